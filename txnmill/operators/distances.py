"""Exact two-sample distances of many numeric columns from bucket totals.

A histogram of buckets is counted for both sides in one scan, one row per task, column and filled bucket, whatever the
number of rows. Bucket totals decide almost everything:

* Kolmogorov-Smirnov: the gap behind every bucket is known, and its largest is a lower bound. A bucket can hold a larger
  one only if all of one side's rows could come first and still exceed that bound; only such buckets are opened.
* Wasserstein: where the gap keeps its sign throughout a bucket, the area between the distribution functions is the
  difference of two integrals, which counts and sums of values give. Only buckets where it may turn are opened.

A bucket of one value is never opened. For opened buckets a second scan takes their distinct values with counts, summed
before the shuffle. Both results are exact whatever the edges are; these come from quantile sketches and only decide how
much is opened. Two samples of nearly one distribution open many buckets, so the number of buckets follows the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import shares_array

#: Rows of a bucket that are aimed at, and bounds of the number of buckets.
ROWS, FEWEST, MOST = 100_000, 256, 8_192

HISTOGRAM = "c int, b int, ref long, cur long, sum_ref double, sum_cur double, squares double, low double, high double"
POINTS = "c int, b int, value double, ref long, cur long"


@dataclass(frozen=True)
class Edges:
    """Per column, ascending inner edges; bucket k holds values above edge k - 1 and up to edge k."""

    inner: list[np.ndarray]
    centre: list[float]

    def bucket(self, column: int, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.inner[column], values, side="left")


def edges_of(both: DataFrame, columns: list[str], buckets: int | None) -> Edges:
    n = buckets or min(MOST, max(FEWEST, -(-both.count() // ROWS)))
    shares = shares_array(max(n, 2))
    finite = [F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in columns]
    row = both.agg(*[F.percentile_approx(v, shares, 10 * n).alias(f"q{i}") for i, v in enumerate(finite)]).first()
    inner = [np.unique(np.array(row[i] or [0.0], float)) for i in range(len(columns))]
    inner = [x[np.isfinite(x)] for x in inner]
    return Edges(inner, [float(x[len(x) // 2]) if len(x) else 0.0 for x in inner])


def _values(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column, without nulls and NaN, and which of them are current."""
    x = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
    held = ~np.isnan(x)
    # One zero: -0.0 is the same value.
    return x[held] + 0.0, batch.column("__cur").to_numpy(zero_copy_only=False)[held] == 1


def histogram(both: DataFrame, columns: list[str], edges: Edges) -> DataFrame:
    """(c, b, ...) totals of every filled bucket; ``squares`` are those of the reference around the column's centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [len(e) + 1 for e in edges.inner]
        totals = [{"ref": np.zeros(n, np.int64), "cur": np.zeros(n, np.int64), "sum_ref": np.zeros(n), "sum_cur": np.zeros(n), "squares": np.zeros(n), "low": np.full(n, np.inf), "high": np.full(n, -np.inf)} for n in sizes]
        for batch in batches:
            for i, total in enumerate(totals):
                x, current = _values(batch, i)
                b, n, off = edges.bucket(i, x), sizes[i], x - edges.centre[i]
                for side, name in ((~current, "ref"), (current, "cur")):
                    total[name] += np.bincount(b[side], minlength=n)
                    total[f"sum_{name}"] += np.bincount(b[side], weights=off[side], minlength=n)
                total["squares"] += np.bincount(b[~current], weights=off[~current] ** 2, minlength=n)
                np.minimum.at(total["low"], b, x)
                np.maximum.at(total["high"], b, x)
        for i, total in enumerate(totals):
            at = np.flatnonzero(total["ref"] + total["cur"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), *(pa.array(total[k][at]) for k in ("ref", "cur", "sum_ref", "sum_cur", "squares", "low", "high"))],
                names=["c", "b", "ref", "cur", "sum_ref", "sum_cur", "squares", "low", "high"],
            )

    counted = both.select(*[F.col(f"`{c}`") for c in columns], "__cur").mapInArrow(run, HISTOGRAM)
    return counted.groupBy("c", "b").agg(*[F.sum(k).alias(k) for k in ("ref", "cur", "sum_ref", "sum_cur", "squares")], F.min("low").alias("low"), F.max("high").alias("high"))


def points_of(both: DataFrame, columns: list[str], edges: Edges, opened: dict[int, np.ndarray]) -> DataFrame:
    """(c, b, value, ref, cur): distinct values of the opened buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, open_ in opened.items():
                x, current = _values(batch, i)
                b = edges.bucket(i, x)
                held = open_[b]
                value, nth = np.unique(x[held], return_inverse=True)
                cur = np.bincount(nth, weights=current[held], minlength=len(value)).astype(np.int64)
                ref = np.bincount(nth, minlength=len(value)) - cur
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), i, np.int32)), pa.array(edges.bucket(i, value).astype(np.int32)), pa.array(value), pa.array(ref), pa.array(cur)], names=["c", "b", "value", "ref", "cur"]
                )

    found = both.select(*[F.col(f"`{c}`") for c in columns], "__cur").mapInArrow(run, POINTS)
    return found.groupBy("c", "b", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))


@dataclass
class Column:
    """Bucket totals of one column in order, and what they decide."""

    b: np.ndarray
    ref: np.ndarray
    cur: np.ndarray
    sum_ref: np.ndarray
    sum_cur: np.ndarray
    squares: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __post_init__(self):
        self.n, self.m = int(self.ref.sum()), int(self.cur.sum())
        self.upto_ref, self.upto_cur = np.cumsum(self.ref), np.cumsum(self.cur)
        self.before_ref, self.before_cur = self.upto_ref - self.ref, self.upto_cur - self.cur
        # Up to the first value of the next bucket.
        self.next = np.append(self.low[1:], self.high[-1:])

    @property
    def both(self) -> bool:
        return self.n > 0 and self.m > 0

    def gap(self) -> np.ndarray:
        return self.upto_ref / self.n - self.upto_cur / self.m

    def ks_open(self) -> np.ndarray:
        best = np.abs(self.gap()).max()
        most = np.maximum(self.upto_ref / self.n - self.before_cur / self.m, self.upto_cur / self.m - self.before_ref / self.n)
        return (most > best) & (self.low < self.high)

    def area_open(self) -> np.ndarray:
        above = self.before_ref / self.n >= self.upto_cur / self.m
        below = self.upto_ref / self.n <= self.before_cur / self.m
        return ~(above | below) & (self.low < self.high) | ~np.isfinite(self.low) | ~np.isfinite(self.high)

    def area(self, centre: float) -> np.ndarray:
        """Area between the distribution functions from the first value of each bucket to that of the next, where the
        sign of the gap does not change inside."""
        with np.errstate(invalid="ignore"):
            width = self.high - self.low
            # Integral of a side's function from low to high: each value counts from itself on.
            ref = (self.before_ref * width + self.ref * (self.high - centre) - self.sum_ref) / self.n
            cur = (self.before_cur * width + self.cur * (self.high - centre) - self.sum_cur) / self.m
            inside = np.where(width > 0, np.abs(ref - cur), 0.0)
            return inside + np.abs(self.gap()) * (self.next - self.high)

    def spread(self) -> float:
        mean = self.sum_ref.sum() / self.n
        return float(np.sqrt(max(self.squares.sum() / self.n - mean * mean, 0.0)))


RESULT = "column string, n_ref long, n_cur long, ks double, wasserstein double"


def distances(both: DataFrame, columns: list[str], wanted: tuple[str, ...] = ("ks", "wasserstein"), buckets: int | None = None) -> DataFrame:
    """``RESULT``, one row per column of ``columns``; ``both`` has them as doubles and ``__cur``, 1 for current rows.

    Nulls and NaN are left out. A column without values on a side has counts and no distance. The distance that is not
    ``wanted`` is null. Wasserstein is divided by the reference's standard deviation; without spread it is null.
    """
    spark = both.sparkSession
    edges = edges_of(both, columns, buckets)
    # One row per column and bucket: bounded whatever the input.
    held = histogram(both, columns, edges).toPandas().sort_values(["c", "b"])
    parts = {int(i): Column(*(g[k].to_numpy() for k in ("b", "ref", "cur", "sum_ref", "sum_cur", "squares", "low", "high"))) for i, g in held.groupby("c")}
    opened, rows, outside = {}, {}, []
    for i, part in parts.items():
        if not part.both:
            continue
        open_ks = part.ks_open() if "ks" in wanted else np.zeros(len(part.b), bool)
        open_area = part.area_open() if "wasserstein" in wanted else np.zeros(len(part.b), bool)
        some = open_ks | open_area
        rows[i] = (float(np.abs(part.gap()).max()), float(part.area(edges.centre[i])[~open_area].sum()))
        if some.any():
            opened[i] = np.zeros(len(edges.inner[i]) + 1, bool)
            opened[i][part.b[some]] = True
            outside += [(i, int(part.b[k]), int(part.before_ref[k]), int(part.before_cur[k]), float(part.next[k]), part.n, part.m, bool(open_area[k])) for k in np.flatnonzero(some)]
    extra = {}
    if opened:
        # One row per opened bucket.
        around = spark.createDataFrame(outside, "c int, b int, o_ref long, o_cur long, following double, n long, m long, area boolean")
        order = Window.partitionBy("c", "b").orderBy("value")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        share = lambda side, total: (F.sum(side).over(upto) + F.col(f"o_{side}")) / F.col(total)
        walk = points_of(both, columns, edges, opened).join(F.broadcast(around), ["c", "b"]).select(
            "c", "area", F.abs(share("ref", "n") - share("cur", "m")).alias("gap"), (F.coalesce(F.lead("value").over(order), F.col("following")) - F.col("value")).alias("step")
        )
        found = walk.groupBy("c").agg(F.max("gap").alias("ks"), F.sum(F.when(F.col("area"), F.col("gap") * F.col("step"))).alias("area"))
        extra = {r["c"]: (r["ks"], r["area"] or 0.0) for r in found.collect()}
    out = []
    for i, name in enumerate(columns):
        part = parts.get(i)
        ks = area = None
        if i in rows:
            more = extra.get(i, (0.0, 0.0))
            ks = max(rows[i][0], more[0]) if "ks" in wanted else None
            spread = part.spread()
            area = (rows[i][1] + more[1]) / spread if "wasserstein" in wanted and spread > 0 else None
        out.append((name, part.n if part else 0, part.m if part else 0, ks, area))
    return spark.createDataFrame(out, RESULT)
