"""Exact order statistics, time splits and running sums over a global order.

A window without a partition key puts all rows into one task, and ``percentile`` keeps every
distinct value in one buffer. Neither holds at scale. Two building blocks replace them:

* ``order_statistics`` finds the exact k-th smallest values in two scans: mergeable quantile sketches give every
  rank a bracket with a proven error, then one map-side-combined ``groupBy`` counts the rows between brackets and the
  distinct values inside them. Where sketches do not serve (integers beyond 2^53, very many rows) repeated
  histograms narrow an interval down, each pass filtering to the part that holds the rank.
* ``running_sums`` splits the order into range buckets taken from the data, sorts inside buckets in
  parallel and adds the totals of the earlier buckets.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import key_hash
from ..functions.scalars import micros_of, timestamp_literal


# --- k-th smallest ----------------------------------------------------------

@dataclass(frozen=True)
class RankValue:
    """The value at a rank, how many rows lie below it and how many equal it."""

    value: float
    below: int
    equal: int


@dataclass
class _Interval:
    column: str
    low: float
    high: float
    below: int
    rows: int
    ranks: list[int] = field(default_factory=list)


def _usable(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    is_float = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.when(~F.isnan(c), c) if is_float else c


#: Points of a sketch's grid, and rows per row of rank error: a point is off by at most one in ``ACCURACY`` rows.
GRID, ACCURACY = 1_000, 10_000
#: Distinct values inside brackets that are ranked in one pass, at most.
INSIDE = 4_000_000


def sketched(df: DataFrame, name: str) -> Column:
    """Approximate values at ``GRID - 1`` even shares, from a sketch that merges across tasks."""
    return F.percentile_approx(_usable(df, name), shares_array(GRID), ACCURACY)


def shares_array(n: int) -> Column:
    """The shares 1/n to (n - 1)/n as one constant."""
    return F.expr("array(" + ", ".join(f"{k / n!r}D" for k in range(1, n)) + ")")


def value_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """(non-missing rows, min, max, sketched grid) per column in one aggregate."""
    parts = []
    for i, name in enumerate(columns):
        c = _usable(df, name)
        parts += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), sketched(df, name).alias(f"q{i}")]
    row = df.agg(*parts).first()
    return {name: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"q{i}"] or []) for i, name in enumerate(columns)}


def _bracket(rank: int, n: int, low, high, grid: list) -> tuple:
    """Values between which the value at ``rank`` lies, by the error of the sketch."""
    slack = n / ACCURACY + 1
    below = bisect.bisect_left(range(1, GRID), True, key=lambda k: k / GRID * n + slack >= rank)
    above = bisect.bisect_left(range(1, GRID), True, key=lambda k: k / GRID * n - slack > rank)
    return (grid[below - 1] if below else low), (grid[above] if above < len(grid) else high)


def _by_brackets(df: DataFrame, ranks: dict[str, list[int]], ranges: dict[str, tuple]) -> tuple[dict[str, dict[int, RankValue]], list[_Interval]]:
    """One scan: values at the ranks, and the intervals of brackets that hold too many values to rank at once.

    Every value of a column falls into one part: a bracket, whose distinct values are counted, or the space before,
    between and behind brackets, of which only the number of rows is needed.
    """
    parts, hits, owner, wanted, wide = [], [], {}, {}, {}
    for nth, (column, of) in enumerate(ranks.items()):
        n, low, high, grid = ranges[column]
        ends = sorted((*_bracket(r, n, low, high, grid), r) for r in of)
        merged: list[list] = []
        for a, b, r in ends:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
                merged[-1][2].append(r)
            else:
                merged.append([a, b, [r]])
        value = F.col(column).cast("double") if column in df.columns else F.col(column)
        many = 3 * n / GRID * len(merged) > INSIDE
        hit = None
        place = lambda inside: F.struct(F.lit(len(parts)).alias("part"), (value if inside and not many else F.lit(None).cast("double")).alias("value"))
        for a, b, of_part in merged:
            for inside, bound in ((False, value < F.lit(float(a))), (True, value <= F.lit(float(b)))):
                hit = F.when(bound, place(inside)) if hit is None else hit.when(bound, place(inside))
                owner[len(parts)] = nth
                if inside and many:
                    wide[len(parts)] = _Interval(column, a, b, 0, 0, of_part)
                elif inside:
                    wanted[len(parts)] = (column, of_part)
                parts.append(column)
        # Missing values meet no bound and reach no part: the rest stands behind all brackets, which nothing needs.
        hits.append(hit)
    counted = df.select(F.explode(F.array(*hits)).alias("hit")).where("hit is not null").groupBy("hit.part", "hit.value").agg(F.count("*").alias("n"))
    # One row per part.
    groups = F.create_map(*[F.lit(x) for pair in owner.items() for x in pair])
    earlier = Window.partitionBy("owner").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("part").agg(F.sum("n").alias("rows")).withColumn("owner", groups[F.col("part")])
    offsets = totals.select("part", "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    before = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.where(F.col("value").isNotNull() | F.col("part").isin(list(wide) or [-1])).join(F.broadcast(offsets), "part")
    ranked = placed.withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    listed = {**{k: r for k, (_, r) in wanted.items()}, **{k: w.ranks for k, w in wide.items()}}
    places = F.create_map(*[x for k, r in listed.items() for x in (F.lit(k), F.array(*[F.lit(i).cast("long") for i in r]))])
    held = F.exists(places[F.col("part")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
    found: dict[str, dict[int, RankValue]] = {c: {} for c in ranks}
    rest = []
    for row in ranked.where(held).collect():
        k = row["part"]
        if k in wide:
            w = wide[k]
            rest.append(_Interval(w.column, w.low, w.high, row["before"], row["n"], w.ranks))
            continue
        column, of = wanted[k]
        value = row["value"] if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else int(row["value"])
        for r in of:
            if row["before"] <= r < row["before"] + row["n"]:
                found[column][r] = RankValue(value, row["before"], row["n"])
    return found, rest


def _sketches_serve(df: DataFrame, name: str, range_: tuple, finish_rows: int) -> bool:
    """Sketches and brackets compute in doubles, which hold floats and integers up to 2^53."""
    kind = df.schema[name].dataType
    if len(range_) < 4 or not range_[3] or range_[0] <= finish_rows:
        return False
    return isinstance(kind, (T.DoubleType, T.FloatType)) or (isinstance(kind, T.IntegralType) and max(abs(range_[1]), abs(range_[2])) < 2**53)


def finite_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, int, float, float]]:
    """(rows of -inf, finite rows, finite min, finite max) per column in one aggregate."""
    parts = []
    for i, name in enumerate(columns):
        c = _usable(df, name)
        inside = F.when(F.abs(c) < F.lit(math.inf), c)
        parts += [F.count_if(c == F.lit(-math.inf)).alias(f"u{i}"), F.count(inside).alias(f"n{i}"), F.min(inside).alias(f"lo{i}"), F.max(inside).alias(f"hi{i}")]
    row = df.agg(*parts).first()
    return {name: (row[f"u{i}"], row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, name in enumerate(columns)}


def order_statistics(
    df: DataFrame,
    ranks: dict[str, list[int]],
    ranges: dict[str, tuple[int, float, float]] | None = None,
    slots: int = 1024,
    finish_rows: int = 20_000,
    prefilter: Callable[[float, float], Column] | None = None,
    brackets: bool = True,
) -> dict[str, dict[int, RankValue]]:
    """Exact values at the given 0-based ranks of several numeric columns at once.

    ``ranges`` come from ``value_ranges``. Columns with more than ``finish_rows`` rows are searched by ``brackets``, all
    of them in one scan. Otherwise: an interval with more than ``finish_rows`` rows is cut into ``slots`` equal parts and only the
    parts that hold a wanted rank are searched again, with their true min and max as new ends. At
    or below ``finish_rows`` its distinct values are counted. The parts are ranked on the executors;
    one row per part that holds a wanted rank reaches the driver. Infinite values are counted apart
    and the finite ones searched, so an interval always shrinks: its ends fall into different parts.
    ``prefilter(low, high)`` may name a filter on source columns that the scan can use; it must keep
    all rows of the interval.
    """
    columns = [c for c in ranks if ranks[c]]
    found: dict[str, dict[int, RankValue]] = {c: {} for c in ranks}
    if not columns:
        return found
    ranges = ranges or value_ranges(df, columns)
    todo = []
    if brackets:
        served = [c for c in columns if _sketches_serve(df, c, ranges[c], finish_rows)]
        at = {c: sorted({r for r in ranks[c] if 0 <= r < ranges[c][0]}) for c in served}
        at = {c: r for c, r in at.items() if r}
        if at:
            quick, todo = _by_brackets(df, at, ranges)
            # A rank that its bracket missed is searched again below; the error bound rules that out.
            late = {p.column for p in todo}
            served = [c for c in served if c in late or set(at.get(c, ())) == set(quick.get(c, ()))]
            for c in served:
                found[c].update(quick.get(c, {}))
        columns = [c for c in columns if c not in served]
    endless = [c for c in columns if any(isinstance(e, float) and math.isinf(e) for e in ranges[c][1:3])]
    finite = finite_ranges(df, endless) if endless else {}
    for c in columns:
        n, low, high = ranges[c][:3]
        under = 0
        wanted = sorted({r for r in ranks[c] if 0 <= r < n})
        if c in finite:
            under, inside, low, high = finite[c]
            for r in wanted:
                if r < under:
                    found[c][r] = RankValue(-math.inf, 0, under)
                elif r >= under + inside:
                    found[c][r] = RankValue(math.inf, under + inside, n - under - inside)
            wanted = [r for r in wanted if under <= r < under + inside]
            n = inside
        if wanted:
            todo.append(_Interval(c, low, high, under, n, wanted))
    while todo:
        open_ = []
        for part in todo:
            if part.low == part.high:
                for r in part.ranks:
                    found[part.column][r] = RankValue(part.low, part.below, part.rows)
            else:
                open_.append(part)
        if prefilter and open_:
            df = df.where(prefilter(min(p.low for p in open_), max(p.high for p in open_)))
        todo = _narrow(df, open_, slots, finish_rows) if open_ else []
    return found


def _slot(value: Column, part: _Interval, slots: int, exact: bool) -> Column:
    """The slot number of a value in its interval; the value itself once few rows are left."""
    if exact:
        return value
    whole = isinstance(part.low, int)
    near = whole and part.high - part.low < 2 ** 62
    offset = (value - F.lit(part.low)) if near else value.cast("double") - F.lit(float(part.low))
    width = float(part.high - part.low) if near else float(part.high) - float(part.low)
    if math.isinf(width):
        # Halves keep the difference of very large ends finite.
        offset, width = value.cast("double") / 2 - F.lit(float(part.low) / 2), float(part.high) / 2 - float(part.low) / 2
    slot = F.least(F.floor(offset.cast("double") / F.lit(width) * slots), F.lit(slots - 1))
    return slot if whole else slot.cast("double")


def _narrow(df: DataFrame, parts: list[_Interval], slots: int, finish_rows: int) -> list[_Interval]:
    """One pass: count rows per slot of every open interval, keep the slots that hold a rank.

    The intervals of one column are disjoint, so a row gives at most one (part, slot) per column.
    Misses are dropped after the explode, not by a filter on the columns: such a filter would move
    below the projection and compute a derived column anew for every comparison.
    """
    by_type: dict[str, dict[str, list[int]]] = {}
    for i, part in enumerate(parts):
        kind = df.schema[part.column].dataType.simpleString()
        by_type.setdefault(kind, {}).setdefault(part.column, []).append(i)
    counts = []
    for columns in by_type.values():
        hits = []
        for column, members in columns.items():
            value = F.col(column)
            hit = F.lit(None)
            for i in members:
                part = parts[i]
                here = value.between(F.lit(part.low), F.lit(part.high))
                slot = _slot(value, part, slots, part.rows <= finish_rows)
                hit = F.when(here, F.struct(F.lit(i).alias("part"), slot.alias("slot"), value.alias("value"))).otherwise(hit)
            hits.append(hit)
        rows = df.select(F.explode(F.array(*hits)).alias("hit")).where("hit is not null")
        slots_found = rows.groupBy("hit.part", "hit.slot").agg(
            F.count("*").alias("n"), F.min("hit.value").alias("low"), F.max("hit.value").alias("high")
        )
        # At most ``max(slots, finish_rows)`` slots per part are ranked together.
        earlier = Window.partitionBy("part").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
        ranked = slots_found.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        members = [i for m in columns.values() for i in m]
        wanted = F.create_map(*[x for i in members for x in (F.lit(i), F.array(*[F.lit(r - parts[i].below).cast("long") for r in parts[i].ranks]))])
        held = F.exists(wanted[F.col("part")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")))
        counts += ranked.where(held).collect()
    out = []
    for g in sorted(counts, key=lambda r: (r["part"], r["before"])):
        part = parts[g["part"]]
        below = part.below + g["before"]
        mine = [r for r in part.ranks if below <= r < below + g["n"]]
        if g["low"] == part.low and g["high"] == part.high and g["n"] == part.rows and part.low != part.high:
            raise ArithmeticError(f"the search of {part.column} between {part.low} and {part.high} does not shrink")
        out.append(_Interval(part.column, g["low"], g["high"], below, g["n"], mine))
    return out


def exact_quantiles(df: DataFrame, probabilities: dict[str, list[float]], **search) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between the two nearest order statistics."""
    columns = list(probabilities)
    ranges = value_ranges(df, columns)
    places, ranks = {}, {}
    for c in columns:
        n = ranges[c][0]
        places[c] = [(n - 1) * p for p in probabilities[c]] if n else []
        ranks[c] = sorted({r for h in places[c] for r in (math.floor(h), math.ceil(h))})
    found = order_statistics(df, ranks, ranges, **search)
    out = {}
    for c in columns:
        values = []
        for h in places[c]:
            low, high = found[c][math.floor(h)].value, found[c][math.ceil(h)].value
            # Equal ends, infinite ones too, need no interpolation; a place between -inf and inf has no value.
            values.append(float(low) if low == high or h == math.floor(h) else float(low + (high - low) * (h - math.floor(h))))
        out[c] = values or [None] * len(probabilities[c])
    return out


# --- splits by position in time ----------------------------------------------

@dataclass(frozen=True)
class Cut:
    """The first key at or after a position: rows before it have ``(time, tie) < (micros, tie)``."""

    micros: int | None
    tie: int | None


def _tie_key(df: DataFrame, id_column: str) -> Column:
    """Integral ids break ties themselves; other ids by 52 bits of their md5."""
    if isinstance(df.schema[id_column].dataType, T.IntegralType):
        return F.col(id_column).cast("long")
    return key_hash(id_column, "")


def cuts_in_time(df: DataFrame, ratios: list[float], time_column: str, id_column: str, **search) -> list[Cut]:
    """The keys at the positions ``int(n * ratio)`` of the order (time, id), without sorting the table.

    Exact when (time, id) is unique. Only where a position falls inside a run of equal timestamps
    is a second search made, over the ids of that run. Rows without a time come last.
    """
    keyed = df.select(
        micros_of(time_column).alias("micros"), _tie_key(df, id_column).alias("tie"), F.col(time_column).alias("ts")
    )
    ends = keyed.agg(F.count("*").alias("rows"), F.count("micros").alias("n"), F.min("micros").alias("lo"), F.max("micros").alias("hi"), sketched(keyed, "micros").alias("q")).first()
    positions = [int(ends["rows"] * ratio) for ratio in ratios]
    window = lambda low, high: F.col("ts").between(timestamp_literal(low), timestamp_literal(high))
    ranges = {"micros": (ends["n"], ends["lo"], ends["hi"], ends["q"] or [])}
    at = order_statistics(keyed, {"micros": positions}, ranges, prefilter=window, **search)["micros"]
    cuts = []
    for p in positions:
        hit = at.get(p)
        if hit is None:
            cuts.append(Cut(None, None))
        elif hit.below == p:
            cuts.append(Cut(hit.value, None))
        else:
            run = keyed.where(F.col("ts") == timestamp_literal(hit.value))
            local = p - hit.below
            tie = order_statistics(run, {"tie": [local]}, **search)["tie"][local].value
            cuts.append(Cut(hit.value, tie))
    return cuts


def before(cut: Cut, time_column: str, tie: Column) -> Column:
    """Predicate for the rows before a cut, on literals only: a filter that the scan can use."""
    if cut.micros is None:
        return F.lit(True)
    ts = timestamp_literal(cut.micros)
    if cut.tie is None:
        return F.col(time_column) < ts
    return (F.col(time_column) < ts) | ((F.col(time_column) == ts) & (tie < F.lit(cut.tie)))


@dataclass(frozen=True)
class TimeSplit:
    """Fitted cuts between train, val and test: literals only, so using it shuffles nothing."""

    first: Cut
    second: Cut
    time_column: str
    id_column: str

    @classmethod
    def fit(
        cls, df: DataFrame, train_ratio: float = 0.6, val_ratio: float = 0.2,
        time_column: str = "timestamp", id_column: str = "transaction_id", **search,
    ) -> "TimeSplit":
        ratios = [train_ratio, train_ratio + val_ratio]
        return cls(*cuts_in_time(df, ratios, time_column, id_column, **search), time_column, id_column)

    def _before(self, df: DataFrame) -> tuple[Column, Column]:
        tie = _tie_key(df, self.id_column)
        return before(self.first, self.time_column, tie), before(self.second, self.time_column, tie)

    def label(self, df: DataFrame) -> DataFrame:
        """Add ``split`` = train | val | test."""
        first, second = self._before(df)
        return df.withColumn("split", F.when(first, "train").when(second, "val").otherwise("test"))

    def rows(self, df: DataFrame, split: str) -> DataFrame:
        """The rows of one split by plain time bounds, which the scan can use; a filter on the
        ``split`` column itself cannot be turned back into bounds."""
        first, second = self._before(df)
        untimed = F.col(self.time_column).isNull()
        return df.where({"train": first, "val": ~first & second, "test": ~second | untimed}[split])


def with_time_split(df: DataFrame, train_ratio: float = 0.6, val_ratio: float = 0.2, time_column: str = "timestamp", id_column: str = "transaction_id", **search) -> DataFrame:
    """Add ``split`` = train | val | test by position in time."""
    return TimeSplit.fit(df, train_ratio, val_ratio, time_column, id_column, **search).label(df)


def split_reference_current(
    df: DataFrame,
    reference_ratio: float = 0.5,
    time_column: str = "timestamp",
    id_column: str = "transaction_id",
    salt: str = "shuffle",
    **search,
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * ratio)`` rows by time and the rest; by id hash where no time exists."""
    if time_column not in df.columns:
        return random_split(df, reference_ratio, id_column, salt, **search)
    (cut,) = cuts_in_time(df, [reference_ratio], time_column, id_column, **search)
    first = before(cut, time_column, _tie_key(df, id_column))
    return df.where(first), df.where(~first | F.col(time_column).isNull())


def random_split(
    df: DataFrame, ratio: float = 0.5, id_column: str = "transaction_id", salt: str = "shuffle", **search
) -> tuple[DataFrame, DataFrame]:
    """An exact ``int(n * ratio)`` / rest split in the order of the id's hash."""
    hashed = df.withColumn("__hash", key_hash(id_column, salt))
    rows = df.count()
    position = int(rows * ratio)
    if position >= rows:
        return df, df.where(F.lit(False))
    hit = order_statistics(hashed, {"__hash": [position]}, **search)["__hash"][position]
    first = F.col("__hash") < F.lit(hit.value)
    if hit.below != position:
        # Several ids share the 52-bit hash at the cut: order those few by the id itself.
        same = hashed.where(F.col("__hash") == F.lit(hit.value)).select(id_column)
        edge = same.orderBy(id_column).limit(position - hit.below + 1).agg(F.max(id_column)).first()[0]
        first = first | ((F.col("__hash") == F.lit(hit.value)) & (F.col(id_column) < F.lit(edge)))
    return hashed.where(first).drop("__hash"), hashed.where(~first).drop("__hash")


def hash_sample(df: DataFrame, rows: int, id_column: str = "transaction_id", salt: str = "sample") -> DataFrame:
    """A fixed-size sample: the rows with the smallest id hashes."""
    return df.orderBy(key_hash(id_column, salt), id_column).limit(rows)


# --- running sums -----------------------------------------------------------

def default_buckets(df: DataFrame) -> int:
    return max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def bucket_edges(df: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Approximately equal-depth bucket edges per column, from one pass of quantile sketches.

    The edges only spread the work; no result depends on where they fall.
    """
    grid = [i / buckets for i in range(1, buckets)]
    row = df.agg(
        *[F.percentile_approx(_usable(df, c).cast("double"), grid, buckets * 20).alias(c) for c in columns]
    ).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def with_buckets(df: DataFrame, columns: list[str], buckets: int | None = None, suffix: str = "__b") -> DataFrame:
    """Add a range bucket number per column (binary search on the column's edges, in the JVM)."""
    edges = bucket_edges(df, columns, buckets or default_buckets(df))
    placed = Bucketizer(
        splitsArray=[[-math.inf, *(edges[c] or [0.0]), math.inf] for c in columns],
        inputCols=columns,
        outputCols=[c + suffix for c in columns],
        handleInvalid="keep",
    ).transform(df)
    return placed.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in columns})


def running_sums(
    df: DataFrame, order: str, sums: list[str], bucket: str, group: list[str], descending: bool = False
) -> DataFrame:
    """Add ``cum_<c>`` for each summed column, over ``order`` within ``group``.

    ``df`` has one row per (group, order value), so no run of ties can fill a bucket. The totals
    table holds one row per (group, bucket); its window is the only one not split by bucket.
    """
    totals = df.groupBy(*group, bucket).agg(*[F.sum(c).alias(c) for c in sums])
    earlier = earlier_buckets(bucket, group, descending)
    offsets = totals.select(*group, bucket, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums])
    within = within_bucket(order, bucket, group, descending).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(F.broadcast(offsets), [*group, bucket])  # at most groups x buckets rows
        .select(
            *[F.col(c) for c in df.columns],
            *[(F.sum(c).over(within) + F.col(f"__o_{c}")).alias(f"cum_{c}") for c in sums],
        )
    )


def earlier_buckets(bucket: str, group: list[str], descending: bool = False):
    """Frame of the buckets before this one; only for tables with one row per (group, bucket)."""
    direction = F.desc if descending else F.asc
    return Window.partitionBy(*group).orderBy(direction(bucket)).rowsBetween(Window.unboundedPreceding, -1)


def within_bucket(order: str, bucket: str, group: list[str], descending: bool = False):
    return Window.partitionBy(*group, bucket).orderBy((F.desc if descending else F.asc)(order))
