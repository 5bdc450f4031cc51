"""Validation rules, suites and record contracts.

Rules are data. A suite of any size is compiled to one aggregate over one scan; the samples of the
failed rules take a second, also single, scan and only when something failed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas


class ValidationFailed(ValueError):
    """Raised by a gate; carries one message per failed rule."""

    def __init__(self, errors: list[str]):
        super().__init__("; ".join(errors))
        self.errors = errors


@dataclass(frozen=True)
class Rule:
    """One check. ``columns`` names the expected set for ``columns_present``."""

    kind: str
    column: str = ""
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    columns: tuple[str, ...] = ()

    def broken(self) -> Column:
        """True on rows that break the rule. Nulls only break ``not_null``."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "between":
            low = F.lit(False) if self.low is None else c < self.low
            high = F.lit(False) if self.high is None else c > self.high
            return F.coalesce(low | high, F.lit(False))
        if self.kind == "in_set":
            return F.coalesce(~c.isin(*self.values), F.lit(False))
        raise ValueError(f"rule {self.kind} is not a row rule")


def raw_suite(all_components: bool = False) -> list[Rule]:
    """Rules for the raw feed; ``all_components`` also requires V1..V28 (the wider stored suite)."""
    required = schemas.RAW_COLUMNS if all_components else ["Time", "Amount", "Class"]
    return [
        Rule("columns_present", columns=tuple(schemas.RAW_COLUMNS)),
        *[Rule("not_null", c) for c in required],
        Rule("between", "Amount", low=0.0),
        Rule("between", "Time", low=0.0),
        Rule("in_set", "Class", values=(0, 1)),
    ]


def processed_suite() -> list[Rule]:
    """Rules for the enriched table."""
    return [
        Rule("columns_present", columns=tuple(schemas.ENRICHED_COLUMNS)),
        *[Rule("not_null", c) for c in ("transaction_id", "user_id", "amount_inr", "is_fraud")],
        *[Rule("between", c, low=0.0) for c in ("amount_inr", "credit_limit", "card_age")],
        *[Rule("in_set", c, values=(0, 1)) for c in ("is_fraud", "is_international", "is_recurring")],
    ]


def check(df: DataFrame, suite: list[Rule]) -> DataFrame:
    """(position, rule, column, ok, unexpected_count): one aggregate whatever the number of rules.

    A rule on an absent column fails without a count.
    """
    there = set(df.columns)
    results, aggregates = [], {}
    for i, rule in enumerate(suite):
        if rule.kind == "columns_present":
            count = F.lit(len(set(rule.columns) - there)).cast("long")
        elif rule.column not in there:
            count = F.lit(None).cast("long")
        else:
            aggregates[f"r{i}"] = F.count_if(rule.broken())
            count = F.col(f"r{i}")
        results.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(rule.kind).alias("rule"),
                F.lit(rule.column).alias("column"),
                F.coalesce(count == 0, F.lit(False)).alias("ok"),
                count.alias("unexpected_count"),
            )
        )
    aggregates = aggregates or {"r": F.count("*")}
    wide = df.agg(*[c.alias(name) for name, c in aggregates.items()])
    return wide.select(F.inline(F.array(*results)))


def samples(df: DataFrame, rules: dict[int, Rule], order: str, n: int = 3) -> DataFrame:
    """(position, samples): the first ``n`` offending values per rule, by ``order``.

    ``row_number() <= n`` is applied inside each task before the shuffle (window group limit), so
    a rule that half the table breaks still sends only ``n`` rows per task.
    """
    bad = [
        F.when(rule.broken(), F.struct(F.lit(i).alias("position"), F.col(rule.column).cast("string").alias("value")))
        for i, rule in rules.items()
    ]
    hits = df.select(F.col(order).alias("__order"), F.explode(F.array_compact(F.array(*bad))).alias("hit")).select(
        "__order", "hit.position", "hit.value"
    )
    place = F.row_number().over(Window.partitionBy("position").orderBy("__order", "value"))
    first = hits.withColumn("place", place).where(F.col("place") <= n)
    return first.groupBy("position").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda s: F.coalesce(s["value"], F.lit("null"))).alias("samples")
    )


def run_suite(df: DataFrame, suite: list[Rule], order: str | None = None) -> DataFrame:
    """``check`` plus up to three offending values of each failed rule."""
    result = check(df, suite)
    spark = df.sparkSession
    done = spark.createDataFrame(result.toArrow(), result.schema)  # one row per rule
    failed = [r["position"] for r in done.where("not ok and unexpected_count > 0").collect()]
    rules = {i: suite[i] for i in failed if suite[i].kind != "columns_present"}
    if not rules:
        return done.withColumn("samples", F.lit(None).cast("array<string>"))
    return done.join(F.broadcast(samples(df, rules, order or df.columns[0])), "position", "left")


def validate(df: DataFrame, suite: list[Rule], order: str | None = None) -> tuple[bool, list[str]]:
    """(all passed, one line per broken rule: place in the suite, rule, column, rows, some values)."""
    broken = run_suite(df, suite, order).where("not ok").orderBy("position").collect()
    return not broken, [_line(r) for r in broken]


def _line(r) -> str:
    where = f"{r['rule']}[{r['column']}]" if r["column"] else r["rule"]
    rows = "column absent" if r["unexpected_count"] is None else f"{r['unexpected_count']} rows"
    some = f", such as {', '.join(r['samples'])}" if r["samples"] else ""
    return f"rule {r['position']}, {where}: {rows}{some}"


def gate(df: DataFrame, suite: list[Rule], order: str | None = None) -> DataFrame:
    """The table itself if it passes; else ``ValidationFailed``."""
    ok, errors = validate(df, suite, order)
    if not ok:
        raise ValidationFailed(errors)
    return df


# --- record contract ----------------------------------------------------------

def request_contract() -> dict[str, Column]:
    """Conditions that a scoring request has to meet, by name. A null breaks every one of them;
    the merchant category alone may be null."""
    whole_flag = lambda c: F.col(c).between(0, 1)
    return {
        "amount": F.col("amount") > 0,
        "time": F.col("time") >= 0,
        "card_tier": F.col("card_tier").isin(*schemas.CARD_TIERS),
        "credit_limit": F.col("credit_limit") > 0,
        "card_age": F.col("card_age") >= 0,
        "transaction_channel": F.col("transaction_channel").isin(*schemas.CHANNELS),
        "is_international": whole_flag("is_international"),
        "is_recurring": whole_flag("is_recurring"),
        **{c: F.col(c).isNotNull() & ~F.isnan(c) for c in schemas.COMPONENTS},
    }


def with_broken_rules(df: DataFrame, contract: dict[str, Column]) -> DataFrame:
    """Add ``broken``: names of the conditions that the row does not meet. Works on streams too."""
    names = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in contract.items()]
    return df.withColumn("broken", F.array_compact(F.array(*names)))


def split_by_contract(df: DataFrame, contract: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reasons)."""
    marked = with_broken_rules(df, contract)
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def no_time_leakage(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Whether train ends no later than validation starts, and validation than test."""
    ends = df.agg(
        *[
            f(F.when(F.col("split") == s, F.col(time_column))).alias(f"{s}_{n}")
            for s in ("train", "val", "test")
            for n, f in (("first", F.min), ("last", F.max))
        ]
    )
    return ends.select(
        (F.col("train_last") <= F.col("val_first")).alias("train_val_ok"),
        (F.col("val_last") <= F.col("test_first")).alias("val_test_ok"),
    )
