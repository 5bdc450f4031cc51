"""Quality rules: statistics of a text as column expressions, and an ordered list of threshold rules learned from labels.

Everything runs on built-in functions. Nothing here calls Python in a task.

Edge cases: a null or empty text has no words, all statistics are 0 and the base rule rejects it. Null or repeated
ids count as rows of their own. Labels without a document, null labels and an empty label table leave the rule list
shorter or empty; an empty list keeps whatever passes the base rule. Columns of the caller are kept; a column with
the name of a statistic is replaced.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.session import cut_lineage

WINDOW = 8
BASE_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_STATS = ("n_lines", "n_upper", "n_punctuation", "n_digits", "n_distinct_words", "n_bytes")
STATS = (*BASE_STATS, *MORE_STATS)
#: Rates the rules may test; each is computed from the statistics above.
RATES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_rate": ("n_symbols", "n_words"),
    "duplicate_line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "upper_rate": ("n_upper", "word_chars"),
    "punctuation_rate": ("n_punctuation", "n_words"),
    "digit_rate": ("n_digits", "word_chars"),
    "distinct_rate": ("n_distinct_words", "n_words"),
    "words": ("n_words", None),
}


def _removed(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that ``pattern`` matches one by one."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeated_windows(hashes: Column, n: int) -> Column:
    """Words in windows whose hash occurs twice or more in the array of window hashes.

    The (hash, position) pairs are sorted, so equal windows are neighbours; the positions are sorted again, and each
    repeated window adds the words that the one before it does not cover.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(pairs: Column) -> Column:
        before = F.concat(F.array(F.lit(None).cast(pairs_type)), F.slice(pairs, 1, F.greatest(F.size(pairs) - 1, F.lit(0))))
        after = F.concat(F.slice(pairs, 2, F.size(pairs)), F.array(F.lit(None).cast(pairs_type)))
        marked = F.zip_with(
            F.zip_with(before, pairs, lambda a, b: F.struct(b["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("same"), b["h"].alias("h"))),
            after,
            lambda b, c: F.struct(b["i"].alias("i"), (b["same"] | F.coalesce(c["h"] == b["h"], F.lit(False))).alias("same")),
        )
        return F.array_sort(F.transform(F.filter(marked, lambda p: p["same"]), lambda p: p["i"]))

    pairs_type = "struct<h:bigint,i:int>"
    covered = F.aggregate(
        F.transform(F.array(pairs), positions)[0],
        F.struct(F.lit(-n).alias("last"), F.lit(0).alias("total")),
        lambda state, p: F.struct(p.alias("last"), (state["total"] + F.least(F.lit(n), p - state["last"])).alias("total")),
        lambda state: state["total"],
    )
    # Most texts repeat nothing, which the size of the distinct set shows without sorting.
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0).cast("long")


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on; ``step`` elements shorter."""
    size = F.size(hashes)
    return F.zip_with(
        F.slice(hashes, 1, F.greatest(size - step, F.lit(0))),
        F.slice(hashes, step + 1, F.greatest(size - step, F.lit(0))),
        lambda a, b: F.xxhash64(a, b),
    )


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics ``STATS`` (long) of the whole text. No shuffle, one scan.

    Windows of 8 words are compared by a 64-bit hash within one text.
    """
    # The caller's columns travel under other names, so none can clash with a helper column.
    names = [c for c in docs.columns if c not in STATS]
    t = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t")
    df = docs.select(*[F.col(f"`{c}`").alias(f"_own{k}") for k, c in enumerate(names)], t)
    df = df.select("*", F.filter(F.split("_t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("_w"))
    df = df.select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h1"))
    df = df.select("*", _pairs(F.col("_h1"), 1).alias("_h2"))
    df = df.select("*", _pairs(F.col("_h2"), 2).alias("_h4"))
    df = df.select("*", _pairs(F.col("_h4"), 4).alias("_h8"))
    df = df.select("*", F.filter(F.split("_t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("_l"))
    joined = F.array_join("_w", "")
    df = df.select("*", joined.alias("_c"))
    return df.select(
        *[F.col(f"_own{k}").alias(c) for k, c in enumerate(names)],
        F.size("_w").cast("long").alias("n_words"),
        F.length("_c").cast("long").alias("word_chars"),
        _removed(F.col("_c"), "[#*$%&|<>]").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeated_windows(F.col("_h8"), WINDOW).alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        _removed(F.col("_c"), "\\p{Lu}").alias("n_upper"),
        _removed(F.col("_c"), "[!?.,;:]").alias("n_punctuation"),
        _removed(F.col("_c"), "[0-9]").alias("n_digits"),
        F.size(F.array_distinct("_h1")).cast("long").alias("n_distinct_words"),
        F.octet_length("_t").cast("long").alias("n_bytes"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rate(name: str) -> Column:
    above, below = RATES[name]
    value = F.col(above).cast("double")
    return value if below is None else F.when(F.col(below) > 0, value / F.col(below)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    """``rate >= threshold`` or ``rate < threshold``."""

    name: str
    above: bool
    threshold: float

    def column(self, value: Column | None = None) -> Column:
        value = rate(self.name) if value is None else value
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules tried in order; the first that holds rejects, no rule keeps."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rejected(self, values=rate) -> Column:
        out = F.lit(False)
        for rule in reversed(self.rules):
            out = F.when(reduce(operator.and_, [c.column(values(c.name)) for c in rule]), F.lit(True)).otherwise(out)
        return out

    def first_rule(self) -> Column:
        """Number of the rule that rejects, from 0; null if none does."""
        out = F.lit(None).cast("int")
        for k, rule in reversed(list(enumerate(self.rules))):
            out = F.when(reduce(operator.and_, [c.column() for c in rule]), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, rule)) for rule in self.rules)


@dataclass(frozen=True)
class Settings:
    """Of the learner. ``sample`` bounds the labelled rows that are fitted; more are thinned by a hash of the id."""

    sample: int = 1_000_000
    bins: int = 32
    rules: int = 12
    conditions: int = 4
    precision: float = 0.9
    support: int = 5
    prune_share: float = 1 / 3
    rates: tuple[str, ...] = field(default=tuple(RATES))


def _entropy_gain(p0: float, n0: float, p: float, n: float) -> float:
    """Information gained about the bad rows a condition keeps."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(labelled: DataFrame, bad: str, key: str, settings: Settings = Settings()) -> DecisionList:
    """Sequential covering over rows with the statistics, ``bad`` (boolean) and ``key`` (for the split).

    Thresholds are quantiles of each rate. A rule grows by the condition with the highest gain on the grow part and
    is cut back on the prune part; rows it covers leave before the next rule starts. A rule must reach
    ``precision`` on the prune part and cover ``support`` bad rows there, so a clean text is rarely rejected.
    Each step collects one histogram of (rate, bin, part, bad): at most 4 x rates x bins rows whatever the input.
    """
    names = list(settings.rates)
    total = labelled.where(F.col(bad).isNotNull()).count()
    if not total:
        return DecisionList()
    # The prune part is a third of the rows by a hash of the key; rows without a key are all in the grow part.
    part = (F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(3000)) < int(3000 * settings.prune_share)).cast("int")
    thin = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, settings.sample / total))
    rows = cut_lineage(
        labelled.where(F.col(bad).isNotNull() & thin).select(
            F.col(bad).alias("bad"), F.coalesce(part, F.lit(0)).alias("part"), *[rate(n).alias(n) for n in names]
        ),
        "labelled",
    )
    shares = [k / settings.bins for k in range(1, settings.bins)]
    # Quantiles of both classes, so that a rare class has thresholds of its own.
    found = rows.groupBy("bad").agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in names]).collect()
    edges = {n: sorted({float(v) for row in found for v in (row[n] or [])}) for n in names}
    # Bin k of a rate holds values with k edges at or below them.
    binned = cut_lineage(
        rows.select(
            "bad",
            "part",
            *[
                (reduce(operator.add, [(F.col(n) >= F.lit(e)).cast("int") for e in edges[n]], F.lit(0))).alias(n)
                for n in names
            ],
        ),
        "binned",
    )

    def histogram(left: DataFrame) -> dict:
        """(rate, bin) -> bad and good counts of both parts."""
        cells = left.select("bad", "part", F.explode(F.array(*[F.struct(F.lit(k).alias("rate"), F.col(n).alias("bin")) for k, n in enumerate(names)])).alias("c"))
        out: dict = {}
        for r in cells.groupBy("c.rate", "c.bin", "part", "bad").count().collect():
            out.setdefault(names[r["rate"]], {}).setdefault(r["bin"], [[0, 0], [0, 0]])[r["part"]][0 if r["bad"] else 1] += r["count"]
        return out

    def holds(rule: list[tuple[str, bool, int]]) -> Column:
        return reduce(operator.and_, [(F.col(n) >= k) if above else (F.col(n) < k) for n, above, k in rule], F.lit(True))

    rules, covered = [], F.lit(False)
    for _ in range(settings.rules):
        left = binned.where(~covered)
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < settings.conditions:
            counts = histogram(left.where(holds(rule)))
            some = next(iter(counts.values()), {})
            p0, n0 = (sum(c[0][j] for c in some.values()) for j in (0, 1))
            if not p0 or (not n0 and rule):
                break
            best = None
            for n in names:
                for k in range(1, len(edges[n]) + 1):
                    for above in (True, False):
                        inside = [c[0] for b, c in counts.get(n, {}).items() if (b >= k) == above]
                        p, m = sum(c[0] for c in inside), sum(c[1] for c in inside)
                        if p < settings.support or (n0 and m == n0):
                            continue
                        gain = _entropy_gain(p0, n0, p, m) if n0 else float(p)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, (n, above, k))
            if best is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # Every shortened form of the rule is judged on the prune part in one aggregate.
        judged = left.where("part = 1").agg(
            *[F.count_if(holds(rule[:j]) & F.col("bad")).alias(f"p{j}") for j in range(1, len(rule) + 1)],
            *[F.count_if(holds(rule[:j]) & ~F.col("bad")).alias(f"n{j}") for j in range(1, len(rule) + 1)],
        ).first()
        worth = [((judged[f"p{j}"] - judged[f"n{j}"]) / max(1, judged[f"p{j}"] + judged[f"n{j}"]), -j) for j in range(1, len(rule) + 1)]
        keep = -max(worth)[1]
        p, n = judged[f"p{keep}"], judged[f"n{keep}"]
        if p < settings.support or p < settings.precision * (p + n):
            break
        rule = rule[:keep]
        rules.append(rule)
        covered = covered | holds(rule)
    return DecisionList(tuple(tuple(Condition(n, above, edges[n][k - 1]) for n, above, k in rule) for rule in rules))


def labelled_stats(stats: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Statistics of the labelled rows that pass the base rule, with ``bad`` (quality 0).

    The rules are tried after the base rule, so they are learned on what it leaves. A document labelled twice is
    fitted twice.
    """
    marks = labels.select(F.col(key).alias("_key"), (F.col(quality) == 0).alias("_bad"))
    joined = stats.where(~base_failed()).join(marks, F.col(key) == F.col("_key"))
    return cut_lineage(joined.select(F.col(key).alias("_id"), "_bad", *STATS), "labelled_stats")


def verdicts(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``stats`` with ``base_failed``, ``kept`` and the number of the rejecting ``rule``."""
    return stats.select(
        *[F.col(f"`{c}`") for c in stats.columns if c not in ("base_failed", "kept", "rule")],
        base_failed().alias("base_failed"),
        (~(base_failed() | rules.rejected())).alias("kept"),
        rules.first_rule().alias("rule"),
    )


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Statistics and verdict of every document: the text is read once, the narrow statistics are stored."""
    stats = cut_lineage(with_stats(docs).select("doc_id", *STATS), "stats")
    return verdicts(stats, learn(labelled_stats(stats, labels), "_bad", "_id", settings))


def labelled_docs(docs: DataFrame, labels: DataFrame, settings: Settings, key: str = "doc_id") -> DataFrame:
    """The documents that have a label, of at most about ``settings.sample`` labels: more are thinned as ``learn`` does.

    That bound is what lets the ids be broadcast, so no text is shuffled.
    """
    ids = labels.select(F.col(key).alias("_label")).where("_label is not null").distinct()
    share = min(1.0, settings.sample / max(1, ids.count()))
    thin = F.pmod(F.xxhash64(F.lit("sample"), F.col("_label")), F.lit(1_000_000)) < math.ceil(1e6 * share)
    return docs.join(F.broadcast(ids.where(thin)), F.col(f"`{key}`") == F.col("_label"), "left_semi")


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    The rules are learned on the labelled documents alone; then one pass over all texts judges and filters.
    """
    known = cut_lineage(with_stats(labelled_docs(docs.select("doc_id", "text"), labels, settings)).select("doc_id", *STATS), "stats")
    rules = learn(labelled_stats(known, labels), "_bad", "_id", settings)
    # Renamed, so that no column of the caller replaces a statistic or a verdict.
    own = [F.col(f"`{c}`").alias(f"_row{k}") for k, c in enumerate(docs.columns)]
    # The row number keeps the filter above the statistics: pushed below, it would hold many copies of them.
    stats = with_stats(docs.select(*own, F.col("text").alias("_text")), "_text").withColumn("_nth", F.monotonically_increasing_id())
    return verdicts(stats, rules).where("kept and _nth >= 0").select(*[F.col(f"_row{k}").alias(c) for k, c in enumerate(docs.columns)])
