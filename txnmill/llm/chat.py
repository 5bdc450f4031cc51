"""Preference formatting: the shared turns of a chosen and a rejected conversation become one prompt, the rest two
completions with loss masks.

Turns are equal when role and text are. The prompt is the longest common prefix of turns, rendered once; each completion
is the rest of its conversation. The mask of a completion lists the character ranges that carry loss: the text and
end mark of assistant turns.

Everything runs on built-in functions. A conversation is one row, so its turns are gathered by its id; conversations
with a common opening are never gathered: each is joined with the one best of its opening, dealt over salts.

Edge cases: a null role is "unknown", a null text is empty, null turn numbers come first, equal numbers are ordered by
role and text; rows with a null conversation id belong to no conversation. Equal conversations have empty completions and
empty masks; one that is a prefix of the other has one empty completion. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import salted_join

# Marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ANSWER = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: the (role, text) structs of each conversation in order."""
    made = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    gathered = turns.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("conv_id")).agg(F.sort_array(F.collect_list(made)).alias("turns"))
    return gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y)
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE + "\n"))), "")


def loss_ranges(turns: Column, answer: str = ANSWER) -> Column:
    """Character ranges [start, stop) of the rendered turns that carry loss."""

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + len(OPEN) + F.length(t["role"]) + 1
        stop = start + F.length(t["text"]) + len(CLOSE)
        own = F.when(t["role"] == answer, F.array(F.struct(start.alias("start"), stop.alias("stop")))).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))
        return F.struct((stop + 1).alias("at"), F.concat(state["ranges"], own).alias("ranges"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("ranges"))
    return F.aggregate(turns, begin, add, lambda state: state["ranges"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` (two columns of turns, and any others) with ``n_common, prompt, chosen, rejected`` and their masks."""
    made = ("n_common", "prompt", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask")
    own = [F.col(f"`{c}`") for c in pairs.columns if c not in (chosen, rejected, *made)]
    a, b = F.col(f"`{chosen}`"), F.col(f"`{rejected}`")
    split = pairs.select(*own, a.alias("_a"), b.alias("_b"), common_turns(a, b).alias("n_common"))
    rest = [F.slice(c, F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0))) for c in ("_a", "_b")]
    parts = split.select(*own, "n_common", F.slice("_a", 1, F.col("n_common")).alias("_p"), rest[0].alias("_a"), rest[1].alias("_b"))
    return parts.select(
        *own,
        "n_common",
        rendered(F.col("_p")).alias("prompt"),
        rendered(F.col("_a")).alias("chosen_text"),
        rendered(F.col("_b")).alias("rejected_text"),
        loss_ranges(F.col("_a")).alias("chosen_mask"),
        loss_ranges(F.col("_b")).alias("rejected_mask"),
    )


def same_opening(convs: DataFrame) -> DataFrame:
    """Pairs of conversations with an equal first turn: the one with most answer text (then the smallest id) is chosen
    against each of the others."""
    answers = F.aggregate(F.filter("turns", lambda t: t["role"] == ANSWER), F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]))
    opened = convs.select("conv_id", "turns", F.col("turns")[0].alias("opening"), answers.alias("weight"))
    best = opened.groupBy("opening").agg(F.max(F.struct("weight", (-F.col("conv_id")).alias("id"))).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.where("n > 1").select("opening", (-F.col("best")["id"]).alias("chosen_id"))
    paired = salted_join(opened.select("conv_id", "turns", "opening"), best, ["opening"], ["conv_id"], "inner")
    rejected = paired.where("conv_id != chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    chosen = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    return salted_join(rejected, chosen, ["chosen_id"], ["rejected_id"], "inner").select("chosen_id", "rejected_id", "chosen", "rejected")


def replaced_answer(convs: DataFrame) -> DataFrame:
    """Every conversation with an answer, up to its last one, against itself with its first answer there; one with a
    single answer against itself with an empty answer."""
    places = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == ANSWER, i + 1)), lambda i: i.isNotNull())
    placed = convs.select("conv_id", "turns", places.alias("places")).where("size(places) > 0")
    last = F.element_at("places", -1)
    empty = F.array(F.struct(F.lit(ANSWER).alias("role"), F.lit("").alias("text")))
    other = F.when(F.size("places") > 1, F.slice("turns", F.element_at("places", 1), 1)).otherwise(empty)
    return placed.select(
        F.col("conv_id").alias("chosen_id"),
        F.col("conv_id").alias("rejected_id"),
        F.slice("turns", 1, last).alias("chosen"),
        F.concat(F.slice("turns", 1, last - 1), other).alias("rejected"),
    )


def mask_text(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda r: F.concat_ws("-", r["start"].cast("string"), r["stop"].cast("string"))), ",")


def preferences(turns: DataFrame) -> DataFrame:
    """The formatted pairs of a table of turns: conversations with the same opening, and replaced answers."""
    convs = conversations(turns)
    return format_pairs(same_opening(convs).union(replaced_answer(convs)))


def oracle() -> str:
    """The query over ``conversations`` in DuckDB SQL."""
    text = f"'{OPEN}' || t.role || chr(10) || t.text || '{CLOSE}' || chr(10)"
    size = f"({len(OPEN) + len(CLOSE) + 2} + length(t.role) + length(t.text))"

    def render(part: str) -> str:
        return f"array_to_string(list_transform({part}, lambda t: {text}), '')"

    def mask(part: str) -> str:
        at = f"coalesce(list_sum(list_transform({part}[:i - 1], lambda t: {size})), 0)"
        one = f"CASE WHEN u.role = '{ANSWER}' THEN CAST(CAST({at} + {len(OPEN) + 1} + length(u.role) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST({at} + {len(OPEN) + 1 + len(CLOSE)} + length(u.role) + length(u.text) AS BIGINT) AS VARCHAR) END"
        return f"coalesce(array_to_string(list_filter(list_transform({part}, lambda u, i: {one}), lambda x: x IS NOT NULL), ','), '')"

    return f"""
WITH convs AS (
  SELECT conv_id, list({{'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
opened AS (
  SELECT conv_id, turns, turns[1] AS opening, coalesce(list_sum(list_transform(list_filter(turns, lambda t: t.role = '{ANSWER}'), lambda t: length(t.text))), 0) AS weight
  FROM convs),
ranked AS (SELECT *, first_value(conv_id) OVER (PARTITION BY opening ORDER BY weight DESC, conv_id) AS chosen_id FROM opened),
placed AS (
  SELECT conv_id, turns, list_filter(list_transform(turns, lambda t, i: CASE WHEN t.role = '{ANSWER}' THEN i END), lambda i: i IS NOT NULL) AS places FROM convs),
pairs AS (
  SELECT r.chosen_id, r.conv_id AS rejected_id, c.turns AS a, r.turns AS b FROM ranked r JOIN convs c ON r.chosen_id = c.conv_id WHERE r.conv_id <> r.chosen_id
  UNION ALL
  SELECT conv_id, conv_id, turns[:places[-1]], list_concat(turns[:places[-1] - 1], CASE WHEN len(places) > 1 THEN [turns[places[1]]] ELSE [{{'role': '{ANSWER}', 'text': ''}}] END) FROM placed WHERE len(places) > 0),
counted AS (
  SELECT *, coalesce(list_min(list_filter(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: CASE WHEN a[i] <> b[i] THEN i END), lambda i: i IS NOT NULL)) - 1, least(len(a), len(b))) AS n FROM pairs),
cut AS (SELECT chosen_id, rejected_id, CAST(n AS INTEGER) AS n_common, a[:n] AS p, a[n + 1:] AS x, b[n + 1:] AS y FROM counted)
SELECT chosen_id, rejected_id, n_common, coalesce({render('p')}, '') AS prompt, coalesce({render('x')}, '') AS chosen_text, coalesce({render('y')}, '') AS rejected_text,
       {mask('x')} AS chosen_mask, {mask('y')} AS rejected_mask
FROM cut"""
