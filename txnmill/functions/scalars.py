"""Scalar column expressions. All stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NIGHT_HOURS = tuple(range(6))
WEEKEND_DAYS = (5, 6)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


# --- time -------------------------------------------------------------------

def hour_of(ts) -> Column:
    return F.hour(as_column(ts))


def day_of_week(ts) -> Column:
    """Monday = 0."""
    return F.weekday(as_column(ts))


def is_night(ts, hours: Iterable[int] = NIGHT_HOURS) -> Column:
    return flag(F.hour(as_column(ts)).isin(*hours))


def is_weekend(ts) -> Column:
    return flag(F.weekday(as_column(ts)).isin(*WEEKEND_DAYS))


def micros_of(ts) -> Column:
    """Microseconds since 1970 of a zone-free timestamp.

    In a UTC session a cast does it. Elsewhere the value is built from date and time fields, since
    a cast would fold the hour that a change of clocks repeats.
    """
    ts = as_column(ts)
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
        return F.unix_micros(ts.cast("timestamp"))
    seconds = F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def timestamp_literal(micros: int) -> Column:
    """The zone-free timestamp literal for a number of microseconds; usable in pushed filters."""
    days, rest = divmod(micros, 86_400_000_000)
    day = date(1970, 1, 1) + timedelta(days=days)
    seconds, part = divmod(rest, 1_000_000)
    clock = f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}.{part:06d}"
    return F.expr(f"timestamp_ntz'{day.isoformat()} {clock}'")


SECONDS_PER_UNIT = {"s": 1.0, "ms": 1e-3, "us": 1e-6, "ns": 1e-9}


def timestamp_from_offset(start: str, offset, unit: str = "s") -> Column:
    """``start`` (YYYY-MM-DD) plus the whole seconds of an elapsed-time column, cut off towards zero."""
    seconds = as_column(offset) * F.lit(SECONDS_PER_UNIT[unit])
    return F.expr(f"timestamp_ntz'{start} 00:00:00'") + F.make_dt_interval(secs=seconds.cast("long").cast("decimal(18,6)"))


def clock_hour(seconds) -> Column:
    """Hour of day of an elapsed-seconds clock."""
    return ((as_column(seconds) / 3600).cast("long") % 24).cast("int")


def clock_day(seconds) -> Column:
    """Day of week of an elapsed-seconds clock."""
    return ((as_column(seconds) / 86400).cast("long") % 7).cast("int")


# --- amounts ----------------------------------------------------------------

def log_amount(amount) -> Column:
    return F.log1p(as_column(amount))


def half_even(x, places: int) -> Column:
    """Scale, round half to even, scale back. ``round`` rounds half up and ``bround`` works on
    the decimal text, so neither equals this on binary ties."""
    scale = F.lit(10.0 ** places)
    return F.rint(as_column(x) * scale) / scale


def convert_currency(amount, rate: float, zero_becomes: float = 1.0) -> Column:
    converted = half_even(as_column(amount) * F.lit(float(rate)), 2)
    return F.when(converted == 0, F.lit(zero_becomes)).otherwise(converted)


def amount_segment(amount, low: float, high: float) -> Column:
    """low | mid | high with right-closed edges; null stays null."""
    amount = as_column(amount)
    return F.when(amount <= low, "low").when(amount <= high, "mid").when(amount > high, "high")


def amount_tier(amount, edges: list[float]) -> Column:
    """Number of the right-closed interval (edges[i-1], edges[i]]; null outside them all."""
    amount = as_column(amount)
    tier = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        tier = F.when((amount > edges[i - 1]) & (amount <= edges[i]), i).otherwise(tier)
    return tier


def clip(x, low, high) -> Column:
    x = as_column(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def floor_to(x, step: int) -> Column:
    return F.floor(as_column(x) / step) * step


def truncated_product(x, factor: float) -> Column:
    return (as_column(x) * F.lit(float(factor))).cast("int")


def linear(x, multiplier: float = 1.0, offset: float = 0.0) -> Column:
    return as_column(x) * F.lit(float(multiplier)) + F.lit(float(offset))


# --- interactions -----------------------------------------------------------

def intl_online(international="is_international", channel="transaction_channel") -> Column:
    return flag((as_column(international) == 1) & (as_column(channel) == "Online"))


def night_high_amount(night, log_amt, threshold) -> Column:
    return flag((as_column(night) == 1) & (as_column(log_amt) > threshold))


# --- ids --------------------------------------------------------------------

def padded_id(prefix: str, number, width: int = 5) -> Column:
    return F.format_string(f"{prefix}_%0{width}d", as_column(number).cast("long"))


def opaque_id(prefix: str, key, digits: int = 12) -> Column:
    """A fixed-length id that is the same on every retry, unlike a random one."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.md5(as_column(key).cast("string")), 1, digits))


# --- labels -----------------------------------------------------------------

def risk_level(probability) -> Column:
    p = as_column(probability)
    return F.when(p < 0.3, "low").when(p < 0.7, "medium").when(p.isNotNull(), "high")


def over_threshold(probability, threshold: float = 0.5) -> Column:
    return (as_column(probability) >= F.lit(threshold)).cast("int")


def rounded_probability(probability, places: int = 4) -> Column:
    return half_even(probability, places)


def significance(p_value, alpha: float = 0.05) -> Column:
    return F.when(as_column(p_value) < alpha, "significant").otherwise("not significant")


def strength(r) -> Column:
    r = F.abs(as_column(r))
    return F.when(r > 0.3, "strong").when(r > 0.1, "moderate").otherwise("weak")


def safe_ratio(a, b) -> Column:
    """a / b, or 0 when b is 0."""
    a, b = as_column(a), as_column(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
