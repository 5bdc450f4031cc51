"""Enrichment of the raw feed: ids, time, amounts, card, merchant and transaction attributes.

Every attribute is one column expression over (key, salt) draws, so the whole job is one projection
over the scan. Only the two amount cut points need a pass of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draws, scalars
from . import lookups
from .order import exact_quantiles
from .projection import finalize

# Distributions and attribute lists of the enrichment.
NETWORKS = {
    "low": {"Visa": 0.30, "Mastercard": 0.30, "RuPay": 0.40, "Amex": 0.00},
    "mid": {"Visa": 0.45, "Mastercard": 0.45, "RuPay": 0.10, "Amex": 0.00},
    "high": {"Visa": 0.45, "Mastercard": 0.45, "RuPay": 0.02, "Amex": 0.08},
}
CATEGORIES = {
    "low": {
        "Grocery": 0.20, "Fast Food": 0.20, "Public Transport": 0.20, "Fuel": 0.15,
        "Digital Services": 0.15, "Pharmacy": 0.05, "Entertainment": 0.05,
    },
    "mid": {
        "Dining": 0.25, "Fashion": 0.20, "Supermarket": 0.15, "Pharmacy": 0.10, "Utility": 0.10,
        "Fuel": 0.05, "Entertainment": 0.05, "Auto": 0.05, "Personal Care": 0.05,
    },
    "high": {
        "Airline": 0.30, "Hotel": 0.20, "Electronics": 0.20, "Jewelry": 0.10, "Furniture": 0.10, "Hospital": 0.10,
    },
}
TIERS_AMEX = {"Gold": 0.3, "Platinum": 0.4, "Signature": 0.3}
TIERS = {
    "low": {"Classic": 0.6, "Gold": 0.3, "Platinum": 0.08, "Signature": 0.02},
    "mid": {"Classic": 0.3, "Gold": 0.4, "Platinum": 0.2, "Signature": 0.1},
    "high": {"Classic": 0.1, "Gold": 0.2, "Platinum": 0.4, "Signature": 0.3},
}
ISSUERS = {
    "HDFC Bank": 0.27, "SBI Card": 0.19, "ICICI Bank": 0.17, "Axis Bank": 0.14, "Kotak Mahindra": 0.05,
    "IndusInd Bank": 0.04, "RBL Bank": 0.04, "IDFC First": 0.04, "Yes Bank": 0.03, "Standard Chartered": 0.03,
}
LIMITS = {
    "Classic": (25_000, 100_000), "Gold": (100_000, 300_000),
    "Platinum": (300_000, 750_000), "Signature": (750_000, 1_500_000),
}
CITY_GROUPS = [
    (0.075, ["Mumbai", "Delhi", "Bengaluru", "Chennai", "Hyderabad", "Kolkata", "Pune", "Ahmedabad"]),
    (0.030, ["Jaipur", "Lucknow", "Chandigarh", "Indore", "Kochi", "Surat", "Nagpur", "Coimbatore", "Bhopal", "Patna"]),
    (0.010, ["Varanasi", "Agra", "Nashik", "Vadodara", "Ludhiana", "Madurai", "Vizag", "Guwahati", "Bhubaneswar", "Raipur"]),
]
ONLINE_CATEGORIES = ["Digital Services", "Airline", "Entertainment", "Public Transport", "Hotel"]
ONLINE_SHARE = {
    "Dining": 0.3, "Grocery": 0.3, "Supermarket": 0.3, "Fashion": 0.5, "Electronics": 0.5,
    "Furniture": 0.5, "Jewelry": 0.5, "Utility": 0.6, "Pharmacy": 0.6,
}
POS_SMALL = {"Tap": 0.585, "Chip": 0.4, "Swipe": 0.015}
POS_LARGE = {"Chip": 0.985, "Swipe": 0.015}
POS_FRAUD = {"Swipe": 0.5, "Tap": 0.4, "Chip": 0.1}
POS_CUT = 5000
RECURRING_DIGITAL = {1: 0.8, 0: 0.2}
INTERNATIONAL = {0: {0: 0.98, 1: 0.02}, 1: {0: 0.75, 1: 0.25}}
USER_EXPONENT, MERCHANT_EXPONENT = 1.5, 1.3


def city_weights() -> dict[str, float]:
    return {city: weight for weight, cities in CITY_GROUPS for city in cities}


@dataclass(frozen=True)
class EnrichmentSettings:
    seed: int = 42
    exchange_rate: float = 88.0
    n_users: int = 10_000
    n_merchants: int = 5_000
    start_date: str = "2023-09-02"
    networks: dict = field(default_factory=lambda: NETWORKS)
    categories: dict = field(default_factory=lambda: CATEGORIES)


def _with_draws(df: DataFrame, key: str, settings: EnrichmentSettings, *salts: str) -> DataFrame:
    """One column ``__u_<salt>`` per draw, so that an expression which looks at a draw in many
    branches hashes once."""
    return df.withColumns({f"__u_{s}": draws.uniform(key, f"{s}:{settings.seed}") for s in salts})


def _without_draws(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__u_")])


def add_ids(df: DataFrame, key: str, settings: EnrichmentSettings = EnrichmentSettings()) -> DataFrame:
    """Opaque transaction id; user and merchant ids with a power-law frequency."""
    u = lambda salt: draws.uniform(key, f"{salt}:{settings.seed}")
    salted = F.concat(F.col(key).cast("string"), F.lit(f"id:{settings.seed}"))
    df = df.withColumn("transaction_id", scalars.opaque_id("txn", salted))
    df = draws.with_power_law(df, "__user", u("user"), USER_EXPONENT, settings.n_users)
    df = draws.with_power_law(df, "__merchant", u("merchant"), MERCHANT_EXPONENT, settings.n_merchants)
    return df.withColumns(
        {
            "user_id": scalars.padded_id("user", "__user"),
            "merchant_id": scalars.padded_id("merchant", "__merchant"),
        }
    ).drop("__user", "__merchant")


def add_temporal(df: DataFrame, settings: EnrichmentSettings = EnrichmentSettings()) -> DataFrame:
    return df.withColumns(
        {
            "timestamp": scalars.timestamp_from_offset(settings.start_date, "Time"),
            "amount_inr": scalars.convert_currency("Amount", settings.exchange_rate),
        }
    )


def add_segments(df: DataFrame, **search) -> tuple[DataFrame, float, float]:
    """Amount segment by the 0.25 and 0.90 quantiles, and the two cut points."""
    low, high = exact_quantiles(df, {"amount_inr": [0.25, 0.90]}, **search)["amount_inr"]
    return df.withColumn("amount_segment", scalars.amount_segment("amount_inr", low, high)), low, high


def add_card(df: DataFrame, key: str, settings: EnrichmentSettings = EnrichmentSettings()) -> DataFrame:
    """Network, tier, issuer, age and limit. The limit is raised when the amount exceeds it."""
    u = lambda salt: F.col(f"__u_{salt}")
    segment = F.col("amount_segment")
    df = _with_draws(df, key, settings, "network", "tier", "issuer", "age", "limit")
    df = df.withColumn("card_network", draws.weighted_by(segment, u("network"), settings.networks, "Unknown"))
    amex = F.col("card_network") == "Amex"
    df = df.withColumns(
        {
            "card_tier": F.when(amex, draws.weighted(u("tier"), TIERS_AMEX)).otherwise(
                draws.weighted_by(segment, u("tier"), TIERS, "Classic")
            ),
            "card_issuer": F.when(amex, F.lit("American Express")).otherwise(draws.weighted(u("issuer"), ISSUERS)),
            "card_age": draws.uniform_int(u("age"), 1, 61),
        }
    )
    limit = F.lit(50_000)
    for tier, (low, high) in LIMITS.items():
        drawn = scalars.floor_to(draws.uniform_int(u("limit"), low, high), 1000).cast("int")
        limit = F.when(F.col("card_tier") == tier, drawn).otherwise(limit)
    raised = scalars.truncated_product("amount_inr", 1.2)
    df = df.withColumn("credit_limit", limit)
    over = F.col("amount_inr") > F.col("credit_limit")
    return _without_draws(df.withColumn("credit_limit", F.when(over, raised).otherwise(F.col("credit_limit"))))


def add_merchant(df: DataFrame, key: str, settings: EnrichmentSettings = EnrichmentSettings()) -> DataFrame:
    """Category by segment, city by weight, state by lookup."""
    u = lambda salt: F.col(f"__u_{salt}")
    df = _with_draws(df, key, settings, "category", "city").withColumns(
        {
            "merchant_category": draws.weighted_by(F.col("amount_segment"), u("category"), settings.categories, "Unknown"),
            "merchant_city": draws.weighted(u("city"), city_weights()),
        }
    )
    return lookups.with_state(_without_draws(df))


def add_transaction(df: DataFrame, key: str, settings: EnrichmentSettings = EnrichmentSettings()) -> DataFrame:
    """Channel by category, entry mode by class, channel and amount, and the two flags."""
    u = lambda salt: F.col(f"__u_{salt}")
    df = _with_draws(df, key, settings, "channel", "entry", "recurring", "international")
    category, target = F.col("merchant_category"), F.col("Class")
    mixed = {c: {"Online": p, "POS": 1 - p} for c, p in ONLINE_SHARE.items()}
    df = df.withColumn(
        "transaction_channel",
        F.when(category.isin(*ONLINE_CATEGORIES), F.lit("Online")).otherwise(
            draws.weighted_by(category, u("channel"), mixed, "POS")
        ),
    )
    large = F.col("amount_inr") > POS_CUT
    entry = (
        F.when(F.col("transaction_channel") == "Online", F.lit("CVC"))
        .when(target == 1, draws.weighted(u("entry"), POS_FRAUD))
        .when((target == 0) & large, draws.weighted(u("entry"), POS_LARGE))
        .when((target == 0) & ~large, draws.weighted(u("entry"), POS_SMALL))
        .otherwise("Unknown")
    )
    recurring = (
        F.when(category == "Utility", 1)
        .when(category == "Digital Services", draws.weighted(u("recurring"), RECURRING_DIGITAL))
        .otherwise(0)
    )
    abroad = F.lit(0)
    for value, weights in INTERNATIONAL.items():
        abroad = F.when(target == value, draws.weighted(u("international"), weights)).otherwise(abroad)
    df = df.withColumns(
        {
            "entry_mode": entry,
            "is_recurring": recurring,
            "is_international": F.when(F.col("card_network") == "RuPay", 0).otherwise(abroad),
        }
    )
    return _without_draws(df)


def enrich(raw: DataFrame, key: str, settings: EnrichmentSettings = EnrichmentSettings(), **search) -> DataFrame:
    """Raw 31 columns (plus a unique ``key``, dropped at the end) -> enriched 46 columns."""
    df = add_temporal(add_ids(raw, key, settings), settings)
    df, _, _ = add_segments(df, **search)
    df = add_transaction(add_merchant(add_card(df, key, settings), key, settings), key, settings)
    return finalize(df.drop(key))
