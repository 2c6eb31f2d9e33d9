"""Ordered classification rules: the first that matches gives the label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern -> label, tried in this order on the lower-cased name.
METAL_RULES = [
    ("18k|750", "18K Gold - 750"),
    ("14k|585", "14K Gold - 585"),
    ("9k|375", "9K Gold - 375"),
    ("silver|925", "Silver - 925"),
    ("platinum|950", "Platinum - 950"),
]
STONE_RULES = [
    ("diamond", "Diamond"),
    ("sapphire", "White Sapphire"),
    ("topaz", "White Topaz"),
    ("zirconia", "Zirconia"),
    ("emerald", "Emerald"),
    ("ruby", "Ruby"),
]
UNCLASSIFIED = "Not Defined"

# Spellings of the payment flag.
PAYPAL_YES = ["true", "1", "yes"]
PAYPAL_NO = ["false", "0", "no"]
PAYMENT_LABELS = ["paypal", "other", "unknown"]

# Statuses with which a shop refuses a crawler.
BLOCKING_STATUSES = [403, 429, 503]


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """Label of the first rule whose pattern occurs in ``text``."""
    lowered = F.lower(text)
    return F.coalesce(
        *[F.when(lowered.rlike(pattern), F.lit(label)) for pattern, label in rules],
        F.lit(otherwise),
    )


def metal_type(product_name: Column) -> Column:
    return first_match(product_name, METAL_RULES, UNCLASSIFIED)


def stone_type(product_name: Column) -> Column:
    return first_match(product_name, STONE_RULES, UNCLASSIFIED)


def payment_label(flag: Column) -> Column:
    """``paypal``, ``other``, or ``unknown`` for a missing or odd flag."""
    spelled = F.lower(flag)
    return (
        F.when(spelled.isin(PAYPAL_YES), "paypal")
        .when(spelled.isin(PAYPAL_NO), "other")
        .otherwise("unknown")
    )


def crawl_outcome(status: Column, name: Column, exception: Column) -> Column:
    """Error text of one crawl attempt; NULL when it produced a name."""
    code = status.cast("string")
    return (
        F.when(exception.isNotNull(), F.concat(F.lit("request_error:"), exception))
        .when(status.isin(BLOCKING_STATUSES), F.concat(F.lit("blocked_"), code))
        .when(status >= 400, F.concat(F.lit("http_"), code))
        .when(name.isNull() | (name == ""), F.lit("no_name_found"))
    )
