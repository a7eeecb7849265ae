"""Derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import normalise_numeric
from tillroll.operators.quality import flag_valid
from tillroll.schema import NO_PROMOTION

MARGIN = 0.3
PLATFORM_LABEL = "Platform"


def enrich_sales(
    df: DataFrame, margin: float = MARGIN, platform_label: str = PLATFORM_LABEL
) -> DataFrame:
    """Cost, profit, unit price and the three 0/1 flags, in one projection.

    `margin` is the share of the amount that is profit; `platform_label` is the
    value of `fulfilled_by` that stands for the marketplace itself. `b2b` may be
    text, where only ``True`` counts, or boolean. Columns whose inputs `df` lacks
    are left out, so a single KPI can do without the others' inputs.
    """
    amount, qty = F.col("amount"), F.col("qty")

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    rules = {
        "cost": ({"amount"}, amount * (1 - margin)),
        "profit": ({"amount"}, amount * margin),
        "profit_margin_pct": (set(), F.lit(round(margin * 100, 10))),
        "price_per_item": ({"amount", "qty"}, F.when(qty > 0, amount / qty).otherwise(amount)),
        "is_b2b": ({"b2b"}, flag(F.col("b2b") == "True")),
        "is_platform_fulfilled": ({"fulfilled_by"}, flag(F.col("fulfilled_by") == platform_label)),
        "has_promotion": ({"promotion_ids"}, flag(F.col("promotion_ids") != NO_PROMOTION)),
    }
    derived = df.withColumns(
        {name: rule for name, (needs, rule) in rules.items() if needs <= set(df.columns)}
    )
    return flag_valid(normalise_numeric(derived, ["profit", "cost", "price_per_item"]))
