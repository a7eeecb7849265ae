"""Reports over enriched orders or their rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import two_places


def summary_report(df: DataFrame) -> DataFrame:
    """(metric, value) rows over enriched orders or a rollup of them, all values double.

    The cancellation rate is the share of orders that are not valid sales, so
    orders without an amount count as cancelled too. Without orders it is null.
    """
    rows = F.col("fact_rows") if "fact_rows" in df.columns else F.lit(1)
    orders = F.coalesce(F.sum(rows), F.lit(0)).cast("double")
    valid = F.coalesce(F.sum(F.when(F.col("is_valid_sale"), rows)), F.lit(0)).cast("double")
    metrics = df.agg(
        orders.alias("Total_Orders"),
        valid.alias("Valid_Sales"),
        two_places((1 - F.try_divide(valid, orders)) * 100).alias("Cancellation_Rate_Pct"),
    )
    return metrics.unpivot([], metrics.columns, "metric", "value")


def ingest_report(rollup: DataFrame) -> DataFrame:
    """One row: input rows, orders kept and duplicates removed, from the stored rollup."""
    return rollup.agg(
        F.coalesce(F.sum("source_rows"), F.lit(0).cast("bigint")).alias("row_count"),
        F.coalesce(F.sum("fact_rows"), F.lit(0).cast("bigint")).alias("order_rows"),
    ).withColumn("duplicates_removed", F.col("row_count") - F.col("order_rows"))
