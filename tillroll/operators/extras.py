"""Further order analytics: calendar columns, buyers, shipping, quantiles, ranks, growth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import percent, two_places
from tillroll.operators.kpis import MEASURES, TOP_K, kpi_groups, valid_sales, with_facts
from tillroll.staging import new_folder


def period_columns(df: DataFrame, date: str = "order_date") -> DataFrame:
    """Year, month and short month name, for input that has only a date."""
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "month_name": F.date_format(date, "MMM"),
        }
    )


def distinct_buyers_by_month(df: DataFrame) -> DataFrame:
    return (
        valid_sales(df)
        .groupBy("year", "month")
        .agg(F.count_distinct("customer_id").alias("buyers"))
        .orderBy("year", "month")
    )


def ship_lag(df: DataFrame) -> DataFrame:
    """Days from order to shipping, by order month."""
    lag = F.datediff("ship_date", "order_date")
    return (
        valid_sales(df)
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("orders"),
            two_places(F.avg(lag)).alias("avg_ship_days"),
        )
        .orderBy("year", "month")
    )


# Sketches are kept by these, and merged for anything coarser.
SKETCH_KEYS = ("year", "month", "category")
# Size of the quantile sketches, and the part of all orders by which their ranks may be off.
VALUE_K = 16_384
RANK_ERROR = 2.296 / VALUE_K**0.9723
# Two to this power are the registers of the buyer sketches, and their relative standard error.
BUYER_BITS = 16
BUYER_ERROR = 1.04 / 2 ** (BUYER_BITS / 2)


def sketch_rollup(df: DataFrame, keys: Sequence[str] = SKETCH_KEYS) -> DataFrame:
    """Valid sales by `keys`: their number, a sketch of order values and, if known, of buyers.

    Quantiles and distinct buyers cannot be added up, their sketches can. The
    table is meant to be stored; any coarser group comes from its few rows.
    """
    sums = [
        F.count("*").alias("orders"),
        F.kll_sketch_agg_double("amount", F.lit(VALUE_K)).alias("value_sketch"),
    ]
    if "customer_id" in df.columns:
        sums.append(F.hll_sketch_agg("customer_id", BUYER_BITS).alias("buyer_sketch"))
    return valid_sales(df).groupBy(*keys).agg(*sums)


def sketched_quantiles(
    sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., share, amount): order-value quantiles of `by` from a stored `sketch_rollup`."""
    asked = F.array(*[F.lit(float(s)) for s in dict.fromkeys(shares)])
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("value_sketch").alias("_merged"))
    amounts = F.kll_sketch_get_quantile_double("_merged", asked)
    pairs = F.arrays_zip(asked.alias("share"), amounts.alias("amount"))
    return merged.select(*by, F.inline(pairs)).toDF(*by, "share", "amount")


def sketched_buyers(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., estimate): distinct buyers of `by` from a stored `sketch_rollup`."""
    union = F.hll_sketch_estimate(F.hll_union_agg("buyer_sketch"))
    return sketches.groupBy(*by).agg(union.alias("estimate"))


def held_to_ranks(df: DataFrame, quantiles: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """`quantiles` (share, amount) with `within_bound`: whether exact ranks bear each out.

    An amount has the ranks from the orders below it, plus one, to those up to
    it. One of them must be within `error` of all orders from the share's own.
    One scan counts below each of the few amounts.
    """
    asked = quantiles.collect()
    amount = F.col("amount")
    counts = [F.count("*").alias("orders")]
    for i, q in enumerate(asked):
        counts += [
            F.count_if(amount < q.amount).alias(f"below_{i}"),
            F.count_if(amount <= q.amount).alias(f"upto_{i}"),
        ]
    slack = F.col("orders") * error + 1
    rows = [
        F.struct(
            F.lit(float(q.share)).alias("share"),
            F.lit(q.amount).cast("double").alias("amount"),
            (
                (F.col(f"below_{i}") + 1 <= F.col("orders") * q.share + slack)
                & (F.col(f"upto_{i}") >= F.col("orders") * q.share - slack)
            ).alias("within_bound"),
        )
        for i, q in enumerate(asked)
    ]
    return valid_sales(df).agg(*counts).select(F.inline(F.array(*rows)))


def approximate_aov_percentiles(df: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Order-value quantiles merged from stored sketches by month and category, with the check."""
    path = new_folder(df.sparkSession, "sketches")
    sketch_rollup(df).write.parquet(path)
    sketches = df.sparkSession.read.parquet(path)
    return held_to_ranks(df, sketched_quantiles(sketches, shares))


def buyers_by_period(df: DataFrame) -> DataFrame:
    """Distinct buyers by month, by year (month null) and in all, exactly and from sketches.

    The sketches of months and categories are stored once and merged for each
    level; `error_pct` is how far the estimate is off.
    """
    path = new_folder(df.sparkSession, "sketches")
    sketch_rollup(df).write.parquet(path)
    sketches = df.sparkSession.read.parquet(path)
    # By the columns that are rolled up, as `grouping_id` numbers them.
    levels = [(("year", "month"), 0), (("year",), 1), ((), 3)]
    estimates = [
        sketched_buyers(sketches, by).withColumn("_of", F.lit(level)) for by, level in levels
    ]
    named = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), estimates)
    named = named.withColumnsRenamed({"year": "_year", "month": "_month"})
    exact = (
        valid_sales(df)
        .rollup("year", "month")
        .agg(F.count_distinct("customer_id").alias("buyers"), F.grouping_id().alias("_level"))
    )
    same = (
        (F.col("_level") == F.col("_of"))
        & F.col("year").eqNullSafe(F.col("_year"))
        & F.col("month").eqNullSafe(F.col("_month"))
    )
    off = F.abs(F.col("estimate") - F.col("buyers"))
    return exact.join(named, same).select(
        "year", "month", "buyers", "estimate", percent(off, F.col("buyers")).alias("error_pct")
    )


def aov_percentiles(df: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Exact order-value quantiles: the smallest amount that `share` of the orders reach.

    Orders are counted per amount, and the counts stored in ranges of amounts.
    The totals of the ranges tell in which one each quantile lies; there the
    running count finds it. Amounts stay doubles of any size. Spark's own exact
    percentiles hold all distinct values in one buffer.
    """
    spark = df.sparkSession
    counts = valid_sales(df).groupBy("amount").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("amount").withColumn("part", F.spark_partition_id())
    path = new_folder(spark, "amounts")
    ranged.write.parquet(path)
    stored = spark.read.parquet(path)

    # One row per range.
    totals = stored.groupBy("part").agg(F.sum("n").alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in dict.fromkeys(shares)]))
    place = F.greatest(F.ceil(F.col("share") * F.col("orders")), F.lit(1).cast("bigint"))
    parts = (
        totals.withColumn("reached", F.sum("n").over(Window.orderBy("part")))
        .withColumn("orders", F.sum("n").over(Window.partitionBy()))
        .withColumn("share", wanted)
        .withColumn("place", place)
    )
    # One row per quantile asked for, hence the broadcast.
    found = F.broadcast(_reached(parts, "part"))
    inside = stored.join(found, "part")
    upward = Window.partitionBy("share").orderBy("amount")
    return _reached(inside.withColumn("reached", F.sum("n").over(upward)), "amount").select(
        "share", "amount"
    )


def _reached(counts: DataFrame, at: str) -> DataFrame:
    """Where the running count gets to each `place`, which becomes the place in there."""
    below = F.col("reached") - F.col("n")
    return counts.filter((below < F.col("place")) & (F.col("place") <= F.col("reached"))).select(
        "share", (F.col("place") - below).alias("place"), at
    )


def top_products_per_category(df: DataFrame, k: int = TOP_K) -> DataFrame:
    """The `k` best products of each category by revenue; the product settles ties."""
    best = Window.partitionBy("category").orderBy(F.desc("total_revenue"), "asin", "style")
    return (
        kpi_groups(df, "top_products")
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .select("category", "place", "asin", "style", "total_revenue")
    )


def revenue_mom_growth(df: DataFrame) -> DataFrame:
    """Revenue against the month before that had any; the window spans months, not orders.

    A month is a year and a number, however its name is spelt.
    """
    before = F.lag("total_revenue").over(Window.orderBy("year", "month"))
    sales = with_facts(valid_sales(df))
    revenue = MEASURES["total_revenue"](sales).alias("total_revenue")
    change = F.col("total_revenue") - F.col("previous_revenue")
    return (
        sales.groupBy("year", "month")
        .agg(revenue)
        .withColumn("previous_revenue", before)
        .withColumn("growth_pct", percent(change, F.col("previous_revenue")))
    )
