"""Profiling, duplicates, defaults and the valid-sale flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.bitmaps import may_be_among
from tillroll.functions.money import normalise_numeric, percent
from tillroll.schema import CANCELLED, FILL_DEFAULTS, NUMERIC_TEXT


def ingest_profile(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns came in."""
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column, null cells and blank text cells, which are empty or of spaces alone.

    `blank_pct` counts blank cells alone, `missing_pct` null and blank ones.
    One aggregate over one scan, whatever the number of columns.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    counts = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        cell = F.col(f"`{name}`")
        blanks = F.count_if(F.trim(cell) == "") if name in text else F.lit(0).cast("bigint")
        counts += [F.count_if(cell.isNull()).alias(f"nulls_{i}"), blanks.alias(f"blanks_{i}")]

    def of_rows(part):
        return F.coalesce(percent(part, F.col("rows")), F.lit(0.0))

    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"blanks_{i}").alias("blank_count"),
            of_rows(F.col(f"blanks_{i}")).alias("blank_pct"),
            of_rows(F.col(f"nulls_{i}") + F.col(f"blanks_{i}")).alias("missing_pct"),
        )
        for i, name in enumerate(df.columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def dedup_orders(
    df: DataFrame,
    key: str = "order_id",
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """Keep one row per `key`: the smallest by `order_by`, ties by all other columns.

    Rows that tie on everything are equal, so the survivor depends on neither
    partitioning nor arrival. Either way one row per key and task is kept before
    the shuffle: a key that holds a large part of the input costs no more than
    others. Rows without a key count as one order. `copies` names a column for
    the number of rows that each survivor stands for; that takes an aggregate of
    whole rows, where a rank over a window moves wide rows faster.
    """
    others = [c for c in df.columns if c != key]
    ranking = [*order_by, *(c for c in others if c not in order_by)]
    columns = [F.col(f"`{c}`") for c in ranking]
    if copies is None:
        first = Window.partitionBy(f"`{key}`").orderBy(*(columns or [F.lit(0)]))
        return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")
    smallest = F.min(F.struct(*columns)).alias("_row")
    kept = [F.col(f"`{c}`") if c == key else F.col(f"_row.`{c}`") for c in df.columns]
    counted = df.groupBy(f"`{key}`").agg(smallest, F.count("*").alias(copies))
    return counted.select(*kept, copies)


def dedup_report(df: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: rows in, orders kept and duplicates removed by `dedup_orders`."""
    keyless = F.max(F.col(key).isNull().cast("int"))
    return df.agg(
        F.count("*").alias("row_count"),
        (F.count_distinct(key) + F.coalesce(keyless, F.lit(0))).alias("order_rows"),
    ).withColumn("duplicates_removed", F.col("row_count") - F.col("order_rows"))


def unknown_orders(new: DataFrame, stored: DataFrame, key: str = "order_id") -> DataFrame:
    """The rows of `new` whose `key` no row of `stored` has.

    Only the new rows are moved, to where the stored table has its buckets. Of
    the stored keys those alone are compared that a bitmap of the new ones lets
    through. Rows without a key are one order: unknown if none is stored.
    """
    named = new.filter(F.col(key).isNotNull())
    known = may_be_among(stored.select(key), named.select(key), key)
    without = stored.filter(F.col(key).isNull()).select(F.lit(True).alias("_none")).limit(1)
    missing = F.col(key).isNull()
    keyless = new.filter(missing).join(
        F.broadcast(without), missing == F.col("_none"), "left_anti"
    )
    return named.join(known, key, "left_anti").unionByName(keyless)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults for nulls (and NaN amounts) in the columns that `df` has."""
    return df.fillna({c: v for c, v in FILL_DEFAULTS.items() if c in df.columns})


def flag_valid(df: DataFrame) -> DataFrame:
    """A valid sale is not cancelled and has a positive amount; unknown is not valid."""
    valid = (F.col("status") != CANCELLED) & (F.col("amount") > 0)
    return df.withColumn("is_valid_sale", F.when(valid, True).otherwise(False))


def settle(df: DataFrame) -> DataFrame:
    """The row-by-row part of cleaning, for batches and streams alike.

    Defaults come before number cleaning, so text that turns out to be no
    number stays null and the sale is not valid.
    """
    filled = fill_defaults(df)
    return flag_valid(normalise_numeric(filled, NUMERIC_TEXT))


def clean_sales(
    df: DataFrame,
    key: str = "order_id",
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One settled row per order."""
    return settle(dedup_orders(df, key, order_by, copies))
