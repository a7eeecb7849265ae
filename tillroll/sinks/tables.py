"""Parquet folders and catalog tables.

Spark's writers create the folders on whatever filesystem the path names and
commit them as a whole, so nothing is prepared on the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.quality import dedup_orders, unknown_orders
from tillroll.schema import headed
from tillroll.staging import new_folder

PARTITIONS = ("Year", "Month")


def _by_month(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows gathered by month for the write, months of any size.

    `rebalance` lets the adaptive planner cut a large month into several files
    of the advised size and put small months together in one task.
    """
    named = headed(df)
    months = [c for c in PARTITIONS if c in named.columns]
    return (named.hint("rebalance", *months) if months else named), months


def write_enriched(df: DataFrame, path: str) -> None:
    """Whole enriched orders, one folder per month, so months can be pruned."""
    rows, months = _by_month(df)
    rows.write.mode("overwrite").partitionBy(*months).parquet(path)


def write_kpis(kpis: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Each KPI to ``{base}/kpis/{name}``; returns the paths.

    The writes do not depend on each other, so they are submitted together and
    share the cluster. The number of files is left to Spark: a KPI per product
    can be large.
    """
    paths = {name: f"{base}/kpis/{name}" for name in kpis}

    def write(name: str) -> None:
        headed(kpis[name]).write.mode("overwrite").parquet(paths[name])

    with ThreadPoolExecutor(max_workers=len(kpis)) as pool:
        for done in [pool.submit(write, name) for name in kpis]:
            done.result()
    return paths


def write_summary(summary: DataFrame, base: str) -> str:
    path = f"{base}/summary_report"
    headed(summary).write.mode("overwrite").parquet(path)
    return path


def save_managed(df: DataFrame, table: str) -> None:
    """Enriched orders as a table whose files the catalog owns."""
    rows, months = _by_month(df)
    rows.write.mode("overwrite").partitionBy(*months).format("parquet").saveAsTable(table)


def register_external(spark: SparkSession, table: str, path: str) -> None:
    """A table over enriched orders that stay where they were written; a former one gives way."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)


# A bucket of a table of stored orders should fit a task; their number is fixed with the table.
BUCKETS = 200


def save_bucketed(
    df: DataFrame, table: str, key: str = "order_id", buckets: int = BUCKETS, mode: str = "overwrite"
) -> None:
    """Orders as a table in buckets by `key`, sorted within, so that joins by it leave it in place."""
    rows = df.repartition(buckets, f"`{key}`")
    writer = rows.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    writer.format("parquet").saveAsTable(table)


def append_new_orders(
    df: DataFrame, table: str, key: str = "order_id", buckets: int = BUCKETS
) -> None:
    """Appends the orders of `df` that the bucketed `table` does not have, one row for each id.

    The new orders are stored once, as they are read for the bitmap and again;
    `table` is neither moved nor written anew.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        save_bucketed(dedup_orders(df, key), table, key, buckets)
        return
    path = new_folder(spark, "new-orders")
    dedup_orders(df, key).write.parquet(path)
    fresh = unknown_orders(spark.read.schema(df.schema).parquet(path), spark.table(table), key)
    save_bucketed(fresh, table, key, buckets, mode="append")
