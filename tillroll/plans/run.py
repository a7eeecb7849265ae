"""The whole job: orders in, enriched orders, KPIs and summary out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.enrich import MARGIN, PLATFORM_LABEL, enrich_sales
from tillroll.operators.extras import period_columns
from tillroll.operators.kpis import KPIS, ROLLUP_KPIS, sales_rollup
from tillroll.operators.quality import clean_sales
from tillroll.plans.report import ingest_report, summary_report
from tillroll.sinks.tables import write_enriched, write_kpis, write_summary
from tillroll.sinks.versions import current, publish
from tillroll.sources.orders import read_orders_parquet


@dataclass(frozen=True)
class Results:
    """Frames over what the job stored; they stay usable after it."""

    enriched: DataFrame
    kpis: dict[str, DataFrame]
    summary: DataFrame
    ingest: DataFrame


# What the KPIs are made of.
REQUIRED = (
    "order_id",
    "amount",
    "qty",
    "status",
    "ship_state",
    "category",
    "style",
    "asin",
    "fulfilled_by",
    "b2b",
    "promotion_ids",
)
PERIOD = ("year", "month", "month_name")


def with_period(orders: DataFrame, date: str = "order_date") -> DataFrame:
    """`orders` with year, month and month name, made of `date` where one is missing."""
    missing = [c for c in PERIOD if c not in orders.columns]
    if not missing or date not in orders.columns:
        return orders
    derived = period_columns(orders.drop(*PERIOD), date)
    return derived.select(*[c for c in orders.columns if c not in PERIOD], *PERIOD)


def checked(orders: DataFrame) -> DataFrame:
    """`orders`, if it has what the job needs."""
    missing = [c for c in (*REQUIRED, *PERIOD) if c not in orders.columns]
    if missing:
        raise ValueError(f"the orders lack {', '.join(missing)}")
    return orders


def kpi_frames(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The KPIs that a job has stored below `output`."""
    return {name: read_orders_parquet(spark, f"{output}/kpis/{name}") for name in KPIS}


def run(
    orders: DataFrame,
    output: str,
    key: str = "order_id",
    order_by: Sequence[str] = (),
    margin: float = MARGIN,
    platform_label: str = PLATFORM_LABEL,
    date: str = "order_date",
) -> Results:
    """Clean and enrich `orders` into `output`, then compute the KPIs from there.

    Orders without year and month get them from `date`. A missing column is an
    error before anything is written. `orders` is read once. The enriched rows
    keep how many input rows each one stands for, so the input size needs neither
    a second read nor counters that a retried task would advance twice. Nine
    KPIs and both reports come from the rollup, one scan of the stored rows,
    which is stored beside them; products read the few columns they need.
    """
    spark = orders.sparkSession
    whole = checked(with_period(orders, date))
    clean = clean_sales(whole, key, order_by, copies="source_rows")
    enriched_path = f"{output}/enriched_sales_data"
    write_enriched(enrich_sales(clean, margin, platform_label), enriched_path)
    enriched = read_orders_parquet(spark, enriched_path)

    rollup_path = f"{output}/sales_rollup"
    sales_rollup(enriched).write.mode("overwrite").parquet(rollup_path)
    rollup = spark.read.parquet(rollup_path)
    kpis = {n: kpi(rollup if n in ROLLUP_KPIS else enriched) for n, kpi in KPIS.items()}
    write_kpis(kpis, output)
    summary_path = write_summary(summary_report(rollup), output)
    return Results(
        enriched=enriched,
        kpis=kpi_frames(spark, output),
        summary=read_orders_parquet(spark, summary_path),
        ingest=ingest_report(rollup),
    )


def publish_run(orders: DataFrame, output: str, **options) -> Results:
    """`run` into a new version below `output`, which readers get as a whole when it is done."""
    return publish(orders.sparkSession, output, lambda folder: run(orders, folder, **options))


def published_kpis(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The KPIs of the current version below `output`."""
    folder = current(spark, output)
    if folder is None:
        raise FileNotFoundError(f"nothing has been published in {output}")
    return kpi_frames(spark, folder)
