
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracles import ORACLES
from tillroll.functions.money import normalise_numeric
from tillroll.operators import extras, kpis, quality
from tillroll.operators.enrich import enrich_sales
from tillroll.plans.report import summary_report
from tillroll.plans.run import published_kpis, run
from tillroll.schema import canonical, headed
from tillroll.sinks.tables import append_new_orders as store_orders
from tillroll.sinks.tables import register_external, save_managed, write_enriched, write_summary
from tillroll.sources.orders import read_orders_csv, read_orders_parquet
from tillroll.sources.star import (
    ORDER_COLUMNS,
    flatten,
    sales_lines,
    table,
    table_stream,
    unique_orders,
)
from tillroll.staging import new_folder
from tillroll.streaming import events, late
from tillroll.streaming import kpis as kpi_stream
from tillroll.streaming import orders as order_stream
from tillroll.streaming.session import (
    drain_table,
    drain_to_parquet,
    drain_unique,
    drain_upserts,
    read_unique,
    stream_session,
)

try:  # the package `llm` may be left out
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as run_pipeline
    from tillroll.llm.queries import QUERIES as LLM_QUERIES
    from tillroll.llm.sql import ORACLES as LLM_ORACLES
except ModuleNotFoundError as missing:
    # Anything else that cannot be imported is an error, not a reason to go without.
    if not (missing.name or "").startswith(("tillroll.llm", "corpus_pipeline")):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": run_pipeline}
    if PIPELINE_SQL:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": PIPELINE_SQL}

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
SHARES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)

# What every KPI needs to tell valid sales, and what each one adds.
_SALE = ("order_id", "status", "amount")
_KPI_COLUMNS = {
    "monthly_revenue": ("qty", "year", "month", "month_name"),
    "profit_margin": (),
    "region_sales": ("qty", "ship_state"),
    "top_states": ("qty", "ship_state"),
    "aov": (),
    "category_performance": ("qty", "category"),
    "fulfillment_performance": ("fulfilled_by",),
    "b2b_analysis": ("qty", "b2b"),
    "promotion_impact": ("promotion_ids",),
    "top_products": ("qty", "asin", "category", "style"),
    "top_products_10": ("qty", "asin", "category", "style"),
    "status_distribution": (),
    "distinct_buyers_by_month": ("year", "month", "customer_id"),
    "ship_lag": ("year", "month", "order_date", "ship_date"),
    "aov_percentiles": (),
    "approximate_aov_percentiles": ("year", "month", "category"),
    "buyers_by_period": ("year", "month", "category", "customer_id"),
    "top_products_per_category": ("qty", "asin", "category", "style"),
    "revenue_mom_growth": ("qty", "year", "month", "month_name"),
}


def _settled(spark: SparkSession, sf_dir: str, columns=ORDER_COLUMNS) -> DataFrame:
    return quality.settle(unique_orders(spark, sf_dir, columns))


def _enriched(spark: SparkSession, sf_dir: str, columns=ORDER_COLUMNS) -> DataFrame:
    return enrich_sales(_settled(spark, sf_dir, columns))


def _kpi(name: str, kpi: Callable[[DataFrame], DataFrame]) -> Query:
    columns = _SALE + _KPI_COLUMNS[name]
    return lambda spark, sf_dir: kpi(_enriched(spark, sf_dir, columns))


def ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingest_profile(sales_lines(spark, sf_dir))


def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_profile(sales_lines(spark, sf_dir))


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_report(sales_lines(spark, sf_dir, ["order_id"]))


def filled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fill_defaults(unique_orders(spark, sf_dir))


def normalise_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales_lines(spark, sf_dir, ["order_id", "asin", "amount_text"])
    return normalise_numeric(lines.withColumn("amount", F.col("amount_text")), ["amount"])


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning as a caller without a line order does it: survivors by all columns."""
    return quality.clean_sales(sales_lines(spark, sf_dir))


def valid_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.valid_sales(_settled(spark, sf_dir))


def period_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.period_columns(unique_orders(spark, sf_dir, ["order_id", "order_date"]))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "orders-csv")
    # Cells of spaces alone are to come back as they are.
    write = headed(sales_lines(spark, sf_dir)).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    write.csv(folder)
    return normalise_numeric(read_orders_csv(spark, folder), ["amount", "qty"])


def enriched_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "enriched")
    write_enriched(_enriched(spark, sf_dir), folder)
    return read_orders_parquet(spark, folder)


def kpi_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job; its stored KPIs as (kpi, grp, measure, value) rows."""
    return kpis.as_measures(run(sales_lines(spark, sf_dir), new_folder(spark, "job")).kpis)


def summary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "summary")
    return read_orders_parquet(
        spark, write_summary(summary_report(_enriched(spark, sf_dir, _SALE)), folder)
    )


def external_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "external")
    write_enriched(_enriched(spark, sf_dir), folder)
    register_external(spark, "enriched_external", folder)
    return canonical(spark.sql("SELECT * FROM enriched_external"))


def managed_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_folder(spark, "managed").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS retail LOCATION '{place}'")
    save_managed(_enriched(spark, sf_dir), "retail.enriched_sales")
    return canonical(spark.table("retail.enriched_sales"))


def append_new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders are stored in buckets, then all lines are delivered again."""
    place = new_folder(spark, "bucketed").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS retail LOCATION '{place}'")
    spark.sql("DROP TABLE IF EXISTS retail.stored_orders")
    lines = sales_lines(spark, sf_dir).filter("order_id IS NOT NULL")
    even = F.substring("order_id", -1, 1).isin("0", "2", "4", "6", "8")
    for delivered in (lines.filter(even), lines):
        store_orders(delivered, "retail.stored_orders", buckets=8)
    return spark.table("retail.stored_orders")


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k BIGINT").alias("data")
    return table(spark, sf_dir, "events").select("event_id", props).select("event_id", "data.*")


def _drained(spark: SparkSession, label: str, stream: DataFrame) -> DataFrame:
    folder = new_folder(spark, label)
    drain_to_parquet(stream, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows")


def stream_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named fields; the messages have no others and none is malformed."""
    inbox = new_folder(spark, "messages")
    # The same long field names in each message: a tenth of the size when compressed.
    order_stream.as_messages(sales_lines(spark, sf_dir)).write.text(inbox, compression="gzip")
    stream = order_stream.read_orders_stream(stream_session(spark), "text", {"path": inbox})
    known = _drained(spark, "orders-stream", stream)
    whole = known.filter("malformed IS NULL AND size(other_fields) = 0")
    return whole.drop("malformed", "other_fields")


def stream_ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = stream_session(spark)
    orders = flatten(session, sf_dir, table_stream(session, sf_dir, "lineitem"))
    return _drained(spark, "enriched-stream", order_stream.enrich_stream(orders))


def stream_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPIs, kept up to date by a stream of lines, as (kpi, grp, measure, value) rows."""
    session, folder = stream_session(spark), new_folder(spark, "order-stream")
    orders = flatten(session, sf_dir, table_stream(session, sf_dir, "lineitem"))
    places = (f"{folder}/{part}" for part in ("store", "results", "checkpoint"))
    kpi_stream.serve_kpis(orders, *places)
    return kpis.as_measures(published_kpis(spark, f"{folder}/results"))


def stream_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = events.read_purchases(stream_session(spark), sf_dir)
    folder = new_folder(spark, "daily-revenue")
    drain_table(events.daily_revenue(purchases), f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase is delivered twice and kept once."""
    session, folder = stream_session(spark), new_folder(spark, "purchases")
    twice = events.read_purchases(session, sf_dir).union(events.read_purchases(session, sf_dir))
    drain_unique(twice, f"{folder}/rows", f"{folder}/checkpoint", ["event_id"])
    kept = read_unique(spark, f"{folder}/rows", twice.schema)
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that the stream has closed, and those still open in what it has stored."""
    purchases = events.read_purchases(stream_session(spark), sf_dir)
    stored = _drained(spark, "session-purchases", purchases)
    closed = _drained(spark, "sessions", events.purchase_sessions(purchases))
    return events.with_open(stored, closed)


def stream_sliding_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = events.read_purchases(stream_session(spark), sf_dir)
    folder, windows = new_folder(spark, "sliding-revenue"), events.sliding_revenue(purchases)
    places = (f"{folder}/rows", f"{folder}/checkpoint")
    drain_upserts(windows, *places, key=["window_start"], day="day")
    return spark.read.parquet(places[0]).drop("day")


def stream_late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of purchases that arrive shuffled, of which many are behind the watermark.

    The events are delivered in four files, by the last digit of their id, and
    each is a micro-batch; a repair run joins the late ones to the sessions.
    """
    inbox, session = new_folder(spark, "shuffled-events"), stream_session(spark)
    for part in range(4):
        arrived = table(spark, sf_dir, "events").filter(F.col("event_id") % 10 % 4 == part)
        arrived.coalesce(1).write.mode("append").parquet(f"{inbox}/events.parquet")
    purchases = events.read_purchases(session, inbox, files_per_batch=1)
    folder = new_folder(spark, "split-purchases")
    late.drain_split(purchases, f"{folder}/rows", f"{folder}/checkpoint")
    punctual = late.on_time_stream(session, f"{folder}/rows", purchases.schema)
    closed = _drained(spark, "punctual-sessions", events.purchase_sessions(punctual))
    return late.repaired_sessions(spark, f"{folder}/rows", purchases.schema, closed)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue over the smallest data."""
    return queries()["monthly_revenue"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    kpi_queries = {
        **kpis.KPIS,
        "top_states": kpis.top_states,
        "top_products_10": kpis.top_products_10,
        "distinct_buyers_by_month": extras.distinct_buyers_by_month,
        "ship_lag": extras.ship_lag,
        "aov_percentiles": lambda df: extras.aov_percentiles(df, SHARES),
        "approximate_aov_percentiles": lambda df: extras.approximate_aov_percentiles(df, SHARES),
        "buyers_by_period": extras.buyers_by_period,
        "top_products_per_category": extras.top_products_per_category,
        "revenue_mom_growth": extras.revenue_mom_growth,
    }
    return {
        "ingest_profile": ingest_profile,
        "missing_profile": missing_profile,
        "dedup_orders": unique_orders,
        "dedup_report": dedup_report,
        "filled_sales": filled_sales,
        "normalise_amount": normalise_amount,
        "clean_sales": clean_sales,
        "valid_sales": valid_sales,
        "enriched_sales": _enriched,
        **{name: _kpi(name, kpi) for name, kpi in kpi_queries.items()},
        "summary_report": lambda spark, sf_dir: summary_report(_enriched(spark, sf_dir, _SALE)),
        "period_columns": period_columns,
        "csv_roundtrip": csv_roundtrip,
        "enriched_parquet_roundtrip": enriched_parquet_roundtrip,
        "kpi_parquet_roundtrip": kpi_parquet_roundtrip,
        "summary_roundtrip": summary_roundtrip,
        "external_table_query": external_table_query,
        "managed_table_roundtrip": managed_table_roundtrip,
        "append_new_orders": append_new_orders,
        "json_parse": json_parse,
        "stream_json_ingest": stream_json_ingest,
        "stream_ingest_parquet": stream_ingest_parquet,
        "stream_kpis": stream_kpis,
        "stream_daily_revenue": stream_daily_revenue,
        "stream_dedup": stream_dedup,
        "stream_sessions": stream_sessions,
        "stream_sliding_revenue": stream_sliding_revenue,
        "stream_late_sessions": stream_late_sessions,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **LLM_ORACLES}
