"""Small hand-made order frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER_TYPES = {
    "order_id": "string",
    "status": "string",
    "amount": "double",
    "qty": "int",
    "fulfilled_by": "string",
    "b2b": "string",
    "promotion_ids": "string",
    "ship_city": "string",
    "ship_state": "string",
    "courier_status": "string",
    "category": "string",
    "style": "string",
    "asin": "string",
    "year": "int",
    "month": "int",
    "month_name": "string",
}
USUAL = {
    "order_id": "O1",
    "status": "Shipped",
    "amount": 100.0,
    "qty": 1,
    "fulfilled_by": "Platform",
    "b2b": "False",
    "promotion_ids": "PROMO-1",
    "ship_city": "CITY-1",
    "ship_state": "NORTH",
    "courier_status": "Shipped",
    "category": "Set",
    "style": "S1",
    "asin": "P1",
    "year": 2022,
    "month": 4,
    "month_name": "Apr",
}


def orders(spark: SparkSession, *changes: dict, types: dict | None = None) -> DataFrame:
    """One row per dict of changes to a usual order."""
    kinds = {**ORDER_TYPES, **(types or {})}
    rows = [tuple({**USUAL, **change}.get(c) for c in kinds) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in kinds.items()))


def values(df: DataFrame, *names: str) -> list[tuple]:
    return [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]


def text(spark: SparkSession, name: str, *cells: str | None) -> DataFrame:
    return spark.createDataFrame([(c,) for c in cells], f"`{name}` string")
