"""The flat order table, joined from a TPC-H-like star schema.

One flat row per order line. All joins are left joins from the lines to unique
keys, so a join neither drops nor repeats lines: asking for fewer columns can
leave out whole tables, and removing duplicate orders can happen before the
joins, on the narrow lines. No join is hinted; Spark broadcasts a side when its
size is under the session's threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.quality import dedup_orders

# Which line of an order stays; lines that tie here are told apart by the rest.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def _line(number: int, tax: float) -> Column:
    return (F.col("l_linenumber") == number) & (F.col("l_tax") == tax)


def _unless(lost: str, column: str) -> Column:
    return F.when(F.col(column) != lost, F.col(column))


def _price_text() -> Column:
    """The price as money text in several spellings, some of them no number, by product."""
    kind, price = F.col("l_partkey") % 20, F.col("l_extendedprice").cast("decimal(18,2)")
    return (
        F.when(kind == 0, "abc")
        .when(kind == 1, "1-2")
        .when(kind == 2, "")
        .when(kind == 3, "   ")
        .when(kind == 4, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("e2")))
        .when(kind == 5, F.concat(F.lit("Rs "), F.format_number(price, 2)))
        .otherwise(F.concat(F.lit("INR "), price.cast("string")))
    )


def _columns() -> dict[str, tuple[str, Column, tuple[str, ...]]]:
    """Name -> (outermost table it needs, expression, columns of the lines it needs).

    The tables hold no gaps, so some cells are emptied, blanked, zeroed or
    garbled by rule, to give cleaning something to do.
    """
    city = F.col("c_nationkey") % 10
    percent_off = F.round(F.col("l_discount") * 100).cast("int")
    edge = ("l_linenumber", "l_tax")
    return {
        "order_id": (
            "lineitem",
            F.when(~_line(7, 0.06), F.concat(F.lit("O"), F.col("l_orderkey").cast("string"))),
            edge,
        ),
        "status": (
            "orders",
            F.when(F.col("o_orderstatus") == "P", "Cancelled")
            .when(F.col("l_returnflag") == "A", "Shipped - Delivered to Buyer")
            .when(F.col("l_returnflag") == "R", "Shipped"),
            ("l_returnflag",),
        ),
        "amount": (
            "lineitem",
            F.when(_line(7, 0.08), None)
            .when(_line(7, 0.07), 0.0)
            .otherwise(F.col("l_extendedprice")),
            (*edge, "l_extendedprice"),
        ),
        "qty": (
            "lineitem",
            F.when(_line(6, 0.08), 0)
            .when(_line(5, 0.08), None)
            .otherwise(F.col("l_quantity").cast("int")),
            (*edge, "l_quantity"),
        ),
        "fulfilled_by": (
            "lineitem",
            F.when(F.col("l_linestatus") == "F", "Platform").when(
                F.col("l_returnflag") != "N", "Merchant"
            ),
            ("l_linestatus", "l_returnflag"),
        ),
        "b2b": (
            "customer",
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "True").otherwise("False"),
            (),
        ),
        "promotion_ids": (
            "lineitem",
            F.when(percent_off == 2, " ").when(
                F.col("l_discount") > 0,
                F.concat(F.lit("PROMO-"), percent_off.cast("string")),
            ),
            ("l_discount",),
        ),
        "ship_city": (
            "customer",
            F.when(city == 3, "")
            .when(city == 7, "   ")
            .when(city != 0, F.concat(F.lit("CITY-"), city.cast("string"))),
            (),
        ),
        "ship_state": ("nation", _unless("NATION_0", "n_name"), ()),
        "courier_status": ("orders", _unless("4-NOT SPECIFIED", "o_orderpriority"), ()),
        "category": ("part", F.col("p_type"), ("l_partkey",)),
        "style": ("part", F.col("p_brand"), ("l_partkey",)),
        "asin": (
            "lineitem",
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
            ("l_partkey",),
        ),
        "year": ("orders", F.year("o_orderdate"), ()),
        "month": ("orders", F.month("o_orderdate"), ()),
        "month_name": ("orders", F.date_format("o_orderdate", "MMM"), ()),
        "customer_id": ("orders", F.col("o_custkey"), ()),
        "order_date": ("orders", F.col("o_orderdate"), ()),
        "ship_date": ("lineitem", F.col("l_shipdate"), ("l_shipdate",)),
        "amount_text": (
            "lineitem",
            _price_text(),
            ("l_partkey", "l_quantity", "l_extendedprice"),
        ),
    }


# The sixteen named columns of the order extract.
ORDER_COLUMNS = (
    "order_id",
    "status",
    "amount",
    "qty",
    "fulfilled_by",
    "b2b",
    "promotion_ids",
    "ship_city",
    "ship_state",
    "courier_status",
    "category",
    "style",
    "asin",
    "year",
    "month",
    "month_name",
)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def table_stream(
    spark: SparkSession, data_dir: str, name: str, files_per_batch: int = 1000
) -> DataFrame:
    """The table as a file stream, be it one file or a folder of files.

    A micro-batch takes `files_per_batch` files at most, so a backlog is worked
    off in bounded steps. The braces make the path a pattern, as a stream takes
    no plain file path.
    """
    schema = table(spark, data_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{data_dir}/{{{name}}}.parquet")


def flatten(
    spark: SparkSession,
    data_dir: str,
    lines: DataFrame,
    columns: Sequence[str] = ORDER_COLUMNS,
    by_order: bool = False,
) -> DataFrame:
    """`columns` for each row of `lines`, which may be a stream.

    Customers and nations join the orders before the lines do: orders are fewer
    and narrower, and lines already spread by order key (`by_order`) are not moved
    again. Other lines get their parts first, so that they end up by order key, where
    the lines of an order are reduced to one before they are moved once more.
    """
    known = _columns()
    needed = {known[c][0] for c in columns}

    def with_parts(lines: DataFrame) -> DataFrame:
        parts = table(spark, data_dir, "part")
        return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")

    if "part" in needed and not by_order:
        lines = with_parts(lines)
    if needed & {"orders", "customer", "nation"}:
        orders = table(spark, data_dir, "orders")
        if needed & {"customer", "nation"}:
            customers = table(spark, data_dir, "customer")
            if "nation" in needed:
                nations = table(spark, data_dir, "nation")
                customers = customers.join(
                    nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
                )
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in needed and by_order:
        lines = with_parts(lines)
    return lines.select(*[known[c][1].alias(c) for c in columns])


def sales_lines(
    spark: SparkSession, data_dir: str, columns: Sequence[str] = ORDER_COLUMNS
) -> DataFrame:
    """Every order line, orders with several lines being the duplicates to remove."""
    return flatten(spark, data_dir, table(spark, data_dir, "lineitem"), columns)


def unique_orders(
    spark: SparkSession, data_dir: str, columns: Sequence[str] = ORDER_COLUMNS
) -> DataFrame:
    """One row per order key of the lines, with the duplicates gone before the joins.

    Only the ranking and what `columns` are made of is read and ranked: lines
    that tie on that are equal in the result.
    """
    known = _columns()
    needed = {n for c in columns for n in known[c][2]} - {"l_orderkey", *LINE_ORDER}
    lines = table(spark, data_dir, "lineitem").select("l_orderkey", *LINE_ORDER, *sorted(needed))
    one = dedup_orders(lines, "l_orderkey", LINE_ORDER)
    return flatten(spark, data_dir, one, columns, by_order=True)
