"""Cleaning semantics on hand-made rows; ANSI mode is on, as by default."""

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from rows import ORDER_TYPES, orders, text, values

from tillroll.functions.money import normalise_numeric
from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import (
    clean_sales,
    dedup_orders,
    dedup_report,
    fill_defaults,
    flag_valid,
    ingest_profile,
    missing_profile,
    settle,
)


def test_profile_tells_null_from_blank(spark):
    df = orders(spark, {"ship_city": None}, {"ship_city": " "}, {"ship_city": ""}, {})
    found = {r.column_name: r for r in missing_profile(df).collect()}
    assert list(found) == list(ORDER_TYPES)
    assert found["ship_city"][1:] == (1, 2, 50.0, 75.0)
    assert found["amount"][1:] == (0, 0, 0.0, 0.0)


def test_profile_of_nothing(spark):
    df = orders(spark, {}).limit(0)
    assert {tuple(r[1:]) for r in missing_profile(df).collect()} == {(0, 0, 0.0, 0.0)}
    assert values(ingest_profile(df), "row_count", "column_count") == [(0, 16)]
    assert values(dedup_report(df), "row_count", "order_rows") == [(0, 0)]


def test_profile_takes_any_column_name(spark):
    df = spark.createDataFrame([(None, " ")], "`a.b` int, `Unnamed: 0` string")
    assert [tuple(r[:3]) for r in missing_profile(df).collect()] == [
        ("a.b", 1, 0),
        ("Unnamed: 0", 0, 1),
    ]


def test_dedup_keeps_the_first_and_merges_missing_ids(spark):
    df = orders(
        spark,
        {"amount": 2.0, "qty": 1},
        {"amount": 1.0, "qty": 9},
        {"order_id": None, "amount": 5.0},
        {"order_id": None, "amount": 4.0},
    )
    kept = dedup_orders(df, order_by=["amount"], copies="n")
    assert sorted(values(kept, "order_id", "amount", "n"), key=str) == [
        ("O1", 1.0, 2),
        (None, 4.0, 2),
    ]
    assert kept.columns == [*df.columns, "n"]
    assert values(dedup_report(df), "row_count", "order_rows", "duplicates_removed") == [(4, 2, 2)]


def test_dedup_does_not_depend_on_partitioning(spark):
    ids = spark.range(3000).select(
        F.concat(F.lit("O"), (F.col("id") % 700).cast("string")).alias("order_id"),
        F.pmod(F.hash("id"), F.lit(5)).alias("qty"),
        F.pmod(F.xxhash64("id"), F.lit(9)).cast("double").alias("amount"),
    )
    results = [
        sorted(map(tuple, dedup_orders(ids.repartition(n, key)).collect()))
        for n, key in [(1, "qty"), (3, "amount"), (7, "order_id")]
    ]
    assert len(results[0]) == 700
    assert results[0] == results[1] == results[2]


def test_a_hot_order_sends_one_row_per_task(spark):
    """A third of the rows share a key; the shuffle still carries one row per key and task."""
    n, tasks = 30_000, 4
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("id").cast("string"))
        .alias("order_id"),
        F.col("id").alias("amount"),
    )
    kept = dedup_orders(df, copies="n")
    assert kept.filter("order_id = 'hot'").select("amount", "n").first() == (0, n // 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning(order_id")
    assert "partial_min" in after and "partial_min" not in before
    ranked = dedup_orders(df)
    assert ranked.filter("order_id = 'hot'").first().amount == 0
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert all("WindowGroupLimit" in part for part in plan.split("Exchange hashpartitioning(order_id"))


def test_both_ways_keep_the_same_rows(spark, sf_dir):
    from tillroll.sources.star import sales_lines

    lines = sales_lines(spark, sf_dir)
    counted = dedup_orders(lines, copies="n")
    assert counted.drop("n").exceptAll(dedup_orders(lines)).count() == 0
    assert counted.count() == dedup_orders(lines).count()
    assert counted.filter("order_id IS NULL").first().n > 100


def test_the_flat_table_has_something_to_clean(spark, sf_dir):
    from tillroll.sources.star import sales_lines

    found = {r.column_name: r for r in missing_profile(sales_lines(spark, sf_dir)).collect()}
    assert found["ship_city"].blank_count > 0 and found["promotion_ids"].blank_count > 0
    assert found["order_id"].null_count > 0


def test_fill_leaves_other_columns_and_absent_ones(spark):
    df = orders(spark, {c: None for c in ORDER_TYPES}, {"amount": math.nan})
    filled = fill_defaults(df).first().asDict()
    assert filled["amount"] == 0.0 and filled["qty"] == 0
    assert [filled[c] for c in ("status", "courier_status", "ship_city", "ship_state")] == [
        "Unknown"
    ] * 4
    assert filled["promotion_ids"] == "No Promotion"
    assert filled["fulfilled_by"] is None and filled["b2b"] is None
    assert fill_defaults(df).collect()[1].amount == 0.0
    assert fill_defaults(df.select("status")).columns == ["status"]


@pytest.mark.parametrize(
    "cell, number",
    [
        ("12.50", 12.5),
        ("", None),
        ("  ", None),
        (None, None),
        ("abc", None),
        ("-", None),
        ("1-2", None),
        ("Rs. 1,234.50", None),
        ("INR 1,234.50", 1234.5),
        ("-7", -7.0),
        ("1.23456789E7", 12345678.9),
        ("NaN", None),
        ("1e400", None),
        ("-1e400", None),
        ("1e300", 1e300),
    ],
)
def test_numbers_in_text(spark, cell, number):
    df = normalise_numeric(text(spark, "amount", cell), ["amount"])
    assert df.first().amount == number
    assert df.schema["amount"].dataType.simpleString() == "double"


def test_typed_numbers_stay_as_they_are(spark):
    df = spark.createDataFrame([(12345678.9,), (0.0001,), (None,)], "amount double")
    assert values(normalise_numeric(df, ["amount", "qty"]), "amount") == [
        (12345678.9,),
        (0.0001,),
        (None,),
    ]


def test_strict_normaliser_needs_its_columns(spark):
    with pytest.raises(AnalysisException):
        normalise_numeric(text(spark, "amount", "1"), ["amount", "qty"], strict=True)


@pytest.mark.parametrize(
    "status, amount, valid",
    [
        ("Shipped", 1.0, True),
        ("cancelled", 1.0, True),
        ("Cancelled", 1.0, False),
        ("Shipped", 0.0, False),
        ("Shipped", -1.0, False),
        ("Shipped", None, False),
        (None, 1.0, False),
    ],
)
def test_valid_sale(spark, status, amount, valid):
    df = flag_valid(orders(spark, {"status": status, "amount": amount}))
    assert df.first().is_valid_sale is valid


def test_defaults_come_before_number_cleaning(spark):
    df = orders(
        spark,
        {"order_id": "O1", "amount": None, "qty": "2"},
        {"order_id": "O2", "amount": "n/a", "qty": "x"},
        {"order_id": "O3", "amount": "INR 5", "qty": None},
        types={"amount": "string", "qty": "string"},
    )
    settled = settle(df).orderBy("order_id")
    assert values(settled, "amount", "qty", "is_valid_sale") == [
        (0.0, 2.0, False),
        (None, None, False),
        (5.0, 0.0, True),
    ]


def test_unknown_columns_pass_through(spark):
    more = {"index": "int", "currency": "string"}
    df = orders(spark, {"index": 7, "currency": "INR"}, types=more)
    row = enrich_sales(clean_sales(df)).first()
    assert (row["index"], row["currency"]) == (7, "INR")


@pytest.mark.parametrize("qty, price", [(4, 25.0), (0, 100.0), (-1, 100.0), (None, 100.0)])
def test_price_per_item(spark, qty, price):
    assert enrich_sales(orders(spark, {"qty": qty})).first().price_per_item == price


@pytest.mark.parametrize(
    "cell, kind, flag",
    [
        ("True", "string", 1),
        ("TRUE", "string", 0),
        ("true", "string", 0),
        (None, "string", 0),
        (True, "boolean", 1),
        (False, "boolean", 0),
        (None, "boolean", 0),
    ],
)
def test_b2b_flag_for_text_and_boolean(spark, cell, kind, flag):
    assert enrich_sales(orders(spark, {"b2b": cell}, types={"b2b": kind})).first().is_b2b == flag


@pytest.mark.parametrize("cell, flag", [("PROMO-1", 1), (" ", 1), (None, 0)])
def test_promotion_flag(spark, cell, flag):
    df = enrich_sales(settle(orders(spark, {"promotion_ids": cell})))
    assert df.first().has_promotion == flag


def test_enrichment_parameters(spark):
    df = orders(spark, {"fulfilled_by": "Own"}, {"fulfilled_by": None})
    rows = enrich_sales(df, margin=0.25, platform_label="Own").collect()
    assert (rows[0].cost, rows[0].profit, rows[0].profit_margin_pct) == (75.0, 25.0, 25.0)
    assert [r.is_platform_fulfilled for r in rows] == [1, 0]


def test_cost_and_profit_make_the_amount(spark):
    rows = enrich_sales(orders(spark, {"amount": 33.33}, {"amount": 0.07})).collect()
    assert all(math.isclose(r.cost + r.profit, r.amount) for r in rows)
    assert {r.profit_margin_pct for r in rows} == {30.0}
    assert enrich_sales(orders(spark, {}), margin=0.07).first().profit_margin_pct == 7.0
