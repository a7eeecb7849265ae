"""KPI semantics, invariants and agreement of the one-scan form."""

import math
from decimal import Decimal

import pytest
from check import assert_same
from pyspark.sql import functions as F
from rows import orders, values

from tillroll.functions import money
from tillroll.operators import extras, kpis
from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import settle
from tillroll.plans.report import summary_report
from tillroll.sources.star import unique_orders


@pytest.fixture(scope="module")
def enriched(spark, sf_dir):
    return enrich_sales(settle(unique_orders(spark, sf_dir))).cache()


def enrich(spark, *changes, **more):
    return enrich_sales(settle(orders(spark, *changes, **more)))


def total(df, name):
    return round(df.agg(F.sum(F.col(name).cast("decimal(18,4)"))).first()[0], 2)


@pytest.mark.parametrize(
    "name", [n for n, k in kpis.VALID_SALE_KPIS.items() if "total_revenue" in k.measures]
)
def test_revenue_adds_up_to_the_same_total(enriched, name):
    whole = total(kpis.profit_margin(enriched), "total_revenue")
    assert total(kpis.KPIS[name](enriched), "total_revenue") == whole


def test_status_distribution_covers_all_orders(enriched):
    shares = kpis.status_distribution(enriched)
    assert total(shares, "order_count") == enriched.filter("order_id IS NOT NULL").count()
    assert abs(total(shares, "percentage") - 100) < 0.05


@pytest.mark.parametrize("name", kpis.ROLLUP_KPIS)
def test_the_rollup_gives_the_same_kpis(enriched, name):
    rolled = kpis.KPIS[name](kpis.sales_rollup(enriched))
    alone = kpis.KPIS[name](enriched)
    assert rolled.dtypes == alone.dtypes
    assert_same(rolled, alone)


def test_null_keys_are_groups_of_their_own(spark):
    df = enrich(spark, {"fulfilled_by": None, "b2b": None}, {"order_id": "O2"})
    for name, key in [("fulfillment_performance", "fulfilled_by"), ("b2b_analysis", "b2b")]:
        alone = values(kpis.KPIS[name](df), key, "order_count")
        rolled = values(kpis.KPIS[name](kpis.sales_rollup(df)), key, "order_count")
        assert len(alone) == 2 and (None, 1) in alone
        assert sorted(alone, key=str) == sorted(rolled, key=str)


def test_orders_without_id_count_in_the_share_only(spark):
    df = enrich(spark, {"order_id": None, "status": "Lost"}, {}, {"order_id": "O2"})
    assert values(kpis.status_distribution(df), "status", "order_count", "percentage") == [
        ("Shipped", 2, 66.67),
        ("Lost", 0, 33.33),
    ]


def test_delivery_rate_reads_valid_sales_and_letter_case(spark):
    df = enrich(
        spark,
        {"status": "Shipped - Delivered to Buyer"},
        {"status": "delivered"},
        {"status": "Delivered", "amount": 0.0},
        {"status": "Cancelled"},
    )
    assert values(kpis.fulfillment_performance(df), "order_count", "delivery_success_rate") == [
        (2, 50.0)
    ]


def test_one_order_has_no_spread(spark):
    row = kpis.aov(enrich(spark, {"amount": 12.345})).first()
    assert tuple(row) == (12.35, 12.35, 12.35, None)


def test_no_valid_sales(spark):
    df = enrich(spark, {"status": "Cancelled"})
    assert values(kpis.profit_margin(df), "total_revenue", "profit_margin_pct") == [(None, None)]
    assert kpis.monthly_revenue(df).count() == 0
    assert kpis.monthly_revenue(kpis.sales_rollup(df)).count() == 0
    assert kpis.status_distribution(df).first().percentage == 100.0


def test_no_orders_at_all(spark):
    df = enrich(spark, {}).limit(0)
    for name, kpi in kpis.KPIS.items():
        assert kpi(df).count() == (1 if name in ("profit_margin", "aov") else 0)
        if name in kpis.ROLLUP_KPIS:
            assert kpi(kpis.sales_rollup(df)).collect() == kpi(df).collect()
    assert values(summary_report(df), "metric", "value") == [
        ("Total_Orders", 0.0),
        ("Valid_Sales", 0.0),
        ("Cancellation_Rate_Pct", None),
    ]


def test_summary_counts_empty_amounts_as_lost(spark):
    df = enrich(spark, {}, {"amount": 0.0}, {"status": "Cancelled"})
    assert values(summary_report(df), "metric", "value") == [
        ("Total_Orders", 3.0),
        ("Valid_Sales", 1.0),
        ("Cancellation_Rate_Pct", 66.67),
    ]


def test_ranking_and_top_settle_ties_by_key(spark):
    df = enrich(spark, *[{"ship_state": s} for s in "CAB"], {"ship_state": "D", "amount": 500.0})
    assert [r.ship_state for r in kpis.region_sales(df).collect()] == ["D", "A", "B", "C"]
    assert [r.ship_state for r in kpis.top_states(df, k=2).collect()] == ["D", "A"]


def test_monthly_revenue_is_in_calendar_order(spark):
    months = [(2023, 1, "Jan"), (2022, 12, "Dec"), (2022, 2, "Feb")]
    names = ("year", "month", "month_name")
    df = enrich(spark, *[dict(zip(names, m, strict=True)) for m in months])
    assert values(kpis.monthly_revenue(df), "year", "month") == [(2022, 2), (2022, 12), (2023, 1)]


def test_fractional_units_are_kept(spark):
    df = enrich(spark, {"qty": "1.5"}, {"qty": "2"}, types={"qty": "string"})
    for source in (df, kpis.sales_rollup(df)):
        assert kpis.monthly_revenue(source).first().total_units_sold == 3.5


def test_cents_do_not_depend_on_partitioning(spark):
    ids = spark.range(20_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(10**7)) / 100 + 0.01).alias("amount"),
        F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("ship_state"),
        F.col("id").cast("string").alias("order_id"),
        F.lit(1).alias("qty"),
        F.lit(True).alias("is_valid_sale"),
    )
    first, *others = (kpis.region_sales(ids.repartition(n)).collect() for n in (1, 5, 13))
    assert all(rows == first for rows in others)


@pytest.mark.parametrize("name", ["top_states", "top_products_10"])
def test_top_k_never_sorts_the_whole_ranking(enriched, name):
    plan = getattr(kpis, name)(enriched)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_exact_quantiles(spark):
    amounts = [10.0] * 6 + [0.01, 20.5, 99999999.99, 20.5]
    df = enrich(spark, *[{"amount": a} for a in amounts])
    shares = [0.0, 0.1, 0.11, 0.7, 0.71, 0.9, 1.0]
    assert sorted(values(extras.aov_percentiles(df, shares), "share", "amount")) == [
        (0.0, 0.01),
        (0.1, 0.01),
        (0.11, 10.0),
        (0.7, 10.0),
        (0.71, 20.5),
        (0.9, 20.5),
        (1.0, 99999999.99),
    ]
    assert extras.aov_percentiles(df.limit(0), shares).count() == 0


def test_sketched_quantiles_are_near_the_exact_ones(enriched):
    shares = [0.25, 0.5, 0.9]
    exact = dict(values(extras.aov_percentiles(enriched, shares), "share", "amount"))
    near = dict(values(extras.approximate_aov_percentiles(enriched, shares), "share", "amount"))
    assert all(abs(near[s] - exact[s]) / exact[s] < 0.005 for s in shares)


def test_ranks_within_category(spark):
    df = enrich(
        spark,
        {"asin": "P1", "amount": 5.0},
        {"asin": "P2", "amount": 9.0},
        {"asin": "P3", "amount": 5.0},
        {"asin": "P4", "category": "Top", "amount": 1.0},
    )
    best = extras.top_products_per_category(df, k=2)
    assert sorted(values(best, "category", "place", "asin")) == [
        ("Set", 1, "P2"),
        ("Set", 2, "P1"),
        ("Top", 1, "P4"),
    ]


def test_growth_against_the_month_before(spark):
    df = enrich(spark, {"month": 5, "amount": 150.0}, {"month": 4}, {"month": 7, "amount": 75.0})
    assert values(extras.revenue_mom_growth(df), "month", "growth_pct") == [
        (4, None),
        (5, 50.0),
        (7, -50.0),
    ]


def test_a_garbled_amount_does_not_stop_the_job(spark):
    df = enrich(spark, {"amount": "9" * 30}, {"amount": "2.5"}, types={"amount": "string"})
    for name, kpi in kpis.KPIS.items():
        assert kpi(df).count() == 1, name
    assert kpis.profit_margin(df).first().total_revenue == 1e30


LARGE = ("0.123456", "0.00001", "5.5", "1e14", "1e33", "9" * 36, "1e300", "1e400")


def test_amounts_of_any_size_are_in_the_sums(spark):
    df = enrich(spark, *[{"amount": a} for a in LARGE], types={"amount": "string"})
    finite = [float(a) for a in LARGE[:-1]]
    for source in (df, kpis.sales_rollup(df)):
        row = kpis.b2b_analysis(source).first()
        assert row.order_count == 7 and row.total_revenue == pytest.approx(sum(finite))
    small = df.filter("amount < 10 or amount is null")
    assert kpis.profit_margin(small).first().total_revenue == 5.62
    row = kpis.aov(df).first()
    assert row.max_order_value == 1e300 and row.min_order_value == 0.0


def test_a_sum_beyond_the_decimals_goes_on_as_doubles(spark):
    df = spark.range(30).selectExpr(
        "1e19 * 9 AS amount", "'S' AS ship_state", "1 AS qty", "'O' AS order_id", "true AS is_valid_sale"
    )
    assert kpis.region_sales(df).first().total_revenue == pytest.approx(30 * 9e19)
    exact = df.selectExpr("amount", "CAST(9e27 AS decimal(38,10)) AS e", "CAST(null AS double) AS r")
    assert exact.agg(money.total(F.col("e"), F.col("r"))).first()[0] == pytest.approx(30 * 9e27)


def test_quantiles_are_amounts_of_the_data(spark):
    df = enrich(spark, *[{"amount": a} for a in LARGE], types={"amount": "string"})
    shares = [0.0, 0.2, 0.4, 0.5, 0.7, 0.85, 1.0]
    got = dict(values(extras.aov_percentiles(df, shares), "share", "amount"))
    finite = sorted(float(a) for a in LARGE[:-1])
    assert got == {s: finite[max(1, math.ceil(s * 7)) - 1] for s in shares}


def test_profit_is_not_rounded_per_order(spark):
    cheap = [{"order_id": f"O{i}", "amount": 0.01} for i in range(1000)]
    df = enrich_sales(settle(orders(spark, *cheap)), margin=0.125)
    for source in (df, kpis.sales_rollup(df)):
        assert tuple(kpis.profit_margin(source).first()) == (10.0, 1.25, 12.5)


def test_a_month_with_two_spellings_is_one_month(spark):
    df = enrich(spark, {"month_name": "Apr"}, {"month_name": "April"}, {"month": 5, "amount": 100.0})
    assert values(extras.revenue_mom_growth(df), "month", "total_revenue", "growth_pct") == [
        (4, 200.0, None),
        (5, 100.0, -50.0),
    ]


def test_ranks_tell_right_from_wrong(spark):
    df = enrich(spark, *[{"amount": float(a)} for a in range(1, 1001)])
    asked = spark.createDataFrame([(0.5, 500.0), (0.9, 930.0), (0.1, 101.5)], "share double, amount double")
    got = dict(values(extras.held_to_ranks(df, asked, error=0.01), "share", "within_bound"))
    assert got == {0.5: True, 0.9: False, 0.1: True}


def test_shares_come_from_one_total(spark):
    df = enrich(spark, *[{"order_id": f"O{i}", "status": f"S{i % 7}"} for i in range(70)])
    plan = kpis.status_distribution(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert {r.percentage for r in kpis.status_distribution(df).collect()} == {14.29}


def _spread_of(spark, amounts, parts):
    rows = spark.createDataFrame([(f"O{i}", a, True) for i, a in enumerate(amounts)],
                                 "order_id string, amount double, is_valid_sale boolean")
    return kpis.aov(rows.repartition(parts)).first()


@pytest.mark.parametrize(
    "amounts",
    [
        [5.0],
        [5.0, 7.25, 100.1],
        [999_999_999.01 + i / 100 for i in range(50)],
        [1e-7, 2e-7, 3.5e-7],
        [1e12, 3e12, 2.0],
        [0.3333333333, 100.0, 2e10, 7.77],
    ],
)
def test_spread_from_moments(spark, amounts):
    got = {_spread_of(spark, amounts, parts).std_dev for parts in (1, 3, 7)}
    held = [Decimal(str(a)) for a in amounts]
    if len(held) < 2:
        assert got == {None}
        return
    mean = sum(held) / len(held)
    exact = float((sum((a - mean) ** 2 for a in held) / (len(held) - 1)).sqrt())
    assert len(got) == 1 and abs(got.pop() - exact) <= 0.0051 + exact * 1e-9


def test_all_ten_but_products_come_from_the_rollup_in_any_partitioning(spark, sf_dir):
    df = enrich_sales(settle(unique_orders(spark, sf_dir)))
    alone = kpis.aov(df).collect()
    assert "aov" in kpis.ROLLUP_KPIS
    for parts in (1, 5):
        assert kpis.aov(kpis.sales_rollup(df.repartition(parts))).collect() == alone


def test_merged_sketches_are_as_good_as_direct_ones(spark):
    """More values than the sketches hold, in groups of very different sizes."""
    rows = spark.range(0, 300_000, 1, 8).select(
        (F.pmod(F.xxhash64("id"), F.lit(100_003)) / 7).alias("amount"),
        F.lit(True).alias("is_valid_sale"),
        F.floor(F.sqrt(F.col("id") % 10)).cast("int").alias("year"),
        (F.col("id") % 7).cast("int").alias("month"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("category"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(40_000)).alias("customer_id"),
    )
    shares = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]
    sketches = extras.sketch_rollup(rows)
    for made in (sketches, extras.sketch_rollup(rows, ())):
        found = extras.held_to_ranks(rows, extras.sketched_quantiles(made, shares))
        got = found.collect()
        assert [r.share for r in got] == shares and all(r.within_bound for r in got)
    off = extras.held_to_ranks(rows, spark.createDataFrame([(0.5, 1.0)], "share double, amount double"))
    assert [r.within_bound for r in off.collect()] == [False]
    by_year = extras.sketched_quantiles(sketches, [0.5], ["year"])
    exact = dict(values(rows.groupBy("year").agg(F.median("amount").alias("m")), "year", "m"))
    assert all(abs(r.amount - exact[r.year]) < 100_003 / 7 * 0.002 for r in by_year.collect())
    buyers = dict(values(rows.groupBy("year").agg(F.count_distinct("customer_id").alias("n")), "year", "n"))
    for r in extras.sketched_buyers(sketches, ["year"]).collect():
        assert abs(r.estimate - buyers[r.year]) <= 4 * extras.BUYER_ERROR * buyers[r.year]


def test_sketches_of_nothing(spark, enriched):
    none = enriched.filter("false").withColumn("customer_id", F.lit(1))
    assert extras.sketch_rollup(none).count() == 0
    assert extras.buyers_by_period(none).collect() == []


def test_buyers_by_period_rolls_up(spark):
    rows = [(2024, 1, "a", 7), (2024, 2, "a", 7), (2024, 2, "b", 8), (2025, 1, "a", None), (None, None, "a", 9)]
    df = spark.createDataFrame(rows, "year int, month int, category string, customer_id bigint")
    df = df.withColumn("is_valid_sale", F.lit(True)).withColumn("amount", F.lit(1.0))
    got = values(extras.buyers_by_period(df), "year", "month", "buyers", "estimate", "error_pct")
    assert sorted(got, key=str) == sorted(
        [
            (2024, 1, 1, 1, 0.0),
            (2024, 2, 2, 2, 0.0),
            (2025, 1, 0, 0, None),
            (2024, None, 2, 2, 0.0),
            (2025, None, 0, 0, None),
            (None, None, 1, 1, 0.0),
            (None, None, 1, 1, 0.0),
            (None, None, 3, 3, 0.0),
        ],
        key=str,
    )
