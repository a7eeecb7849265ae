"""Sources, sinks, tables and the whole job."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from check import assert_same
from pyspark.sql import functions as F
from rows import ORDER_TYPES, orders, values

import job
from tillroll import staging
from tillroll.functions.bitmaps import may_be_among
from tillroll.operators import kpis
from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import clean_sales, dedup_orders, missing_profile, settle
from tillroll.plans.run import publish_run, published_kpis, run
from tillroll.schema import INPUT_HEADERS, canonical, headed
from tillroll.sinks.tables import (
    append_new_orders,
    register_external,
    save_managed,
    write_enriched,
)
from tillroll.sinks.versions import current, publish
from tillroll.sources.orders import land_csv, malformed_lines, read_orders_csv, read_orders_parquet
from tillroll.sources.star import ORDER_COLUMNS, sales_lines, unique_orders

CSV = """index,Order ID,Amount,Qty,Status,Courier Status,ship-city,ship-state,promotion-ids,B2B,fulfilled-by,Category,ASIN,Style,Year,Month,MonthName,currency
0,A1,"INR 1,200.50",2,Shipped,,PUNE,  ,,True,Own,Set,P1,S1,2022,4,Apr,INR
1,A1,"INR 1,200.50",2,Shipped,,PUNE,  ,,True,Own,Set,P1,S1,2022,4,Apr,INR
2,A2,,1,Cancelled,Unshipped,DELHI,DELHI,PLCC,False,,Kurta,P2,S2,2022,5,May,INR
3,,abc,,,,,,,,,,,,,,,
4,A3,-3,1,cancelled,Shipped,DELHI,DELHI,,False,Own,Kurta,P2,S2,2022,5,May,INR
"""


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(CSV)
    return str(tmp_path / "in")


def test_csv_is_read_as_text_but_for_the_period(spark, csv_dir):
    df = read_orders_csv(spark, csv_dir)
    kinds = dict(df.dtypes)
    assert set(INPUT_HEADERS) < set(kinds) and {"index", "currency"} < set(kinds)
    assert {c for c, t in kinds.items() if t != "string"} == {"year", "month"}
    assert df.filter("order_id = 'A2'").first().amount is None


def test_csv_through_all_stages(spark, csv_dir):
    df = enrich_sales(clean_sales(read_orders_csv(spark, csv_dir)), platform_label="Own")
    got = {
        r.order_id: (r.amount, r.qty, r.status, r.ship_state, r.is_valid_sale, r.is_b2b)
        for r in df.collect()
    }
    assert got == {
        "A1": (1200.5, 2.0, "Shipped", "  ", True, 1),
        "A2": (0.0, 1.0, "Cancelled", "DELHI", False, 0),
        "A3": (-3.0, 1.0, "cancelled", "DELHI", False, 0),
        None: (None, 0.0, "Unknown", "Unknown", False, 0),
    }


def test_a_file_with_other_headers_is_an_error(spark, csv_dir):
    with open(os.path.join(csv_dir, "b.csv"), "w") as f:
        head, *rest = CSV.splitlines()
        f.write("\n".join([head.replace("Order ID,Amount", "Amount,Order ID"), *rest]))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_orders_csv(spark, csv_dir).collect()


def test_headers_round_trip(spark):
    df = enrich_sales(settle(orders(spark, {})))
    named = headed(df)
    assert {"Order ID", "ship-state", "Is_B2B", "Has_Promotion"} < set(named.columns)
    assert canonical(named).columns == df.columns


def test_job_stores_all_results(spark, csv_dir, tmp_path):
    out = str(tmp_path / "out")
    done = run(read_orders_csv(spark, csv_dir), out)
    assert sorted(os.listdir(out)) == [
        "enriched_sales_data",
        "kpis",
        "sales_rollup",
        "summary_report",
    ]
    assert sorted(os.listdir(f"{out}/kpis")) == sorted(kpis.KPIS)
    assert tuple(done.ingest.first()) == (5, 4, 1)
    assert done.enriched.count() == 4
    assert dict(values(done.summary, "metric", "value")) == {
        "Total_Orders": 4.0,
        "Valid_Sales": 1.0,
        "Cancellation_Rate_Pct": 75.0,
    }
    stored = spark.read.parquet(f"{out}/kpis/monthly_revenue")
    assert values(stored, "Year", "Month", "MonthName", "Total_Revenue", "Order_Count") == [
        (2022, 4, "Apr", 1200.5, 1)
    ]
    assert spark.read.parquet(f"{out}/summary_report").columns == ["Metric", "Value"]


def test_job_runs_again_over_its_output(spark, csv_dir, tmp_path):
    df = read_orders_csv(spark, csv_dir)
    first = run(df, str(tmp_path / "out")).ingest.first()
    assert run(df, str(tmp_path / "out")).ingest.first() == first


def test_job_equals_the_stages_called_one_by_one(spark, sf_dir, tmp_path):
    done = run(sales_lines(spark, sf_dir), str(tmp_path / "out"))
    alone = kpis.calculate_kpis(enrich_sales(clean_sales(sales_lines(spark, sf_dir))))
    for name, kpi in alone.items():
        assert_same(done.kpis[name], kpi)


def test_months_are_pruned_and_flags_pushed(spark, sf_dir, tmp_path):
    path = str(tmp_path / "enriched")
    write_enriched(enrich_sales(settle(unique_orders(spark, sf_dir))), path)
    df = kpis.valid_sales(read_orders_parquet(spark, path)).filter("year = 1997")
    plan = df.select("amount")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert "EqualTo(Is_Valid_Sale,true)" in plan
    assert "ReadSchema: struct<Amount:double,Is_Valid_Sale:boolean>" in plan
    months = len(os.listdir(f"{path}/Year=1997"))
    files = [f for _, _, fs in os.walk(f"{path}/Year=1997") for f in fs if f.endswith(".parquet")]
    assert months == 12 and len(files) == 12


def test_input_without_period_is_stored_unpartitioned(spark, tmp_path):
    path = str(tmp_path / "enriched")
    df = enrich_sales(settle(orders(spark, {}).drop("year", "month")))
    write_enriched(df, path)
    assert read_orders_parquet(spark, path).columns == df.columns


def test_external_and_managed_tables(spark, tmp_path):
    df = enrich_sales(settle(orders(spark, {}, {"order_id": "O2", "month": 5})))
    write_enriched(df, str(tmp_path / "enriched"))
    register_external(spark, "external_sales", str(tmp_path / "enriched"))
    assert spark.sql("SELECT * FROM external_sales LIMIT 10").count() == 2
    save_managed(df, "managed_sales")
    rows = canonical(spark.sql("SELECT * FROM managed_sales WHERE Month = 5"))
    assert values(rows, "order_id") == [("O2",)]
    types = {t.name: t.tableType for t in spark.catalog.listTables()}
    assert types["external_sales"] == "EXTERNAL" and types["managed_sales"] == "MANAGED"


def test_joins_before_or_after_dedup_are_the_same(spark, sf_dir):
    columns = [*ORDER_COLUMNS, "ship_date", "customer_id", "order_date", "amount_text"]
    early = unique_orders(spark, sf_dir, columns)
    ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "concat('O', l_orderkey) AS key", "l_tax", *ties
    )
    first = dedup_orders(lines, "key", order_by=ties)
    assert early.count() == first.count()
    named = "CASE WHEN NOT (l_linenumber = 7 AND l_tax = 0.06) THEN key END AS order_id"
    wanted = first.selectExpr(named, "concat('P', l_partkey) AS asin")
    assert early.select("order_id", "asin").exceptAll(wanted).count() == 0


@pytest.mark.parametrize(
    "columns, tables",
    [
        (["order_id", "amount"], {"lineitem"}),
        (["order_id", "status"], {"lineitem", "orders"}),
        (["b2b"], {"lineitem", "orders", "customer"}),
        (["ship_state"], {"lineitem", "orders", "customer", "nation"}),
        (["category"], {"lineitem", "part"}),
    ],
)
def test_only_needed_tables_are_read(spark, sf_dir, columns, tables):
    files = sales_lines(spark, sf_dir, columns).inputFiles()
    assert {os.path.basename(f).removesuffix(".parquet") for f in files} == tables


def test_staging_follows_the_session(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = (staging.new_folder(spark, "x") for _ in range(2))
    assert one != two and one.startswith(base + "/x-")

    for master in ("yarn", "local-cluster[3,2,3000]"):

        class Cluster:
            class conf:  # noqa: N801
                get = staticmethod(lambda name, default, m=master: {"spark.master": m}.get(name, default))

        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging.new_folder(Cluster, "x")


def test_types_of_the_flat_table(spark, sf_dir):
    assert dict(sales_lines(spark, sf_dir).dtypes) == ORDER_TYPES
    assert sales_lines(spark, sf_dir).filter(F.col("qty").isNull()).count() > 0


def test_a_large_month_is_split_over_files(spark, tmp_path):
    """Two thirds of the orders in one month: several files there, one for each other month."""
    path = str(tmp_path / "enriched")
    df = spark.range(0, 60_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.lit(2022).alias("year"),
        F.greatest(F.lit(1), F.col("id") % 36 - 23).cast("int").alias("month"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "512k")
    try:
        write_enriched(df, path)
    finally:
        spark.conf.set(size, before)
    files = {
        m: sum(f.endswith(".parquet") for f in os.listdir(f"{path}/Year=2022/Month={m}"))
        for m in range(1, 13)
    }
    assert files[1] > 1 and set(list(files.values())[1:]) == {1}
    assert spark.read.parquet(path).count() == 60_000


def test_period_is_derived_from_the_date(spark, tmp_path):
    days = [{"order_id": f"O{m}", "order_date": f"2024-0{m}-15"} for m in (1, 2)]
    df = orders(spark, *days, types={"order_date": "string"}).drop("year", "month", "month_name")
    done = run(df, str(tmp_path / "out"))
    assert sorted(values(done.kpis["monthly_revenue"], "year", "month", "month_name")) == [
        (2024, 1, "Jan"),
        (2024, 2, "Feb"),
    ]


@pytest.mark.parametrize("lost", ["year", "asin"])
def test_a_missing_column_is_an_error_before_anything_is_written(spark, tmp_path, lost):
    with pytest.raises(ValueError, match=lost):
        run(orders(spark, {}).drop(lost), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_job_leaves_no_folders_behind(spark, csv_dir, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    run(read_orders_csv(spark, csv_dir), str(tmp_path / "out"))
    assert set(os.listdir(base)) == before


def test_lines_that_do_not_fit_the_header_are_kept_apart(spark, tmp_path):
    lines = ["Order ID,Amount,Status", "A1,5,Shipped", "A2,1,200,Shipped", "A3", 'A4,"1,200",Shipped']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "a.csv")
    good = read_orders_csv(spark, path)
    assert values(good, "order_id", "amount", "status") == [
        ("A1", "5", "Shipped"),
        ("A4", "1,200", "Shipped"),
    ]
    assert good.select("order_id").count() == 2 == good.count()
    assert [r.malformed for r in malformed_lines(spark, path).collect()] == ["A2,1,200,Shipped", "A3"]


def test_blank_and_missing_cells_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Order ID,Amount,Status\nA1,"",  \nA2,,""\n"",5,""\n')
    rows = read_orders_csv(spark, str(tmp_path / "a.csv"))
    assert values(rows, "order_id", "amount", "status") == [
        ("A1", "", "  "), ("A2", None, ""), ("", "5", ""),
    ]
    profile = {r.column_name: (r.null_count, r.blank_count) for r in missing_profile(rows).collect()}
    assert profile == {"order_id": (0, 1), "amount": (1, 1), "status": (0, 3)}


def test_one_scan_feeds_orders_and_malformed_lines(spark, tmp_path):
    lines = ["Order ID,Amount,Year", "A1,5,2022", "A2,1,200,2022", 'A3,"",', "A4"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "landed"))
    (tmp_path / "a.csv").write_text("Order ID,Amount,Year\n")
    assert values(good, "order_id", "amount", "year") == [("A1", "5", 2022), ("A3", "", None)]
    assert sorted(r.malformed for r in bad.collect()) == ["A2,1,200,2022", "A4"]
    for frame in (good, bad):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in text and text.count("FileScan parquet") == 1
        assert "PartitionFilters: [isnotnull(fits_header" in text


def test_landing_an_input_without_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Order ID,Amount\n")
    good, bad = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "landed"))
    assert good.columns == ["order_id", "amount"] and good.count() == bad.count() == 0


def test_readers_see_whole_versions_only(spark, tmp_path):
    out, seen, errors = str(tmp_path / "out"), [], []
    assert current(spark, out) is None
    done = threading.Event()

    def write(mark):
        def tables(folder):
            for name in ("a", "b"):
                spark.range(mark, mark + 1).write.parquet(f"{folder}/{name}")

        publish(spark, out, tables, keep=3)

    def read():
        while not done.is_set():
            folder = current(spark, out)
            if folder:
                pair = [spark.read.parquet(f"{folder}/{n}").first().id for n in ("a", "b")]
                seen.append(pair[0])
                errors.extend([pair] if pair[0] != pair[1] else [])

    write(0)
    with ThreadPoolExecutor(1) as pool:
        reader = pool.submit(read)
        for mark in range(1, 6):
            write(mark)
        done.set()
        reader.result()
    assert not errors and seen == sorted(seen)
    assert spark.read.parquet(f"{current(spark, out)}/b").first().id == 5
    assert len(os.listdir(f"{out}/versions")) == len(os.listdir(f"{out}/published")) == 3


def test_a_job_that_ends_midway_leaves_the_former_version(spark, csv_dir, tmp_path):
    out = str(tmp_path / "out")
    publish_run(read_orders_csv(spark, csv_dir), out)
    former = current(spark, out)

    def broken(folder):
        spark.range(3).write.parquet(f"{folder}/kpis/aov")
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        publish(spark, out, broken)
    assert current(spark, out) == former
    assert published_kpis(spark, out)["profit_margin"].count() == 1
    publish_run(read_orders_csv(spark, csv_dir), out)
    # What the broken job has left goes with the next version.
    assert former != current(spark, out) and len(os.listdir(f"{out}/versions")) == 2


def test_new_orders_join_stored_ones_in_buckets(spark):
    spark.sql("DROP TABLE IF EXISTS arrivals")
    first = orders(spark, {"amount": 5.0}, {"amount": 3.0}, {"order_id": "O2"})
    again = orders(
        spark, {"amount": 1.0}, {"order_id": "O3"}, {"order_id": "O3"}, {"order_id": None},
        {"order_id": None, "amount": 2.0},
    )
    for delivered in (first, again, again, first.filter("false")):
        append_new_orders(delivered, "arrivals", buckets=4)
    kept = sorted(values(spark.table("arrivals"), "order_id", "amount"), key=str)
    assert kept == sorted([("O1", 3.0), ("O2", 100.0), ("O3", 100.0), (None, 2.0)], key=str)
    spark.sql("DROP TABLE arrivals")


@pytest.mark.parametrize("most_bits", [1 << 15, 1 << 29])
def test_a_bitmap_holds_nothing_back(spark, most_bits):
    stored = spark.range(0, 200_000).withColumnRenamed("id", "k")
    wanted = spark.range(0, 400_000, 10).withColumnRenamed("id", "k")
    passed = may_be_among(stored, wanted, "k", most_bits)
    assert passed.join(wanted, "k", "left_semi").count() == 20_000
    if most_bits > 1 << 15:
        assert passed.count() < 20_000 + 180_000 * 0.08


def test_paths_with_quotes(spark, tmp_path):
    path = str(tmp_path / "it's here")
    write_enriched(enrich_sales(settle(orders(spark, {}))), path)
    for _ in range(2):
        register_external(spark, "quoted_sales", path)
        assert spark.table("quoted_sales").count() == 1


def test_queries_leave_one_table_each(spark):
    from __spark_entry__ import queries

    for name in ("external_table_query", "managed_table_roundtrip"):
        queries()[name](spark, "/root/testdata/sf0.001")
        before = [t.name for t in spark.catalog.listTables()], spark.catalog.listDatabases()
        queries()[name](spark, "/root/testdata/sf0.001")
        assert before == ([t.name for t in spark.catalog.listTables()], spark.catalog.listDatabases())


def test_job_from_the_command_line(spark, csv_dir, tmp_path):
    with open(os.path.join(csv_dir, "a.csv"), "a") as f:
        f.write("9,A9,too,many" + ",cells" * 20 + "\n")
    done = job.main([csv_dir, str(tmp_path / "out"), "--margin", "0.5", "--platform-label", "Own"])
    assert values(done.kpis["profit_margin"], "total_profit", "profit_margin_pct") == [
        (600.25, 50.0)
    ]
    assert done.enriched.agg(F.sum("is_platform_fulfilled")).first()[0] == 2
    version = current(spark, str(tmp_path / "out"))
    assert spark.read.text(f"{version}/malformed_lines").count() == 1
    with pytest.raises(SystemExit):
        job.main([csv_dir, str(tmp_path / "out")])
