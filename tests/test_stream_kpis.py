"""KPIs that follow a stream, against the batch job over the same lines."""

import os
import random

import pytest
from check import assert_same
from rows import orders, values

from tillroll.operators.kpis import KPIS, calculate_kpis
from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import clean_sales
from tillroll.plans.report import summary_report
from tillroll.plans.run import published_kpis
from tillroll.sinks.versions import current
from tillroll.streaming import kpis as kpi_stream
from tillroll.streaming.session import stream_session
from tillroll.streaming.survivors import batch_survivors


def follow(spark, folder, schema, per_batch=1):
    stream = (
        stream_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    ).parquet(f"{folder}/in")
    places = (f"{folder}/{p}" for p in ("store", "out", "checkpoint"))
    kpi_stream.serve_kpis(stream, *places)
    return published_kpis(spark, f"{folder}/out")


def put(spark, folder, *changes):
    df = orders(spark, *changes)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return df


def lines(seed, count):
    """Lines of few orders, so that most are repeats that differ and come in any order."""
    pick = random.Random(seed)
    return [
        {
            "order_id": pick.choice([None, *(f"O{i}" for i in range(12))]),
            "status": pick.choice(["Shipped", "Cancelled", None, "Shipped - Delivered to Buyer"]),
            "amount": pick.choice([None, 0.0, 10.25, 10.25, 99.999, 1e25, 5.0, -3.0]),
            "qty": pick.choice([None, 0, 1, 7]),
            "category": pick.choice(["Set", "Kurta", None]),
            "asin": pick.choice(["P1", "P2", None]),
            "ship_state": pick.choice(["NORTH", None, ""]),
            "b2b": pick.choice(["True", "False", None]),
            "month": pick.choice([4, 5]),
        }
        for _ in range(count)
    ]


def test_ten_batches_equal_the_batch_job_after_each(spark, tmp_path):
    folder, whole, sizes, reads = str(tmp_path), None, [], []
    for n in range(10):
        more = put(spark, folder, *lines(n, 25))
        whole = more if whole is None else whole.unionByName(more)
        got = follow(spark, folder, more.schema)
        sizes.append(spark.read.parquet(f"{folder}/store/changes/stored_batch={n}").count())
        sums = f"{folder}/store/sums/{n:09d}"
        reads.append(sum(spark.read.parquet(f"{sums}/{t}").count() for t in kpi_stream.TABLES))
        if n in (0, 4, 9):
            batch = enrich_sales(clean_sales(spark.createDataFrame(whole.collect(), more.schema)))
            for name, kpi in calculate_kpis(batch).items():
                assert_same(got[name], kpi)
            summary = spark.read.parquet(f"{current(spark, f'{folder}/out')}/summary_report")
            assert_same(summary.toDF("metric", "value"), summary_report(batch))
            stored = kpi_stream.stored_orders(spark, f"{folder}/store").drop("source_rows")
            assert_same(stored.select(batch.columns), batch)
    # At most a line that goes and one that comes for each of the 13 orders, whatever is stored.
    assert max(sizes) <= 26
    assert max(reads) <= 13 * 3
    assert sorted(os.listdir(f"{folder}/store/sums")) == ["000000008", "000000009"]


def test_lines_that_win_later_take_back_what_was_counted(spark, tmp_path):
    folder = str(tmp_path)
    df = put(spark, folder, {"amount": 50.0}, {"order_id": "O2", "amount": 70.0})
    follow(spark, folder, df.schema)
    put(spark, folder, {"amount": 20.0}, {"amount": 60.0}, {"order_id": "O2", "amount": 80.0})
    got = follow(spark, folder, df.schema)
    aov = ("average_order_value", "max_order_value", "min_order_value")
    assert values(got["aov"], *aov) == [(45.0, 70.0, 20.0)]
    changes = spark.read.parquet(f"{folder}/store/changes/stored_batch=1")
    assert sorted(values(changes, "order_key", "amount", "sign", "copies")) == [
        ("kO1", 20.0, 1, 3),
        ("kO1", 50.0, -1, -1),
        ("kO2", 70.0, 0, 1),
    ]
    kept = kpi_stream.stored_orders(spark, f"{folder}/store")
    assert sorted(values(kept, "order_id", "amount", "source_rows")) == [("O1", 20.0, 3), ("O2", 70.0, 2)]


def test_a_group_that_loses_its_last_order_is_gone(spark, tmp_path):
    folder = str(tmp_path)
    df = put(spark, folder, {"category": "Set"})
    follow(spark, folder, df.schema)
    put(spark, folder, {"category": "Kurta"})
    got = follow(spark, folder, df.schema)
    assert values(got["category_performance"], "category", "order_count") == [("Kurta", 1)]
    assert values(got["top_products"], "category") == [("Kurta",)]


def test_a_micro_batch_that_failed_is_folded_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    df = put(spark, folder, {"amount": 50.0})
    follow(spark, folder, df.schema)
    put(spark, folder, {"order_id": "O2", "amount": 5.0})

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(kpi_stream, "write_summary", broken)
        with pytest.raises(Exception, match="lost"):
            follow(spark, folder, df.schema)
    assert values(published_kpis(spark, f"{folder}/out")["aov"], "average_order_value") == [(50.0,)]
    got = follow(spark, folder, df.schema)
    assert values(got["aov"], "average_order_value") == [(27.5,)]
    assert sorted(got) == sorted(KPIS)


def test_an_id_without_end_is_one_line_per_micro_batch(spark, tmp_path):
    folder = str(tmp_path)
    many = orders(spark, {"order_id": None}).crossJoin(spark.range(20_000)).drop("id")
    many.repartition(2).write.parquet(f"{folder}/in")
    got = follow(spark, folder, many.schema, per_batch=10)
    assert values(got["promotion_impact"], "order_count", "total_revenue") == [(0, 100.0)]
    assert kpi_stream.stored_orders(spark, f"{folder}/store").first().source_rows == 20_000
    assert spark.read.parquet(f"{folder}/store/lines").count() == 1
    plan = batch_survivors(many)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan.split("Exchange")[1]
