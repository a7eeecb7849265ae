"""Streams against the same work in batch, late and repeated input, and restarts."""

import json
import os
from datetime import datetime, timedelta

import pytest
from check import assert_same
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from rows import orders, values

from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import settle
from tillroll.sources.star import table_stream
from tillroll.streaming import events, late
from tillroll.streaming import orders as order_stream
from tillroll.streaming.session import (
    STREAM_CONF,
    LateRows,
    drain_table,
    drain_to_parquet,
    drain_unique,
    drain_upserts,
    read_unique,
    stream_session,
)

NOON = datetime(2024, 1, 1, 12)


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def drained(spark, stream, folder):
    drain_to_parquet(stream, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows")


def put_events(spark, folder, *rows):
    """One file of (event_id, minutes after noon, user_id, value)."""
    data = [(e, NOON + timedelta(minutes=m), u, v) for e, m, u, v in rows]
    df = spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, value double")
    df.coalesce(1).write.mode("append").parquet(folder)


def event_stream(spark, folder):
    schema = "event_id long, ts timestamp, user_id long, value double"
    return stream_session(spark).readStream.schema(schema).parquet(folder)


def test_json_messages(spark):
    cells = [
        json.dumps({"Order_ID": "A1", "Amount": 5.5, "ship_state": "GOA", "extra": 1, "more": {"a": 2}}),
        json.dumps({"Order_ID": "A2", "Amount": "7.5"}),
        json.dumps({"Amount": 1}),
        "{broken",
        None,
    ]
    df = order_stream.parse_orders(spark.createDataFrame([(c,) for c in cells], "value string"))
    assert values(df, "order_id", "amount", "ship_state") == [
        ("A1", 5.5, "GOA"),
        ("A2", None, None),
        (None, 1.0, None),
        (None, None, None),
        (None, None, None),
    ]
    assert df.first().other_fields == {"extra": "1", "more": '{"a":2}'}
    # Whatever does not fit its type is kept as text.
    assert [r.malformed for r in df.collect()] == [None, cells[1], None, "{broken", None]


def test_message_bytes_are_text(spark):
    df = spark.createDataFrame([(b'{"Order_ID": "A1"}',)], "value binary")
    assert order_stream.parse_orders(df).first().order_id == "A1"


def test_own_schema_as_documented(spark):
    df = spark.createDataFrame([('{"Order_ID": "A1", "Amount": 2.0}',)], "value string")
    parsed = order_stream.parse_orders(df, "Order_ID string, Amount double")
    assert parsed.columns == ["order_id", "amount", "other_fields", "malformed"]


def test_order_stream_equals_batch(spark, tmp_path):
    df = orders(spark, {}, {"order_id": "O2", "amount": None, "ship_state": None}, {"b2b": "True"})
    inbox = str(tmp_path / "in")
    order_stream.as_messages(df).write.text(inbox)
    stream = order_stream.read_orders_stream(stream_session(spark), "text", {"path": inbox})
    got = drained(spark, order_stream.enrich_stream(stream), str(tmp_path))
    got = got.drop("other_fields", "malformed")
    assert_same(got, enrich_sales(settle(df)))


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    inbox = str(tmp_path / "in")
    for n in (1, 2):
        df = orders(spark, {"order_id": f"O{n}"})
        order_stream.as_messages(df).write.mode("append").text(inbox)
        stream = order_stream.read_orders_stream(stream_session(spark), "text", {"path": inbox})
        got = drained(spark, stream, str(tmp_path))
        assert sorted(r.order_id for r in got.collect()) == [f"O{i}" for i in range(1, n + 1)]


def test_kafka_options():
    assert order_stream.kafka_options("h:9092", "orders") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "orders",
        "startingOffsets": "latest",
    }
    more = order_stream.kafka_options("h:9092", "orders", "earliest", max_per_batch=10)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"]) == ("earliest", "10")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        order_stream.read_from_kafka(spark, "h:9092", "orders")


def test_stream_settings_stay_in_their_session(spark):
    session = stream_session(spark)
    for name, value in STREAM_CONF.items():
        assert session.conf.get(name) == value
        if "timeZone" not in name:
            assert spark.conf.get(name, None) != value
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"


def test_settings_of_the_caller_hold_in_streams(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "12345", "spark.sql.shuffle.partitions": "500000"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        session = stream_session(spark)
        assert session.conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
        assert session.conf.get("spark.sql.shuffle.partitions") == "200"
        assert stream_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path, salts):
    def kept():
        stream = event_stream(spark, str(tmp_path / "in"))
        return drained(spark, events.drop_repeats(stream, ["event_id"], salts=salts), str(tmp_path))

    put_events(spark, str(tmp_path / "in"), *[(1, 0, 7, 1.0)] * 50, (2, 1, 7, 2.0))
    assert sorted(r.event_id for r in kept().collect()) == [1, 2]
    put_events(spark, str(tmp_path / "in"), *[(1, 0, 7, 1.0)] * 50, (3, 2, 7, 3.0))
    assert sorted(r.event_id for r in kept().collect()) == [1, 2, 3]
    assert kept().columns == ["event_id", "ts", "user_id", "value"]


def test_every_day_is_there_and_stragglers_count(spark, tmp_path):
    inbox, day = str(tmp_path / "in"), 24 * 60

    def days():
        stream = events.daily_revenue(event_stream(spark, inbox))
        drain_table(stream, f"{tmp_path}/days", f"{tmp_path}/checkpoint")
        return sorted(values(spark.read.parquet(f"{tmp_path}/days"), "day", "purchases", "revenue"))

    put_events(spark, inbox, (1, 0, 7, 1.25), (2, 5, 8, 2.0), (3, day, 7, 5.0))
    assert days() == [(datetime(2024, 1, 1), 2, 3.25), (datetime(2024, 1, 2), 1, 5.0)]
    put_events(spark, inbox, (4, 10, 7, 100.0), (5, 3 * day, 8, 1.0))
    assert days() == [
        (datetime(2024, 1, 1), 3, 103.25),
        (datetime(2024, 1, 2), 1, 5.0),
        (datetime(2024, 1, 4), 1, 1.0),
    ]


def test_late_rows_are_reported(spark, tmp_path):
    inbox = str(tmp_path / "in")

    def drain(**more):
        sessions = events.purchase_sessions(event_stream(spark, inbox))
        return drain_to_parquet(sessions, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", **more)

    put_events(spark, inbox, (1, 0, 7, 1.0), (2, 6000, 7, 1.0))
    assert drain() == 0
    put_events(spark, inbox, (3, 1, 8, 1.0), (4, 6001, 7, 1.0))
    with pytest.raises(LateRows, match="1 row"):
        drain()
    put_events(spark, inbox, (5, 2, 8, 1.0), (6, 6002, 7, 1.0))
    assert drain(allow_late=True) == 1


def test_unique_rows_are_kept_however_late(spark, tmp_path):
    inbox = str(tmp_path / "in")

    def kept():
        stream = event_stream(spark, inbox)
        drain_unique(stream, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", ["event_id"])
        rows = read_unique(spark, f"{tmp_path}/rows", stream.schema)
        assert rows.columns == stream.columns
        return sorted(r.event_id for r in rows.collect())

    put_events(spark, inbox, (1, 5000, 7, 1.0), (2, 9000, 7, 2.0), (1, 5000, 7, 1.0))
    assert kept() == [1, 2]
    put_events(spark, inbox, (3, 0, 7, 3.0), (4, 9100, 7, 4.0), (1, 5000, 7, 1.0))
    assert kept() == [1, 2, 3, 4]


def test_rows_without_key_or_time_are_unique_too(spark, tmp_path):
    inbox = str(tmp_path / "in")
    schema = "event_id long, ts timestamp, user_id long, value double"
    rows = [(None, NOON, 7, 1.0), (5, None, 7, 2.0), (None, None, 8, 3.0), (6, NOON, 9, 4.0)]

    def kept():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = event_stream(spark, inbox)
        drain_unique(stream, f"{tmp_path}/rows", f"{tmp_path}/checkpoint", ["event_id"])
        return read_unique(spark, f"{tmp_path}/rows", stream.schema).collect()

    wanted = {(6, NOON), (5, None), (None, NOON)}
    for _ in range(3):
        got = kept()
        # The two rows without a key are one by their key, at a time or without.
        assert {(r.event_id, r.ts) for r in got} <= wanted | {(None, None)}
        assert len(got) == 3


def test_late_rows_lie_beside_the_others(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "split")

    def split():
        stream = event_stream(spark, inbox)
        late.drain_split(stream, path, f"{tmp_path}/c1")
        closed = events.purchase_sessions(
            late.on_time_stream(stream_session(spark), path, stream.schema)
        )
        return stream.schema, drained(spark, closed, f"{tmp_path}/closed")

    put_events(spark, inbox, (1, 0, 7, 1.0), (2, 2000, 8, 1.0))
    split()
    # One of user 7 joins the session that is closed, one is the first of user 9; one is in time.
    put_events(spark, inbox, (3, 100, 7, 2.0), (4, 5, 9, 4.0), (5, 1990, 8, 8.0), (6, 9000, 7, 1.0))
    schema, closed = split()
    ids = [
        sorted(r.event_id for r in read(spark, path, schema).collect())
        for read in (late.on_time, late.late)
    ]
    assert ids == [[1, 2, 5, 6], [3, 4]]
    got = late.repaired_sessions(spark, path, schema, closed)
    assert sorted(values(got, "user_id", "session_start", "purchases", "revenue", "is_open")) == [
        (7, NOON, 2, 3.0, False),
        (7, NOON + timedelta(minutes=9000), 1, 1.0, True),
        (8, NOON + timedelta(minutes=1990), 2, 9.0, False),
        (9, NOON + timedelta(minutes=5), 1, 4.0, False),
    ]


def test_only_changed_days_are_written(spark, tmp_path):
    inbox, path, day = str(tmp_path / "in"), str(tmp_path / "windows"), 24 * 60

    def files():
        stream = events.sliding_revenue(event_stream(spark, inbox), "2 hours", "1 hour")
        drain_upserts(stream, path, f"{tmp_path}/checkpoint", ["window_start"], "day")
        return {
            d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")
        }

    put_events(spark, inbox, (1, 0, 7, 1.0), (2, day, 7, 2.0), (3, 2 * day, 7, 4.0))
    before = files()
    put_events(spark, inbox, (4, day + 30, 7, 8.0), (5, day + 200, 7, 16.0))
    after = files()
    changed = {d for d in after if after[d] != before.get(d)}
    assert changed == {"day=2024-01-02"} and before.keys() == after.keys()
    hour = timedelta(hours=1)
    second = spark.read.parquet(path).filter("day = '2024-01-02'")
    at = NOON + timedelta(days=1)
    assert sorted(values(second, "window_start", "window_end", "purchases", "revenue")) == [
        (at - hour, at + hour, 2, 10.0),
        (at, at + 2 * hour, 2, 10.0),
        (at + 2 * hour, at + 4 * hour, 1, 16.0),
        (at + 3 * hour, at + 5 * hour, 1, 16.0),
    ]


def test_a_busy_user_is_spread_over_buckets(spark, no_broadcast):
    """Half the rows are of one user; the interval join deals them out by user and day."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 600).alias("ts"),
    )
    spans = rows.filter("user_id = 7").select(
        "user_id",
        F.col("ts").alias("session_start"),
        (F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("session_end"),
    )
    left = events.outside(rows, spans, "ts", "user_id", "session_start", "session_end")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 2 and all("/ 86400" in k or "_bucket" in k for k in keys)
    # Line 7 is of user 7 as well.
    assert left.count() == 9_999 and left.filter("user_id = 7").count() == 0


def test_rows_outside_all_spans(spark):
    def at(*minutes):
        return [NOON + timedelta(minutes=m) for m in minutes]

    rows = [(1, t) for t in at(0, 59, 60, 3000)] + [(None, NOON), (2, NOON), (1, None)]
    spans = [(1, *at(0, 60)), (1, *at(2000, 2900)), (None, *at(-10_000, 1)), (2, *at(1, 2))]
    got = events.outside(
        spark.createDataFrame(rows, "k int, t timestamp"),
        spark.createDataFrame(spans, "k int, a timestamp, b timestamp"),
        "t", "k", "a", "b",
    )
    assert sorted(values(got, "k", "t"), key=str) == sorted(
        [(1, None), (1, at(60)[0]), (1, at(3000)[0]), (2, NOON)], key=str
    )


def test_open_sessions_are_there(spark, tmp_path):
    inbox = str(tmp_path / "in")
    put_events(spark, inbox, (1, 0, 7, 1.0), (2, 30, 7, 1.0), (3, 900, 8, 9.0), (4, 910, 7, 2.0))
    stored = drained(spark, event_stream(spark, inbox), f"{tmp_path}/a")
    closed = drained(spark, events.purchase_sessions(event_stream(spark, inbox)), f"{tmp_path}/b")
    found = events.with_open(stored, closed)
    assert sorted(values(found, "user_id", "purchases", "is_open")) == [
        (7, 1, True),
        (7, 2, False),
        (8, 1, True),
    ]


def test_a_backlog_is_worked_off_in_steps(spark, tmp_path):
    os.makedirs(tmp_path / "events.parquet")
    for n in range(5):
        put_events(spark, str(tmp_path / "events.parquet"), (n, n, 7, 1.0))
    session = stream_session(spark)
    stream = table_stream(session, str(tmp_path), "events", files_per_batch=2)
    sizes = []
    query = (
        stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sum(sizes) == 5 and max(sizes) == 2


def test_sessions_join_across_batches_and_split_at_the_gap(spark, tmp_path):
    inbox = str(tmp_path / "in")
    put_events(spark, inbox, (1, 0, 7, 1.0), (2, 30, 7, 1.0), (3, 0, 8, 9.0))
    drained(spark, events.purchase_sessions(event_stream(spark, inbox)), str(tmp_path))
    put_events(spark, inbox, (4, 200, 7, 1.0), (5, 200 + 241, 7, 1.0), (6, 3000, 9, 1.0))
    got = drained(spark, events.purchase_sessions(event_stream(spark, inbox)), str(tmp_path))
    assert sorted(values(got, "user_id", "session_start", "session_end", "purchases")) == [
        (7, NOON, NOON + timedelta(minutes=200 + 240), 3),
        (7, NOON + timedelta(minutes=441), NOON + timedelta(minutes=441 + 240), 1),
        (8, NOON, NOON + timedelta(minutes=240), 1),
    ]


def test_a_busy_user_is_merged_before_the_shuffle(spark, tmp_path, capfd):
    inbox = str(tmp_path / "in")
    put_events(spark, inbox, *[(i, i % 50, 7 if i % 3 else i, 1.0) for i in range(300)])
    put_events(spark, inbox, (1000, 5000, 1, 1.0))
    sessions = events.purchase_sessions(event_stream(spark, inbox))
    sessions.explain()
    after, before = capfd.readouterr().out.split("Exchange hashpartitioning(user_id")
    assert "MergingSessions" in after and "MergingSessions" in before
    got = drained(spark, sessions, str(tmp_path))
    assert values(got.filter("user_id = 7"), "purchases", "revenue") == [(200, 200.0)]


def test_days_are_utc_days_in_any_session(spark, tmp_path):
    zone = "spark.sql.session.timeZone"
    spark.conf.set(zone, "Asia/Kolkata")
    try:
        purchases = events.read_purchases(stream_session(spark), "/root/testdata/sf0.001")
        drain_table(events.daily_revenue(purchases), f"{tmp_path}/days", f"{tmp_path}/checkpoint")
        days = spark.read.parquet(f"{tmp_path}/days")
        wanted = spark.sql(
            "SELECT to_date(ts) AS day, count(*) AS purchases"
            " FROM parquet.`/root/testdata/sf0.001/events.parquet`"
            " WHERE event_type = 'purchase' GROUP BY 1"
        )
        got = days.selectExpr("to_date(day) AS day", "purchases")
        assert got.count() == 30 and got.exceptAll(wanted).count() == 0
    finally:
        spark.conf.set(zone, "UTC")


def test_lines_of_an_order_end_up_together(spark, sf_dir):
    from pyspark.sql import functions as F

    from tillroll.sources.star import flatten, table

    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        flat = flatten(spark, sf_dir, table(spark, sf_dir, "lineitem"), ["order_id", "category", "status"])
        placed = flat.filter("order_id is not null").withColumn("part", F.spark_partition_id())
        places = placed.groupBy("order_id").agg(F.count_distinct("part").alias("n"))
        assert places.agg(F.max("n")).first()[0] == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_messages_are_stored_compressed(spark, sf_dir):
    from pathlib import Path

    import __spark_entry__ as entry

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("messages-*/part-*"))
    entry.stream_json_ingest(spark, sf_dir)
    files = set(shared.glob("messages-*/part-*")) - before
    assert files and all(f.name.endswith(".gz") for f in files)
