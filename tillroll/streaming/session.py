"""Session settings and sinks for streams."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.staging import delete

STREAM_CONF = {
    # State grows with keys, so it lives on disk and in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One busy user's events become sessions in each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Event times are UTC, and so are the days that windows make of them.
    "spark.sql.session.timeZone": "UTC",
    # Late rows are counted over all micro-batches of a run.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
}

# Each partition of a stateful operator is a state store of its own, and their number stays as
# it is for the life of a checkpoint, so it does not follow the batch setting upwards.
STATE_PARTITIONS = 200
_PARTITIONS = "spark.sql.shuffle.partitions"


class LateRows(RuntimeError):
    """Rows came after the watermark and are not in the result."""


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session on the same cluster with stream settings; the caller's stays as it is.

    Settings that the caller has made at run time hold here too, apart from the
    number of shuffle partitions, which is `state_partitions`, or the caller's if
    that is less than `STATE_PARTITIONS`.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    few = min(int(spark.conf.get(_PARTITIONS)), STATE_PARTITIONS)
    session.conf.set(_PARTITIONS, str(state_partitions or few))
    for name, value in STREAM_CONF.items():
        session.conf.set(name, value)
    return session


def finish(query: StreamingQuery, allow_late: bool) -> int:
    """Waits for the end; the number of rows that were too late for the watermark."""
    query.awaitTermination()
    late = sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
    if late and not allow_late:
        raise LateRows(f"{late} rows came after the watermark")
    return late


def drain_to_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    allow_late: bool = False,
) -> int:
    """Process all input that is there now, exactly once; the number of rows that were too late.

    Run again with the same checkpoint it goes on with what has arrived since.
    Late rows are an error unless `allow_late`; the other rows are stored then too.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )
    return finish(query, allow_late)


def drain_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Like `drain_to_parquet`, for an aggregate that is stored whole after each micro-batch."""

    def store(table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(path)

    query = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    finish(query, allow_late=False)


def batch_folder(path: str, batch_id: int) -> str:
    """Where a micro-batch is stored. A repeated one overwrites its own folder."""
    return f"{path}/stored_batch={batch_id}"


def drain_upserts(stream: DataFrame, path: str, checkpoint: str, key: list[str], day: str) -> None:
    """Keeps an aggregate up to date, of which a micro-batch gives the rows that have changed.

    The table is partitioned by `day`. Only the days of changed rows are written
    anew: with the changed rows, and with what else lies there. A micro-batch
    that is repeated writes the same days with the same rows.
    """
    spark = stream.sparkSession
    schema = stream.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            before = batch.sparkSession.read.schema(schema).parquet(path)
            days = changed.select(F.col(day).alias("_day")).distinct()
            same_day = F.col(day).eqNullSafe(F.col("_day"))
            new = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key]
            keys = changed.select(*[F.col(k).alias(f"_new_{k}") for k in key])
            rest = before.join(F.broadcast(days), same_day, "left_semi").join(
                keys, reduce(and_, new), "left_anti"
            )
            # Written aside first, as these days are read and replaced.
            aside = f"{path}-changes/{batch_id:09d}"
            rest.unionByName(changed).write.mode("overwrite").parquet(aside)
            merged = batch.sparkSession.read.schema(schema).parquet(aside)
            writer = merged.hint("rebalance", day).write.mode("overwrite").partitionBy(day)
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
            delete(spark, aside)
        finally:
            changed.unpersist()

    # So that there is a folder to read before the first micro-batch.
    none = spark.createDataFrame([], schema)
    none.write.mode("append").partitionBy(day).parquet(path)
    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    finish(query, allow_late=False)


_KEY, _DAY = "stored_key", "stored_day"
# The day of rows without a time.
_NO_DAY = "0001-01-01"


def _stored(schema: T.StructType) -> T.StructType:
    places = [
        T.StructField(_KEY, T.StringType()),
        T.StructField("stored_batch", T.LongType()),
        T.StructField(_DAY, T.DateType()),
    ]
    return T.StructType([*schema.fields, *places])


def key_digest(key: list[str]) -> Column:
    """A digest of the key's cells in which null is a value of its own."""

    def cell(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        size = F.octet_length(text).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[cell(k) for k in key]), 256)


def drain_unique(
    stream: DataFrame, path: str, checkpoint: str, key: list[str], time: str = "ts"
) -> None:
    """Stores each row once per `key`, whenever and however often it arrives.

    A repeat has the event time of its original, so a micro-batch is compared
    with the stored keys of its own days only. No state is kept and no row is too
    late. Of rows with one key in a micro-batch the smallest by all columns
    stays. Keys are compared by a digest in which nulls equal each other, and
    rows without a time have a day of their own, so they too are stored once.
    """
    others = [c for c in stream.columns if c not in key]
    first = Window.partitionBy(_KEY).orderBy(*(others or key))
    stored_schema = _stored(stream.schema)
    spark = stream.sparkSession
    # So that there is a folder to read before the first micro-batch.
    fields = [*stream.schema.fields, stored_schema[_KEY], stored_schema[_DAY]]
    none = spark.createDataFrame([], T.StructType(fields))
    none.write.mode("overwrite").partitionBy(_DAY).parquet(batch_folder(path, -1))

    def store(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.to_date(time), F.lit(_NO_DAY).cast("date"))
        dated = (
            batch.withColumn(_KEY, key_digest(key))
            .withColumn("_place", F.row_number().over(first))
            .filter("_place = 1")
            .withColumn(_DAY, day)
            .drop("_place")
        )
        known = (
            batch.sparkSession.read.schema(stored_schema)
            .parquet(path)
            .filter(F.col("stored_batch") < batch_id)
            .join(dated.select(_DAY).distinct(), _DAY, "left_semi")
        )
        fresh = dated.join(known.select(_KEY, _DAY), [_KEY, _DAY], "left_anti")
        writer = fresh.select(*batch.columns, _KEY, _DAY).write.mode("overwrite")
        writer.partitionBy(_DAY).parquet(batch_folder(path, batch_id))

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    finish(query, allow_late=False)


def read_unique(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `drain_unique` has stored, with the columns of the stream."""
    return spark.read.schema(_stored(schema)).parquet(path).select(*schema.fieldNames())
