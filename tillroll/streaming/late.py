"""Rows that come behind the watermark, kept beside the others.

A stateful operator drops rows that are later than its delay. Here rows are
stored before such an operator sees them, and split: a row is late if its time
is before the latest time of all earlier micro-batches less the delay. The
operator then reads the rows on time, of which none is too late for it, as its
watermark follows the same rows. The late ones wait for a repair run. Rows
without a time are neither; they lie with the late ones, as no window has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.streaming.events import DELAY, SESSION_GAP, sessions_of, with_open
from tillroll.streaming.session import batch_folder, finish


def _marks(path: str) -> str:
    return f"{path}/marks"


def latest_time(spark: SparkSession, path: str, before_batch: int | None = None):
    """The latest event time of the micro-batches that are stored, or of those before one."""
    schema = "latest timestamp, stored_batch bigint"
    try:
        marks = spark.read.schema(schema).parquet(f"{_marks(path)}/*")
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    if before_batch is not None:
        marks = marks.filter(F.col("stored_batch") < before_batch)
    return marks.agg(F.max("latest")).first()[0]


def drain_split(
    stream: DataFrame, path: str, checkpoint: str, time: str = "ts", delay: str = DELAY
) -> None:
    """Stores all rows of the stream, once each, apart as on time and late."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = latest_time(spark, path, batch_id)
        mark = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.col(time).isNull() | F.coalesce(F.col(time) < mark, F.lit(False))
        for flag, name in ((False, "on_time"), (True, "late")):
            rows = batch.filter(late if flag else ~late)
            rows.write.mode("overwrite").parquet(batch_folder(f"{path}/{name}", batch_id))
        ahead = spark.read.parquet(batch_folder(f"{path}/on_time", batch_id))
        of_batch = ahead.agg(F.max(time).cast("timestamp").alias("latest"))
        numbered = of_batch.withColumn("stored_batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{_marks(path)}/{batch_id:09d}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    finish(query, allow_late=False)


def _rows(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{name}/stored_batch=*")


def on_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _rows(spark, path, "on_time", schema)


def late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _rows(spark, path, "late", schema)


def on_time_stream(session: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows on time as a stream. It takes whole micro-batches, so none is late twice."""
    return session.readStream.schema(schema).parquet(f"{path}/on_time/stored_batch=*")


def repaired_sessions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    closed: DataFrame,
    gap: str = SESSION_GAP,
    delay: str = DELAY,
    time: str = "ts",
) -> DataFrame:
    """All sessions, late rows included, marked `is_open` as the watermark has it.

    Only users with late rows are computed anew, of their rows on time and late;
    the closed sessions of all others stay as the stream has made them.
    """
    behind = late(spark, path, schema).filter(F.col(time).isNotNull())
    users = behind.select("user_id").distinct()
    ahead = on_time(spark, path, schema)

    def touched(df: DataFrame, how: str) -> DataFrame:
        same = df["user_id"].eqNullSafe(users["user_id"])
        return df.join(users, same, how)

    anew = sessions_of(touched(ahead, "left_semi").unionByName(behind), gap)
    mark = F.lit(latest_time(spark, path)).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    is_open = F.col("session_end") > mark.cast("timestamp_ntz")
    others = with_open(touched(ahead, "left_anti"), touched(closed, "left_anti"), gap)
    return others.unionByName(anew.withColumn("is_open", F.coalesce(is_open, F.lit(True))))
