"""Event-time operators over the purchase stream.

`delay` is how late an event may arrive for the operators that forget: what comes
later is counted by `session.drain_to_parquet`, which raises unless told to go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import money_sum
from tillroll.sources.star import table_stream

DELAY = "1 hour"
SESSION_GAP = "4 hours"
# Seconds of a bucket of the interval join.
BUCKET = 86_400
SLIDING_WIDTH = "6 hours"
SLIDING_STEP = "2 hours"
SALTS = 4


def read_purchases(spark: SparkSession, data_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """Purchases as a stream, for a `stream_session`."""
    return (
        table_stream(spark, data_dir, "events", files_per_batch)
        .filter("event_type = 'purchase'")
        .select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    )


def daily_revenue(purchases: DataFrame) -> DataFrame:
    """Revenue of every day so far, for `session.drain_table`: the state is one row per day."""
    return (
        purchases.groupBy(F.window("ts", "1 day").alias("day"))
        .agg(F.count("*").alias("purchases"), money_sum("value").alias("revenue"))
        .select(F.col("day.start").cast("timestamp_ntz").alias("day"), "purchases", "revenue")
    )


def drop_repeats(
    events: DataFrame, key: Sequence[str], delay: str = DELAY, salts: int = SALTS
) -> DataFrame:
    """One row per key among those that arrive within `delay` of each other.

    Keys are forgotten after `delay`, so the state does not grow with the stream;
    where no row may be lost, use `session.drain_unique`. With `salts` the copies
    of a key are first thinned out by that many tasks, for streams where one key
    can be repeated without end; the second pass then sees at most `salts` rows of it. Which task a copy goes to does not matter.
    """
    timed = events.withWatermark("ts", delay)
    if salts > 1:
        salt = F.floor(F.rand() * salts).cast("int")
        timed = (
            timed.withColumn("_salt", salt)
            .dropDuplicatesWithinWatermark([*key, "_salt"])
            .drop("_salt")
        )
    return timed.dropDuplicatesWithinWatermark(list(key))


def sessions_of(purchases: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Runs of one user's purchases with less than `gap` between them."""
    return (
        purchases.groupBy("user_id", F.session_window("ts", gap).alias("session"))
        .agg(F.count("*").alias("purchases"), money_sum("value").alias("revenue"))
        .select(
            "user_id",
            F.col("session.start").cast("timestamp_ntz").alias("session_start"),
            F.col("session.end").cast("timestamp_ntz").alias("session_end"),
            "purchases",
            "revenue",
        )
    )


def purchase_sessions(
    purchases: DataFrame, gap: str = SESSION_GAP, delay: str = DELAY
) -> DataFrame:
    """The runs of a stream, once they are closed."""
    return sessions_of(purchases.withWatermark("ts", delay), gap)


def outside(
    rows: DataFrame, spans: DataFrame, time: str, key: str, start: str, stop: str, bucket: int = BUCKET
) -> DataFrame:
    """The rows whose time lies in none of their key's spans, from `start` up to before `stop`.

    An interval join by buckets of `bucket` seconds: a span is there once for
    each bucket that it meets, so a row is compared with the spans of its key
    and bucket alone, and a key with very many of both is spread over tasks.
    Rows and spans without a key belong together; a row without a time is outside.
    """

    def number(at: Column) -> Column:
        seconds = F.unix_seconds(at.cast("timestamp"))
        return F.floor(seconds / bucket).cast("bigint")

    buckets = F.sequence(number(F.col(start)), number(F.col(stop)))
    met = spans.select(
        F.col(key).alias("_key"),
        F.col(start).cast("timestamp").alias("_start"),
        F.col(stop).cast("timestamp").alias("_stop"),
        F.explode(buckets).alias("_bucket"),
    )
    at = F.col(time).cast("timestamp")
    within = (
        F.col(key).eqNullSafe(F.col("_key"))
        & (number(F.col(time)) == F.col("_bucket"))
        & (at >= F.col("_start"))
        & (at < F.col("_stop"))
    )
    return rows.join(met, within, "left_anti")


def with_open(stored: DataFrame, closed: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Closed sessions and, marked `is_open`, those of the stored purchases in none of them."""
    left = outside(stored, closed, "ts", "user_id", "session_start", "session_end")
    return closed.withColumn("is_open", F.lit(False)).unionByName(
        sessions_of(left, gap).withColumn("is_open", F.lit(True))
    )


def sliding_revenue(
    purchases: DataFrame, width: str = SLIDING_WIDTH, step: str = SLIDING_STEP
) -> DataFrame:
    """Purchases and revenue of overlapping windows, for `session.drain_upserts`.

    `day` is the day that a window starts on, by which the result is stored.
    """
    return (
        purchases.groupBy(F.window("ts", width, step).alias("w"))
        .agg(F.count("*").alias("purchases"), money_sum("value").alias("revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "purchases",
            "revenue",
            F.to_date("w.start").alias("day"),
        )
    )
