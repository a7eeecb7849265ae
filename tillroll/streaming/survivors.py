"""The line that stays of each order, kept up to date while lines arrive.

Of the lines with one order id the smallest by all columns stays, whenever it
comes. A micro-batch is first reduced to its smallest line of each order, with
partial minima before the shuffle, so an id that comes without end is one line
per micro-batch. These lines are the state: a new one is compared with the
earlier ones of its order alone. One that beats them takes back the line that
stayed so far and takes its place, any other only counts as copies. What comes
out are these changes, and what they cost depends on the new lines, not on those
that are stored.

Lines without an id are one order, as in the batch job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_KEY = "order_key"
SIGN = "sign"
COPIES = "copies"


def batch_survivors(
    lines: DataFrame, key: str = "order_id", order_by: Sequence[str] = ()
) -> DataFrame:
    """(order_key, line, copies) of a micro-batch: the smallest line of each order, as a struct."""
    others = [*order_by, *[c for c in lines.columns if c != key and c not in order_by]]
    text = F.concat(F.lit("k"), F.col(f"`{key}`").cast("string"))
    line = F.struct(*[F.col(f"`{c}`") for c in (*others, key)])
    return lines.groupBy(F.coalesce(text, F.lit("")).alias(ORDER_KEY)).agg(
        F.min(line).alias("line"), F.count("*").alias(COPIES)
    )


def _copies(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + x[COPIES])


def survivor_changes(smallest: DataFrame) -> DataFrame:
    """The changes that a stream of `batch_survivors` makes, for a sink in update mode.

    The columns of the lines with `order_key`, `sign` (1 for a line that stays
    from now on, -1 for one that does so no more, 0 for one that goes on) and
    `copies`, the input lines that the change adds to it or, with it, takes away.
    """
    names = smallest.schema["line"].dataType.fieldNames()
    # The time of the micro-batch, which a repeated one has again.
    entry = F.struct("line", F.current_timestamp().alias("came"), COPIES)
    seen = smallest.select(ORDER_KEY, entry.alias("entry")).groupBy(ORDER_KEY)
    state = seen.agg(F.collect_list("entry").alias("all"), F.max("entry.came").alias("now"))
    state = state.withColumn("before", F.filter("all", lambda x: x["came"] < F.col("now")))
    state = state.select(
        ORDER_KEY,
        F.array_min("all")["line"].alias("best"),
        F.array_min("before")["line"].alias("stayed"),
        _copies(F.col("all")).alias("n"),
        _copies(F.col("before")).alias("n_before"),
        (F.size("before") > 0).alias("known"),
    )

    def change(line: str, sign: int, copies: Column) -> Column:
        return F.struct(F.col(line).alias("line"), F.lit(sign).alias(SIGN), copies.alias(COPIES))

    came = change("best", 1, F.col("n"))
    went = change("stayed", -1, -F.col("n_before"))
    same = change("best", 0, F.col("n") - F.col("n_before"))
    changes = (
        F.when(~F.col("known"), F.array(came))
        .when(F.col("best").eqNullSafe(F.col("stayed")), F.array(same))
        .otherwise(F.array(went, came))
    )
    return state.select(ORDER_KEY, F.explode(changes).alias("c")).select(
        *[F.col(f"c.line.`{n}`") for n in names], ORDER_KEY, f"c.{SIGN}", f"c.{COPIES}"
    )
