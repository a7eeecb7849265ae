"""Money and number expressions.

Money is summed as a decimal: a double sum depends on the order in which
partitions are merged, a decimal sum does not, so reruns, retries and other
partition counts give the same cents. Amounts that such a decimal cannot hold
(from 1e20 up, or so small that ten decimals are too few) are summed as doubles
beside it, so no amount is left out and none ends the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(30,10)"
WIDE = "decimal(38,6)"
# A decimal stands for an amount if it is as near as this part of it.
_NEAR = 1e-9

_EXPONENT_NUMBER = r"^[+-]?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+$"


def two_places(value: Column) -> Column:
    """Half-up to two decimals, the same in any engine, as a double.

    What is too large for a decimal has no decimals to round.
    """
    rounded = F.round(value.try_cast(WIDE), 2).cast("double")
    return F.coalesce(rounded, value.cast("double"))


def exact_part(amount: Column, kind: str = MONEY) -> Column:
    """`amount` as a decimal, null if it is not one that `kind` holds."""
    held = amount.try_cast(kind)
    near = F.abs(held.cast("double") - amount) <= F.abs(amount) * _NEAR
    return F.when(near, held)


def rest_part(amount: Column) -> Column:
    """`amount` as a double where `exact_part` is null."""
    return F.when(exact_part(amount).isNull(), amount.cast("double"))


def total(exact: Column, rest: Column) -> Column:
    """The sum of both parts over a group, as a double; null if both are always null.

    A decimal sum that is too large even so is taken as a sum of doubles.
    """
    decimals = F.coalesce(F.try_sum(exact).cast("double"), F.sum(exact.cast("double")))
    doubles = F.sum(rest)
    return F.when(doubles.isNull(), decimals).otherwise(F.coalesce(decimals, F.lit(0.0)) + doubles)


def cents(amount: Column) -> Column:
    """A sum as a double with two decimals."""
    return two_places(amount)


def money_sum(name: str) -> Column:
    amount = F.col(name).cast("double")
    return cents(total(exact_part(amount), rest_part(amount)))


def percent(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole` to two places, null where `whole` is 0 or null."""
    return two_places(F.try_divide(part.cast("double"), whole.cast("double")) * 100)


def number_from_text(text: Column) -> Column:
    """The number in a money text such as ``INR 1,234.50``.

    Blank is null, everything but digits, point and minus is dropped, and what
    is still no number is null. Text in exponent form already is a number, and
    dropping its ``E`` would change it, so it is cast as it stands. A number
    beyond all doubles (``1e400``) is none.
    """
    bare = F.trim(text)
    number = F.when(bare.rlike(_EXPONENT_NUMBER), bare).otherwise(
        F.regexp_replace(text, "[^0-9.-]", "")
    )
    value = number.try_cast("double")
    return F.when((bare != "") & (F.abs(value) < float("inf")), value)


def normalise_numeric(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Text columns among `columns` to double; typed columns are right already.

    A name that `df` lacks is skipped, or with `strict` left to fail on analysis.
    """
    wanted = list(columns)
    present = [c for c in wanted if c in df.columns]
    if strict and len(present) < len(wanted):
        df.select(*wanted)
    text = [c for c in present if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: number_from_text(F.col(c)) for c in text})
