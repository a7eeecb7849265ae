"""Results that are replaced as a whole.

Every job writes into a folder of its own below `versions`. Only when all of it
is there does an entry in `published` name it; the greatest entry is the current
version. An entry is one small file that a commit moves into place, so readers
see a version with all of its tables, or the one before. A job that ends midway
leaves no entry.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from tillroll.staging import delete, names_in

T = TypeVar("T")

KEEP = 2


def _entries(output: str) -> str:
    return f"{output}/published"


def _published(spark: SparkSession, output: str) -> list[str]:
    """The names of complete versions, the oldest first."""
    entries = names_in(spark, _entries(output))
    if not entries:
        return []
    # An entry of a job that is being written, or was retired meanwhile, has no file.
    read = spark.read.option("ignoreMissingFiles", True).text(
        [f"{_entries(output)}/{e}" for e in entries]
    )
    return sorted(r.value for r in read.collect())


def current(spark: SparkSession, output: str) -> str | None:
    """The folder of the version that was published last, None before the first."""
    names = _published(spark, output)
    return f"{output}/versions/{names[-1]}" if names else None


def publish(
    spark: SparkSession, output: str, write: Callable[[str], T], keep: int = KEEP
) -> T:
    """Calls `write` with a new version's folder and then makes that the current one.

    The last `keep` versions stay for readers that have begun with them; older
    ones and what failed jobs have left go. Jobs publish one after another, as
    only one at a time can own an output.
    """
    before = _published(spark, output)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    name = f"{number:09d}-{uuid.uuid4().hex}"
    result = write(f"{output}/versions/{name}")
    entry = spark.createDataFrame([(name,)], "version string").coalesce(1)
    entry.write.text(f"{_entries(output)}/{name}")
    stay = {*before[max(0, len(before) + 1 - keep) :], name} if keep > 1 else {name}
    for folder in ("published", "versions"):
        for old in names_in(spark, f"{output}/{folder}"):
            if old not in stay and old[:1].isdigit():
                delete(spark, f"{output}/{folder}/{old}")
    return result
