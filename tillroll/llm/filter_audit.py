"""What each of five filters removes in every order, by truth-table survival words.

A document fails some of the filters; of their 32 subsets it survives those that
have none of these. Bit S of its survival word tells whether it survives subset
S. Counting each bit over the words of a part, and over those of its labelled
documents, gives every subset's survivors, and from these follow kept, removed,
redundant and lost documents for all 120 orders without a look at the documents.

Words are counted by carry-save adders: three words of one weight become a sum
and a carry word, until a word is left for each binary digit of the 32 counts.
Every task sends its counts per part and label, never its documents.

Fixed meanings: A under 50 words, B under 65 % distinct words, C over 5 % of the
code points A-Z, D any of ``#$%&*|``, E equal to the text of a smaller id
anywhere in the table. Null texts are empty, and empty texts equal each other;
they fail A. Texts of any length are counted whole. Rows without id are never
smaller than others and have none smaller; rows of one id do not remove each
other. Null sources are the part ``''``, together with empty ones. A label
counts if any row of `labels` for the id has it. An empty table has no parts
and no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SMALL_ROWS, blocks, raw_texts, rows, slices, small, stored

# The filters' limits and characters.
LEAST_WORDS = 50
LEAST_DISTINCT_PCT = 65
MOST_UPPER_PCT = 5
MARKS = re.compile(rb"[#$%&*|]")

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
KINDS = ("all", "good", "toxic")
_UPPER = bytes(range(65, 91))
_NEXT = bytes(range(0x80, 0xC0))
_REPEATED = 1 << FILTERS.index("E")
# A task sends its counts once it holds those of so many parts.
_MOST_PARTS = 4096
# Copies of a text up to this number go to one task.
_FEW_COPIES = 1000


def survival_words() -> np.ndarray:
    """The survival word of every set of failed filters."""
    words = [sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)]
    return np.array(words, dtype=np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of `words` have each bit set, by carry-save addition."""
    counts = np.zeros(SUBSETS, dtype=np.int64)
    positions, weight = np.arange(SUBSETS, dtype=np.uint32), 1
    while len(words):
        carries = []
        while len(words) > 1:
            third = max(1, len(words) // 3)
            a, b = words[:third], words[third : 2 * third]
            c = words[2 * third : 3 * third] if len(words) >= 3 else np.zeros(1, np.uint32)
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third :]])
        counts += weight * ((words[0] >> positions) & 1).astype(np.int64)
        words, weight = np.concatenate([np.empty(0, np.uint32), *carries]), weight * 2
    return counts


def failures(raw: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    n, distinct = 0, set()
    for block in blocks(raw):
        words = block.split()
        n += len(words)
        distinct.update(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    points = len(raw.translate(None, _NEXT))
    failed = (
        n < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT_PCT * n,
        100 * upper > MOST_UPPER_PCT * points,
        MARKS.search(raw) is not None,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, failed) of each row: the text's digest, and filters A to D."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = raw_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array([blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                    pa.array([failures(t) for t in texts], pa.int32()),
                ],
                names=["doc_id", "part", "digest", "failed"],
            )

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    texts = docs.select("doc_id", part, F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, part string, digest binary, failed int")


def mark_repeats(found: DataFrame) -> DataFrame:
    """`found` with the bit of E set where a smaller id has the same digest.

    Only digests that occur twice or more are looked up. Those of very many rows
    are told by a table that has fewer than `SMALL_ROWS` rows by their share of
    all, so that no task gets such a group; all others are small groups.
    """
    groups = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1"), "audit-copies")
    most = max(_FEW_COPIES, found.count() // SMALL_ROWS)
    hot = F.broadcast(groups.filter(F.col("n") > most).drop("n"))
    cool = small(stored(groups.filter(F.col("n") <= most).drop("n"), "audit-few-copies"))
    told = found.join(hot, "digest").unionByName(
        found.join(hot, "digest", "left_anti").join(cool, "digest", "left")
    )
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return told.withColumn("failed", F.col("failed") + F.when(later, _REPEATED).otherwise(0))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task per (part, kind)."""
    words, held = survival_words(), {}

    def sent():
        parts, kinds = zip(*held, strict=True)
        columns = [
            pa.array(parts, pa.string()),
            pa.array(kinds, pa.string()),
            pa.array([c.tolist() for c in held.values()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["part", "kind", "counts"])

    for batch in batches:
        of_group = {}
        for part, kind, failed in rows(batch, "part", "kind", "failed"):
            of_group.setdefault((part, kind), []).append(failed)
        for key, failed in of_group.items():
            counts = positional_counts(words[failed])
            held[key] = held[key] + counts if key in held else counts
        if len(held) > _MOST_PARTS:
            yield sent()
            held.clear()
    if held:
        yield sent()


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, all, good, toxic): survivors of each subset of filters, 32 numbers each."""
    found = mark_repeats(stored(judged(docs), "audit-rows"))
    marked = stored(found.select("doc_id", "part", "failed"), "audit-marks")
    of_id = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    labelled = marked.join(of_id, "doc_id")

    def words(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select("part", F.lit(kind).alias("kind"), "failed")

    streams = [words(marked, "all")]
    streams += [words(labelled.filter(kind), kind) for kind in KINDS[1:]]
    every = streams[0].unionByName(streams[1]).unionByName(streams[2])
    counts = every.mapInArrow(_count_words, "part string, kind string, counts array<bigint>")
    sums = (
        counts.select("part", "kind", F.posexplode("counts").alias("subset", "n"))
        .groupBy("part", "kind", "subset")
        .agg(F.sum("n").alias("n"))
    )
    # 32 numbers per part and kind.
    lists = sums.groupBy("part", "kind").agg(
        F.array_sort(F.collect_list(F.struct("subset", "n"))).alias("by_subset")
    )
    zeros = F.array_repeat(F.lit(0).cast("bigint"), SUBSETS)
    return lists.groupBy("part").agg(
        *[
            F.coalesce(F.max(F.when(F.col("kind") == k, F.col("by_subset.n"))), zeros).alias(k)
            for k in KINDS
        ]
    )


def _steps() -> Column:
    """One entry per order of the filters and step in it."""
    entries = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            name = "".join(FILTERS[i] for i in order)
            entries.append((name, step, f, 1 << f, before, before | 1 << f))
            before |= 1 << f
    names = ("filter_order", "step", "filter", "bit", "before", "after")
    spelt = json.dumps([dict(zip(names, e, strict=True)) for e in entries])
    kind = "filter_order: string, step: int, filter: int, bit: int, before: int, after: int"
    return F.from_json(F.lit(spelt), f"array<struct<{kind}>>")


def _shapley(f: int) -> Column:
    """What filter `f` removes, summed over all orders."""
    total, count = F.lit(0).cast("bigint"), len(FILTERS)
    for s in range(SUBSETS):
        if not s >> f & 1:
            size = bin(s).count("1")
            orders = factorial(size) * factorial(count - 1 - size)
            total += orders * (F.col("all")[s] - F.col("all")[s | 1 << f])
    return total


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of filters and step, with counts of documents."""
    counted = stored(survivors(docs, labels), "audit-survivors")
    worth = F.array(*[_shapley(f) for f in range(len(FILTERS))]).alias("worth")
    at = counted.select("*", worth, F.explode(_steps()).alias("s")).select("*", "s.*")
    bit, whole = F.col("bit"), F.lit(SUBSETS - 1)

    def of(kind: str, subset: str | Column) -> Column:
        return F.get(kind, subset)

    def gone(kind: str) -> Column:
        return of(kind, "before") - of(kind, "after")

    failing = of("all", F.lit(0)) - of("all", bit)
    return at.select(
        "part",
        "filter_order",
        "step",
        of("all", "after").alias("kept"),
        gone("all").alias("removed"),
        (failing - gone("all")).alias("redundant"),
        (of("all", whole - bit) - of("all", whole)).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.get("worth", "filter").alias("shapley"),
    )
