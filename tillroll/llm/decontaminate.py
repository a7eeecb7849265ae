"""Benchmark passages in documents, by winnowed fingerprints.

Words are runs of a-z (A-Z lower-cased), digits and characters beyond ASCII. A
window is ten words in a row of a benchmark item, or all words of an item that
has fewer. A document's word is hit if it lies in an occurrence of a window.

Of each window the least hash of its five-word runs is the fingerprint, the
first of equal ones. A passage shared by a document and an item is cut into the
same windows on both sides, each with the same fingerprint, so none of ten words
or more goes unseen. Windows of n < 10 words have runs of min(n, 5) words and
are cut for each n that occurs among the items.

The items' fingerprints make a bitmap of bounded size, and document windows
whose fingerprint is in it are the hits; a full bitmap lets more through and
drops none. A hit is extended over its window: the hit's fingerprint and a
128-bit hash of all the window's words are joined with those of the items. So a
phrase in many items meets one row for each different window, never all items;
items are told per set of windows that some document has. Hits that overlap
become spans.

Null texts and texts without a word have no windows; an item without words is
never found. Very long texts are read in blocks and give several staged rows.
Every row of `docs` is a document of its own, also with an id that others have
or none. Items are told by id: rows of one id are one item, and those without id
hit words but are not listed. Empty tables give empty results or no hits. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import blocks, raw_texts, set_aside, slices, small, stored

WINDOW = 10
GRAM = 5
# Bits of the bitmap for each fingerprint of an item, and the most in all (64 MB).
BITS_EACH = 16
MOST_BITS = 1 << 29
_BUCKET = 1 << 15
_BATCH = 1 << 20

# The bytes of words, after A-Z became a-z.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_ODD = 0x9E3779B97F4A7C15
_HITS = "array<struct<start: bigint, n: int, mark: bigint, digest: binary>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scattered by two rounds of shift and product."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of some texts: a hash and a text number for each, and their bytes."""

    def __init__(self, texts: list[bytes]):
        low = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
        inside = _WORD[low]
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            turns = np.concatenate([[0], turns])
        starts, ends = turns[::2], turns[1::2]
        # A byte sum with powers of an odd number; taking the start's power back makes it the word's.
        sums = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum(_OF_BYTE[low] * _powers(_ODD, len(low)), out=sums[1:])
        back = _powers(pow(_ODD, -1, 1 << 64), len(low))[starts]
        self.hashes = _mixed((sums[ends] - sums[starts]) * back)
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.text = np.searchsorted(np.cumsum(sizes), starts, side="right")
        self.first = np.searchsorted(self.text, np.arange(len(texts)))
        self.count = np.bincount(self.text, minlength=len(texts))
        self._low, self._inside, self._starts, self._ends = low, inside, starts, ends

    def spelt(self, at: np.ndarray, n: int) -> list[bytes]:
        """The words from each of `at` on, `n` of them, joined by one space."""
        if not len(at):
            return []
        keep = self._inside.copy()
        keep[self._ends] = True
        joined = np.where(self._inside, self._low, np.uint8(32))[keep].tobytes()
        place = np.concatenate([[0], np.cumsum(self._ends - self._starts + 1)])
        spans = zip(place[at].tolist(), place[at + n].tolist(), strict=True)
        return [joined[lo : hi - 1] for lo, hi in spans]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of each window of `n` words within one text."""
        gram = min(n, GRAM)
        count = len(self.hashes) - n + 1
        if count < 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        runs = np.zeros(len(self.hashes) - gram + 1, dtype=np.uint64)
        for power, j in zip(_powers(_ODD, gram), range(gram), strict=True):
            runs += self.hashes[j : j + len(runs)] * power
        runs = _mixed(runs)
        least = runs[:count].copy()
        for j in range(1, n - gram + 1):
            np.minimum(least, runs[j : j + count], out=least)
        whole = np.flatnonzero(self.text[:count] == self.text[n - 1 :])
        return whole, least[whole]


def _digests(spelt: list[bytes]) -> list[bytes]:
    return [blake2b(s, digest_size=16).digest() for s in spelt]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """(rows, texts, words before each): short texts together, long ones in blocks.

    A block is led by the last words of the one before, so every window lies in
    one; the number of words before it counts those out.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        if len(text) > 4 * _BATCH:
            tail, before = b"", 0
            for block in blocks(text):
                block = tail + block
                yield [row], [block], [before]
                words = Words([block])
                again = np.arange(max(0, len(words.hashes) - WINDOW + 1), len(words.hashes))
                tail = b" ".join(words.spelt(again, 1)) + b" "
                before += len(words.hashes) - len(again)
            continue
        held.append(row)
        size += len(text)
        if size > _BATCH:
            yield held, [texts[r] for r in held], [0] * len(held)
            held, size = [], 0
    if held:
        yield held, [texts[r] for r in held], [0] * len(held)


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, n, mark, digest) of each window of each item; `mark` is the fingerprint."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("item_id")
            for held, texts, _ in _pieces(raw_texts(batch.column("text"))):
                words = Words(texts)
                # A block of a long text has more words than a window.
                size = np.minimum(words.count, WINDOW)
                for n in np.unique(size[size > 0]).tolist():
                    at, marks = words.windows(n)
                    mine = size[words.text[at]] == n
                    at, marks = at[mine], marks[mine]
                    of = np.array(held)[words.text[at]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(of)),
                            pa.array(np.full(len(at), n, np.int32)),
                            pa.array(marks.view(np.int64)),
                            pa.array(_digests(words.spelt(at, n)), pa.binary()),
                        ],
                        names=["item_id", "n", "mark", "digest"],
                    )

    texts = items.select("item_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"item_id {kind}, n int, mark bigint, digest binary")


class Marks:
    """Tells fingerprints that some item may have."""

    def __init__(self, flags: np.ndarray):
        self.flags, self.bits = flags, np.uint64(len(flags) * 8)

    def __call__(self, marks: np.ndarray) -> np.ndarray:
        spot = marks % self.bits
        return (self.flags[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1) > 0


def item_marks(windows: DataFrame, most_bits: int = MOST_BITS):
    """A broadcast bitmap of the items' fingerprints, made by aggregation in buckets."""
    distinct = windows.select("mark").distinct()
    bits = _BUCKET
    while bits < min(most_bits, distinct.count() * BITS_EACH):
        bits *= 2
    # Sizes are powers of two, so the lowest bits are the remainder, also of negative numbers.
    place = F.col("mark").bitwiseAND(bits - 1) + 1
    buckets = distinct.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    flags = np.zeros((bits // _BUCKET, _BUCKET // 8), dtype=np.uint8)
    for r in buckets.toLocalIterator():
        flags[r.bucket - 1] = np.frombuffer(r.bits, dtype=np.uint8)
    return windows.sparkSession.sparkContext.broadcast(Marks(flags.reshape(-1)))


def _candidates(known, sizes: list[int]):
    """Rows of (row, doc_id, n_words, hits); a long text gives several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks_of_items = known.value
        for batch in slices(batches):
            for held, texts, before in _pieces(raw_texts(batch.column("text"))):
                words, before = Words(texts), np.array(before)
                found = []
                for n in sizes:
                    at, marks = words.windows(n)
                    hit = marks_of_items(marks)
                    at, marks = at[hit], marks[hit]
                    found.append((at, np.full(len(at), n), marks, _digests(words.spelt(at, n))))
                at, n, marks = (np.concatenate(c) for c in list(zip(*found, strict=True))[:3])
                digests = np.array([d for f in found for d in f[3]] + [None], dtype=object)[:-1]
                order = np.argsort(at, kind="stable")
                text = words.text[at[order]]
                start = at[order] - words.first[text] + before[text]
                again = np.where(before > 0, WINDOW - 1, 0)
                hits = pa.StructArray.from_arrays(
                    [
                        pa.array(start, pa.int64()),
                        pa.array(n[order], pa.int32()),
                        pa.array(marks[order].view(np.int64)),
                        pa.array(digests[order].tolist(), pa.binary()),
                    ],
                    names=["start", "n", "mark", "digest"],
                )
                offsets = np.searchsorted(text, np.arange(len(texts) + 1))
                part = batch.take(pa.array(held))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        pa.array(words.count - again, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hits),
                    ],
                    names=["row", "doc_id", "n_words", "hits"],
                )

    return run


def candidates(docs: DataFrame, known, sizes: list[int]) -> DataFrame:
    """(row, doc_id, n_words, hits) of each document, or each block of a long one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.col("text").cast("string").alias("text"),
    )
    return texts.mapInArrow(
        _candidates(known, sizes), f"row bigint, doc_id {kind}, n_words bigint, hits {_HITS}"
    )


def _spans(hits: DataFrame) -> DataFrame:
    """(row, n_hit, spans): the hits of each row joined where they overlap or touch."""
    in_order = Window.partitionBy("row").orderBy("start", "n")
    reach = F.max(F.col("start") + F.col("n")).over(
        in_order.rowsBetween(Window.unboundedPreceding, -1)
    )
    new = F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")
    numbered = hits.select("row", "start", "n", new.alias("new")).withColumn(
        "k", F.sum("new").over(in_order)
    )
    merged = numbered.groupBy("row", "k").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop")
    )
    return merged.groupBy("row").agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
    )


def _items_of(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, items): the sorted ids, as strings, of the items with windows in each row.

    Rows with the same set of windows share one lookup.
    """
    sets = hits.groupBy("row").agg(F.array_sort(F.collect_set("digest")).alias("windows"))
    key = F.sha2(F.array_join(F.transform("windows", F.hex), ","), 256)
    sets = stored(sets.withColumn("key", key), "leak-sets")
    one = sets.groupBy("key").agg(F.any_value("windows").alias("windows"))
    names = windows.filter("item_id IS NOT NULL").select(
        "digest", F.col("item_id").cast("string").alias("item")
    )
    listed = (
        one.select("key", F.explode("windows").alias("digest"))
        .join(names.distinct(), "digest")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return sets.select("row", "key").join(small(stored(listed, "leak-items")), "key").drop("key")


def contamination(docs: DataFrame, items: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(row, doc_id, n_words, n_hit, spans, items) of each document.

    `spans` are runs of hit words (first, behind the last), `items` the ids found, as strings.
    """
    windows = stored(item_windows(items), "leak-windows")
    sizes = sorted(r.n for r in windows.select("n").distinct().collect())  # ten at most
    found = stored(candidates(docs, item_marks(windows, most_bits), sizes or [WINDOW]), "leak-rows")
    distinct = stored(windows.select("mark", "digest").distinct(), "leak-distinct")
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    hits = stored(hits.join(small(distinct), ["mark", "digest"], "left_semi"), "leak-hits")
    rows = found.groupBy("row", "doc_id").agg(F.sum("n_words").alias("n_words"))
    spans, none = _spans(hits), F.array()
    told = rows.join(spans, "row", "left").join(_items_of(hits, windows), "row", "left")
    return told.select(
        "row",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("spans", none.cast("array<struct<start: bigint, stop: bigint>>")).alias("spans"),
        F.coalesce("items", none.cast("array<string>")).alias("items"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, least_share: float = 0.0) -> DataFrame:
    """The rows of `docs` without those of which more than `least_share` of the words are hit.

    Rows are told by id and text, so a clean row stays beside another of its id, or of none.
    """

    def key() -> Column:
        return F.struct("doc_id", F.sha2(F.col("text").cast("string"), 256).alias("sha"))

    keyed = docs.select(key().alias("doc_id"), "text")
    bad = contamination(keyed, items).filter(F.col("n_hit") > least_share * F.col("n_words"))
    keys = stored(bad.select(F.col("doc_id").alias("bad")).distinct(), "leaked")
    named = set_aside(docs, "doc_id", "text")
    left = named.join(small(keys), key().eqNullSafe(F.col("bad")), "left_anti")
    return left.toDF(*docs.columns)
