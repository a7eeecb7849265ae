"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Texts are lower-cased (A-Z), cut into words at white space and into shingles of
consecutive words, repeats included. A fingerprint bit is set if more than half
of the shingles' 64-bit hashes have it. Fingerprints link at `radius` or fewer
differing bits.

Covering masks leave no pair out: each bit position gets a vector of radius + 1
bits, and the table of a vector v compares the positions whose vectors have odd
parity with v. `radius` positions never span all the vectors, so for any pair
within the radius some table leaves out all the bits in which they differ.

Nulls, empty texts and texts without a word have fingerprint zero, which links
like any other. Rows without id have a component but never name one, unless all
its rows are without. Repeated rows are one document if they share their id.
Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import components, raw_texts, set_aside, slices, small, stored

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 3

# Buckets above this size are split by further bits before they reach a task.
SPLIT_ABOVE = 20_000
_CHUNK = 1 << 16
_SMALL_RUN = 16
_DIRECT = 1024


def shingle_hashes(raw: bytes, length: int) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles, a bounded number at a time."""
    words = raw.lower().split()
    if not words:
        return
    n = max(1, len(words) - length + 1)
    for lo in range(0, n, _CHUNK):
        part = words[lo : min(lo + _CHUNK, n) + length - 1]
        if length == 3 and len(part) >= 3:
            joined = [b"%b %b %b" % t for t in zip(part, part[1:], part[2:], strict=False)]
        else:
            count = max(1, len(part) - length + 1)
            joined = [b" ".join(part[i : i + length]) for i in range(count)]
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in joined]
        yield np.array(hashes, dtype=np.uint64)


def fingerprint(raw: bytes, length: int = SHINGLE) -> int:
    total, votes = 0, np.zeros(BITS, dtype=np.int64)
    for hashes in shingle_hashes(raw, length):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of each row, the fingerprint as a signed 64-bit number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            marks = [fingerprint(t, length) for t in raw_texts(batch.column("text"))]
            signed = pa.array(np.array(marks, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), signed], names=["doc_id", "fp"]
            )

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, fp bigint")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2^(radius + 1) - 1 masks; two numbers within `radius` agree under one of them."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(BITS)]
    return [
        sum(1 << i for i, m in enumerate(of_bit) if bin(m & v).count("1") % 2)
        for v in range(1, vectors + 1)
    ]


def _parts(mask: int, count: int) -> list[int]:
    """`mask` together with each of `count` parts of the bits that it leaves out."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[j::count]) for j in range(count)]


def _rows(tables: np.ndarray, keys: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(tables), pa.array(keys.view(np.int64)), pa.array(marks.view(np.int64))],
        names=["t", "key", "fp"],
    )


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _first_level(masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = _column(batch, "fp").view(np.uint64)
            for t, mask in enumerate(masks):
                yield _rows(np.full(len(marks), t, np.int32), marks & np.uint64(mask), marks)

    return run


def _next_level(masks: list[int], count: int):
    """Rows of table t go to tables t * count and up, whose masks are in `masks`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(masks, dtype=np.uint64)
        for batch in batches:
            marks, old = _column(batch, "fp").view(np.uint64), _column(batch, "t")
            for j in range(count):
                new = (old * count + j).astype(np.int32)
                yield _rows(new, marks & table[new], marks)

    return run


def _forest(marks: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is linked, at most one per member."""
    left = marks
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(left ^ at) <= radius
            for other in left[near]:
                yield int(at), int(other)
                todo.append(other)
            left = left[~near]


def bucket_links(marks: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect all distinct `marks` within `radius` of each other.

    A large bucket is split by parts of the bits that vary in it: a pair within
    the radius agrees on one of radius + 1 parts.
    """
    if len(marks) <= _DIRECT:
        yield from _forest(marks, radius)
        return
    varying = int(np.bitwise_or.reduce(marks ^ marks[0]))
    bits = [i for i in range(BITS) if varying >> i & 1]
    for j in range(radius + 1):
        part = np.uint64(sum(1 << i for i in bits[j :: radius + 1]))
        keys = marks & part
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.diff(keys[order])) + 1
        for group in np.split(marks[order], edges):
            if len(group) > 1:
                yield from bucket_links(group, radius)


def _links(radius: int):
    """(a, b) linked fingerprints of the buckets, which come sorted by table and key."""

    def linked(tables, keys, marks):
        starts = np.flatnonzero(np.r_[True, (np.diff(tables) != 0) | (np.diff(keys) != 0)])
        sizes = np.diff(np.r_[starts, len(marks)])
        run = np.repeat(np.arange(len(starts)), sizes)
        small = sizes <= _SMALL_RUN
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for step in range(1, min(_SMALL_RUN, int(sizes.max(initial=1)))):
            near = np.bitwise_count(marks[:-step] ^ marks[step:]) <= radius
            hit = np.flatnonzero((run[:-step] == run[step:]) & near)
            hit = hit[small[run[hit]]]
            a.append(marks[hit])
            b.append(marks[hit + step])
        for i in np.flatnonzero(~small):
            pairs = list(bucket_links(marks[starts[i] : starts[i] + sizes[i]], radius))
            both = np.array(pairs, dtype=np.uint64).reshape(-1, 2)
            a.append(both[:, 0])
            b.append(both[:, 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [_column(batch, "t"), _column(batch, "key"), _column(batch, "fp").view(np.uint64)]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield linked(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield linked(*held)

    return run


_BUCKET = "t int, key bigint, fp bigint"


def fingerprint_links(
    marks: DataFrame, radius: int = RADIUS, split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that connect all within `radius`.

    A bucket above `split_above` is split by radius + 1 parts of the bits that
    its mask leaves out, up to three times. As fingerprints are distinct, what
    is left then has few free bits and so few members, whatever the input. No
    bucket emits all its pairs.
    """
    count = radius + 1
    masks = covering_masks(radius)
    level = marks.select("fp").mapInArrow(_first_level(masks), _BUCKET)
    done = []
    for _ in range(3):
        sizes = level.groupBy("t", "key").agg(F.count("*").alias("n"))
        large = stored(sizes.filter(F.col("n") > split_above).drop("n"), "large-buckets")
        if large.isEmpty():
            break
        done.append(level.join(large, ["t", "key"], "left_anti").select("t", "key", "fp"))
        masks = [m for mask in masks for m in _parts(mask, count)]
        level = (
            level.join(large, ["t", "key"], "left_semi")
            .select("t", "key", "fp")
            .mapInArrow(_next_level(masks, count), _BUCKET)
        )
    links = None
    for buckets in [*done, level]:
        found = (
            buckets.repartition("t", "key")
            .sortWithinPartitions("t", "key")
            .mapInArrow(_links(radius), "a bigint, b bigint")
        )
        links = found if links is None else links.union(found)
    return links.distinct()


def _rooted(marked: DataFrame, radius: int, split_above: int) -> DataFrame:
    """(fp, first, root): the smallest id of each fingerprint, and its component."""
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    tree = components(fingerprint_links(nodes, radius, split_above))
    return nodes.join(tree, nodes.fp == tree.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, length: int = SHINGLE, radius: int = RADIUS, split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """(doc_id, fp, component_id) of each row; component_id is the smallest id reachable.

    Rows of one fingerprint are one node, so copies are never paired.
    """
    marked = stored(fingerprints(docs, length), "fingerprints")
    rooted = _rooted(marked, radius, split_above)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def _with_fingerprint(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = batch.column("text").cast(pa.string())
            marks = [fingerprint(t, length) for t in raw_texts(text)]
            yield batch.append_column("fp", pa.array(np.array(marks, np.uint64).view(np.int64)))

    return run


def one_of_each(
    docs: DataFrame, length: int = SHINGLE, radius: int = RADIUS, split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """One row of `docs` per component: the one with the smallest id, rows without id last.

    Where ids are missing or repeated the fingerprint tells rows apart: of those
    with the smallest id the one with the smallest fingerprint stays, and of
    rows equal in both the one with the smallest text.
    """
    marked = stored(fingerprints(docs, length), "fingerprints")
    order = F.struct(F.col("first").isNull(), "first", "fp")
    best = _rooted(marked, radius, split_above).groupBy("root").agg(F.min(order).alias("b"))
    chosen = stored(best.select(F.col("b.first").alias("_id"), F.col("b.fp").alias("_fp")), "chosen")
    several = marked.groupBy("doc_id").agg(F.count("*").alias("n"))
    several = several.filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_id"))
    several = stored(several, "unclear-ids")

    named = set_aside(docs, "doc_id", "text")
    same_id = F.col("doc_id").eqNullSafe(F.col("_id"))
    clear = chosen.join(several, chosen["_id"].eqNullSafe(several["_id"]), "left_anti")
    plain = named.join(clear, same_id, "left_semi")
    whole = F.struct(*[F.col(c) for c in named.columns])
    unclear = named.join(small(several), same_id, "left_semi")
    schema = T.StructType([*named.schema.fields, T.StructField("fp", T.LongType())])
    rest = unclear.mapInArrow(_with_fingerprint(length), schema)
    one = rest.groupBy("doc_id", "fp").agg(F.min_by(whole, F.struct("text")).alias("row"))
    kept = one.join(chosen, same_id & (F.col("fp") == F.col("_fp")), "left_semi").select("row.*")
    return plain.unionByName(kept).toDF(*docs.columns)
