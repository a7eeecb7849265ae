"""Exact duplicates by two passes with Bloom filters.

Texts are equal when they are after all white space is deleted. The first pass
puts every text's hash into one filter and those that were there already into a
second one; only rows that hit the second filter are shuffled.

Nulls and texts of white space alone count as empty, and equal each other. The
longest original text stays (code points), then the smallest id, with rows
without id last. Rows that are equal in length and id are told apart by their
place in the staged table, so one of them stays. An empty table gives an empty
one. Columns of other names are carried through or ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import raw_texts, set_aside, slices, stored

# The white space that does not count.
WHITE = b" \t\n\x0b\x0c\r"

SHARD_BITS = 1 << 20
BITS_PER_ROW = 16
PROBES = 4
# The second filter is broadcast, so its size is bounded: 64 MB. Beyond 32 million
# rows it fills up, and more rows are shuffled than need be; the result stays right.
MOST_BITS = 1 << 29

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5],
    dtype=np.uint64,
)


def _with(df: DataFrame, **more: str) -> T.StructType:
    """The schema of `df` and further columns."""
    extra = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in more.items()))
    return T.StructType([*df.schema.fields, *extra.fields])


def digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw.translate(None, WHITE)).digest()


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        text = batch.column("text")
        digests = [digest(t) for t in raw_texts(text)]
        points = pc.fill_null(pc.utf8_length(text.cast(pa.large_string())), 0).cast(pa.int64())
        hashes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(digests, pa.binary()),
                points,
                pa.array(hashes, pa.int64()),
            ],
            names=["doc_id", "digest", "points", "hash"],
        )


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, points, hash) of each row, the hash being 64 bits of the digest."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _digest_batches, f"doc_id {kind}, digest binary, points bigint, hash bigint"
    )


def _places(hashes: np.ndarray) -> np.ndarray:
    """Bits of a shard for each hash, one row per probe."""
    mixed = hashes[None, :] * _ODD[:PROBES, None]
    return ((mixed >> np.uint64(24)) % np.uint64(SHARD_BITS)).astype(np.int64)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)


def _thin(shards: int):
    """Hashes of a batch by shard, each once, apart from those met twice already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
            distinct, count = np.unique(hashes, return_counts=True)
            where = _shard(distinct, shards)
            out = []
            for s in np.unique(where):
                mine = where == s
                once, more = distinct[mine & (count == 1)], distinct[mine & (count > 1)]
                out.append((int(s), once.tobytes(), more.tobytes()))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["shard", "once", "more"],
            )

    return run


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second filter of each shard. Rows come sorted by shard."""

    def row(shard, bits):
        packed = [np.packbits(bits, bitorder="little").tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array(packed, pa.binary())], names=["shard", "bits"]
        )

    shard, seen, repeated = None, None, None
    for batch in batches:
        for s, once, more in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if s != shard:
                if shard is not None and repeated.any():
                    yield row(shard, repeated)
                shard = s
                seen = np.zeros(SHARD_BITS, dtype=bool)
                repeated = np.zeros(SHARD_BITS, dtype=bool)
            twice = np.frombuffer(more, dtype=np.uint64)
            places = _places(np.frombuffer(once, dtype=np.uint64))
            hit = seen[places].all(axis=0)
            repeated[places[:, hit]] = True
            seen[places] = True
            places = _places(twice)
            repeated[places] = True
            seen[places] = True
    if shard is not None and repeated.any():
        yield row(shard, repeated)


def _flag(shards: int, filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {s: np.frombuffer(b, dtype=np.uint8) for s, b in filters.value.items()}
        for batch in batches:
            hashes = batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
            where, places = _shard(hashes, shards), _places(hashes)
            maybe = np.zeros(len(hashes), dtype=bool)
            for s in np.unique(where):
                if int(s) in bits:
                    mine = np.flatnonzero(where == s)
                    p = places[:, mine]
                    maybe[mine] = ((bits[int(s)][p >> 3] >> (p & 7)) & 1).all(axis=0)
            yield batch.append_column("maybe", pa.array(maybe))

    return run


def second_filter(hashes: DataFrame, most_bits: int = MOST_BITS) -> tuple:
    """(shards, broadcast bits by shard) of the hashes that occur more than once, or seem to.

    `hashes` should be stored, as it is read twice. The filters are made in
    shards of a fixed number of bits; hashes go to their shard packed, each at
    most once per batch, so copies without number weigh no more than others.
    """
    spark = hashes.sparkSession
    bits = min(most_bits, max(SHARD_BITS, hashes.count() * BITS_PER_ROW))
    shards = -(-bits // SHARD_BITS)
    thin = hashes.select("hash").mapInArrow(_thin(shards), "shard int, once binary, more binary")
    second = (
        thin.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_filters, "shard int, bits binary")
    )
    # At most `most_bits` in all.
    return shards, spark.sparkContext.broadcast({r.shard: bytes(r.bits) for r in second.collect()})


def flag_repeats(hashed: DataFrame, shards: int, filters) -> DataFrame:
    """`hashed` with `maybe`: false only if the row's `hash` occurs nowhere else."""
    return hashed.mapInArrow(_flag(shards, filters), _with(hashed, maybe="boolean"))


def _order(*more: str) -> Column:
    return F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", *more)


def duplicate_report(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """For each row of `docs`: doc_id, keep_id, group_size, kept, digest.

    Only digests and ids are moved, never texts, and only those of rows that may
    be repeated. A group of any size is counted and ranked before the shuffle;
    the join that tells its members who stays may be split by the planner.
    """
    numbered = text_digests(docs).withColumn("row", F.monotonically_increasing_id())
    hashed = stored(numbered, "digests")
    flagged = flag_repeats(hashed, *second_filter(hashed, most_bits))
    one = flagged.filter("not maybe").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "digest",
    )
    several = flagged.filter("maybe")
    heads = several.groupBy("digest").agg(
        F.min(_order("row")).alias("best"), F.count("*").alias("group_size")
    )
    # Stored, so that the join has a shuffle of its own on this side and can be split.
    best = stored(heads, "group-heads")
    told = several.join(best, "digest").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
    )
    return one.unionByName(told)


def _digest_and_flag(shards: int, filters):
    """Whole rows with digest, points and maybe, in one pass."""
    flag = _flag(shards, filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            more = next(flag(_digest_batches(iter([batch]))))
            for name in ("digest", "points", "maybe"):
                batch = batch.append_column(name, more.column(name))
            yield batch

    return run


def deduplicate(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows that occur once by the filters go straight through. Of the others each
    task sends one whole row per text. Rows equal in text and id are one; which
    of their other columns' values stay is not defined.
    """
    hashes = stored(text_digests(docs).select("hash"), "hashes")
    named = set_aside(docs, "doc_id", "text")
    flagged = named.mapInArrow(
        _digest_and_flag(*second_filter(hashes, most_bits)),
        _with(named, digest="binary", points="bigint", maybe="boolean"),
    )
    whole = F.struct(*[F.col(c) for c in named.columns])
    best = F.min_by(whole, _order("text")).alias("best")
    several = flagged.filter("maybe").groupBy("digest").agg(best).select("best.*")
    one = flagged.filter("not maybe").select(*named.columns)
    return one.unionByName(several).toDF(*docs.columns)
