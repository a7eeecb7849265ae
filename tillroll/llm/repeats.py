"""Hashes that occur in several documents, as a bitmap of bounded size.

A first pass over the texts finds them, so that a second one moves only what may
be repeated. Hashes go to shards by their top bits, packed and each at most once
per batch, so that one that is in very many documents weighs no more than others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import slices

# Bits of the bitmap: four to eight for each expected hash, at most 64 MB. When it fills up, more
# hashes seem repeated than are; none that is goes missing.
MOST_BITS = 29
# A hash in more documents than this is reported apart.
CROWDED = 50_000
LAST_ID = int(np.iinfo(np.int64).max)
_PER_SHARD = 1 << 20
_HASHES = ["shard", "once", "more", "docs"]

# From a batch of rows to the hashes of some of them and the ids of their documents, again and
# again.
Extract = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def integer_ids(batch: pa.RecordBatch) -> np.ndarray:
    """Ids as numbers; a row without one comes after all others."""
    ids = batch.column("doc_id").cast(pa.int64())
    return ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False)


def blobs(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    """One Arrow row per tuple: numbers as they are, arrays as bytes."""
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    out = []
    for name, column in zip(names, columns, strict=True):
        if name in ("shard", "kind", "bucket"):
            out.append(pa.array(list(column), pa.int32()))
        else:
            raw = [c if isinstance(c, bytes) else np.ascontiguousarray(c).tobytes() for c in column]
            out.append(pa.array(raw, pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=names)


def by_value(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            yield int(values[group[0]]), group


def _by_shard(extract: Extract, bits: int):
    """Hashes by shard, the top bits, each once per batch: of one id, of several and of how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for value, doc in extract(batch):
                order = np.lexsort((doc, value))
                value, doc = value[order], doc[order]
                new = np.ones(len(value), dtype=bool)
                new[1:] = value[1:] != value[:-1]
                other = new.copy()
                other[1:] |= doc[1:] != doc[:-1]
                first = np.flatnonzero(new)
                docs = np.add.reduceat(other, first, dtype=np.uint32) if len(first) else first
                value, several = value[first], docs > 1
                shard = (value >> np.uint64(64 - bits)).astype(np.int32)
                rest = ((value << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                out = []
                for s, g in by_value(shard):
                    one, many = g[~several[g]], g[several[g]]
                    out.append((s, rest[one], rest[many], docs[many].astype(np.uint32)))
                yield blobs(_HASHES, out)

    return run


def _repeated(shard_bits: int, bits: int, crowded: int):
    """Bits of hashes of several documents; hashes of very many. Rows come sorted by shard."""

    def settle(shard: int, held: list[tuple[bytes, bytes, bytes]]):
        single, several, docs = (
            np.frombuffer(b"".join(column), dtype=np.uint32) for column in zip(*held, strict=True)
        )
        value, back = np.unique(np.concatenate([single, several]), return_inverse=True)
        weight = np.concatenate([np.ones(len(single)), docs])
        count = np.bincount(back, weights=weight, minlength=len(value))
        flags = np.zeros(1 << (bits - shard_bits), dtype=bool)
        flags[value[count > 1] >> np.uint32(32 - (bits - shard_bits))] = True
        return shard, np.packbits(flags, bitorder="little"), value[count > crowded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, shard, held = ["shard", "bits", "crowded"], None, []
        for batch in batches:
            for s, *columns in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if s != shard:
                    if held:
                        yield blobs(names, [settle(shard, held)])
                    shard, held = s, []
                held.append(tuple(columns))
        if held:
            yield blobs(names, [settle(shard, held)])

    return run


class Repeated:
    """Tells hashes that may be in several documents, and those that are in very many."""

    def __init__(self, flags: bytes, bits: int, cut: int, crowded: np.ndarray):
        self.flags = np.frombuffer(flags, dtype=np.uint8)
        self.bits, self.cut, self.crowded = np.uint64(64 - bits), np.uint64(cut), crowded

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        spot = hashes >> self.bits
        at = (spot & np.uint64(7)).astype(np.uint8)
        return ((self.flags[spot >> np.uint64(3)] >> at) & 1).astype(bool)

    def in_very_many(self, hashes: np.ndarray) -> np.ndarray:
        return np.isin((hashes >> self.cut) << self.cut, self.crowded)


def repeated_hashes(
    rows: DataFrame,
    extract: Extract,
    expected: int,
    most_bits: int = MOST_BITS,
    crowded: int = CROWDED,
):
    """A broadcast `Repeated` over the hashes that `extract` finds; `expected` is their number."""
    bits = max(12, min(most_bits, max(1, expected * 4).bit_length()))
    shard_bits = max(1, min(bits - 8, (expected // _PER_SHARD).bit_length()))
    found = (
        rows.mapInArrow(
            _by_shard(extract, shard_bits), "shard int, once binary, more binary, docs binary"
        )
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_repeated(shard_bits, bits, crowded), "shard int, bits binary, crowded binary")
    )
    flags = np.zeros((1 << shard_bits, (1 << (bits - shard_bits)) // 8), dtype=np.uint8)
    many, cut = [np.empty(0, np.uint64)], np.uint64(32 - shard_bits)
    # The bitmap has a bounded size, and hashes of very many documents are few by definition. All at
    # once, as an iterator would have the partitions computed one after the other.
    for r in found.collect():
        flags[r.shard] = np.frombuffer(r.bits, dtype=np.uint8)
        rest = np.frombuffer(r.crowded, dtype=np.uint32).astype(np.uint64)
        many.append((np.uint64(r.shard) << np.uint64(64 - shard_bits)) | (rest << cut))
    spark = rows.sparkSession
    return spark.sparkContext.broadcast(
        Repeated(flags.tobytes(), bits, int(cut), np.concatenate(many))
    )
