"""Removes text that also occurs in an earlier document, by suffix arrays over shards.

A byte goes if it is covered by a string of `length` bytes that also starts in a
document with a smaller id. The strings are taken as runs, called segments, of
consecutive strings that have their smallest hash of `GRAM` bytes at one place, so
all occurrences of a string are in segments of the same hash and meet in one shard.
A segment has two halves, the strings that begin far before that place and those
near it. All strings of a half share its core, about two thirds of their bytes, and
only halves with the same core can have a string in common.

1. A first pass over the texts finds the cores that occur in several documents
   and puts their hashes into a bitmap of bounded size. When it fills up, more
   halves go on than need be; the result stays the same.
2. A second pass takes those halves, the two of a segment as one. Whole equal
   segments within a batch of documents are settled there, apart from the smallest
   id. The rest goes to shards by the smallest hash. Halves whose core very many
   documents have are cut into their single strings, which spread over all shards.
   Where very many have the smallest hash, halves go apart, by their cores.
3. A shard settles equal segments, then equal halves of different ones, and
   compares different halves of the same core by a suffix array over their bytes,
   made by external induced sorting (`suffix_sort`), which carries what neighbours
   share along: those that share `length` bytes or more form groups, and every
   member's smallest id is known. Calls take `sort_bytes` of halves, more only for
   those of one core; queues of more than `in_memory` tuples go to files below
   `spark.checkpoint.dir`.
4. The spans to remove meet their texts again in buckets of bounded size.

Matches never cross documents, and are judged on the input. Texts shorter than
`length`, null and empty ones lose nothing. A row without id counts as later
than all others. Rows with the same id do not remove from each other. Each row
gives one row. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import raw_texts, slices
from tillroll.llm.repeats import (
    CROWDED,
    LAST_ID,
    MOST_BITS,
    blobs,
    by_value,
    integer_ids,
    repeated_hashes,
)
from tillroll.llm.suffix_sort import IN_MEMORY, suffixes
from tillroll.staging import new_folder

LENGTH = 50
GRAM = 16
_PIECE = 1 << 21
_SHARD_BYTES = 1 << 24
_BUCKET_BYTES = 1 << 22
_SORT_BYTES = 1 << 20
_AT_ONCE = 1 << 19
_HELD_BYTES = 1 << 24
_BASE = 1099511628211
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Bits for a place in a batch, which has two pieces at most.
_PLACE_BITS = 23
# Smallest hashes of every so many documents, by their texts, are counted to see which are in very many.
_COUNTED = 16
_SMALLEST = np.uint64(0xA5A5A5A5A5A5A5A5)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every run of `size` bytes."""
    power, length = data.astype(np.uint64) + np.uint64(1), 1
    done, done_length, left = None, 0, size
    while left:
        if left & 1:
            if done is None:
                done = power
            else:
                n = max(0, len(data) - done_length - length + 1)
                scale = np.uint64(pow(_BASE, length, 1 << 64))
                done = done[:n] * scale + power[done_length : done_length + n]
            done_length += length
        left >>= 1
        if left:
            n = max(0, len(data) - 2 * length + 1)
            scale = np.uint64(pow(_BASE, length, 1 << 64))
            power = power[:n] * scale + power[length : length + n]
            length *= 2
    done = done[: max(0, len(data) - size + 1)]
    mixed = (done ^ (done >> np.uint64(29))) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: span - width], values[width - span :])
    return values


def half_width(length: int) -> int:
    """Strings that begin so far or farther before their smallest hash are in the far half."""
    return (length - GRAM + 2) // 2


def core_length(length: int) -> int:
    """The bytes that all strings of a half share."""
    return length - half_width(length) + 1


class Batch:
    """Halves of segments of some texts laid end to end."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int):
        """`parts`: (row, place in its text, bytes)."""
        self.data = b"".join([p[2] for p in parts])
        sizes = np.array([len(p[2]) for p in parts])
        ends = np.cumsum(sizes)
        grams = gram_hashes(np.frombuffer(self.data, dtype=np.uint8))
        # The first place of each string's smallest hash, as far as its upper bits tell.
        low = np.uint64(_PLACE_BITS)
        placed = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
        smallest = _smallest(placed, length - GRAM + 1)
        anchor = (smallest & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)[: len(anchor)]
        at = np.arange(len(anchor))
        valid = at + length <= ends[part]
        far = anchor - at >= half_width(length)
        edge = np.ones(len(anchor), dtype=bool)
        edge[1:] = (anchor[1:] != anchor[:-1]) | (far[1:] != far[:-1]) | (part[1:] != part[:-1])
        self.start = np.flatnonzero(edge & valid)
        # Halves end at the next edge or where no whole string is left.
        limit = np.append(np.flatnonzero(edge), len(anchor))
        stops = limit[np.searchsorted(limit, self.start, side="right")]
        where = part[self.start]
        self.count = np.minimum(stops, ends[where] - length + 1) - self.start
        self.anchor = anchor[self.start]
        self.smallest = grams[self.anchor]
        self.hash = far[self.start].astype(np.uint64)
        core = self.anchor - half_width(length) * far[self.start]
        last = core_length(length) - GRAM
        for step in [*range(0, last, GRAM), last]:
            self.hash = (self.hash ^ grams[core + step]) * _MIX
            self.hash ^= self.hash >> np.uint64(32)
        self.row = np.array([p[0] for p in parts])[where]
        base = np.array([p[1] for p in parts])[where] - (ends - sizes)[where]
        self.place = self.start + base


def _parts(rows: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts of a bounded size together; long ones in parts that share length - 1 bytes."""
    held, size = [], 0
    for row, raw in enumerate(rows):
        if len(raw) < length:
            continue
        for lo in range(0, len(raw) - length + 1, _PIECE):
            piece = raw[lo : lo + _PIECE + length - 1]
            held.append((row, lo, piece))
            size += len(piece)
            if size >= _PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _hashes(length: int):
    def extract(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids = integer_ids(batch)
        tags = batch.column("tag").to_numpy(zero_copy_only=False)
        for parts in _parts(raw_texts(batch.column("text")), length):
            found = Batch(parts, length)
            counted = tags[found.row] % _COUNTED == 0
            value = np.r_[found.hash, found.smallest[counted] ^ _SMALLEST]
            yield value, np.r_[ids[found.row], ids[found.row[counted]]]

    return extract


# ---- segments that may be repeated --------------------------------------------

# A pending row: hash, id, tag and place of segments, how many strings start in each, how far before
# its smallest hash the first one does, and the bytes of those that lead. A settled row: spans as id,
# tag, start and end.
_SEGMENTS = ["shard", "kind", "a", "b", "c", "d", "e", "f", "text"]
_PENDING, _SETTLED = 0, 1
# A segment with the same bytes as the one before it does not lead.
_LEADS = 128


def _runs(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(doc, tag, start, end) of the spans of each row, those that touch as one."""
    if not len(doc):
        return doc, tag, start, end
    order = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    other = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # The furthest end so far within a row, by one running maximum over all rows.
    level = np.r_[0, np.cumsum(other)].astype(np.int64)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(level * span + end) - level * span
    first = np.flatnonzero(np.r_[True, other | (start[1:] > reach[:-1])])
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], tag[first], start[first], reach[last]


_SPAN = (np.int64, np.int64, np.int64, np.int64)


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    columns = zip(zip(*parts, strict=True), _SPAN, strict=True)
    return [np.concatenate(x).astype(kind, copy=False) for x, kind in columns]


def _compressed(held: dict[int, list[tuple]]) -> list[tuple]:
    """One row per shard. What is gathered over many documents compresses better."""
    rows = []
    for shard, parts in held.items():
        first, *others = (b"".join(column) for column in zip(*parts, strict=True))
        rows.append((shard, _PENDING, first, *[zlib.compress(x, 1) for x in others]))
    return rows


def _take_segments(length: int, shards: int, repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = repeats.value
        ready, held, size = [], {}, 0
        for batch in slices(batches):
            ids = integer_ids(batch)
            tags = batch.column("tag").to_numpy(zero_copy_only=False)
            for parts in _parts(raw_texts(batch.column("text")), length):
                found = Batch(parts, length)
                some = np.flatnonzero(repeated(found.hash))
                for shard, kind, *row in _sort_out(found, some, ids, tags, repeated):
                    if kind == _SETTLED:
                        ready.append((shard, kind, *row))
                    else:
                        held.setdefault(shard, []).append(row)
                        size += len(row[-1])
                if size > _HELD_BYTES:
                    yield blobs(_SEGMENTS, [*ready, *_compressed(held)])
                    ready, held, size = [], {}, 0
        yield blobs(_SEGMENTS, [*ready, *_compressed(held)])

    def _sort_out(found, some, ids, tags, repeated):
        if not len(some):
            return
        core, anchor = found.hash[some], found.anchor[some]
        crowd = repeated.in_very_many(core)
        apart = crowd | repeated.in_very_many(found.smallest[some] ^ _SMALLEST)
        # The halves of a segment follow each other.
        opens = np.ones(len(some), dtype=bool)
        opens[1:] = (anchor[1:] != anchor[:-1]) | apart[1:] | apart[:-1]
        first = np.flatnonzero(opens)
        count = np.add.reduceat(found.count[some], first)
        some, core, crowd, apart = some[first], core[first], crowd[first], apart[first]
        start, place = found.start[some], found.place[some]
        before = found.anchor[some] - start
        value = np.where(apart, core, found.smallest[some])
        doc, tag = ids[found.row[some]], tags[found.row[some]]
        ends = (start + count + length - 1).tolist()
        data = memoryview(found.data)
        texts = [data[a:b] for a, b in zip(start.tolist(), ends, strict=True)]
        digest = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], dtype=np.uint64)

        order = np.lexsort((doc, digest, value))
        v, d, i = value[order], digest[order], doc[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
        least = i[new][np.cumsum(new) - 1]
        later = order[i > least]
        stop = place[later] + count[later] + length - 1
        spans = _runs(doc[later], tag[later], place[later], stop)
        if len(spans[0]):
            # They only pass through the shard.
            yield int(spans[0][0] % shards), _SETTLED, *_joined([spans]), b"", b"", b""

        kept, leads = order[i == least], new[i == least]
        many = crowd[kept]
        if many.any():
            yield from _single(found, start, count, doc, tag, place, kept[many])
        kept, leads = kept[~many], leads[~many]
        for s, g in by_value((value[kept] % np.uint64(shards)).astype(np.int32)):
            mine, lead = kept[g], leads[g]
            # By document, which compresses well and keeps equal segments together.
            by_doc = np.lexsort((~lead, digest[mine], value[mine], doc[mine]))
            mine, lead = mine[by_doc], lead[by_doc]
            text = b"".join([texts[j] for j in mine[lead].tolist()])
            numbers = (x[mine] for x in (value, doc, tag, place, count, before))
            yield s, *_packed(*numbers, lead, text)

    def _single(found, start, count, doc, tag, place, crowd):
        """Segments as their single strings, whose hash is their own."""
        sizes = count[crowd]
        which = np.repeat(crowd, sizes)
        step = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data = memoryview(found.data)
        texts = [data[a : a + length] for a in (start[which] + step).tolist()]
        value = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], dtype=np.uint64)
        ones = np.ones(len(which), dtype=np.int64)
        for s, g in by_value((value % np.uint64(shards)).astype(np.int32)):
            j = which[g]
            text = b"".join([texts[k] for k in g.tolist()])
            numbers = (value[g], doc[j], tag[j], place[j] + step[g], ones[g], 0 * ones[g])
            yield s, *_packed(*numbers, ones[g] > 0, text)

    def _packed(value, doc, tag, place, count, before, lead, text):
        """Some bits of the hash are enough, as different segments are compared by their bytes."""
        some_bits = ((value // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        flags = (count + _LEADS * lead).astype(np.uint8)
        where = (doc.astype(np.int64), tag.astype(np.int64), place.astype(np.int64))
        numbers = (*where, flags, before.astype(np.uint8))
        return _PENDING, some_bits.tobytes(), *[x.tobytes() for x in numbers], text

    return run


# ---- shards -------------------------------------------------------------------


class Groups:
    """Equal strings of bytes as groups, ordered by a key. The rows of the smallest id come first."""

    def __init__(self, key: np.ndarray, digest: np.ndarray, doc: np.ndarray, leads: np.ndarray):
        self.order = np.lexsort((~leads, doc, digest, key))
        k, d, i = key[self.order], digest[self.order], doc[self.order]
        new_key = np.ones(len(k), dtype=bool)
        new_key[1:] = k[1:] != k[:-1]
        new = new_key.copy()
        new[1:] |= d[1:] != d[:-1]
        self.first = np.flatnonzero(new)
        self.least = i[self.first]
        same_id = i == self.least[np.cumsum(new) - 1]
        #: Rows of other ids than the smallest of their group.
        self.later = self.order[~same_id]
        self.members = np.add.reduceat(same_id, self.first, dtype=np.int64)
        #: The key of each group, by number, and the groups that are not the only one of theirs.
        self.key = (np.cumsum(new_key) - 1)[self.first]
        self.odd = np.flatnonzero(np.bincount(self.key)[self.key] > 1)

    def lead(self, group: np.ndarray) -> np.ndarray:
        return self.order[self.first[group]]

    def rows(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the smallest id of each of `group`, and to which of these each row belongs."""
        copies = self.members[group]
        which = np.repeat(np.arange(len(group)), copies)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(copies) - copies, copies)
        return self.order[self.first[group][which] + nth], which


def _together(
    groups: np.ndarray, cores: np.ndarray, sizes: np.ndarray, most: int
) -> Iterator[np.ndarray]:
    """Groups in parts of a bounded number of bytes; those of one core stay together."""
    lo = 0
    while lo < len(groups):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), most)))
        while hi < len(groups) and cores[hi] == cores[hi - 1]:
            hi += 1
        yield groups[lo:hi]
        lo = hi


def repeated_strings(
    texts: list[bytes],
    docs: np.ndarray,
    counts: np.ndarray,
    length: int,
    in_memory: int,
    folder: str | None = None,
) -> np.ndarray:
    """For each string of each segment, whether it also starts in a segment of a smaller id.

    `counts` strings start in each segment, at its first bytes.
    """
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    text = np.zeros(ends[-1] + 1, dtype=np.int32)
    inside = np.ones(ends[-1] + 1, dtype=bool)
    inside[ends - 1] = inside[-1] = False
    text[inside] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int32) + 1
    text[ends - 1] = 257 + np.arange(len(texts))
    order, shared = suffixes(text, 256, length, in_memory, folder)

    starts = ends - sizes - 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    segment = np.append(owner, 0)[order]
    whole = (order < ends[-1]) & (order - starts[segment] < counts[segment])
    order, segment = order[whole], segment[whole]
    # What a string shares with the last one before it is the least shared on the way.
    same = np.zeros(len(order), dtype=bool)
    if len(order):
        at = np.flatnonzero(whole)
        if len(at) > 1:
            same[1:] = np.minimum.reduceat(shared[: at[-1] + 1], at[:-1] + 1) >= length
    first = np.flatnonzero(~same)
    least = np.minimum.reduceat(docs[segment], first) if len(first) else docs[:0]
    least = np.repeat(least, np.diff(np.r_[first, len(order)]))
    flags = np.zeros(len(text), dtype=bool)
    flags[order[least < docs[segment]]] = True
    return flags[np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]


def _resolve(length: int, buckets: int, in_memory: int, sort_bytes: int, folder: str):
    """Spans to remove by bucket of texts. Rows come sorted by shard."""

    def spread(parts):
        spans = _runs(*_joined(parts))
        place = bucket_of(spans[0], spans[1], buckets).astype(np.int32)
        rows = [(s, *[x[g] for x in spans]) for s, g in by_value(place)]
        return blobs(_SPANS, rows)

    def settle(held: list[tuple[bytes, ...]]):
        kinds = (np.int64, np.int64, np.int64, np.uint8, np.uint8)
        value = np.frombuffer(b"".join([row[0] for row in held]), dtype=np.uint32)
        doc, tag, place, flags, before = (
            np.frombuffer(b"".join([zlib.decompress(row[i]) for row in held]), dtype=kind)
            for i, kind in enumerate(kinds, 1)
        )
        data = memoryview(b"".join([zlib.decompress(row[6]) for row in held]))
        leads, count = flags >= _LEADS, (flags % _LEADS).astype(np.int64)
        size = np.where(leads, count + length - 1, 0)
        at = np.cumsum(size) - size
        ends = (at + size)[leads].tolist()
        texts = [data[a:b] for a, b in zip(at[leads].tolist(), ends, strict=True)]
        each = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], dtype=np.uint64)
        digest = each[np.cumsum(leads) - 1]
        held.clear()
        del texts, ends

        whole = Groups(value, digest, doc, leads)
        later = whole.later
        spans = [(doc[later], tag[later], place[later], place[later] + count[later] + length - 1)]

        def cover(group: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
            row, which = whole.rows(group)
            spans.append((doc[row], tag[row], place[row] + lo[which], place[row] + hi[which]))

        # Different segments of one hash: are halves of them equal, or what strings do these share?
        lead = whole.lead(whole.odd)
        if not len(lead):
            return spread(spans)
        n_far = np.clip(before[lead].astype(np.int64) - half_width(length) + 1, 0, count[lead])
        sides = np.array([np.zeros_like(n_far), n_far]), np.array([n_far, count[lead] - n_far])
        side, which = np.nonzero(sides[1])
        group, lo, many = whole.odd[which], sides[0][side, which], sides[1][side, which]
        begin, size = at[lead[which]], many + length - 1
        core = begin + before[lead[which]] - half_width(length) * (side == 0)

        def pieces(start: np.ndarray, end: np.ndarray) -> list[memoryview]:
            return [data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]

        cores, texts = pieces(core, core + core_length(length)), pieces(begin + lo, begin + lo + size)
        key, digest = (
            np.array([xxhash.xxh3_64_intdigest(t) for t in x], dtype=np.uint64) for x in (cores, texts)
        )
        halves = Groups(key, digest, whole.least[group], np.ones(len(key), dtype=bool))
        later = halves.later
        cover(group[later], lo[later], (lo + size)[later])
        odd = halves.odd
        for part in _together(odd, halves.key[odd], size[halves.lead(odd)], sort_bytes):
            mine = halves.lead(part)
            parts = [bytes(texts[j]) for j in mine.tolist()]
            sizes = many[mine]
            shared = repeated_strings(parts, halves.least[part], sizes, length, in_memory, folder)
            which = np.repeat(np.arange(len(part)), sizes)
            step = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            opens = shared & ~(np.r_[False, shared[:-1]] & (step > 0))
            closes = shared & ~(np.r_[shared[1:], False] & np.r_[step[1:] > 0, False])
            row, of = halves.rows(part[which[opens]])
            cover(group[row], lo[row] + step[opens][of], lo[row] + (step[closes] + length)[of])
        return spread(spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, passing, size = None, [], [], 0
        for batch in batches:
            for s, kind, *columns in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kind == _SETTLED:
                    passing.append(
                        tuple(np.frombuffer(c, dtype=k) for c, k in zip(columns, _SPAN, strict=False))
                    )
                    size += len(passing[-1][0])
                    if size > _AT_ONCE:
                        yield spread(passing)
                        passing, size = [], 0
                    continue
                if s != shard:
                    if held:
                        yield settle(held)
                    shard, held = s, []
                held.append(tuple(columns))
        if held:
            yield settle(held)
        if passing:
            yield spread(passing)

    return run


# ---- texts --------------------------------------------------------------------


_SPANS = ["bucket", "doc", "tag", "start", "end"]


def bucket_of(doc, tag, buckets: int):
    """The bucket of a row by id and tag, for arrays and for columns alike.

    Rows without id, or of one id, are spread by their texts.
    """
    if isinstance(doc, Column):
        both = doc.bitwiseXOR(F.shiftright(doc, 20)).bitwiseXOR(tag)
        return F.pmod(both, F.lit(buckets))
    return (doc ^ (doc >> 20) ^ tag) % buckets


def _remove(docs: pa.Table, found: pa.Table) -> pa.Table:
    columns = [
        np.frombuffer(b"".join(found.column(n).to_pylist()), dtype=k)
        for n, k in zip(_SPANS[1:], _SPAN, strict=True)
    ]
    doc, tag, start, end = (x.tolist() for x in _runs(*columns))
    own: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for d, t, a, b in zip(doc, tag, start, end, strict=True):
        own.setdefault((d, t), []).append((a, b))
    texts = raw_texts(docs.column("text").combine_chunks())
    rows = zip(docs.column("doc").to_pylist(), docs.column("tag").to_pylist(), strict=True)
    sizes, spans, left = [], [], []
    for row, raw in zip(rows, texts, strict=True):
        mine = own.get(row, [])
        edges = [0, *[x for span in mine for x in span], len(raw)]
        left.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
        spans.append([{"start": a, "end": b} for a, b in mine])
        sizes.append(len(raw))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    columns = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(left, pa.binary())]
    return pa.table([docs.column("doc_id"), *columns], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    most_bits: int = MOST_BITS,
    crowded: int = CROWDED,
    in_memory: int = IN_MEMORY,
    shard_bytes: int = _SHARD_BYTES,
    bucket_bytes: int = _BUCKET_BYTES,
    sort_bytes: int = _SORT_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row: the byte spans removed and the bytes left.

    `kept` is binary, as a span may end within a character.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Rows of one id are told apart by a hash of their text.
    rows = docs.select("doc_id", text.alias("text")).withColumn("tag", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0

    # A new smallest hash begins at two of so many strings, a far half ends at one.
    expected = total * 3 // (length - GRAM + 2)
    held = repeated_hashes(rows, _hashes(length), expected, most_bits, crowded)
    shards = max(1, -(-total // shard_bytes))
    buckets = max(1, -(-total // bucket_bytes)) | 1
    folder = new_folder(docs.sparkSession, "suffixes")
    binary = ", ".join(f"`{n}` binary" for n in _SEGMENTS[2:])
    spans = (
        rows.mapInArrow(_take_segments(length, shards, held), f"shard int, kind int, {binary}")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(
            _resolve(length, buckets, in_memory, sort_bytes, folder),
            "bucket int, " + ", ".join(f"`{n}` binary" for n in _SPANS[1:]),
        )
    )
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    placed = rows.withColumn("doc", doc)
    placed = placed.withColumn("bucket", bucket_of(F.col("doc"), F.col("tag"), buckets).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        placed.groupBy("bucket")
        .cogroup(spans.groupBy("bucket"))
        .applyInArrow(
            _remove,
            f"doc_id {kind}, n_bytes bigint, "
            "spans array<struct<start:bigint,end:bigint>>, kept binary",
        )
    )
