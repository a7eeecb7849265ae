"""Byte-pair encoding by a table of distinct words, and decoding by an id-to-piece table.

A text is cut at ASCII white space, where the tokenizer always cuts.

1. Texts are taken in chunks of some megabytes. A chunk is its distinct words, in
   buckets by their hash, and one number per word of its texts: the place of that
   word in the chunk's list. Words and numbers are made by a pass each, which cut
   the same chunks, as both read the same partitions in the same order; texts that
   do not come straight from files are stored first, so that they do.
2. A bucket brings together what all chunks have of its words. Each distinct
   word is encoded there once, and every chunk gets the ids of its own back.
3. A chunk's ids meet its numbers, and each word's ids go to the word's position.

What is moved are a chunk's distinct words and numbers, packed, not words by
position. Words of letters with punctuation behind them are encoded as the two
pieces into which the tokenizer splits them. All other words (digits, special
tokens, other scripts) go through the library as they are.

Null and empty texts have no ids and decode to the empty text. Texts of any
length are taken in blocks; a very long one is a chunk of its own. Each row gives
one row, whatever its id. Columns besides doc_id and text are ignored. An empty
table gives an empty one.

The vocabulary file must be at the same path on every worker, as a package that
is installed there or a file shipped with the job.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillroll.llm.common import blocks, raw_texts, rows, slices, stored

TABLE_WORDS = 200_000
# Bytes of text in a chunk, and buckets of the table of distinct words.
CHUNK = 1 << 24
BUCKETS = 256
_PUNCTUATION = string.punctuation.encode()
# Small Latin letters beyond ASCII too; C3 B7, left out, is the sign for division.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+\Z")
_SPECIAL = b"<|"


def _byte_characters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def split_words(raw: bytes) -> list[bytes]:
    """Words, lower-cased (A-Z) unless they could hold a special token."""
    if _SPECIAL not in raw:
        return raw.lower().split()
    return [w if _SPECIAL in w else w.lower() for w in raw.split()]


class WordTable(dict):
    """Ids by distinct word, as little-endian unsigned 32-bit numbers, for one vocabulary file."""

    def __init__(self, path: str, most_words: int = TABLE_WORDS):
        # One process per core encodes already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.pieces = [n.encode() for n in names]
        self.numbers = [i.to_bytes(4, "little") for i in range(size)]
        # The merges alone, for pieces that need no more normalising or splitting.
        self.model = self.tokenizer.model
        self.written = str.maketrans(_byte_characters())
        self.most_words = most_words

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > self.most_words:
            self.clear()
        ids = self[word] = self.spell(word)
        return ids

    def spell(self, word: bytes) -> bytes:
        """The ids of a word that is not in the table."""
        if word.isalpha() and word.islower():
            return self._merged(word.decode())
        stripped = word.rstrip(_PUNCTUATION)
        letters = stripped.lower()
        if not letters.isascii():
            letters = letters.decode(errors="replace").lower().encode()
        if letters.isalpha() or _LETTERS.match(letters):
            if letters != word:
                punctuation = word[len(stripped) :]
                ids = self[letters] + (self[punctuation] if punctuation else b"")
            else:
                ids = self._merged(letters.decode("latin-1").translate(self.written))
        else:
            text = word.decode(errors="replace")
            code = self.tokenizer.encode(text, add_special_tokens=False)
            ids = b"".join(map(self.numbers.__getitem__, code.ids))
        return ids

    def _merged(self, piece: str) -> bytes:
        """The ids of a piece in the characters by which the vocabulary writes its bytes."""
        numbers = self.numbers
        return b"".join([numbers[t.id] for t in self.model.tokenize(piece)])

    def encode(self, raw: bytes) -> bytes:
        """The ids of a text."""
        spell = self.__getitem__
        return b"".join([b"".join(map(spell, split_words(block))) for block in blocks(raw)])


@lru_cache(maxsize=2)
def word_table(path: str, most_words: int = TABLE_WORDS) -> WordTable:
    """The worker's table, kept from task to task."""
    return WordTable(path, most_words)


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")), f"doc_id {kind}"


class _Numbers(dict):
    """Words by the order in which they come first."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Chunk:
    """Texts as distinct words and a number per word."""

    def __init__(self):
        self.words, self.codes, self.ids, self.sizes, self.bytes = _Numbers(), [], [], [], 0

    def add(self, doc_id, raw: bytes) -> None:
        number, size = self.words.__getitem__, 0
        for block in blocks(raw):
            words = split_words(block)
            self.codes.append(np.fromiter(map(number, words), dtype=np.int32, count=len(words)))
            size += len(words)
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.bytes += len(raw)

    def records(self, chunk: int, buckets: int, numbers: bool) -> Iterator[tuple]:
        """Its texts' numbers (bucket -1), or its words by bucket in the order of the numbers."""
        words = list(self.words)
        of = np.array([xxhash.xxh3_64_intdigest(w) % buckets for w in words], dtype=np.int64)
        order = np.argsort(of, kind="stable")
        if numbers:
            place = np.empty(len(words), dtype=np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.int32)
            blob = zlib.compress(place[codes].tobytes(), 1)
            yield chunk, -1, self.ids, self.sizes, len(words), blob
            return
        for bucket, mine in groupby(order.tolist(), key=of.__getitem__):
            blob = b"\n".join([words[i] for i in mine])
            yield chunk, int(bucket), None, None, None, zlib.compress(blob, 1)


def _schemas(docs: DataFrame) -> tuple[pa.Schema, str]:
    kind = docs.schema["doc_id"].dataType
    ids = pa.list_(to_arrow_type(kind))
    fields = [pa.int64(), pa.int32(), ids, pa.list_(pa.int64()), pa.int64(), pa.binary()]
    names = ["chunk", "bucket", "doc_ids", "sizes", "n_words", "blob"]
    ddl = f"chunk bigint, bucket int, doc_ids array<{kind.simpleString()}>, "
    ddl += "sizes array<bigint>, n_words bigint, blob binary"
    return pa.schema(list(zip(names, fields, strict=True))), ddl


def _batch(records: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*records, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def chunks(
    docs: DataFrame, numbers: bool, buckets: int = BUCKETS, size: int = CHUNK
) -> DataFrame:
    """(chunk, bucket, doc_ids, sizes, n_words, blob): chunks as numbers, or their distinct words."""
    schema, ddl = _schemas(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, part = _Chunk(), 0, 0

        def sent() -> Iterator[pa.RecordBatch]:
            # A chunk of empty texts has no words.
            if found := list(held.records(part << 32 | n, buckets, numbers)):
                yield _batch(found, schema)

        for batch in slices(batches, 256):
            texts = raw_texts(batch.column("text"))
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                held.add(doc_id, raw)
                if held.bytes >= size:
                    yield from sent()
                    held, n = _Chunk(), n + 1
        if held.ids:
            yield from sent()

    texts = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part")
    )
    return texts.mapInArrow(run, ddl)


def _spelt_words(path: str):
    """Ids of each chunk's words of a bucket. Rows come sorted by bucket; one bucket is held."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bucket, known = word_table(path), None, {}
        for batch in slices(batches, 64):
            out = []
            for chunk, b, blob in rows(batch, "chunk", "bucket", "blob"):
                if b != bucket:
                    bucket, known = b, {}
                words = zlib.decompress(blob).split(b"\n")
                for word in words:
                    if word not in known:
                        known[word] = table.spell(word)
                spelt = [known[w] for w in words]
                counts = np.array([len(s) // 4 for s in spelt], dtype="<u4").tobytes()
                out.append((chunk, b, zlib.compress(counts + b"".join(spelt), 1)))
            if out:
                yield _batch(out, schema)

    return run


def _positioned(kind: pa.DataType):
    """Ids by position. Rows come sorted by chunk, a chunk's numbers before its words' ids."""
    schema = pa.schema(
        [("doc_id", kind), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
    )

    def texts(members: list[tuple]) -> Iterator[pa.RecordBatch]:
        (_, _, doc_ids, sizes, n_words, numbers), *buckets = members
        codes = np.frombuffer(zlib.decompress(numbers), dtype=np.int32)
        counts, ids = [np.empty(0, "<u4")], [np.empty(0, "<u4")]
        for *_, blob in buckets:
            both = np.frombuffer(zlib.decompress(blob), dtype="<u4")
            # As many counts as words, and behind them as many ids as these say.
            n = int(np.searchsorted(np.arange(1, len(both) + 1) + np.cumsum(both), len(both))) + 1
            counts.append(both[:n])
            ids.append(both[n:])
        counts, ids = np.concatenate(counts).astype(np.int64), np.concatenate(ids)
        if len(counts) != n_words:
            raise ValueError("the two passes over the documents have read different chunks")
        first = np.cumsum(counts) - counts
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        for lo in range(0, len(doc_ids), 1024):
            some = slice(lo, lo + 1024)
            begin = ends[lo - 1] if lo else 0
            mine = codes[begin : ends[min(lo + 1024, len(ends)) - 1]]
            each = counts[mine]
            upto = np.cumsum(each)
            spots = np.repeat(first[mine] - (upto - each), each) + np.arange(each.sum())
            edges = np.concatenate([[0], upto])[np.concatenate([[begin], ends[some]]) - begin]
            flat = pa.array(ids[spots].astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[some], kind), pa.array(np.diff(edges)), lists], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("chunk", "bucket", "doc_ids", "sizes", "n_words", "blob")
        flat = (r for b in batches for part in slices(iter([b]), 64) for r in rows(part, *names))
        for _, members in groupby(flat, key=lambda r: r[0]):
            yield from texts(list(members))

    return run


# Operators that give the same rows in the same order each time.
_STEADY = {"AdaptiveSparkPlan", "ColumnarToRow", "FileScan", "Filter", "LocalTableScan", "Project"}


def _reads_alike(docs: DataFrame) -> bool:
    """Whether `docs` is read straight from files or the plan, with nothing shuffled before."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    found = (re.match(r"[^A-Za-z]*([A-Za-z]+)", line) for line in plan.splitlines())
    return {m[1] for m in found if m} <= _STEADY


def encode(
    docs: DataFrame, path: str, buckets: int = BUCKETS, size: int = CHUNK
) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row."""
    texts = docs.select("doc_id", "text")
    docs = texts if _reads_alike(texts) else stored(texts, "texts")
    spelt = (
        chunks(docs, False, buckets, size)
        .select("chunk", "bucket", "blob")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_spelt_words(path), "chunk bigint, bucket int, blob binary")
    )
    both = chunks(docs, True, buckets, size).unionByName(spelt, allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType
    return (
        both.repartition("chunk")
        .sortWithinPartitions("chunk", "bucket")
        .mapInArrow(
            _positioned(to_arrow_type(kind)),
            f"doc_id {kind.simpleString()}, n_tokens bigint, ids array<int>",
        )
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` as `encode` returns it, with the text of its `ids` as `decoded`.

    The pieces of the vocabulary, whose number is fixed, are at every worker, and
    each id is joined to its piece there. Null ids decode to the empty text.
    """
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(word_table(path).pieces, pa.binary()).cast(pa.string())
        for batch in slices(batches):
            ids = batch.column("ids")
            met = pieces.take(ids.flatten())
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), met), " ")
            yield batch.append_column("decoded", texts)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded string"
    )
