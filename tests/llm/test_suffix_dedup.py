import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from plain import removed, sf_rows, table

from pyspark.sql import functions as F

from tillroll.llm import suffix_dedup as S
from tillroll.llm import suffix_sort
from tillroll.llm.suffix_sort import suffix_array, suffixes


def result(docs, **options):
    got = S.remove_repeats(docs, **options).collect()
    for r in got:
        assert all(a < b for a, b in r.spans) and r.n_bytes == len(r.kept) + sum(
            b - a for a, b in r.spans
        )
    return sorted((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in got)


def stitched(n=160, seed=2):
    """Texts put together from shared passages, with copies, edits and runs of one letter."""
    draw = random.Random(seed)
    letters = "abcdefgh é\n漢"
    passages = ["".join(draw.choices(letters, k=draw.randint(20, 160))) for _ in range(25)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 5)):
            text = draw.choice(passages)
            if draw.random() < 0.4:
                at = draw.randrange(len(text))
                text = text[:at] + draw.choice(letters) + text[at + 1 :]
            parts.append(draw.choice([text, text[draw.randrange(len(text)) :], "z" * draw.randint(0, 120)]))
        rows.append((i, "".join(parts)))
    rows += [(n + i, rows[draw.randrange(n)][1]) for i in range(40)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"crowded": 1}, {"in_memory": 7}, {"sort_bytes": 1 << 24, "in_memory": 64}, {"sort_bytes": 1}, {"shard_bytes": 500, "bucket_bytes": 300}, {"most_bits": 12}])
def test_against_every_string(spark, options):
    rows = stitched()
    docs = table(spark, rows, {"key": "k", "bucket": "b", "shard": "s"}).repartition(5)
    assert result(docs, **options) == removed(rows, S.LENGTH)


@pytest.mark.parametrize("length", [32, 50, 75])
def test_whole_table(spark, sf_dir, length):
    rows = sf_rows(spark, sf_dir)[:400]
    assert result(table(spark, rows), length=length) == removed(rows, length)


def test_query_digest(spark, sf_dir):
    import hashlib

    from tillroll.llm.queries import op7_suffix_dedup

    rows = sf_rows(spark, sf_dir)
    got = sorted(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in op7_suffix_dedup(spark, sf_dir).collect()
    )
    assert got == [
        (d, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())
        for d, n, spans, kept in removed(rows, 50)
    ]


def test_odd_rows(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(5, None), (6, ""), (7, text[:49]), (8, text), (8, text), (8, text + "!"), (None, text), (2**62, text)]
    got = S.remove_repeats(table(spark, rows)).collect()
    kept = sorted((str(r.doc_id), len(r.kept)) for r in got)
    size = len(text)
    assert kept == sorted(
        [("5", 0), ("6", 0), ("7", 49), ("8", size), ("8", size), ("8", size + 1), ("None", 0), (str(2**62), 0)]
    )
    assert S.remove_repeats(table(spark, [])).count() == 0


def test_rows_without_id_are_spread_by_their_texts(spark):
    """100,000 rows without id, each with a passage that a document with an id has."""
    passage = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(30))
    rows = spark.range(100_000).select(
        F.lit(None).cast("bigint").alias("doc_id"),
        F.concat(F.col("id").cast("string"), F.lit(" "), F.lit(passage)).alias("text"),
    )
    first = spark.createDataFrame([(7, passage)], "doc_id bigint, text string")
    both = rows.unionByName(first)
    doc = F.coalesce("doc_id", F.lit(S.LAST_ID))
    spread = both.select(S.bucket_of(doc, F.xxhash64("text"), 101).alias("b")).groupBy("b").count()
    assert spread.count() == 101 and spread.agg(F.max("count")).first()[0] < 1300
    got = S.remove_repeats(both, bucket_bytes=100_000)
    sizes = got.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("kept")).alias("kept"))
    prefixes = sum(len(str(i)) + 1 for i in range(100_000))
    # "N " before the passage stays, and at "N" alone no removed string starts.
    assert {r.doc_id: (r.n, r.kept) for r in sizes.collect()} == {7: (1, len(passage)), None: (100_000, prefixes)}


def test_long_texts_go_in_parts(monkeypatch):
    draw = random.Random(1)
    raw = "".join(draw.choices("abcd", k=9000)).encode()
    whole = S.Batch([(0, 0, raw)], 50)
    monkeypatch.setattr(S, "_PIECE", 700)
    covered = []
    for parts in S._parts([raw, b"short"], 50):
        got = S.Batch(parts, 50)
        for place, count, value in zip(got.place, got.count, got.hash, strict=True):
            covered += [(int(place) + i, int(value)) for i in range(count)]
    wanted = [
        (int(p) + i, int(h)) for p, c, h in zip(whole.place, whole.count, whole.hash, strict=True) for i in range(c)
    ]
    assert sorted(covered) == sorted(wanted) and len(covered) == 9000 - 49


def phrases(n=300, seed=4):
    """Texts of common phrases of 17 to 30 bytes with a word of their own after each."""
    draw = random.Random(seed)
    common = ["".join(draw.choices("abcdefgh", k=draw.randint(17, 30))) for _ in range(40)]
    return [
        (i, " ".join(f"{draw.choice(common)} {draw.getrandbits(48):x}" for _ in range(12))) for i in range(n)
    ]


@pytest.mark.parametrize("length", [32, 50, 75])
def test_what_meets_shares_a_core(length):
    """Only halves that share two thirds of a string's bytes have a hash in common."""
    raws = [t.encode() for _, t in stitched(60)]
    data = b"".join(t for t in raws if len(t) >= length)
    got = S.Batch([(i, 0, t) for i, t in enumerate(raws) if len(t) >= length], length)
    assert got.data == data
    by_hash = {}
    for start, count, value, anchor in zip(
        got.start.tolist(), got.count.tolist(), got.hash.tolist(), got.anchor.tolist(), strict=True
    ):
        far = anchor - start >= S.half_width(length)
        core = anchor - S.half_width(length) * far
        # All strings of the half have the core.
        assert start + count - 1 <= core and core + S.core_length(length) <= start + length
        by_hash.setdefault(value, set()).add((far, data[core : core + S.core_length(length)]))
    assert all(len(x) == 1 for x in by_hash.values()) and len(by_hash) > 100


def test_common_phrases_do_not_meet():
    """Strings that share a phrase with others, but not two thirds of their bytes, are not moved."""
    found = [S.Batch([(0, 0, t.encode())], 50) for _, t in phrases()]
    values, docs = np.unique(np.concatenate([np.unique(b.hash) for b in found]), return_counts=True)
    assert len(values) > 4000 and (docs > 1).sum() < 50


class Stub:
    """Every hash is in several documents; those that `many` tells are in very many."""

    def __init__(self, many):
        self.in_very_many = many

    def __call__(self, hashes):
        return np.ones(len(hashes), dtype=bool)


def shard_of_all(rows, many, sort_bytes=S._SORT_BYTES):
    """What one shard of all segments removes: (id, bytes left) by row."""
    batches = []
    for lo in range(0, len(rows), 10):
        ids, texts = zip(*rows[lo : lo + 10], strict=True)
        batches.append(
            pa.record_batch({"doc_id": pa.array(ids), "text": pa.array(texts), "tag": pa.array(ids)})
        )
    segments = []
    for batch in batches:
        segments += S._take_segments(50, 1, SimpleNamespace(value=Stub(many)))([batch])
    spans = [[] for _ in range(4)]
    for out in S._resolve(50, 1, 1 << 20, sort_bytes, None)(segments):
        for column, name, kind in zip(spans, S._SPANS[1:], S._SPAN, strict=True):
            column += np.frombuffer(b"".join(out.column(name).to_pylist()), dtype=kind).tolist()
    own = {}
    for doc, _, start, end in zip(*spans, strict=True):
        own.setdefault(doc, set()).update(range(start, end))
    return [
        (doc, bytes(b for at, b in enumerate(text.encode()) if at not in own.get(doc, ())))
        for doc, text in sorted(rows)
    ]


@pytest.mark.parametrize("sort_bytes", [1, 1 << 20])
@pytest.mark.parametrize("apart", ["none", "smallest", "some", "all"])
def test_halves_together_and_apart(apart, sort_bytes):
    """The same bytes go whether halves travel together, by their cores or as single strings."""
    rows = stitched(120, seed=9)
    smallest = np.concatenate([S.Batch([(0, 0, t.encode())], 50).smallest for _, t in rows if len(t.encode()) >= 50])
    many = {
        "none": lambda x: np.zeros(len(x), dtype=bool),
        "smallest": lambda x: np.isin(x ^ S._SMALLEST, smallest),
        "some": lambda x: x % np.uint64(3) == 0,
        "all": lambda x: np.ones(len(x), dtype=bool),
    }[apart]
    wanted = [(doc, kept) for doc, _, _, kept in removed(rows, 50)]
    assert shard_of_all(rows, many, sort_bytes) == wanted


def test_sorter_gets_no_common_phrases(monkeypatch):
    """Texts of phrases that all have: what is compared by suffixes is no more than what shares cores."""
    sorted_bytes = []
    strings = S.repeated_strings

    def watched(texts, *others):
        sorted_bytes.append(sum(map(len, texts)))
        return strings(texts, *others)

    monkeypatch.setattr(S, "repeated_strings", watched)
    rows = phrases()
    wanted = [(doc, kept) for doc, _, _, kept in removed(rows, 50)]
    assert shard_of_all(rows, lambda x: np.zeros(len(x), dtype=bool)) == wanted
    assert sum(sorted_bytes) < sum(len(t) for _, t in rows) // 10


@pytest.mark.parametrize("in_memory", [2, 1 << 20])
def test_suffix_order(in_memory):
    draw = np.random.default_rng(0)
    for _ in range(150):
        parts = [
            np.r_[draw.integers(1, int(draw.integers(2, 5)), size=int(draw.integers(1, 30))), 300 + i]
            for i in range(int(draw.integers(1, 6)))
        ]
        text = np.concatenate([*parts, [0]]).astype(np.int32)
        wanted = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text, 256, in_memory).tolist() == wanted


def test_queue_files_are_removed(tmp_path, monkeypatch):
    import tempfile

    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    text = np.r_[np.random.default_rng(1).integers(1, 5, 3000), 300, 0].astype(np.int32)
    suffix_array(text, 256, in_memory=10)
    assert list(tmp_path.iterdir()) == []


def separated(draw, parts, letters, longest):
    """Random strings, each with an end of its own, and a last 0."""
    made = [
        np.r_[draw.integers(1, letters, size=int(draw.integers(1, longest))), 300 + i] for i in range(parts)
    ]
    return np.concatenate([*made, [0]]).astype(np.int32)


@pytest.mark.parametrize("in_memory", [2, 30, 1 << 20])
@pytest.mark.parametrize("cap", [1, 5, 50])
def test_carried_prefixes(in_memory, cap, tmp_path):
    """Order and common prefixes against plain comparison, also when queues spill and names recurse."""

    def shared(a, b):
        return next((i for i in range(min(cap, len(a), len(b))) if a[i] != b[i]), min(cap, len(a), len(b)))

    draw = np.random.default_rng(cap)
    for _ in range(60):
        text = separated(draw, int(draw.integers(1, 6)), int(draw.integers(2, 5)), 40)
        ends = [text[i:].tolist() for i in range(len(text))]
        wanted = sorted(range(len(text)), key=ends.__getitem__)
        order, common = suffixes(text, 256, cap, in_memory, tmp_path.as_uri())
        assert order.tolist() == wanted
        pairs = zip(wanted, wanted[1:], strict=False)
        assert common.tolist() == [0, *[shared(ends[a], ends[b]) for a, b in pairs]]
    assert list(tmp_path.iterdir()) == []


def test_more_than_the_queues_hold(tmp_path, monkeypatch):
    """A shard of many times what queues hold gives the order that it gives in memory."""
    spills, names = [], []
    spill, doubling = suffix_sort.SymbolQueue._spill, suffix_sort.ranks_by_doubling

    def counted(queue):
        spills.append(queue.held)
        spill(queue)

    def watched(short):
        names.append(len(short))
        return doubling(short)

    draw = np.random.default_rng(5)
    passages = [draw.integers(1, 27, size=80) for _ in range(30)]
    parts = [np.r_[passages[int(draw.integers(30))], 300 + i] for i in range(500)]
    text = np.concatenate([*parts, [0]]).astype(np.int32)
    in_memory = suffixes(text, 256, 50)
    monkeypatch.setattr(suffix_sort.SymbolQueue, "_spill", counted)
    monkeypatch.setattr(suffix_sort, "ranks_by_doubling", watched)
    on_disk = suffixes(text, 256, 50, 200, str(tmp_path))
    assert all((a == b).all() for a, b in zip(in_memory, on_disk, strict=True))
    assert len(spills) > 50 and max(names) <= 800 < len(text) // 10
    assert list(tmp_path.iterdir()) == []


def test_caps_beyond_a_tuple_are_refused():
    text = np.array([1, 2, 0], dtype=np.int32)
    with pytest.raises(ValueError, match="common prefixes"):
        suffixes(text, 256, 256)
