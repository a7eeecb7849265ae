import hashlib
import random
import zlib

import numpy as np
import pytest
from plain import sf_rows, table
from tokenizers import Tokenizer

from tillroll.llm import bpe, packing
from tillroll.llm.common import vocabulary

ODD = [
    None, "", "  \n", "<|endoftext|> a<|ENDOFTEXT|>b <|startoftext|>", "ΑΣ Σ ὈΔΥΣΣΕΎΣ", "İstanbul ǅ",
    "a b　c\x1cd\x85e", "漢字かな 12½ ٣", "é é x̣́", "don't I'LL we've 's!'s",
    "a×b ÷", "x" * 5000, "\x00a\x7f", "🙂🙃 👨‍👩‍👧", "ſtop K", "'tis ''t t's's",
    " x y​z", "ÉCOLE, Ñ!", "abc<| <|abc", "﷽ﬁ Å",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def mixed(n, seed=3):
    draw = random.Random(seed)
    letters = "abcBZEeÉéß×'.,!<<|> \t\n\x1c\xa012٣İΣσς́漢"
    return ["".join(draw.choices(letters, k=draw.randint(1, 40))) for _ in range(n)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("buckets, size", [(3, 1), (256, 20_000), (256, bpe.CHUNK)])
def test_ids_equal_the_library(spark, sf_dir, library, buckets, size):
    texts = ODD + mixed(1500) + [t for _, t in sf_rows(spark, sf_dir)]
    docs = table(spark, list(enumerate(texts)), {"ids": "x", "n_tokens": "y"})
    got = bpe.decode(bpe.encode(docs.repartition(4), vocabulary(), buckets, size), vocabulary()).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(library, texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_registered_query(spark, sf_dir, library):
    from tillroll.llm.queries import op5_bpe

    texts = dict(sf_rows(spark, sf_dir))
    got = op5_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(library, texts[r.doc_id])
        spelt = " ".join(map(str, ids))
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(spelt.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_a_word_is_encoded_once_for_all_chunks(spark):
    rows = [(i, f"alpha beta gamma{i % 10}") for i in range(1000)]
    docs = table(spark, rows).repartition(4)
    words = bpe.chunks(docs, False, buckets=16, size=200)
    assert words.filter("bucket < 0").count() == 0
    assert bpe.chunks(docs, True, 16, 200).agg({"n_words": "sum"}).first()[0] > 200
    assert words.select("chunk").distinct().count() > 50
    # All chunks have a word in the same bucket.
    held = {}
    for r in words.collect():
        for word in zlib.decompress(r.blob).split(b"\n"):
            held.setdefault(word, set()).add(r.bucket)
    assert len(held) == 12 and all(len(b) == 1 for b in held.values())


def test_texts_that_are_shuffled_are_stored_first(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert bpe._reads_alike(docs) and bpe._reads_alike(docs.filter("doc_id > 3"))
    assert not bpe._reads_alike(docs.repartition(3)) and not bpe._reads_alike(docs.distinct())


def test_odd_tables(spark):
    rows = [(1, None), (1, ""), (None, " \n"), (None, "the end")]
    got = bpe.decode(bpe.encode(table(spark, rows), vocabulary()), vocabulary()).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in got) == [
        ("1", 0, ""), ("1", 0, ""), ("None", 0, ""), ("None", 2, "the</w> end</w>"),
    ]
    assert bpe.encode(table(spark, []), vocabulary()).count() == 0
    none = spark.createDataFrame([(1, 0, None)], "doc_id int, n_tokens bigint, ids array<int>")
    assert bpe.decode(none, vocabulary()).first().decoded == ""


def test_words_that_could_hold_a_special_token(library):
    draw, table = random.Random(11), bpe.WordTable(vocabulary())
    for _ in range(30_000):
        text = "".join(draw.choices("BZEaz <<|>.", k=draw.randint(1, 14)))
        assert np.frombuffer(table.encode(text.encode()), "<u4").tolist() == ids_of(library, text)


def test_punctuation_behind_words_is_merged_once(library):
    class Counted:
        def __init__(self, model):
            self.model, self.pieces = model, []

        def tokenize(self, piece):
            self.pieces.append(piece)
            return self.model.tokenize(piece)

    table = bpe.WordTable(vocabulary())
    table.model = Counted(table.model)
    letters = [f"{a}{b}" for a in "abcde" for b in "fghij"]
    text = " ".join(f"{w}{p}" for w in [*letters, "été"] for p in ("", ",", '."', "?!..."))
    assert np.frombuffer(table.encode(text.encode()), "<u4").tolist() == ids_of(library, text)
    assert len(table.model.pieces) <= len(letters) + 1 + 3


def test_a_full_table_is_emptied(library):
    small = bpe.WordTable(vocabulary(), most_words=5)
    for text in mixed(300, 4):
        assert np.frombuffer(small.encode(text.encode()), "<u4").tolist() == ids_of(library, text)
    assert len(small) <= 10


def test_long_texts_are_cut_between_words(library, monkeypatch):
    monkeypatch.setattr("tillroll.llm.common.BLOCK", 64)
    text = " ".join(mixed(400, 5))
    parts = list(bpe.blocks(text.encode(), 64))
    assert b"".join(parts) == text.encode() and len(parts) > 50
    whole = bpe.WordTable(vocabulary())
    assert b"".join(whole.encode(p) for p in parts) == whole.encode(text.encode())


def pieces(spark, rows, window, partitions=3):
    docs = table(spark, rows, {"part": "p", "n": "n", "at": "a", "first": "f"}).repartition(partitions)
    return packing.pack(docs, vocabulary(), window).collect()


@pytest.mark.parametrize("window", [16, 2048])
def test_every_id_lies_in_one_piece(spark, sf_dir, library, window):
    rows = sf_rows(spark, sf_dir)[:200] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    got = pieces(spark, rows, window)
    whole = {d: [*ids_of(library, t), packing.END_ID] for d, t in rows}
    at, taken = {}, {d: [] for d in whole}
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert p.offset == at.get(p.sequence_id, 0) and len(ids) == p.length > 0
        at[p.sequence_id] = p.offset + p.length
        assert p.start == len(taken[p.doc_id]) and p.doc_tokens == len(whole[p.doc_id])
        taken[p.doc_id] += ids
        assert p.continues == (len(taken[p.doc_id]) < len(whole[p.doc_id]))
        assert not p.continues or at[p.sequence_id] == window
    assert taken == whole
    assert sorted(at) == list(range(len(at)))
    assert all(n == window for s, n in at.items() if s != max(at))


def test_empty_texts_and_tables(spark):
    got = pieces(spark, [(1, None), (1, ""), (None, " ")], 8)
    assert [np.frombuffer(p.ids, "<u4").tolist() for p in got] == [[1]] * 3
    assert pieces(spark, [], 8) == []


def test_query_digest(spark, sf_dir):
    from tillroll.llm.queries import op3_packing

    got = {(r.doc_id, r.start): r.ids_crc32 for r in op3_packing(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for p in packing.pack(docs, vocabulary()).collect():
        assert got[p.doc_id, p.start] == zlib.crc32(p.ids)
