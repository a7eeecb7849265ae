"""The registered queries over a whole table, held against plain Python."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from plain import classes, fingerprint, words

from tillroll.llm.common import vocabulary
from tillroll.llm.queries import QUERIES


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in docs}


def run(spark, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    return {r.doc_id: r for r in rows}, len(rows)


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op1(spark, folder, texts):
    got, n = run(spark, folder, "op1_passages")
    assert n == len(texts) and got.keys() == texts.keys()
    seen, pairs = {}, []
    for d in sorted(texts):
        w = words(texts[d].lower())
        for i in range(len(w) - 49):
            pairs.append((seen.setdefault(tuple(w[i : i + 50]), d), d))
    assert all(got[a].class_id == got[b].class_id for a, b in pairs)
    assert all(r.class_id <= d and (r.n_links > 0) == bool(r.passages) for d, r in got.items())


def test_op2(spark, folder, texts):
    got, n = run(spark, folder, "op2_language")
    assert n == len(texts)
    for d, r in got.items():
        assert r.held_out == is_held_out(d) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[d]))


def test_op5(spark, folder, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    library.no_truncation()
    library.no_padding()
    got, n = run(spark, folder, "op5_bpe")
    assert n == len(texts)
    for d, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        spelt = " ".join(map(str, ids)).encode()
        want = (len(ids), sha256(spelt).hexdigest(), sha256(decoded.encode()).hexdigest())
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == want


def test_op6(spark, folder, texts):
    got, n = run(spark, folder, "op6_quality")
    assert n == len(texts)
    for d, text in texts.items():
        w, r = words(text), got[d]
        lines = [x for x in text.split("\n") if words(x)]
        spans = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(spans)
        repeated = {k for i, s in enumerate(spans) if often[s] > 1 for k in range(i, i + 3)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        want = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_op8(spark, folder, texts):
    got, n = run(spark, folder, "op8_simhash")
    assert n == len(texts)
    marks = {d: fingerprint(t) for d, t in texts.items()}
    assert {d: int(r.fingerprint, 16) for d, r in got.items()} == marks
    pairs = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 3]
    assert {d: r.component_id for d, r in got.items()} == classes(marks, pairs)


def test_op9(spark, folder, texts):
    got, n = run(spark, folder, "op9_toxicity")
    assert n == len(texts)
    for d, r in got.items():
        assert r.held_out == is_held_out(d) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
        assert not any(is_held_out(i) for i in r.evidence)
