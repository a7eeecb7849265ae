import random

import numpy as np
import pytest
from plain import classes, fingerprint, sf_rows, table

from tillroll.llm import simhash


def expected(rows, radius=3):
    marks = {d: fingerprint(t) for d, t in rows}
    distinct = sorted(set(marks.values()))
    low = {m: min(d for d in marks if marks[d] == m) for m in distinct}
    near = [
        (low[a], low[b])
        for i, a in enumerate(distinct)
        for b in distinct[i + 1 :]
        if (a ^ b).bit_count() <= radius
    ]
    same = [(d, low[m]) for d, m in marks.items()]
    return marks, classes(marks, near + same)


def test_whole_table_against_all_pairs(spark, sf_dir):
    rows = sf_rows(spark, sf_dir)
    marks, low = expected(rows)
    got = simhash.near_duplicates(table(spark, rows)).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == marks
    assert {r.doc_id: r.component_id for r in got} == low
    assert len(set(low.values())) < len(rows)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_leave_no_pair_out(radius):
    draw = random.Random(radius)
    masks = simhash.covering_masks(radius)
    for _ in range(3000):
        bits = draw.sample(range(64), draw.randint(0, radius))
        change = sum(1 << b for b in bits)
        assert any(change & m == 0 for m in masks)


def dense(draw, n):
    """Fingerprints that crowd around a few centres."""
    centres = draw.integers(0, 2**63, 5, dtype=np.uint64)
    marks = centres[draw.integers(0, 5, n)]
    for _ in range(4):
        marks = marks ^ (np.uint64(1) << draw.integers(0, 64, n, dtype=np.uint64))
    return np.unique(marks)


@pytest.mark.parametrize("split_above", [2, 40, 20_000])
def test_links_connect_dense_groups(spark, split_above):
    marks = dense(np.random.default_rng(3), 1200)
    signed = marks.view(np.int64).tolist()
    nodes = spark.createDataFrame([(m,) for m in signed], "fp bigint").repartition(4)
    found = simhash.fingerprint_links(nodes, split_above=split_above).collect()
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 3
    pairs = [(int(i), int(j)) for i, j in np.argwhere(np.triu(near, 1))]
    place = {m: i for i, m in enumerate(signed)}
    got = [(place[r.a], place[r.b]) for r in found]
    assert all(near[i, j] for i, j in got)
    assert classes(range(len(marks)), got) == classes(range(len(marks)), pairs)
    assert len(found) < 15 * 4**3 * len(marks)


def test_a_large_bucket_is_split():
    marks = dense(np.random.default_rng(5), 6000)
    near = list(simhash.bucket_links(marks, 3))
    place = {int(m): i for i, m in enumerate(marks)}
    got = [(place[a], place[b]) for a, b in near]
    all_near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 3
    pairs = [(int(i), int(j)) for i, j in np.argwhere(np.triu(all_near, 1))]
    assert classes(range(len(marks)), got) == classes(range(len(marks)), pairs)


def test_odd_texts(spark):
    rows = [(4, None), (3, ""), (5, " \t"), (None, None), (7, "one two"), (8, "ONE  two"), (6, "z")]
    got = simhash.near_duplicates(table(spark, rows, {"fp": "x", "root": "y", "first": "z"}))
    found = {r.doc_id: (r.fp % 2**64, r.component_id) for r in got.collect()}
    assert found[4] == found[3] == found[5] == found[None] == (0, 3)
    assert found[7] == found[8] == (fingerprint("one two"), 7)
    assert found[6][1] == 6
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    alone = simhash.near_duplicates(table(spark, [(None, "a b c d")])).collect()
    assert [r.component_id for r in alone] == [None]


def test_long_text_in_parts():
    text = " ".join(f"w{i % 997}" for i in range(200_000))
    assert simhash.fingerprint(text.encode()) == fingerprint(text)


def test_one_of_each_keeps_columns(spark):
    rows = [(4, "a b c d"), (2, "A b c D"), (9, "other text here"), (9, "other text here"), (None, "q r s")]
    docs = table(spark, rows, {"_first": "f", "component_id": "c"})
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == ["2", "9", "None"]
    assert simhash.one_of_each(table(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = [
        (None, "x"), (None, "x"), (None, "x"), (0, "x"), (1, "x"), (1, "quite another text here"),
        (2, "x"), (None, "alone and without id"), (None, "alone and without id"), (3, None), (4, ""),
        (5, "two rows of one text and id"), (5, "two rows of one text and id"), (6, "kept"),
    ]
    docs = table(spark, rows, {"fp": "f", "_id": "i", "row": "r"}).repartition(3)
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    wanted = [
        (0, "x"), (1, "quite another text here"), (None, "alone and without id"), (3, None),
        (5, "two rows of one text and id"), (6, "kept"),
    ]
    kept = sorted([(r.doc_id, r.text) for r in got.collect()], key=str)
    assert kept == sorted(wanted, key=str)
    assert simhash.one_of_each(docs.filter("false")).count() == 0
