import re
from collections import defaultdict

import pytest
from plain import sf_rows, table

from tillroll.llm import exact_dedup

ODD = [
    (3, "a b\tc"),
    (1, "abc"),
    (2, "a  b  c"),
    (9, None),
    (8, ""),
    (7, " \n"),
    (None, "x y"),
    (6, "xy"),
    (5, "only"),
    (4, "only"),
    (4, "only"),
    (10, " only"),
    (11, "y" * 200_000),
]


def wanted(rows):
    """(doc_id, keep_id, size) of each row, and how many of each group stay."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), d is None, d))
    return sorted(
        (str(d), str(min(g)[2]), len(g)) for g in groups.values() for _, _, d in g
    ), len(groups)


@pytest.mark.parametrize("most_bits", [exact_dedup.SHARD_BITS, 1 << 29])
def test_report(spark, sf_dir, most_bits):
    for rows in (ODD, sf_rows(spark, sf_dir)):
        got = exact_dedup.duplicate_report(table(spark, rows), most_bits).collect()
        told, groups = wanted(rows)
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == told
        assert sum(r.kept for r in got) == groups
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_rows_that_stay_keep_their_columns(spark):
    clash = {"digest": "d", "hash": "h", "maybe": "m", "kept": "k", "points": "p"}
    docs = table(spark, ODD, clash).repartition(3)
    got = exact_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r.doc_id for r in rows} == {2, 7, None, 4, 10, 11}
    assert all((r.digest, r.maybe) == ("d", "m") for r in rows)


def test_empty_table(spark):
    docs = table(spark, [])
    assert exact_dedup.duplicate_report(docs).count() == 0
    assert exact_dedup.deduplicate(docs).count() == 0


def test_only_possible_repeats_are_grouped(spark):
    rows = [(i, f"text {i}") for i in range(5000)] + [(9000 + i, "same") for i in range(50)]
    stored = exact_dedup.stored(exact_dedup.text_digests(table(spark, rows)), "digests")
    flagged = exact_dedup.flag_repeats(stored, *exact_dedup.second_filter(stored))
    maybe = {r.doc_id for r in flagged.filter("maybe").collect()}
    assert maybe >= {9000 + i for i in range(50)} and len(maybe) < 100
