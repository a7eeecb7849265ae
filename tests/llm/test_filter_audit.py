from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import table, words
from pyspark.sql import functions as F

from tillroll.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(60))
ODD = [
    (3, None, "en", None),
    (1, "", "en", ""),
    (2, "", "en", "b"),
    (4, LONG, "en", "b"),
    (4, LONG, "en", "b"),
    (5, LONG, "en", "c"),
    (None, LONG, "en", "c"),
    (None, "only here", "en", "c"),
    (6, LONG + " $", "en", "b"),
    (7, "a " * 60, "en", "b"),
    (8, LONG.upper(), "en", "b"),
    (9, "É" * 10 + "A", "en", "c"),
    (10, "x y\tz\n" * 300_000, "en", "c"),
    (11, "a b " * 30 + "#", "en", "d"),
]
LABELS = [(4, 1, 0), (5, 1, 1), (5, 0, 0), (6, 0, 1), (11, 1, None), (None, 1, 1), (99, 1, 1), (3, None, 1)]


def fails(rows):
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, t, _, s in rows:
        t, w = t or "", words(t)
        failed = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": d is not None and first[t] < d,
        }
        out.append((d, s or "", {f for f, bad in failed.items() if bad}))
    return out


def wanted(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs, out = fails(rows), []
    for part in {p for _, p, _ in docs}:
        mine = [(d, bad) for d, p, bad in docs if p == part]
        shapley, found = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(d, bad) for d, bad in left if f in bad]
                left = [(d, bad) for d, bad in left if f not in bad]
                shapley[f] += len(gone)
                redundant = sum(f in bad for _, bad in mine) - len(gone)
                unique = sum(bad == {f} for _, bad in mine)
                lost = [sum(d in s for d, _ in gone) for s in (good, toxic)]
                found.append(("".join(order), step, f, len(left), len(gone), redundant, unique, *lost))
        out += [(part, o, s, *counts, shapley[f]) for o, s, f, *counts in found]
    return sorted(out)


def told(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("few", [0, 1000])
def test_equals_every_order_played_through(spark, labels, monkeypatch, few):
    monkeypatch.setattr(filter_audit, "_FEW_COPIES", few)
    docs = table(spark, ODD).repartition(3)
    assert told(filter_audit.audit(docs, labels)) == wanted(ODD, LABELS)


def test_empty_tables_and_clashing_columns(spark, labels):
    assert told(filter_audit.audit(table(spark, []), labels)) == []
    clash = table(spark, ODD, {n: "c" for n in ("part", "digest", "failed", "first", "n", "good", "quality")})
    extra = labels.withColumn("part", F.lit("p")).withColumn("failed", F.lit("f"))
    assert told(filter_audit.audit(clash, extra)) == wanted(ODD, LABELS)
    assert told(filter_audit.audit(clash, labels.limit(0))) == wanted(ODD, [])


@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
@settings(max_examples=200, deadline=None)
def test_positional_counts(numbers):
    got = filter_audit.positional_counts(np.array(numbers, dtype=np.uint32))
    assert got.tolist() == [sum(n >> b & 1 for n in numbers) for b in range(32)]


def test_survival_words():
    for failed, word in enumerate(filter_audit.survival_words().tolist()):
        assert [word >> s & 1 for s in range(32)] == [int(not s & failed) for s in range(32)]


def test_a_hot_group_is_not_gathered(spark):
    rows = [(i, "same text", "en", "hot") for i in range(4000)] + [(9000, "other", "en", "hot")]
    got = {r.step: r for r in filter_audit.audit(
        table(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    ).filter("filter_order = 'EABCD'").collect()}
    assert (got[1].removed, got[1].kept, got[2].removed) == (3999, 2, 2)
