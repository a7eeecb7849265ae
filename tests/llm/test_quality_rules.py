import random
import re

import numpy as np
import pytest
from plain import repeat_words, sf_rows, table, words

from tillroll.llm import quality as Q

ODD = [
    None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x", "x y x y x y", "a\n\na\nb\n a\n",
    "#*$ %&|<> é", "l\nl\r\nl\r\n", " ".join(f"w{i}" for i in range(50)), "a b c " * 3000,
    "one\x0btwo\x0cthree\x85four five",
]


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(w),
    )


def test_counts(spark, sf_dir):
    texts = ODD + [t for _, t in sf_rows(spark, sf_dir)]
    docs = table(spark, list(enumerate(texts)), {"_words": "x", "n_words": "y"})
    got = Q.statistics(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == counts(texts[r.doc_id])


def vectors(rows):
    """Features of the texts that pass the base rules."""
    out = {}
    for d, t, lang, source in rows:
        n, chars, symbols, lines, dup, repeat = counts(t)
        if n >= 50 and 100 * repeat <= 50 * n:
            raw = [np.log(chars / n), (symbols / chars) ** 0.5, dup / lines, repeat / n]
            out[d] = ((lang, source), np.floor(np.array(raw) * 65536 + 0.5) / 65536)
    return out


def root(scatter):
    """Triangular root in which no number's own part is under its floor."""
    out = np.zeros((4, 4))
    for i in range(4):
        for j in range(i):
            out[i, j] = (scatter[i, j] - out[i, :j] @ out[j, :j]) / out[j, j]
        out[i, i] = max(scatter[i, i] - out[i, :i] @ out[i, :i], Q.FLOORS[i] ** 2) ** 0.5
    return out


def distances(x, centre, lower):
    return (np.linalg.solve(lower, (x - centre).T) ** 2).sum(0)


def estimate(x, share=Q.SHARE, steps=Q.STEPS):
    """Centre and root of the scatter of one group by the same steps, all rows at hand."""
    bins = np.floor(x * 65536 / 64)
    middle = [np.sort(bins[:, i])[(len(x) + 1) // 2 - 1] * 64 / 65536 for i in range(4)]
    starts = [
        (x.mean(0), root(np.cov(x.T, bias=True).reshape(4, 4))),
        (np.array(middle), root(np.zeros((4, 4)))),
    ]
    best = None
    for centre, lower in starts:
        for _ in range(steps):
            rank = np.floor(np.log2(np.maximum(distances(x, centre, lower), 1e-9)) * 8)
            limit = np.sort(rank)[int(np.ceil(len(x) * share)) - 1]
            near = x[rank <= limit]
            centre = near.mean(0)
            lower = root(np.cov(near.T, bias=True).reshape(4, 4) * Q.consistency(share))
        size = np.log(np.diag(lower)).sum()
        if best is None or size < best[0] - 1e-12:
            best = (size, centre, lower)
    return best[1:]


def test_distances_equal_plain_estimates(spark, sf_dir):
    rows = [(d, t, la, f"s{d % 2}") for d, t, la in sf_rows(spark, sf_dir, "doc_id", "text", "lang")]
    got = {r.doc_id: r for r in Q.judge(table(spark, rows)).collect()}
    known = vectors(rows)
    assert len(got) == len(rows) and {d for d in got if not got[d].base_failed} == set(known)
    groups = {}
    for d, (group, x) in known.items():
        groups.setdefault(group, []).append((d, x))
    checked = 0
    for members in groups.values():
        if len(members) < Q.LEAST_ROWS:
            continue
        x = np.array([v for _, v in members])
        distance = distances(x, *estimate(x))
        for (d, _), want in zip(members, distance, strict=True):
            assert got[d].distance == pytest.approx(want, rel=0.02, abs=0.01)
            checked += 1
    assert checked > 500


def test_junk_goes_and_prose_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    got = Q.judge(docs).join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert len(good) > 250 and all(r.kept for r in good)
    assert len(bad) > 40 and sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_each_kind_of_junk_goes_by_itself(spark):
    """In a clean source: repeated words, repeated lines or symbols that pass the base rules."""
    draw = random.Random(4)
    prose = lambda n: " ".join(draw.choices([f"word{i}" for i in range(3000)], k=n))
    junk = {
        1: lambda: prose(110) + " alpha beta gamma" * 30,
        2: lambda: "\n".join([prose(30) for _ in range(30)] + ["x y"] * 70),
        3: lambda: " ".join(("#" if i % 5 == 0 else "") + w for i, w in enumerate(prose(200).split())),
    }
    rows = [(i, prose(draw.randint(60, 400))) for i in range(400)]
    rows += [(400 + i, prose(100) + " & co") for i in range(10)]
    rows += [(1000 * k + i, make()) for k, make in junk.items() for i in range(10)]
    got = {r.doc_id: r for r in Q.judge(table(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[d].kept == (d < 1000) for d in got)


def test_small_groups_are_pooled(spark):
    prose = " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(60))
    rows = (
        [(i, prose, "en", "big") for i in range(45)]
        + [(100 + i, prose, "en", f"small{i}") for i in range(45)]
        + [(200, prose, "de", "x"), (201, prose, None, None), (201, prose, None, None)]
        + [(300, None, None, None), (None, prose, "en", "big")]
    )
    got = Q.judge(table(spark, rows, {"grp": "g", "kept": "k"}).repartition(3)).collect()
    assert len(got) == len(rows)
    group = {r.doc_id: r.grp for r in got}
    assert '"source":"big"' in group[0] and group[100] == group[140] and "source" not in group[100]
    assert group[200] == group[201] == "rest"
    assert all(r.kept for r in got if r.doc_id != 300) and not [r for r in got if r.doc_id == 300][0].kept


def test_empty_table(spark):
    assert Q.judge(table(spark, [])).count() == 0
    assert Q.judge(table(spark, [(1, "too short")])).first().kept is False


def test_runs_without_python(spark):
    plan = Q.judge(table(spark, [(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_groups_are_summed_before_the_shuffle(spark):
    points = spark.createDataFrame([("g", 1, 2, 3, 4)] * 50, "grp string, " + ", ".join(f"{n} bigint" for n in Q.FEATURES))
    text = Q._estimates(points, "grp")._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_sum") and text.index("partial_sum") > text.index("Exchange")
