from pathlib import Path

import numpy as np
import pytest
from plain import sf_rows, table

from tillroll.llm import toxicity as T
from tillroll.llm.common import held_out

SLURS = ["scumbag", "worthless", "idiotic"]


def corpus(n=300, seed=1):
    """Texts of common words; every third is rude."""
    draw = np.random.default_rng(seed)
    common = ["table", "river", "window", "garden", "silver", "music", "paper", "yellow"]
    rows = []
    for i in range(n):
        text = list(draw.choice(common, size=30))
        if i % 3 == 0:
            for w in draw.choice(SLURS, size=2):
                text[draw.integers(0, 30)] = str(w)
        rows.append((i, " ".join(text)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    labels = spark.createDataFrame([(d, int(d % 3 == 0)) for d, _ in rows], "doc_id bigint, toxic int")
    return rows, T.learn(table(spark, rows), labels.filter("doc_id % 5 <> 4"))


def test_unseen_rows(spark, fitted):
    rows, model = fitted
    got = T.score(table(spark, corpus(200, 9)), model).collect()
    assert all((r.predicted == 1) == (r.doc_id % 3 == 0) for r in got)
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.3) for r in got)
    assert all(i % 3 == 0 for r in got if r.predicted for i in r.evidence)


def test_held_out_rows_of_the_table(spark, sf_dir):
    folder = Path(sf_dir).parent / "sf0.1"
    folder = folder if folder.exists() else Path(sf_dir)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    model = T.learn(docs, labels.filter(~held_out()))
    got = T.score(docs.filter(held_out()), model).join(labels, "doc_id").collect()
    clean = [r for r in got if r.toxic == 0]
    toxic = [r for r in got if r.toxic == 1]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)


def dense(model):
    full = np.zeros((len(model.ids), len(model.terms)))
    n_blocks = model.largest.shape[1]
    for t in range(len(model.terms)):
        lo, hi = model.starts[t * n_blocks], model.starts[(t + 1) * n_blocks]
        full[model.postings[lo:hi], t] = model.weights[lo:hi]
    return full


@pytest.mark.parametrize("k", [1, 5, 15])
def test_nearest_are_exact(fitted, monkeypatch, k):
    rows, model = fitted
    full = dense(model)
    assert np.allclose((full**2).sum(1), 1)
    draw = np.random.default_rng(k)
    for _ in range(200):
        terms = np.sort(draw.choice(len(model.terms), size=draw.integers(1, 12), replace=False))
        vector = model.vector(terms, draw.integers(1, 4, len(terms)))
        cosine = np.round(full[:, terms] @ vector, 9)
        order = np.lexsort((np.arange(len(cosine)), -cosine))
        order = order[cosine[order] > 0][:k]
        found, scores = model.nearest(terms, vector, k)
        assert scores == pytest.approx(cosine[order]) and found.tolist() == order.tolist()


def plain_vote(model, cosine, k):
    """Votes over all examples by a full sort."""
    order = sorted(range(len(cosine)), key=lambda i: (-cosine[i], i))
    near = [i for i in order if cosine[i] > 0][:k]
    each = [cosine[i] / (1.05 - cosine[i]) * model.class_weight[bool(model.toxic[i])] for i in near]
    toxic = sum(w for w, i in zip(each, near, strict=True) if model.toxic[i])
    return near, toxic / sum(each) if near else None


def test_fit_against_all_pairs_of_examples(spark, fitted):
    _, model = fitted
    full = dense(model)
    cosine = np.round(full @ full.T, 9)
    np.fill_diagonal(cosine, 0)
    votes = [plain_vote(model, row, T.NEIGHBOURS)[1] for row in cosine]
    some = [i for i, v in enumerate(votes) if v is not None]
    flags = model.toxic[some].astype(float)
    weights = np.where(flags > 0, model.class_weight[1], model.class_weight[0])
    x, y = T.monotone(np.array([votes[i] for i in some]), flags, weights)
    assert model.votes == pytest.approx(x) and model.chances == pytest.approx(y)


def test_scores_against_all_examples(spark, fitted):
    _, model = fitted
    full = dense(model)
    rows = corpus(120, 17)
    got = {r.doc_id: r for r in T.score(table(spark, rows), model).collect()}
    with_terms = 0
    for d, text in rows:
        terms, counts = model.counts(text.encode())
        near, vote = [], None
        if len(terms):
            near, vote = plain_vote(model, np.round(full[:, terms] @ model.vector(terms, counts), 9), T.NEIGHBOURS)
        with_terms += bool(near)
        want = model.without_terms if vote is None else np.interp(vote, model.votes, model.chances)
        assert got[d].score == pytest.approx(want) and got[d].evidence == [model.ids[i] for i in near]
    assert with_terms > 20


def test_document_frequencies_cover_all_documents(spark, fitted):
    rows, model = fitted
    df = np.zeros(len(model.terms))
    for _, text in rows:
        df[model.counts(text.encode())[0]] += 1
    assert np.allclose(model.idf, np.log((len(rows) + 1) / (df + 1)) + 1)


def test_odd_texts(spark, fitted):
    _, model = fitted
    rows = [(1, None), (2, ""), (2, ""), (None, "worthless idiotic"), (5, "garden " * 100_000), (6, "漢字")]
    docs = table(spark, rows, {"score": "x", "evidence": "y", "predicted": "z"})
    got = T.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.predicted == 1 and r.evidence
        else:
            assert (r.score, r.evidence) == (model.without_terms, [])
    assert T.score(table(spark, []), model).count() == 0


def test_prediction_sees_the_text_alone(spark, fitted):
    _, model = fitted
    rows = corpus(40, 4)
    a = T.score(table(spark, [(d, t, "en", "s") for d, t in rows]), model).collect()
    b = T.score(table(spark, [(d + 7, t, None, "q") for d, t in rows]), model).collect()
    assert [r.score for r in a] == [r.score for r in b]


def test_little_to_learn(spark):
    docs = table(spark, corpus(20))
    for rows, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0), ([(1, None), (None, 1)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        model = T.learn(docs, labels)
        assert {r.score for r in T.score(docs, model).collect()} == {score}


def test_sample_is_bounded_and_repeatable(spark):
    rows = corpus(90)
    labels = [(d, int(d % 3 == 0)) for d, _ in rows] + [(1, 1), (0, 0)]
    got = []
    for parts in (1, 4):
        frame = spark.createDataFrame(labels, "doc_id bigint, toxic int").repartition(parts)
        examples, sizes = T.sample(table(spark, rows), frame, most=(12, 10))
        got.append(sorted((r.doc_id, r.toxic) for r in examples.collect()))
        assert sizes == {True: 31, False: 59}
    assert got[0] == got[1] and len(got[0]) == 22


def test_terms_come_from_all_labelled_rows(spark):
    """Each slur is in 6 of 60 toxic rows; of 20 sampled ones, two or so have it."""
    slurs = [f"qz{chr(97 + i)}x{chr(107 + i)}" for i in range(10)]
    draw = np.random.default_rng(3)
    common = ["table", "river", "window", "garden", "silver", "music", "paper", "yellow"]
    rows = []
    for i in range(600):
        text = list(draw.choice(common, size=30))
        if i % 10 == 0:
            text[7] = slurs[i // 10 % 10]
        rows.append((i, " ".join(text)))
    labels = spark.createDataFrame([(d, int(d % 10 == 0)) for d, _ in rows], "doc_id bigint, toxic int")
    model = T.learn(table(spark, rows), labels, most=(60, 20))
    known = set(model.terms.tolist())
    assert len(model.ids) <= 80
    assert all(known & set(T.term_hashes(w.encode()).tolist()) for w in slurs)


def test_monotone_fit():
    draw = np.random.default_rng(0)
    votes = draw.random(2000)
    labels = (draw.random(2000) < votes**2).astype(float)
    x, y = T.monotone(votes, labels, np.ones(2000))
    assert (np.diff(y) >= 0).all() and abs(np.interp(0.8, x, y) - 0.64) < 0.1


def test_whole_texts_are_read():
    text = ("river " * 400_000 + "worthless").encode()
    assert set(T.term_hashes(b"worthless").tolist()) <= set(T.term_hashes(text).tolist())


def test_terms_ignore_case_and_punctuation(spark, sf_dir):
    a, b = T.term_hashes(b"You, IDIOT!"), T.term_hashes(b"you idiot")
    assert a.tolist() == b.tolist()
    assert len(T.term_hashes(b"")) == 0 and sf_rows(spark, sf_dir)
