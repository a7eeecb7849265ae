"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are hashed five-byte runs of the lower-cased text, all those that toxic rows
have more often than others, by a least ratio and a least certainty, counted over
all labelled rows. A text's vector has, for each term, the root of its count times
its inverse document frequency, at unit length.

Examples lie in an inverted index whose postings are cut into blocks of
examples, with the largest weight of each term in each block. A search adds up
each block's largest weights into a bound, scores the blocks with the largest
bounds and then those others whose bound is above the k nearest so far. So the k
nearest are exact; ties go to the example that comes first. Neighbours vote with weights that grow
as their distance falls, each class in proportion to its share of all labelled
rows; a monotone fit to the examples' own votes, each without itself, turns
votes into probabilities. The neighbours' ids are the evidence.

The index holds at most `MOST_TOXIC` toxic examples and `MOST_OTHERS` others,
those with the smallest hash of the id. Document frequencies are counted over all documents.

Null and empty texts, and texts without a term, get the share of toxic examples
among those without a term. A document labelled twice counts as toxic if one of
its labels says so. Without labelled rows, or with one label only, the score is
that label's (0 without any). Each row gives one row, whatever its id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import blocks, raw_texts, slices, small, stored

MOST_TOXIC = 4096
MOST_OTHERS = 8192
NEIGHBOURS = 15
THRESHOLD = 0.3

_SIZE = 5
_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 64
_OPENING = 6
_LEAST_DOCS = 4
# A term's share of toxic rows against that of all rows, and how sure that must be.
_LEAST_LIFT = 1.5
_LEAST_CHI = 6.0
_KNOWN_QUERIES = 20_000
# Examples whose own votes one task finds.
_FIT_ROWS = 512

# ASCII letters and digits and all bytes of longer characters stay, in lower case.
_PLAIN = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)


def term_hashes(raw: bytes) -> np.ndarray:
    """The bucket of every five-byte run."""
    parts = []
    for block in blocks(raw, 1 << 20):
        plain = b" %b " % b" ".join(block.translate(_PLAIN).split())
        wide = np.frombuffer(plain, dtype=np.uint8).astype(np.uint64)
        runs = wide[: max(0, len(wide) - _SIZE + 1)].copy()
        for i in range(1, _SIZE):
            runs |= wide[i : i + len(runs)] << np.uint64(8 * i)
        parts.append((runs * _ODD) >> np.uint64(64 - _BITS))
    return np.concatenate(parts).astype(np.int64)


@dataclass
class Model:
    """The index and what turns votes into scores."""

    terms: np.ndarray  # bucket of each term
    idf: np.ndarray
    prior: float  # share of toxic rows among all labelled ones
    ids: list = field(default_factory=list)
    toxic: np.ndarray | None = None
    starts: np.ndarray | None = None  # first posting of each term and block, and the end
    postings: np.ndarray | None = None  # example of each posting, by term, then example
    weights: np.ndarray | None = None
    largest: np.ndarray | None = None  # term x block -> largest weight
    class_weight: tuple[float, float] = (1.0, 1.0)
    votes: np.ndarray | None = None  # steps of the monotone fit
    chances: np.ndarray | None = None
    without_terms: float = 0.0

    def __post_init__(self):
        self.place = np.full(1 << _BITS, -1, dtype=np.int32)
        self.place[self.terms] = np.arange(len(self.terms))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "place"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def counts(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The text's terms and how often it has them."""
        found = self.place[term_hashes(raw)]
        found = found[found >= 0].astype(np.int64)
        if not len(found):
            return found, found
        return np.unique(found, return_counts=True)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = np.sqrt(counts) * self.idf[terms]
        return weights / np.sqrt((weights * weights).sum())

    def _cosines(
        self, terms: np.ndarray, weights: np.ndarray, part: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the blocks of `part` that share a term, and their cosines."""
        cells = terms[:, None] * self.largest.shape[1] + part[None, :]
        lo = self.starts[cells]
        sizes = (self.starts[cells + 1] - lo).ravel()
        ends = np.cumsum(sizes)
        at = np.repeat(lo.ravel() - ends + sizes, sizes) + np.arange(ends[-1])
        # Members are counted from the first one of the first block taken.
        base = np.tile(np.arange(len(part)) * _BLOCK - part * _BLOCK, len(terms))
        members = self.postings[at] + np.repeat(base, sizes)
        adds = self.weights[at] * np.repeat(np.repeat(weights, len(part)), sizes)
        sums = np.bincount(members, weights=adds)
        some = np.flatnonzero(sums)
        return part[some // _BLOCK] * _BLOCK + some % _BLOCK, np.round(sums[some], 9)

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above 0, and the cosines."""
        bounds = weights @ self.largest[terms]
        order = np.argsort(-bounds, kind="stable")
        # The first blocks tell how near a neighbour must be; of the others only those count
        # whose bound is above that. Rounding must not leave one out.
        found, cosines = self._cosines(terms, weights, order[:_OPENING])
        found, cosines = found[found != without], cosines[found != without]
        floor = np.partition(cosines, -k)[-k] if len(cosines) >= k else 0.0
        rest = order[_OPENING:]
        rest = rest[(bounds[rest] > 0) & (bounds[rest] >= floor - 1e-8)]
        if len(rest):
            more, others = self._cosines(terms, weights, rest)
            near = (others >= floor) & (more != without)
            found = np.concatenate([found, more[near]])
            cosines = np.concatenate([cosines, others[near]])
        best = np.lexsort((found, -cosines))[:k]
        return found[best], cosines[best]

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """The toxic share of the votes; near neighbours weigh more."""
        weight = cosines / (1.05 - cosines)
        weight = weight * np.where(self.toxic[found], self.class_weight[1], self.class_weight[0])
        return float(weight[self.toxic[found]].sum() / weight.sum())

    def score(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.chances))


def monotone(values: np.ndarray, labels: np.ndarray, weights: np.ndarray, bins: int = 40):
    """Votes and the chances that go with them, rising: pooled neighbours over weighted bins."""
    edges = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)))
    place = np.clip(np.searchsorted(edges, values, side="right") - 1, 0, len(edges) - 1)
    pools: list[list[float]] = []
    for b in np.unique(place):
        mine = place == b
        w = weights[mine]
        pools.append([(values[mine] * w).sum(), (labels[mine] * w).sum(), w.sum()])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return (
        np.array([v / w for v, _, w in pools]),
        np.array([(y + 0.01) / (w + 0.02) for _, y, w in pools]),
    )


def by_document(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of every labelled document, stored."""
    known = labels.filter("doc_id is not null and toxic is not null")
    return stored(known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")), "labels")


def sample(
    docs: DataFrame, labels: DataFrame, most: tuple[int, int] = (MOST_OTHERS, MOST_TOXIC)
) -> tuple[DataFrame, dict]:
    """(doc_id, text, toxic) of the chosen examples, stored; labelled rows by label."""
    return _sample(docs, by_document(labels), most)


def _sample(docs: DataFrame, each: DataFrame, most: tuple[int, int]) -> tuple[DataFrame, dict]:
    sizes = {r.toxic: r.n for r in each.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    some = [
        each.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for value, n in zip((False, True), most, strict=True)
    ]
    # A bounded number of ids.
    chosen = F.broadcast(some[0].union(some[1]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return stored(texts.join(chosen, "doc_id"), "examples"), sizes


def _term_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled rows that have a bucket, by label, of one task; bucket -1 has all of them."""
    total = [0, 0]
    counts = np.zeros((2, 1 << _BITS), dtype=np.int32)
    for batch in slices(batches):
        flags = batch.column("toxic").to_pylist()
        for flag, raw in zip(flags, raw_texts(batch.column("text")), strict=True):
            counts[int(flag), np.unique(term_hashes(raw))] += 1
            total[int(flag)] += 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([-1], pa.int64()),
            pa.array(total[:1], pa.int32()),
            pa.array(total[1:], pa.int32()),
        ],
        names=["bucket", "clean", "toxic"],
    )
    some = np.flatnonzero(counts.any(axis=0))
    for lo in range(0, len(some), 50_000):
        part = some[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(counts[0, part]), pa.array(counts[1, part])],
            names=["bucket", "clean", "toxic"],
        )


def _document_frequencies(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, documents = held.value, 0
        counts = np.zeros(len(model.terms) + 1, dtype=np.int64)
        for batch in slices(batches):
            for raw in raw_texts(batch.column("text")):
                counts[model.counts(raw)[0]] += 1
                documents += 1
        counts[-1] = documents
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(counts))), pa.array(counts)], names=["term", "n"]
        )

    return run


def choose_terms(docs: DataFrame, each: DataFrame) -> np.ndarray:
    """Buckets that toxic rows have far more often than others, the strongest first.

    All of them: their number is bounded by that of the buckets alone.

    `each` (doc_id, toxic) is stored and has every labelled document.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = texts.join(small(each), "doc_id").select("toxic", "text")
    counts = stored(
        labelled.mapInArrow(_term_documents, "bucket bigint, clean int, toxic int")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "terms",
    )
    n0, n1 = counts.filter("bucket = -1").select("clean", "toxic").first()
    share = F.lit(n1 / (n0 + n1))
    expected = (F.col("clean") + F.col("toxic")) * share
    surplus = F.col("toxic") - expected
    chi = surplus * surplus / (expected * (1 - share))
    best = (
        counts.filter("bucket >= 0")
        .filter((F.col("toxic") >= _LEAST_DOCS) & (chi >= _LEAST_CHI))
        # Where most rows are toxic no share can be that much larger.
        .filter(F.col("toxic") >= expected * min(_LEAST_LIFT, 0.5 + 0.5 * (n0 + n1) / n1))
        .orderBy(F.desc(chi), "bucket")
    )
    return np.array([r.bucket for r in best.select("bucket").collect()], dtype=np.int64)


def _index(model: Model, examples: list) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Fills the index with (id, toxic, terms, counts); terms and weights of each example in it."""
    with_terms = [e for e in examples if len(e[2])]
    # Examples that share their heaviest term lie together, which tightens the bounds.
    vectors = [model.vector(np.array(e[2]), np.array(e[3])) for e in with_terms]
    heavy = [e[2][int(np.argmax(v))] for e, v in zip(with_terms, vectors, strict=True)]
    order = sorted(range(len(with_terms)), key=lambda i: (heavy[i], with_terms[i][0]))
    with_terms, vectors = [with_terms[i] for i in order], [vectors[i] for i in order]
    count, n_blocks = len(with_terms), max(1, -(-len(with_terms) // _BLOCK))

    terms = np.array([t for e in with_terms for t in e[2]], dtype=np.int64)
    members = np.repeat(np.arange(count), [len(e[2]) for e in with_terms])
    weights = np.concatenate(vectors) if vectors else np.empty(0)
    by_term = np.lexsort((members, terms))
    terms, members, weights = terms[by_term], members[by_term], weights[by_term]
    cell = terms * n_blocks + members // _BLOCK
    model.largest = np.zeros((len(model.terms), n_blocks))
    np.maximum.at(model.largest.reshape(-1), cell, weights)
    model.starts = np.searchsorted(cell, np.arange(len(model.terms) * n_blocks + 1))
    model.postings, model.weights = members, weights
    model.ids = [e[0] for e in with_terms]
    model.toxic = np.array([e[1] for e in with_terms], dtype=bool)

    return [np.array(e[2], dtype=np.int64) for e in with_terms], vectors


def _votes(spark, model: Model, terms: list, vectors: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Examples that have a neighbour besides themselves, and its votes, found in tasks."""
    held = spark.sparkContext.broadcast((model, terms, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, terms, vectors = held.value
        for batch in batches:
            out = []
            for i in batch.column("id").to_pylist():
                found, cosines = known.nearest(terms[i], vectors[i], k, without=i)
                if len(found):
                    out.append((i, known.vote(found, cosines)))
            columns = [pa.array([o[c] for o in out], t) for c, t in ((0, "int64"), (1, "float64"))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vote"])

    tasks = max(1, -(-len(terms) // _FIT_ROWS))
    # One number for each of the bounded number of examples.
    got = spark.range(0, len(terms), 1, tasks).mapInArrow(run, "id bigint, vote double").toPandas()
    held.unpersist()
    got = got.sort_values("id")
    return got["id"].to_numpy(dtype=np.int64), got["vote"].to_numpy()


def _fit(spark, model: Model, examples: list, sizes: dict, k: int) -> Model:
    """Builds the index and turns the examples' own votes into chances."""
    terms, vectors = _index(model, examples)
    taken = [sum(1 for e in examples if e[1] == flag) for flag in (False, True)]
    model.class_weight = tuple(sizes[f] / max(1, taken[int(f)]) for f in (False, True))
    bare = [e[1] for e in examples if not len(e[2])]
    w0, w1 = model.class_weight
    toxic = sum(bare) * w1
    model.without_terms = (toxic + 0.5) / (toxic + (len(bare) - sum(bare)) * w0 + 1)
    model.votes, model.chances = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    if len(terms):
        which, votes = _votes(spark, model, terms, vectors, k)
        flags = model.toxic[which].astype(float)
        if len(which):
            model.votes, model.chances = monotone(votes, flags, np.where(flags > 0, w1, w0))
    return model


def learn(
    docs: DataFrame,
    labels: DataFrame,
    most: tuple[int, int] = (MOST_OTHERS, MOST_TOXIC),
    neighbours: int = NEIGHBOURS,
) -> Model:
    """A model from `docs` (doc_id, text) and the rows of `labels` (doc_id, toxic)."""
    spark = docs.sparkSession
    each = by_document(labels)
    examples, sizes = _sample(docs, each, most)
    found = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        only = float(next(iter(found))) if found else 0.0
        return Model(np.empty(0, np.int64), np.empty(0), only, without_terms=only)
    terms = choose_terms(docs, each)
    prior = sizes[True] / (sizes[False] + sizes[True])
    model = Model(terms, np.zeros(len(terms)), prior)
    held = spark.sparkContext.broadcast(model)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = (
        texts.mapInArrow(_document_frequencies(held), "term bigint, n bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    df = np.zeros(len(terms) + 1)
    df[counted.term] = counted.n
    model.idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [held.value.counts(raw) for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([t.tolist() for t, _ in found], pa.list_(pa.int32())),
                    pa.array([c.tolist() for _, c in found], pa.list_(pa.int32())),
                ],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    # The bounded number of examples, each with its terms alone.
    rows = examples.select("doc_id", "toxic", "text").mapInArrow(
        vectors, f"doc_id {kind}, toxic boolean, terms array<int>, counts array<int>"
    )
    got = sorted(tuple(r) for r in rows.collect())
    return _fit(spark, model, got, sizes, neighbours)


def score(
    docs: DataFrame,
    model: Model,
    neighbours: int = NEIGHBOURS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`docs` (any columns) with score, predicted and evidence, the ids of the neighbours.

    Columns of `docs` with these names give way to the new ones.
    """
    new = ["score", "predicted", "evidence"]
    docs = docs.drop(*new).withColumn("text", F.col("text").cast("string"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, answers = held.value, {}
        for batch in slices(batches):
            scores, evidence = [], []
            for raw in raw_texts(batch.column("text")):
                terms, counts = known.counts(raw)
                if not len(terms):
                    scores.append(known.without_terms)
                    evidence.append([])
                    continue
                key = (terms.tobytes(), counts.tobytes())
                if key not in answers:
                    if len(answers) >= _KNOWN_QUERIES:
                        answers.clear()
                    vector = known.vector(terms, counts)
                    found, cosines = known.nearest(terms, vector, neighbours)
                    if len(found):
                        chance = known.score(known.vote(found, cosines))
                    else:
                        chance = known.without_terms
                    answers[key] = (chance, [known.ids[i] for i in found])
                chance, ids = answers[key]
                scores.append(chance)
                evidence.append(ids)
            predicted = [int(s >= threshold) for s in scores]
            ids = pa.array(evidence, pa.list_(batch.schema.field("doc_id").type))
            batch = batch.append_column("score", pa.array(scores, pa.float64()))
            batch = batch.append_column("predicted", pa.array(predicted, pa.int32()))
            yield batch.append_column("evidence", ids)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    ddl = f"score double, predicted int, evidence array<{id_kind}>"
    return docs.mapInArrow(run, f"{fields}, {ddl}")
