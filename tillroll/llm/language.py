"""Language of a text by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed byte
n-grams (naive Bayes, every language with the same weight) tells the languages
with a one from those with a zero. Decoding adds up, for each language, the loss
of every bit's answer against its codeword, weighted by how well that bit does
on that language in training; the smallest sum wins. The score is the winner's
share when losses are turned into probabilities, and a small lead over the
second language flags the text as ambiguous.

Learning reads every labelled row that it is given: n-gram counts by language,
then right answers by language and bit. Languages times buckets numbers reach
the driver, whatever the number of rows.

Null texts and texts without a letter are `und` with score 0. Rows without a
language or text teach nothing. With nothing learned everything is `und`; with
one language every text with a letter is that one. Texts of any length are taken
in blocks. Each row gives one row, whatever its id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import blocks, raw_texts, set_aside, slices

UNKNOWN = "und"
BUCKETS = 1 << 14
LENGTHS = (1, 2, 3)
SMOOTHING = 0.5
# n-grams overlap and follow from each other, so their evidence is divided by this.
TEMPER = 8.0
# No n-gram counts for more than this, so that a passage in another language does not outvote
# a longer text by its rare letters.
STRONGEST = 0.5
# Leads below this are ambiguous; a score of two thirds has a lead of log 2.
LEAD = 0.7

_EXHAUSTIVE = 5
_SALTS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
_LETTER = re.compile(rb"[A-Za-z]")
_MOST = 30.0


def ngram_counts(raw: bytes) -> np.ndarray:
    """Hashed byte n-grams of the text in lower case, white space as one space."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for block in blocks(raw):
        plain = np.frombuffer(b" %b " % b" ".join(block.lower().split()), dtype=np.uint8)
        grams = plain.astype(np.uint32)
        for length in LENGTHS:
            if length > 1:
                grams = grams[:-1] | (plain[length - 1 :].astype(np.uint32) << (8 * (length - 1)))
            mixed = (grams + np.uint32(length)) * np.uint32(_SALTS[length - 1])
            total += np.bincount(mixed >> np.uint32(32 - 14), minlength=BUCKETS)
    return total


def has_letter(raw: bytes) -> bool:
    if _LETTER.search(raw):
        return True
    return not raw.isascii() and any(c.isalpha() for c in raw.decode())


def codewords(languages: int) -> np.ndarray:
    """A codeword of -1 and 1 per language.

    All ways to part a few languages in two; for many, random words whose
    closest pair is the farthest apart of a hundred draws with a fixed seed.
    """
    if languages <= 1:
        return np.ones((languages, 0))
    if languages <= _EXHAUSTIVE:
        bits = range(1, 1 << (languages - 1))
        return np.array([[1 if b >> i & 1 else -1 for b in bits] for i in range(languages)])
    draw, best, apart = np.random.default_rng(0), None, -1
    width = int(np.ceil(10 * np.log2(languages)))
    for _ in range(100):
        words = draw.choice([-1, 1], size=(languages, width))
        words = words[:, np.abs(words.sum(axis=0)) < languages]
        near = (words @ words.T - 2 * words.shape[1] * np.eye(languages)).max()
        if words.shape[1] - near > apart:
            best, apart = words, words.shape[1] - near
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # language x bit
    weights: np.ndarray  # bucket x bit
    trust: np.ndarray  # language x bit

    def margins(self, texts: list[bytes]) -> np.ndarray:
        counts = np.array([ngram_counts(t) for t in texts], dtype=np.float32)
        return np.clip(counts @ self.weights / TEMPER, -_MOST, _MOST)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Loss of each text (row) under each language's codeword."""
        each = np.logaddexp(0, -margins[:, None, :] * self.codes[None, :, :])
        return (each * self.trust[None, :, :]).sum(axis=2)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by language of one task."""
    sums: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        texts = raw_texts(batch.column("text"))
        for lang, raw in zip(batch.column("lang").to_pylist(), texts, strict=True):
            if lang not in sums:
                sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
            sums[lang] += ngram_counts(raw)
    for lang, counts in sums.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some)), pa.array(some), pa.array(counts[some])],
            names=["lang", "bucket", "n"],
        )


def _answers(model):
    """Right answers by language and bit of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        place = {lang: i for i, lang in enumerate(known.languages)}
        right = np.zeros(known.codes.shape, dtype=np.int64)
        seen = np.zeros(len(known.languages), dtype=np.int64)
        for batch in slices(batches):
            texts = raw_texts(batch.column("text"))
            langs = np.array([place[lang] for lang in batch.column("lang").to_pylist()])
            for lo in range(0, len(texts), 64):
                true = langs[lo : lo + 64]
                good = known.margins(texts[lo : lo + 64]) * known.codes[true] > 0
                np.add.at(right, true, good)
                np.add.at(seen, true, 1)
        i, b = np.indices(right.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(b), pa.array(right.ravel()), pa.array(seen[i])],
            names=["language", "bit", "good", "n"],
        )

    return run


def learn(labelled: DataFrame) -> Model:
    """A model from the rows of `labelled` (text, lang) that have both."""
    spark = labelled.sparkSession
    rows = labelled.select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter("text is not null and lang is not null")
    counts = (
        rows.mapInArrow(_train, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(counts.lang.unique())
    codes = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((BUCKETS, 0)), codes)
    table = np.zeros((len(languages), BUCKETS))
    table[counts.lang.map(languages.index), counts.bucket] = counts.n
    rates = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    ones = (codes > 0).astype(float)
    one = ones.T @ rates / ones.sum(axis=0)[:, None]
    zero = (1 - ones).T @ rates / (1 - ones).sum(axis=0)[:, None]
    weights = np.clip(np.log(one / zero), -STRONGEST, STRONGEST).T.astype(np.float32)
    model = Model(languages, codes, weights, np.ones(codes.shape))

    found = (
        rows.mapInArrow(
            _answers(spark.sparkContext.broadcast(model)),
            "language bigint, bit bigint, good bigint, n bigint",
        )
        .groupBy("language", "bit")
        .agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        .toPandas()
    )
    trust = np.zeros(codes.shape)
    share = (found.good + 1) / (found.n + 2)
    trust[found.language, found.bit] = np.maximum(2 * share - 1, 0.01)
    model.trust = trust / trust.sum(axis=1, keepdims=True) * codes.shape[1]
    return model


def identify(docs: DataFrame, model: Model, lead: float = LEAD) -> DataFrame:
    """`docs` (any columns) with lang_pred, score, second and ambiguous behind them.

    Columns of `docs` with these names give way to the new ones.
    """
    new = ["lang_pred", "score", "second", "ambiguous"]
    docs = docs.drop(*new).withColumn("text", F.col("text").cast("string"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in slices(batches):
            texts = raw_texts(batch.column("text"))
            names = [UNKNOWN] * len(texts)
            score, second = [0.0] * len(texts), [None] * len(texts)
            unclear = [True] * len(texts)
            some = [i for i, t in enumerate(texts) if known.languages and has_letter(t)]
            for lo in range(0, len(some), 64):
                part = some[lo : lo + 64]
                if len(known.languages) == 1:
                    loss = np.zeros((len(part), 1))
                else:
                    loss = known.losses(known.margins([texts[i] for i in part]))
                share = np.exp(loss.min(axis=1, keepdims=True) - loss)
                share /= share.sum(axis=1, keepdims=True)
                order = np.argsort(loss, axis=1, kind="stable")
                for row, i in enumerate(part):
                    best = order[row, 0]
                    names[i], score[i] = known.languages[best], float(share[row, best])
                    unclear[i] = False
                    if loss.shape[1] > 1:
                        next_best = order[row, 1]
                        second[i] = known.languages[next_best]
                        unclear[i] = bool(loss[row, next_best] - loss[row, best] < lead)
            found = [names, score, second, unclear]
            kinds = [pa.string(), pa.float64(), pa.string(), pa.bool_()]
            for name, column, kind in zip(new, found, kinds, strict=True):
                batch = batch.append_column(name, pa.array(column, kind))
            yield batch

    ddl = "lang_pred string, score double, second string, ambiguous boolean"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, {ddl}")


def keep_clear(docs: DataFrame, model: Model, lead: float = LEAD) -> DataFrame:
    """The rows of `docs` whose language is known and not ambiguous, with all their columns."""
    named = set_aside(docs, "text")
    found = identify(named, model, lead)
    clear = (F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")
    return found.filter(clear).select(*named.columns).toDF(*docs.columns)
