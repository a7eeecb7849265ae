import re

import corpus_pipeline
import numpy as np
from plain import classes, fingerprint, sf_rows, table
from test_bpe_packing import ids_of
from test_secret_scan import redacted
from tokenizers import Tokenizer

from tillroll.llm import language, packing
from tillroll.llm.common import documents, held_out, vocabulary


def near_survivors(rows):
    marks = {d: fingerprint(t) for d, t in rows}
    order = sorted(marks)
    pairs = [
        (a, b)
        for i, a in enumerate(order)
        for b in order[i + 1 :]
        if (marks[a] ^ marks[b]).bit_count() <= 3
    ]
    low = classes(marks, pairs)
    return {d for d in marks if low[d] == d}


def test_run_equals_plain_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.learn(docs.filter(~held_out()))
    found = language.identify(docs, model).collect()
    rows = [(r.doc_id, r.text) for r in found if r.lang_pred != "und" and not r.ambiguous]
    best = {}
    for d, t in rows:
        key = re.sub("[\x20\x09-\x0d]", "", t)
        best[key] = min(best.get(key, (1, 0, "")), (-len(t), d, t))
    rows = [(d, t) for _, d, t in best.values()]
    stay = near_survivors(rows)
    texts = {d: redacted(t, "[secret]") for d, t in rows if d in stay}

    library = Tokenizer.from_file(vocabulary())
    got = {}
    for p in sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=lambda p: (p.doc_id, p.start)):
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert got.keys() == texts.keys()
    assert all(got[d] == [*ids_of(library, texts[d]), packing.END_ID] for d in got)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = documents(spark, sf_dir).limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_odd_tables(spark, sf_dir):
    clash = {"score": "s", "digest": "d", "component_id": "c", "_spans": "p", "part": "q"}
    odd = [(1, None), (None, "the and of the"), (3, ""), (4, "the of"), (4, "the of"), (5, "of and " * 9000)]
    for rows in ([], odd):
        docs = table(spark, rows, clash)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
        assert {r.doc_id for r in docs.collect()} <= {d for d, _ in rows}
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()


def test_stages_in_order(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "exact_dedup", "near_dedup", "secrets", "packing",
    ]
    assert sf_rows(spark, sf_dir)
