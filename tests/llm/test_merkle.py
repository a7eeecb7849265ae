import hashlib
import zlib
from collections import defaultdict

import pytest
from plain import SCHEMA, sf_rows
from pyspark.sql import functions as F

from tillroll.llm import merkle
from tillroll.llm.queries import QUERIES

NAMES = ("doc_id", "source", "lang", "n_chars", "text")
ODD = [
    (5, "b", "en", 3, "a\nb"),
    (None, "b", "en", 3, "a\nb"),
    (4, None, None, None, None),
    (4, None, "", 0, ""),
    (6, "", "en", 1, "x"),
    (7, "ü", "de", 200_002, "\n" + "y" * 200_000 + "\n"),
    (8, "b", "en", 3, "q\nr"),
    (8, "b", "en", 3, "q\nr"),
    (-3, "b", "en", None, "\n"),
    (10, "b", "en", 1, None),
]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = [None if v is None else str(v) for v in row]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def climb(nodes, at):
    """The end of the tree and the siblings of the node `at` on the way."""
    siblings, turns = [], []
    while len(nodes) > 1:
        lo = at // 3 * 3
        siblings += [n for k, n in enumerate(nodes[lo : lo + 3], lo) if k != at]
        turns.append((nodes[lo : lo + 3], at - lo))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at //= 3
    return nodes[0], siblings, turns


def wanted(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for held in by_source.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: [leaf(r) for r in held] for s, held in by_source.items()}
    subroots = [climb(trees[s], 0)[0] for s in order]
    out = []
    for at, s in enumerate(order):
        root, upper, upper_turns = climb(subroots, at)
        for k, r in enumerate(by_source[s]):
            subroot, siblings, turns = climb(trees[s], k)
            value = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                value = leaf((*r[:4], r[4].replace("\n", "")))
            for kids, slot in turns + upper_turns:
                value = h(*kids[:slot], value, *kids[slot + 1 :])
            proof = h(*siblings, *upper)
            out.append((str(r[0]), leaf(r), subroot, root, proof, value, value == root))
    return sorted(out)


def told(frame):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((str(r[0]), *r[1:]) for r in frame.select(*names).collect())


def changed():
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


@pytest.fixture
def table(spark):
    def make(rows, parts=3):
        order = ("doc_id", "text", "lang", "source", "n_chars")
        data = [tuple(dict(zip(NAMES, r, strict=True))[n] for n in order) for r in rows]
        return spark.createDataFrame(data, SCHEMA).repartition(parts)

    return make


@pytest.mark.parametrize("levels", [1, 8])
def test_equals_plain_trees(table, levels):
    many = [(i, f"s{i % 7 % 3}", "en", i, f"text\n{i}") for i in range(100)]
    lone = [(i, f"s{i}", "en", i, "z") for i in range(11)]
    for rows in (ODD, many, lone, ODD[:1]):
        assert told(merkle.Manifest(table(rows), changed(), levels).refold()) == wanted(rows)


def test_registered_query(spark, sf_dir):
    assert told(QUERIES["op13_merkle_manifest"](spark, sf_dir)) == wanted(sf_rows(spark, sf_dir, *NAMES))


def test_sources_root_and_proofs(table):
    rows = [(i, f"s{i % 4}", "en", i, f"text {i}") for i in range(50)]
    made = merkle.Manifest(table(rows))
    plain = wanted(rows)
    assert {r.subroot for r in made.sources.collect()} == {p[2] for p in plain}
    assert sum(r.n_docs for r in made.sources.collect()) == 50
    assert made.root == plain[0][3]
    for r in made.proofs().collect():
        node = bytes.fromhex(r.leaf)
        for slot, nodes in r.path:
            assert bytes(nodes[slot]) == node
            node = bytes.fromhex(h(*[bytes(n).hex() for n in nodes]))
        assert node.hex() == made.root


def test_nothing_changed_verifies(table):
    rows = merkle.Manifest(table(ODD)).refold().collect()
    assert len(rows) == len(ODD) and all(r.verified for r in rows)


def test_states_resume_to_the_right_only():
    kids = [h(c).encode() for c in "abc"]
    parent, new = merkle.Parent(kids), h("n").encode()
    for slot in range(3):
        full = h(*[(new if k == slot else c).decode() for k, c in enumerate(kids)]).encode()
        assert parent.refolded(slot, new) == full
    full = h(kids[0].decode(), kids[1].decode(), new.decode()).encode()
    parent.children[0] = b"never read again"
    assert parent.refolded(2, new) == full


def test_empty_and_clashing_columns(spark, table):
    empty = merkle.Manifest(table([]), changed())
    assert empty.refold().count() == 0 and empty.root is None and empty.sources.count() == 0
    clash = table(ODD)
    for n in ("grp", "i", "n", "digest", "path", "leaf", "chunk", "other"):
        clash = clash.withColumn(n, F.lit("c"))
    assert told(merkle.Manifest(clash, changed()).refold()) == wanted(ODD)
