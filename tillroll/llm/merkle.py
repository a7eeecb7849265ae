"""A Merkle manifest of a dataset: trees of hash midstates, one per source, under one root.

A row's leaf is the SHA-256 of its fields. The leaves of a source lie in the
order of their ids; while there are several nodes, every three neighbours become
the hash of their digests. What remains is the source's subroot, and the
subroots in the order of the sources go on in the same way to the root.

A parent keeps a copy of its hash state from before each child slot. Putting
another child into a slot resumes that state with the new digest and the
siblings on its right alone; those on its left are not hashed again.

The tree is built in chunks of 3^8 neighbours, so no source of any size lies in
one task: rows are sorted by ranges, a prefix sum over the partitions' counts
gives each its place, a chunk gives its top, and the tops are the next round's
nodes. On the way back each chunk gets one row, the path above its top.

Fields: null is ``-``, else the number of UTF-8 bytes, a colon and the value, so
null and empty differ. Rows without source are a source of their own, before all
others; rows without id come first in theirs. Rows of one id are ordered by
their leaves; equal rows are leaves of their own with equal digests. A text of
any length is one leaf. An empty table has no rows and no root. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillroll.llm.common import rows, small, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
# Levels that one task builds at a time, over ARITY ** LEVELS neighbours.
LEVELS = 8
_ROWS = 4096

_STEP = pa.struct([("slot", pa.int32()), ("nodes", pa.list_(pa.binary()))])
_PATH = "array<struct<slot: int, nodes: array<binary>>>"


def leaf(*values: Column) -> Column:
    """The digest of one row's fields, as bytes."""

    def spelt(value: Column) -> Column:
        text = value.cast("string")
        size = F.octet_length(text).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(size, F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*[spelt(v) for v in values]), 256))


def height(n: int) -> int:
    """Levels above `n` neighbours."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _hex(digest: bytes) -> bytes:
    return digest.hex().encode()


class Parent:
    """The hash of up to three digests (hex), with the state from before each of them."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: list[bytes]):
        self.children, self.states = children, []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def refolded(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in `slot`: the state before it goes on from there."""
        state = self.states[slot].copy()
        state.update(child)
        for right in self.children[slot + 1 :]:
            state.update(right)
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1 :])


def parents(nodes: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents of each level above `nodes`."""
    out = []
    for _ in range(levels):
        out.append([Parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)])
        nodes = [p.digest for p in out[-1]]
    return out


def _ordered(nodes: DataFrame, *order: str) -> DataFrame:
    """`nodes` with `i`, the place in its `grp` by `order`, and `n`, the rows of that.

    Sorted by ranges and stored, so that places hold; one row per partition and
    group is summed up, never one per node.
    """
    by = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    lying = stored(ranged.withColumn("pos", F.monotonically_increasing_id()), "merkle-order")
    # The number's upper bits are the partition, the others count its rows.
    lying = lying.withColumn("part", F.shiftright("pos", 33))
    runs = lying.groupBy("grp", "part").agg(F.count("*").alias("rows"), F.min("pos").alias("low"))
    whole = Window.partitionBy("grp")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("low")
    runs = runs.select("grp", "part", before.alias("shift"), F.sum("rows").over(whole).alias("n"))
    places = lying.join(small(stored(runs, "merkle-runs")), ["grp", "part"])
    return places.withColumn("i", F.col("pos") + F.col("shift")).drop("pos", "part", "shift")


def _chunk(levels: int) -> Column:
    return F.expr(f"i div {ARITY**levels}").alias("chunk")


def _together(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "i")


def _chunks(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list]]:
    """((grp, chunk), rows of `names`) of each chunk; never more than one is held."""
    flat = (r for batch in batches for r in rows(batch, "grp", "chunk", *names))
    for key, held in groupby(flat, key=lambda r: r[:2]):
        yield key, [r[2:] for r in held]


def _batches(records: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []

    def batch():
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for record in records:
        held.append(record)
        if len(held) == _ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _lifted(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of the chunks of (grp, i, n, digest), in the same columns."""
    schema = pa.schema(
        [("grp", pa.string()), ("i", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]
    )

    def tops(batches):
        for (grp, chunk), members in _chunks(batches, "n", "digest"):
            n, level = members[0][0], [_hex(d) for _, d in members]
            for _ in range(min(levels, height(n))):
                level = [
                    sha256(b"".join(level[i : i + ARITY])).hexdigest().encode()
                    for i in range(0, len(level), ARITY)
                ]
            yield grp, chunk, -(-n // ARITY**levels), bytes.fromhex(level[0].decode())

    chunks = _together(nodes.select("grp", "i", "n", "digest", _chunk(levels)))
    return chunks.mapInArrow(
        lambda batches: _batches(tops(batches), schema),
        "grp string, i bigint, n bigint, digest binary",
    )


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The node tables from `nodes` up to the one with a single node per group."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(stored(_lifted(out[-1], levels), "merkle-tops"))
    return out


def _with_paths(nodes: DataFrame, upper: DataFrame | None, levels: int) -> DataFrame:
    """The nodes by chunk, each chunk behind one row (`i` is -1) with the path above its top."""
    mine = nodes.select("*", _chunk(levels))
    if upper is None:
        return _together(mine.withColumn("path", F.lit(None).cast(_PATH)))
    above = upper.select("grp", F.col("i").alias("chunk"), F.lit(-1).cast("bigint").alias("i"), "path")
    return _together(mine.unionByName(above, allowMissingColumns=True))


class _Chunk:
    """A chunk's parents, and those above its top up to the end of the path."""

    def __init__(self, members: list[tuple], path: list[dict] | None, levels: int):
        self.nodes = [_hex(m[2]) for m in members]
        self.n = members[0][1]
        self.inner = parents(self.nodes, min(levels, height(self.n)))
        self.outer = [
            (s["slot"], Parent([_hex(d) for d in s["nodes"]])) for s in path or []
        ]
        self.beyond = b"".join(p.siblings(slot) for slot, p in self.outer)

    def steps(self, k: int) -> Iterator[tuple[int, Parent]]:
        """(slot, parent) of the node in place `k` at each level of the chunk."""
        for level in self.inner:
            k, slot = divmod(k, ARITY)
            yield slot, level[k]

    def climb(self, k: int) -> list[tuple[int, Parent]]:
        return [*self.steps(k), *self.outer]


def _members(batches: Iterable[pa.RecordBatch], levels: int, *names: str):
    """((grp, members, chunk) for each chunk; a member is (i, n, digest, ...)."""
    for (grp, _), held in _chunks(batches, "path", "i", "n", *names):
        path = held[0][0] if held[0][1] == -1 else None
        members = [r[1:] for r in held if r[1] >= 0]
        if members:
            yield grp, members, _Chunk(members, path, levels)


def _paths(nodes: DataFrame, upper: DataFrame | None, levels: int) -> DataFrame:
    """(grp, i, path) of each node: slot and children of every parent up to the end."""
    schema = pa.schema(
        [("grp", pa.string()), ("i", pa.int64()), ("path", pa.list_(_STEP))]
    )

    def found(batches):
        for grp, members, chunk in _members(batches, levels, "digest"):
            for k, (i, *_) in enumerate(members):
                steps = [
                    {"slot": slot, "nodes": [bytes.fromhex(c.decode()) for c in p.children]}
                    for slot, p in chunk.climb(k)
                ]
                yield grp, i, steps

    return _with_paths(nodes, upper, levels).mapInArrow(
        lambda batches: _batches(found(batches), schema), f"grp string, i bigint, path {_PATH}"
    )


def _descended(rounds: list[DataFrame], upper: DataFrame | None, levels: int):
    """The paths above the chunks of the first round, from those above the last one."""
    for nodes in reversed(rounds[1:]):
        upper = stored(_paths(nodes, upper, levels), "merkle-paths")
    return upper


def _source(group: str) -> Column:
    return F.when(F.col(group) != "", F.substr(group, F.lit(2))).alias("source")


def _spelt(digest: str) -> Column:
    return F.lower(F.hex(digest))


class Manifest:
    """The trees of a table: `leaves` with their places, `sources` with subroots, and `root`.

    All node tables are stored below the session's shared folder.
    """

    def __init__(
        self, docs: DataFrame, text_after: Column | None = None, levels: int = LEVELS
    ):
        fields = [F.col(c) for c in FIELDS]
        other = F.lit(None).cast("binary")
        if text_after is not None:
            changed = ~text_after.eqNullSafe(F.col("text"))
            other = F.when(changed, leaf(*fields[:-1], text_after))
        grp = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
        hashed = docs.select(
            grp.alias("grp"), "doc_id", leaf(*fields).alias("digest"), other.alias("other")
        )
        self.levels = levels
        self.kind = docs.schema["doc_id"].dataType
        self.leaves = _ordered(stored(hashed, "merkle-leaves"), "doc_id", "digest")
        self._own = _rounds(self.leaves.select("grp", "i", "n", "digest"), levels)
        tops = self._own[-1].select("grp", "n", "digest")
        listed = tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest")
        self._listed = _ordered(listed, "key")
        self._top = _rounds(self._listed.select("grp", "i", "n", "digest"), levels)

    @property
    def root(self) -> str | None:
        """Hex digest over the whole table, None if it is empty."""
        top = self._top[-1].select(_spelt("digest").alias("root")).first()
        return top.root if top else None

    @property
    def sources(self) -> DataFrame:
        """(source, n_docs, subroot) in any order."""
        counts = self.leaves.filter("i = 0").select(F.col("grp").alias("key"), "n")
        return (
            self._listed.select("key", "digest")
            .join(counts, "key")
            .select(_source("key"), F.col("n").alias("n_docs"), _spelt("digest").alias("subroot"))
        )

    def _above(self) -> DataFrame:
        """The paths above the chunks of leaves, up to the root."""
        levels = self.levels
        top = _paths(self._top[0], _descended(self._top, None, levels), levels)
        keys = self._listed.select(F.col("grp"), "i", "key")
        named = top.join(keys, ["grp", "i"]).select(
            F.col("key").alias("grp"), F.lit(0).cast("bigint").alias("i"), "path"
        )
        return _descended(self._own, stored(named, "merkle-paths"), levels)

    def proofs(self) -> DataFrame:
        """(doc_id, source, leaf, path): what proves that a row belongs to the root.

        The path has, level by level, the slot of the node and all children there.
        """
        held = self.leaves.select("grp", "i", "doc_id", _spelt("digest").alias("leaf"))
        found = _paths(self._own[0], self._above(), self.levels)
        return held.join(found, ["grp", "i"]).select("doc_id", _source("grp"), "leaf", "path")

    def refold(self) -> DataFrame:
        """One row per document: the proof's digest, and the root with its changed leaf.

        (doc_id, source, leaf, subroot, root, proof_sha256, folded_root,
        verified). A row that did not change folds to the root.
        """
        levels = self.levels
        names = ["grp", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        schema = pa.schema([(n, pa.string()) for n in names])
        schema = schema.set(1, pa.field("doc_id", to_arrow_type(self.kind)))

        def folded(batches):
            for grp, members, chunk in _members(batches, levels, "digest", "doc_id", "other"):
                own = height(chunk.n)
                for k, (_, _, _, doc_id, other) in enumerate(members):
                    node, climb = chunk.nodes[k], chunk.climb(k)
                    proof = sha256()
                    for slot, parent in climb[: len(chunk.inner)]:
                        proof.update(parent.siblings(slot))
                    proof.update(chunk.beyond)
                    subroot = climb[own - 1][1].digest if own else node
                    root = climb[-1][1].digest if climb else node
                    value = node if other is None else _hex(other)
                    for slot, parent in climb:
                        value = parent.refolded(slot, value)
                    yield (
                        grp, doc_id, node.decode(), subroot.decode(), root.decode(),
                        proof.hexdigest(), value.decode(),
                    )

        chunks = _with_paths(self.leaves, self._above(), levels)
        kinds = ", ".join(f"{n} {self.kind.simpleString() if n == 'doc_id' else 'string'}" for n in names)
        out = chunks.mapInArrow(lambda batches: _batches(folded(batches), schema), kinds)
        verified = (F.col("folded_root") == F.col("root")).alias("verified")
        return out.select("doc_id", _source("grp"), *names[2:], verified)
