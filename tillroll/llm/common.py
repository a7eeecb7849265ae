"""What the operators share: staged tables, text bytes and connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.staging import new_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary() -> str:
    """The file of the public vocabulary that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Long texts are worked on in parts of about so many bytes.
BLOCK = 1 << 22
_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back.

    This cuts the lineage with a copy that outlives any executor.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A table of no more rows than this is sent to every executor.
SMALL_ROWS = 100_000


def small(table: DataFrame) -> DataFrame:
    """A stored table for the small side of a join: broadcast if it is, else left to the planner."""
    return F.broadcast(table) if table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else table


def set_aside(docs: DataFrame, *own: str) -> DataFrame:
    """`docs` with all columns but `own` renamed, so that none can clash with an operator's.

    The order stays, so ``.toDF(*docs.columns)`` gives the names back.
    """
    return docs.toDF(*[n if n in own else f"_c{i}" for i, n in enumerate(docs.columns)])


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in parts of `size` rows, so that few texts are held as Python objects."""
    for batch in batches:
        for lo in range(0, batch.num_rows, size):
            yield batch.slice(lo, size)


def blocks(raw: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """`raw` in parts of about `size` bytes, cut behind ASCII white space."""
    lo = 0
    while len(raw) - lo > size:
        cut = _WHITE.search(raw, lo + size)
        if cut is None:
            break
        yield raw[lo : cut.end()]
        lo = cut.end()
    yield raw[lo:] if lo else raw


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: a quarter, by the checksum of the id. False without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _symmetric(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the node's smallest neighbour."""
    both = _symmetric(edges)
    # Stored, so that the join has a shuffle of its own on this side and a hub can be split.
    roots = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "roots")
    return (
        both.join(roots, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them."""
    roots = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(roots, "a").filter("b > m").select(F.col("b").alias("a"), "m")
    return smaller.union(roots).select("a", F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b): root is the smallest node reachable.

    Alternating large and small stars; every round is stored, and the number of
    rounds grows with the logarithm of the number of nodes. The roots themselves
    are in the result, nodes without an edge are not. A hub with very many
    neighbours is reduced to its minimum before the shuffle, and the join that
    follows may be split by the planner.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    mark = None
    while True:
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        found = now.agg(F.count("*").alias("n"), total.alias("h")).first()
        if found.n == 0 or (found.n, found.h) == mark:
            break
        mark = (found.n, found.h)
        now = stored(_small_star(_large_star(now)), "edges")
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return hung.union(tops)
