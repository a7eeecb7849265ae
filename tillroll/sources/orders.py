"""Order extracts as files.

A CSV tells an empty cell in quotes from one that is not there, and so does this
reader: the first comes as an empty text, the other as null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import canonical

# Columns that are whole numbers in the extract and never cleaned as money text.
WHOLE_NUMBERS = ("year", "month")


MALFORMED = "malformed"
FITS = "fits_header"
# Stands for an empty cell in quotes while Spark reads, as its reader would make it null.
_EMPTY = "\ue000empty\ue000"


def _csv_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Cells as text, and the whole line as `malformed` if it has more or fewer than the header."""
    reader = spark.read.options(header=True, inferSchema=False, enforceSchema=False, **options)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
    reader = reader.options(emptyValue=_EMPTY)
    # Without pruning every cell of a line is looked at, whatever columns are asked for.
    reader = reader.options(columnPruning=False, columnNameOfCorruptRecord=MALFORMED)
    lines = reader.schema(schema).csv(path)
    # Spark reads no malformed lines by themselves, so an empty part of a cell goes along.
    cell = F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0)
    cells = [F.when(F.col(f"`{n}`") == _EMPTY, "").otherwise(F.col(f"`{n}`")).alias(n) for n in names]
    return canonical(lines.select(*cells, F.concat(MALFORMED, cell).alias(MALFORMED)))


def _orders_of(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {c: F.trim(c).try_cast("int") for c in WHOLE_NUMBERS if c in lines.columns}
    )


def read_orders_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A CSV with header, from any path that Spark reads (local, HDFS, object store).

    Only the header line is looked at for the schema: every cell is read as
    text, so types do not depend on the data and no pass is spent on guessing
    them. Amount and quantity become numbers in cleaning, after the defaults.
    A later file whose header differs is an error, not shifted columns. Lines
    with more or fewer cells than the header are left to `malformed_lines`.
    """
    lines = _csv_lines(spark, path, **options)
    return _orders_of(lines.filter(F.col(MALFORMED).isNull()).drop(MALFORMED))


def malformed_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The lines (`malformed`) that `read_orders_csv` leaves out, to be counted and kept."""
    return _csv_lines(spark, path, **options).select(MALFORMED).filter(F.col(MALFORMED).isNotNull())


def land_csv(
    spark: SparkSession, path: str, folder: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The orders and the malformed lines of a CSV, which is read and parsed once.

    One scan writes all lines to `folder`, split by whether they fit the header;
    both frames read their part of it. So a job that needs both, or reads its
    input again, does not parse the text again.
    """
    lines = _csv_lines(spark, path, **options)
    landed = lines.withColumn(FITS, F.col(MALFORMED).isNull())
    landed.write.mode("overwrite").partitionBy(FITS).parquet(folder)
    # The schema is given, as an input without lines leaves no file to take it from.
    stored = spark.read.schema(landed.schema).parquet(folder)
    orders = _orders_of(stored.filter(F.col(FITS)).drop(FITS, MALFORMED))
    return orders, stored.filter(~F.col(FITS)).select(MALFORMED)


def read_orders_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Enriched orders or a KPI as written by `tillroll.sinks`."""
    return canonical(spark.read.parquet(path))
