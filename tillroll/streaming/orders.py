"""Orders that arrive as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.enrich import enrich_sales
from tillroll.operators.quality import settle
from tillroll.schema import INPUT_HEADERS, canonical

# JSON field names are the extract's headers with underscores.
JSON_NAMES = {name: h.replace(" ", "_").replace("-", "_") for name, h in INPUT_HEADERS.items()}
_JSON_TYPES = {
    "amount": T.DoubleType(),
    "qty": T.IntegerType(),
    "year": T.IntegerType(),
    "month": T.IntegerType(),
}
ORDER_JSON = T.StructType(
    [T.StructField(j, _JSON_TYPES.get(name, T.StringType())) for name, j in JSON_NAMES.items()]
)


def kafka_options(
    brokers: str, topic: str, starting: str = "latest", max_per_batch: int | None = None
) -> dict[str, str]:
    """Source options; `max_per_batch` bounds a micro-batch after a standstill."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_orders_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType = ORDER_JSON
) -> DataFrame:
    """Typed orders from any source with a `value` column: kafka, text files, ..."""
    return parse_orders(spark.readStream.format(fmt).options(**options).load(), schema)


def read_from_kafka(
    spark: SparkSession, brokers: str, topic: str, schema: T.StructType = ORDER_JSON, **more
) -> DataFrame:
    """Orders of a Kafka topic, from now on. Needs Spark's Kafka connector on the class path."""
    return read_orders_stream(spark, "kafka", kafka_options(brokers, topic, **more), schema)


def parse_orders(messages: DataFrame, schema: T.StructType | str = ORDER_JSON) -> DataFrame:
    """Columns of the JSON in `value`, and what does not fit in them.

    `other_fields` maps the names of further JSON fields to their text, and
    `malformed` is the text of a message that is no JSON object of the schema.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    wide = T.StructType([*schema.fields, T.StructField("malformed", T.StringType())])
    text = F.col("value").cast("string")
    order = F.from_json(text, wide, {"columnNameOfCorruptRecord": "malformed"}).alias("data")
    fields = F.from_json(text, "map<string,string>")
    more = F.map_filter(fields, lambda k, _: ~k.isin(names)) if names else fields
    df = messages.select(order, more.alias("other_fields"))
    found = df.select(*[F.col(f"data.`{n}`") for n in names], "other_fields", "data.malformed")
    return canonical(found).withColumnsRenamed({j: name for name, j in JSON_NAMES.items()})


def as_messages(orders: DataFrame) -> DataFrame:
    """Orders as JSON text in `value`, the form that `parse_orders` reads."""
    fields = [F.col(name).alias(JSON_NAMES[name]) for name in orders.columns]
    return orders.select(F.to_json(F.struct(*fields)).alias("value"))


def enrich_stream(orders: DataFrame) -> DataFrame:
    """The stages of the batch job that need no other rows; duplicates are left in."""
    return enrich_sales(settle(orders))
