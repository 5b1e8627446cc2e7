"""Message streams and bounded message reads.

A source is any format that yields a text ``value`` per message: a broker topic in
production, text files in tests. Broker options are parameters, no connector is bundled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How a topic is followed live, and how it is read from its start.
FOLLOW_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}
FROM_START_OPTIONS = {"startingOffsets": "earliest"}


def follow_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Live stream of a broker topic."""
    reader = spark.readStream.format("kafka").options(**FOLLOW_OPTIONS)
    return reader.options(**_address(servers, topic), **options).load()


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Everything a broker topic holds, as a batch."""
    reader = spark.read.format("kafka").options(**FROM_START_OPTIONS)
    return reader.options(**_address(servers, topic), **options).load()


def _address(servers: str, topic: str) -> Mapping[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def follow_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """S1 on files: one message per line of text files that appear below ``path``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


#: Columns of a broker message that tell the order of arrival of one key's messages.
ARRIVAL = ("timestamp", "partition", "offset")


def parse(messages: DataFrame, schema: str, arrival: Sequence[str] = ()) -> DataFrame:
    """Message values to typed columns.

    Unknown fields are ignored, mistyped ones are NULL, a malformed value is an all-NULL row.
    ``arrival`` names message columns to keep, as ``arrived_<name>``, for last-write-wins.
    """
    body = F.from_json(F.col("value").cast("string"), schema)
    kept = [F.col(c).alias(f"arrived_{c}") for c in arrival]
    return messages.select(body.alias("data"), *kept).select("data.*", *[f"arrived_{c}" for c in arrival])


def json_objects(messages: DataFrame) -> DataFrame:
    """Only messages whose value is a JSON object, as text."""
    value = F.col("value").cast("string")
    is_object = F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT")
    return messages.select(value.alias("value")).filter(is_object)
