"""Result tables and messages (K1, K2, K7-K9)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARRAY_DOCUMENT_ROWS = 100_000
#: Shuffle files of a query are removed when it ends, not when the driver collects garbage.
FREED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Sorts of wide rows made from narrow ones fit into memory.
SMALL_SCANS = {"spark.sql.files.maxPartitionBytes": "16m"}


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what is planned and run inside."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_once(rows: DataFrame, path: str, conf: Mapping[str, str] = FREED_SHUFFLES, **options: str) -> DataFrame:
    """A table for later steps: written, its shuffles removed, and read back."""
    with settings(rows.sparkSession, FREED_SHUFFLES | dict(conf)):
        rows.write.options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append_table(rows: DataFrame, path: str | None = None, partition_by: str | None = "run_id",
                 jdbc: Mapping[str, str] | None = None) -> None:
    """K1: append to a parquet table by run, or to a database given by JDBC options."""
    writer = rows.write.mode("append")
    if jdbc:
        writer.format("jdbc").options(**jdbc).save()
    elif partition_by:
        writer.partitionBy(partition_by).parquet(path)
    else:
        writer.parquet(path)


def replace_run(rows: DataFrame, path: str, partition_by: str = "run_id") -> None:
    """K1: rows of a run into a parquet table by run; a run that is there already is replaced."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)


def to_messages(rows: DataFrame, key: Column) -> DataFrame:
    """K2/K9: key and JSON value; rows without a key are skipped."""
    body = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    keyed = rows.select(key.cast("string").alias("key"), body.alias("value"))
    return keyed.filter(F.col("key").isNotNull() & (F.col("key") != ""))


def publish(messages: DataFrame, format: str = "kafka", path: str | None = None,
            options: Mapping[str, str] | None = None) -> None:
    """K2: write key/value messages to a topic, or to files for tests."""
    writer = messages.select("key", "value").write.format(format).options(**(options or {}))
    if path:
        writer.mode("append").save(path)
    else:
        writer.save()


def message_sink(key: str, **target) -> Callable[[DataFrame, int], None]:
    """K2 for a stream: publish each micro-batch keyed by one of its columns.

    Messages are sent at least once; a consumer keeps the last one per key.
    """
    return lambda rows, batch_id: publish(to_messages(rows, F.col(key)), **target)


def replace_table(rows: DataFrame, path: str) -> None:
    """K7: the table holds exactly these rows afterwards."""
    rows.write.mode("overwrite").parquet(path)


def dump_lines(messages: DataFrame, path: str) -> None:
    """K8: message values as JSON lines, any size."""
    messages.select(F.col("value").cast("string")).write.text(path)


def array_document(messages: DataFrame, max_rows: int = ARRAY_DOCUMENT_ROWS, order: Sequence[str] = ()) -> DataFrame:
    """K8: all values as one JSON array, for a topic of at most ``max_rows`` messages.

    They stand in the order of the columns ``order``, the messages' columns of arrival;
    without these, in the order of their text.
    """
    if len(messages.select(F.lit(1)).take(max_rows + 1)) > max_rows:
        raise ValueError(f"more than {max_rows} messages; use dump_lines")
    placed = F.array_sort(F.collect_list(F.struct(*order, F.col("value").cast("string").alias("value"))))
    values = F.transform(placed, lambda m: m["value"])
    return messages.agg(
        F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")).alias("document")
    )
