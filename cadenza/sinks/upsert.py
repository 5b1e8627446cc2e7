"""Keyed tables fed by micro-batches, last write wins.

Each micro-batch is one partition folder. A batch that runs again after a failure replaces
its own folder, so the table holds every batch exactly once; reading picks the last row of
each key by aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadenza.operators.latest import latest_per_key

BATCH = "batch_id"
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class KeyedTable:
    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def history(self, spark: SparkSession) -> DataFrame:
        """Every revision with its batch."""
        return spark.read.option("basePath", self.path).parquet(f"{self.path}/{BATCH}=*")

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows of one written batch."""
        return spark.read.parquet(f"{self.path}/{BATCH}={batch_id}")

    def before(self, spark: SparkSession, batch_id: int, schema: StructType, all_rows: bool = False, of: DataFrame | None = None) -> DataFrame:
        """The last revision of each key (of those in ``of``), or every row, as batches before ``batch_id`` left them."""
        # The first batch finds no folder yet.
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        rows = self.history(spark).filter(F.col(BATCH) < batch_id)
        if of is not None:
            rows = rows.join(of, list(self.keys), "left_semi")
        found = rows if all_rows else latest_per_key(rows, self.keys, [BATCH, *self.order])
        return found.select(*schema.names)

    def current(self, spark: SparkSession) -> DataFrame:
        """The last revision of each key."""
        revisions = self.history(spark)
        return latest_per_key(revisions, self.keys, [BATCH, *self.order]).drop(BATCH)

    def compact(self, spark: SparkSession, path: str) -> KeyedTable:
        """A new table with the last revision of each key, each still under its own batch.

        So a batch that runs again on the new table replaces nothing but its own rows, and
        tables that are matched by batch stay matched.
        """
        last = latest_per_key(self.history(spark), self.keys, [BATCH, *self.order])
        last.write.mode("overwrite").partitionBy(BATCH).parquet(path)
        return KeyedTable(path, self.keys, self.order)


def fan_out(*sinks: Sink) -> Sink:
    """Give one computed micro-batch to several sinks."""
    if len(sinks) == 1:
        return sinks[0]

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()

    return write


def unique_by(keys: Sequence[str], order: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Keep one row per key inside a micro-batch: the last by ``order``, ties by the other columns.

    ``order`` names the columns of arrival (see ``messages.ARRIVAL``); without it there is
    no telling which of two revisions in a batch came last.
    """
    return lambda rows: latest_per_key(rows, keys, order)
