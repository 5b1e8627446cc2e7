"""Integrity checks of result tables (Z3).

Both checks shuffle pre-aggregated keys only: a foreign key shared by a third of all rows
reaches the anti join as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary key values that occur more than once, with their row counts."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent, with the number of child rows each."""
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(
        F.count("*").alias("n_rows")
    )
    known = parent.select(F.col(key).alias(foreign_key)).distinct()
    return used.join(known, foreign_key, "left_anti")


def null_counts(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """NOT NULL check: one row per required column with its number of NULLs."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], list(required), "column_name", "n_null")


def audit(rows: DataFrame, table: str, keys: Sequence[str], required: Sequence[str],
          parents: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """All findings of one table as (table_name, check_name, n_findings)."""
    def finding(check: str, frame: DataFrame, n) -> DataFrame:
        return frame.agg(n.alias("n_findings")).select(
            F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
            F.coalesce("n_findings", F.lit(0)).cast("bigint").alias("n_findings"),
        )

    result = finding(f"unique({','.join(keys)})", duplicate_keys(rows, keys), F.count("*"))
    for column, parent, key in parents:
        orphans = orphan_keys(rows, column, parent, key)
        result = result.unionByName(finding(f"foreign_key({column})", orphans, F.sum("n_rows")))
    nulls = null_counts(rows, required).select(
        F.lit(table).alias("table_name"),
        F.concat(F.lit("not_null("), "column_name", F.lit(")")).alias("check_name"),
        F.col("n_null").alias("n_findings"),
    )
    return result.unionByName(nulls)
