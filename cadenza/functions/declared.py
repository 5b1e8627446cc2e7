"""Columns in the names, order and types of a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def declared(schema: str, given: Mapping[str, Column] | None = None) -> list[Column]:
    """Every field of ``schema``: the given column, else the one of the same name, in its type.

    A given column that the schema does not declare is an error, so that no value gets lost.
    """
    fields = StructType.fromDDL(schema).fields
    given = given or {}
    if unknown := set(given) - {f.name for f in fields}:
        raise ValueError(f"not declared: {sorted(unknown)}")
    return [(given[f.name] if f.name in given else F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields]


def declared_json(schema: str, given: Mapping[str, Column] | None = None) -> Column:
    """The same as one JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*declared(schema, given)))
