"""Explicit schemas from plain column lists, without needing a session."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(),
          "double": DoubleType(), "boolean": BooleanType(), "timestamp": TimestampType()}


def schema_of(columns: dict[str, str]) -> StructType:
    """Nullable fields from ``{name: type}``; names may hold any character."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])
