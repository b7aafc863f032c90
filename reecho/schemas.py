"""Schemas written as name/type pairs, usable before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
STRING = T.StringType()
BOOLEAN = T.BooleanType()
TIMESTAMP = T.TimestampType()
BIGINTS = T.ArrayType(BIGINT)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
