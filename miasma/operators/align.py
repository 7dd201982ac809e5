"""Bringing a table to another table's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def schema_difference(df: DataFrame, target: StructType) -> tuple[list[str], list[str]]:
    """(columns only in ``df``, columns only in ``target``), in table order."""
    have, want = df.columns, target.fieldNames()
    return [c for c in have if c not in want], [c for c in want if c not in have]


def align_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Drop extra columns, add missing ones as typed nulls, put all in target order."""
    _, missing = schema_difference(df, target)
    return df.select([
        (F.lit(None) if f.name in missing else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in target.fields])


def union_missing_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)
