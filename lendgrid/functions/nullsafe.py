"""Null rules of the analytics: null means missing, NaN never leaves the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio that is null for a zero or missing denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def rate(predicate: Column) -> Column:
    """Share of rows where the predicate holds; a missing operand counts as not holding."""
    return F.avg(F.coalesce(predicate, F.lit(False)).cast("int"))


def count_where(predicate: Column) -> Column:
    return F.sum(F.coalesce(predicate, F.lit(False)).cast("long"))


def sum0(column: Column) -> Column:
    """Sum that is 0, not null, for a group without values."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in all floating columns."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floating else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
