"""Stratified splits with exact class shares, repeatable for a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendgrid.functions.defaults import SEED
from lendgrid.operators.ordered import hash_rank


def stratified_holdout(df: DataFrame, id_col: str, y: str, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_holdout``; each class gives the rounded share of its rows."""
    ranked = hash_rank(df.where(F.col(y).isNotNull()), id_col, seed, (y,))
    return ranked.withColumn("is_holdout", F.col("rank") <= F.round(F.col("n") * share)).drop("rank", "n")


def stratified_folds(df: DataFrame, id_col: str, y: str, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` 0..folds-1; the folds of a class differ by one row at most."""
    ranked = hash_rank(df.where(F.col(y).isNotNull()), id_col, seed, (y,))
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank", "n")
