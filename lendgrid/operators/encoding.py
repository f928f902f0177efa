"""One-hot encoding with a column for missing values, as fit and apply."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def fit_categories(df: DataFrame, columns: list[str] | None = None, limit: int = 5000) -> dict[str, list[str]]:
    """Sorted category values per column, from one scan.

    The values become columns, so a set larger than ``limit`` is an error.
    """
    columns = categorical_columns(df) if columns is None else columns
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(columns)])
    distinct = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.i", "p.v")
        .where(F.col("v").isNotNull())
        .distinct()
    )
    rows = distinct.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories; these columns are not categorical")
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        values[columns[row["i"]]].append(row["v"])
    return {c: sorted(v) for c, v in values.items()}


def apply_one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """Replace each categorical column by ``<col>_<value>`` flags and ``<col>_nan``."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in categories]
    flags = []
    for name, values in categories.items():
        source = F.col(f"`{name}`")
        flags += [F.coalesce(source == v, F.lit(False)).alias(f"{name}_{v}") for v in values]
        flags.append(source.isNull().alias(f"{name}_nan"))
    return df.select(*kept, *flags)


def encode_categoricals(df: DataFrame, categories: dict[str, list[str]] | None = None) -> DataFrame:
    """One-hot of all text columns; ``prev_ever_refused`` becomes 1, 0 or null."""
    if "prev_ever_refused" in df.columns:
        df = df.withColumn("prev_ever_refused", F.col("prev_ever_refused").cast("int"))
    return apply_one_hot(df, fit_categories(df) if categories is None else categories)
