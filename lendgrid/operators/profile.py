"""Profiles of a table: missing values, distributions, correlations, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, NumericType

from lendgrid.operators.ordered import exact_quantiles


def _long(row: DataFrame, names: dict[str, list[Column]], fields: list[str], label: str = "column") -> DataFrame:
    """One wide row of statistics to one row per column."""
    structs = [
        F.struct(F.lit(name).alias(label), *[v.alias(f) for v, f in zip(values, fields)])
        for name, values in names.items()
    ]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percent with two decimals, most first."""
    columns = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    missing = {c: F.col("n") - F.col(f"c{i}") for i, c in enumerate(columns)}
    out = _long(
        row,
        {c: [m, F.round(m / F.nullif(F.col("n"), F.lit(0)) * 100, 2)] for c, m in missing.items()},
        ["n_missing", "pct_missing"],
    )
    return out.where(F.col("n_missing") > 0).orderBy(F.desc("pct_missing"), "column")


def target_distribution(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Count per label and its share; the share of label 1 is the default rate."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each present value, most frequent first."""
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def counts_at_maximum(df: DataFrame, column: str, category: str) -> DataFrame:
    """Category counts among the rows that hold the column's maximum.

    The maximum is one number, fixed first, so the filter reaches the scan.
    """
    top = df.agg(F.max(column)).first()[0]
    return value_counts(df.where(F.col(column) == F.lit(top)), category)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    aggregates, names = [], {}
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
        q = [F.lit(v).cast("double") for v in quartiles[c]]
        names[c] = [F.col(f"n{i}"), F.col(f"a{i}"), F.col(f"s{i}"), F.col(f"l{i}"), *q, F.col(f"h{i}")]
    return _long(df.agg(*aggregates), names, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def target_correlations(df: DataFrame, columns: list[str], target: str = "TARGET") -> DataFrame:
    """Pearson correlation of each column with the target over complete pairs, in one pass.

    A column that is constant but for rounding has none.
    """
    y = F.col(target).cast("double")
    x = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns]
    row = df.where(y.isNotNull()).agg(*[F.when(F.stddev_pop(v) > 1e-9 * F.abs(F.avg(v)), F.corr(v, y)).alias(f"r{i}") for i, v in enumerate(x)])
    return _long(row, {c: [F.nanvl(F.col(f"r{i}"), F.lit(None))] for i, c in enumerate(columns)}, ["corr"], "feature")


def group_default_rate(df: DataFrame, column: str, target: str = "TARGET") -> DataFrame:
    """Mean target and labelled rows per group, riskiest first."""
    groups = df.where(F.col(column).isNotNull()).groupBy(column)
    return groups.agg(F.avg(F.col(target).cast("double")).alias("default_rate"), F.count(target).alias("n")).orderBy(
        F.desc("default_rate"), column
    )


def table_inventory(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, columns and distinct keys per table; ``tables`` maps a name to (table, key).

    Distinct keys are counted in two levels, so a hot key is merged map-side.
    """
    parts = None
    for name, (df, key) in tables.items():
        per_key = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        part = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("_k").alias("n_keys")
        ).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"), "n_keys",
            F.lit(key).alias("key"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def missing_record_counts(features: DataFrame, references: dict[str, str]) -> DataFrame:
    """Applicants without a record per table, and their share."""
    row = features.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(ref).alias(f"c{i}") for i, ref in enumerate(references.values())]
    )
    names = {
        flag: [F.col("n") - F.col(f"c{i}"), (F.col("n") - F.col(f"c{i}")) / F.nullif(F.col("n"), F.lit(0))]
        for i, flag in enumerate(references)
    }
    return _long(row, names, ["n_without", "share_without"], "flag")


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct present values per column, most first.

    Values are merged per (column, value) map-side; no set is held per column.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    return distinct.groupBy("column").agg(F.count("value").alias("n_distinct")).orderBy(
        F.desc("n_distinct"), "column"
    )


def value_range(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    return row[0], row[1]


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Index of the equal-width bin; the last bin is closed on the right."""
    raw = F.floor((x - low) * bins / F.nullif(high - low, F.lit(0.0)))
    return F.greatest(F.lit(0), F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Bin counts over the column's range; with ``by``, densities within each class."""
    low, high = value_range(df, column)
    if low is None:
        low = high = 0.0
    keys = [by] if by else []
    present = df.where(F.col(column).isNotNull())
    if by:
        present = present.where(F.col(by).isNotNull())
    index = equal_width_bin(F.col(column).cast("double"), F.lit(low), F.lit(high), bins)
    counts = present.groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    total = F.sum("n").over(Window.partitionBy(*keys))
    out = counts.withColumn("left_edge", F.lit(low) + F.col("bin") * width)
    return out.withColumn("density", F.col("n") / (total * F.nullif(F.lit(width), F.lit(0.0))))


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("IS_TRAIN").agg(F.count(F.lit(1)).alias("n"), F.count("TARGET").alias("n_labelled"))


def null_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing share of every column, in one pass."""
    columns = columns or df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    names = {c: [1 - F.col(f"c{i}") / F.nullif(F.col("n"), F.lit(0))] for i, c in enumerate(columns)}
    return _long(row, names, ["null_share"])


def flag_shares(df: DataFrame, flags: list[str]) -> DataFrame:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(flags)])
    return _long(row, {c: [F.col(f"c{i}")] for i, c in enumerate(flags)}, ["share"], "flag")


def correlation_ranking(correlations: DataFrame, top: int | None = None) -> DataFrame:
    """Features by falling absolute correlation. One row per feature, so one task ranks them."""
    order = Window.partitionBy().orderBy(F.desc_nulls_last(F.round(F.abs("corr"), 9)), "feature")
    ranked = correlations.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top) if top else ranked


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in skip
    ]
