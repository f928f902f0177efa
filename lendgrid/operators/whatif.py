"""Effect of imputation on scores, and what-if changes that flip a decision."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.functions.defaults import ACTIONABLE


def continuous_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with more than two distinct present values, from one scan.

    Minimum and maximum decide alone unless a value lies strictly between them.
    """
    ends = df.agg(
        *[F.min(F.col(f"`{c}`").cast("double")).alias(f"l{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(f"`{c}`").cast("double")).alias(f"h{i}") for i, c in enumerate(columns)],
    ).first()
    open_ = [i for i in range(len(columns)) if ends[f"l{i}"] is not None and ends[f"l{i}"] < ends[f"h{i}"]]
    if not open_:
        return []

    def between(i: int) -> Column:
        x = F.col(f"`{columns[i]}`").cast("double")
        return F.bool_or((x > F.lit(ends[f"l{i}"])) & (x < F.lit(ends[f"h{i}"])))

    row = df.agg(*[between(i).alias(f"b{i}") for i in open_]).first()
    return [columns[i] for i in open_ if row[f"b{i}"]]


def missing_count(columns: list[str]) -> Column:
    return sum((F.col(f"`{c}`").isNull().cast("int") for c in columns), F.lit(0))


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Medians for missing values, the same types otherwise."""
    types = dict(df.dtypes)
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.lit(m).cast(types[c])) for c, m in medians.items() if types[c] != "boolean"}
    return df.withColumns(filled)


def imputation_shift(native: DataFrame, imputed: DataFrame, threshold: float, id_col: str = "id") -> DataFrame:
    """Per case: score with and without imputation, their distance, and whether the decision flips.

    ``native`` has (id, p, n_missing), ``imputed`` (id, p).
    """
    other = imputed.select(id_col, F.col("p").alias("p_imputed"))
    cut = F.lit(float(threshold))
    return native.join(other, id_col).withColumns(
        {
            "shift": F.abs(F.col("p") - F.col("p_imputed")),
            "flips": (F.col("p") >= cut) != (F.col("p_imputed") >= cut),
            "complete": F.col("n_missing") == 0,
        }
    )


def shift_summary(shifts: DataFrame) -> DataFrame:
    return shifts.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("complete").cast("long")).alias("n_complete"),
        F.sum(F.col("flips").cast("long")).alias("n_flips"),
        F.avg("shift").alias("mean_shift"),
        F.max("shift").alias("max_shift"),
    )


def counterfactuals(cases: DataFrame, score, threshold: float, scales: dict[str, float], inputs: list[str],
                    id_col: str = "SK_ID_CURR",
                    columns: tuple[str, ...] = ACTIONABLE, factors: tuple[float, ...] = (0.5, 0.75, 0.9, 1.0, 1.1, 1.25, 1.5),
                    limit: int = 3) -> DataFrame:
    """Up to ``limit`` smallest changes of the actionable columns that flip each complete case.

    A case is complete without missing ``inputs``; ``score(df)`` adds ``p``. Every case tries the same fixed grid of factors,
    so the work is a constant multiple of the cases and needs no join. Distance
    is the sum of changes over the column's scale.
    """
    grid = [g for g in product(factors, repeat=len(columns)) if any(f != 1.0 for f in g)]
    options = F.array(*[F.struct(*[F.lit(f).alias(f"m{i}") for i, f in enumerate(g)]) for g in grid])
    complete = score(cases.where(missing_count(inputs) == 0)).withColumnRenamed("p", "p_original")
    tried = complete.withColumn("_g", F.explode(options))
    for i, c in enumerate(columns):
        tried = tried.withColumn(f"_was_{i}", F.col(c).cast("double")).withColumn(c, F.col(c).cast("double") * F.col("_g")[f"m{i}"])
    distance = sum(
        (F.abs(F.col(c) - F.col(f"_was_{i}")) / F.lit(float(scales[c]) or 1.0) for i, c in enumerate(columns)), F.lit(0.0)
    )
    cut = F.lit(float(threshold))
    rescored = score(tried.withColumn("distance", F.round(distance, 9)))
    flipped = rescored.where((F.col("p") >= cut) != (F.col("p_original") >= cut))
    order = Window.partitionBy(id_col).orderBy("distance", *columns)
    return (
        flipped.select(id_col, *columns, "p_original", "p", "distance")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= limit)
    )
