"""Segmentation: impute, standardise, K-Means with restarts, profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.functions.defaults import SEED, SEGMENT_COUNT, SEGMENT_INPUTS
from lendgrid.operators.kmeans import Fit, fit_many
from lendgrid.operators.ordered import exact_quantiles, sample_rows
from lendgrid.sources.tables import enforce_unique


def add_cluster_input_columns(df: DataFrame, year: float = 365.0) -> DataFrame:
    return df.withColumns(
        {"AGE_YEARS": -F.col("DAYS_BIRTH") / F.lit(year), "EMPLOYED_YEARS": -F.col("DAYS_EMPLOYED") / F.lit(year)}
    )

DOUBLE_EPSILON = 2.0**-52


@dataclass(frozen=True)
class Scaling:
    """Medians, means and population deviations of the training rows."""

    columns: tuple[str, ...]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    def imputed(self, column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("double"), F.lit(float(self.medians[column])))

    def standard(self, column: str) -> Column:
        spread = self.deviations[column] or 1.0
        return (self.imputed(column) - F.lit(float(self.means[column]))) / F.lit(float(spread))


def fit_scaling(train: DataFrame, columns: tuple[str, ...] = SEGMENT_INPUTS) -> Scaling:
    """Exact medians, then mean and population deviation of the imputed values.

    A column without values counts as 0. A deviation that rounding alone
    explains is 0, so a constant column is centred but not blown up.
    """
    medians = {c: q[0] or 0.0 for c, q in exact_quantiles(train, {c: [0.5] for c in columns}).items()}
    blank = Scaling(tuple(columns), medians, {}, {})
    row = train.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(blank.imputed(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(blank.imputed(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    means = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(columns)}
    deviations = {}
    for i, c in enumerate(columns):
        spread, noise = row[f"s{i}"] or 0.0, row["n"] * DOUBLE_EPSILON
        deviations[c] = 0.0 if spread**2 <= noise * spread**2 + (noise * means[c]) ** 2 else spread
    return Scaling(tuple(columns), medians, means, deviations)


def standardise(df: DataFrame, scaling: Scaling, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and the standardised inputs under their own names."""
    return df.select(*keep, *[scaling.standard(c).alias(c) for c in scaling.columns])


def with_vector(standard: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="vector").transform(standard)


@dataclass(frozen=True)
class Centres:
    """Cluster centres in standardised space, largest cluster first."""

    columns: tuple[str, ...]
    points: tuple[tuple[float, ...], ...]
    inertia: float


def _ordered(columns: tuple[str, ...], fit: Fit) -> Centres:
    """Centres by falling size."""
    order = sorted(range(len(fit.sizes)), key=lambda i: (-fit.sizes[i], tuple(fit.points[i])))
    return Centres(tuple(columns), tuple(tuple(float(v) for v in fit.points[i]) for i in order), float(fit.inertia))


def fit_kmeans(vectors: DataFrame, columns: tuple[str, ...], k: int = SEGMENT_COUNT, seed: int = SEED, restarts: int = 10,
               iterations: int = 300) -> Centres:
    """Best of several seeded fits by inertia, all advanced by the same scans. ``vectors`` should be cached by the caller."""
    fits, _ = fit_many(vectors.select(vector_to_array("vector").alias("x")), [(k, seed + r) for r in range(restarts)], iterations)
    return _ordered(columns, min(fits, key=lambda f: f.inertia))


def nearest_centre(centres: Centres) -> Column:
    """Index of the nearest centre; one expression, so no vector is built per row."""
    distances = [
        sum(((F.col(f"`{c}`") - F.lit(v)) * (F.col(f"`{c}`") - F.lit(v)) for c, v in zip(centres.columns, point)), F.lit(0.0))
        for point in centres.points
    ]
    return (F.array_position(F.array(*distances), F.array_min(F.array(*distances))) - 1).cast("int")


def assign_clusters(features: DataFrame, scaling: Scaling, centres: Centres, id_col: str = "SK_ID_CURR") -> DataFrame:
    standard = standardise(add_cluster_input_columns(features), scaling, (id_col, "IS_TRAIN"))
    return standard.select(id_col, "IS_TRAIN", nearest_centre(centres).alias("cluster"))


def build_segments(features: DataFrame, k: int = SEGMENT_COUNT, seed: int = SEED, restarts: int = 10, check: bool = True) -> DataFrame:
    """Fit on the labelled applicants, assign everyone."""
    train = add_cluster_input_columns(features.where("IS_TRAIN = 1"))
    scaling = fit_scaling(train)
    vectors = with_vector(standardise(train, scaling), scaling.columns).select("vector").persist()
    try:
        centres = fit_kmeans(vectors, scaling.columns, k, seed, restarts)
    finally:
        vectors.unpersist()
    segments = assign_clusters(features, scaling, centres)
    if check:
        enforce_unique(segments, "SK_ID_CURR")
    return segments


def sweep_k(standard: DataFrame, columns: tuple[str, ...], id_col: str, ks=range(2, 9), seed: int = SEED, restarts: int = 10,
            sample: int | None = None) -> DataFrame:
    """Inertia and squared-Euclidean silhouette per k, on all rows; ``sample`` takes the silhouette on so many seeded ones.

    All starts of all k are advanced by the same scans.
    """
    vectors = with_vector(standard, columns).select(id_col, "vector", *columns).persist()
    drawn = vectors if sample is None else sample_rows(vectors, id_col, sample, seed).persist()
    evaluator = ClusteringEvaluator(featuresCol="vector", predictionCol="cluster")
    rows = []
    try:
        fits, _ = fit_many(vectors.select(vector_to_array("vector").alias("x")), [(k, seed + r) for k in ks for r in range(restarts)])
        for k in ks:
            centres = _ordered(columns, min((f for f in fits if f.k == k), key=lambda f: f.inertia))
            labelled = drawn.withColumn("cluster", nearest_centre(centres))
            rows.append((int(k), centres.inertia, float(evaluator.evaluate(labelled))))
    finally:
        drawn.unpersist()
        vectors.unpersist()
    return standard.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def cluster_profile(df: DataFrame, columns: list[str], target: str = "TARGET") -> DataFrame:
    """Size, default rate and input means per cluster."""
    return df.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg(F.col(target).cast("double")).alias("default_rate"),
        *[F.avg(F.col(c).cast("double")).alias(c) for c in columns],
    )


def compute_segments(segments: DataFrame, features: DataFrame) -> DataFrame:
    """Labelled segments with their outcome columns."""
    outcome = features.select("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "AMT_CREDIT")
    return segments.where("IS_TRAIN = 1").join(outcome, "SK_ID_CURR", "inner")


def segment_profile(train_segments: DataFrame) -> DataFrame:
    profile = train_segments.groupBy("cluster").agg(
        F.count("SK_ID_CURR").alias("n_clientes"),
        F.avg(F.col("TARGET").cast("double")).alias("tasa_default"),
        F.avg("AMT_INCOME_TOTAL").alias("ingreso_promedio"),
        F.avg("AMT_CREDIT").alias("credito_promedio"),
    )
    return profile.withColumn("pct_poblacion", F.col("n_clientes") / F.sum("n_clientes").over(Window.partitionBy()))


def cluster_shares(segments: DataFrame) -> DataFrame:
    """Share of each cluster within its split."""
    counts = segments.groupBy("IS_TRAIN", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("IS_TRAIN")))


def project_2d(standard: DataFrame, columns: tuple[str, ...], id_col: str, sample: int | None = None, seed: int = SEED) -> tuple[DataFrame, list[float]]:
    """Two principal components of all rows, or of ``sample`` seeded ones, and the variance they explain.

    The fit uses all rows. A component points where its largest loading is positive.
    """
    vectors = with_vector(standard, columns).select(id_col, "vector")
    model = PCA(k=2, inputCol="vector", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    drawn = vectors if sample is None else sample_rows(vectors, id_col, sample, seed)
    pc = vector_to_array("pc")
    out = model.transform(drawn).select(
        id_col, (pc[0] * signs[0]).alias("PC1"), (pc[1] * signs[1]).alias("PC2")
    )
    return out, [float(v) for v in model.explainedVariance.toArray()]
