"""Default models: a linear baseline on Spark ML and boosted trees."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendgrid.functions import defaults
from lendgrid.operators.boosting import NODES, PATIENCE, Booster, TreeSettings, fit_booster, margins_of, trees_of
from lendgrid.operators.scoring import ranking_metrics
from lendgrid.operators.segments import Scaling, fit_scaling
from lendgrid.operators.splits import stratified_folds
from lendgrid.operators.summaries import matrix_of, values_of
from lendgrid.session import shared_folder


def feature_columns(df: DataFrame, skip: tuple[str, ...] = defaults.NON_FEATURES) -> list[str]:
    """All columns but id, label and split."""
    return [c for c in df.columns if c not in skip]


def balanced_weights(train: DataFrame, y: str = "TARGET") -> dict[int, float]:
    """Class weight n / (classes * n_class)."""
    counts = {int(r[0]): r[1] for r in train.groupBy(y).agg(F.count(F.lit(1))).collect()}
    total = sum(counts.values())
    return {label: total / (len(counts) * n) for label, n in counts.items()}


def negative_to_positive(train: DataFrame, y: str = "TARGET") -> float:
    """Weight of the positive class that balances it against the negative one."""
    row = train.agg(F.sum((F.col(y) == 0).cast("long")), F.sum((F.col(y) == 1).cast("long"))).first()
    return row[0] / row[1]


def _weight(y: str, weights: dict[int, float]) -> Column:
    out = F.lit(1.0)
    for label, weight in weights.items():
        out = F.when(F.col(y) == label, F.lit(float(weight))).otherwise(out)
    return out


@dataclass(frozen=True)
class LinearScorer:
    """Median-imputed, standardised logistic regression."""

    scaling: Scaling
    coefficients: tuple[float, ...]
    intercept: float

    def margin(self) -> Column:
        terms = (F.lit(w) * self.scaling.standard(c) for w, c in zip(self.coefficients, self.scaling.columns) if w)
        return sum(terms, F.lit(self.intercept))

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        # a plain expression: scoring stays inside code generation
        return df.withColumn(name, 1 / (1 + F.exp(-self.margin())))


def fit_baseline(train: DataFrame, columns: list[str], y: str = "TARGET", iterations: int = 1000) -> LinearScorer:
    scaling = fit_scaling(train, tuple(columns))
    weights = balanced_weights(train, y)
    rows = train.select(
        F.col(y).cast("double").alias("label"), _weight(y, weights).alias("weight"),
        # what rounding leaves of a constant column would be scaled up by the fit, and its line search fail
        *[(scaling.standard(c) if scaling.deviations[c] else F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(columns)],
    )
    vectors = VectorAssembler(inputCols=[f"f{i}" for i in range(len(columns))], outputCol="vector").transform(rows)
    # the inputs are standardised already; C=1 of a summed loss is 1/n of an averaged one
    n = vectors.count()
    model = LogisticRegression(
        featuresCol="vector", weightCol="weight", maxIter=iterations, regParam=1.0 / max(n, 1), standardization=False
    ).fit(vectors)
    return LinearScorer(scaling, tuple(float(w) for w in model.coefficients), float(model.intercept))


@dataclass(frozen=True)
class TreeScorer:
    """Boosted trees over raw values: missing ones take the side that each split has learned."""

    booster: Booster

    @property
    def names(self) -> list[str]:
        return list(self.booster.columns)

    @property
    def tree_count(self) -> int:
        return len(self.booster.trees)

    def margin(self, df: DataFrame) -> Column:
        """The margin of a row; only the model's columns leave the JVM, in Arrow batches."""
        sent = df.sparkSession.sparkContext.broadcast((self.booster.stacked(), self.booster.base))

        @F.arrow_udf("double")
        def margin(values: pa.Array) -> pa.Array:
            stacked, base = sent.value
            return pa.array(margins_of(matrix_of(values), stacked, base), pa.float64())

        return margin(values_of(self.booster.columns))

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        return df.withColumn(name, 1 / (1 + F.exp(-self.margin(df))))


def fit_trees(train: DataFrame, columns: list[str], y: str = "TARGET", settings: TreeSettings = TreeSettings(),
              validation: str | None = None, patience: int = PATIENCE, key: str = "SK_ID_CURR", **options) -> TreeScorer:
    """Boosted trees (see ``boosting.fit_booster``); rows are sampled by ``key`` if ``train`` has it."""
    return TreeScorer(fit_booster(train, columns, y, settings, validation, patience, key if key in train.columns else None, **options))


def cross_validate(df: DataFrame, columns: list[str], y: str = "TARGET", id_col: str = "SK_ID_CURR", folds: int = 5,
                   settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Metrics per fold and the number of trees each fold kept.

    Each fold's model stops early on the fold itself, which is also the scored part. The fits do not wait for one another.
    """
    labelled = stratified_folds(df, id_col, y, folds).persist()

    def fit(fold: int) -> TreeScorer:
        return fit_trees(labelled.withColumn("_held", F.col("fold") == fold), columns, y, settings, validation="_held", key=id_col)

    try:
        labelled.count()
        with ThreadPoolExecutor(folds) as pool:
            scorers = list(pool.map(fit, range(folds)))
        scored = None
        for fold, scorer in enumerate(scorers):
            part = scorer.score(labelled.where(F.col("fold") == fold)).select("fold", F.col(y).alias("y"), "p")
            scored = part if scored is None else scored.unionByName(part)
        metrics = ranking_metrics(scored, keys=("fold",)).collect()  # one row per fold
    finally:
        labelled.unpersist()
    rows = [(r["fold"], r["roc_auc"], r["pr_auc"], r["ks"], r["brier"], r["n"], scorers[r["fold"]].tree_count) for r in metrics]
    return df.sparkSession.createDataFrame(
        rows, "fold int, roc_auc double, pr_auc double, ks double, brier double, n long, trees int"
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold AUCs, and the rounded mean tree count."""
    return folds.agg(
        F.avg("roc_auc").alias("cv_auc_mean"),
        F.stddev_pop("roc_auc").alias("cv_auc_std"),
        F.round(F.avg("trees")).cast("int").alias("tree_count"),
    )


def save_trees(scorer: TreeScorer, path: str | None = None) -> str:
    """Write the node table below the shared folder and return where it is."""
    spark = SparkSession.active()
    path = path or f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    scorer.booster.nodes(spark).write.mode("overwrite").parquet(path)
    return path


def read_nodes(path: str) -> DataFrame:
    """Node table of a saved model: one row per node."""
    return SparkSession.active().read.schema(NODES).parquet(path)


def load_trees(path: str, columns: list[str], base: float) -> TreeScorer:
    """The scorer of a saved node table."""
    return TreeScorer(Booster(tuple(columns), tuple(trees_of(read_nodes(path).toArrow())), base))


def gain_importance(nodes: DataFrame, names: list[str], top: int = 20) -> DataFrame:
    """Mean gain per use of a feature, highest first."""
    labels = F.array(*[F.lit(n) for n in names])
    return (
        nodes.where(F.col("left") >= 0)
        .groupBy(F.element_at(labels, F.col("feature") + 1).alias("feature"))
        .agg(F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
        .orderBy(F.desc("gain"), "feature")
        .limit(top)
    )
