"""Train, evaluate, refit, score and fix the threshold."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lendgrid.operators.models import TreeScorer, TreeSettings, feature_columns, fit_trees
from lendgrid.operators.scoring import ranking_metrics, rate_matched_threshold, score_records
from lendgrid.operators.splits import stratified_holdout
from lendgrid.session import cut_lineage


@dataclass(frozen=True)
class Bundle:
    """What later jobs need: the final model, the scored applicants and the threshold."""

    scorer: TreeScorer
    columns: tuple[str, ...]
    scored: DataFrame
    threshold: float
    holdout_metrics: dict

    def score_unlabelled(self, features: DataFrame) -> DataFrame:
        """Score records of all applicants without a label, as one set."""
        scored = self.scorer.score(features.where("IS_TRAIN = 0"))
        return score_records(scored, self.threshold, "SK_ID_CURR")

    def records(self) -> DataFrame:
        return score_records(self.scored, self.threshold, "SK_ID_CURR")


def train_full_model(features: DataFrame, columns: list[str] | None = None, settings: TreeSettings = TreeSettings(),
                     final: Callable[[], TreeScorer] | None = None) -> Bundle:
    """Holdout metrics of a first fit, then a fit on all labelled rows; ``final`` gives that fit, if not this one is to.

    ``features`` should be a written table: the fits and the scoring scan it again. The two fits do not wait for one another.
    """
    columns = columns or feature_columns(features)
    train = features.where("IS_TRAIN = 1")
    # ranks shuffle whole rows, so the split is written once; the fit and its metrics scan it several times
    split = cut_lineage(stratified_holdout(train, "SK_ID_CURR", "TARGET"))
    with ThreadPoolExecutor(1) as pool:
        later = pool.submit(final or (lambda: fit_trees(train, columns, settings=settings)))
        first = fit_trees(split.where("NOT is_holdout"), columns, settings=settings)
        whole = later.result()
    metrics = ranking_metrics(first.score(split.where("is_holdout")), y="TARGET").first().asDict()
    # scores feed the threshold and every later lookup, so they are written once; only what those need
    scored = cut_lineage(whole.score(train).select("SK_ID_CURR", "IS_TRAIN", "TARGET", "p", F.col("TARGET").cast("int").alias("y")))
    return Bundle(whole, tuple(columns), scored, rate_matched_threshold(scored), metrics)
