"""Ranking and calibration metrics, thresholds, decisions and score lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions.defaults import HIGH_RISK, LOW_RISK
from lendgrid.operators.ordered import exact_quantiles, place_in_ranges, running_sums


def score_counts(scored: DataFrame, y: str = "y", p: str = "p", keys: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives per distinct score, merged map-side."""
    labelled = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return labelled.groupBy(*keys, F.col(p).cast("double").alias("p")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum(1 - F.col(y).cast("long")).alias("neg")
    )


def ranking_metrics(scored: DataFrame, y: str = "y", p: str = "p", keys: tuple[str, ...] = ()) -> DataFrame:
    """ROC-AUC, average precision, KS and Brier score per key, exact under ties.

    All four come from one table of counts per distinct score, walked from the
    highest score down in ranges. A metric without both classes is null.
    """
    counts = place_in_ranges(score_counts(scored, y, p, keys), "p")
    run = running_sums(counts, [F.col("p").desc()], ["pos", "neg"], keys, descending=True)
    positives, negatives = F.nullif(F.col("all_pos"), F.lit(0)), F.nullif(F.col("all_neg"), F.lit(0))
    above = F.col("cum_pos") - F.col("pos")
    return run.groupBy(*keys).agg(
        F.sum(F.col("neg") / negatives * ((above + F.col("pos") / 2) / positives)).alias("roc_auc"),
        F.sum(F.col("pos") / positives * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))).alias("pr_auc"),
        F.when(
            (F.max("all_pos") > 0) & (F.max("all_neg") > 0),
            F.greatest(F.max(F.col("cum_pos") / positives - F.col("cum_neg") / negatives), F.lit(0.0)),
        ).alias("ks"),
        (
            F.sum(F.col("pos") * F.pow(1 - F.col("p"), 2) + F.col("neg") * F.pow("p", 2))
            / F.sum(F.col("pos") + F.col("neg"))
        ).alias("brier"),
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
    )


def rate_matched_threshold(scored: DataFrame, y: str = "y", p: str = "p") -> float:
    """Score that marks as many cases high-risk as there are real defaults."""
    labelled = scored.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    positive_rate = labelled.agg(F.avg(F.col(y).cast("double"))).first()[0]
    if positive_rate is None:
        raise ValueError("no labelled scores")
    return exact_quantiles(labelled, {p: [1 - positive_rate]})[p][0]


def decision(p: Column, threshold: Column) -> Column:
    return F.when(p >= threshold, F.lit(HIGH_RISK)).otherwise(F.lit(LOW_RISK))


def score_records(scored: DataFrame, threshold: float, id_col: str = "id", p: str = "p") -> DataFrame:
    """``sk_id_curr, probability, threshold, decision`` per scored case."""
    cut = F.lit(float(threshold))
    return scored.select(
        F.col(id_col).cast("long").alias("sk_id_curr"),
        F.col(p).cast("double").alias("probability"),
        cut.alias("threshold"),
        decision(F.col(p), cut).alias("decision"),
    )


def lookup_scores(requested: DataFrame, records: DataFrame) -> DataFrame:
    """Records of the requested ids; an id that was never scored has ``found`` false."""
    asked = requested.select("sk_id_curr").distinct()
    return asked.join(records, "sk_id_curr", "left").withColumn("found", F.col("decision").isNotNull())


def population_summary(scored: DataFrame, threshold: float, y: str = "y") -> DataFrame:
    """Labelled cases, real default rate and the threshold in use."""
    return scored.agg(F.count(y).alias("n_labelled"), F.avg(F.col(y).cast("double")).alias("default_rate")).withColumn(
        "threshold", F.lit(float(threshold))
    )


def riskiest_first(scored: DataFrame, id_col: str = "id", p: str = "p") -> DataFrame:
    """Cases by falling score; equal scores by id."""
    return scored.select(id_col, p).orderBy(F.col(p).desc_nulls_last(), id_col)


def example_cases(scored: DataFrame, target: float = 0.5, id_col: str = "id", p: str = "p") -> DataFrame:
    """The case with the highest score, with the lowest, and nearest to ``target``; the smallest id wins a tie."""
    case = F.struct(F.col(id_col).alias("id"), F.col(p).alias("p"))
    row = scored.where(F.col(p).isNotNull()).agg(
        F.min_by(case, F.struct(-F.col(p), F.col(id_col))).alias("highest"),
        F.min_by(case, F.struct(F.col(p), F.col(id_col))).alias("lowest"),
        F.min_by(case, F.struct(F.round(F.abs(F.col(p) - target), 12), F.col(id_col))).alias("nearest"),
    )
    named = [
        F.struct(F.lit(k).alias("example"), F.col(f"{k}.id").alias("id"), F.col(f"{k}.p").alias("p"))
        for k in ("highest", "lowest", "nearest")
    ]
    return row.select(F.explode(F.array(*named)).alias("_e")).select("_e.*")
