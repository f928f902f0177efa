"""Group fairness of binary decisions for several attributes in one run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.functions.defaults import AGE_BANDS, IMPACT_FLOOR, PARITY_RANGE


def age_band(years: Column, bands=AGE_BANDS) -> Column:
    """Right-closed band of an age; null outside all bands."""
    out = None
    for low, high, label in bands:
        inside = (years > low) & (years <= high)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def group_rates(decided: DataFrame, attributes: dict[str, Column], y: str = "y", pred: str = "pred") -> DataFrame:
    """Per attribute and group: rows, selection rate, recall and real rate.

    Recall is 0 for a group without positives. Rows are unfolded once per
    attribute and merged map-side, so the shuffle carries groups only.
    """
    pairs = F.array(
        *[F.struct(F.lit(k).alias("attribute"), c.cast("string").alias("group")) for k, c in attributes.items()]
    )
    real, selected = F.col(y).cast("double"), F.col(pred).cast("double")
    long = decided.select(F.explode(pairs).alias("_a"), real.alias("_y"), selected.alias("_s"))
    return (
        long.select("_a.*", "_y", "_s")
        .where(F.col("group").isNotNull())
        .groupBy("attribute", "group")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_s").alias("selection_rate"),
            F.coalesce(F.sum(F.col("_s") * F.col("_y")) / F.nullif(F.sum("_y"), F.lit(0.0)), F.lit(0.0)).alias("recall"),
            F.avg("_y").alias("real_rate"),
        )
    )


def _spread(c: str) -> Column:
    return F.max(c) - F.min(c)


def _ratio(c: str) -> Column:
    return F.min(c) / F.nullif(F.max(c), F.lit(0.0))


def fairness_metrics(rates: DataFrame) -> DataFrame:
    """Parity difference, impact ratio and opportunity difference, with verdicts."""
    out = rates.groupBy("attribute").agg(
        _spread("selection_rate").alias("statistical_parity_difference"),
        _ratio("selection_rate").alias("disparate_impact"),
        _spread("recall").alias("equal_opportunity_difference"),
    )
    return with_verdicts(out)


def with_verdicts(metrics: DataFrame, parity_range: float = PARITY_RANGE, impact_floor: float = IMPACT_FLOOR) -> DataFrame:
    return metrics.withColumns(
        {
            "parity_ok": F.col("statistical_parity_difference").between(-parity_range, parity_range),
            "impact_ok": F.col("disparate_impact") >= impact_floor,
            "opportunity_ok": F.col("equal_opportunity_difference").between(-parity_range, parity_range),
        }
    )


def amplification(rates: DataFrame) -> DataFrame:
    """Gap and ratio between groups, real against predicted, and how much the model widens the gap."""
    out = rates.groupBy("attribute").agg(
        _spread("real_rate").alias("real_gap"),
        _spread("selection_rate").alias("predicted_gap"),
        _ratio("real_rate").alias("real_ratio"),
        _ratio("selection_rate").alias("predicted_ratio"),
    )
    return out.withColumn("gap_amplification", F.col("predicted_gap") / F.nullif(F.col("real_gap"), F.lit(0.0)))


def fairness_attributes(gender: str = "CODE_GENDER_M", days_birth: str = "DAYS_BIRTH", year: float = 365.25) -> dict[str, Column]:
    """The two audited attributes of an applicant."""
    return {"gender": F.col(gender).cast("int"), "age": age_band(-F.col(days_birth) / F.lit(year))}


def fairness_report(decided: DataFrame, attributes: dict[str, Column], y: str = "y", pred: str = "pred") -> DataFrame:
    """Group rates of every attribute next to the attribute's metrics.

    An attribute has few groups, so its metrics are a window over them and the cases are read once.
    """
    rates = group_rates(decided, attributes, y, pred)
    groups = Window.partitionBy("attribute")

    def spread(c: str) -> Column:
        return F.max(c).over(groups) - F.min(c).over(groups)

    return with_verdicts(
        rates.withColumns(
            {
                "statistical_parity_difference": spread("selection_rate"),
                "disparate_impact": F.min("selection_rate").over(groups)
                / F.nullif(F.max("selection_rate").over(groups), F.lit(0.0)),
                "equal_opportunity_difference": spread("recall"),
            }
        )
    )
