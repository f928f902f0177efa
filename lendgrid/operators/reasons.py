"""Adverse-action reasons from attributions, and the explanation record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions import defaults


def reason_text(feature: Column, texts: dict[str, str] = defaults.REASON_TEXT) -> Column:
    """Wording of a feature, or the generic sentence with its name."""
    before, after = defaults.REASON_FALLBACK
    pairs = [F.lit(x) for item in texts.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[feature], F.concat(F.lit(before), feature, F.lit(after)))


def strict_protected(names: list[str], prefixes: tuple[str, ...] = defaults.PROTECTED_STRICT_PREFIXES) -> tuple[str, ...]:
    """Protected set that also covers marital status."""
    return tuple(n for n in names if n.startswith(prefixes))


def reason_codes(names: list[str], contributions: Column, limit: int = defaults.REASON_LIMIT,
                 protected: tuple[str, ...] = defaults.PROTECTED, texts: dict[str, str] = defaults.REASON_TEXT) -> Column:
    """Up to ``limit`` texts of the largest positive contributions of unprotected features.

    The work is inside the row's array: no shuffle, whatever the population.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    labels = F.array(*[F.lit(n) for n in names])
    cells = F.transform(
        contributions,
        lambda c, i: F.struct((-F.round(c, 9)).alias("size"), i.alias("at"), c.alias("c"), F.element_at(labels, i + 1).alias("feature")),
    )
    kept = F.filter(cells, lambda s: (s["c"] > 0) & ~s["feature"].isin(*protected))
    return F.transform(F.slice(F.sort_array(kept), 1, limit), lambda s: reason_text(s["feature"], texts))


def explain_records(wide: DataFrame, records: DataFrame, names: list[str], base: float,
                    limit: int = defaults.REASON_LIMIT) -> DataFrame:
    """Score record, base value, attributions in feature order and reasons; reasons only for high risk.

    Spark takes an array of any length for one number and would broadcast the attributions of a population far beyond its limit; the join sorts both sides.
    """
    codes = reason_codes(names, F.col("contributions"), limit)
    none = F.array().cast("array<string>")
    joined = records.join(wide.select(F.col("id").alias("sk_id_curr"), "contributions").hint("merge"), "sk_id_curr")
    return joined.select(
        "sk_id_curr", "probability", "threshold", "decision", F.lit(float(base)).alias("base_value"),
        F.col("contributions").alias("shap_values"),
        F.array(*[F.lit(n) for n in names]).alias("feature_names"),
        F.when(F.col("decision") == defaults.HIGH_RISK, codes).otherwise(none).alias("reason_codes"),
    )


def lookup_explanations(requested: DataFrame, explained: DataFrame) -> DataFrame:
    return requested.select("sk_id_curr").distinct().join(explained, "sk_id_curr", "left").withColumn(
        "found", F.col("decision").isNotNull()
    )
