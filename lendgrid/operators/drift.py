"""Population stability of all columns in one job, and the alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from lendgrid.functions.defaults import PSI_ALERT, PSI_BINS, PSI_DISCRETE_LIMIT, PSI_FLOOR
from lendgrid.operators.profile import cardinality, equal_width_bin


def column_bins(df: DataFrame, columns: list[str], bins: int = PSI_BINS, limit: int = PSI_DISCRETE_LIMIT) -> dict[str, Column]:
    """Bin label of each column over the pooled rows.

    Numbers with more than ``limit`` distinct values get equal-width bins over
    their range; everything else is its own bin. One scan decides all columns,
    and only those near the limit are counted exactly.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(types[c], NumericType)]
    wide: dict[str, tuple[float, float]] = {}
    if numeric:
        row = df.agg(
            *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(numeric)],
            *[F.min(F.col(f"`{c}`")).cast("double").alias(f"l{i}") for i, c in enumerate(numeric)],
            *[F.max(F.col(f"`{c}`")).cast("double").alias(f"h{i}") for i, c in enumerate(numeric)],
        ).first()
        ends = {c: (row[f"l{i}"], row[f"h{i}"]) for i, c in enumerate(numeric)}
        approx = {c: row[f"d{i}"] for i, c in enumerate(numeric)}
        # the sketch errs by 5 %, so four times the limit is certain
        unsure = [c for c in numeric if limit / 4 < approx[c] <= limit * 4]
        exact = {r["column"]: r["n_distinct"] for r in cardinality(df, unsure).collect()} if unsure else {}
        wide = {c: ends[c] for c in numeric if exact.get(c, approx[c]) > limit}
    labels = {}
    for c in columns:
        x = F.col(f"`{c}`")
        if c in wide:
            low, high = wide[c]
            label = equal_width_bin(x.cast("double"), F.lit(low), F.lit(high), bins).cast("string")
        else:
            label = x.cast("string")
        labels[c] = F.when(x.isNotNull(), label)
    return labels


def stability_index(df: DataFrame, columns: list[str], is_reference: Column, bins: int = PSI_BINS,
                    limit: int = PSI_DISCRETE_LIMIT, floor: float = PSI_FLOOR) -> DataFrame:
    """``(column, psi)``: sum of (r - c) * ln(r / c) over bins, missing values left out.

    Cells are counted per (column, bin) before the shuffle, so what moves is
    bins, not rows.
    """
    labels = column_bins(df, columns, bins, limit)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), label.alias("bin")) for c, label in labels.items()])
    long = df.select(F.explode(cells).alias("_c"), is_reference.alias("_ref"))
    counts = (
        long.where(F.col("_c.bin").isNotNull() & F.col("_ref").isNotNull())
        .groupBy("_c.column", "_c.bin")
        .agg(F.sum(F.col("_ref").cast("long")).alias("r"), F.sum((~F.col("_ref")).cast("long")).alias("c"))
    )
    totals = counts.groupBy("column").agg(F.sum("r").alias("all_r"), F.sum("c").alias("all_c"))

    def share(n: str, total: str) -> Column:
        s = F.col(n) / F.nullif(F.col(total), F.lit(0))
        return F.when(F.coalesce(s, F.lit(0.0)) > 0, s).otherwise(F.lit(floor))

    r, c = share("r", "all_r"), share("c", "all_c")
    return counts.join(totals, "column").groupBy("column").agg(F.sum((r - c) * F.log(r / c)).alias("psi"))


def alert_columns(psi: DataFrame, threshold: float = PSI_ALERT) -> DataFrame:
    """Columns strictly above the threshold."""
    return psi.where(F.col("psi") > threshold)


def alert_report(psi: DataFrame, threshold: float = PSI_ALERT) -> DataFrame:
    """Evaluated columns, number of alerts and their list, worst first.

    The list is as long as the table is wide, whatever the number of rows.
    """
    alert = F.col("psi") > threshold
    listed = F.sort_array(F.collect_list(F.when(alert, F.struct((-F.round("psi", 9)).alias("k"), "column", "psi"))))
    return psi.agg(
        F.count(F.lit(1)).alias("n_evaluated"), F.sum(alert.cast("long")).alias("n_alerts"), listed.alias("_l")
    ).select("n_evaluated", "n_alerts", F.transform("_l", lambda s: F.struct(s["column"], s["psi"])).alias("alerts"))
