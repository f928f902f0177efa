"""Applicant features from the credit tables, one aggregate per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions.defaults import DPD_LEVELS, EMPLOYED_SENTINEL, NO_RECORD
from lendgrid.functions.nullsafe import count_where, rate, safe_div, sum0

KEY = "SK_ID_CURR"


def load_application(train: DataFrame, test: DataFrame) -> DataFrame:
    """Labelled and unlabelled applicants in one table; ``IS_TRAIN`` is 1 with a label."""
    both = train.unionByName(test, allowMissingColumns=True)
    return both.withColumn("IS_TRAIN", F.col("TARGET").isNotNull().cast("int"))


def clean_days_employed(app: DataFrame, sentinel: int = EMPLOYED_SENTINEL) -> DataFrame:
    """Sentinel to null, kept as a flag. A missing value is not anomalous."""
    days = F.col("DAYS_EMPLOYED")
    anomalous = F.coalesce(days == sentinel, F.lit(False))
    return app.withColumns(
        {"DAYS_EMPLOYED_ANOM": anomalous, "DAYS_EMPLOYED": F.when(~anomalous, days)}
    )


def add_business_ratios(app: DataFrame) -> DataFrame:
    return app.withColumns(
        {
            "credit_to_income": safe_div(F.col("AMT_CREDIT"), F.col("AMT_INCOME_TOTAL")),
            "annuity_to_income": safe_div(F.col("AMT_ANNUITY"), F.col("AMT_INCOME_TOTAL")),
            "credit_to_goods": safe_div(F.col("AMT_CREDIT"), F.col("AMT_GOODS_PRICE")),
        }
    )


def _per_applicant(df: DataFrame) -> DataFrame:
    return df.where(F.col(KEY).isNotNull()).groupBy(KEY)


def aggregate_bureau(bureau: DataFrame) -> DataFrame:
    return _per_applicant(bureau).agg(
        F.count("SK_ID_BUREAU").alias("bureau_count"),
        count_where(F.col("CREDIT_ACTIVE") == "Active").alias("bureau_active_count"),
        F.avg("AMT_CREDIT_SUM").alias("bureau_credit_sum_mean"),
        F.max("AMT_CREDIT_SUM").alias("bureau_credit_sum_max"),
        sum0(F.col("AMT_CREDIT_SUM_DEBT")).alias("bureau_debt_sum"),
        F.avg("AMT_CREDIT_SUM_DEBT").alias("bureau_debt_mean"),
        sum0(F.col("AMT_CREDIT_SUM_OVERDUE")).alias("bureau_overdue_sum"),
        F.max("AMT_CREDIT_SUM_OVERDUE").alias("bureau_overdue_max"),
        F.avg("AMT_ANNUITY").alias("bureau_annuity_mean"),
    )


def dpd_level(status: Column) -> Column:
    """Days-past-due level of a monthly status; null for a status outside the map."""
    level = None
    for code, value in DPD_LEVELS.items():
        level = F.when(status == code, F.lit(value)) if level is None else level.when(status == code, F.lit(value))
    return level


def balance_per_credit(bureau_balance: DataFrame) -> DataFrame:
    level = dpd_level(F.col("STATUS"))
    return (
        bureau_balance.where(F.col("SK_ID_BUREAU").isNotNull())
        .groupBy("SK_ID_BUREAU")
        .agg(
            F.count("MONTHS_BALANCE").alias("months_count"),
            count_where(level > 0).alias("months_dpd"),
            F.max(level).alias("worst_dpd_level"),
        )
    )


def aggregate_bureau_balance(bureau_balance: DataFrame, bureau_ids: DataFrame) -> DataFrame:
    """Monthly balances to credits, then through the bureau ids to applicants."""
    ids = bureau_ids.select(KEY, "SK_ID_BUREAU").where(F.col(KEY).isNotNull())
    joined = ids.join(balance_per_credit(bureau_balance), "SK_ID_BUREAU", "inner")
    return joined.groupBy(KEY).agg(
        F.count("SK_ID_BUREAU").alias("bb_credits_with_history"),
        F.sum("months_dpd").alias("bb_months_dpd_sum"),
        F.max("worst_dpd_level").alias("bb_worst_dpd_level_max"),
        F.avg("months_count").alias("bb_months_count_mean"),
    )


def aggregate_previous_application(previous: DataFrame) -> DataFrame:
    status = F.col("NAME_CONTRACT_STATUS")
    return _per_applicant(previous).agg(
        F.count("SK_ID_PREV").alias("prev_count"),
        F.bool_or(F.coalesce(status == "Refused", F.lit(False))).alias("prev_ever_refused"),
        rate(status == "Approved").alias("prev_approval_rate"),
        F.avg("AMT_CREDIT").alias("prev_credit_mean"),
        F.avg("AMT_ANNUITY").alias("prev_annuity_mean"),
        F.avg("DAYS_DECISION").alias("prev_days_decision_mean"),
    )


def aggregate_pos_cash(pos: DataFrame) -> DataFrame:
    # the one distinct count is planned over (applicant, credit) first, so a
    # hot applicant is spread over its credits before the last shuffle
    return _per_applicant(pos).agg(
        F.countDistinct("SK_ID_PREV").alias("pos_credits_count"),
        F.count("SK_ID_PREV").alias("pos_months_count"),
        rate(F.col("SK_DPD") > 0).alias("pos_dpd_rate"),
        F.max("SK_DPD").alias("pos_dpd_max"),
    )


def aggregate_credit_card(card: DataFrame) -> DataFrame:
    used = safe_div(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL"))
    return _per_applicant(card).agg(
        F.countDistinct("SK_ID_PREV").alias("cc_cards_count"),
        F.avg(used).alias("cc_utilization_mean"),
        F.max(used).alias("cc_utilization_max"),
        rate(F.col("SK_DPD") > 0).alias("cc_dpd_rate"),
    )


def aggregate_installments(installments: DataFrame, late_days: int = 5) -> DataFrame:
    delay = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return _per_applicant(installments).agg(
        F.avg(delay).alias("inst_delay_mean"),
        F.max(delay).alias("inst_delay_max"),
        rate(delay > late_days).alias("inst_late_rate"),
        F.avg(F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")).alias("inst_shortfall_mean"),
    )


def join_features(app: DataFrame, aggregates: list[DataFrame]) -> DataFrame:
    """Left joins on the applicant key.

    Each aggregate is already hash-partitioned on the key, so only the
    applicants are shuffled, once, for all the joins.
    """
    for aggregate in aggregates:
        app = app.join(aggregate, KEY, "left")
    return app


def add_no_record_flags(features: DataFrame, specs: dict[str, str] = NO_RECORD) -> DataFrame:
    return features.withColumns({flag: F.col(ref).isNull() for flag, ref in specs.items()})


def bureau_credits_ever_dpd(bureau_balance: DataFrame, bureau_ids: DataFrame) -> DataFrame:
    """Exploratory variant: number of credits with any month past due."""
    ever = bureau_balance.groupBy("SK_ID_BUREAU").agg(
        F.bool_or(F.coalesce(dpd_level(F.col("STATUS")) > 0, F.lit(False))).cast("int").alias("ever_dpd")
    )
    joined = bureau_ids.select(KEY, "SK_ID_BUREAU").join(ever, "SK_ID_BUREAU", "inner")
    return joined.groupBy(KEY).agg(F.sum("ever_dpd").alias("bureau_credits_ever_dpd"))


def pos_ever_dpd(pos: DataFrame) -> DataFrame:
    """Exploratory variant: worst delay and whether there was any."""
    return _per_applicant(pos).agg(
        F.max("SK_DPD").alias("pos_dpd_max"),
        F.bool_or(F.coalesce(F.col("SK_DPD") > 0, F.lit(False))).alias("pos_ever_dpd"),
    )
