"""The applicant feature table, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendgrid.operators import features as fe
from lendgrid.operators.encoding import encode_categoricals, fit_categories
from lendgrid.sources.tables import enforce_unique, scan_csv, scan_parquet

TABLES = (
    "application_train", "application_test", "bureau", "bureau_balance", "previous_application",
    "POS_CASH_balance", "credit_card_balance", "installments_payments",
)


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    scan = scan_csv if fmt == "csv" else (lambda s, d, name: scan_parquet(s, f"{d}/{name}.parquet"))
    return {name: scan(spark, folder, name) for name in TABLES}


def joined_features(tables: dict[str, DataFrame]) -> DataFrame:
    """Applicants with the six aggregates and the coverage flags, before encoding."""
    app = fe.load_application(tables["application_train"], tables["application_test"])
    app = fe.add_business_ratios(fe.clean_days_employed(app))
    bureau = tables["bureau"]
    aggregates = [
        fe.aggregate_bureau(bureau),
        fe.aggregate_bureau_balance(tables["bureau_balance"], bureau),
        fe.aggregate_previous_application(tables["previous_application"]),
        fe.aggregate_pos_cash(tables["POS_CASH_balance"]),
        fe.aggregate_credit_card(tables["credit_card_balance"]),
        fe.aggregate_installments(tables["installments_payments"]),
    ]
    return fe.add_no_record_flags(fe.join_features(app, aggregates))


def build_feature_table(tables: dict[str, DataFrame], check: bool = False) -> DataFrame:
    """One row per applicant, encoded. ``check`` adds a job that enforces the key.

    Categories are collected from the applicants alone: the aggregates add no
    text column, so the fit does not run the joins.
    """
    app = fe.load_application(tables["application_train"], tables["application_test"])
    categories = fit_categories(app)
    features = joined_features(tables)
    if check:
        enforce_unique(features, fe.KEY, app)
    return encode_categoricals(features, categories)
