"""Stored sums of the histories against the aggregates over all rows."""

import pytest
from pyspark.sql import functions as F

from lendgrid.operators import features as fe
from lendgrid.plans.feature_build import joined_features
from lendgrid.plans.history_store import HISTORIES, HistoryStore
from lendgrid.sources import proxy
from lendgrid.sources.schemas import SCHEMAS

FOLDER = "/root/testdata/sf0.001"


def small_tables(spark):
    """A hot applicant, missing keys and values, repeated bureau ids, credits without balances."""
    rows = {
        "application_train": [(1, 1, 10.0, 5.0, 1.0, 9.0, -5, -9000, "A"), (2, 0, 10.0, 5.0, 1.0, 9.0, -5, -9000, None)],
        "application_test": [(3, 10.0, 5.0, 1.0, 9.0, -5, -9000, "A"), (4, None, None, None, None, None, None, None)],
        "bureau": [(1, 10, "Active", 5.0, None, 1.0, None), (1, 10, "Closed", 7.0, 2.0, None, 3.0), (1, None, None, None, None, None, None),
                   (2, 12, "Active", None, None, None, None), (None, 13, "Active", 1.0, 1.0, 1.0, 1.0)],
        "bureau_balance": [(10, -1, "2"), (10, -2, "0"), (10, None, "X"), (12, -1, None), (99, -1, "5"), (None, -1, "5")],
        "previous_application": [(1, 1, "Approved", 4.0, None, -3), (1, 2, "Refused", None, None, -5), (2, None, None, None, None, None)],
        "POS_CASH_balance": [(1, 1, 0), (1, 1, 4), (1, 2, None), (2, None, 3)] + [(1, i % 9, i % 2) for i in range(60)],
        "credit_card_balance": [(1, 1, 5.0, 10.0, 0), (1, 1, 5.0, 0.0, 1), (2, 3, None, 10.0, None)],
        "installments_payments": [(1, -3.0, -10.0, 5.0, 4.0), (1, None, -10.0, 5.0, None), (3, -10.0, -10.0, 1.0, 1.0)],
    }
    return {name: spark.createDataFrame(values, SCHEMAS[name]) for name, values in rows.items()}


def batches_of(tables, n):
    histories = {name: rows for name, rows in tables.items() if not name.startswith("application")}
    return [{name: rows.where(F.pmod(F.hash(*rows.columns), F.lit(n)) == i) for name, rows in histories.items()} for i in range(n)]


def values(df):
    """All rows with doubles rounded: sums of parts add up in another order."""
    plain = [{k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in df.collect()]
    return sorted(plain, key=lambda r: r["SK_ID_CURR"])


def application(tables):
    return fe.add_business_ratios(fe.clean_days_employed(fe.load_application(tables["application_train"], tables["application_test"])))


@pytest.mark.parametrize("n", [1, 4])
def test_batches_add_up_to_all_rows(spark, tmp_path, n):
    tables = small_tables(spark)
    store = HistoryStore(spark, str(tmp_path), 3)
    for i, batch in enumerate(batches_of(tables, n)):
        store.put(f"month-{i}", batch)
    expected = values(joined_features(tables))
    assert values(store.features(application(tables))) == expected
    store.put("month-0", batches_of(tables, n)[0])  # a repeated batch changes nothing
    assert values(store.features(application(tables))) == expected


def test_a_corrected_batch_replaces_what_it_held(spark, tmp_path):
    tables = small_tables(spark)
    first, second = batches_of(tables, 2)
    store = HistoryStore(spark, str(tmp_path), 2)
    store.put("a", second)
    store.put("b", second)  # wrong rows at first
    store.put("b", first)
    assert values(store.features(application(tables))) == values(joined_features(tables))
    assert store.batches("pos") == ["a", "b"]
    store.put("a", {})  # withdrawn
    assert store.batches("pos") == ["b"]


def test_another_session_reads_the_folder(spark, tmp_path):
    tables = small_tables(spark)
    store = HistoryStore(spark, str(tmp_path), 2)
    store.put("a", batches_of(tables, 1)[0])
    expected = values(store.features(application(tables)))
    store.close()
    again = HistoryStore(spark, str(tmp_path), 2)
    assert values(again.features(application(tables))) == expected
    assert again.batches("bureau") == ["a"]


def test_histories_are_not_shuffled(spark, tmp_path):
    """Sums merge in their buckets; what crosses an exchange are applicants, or sums per applicant."""
    store = HistoryStore(spark, str(tmp_path), 4)
    for i, batch in enumerate(batches_of(proxy.credit_tables(spark, FOLDER), 2)):
        store.put(f"m{i}", batch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in HISTORIES:
            assert "Exchange" not in store.sums(name)._jdf.queryExecution().executedPlan().toString(), name
        plan = store.features(application(proxy.credit_tables(spark, FOLDER)))._jdf.queryExecution().executedPlan().toString()
        # the applicants, and the sums per applicant of balances, point-of-sale credits and cards
        assert plan.count("Exchange hashpartitioning") == 4, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_names_and_missing_stores(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), 2)
    with pytest.raises(ValueError):
        store.put("a' OR '1", {})
    with pytest.raises(ValueError):
        store.sums("pos")
    assert store.batches("pos") == []
