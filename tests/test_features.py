import pytest
from pyspark.sql import functions as F

from lendgrid.operators import features as fe
from lendgrid.operators.encoding import encode_categoricals, fit_categories
from lendgrid.plans.feature_build import build_feature_table, read_tables
from lendgrid.sources import tables


def one(df):
    return df.first().asDict()


def test_sentinel_becomes_null_and_flag(spark):
    app = spark.createDataFrame([(1, 365243), (2, -500), (3, 365243), (4, -100), (5, None)], "SK_ID_CURR long, DAYS_EMPLOYED long")
    rows = fe.clean_days_employed(app).orderBy("SK_ID_CURR").collect()
    assert [r.DAYS_EMPLOYED for r in rows] == [None, -500, None, -100, None]
    assert [r.DAYS_EMPLOYED_ANOM for r in rows] == [True, False, True, False, False]


def test_ratios_and_zero_denominator(spark):
    schema = "AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double, AMT_GOODS_PRICE double"
    rows = fe.add_business_ratios(spark.createDataFrame([(1e5, 5e4, 1e4, 8e4), (1e5, 0.0, 1e4, None)], schema)).collect()
    assert (rows[0].credit_to_income, rows[0].annuity_to_income, rows[0].credit_to_goods) == (2.0, 0.2, 1.25)
    assert (rows[1].credit_to_income, rows[1].annuity_to_income, rows[1].credit_to_goods) == (None, None, None)


def test_bureau(spark, width):
    schema = ("SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, "
              "AMT_CREDIT_SUM_OVERDUE double, AMT_ANNUITY double")
    rows = [(1, 10, "Active", 1000.0, None, 0.0, None), (1, 11, "Closed", 2000.0, None, 5.0, 7.0), (None, 12, "Active", 1.0, 1.0, 1.0, 1.0)]
    out = fe.aggregate_bureau(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1  # a missing key is no group
    r = out[0].asDict()
    assert (r["bureau_count"], r["bureau_active_count"], r["bureau_credit_sum_mean"]) == (2, 1, 1500.0)
    assert r["bureau_debt_sum"] == 0.0 and r["bureau_debt_mean"] is None  # sum of nothing is 0, its mean is missing
    assert r["bureau_overdue_max"] == 5.0 and r["bureau_annuity_mean"] == 7.0


def test_bureau_balance_two_hops(spark):
    ids = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "SK_ID_CURR long, SK_ID_BUREAU long")
    months = spark.createDataFrame(
        [(10, -1, "0"), (10, -2, "2"), (11, -1, "C"), (99, -1, "5")], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"
    )
    rows = fe.aggregate_bureau_balance(months, ids).collect()
    assert len(rows) == 1  # applicant 2 has no history
    r = rows[0]
    assert (r.SK_ID_CURR, r.bb_credits_with_history, r.bb_months_dpd_sum, r.bb_worst_dpd_level_max) == (1, 2, 1, 2)
    assert r.bb_months_count_mean == 1.5


def test_unknown_status_has_no_level(spark):
    df = spark.createDataFrame([("X",), ("5",), ("9",), (None,)], "s string").select(fe.dpd_level(F.col("s")).alias("l"))
    assert [r.l for r in df.collect()] == [0, 5, None, None]


def test_previous_application(spark):
    schema = "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, AMT_CREDIT double, AMT_ANNUITY double, DAYS_DECISION int"
    rows = [(1, 1, "Approved", 1e4, 1.0, -1), (1, 2, "Refused", 2e4, 2.0, -2), (1, 3, "Approved", 3e4, 3.0, -3),
            (2, 4, None, None, None, None), (2, 5, "Approved", None, None, None)]
    out = {r.SK_ID_CURR: r for r in fe.aggregate_previous_application(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1].prev_count, out[1].prev_ever_refused, out[1].prev_credit_mean) == (3, True, 2e4)
    assert out[1].prev_approval_rate == pytest.approx(2 / 3)
    # a missing status counts as not approved and not refused
    assert (out[2].prev_ever_refused, out[2].prev_approval_rate, out[2].prev_credit_mean) == (False, 0.5, None)


def test_pos_cash(spark, width):
    rows = [(1, 100, 0), (1, 100, 5), (1, 101, 0), (2, 200, None)]
    out = {r.SK_ID_CURR: r for r in fe.aggregate_pos_cash(spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_PREV long, SK_DPD int")).collect()}
    assert (out[1].pos_credits_count, out[1].pos_months_count, out[1].pos_dpd_max) == (2, 3, 5)
    assert out[1].pos_dpd_rate == pytest.approx(1 / 3)
    assert (out[2].pos_dpd_rate, out[2].pos_dpd_max) == (0.0, None)


def test_credit_card(spark):
    schema = "SK_ID_CURR long, SK_ID_PREV long, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, SK_DPD int"
    rows = [(1, 1, 500.0, 1000.0, 0), (1, 1, 1500.0, 1000.0, 3), (2, 2, 10.0, 0.0, 0)]
    out = {r.SK_ID_CURR: r for r in fe.aggregate_credit_card(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1].cc_utilization_mean, out[1].cc_utilization_max, out[1].cc_dpd_rate) == (1.0, 1.5, 0.5)
    assert (out[2].cc_utilization_mean, out[2].cc_cards_count) == (None, 1)


def test_installments(spark):
    schema = "SK_ID_CURR long, DAYS_ENTRY_PAYMENT int, DAYS_INSTALMENT int, AMT_INSTALMENT double, AMT_PAYMENT double"
    rows = [(1, -95, -100, 500.0, 500.0), (1, -115, -100, 500.0, 300.0), (2, -93, -100, 1.0, 1.0), (2, None, -100, 1.0, 1.0)]
    out = {r.SK_ID_CURR: r for r in fe.aggregate_installments(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1].inst_delay_mean, out[1].inst_delay_max, out[1].inst_late_rate, out[1].inst_shortfall_mean) == (-5.0, 5, 0.0, 100.0)
    # exactly five days is on time; a missing payment stays in the denominator
    assert (out[2].inst_delay_max, out[2].inst_late_rate) == (7, 0.5)


def test_one_hot_always_has_a_missing_column(spark):
    df = spark.createDataFrame(
        [(1, "Married", True, "x"), (2, "Single", False, "x"), (3, None, True, "x"), (4, "Single", None, "x")],
        "SK_ID_CURR long, STATUS string, prev_ever_refused boolean, K string",
    )
    out = encode_categoricals(df).orderBy("SK_ID_CURR")
    assert out.columns == ["SK_ID_CURR", "prev_ever_refused", "STATUS_Married", "STATUS_Single", "STATUS_nan", "K_x", "K_nan"]
    rows = out.collect()
    assert [r.STATUS_nan for r in rows] == [False, False, True, False]
    assert [r.prev_ever_refused for r in rows] == [1, 0, 1, None]
    assert [r.K_nan for r in rows] == [False] * 4


def test_too_many_categories_is_an_error(spark):
    with pytest.raises(ValueError):
        fit_categories(spark.range(50).selectExpr("cast(id as string) s"), limit=10)


APP = "SK_ID_CURR,TARGET,AMT_CREDIT,AMT_INCOME_TOTAL,AMT_ANNUITY,AMT_GOODS_PRICE,DAYS_EMPLOYED,DAYS_BIRTH,NAME_FAMILY_STATUS"


@pytest.fixture()
def credit_folder(tmp_path):
    files = {
        "application_train": f"{APP}\n1,0,100000,50000,10000,80000,-500,-10000,Married\n2,1,200000,0,20000,150000,365243,-12000,\n",
        "application_test": APP.replace("TARGET,", "") + "\n3,50000,30000,5000,40000,-100,-9000,Single\n",
        "bureau": "SK_ID_CURR,SK_ID_BUREAU,CREDIT_ACTIVE,AMT_CREDIT_SUM,AMT_CREDIT_SUM_DEBT,AMT_CREDIT_SUM_OVERDUE,AMT_ANNUITY\n"
                  "1,10,Active,1000,500,0,100\n3,11,Closed,2000,0,0,\n",
        "bureau_balance": "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n10,-1,0\n10,-2,1\n",
        "previous_application": "SK_ID_CURR,SK_ID_PREV,NAME_CONTRACT_STATUS,AMT_CREDIT,AMT_ANNUITY,DAYS_DECISION\n1,100,Approved,10000,500,-100\n2,101,Refused,20000,900,-50\n",
        "POS_CASH_balance": "SK_ID_CURR,SK_ID_PREV,SK_DPD\n1,100,0\n",
        "credit_card_balance": "SK_ID_CURR,SK_ID_PREV,AMT_BALANCE,AMT_CREDIT_LIMIT_ACTUAL,SK_DPD\n1,100,500,1000,0\n",
        "installments_payments": "SK_ID_CURR,DAYS_ENTRY_PAYMENT,DAYS_INSTALMENT,AMT_INSTALMENT,AMT_PAYMENT\n1,-10,-12,100,100\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_full_build_from_csv(spark, credit_folder, width):
    features = build_feature_table(read_tables(spark, credit_folder), check=True)
    rows = {r.SK_ID_CURR: r for r in features.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert [rows[i].IS_TRAIN for i in (1, 2, 3)] == [1, 1, 0]
    assert rows[2].bureau_no_record and rows[2].DAYS_EMPLOYED_ANOM and rows[2].DAYS_EMPLOYED is None
    assert rows[2].credit_to_income is None and rows[2].NAME_FAMILY_STATUS_nan
    assert not rows[3].bureau_no_record and rows[3].bb_no_record and rows[3].bureau_annuity_mean is None
    assert (rows[1].prev_ever_refused, rows[2].prev_ever_refused, rows[3].prev_ever_refused) == (0, 1, None)
    assert rows[1].bb_months_dpd_sum == 1 and rows[1].NAME_FAMILY_STATUS_Married


def test_pruned_csv_scan_reads_two_columns(spark, credit_folder):
    ids = tables.scan_csv(spark, credit_folder, "bureau", ["SK_ID_CURR", "SK_ID_BUREAU"])
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<SK_ID_CURR:bigint,SK_ID_BUREAU:bigint>" in plan
    assert sorted(tuple(r) for r in ids.collect()) == [(1, 10), (3, 11)]


def test_csv_fields(spark, tmp_path):
    (tmp_path / "installments_payments.csv").write_text(
        "SK_ID_PREV,SK_ID_CURR,DAYS_ENTRY_PAYMENT,DAYS_INSTALMENT,AMT_INSTALMENT,AMT_PAYMENT\n9,1,-1187.0,-1180.0,10.5,NaN\n9,2,,-5,1,1\n")
    rows = tables.scan_csv(spark, str(tmp_path), "installments_payments").orderBy("SK_ID_CURR").collect()
    assert (rows[0].DAYS_ENTRY_PAYMENT, rows[0].AMT_PAYMENT, rows[0].SK_ID_PREV) == (-1187.0, None, 9.0)
    assert rows[1].DAYS_ENTRY_PAYMENT is None and rows[1].DAYS_INSTALMENT == -5.0
    (tmp_path / "previous_application.csv").write_text(
        'SK_ID_CURR,SK_ID_PREV,NAME_CONTRACT_STATUS,CODE_REJECT_REASON,AMT_CREDIT,AMT_ANNUITY,DAYS_DECISION\n1,2,"","XAP",1,,-3\n')
    row = tables.scan_csv(spark, str(tmp_path), "previous_application").first()
    assert row.NAME_CONTRACT_STATUS is None and row.CODE_REJECT_REASON == "XAP" and row.DAYS_DECISION == -3


def test_categories_with_odd_names_survive_the_store(spark, tmp_path):
    df = spark.createDataFrame([(1, "Stone, brick"), (2, "Trade: type 1 (x)")], "SK_ID_CURR long, WALLS string")
    encoded = encode_categoricals(df)
    tables.write_table(encoded, str(tmp_path / "f"))
    assert tables.scan_parquet(spark, str(tmp_path / "f")).columns == ["SK_ID_CURR", "WALLS_Stone, brick", "WALLS_Trade: type 1 (x)", "WALLS_nan"]


def test_key_assertions(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert one(tables.assert_unique(df, "k")) == {"n_rows": 3, "n_keys": 2, "key_is_unique": False}
    with pytest.raises(ValueError):
        tables.enforce_unique(df, "k")
    with pytest.raises(ValueError):
        tables.enforce_unique(df.distinct(), "k", df)
    tables.enforce_unique(df.distinct(), "k", df.distinct())


def test_exploratory_variants(spark):
    ids = spark.createDataFrame([(1, 10), (1, 11)], "SK_ID_CURR long, SK_ID_BUREAU long")
    months = spark.createDataFrame([(10, -1, "1"), (10, -2, "3"), (11, -1, "0")], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    assert fe.bureau_credits_ever_dpd(months, ids).first().bureau_credits_ever_dpd == 1
    pos = spark.createDataFrame([(1, 1, 0), (1, 1, 4), (2, 2, 0)], "SK_ID_CURR long, SK_ID_PREV long, SK_DPD int")
    assert {r.SK_ID_CURR: r.pos_ever_dpd for r in fe.pos_ever_dpd(pos).collect()} == {1: True, 2: False}


def test_store_and_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 1), (2, 0)], "a int, IS_TRAIN int")
    tables.write_table(df, path, ("IS_TRAIN",))
    tables.write_table(df.where("a = 1"), path, ("IS_TRAIN",))  # overwrite
    assert [tuple(r) for r in tables.scan_parquet(spark, path, ["a", "IS_TRAIN"]).collect()] == [(1, 1)]
    runs = str(tmp_path / "runs")
    tables.append_run(spark, runs, "one", {"depth": 5}, {"roc_auc": 0.75})
    tables.append_run(spark, runs, "two", {}, {"cv_auc_mean": 0.5, "cv_auc_std": 0.1})
    rows = {(r.run, r.kind, r.key): r.value for r in tables.read_runs(spark, runs).collect()}
    assert rows[("one", "param", "depth")] == "5" and rows[("two", "metric", "cv_auc_std")] == "0.1" and len(rows) == 4


def test_parquet_scan_turns_nan_into_null(spark, tmp_path):
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id int, x double").write.parquet(f"{tmp_path}/t")
    assert {r["id"]: r["x"] for r in tables.scan_parquet(spark, f"{tmp_path}/t").collect()} == {1: None, 2: 3.0}
