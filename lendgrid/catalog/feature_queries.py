"""Scans, feature engineering and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendgrid.catalog.registry import register
from lendgrid.catalog.views import MARKET_SEGMENTS
from lendgrid.functions.defaults import NO_RECORD, NON_FEATURES
from lendgrid.operators import features as fe, profile as pr
from lendgrid.operators.dictionary import category_drift, category_numbers, extend_dictionary
from lendgrid.operators.encoding import encode_categoricals
from lendgrid.plans.feature_build import build_feature_table, joined_features
from lendgrid.plans.history_store import HistoryStore
from lendgrid.session import shared_folder
from lendgrid.sources import proxy, tables
from lendgrid.sources.checked_csv import checked_csv
from lendgrid.sources.schemas import SCHEMAS


def _scratch(spark, name: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _application(spark, d):
    return fe.load_application(proxy.application_train(spark, d), proxy.application_test(spark, d))


def _joined(spark, d):
    return joined_features(proxy.credit_tables(spark, d))


def _features(spark, d):
    return build_feature_table(proxy.credit_tables(spark, d))


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark, d, name, make):
    """A derived table, built once per session and folder and then scanned, so that queries read only their columns of it."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _STORED:
        path = _scratch(spark, name)
        tables.write_table(make(spark, d), path, ("IS_TRAIN",))
        _STORED[key] = path
    return tables.scan_parquet(spark, _STORED[key])


def stored_joined(spark, d):
    return stored(spark, d, "joined", _joined)


def stored_features(spark, d):
    return stored(spark, d, "features", _features)


BUREAU_COLUMNS = ("SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE")
BUREAU_AMOUNTS = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY")


@register("io1_csv_scan", "SELECT * FROM bureau", ("bureau",), BUREAU_COLUMNS, BUREAU_AMOUNTS)
def io1_csv_scan(spark, d):
    """A credit table written as CSV and scanned with its declared schema."""
    folder = _scratch(spark, "csv")
    proxy.bureau(spark, d).write.option("header", True).csv(f"{folder}/bureau.csv")
    return tables.scan_csv(spark, folder, "bureau", schema=SCHEMAS["bureau"])


@register(
    "io1_checked_scan",
    """SELECT SK_ID_BUREAU, AMT_CREDIT_SUM, upper(CREDIT_ACTIVE) AS note, SK_ID_BUREAU % 10 AS score,
         '' AS failed FROM bureau WHERE SK_ID_BUREAU % 17 <> 0
       UNION ALL SELECT SK_ID_BUREAU, NULL, upper(CREDIT_ACTIVE), SK_ID_BUREAU % 10, 'AMT_CREDIT_SUM' FROM bureau WHERE SK_ID_BUREAU % 17 = 0""",
    ("bureau",), ("SK_ID_BUREAU", "note", "failed"), ("AMT_CREDIT_SUM", "score"),
)
def io1_checked_scan(spark, d):
    """A CSV with an amount that is no number in some rows, and two columns without a declared type: nothing turns null unseen."""
    key, folder = F.col("SK_ID_BUREAU"), _scratch(spark, "csv")
    spoilt = F.when(key % 17 == 0, F.lit("n/a")).otherwise(F.col("AMT_CREDIT_SUM").cast("string"))
    proxy.bureau(spark, d).select(
        "SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", spoilt.alias("AMT_CREDIT_SUM"), F.upper("CREDIT_ACTIVE").alias("note"), (key % 10).alias("score"),
    ).write.option("header", True).csv(f"{folder}/bureau.csv")
    table = checked_csv(spark, f"{folder}/bureau.csv", SCHEMAS["bureau"], f"{folder}/bureau", limit=0.5)
    good = table.rows.select("SK_ID_BUREAU", "AMT_CREDIT_SUM", "note", "score", F.lit("").alias("failed"))
    bad = table.rejects.select(
        F.col("fields.SK_ID_BUREAU").cast("long").alias("SK_ID_BUREAU"), F.lit(None).cast("double").alias("AMT_CREDIT_SUM"),
        "fields.note", F.col("fields.score").cast("double").alias("score"), F.array_join("failed", ",").alias("failed"),
    )
    return good.unionByName(bad)


@register("io2_pruned_scan", "SELECT SK_ID_CURR, SK_ID_BUREAU FROM bureau", ("bureau",), ("SK_ID_CURR", "SK_ID_BUREAU"))
def io2_pruned_scan(spark, d):
    return proxy.bureau(spark, d).select("SK_ID_CURR", "SK_ID_BUREAU")


APPLICATION_EXACT = (
    "SK_ID_CURR", "TARGET", "IS_TRAIN", "DAYS_EMPLOYED", "DAYS_BIRTH", "NAME_FAMILY_STATUS", "CODE_GENDER_M",
    "CNT_CHILDREN",
)
APPLICATION_AMOUNTS = ("AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS")


@register("fe1_load_application", "SELECT * FROM application", ("application",), APPLICATION_EXACT, APPLICATION_AMOUNTS)
def fe1_load_application(spark, d):
    return _application(spark, d)


@register(
    "fe2_clean_days_employed",
    """SELECT SK_ID_CURR, coalesce(DAYS_EMPLOYED = 365243, false) AS DAYS_EMPLOYED_ANOM,
         CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED FROM application""",
    ("application",), ("SK_ID_CURR", "DAYS_EMPLOYED_ANOM", "DAYS_EMPLOYED"),
)
def fe2_clean_days_employed(spark, d):
    return fe.clean_days_employed(_application(spark, d))


@register(
    "fe3_business_ratios",
    """SELECT SK_ID_CURR, AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS credit_to_income,
         AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0) AS annuity_to_income,
         AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0) AS credit_to_goods FROM application""",
    ("application",), ("SK_ID_CURR",), ("credit_to_income", "annuity_to_income", "credit_to_goods"),
)
def fe3_business_ratios(spark, d):
    return fe.add_business_ratios(_application(spark, d))


@register(
    "fe4_bureau", "SELECT * FROM bureau_agg", ("bureau_agg",),
    ("SK_ID_CURR", "bureau_count", "bureau_active_count"),
    ("bureau_credit_sum_mean", "bureau_credit_sum_max", "bureau_debt_sum", "bureau_debt_mean", "bureau_overdue_sum",
     "bureau_overdue_max", "bureau_annuity_mean"),
)
def fe4_bureau(spark, d):
    return fe.aggregate_bureau(proxy.bureau(spark, d))


@register(
    "fe5_dpd_level",
    "SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS, dpd_level FROM balance_levels", ("balance_levels",),
    ("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS", "dpd_level"),
)
def fe5_dpd_level(spark, d):
    return proxy.bureau_balance(spark, d).withColumn("dpd_level", fe.dpd_level(F.col("STATUS")))


@register(
    "fe6_bureau_balance", "SELECT * FROM bb_agg", ("bb_agg",),
    ("SK_ID_CURR", "bb_credits_with_history", "bb_months_dpd_sum", "bb_worst_dpd_level_max"), ("bb_months_count_mean",),
)
def fe6_bureau_balance(spark, d):
    return fe.aggregate_bureau_balance(proxy.bureau_balance(spark, d), proxy.bureau(spark, d))


@register(
    "fe7_previous_application", "SELECT * FROM prev_agg", ("prev_agg",),
    ("SK_ID_CURR", "prev_count", "prev_ever_refused"),
    ("prev_approval_rate", "prev_credit_mean", "prev_annuity_mean", "prev_days_decision_mean"),
)
def fe7_previous_application(spark, d):
    return fe.aggregate_previous_application(proxy.previous_application(spark, d))


@register(
    "fe8_pos_cash", "SELECT * FROM pos_agg", ("pos_agg",),
    ("SK_ID_CURR", "pos_credits_count", "pos_months_count", "pos_dpd_max"), ("pos_dpd_rate",),
)
def fe8_pos_cash(spark, d):
    return fe.aggregate_pos_cash(proxy.pos_cash_balance(spark, d))


@register(
    "fe9_credit_card", "SELECT * FROM cc_agg", ("cc_agg",),
    ("SK_ID_CURR", "cc_cards_count"), ("cc_utilization_mean", "cc_utilization_max", "cc_dpd_rate"),
)
def fe9_credit_card(spark, d):
    return fe.aggregate_credit_card(proxy.credit_card_balance(spark, d))


@register(
    "fe10_installments", "SELECT * FROM inst_agg", ("inst_agg",),
    ("SK_ID_CURR", "inst_delay_max"), ("inst_delay_mean", "inst_late_rate", "inst_shortfall_mean"),
)
def fe10_installments(spark, d):
    return fe.aggregate_installments(proxy.installments_payments(spark, d))


JOINED_EXACT = (
    "SK_ID_CURR", "TARGET", "IS_TRAIN", "bureau_count", "bureau_active_count", "bb_credits_with_history",
    "bb_months_dpd_sum", "bb_worst_dpd_level_max", "prev_count", "prev_ever_refused", "pos_credits_count",
    "pos_months_count", "pos_dpd_max", "cc_cards_count", "inst_delay_max",
)
JOINED_DOUBLES = (
    "AMT_CREDIT", "AMT_INCOME_TOTAL", "credit_to_income", "annuity_to_income", "credit_to_goods",
    "bureau_credit_sum_mean", "bureau_credit_sum_max", "bureau_debt_sum", "bureau_debt_mean", "bureau_overdue_sum",
    "bureau_overdue_max", "bureau_annuity_mean", "bb_months_count_mean", "prev_approval_rate", "prev_credit_mean",
    "prev_annuity_mean", "prev_days_decision_mean", "pos_dpd_rate", "cc_utilization_mean", "cc_utilization_max",
    "cc_dpd_rate", "inst_delay_mean", "inst_late_rate", "inst_shortfall_mean",
)
FLAGS = tuple(NO_RECORD)


@register("fe11_feature_join", "SELECT * FROM joined", ("joined",), JOINED_EXACT, JOINED_DOUBLES)
def fe11_feature_join(spark, d):
    return _joined(spark, d)


@register(
    "fe12_key_checks",
    """SELECT count(*) AS n_rows, count(DISTINCT SK_ID_CURR) AS n_keys,
         count(*) = count(DISTINCT SK_ID_CURR) AS key_is_unique,
         (SELECT count(*) FROM application) AS n_expected,
         count(*) = (SELECT count(*) FROM application) AS rows_kept FROM joined""",
    ("joined",), ("n_rows", "n_keys", "key_is_unique", "n_expected", "rows_kept"),
)
def fe12_key_checks(spark, d):
    return tables.assert_unique(_joined(spark, d), "SK_ID_CURR", _application(spark, d))


@register("fe13_no_record_flags", "SELECT * FROM joined", ("joined",), ("SK_ID_CURR", *FLAGS))
def fe13_no_record_flags(spark, d):
    return _joined(spark, d)


ONE_HOT = tuple(f"NAME_FAMILY_STATUS_{v}" for v in (*MARKET_SEGMENTS, "nan"))


@register("fe14_one_hot", "SELECT * FROM features", ("features",), ("SK_ID_CURR", "prev_ever_refused", *ONE_HOT))
def fe14_one_hot(spark, d):
    app = _application(spark, d)
    prev = fe.aggregate_previous_application(proxy.previous_application(spark, d))
    return encode_categoricals(fe.join_features(app, [prev]))


_CATEGORIES = ("c_name", "c_mktsegment")


def _numbers_sql(column: str) -> str:
    """Numbers of one column: first those of even customers in the order of values, then the others."""
    return f"""(SELECT {column}, row_number() OVER (ORDER BY bool_or(c_custkey % 2 = 0) DESC, {column}) AS number
                FROM customer WHERE {column} IS NOT NULL GROUP BY {column})"""


@register(
    "fe14_category_dictionary",
    f"""SELECT c_custkey, coalesce(names.number, 0) AS name_number, coalesce(segments.number, 0) AS segment_number
        FROM customer LEFT JOIN {_numbers_sql('c_name')} AS names USING (c_name)
        LEFT JOIN {_numbers_sql('c_mktsegment')} AS segments USING (c_mktsegment)""",
    (), ("c_custkey", "name_number", "segment_number"),
)
def fe14_category_dictionary(spark, d):
    """Every name and segment as a number; the dictionary is made from even customers and extended by the rest."""
    customers = proxy.given(spark, d, "customer")
    known = None
    for rows in (customers.where(F.col("c_custkey") % 2 == 0), customers):
        path = _scratch(spark, "dictionary")
        tables.write_table(extend_dictionary(rows, list(_CATEGORIES), known), path)
        known = tables.scan_parquet(spark, path)
    numbers = category_numbers(customers, known, list(_CATEGORIES), "c_custkey")
    return numbers.select("c_custkey", F.col("numbers")["c_name"].alias("name_number"), F.col("numbers")["c_mktsegment"].alias("segment_number"))


def _flag_psi_sql(column: str) -> str:
    """The index of every category of a column against all others, from shares; 0.0001 stands for none."""
    return f"""SELECT '{column}' AS "column", value, (r - c) * ln(r / c) + (r1 - c1) * ln(r1 / c1) AS psi FROM (
        SELECT value, CASE WHEN r > 0 THEN r / all_r ELSE 1e-4 END AS r, CASE WHEN c > 0 THEN c / all_c ELSE 1e-4 END AS c,
          CASE WHEN r < all_r THEN 1 - r / all_r ELSE 1e-4 END AS r1, CASE WHEN c < all_c THEN 1 - c / all_c ELSE 1e-4 END AS c1
        FROM (SELECT *, sum(r) OVER () AS all_r, sum(c) OVER () AS all_c FROM (
          SELECT {column}::VARCHAR AS value, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16')::DOUBLE AS r,
            count(*) FILTER (WHERE NOT ts < TIMESTAMP '2024-01-16')::DOUBLE AS c FROM events GROUP BY 1)))"""


@register(
    "d1_category_drift", f"{_flag_psi_sql('event_type')} UNION ALL {_flag_psi_sql('user_id')}", (), ("column", "value"), ("psi",),
)
def d1_category_drift(spark, d):
    """Drift of each event type and each user, without a column for each."""
    before = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return category_drift(proxy.given(spark, d, "events"), ["event_type", "user_id"], before)


FEATURE_EXACT = (
    *JOINED_EXACT, "DAYS_EMPLOYED_ANOM", "DAYS_EMPLOYED", "DAYS_BIRTH", "CODE_GENDER_M", "CNT_CHILDREN", *FLAGS, *ONE_HOT
)
FEATURE_DOUBLES = (*JOINED_DOUBLES, "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS")
#: All model inputs, for the SQL side; the Spark side takes them from the schema.
FEATURE_INPUTS = tuple(dict.fromkeys(c for c in (*FEATURE_EXACT, *FEATURE_DOUBLES) if c not in NON_FEATURES))


@register("fe15_feature_table", "SELECT * FROM features", ("features",), FEATURE_EXACT, FEATURE_DOUBLES)
def fe15_feature_table(spark, d):
    """The flagship: eight tables to one encoded row per applicant."""
    return _features(spark, d)


@register("fe11_history_store", "SELECT * FROM joined", ("joined",), (*JOINED_EXACT, *FLAGS), JOINED_DOUBLES)
def fe11_history_store(spark, d):
    """The feature join from stored sums: the histories arrive in two batches, of which one is put twice."""
    histories = {name: rows for name, rows in proxy.credit_tables(spark, d).items() if not name.startswith("application")}
    for name in ("POS_CASH_balance", "credit_card_balance", "installments_payments"):
        # lines joined with their orders arrive as files: a batch that is put does not join them anew
        path = _scratch(spark, name)
        tables.write_table(histories[name], path)
        histories[name] = tables.scan_parquet(spark, path)
    store = HistoryStore(spark, _scratch(spark, "histories"), spark.sparkContext.defaultParallelism)
    for part in (0, 1, 0):
        store.put(f"part-{part}", {name: rows.where(F.pmod(F.hash(*rows.columns), F.lit(2)) == part) for name, rows in histories.items()})
    return store.features(fe.add_business_ratios(fe.clean_days_employed(_application(spark, d))))


@register(
    "fe16_ever_past_due",
    """SELECT SK_ID_CURR, CAST(sum(ever_dpd) AS BIGINT) AS bureau_credits_ever_dpd FROM bureau JOIN
         (SELECT SK_ID_BUREAU, max(CASE WHEN dpd_level > 0 THEN 1 ELSE 0 END) AS ever_dpd
          FROM balance_levels GROUP BY SK_ID_BUREAU) USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR""",
    ("bureau", "balance_levels"), ("SK_ID_CURR", "bureau_credits_ever_dpd"),
)
def fe16_ever_past_due(spark, d):
    return fe.bureau_credits_ever_dpd(proxy.bureau_balance(spark, d), proxy.bureau(spark, d))


@register(
    "fe16_pos_ever_past_due",
    """SELECT SK_ID_CURR, max(SK_DPD) AS pos_dpd_max, bool_or(SK_DPD > 0) AS pos_ever_dpd
       FROM pos_cash GROUP BY SK_ID_CURR""",
    ("pos_cash",), ("SK_ID_CURR", "pos_dpd_max", "pos_ever_dpd"),
)
def fe16_pos_ever_past_due(spark, d):
    return fe.pos_ever_dpd(proxy.pos_cash_balance(spark, d))


@register("io4_feature_store", "SELECT * FROM features", ("features",), FEATURE_EXACT, FEATURE_DOUBLES)
def io4_feature_store(spark, d):
    """The feature table written as parquet, by split, and read back."""
    path = _scratch(spark, "features")
    tables.write_table(_features(spark, d), path, ("IS_TRAIN",))
    return tables.scan_parquet(spark, path)


# profiling


def _null_rows(view: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS n_missing,
            100.0 * (count(*) - count("{c}")) / count(*) AS pct_missing FROM {view}"""
        for c in columns
    )


JOINED_ALL = (*APPLICATION_EXACT, *APPLICATION_AMOUNTS, *[c for c in (*JOINED_EXACT, *JOINED_DOUBLES) if c not in
              (*APPLICATION_EXACT, *APPLICATION_AMOUNTS)], "DAYS_EMPLOYED_ANOM", *FLAGS)


@register(
    "p1_null_profile", f"SELECT * FROM ({_null_rows('joined', JOINED_ALL)}) WHERE n_missing > 0", ("joined",),
    ("column", "n_missing"), ("pct_missing",), 2,
)
def p1_null_profile(spark, d):
    return pr.null_profile(_joined(spark, d))


@register(
    "p2_target_distribution",
    """SELECT TARGET, count(*) AS n, count(*) / (SELECT count(TARGET) FROM application)::DOUBLE AS share
       FROM application WHERE TARGET IS NOT NULL GROUP BY TARGET""",
    ("application",), ("TARGET", "n"), ("share",),
)
def p2_target_distribution(spark, d):
    return pr.target_distribution(_application(spark, d))


@register(
    "p3_value_counts",
    "SELECT STATUS, count(*) AS n FROM bureau_balance WHERE STATUS IS NOT NULL GROUP BY STATUS",
    ("bureau_balance",), ("STATUS", "n"),
)
def p3_value_counts(spark, d):
    return pr.value_counts(proxy.bureau_balance(spark, d), "STATUS")


@register(
    "p4_counts_at_maximum",
    """SELECT NAME_FAMILY_STATUS, count(*) AS n FROM application
       WHERE DAYS_EMPLOYED = (SELECT max(DAYS_EMPLOYED) FROM application) AND NAME_FAMILY_STATUS IS NOT NULL
       GROUP BY NAME_FAMILY_STATUS""",
    ("application",), ("NAME_FAMILY_STATUS", "n"),
)
def p4_counts_at_maximum(spark, d):
    return pr.counts_at_maximum(_application(spark, d), "DAYS_EMPLOYED", "NAME_FAMILY_STATUS")


#: Numbers and flags of the joined table, for the SQL side; the Spark side takes them from the schema.
JOINED_NUMBERS = tuple(c for c in JOINED_ALL if c not in ("SK_ID_CURR", "NAME_FAMILY_STATUS"))


def _numbers(df, *skip):
    return pr.numeric_columns(df, ("SK_ID_CURR", *skip))


@register(
    "p5_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std, min({c}::DOUBLE) AS min,
            quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50,
            quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c}::DOUBLE) AS max FROM joined"""
        for c in JOINED_NUMBERS
    ),
    ("joined",), ("column", "count"), ("mean", "std", "min", "q25", "q50", "q75", "max"), 4,
)
def p5_describe(spark, d):
    joined = stored_joined(spark, d)
    return pr.describe(joined, _numbers(joined))


_CORR_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CASE WHEN stddev_pop({c}::DOUBLE) > 1e-9::DOUBLE * abs(avg({c}::DOUBLE)) THEN corr({c}::DOUBLE, TARGET::DOUBLE) END AS corr
        FROM joined WHERE IS_TRAIN = 1 AND TARGET IS NOT NULL"""
    for c in JOINED_NUMBERS if c not in ("TARGET", "IS_TRAIN")
)


def _correlations(spark, d):
    joined = stored_joined(spark, d)
    return pr.target_correlations(joined.where("IS_TRAIN = 1"), _numbers(joined, "TARGET", "IS_TRAIN"))


@register("p6_target_correlations", _CORR_SQL, ("joined",), ("feature",), ("corr",))
def p6_target_correlations(spark, d):
    return _correlations(spark, d)


@register(
    "p7_group_default_rate",
    """SELECT NAME_FAMILY_STATUS, avg(TARGET) AS default_rate, count(TARGET) AS n FROM application
       WHERE NAME_FAMILY_STATUS IS NOT NULL GROUP BY NAME_FAMILY_STATUS""",
    ("application",), ("NAME_FAMILY_STATUS", "n"), ("default_rate",),
)
def p7_group_default_rate(spark, d):
    return pr.group_default_rate(_application(spark, d), "NAME_FAMILY_STATUS")


_INVENTORY = (
    ("application_train", "(SELECT SK_ID_CURR FROM application WHERE IS_TRAIN = 1)", "SK_ID_CURR", 12),
    ("application_test", "(SELECT SK_ID_CURR FROM application WHERE IS_TRAIN = 0)", "SK_ID_CURR", 11),
    ("bureau", "bureau", "SK_ID_CURR", 7),
    ("bureau_balance", "bureau_balance", "SK_ID_BUREAU", 3),
    ("previous_application", "previous_application", "SK_ID_CURR", 6),
    ("POS_CASH_balance", "pos_cash", "SK_ID_CURR", 3),
    ("credit_card_balance", "credit_card", "SK_ID_CURR", 5),
    ("installments_payments", "installments", "SK_ID_CURR", 5),
)


@register(
    "p8_table_inventory",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns,
            count(DISTINCT {key}) AS n_keys, '{key}' AS "key" FROM {view}"""
        for name, view, key, n in _INVENTORY
    ),
    ("application", "bureau", "bureau_balance", "previous_application", "pos_cash", "credit_card", "installments"),
    ("table", "n_rows", "n_columns", "n_keys", "key"),
)
def p8_table_inventory(spark, d):
    views = proxy.credit_tables(spark, d)
    return pr.table_inventory({name: (views[name], key) for name, _, key, _ in _INVENTORY})


@register(
    "p9_coverage",
    " UNION ALL ".join(
        f"""SELECT '{flag}' AS flag, count(*) - count({ref}) AS n_without,
            (count(*) - count({ref})) / count(*)::DOUBLE AS share_without FROM joined"""
        for flag, ref in NO_RECORD.items()
    ),
    ("joined",), ("flag", "n_without"), ("share_without",),
)
def p9_coverage(spark, d):
    return pr.missing_record_counts(stored_joined(spark, d), NO_RECORD)


@register(
    "p9_flag_shares",
    " UNION ALL ".join(f"SELECT '{c}' AS flag, avg({c}::INTEGER) AS share FROM joined" for c in FLAGS),
    ("joined",), ("flag",), ("share",),
)
def p9_flag_shares(spark, d):
    return pr.flag_shares(stored_joined(spark, d), list(FLAGS))


@register(
    "p9_null_shares",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", 1 - count("{c}") / count(*)::DOUBLE AS null_share FROM joined""" for c in JOINED_ALL
    ),
    ("joined",), ("column",), ("null_share",),
)
def p9_null_shares(spark, d):
    return pr.null_shares(_joined(spark, d))


_CATEGORICAL = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register(
    "p10_cardinality",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM customer""" for c in _CATEGORICAL),
    (), ("column", "n_distinct"),
)
def p10_cardinality(spark, d):
    """Distinct values of every column of the customers."""
    customers = proxy.given(spark, d, "customer")
    return pr.cardinality(customers, customers.columns)


_HIST = """
    SELECT {by} least(49, greatest(0, CAST(floor((x - lo) * 50 / (hi - lo)) AS INTEGER))) AS bin, count(*) AS n,
      any_value(lo) AS lo, any_value(hi) AS hi
    FROM (SELECT {by} CAST({column} AS DOUBLE) AS x FROM application WHERE {keep}),
         (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM application)
    GROUP BY {by} bin"""


@register(
    "p11_histogram",
    f"""SELECT bin, n, lo + bin * (hi - lo) / 50 AS left_edge, n / (sum(n) OVER () * (hi - lo) / 50) AS density
        FROM ({_HIST.format(by='', column='DAYS_EMPLOYED', keep='DAYS_EMPLOYED IS NOT NULL')})""",
    ("application",), ("bin", "n"), ("left_edge", "density"),
)
def p11_histogram(spark, d):
    return pr.histogram(_application(spark, d), "DAYS_EMPLOYED")


@register(
    "p11_class_density",
    f"""SELECT TARGET, bin, n, lo + bin * (hi - lo) / 50 AS left_edge,
          n / (sum(n) OVER (PARTITION BY TARGET) * (hi - lo) / 50) AS density
        FROM ({_HIST.format(by='TARGET,', column='DAYS_BIRTH', keep='TARGET IS NOT NULL')})""",
    ("application",), ("TARGET", "bin", "n"), ("left_edge", "density"),
)
def p11_class_density(spark, d):
    return pr.histogram(_application(spark, d), "DAYS_BIRTH", by="TARGET")


@register(
    "p12_split_summary",
    "SELECT IS_TRAIN, count(*) AS n, count(TARGET) AS n_labelled FROM application GROUP BY IS_TRAIN",
    ("application",), ("IS_TRAIN", "n", "n_labelled"),
)
def p12_split_summary(spark, d):
    return pr.split_summary(_application(spark, d))


@register(
    "p13_correlation_ranking",
    f"""SELECT feature, corr, row_number() OVER (ORDER BY round(abs(corr), 9) DESC NULLS LAST, feature) AS "rank"
        FROM ({_CORR_SQL})""",
    ("joined",), ("feature", "rank"), ("corr",),
)
def p13_correlation_ranking(spark, d):
    return pr.correlation_ranking(_correlations(spark, d))
