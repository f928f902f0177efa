"""SQL text of the derived credit tables, for the SQL side of the checks."""

from __future__ import annotations

from lendgrid.functions.defaults import SEGMENT_INPUTS

_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_PAST_DUE = "CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS INTEGER)"
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

# name -> (views it reads, SQL)
VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": ((), """
        SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS INTEGER) AS label,
          CAST(1000 + (c_custkey * 7919) % 90000 AS DOUBLE) AS AMT_CREDIT,
          CASE WHEN c_custkey % 97 = 0 THEN 0.0::DOUBLE ELSE abs(c_acctbal) END AS AMT_INCOME_TOTAL,
          CAST(1000 + (c_custkey * 7919) % 90000 AS DOUBLE) / 20 AS AMT_ANNUITY,
          CASE WHEN c_custkey % 53 <> 0 THEN CAST(1000 + (c_custkey * 7919) % 90000 AS DOUBLE) * 0.9::DOUBLE END AS AMT_GOODS_PRICE,
          CAST(CASE WHEN c_nationkey = 0 THEN 365243 ELSE -(1 + (c_custkey * 13) % 9000) END AS BIGINT) AS DAYS_EMPLOYED,
          CAST(-(7400 + (c_custkey * 37) % 17000) AS BIGINT) AS DAYS_BIRTH,
          CASE WHEN c_custkey % 31 <> 0 THEN c_mktsegment END AS NAME_FAMILY_STATUS,
          CAST(c_custkey % 2 AS INTEGER) AS CODE_GENDER_M, CAST(c_custkey % 4 AS INTEGER) AS CNT_CHILDREN,
          CAST(2 + c_custkey % 3 AS DOUBLE) AS CNT_FAM_MEMBERS
        FROM customer"""),
    "application": (("customers",), """
        SELECT * EXCLUDE (label), CASE WHEN SK_ID_CURR % 8 <> 0 THEN label END AS TARGET,
          CAST(SK_ID_CURR % 8 <> 0 AS INTEGER) AS IS_TRAIN FROM customers"""),
    "bureau": ((), """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
          CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Sold' END AS CREDIT_ACTIVE,
          o_totalprice AS AMT_CREDIT_SUM,
          CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 0.3::DOUBLE END AS AMT_CREDIT_SUM_DEBT,
          CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.01::DOUBLE ELSE 0.0 END AS AMT_CREDIT_SUM_OVERDUE,
          CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 12 END AS AMT_ANNUITY
        FROM orders WHERE o_custkey % 7 <> 0"""),
    "bureau_balance": ((), """
        SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE,
          CASE l_returnflag WHEN 'R' THEN CAST(1 + l_linenumber % 5 AS VARCHAR) WHEN 'N' THEN '0' WHEN 'A' THEN 'C' END AS STATUS
        FROM lineitem"""),
    "previous_application": ((), """
        SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV,
          CASE WHEN o_orderkey % 41 <> 0 THEN
            CASE o_orderstatus WHEN 'P' THEN 'Approved' WHEN 'F' THEN 'Refused' WHEN 'O' THEN 'Canceled' END
          END AS NAME_CONTRACT_STATUS,
          o_totalprice AS AMT_CREDIT, o_totalprice / 24 AS AMT_ANNUITY,
          CAST(date_diff('day', DATE '2001-12-31', CAST(o_orderdate AS DATE)) AS INTEGER) AS DAYS_DECISION
        FROM orders WHERE o_custkey % 5 <> 0"""),
    "pos_cash": ((), f"""
        SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, {_PAST_DUE} AS SK_DPD
        FROM {_LINES} WHERE o_orderpriority = '3-MEDIUM'"""),
    "credit_card": ((), f"""
        SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, l_extendedprice * l_discount AS AMT_BALANCE,
          CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice * l_tax END AS AMT_CREDIT_LIMIT_ACTUAL, {_PAST_DUE} AS SK_DPD
        FROM {_LINES} WHERE o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0"""),
    "installments": ((), f"""
        SELECT o_custkey AS SK_ID_CURR,
          CASE WHEN l_linenumber <> 7 THEN CAST(-125 + l_quantity AS INTEGER) END AS DAYS_ENTRY_PAYMENT,
          -100 AS DAYS_INSTALMENT, l_extendedprice AS AMT_INSTALMENT,
          l_extendedprice * (1 - l_discount) AS AMT_PAYMENT
        FROM {_LINES} WHERE o_custkey % 11 <> 0"""),
    "bureau_agg": (("bureau",), """
        SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS bureau_count,
          count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') AS bureau_active_count,
          avg(AMT_CREDIT_SUM) AS bureau_credit_sum_mean, max(AMT_CREDIT_SUM) AS bureau_credit_sum_max,
          coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS bureau_debt_sum, avg(AMT_CREDIT_SUM_DEBT) AS bureau_debt_mean,
          coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS bureau_overdue_sum,
          max(AMT_CREDIT_SUM_OVERDUE) AS bureau_overdue_max, avg(AMT_ANNUITY) AS bureau_annuity_mean
        FROM bureau GROUP BY SK_ID_CURR"""),
    "balance_levels": (("bureau_balance",), """
        SELECT *, CASE WHEN STATUS IN ('C', 'X', '0') THEN 0 WHEN STATUS IN ('1', '2', '3', '4', '5')
          THEN CAST(STATUS AS INTEGER) END AS dpd_level FROM bureau_balance"""),
    "balance_per_credit": (("balance_levels",), """
        SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS months_count,
          count(*) FILTER (WHERE dpd_level > 0) AS months_dpd, max(dpd_level) AS worst_dpd_level
        FROM balance_levels GROUP BY SK_ID_BUREAU"""),
    "bb_agg": (("bureau", "balance_per_credit"), """
        SELECT SK_ID_CURR, count(*) AS bb_credits_with_history, CAST(sum(months_dpd) AS BIGINT) AS bb_months_dpd_sum,
          max(worst_dpd_level) AS bb_worst_dpd_level_max, avg(months_count) AS bb_months_count_mean
        FROM bureau JOIN balance_per_credit USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR"""),
    "prev_agg": (("previous_application",), """
        SELECT SK_ID_CURR, count(SK_ID_PREV) AS prev_count,
          bool_or(coalesce(NAME_CONTRACT_STATUS = 'Refused', false)) AS prev_ever_refused,
          avg(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS prev_approval_rate,
          avg(AMT_CREDIT) AS prev_credit_mean, avg(AMT_ANNUITY) AS prev_annuity_mean,
          avg(DAYS_DECISION) AS prev_days_decision_mean
        FROM previous_application GROUP BY SK_ID_CURR"""),
    "pos_agg": (("pos_cash",), """
        SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS pos_credits_count, count(SK_ID_PREV) AS pos_months_count,
          avg(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS pos_dpd_rate, max(SK_DPD) AS pos_dpd_max
        FROM pos_cash GROUP BY SK_ID_CURR"""),
    "cc_agg": (("credit_card",), """
        SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS cc_cards_count,
          avg(AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)) AS cc_utilization_mean,
          max(AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)) AS cc_utilization_max,
          avg(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS cc_dpd_rate
        FROM credit_card GROUP BY SK_ID_CURR"""),
    "inst_agg": (("installments",), """
        SELECT SK_ID_CURR, avg(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS inst_delay_mean,
          max(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT) AS inst_delay_max,
          avg(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 5 THEN 1 ELSE 0 END) AS inst_late_rate,
          avg(AMT_INSTALMENT - AMT_PAYMENT) AS inst_shortfall_mean
        FROM installments GROUP BY SK_ID_CURR"""),
    "joined": (("application", "bureau_agg", "bb_agg", "prev_agg", "pos_agg", "cc_agg", "inst_agg"), """
        SELECT * REPLACE (CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED),
          coalesce(DAYS_EMPLOYED = 365243, false) AS DAYS_EMPLOYED_ANOM,
          AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0) AS credit_to_income,
          AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0) AS annuity_to_income,
          AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0) AS credit_to_goods,
          bureau_count IS NULL AS bureau_no_record, bb_credits_with_history IS NULL AS bb_no_record,
          prev_count IS NULL AS prev_no_record, pos_credits_count IS NULL AS pos_no_record,
          cc_cards_count IS NULL AS cc_no_record, inst_delay_mean IS NULL AS inst_no_record
        FROM application LEFT JOIN bureau_agg USING (SK_ID_CURR) LEFT JOIN bb_agg USING (SK_ID_CURR)
          LEFT JOIN prev_agg USING (SK_ID_CURR) LEFT JOIN pos_agg USING (SK_ID_CURR)
          LEFT JOIN cc_agg USING (SK_ID_CURR) LEFT JOIN inst_agg USING (SK_ID_CURR)"""),
    "features": (("joined",), f"""
        SELECT * EXCLUDE (NAME_FAMILY_STATUS) REPLACE (CAST(prev_ever_refused AS INTEGER) AS prev_ever_refused),
          {', '.join(f"coalesce(NAME_FAMILY_STATUS = '{v}', false) AS NAME_FAMILY_STATUS_{v}" for v in MARKET_SEGMENTS)},
          NAME_FAMILY_STATUS IS NULL AS NAME_FAMILY_STATUS_nan
        FROM joined"""),
    "scored_labels": ((), """
        SELECT doc_id AS id, quality AS y, (n_chars % 1000) / 1000.0 AS p, lang AS "group", toxic, source
        FROM labels JOIN documents USING (doc_id)"""),
}


def _standard_views(tag: str, source: str, columns: tuple[str, ...]) -> None:
    """Views ``<tag>_imputed`` and ``<tag>_standard`` with the standardised columns of ``source``."""
    medians = ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS m{i}" for i, c in enumerate(columns))
    imputed = ", ".join(f"coalesce({c}::DOUBLE, m{i}) AS {c}" for i, c in enumerate(columns))
    moments = "count(*) * pow(2, -52) AS e, " + ", ".join(
        f"avg({c}) AS a{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(columns)
    )
    standard = ", ".join(
        f"({c} - a{i}) / CASE WHEN s{i} * s{i} <= e * s{i} * s{i} + (e * a{i}) * (e * a{i}) THEN 1 ELSE s{i} END AS {c}"
        for i, c in enumerate(columns)
    )
    VIEW_SQL[f"{tag}_medians"] = ((source,), f"SELECT {medians} FROM {source} WHERE IS_TRAIN = 1")
    VIEW_SQL[f"{tag}_imputed"] = (
        (source, f"{tag}_medians"), f"SELECT SK_ID_CURR, IS_TRAIN, TARGET, {imputed} FROM {source}, {tag}_medians"
    )
    VIEW_SQL[f"{tag}_moments"] = ((f"{tag}_imputed",), f"SELECT {moments} FROM {tag}_imputed WHERE IS_TRAIN = 1")
    VIEW_SQL[f"{tag}_standard"] = (
        (f"{tag}_imputed", f"{tag}_moments"),
        f"SELECT SK_ID_CURR, IS_TRAIN, TARGET, {standard} FROM {tag}_imputed, {tag}_moments",
    )


VIEW_SQL["years"] = (("features",), """
    SELECT *, -DAYS_BIRTH / 365.0::DOUBLE AS AGE_YEARS, -DAYS_EMPLOYED / 365.0::DOUBLE AS EMPLOYED_YEARS FROM features""")
_standard_views("segment", "years", SEGMENT_INPUTS)

# group centres (applicants by number of children) as fixed, data-derived cluster centres
VIEW_SQL["centres"] = (("segment_standard", "years"), f"""
    SELECT CAST(y.CNT_CHILDREN AS INTEGER) AS cluster, {', '.join(f'avg(s.{c}) AS {c}' for c in SEGMENT_INPUTS)}
    FROM segment_standard s JOIN years y USING (SK_ID_CURR) WHERE s.IS_TRAIN = 1 GROUP BY y.CNT_CHILDREN""")
VIEW_SQL["clusters"] = (("segment_standard", "centres"), f"""
    SELECT SK_ID_CURR, IS_TRAIN, arg_min(cluster, distance) AS cluster FROM (
      SELECT s.SK_ID_CURR, s.IS_TRAIN, c.cluster, {' + '.join(f'(s.{c} - c.{c}) * (s.{c} - c.{c})' for c in SEGMENT_INPUTS)} AS distance
      FROM segment_standard s, centres c) GROUP BY SK_ID_CURR, IS_TRAIN""")

# a linear score whose weights are the correlations with the target
LINEAR_INPUTS = (
    "AMT_CREDIT", "AMT_INCOME_TOTAL", "credit_to_income", "bureau_debt_mean", "bureau_active_count", "prev_credit_mean",
    "prev_annuity_mean", "inst_shortfall_mean", "inst_delay_max", "pos_months_count", "cc_utilization_mean",
    "DAYS_EMPLOYED", "DAYS_BIRTH", "CODE_GENDER_M",
)
_standard_views("linear", "features", LINEAR_INPUTS)
VIEW_SQL["linear_weights"] = (("linear_standard",), f"""
    SELECT ln(avg(TARGET) / (1 - avg(TARGET))) AS intercept,
      {', '.join(f'round(corr({c}, TARGET::DOUBLE), 6) AS w{i}' for i, c in enumerate(LINEAR_INPUTS))}
    FROM linear_standard WHERE IS_TRAIN = 1""")
VIEW_SQL["linear_wide"] = (("linear_standard", "linear_weights"), f"""
    SELECT SK_ID_CURR AS id, TARGET AS y, intercept, {', '.join(f'w{i} * {c} AS c{i}' for i, c in enumerate(LINEAR_INPUTS))}
    FROM linear_standard, linear_weights WHERE IS_TRAIN = 1""")
VIEW_SQL["contributions"] = (("linear_wide",), " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, {i} AS position, c{i} AS contribution FROM linear_wide" for i, c in enumerate(LINEAR_INPUTS)
))
VIEW_SQL["linear_scored"] = (("linear_wide",), f"""
    SELECT id, y, intercept, 1 / (1 + exp(-(intercept + {' + '.join(f'c{i}' for i in range(len(LINEAR_INPUTS)))}))) AS p
    FROM linear_wide""")

# applicants scored by the weight of the annuity on their income
VIEW_SQL["burden"] = (("application",), """
    SELECT SK_ID_CURR AS id, TARGET AS y, AMT_ANNUITY / (AMT_INCOME_TOTAL + AMT_ANNUITY) AS p, CODE_GENDER_M, DAYS_BIRTH,
      AMT_ANNUITY FROM application WHERE IS_TRAIN = 1""")


def _threshold(source: str) -> str:
    """Linear-interpolation quantile of p at one minus the mean label."""
    return f"""SELECT avg(p) FILTER (WHERE r = floor(h)) * (1 - (any_value(h) - floor(any_value(h))))
          + coalesce(avg(p) FILTER (WHERE r = floor(h) + 1), 0) * (any_value(h) - floor(any_value(h))) AS threshold
        FROM (SELECT p, row_number() OVER (ORDER BY p) - 1 AS r, (count(*) OVER () - 1) * (1 - avg(y) OVER ()) AS h FROM {source})"""


for _source in ("burden", "scored_labels", "linear_scored"):
    VIEW_SQL[f"{_source}_cut"] = ((_source,), _threshold(_source))
VIEW_SQL["decided"] = (("burden", "burden_cut"), """
    SELECT *, CAST(p >= threshold AS INTEGER) AS pred, -DAYS_BIRTH / 365.25::DOUBLE AS years FROM burden, burden_cut""")
_BAND = """CASE WHEN years > 0 AND years <= 30 THEN '<30' WHEN years > 30 AND years <= 45 THEN '30-45'
    WHEN years > 45 AND years <= 60 THEN '45-60' WHEN years > 60 AND years <= 100 THEN '60+' END"""
VIEW_SQL["group_rates"] = (("decided",), f"""
    SELECT attribute, "group", count(*) AS n, avg(pred) AS selection_rate,
      coalesce(sum(pred * y)::DOUBLE / nullif(sum(y), 0), 0) AS recall, avg(y) AS real_rate
    FROM (SELECT 'gender' AS attribute, CAST(CODE_GENDER_M AS VARCHAR) AS "group", y, pred FROM decided
          UNION ALL SELECT 'age', {_BAND}, y, pred FROM decided) WHERE "group" IS NOT NULL GROUP BY attribute, "group" """)
VIEW_SQL["score_records"] = (("burden", "burden_cut"), """
    SELECT id AS sk_id_curr, p AS probability, threshold,
      CASE WHEN p >= threshold THEN 'alto_riesgo' ELSE 'riesgo_aceptable' END AS decision FROM burden, burden_cut""")

# retrieval: chunks of all documents, and the whole benchmark texts as questions
VIEW_SQL["corpus_words"] = ((), r"""
    SELECT lpad(doc_id::VARCHAR, 9, '0') AS doc_id, 'Doc ' || doc_id AS title, text,
      list_filter(regexp_split_to_array(text, '[\s]+'), lambda x: x <> '') AS w FROM documents""")


def chunk_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
    SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, doc_id || '::' || i AS chunk_id, title,
      CASE WHEN len(w) <= {size} THEN text ELSE array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ') END AS text
    FROM (SELECT *, unnest(generate_series(0, CASE WHEN len(w) <= {size} THEN 0
            ELSE CAST(ceil((len(w) - {size}) / {step}.0) AS INTEGER) END)) AS i FROM corpus_words)"""


VIEW_SQL["chunks"] = (("corpus_words",), chunk_sql(180, 30))
VIEW_SQL["chunk_tokens"] = (("chunks",), r"""
    SELECT doc_id, chunk_no, chunk_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM chunks""")
VIEW_SQL["postings"] = (("chunk_tokens",), """
    SELECT doc_id, chunk_no, chunk_id, length, term, count(*) AS tf FROM (
      SELECT doc_id, chunk_no, chunk_id, len(t) AS length, unnest(t) AS term FROM chunk_tokens)
    GROUP BY doc_id, chunk_no, chunk_id, length, term""")
VIEW_SQL["raw_terms"] = (("postings", "chunks"), """
    SELECT term, count(*) AS df, ln((SELECT count(*) FROM chunks) - count(*) + 0.5::DOUBLE) - ln(count(*) + 0.5::DOUBLE) AS idf
    FROM postings GROUP BY term""")
VIEW_SQL["terms"] = (("raw_terms",), """
    SELECT term, df, CASE WHEN idf < 0 THEN 0.25::DOUBLE * (SELECT avg(idf) FROM raw_terms) ELSE idf END AS idf FROM raw_terms""")
VIEW_SQL["questions"] = ((), "SELECT item_id AS query_id, text AS query FROM benchmark")
VIEW_SQL["question_terms"] = (("questions",), r"""
    SELECT query_id, term, count(*) AS qtf FROM (
      SELECT query_id, unnest(regexp_extract_all(lower(query), '[\p{L}\p{N}_]+')) AS term FROM questions) GROUP BY query_id, term""")
VIEW_SQL["keyword_scores"] = (("question_terms", "terms", "postings", "chunk_tokens"), """
    SELECT query_id, doc_id, chunk_no, chunk_id, sum(qtf * idf * (tf * 2.5::DOUBLE)
        / (tf + 1.5::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * (length / (SELECT avg(len(t)) FROM chunk_tokens))))) AS score
    FROM question_terms JOIN terms USING (term) JOIN postings USING (term) GROUP BY query_id, doc_id, chunk_no, chunk_id""")
VIEW_SQL["keyword_ranking"] = (("questions", "chunks", "keyword_scores"), """
    SELECT * FROM (SELECT query_id, chunk_id, coalesce(score, 0) AS score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY round(coalesce(score, 0), 9) DESC, doc_id, chunk_no) AS INTEGER) AS "rank"
      FROM (SELECT query_id, doc_id, chunk_no, chunk_id FROM questions, chunks)
      LEFT JOIN keyword_scores USING (query_id, doc_id, chunk_no, chunk_id)) WHERE "rank" <= 10""")

# letter counts as a stand-in for an embedding model
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letters_sql(text: str) -> str:
    counts = ", ".join(f"(len({text}) - len(replace(lower({text}), '{c}', '')))::DOUBLE" for c in LETTERS)
    return f"[{counts}]"


VIEW_SQL["chunk_vectors"] = (("chunks",), f"SELECT chunk_id, {_letters_sql('text')} AS v FROM chunks")
VIEW_SQL["question_vectors"] = (("questions",), f"SELECT query_id, {_letters_sql('query')} AS v FROM questions")
VIEW_SQL["dense_ranking"] = (("chunk_vectors", "question_vectors"), """
    SELECT * FROM (SELECT query_id, chunk_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS "rank"
      FROM (SELECT query_id, chunk_id, round(list_dot_product(q.v, c.v)
              / (CASE WHEN list_dot_product(q.v, q.v) = 0 THEN 1 ELSE sqrt(list_dot_product(q.v, q.v)) END)
              / (CASE WHEN list_dot_product(c.v, c.v) = 0 THEN 1 ELSE sqrt(list_dot_product(c.v, c.v)) END), 9) AS score
            FROM question_vectors q, chunk_vectors c)) WHERE "rank" <= 10""")
VIEW_SQL["fused"] = (("dense_ranking", "keyword_ranking"), """
    SELECT query_id, item_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY round(score, 12) DESC, first_met) AS INTEGER) AS "rank"
    FROM (SELECT query_id, item_id, sum(1 / (60.0::DOUBLE + "rank")) AS score, min(list_no * 100 + "rank") AS first_met
          FROM (SELECT query_id, 0 AS list_no, chunk_id AS item_id, "rank" FROM dense_ranking
                UNION ALL SELECT query_id, 1, chunk_id, "rank" FROM keyword_ranking) GROUP BY query_id, item_id)""")
VIEW_SQL["retrieved"] = (("fused", "chunks"), """
    SELECT query_id, "rank", doc_id, chunk_id, title, text FROM fused JOIN chunks ON item_id = chunk_id WHERE "rank" <= 4""")
VIEW_SQL["citations"] = (("retrieved",), """
    SELECT query_id, "rank", title, chunk_id, CASE WHEN length(text) <= 200 THEN text
      ELSE rtrim(substr(text, 1, 200), chr(32) || chr(9) || chr(10) || chr(13)) || '...' END AS snippet FROM retrieved""")

# events as a prediction log and as a drifting population
VIEW_SQL["event_log"] = ((), """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp", user_id AS sk_id_curr, value / 500 AS probability,
      0.2::DOUBLE AS threshold, CASE WHEN value / 500 >= 0.2::DOUBLE THEN 'alto_riesgo' ELSE 'riesgo_aceptable' END AS decision
    FROM events""")


def _psi(long: str) -> str:
    """Shares and the index of rows ``column, bin, ref``."""
    return f"""SELECT "column", sum((r - c) * ln(r / c)) AS psi FROM (
        SELECT "column", greatest(r / sum(r) OVER w, CASE WHEN r > 0 THEN 0 ELSE 1e-4 END) AS r,
          greatest(c / sum(c) OVER w, CASE WHEN c > 0 THEN 0 ELSE 1e-4 END) AS c
        FROM (SELECT "column", bin, count(*) FILTER (WHERE ref)::DOUBLE AS r, count(*) FILTER (WHERE NOT ref)::DOUBLE AS c
              FROM ({long}) GROUP BY "column", bin) WINDOW w AS (PARTITION BY "column")) GROUP BY "column" """


def numeric_psi_sql(source: str, reference: str, columns: tuple[str, ...]) -> str:
    """The index of columns of numbers and flags; those with more than 20 values get ten bins of equal width."""
    numbers = ", ".join(f'{c}::DOUBLE AS "{c}"' for c in columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    return _psi(f"""SELECT "column", CASE WHEN n > 20 THEN least(9, greatest(0, coalesce(floor((x - lo) * 10 / nullif(hi - lo, 0)), 0))) ELSE x END AS bin, ref
        FROM (UNPIVOT (SELECT {reference} AS ref, {numbers} FROM {source}) ON {listed} INTO NAME "column" VALUE x) AS cells
        JOIN (SELECT "column", count(DISTINCT x) AS n, min(x) AS lo, max(x) AS hi
              FROM (UNPIVOT (SELECT {numbers} FROM {source}) ON {listed} INTO NAME "column" VALUE x) GROUP BY "column") AS ends USING ("column")""")


def psi_sql(source: str, reference: str, binned: tuple[str, ...], by_value: tuple[str, ...]) -> str:
    """Long form of all columns with their bins, then shares and the index."""
    parts = []
    for c in binned:
        parts.append(f"""SELECT '{c}' AS "column", CASE WHEN n > 20 THEN CAST(least(9, greatest(0, coalesce(floor(({c}::DOUBLE - lo) * 10 / nullif(hi - lo, 0)), 0)))
            AS INTEGER)::VARCHAR ELSE {c}::VARCHAR END AS bin, {reference} AS ref FROM {source},
            (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count(DISTINCT {c}) AS n FROM {source}) WHERE {c} IS NOT NULL""")
    for c in by_value:
        parts.append(f"""SELECT '{c}' AS "column", {c}::VARCHAR AS bin, {reference} AS ref FROM {source} WHERE {c} IS NOT NULL""")
    return _psi(" UNION ALL ".join(parts))


def _ordered(names, done: list[str]) -> list[str]:
    for name in names:
        if name in VIEW_SQL and name not in done:
            _ordered(VIEW_SQL[name][0], done)
            done.append(name)
    return done


def with_views(names: tuple[str, ...]) -> str:
    """WITH clause that defines the named views and whatever they read."""
    order = _ordered(names, [])
    if not order:
        return ""
    return "WITH " + ", ".join(f"{name} AS ({VIEW_SQL[name][1]})" for name in order) + " "
