"""Segmentation, metrics, models, attributions, reasons and fairness."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lendgrid.catalog.feature_queries import FEATURE_INPUTS, _application, _scratch, stored_features
from lendgrid.catalog.registry import register
from lendgrid.catalog.views import LINEAR_INPUTS
from lendgrid.functions import defaults
from lendgrid.functions.defaults import SEGMENT_INPUTS
from lendgrid.operators import attributions as at, fairness as fa, models as mo, reasons as re_, scoring as sc
from lendgrid.operators import segments as sg, splits as sp, whatif as wi
from lendgrid.operators.ordered import exact_quantiles, sample_rows
from lendgrid.plans.training import train_full_model
from lendgrid.session import cut_lineage
from lendgrid.sources import proxy, tables
from lendgrid.sources.score_log import append_log, log_entries, read_log

_FITTED: dict[tuple[str, str], mo.TreeScorer] = {}


def _training_table(spark, d):
    """The feature table, written once a session: a fit scans its input many times."""
    return stored_features(spark, d)


# segmentation


def _years(spark, d):
    return sg.add_cluster_input_columns(_training_table(spark, d))


def _segment_scaling(spark, d):
    years = _years(spark, d)
    return years, sg.fit_scaling(years.where("IS_TRAIN = 1"))


def _group_centres(years, scaling) -> sg.Centres:
    """Mean standardised inputs by number of children, as centres that SQL can derive too."""
    standard = sg.standardise(years, scaling, ("IS_TRAIN", F.col("CNT_CHILDREN").alias("_g"))).where("IS_TRAIN = 1")
    rows = standard.groupBy("_g").agg(*[F.avg(c).alias(c) for c in scaling.columns]).orderBy("_g").collect()
    return sg.Centres(scaling.columns, tuple(tuple(r[c] for c in scaling.columns) for r in rows), 0.0)


def _clusters_of(features):
    years = sg.add_cluster_input_columns(features)
    scaling = sg.fit_scaling(years.where("IS_TRAIN = 1"))
    return sg.assign_clusters(years, scaling, _group_centres(years, scaling))


def _clusters(spark, d):
    return _clusters_of(_training_table(spark, d))


@register(
    "c1_cluster_inputs",
    "SELECT SK_ID_CURR, -DAYS_BIRTH / 365.0::DOUBLE AS AGE_YEARS, -DAYS_EMPLOYED / 365.0::DOUBLE AS EMPLOYED_YEARS FROM joined",
    ("joined",), ("SK_ID_CURR",), ("AGE_YEARS", "EMPLOYED_YEARS"),
)
def c1_cluster_inputs(spark, d):
    return _years(spark, d)


@register("c2_median_impute", "SELECT * FROM segment_imputed", ("segment_imputed",), ("SK_ID_CURR",), SEGMENT_INPUTS)
def c2_median_impute(spark, d):
    years, scaling = _segment_scaling(spark, d)
    return years.select("SK_ID_CURR", *[scaling.imputed(c).alias(c) for c in SEGMENT_INPUTS])


@register("c3_standardise", "SELECT * FROM segment_standard", ("segment_standard",), ("SK_ID_CURR",), SEGMENT_INPUTS)
def c3_standardise(spark, d):
    years, scaling = _segment_scaling(spark, d)
    return sg.standardise(years, scaling, ("SK_ID_CURR",))


def _vectors(spark, d):
    years, scaling = _segment_scaling(spark, d)
    return sg.standardise(years.where("IS_TRAIN = 1"), scaling, ("SK_ID_CURR",)), scaling


@register("c4_kmeans_fit")
def c4_kmeans_fit(spark, d):
    standard, scaling = _vectors(spark, d)
    vectors = sg.with_vector(standard, scaling.columns).select("vector").persist()
    centres = sg.fit_kmeans(vectors, scaling.columns)
    vectors.unpersist()
    rows = [(i, centres.inertia, list(p)) for i, p in enumerate(centres.points)]
    return spark.createDataFrame(rows, "cluster int, inertia double, centre array<double>")


@register("c5_assign_clusters", "SELECT * FROM clusters", ("clusters",), ("SK_ID_CURR", "IS_TRAIN", "cluster"))
def c5_assign_clusters(spark, d):
    return _clusters(spark, d)


@register("c6_build_segments")
def c6_build_segments(spark, d):
    return sg.build_segments(_training_table(spark, d))


@register(
    "c6_segment_keys", "SELECT SK_ID_CURR, IS_TRAIN, true AS assigned FROM application", ("application",),
    ("SK_ID_CURR", "IS_TRAIN", "assigned"),
)
def c6_segment_keys(spark, d):
    """Every applicant, labelled or not, has one of the five segments."""
    segments = sg.build_segments(_training_table(spark, d))
    return segments.withColumn("assigned", F.col("cluster").between(0, defaults.SEGMENT_COUNT - 1))


@register("c7_sweep_k")
def c7_sweep_k(spark, d):
    standard, scaling = _vectors(spark, d)
    return sg.sweep_k(standard, scaling.columns, "SK_ID_CURR")


@register(
    "c8_cluster_profile",
    f"""SELECT cluster, count(*) AS size, avg(TARGET) AS default_rate, {', '.join(f'avg({c}) AS {c}' for c in SEGMENT_INPUTS)}
        FROM clusters JOIN segment_imputed USING (SK_ID_CURR) WHERE clusters.IS_TRAIN = 1 GROUP BY cluster""",
    ("clusters", "segment_imputed"), ("cluster", "size"), ("default_rate", *SEGMENT_INPUTS),
)
def c8_cluster_profile(spark, d):
    years, scaling = _segment_scaling(spark, d)
    centres = _group_centres(years, scaling)
    train = years.where("IS_TRAIN = 1")
    # the standardised copy and the imputed inputs are two projections of one row, so no join is needed
    standard = [scaling.standard(c).alias(f"z_{c}") for c in SEGMENT_INPUTS]
    imputed = [scaling.imputed(c).alias(c) for c in SEGMENT_INPUTS]
    both = train.select("TARGET", *standard, *imputed)
    renamed = sg.Centres(tuple(f"z_{c}" for c in centres.columns), centres.points, 0.0)
    return sg.cluster_profile(both.withColumn("cluster", sg.nearest_centre(renamed)), list(SEGMENT_INPUTS))


@register(
    "c9_segment_profile",
    """SELECT cluster, count(*) AS n_clientes, avg(TARGET) AS tasa_default, avg(AMT_INCOME_TOTAL) AS ingreso_promedio,
         avg(AMT_CREDIT) AS credito_promedio, count(*) / sum(count(*)) OVER () AS pct_poblacion
       FROM clusters JOIN features USING (SK_ID_CURR) WHERE clusters.IS_TRAIN = 1 GROUP BY cluster""",
    ("clusters", "features"), ("cluster", "n_clientes"),
    ("tasa_default", "ingreso_promedio", "credito_promedio", "pct_poblacion"),
)
def c9_segment_profile(spark, d):
    features = _training_table(spark, d)
    return sg.segment_profile(sg.compute_segments(_clusters_of(features), features))


@register(
    "c10_compute_segments",
    """SELECT SK_ID_CURR, cluster, TARGET, AMT_INCOME_TOTAL, AMT_CREDIT FROM clusters
       JOIN (SELECT SK_ID_CURR, TARGET, AMT_INCOME_TOTAL, AMT_CREDIT FROM features) USING (SK_ID_CURR) WHERE IS_TRAIN = 1""",
    ("clusters", "features"), ("SK_ID_CURR", "cluster", "TARGET"), ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
)
def c10_compute_segments(spark, d):
    features = _training_table(spark, d)
    return sg.compute_segments(_clusters_of(features), features)


@register(
    "c11_cluster_shares",
    """SELECT IS_TRAIN, cluster, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY IS_TRAIN) AS share
       FROM clusters GROUP BY IS_TRAIN, cluster""",
    ("clusters",), ("IS_TRAIN", "cluster", "n"), ("share",),
)
def c11_cluster_shares(spark, d):
    return sg.cluster_shares(_clusters(spark, d))


@register("c12_projection")
def c12_projection(spark, d):
    standard, scaling = _vectors(spark, d)
    points, explained = sg.project_2d(standard, scaling.columns, "SK_ID_CURR")
    return points.withColumn("explained", F.lit(sum(explained)))


# splits, metrics, thresholds

_HASH_RANK = """SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(id || ':42'), id) AS r,
    count(*) OVER (PARTITION BY y) AS n FROM burden"""


def _burden(spark, d):
    """Labelled applicants, scored by the weight of the annuity on their income."""
    app = _application(spark, d).where("IS_TRAIN = 1")
    annuity = F.col("AMT_ANNUITY")
    return app.select(
        F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y"), (annuity / (F.col("AMT_INCOME_TOTAL") + annuity)).alias("p"),
        "CODE_GENDER_M", "DAYS_BIRTH", "AMT_ANNUITY",
    )


@register(
    "m2_stratified_holdout", f"SELECT id, y, r <= round(n * 0.2) AS is_holdout FROM ({_HASH_RANK})", ("burden",),
    ("id", "y", "is_holdout"),
)
def m2_stratified_holdout(spark, d):
    return sp.stratified_holdout(_burden(spark, d), "id", "y")


@register(
    "m3_stratified_folds", f"SELECT id, y, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ({_HASH_RANK})", ("burden",),
    ("id", "y", "fold"),
)
def m3_stratified_folds(spark, d):
    return sp.stratified_folds(_burden(spark, d), "id", "y")


def _metrics_sql(source: str, key: str = "", where: str = "true") -> str:
    part = f"PARTITION BY {key}" if key else ""
    keys = f"{key}," if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""SELECT {keys} sum(neg / an * ((cp - pos + pos / 2.0::DOUBLE) / ap)) AS roc_auc,
          sum(pos / ap * (cp / (cp + cn))) AS pr_auc, CASE WHEN max(ap) > 0 AND max(an) > 0 THEN greatest(max(cp / ap - cn / an), 0) END AS ks,
          sum(pos * (1 - p) ** 2 + neg * p ** 2) / sum(pos + neg) AS brier, CAST(sum(pos + neg) AS BIGINT) AS n
        FROM (SELECT *, sum(pos) OVER (PARTITION BY {key or '1'} ORDER BY p DESC) AS cp,
                sum(neg) OVER (PARTITION BY {key or '1'} ORDER BY p DESC) AS cn,
                nullif(sum(pos) OVER ({part}), 0) AS ap, nullif(sum(neg) OVER ({part}), 0) AS an
              FROM (SELECT {keys} p, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM {source} WHERE {where} GROUP BY {keys} p))
        {group}"""


_ALL_METRICS = ("roc_auc", "pr_auc", "ks", "brier")
for _name, _metric in (("m7_roc_auc", "roc_auc"), ("m8_average_precision", "pr_auc"), ("m9_ks", "ks"), ("m10_brier", "brier")):
    register(_name, _metrics_sql("scored_labels"), ("scored_labels",), (), (_metric,))(
        lambda spark, d: sc.ranking_metrics(proxy.scored_labels(spark, d))
    )


@register("m11_metrics_by_group", _metrics_sql("scored_labels", '"group"'), ("scored_labels",), ("group", "n"), _ALL_METRICS)
def m11_metrics_by_group(spark, d):
    return sc.ranking_metrics(proxy.scored_labels(spark, d), keys=("group",))


@register("m11_metrics_applicants", _metrics_sql("burden"), ("burden",), ("n",), _ALL_METRICS)
def m11_metrics_applicants(spark, d):
    return sc.ranking_metrics(_burden(spark, d))


@register(
    "m12_fold_metrics",
    f"""SELECT avg(roc_auc) AS cv_auc_mean, stddev_pop(roc_auc) AS cv_auc_std FROM (
        {_metrics_sql('folded', 'fold')})""".replace(
        "FROM folded", f"FROM (SELECT b.p, b.y, CAST((r - 1) % 5 AS INTEGER) AS fold FROM burden b JOIN ({_HASH_RANK}) USING (id))"
    ),
    ("burden",), (), ("cv_auc_mean", "cv_auc_std"),
)
def m12_fold_metrics(spark, d):
    folded = sp.stratified_folds(_burden(spark, d), "id", "y")
    per_fold = sc.ranking_metrics(folded, keys=("fold",))
    return mo.fold_summary(per_fold.withColumn("trees", F.lit(0)))


@register("m15_threshold", "SELECT threshold FROM scored_labels_cut", ("scored_labels_cut",), (), ("threshold",))
def m15_threshold(spark, d):
    cut = sc.rate_matched_threshold(proxy.scored_labels(spark, d))
    return spark.createDataFrame([(cut,)], "threshold double")


def _records(spark, d):
    scored = _burden(spark, d)
    return sc.score_records(scored, sc.rate_matched_threshold(scored))


RECORD_DOUBLES = ("probability", "threshold")


@register("m16_decisions", "SELECT * FROM score_records", ("score_records",), ("sk_id_curr", "decision"), RECORD_DOUBLES)
def m16_decisions(spark, d):
    return _records(spark, d)


@register(
    "m18_score_lookup",
    """SELECT a.SK_ID_CURR AS sk_id_curr, probability, threshold, decision, decision IS NOT NULL AS found
       FROM application a LEFT JOIN score_records r ON a.SK_ID_CURR = r.sk_id_curr""",
    ("application", "score_records"), ("sk_id_curr", "decision", "found"), RECORD_DOUBLES,
)
def m18_score_lookup(spark, d):
    """Every applicant is asked for; the unlabelled ones were not scored."""
    asked = _application(spark, d).select(F.col("SK_ID_CURR").alias("sk_id_curr"))
    return sc.lookup_scores(asked, _records(spark, d))


@register(
    "m20_population_summary",
    "SELECT count(y) AS n_labelled, avg(y) AS default_rate, any_value(threshold) AS threshold FROM burden, burden_cut",
    ("burden", "burden_cut"), ("n_labelled",), ("default_rate", "threshold"),
)
def m20_population_summary(spark, d):
    scored = _burden(spark, d)
    return sc.population_summary(scored, sc.rate_matched_threshold(scored))


# fitted models (checked by properties in the tests)

def _train(spark, d):
    return _training_table(spark, d).where("IS_TRAIN = 1")


def _split(spark, d):
    """The labelled rows with their holdout flag, written once: ranks shuffle whole rows, and a fit scans its input many times."""
    path = _scratch(spark, "split")
    tables.write_table(sp.stratified_holdout(_train(spark, d), "SK_ID_CURR", "TARGET"), path)
    return tables.scan_parquet(spark, path)


def _trees(spark, d):
    """Boosted trees with the full settings on all columns and labelled rows, fitted once a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        train = _train(spark, d)
        _FITTED[key] = mo.fit_trees(train, mo.feature_columns(train))
    return _FITTED[key]


def _bundle(spark, d):
    return train_full_model(_training_table(spark, d), final=lambda: _trees(spark, d))


@register("m4_baseline")
def m4_baseline(spark, d):
    split = _split(spark, d)
    scorer = mo.fit_baseline(split.where("NOT is_holdout"), mo.feature_columns(_train(spark, d)))
    return sc.ranking_metrics(scorer.score(split.where("is_holdout")), y="TARGET")


@register("m5_boosted_trees")
def m5_boosted_trees(spark, d):
    train = _train(spark, d)
    return _trees(spark, d).score(train).select("SK_ID_CURR", "TARGET", "p")


@register("m6_early_stopping")
def m6_early_stopping(spark, d):
    train = _train(spark, d)
    split = sp.stratified_holdout(train, "SK_ID_CURR", "TARGET")
    ratio = mo.negative_to_positive(split.where("NOT is_holdout"))
    rows = []
    for label, weight in (("weighted", ratio), ("plain", 1.0)):
        settings = mo.TreeSettings(positive_weight=weight)
        scorer = mo.fit_trees(split, mo.feature_columns(train), settings=settings, validation="is_holdout")
        m = sc.ranking_metrics(scorer.score(split.where("is_holdout")), y="TARGET").first()
        rows.append((label, float(weight), scorer.tree_count, m["roc_auc"], m["brier"]))
    return spark.createDataFrame(rows, "model string, positive_weight double, trees int, roc_auc double, brier double")


@register("m12_cross_validation")
def m12_cross_validation(spark, d):
    train = _train(spark, d)
    return mo.cross_validate(train, mo.feature_columns(train), folds=5)


@register("m13_tree_count",
          """SELECT CAST(round(avg(n)) AS INTEGER) AS tree_count FROM
               (SELECT count(*) AS n FROM bureau_balance GROUP BY SK_ID_BUREAU)""",
          ("bureau_balance",), ("tree_count",))
def m13_tree_count(spark, d):
    """Rounded mean of per-run counts; months per credit stand in for the rounds of a run."""
    runs = proxy.bureau_balance(spark, d).groupBy("SK_ID_BUREAU").agg(F.count(F.lit(1)).alias("trees"))
    return mo.fold_summary(runs.withColumn("roc_auc", F.lit(0.0))).select("tree_count")


@register("m14_gain_importance")
def m14_gain_importance(spark, d):
    scorer = _trees(spark, d)
    return mo.gain_importance(mo.read_nodes(mo.save_trees(scorer)), scorer.names)


@register("m17_train_full_model")
def m17_train_full_model(spark, d):
    bundle = _bundle(spark, d)
    m = bundle.holdout_metrics
    return bundle.scored.select("SK_ID_CURR", "TARGET", "p").withColumns(
        {"threshold": F.lit(bundle.threshold), "holdout_auc": F.lit(m["roc_auc"])}
    )


@register("m19_batch_scoring")
def m19_batch_scoring(spark, d):
    """Unlabelled applicants, scored as one set, appended to the log and read back."""
    features = _training_table(spark, d)
    bundle = _bundle(spark, d)
    path = _scratch(spark, "log")
    append_log(log_entries(bundle.score_unlabelled(features), "2024-01-31T00:00:00+00:00"), path)
    return read_log(spark, path)


@register(
    "m19_logged_population",
    """SELECT '2024-01-31T00:00:00+00:00' AS "timestamp", SK_ID_CURR AS sk_id_curr, true AS consistent FROM application WHERE IS_TRAIN = 0""",
    ("application",), ("timestamp", "sk_id_curr", "consistent"),
)
def m19_logged_population(spark, d):
    """Each unlabelled applicant has one log line, whose decision follows from its numbers."""
    return m19_batch_scoring(spark, d).withColumn(
        "consistent", (F.col("decision") == defaults.HIGH_RISK) == (F.col("probability") >= F.col("threshold"))
    )


_RUN_SQL = " UNION ALL ".join(
    f"""SELECT '{run}' AS run, "key", value FROM (UNPIVOT (SELECT roc_auc, pr_auc, ks, brier FROM ({_metrics_sql(view)}))
        ON roc_auc, pr_auc, ks, brier INTO NAME "key" VALUE value)"""
    for run, view in (("labels", "scored_labels"), ("burden", "burden"))
)


@register("io10_run_tracking", _RUN_SQL, ("scored_labels", "burden"), ("run", "key"), ("value",))
def io10_run_tracking(spark, d):
    """Two runs appended to the tracking table; their metric rows."""
    path = _scratch(spark, "runs")
    for run, scored in (("labels", proxy.scored_labels(spark, d)), ("burden", _burden(spark, d))):
        m = sc.ranking_metrics(scored).first().asDict()
        tables.append_run(spark, path, run, {"score": run}, {k: m[k] for k in _ALL_METRICS})
    return tables.read_runs(spark, path).where("kind = 'metric'")


# attributions and reasons

NAMES = list(LINEAR_INPUTS)


def _linear_scorer(spark, d):
    """Linear score whose weights are the correlations with the target, so SQL can derive it too."""
    train = _train(spark, d)
    scaling = sg.fit_scaling(train, LINEAR_INPUTS)
    target = F.col("TARGET").cast("double")
    row = train.agg(
        F.avg(target).alias("rate"), *[F.round(F.corr(scaling.standard(c), target), 6).alias(f"w{i}") for i, c in enumerate(NAMES)]
    ).first()
    weights = tuple(row[f"w{i}"] or 0.0 for i in range(len(NAMES)))
    return train, mo.LinearScorer(scaling, weights, math.log(row["rate"] / (1 - row["rate"])))


def _linear_wide(spark, d):
    train, scorer = _linear_scorer(spark, d)
    wide, base = at.linear_attributions(scorer, train, "SK_ID_CURR")
    return wide.withColumn("p", 1 / (1 + F.exp(-F.col("margin")))), base


@register("x2_linear_attributions", "SELECT * FROM contributions", ("contributions",), ("id", "feature"), ("contribution",))
def x2_linear_attributions(spark, d):
    return at.long_form(_linear_wide(spark, d)[0], NAMES)


@register(
    "x3_global_importance", "SELECT feature, avg(abs(contribution)) AS mean_abs_shap FROM contributions GROUP BY feature",
    ("contributions",), ("feature",), ("mean_abs_shap",),
)
def x3_global_importance(spark, d):
    return at.global_importance(_linear_wide(spark, d)[0], NAMES)


_TEXT_SQL = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in defaults.REASON_TEXT.items()) + \
    " ELSE 'Valor de ''' || feature || ''' desfavorable para el perfil.' END"
_REASONS_SQL = f"""
    SELECT s.id, s.p, coalesce(string_agg(reason, ' | ' ORDER BY r) FILTER (WHERE r <= 4), '') AS reasons
    FROM linear_scored s LEFT JOIN (
      SELECT id, {_TEXT_SQL} AS reason, row_number() OVER (PARTITION BY id ORDER BY round(contribution, 9) DESC, position) AS r
      FROM contributions WHERE contribution > 0 AND feature NOT IN ('CODE_GENDER_M', 'CODE_GENDER_F', 'DAYS_BIRTH')
    ) c ON s.id = c.id GROUP BY s.id, s.p"""


@register("x4_reason_codes", _REASONS_SQL, ("contributions", "linear_scored"), ("id", "reasons"))
def x4_reason_codes(spark, d):
    wide, _ = _linear_wide(spark, d)
    return wide.select("id", F.array_join(re_.reason_codes(NAMES, F.col("contributions")), " | ").alias("reasons"))


@register(
    "x6_sample",
    "SELECT id FROM burden ORDER BY md5(id || ':42'), id LIMIT 500", ("burden",), ("id",),
)
def x6_sample(spark, d):
    return sample_rows(_burden(spark, d), "id", 500, 42)


def _poisson_sql(u: str) -> str:
    total, term, out = 0.0, 2.718281828459045**-1, []
    for k in range(9):
        total += term
        out.append(f"WHEN {u} < {total!r}::DOUBLE THEN {k}")
        term /= k + 1
    return f"CASE {' '.join(out)} ELSE 9 END"


_BOOT_SQL = f"""
    WITH reps AS (SELECT unnest(generate_series(0, 30)) AS r),
    w AS (SELECT id, r, CASE WHEN r = 0 THEN 1 ELSE
            {_poisson_sql("(('0x' || substr(md5(id || ':' || (42000 + r - 1)), 1, 7))::BIGINT / 268435456.0::DOUBLE)")} END AS weight
          FROM linear_scored, reps),
    ranks AS (SELECT r, position, sum(abs(contribution) * weight) AS v FROM contributions JOIN w USING (id) GROUP BY r, position),
    pairs AS (SELECT b1.r, sign(a1.v - a2.v) AS da, sign(b1.v - b2.v) AS db
      FROM ranks b1 JOIN ranks b2 ON b1.r = b2.r AND b1.position < b2.position AND b1.r > 0
      JOIN ranks a1 ON a1.r = 0 AND a1.position = b1.position JOIN ranks a2 ON a2.r = 0 AND a2.position = b2.position)
    SELECT CAST(r AS INTEGER) AS replicate,
      sum(da * db) / sqrt(count(*) FILTER (WHERE da <> 0) * count(*) FILTER (WHERE db <> 0)::DOUBLE) AS tau
    FROM pairs GROUP BY r"""


@register("x7_rank_stability", _BOOT_SQL, ("contributions", "linear_scored"), ("replicate",), ("tau",))
def x7_rank_stability(spark, d):
    return at.rank_stability(_linear_wide(spark, d)[0], NAMES)


@register(
    "x8_example_cases",
    """SELECT 'highest' AS example, arg_max(id, p) AS id, max(p) AS p FROM linear_scored
       UNION ALL SELECT 'lowest', arg_min(id, p), min(p) FROM linear_scored
       UNION ALL SELECT 'nearest', arg_min(id, abs(p - 0.1)), arg_min(p, abs(p - 0.1)) FROM linear_scored""",
    ("linear_scored",), ("example", "id"), ("p",),
)
def x8_example_cases(spark, d):
    return sc.example_cases(_linear_wide(spark, d)[0], 0.1)


@register(
    "x9_waterfall",
    """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(abs(contribution), 9) DESC, feature) AS r
                       FROM contributions)
       SELECT id, CAST(r AS INTEGER) AS position, feature, contribution FROM ranked WHERE r <= 10
       UNION ALL SELECT id, 11, 'other', sum(contribution) FROM ranked WHERE r > 10 GROUP BY id
       UNION ALL SELECT id, 0, 'base', intercept FROM linear_scored""",
    ("contributions", "linear_scored"), ("id", "position", "feature"), ("contribution",),
)
def x9_waterfall(spark, d):
    wide, base = _linear_wide(spark, d)
    return at.waterfall(wide, NAMES, base)


@register("x10_riskiest_first", "SELECT id, p FROM burden", ("burden",), ("id",), ("p",))
def x10_riskiest_first(spark, d):
    return sc.riskiest_first(_burden(spark, d))


@register(
    "x11_explain_records",
    f"""SELECT id AS sk_id_curr, CASE WHEN p >= threshold THEN 'alto_riesgo' ELSE 'riesgo_aceptable' END AS decision,
          CASE WHEN p >= threshold THEN reasons ELSE '' END AS reasons, p AS probability, intercept AS base_value, total
        FROM ({_REASONS_SQL}) JOIN (SELECT id, sum(contribution) AS total FROM contributions GROUP BY id) USING (id)
        JOIN (SELECT id, intercept FROM linear_scored) USING (id), linear_scored_cut""",
    ("contributions", "linear_scored", "linear_scored_cut"), ("sk_id_curr", "decision", "reasons"),
    ("probability", "base_value", "total"),
)
def x11_explain_records(spark, d):
    train, scorer = _linear_scorer(spark, d)
    wide, base = at.linear_attributions(scorer, train, "SK_ID_CURR")
    scored = scorer.score(train).select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y"), "p")
    records = sc.score_records(scored, sc.rate_matched_threshold(scored))
    explained = re_.explain_records(wide, records, NAMES, base)
    return explained.withColumns(
        {"reasons": F.array_join("reason_codes", " | "), "total": F.aggregate("shap_values", F.lit(0.0), lambda a, v: a + v)}
    )


@register("x1_tree_attributions")
def x1_tree_attributions(spark, d):
    train = _train(spark, d)
    scorer = _trees(spark, d)
    wide, base = at.tree_attributions(scorer, train, "SK_ID_CURR")
    return at.long_form(wide, scorer.names)


@register(
    "x1_additivity", "SELECT SK_ID_CURR AS id, true AS adds_up, true AS gives_probability FROM application WHERE IS_TRAIN = 1",
    ("application",), ("id", "adds_up", "gives_probability"),
)
def x1_additivity(spark, d):
    """Every applicant's attributions add up to the margin behind the model's own probability."""
    train = _train(spark, d)
    scorer = _trees(spark, d)
    wide, base = at.tree_attributions(scorer, train, "SK_ID_CURR")
    total = F.aggregate("contributions", F.lit(base), lambda a, v: a + v)
    scored = scorer.score(train).select(F.col("SK_ID_CURR").alias("id"), "p")
    return wide.join(scored, "id").select(
        "id", (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"),
        (F.abs(1 / (1 + F.exp(-total)) - F.col("p")) < 1e-9).alias("gives_probability"),
    )


def _tree_wide(spark, d):
    """Attributions of every labelled applicant by the boosted trees, written once a query, with the base value and names."""
    scorer = _trees(spark, d)
    wide, base = at.tree_attributions(scorer, _train(spark, d), "SK_ID_CURR")
    return cut_lineage(wide), base, scorer.names


@register("x3_tree_importance")
def x3_tree_importance(spark, d):
    wide, _, names = _tree_wide(spark, d)
    return at.global_importance(wide, names)


@register("x7_tree_stability")
def x7_tree_stability(spark, d):
    wide, _, names = _tree_wide(spark, d)
    return at.rank_stability(wide, names)


@register("x9_tree_waterfall")
def x9_tree_waterfall(spark, d):
    wide, base, names = _tree_wide(spark, d)
    return at.waterfall(wide, names, base)


@register(
    "x11_tree_records",
    """SELECT SK_ID_CURR AS sk_id_curr, true AS adds_up, true AS reasons_for_high_risk_only FROM application WHERE IS_TRAIN = 1""",
    ("application",), ("sk_id_curr", "adds_up", "reasons_for_high_risk_only"),
)
def x11_tree_records(spark, d):
    """Score, decision, attributions and reasons of every labelled applicant by the boosted trees, and what must hold of them."""
    wide, base, names = _tree_wide(spark, d)
    # by their sizes in columns that compress well, labels of a whole population would be broadcast
    labels = _train(spark, d).select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y")).hint("merge")
    scored = wide.join(labels, "id").select("id", "y", (1 / (1 + F.exp(-F.col("margin")))).alias("p"))
    records = sc.score_records(scored, sc.rate_matched_threshold(scored))
    explained = re_.explain_records(wide, records, names, base)
    total = F.aggregate("shap_values", F.col("base_value"), lambda a, v: a + v)
    protected = F.exists("reason_codes", lambda r: r.contains("CODE_GENDER") | r.contains("DAYS_BIRTH"))
    return explained.withColumns({
        "adds_up": F.abs(1 / (1 + F.exp(-total)) - F.col("probability")) < 1e-9,
        "reasons_for_high_risk_only": ((F.col("decision") == defaults.HIGH_RISK) | (F.size("reason_codes") == 0)) & (F.size("reason_codes") <= 4) & ~protected,
    })


def _missing_sql(columns) -> str:
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in columns)


@register(
    "x12_imputation_shift",
    f"SELECT SK_ID_CURR AS id, n_missing, n_missing = 0 AS complete, true AS whole_cases_keep_score FROM (SELECT SK_ID_CURR, {_missing_sql(FEATURE_INPUTS)} AS n_missing FROM features WHERE IS_TRAIN = 1)",
    ("features",), ("id", "n_missing", "complete", "whole_cases_keep_score"),
)
def x12_imputation_shift(spark, d):
    """Scores with and without imputation; a case without missing values must not move."""
    return _shifts(spark, d).withColumn("whole_cases_keep_score", ~F.col("complete") | (F.col("shift") == 0))


@register("x12_shift_summary")
def x12_shift_summary(spark, d):
    return wi.shift_summary(_shifts(spark, d))


def _shifts(spark, d):
    train = _train(spark, d)
    scorer = _trees(spark, d)
    inputs, types = mo.feature_columns(train), dict(train.dtypes)
    numeric = [c for c in inputs if types[c] != "boolean"]
    medians = {c: q[0] for c, q in exact_quantiles(train, {c: [0.5] for c in numeric}).items() if q[0] is not None}
    scored = scorer.score(train.withColumn("n_missing", wi.missing_count(inputs)))
    # the threshold reads the scores several times, so they are written once
    native = cut_lineage(scored.select(F.col("SK_ID_CURR").alias("id"), "p", "n_missing", F.col("TARGET").alias("y")))
    imputed = scorer.score(wi.impute(train, medians)).select(F.col("SK_ID_CURR").alias("id"), "p")
    return wi.imputation_shift(native, imputed, sc.rate_matched_threshold(native))


WHATIF_COLUMNS = ("AMT_CREDIT", "credit_to_income", "inst_delay_max")
WHATIF_INPUTS = [c for c in LINEAR_INPUTS if c != "cc_utilization_mean"]
_FACTORS = "(0.5), (0.75), (0.9), (1.0), (1.1), (1.25), (1.5)"


def _whatif_sql() -> str:
    at_ = [NAMES.index(c) for c in WHATIF_COLUMNS]
    new = ", ".join(f"t.{c}::DOUBLE * f{i}.f::DOUBLE AS n{i}" for i, c in enumerate(WHATIF_COLUMNS))
    moved = " + ".join(f"w{k} * (n{i} - {c}) / s{k}" for i, (c, k) in enumerate(zip(WHATIF_COLUMNS, at_)))
    distance = " + ".join(f"abs(n{i} - {c}) / s{k}" for i, (c, k) in enumerate(zip(WHATIF_COLUMNS, at_)))
    return f"""SELECT SK_ID_CURR, n0 AS AMT_CREDIT, n1 AS credit_to_income, n2 AS inst_delay_max, p_original, p, distance,
          CAST(r AS INTEGER) AS "rank" FROM (
        SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY distance, n0, n1, n2) AS r FROM (
          SELECT *, round({distance}, 9) AS distance, 1 / (1 + exp(-(margin + {moved}))) AS p FROM (
            SELECT t.SK_ID_CURR, {', '.join(f't.{c}::DOUBLE AS {c}' for c in WHATIF_COLUMNS)}, {new},
              ln(s.p / (1 - s.p)) AS margin, s.p AS p_original
            FROM features t JOIN linear_scored s ON s.id = t.SK_ID_CURR,
              (VALUES {_FACTORS}) f0(f), (VALUES {_FACTORS}) f1(f), (VALUES {_FACTORS}) f2(f)
            WHERE ({_missing_sql(WHATIF_INPUTS)}) = 0 AND NOT (f0.f = 1 AND f1.f = 1 AND f2.f = 1)
          ), linear_weights, linear_moments
        ), linear_scored_cut WHERE (p >= threshold) <> (p_original >= threshold)) WHERE r <= 3"""


@register(
    "x13_counterfactuals", _whatif_sql(), ("features", "linear_scored", "linear_scored_cut", "linear_weights", "linear_moments"),
    ("SK_ID_CURR", "rank"), (*WHATIF_COLUMNS, "p_original", "p", "distance"),
)
def x13_counterfactuals(spark, d):
    """Smallest changes of three inputs that flip the linear score's decision."""
    train, scorer = _linear_scorer(spark, d)
    scored = scorer.score(train).select(F.col("TARGET").alias("y"), "p")
    return wi.counterfactuals(
        train, scorer.score, sc.rate_matched_threshold(scored), scorer.scaling.deviations, WHATIF_INPUTS, columns=WHATIF_COLUMNS
    )


# fairness


def _decided(spark, d):
    scored = _burden(spark, d)
    cut = sc.rate_matched_threshold(scored)
    return scored.withColumn("pred", (F.col("p") >= F.lit(cut)).cast("int"))


def _rates(spark, d):
    return fa.group_rates(_decided(spark, d), fa.fairness_attributes())


_METRIC_SQL = """SELECT attribute, max(selection_rate) - min(selection_rate) AS statistical_parity_difference,
    min(selection_rate) / nullif(max(selection_rate), 0) AS disparate_impact, max(recall) - min(recall) AS equal_opportunity_difference
    FROM group_rates GROUP BY attribute"""
_FAIR_DOUBLES = ("statistical_parity_difference", "disparate_impact", "equal_opportunity_difference")
_RATE_DOUBLES = ("selection_rate", "recall", "real_rate")


@register("a1_group_rates", "SELECT * FROM group_rates", ("group_rates",), ("attribute", "group", "n"), _RATE_DOUBLES)
def a1_group_rates(spark, d):
    return _rates(spark, d)


for _name, _metric in (("a2_parity_difference", 0), ("a3_disparate_impact", 1), ("a4_opportunity_difference", 2)):
    register(_name, _METRIC_SQL, ("group_rates",), ("attribute",), (_FAIR_DOUBLES[_metric],))(
        lambda spark, d: fa.fairness_metrics(_rates(spark, d))
    )


@register(
    "a5_age_bands",
    """SELECT SK_ID_CURR, CASE WHEN y > 0 AND y <= 30 THEN '<30' WHEN y > 30 AND y <= 45 THEN '30-45'
         WHEN y > 45 AND y <= 60 THEN '45-60' WHEN y > 60 AND y <= 100 THEN '60+' END AS age_group
       FROM (SELECT SK_ID_CURR, -DAYS_BIRTH / 365.25::DOUBLE AS y FROM application)""",
    ("application",), ("SK_ID_CURR", "age_group"),
)
def a5_age_bands(spark, d):
    return _application(spark, d).withColumn("age_group", fa.age_band(-F.col("DAYS_BIRTH") / F.lit(365.25)))


@register(
    "a6_real_and_predicted", "SELECT * FROM group_rates", ("group_rates",), ("attribute", "group"), ("real_rate", "selection_rate")
)
def a6_real_and_predicted(spark, d):
    return _rates(spark, d)


@register(
    "a7_amplification",
    """SELECT attribute, max(real_rate) - min(real_rate) AS real_gap, max(selection_rate) - min(selection_rate) AS predicted_gap,
         min(real_rate) / max(real_rate) AS real_ratio, min(selection_rate) / max(selection_rate) AS predicted_ratio,
         (max(selection_rate) - min(selection_rate)) / (max(real_rate) - min(real_rate)) AS gap_amplification
       FROM group_rates GROUP BY attribute""",
    ("group_rates",), ("attribute",), ("real_gap", "predicted_gap", "real_ratio", "predicted_ratio", "gap_amplification"),
)
def a7_amplification(spark, d):
    return fa.amplification(_rates(spark, d))


_VERDICT_SQL = f"""SELECT *, statistical_parity_difference BETWEEN -0.1 AND 0.1 AS parity_ok, disparate_impact >= 0.8 AS impact_ok,
    equal_opportunity_difference BETWEEN -0.1 AND 0.1 AS opportunity_ok FROM ({_METRIC_SQL})"""


@register("a8_verdicts", _VERDICT_SQL, ("group_rates",), ("attribute", "parity_ok", "impact_ok", "opportunity_ok"))
def a8_verdicts(spark, d):
    return fa.fairness_metrics(_rates(spark, d))


@register(
    "a9_fairness_report", f"SELECT * FROM group_rates JOIN ({_VERDICT_SQL}) USING (attribute)", ("group_rates",),
    ("attribute", "group", "n", "parity_ok", "impact_ok", "opportunity_ok"), (*_RATE_DOUBLES, *_FAIR_DOUBLES),
)
def a9_fairness_report(spark, d):
    return fa.fairness_report(_decided(spark, d), fa.fairness_attributes())
