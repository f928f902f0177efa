import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.operators import fairness as fa, scoring as sc, splits as sp


def brute_metrics(y, p):
    y, p = np.asarray(y, float), np.asarray(p, float)
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap = ks = last = 0.0
    for t in sorted(set(p), reverse=True):
        chosen = p >= t
        recall, precision = y[chosen].sum() / y.sum(), y[chosen].mean()
        ap += (recall - last) * precision
        last = recall
        ks = max(ks, recall - (1 - y[chosen]).sum() / (1 - y).sum())
    return auc, ap, ks, np.mean((y - p) ** 2)


@pytest.mark.parametrize("levels", [3, 40, 100_000])
def test_metrics_match_brute_force(spark, width, levels):
    rng = np.random.default_rng(levels)
    p = rng.integers(0, levels, 400) / levels
    y = (rng.random(400) < 0.2 + 0.5 * p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    row = sc.ranking_metrics(df).first()
    assert (row.roc_auc, row.pr_auc, row.ks, row.brier) == pytest.approx(brute_metrics(y, p), abs=1e-12)


def test_metrics_by_key_with_a_hot_key(spark, width):
    rng = np.random.default_rng(9)
    rows = [("hot" if i % 3 else f"k{i % 4}", int(rng.random() < 0.3), float(rng.integers(0, 50) / 50)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, y int, p double")
    for r in sc.ranking_metrics(df, keys=("k",)).collect():
        mine = [(y, p) for k, y, p in rows if k == r.k]
        assert (r.roc_auc, r.pr_auc, r.ks, r.brier) == pytest.approx(brute_metrics(*zip(*mine)), abs=1e-12)


def test_one_class_has_no_ranking_metric(spark):
    row = sc.ranking_metrics(spark.createDataFrame([(0, 0.1), (0, 0.3)], "y int, p double")).first()
    assert (row.roc_auc, row.pr_auc, row.ks) == (None, None, None) and row.brier == pytest.approx(0.05)


def test_threshold_is_the_rate_matched_quantile(spark):
    rng = np.random.default_rng(4)
    p, y = rng.random(777), (rng.random(777) < 0.08).astype(int)
    df = spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "id long, y int, p double")
    cut = sc.rate_matched_threshold(df)
    assert cut == pytest.approx(np.quantile(p, 1 - y.mean()))
    records = sc.score_records(df, cut)
    assert {r.decision: r.n for r in records.groupBy("decision").agg(F.count("*").alias("n")).collect()}["alto_riesgo"] == (p >= cut).sum()
    asked = spark.createDataFrame([(0,), (0,), (10_000,)], "sk_id_curr long")
    found = {r.sk_id_curr: r.found for r in sc.lookup_scores(asked, records).collect()}
    assert found == {0: True, 10_000: False}


def test_examples_and_order(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.9), (3, 0.9), (4, 0.45), (5, 0.55)], "id long, p double")
    got = {r.example: r.id for r in sc.example_cases(df).collect()}
    assert got == {"highest": 2, "lowest": 1, "nearest": 4}
    assert [r.id for r in sc.riskiest_first(df).collect()] == [2, 3, 5, 4, 1]


def test_stratified_splits_keep_class_shares(spark, width):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    rows = sp.stratified_holdout(df, "id", "y").collect()
    held = [r for r in rows if r.is_holdout]
    assert (len(rows), len(held), sum(r.y for r in held)) == (1000, 200, 20)
    folds = sp.stratified_folds(df, "id", "y").groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect()
    assert sorted((r.fold, r.n, r.p) for r in folds) == [(i, 200, 20) for i in range(5)]
    again = {r.id for r in sp.stratified_holdout(df.repartition(5), "id", "y").collect() if r.is_holdout}
    assert again == {r.id for r in held}


def test_fairness_against_numpy(spark):
    rng = np.random.default_rng(11)
    group, y = rng.integers(0, 2, 500), (rng.random(500) < 0.3).astype(int)
    pred = (rng.random(500) < 0.2 + 0.2 * group).astype(int)
    df = spark.createDataFrame([(int(g), int(a), int(b)) for g, a, b in zip(group, y, pred)], "g int, y int, pred int")
    rates = fa.group_rates(df, {"g": F.col("g"), "none": F.when(F.col("g") == 0, F.lit("only"))})
    rows = {(r.attribute, r.group): r for r in rates.collect()}
    assert ("none", None) not in rows
    sel = [pred[group == g].mean() for g in (0, 1)]
    rec = [pred[(group == g) & (y == 1)].mean() for g in (0, 1)]
    for g in (0, 1):
        assert rows[("g", str(g))].selection_rate == pytest.approx(sel[g]) and rows[("g", str(g))].recall == pytest.approx(rec[g])
    m = fa.fairness_metrics(rates).where("attribute = 'g'").first()
    assert m.statistical_parity_difference == pytest.approx(max(sel) - min(sel))
    assert m.disparate_impact == pytest.approx(min(sel) / max(sel))
    assert m.equal_opportunity_difference == pytest.approx(max(rec) - min(rec))
    assert m.impact_ok == (min(sel) / max(sel) >= 0.8)
    real = [y[group == g].mean() for g in (0, 1)]
    a = fa.amplification(rates).where("attribute = 'g'").first()
    assert a.gap_amplification == pytest.approx((max(sel) - min(sel)) / (max(real) - min(real)))


def test_recall_without_positives_is_zero(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 0, 0)], "g int, y int, pred int")
    assert fa.group_rates(df, {"g": F.col("g")}).first().recall == 0.0


def test_age_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (30.1,), (45.0,), (60.0,), (100.0,), (100.1,)], "a double")
    assert [r.b for r in df.select(fa.age_band(F.col("a")).alias("b")).collect()] == [
        None, "<30", "30-45", "30-45", "45-60", "60+", None]
