"""What is costly to make is made once: plans of what is read again hold no scoring, no window and no join."""

from types import SimpleNamespace

import numpy as np
import pytest

from lendgrid.catalog import QUERIES, feature_queries, model_queries
from lendgrid.operators import boosting as bo, kmeans as km, vectors as ve
from lendgrid.plans import retrieval, training

FOLDER = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def stop_with(seen):
    def stop(*given, **named):
        seen.append((given, named))
        raise Seen
    return stop


def test_margins_walk_every_tree():
    tree = bo.Tree(*[np.array(v, t) for v, t in (
        ([0, 1, 0, 0, 0], np.int32), ([0] * 5, np.int32), ([0.5, np.inf, np.inf, np.inf, np.inf], float), ([True, False, False, False, False], bool),
        ([1, 3, -1, -1, -1], np.int32), ([2, 4, -1, -1, -1], np.int32), ([0.0, 0.0, 1.0, 2.0, 4.0], float), ([0.0] * 5, float), ([0.0] * 5, float))])
    leaf = bo.Tree(*[np.array([v], t) for v, t in ((0, np.int32), (0, np.int32), (np.inf, float), (False, bool), (-1, np.int32), (-1, np.int32), (8.0, float), (0.0, float), (0.0, float))])
    values = [-np.inf, 0.0, 0.5, 0.6, np.inf, np.nan]
    x = np.array([(a, b) for a in values for b in values])
    # to the left at most 0.5 or missing; then everything but a missing value
    want = [8.0 + (1.0 if a > 0.5 else 4.0 if np.isnan(b) else 2.0) for a, b in x]
    assert bo.margins_of(x, bo.Booster(("a", "b"), (tree, leaf), 0.0).stacked(), 0.0, tile=5).tolist() == want


def test_scores_are_written_before_the_threshold_reads_them(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(model_queries.sc, "rate_matched_threshold", stop_with(seen))
    with pytest.raises(Seen):
        QUERIES["x12_imputation_shift"](spark, FOLDER)
    assert "PythonUDF" not in plan(seen[0][0][0]) and "EvalPython" not in plan(seen[0][0][0])


@pytest.mark.parametrize("name, where, what", [("m4_baseline", model_queries.mo, "fit_baseline"), ("m17_train_full_model", training, "fit_trees")])
def test_a_split_is_written_before_it_is_fitted(spark, monkeypatch, name, where, what):
    seen = []
    monkeypatch.setattr(model_queries, "_trees", lambda spark, d: SimpleNamespace())
    monkeypatch.setattr(where, what, stop_with(seen))
    with pytest.raises(Seen):
        QUERIES[name](spark, FOLDER)
    assert "Window" not in plan(seen[0][0][0])


def test_distances_are_summed_once(spark, monkeypatch):
    asked, moved = [], km._moved
    monkeypatch.setattr(km, "_moved", lambda rows, centres, inertia=False: asked.append(inertia) or moved(rows, centres, inertia))
    rows = spark.createDataFrame([([float(i % 7), float(i % 3)],) for i in range(40)], "x array<double>")
    fits, scans = km.fit_many(rows, [(2, 1), (3, 1), (3, 2)])
    assert asked == [False] * scans + [True] and [len(f.points) for f in fits] == [2, 3, 3]


def test_rows_of_a_tile_go_to_the_nearest_centre_of_each_run():
    rng = np.random.default_rng(3)
    x, sizes = rng.integers(-2, 3, (50, 2)).astype(float), [2, 2, 5]
    stacked = rng.integers(-2, 3, (sum(sizes), 2)).astype(float)  # some are equal: the first one takes the row
    sums, taken = km.tile_sums(x, stacked, (stacked ** 2).sum(axis=1), [(0, 2, 2), (4, 1, 5)])
    first = 0
    for k, own in zip(sizes, [own for of in taken for own in of]):
        want = ((x[:, None] - stacked[None, first:first + k]) ** 2).sum(axis=2).argmin(axis=1)
        assert own.tolist() == want.tolist()
        assert sums[first:first + k].tolist() == [[*x[want == j].sum(axis=0), (want == j).sum()] for j in range(k)]
        first += k


def test_candidates_are_made_once_for_a_ranking_of_them(spark, monkeypatch):
    made = []
    fused = spark.range(6).selectExpr("id % 2 as query_id", "concat('d::', id) as item_id", "cast(id / 2 as int) + 1 as rank", "1.0d as score")
    monkeypatch.setattr(retrieval, "hybrid_candidates", lambda *given: made.append(1) or fused)
    chunks = spark.range(6).selectExpr("concat('d::', id) as chunk_id", "'d' as doc_id", "'t' as title", "'x' as text")
    given = lambda found: found.where("rank = 3").selectExpr("query_id", "item_id", "1 as given_rank")
    rows = retrieval.retrieve(None, None, None, SimpleNamespace(chunks=chunks), given=given, top_k=1).collect()
    assert made == [1] and {(r.query_id, r.chunk_id) for r in rows} == {(0, "d::4"), (1, "d::5")}


def test_rows_below_the_floor_are_left_out():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-2, 3, (60, 3)).astype(float), rng.integers(-2, 3, (4, 3)).astype(float)
    ids = np.array([f"i{i:02d}" for i in range(60)], object)
    whole = ve._block_top(ids, x, np.arange(4), q, 3)
    first = ve._block_top(ids[:30], x[:30], np.arange(4), q, 3)
    rest = ve._block_top(ids[30:], x[30:], np.arange(4), q, 3, ve._floor(first, np.arange(4), 3))
    assert (rest.groupby("query_id")["score"].min() >= first.groupby("query_id")["score"].min().loc[rest["query_id"].unique()]).all()
    assert ve._best(ve.pd.concat([first, rest]), 3).values.tolist() == whole.values.tolist()


def test_batches_of_histories_are_not_joined_anew(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(feature_queries.HistoryStore, "put", stop_with(seen))
    with pytest.raises(Seen):
        QUERIES["fe11_history_store"](spark, FOLDER)
    assert not any("Join" in plan(rows) for rows in seen[0][0][2].values())


def test_attributions_of_a_population_are_not_broadcast(spark):
    from lendgrid.operators.reasons import explain_records

    names = [f"f{i}" for i in range(60)]
    wide = spark.range(50).selectExpr("id", "array_repeat(0.5D, 60) AS contributions")
    records = spark.range(50).selectExpr("id AS sk_id_curr", "0.5D AS probability", "0.4D AS threshold", "'alto_riesgo' AS decision")
    explained = explain_records(wide, records, names, 0.0)
    # Spark puts an array down as one number, so its limit for broadcasts does not hold them back
    assert "BroadcastHashJoin" not in explained._jdf.queryExecution().executedPlan().toString()
    assert explained.count() == 50


def test_tree_records_broadcast_no_population(spark, monkeypatch):
    seen = []
    wide = spark.range(50).selectExpr("id", "array_repeat(0.5D, 3) AS contributions", "0.1D AS margin")
    monkeypatch.setattr(model_queries, "_tree_wide", lambda spark, d: (wide, 0.0, ["a", "b", "c"]))
    monkeypatch.setattr(model_queries, "_train", lambda spark, d: spark.range(50).selectExpr("id AS SK_ID_CURR", "CAST(id % 2 AS INT) AS TARGET"))
    monkeypatch.setattr(model_queries.sc, "rate_matched_threshold", stop_with(seen))
    with pytest.raises(Seen):
        QUERIES["x11_tree_records"](spark, FOLDER)
    assert "BroadcastHashJoin" not in seen[0][0][0]._jdf.queryExecution().executedPlan().toString()
