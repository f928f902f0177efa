import math
import os
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.catalog import QUERIES, model_queries
from lendgrid.functions.defaults import SEGMENT_INPUTS
from lendgrid.operators import attributions as at, boosting as bo, kmeans as km, models as mo, reasons as re_, scoring as sc, segments as sg, whatif as wi
from lendgrid.plans.training import train_full_model
from lendgrid.session import shared_folder


@pytest.fixture(scope="module")
def people(spark):
    """Two income groups, 30 rows each, and an unlabelled copy of ten."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(70):
        rich = i % 2 == 1
        row = {c: float(rng.normal()) * 0.01 for c in SEGMENT_INPUTS if c not in ("AGE_YEARS", "EMPLOYED_YEARS")}
        row.update(SK_ID_CURR=i, IS_TRAIN=int(i < 60), TARGET=int(i % 3 == 0) if i < 60 else None,
                   AMT_INCOME_TOTAL=float(rng.normal(300_000 if rich else 30_000, 1000)), AMT_CREDIT=1.0 * i,
                   credit_to_income=10.0 if rich else 0.1, prev_approval_rate=None if i == 4 else (0.9 if rich else 0.1),
                   DAYS_BIRTH=-3650, DAYS_EMPLOYED=-365)
        for flag in ("bureau_no_record", "bb_no_record", "prev_no_record", "pos_no_record", "cc_no_record", "inst_no_record"):
            row[flag] = rich
        rows.append(row)
    kinds = {c: "double" for c in rows[0]}
    kinds.update(SK_ID_CURR="long", IS_TRAIN="int", TARGET="int", DAYS_BIRTH="long", DAYS_EMPLOYED="long")
    kinds.update({c: "boolean" for c in rows[0] if c.endswith("_no_record")})
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    return spark.createDataFrame([tuple(r[c] for c in kinds) for r in rows], schema).persist()


def test_years(people):
    row = sg.add_cluster_input_columns(people).first()
    assert (row.AGE_YEARS, row.EMPLOYED_YEARS) == (10.0, 1.0)


def test_income_groups_fall_apart(people):
    out = sg.build_segments(people, k=2, restarts=2)
    assert out.count() == 70
    sides = {c: {r.SK_ID_CURR % 2 for r in out.where(F.col("cluster") == c).collect()} for c in (0, 1)}
    assert sorted(map(sorted, sides.values())) == [[0], [1]]
    income = sg.segment_profile(sg.compute_segments(out, people)).collect()
    assert abs(income[0].ingreso_promedio - income[1].ingreso_promedio) > 100_000
    assert sum(r.pct_poblacion for r in income) == pytest.approx(1)


def test_scaling_is_fit_on_train_only(people):
    train = sg.add_cluster_input_columns(people.where("IS_TRAIN = 1"))
    scaling = sg.fit_scaling(train)
    shifted = people.withColumn("AMT_INCOME_TOTAL", F.when(F.col("IS_TRAIN") == 0, F.lit(1e12)).otherwise(F.col("AMT_INCOME_TOTAL")))
    again = sg.fit_scaling(sg.add_cluster_input_columns(shifted.where("IS_TRAIN = 1")))
    assert scaling == again
    incomes = np.array([r.AMT_INCOME_TOTAL for r in train.collect()])
    assert scaling.deviations["AMT_INCOME_TOTAL"] == pytest.approx(incomes.std())  # population deviation
    assert scaling.deviations["AGE_YEARS"] == 0.0  # constant column


def test_centres_are_ordered_by_size(spark):
    df = spark.createDataFrame([(float(v),) for v in [0] * 5 + [10] * 20 + [20] * 9], "x double")
    centres = sg.fit_kmeans(sg.with_vector(df, ("x",)), ("x",), k=3, restarts=3)
    assert [p[0] for p in centres.points] == [10.0, 20.0, 0.0] and centres.inertia == pytest.approx(0)
    labels = df.withColumn("c", sg.nearest_centre(centres)).groupBy("c").count().collect()
    assert {r.c: r["count"] for r in labels} == {0: 20, 1: 9, 2: 5}


def test_many_fits_share_their_scans(spark, width):
    rng = np.random.default_rng(7)
    x = np.concatenate([c + rng.normal(size=(60, 3)) for c in rng.normal(size=(4, 3)) * 9])
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(3).persist()
    runs = [(k, s) for k in (1, 2, 4, 6) for s in range(4)]
    fits, scans = km.fit_many(rows, runs)
    assert [(f.k, f.seed) for f in fits] == runs and scans == max(f.rounds for f in fits) < 100
    for f in fits:
        away = ((x[:, None] - f.points[None]) ** 2).sum(axis=2)
        own = away.argmin(axis=1)
        assert f.inertia == pytest.approx(away.min(axis=1).sum()) and (f.sizes == np.bincount(own, minlength=len(f.points))).all()
        for j in np.unique(own):
            assert f.points[j] == pytest.approx(x[own == j].mean(axis=0))
    best = [min(f.inertia for f in fits if f.k == k) for k in (1, 2, 4, 6)]
    assert best == sorted(best, reverse=True) and best[0] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum()) and best[2] < 3.6 * len(x)
    rows.unpersist()
    assert km.fit_many(rows.limit(0), [(2, 1)]) == ([], 0)
    copies = spark.createDataFrame([([1.0, 2.0],)] * 5, "x array<double>")
    fit = km.fit_many(copies, [(3, 1)])[0][0]
    assert fit.points.tolist() == [[1.0, 2.0]] and fit.inertia == 0 and fit.sizes.tolist() == [5]


def test_projection(people):
    years = sg.add_cluster_input_columns(people)
    scaling = sg.fit_scaling(years)
    standard = sg.standardise(years, scaling, ("SK_ID_CURR",))
    points, explained = sg.project_2d(standard, scaling.columns, "SK_ID_CURR", sample=20)
    x = np.array([[r[c] for c in scaling.columns] for r in standard.collect()])
    share = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert sg.project_2d(standard, scaling.columns, "SK_ID_CURR")[0].count() == len(x)
    assert points.count() == 20 and explained == pytest.approx(list(share[:2] / share.sum()), rel=1e-6)


COLUMNS = ["a", "b", "c", "flag"]


@pytest.fixture(scope="module")
def cases(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        a, b = float(rng.normal()), float(rng.normal())
        c = None if i % 7 == 0 else float(rng.normal())
        flag = bool(i % 2)
        z = 2 * a - b + (1.0 if flag else 0.0) + (0.0 if c is None else 0.5 * c) - 1.5
        rows.append((i, int(rng.random() < 1 / (1 + math.exp(-z))) if i < 500 else None, int(i < 500), a, b, c, flag))
    schema = "SK_ID_CURR long, TARGET int, IS_TRAIN int, a double, b double, c double, flag boolean"
    return spark.createDataFrame(rows, schema).persist()


SMALL = mo.TreeSettings(trees=5, depth=3, step=0.3, min_child=5)


@pytest.fixture(scope="module")
def trees(cases):
    return mo.fit_trees(cases.where("IS_TRAIN = 1"), COLUMNS, settings=SMALL)


def test_baseline_ranks_well(cases):
    train = cases.where("IS_TRAIN = 1")
    scorer = mo.fit_baseline(train, COLUMNS, iterations=50)
    assert sc.ranking_metrics(scorer.score(train), y="TARGET").first().roc_auc > 0.8
    weights = mo.balanced_weights(train)
    n1 = train.where("TARGET = 1").count()
    assert weights[1] == pytest.approx(500 / (2 * n1))
    wide, base = at.linear_attributions(scorer, train, "SK_ID_CURR")
    for r in wide.limit(20).collect():
        assert base + sum(r.contributions) == pytest.approx(r.margin)


def test_trees_take_missing_values(cases, trees):
    scored = trees.score(cases)
    assert scored.count() == 600 and scored.where("p IS NULL OR p < 0 OR p > 1").count() == 0
    assert trees.names == COLUMNS and trees.tree_count == 5
    assert sc.ranking_metrics(scored.where("IS_TRAIN = 1"), y="TARGET").first().roc_auc > 0.8


def test_tree_attributions_add_up_to_the_margin(cases, trees):
    wide, base = at.tree_attributions(trees, cases, "SK_ID_CURR")
    p = {r.SK_ID_CURR: r.p for r in trees.score(cases).collect()}
    rows = wide.collect()
    assert len(rows) == 600
    for r in rows:
        assert base + sum(r.contributions) == pytest.approx(r.margin)
        assert 1 / (1 + math.exp(-r.margin)) == pytest.approx(p[r.id], abs=1e-9)


def _shapley(forest, x):
    """Shapley values of one row by all subsets of the features."""
    def payoff(tree, node, known):
        if tree.left[node] < 0:
            return tree.value[node]
        v, children = x[tree.feature[node]], (tree.left[node], tree.right[node])
        if tree.feature[node] in known:
            return payoff(tree, children[0 if (tree.missing_left[node] if np.isnan(v) else v <= tree.threshold[node]) else 1], known)
        return sum(payoff(tree, k, known) * tree.cover[k] for k in children) / tree.cover[node]

    count = len(x)
    total = {s: sum(payoff(t, 0, s) for t in forest) for size in range(count + 1) for s in combinations(range(count), size)}
    return [sum(math.factorial(len(s)) * math.factorial(count - 1 - len(s)) / math.factorial(count) * (total[tuple(sorted({*s, j}))] - v) for s, v in total.items() if j not in s)
            for j in range(count)]


def test_tree_attributions_are_shapley_values(cases, trees):
    some = cases.orderBy("SK_ID_CURR").limit(8)
    inputs = {r.SK_ID_CURR: np.array([np.nan if v is None else float(v) for v in (r.a, r.b, r.c, r.flag)]) for r in some.collect()}
    for leaves in (1, 1 << 16):  # the model in one piece and in many
        got = {r.id: r.contributions for r in at.tree_attributions(trees, some, "SK_ID_CURR", leaves)[0].collect()}
        for i, x in inputs.items():
            assert got[i] == pytest.approx(_shapley(trees.booster.trees, x), abs=1e-9)


def test_deep_trees_by_all_subsets(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (900, 8)).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = (np.nan_to_num(x) @ rng.normal(size=8) + rng.normal(size=900) > 0).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(900)],
                               "SK_ID_CURR long, TARGET int, " + ", ".join(f"c{j} double" for j in range(8)))
    scorer = mo.fit_trees(df, [f"c{j}" for j in range(8)], settings=mo.TreeSettings(trees=3, depth=8, step=0.5, min_child=1))
    assert max(len(path) for t in scorer.booster.trees for _, path in at._leaves(t)) >= 6
    out = np.zeros((5, 8))
    for piece in at.tree_paths(scorer.booster.trees, 40):
        at.path_attributions(x[:5], piece, out)
    for i in range(5):
        assert list(out[i]) == pytest.approx(_shapley(scorer.booster.trees, x[i]), abs=1e-9)


def _naive_tree(x, g, h, bins, settings, columns):
    """One tree by trying every cut of every column with both sides for missing values; nested tuples."""
    leaf = lambda rows: -settings.step * g[rows].sum() / (h[rows].sum() + settings.ridge)

    def grow(rows, depth):
        best = (1e-6, None)
        if depth:
            part = lambda r: g[r].sum() ** 2 / (h[r].sum() + settings.ridge)
            for j in columns:
                v = x[rows, j]
                for missing_left in (False, True):
                    for k, cut in enumerate([*bins.cuts[j], np.inf][:None if not missing_left else -1]):
                        left = np.where(np.isnan(v), missing_left, v <= cut)
                        a, b = rows[left], rows[~left]
                        if min(h[a].sum(), h[b].sum()) >= settings.min_child:
                            gain = part(a) + part(b) - part(rows)
                            if gain > best[0] + 1e-9:
                                best = (gain, (j, cut, missing_left, a, b))
        if best[1] is None:
            return round(leaf(rows), 9)
        j, cut, missing_left, a, b = best[1]
        return (j, cut, missing_left, grow(a, depth - 1), grow(b, depth - 1))

    return grow(np.arange(len(x)), settings.depth)


def _nested(tree, node=0):
    if tree.left[node] < 0:
        return round(float(tree.value[node]), 9)
    return (int(tree.feature[node]), float(tree.threshold[node]), bool(tree.missing_left[node]), _nested(tree, tree.left[node]), _nested(tree, tree.right[node]))


def test_first_tree_by_brute_force(spark):
    rng = np.random.default_rng(9)
    x = np.stack([rng.normal(size=150), rng.integers(0, 3, 150), np.where(rng.random(150) < 0.3, np.nan, rng.normal(size=150))], axis=1)
    y = (x[:, 0] + np.where(np.isnan(x[:, 2]), 1.5, x[:, 2]) + 0.3 * rng.normal(size=150) > 0.2).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(150)], "id long, TARGET int, a double, b double, c double")
    settings = mo.TreeSettings(trees=1, depth=3, step=0.7, row_sample=1.0, column_sample=1.0, min_child=2)
    booster = mo.fit_trees(df, ["a", "b", "c"], settings=settings).booster
    p = 1 / (1 + np.exp(-booster.base))
    assert p == pytest.approx(y.mean())
    unit = bo.UNIT
    g, h = np.rint((p - y) * unit) / unit, np.rint(np.full(150, p * (1 - p)) * unit) / unit
    assert _nested(booster.trees[0]) == _naive_tree(x, g, h, bo.fit_bins(df, ["a", "b", "c"]), settings, [0, 1, 2])


def test_model_does_not_depend_on_blocks(cases):
    train = cases.where("IS_TRAIN = 1").withColumn("held", F.col("SK_ID_CURR") % 5 == 0)
    settings = mo.TreeSettings(trees=13, depth=3, step=0.3, min_child=3)
    one = mo.fit_trees(train, COLUMNS, settings=settings, validation="held", patience=4)
    many = mo.fit_trees(train, COLUMNS, settings=settings, validation="held", patience=4, block_bytes=500)
    assert one.tree_count == many.tree_count >= 1
    for a, b in zip(one.booster.trees, many.booster.trees):
        assert all((getattr(a, f) == getattr(b, f)).all() for f in bo.Tree.__dataclass_fields__)


def test_payoffs_are_looked_up_once_a_set(monkeypatch):
    """Many rows take the tables: the same values as row by row, and as few payoffs as there are sets, not one a row."""
    rng = np.random.default_rng(12)
    x = np.where(rng.random((700, 4)) < 0.2, np.nan, np.round(rng.normal(size=(700, 4)), 1))
    x[5], x[6], x[7, 0], x[8, 0] = np.nan, 0.0, np.inf, -np.inf
    bins = bo.Bins(tuple("abcd"), tuple(np.unique(x[np.isfinite(x[:, j]), j])[::3] for j in range(4)))
    settings = mo.TreeSettings(trees=25, depth=5, step=0.4, min_child=1, row_sample=1.0, column_sample=1.0)
    block = bo.Block(bins, bins.encode(x), (rng.random(700) < np.where(np.isnan(x[:, 3]), 0.8, 0.3)).astype(float), np.zeros(700, bool), np.arange(700).astype(np.uint64), np.zeros(700), settings)
    trees = bo._grow_in_task(block, bo.Splits(bins, settings), 50)
    assert any(np.isinf(t.threshold[t.left >= 0]).any() for t in trees) and sum((t.left < 0).sum() for t in trees) > at.TABLE_LEAVES
    pieces, worked, payoffs = at.tree_paths(trees), [], at._payoffs
    monkeypatch.setattr(at, "_payoffs", lambda known, *rest: worked.append(len(known[0])) or payoffs(known, *rest))
    looked_up, by_row = np.zeros(x.shape), np.zeros(x.shape)
    for piece in pieces:
        at.path_attributions(x, piece, looked_up)
    assert max(worked) <= 1 << 5
    monkeypatch.setattr(at, "TABLED", 0)
    for piece in pieces:
        at.path_attributions(x, piece, by_row)
    assert max(worked) > 1 << 5
    assert np.abs(looked_up - by_row).max() < 1e-9 and np.abs(by_row).max() > 0.01
    margin = bo.margins_of(x, bo.Booster(tuple("abcd"), tuple(trees), 0.0).stacked(), 0.0)  # of the infinite values too
    assert np.abs(looked_up.sum(axis=1) + sum(p.expected for p in pieces) - margin).max() < 1e-9


@pytest.mark.parametrize("held", [None, "held"])
def test_trees_grown_together_are_those_of_levels(cases, held, monkeypatch):
    train, spark = cases.where("IS_TRAIN = 1").withColumn("held", F.col("SK_ID_CURR") % 5 == 0), cases.sparkSession
    monkeypatch.setattr(bo, "ROUNDS", 5)
    monkeypatch.setattr(bo, "REFRESH", 5)
    fit = lambda: mo.fit_trees(train, COLUMNS, settings=mo.TreeSettings(trees=13, depth=3, step=0.3, min_child=3), validation=held, block_bytes=500).booster.trees
    together = fit()
    monkeypatch.setattr(bo, "grows_together", lambda *_: False)
    by_levels = fit()
    assert len(together) == len(by_levels) >= 1
    for a, b in zip(together, by_levels):
        assert all((getattr(a, f) == getattr(b, f)).all() for f in bo.Tree.__dataclass_fields__)
    assert not [f for f in os.listdir(shared_folder(spark)) if f.startswith("fit-")]  # nothing is left behind


def test_jobs_do_not_grow_with_trees(cases):
    train, context = cases.where("IS_TRAIN = 1"), cases.sparkSession.sparkContext
    jobs = []
    for trees in (1, 9):
        context.setJobGroup(f"trees-{trees}", "a fit")
        assert len(mo.fit_trees(train, COLUMNS, settings=mo.TreeSettings(trees=trees, depth=3, min_child=3), block_bytes=500).booster.trees) == trees
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"trees-{trees}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_tasks_without_a_column_agree_with_the_others(tmp_path):
    rng = np.random.default_rng(8)
    for sizes, tasks in (([3], 4), ([2, 200, 2, 2], 3), ([5, 5, 5, 5, 5], 2), ([2, 2, 90], 8), ([90, 2, 2], 8)):
        shares = bo.column_shares(np.array(sizes), tasks)
        used = sorted(set(shares))
        assert len(shares) == tasks and sorted({c for a, b in used for c in range(a, b)}) == list(range(len(sizes)))
        bins = bo.Bins(tuple(map(str, sizes)), tuple(np.arange(s - 2.0) for s in sizes))
        splits, columns = bo.Splits(bins, mo.TreeSettings(min_child=1)), np.arange(len(sizes))
        rows = [[rng.integers(0, s, 400) for s in sizes] for _ in range(2)]
        # gains that are equal in several columns: the first one is taken
        g, h = np.rint(rng.normal(size=400) * bo.UNIT), np.full(400, bo.UNIT / 4)
        sums = np.stack([np.concatenate([np.stack([np.bincount(c, w, s) for w in (g, h)], axis=1) for c, s in zip(r, sizes)]) for r in rows]).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        apart = splits.chosen([splits.candidates(sums[:, starts[a]:starts[b]], columns[a:b]) for a, b in shares])
        for one, other in zip(splits.best(sums, columns), apart):
            assert one[:4] == other[:4] and (one[4] == other[4]).all() and (one[5] == other[5]).all()


def test_where_trees_are_grown_together(spark):
    cores = spark.sparkContext.defaultParallelism
    assert bo.grows_together(spark, cores, 1000) and not bo.grows_together(spark, cores + 1, 1000)
    assert not bo.grows_together(spark, 2, 2 * bo.KEPT_BYTES + 1)
    # a parallelism that is set says nothing of the cores: a barrier stage with more tasks than these would not start
    more = {"spark.default.parallelism": "96", "spark.executor.cores": "4"}
    assert bo.task_slots({}, 12, 3) == 12 and bo.task_slots({"spark.task.cpus": "2"}, 12, 3) == 6
    assert bo.task_slots(more | {"spark.master": "spark://a:1"}, 96, 3) == 12 and bo.task_slots(more | {"spark.master": "local[8]"}, 96, 1) == 8
    assert bo._plain_folder("/a/b") == bo._plain_folder("file:/a/b") == bo._plain_folder("file:///a/b") == "/a/b" and bo._plain_folder("hdfs://x/a") is None


def test_blocks_are_taken_up_where_a_worker_left_them():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    bins = bo.Bins(("a", "b", "c"), tuple(np.quantile(x[:, j], np.arange(1, 20) / 20) for j in range(3)))
    settings = mo.TreeSettings(trees=4, depth=3, step=0.5, min_child=2)
    y, keys = (x[:, 0] + x[:, 1] > 0).astype(float), rng.integers(0, 2**62, 300).astype(np.uint64)
    fresh, made, trees = lambda: bo.Block(bins, bins.encode(x), y, np.zeros(300, bool), keys, np.zeros(300), settings), [], []

    def make():
        made.append(1)
        return fresh()

    for k in range(4):
        trees.append(bo.grow_tree(bo.Splits(bins, settings), k, lambda t, c, w: bo.kept_block("fit", 7, 0, trees, make).sums(k, t, c, w)))  # noqa: B023
        other = bo.kept_block("other", k, 0, trees, fresh)  # a worker that sees the block for the first time
        assert (other.margin == bo.kept_block("fit", 7, 0, trees).margin).all() and other.done == k + 1
    assert len(made) == 1 and bo.kept_block("unknown", 7, 0, trees) is None
    # the state of an earlier round is asked for again: the block is made anew
    assert bo.kept_block("fit", 7, 0, trees[:2], make).done == 2 and len(made) == 2


def test_sums_go_out_before_the_input_is_read():
    seen = []

    def part():
        seen.append("read")
        yield 1

    steps = bo.sums_then_input(3, part(), lambda: 5)
    assert next(steps) == (3, 5, False) and not seen
    assert not list(steps) and seen == ["read"]  # read to its end, so that the worker stays
    assert list(bo.sums_then_input(3, iter([1, 2]), lambda: None, sum)) == [(3, 3, True)]
    assert list(bo.sums_then_input(3, iter([1, 2]), lambda: None)) == [(3, None, False)]


def test_a_level_sends_rows_until_workers_have_their_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2))
    df = spark.createDataFrame([(int(a[0] > 0), float(a[0]), float(a[1])) for a in x], "y int, a double, b double")
    bins, settings = bo.fit_bins(df, ["a", "b"]), bo.TreeSettings(trees=1, depth=2, min_child=1.0, row_sample=1.0, column_sample=1.0)
    blocks, parts = bo.write_blocks(df, bins, "y", None, None, 0.0, 600, 400)
    assert parts > 1
    sent = spark.sparkContext.broadcast((bins, settings))
    levels = bo._Levels(blocks, sent, "levels", 0)
    root = bo.Tree(*[np.full(1, v, k) for v, k in ((0, np.int32), (0, np.int32), (np.inf, float), (False, bool), (-1, np.int32), (-1, np.int32), (0.0, float), (0.0, float), (0.0, float))])
    found = [levels.sums([], 0, root, np.array([0, 1]), [0])]
    assert not levels.settled  # no worker had a block
    while not levels.settled:
        found.append(levels.sums([], 0, root, np.array([0, 1]), [0]))
    found.append(levels.sums([], 0, root, np.array([0, 1]), [0]))
    assert all((f == found[0]).all() for f in found)
    assert sum(len(d) for d in levels.dealt) == blocks.count()
    levels.unpersist()


def test_more_rows_than_a_block_go_to_all_cores(cases, tmp_path):
    train = cases.where("IS_TRAIN = 1")
    bins, n = bo.fit_bins(train, COLUMNS), train.count()
    size, cores = n * len(COLUMNS), train.sparkSession.sparkContext.defaultParallelism
    for block_bytes, parts in ((size, 1), (size - 1, 2), (max(1, size // 100), cores)):
        blocks, found = bo.write_blocks(train, bins, "TARGET", None, "SK_ID_CURR", 0.0, n, block_bytes)
        assert found == parts and blocks.agg({"rows": "sum"}).first()[0] == train.where("TARGET IS NOT NULL").count()


def test_degenerate_training_tables(spark):
    schema = "SK_ID_CURR long, TARGET int, x double, gone double"
    for rows in ([], [(1, None, 1.0, None)], [(i, 1, float(i), None) for i in range(30)], [(i, i % 2, float("nan"), None) for i in range(30)]):
        scorer = mo.fit_trees(spark.createDataFrame(rows, schema), ["x", "gone"], settings=SMALL)
        scored = scorer.score(spark.createDataFrame([(7, None, 2.0, 1.0), (8, None, None, None)], schema)).collect()
        assert len({r.p for r in scored}) == 1 and 0 <= scored[0].p <= 1
    repeated = spark.createDataFrame([(1, i % 2, float(i % 2), None) for i in range(60)], schema)
    p = sorted(r.p for r in mo.fit_trees(repeated, ["x", "gone"], settings=SMALL).score(repeated).collect())
    assert p[0] < 0.5 < p[-1]


def test_bins_of_many_values(spark):
    values = [(float(i % 20_000),) for i in range(40_000)] + [(None,)] * 5
    cuts = bo.fit_bins(spark.createDataFrame(values, "v double").repartition(3), ["v"]).cuts[0]
    expected = np.arange(1, bo.MOST_BINS) * 20_000 / bo.MOST_BINS
    assert len(cuts) == bo.MOST_BINS - 1 and np.abs(cuts - expected).max() < 40
    few = spark.createDataFrame([(float(v),) for v in [0] * 5000 + [1]], "v double")
    assert bo.fit_bins(few, ["v"]).cuts[0].tolist() == [0.5]


def test_early_stopping_and_importance(cases, trees):
    train = cases.where("IS_TRAIN = 1").withColumn("held", F.col("SK_ID_CURR") % 4 == 0)
    stopped = mo.fit_trees(train, COLUMNS, settings=mo.TreeSettings(trees=12, depth=4, step=0.9, min_child=1), validation="held")
    assert 1 <= stopped.tree_count <= 12
    nodes = mo.read_nodes(mo.save_trees(trees))
    inner = nodes.where("left >= 0").toPandas()
    expected = inner.groupby("feature")["gain"].mean().sort_values(ascending=False)
    top = mo.gain_importance(nodes, trees.names).collect()
    assert [r.feature for r in top] == [trees.names[i] for i in expected.index]
    assert [r.gain for r in top] == pytest.approx(list(expected))


def test_early_stopping_keeps_the_best_prefix(cases):
    train = cases.where("IS_TRAIN = 1").withColumn("held", F.col("SK_ID_CURR") % 4 == 0)
    settings = mo.TreeSettings(trees=30, depth=3, step=0.03, min_child=1)
    whole = mo.fit_trees(train, COLUMNS, settings=settings, validation="held", patience=1000)
    longer = mo.fit_trees(train.where("NOT held"), COLUMNS, settings=settings).booster
    held = train.where("held").select("TARGET", F.array(*[F.col(c).cast("double") for c in COLUMNS]).alias("x")).collect()
    x, y = np.array([r.x for r in held], float), np.array([r.TARGET for r in held])
    aucs = []
    for k in range(1, 31):
        m = bo.margins_of(x, bo.Booster(longer.columns, longer.trees[:k], longer.base).stacked(), longer.base)
        aucs.append(np.mean([(a > b) + (a == b) / 2 for a in m[y == 1] for b in m[y == 0]]))
    assert whole.tree_count == int(np.argmax(np.round(aucs, 12))) + 1
    patient = mo.fit_trees(train, COLUMNS, settings=settings, validation="held", patience=3).tree_count
    expected, best = 0, -1.0
    for i, auc in enumerate(np.round(aucs, 12)):
        if auc > best:
            expected, best = i + 1, auc
        if i + 1 - expected >= 3:
            break
    assert patient == expected


def test_saved_trees_score_alike(cases, trees):
    loaded = mo.load_trees(mo.save_trees(trees), COLUMNS, trees.booster.base)
    assert [r.p for r in loaded.score(cases).orderBy("SK_ID_CURR").collect()] == [r.p for r in trees.score(cases).orderBy("SK_ID_CURR").collect()]


def test_cross_validation(cases):
    folds = mo.cross_validate(cases.where("IS_TRAIN = 1"), COLUMNS, folds=2, settings=mo.TreeSettings(trees=3, depth=2, step=0.5))
    rows = folds.collect()
    assert sum(r.n for r in rows) == 500 and all(1 <= r.trees <= 3 for r in rows)
    summary = mo.fold_summary(folds).first()
    assert summary.cv_auc_std == pytest.approx(np.std([r.roc_auc for r in rows]))


def test_full_training(cases):
    bundle = train_full_model(cases, COLUMNS, SMALL)
    p, y = zip(*[(r.p, r.TARGET) for r in bundle.scored.collect()])
    assert bundle.threshold == pytest.approx(np.quantile(p, 1 - np.mean(y))) and bundle.holdout_metrics["roc_auc"] > 0.7
    assert bundle.score_unlabelled(cases).count() == 100


def rows_of(spark, matrix):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(matrix)], "id long, contributions array<double>")


def test_importance_order(spark):
    got = at.global_importance(rows_of(spark, [[0.1, -0.9, 0.01], [0.2, 0.8, -0.02], [-0.1, 0.7, 0.0]]), ["a", "b", "c"]).collect()
    assert [r.feature for r in got] == ["b", "a", "c"]


def test_reasons(spark):
    names = ["inst_late_rate", "CODE_GENDER_M", "DAYS_BIRTH", "EXT_SOURCE_2", "AMT_ANNUITY"]
    df = rows_of(spark, [[0.3, 0.9, 0.8, 0.5, -0.2], [-1, 1, 1, 0, -1]])

    def codes(limit=4):
        return [list(r.c) for r in df.select(re_.reason_codes(names, F.col("contributions"), limit).alias("c")).collect()]

    assert codes() == [["Score de riesgo externo (fuente 2) por debajo del promedio.",
                        "Valor de 'inst_late_rate' desfavorable para el perfil."], []]
    assert [len(c) for c in codes(1)] == [1, 0]
    for bad in (0, -1):
        with pytest.raises(ValueError):
            codes(bad)
    assert re_.strict_protected([*names, "NAME_FAMILY_STATUS_Married"]) == ("CODE_GENDER_M", "DAYS_BIRTH", "NAME_FAMILY_STATUS_Married")


def test_explanations_only_name_reasons_for_high_risk(spark):
    records = spark.createDataFrame(
        [(0, 0.9, 0.5, "alto_riesgo"), (1, 0.1, 0.5, "riesgo_aceptable")],
        "sk_id_curr long, probability double, threshold double, decision string")
    out = re_.explain_records(rows_of(spark, [[0.3, -0.1], [0.4, 0.2]]), records, ["AMT_ANNUITY", "b"], -1.0)
    asked = spark.createDataFrame([(0,), (1,), (7,)], "sk_id_curr long")
    got = {r.sk_id_curr: r for r in re_.lookup_explanations(asked, out).collect()}
    assert len(got[0].reason_codes) == 1 and got[1].reason_codes == [] and not got[7].found
    assert got[0].feature_names == ["AMT_ANNUITY", "b"] and got[0].shap_values == [0.3, -0.1] and got[0].base_value == -1.0


def test_waterfall_keeps_the_sum(spark):
    matrix = np.random.default_rng(0).normal(size=(3, 14))
    names = [f"f{i}" for i in range(14)]
    rows = at.waterfall(rows_of(spark, matrix), names, 0.5).collect()
    for i in range(3):
        mine = [r for r in rows if r.id == i]
        assert len(mine) == 12 and sum(r.contribution for r in mine) == pytest.approx(0.5 + matrix[i].sum())
        assert next(r for r in mine if r.position == 1).feature == f"f{np.abs(matrix[i]).argmax()}"


def test_kendall_tau():
    assert at.kendall_tau(np.array([1, 2, 3.0]), np.array([1, 2, 3.0])) == 1.0
    assert at.kendall_tau(np.array([1, 2, 3.0]), np.array([3, 2, 1.0])) == -1.0
    # x = 1 2 2 3, y = 1 3 2 2: four pairs agree, one disagrees, one tie on each side
    assert at.kendall_tau(np.array([1, 2, 2, 3.0]), np.array([1, 3, 2, 2.0])) == pytest.approx((3 - 1) / 5)


def test_rank_stability(spark):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(400, 6)) * np.array([1, 2, 4, 8, 16, 32])
    taus = at.rank_stability(rows_of(spark, matrix), list("abcdef"), replicates=10)
    summary = at.stability_summary(taus).first()
    assert summary.replicates == 10 and summary.tau_mean > 0.95


def test_imputation_shift_and_continuous_columns(cases, trees):
    assert wi.continuous_columns(cases, COLUMNS) == ["a", "b", "c"]
    native = trees.score(cases.withColumn("n_missing", wi.missing_count(COLUMNS))).select(F.col("SK_ID_CURR").alias("id"), "p", "n_missing")
    imputed = trees.score(wi.impute(cases, {"c": 0.0})).select(F.col("SK_ID_CURR").alias("id"), "p")
    shifts = wi.imputation_shift(native, imputed, 0.5)
    assert shifts.where("complete AND shift > 0").count() == 0
    summary = wi.shift_summary(shifts).first()
    assert (summary.n, summary.n_complete) == (600, sum(1 for i in range(600) if i % 7))


def test_counterfactuals_flip_complete_cases(cases):
    train = cases.where("IS_TRAIN = 1")
    scorer = mo.fit_baseline(train, ["a", "b", "c"], iterations=50)
    out = wi.counterfactuals(train, scorer.score, 0.5, scorer.scaling.deviations, ["a", "b", "c"], columns=("a", "b")).collect()
    assert out and all((r.p >= 0.5) != (r.p_original >= 0.5) for r in out)
    assert all(r.SK_ID_CURR % 7 for r in out) and max(r["rank"] for r in out) <= 3
    mine = sorted([r for r in out if r.SK_ID_CURR == out[0].SK_ID_CURR], key=lambda r: r["rank"])
    assert [r.distance for r in mine] == sorted(r.distance for r in mine)


def test_baseline_learns_beside_a_constant_column(spark):
    rows = [(i, i % 2, 0.1, 3.0 * (i % 2) + (i * 37 % 11) / 5) for i in range(121)]
    df = spark.createDataFrame(rows, "id long, TARGET int, same double, x double")
    scorer = mo.fit_baseline(df, ["same", "x"])
    assert scorer.coefficients[0] == 0 and scorer.coefficients[1] > 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
@pytest.mark.parametrize("name", [
    "m5_boosted_trees", "m6_early_stopping", "m12_cross_validation", "m14_gain_importance", "m17_train_full_model", "m19_batch_scoring",
    "m19_logged_population", "x1_tree_attributions", "x1_additivity", "x12_imputation_shift", "x12_shift_summary"])
def test_registered_trees_take_all_columns_and_settings(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def asked(train, columns, y="TARGET", settings=mo.TreeSettings(), **rest):
        assert {*columns} == {*mo.feature_columns(train)} - {"is_holdout", "fold", "_held"} and len(columns) > 50
        assert (settings.trees, settings.depth) == (1086, 5)
        raise Asked

    monkeypatch.setattr(mo, "fit_trees", asked)
    monkeypatch.setattr(model_queries, "_FITTED", {})
    with pytest.raises(Asked):
        QUERIES[name](spark, "/root/testdata/sf0.001")
