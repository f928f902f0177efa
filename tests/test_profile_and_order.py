import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.operators import profile as pr
from lendgrid.operators import ordered as orders, summaries as su
from lendgrid.operators.ordered import exact_quantiles, global_positions, hash_rank, place_in_ranges, running_sums, sample_rows


def frame(spark, values, name="x"):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], f"id long, {name} double")


@pytest.mark.parametrize("case", ["small", "ties", "large", "one", "hot"])
def test_quantiles_match_linear_interpolation(spark, width, case):
    rng = np.random.default_rng(3)
    values = {
        "small": [3, 1, 2, 10], "ties": rng.integers(0, 5, 400), "large": rng.normal(size=30_000), "one": [7.5],
        "hot": np.where(rng.random(20_000) < 0.4, 0.25, rng.random(20_000)),
    }[case]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9193, 1.0]
    got = exact_quantiles(frame(spark, [*values, None]), {"x": probabilities})["x"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), abs=1e-12)


def test_quantiles_in_parts(spark, width):
    rng = np.random.default_rng(8)
    values = np.where(rng.random(30_000) < 0.3, 0.5, rng.random(30_000))
    probabilities = [0.001, 0.25, 0.5, 0.77, 0.999]
    got = exact_quantiles(frame(spark, values), {"x": probabilities})["x"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), abs=1e-12)


@pytest.mark.parametrize("repeat", [1, 5])
def test_quantiles_beyond_a_summary(spark, width, repeat, monkeypatch):
    rng = np.random.default_rng(repeat)
    values = np.round(rng.normal(size=4000), 3 if repeat > 1 else 9).tolist() * repeat
    rng.shuffle(values)
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.7771, 0.999, 1.0]

    monkeypatch.setattr(su, "EXACT", 50)
    monkeypatch.setattr(su, "WIDTH", 32)
    whole = su.Summary()
    for start in range(0, len(values), 250):
        whole.add(*np.unique(values[start:start + 250], return_counts=True))
    ordered = np.sort(values)
    run = np.cumsum(whole.pairs()[1])
    assert run[-1] == len(values) and all(abs(int(r) - np.searchsorted(ordered, v, "right")) <= whole.error for v, r in zip(whole.pairs()[0], run))
    monkeypatch.setattr(orders, "column_summaries", lambda df, columns: {"x": whole})
    got = exact_quantiles(frame(spark, values), {"x": probabilities})["x"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), abs=1e-12)


def test_summaries_of_columns(spark, width):
    rows = [(float(i % 7), float(i), None if i % 3 else float("nan")) for i in range(20_000)]
    found = su.column_summaries(spark.createDataFrame(rows, "a double, b double, c double").repartition(3), ["a", "b", "c"])
    assert found["a"].exact and found["a"].pairs()[1].sum() == 20_000 and found["c"].n == 0
    assert not found["b"].exact and found["b"].n == 20_000 and abs(found["b"].at_rank(9_999) - 9_999) <= found["b"].error + 8 < 200


def test_global_positions(spark, width):
    rng = np.random.default_rng(6)
    rows = [(f"d{int(a)}", i) for i, a in enumerate(rng.integers(0, 9, 200))]
    got = {(r.a, r.b): r.position for r in global_positions(spark.createDataFrame(rows, "a string, b long"), ["a", "b"]).collect()}
    assert [got[r] for r in sorted(rows)] == list(range(200))


def test_a_missing_key_is_a_key(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 1), ("a", 1.0, 1)], "k string, p double, n long")
    rows = running_sums(place_in_ranges(df, "p", 3), [F.col("p")], ["n"], ("k",)).collect()
    assert sorted((str(r.k), r.p, r.cum_n, r.all_n) for r in rows) == [("None", 1.0, 1, 2), ("None", 2.0, 2, 2), ("a", 1.0, 1, 1)]


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(frame(spark, [None, None]), {"x": [0.5]}) == {"x": [None]}


def test_running_sums_equal_a_global_window(spark, width):
    rng = np.random.default_rng(1)
    rows = [(k, float(p), int(n)) for k in ("a", "b") for p, n in zip(rng.permutation(300) / 7, rng.integers(1, 9, 300))]
    df = spark.createDataFrame(rows, "k string, p double, n long")
    got = {(r.k, r.p): (r.cum_n, r.all_n) for r in running_sums(
        place_in_ranges(df, "p"), [F.col("p").desc()], ["n"], ("k",), descending=True).collect()}
    for k in ("a", "b"):
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: -r[1])
        total = 0
        for _, p, n in mine:
            total += n
            assert got[(k, p)] == (total, sum(r[2] for r in mine))


def test_hash_rank_is_a_permutation_per_key(spark, width):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    rows = hash_rank(df, "id", 5, ("k",)).collect()
    for k in range(3):
        mine = [r for r in rows if r.k == k]
        assert sorted(r["rank"] for r in mine) == list(range(1, len(mine) + 1)) and {r.n for r in mine} == {len(mine)}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    first = {r.id for r in sample_rows(df, "id", 100, 42).collect()}
    assert len(first) == 100 and first == {r.id for r in sample_rows(df.repartition(7), "id", 100, 42).collect()}
    assert first != {r.id for r in sample_rows(df, "id", 100, 43).collect()}
    assert sample_rows(df, "id", 9999, 42).count() == 500


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "b")], "a int, b double, c string")
    assert [tuple(r) for r in pr.null_profile(df).collect()] == [("b", 2, 66.67), ("c", 1, 33.33)]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(0).normal(size=2000)
    counts, edges = np.histogram(values, bins=50)
    got = {r.bin: r for r in pr.histogram(frame(spark, values), "x").collect()}
    assert sum(r.n for r in got.values()) == 2000
    differing = sum(abs((got[i].n if i in got else 0) - c) for i, c in enumerate(counts))
    assert differing <= 2  # values on an edge may move by rounding
    assert got[0].left_edge == pytest.approx(edges[0])


def test_correlations_skip_incomplete_pairs(spark):
    rows = [(1.0, 2.0, 0), (2.0, None, 1), (3.0, 1.0, 1), (4.0, 0.5, None), (5.0, 0.1, 1)]
    df = spark.createDataFrame(rows, "a double, b double, TARGET int")
    got = {r.feature: r["corr"] for r in pr.target_correlations(df, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx(np.corrcoef([1, 2, 3, 5], [0, 1, 1, 1])[0, 1])
    assert got["b"] == pytest.approx(np.corrcoef([2, 1, 0.1], [0, 1, 1])[0, 1])


def test_describe(spark):
    values = np.random.default_rng(2).normal(size=501)
    row = pr.describe(frame(spark, values), ["x"]).first()
    assert (row["count"], row["std"]) == (501, pytest.approx(values.std(ddof=1)))
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_counts_at_maximum_and_cardinality(spark):
    df = spark.createDataFrame([(9, "a"), (9, "b"), (9, "a"), (1, "c"), (None, "a")], "x int, k string")
    assert {r.k: r.n for r in pr.counts_at_maximum(df, "x", "k").collect()} == {"a": 2, "b": 1}
    assert {r.column: r.n_distinct for r in pr.cardinality(df, ["x", "k"]).collect()} == {"x": 2, "k": 3}
