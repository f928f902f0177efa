"""Numbers of categories against the one-hot form, and beyond its size."""

import pytest
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from lendgrid.operators.dictionary import category_drift, category_numbers, extend_dictionary, sparse_categories
from lendgrid.operators.drift import stability_index
from lendgrid.operators.encoding import apply_one_hot, fit_categories

COLUMNS = ["kind", "place"]


@pytest.fixture
def rows(spark):
    values = [(i, None if i % 7 == 0 else "abc"[i % 3], ["x", "y", None, "", "x"][i % 5]) for i in range(60)]
    return spark.createDataFrame(values, "id long, kind string, place string")


def numbers_of(dictionary):
    return {(r["column"], r["value"]): r["number"] for r in dictionary.collect()}


def test_numbers_stay_when_values_are_added(spark, rows, width, tmp_path):
    extend_dictionary(rows.where("kind = 'b'"), COLUMNS).write.parquet(str(tmp_path / "a"))
    first = spark.read.parquet(str(tmp_path / "a"))
    before = numbers_of(first)
    after = numbers_of(extend_dictionary(rows, COLUMNS, first))
    assert before[("kind", "b")] == 1 and before.items() <= after.items()
    assert (after[("kind", "a")], after[("kind", "c")]) == (2, 3)
    assert sorted(n for (c, _), n in after.items() if c == "place") == [1, 2, 3]
    again = extend_dictionary(rows, COLUMNS, extend_dictionary(rows, COLUMNS, first))
    assert numbers_of(again) == after  # nothing new, nothing changes


def test_totals_are_those_of_the_one_hot_form(spark, rows, width):
    dictionary = extend_dictionary(rows, COLUMNS)
    known = numbers_of(dictionary)
    coded = sparse_categories(category_numbers(rows, dictionary, COLUMNS, "id"), dictionary, COLUMNS)
    total = coded.select(Summarizer.sum(F.col("categories")).alias("s")).first()["s"]
    categories = fit_categories(rows, COLUMNS)
    flags = apply_one_hot(rows, categories).drop("id")
    wide = flags.agg(*[F.sum(F.col(f"`{c}`").cast("int")).alias(c) for c in flags.columns]).first().asDict()
    start = 0
    for c in COLUMNS:
        assert total[start] == wide[f"{c}_nan"]
        for v in categories[c]:
            assert total[start + known[(c, v)]] == wide[f"{c}_{v}"]
        start += len(categories[c]) + 2
        assert total[start - 1] == 0  # no unknown value
    assert len(total) == start


def test_unknown_missing_and_empty(spark, rows):
    dictionary = extend_dictionary(rows, COLUMNS)
    other = spark.createDataFrame([(1, "new", None), (2, None, "x")], "id long, kind string, place string")
    got = {r["id"]: r["numbers"] for r in category_numbers(other, dictionary, COLUMNS, "id").collect()}
    assert got == {1: {"kind": None, "place": 0}, 2: {"kind": 0, "place": numbers_of(dictionary)[("place", "x")]}}
    coded = sparse_categories(category_numbers(other, dictionary, COLUMNS, "id"), dictionary, COLUMNS).orderBy("id").collect()
    assert list(coded[0]["categories"].indices) == [4, 5]  # kind has places 0 to 4, the last one for unknown values
    nothing = rows.where("id < 0")
    assert extend_dictionary(nothing, COLUMNS).count() == 0
    assert category_numbers(nothing, dictionary, COLUMNS, "id").count() == 0
    assert category_drift(nothing, COLUMNS, F.col("id") > 3).count() == 0


def test_drift_of_categories_is_that_of_flags(rows):
    reference = F.col("id") < 25
    got = {f"{r['column']}_{'nan' if r['value'] is None else r['value']}": r["psi"] for r in category_drift(rows, COLUMNS, reference).collect()}
    flags = apply_one_hot(rows, fit_categories(rows, COLUMNS))
    wide = stability_index(flags, [c for c in flags.columns if c != "id"], reference)
    assert got == pytest.approx({r["column"]: r["psi"] for r in wide.collect()})


def test_a_million_categories(spark, tmp_path):
    """Half of the rows share one value; all others have their own."""
    n = 2_000_000
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("kind"))
    path = str(tmp_path / "dictionary")
    extend_dictionary(df, ["kind"]).write.parquet(path)
    dictionary = spark.read.parquet(path)
    row = dictionary.agg(F.count(F.lit(1)), F.countDistinct("number"), F.min("number"), F.max("number")).first()
    assert tuple(row) == (n // 2 + 1, n // 2 + 1, 1, n // 2 + 1)
    numbers = category_numbers(df, dictionary, ["kind"], "id").select(F.col("numbers")["kind"].alias("number"))
    hot = dictionary.where("value = 'hot'").first()["number"]
    got = numbers.agg(F.count("number"), F.countDistinct("number"), F.sum((F.col("number") == hot).cast("long"))).first()
    assert tuple(got) == (n, n // 2 + 1, n // 2)
