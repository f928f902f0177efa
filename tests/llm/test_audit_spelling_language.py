"""Filter audit, spelling variants and language ID against brute force, enumeration and held-out labels."""

import os
import random
import zlib
from itertools import permutations, product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lendgrid.llm import filter_audit, language_crf, spelling_variants
from lendgrid.llm.filter_audit import audit_filters, document_failures, lattice_edges
from lendgrid.llm.language_crf import detect_languages, fit_field, identify_languages, marginals, train_languages
from lendgrid.llm.spelling_variants import group_spellings, near_words, slipped_words
from lendgrid.llm.words import letters
from sql_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@needs_tables
@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_spelling_variants"])
def test_query_matches_sql(spark, name):
    outcome = compare(spark, connect(FOLDER), FOLDER, name, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


# --- filter audit -----------------------------------------------------------------------------------------------------------

def test_edges_lie_on_all_orders():
    for k in (1, 3, 5):
        edges = lattice_edges(k)
        assert len(edges) == k * 2 ** (k - 1)
        for f in range(k):
            assert sum(e.orders for e in edges if e.filter == f) == len(list(permutations(range(k))))


def _audit(rows, names):
    """(part, order, step) -> figures, one document at a time."""
    out = {}
    for part in {p for p, *_ in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            gone = set()
            for step, f in enumerate(order, 1):
                fails = [i for i, r in enumerate(own) if r[1] >> names.index(f) & 1]
                now = [i for i in fails if i not in gone]
                figures = [len(own) - len(gone) - len(now), len(now), len(fails) - len(now), sum(own[i][1] == 1 << names.index(f) for i in fails),
                           sum(own[i][2] or 0 for i in now), sum(own[i][3] or 0 for i in now)]
                gone |= set(now)
                shapley[f] += len(now)
                out[part, "".join(order), step] = (*figures, f)
        out |= {k: (*v[:-1], shapley[v[-1]]) for k, v in out.items() if k[0] == part and isinstance(v[-1], str)}
    return out


def test_audit_by_brute_force(spark, width):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "b", "b"]), rng.randrange(16), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(200)]
    frame = spark.createDataFrame(rows, "part string, mask int, good int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit_filters(frame, "WXYZ").collect()}
    assert got == _audit(rows, "WXYZ") and len(got) == 2 * 24 * 4


def test_failures_of_texts(spark, width, monkeypatch):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", 3)  # both ways to look up a digest are taken
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(4, "hot", "s"), (1, "hot", "s"), (9, "hot", None), (1, "hot", "s"), (2, None, "s"), (3, "", ""), (None, "hot", "s"), (5, long, "t"), (6, long + " #", "t"),
            (7, "A b " * 40, "t"), (8, long, "t"), (10, "x " * 200_000, "t")]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, key string, mask int")
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = sorted((r["doc_id"] or 0, r["part"], r["mask"], r["good"] or 0, r["toxic"] or 0) for r in document_failures(docs, labels).collect())
    assert got == sorted([(4, "s", 17, 1, 1), (1, "s", 1, 0, 0), (9, "", 17, 0, 0), (1, "s", 1, 0, 0), (2, "s", 1, 0, 0), (3, "", 17, 0, 0), (0, "s", 1, 0, 0), (5, "t", 0, 0, 0),
                          (6, "t", 8, 0, 0), (7, "t", 6, 0, 0), (8, "t", 16, 0, 0), (10, "t", 2, 0, 0)])


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(document_failures(docs, labels)).collect() == []
    one = audit_filters(document_failures(spark.createDataFrame([(None, None, None)], docs.schema), labels))
    assert one.count() == 600 and {r["part"] for r in one.collect()} == {""}


# --- spelling variants ------------------------------------------------------------------------------------------------------

def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _groups(words):
    out = {}
    for w, n in words.items():
        near = [(-words[x], x) for x in words if _near(w, x)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= 10 * n else None
        out[w] = (form, n, len(near), -best[0] if form else None)
    for w, (form, *rest) in list(out.items()):
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w] = (form, root, *rest)
    return out


def _check_groups(spark, words):
    got = group_spellings(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got.collect()} == _groups(words)


def test_spellings_by_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(spelling_variants, "TOGETHER", 16)  # blocks are cut
    rng = random.Random(11)
    words = {}
    for _ in range(500):
        word = "".join(rng.choice("abcé€𝄞" if rng.random() < 0.1 else "aab") for _ in range(rng.randint(3, 7)))
        words[word] = rng.choice([1, 2, 3, 30, 300, 5000])
    words |= {"z" * 5000: 7, "z" * 4999: 90, "z" * 2500 + "y" + "z" * 2499: 1, "": 3, "q": 40, "r": 400}
    _check_groups(spark, words)


def test_parts_of_a_hot_block(spark):
    rng = random.Random(2)
    words = {"".join(rng.sample("abcdefgh", 8)): 2 for _ in range(300)}  # one block: the same letters in another order
    words |= {w[:3] + rng.choice("abcdefgh") + w[4:]: 9 for w in list(words)[:80]} | {w[:3] + w[4:]: 25 for w in list(words)[:80]}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = sorted((a, b) for a in words for b in words if _near(a, b))
    for block in (7, 100_000):
        assert sorted((r["word"], r["near"]) for r in near_words(frame, classes=3, block=block).collect()) == expected


def test_slips_and_counts(spark):
    texts = [(i, f"Wörtchen wörtchen WÖRTCHEN ×÷ÿabcdefg short1longenough{i % 3} " * 3) for i in range(70)] + [(None, "Nonamehere nonamehere"), (70, None), (71, ""), (71, "x" * 200_000 + " " + "x" * 200_000)]
    docs = spark.createDataFrame([(*t, "k", 5) for t in texts], "doc_id long, text string, word string, n int")
    counts = {}
    for i, text in texts:
        import re
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    expected = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in slipped_words(docs).collect()} == expected


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert group_spellings(slipped_words(docs)).collect() == []


def test_letters_of_words():
    words = pa.array(["", "abc", "é", "xÿz", ""])
    assert [chr(c) for c in letters(words)[0]] == list("abcéxÿz") and letters(words.slice(2))[1].tolist() == [0, 1, 4, 4]
    assert [chr(c) for c in letters(pa.array(["a€", "𝄞"]))[0]] == list("a€𝄞")


# --- language ID ------------------------------------------------------------------------------------------------------------

def test_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    sizes, k = np.array([5, 0, 1, 7, 2]), 3
    scores, start, switch = rng.normal(size=(15, k)) * 3, rng.normal(size=k), rng.normal(size=(k, k)) * 2
    expected, at = np.zeros((15, k)), 0
    for n in sizes:
        for path in product(range(k), repeat=int(n)):
            if n:
                weight = np.exp(start[path[0]] + sum(scores[at + i, y] for i, y in enumerate(path)) + sum(switch[a, b] for a, b in zip(path, path[1:])))
                for i, y in enumerate(path):
                    expected[at + i, y] += weight
        at += n
    expected /= expected.sum(axis=1, keepdims=True)
    for segment in (1, 2, 3, 64):
        assert np.allclose(marginals(scores, sizes, start, switch, segment), expected)
    assert marginals(np.empty((0, k)), np.zeros(2, int), start, switch).shape == (0, k)


def test_long_chains_stay_finite():
    rng = np.random.default_rng(1)
    out = marginals(rng.normal(size=(30_000, 3)) * 30, np.array([30_000]), np.zeros(3), np.diag([9.0, 9, 9]) - 9)
    assert np.isfinite(out).all() and np.allclose(out.sum(axis=1), 1)


def test_slope_of_the_likelihood():
    rng = np.random.default_rng(8)
    words = pa.array(["ab", "b", "abc", "ça"])
    goal = language_crf._Likelihood(words, rng.integers(0, 4, (3, 5)), rng.integers(0, 2, (3, 5)), np.array([0, 1, 2, 0]), 2)
    x = rng.normal(size=sum(goal.sizes)) * 0.3
    slope = goal(x)[1]
    for i in rng.choice(len(x), 12, replace=False).tolist() + [len(x) - 1, len(x) - 5]:
        move = np.zeros(len(x))
        move[i] = 1e-5
        assert abs((goal(x + move)[0] - goal(x - move)[0]) / 2e-5 - slope[i]) < 1e-7


def _model():
    en, de = "the cat sat on that mat with this hat".split(), "der hund und die katze schlafen nicht".split()
    return fit_field([("en", en), ("de", de)] * 6)


def test_switched_text_is_cut_into_stretches(spark):
    docs = spark.createDataFrame([(1, "The cat sat on the mat. Der Hund und die Katze! that hat with this mat", "s", 0.5)], "doc_id long, text string, lang_spans string, Score double")
    row = identify_languages(docs, _model(), spans=True).first()
    assert [(s["lang"], s["first"], s["words"]) for s in row["lang_spans"]] == [("en", 0, 6), ("de", 6, 5), ("en", 11, 5)]
    assert row["lang_pred"] == "en" and 0.6 < row["score"] < 0.8 and row.asDict().keys() == {"doc_id", "text", "lang_pred", "score", "lang_spans"}


def test_texts_without_letters(spark):
    texts = [None, "", " \n", "12 + 3 = 15 #", "́́", "the", "der " * 60_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_languages(docs, _model()).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(5)) and got[5][0] == "en" and got[6][0] == "de"
    assert {r["lang_pred"] for r in identify_languages(docs, fit_field([])).collect()} == {"und"}


def test_fit_without_labels_or_rows(spark):
    schema = "doc_id long, text string, lang string, held_out int, body string"
    none = spark.createDataFrame([(1, "a b", None, 0, "x"), (None, None, "en", 0, "x")], schema)
    assert [(r["held_out"], r["lang_pred"]) for r in detect_languages(none).orderBy("doc_id").collect()] == [(False, "und"), (zlib.crc32(b"1") % 3 == 1, "und")]
    assert detect_languages(spark.createDataFrame([], schema)).collect() == []
    one = spark.createDataFrame([(i, f"word{i} text", "en", 0, "x") for i in range(6)] * 2, schema)
    assert [r["lang_pred"] for r in detect_languages(one).collect()] == ["en"] * 12


@needs_tables
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    scored = detect_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = scored.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 300 and right >= 0.98
    assert not train_languages(docs.withColumn("lang", F.lit(None).cast("string"))).languages
