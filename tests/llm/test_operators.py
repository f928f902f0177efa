"""Operators of the llm subpackage against brute force, round trips and plain SQL; nulls, ties, empty tables, clashing columns."""

import base64
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from lendgrid.llm import decontaminate, license_scan, simhash, warc_archive
from lendgrid.llm.components import connected_components
from lendgrid.llm.line_dedup import drop_boilerplate
from lendgrid.llm.mixing import mix_sources, share_budget
from lendgrid.llm.ordinal_quality import GRADES, OrdinalModel, fit_ordinal, keep_good, score_quality, train_quality
from lendgrid.llm.quality_rules import apply_quality_rules
from lendgrid.llm.suffix_dedup import equal_classes, remove_repeats
from lendgrid.llm.token_counts import PieceCounter, Vocabulary, count_tokens
from lendgrid.llm.words import number_texts, number_words, plain_words
from sql_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, count int, lines string"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def table(spark, texts, ids=None, source="s0"):
    rows = [(i, t, "en", source, None, "k", 1, "l") for i, t in zip(range(len(texts)) if ids is None else ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


@needs_tables
@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_warc_archive", "op5_source_mixing", "op8_quality_rules"])
def test_query_matches_sql(spark, name):
    outcome = compare(spark, connect(FOLDER), FOLDER, name, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


# --- line dedup -------------------------------------------------------------------------------------------------------------

def test_lines_by_brute_force(spark, width):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice(["menu", " menu ", "foot", "", "a%d" % i, "b", "rare"]) for _ in range(rng.randint(0, 6))) for i in range(60)]
    hosts = [rng.choice(["x", "y", None]) for _ in texts]
    docs = spark.createDataFrame([(i, t, h, "k", 7) for i, (t, h) in enumerate(zip(texts, hosts))], "doc_id long, text string, source string, keys string, host_key int")
    got = {r["doc_id"]: r["text"] for r in drop_boilerplate(docs, max_ratio=0.3, min_pages=4).collect()}
    for i, (text, host) in enumerate(zip(texts, hosts)):
        own = [t for t, h in zip(texts, hosts) if h == host]
        n = lambda line: sum(line.strip(" \t\r") in {x.strip(" \t\r") for x in t.split("\n")} for t in own)  # noqa: B023,E731
        gone = [bool(x.strip(" \t\r")) and n(x) >= 4 and n(x) > 0.3 * len(own) for x in text.split("\n")]
        rest = [x for x, g in zip(text.split("\n"), gone) if not g]
        assert got[i] == ("\n".join(rest) if any(gone) and any(x.strip(" \t\r") for x in rest) else text)


def test_lines_keep_null_and_copies(spark):
    docs = table(spark, [None, "", *["same page\nall of it"] * 8])
    assert [r["text"] for r in drop_boilerplate(docs).orderBy("doc_id").collect()] == [None, "", *["same page\nall of it"] * 8]
    assert drop_boilerplate(docs.limit(0)).columns == docs.columns


# --- archive ----------------------------------------------------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    rows = [(3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, None), (5, "u", ""), (None, "n", "same"), (7, "é", "öß\r\n\r\nend")]
    pages = spark.createDataFrame([(*r, 0, "x") for r in rows], "page_id long, url string, html string, first int, address string")
    warc_archive.write_archive(pages, f"{tmp_path}/a")
    got = {r["page_id"]: r for r in warc_archive.read_archive(spark, f"{tmp_path}/a").collect()}
    assert len(got) == 6
    for page, _, html in rows:
        body = (html or "").encode()
        assert got[page]["payload_bytes"] == len(body)
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 2: ("response", None), 5: ("revisit", 2), 7: ("response", None)}
    assert bytes(got[7]["record"]).endswith("\r\n\r\nöß\r\n\r\nend".encode()) and bytes(got[3]["record"]).count(b"same") == 0
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == 3
    warc_archive.export_warc(spark, f"{tmp_path}/a", f"{tmp_path}/w", records_per_file=2)
    files = warc_archive.read_warc_files(spark, f"{tmp_path}/w").collect()
    assert sorted(bytes(r["header"]) + bytes(r["block"]) for r in files) == sorted(bytes(r["record"]) for r in got.values())


def test_archive_finds_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    warc_archive.write_archive(pages, f"{tmp_path}/a")
    good = spark.read.parquet(f"{tmp_path}/a/payloads").withColumn("payload", F.lit("other").cast("binary")).collect()
    spark.createDataFrame(good, "address binary, payload binary").write.mode("overwrite").parquet(f"{tmp_path}/a/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc_archive.read_archive(spark, f"{tmp_path}/a").collect()


def test_empty_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc_archive.write_archive(pages, f"{tmp_path}/a")
    assert warc_archive.read_archive(spark, f"{tmp_path}/a").count() == 0


# --- token counts -----------------------------------------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.exists(MODEL), reason="vocabulary files are not here")
def test_pieces_equal_the_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = Vocabulary.read(MODEL)
    worst = min(s for _, s in vocabulary.pieces)
    own = [("<unk>", worst), *vocabulary.pieces, *[(f"<0x{i:02X}>", worst) for i in range(256)]]
    exact = tokenizers.Tokenizer(tokenizers.models.Unigram(own, 0, True))
    exact.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = ["", " ", "  a", "a b  c ", "▁x▁", "line\nbreak\n\n", "日本語 é😀", "aaaaaaaa" * 50, "word " * 3000]
    if os.path.isdir(FOLDER):
        texts += [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(table(spark, [*texts, None]), vocabulary).collect()}
    assert got.pop(len(texts)) == 0
    assert got == {i: len(exact.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_piece_ties_and_unknown():
    counter = PieceCounter(Vocabulary([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("b", -3.0)], False))
    assert counter.count("aa") == (2, -3.0)  # of equal scores the longer last piece
    assert counter.count("xyb") == (3, -1.0 + 2 * -13.0 - 3.0)  # unknown neighbours are one piece


# --- licenses ---------------------------------------------------------------------------------------------------------------

def test_licenses_by_brute_force(spark):
    rng = random.Random(5)
    filler = [f"w{i}" for i in range(40)]
    texts = [None, "", "word"]
    for i in range(60):
        notice = plain_words(rng.choice(license_scan.TEMPLATES)[1])
        if i % 3 == 1 and len(notice) > 12:
            notice[rng.choice([0, len(notice) - 1])] = "changed"
        if i % 3 == 2:
            notice = notice[: len(notice) // 2]
        texts.append(" ".join([*rng.choices(filler, k=rng.randint(0, 30)), *notice, *rng.choices(filler, k=rng.randint(0, 30))]))
    expected = {}
    for i, text in enumerate(texts):
        words = plain_words(text or "")
        for name, template in license_scan.TEMPLATES:
            own = plain_words(template)
            want = set(license_scan.shingles(own))
            for at in range(len(words)):
                share = len(want & set(license_scan.shingles(words[at:at + len(own)]))) / len(want)
                if share >= license_scan.CONTAINMENT:
                    expected[i, name] = max(share, expected.get((i, name), 0))
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan_licenses(table(spark, texts)).collect()}
    assert got == expected and len(got) > 30


# --- mixing -----------------------------------------------------------------------------------------------------------------

def fill(capacity, weight, budget):
    """Water level by bisection in exact fractions is overkill here: repeat dealing to nodes that are not full."""
    given, open_nodes = [0] * len(capacity), {i for i, w in enumerate(weight) if w}
    while open_nodes:
        left = budget - sum(given[i] for i in range(len(given)) if i not in open_nodes)
        total = sum(weight[i] for i in open_nodes)
        full = {i for i in open_nodes if left * weight[i] >= capacity[i] * total}
        if not full:
            for i in open_nodes:
                given[i] = left * weight[i] // total
            break
        for i in full:
            given[i] = capacity[i]
        open_nodes -= full
    return given


def test_budgets_by_brute_force(spark):
    rng, rows, expected = random.Random(1), [], {}
    for parent in range(40):
        n = rng.randint(1, 6)
        capacity, weight, budget = [rng.randint(1, 50) for _ in range(n)], [rng.randint(0, 4) for _ in range(n)], rng.randint(0, 150)
        rows += [(parent, i, c, w, budget) for i, (c, w) in enumerate(zip(capacity, weight))]
        expected |= {(parent, i): b for i, b in enumerate(fill(capacity, weight, budget)) if weight[i]}
    nodes = spark.createDataFrame(rows, "p int, k int, capacity long, weight long, parent_budget long")
    got = {(r["p"], r["k"]): r["budget"] for r in share_budget(nodes, ["p"], "k").collect()}
    assert got == expected


def test_mixing_edges(spark, width):
    docs = spark.createDataFrame([(1, "a b c", "en", "s0", 5), (1, "a b c", "en", "s0", 5), (2, None, None, None, 5), (3, "", "en", "s1", 5), (4, "x y", None, None, 5)],
                                 "doc_id long, text string, lang string, source string, copies int")
    rows = mix_sources(docs, share=1.0).collect()
    assert {r[0] for r in rows} == {1, 4} and sum(r["doc_id"] == 1 for r in rows) == 2
    assert mix_sources(docs.limit(0)).count() == 0


# --- quality classifier -----------------------------------------------------------------------------------------------------

@needs_tables
def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else FOLDER
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = train_quality(docs, labels.filter("doc_id % 4 <> 0"))
    held = score_quality(docs.filter("doc_id % 4 = 0"), model).join(labels, "doc_id")
    kept = {(r["quality"], r["toxic"]): r["share"] for r in held.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1, 0] > 0.98 and kept[0, 0] < 0.05 and kept[1, 1] < 0.5


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
@pytest.mark.parametrize("part", range(4))
def test_classifier_drops_toxic_held_out_rows(spark, part):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = train_quality(docs, labels.filter(f"doc_id % 4 <> {part}"))
    held = score_quality(docs.filter(f"doc_id % 4 = {part}"), model).join(labels, "doc_id").filter("quality = 1")
    kept = {r["toxic"]: r["share"] for r in held.groupBy("toxic").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    print(f"part {part}: kept toxic {kept[1]:.4f}, kept clean {kept[0]:.4f}")
    assert kept[1] < 0.2 and kept[0] > 0.975


def test_ordinal_model():
    rng = np.random.default_rng(2)
    grades = np.array([k % GRADES for k in range(90)])
    rows = [(np.array([k, 10 + rng.integers(5)]), np.array([1.0, 0.1])) for k in grades]
    model = fit_ordinal(rows, grades)
    assert np.all(np.diff(model.thresholds) > 0)
    tails = model.tails(np.array([float(model.weights[i] @ v) for i, v in rows]))
    assert np.all(tails[:, 0] >= tails[:, 1]) and np.array_equal((tails >= 0.5).sum(axis=1), grades)
    assert isinstance(fit_ordinal([], np.empty(0, int)), OrdinalModel)


def test_classifier_edges(spark):
    docs = table(spark, [None, "", "good text", "bad | bad"], ids=[None, 1, 2, 3]).withColumn("kept", F.lit("own"))
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, None), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id = 2").count() == 1 and kept.filter("doc_id = 3").count() == 0
    assert keep_good(docs.limit(0), labels).count() == 0
    assert keep_good(docs, labels.limit(0)).count() in (0, 4)


# --- decontamination --------------------------------------------------------------------------------------------------------

def test_latent_space_knows_every_passage(spark):
    rng = random.Random(3)
    common = [f"word{i}" for i in range(300)]
    slot = lambda words: decontaminate._slot(np.array(number_words(words), np.uint64)).tolist()
    taken = set(slot(common))
    # texts with words of their own, among so many others that a sample of 20,000 by the hash of the text left them out
    rare = [[w for w in (f"rare{i}x{j}" for j in range(12)) if slot([w])[0] not in taken] for i in range(80)]
    hashed = table(spark, [" ".join(r) for r in rare]).select("doc_id", F.pmod(F.xxhash64("text"), F.lit(1_000_000)).alias("h")).collect()
    left_out = [rare[r["doc_id"]] for r in hashed if r["h"] > 900_000][:3]
    assert left_out
    texts = [" ".join(rng.choices(common, k=5)) for _ in range(23_000)] + [" ".join(r) for r in left_out] * 20
    passages = decontaminate.cut_items([(1, " ".join(common[:30]), None)])
    idf, basis = decontaminate.fit_space(table(spark, texts).select("text"), passages)
    assert (np.abs(basis[slot([w for r in left_out for w in r])]).max(axis=1) > 0).all()
    assert basis.shape == (decontaminate.SLOTS, decontaminate.RANK) and np.allclose(basis.T @ basis, np.eye(decontaminate.RANK), atol=1e-2)


def test_products_of_the_corpus_are_the_dense_ones(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", *[" ".join(f"w{i}" for i in rng.integers(0, 50, n)) for n in rng.integers(1, 200, 40)]]
    found = table(spark, texts).select("text").mapInArrow(decontaminate._passage_slots, "slots binary, starts binary")
    idf, basis = rng.random(decontaminate.SLOTS, np.float32) + 1, rng.standard_normal((decontaminate.SLOTS, 6), np.float32)
    dense = []
    for text in texts:
        words = decontaminate._slot(np.array(number_words(plain_words(text or "")), np.uint64))
        for at in range(0, len(words), 4 * decontaminate.BLOCK):
            some = words[at:at + 4 * decontaminate.BLOCK]
            row = np.bincount(some, idf[some], decontaminate.SLOTS)
            dense.append(row / np.sqrt((idf[some] ** 2).sum()))
    dense = np.array(dense)
    got = decontaminate._corpus_product(found, idf, basis)
    assert np.allclose(got, dense.T @ (dense @ basis), rtol=1e-3, atol=1e-3)


def test_leaks_and_recall(spark):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)]
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([8, 25, 60]))) for _ in range(30)]
    texts, planted = [None, ""], {}
    for i in range(300):
        words = rng.choices(vocabulary, k=rng.randint(5, 400))
        if i % 3 == 0:
            item = rng.randrange(len(items))
            leak = items[item].split()
            if i % 2 and len(leak) > 20:
                for _ in range(len(leak) // 10):
                    leak[rng.randrange(len(leak))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = leak
            planted[len(texts)] = item
        texts.append(" ".join(words))
    benchmark = spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(table(spark, texts), benchmark).collect()}
    # brute force: every window of every text against every passage
    passages = decontaminate.cut_items([(i, t, None) for i, t in enumerate(items)])
    expected = set()
    for d, text in enumerate(texts):
        words = number_words(plain_words(text or ""))
        for item, pattern, answer in zip(passages.items, passages.words, passages.answers):
            if len(set(pattern) & set(words)) >= 0.6 * len(set(pattern)):
                for a in range(0, max(1, len(words)), 4):
                    share = decontaminate.lcs_length(pattern, words[a:a + len(pattern) + 4]) / len(pattern)
                    if share >= decontaminate.LCS_SURE:
                        expected.add((d, item))
                        break
    assert set(planted.items()) <= expected
    assert len(got & expected) >= 0.9 * len(expected) and set(planted.items()) <= got and {d for d, _ in got} == {d for d, _ in expected}
    assert decontaminate.find_leaks(table(spark, texts), benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(table(spark, [None, ""], ids=[None, 1]), benchmark).count() == 2


def test_lcs():
    rng = random.Random(1)
    for _ in range(100):
        a, b = rng.choices(range(5), k=rng.randint(0, 12)), rng.choices(range(5), k=rng.randint(0, 12))
        row = [0] * (len(b) + 1)
        for x in a:
            row = _lcs_step(row, x, b)
        assert decontaminate.lcs_length(a, b) == row[-1]


def _lcs_step(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


# --- quality rules ----------------------------------------------------------------------------------------------------------

def test_measures_by_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b c a b c", "x" * 5000, "one two\none two\n\none two\r", "# $ |<é>&"]
    texts += ["".join(rng.choice([f"{rng.choice('abc')} ", "the ", "\n", "#x "]) for _ in range(rng.randint(40, 300))) for _ in range(30)]
    for r in apply_quality_rules(table(spark, texts)).collect():
        text = texts[r["doc_id"]] or ""
        words = [w for w in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        repeat = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if x.strip()]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat)), text[:80]
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeat) > 50 * len(words)) and not (r["kept"] and r["base_failed"])


# --- near duplicates --------------------------------------------------------------------------------------------------------

def slow_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    found = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum((2 * sum(h >> b & 1 for h in found) > len(found)) << b for b in range(64))


def classes(values, ids):
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_near_duplicates_by_brute_force(spark, width):
    rng = random.Random(6)
    texts = [None, "", " ", "A b", "a B", "a b c d"]
    for _ in range(25):
        words = rng.choices([f"W{i}" for i in range(300)], k=rng.randint(100, 400))
        for _ in range(3):
            texts.append(" ".join(words))
            words[rng.randrange(len(words))] = "edit"
    got = {r["doc_id"]: r for r in simhash.near_duplicate_classes(table(spark, texts)).collect()}
    values = [slow_fingerprint(t or "") for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{v:016x}" for v in values]
    expected = classes(values, range(len(texts)))
    assert [got[i]["component_id"] for i in range(len(texts))] == expected
    left = simhash.drop_near_duplicates(table(spark, texts))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(expected)) and left.columns == SCHEMA_COLUMNS


SCHEMA_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def test_repeated_and_missing_ids(spark):
    docs = table(spark, ["same text here", "same text here", "same text here", "other words"], ids=[4, 4, None, 4])
    assert simhash.near_duplicate_classes(docs).count() == 4
    left = sorted((str(r["doc_id"]), r["text"]) for r in simhash.drop_near_duplicates(docs).collect())
    assert left == [("4", "other words"), ("4", "same text here"), ("None", "same text here")]
    assert simhash.near_duplicate_classes(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_each(spark):
    a, near, b = "one two three four five six seven", "one two three four five six seven", "quite another text with other words in it"
    docs = table(spark, [a, near, b, b, b, "third kind of text"], ids=[3, 5, 5, 5, 9, 9])
    left = sorted((r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(docs).collect())
    assert left == [(3, a), (5, b), (9, "third kind of text")]


def test_chains_lose_no_link():
    rng = np.random.default_rng(3)
    for _ in range(2000):
        a = int(rng.integers(1 << 63)) * 2 + 1
        b = a
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b ^= 1 << int(bit)
        x = np.array([a ^ b], np.uint64)
        assert any(not int(x[0]) & mask and len(simhash.within_chain(x, first)) for first, mask in simhash.KEYS)


def test_large_buckets_are_cut_without_loss(monkeypatch):
    rng = np.random.default_rng(4)
    first, mask = simhash.KEYS[7]
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    values = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40, np.uint64)) for _ in range(12)]) & np.uint64(~mask & (1 << 64) - 1))
    slow = classes([int(v) for v in values], range(len(values)))
    monkeypatch.setattr(simhash, "_LARGE", 16)
    monkeypatch.setattr(simhash, "within_chain", lambda x, _: np.flatnonzero(np.bitwise_count(x) <= 4))
    label = {int(v): i for i, v in enumerate(values)}
    links = [(label[a], label[b]) for a, b in simhash.bucket_links(values, first, mask)]
    parent = list(range(len(values)))
    for _ in range(len(values)):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert parent == slow


def test_components(spark, width):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


# --- suffix dedup -----------------------------------------------------------------------------------------------------------

def slow_repeats(rows):
    out = {}
    starts: dict[bytes, int] = {}
    far = 1 << 62
    for doc, text in rows:
        body = (text or "").encode()
        for x in range(len(body) - 49):
            starts[body[x:x + 50]] = min(starts.get(body[x:x + 50], far), far if doc is None else doc)
    for i, (doc, text) in enumerate(rows):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for x in range(len(body) - 49):
            if starts[body[x:x + 50]] < (far if doc is None else doc):
                gone[x:x + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(body, gone) if not g)
        out[i] = (doc, len(body), kept, sum(g and not p for g, p in zip(gone, b"\0" + gone)))
    return sorted(out.values(), key=repr)


@pytest.mark.parametrize("block_bytes", [1, 3000, 1 << 20])
def test_repeats_by_brute_force(spark, block_bytes):
    rng = random.Random(9)
    passage = " ".join(rng.choices(["alpha", "beta", "gamma", "é", "delta"], k=60))
    texts = [None, "", "x" * 49, "x" * 50, "x" * 120, "xy" * 100, passage, passage, passage[3:]]
    for _ in range(40):
        words = rng.choices([f"w{i}" for i in range(30)], k=rng.randint(1, 120))
        texts.append(" ".join(words) + (passage[rng.randint(0, 50):rng.randint(100, 300)] if rng.random() < 0.5 else "") + (rng.choice(texts[:9]) or "")[:80] if rng.random() < 0.9 else None)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3] = ids[4] = 500
    ids[7] = None
    docs = table(spark, texts, ids).repartition(3)
    got = remove_repeats(docs, block_bytes=block_bytes, range_bytes=2000).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["starts"])) for r in got), key=repr) == slow_repeats(list(zip(ids, texts)))


def test_repeats_of_nothing(spark):
    assert remove_repeats(table(spark, [])).count() == 0


def test_multikey_sort():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(5)]
    rows = list(zip(*[w.tolist() for w in words]))
    number = equal_classes(words)
    assert len(set(number.tolist())) == len(set(rows)) == len({(r, n) for r, n in zip(rows, number.tolist())})


# --- pipeline ---------------------------------------------------------------------------------------------------------------

@needs_tables
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == [*docs.columns, "copies"]
    ids = [r["doc_id"] for r in rows.collect()]
    assert len(ids) == len(set(ids)) > 20
    junk = spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 0")
    assert not {r["doc_id"] for r in junk.collect()} & set(ids)


def test_word_numbers():
    long = "w" * 70
    texts = ["", None, "  The END, (of) it! ", "... !!", f"ÉTÉ\u00a0straße\u2003{long} {long}x\tof 12345678 123456789", "the end"]
    flat, ends = number_texts(pa.array(["cut off", *texts], pa.string()).slice(1))
    own = [[w for w in (x.strip(".,!()") for x in (t or "").lower().split()) if w] for t in texts]
    assert [plain_words(t or "") for t in texts] == own
    assert ends.tolist() == np.cumsum([len(w) for w in own]).tolist()
    words = [w for part in own for w in part]
    assert flat.tolist() == number_words(words) and 0 not in flat
    assert len(set(flat.tolist())) == len(set(words))
    assert number_texts(pa.array([], pa.string()))[0].size == 0


def test_corpus_product_by_brute_force():
    """Sums of unit rows by their products; the large matrix is written to once a call, not once a group of passages."""
    de = decontaminate

    class Counted(np.ndarray):
        writes = 0

        def __setitem__(self, key, value):
            Counted.writes += 1
            super().__setitem__(key, value)

    rng = np.random.default_rng(3)
    flat, starts = rng.integers(0, 400, 3000).astype(np.uint16), np.arange(0, 3000, 30).astype(np.int32)
    idf, basis = rng.random(de.SLOTS).astype(np.float32) + 1, rng.standard_normal((de.SLOTS, 5)).astype(np.float32)
    rows = np.zeros((100, de.SLOTS))
    np.add.at(rows, (np.arange(3000) // 30, flat), idf[flat])
    rows /= np.sqrt((idf[flat].reshape(100, 30).astype(float) ** 2).sum(axis=1))[:, None]
    out = np.ones((de.SLOTS, 5)).view(Counted)
    de._gram(flat, starts, idf, basis, out)
    assert np.abs(np.asarray(out) - 1 - rows.T @ (rows @ basis)).max() < 1e-4 and Counted.writes <= 1
