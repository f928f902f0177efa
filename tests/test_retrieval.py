import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.functions.texts import snippet, strip_fences, tokens, words
from lendgrid.operators import answers as an, fusion as fu, keyword as kw, vector_index as vi, vectors as ve
from lendgrid.operators.batches import apply_in_batches
from lendgrid.operators.chunks import chunk_documents
from lendgrid.plans.retrieval import retrieve
from lendgrid.sources import tables
from lendgrid.sources.keyed_store import KeyedStore
from lendgrid.sources.corpus import scan_corpus


def documents(spark, texts):
    return spark.createDataFrame([(f"doc-{i}", f"T{i}", t) for i, t in enumerate(texts)], "doc_id string, title string, text string")


def test_chunks_overlap(spark):
    text = " ".join(f"w{i}" for i in range(250))
    rows = chunk_documents(documents(spark, [text, "  short\ttext\n kept "]), 100, 20).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == ["doc-0::0", "doc-0::1", "doc-0::2", "doc-1::0"]
    parts = [r.text.split() for r in rows[:3]]
    assert [len(p) for p in parts] == [100, 100, 90] and parts[0][-20:] == parts[1][:20] and parts[1][-20:] == parts[2][:20]
    assert rows[3].text == "  short\ttext\n kept " and rows[3].title == "T1"
    with pytest.raises(ValueError):
        chunk_documents(documents(spark, ["x"]), 10, 10)


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 17, 18, 19, 40])
def test_chunk_windows_match_the_definition(spark, n):
    text, (size, overlap) = " ".join(str(i) for i in range(n)), (10, 3)
    expected, w = [], text.split()
    if len(w) <= size:
        expected = [text]
    else:
        start = 0
        while True:
            expected.append(" ".join(w[start:start + size]))
            if start + size >= len(w):
                break
            start += size - overlap
    assert [r.text for r in chunk_documents(documents(spark, [text]), size, overlap).orderBy("chunk_no").collect()] == expected


def test_words_and_tokens_follow_unicode(spark):
    text = "Género_1, ÑANDÚ x y\x1cz  ²½ 東京\n«ça»"
    row = spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t")).alias("t"), words(F.col("t")).alias("w")).first()
    assert row.t == re.findall(r"\w+", text.lower()) and row.w == text.split()


def test_corpus(spark, tmp_path):
    (tmp_path / "b.md").write_text("# Second title\n\nbody two\nmore\n")
    (tmp_path / "a.md").write_text("\n## First\nbody one")
    (tmp_path / "c.txt").write_text("# Not me\n\nx")
    rows = sorted(tuple(r) for r in scan_corpus(spark, str(tmp_path)).collect())
    assert rows == [("a", "First", "body one"), ("b", "Second title", "body two\nmore")]


def test_chunk_store(spark, tmp_path):
    chunks = chunk_documents(documents(spark, ["one", "two"]))
    tables.write_chunks(chunks, str(tmp_path / "store"))
    assert tables.read_chunks(spark, str(tmp_path / "store")).count() == 2
    (tmp_path / "chunks.json").write_text('[{"doc_id": "d", "chunk_id": "d::0", "title": "t", "text": "é"}]')
    assert tuple(tables.read_chunks(spark, str(tmp_path / "chunks.json"), as_json=True).first()) == ("d", "d::0", "t", "é")


def okapi(chunks, query, k1=1.5, b=0.75, eps=0.25):
    docs = [re.findall(r"\w+", t.lower()) for t in chunks]
    n, average = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = eps * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    out = []
    for d in docs:
        tf = Counter(d)
        out.append(sum(idf.get(q, 0) * tf[q] * (k1 + 1) / (tf[q] + k1 * (1 - b + b * len(d) / average))
                       for q in re.findall(r"\w+", query.lower())))
    return out


def check_search(spark, texts, queries, top_k, **options):
    chunks = chunk_documents(documents(spark, texts).withColumn("doc_id", F.lpad("doc_id", 12, " ")))
    index = kw.build_index(chunks)
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, query string")
    got = {}
    for r in kw.search(index, asked, top_k).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (int(r.chunk_id.strip().split("-")[1].split("::")[0]), r.score)
    for i, q in enumerate(queries):
        scores = okapi(texts, q)
        order = sorted(range(len(texts)), key=lambda j: (-round(scores[j], 9), f"doc-{j}".rjust(12)))[:top_k]
        assert [got[i][r][0] for r in sorted(got[i])] == order, q
        assert [got[i][r][1] for r in sorted(got[i])] == pytest.approx([scores[j] for j in order], abs=1e-9)


def random_texts(seed, n, vocabulary, length):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(vocabulary, size=rng.integers(1, length))) for _ in range(n)]


def test_keyword_search_matches_okapi(spark, width):
    vocabulary = [f"t{i}" for i in range(40)]
    texts = random_texts(1, 60, vocabulary, 12)
    check_search(spark, texts, ["t1 t2 t2 t39", "t5", "nothing here", "t0 t1 t3 t4 t5 t6 t7", ""], 10)


def test_keyword_search_with_negative_scores(spark):
    # every term is in most chunks, so the mean idf and the scores are negative
    texts = ["a b c"] * 30 + ["a b"] * 5 + ["z"] * 2 + ["a c b c"] * 20
    check_search(spark, texts, ["a b", "z a", "c", "q"], 4)


def test_small_segments_and_query_blocks(spark, width):
    vocabulary = [f"t{i}" for i in range(15)]
    texts = ["the " + t if i % 9 else "" for i, t in enumerate(random_texts(4, 70, vocabulary, 14))]
    chunks = chunk_documents(documents(spark, texts).withColumn("doc_id", F.lpad("doc_id", 12, " ")))
    index = kw.build_index(chunks, segment_tokens=60)
    assert index.segments.count() > 4
    queries = ["the t1 t2", "the t3 t3 t4 nothing", "the", "t5 t6 t7 t8 t9", "", "zzz"]
    asked = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(queries)], "query_id string, query string")
    rows = kw.search(index, asked, 5, query_block=2).collect()
    for i, q in enumerate(queries):
        scores = okapi(texts, q)
        order = sorted(range(len(texts)), key=lambda j: (-round(scores[j], 9), f"doc-{j}".rjust(12)))[:5]
        mine = sorted((r for r in rows if r.query_id == f"q{i}"), key=lambda r: r["rank"])
        assert [int(r.chunk_id.strip().split("-")[1].split("::")[0]) for r in mine] == order
        assert [r.score for r in mine] == pytest.approx([scores[j] for j in order], abs=1e-9)


def test_stop_words_are_not_scored(spark):
    """A word of all chunks in all queries: its postings are skipped once better chunks are known, and the best stay the same."""
    rng = np.random.default_rng(2)
    texts = ["the " * int(rng.integers(1, 4)) + " ".join(f"w{x}" for x in rng.integers(0, 3000, 12)) for _ in range(6000)]
    index = kw.build_index(chunk_documents(documents(spark, texts)), segment_tokens=20_000)
    opened = [kw._Opened(b, i) for b in index.segments.coalesce(1).toArrow().to_batches() for i in range(b.num_rows)]
    idf = {r.term: r.idf for r in index.terms.collect()}
    for query in ("the w2 w3 w77", "the w1 w5", "the the w1999"):
        words = [w for w in sorted(set(query.split())) if w in idf]
        weight = np.array([query.split().count(w) * idf[w] for w in words])

        def run(pruned):
            held, counts = np.empty(0), kw.Counts()
            for s in opened:
                at = np.array([s.terms.to_pylist().index(w) if w in s.terms.to_pylist() else -1 for w in words])
                least = held[4] if pruned and len(held) == 5 else -np.inf
                _, score = kw.segment_top(s, at[at >= 0], weight[at >= 0], 5, least, index.average_length, 1.5, 0.75, counts)
                held = np.sort(np.concatenate([held, score]))[::-1][:5]
            return held, counts

        (best, few), (all_best, every) = run(True), run(False)
        assert list(best) == list(all_best) and few.scored < 0.1 * every.scored


def test_index_of_nothing(spark):
    none = kw.build_index(chunk_documents(documents(spark, [])))
    asked = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert kw.search(none, asked, 3).collect() == [] and none.average_length == 0.0
    some = kw.build_index(chunk_documents(documents(spark, ["a b", "c"])))
    assert kw.search(some, asked.limit(0), 3).collect() == []
    assert Counter(tuple(r) for r in kw.postings(some).collect()) == Counter([("doc-0", 0, 2, "a", 1), ("doc-0", 0, 2, "b", 1), ("doc-1", 0, 1, "c", 1)])


def test_spanish_question(spark):
    texts = ["Se comunican hasta cuatro reason codes al solicitante", "El capital minimo se calcula por riesgo", "La politica define plazos de archivo"]
    index = kw.build_index(chunk_documents(documents(spark, texts)))
    asked = spark.createDataFrame([(1, "cuantos reason codes se comunican"), (2, "xyz")], "query_id long, query string")
    rows = kw.search(index, asked, 3).collect()
    assert {r.query_id: r.chunk_id for r in rows if r["rank"] == 1} == {1: "doc-0::0", 2: "doc-0::0"}
    assert Counter(r.query_id for r in rows) == {1: 3, 2: 3}  # no overlap still gives three


def vectors(spark, matrix, name="item_id"):
    return spark.createDataFrame([(f"i{i}", [float(v) for v in r]) for i, r in enumerate(matrix)], f"{name} string, vector array<double>")


def test_cosine_small(spark):
    got = ve.cosine_top_k(vectors(spark, [(1, 0, 0), (0, 1, 0), (0.9, 0.1, 0)]), vectors(spark, [(1, 0, 0)], "query_id"), 2).orderBy("rank").collect()
    assert [r.item_id for r in got] == ["i0", "i2"]


@pytest.mark.parametrize("budget", [4_000_000, 20])
def test_cosine_matches_brute_force_with_copies(spark, width, budget, monkeypatch):
    monkeypatch.setattr(ve, "VECTOR_BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4))
    x[::3] = x[0]  # a third of the rows are copies
    x[7] = 0
    q = rng.normal(size=(12, 4))
    got = {}
    for r in ve.cosine_top_k(vectors(spark, x), vectors(spark, q, "query_id"), 5, broadcast_numbers=budget).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.item_id
    norms = np.linalg.norm(x, axis=1)
    for j in range(12):
        scores = np.round(x @ q[j] / np.where(norms == 0, 1, norms) / np.linalg.norm(q[j]), 9)
        order = sorted(range(150), key=lambda i: (-scores[i], f"i{i}"))[:5]
        assert [got[f"i{j}"][r] for r in range(1, 6)] == [f"i{i}" for i in order]


def test_upsert_last_write_wins(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    incoming = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "id string, v int, o int")
    assert sorted(tuple(r) for r in ve.upsert(stored, incoming, "id", "o").collect()) == [("a", 1), ("b", 4), ("c", 5)]


def rankings(spark, *lists):
    rows = [(0, n, item, r + 1) for n, items in enumerate(lists) for r, item in enumerate(items)]
    return spark.createDataFrame(rows, "query_id long, list_no int, item_id string, rank int")


def test_rank_fusion(spark):
    fused = fu.reciprocal_rank_fusion(rankings(spark, ["a", "b", "c"], ["a", "c", "b", "d"])).orderBy("rank").collect()
    assert [r.item_id for r in fused] == ["a", "b", "c", "d"]  # b and c tie: b was met first
    assert fused[0].score == pytest.approx(2 / 61) and fused[3].score == pytest.approx(1 / 64)
    assert fu.reciprocal_rank_fusion(rankings(spark, ["a"]).limit(0)).count() == 0
    gap = [r.score for r in fu.reciprocal_rank_fusion(rankings(spark, ["a", "b"]), k=1).orderBy("rank").collect()]
    assert gap == [0.5, pytest.approx(1 / 3)]


def test_reorder(spark):
    fused = fu.reciprocal_rank_fusion(rankings(spark, ["d1::0", "d1::1", "d2::0", "d3::0"]))
    reply = '```json\n{"ranked_chunk_ids": ["d1::1", "ghost", "d2::0"]}\n```'
    given = fu.parse_ranking(spark.createDataFrame([(0, reply)], "query_id long, reply string"))
    assert [r.item_id for r in fu.reorder(fused, given, 3).orderBy("rank").collect()] == ["d1::1", "d2::0", "d1::0"]


@pytest.mark.parametrize("reply", ["no json", '{"other": []}', '["a"]', '{"ranked_chunk_ids": ["a"]', '{"ranked_chunk_ids": ["a"]} tail'])
def test_malformed_replies(spark, reply):
    df = spark.createDataFrame([(0, reply)], "query_id long, reply string")
    assert fu.parse_ranking(df, strict=False).count() == 0
    with pytest.raises(Exception, match="ranked_chunk_ids"):
        fu.parse_ranking(df).collect()


def test_fences(spark):
    texts = ["```json\n{1}\n```", "``` {2} ```", "x ```{3}``` y ```{4}```", "{5}", "``` open"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(strip_fences(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == ["{1}", "{2}", "{3}", "{5}", "``` open"]


def test_snippet(spark):
    texts = ["x" * 200, "y" * 198 + "  " + "z", "w" * 201]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(snippet(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == ["x" * 200, "y" * 198 + "...", "w" * 200 + "..."]


def test_batches_and_answers(spark):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(23)], "query_id long, query string")
    sizes = apply_in_batches(df.coalesce(1), "query", lambda part: [len(part)] * len(part), "n", "int", batch=10)
    assert Counter(r.n for r in sizes.collect()) == {10: 20, 3: 3} and df.columns == ["query_id", "query"]
    with pytest.raises(Exception, match="values in"):
        apply_in_batches(df, "query", lambda part: [], "n", "int").collect()
    found = spark.createDataFrame(
        [(0, 2, "b::0", "B", "second"), (0, 1, "a::0", "A", "first")], "query_id long, rank int, chunk_id string, title string, text string")
    assert an.ground(found).first().context == "[A] (id=a::0)\nfirst\n\n[B] (id=b::0)\nsecond"
    out = {r.query_id: r for r in an.answer_questions(df, found, lambda prompts: [p.upper() for p in prompts]).collect()}
    assert len(out) == 23 and [c.chunk_id for c in out[0].citations] == ["a::0", "b::0"] and out[5].citations == []
    assert out[0].answer.endswith("PREGUNTA: Q0") and "FIRST" in out[0].answer


def test_retrieve_end_to_end(spark):
    texts = ["credit policy rules", "capital requirements for risk", "adverse action notice", "archive periods"]
    chunks = chunk_documents(documents(spark, texts))
    letters = lambda part: [[float(t.count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in part]
    asked = spark.createDataFrame([(1, "adverse action"), (2, "capital risk")], "query_id long, query string")
    vec = apply_in_batches(chunks, "text", letters, "vector", "array<double>").select(F.col("chunk_id").alias("item_id"), "vector")
    qvec = apply_in_batches(asked, "query", letters, "vector", "array<double>").select("query_id", "vector")
    rows = retrieve(asked, qvec, vec, kw.build_index(chunks), top_k=2).collect()
    assert {r.query_id: r.chunk_id for r in rows if r["rank"] == 1} == {1: "doc-2::0", 2: "doc-1::0"} and len(rows) == 4


def test_tiles_give_the_same_top_rows(monkeypatch):
    rng = np.random.default_rng(5)
    x, q = rng.integers(-2, 3, (60, 3)).astype(float), rng.integers(-2, 3, (9, 3)).astype(float)  # many equal scores
    whole = ve._block_top(np.arange(60), x, np.arange(9), q, 4)
    monkeypatch.setattr(ve, "TILE_ROWS", 7)
    monkeypatch.setattr(ve, "TILE_QUERIES", 2)
    tiled = ve._block_top(np.arange(60), x, np.arange(9), q, 4)
    assert whole.reset_index(drop=True).equals(tiled.reset_index(drop=True))


@pytest.mark.parametrize("shape", ["clusters", "copies", "one"])
def test_cells_find_what_brute_force_finds(spark, width, shape):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    x = {"clusters": np.concatenate([c + 0.05 * rng.normal(size=(80, 8)) for c in centres] + [np.zeros((3, 8))]),
         "copies": np.concatenate([np.tile(centres[0], (200, 1)), rng.normal(size=(60, 8))]), "one": centres[:1]}[shape]
    q = np.concatenate([centres[:4] + 0.01, rng.normal(size=(3, 8)), np.zeros((1, 8))])
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item_id long, vector array<double>")
    asked = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(q)], "query_id string, vector array<double>")
    index = vi.build_vector_index(items)
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    scores = np.round(unit(q) @ unit(x).T, 9)
    for numbers in (16, 4_000_000):
        found, share = vi.search_cells(index, asked, 6, query_numbers=numbers)
        got = {(r.query_id, r["rank"]): (r.item_id, r.score) for r in found.collect()}
        for i in range(len(q)):
            order = sorted(range(len(x)), key=lambda j: (-scores[i, j], j))[:6]
            assert [got[f"q{i}", r + 1][1] for r in range(len(order))] == pytest.approx([scores[i, j] for j in order], abs=1e-8)
            if shape != "copies":
                assert [got[f"q{i}", r + 1][0] for r in range(len(order))] == order or len(set(scores[i, order])) < len(order)
        assert 0 < share <= 1
    if shape == "clusters":
        near, share = vi.search_cells(index, asked.where("query_id < 'q4'"), 6)
        assert near.count() == 24 and share < 0.5


def test_cells_of_nothing(spark):
    none = vi.build_vector_index(spark.createDataFrame([], "item_id long, vector array<double>"))
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    assert vi.search_cells(none, asked, 3)[0].collect() == []
    some = vi.build_vector_index(spark.createDataFrame([(1, [1.0, 0.0])], "item_id long, vector array<double>"))
    assert vi.search_cells(some, asked.limit(0), 3)[0].collect() == []
    assert [tuple(r) for r in vi.search_cells(some, asked, 3)[0].collect()] == [(1, 1, 1, 1.0)]


def test_keyed_store(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), "id")
    frame_of = lambda rows: spark.createDataFrame(rows, "id long, vector array<double>, at int")
    rows = lambda: {r.id: r.vector[0] for r in store.read().collect()}
    with pytest.raises(ValueError):
        store.read()
    assert store.write("a", frame_of([(1, [1.0], 0), (2, [2.0], 0), (None, [9.0], 0), (2, [2.5], 1)]), "at")
    assert rows() == {1: 1.0, 2: 2.5}
    assert store.write("b", frame_of([(2, [20.0], 0), (3, [30.0], 0)]), "at")
    before = sorted(p.name for p in (tmp_path / "store").iterdir())
    assert not store.write("a", frame_of([(1, [-1.0], 0)]), "at")  # the batch is known: nothing changes
    assert rows() == {1: 1.0, 2: 20.0, 3: 30.0} and sorted(p.name for p in (tmp_path / "store").iterdir()) == before
    frame_of([(1, [77.0], 0)]).drop("at").write.parquet(str(tmp_path / "store" / "delta-half"))  # a batch that failed before its entry
    store.compact()
    assert rows() == {1: 1.0, 2: 20.0, 3: 30.0} and len(store._live()) == 1
    assert store.write("c", frame_of([(3, [31.0], 0)]), "at") and rows() == {1: 1.0, 2: 20.0, 3: 31.0}
    with pytest.raises(Exception):
        store._commit(2, "late", "x", False)  # a version is made once


def test_files_of_documents_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    from lendgrid.catalog import QUERIES, text_queries

    rows = [(i, None if i == 3 else f"text {i % 20}", "en", "web", 7) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(text_queries, "_scratch", lambda spark, name: str(tmp_path / name))
    found = QUERIES["io7_corpus"](spark, str(tmp_path)).collect()
    assert sorted((r.title, r.text) for r in found if r.text) == sorted((f"Doc {i}", t) for i, t, *_ in rows if t)
    names = [p.name for p in (tmp_path / "corpus").glob("part-*")]
    assert len(names) == 40 and len({n[:10] for n in names}) > 1


def test_files_of_a_corpus_are_dealt_out_and_read_as_spark_reads_them(spark, tmp_path, monkeypatch):
    from lendgrid.sources import corpus

    files = {"b c%20d.md": "# é\r\nñ".encode(), "bad.md": b"# q\xff\n\xfe\x00z", "bom.md": b"\xef\xbb\xbf# bom\nt", "nl.md": b"\n", "q　[1]#?.md": b"a", "_a=b.md": b"p",
             "empty.md": b"", "_h.md": b"h", ".h.md": b"h", "x.txt": b"t", "n.MD": b"t", "z._COPYING_": b"1"} | {f"{i}.md": b"# n\ntext %d" % i for i in range(300)}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "sub.md").mkdir()
    (tmp_path / "sub.md" / "i.md").write_text("not direct")
    read = lambda pattern: sorted(map(tuple, scan_corpus(spark, f"file://{tmp_path}", pattern).collect()))
    # a task per core, however few files Spark would put into one of its own
    assert scan_corpus(spark, str(tmp_path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    found = {p: read(p) for p in ("*.md", "*.txt", "n*", "*.none")}
    monkeypatch.setattr(corpus, "mounted_folder", lambda spark, path: None)  # as if only Spark could open it
    assert found == {p: read(p) for p in found} and len(found["*.md"]) == 306
    monkeypatch.undo()
    (tmp_path / "parts" / "k=1").mkdir(parents=True)
    (tmp_path / "parts" / "k=1" / "i.md").write_text("in a partition")
    assert [r.title for r in scan_corpus(spark, str(tmp_path / "parts")).collect()] == ["in a partition"]


def test_a_corpus_is_a_file_for_each_text_and_nothing_else(spark, tmp_path):
    from lendgrid.sources.corpus import write_corpus

    texts = ["# a\nb", None, "", "same", "same", "é\x00"]
    write_corpus(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(2), f"file:{tmp_path}/corpus")
    own = [p for p in (tmp_path / "corpus").iterdir() if p.is_file()]  # no checksum files beside them
    assert sorted(p.read_bytes() for p in own) == sorted((t or "").encode() + b"\n" for t in texts)
    assert not any(p.is_file() for p in (tmp_path / "corpus" / "_temporary").rglob("*"))
    with pytest.raises(FileExistsError):
        write_corpus(spark.createDataFrame([("x",)], "value string"), str(tmp_path / "corpus"))


def test_segments_are_read_one_at_a_time(spark, tmp_path):
    import pyarrow.parquet as pq

    chunks = spark.range(200, numPartitions=2).selectExpr("CAST(id AS STRING) AS doc_id", "0 AS chunk_no", "concat('a b c ', id) AS text")
    kw.build_index(chunks, folder=str(tmp_path), segment_tokens=40)
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "segments").glob("*.parquet")]
    # Spark's reader takes up to 4096 rows of a row group together, so a file's segments must not share one
    assert sum(f.num_rows for f in files) == 20 and all(f.num_row_groups == f.num_rows > 1 for f in files)
