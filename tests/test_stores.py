"""The log of batches that count once, and the table of replies."""

import pytest
from pyspark.sql import functions as F

from lendgrid.operators import answers as an
from lendgrid.operators.replies import ReplyStore
from lendgrid.sources.keyed_store import KeyedStore
from lendgrid.sources.schemas import LOG_SCHEMA
from lendgrid.sources.score_log import summarize_log
from lendgrid.streaming.log_store import LogStore, known_only, start_log_store
from lendgrid.streaming.score_log import stream_log


def entries(spark, ids):
    rows = [(f"2024-01-0{1 + i % 5}T00:00:00+00:00", i, i / 10, 0.5, "alto_riesgo" if i >= 5 else "riesgo_aceptable") for i in ids]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def ids_of(log):
    return sorted(r["sk_id_curr"] for r in log.collect())


def test_a_batch_counts_once(spark, tmp_path):
    store = LogStore(spark, str(tmp_path))
    assert store.read().count() == 0 and store.batches().count() == 0
    assert store.append("a", 0, entries(spark, [1, 2]))
    assert not store.append("a", 0, entries(spark, [1, 2]))
    assert store.append("b", 0, entries(spark, [1]))  # another source has its own numbers
    assert ids_of(store.read()) == [1, 1, 2]
    assert store.append("a", 1, entries(spark, []))
    assert ids_of(store.read()) == [1, 1, 2]


def test_a_batch_that_fails_before_its_entry_is_not_read(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path))
    monkeypatch.setattr(LogStore, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.append("a", 0, entries(spark, [1, 2]))
    assert store.read().count() == 0
    monkeypatch.undo()
    assert store.append("a", 0, entries(spark, [1, 2]))
    assert ids_of(store.read()) == [1, 2]


def test_a_stream_that_fails_and_runs_again(spark, tmp_path, monkeypatch):
    incoming, state = str(tmp_path / "in"), str(tmp_path / "state")
    entries(spark, range(10)).repartition(4).write.json(incoming)
    store = LogStore(spark, str(tmp_path / "log"))
    known = spark.range(3, 100).select(F.col("id").alias("sk_id_curr"))
    commit = LogStore._commit

    def written_but_lost(self, *entry):
        commit(self, *entry)
        raise OSError("lost after the entry")

    stream = known_only(stream_log(spark, incoming, files_per_batch=2), known)
    monkeypatch.setattr(LogStore, "_commit", written_but_lost)
    with pytest.raises(Exception):
        start_log_store(stream, store, "s", state).awaitTermination()
    monkeypatch.undo()
    start_log_store(stream, store, "s", state).awaitTermination()  # sends the failed batch again
    assert ids_of(store.read()) == list(range(3, 10))
    assert {r["decision"]: r["n"] for r in summarize_log(store.read()).collect()} == {"alto_riesgo": 5, "riesgo_aceptable": 2}
    assert store.batches().agg(F.sum("n")).first()[0] == 7


def counting(folder):
    """A model that leaves a file per prompt it is asked."""
    def model(prompts):
        import os
        import uuid

        for p in prompts:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(p)
        return [p.upper() for p in prompts]

    return model


def test_each_prompt_is_asked_once_across_runs(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    store = ReplyStore(KeyedStore(spark, str(tmp_path / "replies"), "digest"), "upper")
    rows = [(i, None if i % 50 == 49 else "hot" if i % 3 else f"p{i % 30}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, prompt string").repartition(7)
    for part in (df.where("id < 100"), df, df):
        got = {r["id"]: r["reply"] for r in store.ask(part, "prompt", counting(str(seen)), "reply").collect()}
    assert got == {i: p and p.upper() for i, p in rows}
    assert sorted(f.read_text() for f in seen.iterdir()) == sorted({p for _, p in rows if p})
    other = ReplyStore(store.table, "other")
    again = other.ask(df.where("prompt = 'hot'"), "prompt", lambda ps: ["x"] * len(ps), "reply")  # another model's reply to the same prompt
    assert {r["reply"] for r in again.collect()} == {"x"}
    nothing = store.ask(df.where("id < 0"), "prompt", counting(str(seen)), "reply")
    assert nothing.columns == ["id", "prompt", "reply"] and nothing.count() == 0


def test_answers_with_kept_replies(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()
    queries = spark.createDataFrame([(1, "a?"), (2, "b?")], "query_id long, query string")
    found = spark.createDataFrame([(1, 1, "c1", "T", "text")], "query_id long, rank int, chunk_id string, title string, text string")
    store = ReplyStore(KeyedStore(spark, str(tmp_path / "replies"), "digest"), "chat")
    runs = [sorted(map(tuple, an.answer_questions(queries, found, counting(str(seen)), replies=store).select("query_id", "answer").collect())) for _ in range(2)]
    plain = an.answer_questions(queries, found, counting(str(tmp_path / "seen")))
    assert runs[0] == runs[1] == sorted(map(tuple, plain.select("query_id", "answer").collect()))
    assert len(list(seen.iterdir())) == 4  # two for the stored runs, two for the plain one


@pytest.mark.parametrize("frequent", [1, 1000])
def test_lookup_is_a_left_join(spark, monkeypatch, frequent):
    from lendgrid.operators import lookup as lk

    monkeypatch.setattr(lk, "FREQUENT", frequent)  # 1: no key is frequent
    rows = [(i, None if i % 11 == 0 else "hot" if i % 2 else f"k{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "id long, k string")
    table = spark.createDataFrame([("hot", 1), ("k2", 2), ("k4", None), ("unused", 3)], "k string, v int")
    got = sorted(map(tuple, lk.lookup(df, "k", table).collect()))
    assert got == [(i, k, {"hot": 1, "k2": 2}.get(k)) for i, k in rows]
    assert lk.lookup(df.where("id < 0"), "k", table).count() == 0


def test_each_policy_question_is_searched_once(spark):
    from lendgrid.plans.retrieval import policy_citations

    asked = spark.createDataFrame([(i, None if i == 7 else "nothing" if i == 8 else "why?" if i % 2 else "what?") for i in range(1, 12)], "sk_id_curr long, query string")
    searched = []

    def search(queries):
        searched.extend(r["query"] for r in queries.collect())
        hit = queries.where("query <> 'nothing'")
        return hit.select("query_id", F.explode(F.array(F.lit(2), F.lit(1))).alias("rank"), "query").select(
            "query_id", "rank", F.concat(F.lit("c"), "rank").alias("chunk_id"), F.col("query").alias("title"), F.lit("text").alias("text"))

    out = {r["sk_id_curr"]: [(c["doc_title"], c["chunk_id"]) for c in r["citations"]] for r in policy_citations(asked, search).collect()}
    assert sorted(searched) == ["nothing", "what?", "why?"]
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 9, 10, 11]
    assert out[1] == [("why?", "c1"), ("why?", "c2")] and out[2][0] == ("what?", "c1")
