import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrid.functions.texts import float_text
from lendgrid.operators import drift as dr, review as rv
from lendgrid.sources.score_log import append_log, log_entries, read_log, summarize_log
from lendgrid.operators.scoring import lookup_scores
from lendgrid.streaming import score_log as stream


def issues(spark, memo, decision="riesgo_aceptable", reasons=(), citations=(), whole_word=False):
    df = spark.createDataFrame([(memo, decision, list(reasons), list(citations))], "m string, d string, r array<string>, c array<string>")
    return df.select(rv.precheck(F.col("m"), F.col("d"), F.col("r"), F.col("c"), whole_word).alias("i")).first().i


def test_precheck(spark):
    assert issues(spark, "Memo claro.", "alto_riesgo", ["a"], ["c"]) == []
    assert issues(spark, "  \n") == ["memo vacio"]
    assert issues(spark, "x", reasons="abcde") == ["mas de 4 reason codes"]
    assert issues(spark, "x", "alto_riesgo") == ["decision de alto riesgo sin cita de politica"]
    assert issues(spark, "Por su EDAD y género") == ["memo menciona atributo protegido: género, edad"]
    assert len(issues(spark, "", "alto_riesgo", "abcde")) == 3


def test_protected_words_as_substring_or_word(spark):
    assert issues(spark, "Antiguedad laboral") == ["memo menciona atributo protegido: edad"]
    assert issues(spark, "Antiguedad laboral, trazado", whole_word=True) == []
    assert issues(spark, "la edad.", whole_word=True) == ["memo menciona atributo protegido: edad"]


@pytest.mark.parametrize("reply,expected", [
    ('{"approved": true, "feedback": "ok"}', (True, "ok")),
    ('```json\n{"approved": false, "feedback": "x"}\n```', (False, "x")),
    ('{"approved": "false", "feedback": "x"}', None), ('{"approved": true}', None), ("garbage", None),
])
def test_verdicts(spark, reply, expected):
    v = spark.createDataFrame([(reply,)], "r string").select(rv.parse_verdict(F.col("r")).alias("v")).first().v
    assert (None if v is None else tuple(v)) == expected


CITATION = "struct<doc_title:string,chunk_id:string,snippet:string>"


def evidence(spark):
    records = spark.createDataFrame(
        [(1, 0.9, 0.5, "alto_riesgo"), (2, 0.1, 0.5, "riesgo_aceptable"), (3, 0.8, 0.5, "alto_riesgo"), (4, 0.7, 0.5, "alto_riesgo")],
        "sk_id_curr long, probability double, threshold double, decision string")
    reasons = spark.createDataFrame([(i, [f"razon {i}"]) for i in (1, 2, 3, 4)], "sk_id_curr long, reason_codes array<string>")
    citations = spark.createDataFrame([(i, [("T", "t::0", f"s{i}")]) for i in (1, 2, 3)], f"sk_id_curr long, citations array<{CITATION}>")
    return rv.gather_evidence(records, reasons, citations)


def test_evidence_and_memo_input(spark):
    rows = {r.sk_id_curr: r for r in evidence(spark).withColumn("t", rv.memo_input()).collect()}
    assert rows[2].reason_codes == [] and rows[2].citations == [] and len(rows[1].citations) == 1
    assert rows[1].t == ("Score: sk_id_curr=1, probability=0.9, threshold=0.5, decision=alto_riesgo\n\n"
                         "Reason codes:\n- razon 1\n\nCitas de politica:\n- [T] s1")
    assert rows[2].t.endswith("Reason codes:\n(sin reason codes: riesgo aceptable)\n\nCitas de politica:\n(sin citas de politica)")
    again = evidence(spark).select(rv.memo_input(F.lit("corregir")).alias("t")).first().t
    assert again.endswith("\n\nEsta es una revision. Feedback del evaluador anterior:\ncorregir")


def test_review_of_a_batch(spark):
    def draft(prompts):
        return ["memo bueno" if "decision=riesgo" in p or "revision" in p else "memo malo" for p in prompts]

    def judge(prompts):
        return [json.dumps({"approved": "memo bueno" in p and '"sk_id_curr":3' not in p, "feedback": "f"}) for p in prompts]

    rows = {r.sk_id_curr: r for r in rv.review_batch(evidence(spark), draft, judge).collect()}
    assert (rows[2].status, rows[2].iteration) == ("approved", 0)
    assert (rows[1].status, rows[1].iteration) == ("approved", 1)
    assert (rows[3].status, rows[3].iteration) == ("needs_human_review", 1)
    assert rows[4].status == "needs_human_review" and rows[4].evaluator_feedback == "decision de alto riesgo sin cita de politica"
    reviews = spark.createDataFrame([(r.iteration, r.status) for r in rows.values()], "iteration int, status string")
    assert rv.first_try_rate(reviews).first().first_try_rate == 0.25


def test_malformed_judge_reply_goes_to_a_person(spark):
    def judge(prompts):
        return ["?" if '"sk_id_curr":2' in p else json.dumps({"approved": True, "feedback": "f"}) for p in prompts]

    rows = {r.sk_id_curr: r for r in rv.review_batch(evidence(spark), lambda p: ["m"] * len(p), judge).collect()}
    assert (rows[2].status, rows[2].evaluator_feedback) == ("needs_human_review", "?")
    assert rows[1].status == "approved"


def test_usage(spark):
    calls = ['{"usage": {"prompt_tokens": 10, "completion_tokens": 5, "total_tokens": 15}}', '{"usage": {"prompt_tokens": 3, "total_tokens": 3}}', "{}"]
    df = spark.createDataFrame([("m", c) for c in calls], "model string, c string").select("model", rv.extract_usage(F.col("c")).alias("usage"))
    assert [tuple(r.usage) for r in df.collect()] == [(10, 5, 15), (3, None, 3), (None, None, None)]
    assert tuple(rv.usage_totals(df).first()) == ("m", 3, 13, 5, 18)


def test_judge_and_answer_quality(spark):
    cases = spark.createDataFrame([(True, True)] * 5 + [(False, False)] * 4 + [(False, True)], "human_approved boolean, predicted_approved boolean")
    r = rv.judge_quality(cases).first()
    assert (r.tp, r.tn, r.fp, r.fn, r.tpr, r.tnr, r.tpr_ok, r.tnr_ok) == (5, 4, 1, 0, 1.0, 0.8, True, False)
    only = rv.judge_quality(cases.where("human_approved")).first()
    assert only.tnr is None and not only.tnr_ok
    assert rv.mark_verdicts(cases).where("mark = 'MAL'").count() == 1
    q = rv.answer_quality(spark.createDataFrame([(0.95, 0.8), (0.9, 0.8)], "faithfulness double, relevancy double")).first()
    assert (q.faithfulness_ok, q.relevancy_ok) == (True, False)


def test_float_text_is_decimal(spark):
    values = [0.25, 0.001, 0.00052, 0.0001, 0.000012, 1e-05, -0.0003, 123456.5, 0.0, 1.5e-12]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(float_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(v) for v in values]


def psi(reference, current, labels):
    total = 0.0
    for label in labels:
        r, c = np.mean([x == label for x in reference]) or 1e-4, np.mean([x == label for x in current]) or 1e-4
        total += (r - c) * np.log(r / c)
    return total


def test_stability_index(spark, width):
    rng = np.random.default_rng(0)
    rows = [(bool(i < 500), float(rng.normal(0 if i < 500 else 1)), int(rng.integers(0, 3 if i < 500 else 4)),
             None if i % 5 == 0 else "ab"[i % 2], 7.0) for i in range(900)]
    df = spark.createDataFrame(rows, "ref boolean, x double, k int, s string, one double")
    got = {r.column: r.psi for r in dr.stability_index(df, ["x", "k", "s", "one"], F.col("ref")).collect()}
    xs = np.array([r[1] for r in rows])
    bins = np.clip(np.floor((xs - xs.min()) * 10 / (xs.max() - xs.min())), 0, 9)
    assert got["x"] == pytest.approx(psi(bins[:500], bins[500:], range(10)))
    assert got["k"] == pytest.approx(psi([r[2] for r in rows[:500]], [r[2] for r in rows[500:]], range(4)))
    assert got["s"] == pytest.approx(psi([r[3] for r in rows[:500] if r[3]], [r[3] for r in rows[500:] if r[3]], "ab"))
    assert got["one"] == pytest.approx(0)


def test_alerts_are_strict(spark):
    table = spark.createDataFrame([("a", 0.35), ("b", 0.05), ("c", 0.21), ("d", 0.2)], "column string, psi double")
    assert {r.column for r in dr.alert_columns(table).collect()} == {"a", "c"}
    report = dr.alert_report(table).first()
    assert (report.n_evaluated, report.n_alerts, [a.column for a in report.alerts]) == (4, 2, ["a", "c"])


RECORD = "sk_id_curr long, probability double, threshold double, decision string"


def test_log_appends_and_ignores_unknown_ids(spark, tmp_path):
    path = str(tmp_path / "log")
    records = spark.createDataFrame([(1, 0.9, 0.5, "alto_riesgo"), (2, 0.1, 0.5, "riesgo_aceptable")], RECORD)
    append_log(log_entries(records.where("sk_id_curr = 1"), "2024-01-01T00:00:00+00:00"), path)
    asked = spark.createDataFrame([(2,), (99,)], "sk_id_curr long")
    append_log(log_entries(lookup_scores(asked, records).where("found"), "2024-01-01T01:00:00+00:00"), path)
    log = read_log(spark, path)
    assert log.columns == ["timestamp", "sk_id_curr", "probability", "threshold", "decision"]
    assert sorted(r.sk_id_curr for r in log.collect()) == [1, 2]
    assert {r.decision: r.n for r in summarize_log(log).collect()} == {"alto_riesgo": 1, "riesgo_aceptable": 1}


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in range(1, 5):
        rows = [(f"2024-01-{day:02d}T{h:02d}:30:00+00:00", h, h / 24, 0.5, "alto_riesgo" if h >= 12 else "riesgo_aceptable") for h in range(24)]
        append_log(spark.createDataFrame(rows, "timestamp string, " + RECORD).coalesce(1), path)
    query = stream.start_summary(stream.stream_log(spark, path), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    streamed = {(str(r.window_start), r.decision): (r.n, r.mean_probability, r.high_risk_share) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {(str(r.window_start), r.decision): (r.n, r.mean_probability, r.high_risk_share) for r in stream.windowed_summary(read_log(spark, path)).collect()}
    closed = {k: v for k, v in batch.items() if not k[0].startswith("2024-01-04")}  # the last day is still open
    assert streamed == closed and len(batch) == 8
    copy = stream.start_log_sink(stream.stream_log(spark, path), str(tmp_path / "copy"), str(tmp_path / "state2"))
    copy.awaitTermination()
    assert read_log(spark, str(tmp_path / "copy")).count() == 96
