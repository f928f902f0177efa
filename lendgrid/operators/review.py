"""Credit memos: evidence, drafting input, checks, verdicts and the review of a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions import defaults as d
from lendgrid.functions.texts import float_text, strip_blank
from lendgrid.operators.batches import apply_in_batches
from lendgrid.operators.fusion import parse_reply
from lendgrid.session import cut_lineage

CITATION = "struct<doc_title:string,chunk_id:string,snippet:string>"


def gather_evidence(records: DataFrame, reasons: DataFrame, citations: DataFrame) -> DataFrame:
    """Score of every applicant; reasons and citations (arrays per id) for high risk only."""
    high = F.col("decision") == d.HIGH_RISK
    joined = records.join(reasons.select("sk_id_curr", "reason_codes"), "sk_id_curr", "left").join(
        citations.select("sk_id_curr", "citations"), "sk_id_curr", "left"
    )
    return joined.withColumns(
        {
            "reason_codes": F.coalesce(F.when(high, F.col("reason_codes")), F.array().cast("array<string>")),
            "citations": F.coalesce(F.when(high, F.col("citations")), F.array().cast(f"array<{CITATION}>")),
        }
    )


def _bullets(items: Column, placeholder: str) -> Column:
    lines = F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.when(F.size(items) > 0, lines).otherwise(F.lit(placeholder))


def memo_input(feedback: Column | None = None) -> Column:
    """Drafting text of an evidence row; a revision also carries the feedback."""
    quoted = F.transform("citations", lambda c: F.concat(F.lit("["), c["doc_title"], F.lit("] "), c["snippet"]))
    text = F.concat(
        F.lit("Score: sk_id_curr="), F.col("sk_id_curr").cast("string"),
        F.lit(", probability="), float_text(F.col("probability")), F.lit(", threshold="), float_text(F.col("threshold")),
        F.lit(", decision="), F.col("decision"),
        F.lit("\n\nReason codes:\n"), _bullets(F.col("reason_codes"), d.NO_REASONS),
        F.lit("\n\nCitas de politica:\n"), _bullets(quoted, d.NO_CITATIONS),
    )
    if feedback is None:
        return text
    note = F.concat(F.lit(f"\n\n{d.REVISION_NOTE}\n"), feedback)
    return F.concat(text, F.when(F.coalesce(feedback, F.lit("")) != "", note).otherwise(F.lit("")))


def protected_words(memo: Column, vocabulary: tuple[str, ...] = d.PROTECTED_WORDS, whole_word: bool = False) -> Column:
    """Protected words found in the memo, as substrings or as whole words."""
    text = F.lower(memo)
    found = [
        F.when(text.rlike(rf"(?<![\p{{L}}\p{{N}}_]){w}(?![\p{{L}}\p{{N}}_])") if whole_word else text.contains(w), F.lit(w))
        for w in vocabulary
    ]
    return F.array_compact(F.array(*found))


def precheck(memo: Column, decision: Column, reason_codes: Column, citations: Column, whole_word: bool = False,
             limit: int = d.REASON_LIMIT) -> Column:
    """Array of issues found without a model; empty for a well-formed memo."""
    words = protected_words(memo, whole_word=whole_word)
    return F.array_compact(
        F.array(
            F.when(strip_blank(memo) == "", F.lit(d.ISSUE_EMPTY)),
            F.when(F.size(reason_codes) > limit, F.lit(d.ISSUE_REASONS)),
            F.when((decision == d.HIGH_RISK) & (F.size(citations) == 0), F.lit(d.ISSUE_NO_CITATION)),
            F.when(F.size(words) > 0, F.concat(F.lit(d.ISSUE_PROTECTED), F.array_join(words, ", "))),
        )
    )


def parse_verdict(reply: Column) -> Column:
    """Struct ``(approved, feedback)``; only a JSON boolean approves, anything else is null."""
    return parse_reply(reply, "approved: boolean, feedback: string", ("approved", "feedback"))


def judge_context() -> Column:
    """What the judge may rely on."""
    return F.concat(
        F.lit("score="), F.to_json(F.struct("sk_id_curr", "probability", "threshold", "decision")),
        F.lit(", reason_codes="), F.to_json("reason_codes"),
        F.lit(", citas="), F.to_json(F.transform("citations", lambda c: c["snippet"])),
    )


Model = Callable[[list[str]], list[str]]


def _draft_and_judge(rows: DataFrame, draft: Model, judge: Model) -> DataFrame:
    """One pass: draft, check, and ask the judge about memos without issues.

    Model output is written before it is used: a lost task must not get another answer.
    """
    drafted = cut_lineage(apply_in_batches(rows, "prompt", draft, "memo", "string"))
    issues = precheck(F.col("memo"), F.col("decision"), F.col("reason_codes"), F.col("citations"))
    checked = drafted.withColumn("_issues", F.array_join(issues, "; "))
    failed = checked.where(F.col("_issues") != "").select(
        *rows.columns, "memo", F.lit(False).alias("approved"), F.col("_issues").alias("feedback")
    )
    asked = checked.where(F.col("_issues") == "").withColumn(
        "_ask", F.concat(F.lit("Contexto:\n"), judge_context(), F.lit("\n\nMemo:\n"), F.col("memo"))
    )
    replied = cut_lineage(apply_in_batches(asked, "_ask", judge, "_reply", "string"))
    # a malformed reply approves nothing; it is kept as the feedback, and a second one sends the memo to a person
    judged = replied.withColumn("_v", parse_verdict(F.col("_reply"))).select(
        *rows.columns, "memo", F.coalesce("_v.approved", F.lit(False)).alias("approved"), F.coalesce("_v.feedback", "_reply").alias("feedback")
    )
    return failed.unionByName(judged)


def review_batch(evidence: DataFrame, draft: Model, judge: Model) -> DataFrame:
    """Draft all memos, redraft the failing ones once, and send what fails again to a person."""
    columns = ["sk_id_curr", "probability", "threshold", "decision", "reason_codes", "citations"]
    first = _draft_and_judge(evidence.select(*columns, memo_input().alias("prompt")), draft, judge)
    passed = first.where("approved").withColumns({"iteration": F.lit(0), "status": F.lit(d.APPROVED)})
    again = first.where("NOT approved").select(*columns, memo_input(F.col("feedback")).alias("prompt"))
    second = _draft_and_judge(again, draft, judge).withColumns(
        {"iteration": F.lit(1), "status": F.when(F.col("approved"), d.APPROVED).otherwise(d.NEEDS_REVIEW)}
    )
    out = passed.unionByName(second)
    return out.select(*columns, "memo", F.col("feedback").alias("evaluator_feedback"), "iteration", "status")


def first_try_success(iteration: Column, status: Column) -> Column:
    return F.coalesce((status == d.APPROVED) & (iteration == 0), F.lit(False))


def first_try_rate(reviews: DataFrame) -> DataFrame:
    success = first_try_success(F.col("iteration"), F.col("status")).cast("int")
    return reviews.agg(F.count(F.lit(1)).alias("n"), F.avg(success).alias("first_try_rate"))


def extract_usage(response: Column) -> Column:
    """Tokens of a JSON response: input, output and total; absent numbers are null."""
    usage = "$.usage"
    return F.struct(
        F.get_json_object(response, f"{usage}.prompt_tokens").cast("long").alias("input"),
        F.get_json_object(response, f"{usage}.completion_tokens").cast("long").alias("output"),
        F.get_json_object(response, f"{usage}.total_tokens").cast("long").alias("total"),
    )


def usage_totals(calls: DataFrame, by: str = "model") -> DataFrame:
    return calls.groupBy(by).agg(
        F.count(F.lit(1)).alias("calls"), F.sum("usage.input").alias("input"), F.sum("usage.output").alias("output"),
        F.sum("usage.total").alias("total"),
    )


def mark_verdicts(cases: DataFrame, human: str = "human_approved", predicted: str = "predicted_approved") -> DataFrame:
    return cases.withColumn("mark", F.when(F.col(human) == F.col(predicted), F.lit("OK")).otherwise(F.lit("MAL")))


def judge_quality(cases: DataFrame, human: str = "human_approved", predicted: str = "predicted_approved",
                  floor: float = d.JUDGE_FLOOR) -> DataFrame:
    """Confusion counts, sensitivity, specificity, and whether each reaches the floor."""
    h, p = F.col(human), F.col(predicted)

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

    counts = cases.agg(n(h & p).alias("tp"), n(~h & ~p).alias("tn"), n(~h & p).alias("fp"), n(h & ~p).alias("fn"))
    return counts.withColumns(
        {
            "tpr": F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)),
            "tnr": F.col("tn") / F.nullif(F.col("tn") + F.col("fp"), F.lit(0)),
        }
    ).withColumns(
        {
            "tpr_ok": F.coalesce(F.col("tpr") >= floor, F.lit(False)),
            "tnr_ok": F.coalesce(F.col("tnr") >= floor, F.lit(False)),
        }
    )


def answer_quality(scores: DataFrame, faithfulness_floor: float = d.FAITHFULNESS_FLOOR,
                   relevancy_floor: float = d.RELEVANCY_FLOOR) -> DataFrame:
    """Mean faithfulness and relevancy of scored answers against their targets."""
    means = scores.agg(F.avg("faithfulness").alias("faithfulness"), F.avg("relevancy").alias("relevancy"))
    return means.withColumns(
        {
            "faithfulness_ok": F.col("faithfulness") >= faithfulness_floor,
            "relevancy_ok": F.col("relevancy") >= relevancy_floor,
        }
    )
