"""Citations, grounded context and answer tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lendgrid.functions.texts import snippet
from lendgrid.operators.batches import apply_in_batches
from lendgrid.operators.replies import ReplyStore
from lendgrid.session import cut_lineage


def ground(retrieved: DataFrame) -> DataFrame:
    """Per query: context block and citations of the retrieved chunks, in rank order.

    ``retrieved`` has (query_id, rank, chunk_id, title, text); a query has its
    top chunks only, so the arrays are short.
    """
    block = F.concat(F.lit("["), F.col("title"), F.lit("] (id="), F.col("chunk_id"), F.lit(")\n"), F.col("text"))
    entry = F.struct(
        "rank", block.alias("block"), F.col("title").alias("doc_title"), "chunk_id", snippet(F.col("text")).alias("snippet")
    )
    grouped = retrieved.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return grouped.select(
        "query_id",
        F.array_join(F.transform("_e", lambda e: e["block"]), "\n\n").alias("context"),
        F.transform("_e", lambda e: F.struct(e["doc_title"].alias("doc_title"), e["chunk_id"].alias("chunk_id"), e["snippet"].alias("snippet"))).alias("citations"),
    )


def answer_questions(queries: DataFrame, retrieved: DataFrame, chat: Callable[[list[str]], list[str]], batch: int = 16,
                     replies: ReplyStore | None = None) -> DataFrame:
    """``(query_id, answer, citations)``. Citations come from the retrieved chunks, never from the answer.

    Answers are written once, so a lost task does not ask the model again; with ``replies`` a later run does not ask again either.
    """
    none = F.array().cast("array<struct<doc_title:string,chunk_id:string,snippet:string>>")
    grounded = queries.join(ground(retrieved), "query_id", "left").select(
        "query_id", F.coalesce("citations", none).alias("citations"),
        F.concat(F.lit("Contexto:\n\n"), F.coalesce("context", F.lit("")), F.lit("\n\nPregunta: "), F.col("query")).alias("prompt"),
    )
    if replies:
        answered = replies.ask(grounded, "prompt", chat, "answer", batch)
    else:
        answered = cut_lineage(apply_in_batches(grounded, "prompt", chat, "answer", "string", batch))
    return answered.select("query_id", "answer", "citations")
