"""Rank fusion, re-ordering by a supplied ranking, and parsing of model replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.functions.defaults import FUSION_K, TOP_K
from lendgrid.functions.texts import strip_fences


def reciprocal_rank_fusion(rankings: DataFrame, k: int = FUSION_K) -> DataFrame:
    """``(query_id, item_id, rank, score)`` from ``(query_id, list_no, item_id, rank)`` with ranks from 1.

    An item scores 1/(k + rank) per list; equal scores go to the item met first,
    list by list. A query has only the listed candidates, so its group is short.
    """
    fused = rankings.groupBy("query_id", "item_id").agg(
        F.sum(1 / (F.lit(float(k)) + F.col("rank"))).alias("score"),
        F.min(F.struct("list_no", "rank")).alias("_first"),
    )
    order = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "_first")
    return fused.withColumn("rank", F.row_number().over(order)).select("query_id", "item_id", "rank", "score")


def reorder(candidates: DataFrame, given: DataFrame, top_n: int = TOP_K) -> DataFrame:
    """Candidates in the order of ``given`` (query_id, item_id, given_rank), the others after them.

    Ids that are no candidates drop out; a repeated id is repeated, as given.
    """
    joined = candidates.join(given.select("query_id", "item_id", "given_rank"), ["query_id", "item_id"], "left")
    order = Window.partitionBy("query_id").orderBy(F.col("given_rank").asc_nulls_last(), F.col("rank"))
    out = joined.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top_n)
    return out.select("query_id", "item_id", F.col("_r").alias("rank"))


def parse_reply(reply: Column, schema: str, required: tuple[str, ...]) -> Column:
    """Struct of a JSON reply, fences stripped; null when it is no JSON object with the required fields.

    The text is read as the only element of an array, so that anything after
    the object makes it malformed instead of being skipped.
    """
    text = F.concat(F.lit("["), strip_fences(reply), F.lit("]"))
    elements = F.from_json(text, f"array<struct<{schema}>>")
    parsed = F.get(elements, F.lit(0))
    complete = F.try_parse_json(text).isNotNull() & (F.size(elements) == 1)
    for name in required:
        complete = complete & parsed[name].isNotNull()
    return F.when(complete, parsed)


def require(parsed: Column, message: str) -> Column:
    """The value, or a failed job with ``message`` for a null."""
    return F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(F.lit(message)))


def parse_ranking(replies: DataFrame, strict: bool = True) -> DataFrame:
    """``(query_id, item_id, given_rank)`` from replies like ``{"ranked_chunk_ids": [...]}``.

    A malformed reply is an error, or with ``strict=False`` gives no rows.
    """
    parsed = parse_reply(F.col("reply"), "ranked_chunk_ids: array<string>", ("ranked_chunk_ids",))
    value = require(parsed, "reply holds no ranked_chunk_ids") if strict else parsed
    return replies.select("query_id", F.posexplode(value["ranked_chunk_ids"]).alias("_i", "item_id")).select(
        "query_id", "item_id", (F.col("_i") + 1).alias("given_rank")
    )
