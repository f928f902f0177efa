"""Hybrid retrieval of policy chunks for a table of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lendgrid.functions.defaults import CANDIDATES, TOP_K
from lendgrid.operators.answers import ground
from lendgrid.operators.fusion import reciprocal_rank_fusion, reorder
from lendgrid.operators.keyword import Index, search
from lendgrid.operators.lookup import lookup
from lendgrid.operators.vectors import cosine_top_k
from lendgrid.session import cut_lineage


def hybrid_candidates(queries: DataFrame, query_vectors: DataFrame, chunk_vectors: DataFrame, index: Index,
                      candidates: int = CANDIDATES) -> DataFrame:
    """Dense and keyword rankings, fused; dense hits come first among equals."""
    dense = cosine_top_k(chunk_vectors, query_vectors, candidates).select(
        "query_id", F.lit(0).alias("list_no"), "item_id", "rank"
    )
    sparse = search(index, queries, candidates).select(
        "query_id", F.lit(1).alias("list_no"), F.col("chunk_id").alias("item_id"), "rank"
    )
    return reciprocal_rank_fusion(dense.unionByName(sparse))


def attach_chunks(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk columns for ranked ids; the short ranked side is matched against the chunks by id."""
    found = ranked.withColumnRenamed("item_id", "chunk_id")
    return chunks.join(found, "chunk_id").select("query_id", "rank", "doc_id", "chunk_id", "title", "text")


def retrieve(queries: DataFrame, query_vectors: DataFrame, chunk_vectors: DataFrame, index: Index,
             given: DataFrame | Callable[[DataFrame], DataFrame] | None = None, candidates: int = CANDIDATES, top_k: int = TOP_K) -> DataFrame:
    """Top chunks per question. ``given`` is a supplied ranking of the fused candidates, or makes it from them; they are written once then."""
    fused = hybrid_candidates(queries, query_vectors, chunk_vectors, index, candidates)
    if callable(given):
        fused = cut_lineage(fused)
        given = given(fused)
    if given is None:
        top = fused.where(F.col("rank") <= top_k).select("query_id", "item_id", "rank")
    else:
        top = reorder(fused, given, top_k)
    return attach_chunks(top, index.chunks)


def policy_citations(asked: DataFrame, search_for: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(sk_id_curr, citations)`` for applicants with a policy question, ``asked`` as ``(sk_id_curr, query)``.

    Applicants share questions: each text is searched once. ``search_for`` gets ``(query_id, query)`` and returns what ``retrieve`` does. A
    question that finds nothing, and a null one, have no citations.
    """
    texts = asked.where(F.col("query").isNotNull()).groupBy("query").agg(F.min("sk_id_curr").alias("query_id"))
    found = ground(search_for(texts.select("query_id", "query"))).select("query_id", "citations")
    cited = lookup(asked.select("sk_id_curr", "query"), "query", texts.join(found, "query_id").select("query", "citations"))
    return cited.where(F.col("citations").isNotNull()).select("sk_id_curr", "citations")
