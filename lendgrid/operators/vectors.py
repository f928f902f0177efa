"""Vector store operations: upsert by id and exact cosine top-k for many queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

QUERY_BLOCK_NUMBERS = 4_000_000  # queries x dimensions that travel with the tasks
VECTOR_BLOCK_ROWS = 50_000
TILE_ROWS, TILE_QUERIES = 8192, 512  # scores held at once in a task


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Stored rows plus incoming ones; for a key the highest ``order`` among the incoming rows wins."""
    fields = [c for c in stored.columns if c != key]
    latest = incoming.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("_v")).select(key, "_v.*")
    return stored.join(latest.select(key), key, "left_anti").unionByName(latest)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` rows per query; equal scores by id."""
    ranked = found.sort_values(["query_id", "score", "item_id"], ascending=[True, False, True])
    return ranked.groupby("query_id", dropna=False).head(k)


def _block_top(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray | None = None) -> pd.DataFrame:
    """Best ``k`` rows of one block per query, of those that reach the query's ``floor``. Scores are computed tile by tile, whatever the block and the queries.

    Of a tile only rows that reach the query's k-th best score there are sorted, equal ones by id.
    """
    parts = []
    for at in range(0, len(query_ids), TILE_QUERIES):
        asked = _unit(q[at:at + TILE_QUERIES])
        least = np.full(len(asked), -np.inf) if floor is None else floor[at:at + TILE_QUERIES].copy()
        for row in range(0, len(x), TILE_ROWS):
            scores = np.round(asked @ _unit(x[row:row + TILE_ROWS]).T, 9)
            if scores.shape[1] > k:
                least = np.maximum(least, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
            query, item = np.nonzero(scores >= least[:, None])
            own, score = ids[row + item], scores[query, item]
            order = np.lexsort((own, -score, query))
            query, own, score = query[order], own[order], score[order]
            best = np.arange(len(query)) - np.searchsorted(query, query) < k
            parts.append(pd.DataFrame({"query_id": query_ids[at + query[best]], "item_id": own[best], "score": score[best]}))
    return _best(pd.concat(parts), k) if parts else pd.DataFrame({"query_id": [], "item_id": [], "score": []})


def _floor(best: pd.DataFrame, query_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score that each query has so far, of ``k`` or more rows."""
    scores = best.groupby("query_id", dropna=False)["score"].agg(["size", "min"])
    full = scores.loc[scores["size"] >= k, "min"]
    return full.reindex(query_ids).fillna(-np.inf).to_numpy(dtype=np.float64)


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, broadcast_numbers: int = QUERY_BLOCK_NUMBERS) -> DataFrame:
    """``(query_id, item_id, rank, score)``: the ``k`` nearest items of every query, exactly.

    ``vectors`` has (item_id, vector), ``queries`` (query_id, vector). Each
    task keeps a running best ``k`` per query, so pairs never leave it. A query set of checked size travels to the vectors; a larger one
    meets them block by block.
    """
    kinds = dict(vectors.dtypes), dict(queries.dtypes)
    schema = f"query_id {kinds[1]['query_id']}, item_id {kinds[0]['item_id']}, score double"
    width = queries.agg(F.max(F.size("vector"))).first()[0] or 1
    limit = max(1, broadcast_numbers // width)
    fits = queries.limit(limit + 1).count() <= limit
    partial = _beside(vectors, queries, k, schema) if fits else _blockwise(vectors, queries, k, schema, limit)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "item_id", "rank", "score")


def _beside(vectors: DataFrame, queries: DataFrame, k: int, schema: str) -> DataFrame:
    rows = queries.toPandas()
    held = (rows["query_id"].to_numpy(), np.array(rows["vector"].tolist(), dtype=np.float64))
    shared = vectors.sparkSession.sparkContext.broadcast(held)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, q = shared.value
        best, floor = None, None
        for batch in batches:
            if len(batch) and len(query_ids):
                x = np.stack(batch["vector"].to_numpy()).astype(np.float64)
                top = _block_top(batch["item_id"].to_numpy(), x, query_ids, q, k, floor)
                best = top if best is None else _best(pd.concat([best, top]), k)
                # ids that come twice share their rows, so they have no floor
                floor = _floor(best, query_ids, k) if pd.Index(query_ids).is_unique else None
        if best is not None:
            yield best

    return vectors.select("item_id", "vector").mapInPandas(scan, schema)


def _blockwise(vectors: DataFrame, queries: DataFrame, k: int, schema: str, query_rows: int) -> DataFrame:
    """Every query block meets every vector block; blocks are hashed to an even, bounded size."""
    vector_blocks = max(1, -(-vectors.count() // VECTOR_BLOCK_ROWS))
    query_blocks = max(1, -(-queries.count() // query_rows))

    def blocks(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = vectors.select(
        "item_id", "vector", F.pmod(F.xxhash64("item_id"), F.lit(vector_blocks)).alias("vb")
    ).withColumn("qb", blocks(query_blocks))
    right = queries.select(
        "query_id", F.col("vector").alias("q"), F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).alias("qb")
    ).withColumn("vb", blocks(vector_blocks))

    def meet(_, items: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(items) or not len(asked):
            return pd.DataFrame({"query_id": [], "item_id": [], "score": []})
        x = np.stack(items["vector"].to_numpy()).astype(np.float64)
        q = np.stack(asked["q"].to_numpy()).astype(np.float64)
        return _block_top(items["item_id"].to_numpy(), x, asked["query_id"].to_numpy(), q, k)

    return left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(meet, schema)
