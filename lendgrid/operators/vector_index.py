"""A vector table in cells: exact cosine top-k that reads only the cells which can hold one of the best."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lendgrid.functions.hashing import hash_key
from lendgrid.operators.summaries import matrix_of
from lendgrid.session import shared_folder

#: Vectors that choose the centres, centres at most, and rounds of moving them. They decide what is read, never what is found.
SAMPLE, MOST_CELLS, ROUNDS = 20_000, 2048, 8
#: Numbers (queries x dimensions) that travel with the tasks at a time, scores held at once, and slack of the bounds.
QUERY_NUMBERS, SCORES, SLACK = 4_000_000, 1 << 20, 1e-7
#: The cell of vectors without a direction.
NOWHERE = -1


@dataclass(frozen=True)
class VectorIndex:
    """``rows``: ``item_id vector cell angle``, in order of cell and of angle to its centre; ``cells``: per cell its number of rows and the
    range of angles."""

    rows: DataFrame
    centres: np.ndarray
    cells: dict[int, tuple[int, float, float]]


def _unit(x: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms == 0, 1.0, norms)


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1.0, 1.0))


def _centres(sample: np.ndarray, seed: int) -> np.ndarray:
    """Directions that the sample gathers around, about the root of its size."""
    distinct = np.unique(_unit(sample[np.linalg.norm(sample, axis=1) > 0]), axis=0)
    if not len(distinct):
        return np.empty((0, sample.shape[1] if sample.ndim > 1 else 0))
    count = min(MOST_CELLS, max(1, int(np.sqrt(len(distinct)))))
    centres = distinct[np.sort(np.random.default_rng(seed).permutation(len(distinct))[:count])]
    for _ in range(ROUNDS):
        nearest = (distinct @ centres.T).argmax(axis=1)
        sums = np.stack([np.bincount(nearest, distinct[:, j], len(centres)) for j in range(distinct.shape[1])], axis=1)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, _unit(sums), centres)
    return centres


def build_vector_index(vectors: DataFrame, folder: str | None = None, seed: int = 42) -> VectorIndex:
    """Write ``vectors`` (``item_id``, ``vector``; one length, no nulls) in cells below ``folder``.

    Centres come from a bounded sample by hash; every vector is in the cell of its nearest centre. The table is dealt out by ranges of cell,
    angle and hash, so a cell with a large share of all vectors, or of copies of one, is spread over many files.
    """
    spark = vectors.sparkSession
    folder = folder or f"{shared_folder(spark)}/vectors-{uuid.uuid4().hex}"
    drawn = vectors.orderBy(hash_key(F.col("item_id"), seed), "item_id").limit(SAMPLE).select(F.col("vector").cast("array<double>").alias("v")).toArrow()
    centres = _centres(matrix_of(drawn.column(0).combine_chunks()), seed)
    sent = spark.sparkContext.broadcast(centres)
    kind = T.StructType([T.StructField("item_id", vectors.schema["item_id"].dataType), T.StructField("vector", T.ArrayType(T.DoubleType())),
                         T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column(1))
            cell, angle = np.full(len(x), NOWHERE, np.int32), np.zeros(len(x))
            there = np.flatnonzero(np.linalg.norm(x, axis=1) > 0)
            for start in range(0, len(there), 1024):
                part = there[start:start + 1024]
                near = _unit(x[part]) @ centres.T
                cell[part] = near.argmax(axis=1)
                angle[part] = np.arccos(np.clip(near.max(axis=1), -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=kind.names)

    placed = vectors.select("item_id", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(place, kind)
    placed.repartitionByRange("cell", "angle", F.xxhash64("item_id")).sortWithinPartitions("cell", "angle").write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(kind).parquet(folder)
    cells = {r["cell"]: (r["n"], r["low"], r["high"]) for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")).collect()}
    return VectorIndex(rows, centres, cells)


def _most(index: VectorIndex, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells, and the largest cosine that a vector of each can have with each query, by the triangle inequality of angles."""
    cells = np.array(sorted(index.cells), np.int64)
    low, high = (np.array([index.cells[int(c)][i] for c in cells]) for i in (1, 2))
    most = np.zeros((len(q), len(cells)))
    real = cells >= 0
    if real.any() and len(q):
        to = _angles(q, index.centres[cells[real]])
        most[:, real] = np.cos(np.clip(np.maximum(to - high[real], low[real] - to), 0.0, np.pi))
    most[np.linalg.norm(q, axis=1) == 0] = 0.0  # a query without a direction scores 0 with all
    return cells, most


def search_cells(index: VectorIndex, queries: DataFrame, k: int, query_numbers: int = QUERY_NUMBERS) -> tuple[DataFrame, float]:
    """``(query_id, item_id, rank, score)``, the ``k`` nearest items of every query, exactly; and the share of the table's vectors that were read, averaged over the queries.

    First each query reads the cells with the best bounds until they hold ``k`` vectors; its k-th best score there is a floor. Then it
    reads the other cells whose bound reaches the floor, so a cell is left out only if none of its vectors can be among the best. Tasks keep
    the best ``k`` per query; no vector is shuffled. Queries come in blocks of bounded size.
    """
    width = queries.agg(F.max(F.size("vector"))).first()[0] or 1
    blocks = max(1, -(-queries.count() * width // query_numbers))
    numbered = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("_b"))
    parts, shares = None, []
    for block in range(blocks):
        asked = numbered.where(F.col("_b") == block).select("query_id", "vector").toArrow()
        if not asked.num_rows:
            continue
        found, share = _search_block(index, asked, queries.schema["query_id"].dataType, k)
        parts = found if parts is None else parts.unionByName(found)
        shares.append((share, asked.num_rows))
    if parts is None:
        parts = queries.sparkSession.createDataFrame([], _found_type(index, queries.schema["query_id"].dataType))
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "item_id", "rank", "score"), sum(s * n for s, n in shares) / max(1, sum(n for _, n in shares))


def _found_type(index: VectorIndex, query_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("query_id", query_type), T.StructField("item_id", index.rows.schema["item_id"].dataType), T.StructField("score", T.DoubleType())])


def _search_block(index: VectorIndex, asked: pa.Table, query_type: T.DataType, k: int) -> tuple[DataFrame, float]:
    ids, q = asked.column(0).combine_chunks(), _unit(matrix_of(asked.column(1).combine_chunks()))
    cells, most = _most(index, q)
    sizes = np.array([index.cells[int(c)][0] for c in cells], np.int64)
    first = np.zeros(most.shape, bool)
    for i, own in enumerate(most):
        order = np.argsort(-own, kind="stable")
        first[i, order[:int(np.searchsorted(np.cumsum(sizes[order]), k, "left")) + 1]] = True
    near = _read(index, ids, q, cells, first, np.full(len(q), -np.inf), query_type, k).toArrow()
    # the floor of a query: its k-th best score in the cells that it has read
    floor = np.full(len(q), -np.inf)
    at, score = pc.index_in(near.column("query_id"), ids).to_numpy(), near.column("score").to_numpy()
    order = np.lexsort((-score, at))
    at, score = at[order], score[order]
    starts = np.searchsorted(at, np.arange(len(q)))
    full = np.searchsorted(at, np.arange(len(q)), "right") - starts >= k
    floor[full] = score[starts[full] + k - 1]
    rest = (most >= floor[:, None] - SLACK) & ~first
    read = float((first | rest).astype(float) @ sizes @ np.ones(len(q)) / max(1, sizes.sum()) / len(q)) if len(q) else 0.0
    out = index.rows.sparkSession.createDataFrame(near)
    if rest.any():
        out = out.unionByName(_read(index, ids, q, cells, rest, floor, query_type, k))
    return out, read


def _read(index: VectorIndex, ids: pa.Array, q: np.ndarray, cells: np.ndarray, wanted: np.ndarray, floor: np.ndarray, query_type: T.DataType, k: int) -> DataFrame:
    """The best ``k`` rows per query and task in the ``wanted`` cells (queries x cells), of at least the query's floor."""
    kind = _found_type(index, query_type)
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in kind.fields])
    used = cells[wanted.any(axis=0)]
    askers = {int(c): np.flatnonzero(wanted[:, j]) for j, c in enumerate(cells) if wanted[:, j].any()}
    sent = index.rows.sparkSession.sparkContext.broadcast((ids, q, askers, floor))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, askers, floor = sent.value
        held: dict[int, tuple[np.ndarray, pa.Array]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(2).to_numpy()
            x = _unit(matrix_of(batch.column(1)))
            cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = askers.get(int(cell[a]), np.empty(0, np.int64))
                step = max(1, SCORES // max(1, b - a))
                for at in range(0, len(own), step):
                    part = own[at:at + step]
                    scores = np.round(x[a:b] @ q[part].T, 9)
                    for j, i in enumerate(part.tolist()):
                        bar = max(floor[i], held[i][0][-1] if i in held and len(held[i][0]) == k else -np.inf)
                        good = np.flatnonzero(scores[:, j] >= bar)
                        if not len(good):
                            continue
                        score, items = scores[good, j], batch.column(0).take(pa.array(good + a))
                        if i in held:
                            score, items = np.concatenate([held[i][0], score]), pa.concat_arrays([held[i][1], items])
                        best = pc.sort_indices(pa.table({"s": -score, "i": items}), [("s", "ascending"), ("i", "ascending")])[:k]
                        held[i] = (score[best.to_numpy()], items.take(best))
        for i, (score, items) in held.items():
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([ids.slice(i, 1)] * len(score)), items, pa.array(score)], schema=schema)

    return index.rows.where(F.col("cell").isin([int(c) for c in used])).mapInArrow(scan, kind)
