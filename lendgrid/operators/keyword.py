"""BM25 (Okapi) over chunks, for many queries at once: an inverted index in segments, searched with upper bounds of its blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lendgrid.functions.defaults import BM25_B, BM25_EPSILON, BM25_K1
from lendgrid.functions.texts import tokens
from lendgrid.session import shared_folder
from lendgrid.sources.tables import scan_parquet

AT = ("doc_id", "chunk_no")
#: Tokens of a segment, beyond which the next chunk begins a new one; postings of a block; queries that travel with the tasks at a time.
SEGMENT_TOKENS, BLOCK, QUERY_BLOCK = 1 << 20, 128, 20_000


@dataclass(frozen=True)
class Index:
    """Segments of postings, ``terms`` (term, df, idf) and two corpus numbers.

    A segment is one row: the chunks in corpus order with their lengths, its terms in order, and for each term the positions of
    its chunks, how often each has it, and per block of postings the most occurrences and the shortest chunk, which bound every
    score in the block.
    """

    chunks: DataFrame
    segments: DataFrame
    terms: DataFrame
    average_length: float
    idf_floor: float


def _segment_type(doc_type: T.DataType) -> T.StructType:
    binary = [T.StructField(c, T.BinaryType()) for c in ("lengths", "starts", "places", "counts", "block_starts", "most", "shortest")]
    return T.StructType([T.StructField("doc_ids", T.ArrayType(doc_type)), T.StructField("chunk_nos", T.ArrayType(T.IntegerType())),
                         T.StructField("terms", T.ArrayType(T.StringType())), *binary])


def _segment(doc_ids: pa.Array, chunk_nos: pa.Array, words: pa.Array, sizes: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """One segment of chunks that are in corpus order."""
    encoded = words.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy() if len(encoded.dictionary) else np.empty(0, np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    n = max(1, len(sizes))
    pair, counts = np.unique(rank[encoded.indices.to_numpy()] * n + np.repeat(np.arange(len(sizes)), sizes), return_counts=True)
    term, place = np.divmod(pair, n)
    starts = np.searchsorted(term, np.arange(len(order) + 1))
    blocks = -(-np.diff(starts) // BLOCK)
    block_starts = np.concatenate([[0], np.cumsum(blocks)])
    heads = np.repeat(starts[:-1], blocks) + BLOCK * (np.arange(block_starts[-1]) - np.repeat(block_starts[:-1], blocks))
    lengths = sizes.astype(np.int32)
    most = np.maximum.reduceat(counts, heads) if len(heads) else counts
    shortest = np.minimum.reduceat(lengths[place], heads) if len(heads) else lengths[:0]
    binary = [x.astype(kind).tobytes() for x, kind in ((lengths, np.int32), (starts, np.int64), (place, np.int32), (counts, np.int32), (block_starts, np.int64), (most, np.int32), (shortest, np.int32))]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (doc_ids, chunk_nos, encoded.dictionary.take(pa.array(order)))]
    return pa.RecordBatch.from_arrays([*lists, *[pa.array([b], pa.binary()) for b in binary]], schema=schema)


def build_index(chunks: DataFrame, epsilon: float = BM25_EPSILON, folder: str | None = None, segment_tokens: int = SEGMENT_TOKENS) -> Index:
    """Segments and terms, written once below ``folder`` and scanned by every search.

    Chunks are indexed where they are read: a task cuts its chunks into segments of about ``segment_tokens``, and nothing but the terms' counts is shuffled.
    A negative idf (a term in more than half of the chunks) becomes epsilon times the mean idf. A chunk without a text has no token.
    """
    spark = chunks.sparkSession
    folder = folder or f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    doc_type = chunks.schema["doc_id"].dataType
    kind = _segment_type(doc_type)
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in kind.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def close():
            table = pa.Table.from_batches(waiting)
            table = table.take(pc.sort_indices(table.select(AT), [(c, "ascending") for c in AT]))
            lists = table.column("_t").combine_chunks()
            return _segment(table.column("doc_id").combine_chunks(), table.column("chunk_no").combine_chunks(), lists.flatten(),
                            pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), schema)

        for batch in batches:
            sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            start = 0
            for i, size in enumerate(sizes.tolist()):
                held += size
                if held >= segment_tokens:
                    waiting.append(batch.slice(start, i + 1 - start))
                    yield close()
                    waiting, held, start = [], 0, i + 1
            if start < batch.num_rows:
                waiting.append(batch.slice(start))
        if waiting:
            yield close()

    split = chunks.select(F.col("doc_id"), F.col("chunk_no").cast("int").alias("chunk_no"), F.coalesce(tokens(F.col("text")), F.array()).alias("_t"))
    # a row group each: Spark writes a group, and reads up to 4096 rows of one, at a time, which would be all segments of a file
    split.mapInArrow(pack, kind).write.mode("overwrite").option("parquet.block.row.count.limit", "1").parquet(f"{folder}/segments")
    segments = spark.read.schema(kind).parquet(f"{folder}/segments")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([terms.values, pa.array(np.diff(np.frombuffer(starts, np.int64)))], names=["term", "df"])

    n, total = _totals(segments)
    df = segments.select("terms", "starts").mapInArrow(sums, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df.withColumn("idf", F.log(F.lit(float(n)) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).write.mode("overwrite").parquet(f"{folder}/terms")
    terms = scan_parquet(spark, f"{folder}/terms")
    floor = epsilon * (terms.agg(F.avg("idf")).first()[0] or 0.0)
    floored = terms.withColumn("idf", F.when(F.col("idf") < 0, F.lit(floor)).otherwise(F.col("idf")))
    return Index(chunks, segments, floored, total / n if n else 0.0, floor)


def _totals(segments: DataFrame) -> tuple[int, int]:
    """Number of chunks and of tokens."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [np.frombuffer(b, np.int32) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in lengths], pa.int64()), pa.array([int(x.sum(dtype=np.int64)) for x in lengths], pa.int64())], names=["n", "total"])

    return tuple(segments.select("lengths").mapInArrow(sums, "n long, total long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first())


def postings(index: Index) -> DataFrame:
    """The index as rows ``(doc_id, chunk_no, length, term, tf)``."""
    kind = T.StructType([T.StructField("doc_id", index.chunks.schema["doc_id"].dataType), T.StructField("chunk_no", T.IntegerType()), T.StructField("length", T.IntegerType()),
                         T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = _Opened(batch, i)
                at = pa.array(s.places.astype(np.int64))
                terms = s.terms.take(pa.array(np.repeat(np.arange(len(s.terms)), np.diff(s.starts))))
                yield pa.RecordBatch.from_arrays([s.doc_ids.take(at), s.chunk_nos.take(at), pa.array(s.lengths[s.places]), terms, pa.array(s.counts.astype(np.int64))], names=kind.names)

    return index.segments.mapInArrow(rows, kind)


class _Opened:
    """A segment as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        of = lambda name: batch.column(batch.schema.get_field_index(name))[i]
        self.doc_ids, self.chunk_nos, self.terms = of("doc_ids").values, of("chunk_nos").values, of("terms").values
        for name, kind in (("lengths", np.int32), ("starts", np.int64), ("places", np.int32), ("counts", np.int32), ("block_starts", np.int64), ("most", np.int32), ("shortest", np.int32)):
            setattr(self, name, np.frombuffer(of(name).as_buffer(), kind))  # no copy


def query_weights(index: Index, queries: DataFrame) -> DataFrame:
    """``(query_id, term, weight)``: idf times the term's frequency in the query."""
    wanted = (
        queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    return wanted.join(index.terms, "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))


def _unit(tf: np.ndarray, length: np.ndarray, average: float, k1: float, b: float) -> np.ndarray:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * (length / (average or 1.0))))


@dataclass
class Counts:
    """What a search has read: postings of the queries' terms, and those whose score was computed."""

    postings: int = 0
    scored: int = 0


def segment_top(s: _Opened, rows: np.ndarray, weights: np.ndarray, k: int, least: float, average: float, k1: float, b: float, counts: Counts | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores (to nine decimals) of the best ``k`` chunks of a segment for one query, equal ones in corpus order.

    ``rows`` are the query's terms in the segment. Only chunks that can reach ``least`` count: the k-th best score of the task so far, or the
    lowest score of k chunks with the strongest term. Terms are taken by the most they can add. Once ``least`` exceeds what all remaining terms can add together, chunks that hold only those are out;
    and a block of postings is skipped if its own bound and the other terms' do not reach it. The chunks that are left get
    their whole score. A chunk without any term scores 0, which may be among the best.
    """
    counts = counts or Counts()
    n = len(s.lengths)
    spans = [(s.starts[r], s.starts[r + 1]) for r in rows]
    tops = []
    for r, w in zip(rows, weights):
        blocks = slice(s.block_starts[r], s.block_starts[r + 1])
        # a negative weight adds at most nothing; a block's bound is its best count in its shortest chunk
        tops.append(np.maximum(w * _unit(s.most[blocks], s.shortest[blocks], average, k1, b), 0.0))
    most = np.array([t.max() for t in tops]) if len(rows) else np.empty(0)
    order = np.argsort(-most, kind="stable")
    rest = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0.0]])
    wanted = np.zeros(n, bool)

    def scores(found: np.ndarray) -> np.ndarray:
        """The whole score of each of these chunks (in order), read from their own postings."""
        out = np.zeros(len(found))
        for j, (first, last) in enumerate(spans):
            own = s.places[first:last]
            if len(found) * 8 < len(own):
                at = np.searchsorted(own, found)
                hit = np.flatnonzero((at < len(own)) & (own[np.minimum(at, len(own) - 1)] == found))
                source = first + at[hit]
            else:
                wanted[:] = False
                wanted[found] = True
                place = np.flatnonzero(wanted[own])
                hit, source = np.searchsorted(found, own[place]), first + place
            counts.scored += len(source)
            out[hit] += weights[j] * _unit(s.counts[source], s.lengths[s.places[source]], average, k1, b)
        return np.round(out, 9)

    if len(rows) > 1 and weights.min() >= 0 and spans[order[0]][1] - spans[order[0]][0] >= k:
        # k chunks with much of the strongest term: the k-th best score is at least the lowest of theirs
        first, last = spans[order[0]]
        own = _unit(s.counts[first:last], s.lengths[s.places[first:last]], average, k1, b)
        least = max(least, float(scores(np.sort(s.places[first:last][np.argpartition(-own, k - 1)[:k]])).min()))
    bar = least - 1e-8
    wanted[:] = False
    for i, j in enumerate(order):
        counts.postings += int(spans[j][1] - spans[j][0])
        if rest[i] < bar:
            continue  # neither this term nor those after it can lift a chunk over the bar
        first, last = spans[j]
        # earlier terms may add to a chunk here, but then it is wanted by them unless their block was skipped
        open_blocks = np.flatnonzero(tops[j] + (rest[0] - most[j]) >= bar)
        if len(open_blocks) == len(tops[j]):
            wanted[s.places[first:last]] = True
        else:
            for block in open_blocks:
                wanted[s.places[first + block * BLOCK:min(last, first + (block + 1) * BLOCK)]] = True
    found = np.flatnonzero(wanted)
    score = scores(found)
    if least <= 0:  # chunks without a term
        empty = np.ones(n, bool)
        for first, last in spans:
            empty[s.places[first:last]] = False
        none = np.flatnonzero(empty)[:k]
        found, score = np.concatenate([found, none]), np.concatenate([score, np.zeros(len(none))])
    keep = np.flatnonzero(score >= bar)
    found, score = found[keep], score[keep]
    if len(found) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= cut)
        found, score = found[keep], score[keep]
    best = np.lexsort((found, -score))[:k]
    return found[best], score[best]


def search(index: Index, queries: DataFrame, top_k: int, k1: float = BM25_K1, b: float = BM25_B, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, chunk_id, rank, score)``: the ``top_k`` chunks of every query, equal scores in corpus order.

    A query that matches fewer chunks is filled with chunks of score 0 in corpus order. Queries travel to the segments, ``query_block`` of them at a time; each
    task keeps the best ``top_k`` of a query over its segments, so only those are shuffled, and no postings ever are.
    """
    asked = queries.select("query_id").distinct()
    blocks = max(1, -(-asked.count() // query_block))
    weighed = query_weights(index, queries).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    # few distinct query terms per query, one row per query
    whole = asked.join(weighed, "query_id", "left").withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    partial = None
    for block in range(blocks):
        part = _search_block(index, whole.where(F.col("_b") == block), queries.schema["query_id"].dataType, top_k, k1, b)
        partial = part if partial is None else partial.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *AT)
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    chunk_id = F.concat(F.col("doc_id").cast("string"), F.lit("::"), F.col("chunk_no").cast("string"))
    return ranked.select("query_id", chunk_id.alias("chunk_id"), "rank", "score")


def _search_block(index: Index, asked: DataFrame, query_type: T.DataType, k: int, k1: float, b: float) -> DataFrame:
    rows = asked.select("query_id", "terms").collect()  # at most about one block of queries
    ids = [r["query_id"] for r in rows]
    words = sorted({t["term"] for r in rows for t in r["terms"] or ()})
    number = {w: i for i, w in enumerate(words)}
    terms = [np.array([number[t["term"]] for t in r["terms"] or ()], np.int64) for r in rows]
    weights = [np.array([t["weight"] for t in r["terms"] or ()], float) for r in rows]
    sent = asked.sparkSession.sparkContext.broadcast((ids, words, terms, weights))
    average = index.average_length
    kind = T.StructType([T.StructField("query_id", query_type), T.StructField("doc_id", index.chunks.schema["doc_id"].dataType), T.StructField("chunk_no", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in kind.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, terms, weights = sent.value
        best: list[tuple] = [(np.empty(0), None, None)] * len(ids)
        for batch in batches:
            for i in range(batch.num_rows):
                s = _Opened(batch, i)
                # where each query term stands in the segment, or -1
                at = pc.fill_null(pc.index_in(pa.array(words, pa.string()), s.terms), -1).to_numpy() if words else np.empty(0, np.int64)
                for q in range(len(ids)):
                    held, docs, nos = best[q]
                    row = at[terms[q]]
                    there = row >= 0
                    found, score = segment_top(s, row[there], weights[q][there], k, held[-1] if len(held) == k else -np.inf, average, k1, b)
                    if not len(found):
                        continue
                    place = pa.array(found.astype(np.int64))
                    own_docs, own_nos = s.doc_ids.take(place), s.chunk_nos.take(place)
                    if docs is not None:
                        score, own_docs, own_nos = np.concatenate([held, score]), pa.concat_arrays([docs, own_docs]), pa.concat_arrays([nos, own_nos])
                        table = pa.table({"s": -score, "d": own_docs, "n": own_nos})
                        order = pc.sort_indices(table, [("s", "ascending"), ("d", "ascending"), ("n", "ascending")])[:k]
                        score, own_docs, own_nos = score[order.to_numpy()], own_docs.take(order), own_nos.take(order)
                    best[q] = (score, own_docs, own_nos)
        for q, (score, docs, nos) in enumerate(best):
            if docs is not None:
                yield pa.RecordBatch.from_arrays([pa.array([ids[q]] * len(score), schema.field(0).type), docs, nos, pa.array(score)], schema=schema)

    return index.segments.mapInArrow(scan, kind)
