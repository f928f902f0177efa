"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendgrid.llm.frames import fresh, slices, written
from lendgrid.llm.words import number_texts, number_words, plain_words

#: Hashed vocabulary, dimensions of the latent space, and spare dimensions of the randomised SVD.
SLOTS, RANK, SPARE = 1 << 13, 96, 8
#: Windows of the texts start every BLOCK words and are 2 or 4 blocks long; items are cut into passages that fit in one.
BLOCK, PASSAGE = 16, 48
#: Passages multiplied at a time, and slots whose rows of a product travel together.
PASSAGES_AT_ONCE, SLOT_RUN = 32, 256
#: A window is a candidate if it scores like one that holds this share of a passage's weight.
SHARE = 0.55
#: A passage has leaked if so much of it is there in order, or less with its answer.
LCS_SURE, LCS_WITH_ANSWER = 0.8, 0.6
ANSWER_WORDS = 5
_PIECE = 1 << 15


def lcs_length(pattern: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a bit of an integer for each place of the pattern."""
    places: dict[int, int] = {}
    for i, w in enumerate(pattern):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for w in text:
        match = places.get(w)
        if match:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(pattern) - row.bit_count()


def _holds(text: list[int], part: list[int]) -> bool:
    n = len(part)
    return any(text[i:i + n] == part for i in range(len(text) - n + 1)) if n else False


@dataclass
class Passages:
    """The benchmark's passages: item, words as numbers, and whether the item's answer, ``answers``, ends in this passage."""

    items: list[int | None]
    words: list[list[int]]
    answers: list[list[int]]


def cut_items(rows: list[tuple[int | None, str | None, str | None]]) -> Passages:
    """Passages of (item, text, answer). Without an answer its last words stand for it; items without words have none."""
    found = Passages([], [], [])
    for item, text, answer in rows:
        words = number_words(plain_words(text or ""))
        if not words:
            continue
        reply = number_words(plain_words(answer or "")) or words[-ANSWER_WORDS:]
        n = -(-len(words) // PASSAGE)
        for i in range(n):
            found.items.append(item)
            found.words.append(words[len(words) * i // n:len(words) * (i + 1) // n])
            found.answers.append(reply)
    return found


def _slot(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(7)).astype(np.int64) % SLOTS


def _passage_starts(ends: np.ndarray, size: int) -> np.ndarray:
    begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return np.concatenate([np.arange(a, b, size) for a, b in zip(begin.tolist(), ends.tolist())]) if len(ends) else np.empty(0, np.int64)


def _frequencies(batches):
    """Of each task: in how many passages each slot occurs, at -1 the number of passages."""
    counts, passages = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        for slots, starts in zip(*(c.to_pylist() for c in batch.columns)):
            flat, starts = np.frombuffer(slots, np.uint16), np.frombuffer(starts, np.int32)
            passages += len(starts)
            row = np.zeros(len(flat), np.int64)
            row[starts[1:]] = 1
            pairs = np.cumsum(row) * SLOTS + flat
            pairs.sort()
            counts += np.bincount(pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] % SLOTS, minlength=SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], used])), pa.array(np.concatenate([[passages], counts[used]]))], names=["slot", "n"])


def _passage_slots(batches):
    """Of each slice: the slots of its words, two bytes each, and where its passages start."""
    for part in slices(batches, "text", 2 << 20):
        flat, ends = number_texts(part.column(0))
        if len(flat):
            starts = _passage_starts(ends, 4 * BLOCK).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([_slot(flat).astype(np.uint16).tobytes()], pa.binary()), pa.array([starts.tobytes()], pa.binary())], names=["slots", "starts"])


def _gram(flat: np.ndarray, starts: np.ndarray, idf: np.ndarray, basis: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` the sum over unit TF-IDF rows a of a (a . basis); ``flat`` are the slots of all rows, and ``starts`` where each begins.

    The rows of one call are summed in single precision, calls in that of ``out``.
    """
    bounds = np.append(starts, len(flat)).astype(np.int64)
    weight, sizes = idf[flat], np.diff(bounds)
    row, place, there, sums = np.repeat(np.arange(len(sizes)), sizes), np.zeros(SLOTS, np.int64), np.zeros(SLOTS, bool), np.zeros(out.shape, np.float32)
    weight = weight / np.sqrt(np.add.reduceat(weight * weight, bounds[:-1]))[row]
    for at in range(0, len(starts), PASSAGES_AT_ONCE):
        n = min(PASSAGES_AT_ONCE, len(starts) - at)
        some = slice(bounds[at], bounds[at + n])
        # a small dense matrix over the slots that these passages have, so that both products are quick
        there[flat[some]] = True
        used = np.flatnonzero(there)
        there[used] = False
        place[used] = np.arange(len(used))
        dense = np.bincount((row[some] - at) * len(used) + place[flat[some]], weight[some], n * len(used)).astype(np.float32).reshape(n, -1)
        sums[used] += dense.T @ (dense @ basis.take(used, axis=0))
    out += sums


def _corpus_product(found: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The sum of ``_gram`` over all passages of the corpus: a task per core sums up its own, and these sums are added in the cluster,
    a run of slots at a time. What reaches the driver is one matrix of slots x directions."""
    context = found.sparkSession.sparkContext
    sent = context.broadcast((idf, basis))
    kinds = "run int, rows binary"

    def of(run, rows):
        return pa.RecordBatch.from_arrays([pa.array([run], pa.int32()), pa.array([rows.astype(np.float32).tobytes()], pa.binary())], names=["run", "rows"])

    def product(batches):
        weights, directions = sent.value
        out = None
        for batch in batches:
            for slots, starts in zip(*(c.to_pylist() for c in batch.columns)):
                out = np.zeros(directions.shape) if out is None else out
                _gram(np.frombuffer(slots, np.uint16), np.frombuffer(starts, np.int32), weights, directions, out)
        for run in range(0, 0 if out is None else SLOTS, SLOT_RUN):
            yield of(run, out[run:run + SLOT_RUN])

    def add(batches):
        sums = {}
        for batch in batches:
            for run, rows in zip(*(c.to_pylist() for c in batch.columns)):
                sums[run] = sums.get(run, 0) + np.frombuffer(rows, np.float32).astype(np.float64)
        for run, rows in sums.items():
            yield of(run, rows)

    image = np.zeros(basis.shape)
    parts = found.coalesce(context.defaultParallelism).mapInArrow(product, kinds)
    for r in parts.repartition("run").mapInArrow(add, kinds).collect():
        image[r["run"]:r["run"] + SLOT_RUN] = np.frombuffer(r["rows"], np.float32).reshape(-1, basis.shape[1])
    sent.destroy()
    return image


def fit_space(texts: DataFrame, passages: Passages, rank: int = RANK, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """IDF over all passages of ``texts`` and a basis of the latent space (slots x rank).

    The basis is a randomised SVD with one power step of all corpus passages, together with the benchmark's passages at the same
    total weight. The products with the passages run in tasks over their slots, written once (two bytes a word);
    what reaches the driver is a few slots x rank matrices, whatever the corpus.
    """
    found = written(texts.mapInArrow(_passage_slots, "slots binary, starts binary"), "passage-slots")
    counted = found.mapInArrow(_frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    seen = {r["slot"]: r["n"] for r in counted}
    total = seen.pop(-1, 0)
    df = np.zeros(SLOTS)
    df[list(seen)] = list(seen.values())
    idf = np.log((total + 1) / (df + 1) + 1).astype(np.float32)
    own = [_slot(np.array(w, np.uint64)) for w in passages.words]
    begins = np.cumsum([0, *(len(w) for w in own[:-1])])
    basis = np.random.default_rng(seed).standard_normal((SLOTS, rank + SPARE), np.float32) / np.float32(SLOTS**0.5)
    for _ in range(2):
        image = np.zeros(basis.shape)
        if own:
            _gram(np.concatenate(own), begins, idf, basis, image)
        image = image * (max(1, total) / max(1, len(own))) + _corpus_product(found, idf, basis)
        basis = _left_vectors(image.astype(np.float32))
    return idf, basis[:, :rank].copy()


def _left_vectors(image: np.ndarray) -> np.ndarray:
    """Left singular vectors of a tall matrix, largest first, by way of its small Gram matrix."""
    small = np.zeros((image.shape[1],) * 2)
    for at in range(0, len(image), 2048):
        part = image[at:at + 2048].astype(np.float64)
        small += part.T @ part
    values, vectors = np.linalg.eigh(small)
    scale = np.sqrt(np.maximum(values[::-1], values[-1] * 1e-12 + 1e-30))
    return image @ (vectors[:, ::-1] / scale).astype(np.float32)


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """``doc_id item_id cosine lcs answer_found``: one row for each benchmark item and row of ``docs`` that holds a passage of it.

    ``benchmark`` has ``item_id``, ``text`` and perhaps ``answer``; it is the query set and goes to every task. Texts are cut
    into overlapping windows, all of them compared with all passages by latent cosine; candidates are verified on the words:
    the longest common subsequence must cover ``LCS_SURE`` of the passage, or ``LCS_WITH_ANSWER`` of it if the answer is there
    too. ``lcs`` is the best share, ``cosine`` that window's. Texts and items without words give no rows; an empty benchmark
    gives none; rows with the same id are searched each.
    """
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    passages = cut_items([tuple(r) for r in benchmark.select("item_id", "text", answer).orderBy("item_id", "text").collect()])
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, item_id long, cosine double, lcs double, answer_found boolean"
    if not passages.words:
        return docs.sparkSession.createDataFrame([], schema)
    idf, basis = fit_space(texts.select("text"), passages)
    queries = np.zeros((len(passages.words), basis.shape[1]), np.float32)
    least = np.zeros(len(passages.words), np.float32)
    for i, words in enumerate(passages.words):
        slots = _slot(np.array(words, np.uint64))
        norm = np.sqrt(float(idf[slots] @ idf[slots]))
        queries[i] = (idf[slots, None] * basis[slots]).sum(axis=0) / norm
        # what a window of this weight scores if it holds `share` of the passage
        least[i] = share * float(queries[i] @ queries[i]) * norm
    latent = np.vstack([idf[:, None] * basis, np.zeros((1, basis.shape[1]), np.float32)])
    del basis
    sent = docs.sparkSession.sparkContext.broadcast((np.append(idf, np.float32(0)), latent, queries, least, passages))
    del latent

    def run(batches):
        weights, latent, queries, least, passages = sent.value
        short = np.array([len(w) <= BLOCK + 1 for w in passages.words])
        for part in slices(batches, "text", 2 << 20):
            ids = part.column(0).to_pylist()
            flat, ends = number_texts(part.column(1))
            hits = _candidates(flat, ends, weights, latent, queries, least, short)
            yield _verified(ids, flat, ends, hits, passages)

    return texts.mapInArrow(run, schema)


def _candidates(flat, ends, weights, latent, queries, least, short):
    """The windows that may hold a passage, as arrays: document, passage, first word, end, cosine."""
    found = []
    begin = np.concatenate([[0], ends[:-1]])
    blocks_of = -(-(ends - begin) // BLOCK)
    last = np.cumsum(blocks_of)
    doc = np.repeat(np.arange(len(ends)), blocks_of)
    starts = begin[doc] + BLOCK * (np.arange(len(doc)) - np.repeat(last - blocks_of, blocks_of))
    # each text is filled up to whole blocks with a slot of weight 0, so that blocks can be summed as rows of a matrix
    slots = np.full(len(doc) * BLOCK, SLOTS)
    slots[np.arange(len(flat)) + np.repeat((last - blocks_of) * BLOCK - begin, ends - begin)] = _slot(flat)
    slots = slots.reshape(-1, BLOCK)
    per = _PIECE // BLOCK
    for at in range(0, len(starts), per):
        # windows of up to 4 blocks go on into the next piece
        some = slice(at, min(at + per + 3, len(starts)))
        own = min(at + per, len(starts)) - at
        sums = latent[slots[some]].sum(axis=1)
        square = (weights[slots[some]] ** 2).sum(axis=1)
        for blocks, which in ((2, short), (4, ~short)):
            step = blocks // 2
            same = (doc[some][step:] == doc[some][:-step]).astype(np.float32)
            sums = sums.copy()
            sums[:-step] += sums[step:] * same[:, None]
            square = square.copy()
            square[:-step] += square[step:] * same
            columns = np.flatnonzero(which)
            if not len(columns):
                continue
            norm = np.sqrt(np.maximum(square[:own], 1e-12))
            dots = sums[:own] @ queries[columns].T
            window, column = np.nonzero(dots >= least[columns])
            first, own_doc = starts[at + window], doc[at + window]
            end = np.minimum(first + blocks * BLOCK, ends[own_doc])
            found.append((own_doc, columns[column], first, end, dots[window, column] / norm[window]))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 5


def _enough_common(spans, sizes, table, counts, least):
    """Which spans have at least ``least`` words in common with a passage, repeats included: no subsequence is longer.

    ``spans`` are rows of the texts' places in the vocabulary, valid up to their ``sizes``, ``table`` the passage's own number
    of each place (0: not there), and ``counts`` how often the passage has each of its words.
    """
    own = table.take(spans, mode="clip")
    own *= np.arange(own.shape[1], dtype=np.int32) < sizes[:, None]
    # words that the passage has at all bound the number from above, and leave few spans to count word by word
    alive = np.flatnonzero(np.count_nonzero(own, axis=1) >= least)
    kinds = len(counts) + 1
    there = own[alive] + kinds * np.arange(len(alive))[:, None]
    there = np.bincount(there.ravel(), minlength=kinds * len(alive)).reshape(-1, kinds)[:, 1:]
    return alive[np.minimum(there, counts).sum(axis=1) >= least]


def _verified(ids, flat, ends, hits, passages: Passages):
    """Candidates whose words hold the passage; the subsequence is sought only where enough common words allow it."""
    best: dict[tuple[int, int], tuple] = {}
    doc, query, first, end, cosine = hits
    if len(doc):
        vocabulary = np.unique(np.concatenate([np.array(w, np.uint64) for w in passages.words]))
        number = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1).astype(np.int32)
        number[vocabulary[number] != flat] = len(vocabulary)
        table = np.zeros(len(vocabulary) + 1, np.uint8)  # a passage has PASSAGE words at most
        begin = np.concatenate([[0], ends[:-1]])
        low, high = np.maximum(begin[doc], first - BLOCK), np.minimum(ends[doc], end + BLOCK)
        widest = int((high - low).max())
        spans = np.lib.stride_tricks.sliding_window_view(np.append(number, np.full(widest, len(vocabulary), np.int32)), widest)
        order = np.argsort(query, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(query[order])) + 1):
            q = int(query[some[0]])
            pattern, answer = passages.words[q], passages.answers[q]
            words, counts = np.unique(np.array(pattern, np.uint64), return_counts=True)
            places = np.searchsorted(vocabulary, words)
            table[places] = np.arange(1, len(words) + 1)
            for at in range(0, len(some), 1024):
                part = some[at:at + 1024]
                enough = _enough_common(spans[low[part]], high[part] - low[part], table, counts, LCS_WITH_ANSWER * len(pattern) - 1e-9)
                for i in part[enough].tolist():
                    text = flat[low[i]:high[i]].tolist()
                    share = lcs_length(pattern, text) / len(pattern)
                    if share >= LCS_WITH_ANSWER:
                        holds = _holds(text, answer)
                        if share >= LCS_SURE or holds:
                            key = (int(doc[i]), passages.items[q])
                            best[key] = max(best.get(key, (0.0, 0.0, False)), (share, float(cosine[i]), holds))
            table[places] = 0
    rows = [(ids[d], item, cosine, share, found) for (d, item), (share, cosine, found) in sorted(best.items(), key=repr)]
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                      names=["doc_id", "item_id", "cosine", "lcs", "answer_found"])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id has no leak; rows without an id are kept if no row without one has a leak."""
    (name,) = fresh(docs, "leaked_id")
    leaked = written(find_leaks(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(name)).distinct(), "leaked")
    return docs.join(leaked, F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(name)), "left_anti")
