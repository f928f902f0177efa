"""Language ID: a linear-chain conditional random field over the words of a text, read by forward-backward."""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lendgrid.llm.frames import fresh, slices
from lendgrid.llm.words import letters, number_texts

#: Slots of the hashed features.
SLOTS = 1 << 17
#: The sample of a fit: about so many labelled documents of each language, chosen by hash, and so many words in a row of each; languages at most.
PER_LANGUAGE, SPAN, MAX_LANGUAGES = 800, 48, 200
#: Training sequences switch language after pieces of so many words.
LEAST_PIECE, MOST_PIECE, SEQUENCE = 4, 24, 48
ROUNDS, RIDGE = 40, 2e-6
#: A word is of a language's lexicon if it was seen so often there, and so large a share of its uses.
LEAST_USES, LEAST_SHARE = 2, 0.8
UNKNOWN = "und"
#: Words of a segment; segments are walked side by side and joined by their transfer matrices.
SEGMENT = 32
#: Between words: what is no letter, and marks that follow no letter.
BETWEEN = r"^\p{M}+|[^\p{L}\p{M}]+\p{M}*"


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words (runs of letters and their marks, in lower case) of all texts one after the other, and how many each text has."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), BETWEEN)
    offsets = np.asarray(lists.offsets, np.int64)
    flat = lists.flatten()
    there = pc.greater(pc.binary_length(flat), 0)
    seen = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return flat.filter(there), np.diff(seen[offsets - offsets[0]])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_features(words: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature slots of each word, as groups of slots and the number of them that each word has: parts of 1 to 4 letters with the
    marks of the word's beginning and end (so those at an edge are its affixes), affixes of 4, and the word itself."""
    flat, begins = letters(pc.binary_join_element_wise("^", words, "$", ""))
    sizes, last = np.diff(begins), np.repeat(begins[1:], np.diff(begins))
    codes, at = flat.astype(np.uint64) + np.uint64(1), np.arange(len(flat))
    out, h = [], np.zeros(len(flat), np.uint64)
    for n in range(1, 6):
        reach = len(flat) - n + 1
        if reach <= 0:
            break
        h = h[:reach] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        if n == 1:
            continue
        inside = at[:reach] + n <= last[:reach]
        if n == 5:  # affixes only
            inside &= (codes[:reach] == ord("^") + 1) | (codes[n - 1:] == ord("$") + 1)
        where = np.flatnonzero(inside)
        counts = np.diff(np.searchsorted(where, begins))
        out.append(((_mixed(h[where] + np.uint64(n)) % np.uint64(SLOTS)).astype(np.int64), counts))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(codes * (np.uint64(0xD6E8FEB86659FD93) + (at - np.repeat(begins[:-1], sizes)).astype(np.uint64))), dtype=np.uint64)])
    whole = _mixed(sums[begins[1:]] - sums[begins[:-1]])
    out.append(((whole % np.uint64(SLOTS)).astype(np.int64), np.ones(len(sizes), np.int64)))
    return out


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the next ``counts`` rows each."""
    total = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@dataclass
class LanguageModel:
    """Weights of the field. ``weights``: slot x language; ``listed``: lexicon (0 for no entry, else 1 + language) x language;
    ``start`` and ``switch`` (from x to) hold the transitions; ``lexicon``: sorted numbers of words and their languages."""

    languages: list[str]
    weights: np.ndarray
    listed: np.ndarray
    start: np.ndarray
    switch: np.ndarray
    lexicon: tuple[np.ndarray, np.ndarray]

    def entries(self, words: pa.Array) -> np.ndarray:
        return lexicon_entries(self.lexicon, words)

    def scores(self, words: pa.Array) -> np.ndarray:
        """What each word says for each language."""
        total, n = np.zeros((len(words), len(self.languages))), np.zeros(len(words))
        for slots, counts in word_features(words):
            total += _sums(self.weights[slots], counts)
            n += counts
        return total / np.sqrt(np.maximum(n, 1))[:, None] + self.listed[self.entries(words)]


def lexicon_entries(lexicon: tuple[np.ndarray, np.ndarray], words: pa.Array) -> np.ndarray:
    """1 + the language whose lexicon has the word, or 0."""
    numbers, owners = lexicon
    if not len(numbers):
        return np.zeros(len(words), np.int64)
    own = _numbers(words)
    at = np.minimum(np.searchsorted(numbers, own), len(numbers) - 1)
    return np.where(numbers[at] == own, owners[at] + 1, 0)


def _numbers(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each word."""
    return number_texts(words)[0] if len(words) else np.empty(0, np.uint64)


def marginals(scores: np.ndarray, sizes: np.ndarray, start: np.ndarray, switch: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """P(language of a word | its whole text), for all words of texts of ``sizes`` words each, by forward-backward.

    Texts are cut into segments. First each segment's transfer matrix is the product of its steps, all segments side by side; then
    the matrices carry the forward and the backward vectors from segment to segment within each text; then the words inside all
    segments get theirs side by side. Vectors are scaled at every step, so long texts neither vanish nor overflow.
    """
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, first = np.exp(switch - switch.max()), np.exp(start - start.max())
    texts = np.flatnonzero(sizes)
    begins = (np.cumsum(sizes) - sizes)[texts]
    pieces = -(-sizes[texts] // segment)
    owner = np.repeat(np.arange(len(texts)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = begins[owner] + place * segment
    long = np.minimum(segment, sizes[texts][owner] - place * segment)
    order = np.argsort(-long, kind="stable")  # at step t the segments that reach it are the first ones
    reach = np.searchsorted(-long[order], -np.arange(segment), "left")
    heads, begin = place[order] == 0, at[order]

    def scaled(x, axis):
        return x / x.max(axis=axis, keepdims=True)

    moves = np.broadcast_to(np.eye(k), (len(order), k, k)).copy()
    for t in range(segment):
        m = reach[t]
        if not m:
            break
        new = moves[:m] @ step
        if t == 0:
            new[heads[:m]] = first  # nothing comes before a text
        moves[:m] = scaled(new * emit[begin[:m] + t][:, None, :], (1, 2))
    back_to = np.empty(len(order), np.int64)
    back_to[order] = np.arange(len(order))
    before, after = np.ones((len(order), k)), np.ones((len(order), k))
    by_pieces = np.argsort(-pieces, kind="stable")
    origin = (np.cumsum(pieces) - pieces)[by_pieces]
    for s in range(1, int(pieces.max())):
        own = origin[:np.searchsorted(-pieces[by_pieces], -s, "left")] + s
        here, there = back_to[own - 1], back_to[own]
        before[there] = scaled(np.einsum("ni,nij->nj", before[here], moves[here]), 1)
    for s in range(int(pieces.max()) - 1, 0, -1):
        own = origin[:np.searchsorted(-pieces[by_pieces], -s, "left")] + s
        here, there = back_to[own], back_to[own - 1]
        after[there] = scaled(np.einsum("nij,nj->ni", moves[here], after[here]), 1)
    out = np.empty((n, k))
    now = before
    for t in range(segment):
        m = reach[t]
        if not m:
            break
        new = now[:m] @ step
        if t == 0:
            new[heads[:m]] = first
        now[:m] = scaled(new * emit[begin[:m] + t], 1)
        out[begin[:m] + t] = now[:m]
    now = after
    for t in range(segment - 1, -1, -1):
        m = reach[t]
        rows = begin[:m] + t
        out[rows] *= now[:m]
        now[:m] = scaled((now[:m] * emit[rows]) @ step.T, 1)
    return out / out.sum(axis=1, keepdims=True)


class _Likelihood:
    """Penalised negative log-likelihood of labelled sequences of equal length and its slope."""

    def __init__(self, words: pa.Array, index: np.ndarray, labels: np.ndarray, entries: np.ndarray, k: int):
        self.index, self.labels, self.entries, self.k = index, labels, entries, k
        groups = word_features(words)
        owner = np.concatenate([np.repeat(np.arange(len(words)), counts) for _, counts in groups])
        slots = np.concatenate([s for s, _ in groups])
        order = np.argsort(owner, kind="stable")
        self.owner, self.counts = owner[order], np.bincount(owner, minlength=len(words))
        self.used, self.column = np.unique(slots[order], return_inverse=True)
        self.scale = 1 / np.sqrt(np.maximum(self.counts, 1))
        by = np.argsort(self.column, kind="stable")
        self.by_owner, self.per_column = self.owner[by], np.bincount(self.column, minlength=len(self.used))
        self.sizes = (len(self.used) * k, (k + 1) * k, k, k * k)

    def parts(self, x: np.ndarray):
        w, listed, start, switch = np.split(x, np.cumsum(self.sizes)[:-1])
        return w.reshape(-1, self.k), listed.reshape(-1, self.k), start, switch.reshape(self.k, self.k)

    def __call__(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        w, listed, start, switch = self.parts(x)
        k, (rows, length) = self.k, self.index.shape
        scores = (_sums(w[self.column], self.counts) * self.scale[:, None] + listed[self.entries])[self.index]
        top = scores.max(axis=2, keepdims=True)
        emit = np.exp(scores - top)
        step, first = np.exp(switch), np.exp(start)
        forward, backward, scales = np.empty_like(emit), np.ones_like(emit), np.empty((rows, length))
        for t in range(length):
            new = (first[None, :] if t == 0 else forward[:, t - 1] @ step) * emit[:, t]
            scales[:, t] = new.sum(axis=1)
            forward[:, t] = new / scales[:, t, None]
        for t in range(length - 2, -1, -1):
            backward[:, t] = (emit[:, t + 1] * backward[:, t + 1]) @ step.T / scales[:, t + 1, None]
        each = forward * backward
        at = np.arange(rows)[:, None], np.arange(length)[None, :], self.labels
        log_z = np.log(scales).sum() + top.sum()
        path = scores[at].sum() + start[self.labels[:, 0]].sum() + switch[self.labels[:, :-1], self.labels[:, 1:]].sum()
        both = np.einsum("nti,ntj,nt->ij", forward[:, :-1], emit[:, 1:] * backward[:, 1:], 1 / scales[:, 1:]) * step
        seen = np.zeros((k, k))
        np.add.at(seen, (self.labels[:, :-1].ravel(), self.labels[:, 1:].ravel()), 1)
        off = each.copy()
        off[at] -= 1
        flat, total = off.reshape(-1, k), rows * length
        by_word = np.stack([np.bincount(self.index.ravel(), flat[:, j], len(self.counts)) for j in range(k)], axis=1)
        slope_w = _sums((by_word * self.scale[:, None])[self.by_owner], self.per_column)
        slope_l = np.stack([np.bincount(self.entries, by_word[:, j], k + 1) for j in range(k)], axis=1)
        slope = np.concatenate([slope_w.ravel(), slope_l.ravel(), off[:, 0].sum(axis=0), (both - seen).ravel()]) / total
        return float((log_z - path) / total + 0.5 * RIDGE * (x @ x)), slope + RIDGE * x


def _minimum(goal: _Likelihood, x: np.ndarray, rounds: int) -> np.ndarray:
    """L-BFGS with halved steps."""
    value, slope = goal(x)
    memory: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        move, parts = -slope, []
        for s, y, r in reversed(memory):
            parts.append(r * (s @ move))
            move = move - parts[-1] * y
        move = move * (memory[-1][0] @ memory[-1][1] / (memory[-1][1] @ memory[-1][1]) if memory else 1 / max(1e-12, np.sqrt(slope @ slope)))
        for (s, y, r), a in zip(memory, reversed(parts)):
            move = move + (a - r * (y @ move)) * s
        size = 1.0
        while True:
            new_x = x + size * move
            new_value, new_slope = goal(new_x)
            if new_value <= value + 1e-4 * size * (slope @ move) or size < 1e-6:
                break
            size /= 2
        s, y = new_x - x, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            memory = [*memory, (s, y, 1 / (s @ y))][-8:]
        gain, x, value, slope = value - new_value, new_x, new_value, new_slope
        if gain < 1e-6:
            break
    return x


def fit_field(spans: list[tuple[str, list[str]]], rounds: int = ROUNDS, seed: int = 7) -> LanguageModel:
    """A field fitted to ``spans`` of words with the language of their document.

    Every second span makes the lexicons, the others make training sequences; so how far a lexicon can be trusted is learned from words
    that are not in it by construction. The sequences put pieces of spans of drawn languages after one another, each word with its own
    label, so that transitions are learned from text that switches. With few spans all serve both.
    """
    languages = sorted({lang for lang, words in spans if words})
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    listing, training = (spans[::2], spans[1::2]) if len({lang for lang, w in spans[::2] if w}) == k == len({lang for lang, w in spans[1::2] if w}) else (spans, spans)
    uses: dict[str, Counter] = {}
    for lang, words in listing:
        for word in words:
            uses.setdefault(word, Counter())[number[lang]] += 1
    owned = [(w, max(c, key=lambda i: (c[i], -i))) for w, c in uses.items() if max(c.values()) >= max(LEAST_USES, LEAST_SHARE * sum(c.values()))]
    numbers = _numbers(pa.array([w for w, _ in owned], pa.string()))
    order = np.argsort(numbers)
    lexicon = numbers[order], np.array([i for _, i in owned], np.int64)[order]
    if not k:
        return LanguageModel([], np.zeros((SLOTS, 0)), np.zeros((1, 0)), np.zeros(0), np.zeros((0, 0)), lexicon)
    rng = np.random.default_rng(seed)
    pools = [[w for lang, w in training if lang == name and w] for name in languages]
    total = sum(len(w) for p in pools for w in p)
    words, labels = [], []
    while len(words) < max(total, 8 * SEQUENCE * k):
        lang = int(rng.integers(k))  # languages are drawn alike, however many spans they have
        span = pools[lang][int(rng.integers(len(pools[lang])))]
        size = int(rng.integers(LEAST_PIECE, MOST_PIECE + 1))
        begin = int(rng.integers(max(1, len(span) - size + 1)))
        piece = span[begin:begin + size]
        words += piece
        labels += [lang] * len(piece)
    whole = len(words) // SEQUENCE * SEQUENCE
    encoded = pa.array(words[:whole], pa.string()).dictionary_encode()
    index = encoded.indices.to_numpy().reshape(-1, SEQUENCE)
    goal = _Likelihood(encoded.dictionary, index, np.array(labels[:whole], np.int64).reshape(-1, SEQUENCE), lexicon_entries(lexicon, encoded.dictionary), k)
    w, listed, start, switch = goal.parts(_minimum(goal, np.zeros(sum(goal.sizes)), rounds))
    weights = np.zeros((SLOTS, k), np.float32)
    weights[goal.used] = w
    return LanguageModel(languages, weights, listed, start, switch, lexicon)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from the fit: CRC-32 of its id as text is 1 modulo 3. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on about ``per_language`` documents of each language (the ``MAX_LANGUAGES`` most frequent) that are not held out.

    Documents are chosen by the hash of their id, and give the ``SPAN`` words from a place that the hash picks. One task fits this
    bounded sample; the driver gets counts per language and the model. Rows without a language, a text or a word give nothing.
    """
    known = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"),
                        held_out(F.col(f"`{doc_id}`")).alias("held")).filter("lang IS NOT NULL AND text IS NOT NULL AND NOT held")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return fit_field([])
    rates = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(per_language / r["n"]))])
    draw = F.shiftrightunsigned(F.xxhash64("id", F.lit("languages")), 11) / F.lit(float(1 << 53))
    chosen = known.filter(draw < F.element_at(rates, F.col("lang"))).select("id", "lang", "text")

    def cut(batches):
        for part in slices(batches, "text", 2 << 20):
            words, sizes = text_words(part.column(2))
            begins = np.cumsum(sizes) - sizes
            spans = []
            for i, (b, n) in enumerate(zip(begins.tolist(), sizes.tolist())):
                first = zlib.crc32(b"span " + part.column(0)[i].as_py().encode("utf-8", "surrogatepass")) % max(1, n - SPAN + 1)
                spans.append(words.slice(b + first, min(SPAN, n)).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(spans, pa.list_(pa.string()))], names=["id", "lang", "words"])

    spans = chosen.mapInArrow(cut, "id string, lang string, words array<string>").repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "lang")

    def fit(batches):
        rows = [(a, w) for b in batches for a, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_field(rows))], pa.binary())], names=["model"])

    return pickle.loads(spans.mapInArrow(fit, "model binary").first()["model"])


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, and with ``spans`` also ``lang_spans``: the stretches of words of one language (``lang``,
    ``first`` word, ``words``), each word with its likeliest language.

    The language of a text is the one with the largest expected share of its words, and the score is that share; of equal shares the first
    language in order wins. A text that is null or has no letter is ``und`` with score 0 and no spans, and so is every text if no language was
    learned. Columns of ``docs`` with one of these names are replaced. Whole texts are read, where they are; rows never move.
    """
    new = ["lang_pred", "score", *["lang_spans"] * spans]
    base = docs.drop(*[c for c in docs.columns if c.lower() in new])
    at = base.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        k, names = len(m.languages), np.array([*m.languages, UNKNOWN], object)
        for part in slices(batches, text, 4 << 20):
            words, sizes = text_words(part.column(at))
            if not k:
                words, sizes = words.slice(0, 0), np.zeros_like(sizes)
            encoded = words.dictionary_encode()
            each = marginals(m.scores(encoded.dictionary)[encoded.indices.to_numpy()], sizes, m.start, m.switch)
            best, score = np.full(len(sizes), k), np.zeros(len(sizes))
            has = np.flatnonzero(sizes)
            if len(has):
                share = np.add.reduceat(each, (np.cumsum(sizes) - sizes)[has], axis=0) / sizes[has][:, None]
                best[has] = share.argmax(axis=1)
                score[has] = np.clip(share.max(axis=1), 0, 1)
            columns = [pa.array(names[best].tolist(), pa.string()), pa.array(score)]
            if spans:
                columns.append(_stretches(each, sizes, names))
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *new])

    kinds = {"lang_pred": T.StringType(), "score": T.DoubleType(), "lang_spans": T.ArrayType(T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("first", T.LongType()), T.StructField("words", T.LongType())]))}
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *[T.StructField(c, kinds[c]) for c in new]]))


def _stretches(each: np.ndarray, sizes: np.ndarray, names: np.ndarray) -> pa.Array:
    owner = np.repeat(np.arange(len(sizes)), sizes)
    label = each.argmax(axis=1) if len(each) else np.empty(0, np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])])) if len(owner) else np.empty(0, np.int64)
    first = cut - (np.cumsum(sizes) - sizes)[owner[cut]]
    fields = [pa.array(names[label[cut]].tolist(), pa.string()), pa.array(first, pa.int64()), pa.array(np.diff(np.append(cut, len(owner))), pa.int64())]
    inner = pa.StructArray.from_arrays(fields, names=["lang", "first", "words"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[cut], minlength=len(sizes)))]), pa.int32()), inner)


def detect_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id held_out lang_pred score`` of every row of ``docs``, by a field fitted to its labelled rows that are not held out."""
    model = train_languages(docs, doc_id, text, lang)
    body, flag = fresh(docs, "body", "flag")
    rows = docs.select(F.col(f"`{doc_id}`"), held_out(F.col(f"`{doc_id}`")).alias(flag), F.col(f"`{text}`").alias(body))
    return identify_languages(rows, model, body).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(flag).alias("held_out"), "lang_pred", "score")
