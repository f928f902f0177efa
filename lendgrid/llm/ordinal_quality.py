"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lendgrid.llm.frames import fresh, slices
from lendgrid.llm.words import Remembered

SLOTS = 1 << 18
#: Labelled rows that a fit takes at most: those with the smallest hash of their id. Scoring takes all rows.
MAX_LABELLED = 6000
GRADES = 3
#: L-BFGS rounds: at most, and without enough labels to measure when to stop; a fit stops after PATIENCE rounds without a gain on held-out rows.
MOST_ROUNDS, ROUNDS, PATIENCE = 400, 100, 40
#: Held-out parts of the labelled rows; the share of their clean rows that the cut keeps; clean rows and others that a cut needs.
FOLDS, KEEP_CLEAN, LEAST_CLEAN, LEAST_OTHERS = 4, 0.985, 200, 40
#: Labelled rows that must hold a slot before it gets a weight in such a fit: rarer ones only tell the labelled rows apart.
LEAST_ROWS = 10
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]")


def _slots(word: str) -> tuple[int, ...]:
    slot = zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS
    return (slot, zlib.crc32(b"begins " + word[:4].encode("utf-8", "surrogatepass")) % SLOTS) if len(word) > 4 else (slot,)


def features(text: str | None, slots: Remembered) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, word beginnings and signs of a text with the logarithm of their counts, and two marks of its shape (tenths
    of distinct tokens and of words in capitals), scaled to length 1."""
    lower: Counter = Counter()
    tokens = capitals = 0
    for token, n in Counter(_TOKEN.findall(text or "")).items():
        lower[token.lower()] += n
        tokens += n
        capitals += n * (len(token) > 1 and token.isupper())
    counts: Counter = Counter()
    for token, n in lower.items():
        for slot in slots[token]:
            counts[slot] += n
    if tokens:
        counts[zlib.crc32(b"distinct %d" % (10 * len(lower) // tokens)) % SLOTS] += 1
        counts[zlib.crc32(b"capitals %d" % (10 * capitals // tokens)) % SLOTS] += 1
    index = np.fromiter(counts.keys(), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    return index, value / max(1e-12, np.sqrt(value @ value)) if len(value) else value


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . features): one set of weights, ordered thresholds.

    A document stays if P(top grade) is ``cut`` or more.
    """

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns; their sum is the expected grade."""
        return 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.array([float(self.weights[i] @ v) for i, v in rows])


def _order(scores: np.ndarray, grades: np.ndarray) -> float:
    """How well scores part the top grade from the others: the AUC against each lower grade, averaged, so that a rare one counts as much."""
    top = np.sort(scores[grades == GRADES - 1])
    if not len(top):
        return 0.0
    areas = []
    for k in range(GRADES - 1):
        low = scores[grades == k]
        if len(low):
            beaten = len(top) - (np.searchsorted(top, low, "left") + np.searchsorted(top, low, "right")) / 2
            areas.append(float(beaten.mean()) / len(top))
    return float(np.mean(areas)) if areas else 0.0


class _Likelihood:
    """Penalised negative log-likelihood of the labelled rows; weights of the used slots, the first threshold, logarithms of the gaps."""

    def __init__(self, rows, grades: np.ndarray, ridge: float):
        self.grades, self.ridge, self.n = grades, ridge, len(rows)
        sizes = np.array([len(r[0]) for r in rows])
        index, self.value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        self.used, self.column = np.unique(index, return_inverse=True)
        self.rows = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.rows]
        order = np.argsort(self.column, kind="stable")
        self.by_column, self.row_of = self.value[order], np.repeat(np.arange(self.n), sizes)[order]
        self.heads = np.searchsorted(self.column[order], np.arange(len(self.used)))

    def thresholds(self, x: np.ndarray) -> np.ndarray:
        own = x[len(self.used):]
        return np.cumsum(np.concatenate([own[:1], np.exp(np.clip(own[1:], -20, 20))]))

    def __call__(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        w, thresholds, grades = x[:len(self.used)], self.thresholds(x), self.grades
        z = np.zeros(self.n)
        if len(w):
            z[self.rows] = np.add.reduceat(self.value * w[self.column], self.starts)
        edges = np.concatenate([[-1e4], thresholds, [1e4]])
        above, below = _sigmoid(edges[grades + 1] - z), _sigmoid(edges[grades] - z)
        p = np.maximum(above - below, 1e-12)
        up, down = above * (1 - above) / p, below * (1 - below) / p
        slope = np.add.reduceat(self.by_column * (up - down)[self.row_of], self.heads) / self.n + self.ridge * w if len(w) else w
        shift = np.array([down[grades == k + 1].sum() - up[grades == k].sum() for k in range(len(thresholds))]) / self.n
        later = np.cumsum(shift[::-1])[::-1]  # a gap moves its threshold and all later ones
        later[1:] *= np.diff(thresholds)
        return float(-np.log(p).mean() + 0.5 * self.ridge * (w @ w)), np.concatenate([slope, later])


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, rounds: int = ROUNDS, ridge: float = 1e-5, held=None) -> OrdinalModel:
    """Penalised maximum likelihood by L-BFGS over all rows. Without rows, or with one grade only, thresholds alone are set.

    With ``held`` (rows and grades) the fit stops ``PATIENCE`` rounds after their order (``_order``) last got better, and that best model
    is returned.
    """
    n, top = len(rows), GRADES - 1
    share = np.array([(np.sum(grades <= k) + 0.5) / (n + 1) for k in range(top)])
    thresholds = np.log(share / (1 - share))
    if n == 0 or len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(SLOTS), thresholds)
    goal = _Likelihood(rows, grades, ridge)

    def model(x):
        weights = np.zeros(SLOTS)
        weights[goal.used] = x[:len(goal.used)]
        return OrdinalModel(weights, goal.thresholds(x))

    x = np.concatenate([np.zeros(len(goal.used)), thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    value, slope = goal(x)
    memory: list[tuple[np.ndarray, np.ndarray, float]] = []
    best, best_order, best_round = model(x), -1.0, 0
    for i in range(1, rounds + 1):
        move, parts = -slope, []
        for s, y, r in reversed(memory):
            parts.append(r * (s @ move))
            move = move - parts[-1] * y
        move = move * (memory[-1][0] @ memory[-1][1] / (memory[-1][1] @ memory[-1][1]) if memory else 1 / max(1e-12, np.sqrt(slope @ slope)))
        for (s, y, r), a in zip(memory, reversed(parts)):
            move = move + (a - r * (y @ move)) * s
        if slope @ move >= 0:
            move, memory = -slope, []
        step = 1.0
        while True:
            new_x = x + step * move
            new_value, new_slope = goal(new_x)
            if new_value <= value + 1e-4 * step * (slope @ move) or step < 1e-8:
                break
            step /= 2
        s, y = new_x - x, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            memory = [*memory, (s, y, 1 / (s @ y))][-10:]
        gain, x, value, slope = value - new_value, new_x, new_value, new_slope
        if held is not None:
            now = model(x)
            order = _order(now.scores(held[0]), held[1])
            if order > best_order:
                best, best_order, best_round = now, order, i
        if gain < 1e-9 or (held is not None and i - best_round >= PATIENCE):
            break
    return model(x) if held is None else best


def fit_with_cut(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray) -> OrdinalModel:
    """The mean of ``FOLDS`` fits, whose lengths and cut come from held-out rows.

    Each part (equal texts share one) is scored by a fit on the others that stops when the part is parted no better. The cut is
    the highest one that keeps ``KEEP_CLEAN`` of the rows of the top grade, each scored by the fit that did not see it. With too
    few rows of either kind to measure, one fit takes all rows and slots for ``ROUNDS`` rounds and the cut is 0.5.
    """
    clean = grades == GRADES - 1
    fold = np.array([zlib.crc32(i.tobytes() + v.tobytes()) % FOLDS for i, v in rows], np.int64)
    if clean.sum() < LEAST_CLEAN or (~clean).sum() < LEAST_OTHERS or len(np.unique(fold)) < FOLDS:
        return fit_ordinal(rows, grades)
    held_by = np.bincount(np.concatenate([i for i, _ in rows]), minlength=SLOTS)
    rows = [(i[known], v[known]) for i, v in rows for known in [held_by[i] >= LEAST_ROWS]]
    chance, weights, thresholds = np.zeros(len(rows)), np.zeros(SLOTS), np.zeros(GRADES - 1)
    for k in range(FOLDS):
        inside, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        part = [rows[i] for i in out]
        found = fit_ordinal([rows[i] for i in inside], grades[inside], MOST_ROUNDS, held=(part, grades[out]))
        chance[out] = found.tails(found.scores(part))[:, -1]
        weights += found.weights / FOLDS
        thresholds += found.thresholds / FOLDS
    return OrdinalModel(weights, thresholds, float(np.quantile(chance[clean], 1 - KEEP_CLEAN, method="lower")))


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Graded rating of a label: 0 poor, 1 good but toxic, 2 good and clean; null if the quality is missing."""
    return F.when(F.col(quality) == 0, 0).when(F.col(quality).isNull(), None).when(F.col(toxic) == 1, 1).otherwise(2)


def train_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """Fit on at most ``max_labelled`` labelled documents, chosen by the hash of their id.

    ``labels`` has ``doc_id quality toxic``; rows without an id or a quality are left out. The chosen labels are few enough to be
    sent to the texts; features are made where the texts are, one task fits them, and the driver
    gets the model.
    """
    rated = labels.select(F.col("doc_id").cast("long").alias("rated_id"), grade_of().alias("grade")).filter("rated_id IS NOT NULL AND grade IS NOT NULL")
    chosen = rated.orderBy(F.xxhash64("rated_id"), "rated_id", "grade").limit(max_labelled)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")).select("doc_id", "text", "grade")

    def extract(batches):
        slots = Remembered(_slots)
        for part in slices(batches, "text", 4 << 20):
            made = [features(t, slots) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([i.astype(np.int32).tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())], names=["doc_id", "grade", "slots", "weights"])

    made = sample.mapInArrow(extract, "doc_id long, grade int, slots binary, weights binary")
    # repeated documents or labels may bring more rows than labels
    bounded = made.orderBy("doc_id", "grade", "slots").limit(max_labelled).repartition(1)

    def fit(batches):
        rows, grades = [], []
        for batch in batches:
            grades += batch.column(1).to_pylist()
            rows += [(np.frombuffer(i, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64))
                     for i, v in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        model = fit_with_cut(rows, np.array(grades, np.int64))
        used = np.flatnonzero(model.weights).astype(np.int32)
        parts = [pa.array([x.tobytes()], pa.binary()) for x in (used, model.weights[used].astype(np.float32), model.thresholds)]
        yield pa.RecordBatch.from_arrays([*parts, pa.array([model.cut])], names=["slots", "weights", "thresholds", "cut"])

    # one task fits the bounded sample; the driver gets the model alone
    found = bounded.mapInArrow(fit, "slots binary, weights binary, thresholds binary, cut double").first()
    if found is None:
        return fit_ordinal([], np.empty(0, np.int64))
    weights = np.zeros(SLOTS, np.float32)
    weights[np.frombuffer(found["slots"], np.int32)] = np.frombuffer(found["weights"], np.float32)
    return OrdinalModel(weights, np.frombuffer(found["thresholds"], np.float64), found["cut"])


def score_quality(docs: DataFrame, model: OrdinalModel, text: str = "text", least_tail: float | None = None) -> DataFrame:
    """``docs`` with ``p_good`` (P(grade >= 1)), ``p_clean`` (P(grade >= 2)), ``expected_grade`` and ``kept`` (``p_clean`` of at least ``least_tail``, by default the model's cut).

    Columns of ``docs`` with one of these names are replaced. Whole texts are scored; a missing or empty text has no features and
    gets the prior of the thresholds. Rows never go and are scored where they are read.
    """
    new = ("p_good", "p_clean", "expected_grade", "kept")
    least = model.cut if least_tail is None else least_tail
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    base = docs.drop(*[c for c in docs.columns if c.lower() in new])
    at = base.columns.index(text)

    def run(batches):
        weights, thresholds = sent.value
        slots = Remembered(_slots)
        for part in slices(batches, text, 4 << 20):
            made = [features(t, slots) for t in part.column(at).to_pylist()]
            tails = OrdinalModel(weights, thresholds).tails(np.array([float(weights[i] @ v) for i, v in made]))
            expected = tails.sum(axis=1)
            columns = [*part.columns, pa.array(tails[:, 0]), pa.array(tails[:, 1]), pa.array(expected), pa.array(tails[:, 1] >= least)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *new])

    schema = T.StructType([*base.schema.fields, *[T.StructField(name, T.BooleanType() if name == "kept" else T.DoubleType()) for name in new]])
    return base.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", least_tail: float | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns."""
    model = train_quality(docs, labels, doc_id, text)
    (body, row) = fresh(docs, "scored_text", "scored_row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{text}`").alias(body))
    scored = score_quality(packed, model, body, least_tail)
    return scored.filter("kept").select(f"{row}.*")
