"""Additive attributions: exact for tree ensembles, closed form for linear models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendgrid.functions.hashing import hash_key, hash_uniform, poisson_one
from lendgrid.operators.boosting import Tree
from lendgrid.operators.models import LinearScorer, TreeScorer
from lendgrid.operators.summaries import matrix_of, values_of
from lendgrid.session import spread

#: Leaves that are sent to the tasks together, and leaves x rows that a task handles at a time.
LEAVES, CELLS = 1 << 16, 1 << 17
#: Most features on a way whose payoffs are tabulated, leaves and rows that are looked up together, and rows from which a table pays.
TABLED, TABLE_LEAVES, TABLE_ROWS, LEAST_ROWS = 6, 256, 256, 128


@dataclass(frozen=True)
class Paths:
    """Leaves of some trees, each with the features on its way (one column a feature, padded): the interval that leads on, whether a
    missing value does, and the share of the training weight that does."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    lost: np.ndarray
    share: np.ndarray
    value: np.ndarray

    @property
    def expected(self) -> float:
        return float(self.value @ self.share.prod(axis=1))


def _leaves(tree: Tree) -> Iterator[tuple[float, dict]]:
    """Value and path of each leaf; splits on one feature are one interval with one share."""
    waiting = [(0, {})]
    while waiting:
        node, path = waiting.pop()
        if tree.left[node] < 0:
            yield float(tree.value[node]), path
            continue
        feature, cut = int(tree.feature[node]), float(tree.threshold[node])
        for child, left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
            low, high, lost, share = path.get(feature, (-np.inf, np.inf, True, 1.0))
            bounds = (low, min(high, cut)) if left else (max(low, cut), high)
            waiting.append((child, {**path, feature: (*bounds, lost and bool(tree.missing_left[node]) == left, share * float(tree.cover[child] / tree.cover[node]))}))


def tree_paths(trees: tuple[Tree, ...] | list[Tree], most: int = LEAVES) -> list[Paths]:
    """The leaves of all trees in pieces of about ``most`` leaves, so that no piece grows with the model."""
    pieces, leaves = [], []

    def close():
        width = max(1, max(len(path) for _, path in leaves))
        shape = (len(leaves), width)
        piece = Paths(np.zeros(shape, np.int32), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape, bool), np.ones(shape), np.array([v for v, _ in leaves]))
        for i, (_, path) in enumerate(leaves):
            for j, (feature, (low, high, lost, share)) in enumerate(path.items()):
                piece.feature[i, j], piece.low[i, j], piece.high[i, j], piece.lost[i, j], piece.share[i, j] = feature, low, high, lost, share
        pieces.append(piece)
        leaves.clear()

    for tree in trees:
        leaves.extend(_leaves(tree))
        if len(leaves) >= most:
            close()
    if leaves:
        close()
    return pieces


def path_attributions(x: np.ndarray, paths: Paths, out: np.ndarray) -> None:
    """Add the Shapley values of the leaves to ``out`` (rows x features).

    What a leaf pays depends on a row only by which of its features lead on: with few features on the way there are few such sets, so their
    payoffs are made once and looked up for each row; long ways, and few rows, are worked out row by row. A table has ``2 ** depth`` entries a leaf.
    """
    if paths.feature.shape[1] <= TABLED and len(x) >= LEAST_ROWS:
        _look_up(x, paths, out)
        return
    leaves, depth = paths.feature.shape
    # columns of cells by feature: what each feature gets is one run
    for first in range(0, leaves, 4096):
        part = slice(first, first + 4096)
        feature, share = paths.feature[part].T.copy(), paths.share[part].T
        low, high, lost, value = paths.low[part].T, paths.high[part].T, paths.lost[part].T, paths.value[part]
        order = np.argsort(feature.ravel(), kind="stable")
        owners, heads = np.unique(feature.ravel()[order], return_index=True)
        step = max(1, CELLS // feature.shape[1])
        for at in range(0, len(x), step):
            rows = x[at:at + step]
            known = []
            for j in range(depth):
                seen = rows[:, feature[j]]
                known.append(np.where(np.isnan(seen), lost[j], ((seen > low[j]) | np.isneginf(low[j])) & (seen <= high[j])))
            cells = np.concatenate(_payoffs(known, share, value), axis=1)
            out[at:at + step, owners] += np.add.reduceat(cells[:, order], heads, axis=1)


def _payoffs(known: list[np.ndarray], share: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
    """What each feature of each leaf's way gets, by which of them are ``known`` to lead on (rows x leaves a feature).

    A leaf pays its value times the product of a factor for each feature on its path: 1 or 0 for a known feature, whose value leads on or not,
    and the share for an unknown one. The Shapley value of feature j is the payoff with it less that without it, averaged over all orders;
    that average is the integral over t of the product of the others' factors ``share * (1 - t) + known * t``, a polynomial of
    degree depth - 1, which Gauss-Legendre quadrature with half as many points gives exactly. So a leaf takes a number of
    operations that is quadratic in its depth.
    """
    depth, share = len(known), np.maximum(share, 1e-200)
    points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    points, weights = (points + 1) / 2, weights / 2
    effect = [np.zeros(known[0].shape) for _ in range(depth)]
    for t, w in zip(points, weights):
        factors = [share[j] * (1 - t) + known[j] * t for j in range(depth)]
        product = w * value
        for f in factors:
            product = product * f
        for j in range(depth):
            effect[j] += product / factors[j]
    return [(known[j] - share[j]) * effect[j] for j in range(depth)]


def _look_up(x: np.ndarray, paths: Paths, out: np.ndarray) -> None:
    """``path_attributions`` by tables: leaves by rows, so that a feature's values are copied and compared as runs."""
    depth, gone = paths.feature.shape[1], np.isnan(x).T
    sets = np.arange(1 << depth)
    for first in range(0, len(paths.value), TABLE_LEAVES):
        part = slice(first, first + TABLE_LEAVES)
        feature, share, lost, value = paths.feature[part].T.copy(), paths.share[part].T, paths.lost[part].T, paths.value[part]
        # each feature's values as their place among its bounds: a value is in an interval if its place is
        used = np.unique(feature)
        places, low, high = np.empty((len(used), len(x)), np.int32), np.empty(feature.shape, np.int32), np.empty(feature.shape, np.int32)
        own = np.searchsorted(used, feature)
        for i, f in enumerate(used):
            mine = own == i
            below, above = paths.low[part].T[mine], paths.high[part].T[mine]
            bounds = np.unique(np.concatenate([below, above]))
            bounds = bounds[np.isfinite(bounds)]
            places[i] = np.where(gone[f], -2, np.searchsorted(bounds, x[:, f], "left"))
            low[mine] = np.where(np.isneginf(below), -1, np.searchsorted(bounds, below))
            high[mine] = np.searchsorted(bounds, above)
        known = [np.repeat(((sets >> j) & 1)[:, None], len(value), axis=1).astype(bool) for j in range(depth)]
        table = np.stack(_payoffs(known, share, value)).transpose(0, 2, 1)  # feature on the way x leaf x set
        # a feature whose share is whole and that always leads on gets nothing: so do the places that pad a way
        real = (np.abs(share - 1) > 0) | ~np.isneginf(paths.low[part].T) | ~np.isposinf(paths.high[part].T) | ~lost
        cells = np.flatnonzero(real.ravel())
        if not len(cells):
            continue
        cells = cells[np.argsort(feature.ravel()[cells], kind="stable")]
        owners, heads = np.unique(feature.ravel()[cells], return_index=True)
        leaf, entries = cells % len(value), np.ascontiguousarray(table.reshape(-1, len(sets))[cells]).ravel()
        begin = (np.arange(len(cells)) * len(sets))[:, None]
        missing = gone[used].any()
        for at in range(0, len(x), TABLE_ROWS):
            rows = slice(at, at + TABLE_ROWS)
            place, absent = np.ascontiguousarray(places[:, rows]), np.ascontiguousarray(gone[used, rows])
            found = np.zeros((len(value), place.shape[1]), np.uint8)
            for j in range(depth):
                seen = place[own[j]]
                leads = (seen > low[j][:, None]) & (seen <= high[j][:, None])
                if missing:
                    leads |= absent[own[j]] & lost[j][:, None]
                found |= leads.view(np.uint8) << np.uint8(j)
            out[rows, owners] += np.add.reduceat(entries.take(found[leaf] + begin, mode="clip"), heads, axis=0).T


def tree_attributions(scorer: TreeScorer, df: DataFrame, id_col: str, leaves: int = LEAVES) -> tuple[DataFrame, float]:
    """``(id, contributions, margin)`` per row and the base value of the ensemble.

    Path-dependent Shapley values in margin units: they add up to margin minus base. The model is sent in pieces of about ``leaves``
    leaves, one after the other over the same rows and within one stage, so its size has no limit. A row takes far longer to explain than to send, so the
    rows are dealt out to all cores first.
    """
    spark, columns = df.sparkSession, scorer.booster.columns
    pieces = tree_paths(scorer.booster.trees, leaves)
    base = scorer.booster.base + sum(p.expected for p in pieces)
    width = len(columns)
    rows = df.select(F.col(id_col).cast("long").alias("id"), values_of(columns).alias("x"))
    out = spread(rows).withColumn("contributions", F.array_repeat(F.lit(0.0), width))
    kinds = "id long, x array<double>, contributions array<double>"

    def explain(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                so_far = matrix_of(batch.column(2))
                path_attributions(matrix_of(batch.column(1)), sent.value, so_far)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, so_far.size + 1, max(1, width)), pa.int32()), pa.array(so_far.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "x", "contributions"])

        return run

    for piece in pieces:
        out = out.mapInArrow(explain(spark.sparkContext.broadcast(piece)), kinds)
    margin = F.aggregate("contributions", F.lit(base), lambda a, v: a + v)
    return out.select("id", "contributions", margin.alias("margin")), base


def linear_attributions(scorer: LinearScorer, df: DataFrame, id_col: str) -> tuple[DataFrame, float]:
    """Coefficient times distance from the mean; the inputs have mean zero."""
    parts = [F.lit(float(w)) * scorer.scaling.standard(c) for w, c in zip(scorer.coefficients, scorer.scaling.columns)]
    out = df.select(
        F.col(id_col).alias("id"), F.array(*parts).alias("contributions"), scorer.margin().alias("margin")
    )
    return out, scorer.intercept


def long_form(wide: DataFrame, names: list[str]) -> DataFrame:
    """``(id, feature, contribution)``, one row per cell."""
    labels = F.array(*[F.lit(n) for n in names])
    return wide.select("id", F.posexplode("contributions").alias("_i", "contribution")).select(
        "id", F.element_at(labels, F.col("_i") + 1).alias("feature"), "contribution"
    )


def global_importance(wide: DataFrame, names: list[str]) -> DataFrame:
    """Mean absolute contribution per feature, from one pass over the arrays."""
    row = wide.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"c{i}") for i in range(len(names))])
    cells = [F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("mean_abs_shap")) for i, n in enumerate(names)]
    out = row.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")
    return out.orderBy(F.desc("mean_abs_shap"), "feature")


def waterfall(wide: DataFrame, names: list[str], base: float, top: int = 10) -> DataFrame:
    """Per id: the ``top`` contributions by size, the rest as one row, and the base value.

    Sorting happens inside the row's own array, so nothing is shuffled.
    """
    labels = F.array(*[F.lit(n) for n in names])
    cells = F.transform(
        "contributions",
        lambda c, i: F.struct(
            (-F.round(F.abs(c), 9)).alias("size"), F.element_at(labels, i + 1).alias("feature"), c.alias("contribution")
        ),
    )
    ordered = wide.select("id", F.sort_array(cells).alias("_all"))
    head = F.transform(
        F.slice("_all", 1, top),
        lambda s, i: F.struct((i + 1).cast("int").alias("position"), s["feature"].alias("feature"), s["contribution"].alias("contribution")),
    )
    rest = F.aggregate(F.slice("_all", top + 1, len(names) + 1), F.lit(0.0), lambda a, s: a + s["contribution"])
    tail = F.array(
        F.struct(F.lit(top + 1).alias("position"), F.lit("other").alias("feature"), rest.alias("contribution")),
        F.struct(F.lit(0).alias("position"), F.lit("base").alias("feature"), F.lit(float(base)).alias("contribution")),
    )
    return ordered.select("id", F.explode(F.concat(head, tail)).alias("_s")).select("id", "_s.*")


def kendall_tau(a: np.ndarray, b: np.ndarray) -> float:
    """Tau-b of two score vectors."""
    agree = ties_a = ties_b = 0.0
    for i in range(len(a) - 1):
        da, db = np.sign(a[i] - a[i + 1:]), np.sign(b[i] - b[i + 1:])
        agree += float((da * db).sum())
        ties_a += float((da == 0).sum())
        ties_b += float((db == 0).sum())
    pairs = len(a) * (len(a) - 1) / 2
    scale = np.sqrt((pairs - ties_a) * (pairs - ties_b))
    return float(agree / scale) if scale else float("nan")


def rank_stability(wide: DataFrame, names: list[str], replicates: int = 30, seed: int = 42) -> DataFrame:
    """Kendall tau between the importance ranking and that of each bootstrap resample.

    A resample is a Poisson(1) weight per row, so all resamples are sums in the
    same pass; what reaches the driver is features x replicates numbers.
    """
    draws = F.array(
        *[poisson_one(hash_uniform(hash_key(F.col("id"), seed * 1000 + r))) for r in range(replicates)]
    )
    weighted = wide.select("contributions", F.concat(F.array(F.lit(1.0)), draws).alias("w"))
    cells = weighted.select(F.posexplode("contributions").alias("feature", "c"), "w")
    sums = cells.groupBy("feature").agg(
        *[F.sum(F.abs("c") * F.col("w")[r]).alias(f"r{r}") for r in range(replicates + 1)]
    )
    table = sums.orderBy("feature").toPandas()
    reference = table["r0"].to_numpy()
    rows = [(r, kendall_tau(reference, table[f"r{r}"].to_numpy())) for r in range(1, replicates + 1)]
    return wide.sparkSession.createDataFrame(rows, "replicate int, tau double")


def stability_summary(taus: DataFrame) -> DataFrame:
    return taus.agg(F.avg("tau").alias("tau_mean"), F.stddev_pop("tau").alias("tau_std"), F.count("tau").alias("replicates"))
