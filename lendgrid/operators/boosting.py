"""Gradient boosting over histograms: columns become bytes once, levels are grown from sums of gradients, missing values learn their side.

Rows lie in blocks of bytes. What a level needs from them is the sum of gradients and hessians per column, bin and node; these sums are
whole numbers (fixed point), so they do not depend on how rows are dealt, and a model is the same for any number of blocks (with the same cuts).
If all rows fit one block, one task grows all trees. Else the tasks of a barrier stage, one per core, hold a part of the blocks each and grow ``ROUNDS``
trees together: each sums the histograms of its blocks, adds those of all tasks for its share of the columns, and all take the best of the splits so found.
What they tell each other lies in the shared folder until all have read it.

Where Spark cannot run a barrier stage, or the shared folder is no plain one, each level is one job of one stage: a task per core sums the histograms of its
blocks, and the driver adds these. A worker keeps the blocks that it has seen, with their margins and nodes, and takes them up where it left
them, so that a level sends no rows; what a worker does not have is made from its row and the trees since, so what is kept changes no result.
"""

from __future__ import annotations

import os
import pickle
import re
import shutil
import time
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.functions import defaults
from lendgrid.operators.summaries import Summary, column_summaries, matrix_of, values_of
from lendgrid.session import cut_lineage, plain_folder as _plain_folder, shared_folder

#: Distinct values up to which a column keeps a bin for each; quantiles of the others. One more bin is for missing values.
MOST_BINS = 254
#: Bytes of bins in a block, rows counted at a time, and fixed point of gradients.
BLOCK_BYTES, TILE, UNIT = 16 << 20, 1 << 15, float(1 << 24)
#: Least bytes of bins for a task of its own, and bytes of blocks that a worker keeps between tasks.
TASK_BYTES, KEPT_BYTES = 1 << 20, 256 << 20
#: Rounds after which margins are written down: with held-out rows, which are ranked then, and without; and after which lineage is cut.
REFRESH, REFRESH_ALONE, CUT = 10, 50, 100
#: Rounds without a better validation AUC after which boosting has ended (fixed value).
PATIENCE = 50
#: Tasks whose sums the driver adds itself; those of more are added in the cluster first. No more than these grow trees together.
MOST_ADDED = 32
#: Trees that the tasks of a barrier stage grow before their margins are written down, and seconds that they wait for one another.
ROUNDS, MOST_WAIT = 100, 900.0


@dataclass(frozen=True)
class TreeSettings:
    trees: int = defaults.TREE_COUNT
    depth: int = defaults.TREE_DEPTH
    step: float = defaults.LEARNING_RATE
    row_sample: float = defaults.ROW_SAMPLE
    column_sample: float = defaults.COLUMN_SAMPLE
    min_child: float = defaults.MIN_CHILD
    ridge: float = defaults.LEAF_PENALTY
    positive_weight: float = 1.0
    seed: int = defaults.SEED


@dataclass(frozen=True)
class Bins:
    """The cuts of each column: a value is in the first bin whose cut is not below it; the bin after the last is for missing ones."""

    columns: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(c) + 2 for c in self.cuts], np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Bins of rows x columns of values."""
        out = np.empty(x.shape, np.uint8)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), len(cuts) + 1, np.searchsorted(cuts, x[:, j], "left"))
        return out


def _cuts(summary: Summary) -> np.ndarray:
    values, weights = summary.pairs()
    if summary.exact and len(values) <= MOST_BINS:
        return (values[1:] + values[:-1]) / 2
    run = np.cumsum(weights)
    return values[np.unique(np.searchsorted(run, np.arange(1, MOST_BINS) * (run[-1] / MOST_BINS)))]


def fit_bins(df: DataFrame, columns: list[str]) -> Bins:
    """One pass over all columns. A column with up to ``MOST_BINS`` values has its cuts between them, so no split of it is lost; another
    one has its quantiles, exact or with the small error of a summary."""
    found = column_summaries(df, columns)
    return Bins(tuple(columns), tuple(_cuts(found[c]) for c in columns))


@dataclass
class Tree:
    """Nodes of one tree as arrays. A leaf has ``left`` -1; a value of at most ``threshold`` goes left, a missing one where ``missing_left`` says."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray


#: Node table of a model: what ``Tree`` holds, one row per node.
NODES = ("tree int, node int, feature int, bin int, threshold double, missing_left boolean, left int, right int, value double, gain double, "
         "cover double")


@dataclass(frozen=True)
class Splits:
    """How node sums become splits: the cuts, and which columns a tree may use."""

    bins: Bins
    settings: TreeSettings

    def columns_of(self, tree: int) -> np.ndarray:
        n = len(self.bins.columns)
        share = max(1, round(self.settings.column_sample * n))
        return np.sort(np.random.default_rng([self.settings.seed, tree]).permutation(n)[:share])

    def leaf(self, g: float, h: float) -> float:
        return -self.settings.step * g / (h + self.settings.ridge)

    def best(self, sums: np.ndarray, columns: np.ndarray) -> list[tuple | None]:
        """Of each node's ``sums`` (slots x 2, of ``columns``): gain, column, last bin on the left, side of missing values, sums of both children."""
        return self.chosen([self.candidates(sums, columns)])

    def chosen(self, found: list[list[tuple]]) -> list[tuple | None]:
        """Each node's split from the candidates of runs of columns, in the order of the columns: the first of equal ones."""
        out = []
        for of_node in zip(*found):
            right_first, left_first = ([side[at] for side in of_node] for at in (0, 1))
            a, b = (side[int(np.argmax([split[0] for split in side]))] for side in (right_first, left_first))
            split = b if b[0] > a[0] else a
            out.append(split if split[0] > 1e-6 else None)
        return out

    def candidates(self, sums: np.ndarray, columns: np.ndarray) -> list[tuple]:
        """Of each node the best split with missing values on the right and that with them on the left, as ``best`` gives them."""
        sizes = self.bins.sizes[columns]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        x = sums / UNIT
        run = np.cumsum(x, axis=1)
        before = np.concatenate([np.zeros((len(x), 1, 2)), run], axis=1)[:, starts[:-1]]
        total = run[:, starts[1] - 1]
        left = run - np.repeat(before, sizes, axis=1)
        lost = np.repeat(x[:, starts[1:] - 1], sizes, axis=1)  # sums of the rows without a value
        ridge, least = self.settings.ridge, self.settings.min_child
        whole = (total[:, 0] ** 2 / (total[:, 1] + ridge))[:, None]
        missing_slot = np.zeros(starts[-1], bool)
        missing_slot[starts[1:] - 1] = True
        last_value = np.zeros(starts[-1], bool)
        last_value[starts[1:] - 2] = True

        def gains(own, barred):
            other = total[:, None] - own
            with np.errstate(divide="ignore", invalid="ignore"):  # slots that are no split are barred below
                out = own[..., 0] ** 2 / (own[..., 1] + ridge) + other[..., 0] ** 2 / (other[..., 1] + ridge) - whole
            return np.where((own[..., 1] < least) | (other[..., 1] < least) | barred, -np.inf, out)

        right_first, left_first = gains(left, missing_slot), gains(left + lost, missing_slot | last_value)
        found = []
        for i in range(len(x)):
            sides = []
            for to_left, gain in ((False, right_first[i]), (True, left_first[i])):
                at = int(gain.argmax())
                j = int(np.searchsorted(starts, at, "right")) - 1
                own = left[i, at] + (lost[i, at] if to_left else 0)
                sides.append((float(gain[at]), int(columns[j]), int(at - starts[j]), to_left, own, total[i] - own))
            found.append(tuple(sides))
        return found


def grow_tree(splits: Splits, tree: int, sums_of: Callable[["Tree", np.ndarray, list[int]], np.ndarray],
              share_of: Callable[[np.ndarray], np.ndarray] = lambda columns: columns, best: Callable[[np.ndarray, np.ndarray], list[tuple | None]] | None = None) -> Tree:
    """One tree, level by level. ``sums_of(partial tree, columns, nodes)`` gives the sums of these nodes.

    Of two siblings only the one with less weight is summed; the other is what is left of the parent. Where several grow the same tree, ``sums_of``
    gives the sums of the caller's ``share_of(columns)`` (one or more), and ``best`` the splits that all agree on.
    """
    best = best or splits.best
    cap = 2 ** (splits.settings.depth + 1)
    t = Tree(np.zeros(cap, np.int32), np.zeros(cap, np.int32), np.full(cap, np.inf), np.zeros(cap, bool), np.full(cap, -1, np.int32),
             np.full(cap, -1, np.int32), np.zeros(cap), np.zeros(cap), np.zeros(cap))
    columns = splits.columns_of(tree)
    share = share_of(columns)
    held = {0: sums_of(t, columns, [0])[0]}
    first = held[0][:int(splits.bins.sizes[share[0]])].sum(axis=0) / UNIT
    t.value[0], t.cover[0], count = splits.leaf(*first), first[1], 1
    for level in range(splits.settings.depth):
        nodes = sorted(held)
        new = []
        for node, split in zip(nodes, best(np.stack([held[n] for n in nodes]), share)):
            if split is None:
                continue
            gain, column, last, missing_left, left, right = split
            cuts = splits.bins.cuts[column]
            t.feature[node], t.bin[node], t.gain[node], t.missing_left[node] = column, last, gain, missing_left
            t.threshold[node] = cuts[last] if last < len(cuts) else np.inf
            t.left[node], t.right[node] = count, count + 1
            for child, (g, h) in ((count, left), (count + 1, right)):
                t.value[child], t.cover[child] = splits.leaf(g, h), h
            new.append((node, *((count, count + 1) if left[1] <= right[1] else (count + 1, count))))
            count += 2
        if not new or level + 1 == splits.settings.depth:
            break
        small = sums_of(t, columns, [lesser for _, lesser, _ in new])
        held = {n: s for (parent, lesser, other), own in zip(new, small) for n, s in ((lesser, own), (other, held[parent] - own))}
    return Tree(*[getattr(t, f)[:count] for f in Tree.__dataclass_fields__])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Rows of one block: bins by column, labels, weights, keys and margins, and the sums that growing a tree asks for."""

    def __init__(self, bins: Bins, codes: np.ndarray, y: np.ndarray, held: np.ndarray, keys: np.ndarray, margin: np.ndarray, settings: TreeSettings):
        self.bins, self.codes, self.y, self.held, self.keys, self.margin, self.settings = bins, np.ascontiguousarray(codes.T), y, held, keys, margin, settings
        self.weight = np.where(y > 0, settings.positive_weight, 1.0)
        self.missing = (bins.sizes - 1).astype(np.int64)
        self.tree, self.done = -1, 0

    @property
    def nbytes(self) -> int:
        return self.codes.nbytes + 48 * len(self.y)

    def begin(self, tree: int) -> None:
        """Gradients and hessians of the rows that a tree learns from: a share of those not held out, by the hash of their key."""
        chance = _mixed(self.keys ^ _mixed(np.array([self.settings.seed * 1_000_003 + tree], np.uint64))[0])
        self.rows = np.flatnonzero(~self.held & (chance < np.uint64(min(self.settings.row_sample * 2.0**64, 2.0**64 - 2048)))) if self.settings.row_sample < 1 else np.flatnonzero(~self.held)
        p = 1 / (1 + np.exp(-self.margin[self.rows]))
        w = self.weight[self.rows]
        self.g = np.rint((p - self.y[self.rows]) * w * UNIT)
        self.h = np.rint(np.maximum(p * (1 - p), 1e-16) * w * UNIT)
        self.tree, self.at, self.splits = tree, np.zeros(len(self.y), np.int32), 0

    def move(self, tree: Tree) -> None:
        """Every row to the node that it reaches in ``tree``."""
        inner = np.flatnonzero(tree.left[self.at] >= 0)
        while len(inner):
            at = self.at[inner]
            feature = tree.feature[at]
            seen = self.codes[feature, inner]
            to = np.where(np.where(seen == self.missing[feature], tree.missing_left[at], seen <= tree.bin[at]), tree.left[at], tree.right[at])
            self.at[inner] = to
            inner = inner[tree.left[to] >= 0]

    def sums(self, number: int, tree: Tree, columns: np.ndarray, wanted: list[int]) -> np.ndarray:
        """Whole-number sums (nodes x slots x 2) of gradients and hessians by column and bin; ``tree`` is what there is of tree ``number``."""
        splits = int((tree.left >= 0).sum())
        if self.tree != number or self.splits > splits:
            self.begin(number)
        self.move(tree)
        self.splits = splits
        sizes = self.bins.sizes[columns]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        place = np.full(len(tree.left), -1, np.int64)
        place[wanted] = np.arange(len(wanted))
        where = place[self.at[self.rows]]
        chosen = np.flatnonzero(where >= 0)
        out = np.zeros((2, len(wanted), int(starts[-1])))
        for start in range(0, len(chosen), TILE):
            part = chosen[start:start + TILE]
            rows, node, g, h = self.rows[part], where[part], self.g[part], self.h[part]
            for column, first, size in zip(columns, starts, sizes):
                index = self.codes[column][rows].astype(np.int64)
                if len(wanted) > 1:
                    index += node * size
                # sums of whole numbers far below 2^53 are exact in doubles
                out[0, :, first:first + size] += np.bincount(index, g, len(wanted) * size).reshape(len(wanted), size)
                out[1, :, first:first + size] += np.bincount(index, h, len(wanted) * size).reshape(len(wanted), size)
        return np.ascontiguousarray(out.astype(np.int64).transpose(1, 2, 0))

    def add(self, number: int, tree: Tree) -> None:
        """Margins after tree ``number``."""
        if self.tree != number:
            self.at = np.zeros(len(self.y), np.int32)
        self.move(tree)
        self.margin, self.tree, self.done = self.margin + tree.value[self.at], -1, number + 1


def _auc(y: np.ndarray, score: np.ndarray) -> float | None:
    """Area under the ranking curve, ties averaged; none without both classes."""
    order = np.argsort(score, kind="stable")
    s, own = score[order], y[order]
    ends = np.flatnonzero(np.append(s[1:] != s[:-1], True)) + 1
    begins = np.concatenate([[0], ends[:-1]])
    positive = np.add.reduceat(own, begins)
    negative = ends - begins - positive
    n_pos, n_neg = positive.sum(), negative.sum()
    if not n_pos or not n_neg:
        return None
    below = np.cumsum(negative) - negative
    return float((positive * (below + negative / 2)).sum() / n_pos / n_neg)


class Stopper:
    """Follows the validation AUC: the best round (the first of equals) and whether patience has run out."""

    def __init__(self, patience: int):
        self.patience, self.best, self.best_auc = patience, 0, -1.0

    def over(self, round_: int, auc: float | None) -> bool:
        if auc is not None and auc > self.best_auc + 1e-12:
            self.best, self.best_auc = round_, auc
        return round_ - self.best >= self.patience


def _grow_in_task(block: Block, splits: Splits, patience: int) -> list[Tree]:
    """All trees over one block; with held-out rows boosting ends when patience does, and the best prefix is kept."""
    trees, stopper = [], Stopper(patience)
    held = np.flatnonzero(block.held)
    for k in range(splits.settings.trees):
        trees.append(grow_tree(splits, k, lambda t, c, w: block.sums(k, t, c, w)))  # noqa: B023
        block.add(k, trees[-1])
        if len(held) and stopper.over(k + 1, _auc(block.y[held], block.margin[held])):
            break
    return trees[:stopper.best] if stopper.best else trees


def _node_rows(trees: list[Tree]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(trees), 256):
        part = trees[start:start + 256]
        sizes = [len(t.left) for t in part]
        columns = [np.repeat(np.arange(start, start + len(part), dtype=np.int32), sizes), np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])]
        columns += [np.concatenate([getattr(t, f) for t in part]) for f in Tree.__dataclass_fields__]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in NODES.split(", ")])


def trees_of(nodes: pa.Table) -> list[Tree]:
    """The trees of a collected node table."""
    nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
    tree = nodes.column("tree").to_numpy()
    if not len(tree):
        return []
    ends = np.append(np.flatnonzero(tree[1:] != tree[:-1]) + 1, len(tree))
    columns = {f: nodes.column(f).to_numpy() for f in Tree.__dataclass_fields__}
    return [Tree(**{f: c[a:b] for f, c in columns.items()}) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]


_STATE = "block long, rows long, codes binary, labels binary, held binary, keys binary, margins binary"
_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def _block(bins: Bins, settings: TreeSettings, row: dict) -> Block:
    n = row["rows"]
    of = lambda name, kind: np.frombuffer(row[name], kind)
    return Block(bins, of("codes", np.uint8).reshape(n, -1), of("labels", np.uint8).astype(np.float64), of("held", bool), of("keys", np.uint64), of("margins", np.float64), settings)


_KEPT: OrderedDict[tuple[str, int], Block] = OrderedDict()


def kept_block(fit: str, number: int, first: int, pending: list[Tree], make: Callable[[], Block] | None = None) -> Block | None:
    """Block ``number`` with the margins after ``first`` and the ``pending`` trees, from where this worker left it; else from ``make``, which
    gives it with the margins after ``first`` trees, or none."""
    block = _KEPT.pop((fit, number), None)
    if block is None or not first <= block.done <= first + len(pending):
        if make is None:
            return None
        block = make()
        block.done = first
    for tree in pending[block.done - first:]:
        block.add(block.done, tree)
    _KEPT[fit, number] = block
    while len(_KEPT) > 1 and sum(b.nbytes for b in _KEPT.values()) > KEPT_BYTES:
        _KEPT.popitem(last=False)
    return block


def write_blocks(train: DataFrame, bins: Bins, y: str, validation: str | None, key: str | None, base: float, rows: int, block_bytes: int) -> tuple[DataFrame, int]:
    """The training rows as blocks of bins, written to the shared folder, and the number of their parts: one if they fit a block, else up to one per core."""
    spark = train.sparkSession
    size = rows * max(1, len(bins.columns))
    parts = 1 if size <= block_bytes else max(2, min(spark.sparkContext.defaultParallelism, -(-size // min(block_bytes, TASK_BYTES))))
    hashed = F.xxhash64(F.col(f"`{key}`")) if key else F.xxhash64(*[F.col(f"`{c}`") for c in bins.columns])
    flat = train.select(F.col(f"`{y}`").cast("int").alias("y"), F.coalesce(F.col(validation), F.lit(False)).alias("held") if validation else F.lit(False).alias("held"),
                        hashed.alias("key"), values_of(bins.columns).alias("x")).where("y IS NOT NULL")
    most = max(1, block_bytes // max(1, len(bins.columns)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, waiting, n = TaskContext.get().partitionId() << 20, [], 0
        names = [f.split()[0] for f in _STATE.split(", ")]

        def block():
            joined = [np.concatenate(c) for c in zip(*waiting)]
            values = [number, len(joined[0]), joined[3].tobytes(), joined[0].tobytes(), joined[1].tobytes(), joined[2].tobytes(), np.full(len(joined[0]), base).tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(names, values))], pa.schema([("block", pa.int64()), ("rows", pa.int64()), *[(c, pa.binary()) for c in names[2:]]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column(3))
            waiting.append((batch.column(0).to_numpy().astype(np.uint8), batch.column(1).to_numpy(zero_copy_only=False).astype(bool), batch.column(2).to_numpy().view(np.uint64), bins.encode(x)))
            n += batch.num_rows
            if n >= most:
                yield block()
                number, waiting, n = number + 1, [], 0
        if waiting:
            yield block()

    path = f"{shared_folder(spark)}/blocks-{_fresh()}"
    flat.repartition(parts).mapInArrow(pack, _STATE).write.parquet(path)
    return spark.read.schema(_STATE).parquet(path), parts


def _fresh() -> str:
    import uuid

    return uuid.uuid4().hex


def _plain_rows(state: DataFrame) -> tuple[RDD, RDD]:
    """The blocks as plain tuples, and only their numbers; both stay where they are."""
    rows = state.rdd.map(lambda r: tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)).persist(StorageLevel.MEMORY_AND_DISK)
    return rows, rows.map(lambda r: r[0]).persist(StorageLevel.MEMORY_AND_DISK)


def sums_then_input(at: int, part: Iterator, kept: Callable[[], np.ndarray | None], made: Callable[[Iterator], np.ndarray] | None = None) -> Iterator[tuple]:
    """The part's number, its sums and whether they needed its input: sums of what the worker has ``kept``, else those ``made`` from the input, or none.

    A task's input comes in a packet of its own, some 40 ms after its function where the network waits for an answer to the first packet.
    So sums that need no input are made and sent first. It is still read to its end, or the worker would end, and with it what it keeps.
    """
    own = kept()
    if own is None and made is not None:
        yield at, made(part), True
    else:
        yield at, own, False
    for _ in part:
        pass


class _Levels:
    """The blocks of a fit as they lie in the cluster, and the sums of a level over them."""

    def __init__(self, state: DataFrame, sent: Broadcast, fit: str, first: int):
        self.sent, self.fit, self.first, self.settled = sent, fit, first, False
        self.rows, self.numbers = _plain_rows(state)
        self.dealt = self.numbers.glom().collect()

    def sums(self, pending: list[Tree], tree: int, partial: Tree, columns: np.ndarray, wanted: list[int]) -> np.ndarray:
        """One level: every task sums its blocks, and the driver gets one sum per task, or of more than ``MOST_ADDED`` tasks the sum of several.

        Tasks get the rows of their blocks until no worker needed them, from then on only the numbers. Where a worker has not kept a block
        then, a second job sends the rows of that part, and the next levels send rows again.
        """
        sent, fit, first, dealt = self.sent, self.fit, self.first, self.dealt

        def add(blocks: Iterator[Block | None]) -> np.ndarray | None:
            total = None
            for block in blocks:
                if block is None:
                    return None
                own = block.sums(tree, partial, columns, wanted)
                total = own if total is None else total + own
            return 0 if total is None else total

        def of_kept(at: int) -> np.ndarray | None:
            return add(kept_block(fit, number, first, pending) for number in dealt[at])

        def of_rows(part: Iterator[tuple]) -> np.ndarray:
            return add(kept_block(fit, row[0], first, pending, lambda: _block(*sent.value, dict(zip(_NAMES, row)))) for row in part)  # noqa: B023

        if len(dealt) > MOST_ADDED:
            return self.rows.mapPartitions(lambda part: [of_rows(part)]).treeReduce(lambda a, b: a + b)
        if self.settled:
            found = self.numbers.mapPartitionsWithIndex(lambda at, part: sums_then_input(at, part, lambda: of_kept(at))).collect()
        else:
            found = self.rows.mapPartitionsWithIndex(lambda at, part: sums_then_input(at, part, lambda: of_kept(at), of_rows)).collect()
        missing = [at for at, own, _ in found if own is None]
        rest = self.rows.context.runJob(self.rows, lambda part: [of_rows(part)], missing) if missing else []
        self.settled = not missing and not any(made for _, _, made in found)
        return sum([own for _, own, _ in found if own is not None] + rest)

    def unpersist(self) -> None:
        self.numbers.unpersist()
        self.rows.unpersist()


class _Round:
    """What tasks that run at the same time tell each other: files in a folder that all see, named by turn and task. A file is there as a whole or not at all.

    A turn has two exchanges: after the second one all have read what was put down for the first, so everyone takes his own file away.
    """

    def __init__(self, folder: str, at: int, tasks: int):
        self.folder, self.at, self.tasks, self.turn = folder, at, tasks, 0
        os.makedirs(folder, exist_ok=True)

    def _put(self, kind: str, data: bytes) -> None:
        path = f"{self.folder}/{kind}-{self.turn}-{self.at}"
        with open(f"{path}.part", "wb") as f:
            f.write(data)
        os.replace(f"{path}.part", path)

    def _get(self, kind: str, task: int, start: int = 0, size: int = -1) -> bytes:
        began = looked = time.monotonic()
        while True:
            try:
                with open(f"{self.folder}/{kind}-{self.turn}-{task}", "rb") as f:
                    f.seek(start)
                    return f.read(size)
            except FileNotFoundError:
                now = time.monotonic()
                if now - began > MOST_WAIT:
                    raise TimeoutError(f"task {task} has put down nothing for {MOST_WAIT:.0f} s") from None
                if now - looked > 0.05:  # a network folder may remember that a file was not there, until the folder is read again
                    os.listdir(self.folder)
                    looked = time.monotonic()
                time.sleep(0.0005)

    def added(self, own: list[np.ndarray]) -> np.ndarray:
        """The sum, over all tasks, of what each has for this one; ``own`` are this task's sums for task 0, 1, ...; of equal shapes over all tasks."""
        self._put("sums", b"".join(np.ascontiguousarray(o).tobytes() for o in own))
        start, total = sum(o.nbytes for o in own[:self.at]), own[self.at].copy()
        for task in range(self.tasks):
            if task != self.at:
                total += np.frombuffer(self._get("sums", task, start, total.nbytes), total.dtype).reshape(total.shape)
        return total

    def all(self, own: object) -> list:
        """What every task has, in the order of the tasks; ends the turn."""
        self._put("found", pickle.dumps(own))
        found = [own if task == self.at else pickle.loads(self._get("found", task)) for task in range(self.tasks)]
        os.remove(f"{self.folder}/sums-{self.turn}-{self.at}")
        if self.turn:  # all have put down something for this turn, so they have read what was found in the one before
            os.remove(f"{self.folder}/found-{self.turn - 1}-{self.at}")
        self.turn += 1
        return found


def column_shares(sizes: np.ndarray, tasks: int) -> list[tuple[int, int]]:
    """Runs of columns for the tasks, in order, with about as many slots each; tasks for which none is left look at the first column, like another one."""
    ends = np.cumsum(sizes)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(1, tasks) * (ends[-1] / tasks), "left") + 1, [len(sizes)]]).clip(0, len(sizes)))
    runs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    return runs + [(0, 1)] * (tasks - len(runs))


def task_slots(settings: dict[str, str], parallelism: int, executors: int) -> int:
    """Tasks that surely run at the same time: the default parallelism is the number of cores, unless it is set to something else."""
    if "spark.default.parallelism" in settings:
        local = re.fullmatch(r"local(?:\[(\d+)(?:,\d+)?\])?", settings.get("spark.master", ""))
        cores = int(local[1] or 1) if local else executors * int(settings.get("spark.executor.cores", "1"))
        parallelism = min(parallelism, cores)
    return parallelism // int(settings.get("spark.task.cpus", "1"))


def grows_together(spark: SparkSession, parts: int, size: int) -> bool:
    """Whether the parts, of ``size`` bytes in all, can be held by tasks that all run at the same time and see the shared folder."""
    context = spark.sparkContext
    settings = dict(context.getConf().getAll())
    # the driver is one of those that hold blocks
    slots = task_slots(settings, context.defaultParallelism, max(1, context._jsc.sc().getExecutorMemoryStatus().size() - 1))
    adapts = settings.get("spark.dynamicAllocation.enabled", "false").lower() == "true"
    return not adapts and parts <= min(MOST_ADDED, slots) and size <= parts * KEPT_BYTES and _plain_folder(shared_folder(spark)) is not None


class _Together:
    """The blocks of a fit, dealt to tasks that grow trees together. Margins lie in the fit's folder by block and number of trees, so that a job that fails
    is run again from the trees before it."""

    def __init__(self, state: DataFrame, sent: Broadcast, splits: Splits, parts: int, fit: str):
        self.sent, self.splits, self.parts = sent, splits, parts
        self.folder = f"{_plain_folder(shared_folder(state.sparkSession))}/fit-{fit}"
        os.makedirs(self.folder)
        # block numbers begin with the number of their part
        self.rows = state.rdd.map(lambda r: (r[0] >> 20, tuple(bytes(v) if isinstance(v, bytearray) else v for v in r))).partitionBy(parts, lambda part: part)

    def grow(self, first: int, count: int) -> list[Tree]:
        """Trees ``first`` to ``first + count - 1``; margins after them are in the folder then."""
        sent, splits, parts, folder = self.sent, self.splits, self.parts, self.folder

        def run(part: Iterator[tuple]) -> Iterator[bytes]:
            from pyspark import BarrierTaskContext

            context, blocks = BarrierTaskContext.get(), []
            for _, row in part:
                block = _block(*sent.value, dict(zip(_NAMES, row)))
                if first:
                    block.margin = np.load(f"{folder}/margins-{first}-{row[0]}.npy")
                blocks.append((row[0], block))
            at = context.partitionId()
            # a stage that is run again has another folder, so that nothing of the earlier run is read
            told = _Round(f"{folder}/{context.allGather(_fresh())[0]}", at, parts)
            sizes = splits.bins.sizes

            def share_of(columns: np.ndarray) -> np.ndarray:
                return columns[slice(*column_shares(sizes[columns], parts)[at])]

            def sums_of(number: int, partial: Tree, columns: np.ndarray, wanted: list[int]) -> np.ndarray:
                starts = np.concatenate([[0], np.cumsum(sizes[columns])])
                own = sum((block.sums(number, partial, columns, wanted) for _, block in blocks), np.zeros((len(wanted), int(starts[-1]), 2), np.int64))
                return told.added([own[:, starts[a]:starts[b]] for a, b in column_shares(sizes[columns], parts)])

            def best(sums: np.ndarray, columns: np.ndarray) -> list[tuple | None]:
                return splits.chosen(told.all(splits.candidates(sums, columns)))

            trees = []
            for k in range(first, first + count):
                trees.append(grow_tree(splits, k, lambda t, c, w: sums_of(k, t, c, w), share_of, best))  # noqa: B023
                for _, block in blocks:
                    block.add(k, trees[-1])
            for number, block in blocks:
                np.save(f"{folder}/margins-{first + count}-{number}.npy", block.margin)
            if at == 0:
                yield pickle.dumps(trees)

        return pickle.loads(self.rows.barrier().mapPartitions(run).collect()[0])

    def margins(self, done: int) -> str | None:
        """Where the margins after ``done`` trees begin; none before the first."""
        return f"{self.folder}/margins-{done}-" if done else None

    def close(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def _grow_together(blocks: DataFrame, splits: Splits, patience: int, held: bool, parts: int) -> list[Tree]:
    """All trees by barrier stages of ``ROUNDS`` trees each; of ``REFRESH`` with held-out rows, which are ranked after each stage for each of its rounds."""
    from lendgrid.operators.scoring import ranking_metrics

    bins, settings, trees, stopper = splits.bins, splits.settings, [], Stopper(patience)
    sent = blocks.sparkSession.sparkContext.broadcast((bins, settings))
    together = _Together(blocks, sent, splits, parts, _fresh())
    try:
        while len(trees) < settings.trees:
            first = len(trees)
            trees += together.grow(first, min(REFRESH if held else ROUNDS, settings.trees - first))
            if held:
                margins = _held_margins(blocks, bins, settings, trees[first:], together.margins(first))
                areas = {r["at"]: r["roc_auc"] for r in ranking_metrics(margins, keys=("at",)).select("at", "roc_auc").collect()}
                if any(stopper.over(first + i + 1, areas.get(i)) for i in range(len(trees) - first)):
                    break
    finally:
        together.close()
        sent.unpersist()
    return trees[:stopper.best] if stopper.best else trees


def _advance(state: DataFrame, sent: Broadcast, fit: str, first: int, pending: list[Tree]) -> DataFrame:
    """The blocks, whose margins are those after ``first`` trees, with the margins after the ``pending`` ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, settings = sent.value
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                block = kept_block(fit, row["block"], first, pending, lambda: _block(bins, settings, row))  # noqa: B023
                yield pa.RecordBatch.from_arrays([*[c.slice(i, 1) for c in batch.columns[:-1]], pa.array([block.margin.tobytes()], pa.binary())], names=batch.schema.names)

    return state.mapInArrow(run, _STATE)


def _held_margins(state: DataFrame, bins: Bins, settings: TreeSettings, pending: list[Tree], margins: str | None = None) -> DataFrame:
    """``y``, ``at`` and ``p``: the margin of every held-out row after the first, second, ... of the ``pending`` trees. Margins before these are
    those of the blocks, or lie in files that begin with ``margins``."""
    sent = state.sparkSession.sparkContext.broadcast((bins, settings, pending))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, settings, pending = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                block = _block(bins, settings, row)
                if margins:
                    block.margin = np.load(f"{margins}{row['block']}.npy")
                held = np.flatnonzero(block.held)
                for at, t in enumerate(pending):
                    block.add(at, t)
                    yield pa.RecordBatch.from_arrays([pa.array(block.y[held].astype(np.int32)), pa.array(np.full(len(held), at, np.int32)), pa.array(block.margin[held])], names=["y", "at", "p"])

    return state.mapInArrow(run, "y int, at int, p double")


def _grow_by_jobs(blocks: DataFrame, splits: Splits, patience: int, held: bool) -> list[Tree]:
    """All trees with one job a level. Margins are written down every ``REFRESH`` rounds and held-out rows ranked then, for each round; every ``REFRESH_ALONE`` without such rows."""
    from lendgrid.operators.scoring import ranking_metrics

    state, trees, pending, stopper, fit = blocks.persist(), [], [], Stopper(patience), _fresh()
    bins, settings = splits.bins, splits.settings
    sent = blocks.sparkSession.sparkContext.broadcast((bins, settings))
    levels, refresh = _Levels(state, sent, fit, 0), REFRESH if held else REFRESH_ALONE
    try:
        for k in range(settings.trees):
            trees.append(grow_tree(splits, k, lambda t, c, w: levels.sums(pending, k, t, c, w)))  # noqa: B023
            pending.append(trees[-1])
            if len(pending) < refresh and k + 1 < settings.trees:
                continue
            if held:
                areas = {r["at"]: r["roc_auc"] for r in ranking_metrics(_held_margins(state, bins, settings, pending), keys=("at",)).select("at", "roc_auc").collect()}
                if any(stopper.over(len(trees) - len(pending) + i + 1, areas.get(i)) for i in range(len(pending))):
                    break
            if k + 1 == settings.trees:
                break
            older, state = (state, levels), _advance(state, sent, fit, k + 1 - len(pending), pending)
            state = cut_lineage(state) if (k + 1) % CUT == 0 else state.persist()
            levels = _Levels(state, sent, fit, k + 1)
            for held_before in older:
                held_before.unpersist()
            pending = []
    finally:
        levels.unpersist()
        state.unpersist()
        sent.unpersist()
    return trees[:stopper.best] if stopper.best else trees


@dataclass(frozen=True)
class Booster:
    """A fitted ensemble: margin = base + sum of its trees' leaf values."""

    columns: tuple[str, ...]
    trees: tuple[Tree, ...]
    base: float

    def stacked(self) -> dict[str, np.ndarray]:
        """All trees as arrays of trees x nodes; a leaf leads to itself."""
        width = max((len(t.left) for t in self.trees), default=1)
        out = {"feature": np.zeros((len(self.trees), width), np.int32), "threshold": np.full((len(self.trees), width), np.inf), "missing_left": np.zeros((len(self.trees), width), bool),
               "left": np.tile(np.arange(width, dtype=np.int32), (len(self.trees), 1)), "value": np.zeros((len(self.trees), width))}
        out["right"] = out["left"].copy()
        for i, t in enumerate(self.trees):
            n = len(t.left)
            inner = t.left >= 0
            for name in ("feature", "threshold", "missing_left"):
                out[name][i, :n] = np.where(inner, getattr(t, name), out[name][i, :n])
            out["left"][i, :n], out["right"][i, :n] = np.where(inner, t.left, np.arange(n)), np.where(inner, t.right, np.arange(n))
            out["value"][i, :n] = np.where(inner, 0.0, t.value)
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        """Node table of the model: one row per node."""
        batches = list(_node_rows(list(self.trees)))
        return spark.createDataFrame(pa.Table.from_batches(batches)) if batches else spark.createDataFrame([], NODES)


def margins_of(x: np.ndarray, stacked: dict[str, np.ndarray], base: float, tile: int = 64) -> np.ndarray:
    """The margin of each row of values."""
    out = np.full(len(x), base)
    count, width = stacked["feature"].shape
    if not count:
        return out
    columns = x.shape[1]
    origin = (np.arange(count) * width).astype(np.int64)
    # a row's values stand there twice: a missing one compares as false, so it goes right, and is below every threshold in the second copy
    feature = (stacked["feature"] + columns * stacked["missing_left"]).ravel().astype(np.int64)
    threshold, value = stacked["threshold"].ravel(), stacked["value"].ravel()
    to = np.stack([stacked["right"] + origin[:, None], stacked["left"] + origin[:, None]], axis=2).ravel().astype(np.int64)
    for start in range(0, len(x), tile):
        rows = x[start:start + tile]
        both = np.concatenate([rows, np.where(np.isnan(rows), -np.inf, rows)], axis=1).ravel()
        at = (np.arange(len(rows)) * 2 * columns)[:, None]
        node = np.tile(origin, (len(rows), 1))
        while True:
            new = to.take(2 * node + (both.take(at + feature.take(node)) <= threshold.take(node)))
            if (new == node).all():
                break
            node = new
        out[start:start + tile] += value.take(node).sum(axis=1)
    return out


def fit_booster(train: DataFrame, columns: list[str], y: str = "TARGET", settings: TreeSettings = TreeSettings(), validation: str | None = None,
                patience: int = PATIENCE, key: str | None = None, block_bytes: int = BLOCK_BYTES) -> Booster:
    """Boosted trees by logistic loss. Rows with a null label are left out; without rows, or with one class, the model has no tree that splits.

    With ``validation`` (a boolean column) bins and trees are made from the other rows; boosting ends after ``patience`` rounds without
    a better AUC on those, and the best prefix is kept (all trees, if they have one class only). ``key`` names the column that
    decides with the seed which rows a tree samples; without it rows are told apart by their values.
    """
    train = train.where(F.col(f"`{y}`").isNotNull())
    own = train.where(~F.coalesce(F.col(validation), F.lit(False))) if validation else train
    bins = fit_bins(own, columns)
    label = F.col(f"`{y}`").cast("int")
    n, positive = own.agg(F.count(F.lit(1)), F.coalesce(F.sum((label == 1).cast("long")), F.lit(0))).first()
    weighted = positive * settings.positive_weight
    base = float(np.log(weighted / (n - positive))) if 0 < positive < n else (0.0 if not n else (-10.0 if not positive else 10.0))
    splits = Splits(bins, settings)
    if not n or not columns:
        return Booster(tuple(columns), (), base)
    rows = n if not validation else train.count()
    blocks, parts = write_blocks(train, bins, y, validation, key, base, rows, block_bytes)
    if parts > 1 and grows_together(train.sparkSession, parts, rows * (len(columns) + 48)):
        return Booster(tuple(columns), tuple(_grow_together(blocks, splits, patience, validation is not None, parts)), base)
    if parts > 1:
        return Booster(tuple(columns), tuple(_grow_by_jobs(blocks, splits, patience, validation is not None)), base)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            joined = {c: b"".join(r[c] for r in sorted(rows, key=lambda r: r["block"])) for c in ("codes", "labels", "held", "keys", "margins")}
            yield from _node_rows(_grow_in_task(_block(bins, settings, joined | {"rows": sum(r["rows"] for r in rows)}), splits, patience))

    # the rows fit one block, so one task holds them all
    return Booster(tuple(columns), tuple(trees_of(blocks.coalesce(1).mapInArrow(fit, NODES).toArrow())), base)
