"""K-Means for many starts and many numbers of clusters at once: one scan moves the centres of all of them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendgrid.operators.summaries import matrix_of

#: Rows, chosen by the hash of their values, that starting centres are drawn from; rows whose distances a task holds at once.
SAMPLE, TILE = 10_000, 2048


@dataclass(frozen=True)
class Fit:
    """Centres, rows of each, sum of squared distances of all rows to their nearest centre, and the scans that the run took part in."""

    k: int
    seed: int
    points: np.ndarray
    sizes: np.ndarray
    inertia: float
    rounds: int


def starting_points(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` rows of the sample, each drawn with the square of its distance to those before; fewer if the sample has fewer distinct rows."""
    rng = np.random.default_rng(seed)
    points = sample[[int(rng.integers(len(sample)))]]
    nearest = ((sample - points[0]) ** 2).sum(axis=1)
    while len(points) < k and nearest.sum() > 0:
        chosen = sample[int(rng.choice(len(sample), p=nearest / nearest.sum()))]
        points = np.concatenate([points, chosen[None]])
        nearest = np.minimum(nearest, ((sample - chosen) ** 2).sum(axis=1))
    return points


def _packed(rows: DataFrame) -> DataFrame:
    """The rows as blocks of numbers, one per batch, so that a scan hands over bytes instead of rows."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([matrix_of(batch.column(0)).tobytes()], pa.binary())], names=["n", "x"])

    return rows.mapInArrow(pack, "n long, x binary")


def tile_sums(x: np.ndarray, stacked: np.ndarray, norms: np.ndarray, groups: list[tuple[int, int, int]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each centre: sums and number (last column) of the rows nearest to it among its run's, and per group the centre that each row takes in each run.

    Runs with the same number of centres lie together: a group is (first centre, runs, centres of a run).
    """
    # distances to all centres of all runs in one product, but for the rows' own squares; rows lie side by side
    near = norms[:, None] - 2 * (stacked @ x.T)
    member, taken = np.empty(near.shape), []
    for first, runs, k in groups:
        of = near[first:first + runs * k].reshape(runs, k, len(x))
        best, own = of[:, 0].copy(), np.zeros((runs, len(x)), np.int32)
        for j in range(1, k):
            np.copyto(own, j, where=of[:, j] < best)
            np.minimum(best, of[:, j], out=best)
        into = member[first:first + runs * k].reshape(runs, k, len(x))
        for j in range(k):
            np.equal(own, j, out=into[:, j])
        taken.append(own)
    return member @ np.concatenate([x, np.ones((len(x), 1))], axis=1), taken


def _moved(blocks: DataFrame, centres: dict[int, np.ndarray], inertia: bool = False) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Of each run: sums and numbers of the rows nearest to its centres and, if asked for, their squared distances, from one scan.

    A task sends one row per run, and the rows of a run are added; the driver gets one row per run.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(centres)
    kinds = "run int, sums binary, counts binary, inertia double"

    def batch_of(found: dict[int, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), *[pa.array([f[i].tobytes() for f in found.values()], pa.binary()) for i in (0, 1)],
                                           pa.array([f[2] for f in found.values()])], names=["run", "sums", "counts", "inertia"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        runs = sorted(centres, key=lambda r: len(centres[r]))
        sizes = np.array([len(centres[r]) for r in runs])
        stacked, begins = np.concatenate([centres[r] for r in runs]), np.cumsum([0, *sizes])
        norms = (stacked * stacked).sum(axis=1)
        groups = [(int(begins[np.searchsorted(sizes, k)]), int((sizes == k).sum()), int(k)) for k in np.unique(sizes)]
        total, away = np.zeros((len(stacked), stacked.shape[1] + 1)), np.zeros(len(runs))
        any_row = False
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = np.frombuffer(data.as_buffer()).reshape(n, -1)
                for at in range(0, n, TILE):
                    x = whole[at:at + TILE]
                    any_row = True
                    sums, taken = tile_sums(x, stacked, norms, groups)
                    total += sums
                    if inertia:
                        for i, own in enumerate(own for of in taken for own in of):
                            apart = x - stacked[begins[i]:begins[i + 1]][own]
                            away[i] += float((apart * apart).sum())
        if any_row:
            yield batch_of({r: [total[a:b, :-1], total[a:b, -1].astype(np.int64), float(w)] for r, a, b, w in zip(runs, begins[:-1], begins[1:], away)})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                new = [np.frombuffer(r["sums"]), np.frombuffer(r["counts"], np.int64), r["inertia"]]
                total[r["run"]] = [a + b for a, b in zip(total[r["run"]], new)] if r["run"] in total else new
        if total:
            yield batch_of(total)

    merged = blocks.mapInArrow(scan, kinds).repartition("run").mapInArrow(merge, kinds).collect()
    sent.unpersist()
    return {r["run"]: (np.frombuffer(r["sums"]).reshape(centres[r["run"]].shape), np.frombuffer(r["counts"], np.int64), r["inertia"]) for r in merged}


def fit_many(rows: DataFrame, runs: list[tuple[int, int]], iterations: int = 300, tolerance: float = 1e-9) -> tuple[list[Fit], int]:
    """A fit for each ``(k, seed)``, and the number of scans of ``rows`` (one column: arrays of doubles without nulls) that moved their centres; one more sums distances.

    A run ends when no centre moves further than ``tolerance``, so its centres are the means of their rows, or after ``iterations`` scans; it
    then leaves the scans of the others. A centre without rows stays where it is. With fewer distinct rows than ``k`` there are as
    many centres as rows; without rows there is no fit.
    """
    x = rows.columns[0]
    sample = rows.orderBy(F.xxhash64(x), x).limit(SAMPLE).toArrow().column(0).combine_chunks()
    if not len(sample):
        return [], 0
    drawn = matrix_of(sample)
    active = {i: starting_points(drawn, k, seed) for i, (k, seed) in enumerate(runs)}
    done: dict[int, tuple[np.ndarray, int]] = {}
    scans = 0
    blocks = _packed(rows).persist()
    try:
        while active:
            scans += 1
            for i, (sums, counts, _) in _moved(blocks, active).items():
                old = active[i]
                new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], old)
                if np.abs(new - old).max() <= tolerance or scans >= iterations:
                    done[i] = old, scans
                    del active[i]
                else:
                    active[i] = new
        # distances are summed once, for the centres that the runs ended with
        last = _moved(blocks, {i: points for i, (points, _) in done.items()}, inertia=True) if done else {}
    finally:
        blocks.unpersist()
    return [Fit(*runs[i], done[i][0], last[i][1], last[i][2], done[i][1]) for i in range(len(runs))], scans
