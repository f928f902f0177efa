"""Summaries of the values of many columns in one pass: exact while a column has few distinct values, with bounded rank errors beyond."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Distinct values up to which a summary is exact; values of one weight that it keeps beyond.
EXACT, WIDTH = 1 << 13, 1 << 12


def values_of(columns: tuple[str, ...] | list[str]) -> Column:
    """The columns of a row as one array of doubles; NaN and null are missing."""
    return F.array(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns])


def matrix_of(values: pa.Array) -> np.ndarray:
    """Rows x columns of a list column of doubles; missing is NaN."""
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1) if len(values) else np.empty((0, 0))


class Summary:
    """Values of a column with their weights.

    Up to ``EXACT`` distinct values each has its count. Beyond, values lie on levels, where one of level i stands for 2^i rows; a level
    with more than ``WIDTH`` values is sorted and every other one, from the first or the second in turn, goes one level up. Each such
    step moves a rank by at most the weight of its level, and ``error`` adds that up. Summaries can be merged in any order.
    """

    def __init__(self):
        self.values, self.weights = np.empty(0), np.empty(0, np.int64)
        self.levels: list[np.ndarray] | None = None
        self.error, self.turn = 0, 0

    @property
    def exact(self) -> bool:
        return self.levels is None

    @property
    def n(self) -> int:
        return int(self.pairs()[1].sum())

    def add(self, values: np.ndarray, weights: np.ndarray, error: int = 0, exact: bool = True) -> None:
        self.error += error
        if self.levels is None:
            self.values, place = np.unique(np.concatenate([self.values, values]), return_inverse=True)
            self.weights = np.bincount(place, np.concatenate([self.weights, weights]), len(self.values)).astype(np.int64)
            if exact and len(self.values) <= EXACT:
                return
            self.levels, values, weights = [], self.values, self.weights
        for i in range(int(weights.max()).bit_length() if len(weights) else 0):
            own = values[(weights >> i) & 1 == 1]
            if len(own):
                self.levels += [np.empty(0)] * (i + 1 - len(self.levels))
                self.levels[i] = np.concatenate([self.levels[i], own])
        i = 0
        while i < len(self.levels):
            if len(self.levels[i]) > WIDTH:
                own = np.sort(self.levels[i])
                rest, own = (own[-1:], own[:-1]) if len(own) % 2 else (own[:0], own)
                if i + 1 == len(self.levels):
                    self.levels.append(np.empty(0))
                self.levels[i], self.levels[i + 1] = rest, np.concatenate([self.levels[i + 1], own[self.turn::2]])
                self.turn, self.error = 1 - self.turn, self.error + (1 << i)
            i += 1

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values in order and their weights."""
        if self.levels is None:
            return self.values, self.weights
        values = np.concatenate(self.levels) if self.levels else np.empty(0)
        weights = np.concatenate([np.full(len(v), 1 << i, np.int64) for i, v in enumerate(self.levels)]) if self.levels else np.empty(0, np.int64)
        distinct, place = np.unique(values, return_inverse=True)
        return distinct, np.bincount(place, weights, len(distinct)).astype(np.int64)

    def at_rank(self, rank: float) -> float:
        """The value at a rank from 0."""
        values, weights = self.pairs()
        return float(values[min(len(values) - 1, int(np.searchsorted(np.cumsum(weights), rank, "right")))])


_KINDS = "column int, exact boolean, error long, values binary, weights binary"


def _rows_of(found: dict[int, Summary]) -> pa.RecordBatch:
    pairs = [s.pairs() for s in found.values()]
    return pa.RecordBatch.from_arrays([
        pa.array(list(found), pa.int32()), pa.array([s.exact for s in found.values()]), pa.array([s.error for s in found.values()], pa.int64()),
        pa.array([v.tobytes() for v, _ in pairs], pa.binary()), pa.array([w.tobytes() for _, w in pairs], pa.binary())], names=[c.split()[0] for c in _KINDS.split(", ")])


def column_summaries(df: DataFrame, columns: list[str] | tuple[str, ...]) -> dict[str, Summary]:
    """A summary of every column, from one scan: tasks sum up what they read, and those of a column are merged.

    What reaches the driver is one summary per column, of bounded size.
    """
    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Summary] = {}
        for batch in batches:
            x = matrix_of(batch.column(0))
            for j in range(x.shape[1]):
                found.setdefault(j, Summary()).add(*np.unique(x[:, j][~np.isnan(x[:, j])], return_counts=True))
        if found:
            yield _rows_of(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Summary] = {}
        for batch in batches:
            for r in batch.to_pylist():
                found.setdefault(r["column"], Summary()).add(np.frombuffer(r["values"]), np.frombuffer(r["weights"], np.int64), r["error"], r["exact"])
        if found:
            yield _rows_of(found)

    out = {c: Summary() for c in columns}
    if columns:
        for r in df.select(values_of(columns).alias("x")).mapInArrow(sum_up, _KINDS).repartition("column").mapInArrow(merge, _KINDS).collect():
            out[columns[r["column"]]].add(np.frombuffer(r["values"]), np.frombuffer(r["weights"], np.int64), r["error"], r["exact"])
    return out
