"""Ordered computations without a global window: running sums, ranks, exact quantiles.

A window without a partition key puts every row into one task. Here the rows
are placed into value ranges first; each range is summed on its own, and the
sums of the ranges before it (a table of one row per range) are added.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.functions.hashing import hash_key
from lendgrid.operators.summaries import column_summaries
from lendgrid.session import cut_lineage, shuffle_width


def place_in_ranges(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Add ``_range``: the index of the value range that holds ``column``, in rising order.

    The bounds are one short list of numbers, fixed before the plan is built,
    so a recomputed task places its rows as before.
    """
    ranges = ranges or shuffle_width(df)
    points = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(df.approxQuantile(column, points, 0.5 / ranges)))
    if not bounds:
        return df.withColumn("_range", F.lit(0.0))
    splits = [-math.inf, *bounds, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol="_range").transform(df)


def running_sums(placed: DataFrame, order: list[Column], sums: list[str], keys: tuple[str, ...] = (),
                 descending: bool = False) -> DataFrame:
    """Add ``cum_<s>`` (up to and with the row) and ``all_<s>`` (of the key) for each ``s``.

    ``placed`` carries ``_range``; ``order`` must agree with the order of the ranges.
    """
    totals = placed.groupBy(*keys, "_range").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    step = F.col("_range").desc() if descending else F.col("_range").asc()
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_range").alias("_offset_range"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    local = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # a missing key is a key of its own
    same = F.col("_range") == F.col("_offset_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    out = placed.join(offsets, same)
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"_off_{s}") + F.sum(s).over(local))
    return out.drop("_range", "_offset_range", *[f"_key_{k}" for k in keys], *[f"_off_{s}" for s in sums])


def global_positions(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the given order, for any sortable columns.

    Rows are sorted into ranges; the written copy keeps each row's range, so the
    positions do not depend on a range sampled anew.
    """
    ranged = df.repartitionByRange(shuffle_width(df), *order).withColumn("_range", F.spark_partition_id())
    fixed = cut_lineage(ranged).withColumn("_one", F.lit(1).cast("long"))
    placed = running_sums(fixed, [F.col(c) for c in order], ["_one"])
    return placed.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one", "all__one")


def hash_rank(df: DataFrame, id_col: str, seed: int, keys: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """Add ``rank`` (1..n in a seeded random order within the keys) and ``n`` (rows of the key).

    Hash values are uniform, so their leading digits are even ranges and no
    class, however large, meets in one task.
    """
    ranges = ranges or shuffle_width(df) * 4
    placed = (
        df.withColumn("_hash", hash_key(F.col(id_col), seed))
        .withColumn("_range", F.floor(F.conv(F.substring("_hash", 1, 6), 16, 10).cast("double") * ranges / 16.0**6))
        .withColumn("_one", F.lit(1).cast("long"))
    )
    ranked = running_sums(placed, [F.col("_hash"), F.col(id_col)], ["_one"], keys)
    return ranked.drop("_hash", "_one").withColumnsRenamed({"cum__one": "rank", "all__one": "n"})


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same ones for the same seed.

    Each task keeps its ``n`` smallest hashes, so only candidates are merged.
    """
    return df.withColumn("_hash", hash_key(F.col(id_col), seed)).orderBy("_hash", id_col).limit(n).drop("_hash")


def exact_quantiles(df: DataFrame, probabilities: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of several columns, exact, in one scan or two.

    The first scan sums all columns up, which settles those with few distinct values. For the others the summary gives a bracket that
    holds the two neighbours of each quantile; a second scan counts what lies below and passes on only what lies inside, which is sorted in
    ranges. NaN counts as missing.
    """
    summaries = column_summaries(df, list(probabilities))
    result: dict[str, list[float | None]] = {c: [None] * len(ps) for c, ps in probabilities.items()}
    wanted = []  # (column, quantile index, lower bound, upper bound, position, summary values between the bounds)
    for c, s in summaries.items():
        n = s.n
        for j, p in enumerate(probabilities[c]):
            position = (n - 1) * p
            if n and s.exact:
                lower, upper = s.at_rank(math.floor(position)), s.at_rank(math.ceil(position))
                result[c][j] = lower + (upper - lower) * (position - math.floor(position))
            elif n:
                values, weights = s.pairs()
                run, at = weights.cumsum(), math.floor(position)
                # true ranks are within the error: at most as many rows up to ``low``, and at least two more up to ``high``
                first, last = int(run.searchsorted(at - s.error, "right")), int(run.searchsorted(at + 2 + s.error, "left"))
                low, high = values[first - 1] if first else -math.inf, values[last] if last < len(values) else math.inf
                wanted.append((c, j, float(low), float(high), position, [float(v) for v in values[first:last]]))
    found = _values_at(df, wanted)
    for key, (c, j, _, _, position, _) in enumerate(wanted):
        lower, upper = found[(key, math.floor(position))], found[(key, math.ceil(position))]
        result[c][j] = lower + (upper - lower) * (position - math.floor(position))
    return result


def _values_at(df: DataFrame, wanted: list[tuple]) -> dict[tuple[int, int], float]:
    """Values at two neighbouring positions per request, found inside their brackets."""
    if not wanted:
        return {}
    columns = sorted({w[0] for w in wanted})
    values = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(columns)])
    x = [F.col(f"c{columns.index(w[0])}") for w in wanted]
    below = values.agg(*[F.count_if(v < F.lit(w[2])).alias(f"b{k}") for k, (v, w) in enumerate(zip(x, wanted))]).first()
    inside = F.array_compact(F.array(*[F.when((v >= F.lit(w[2])) & (v <= F.lit(w[3])), F.struct(F.lit(k).alias("_key"), v.alias("_value"))) for k, (v, w) in enumerate(zip(x, wanted))]))
    counts = values.select(F.explode(inside).alias("_s")).select("_s.*").groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("_n"))
    # the summary's own values cut a bracket into ranges
    cuts = F.array(*[F.array(*[F.lit(v) for v in w[5]]).cast("array<double>") for w in wanted])[F.col("_key")]
    placed = counts.withColumn("_range", F.size(F.filter(cuts, lambda v: v < F.col("_value"))))
    summed = running_sums(placed, [F.col("_value")], ["_n"], ("_key",))
    floors = F.array(*[F.lit(math.floor(w[4]) - below[f"b{k}"]).cast("long") for k, w in enumerate(wanted)])[F.col("_key")]
    rows = (
        summed.withColumn("_at", floors)
        .where((F.col("cum__n") > F.col("_at")) & (F.col("cum__n") - F.col("_n") <= F.col("_at") + 1))
        .select("_key", "_value", "_n", F.col("cum__n").alias("_end"), "_at")
        .collect()  # at most two rows per request
    )
    found = {}
    for row in rows:
        for position in (row["_at"], row["_at"] + 1):
            if row["_end"] - row["_n"] <= position < row["_end"]:
                found[(row["_key"], position + below[f"b{row['_key']}"])] = row["_value"]
    return found
