"""Repeatable pseudo-random order and numbers from an id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(id_col: Column, seed: int | Column) -> Column:
    """32 hex digits that any engine with MD5 reproduces."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", id_col.cast("string"), seed.cast("string")))


def hash_uniform(key: Column) -> Column:
    """Number in [0, 1) from the first seven hex digits of a key."""
    return F.conv(F.substring(key, 1, 7), 16, 10).cast("double") / F.lit(float(16**7))


def poisson_one(u: Column) -> Column:
    """Poisson(1) draw by inverting its distribution function at ``u``."""
    steps, term, total = [], 2.718281828459045**-1, 0.0
    for k in range(0, 9):
        total += term
        steps.append((total, k))
        term /= k + 1
    out = F.when(u < F.lit(steps[0][0]), F.lit(0))
    for bound, k in steps[1:]:
        out = out.when(u < F.lit(bound), F.lit(k))
    return out.otherwise(F.lit(9)).cast("double")
