"""Join to a table of unique keys where many rows may share one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key that a larger share of the rows has than one in so many is joined by broadcast: fewer keys than that.
FREQUENT = 1000


def lookup(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Left join of ``rows`` with ``table``, whose ``key`` is unique; a null key finds nothing.

    Frequent keys meet their row in a broadcast table of fewer than ``FREQUENT`` entries, so no task gets all rows of one; the others are
    shuffled. The keys are counted in a scan of their own, combined before the shuffle.
    """
    added = [c for c in table.columns if c != key]
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    often = counts.where(F.col("_n") * FREQUENT > total).select(key, F.lit(True).alias("_often"))
    near = rows.join(F.broadcast(often.join(table, key, "left")), key, "left")
    rare = F.col("_often").isNull() & F.col(key).isNotNull()
    columns = [*rows.columns, *added]
    far = near.where(rare).select(*rows.columns).join(table, key, "left").select(*columns)
    return near.where(~rare).select(*columns).unionByName(far)
