"""Categories as numbers from a dictionary table, for columns with more values than there may be one-hot columns."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions.defaults import PSI_FLOOR
from lendgrid.operators.ordered import global_positions

#: A value that a larger share of a column's rows has than one in so many is looked up in a broadcast table: fewer than that per column.
FREQUENT = 1000


def _cells(df: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """``(*kept, column, value)``: one row per row and column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(*kept, F.explode(cells).alias("_c")).select(*kept, "_c.column", "_c.value")


def extend_dictionary(df: DataFrame, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """``(column, value, number)`` of all values of ``df`` and of a dictionary made before.

    Numbers run from 1 in each column. A known value keeps its number; new ones follow the highest, in the order of the values. Missing
    values have no entry: their number is 0. Write the result before the next step reads it.
    """
    found = _cells(df, columns).where(F.col("value").isNotNull()).distinct()
    if known is not None:
        found = found.join(known.select("column", "value"), ["column", "value"], "left_anti")
    placed = global_positions(found, ["column", "value"])
    first = placed.groupBy("column").agg(F.min("position").alias("_first"))
    if known is not None:
        last = known.groupBy("column").agg(F.max("number").alias("_last"))
        first = first.join(last, "column", "left")
    else:
        first = first.withColumn("_last", F.lit(None).cast("long"))
    number = F.col("position") - F.col("_first") + 1 + F.coalesce("_last", F.lit(0))
    fresh = placed.join(F.broadcast(first), "column").select("column", "value", number.alias("number"))  # one row per column
    return fresh if known is None else known.select("column", "value", "number").unionByName(fresh)


def category_numbers(df: DataFrame, dictionary: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """``(id, numbers)``: a map from column to number, 0 for a missing value and null for one that the dictionary lacks.

    ``id`` names a row; a repeated one is an error. Values that many rows share meet their numbers in a broadcast table of fewer than
    ``FREQUENT`` entries a column, so only the rare ones are shuffled to the dictionary.
    """
    cells = _cells(df, columns, id_col)
    counts = cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    totals = F.broadcast(cells.groupBy("column").agg(F.count(F.lit(1)).alias("_all")))
    often = counts.join(totals, "column").where(F.col("_n") * FREQUENT > F.col("_all")).select("column", "value")
    frequent = often.join(dictionary.select("column", "value", "number"), ["column", "value"], "left").withColumn("_frequent", F.lit(True))
    looked_up = cells.join(F.broadcast(frequent), ["column", "value"], "left")
    rare = F.col("_frequent").isNull() & F.col("value").isNotNull()
    settled = looked_up.where(~rare).select(id_col, "column", F.when(F.col("value").isNull(), F.lit(0)).otherwise(F.col("number")).alias("number"))
    others = looked_up.where(rare).select(id_col, "column", "value").join(dictionary, ["column", "value"], "left").select(id_col, "column", "number")
    entries = F.collect_list(F.struct("column", F.col("number").cast("int").alias("number")))  # as many as there are columns
    return settled.unionByName(others).groupBy(id_col).agg(F.map_from_entries(entries).alias("numbers"))


def sparse_categories(numbered: DataFrame, dictionary: DataFrame, columns: list[str], output: str = "categories") -> DataFrame:
    """Add a sparse vector with a 1 for each column's category: per column missing first, then the numbers, then one place for unknown values."""
    highest = {r["column"]: r["last"] for r in dictionary.groupBy("column").agg(F.max("number").alias("last")).collect()}
    inputs, outputs = [f"_in_{i}" for i in range(len(columns))], [f"_out_{i}" for i in range(len(columns))]
    ends = numbered.sparkSession.createDataFrame([[float(highest.get(c, 0)) for c in columns]], ", ".join(f"{i} double" for i in inputs))
    encoder = OneHotEncoder(inputCols=inputs, outputCols=outputs, dropLast=False, handleInvalid="keep").fit(ends)
    unknown = {c: F.lit(float(highest.get(c, 0) + 1)) for c in columns}
    codes = {i: F.coalesce(F.col("numbers")[c].cast("double"), unknown[c]) for i, c in zip(inputs, columns)}
    encoded = encoder.transform(numbered.withColumns(codes))
    return VectorAssembler(inputCols=outputs, outputCol=output).transform(encoded).drop(*inputs, *outputs)


def category_drift(df: DataFrame, columns: list[str], is_reference: Column, floor: float = PSI_FLOOR) -> DataFrame:
    """``(column, value, psi)``: the stability index that each category's one-hot column would have, from counts; a null value is the missing one."""
    counts = (
        _cells(df.withColumn("_ref", is_reference).where(F.col("_ref").isNotNull()), columns, "_ref")
        .groupBy("column", "value")
        .agg(F.sum(F.col("_ref").cast("long")).alias("r"), F.sum((~F.col("_ref")).cast("long")).alias("c"))
    )
    totals = counts.groupBy("column").agg(F.sum("r").alias("all_r"), F.sum("c").alias("all_c"))

    def share(n: Column, total: str) -> Column:
        return F.when((n > 0) & (F.col(total) > 0), n / F.col(total)).otherwise(F.lit(floor))

    def part(r: Column, c: Column) -> Column:
        r, c = share(r, "all_r"), share(c, "all_c")
        return (r - c) * F.log(r / c)

    r, c = F.col("r"), F.col("c")
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", (part(r, c) + part(F.col("all_r") - r, F.col("all_c") - c)).alias("psi")
    )
