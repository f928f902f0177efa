"""Small helpers of the operators: fresh column names, written intermediate tables, slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.session import shared_folder

#: White space of the word rule: blank and the control characters from tab to carriage return.
GAPS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array; of a missing text, none.

    One blank as the separator takes Java's quick split; a pattern would cost twice as much.
    """
    flat = reduce(lambda c, gap: F.replace(c, F.lit(gap), F.lit(" ")), GAPS[1:], F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(flat, " ", -1), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def scratch_path(df_or_spark, name: str) -> str:
    """A new folder below the one that all executors share."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    The copy outlives lost executors, and its size is known when later joins are planned.
    """
    path = scratch_path(df, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` (strings or bytes) holds about ``most`` bytes a slice, one row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        lengths = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def texts_as_bytes(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each string; a missing one is empty."""
    return [b"" if v is None else v for v in values.cast(pa.binary()).to_pylist()]
