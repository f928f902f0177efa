"""Apply a supplied function to a column, in batches inside the partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType


def apply_in_batches(df: DataFrame, column: str, function: Callable[[list], list], output: str, output_type: str,
                     batch: int = 64) -> DataFrame:
    """Add ``output = function(values)``, called with up to ``batch`` values at a time.

    The function stands for an external model: it gets a list and returns a
    list of the same length.
    """
    schema = StructType([*df.schema.fields, StructField(output, DataType.fromDDL(output_type))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame[column].tolist()
            results: list = []
            for start in range(0, len(values), batch):
                part = values[start:start + batch]
                answers = list(function(part))
                if len(answers) != len(part):
                    raise ValueError(f"{len(part)} values in, {len(answers)} out")
                results += answers
            yield frame.assign(**{output: pd.Series(results, index=frame.index, dtype="object")})

    return df.mapInPandas(run, schema)
