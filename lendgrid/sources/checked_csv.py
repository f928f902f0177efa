"""CSV scans that lose nothing: fields that do not fit their type put the row aside, with its text and the reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from lendgrid.functions.nullsafe import nan_to_null

RECORD = "_record"


@dataclass(frozen=True)
class CheckedTable:
    """``rows`` with their types; ``rejects`` as ``(failed, record, fields)``: names of the columns at fault, the line where it could not be
    cut into fields (else null), and the fields as text."""

    rows: DataFrame
    rejects: DataFrame

    def failures(self) -> DataFrame:
        """``(column, n)``: rejected rows by the column at fault."""
        return self.rejects.select(F.explode("failed").alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def _fits(text: Column, kind: str) -> Column:
    return text.isNull() | text.try_cast(kind).isNotNull()


def checked_csv(spark: SparkSession, path: str, declared: StructType, store: str, limit: float = 0.0) -> CheckedTable:
    """Read ``path`` once, write it typed below ``store``, and give the written copy.

    An empty field is missing. A row fails if a field does not fit the declared type of its column, or if it has more or fewer fields than
    the header. A column that is not declared is a number if all its fields are, else text, so none is lost to a guess. A file whose header
    differs is an error. So is a share of failing rows above ``limit``; what was rejected lies below ``store`` then as well.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    kinds = {f.name: f.dataType.simpleString() for f in declared.fields if f.name in header}
    texts = StructType()
    for name in (*header, RECORD):
        texts.add(name, StringType(), True)
    read = (
        spark.read.schema(texts).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD).csv(path)
    )
    raw = read.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in header], RECORD)
    reasons = [F.when(F.col(RECORD).isNotNull(), F.lit(RECORD))]
    reasons += [F.when(~_fits(F.col(f"`{c}`"), kind), F.lit(c)) for c, kind in kinds.items()]
    failed = F.array_compact(F.array(*reasons))
    typed = [F.col(f"`{c}`").try_cast(kinds.get(c, "string")).alias(c) for c in header]
    fields = F.struct(*[F.col(f"`{c}`") for c in header])
    checked = raw.select(*typed, failed.alias("_failed"), RECORD, fields.alias("_fields")).withColumn("_ok", F.size("_failed") == 0)
    checked.withColumn("_fields", F.when(~F.col("_ok"), F.col("_fields"))).write.mode("errorifexists").partitionBy("_ok").parquet(store)
    stored = spark.read.schema(checked.schema).parquet(store)  # declared: an empty table leaves no file to ask
    rejects = stored.where(~F.col("_ok")).select(F.col("_failed").alias("failed"), F.col(RECORD).alias("record"), F.col("_fields").alias("fields"))
    rows = stored.where("_ok").select(*[F.col(f"`{c}`") for c in header])
    result = CheckedTable(nan_to_null(_numbers(rows, [c for c in header if c not in kinds])), rejects)
    n, bad = stored.agg(F.count(F.lit(1)), F.count_if(~F.col("_ok"))).first()
    if bad > limit * n:
        counts = {r["column"]: r["n"] for r in result.failures().collect()}  # a row per column
        raise ValueError(f"{bad} of {n} rows of {path} do not fit: {counts}; see {store}")
    return result


def _numbers(rows: DataFrame, undeclared: list[str]) -> DataFrame:
    """Doubles for those text columns in which every present field is a number."""
    if not undeclared:
        return rows
    other = rows.agg(*[F.count_if(~_fits(F.col(f"`{c}`"), "double")).alias(f"o{i}") for i, c in enumerate(undeclared)]).first()
    return rows.withColumns({c: F.col(f"`{c}`").cast("double") for i, c in enumerate(undeclared) if other[f"o{i}"] == 0})
