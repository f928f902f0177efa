"""Scans and sinks of the relational tables and the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lendgrid.functions.nullsafe import nan_to_null
from lendgrid.sources.schemas import CHUNK_SCHEMA, SCHEMAS


def csv_schema(spark: SparkSession, path: str, declared: StructType) -> StructType:
    """Schema in file order: declared types where known, names from the header for the rest.

    Only the header line is read. An undeclared column is a double, unless its
    name says that it holds text.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    known = {field.name: field for field in declared.fields}
    textual = ("NAME_", "CODE_", "FLAG_OWN_", "FLAG_LAST_APPL", "WEEKDAY_", "STATUS", "CREDIT_CURRENCY", "CREDIT_TYPE", "OCCUPATION_", "ORGANIZATION_",
               "FONDKAPREMONT_", "HOUSETYPE_", "WALLSMATERIAL_", "EMERGENCYSTATE_", "CHANNEL_", "PRODUCT_")
    return StructType(
        [
            known.get(name)
            or StructField(name, StringType() if name.startswith(textual) else DoubleType(), True)
            for name in header
        ]
    )


def scan_csv(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None,
             schema: StructType | None = None) -> DataFrame:
    """One credit table from ``<folder>/<name>.csv``; an empty field is missing.

    ``columns`` prunes the scan: the parser then skips the other fields.
    """
    path = f"{folder}/{name}.csv"
    schema = schema or csv_schema(spark, path, SCHEMAS[name])
    df = nan_to_null(spark.read.schema(schema).option("header", True).csv(path))
    textual = {f.name for f in schema.fields if isinstance(f.dataType, StringType)}
    # a quoted empty field is missing as well
    df = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in textual else F.col(f"`{c}`") for c in df.columns])
    return df.select(*columns) if columns else df


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = nan_to_null(spark.read.parquet(path))
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the parquet table at ``path``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    write_table(chunks.select("doc_id", "chunk_id", "title", "text"), path)


def read_chunks(spark: SparkSession, path: str, as_json: bool = False) -> DataFrame:
    """Chunk store written by ``write_chunks``, or a file holding one JSON array."""
    if as_json:
        return spark.read.schema(CHUNK_SCHEMA).option("multiLine", True).json(path)
    return spark.read.schema(CHUNK_SCHEMA).parquet(path)


def append_run(spark: SparkSession, path: str, run: str, params: dict, metrics: dict) -> None:
    """Add one tracking record as (run, kind, key, value) rows; earlier rows stay."""
    rows = [(run, "param", str(k), str(v)) for k, v in params.items()]
    rows += [(run, "metric", str(k), repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run string, kind string, key string, value string").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run string, kind string, key string, value string").parquet(path)


def assert_unique(df: DataFrame, key: str, expected_rows: DataFrame | None = None) -> DataFrame:
    """One row ``(n_rows, n_keys, key_is_unique[, n_expected, rows_kept])``."""
    rows = df.select(F.col(key).alias("_k"), F.lit(1).alias("_row"), F.lit(0).alias("_exp"))
    if expected_rows is not None:
        rows = rows.unionByName(
            expected_rows.select(F.col(key).alias("_k"), F.lit(0).alias("_row"), F.lit(1).alias("_exp"))
        )
    # two levels: a hot key is merged map-side before the shuffle
    per_key = rows.groupBy("_k").agg(F.sum("_row").alias("_row"), F.sum("_exp").alias("_exp"))
    out = per_key.agg(
        F.sum("_row").alias("n_rows"),
        F.sum((F.col("_row") > 0).cast("long")).alias("n_keys"),
        (F.max("_row") == 1).alias("key_is_unique"),
        F.sum("_exp").alias("n_expected"),
    )
    if expected_rows is None:
        return out.drop("n_expected")
    return out.withColumn("rows_kept", F.col("n_rows") == F.col("n_expected"))


def enforce_unique(df: DataFrame, key: str, expected_rows: DataFrame | None = None) -> None:
    """Raise when a key repeats or the row count changed."""
    row = assert_unique(df, key, expected_rows).first()
    if row["n_rows"] and not row["key_is_unique"]:
        raise ValueError(f"{key} repeats: {row['n_rows']} rows, {row['n_keys']} keys")
    if expected_rows is not None and not row["rows_kept"]:
        raise ValueError(f"row count changed: {row['n_rows']} instead of {row['n_expected']}")
