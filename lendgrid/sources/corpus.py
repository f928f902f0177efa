"""Policy documents in markdown files."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendgrid.functions.texts import strip_blank
from lendgrid.session import mounted_folder

#: Files that a task reads, and bytes of text that it hands over at a time.
TASK_FILES, BATCH_BYTES = 4096, 4 << 20
#: Endings of files that Spark's reader unpacks.
PACKED = ("bz2", "deflate", "gz", "lz4", "passthrough", "snappy", "xz", "zst")
#: Characters of a name that are escaped in Spark's ``file_name``.
_ESCAPED = re.compile(r"[^\w!'()*:@&=+$,;.~\-\x80-\U0010ffff]|[\x80-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def split_title(raw: Column) -> tuple[Column, Column]:
    """Title (first line without its ``#`` marks) and body of a markdown text."""
    text = F.regexp_replace(strip_blank(raw), r"\r\n?", "\n")
    first = F.substring_index(text, "\n", 1)
    title = strip_blank(F.regexp_replace(first, r"^#+", ""))
    body = strip_blank(F.substring(text, F.length(first) + F.lit(1), F.length(text)))
    return title, body


def write_corpus(pages: DataFrame, folder: str) -> None:
    """A text file of its own in ``folder`` for every row of the only column, ``part-<partition>-<write>-c<row>.txt``; a line end follows each text.

    Spark's writer spends far more on a file than the file takes (a checksum file beside it, and a process for the rights of each), so
    tasks write a plain folder themselves. They move their files into place when all are written; a task that runs again makes the same ones.
    """
    spark, plain = pages.sparkSession, mounted_folder(pages.sparkSession, folder)
    if plain is None:
        pages.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
        return
    os.makedirs(plain)
    write = uuid.uuid4().hex

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        waiting, count = f"{plain}/_temporary/{uuid.uuid4().hex}", 0
        name = lambda i: f"part-{TaskContext.get().partitionId():05d}-{write}-c{i:06d}.txt"
        for batch in batches:
            os.makedirs(waiting, exist_ok=True)
            for value in batch.column(0):
                with open(f"{waiting}/{name(count)}", "wb") as f:
                    f.write((value.as_py() or b"") + b"\n")
                count += 1
        for i in range(count):
            os.replace(f"{waiting}/{name(i)}", f"{plain}/{name(i)}")
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["files"])

    pages.select(F.col(pages.columns[0]).cast("binary")).mapInArrow(put, "files long").agg(F.sum("files")).collect()


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _whole_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``value, file`` of every matching file of a folder.

    Spark's reader holds each file on the driver and deals a few to a task. Files of a plain folder are listed in a task and dealt out by name instead.
    """
    plain, ending = mounted_folder(spark, folder), pattern[1:]
    files, flat = 0, plain is not None and re.fullmatch(r"\*\.\w+", pattern) is not None and ending[1:].lower() not in PACKED and os.path.isdir(plain)
    if flat:
        for entry in os.scandir(plain):
            files += 1
            flat = flat and not ("=" in entry.name and entry.is_dir())  # partitions are read too
    if not flat:
        raw = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
        return raw.select("value", F.col("_metadata.file_name").alias("file"))

    def names(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for entry in os.scandir(plain):
            if entry.name.endswith(ending) and not _hidden(entry.name) and entry.is_file():
                found.append(entry.name)
            if len(found) == TASK_FILES:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["file"])
                found = []
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["file"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, own, held = [], [], 0
        close = lambda: pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(own, pa.string())], names=["value", "file"])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open(f"{plain}/{name}", "rb") as f:
                    text = f.read()
                if not text:
                    continue  # Spark's reader skips empty files
                texts.append(text)
                own.append(_ESCAPED.sub(lambda m: quote(m[0], safe=""), name))
                held += len(text)
                if held >= BATCH_BYTES:
                    yield close()
                    texts, own, held = [], [], 0
        if own:
            yield close()

    tasks = max(spark.sparkContext.defaultParallelism, -(-files // TASK_FILES))
    dealt = spark.range(1, numPartitions=1).mapInArrow(names, "file string").repartition(tasks)
    # bytes are kept as they are
    return dealt.mapInArrow(read, "value binary, file string").select(F.col("value").cast("string").alias("value"), "file")


def scan_corpus(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """``doc_id, title, text`` of every matching file, in no order; the id is the file name without its ending."""
    raw = _whole_files(spark, folder, pattern)
    title, body = split_title(F.col("value"))
    doc_id = F.regexp_replace("file", r"\.[^.]*$", "")
    return raw.select(doc_id.alias("doc_id"), title.alias("title"), body.alias("text"))
