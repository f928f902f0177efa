"""The score log with every batch in it once: files count only when the manifest names their batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from lendgrid.sources.schemas import LOG_SCHEMA

_ENTRY = "source string, batch long, path string, n long"


@dataclass(frozen=True)
class LogStore:
    """A log below ``folder``. A batch is written first and named in the manifest afterwards, under its source and number.

    A batch that fails in between is not read, and a batch that is sent again adds nothing. The manifest's folder of a batch can be made once
    only, so of two writers of one batch one fails; its files are never read.
    """

    spark: SparkSession
    folder: str

    def batches(self) -> DataFrame:
        """The manifest: a row per batch."""
        try:
            return self.spark.read.schema(_ENTRY).json(f"{self.folder}/manifest/*/*")
        except AnalysisException:  # no batch yet
            return self.spark.createDataFrame([], _ENTRY)

    def has(self, source: str, batch: int) -> bool:
        return bool(self.batches().where((F.col("source") == source) & (F.col("batch") == batch)).limit(1).count())

    def append(self, source: str, batch: int, entries: DataFrame) -> bool:
        """Add a batch of log entries; false if the log has it already. Sources are names without a slash."""
        if self.has(source, batch):
            return False
        path = f"{self.folder}/entries/{source}-{batch}-{uuid.uuid4().hex}"
        entries.select(*LOG_SCHEMA.names).write.json(path)
        self._commit(source, batch, path)
        return True

    def _commit(self, source: str, batch: int, path: str) -> None:
        n = self.spark.read.schema(LOG_SCHEMA).json(path).count()
        entry = self.spark.createDataFrame([(source, batch, path, n)], _ENTRY)
        entry.coalesce(1).write.mode("errorifexists").json(f"{self.folder}/manifest/{source}/{batch}")

    def read(self) -> DataFrame:
        """All entries of the batches in the manifest."""
        paths = [r["path"] for r in self.batches().select("path").collect()]  # a row per batch
        return self.spark.read.schema(LOG_SCHEMA).json(paths) if paths else self.spark.createDataFrame([], LOG_SCHEMA)


def known_only(entries: DataFrame, known: DataFrame, id_col: str = "sk_id_curr") -> DataFrame:
    """Entries of known applicants; an id that is missing or unknown writes nothing."""
    return entries.join(known.select(id_col), id_col, "left_semi").select(*entries.columns)


def start_log_store(entries: DataFrame, store: LogStore, source: str, checkpoint: str) -> StreamingQuery:
    """Write a stream of log entries to the store, taking all present input and then stopping.

    Spark numbers the batches in ``checkpoint`` and sends one again after a failure: the number decides whether it is new.
    """
    return (
        entries.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(lambda rows, number: store.append(source, number, rows) and None).start()
    )
