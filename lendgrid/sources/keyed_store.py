"""A keyed table of delta files under a manifest: writes touch new rows only, the last write of a key is resolved on read."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

_ENTRY = "version long, batch string, path string, base boolean"


@dataclass(frozen=True)
class KeyedStore:
    """The table below ``folder``. Each version of the manifest names one file set: a delta (a batch of rows), or a base that replaces all before it.

    A batch is written first and named in the manifest afterwards, so one that fails halfway is never read. The manifest's folder of a
    version can be made once only: of two writers of one version, one fails and may try again.
    """

    spark: SparkSession
    folder: str
    key: str

    def entries(self) -> list:
        """The manifest, by version: one row per write, whatever the number of rows."""
        try:
            found = self.spark.read.schema(_ENTRY).json(f"{self.folder}/manifest/*").collect()
        except AnalysisException:  # no write yet
            return []
        return sorted(found, key=lambda e: e["version"])

    def _commit(self, version: int, batch: str, path: str, base: bool) -> None:
        entry = self.spark.createDataFrame([(version, batch, path, base)], _ENTRY)
        entry.coalesce(1).write.mode("errorifexists").json(f"{self.folder}/manifest/{version}")

    def write(self, batch: str, rows: DataFrame, order: str | None = None) -> bool:
        """Add a batch. Of its rows with one key the one with the highest ``order`` wins (by default any one); rows without a key are left out.

        A batch that the manifest has already is not written again, so a repeated job changes nothing; the result says whether it was.
        """
        entries = self.entries()
        if any(e["batch"] == batch for e in entries):
            return False
        fields = [c for c in rows.columns if c not in (self.key, order)]
        known = rows.where(F.col(self.key).isNotNull())
        pick = F.max_by(F.struct(*fields), F.col(order)) if order else F.first(F.struct(*fields))
        path = f"{self.folder}/delta-{uuid.uuid4().hex}"
        known.groupBy(self.key).agg(pick.alias("_v")).select(self.key, "_v.*").write.parquet(path)
        self._commit(entries[-1]["version"] + 1 if entries else 0, batch, path, False)
        return True

    def _live(self) -> list:
        entries = self.entries()
        start = max((i for i, e in enumerate(entries) if e["base"]), default=0)
        return entries[start:]

    def read(self) -> DataFrame:
        """The row of the latest version of every key."""
        live = self._live()
        if not live:
            raise ValueError(f"nothing was written to {self.folder}")
        merged = None
        for e in live:
            part = self.spark.read.parquet(e["path"]).withColumn("_version", F.lit(e["version"]))
            merged = part if merged is None else merged.unionByName(part)
        if len(live) == 1:  # a base or a single batch has each key once
            return merged.drop("_version")
        fields = [c for c in merged.columns if c not in (self.key, "_version")]
        return merged.groupBy(self.key).agg(F.max_by(F.struct(*fields), "_version").alias("_v")).select(self.key, "_v.*")

    def compact(self) -> None:
        """Write what ``read`` gives as a new base; files before it are no longer read, and stay for readers that have begun."""
        live = self._live()
        if len(live) > 1:
            path = f"{self.folder}/base-{uuid.uuid4().hex}"
            self.read().write.parquet(path)
            self._commit(live[-1]["version"] + 1, f"base-{live[-1]['version']}", path, True)
