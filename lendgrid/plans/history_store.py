"""Histories kept as sums per applicant: a new month is added to the store, and earlier rows are not read again."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendgrid.functions.nullsafe import count_where, safe_div
from lendgrid.operators.features import KEY, add_no_record_flags, dpd_level, join_features

BATCH = "_batch"


def _mean(name: str, value: Column) -> list[Column]:
    return [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]


def _known(df: DataFrame, *keys: str) -> DataFrame:
    return reduce(lambda rows, key: rows.where(F.col(key).isNotNull()), keys, df)


def _bureau(df: DataFrame) -> DataFrame:
    return _known(df, KEY).groupBy(KEY).agg(
        F.count("SK_ID_BUREAU").alias("credits"), count_where(F.col("CREDIT_ACTIVE") == "Active").alias("active"),
        *_mean("credit", F.col("AMT_CREDIT_SUM")), F.max("AMT_CREDIT_SUM").alias("credit_max"),
        *_mean("debt", F.col("AMT_CREDIT_SUM_DEBT")), F.sum("AMT_CREDIT_SUM_OVERDUE").alias("overdue_sum"),
        F.max("AMT_CREDIT_SUM_OVERDUE").alias("overdue_max"), *_mean("annuity", F.col("AMT_ANNUITY")),
    )


def _bureau_ids(df: DataFrame) -> DataFrame:
    return _known(df, KEY, "SK_ID_BUREAU").groupBy("SK_ID_BUREAU", KEY).agg(F.count(F.lit(1)).alias("times"))


def _balance(df: DataFrame) -> DataFrame:
    level = dpd_level(F.col("STATUS"))
    return _known(df, "SK_ID_BUREAU").groupBy("SK_ID_BUREAU").agg(
        F.count("MONTHS_BALANCE").alias("months"), count_where(level > 0).alias("past_due"), F.max(level).alias("level_max"),
    )


def _previous(df: DataFrame) -> DataFrame:
    status = F.col("NAME_CONTRACT_STATUS")
    return _known(df, KEY).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("lines"), F.count("SK_ID_PREV").alias("applications"), count_where(status == "Refused").alias("refused"),
        count_where(status == "Approved").alias("approved"), *_mean("credit", F.col("AMT_CREDIT")),
        *_mean("annuity", F.col("AMT_ANNUITY")), *_mean("days", F.col("DAYS_DECISION")),
    )


def _pos(df: DataFrame) -> DataFrame:
    return _known(df, KEY).groupBy(KEY, "SK_ID_PREV").agg(
        F.count(F.lit(1)).alias("lines"), count_where(F.col("SK_DPD") > 0).alias("past_due"), F.max("SK_DPD").alias("dpd_max"),
    )


def _card(df: DataFrame) -> DataFrame:
    used = safe_div(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL"))
    return _known(df, KEY).groupBy(KEY, "SK_ID_PREV").agg(
        F.count(F.lit(1)).alias("lines"), count_where(F.col("SK_DPD") > 0).alias("past_due"), *_mean("used", used),
        F.max(used).alias("used_max"),
    )


def _installments(df: DataFrame, late_days: int = 5) -> DataFrame:
    delay = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return _known(df, KEY).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("lines"), count_where(delay > late_days).alias("late"), *_mean("delay", delay),
        F.max(delay).alias("delay_max"), *_mean("shortfall", F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")),
    )


@dataclass(frozen=True)
class History:
    """``source`` rows become ``sums`` per ``keys``; the store is bucketed by ``buckets`` of them."""

    source: str
    keys: tuple[str, ...]
    buckets: tuple[str, ...]
    sums: Callable[[DataFrame], DataFrame]


#: Stores of histories. Those of one applicant's many credits are bucketed by the credit too, so that a hot applicant is spread.
HISTORIES = {
    "bureau": History("bureau", (KEY,), (KEY,), _bureau),
    "bureau_ids": History("bureau", ("SK_ID_BUREAU", KEY), ("SK_ID_BUREAU",), _bureau_ids),
    "balance": History("bureau_balance", ("SK_ID_BUREAU",), ("SK_ID_BUREAU",), _balance),
    "previous": History("previous_application", (KEY,), (KEY,), _previous),
    "pos": History("POS_CASH_balance", (KEY, "SK_ID_PREV"), (KEY, "SK_ID_PREV"), _pos),
    "card": History("credit_card_balance", (KEY, "SK_ID_PREV"), (KEY, "SK_ID_PREV"), _card),
    "installments": History("installments_payments", (KEY,), (KEY,), _installments),
}


def _merge(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key from any number of them: a column ``*_max`` is a maximum, every other one a sum."""
    merged = [(F.max if c.endswith("_max") else F.sum)(c).alias(c) for c in sums.columns if c not in (*keys, BATCH)]
    return sums.groupBy(*keys).agg(*merged)


def _ratio(total: str, count: str) -> Column:
    return F.col(total) / F.nullif(F.col(count), F.lit(0))


def _average(name: str) -> Column:
    return _ratio(f"{name}_sum", f"{name}_n")


@dataclass(frozen=True)
class HistoryStore:
    """Sums of the histories in bucketed tables below ``folder``, one partition per batch.

    A batch holds rows that no other batch holds (a month, say). It is reduced to sums before it is written; putting a batch again replaces
    what it held, so a repeated job changes nothing. The folder is the store: the session's catalog only knows its tables by a name made
    from the folder, and a new session names them again. The number of buckets belongs to the folder and stays as it was made.
    """

    spark: SparkSession
    folder: str
    buckets: int

    def _table(self, name: str) -> str:
        return f"history_{name}_{md5(f'{self.folder}|{self.buckets}'.encode()).hexdigest()[:16]}"

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}-{self.buckets}"

    def _open(self, name: str) -> str | None:
        """The table of a history in this session's catalog; None where no batch has it."""
        table = self._table(name)
        if self.spark.catalog.tableExists(table):
            return table
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        if not path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return None
        self._create(name, self.spark.read.parquet(self._path(name)))
        self.spark.catalog.recoverPartitions(table)
        return table

    def _create(self, name: str, rows: DataFrame) -> None:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != BATCH)
        by = ", ".join(HISTORIES[name].buckets)
        self.spark.sql(
            f"CREATE TABLE {self._table(name)} ({fields}, {BATCH} string) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self._path(name)}'"
        )

    def put(self, batch: str, tables: dict[str, DataFrame]) -> None:
        """Add or replace a batch; a history that ``tables`` lacks has no rows in it.

        Sums are made map-side before the shuffle, so a hot applicant is a row per task. Each history is committed on its own: a job that fails
        halfway is put again. Batch names are letters, digits, ``-`` and ``_``.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        for name, history in HISTORIES.items():
            table = self._open(name)
            if history.source in tables:
                sums = history.sums(tables[history.source])
                if table is None:
                    self._create(name, sums)
                    table = self._table(name)
            elif table is None:
                continue
            else:
                sums = self.spark.createDataFrame([], self.spark.table(table).schema)
            columns = [c for c in self.spark.table(table).columns if c != BATCH]
            view = f"{table}_{batch.replace('-', '_')}"
            sums.select(*columns).repartition(self.buckets, *history.buckets).createOrReplaceTempView(view)
            self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{batch}') SELECT * FROM {view}")
            self.spark.catalog.dropTempView(view)

    def batches(self, name: str) -> list[str]:
        """Names of the batches with rows of a history."""
        table = self._open(name)
        return [] if table is None else sorted(r[BATCH] for r in self.spark.table(table).select(BATCH).distinct().collect())

    def sums(self, name: str) -> DataFrame:
        """A history's sums over all batches: merged inside the buckets, without a shuffle."""
        table = self._open(name)
        if table is None:
            raise ValueError(f"no batch of {name} was put to {self.folder}")
        return _merge(self.spark.table(table), HISTORIES[name].keys)

    def bureau(self) -> DataFrame:
        return self.sums("bureau").select(
            KEY, F.col("credits").alias("bureau_count"), F.col("active").alias("bureau_active_count"),
            _average("credit").alias("bureau_credit_sum_mean"), F.col("credit_max").alias("bureau_credit_sum_max"),
            F.coalesce("debt_sum", F.lit(0.0)).alias("bureau_debt_sum"), _average("debt").alias("bureau_debt_mean"),
            F.coalesce("overdue_sum", F.lit(0.0)).alias("bureau_overdue_sum"), F.col("overdue_max").alias("bureau_overdue_max"),
            _average("annuity").alias("bureau_annuity_mean"),
        )

    def balance(self) -> DataFrame:
        """Balances and bureau ids lie in the same buckets of the credit; what is shuffled to the applicants is a sum per task."""
        times = F.col("times")
        per_credit = self.sums("bureau_ids").join(self.sums("balance"), "SK_ID_BUREAU")
        return per_credit.groupBy(KEY).agg(
            F.sum("times").alias("bb_credits_with_history"), F.sum(times * F.col("past_due")).alias("bb_months_dpd_sum"),
            F.max("level_max").alias("bb_worst_dpd_level_max"), (F.sum(times * F.col("months")) / F.sum("times")).alias("bb_months_count_mean"),
        )

    def previous(self) -> DataFrame:
        return self.sums("previous").select(
            KEY, F.col("applications").alias("prev_count"), (F.col("refused") > 0).alias("prev_ever_refused"),
            _ratio("approved", "lines").alias("prev_approval_rate"), _average("credit").alias("prev_credit_mean"),
            _average("annuity").alias("prev_annuity_mean"), _average("days").alias("prev_days_decision_mean"),
        )

    def pos(self) -> DataFrame:
        of_credit = F.col("SK_ID_PREV").isNotNull()
        return self.sums("pos").groupBy(KEY).agg(
            F.count("SK_ID_PREV").alias("pos_credits_count"), F.coalesce(F.sum(F.when(of_credit, F.col("lines"))), F.lit(0)).alias("pos_months_count"),
            (F.sum("past_due") / F.sum("lines")).alias("pos_dpd_rate"), F.max("dpd_max").alias("pos_dpd_max"),
        )

    def card(self) -> DataFrame:
        return self.sums("card").groupBy(KEY).agg(
            F.count("SK_ID_PREV").alias("cc_cards_count"), (F.sum("used_sum") / F.nullif(F.sum("used_n"), F.lit(0))).alias("cc_utilization_mean"),
            F.max("used_max").alias("cc_utilization_max"), (F.sum("past_due") / F.sum("lines")).alias("cc_dpd_rate"),
        )

    def installments(self) -> DataFrame:
        return self.sums("installments").select(
            KEY, _average("delay").alias("inst_delay_mean"), F.col("delay_max").alias("inst_delay_max"),
            _ratio("late", "lines").alias("inst_late_rate"), _average("shortfall").alias("inst_shortfall_mean"),
        )

    def features(self, app: DataFrame) -> DataFrame:
        """Applicants with the aggregates of all batches and the coverage flags, as ``joined_features`` gives them from the rows."""
        aggregates = [self.bureau(), self.balance(), self.previous(), self.pos(), self.card(), self.installments()]
        return add_no_record_flags(join_features(app, aggregates))

    def close(self) -> None:
        """Take the tables out of the session's catalog; the folder stays."""
        for name in HISTORIES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
