"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.llm.frames import fresh, written

_EDGE = " \t\r"


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line, F.lit(_EDGE))))


def _filled(line: Column) -> Column:
    return F.trim(line, F.lit(_EDGE)) != ""


def _host(column: str) -> Column:
    """A missing host is a host of its own."""
    return F.when(F.col(f"`{column}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("h"), F.col(f"`{column}`").cast("string")))


def boilerplate_lines(docs: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """One row per host with such lines: ``host`` and ``keys``, the MD5 of each line found on too large a share of its pages.

    A page counts once per line. ``keys`` is short: a host's lines sum up to its line total, and each one kept here fills more
    than ``max_ratio`` of its pages, so there are fewer than (lines a page / ``max_ratio``) of them.
    """
    page = docs.select(_host(host).alias("host"), F.split(F.col(f"`{text}`"), "\n", -1).alias("lines"))
    totals = page.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = F.array_distinct(F.transform(F.filter("lines", _filled), _key))
    counts = page.select("host", F.explode(lines).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= min_pages).join(totals, "host").filter(F.col("n") / F.col("pages") > max_ratio)
    return frequent.groupBy("host").agg(F.collect_set("key").alias("keys"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.05, min_pages: int = 5,
                     counts: bool = False) -> DataFrame:
    """``docs`` with the lines removed that occur on more than ``max_ratio`` of their host's pages.

    Lines are split at ``\\n`` and compared without blanks, tabs and ``\\r`` at their ends; lines with nothing else always stay.
    A line found on fewer than ``min_pages`` pages is no boilerplate however small its host is. A page that would lose
    every line keeps its text: copies of whole pages are left to document dedup. Rows never go, a missing text stays
    missing, a missing host is a host of its own, and a repeated row is one more page. With ``counts`` the columns ``n_lines``,
    ``n_dropped`` and ``all_boilerplate`` come along.

    Line counts are combined before the shuffle and keyed by host and line, so a large host spreads over all tasks. The
    per-host lists are written first: Spark broadcasts them if they are small, else it joins by host and splits a large one.
    """
    found = written(boilerplate_lines(docs, host, text, max_ratio, min_pages), "boilerplate")
    at, keys, lines, kept, filled = fresh(docs, "host_key", "host_lines", "page_lines", "kept_lines", "filled_lines")
    joined = docs.withColumn(at, _host(host)).join(found.toDF(at, keys), at, "left")
    split = joined.withColumn(lines, F.split(F.col(f"`{text}`"), "\n", -1))
    stays = lambda x: ~_filled(x) | ~F.array_contains(F.col(keys), _key(x))
    chosen = split.withColumn(kept, F.when(F.col(keys).isNull(), F.col(lines)).otherwise(F.filter(F.col(lines), stays)))
    gone = F.size(lines) - F.size(kept)
    chosen = chosen.withColumn(filled, (gone > 0) & ~F.exists(F.col(kept), _filled))
    cleaned = F.when((gone > 0) & ~F.col(filled), F.array_join(kept, "\n")).otherwise(F.col(f"`{text}`"))
    columns = [cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        missing = F.col(f"`{text}`").isNull()
        columns = [c for c, name in zip(columns, docs.columns) if name not in ("n_lines", "n_dropped", "all_boilerplate")] + [
            F.when(missing, 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
            F.when(missing | F.col(filled), 0).otherwise(gone).cast("long").alias("n_dropped"),
            F.coalesce(F.col(filled), F.lit(False)).alias("all_boilerplate"),
        ]
    return chosen.select(*columns)
