"""Overlapping word chunks of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.functions.defaults import CHUNK_OVERLAP, CHUNK_WORDS
from lendgrid.functions.texts import words


def chunk_text(text: Column, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of chunks; a text of at most ``size`` words is returned untouched."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap

    def windows(w: Column) -> Column:
        last = F.ceil((F.size(w) - size) / F.lit(step)).cast("int")
        starts = F.sequence(F.lit(0), last)
        return F.when(F.size(w) <= size, F.array(text)).otherwise(
            F.transform(starts, lambda i: F.array_join(F.slice(w, i * step + 1, size), " "))
        )

    # the outer transform binds the words, so a text is split once
    return F.transform(F.array(words(text)), windows)[0]


def chunk_documents(documents: DataFrame, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """``doc_id, chunk_no, chunk_id, title, text``; the id is ``<doc_id>::<chunk_no>``."""
    exploded = documents.select(
        "doc_id", "title", F.posexplode(chunk_text(F.col("text"), size, overlap)).alias("chunk_no", "text")
    )
    chunk_id = F.concat(F.col("doc_id").cast("string"), F.lit("::"), F.col("chunk_no").cast("string"))
    return exploded.select("doc_id", "chunk_no", chunk_id.alias("chunk_id"), "title", "text")
