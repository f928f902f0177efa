"""Replies of external models, kept: a prompt is asked once, and reruns read the table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lendgrid.operators.batches import apply_in_batches
from lendgrid.operators.lookup import lookup
from lendgrid.sources.keyed_store import KeyedStore


@dataclass(frozen=True)
class ReplyStore:
    """Replies of the model called ``name`` in a keyed table; the key is a digest of name and prompt, so one table serves many models.

    ``kind`` is the type of a reply.
    """

    table: KeyedStore
    name: str
    kind: str = "string"

    def ask(self, rows: DataFrame, prompt: str, model: Callable[[list], list], output: str, batch: int = 64) -> DataFrame:
        """``rows`` with ``output``, the reply to each row's ``prompt``; a null prompt is not asked and has a null reply.

        Only prompts without a stored reply are asked, each once however many rows have it. Replies are written and named in the
        manifest before they are used, so whatever is computed later, or again, sees the same ones.
        """
        key = self.table.key
        digest = F.when(F.col(prompt).isNotNull(), F.sha2(F.concat(F.lit(f"{self.name}\n"), F.col(prompt)), 256))
        keyed = rows.withColumn(key, digest)
        new = keyed.where(F.col(key).isNotNull()).groupBy(key).agg(F.first(prompt).alias("_prompt"))
        if self.table.entries():
            new = new.join(self.table.read().select(key), key, "left_anti")
        replied = apply_in_batches(new, "_prompt", model, "reply", self.kind, batch).select(key, "reply")
        self.table.write(uuid.uuid4().hex, replied)
        replies = self.table.read().select(key, F.col("reply").alias(output))
        return lookup(keyed, key, replies).select(*rows.columns, output)
