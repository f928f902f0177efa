"""Filter interaction audit: what each filter removes at each place of each order, by counting paths through the lattice of filter sets."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from lendgrid.llm.frames import words_of, written

#: The filters of ``text_failures`` and ``repeat_failures``, in the order of their bits.
FILTERS = "ABCDE"
#: A digest that at least one row in so many has is looked up in a small broadcast table, which has no more digests than this.
HOT_SHARE = 1000


@dataclass(frozen=True)
class Edge:
    """Applying ``filter`` after all filters of ``state`` (a bit each), and the number of orders that do so."""

    state: int
    filter: int
    orders: int


def lattice_edges(k: int) -> list[Edge]:
    """The edges between the sets of ``k`` filters.

    Forward counts say how many ways lead from no filter to a set, backward counts how many lead on from there to all of them; an
    edge lies on as many orders as the product of the count at its tail and the count at its head.
    """
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):  # every set comes after its subsets
        for f in range(k):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        backward[state] += sum(backward[state | 1 << f] for f in range(k) if not state >> f & 1)
    return [Edge(s, f, forward[s] * backward[s | 1 << f]) for s in range(full + 1) for f in range(k) if not s >> f & 1]


def order_steps(names: str) -> list[tuple[str, int, int, int]]:
    """``(order, step, state, filter)``: the edges on the way of every order of the filters."""
    steps = []
    for order in permutations(range(len(names))):
        state = 0
        for i, f in enumerate(order):
            steps.append(("".join(names[j] for j in order), i + 1, state, f))
            state |= 1 << f
    return steps


def audit_filters(failures: DataFrame, names: str = FILTERS) -> DataFrame:
    """What every filter does at every step of every order, by part.

    ``failures`` has a row per document: ``part``, ``mask`` (bit i is set if the document fails ``names[i]``), ``good`` and
    ``toxic`` (0 or 1, or null for 0). The result has, per ``part``, ``filter_order`` and ``step``: ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``. Every part of ``failures`` has all orders, zeros included; without rows
    there is no part and the result is empty. A null part or mask counts as an empty string or as no failure.

    Documents are summed per part and mask (at most 2^k rows a part) before the one shuffle of all rows; each of these sums is then added
    to the k * 2^(k-1) edges of the lattice. The steps of an order are read from its edges, and the removals of all edges of a filter,
    each times the number of orders that take it, make its Shapley sum.
    """
    spark, edges = failures.sparkSession, lattice_edges(len(names))
    cells = failures.groupBy(F.coalesce("part", F.lit("")).alias("part"), F.coalesce("mask", F.lit(0)).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    literal = F.array(*[F.struct(F.lit(e.state).alias("state"), F.lit(e.filter).alias("filter"), F.lit(e.orders).alias("orders")) for e in edges])
    at = cells.select("*", F.explode(literal).alias("e")).select("part", "mask", "n", "good", "toxic", "e.*")
    alive = F.col("mask").bitwiseAND(F.col("state")) == 0
    own = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    fails = F.col("mask").bitwiseAND(own) != 0
    total = lambda condition, of: F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")
    flows = at.groupBy("part", "state", "filter", "orders").agg(
        total(alive & ~fails, "n").alias("kept"), total(alive & fails, "n").alias("removed"), total(~alive & fails, "n").alias("redundant"),
        total(F.col("mask") == own, "n").alias("unique_fails"), total(alive & fails, "good").alias("good_lost"), total(alive & fails, "toxic").alias("toxic_lost"))
    shares = flows.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).cast("long").alias("shapley"))
    # orders x steps rows, whatever the data
    steps = spark.createDataFrame(order_steps(names), "filter_order string, step int, state int, filter int")
    return flows.join(shares, ["part", "filter"]).join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: A under 50 words; B under 65 % distinct words; C over 5 % capitals of all code
    points; D holds one of ``#$%&*|``."""
    body = F.coalesce(text, F.lit(""))
    words = words_of(body)
    n = F.size(words)
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    checks = (n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(body), body.rlike("[#$%&*|]"))
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(checks)), F.lit(0))


def _repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``digest`` and others) with ``repeats``: whether a row with a smaller id has the digest.

    A digest that over a thousandth of all rows have (there are fewer than a thousand) is looked up where the rows are; the others, none
    of which is frequent, are joined.
    """
    total = rows.count()
    first = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n"))
                    .filter("first_id < last_id").select("digest", "first_id", "n"), "repeated")
    hot = first.filter(F.col("n") * HOT_SHARE >= total).select("digest", F.col("first_id").alias("hot_id"))
    rest = first.filter(F.col("n") * HOT_SHARE < total).select(F.col("digest").alias("key"), "first_id")
    marked = rows.join(F.broadcast(hot), "digest", "left")
    # a row that is settled gets a key of its own, so that a hot digest is dealt out too
    keyed = marked.withColumn("key", F.when(F.col("hot_id").isNull(), F.col("digest")).otherwise(F.encode(F.concat(F.lit("#"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "utf-8")))
    found = keyed.join(rest, "key", "left")
    return found.select(*rows.columns, F.coalesce(F.col("doc_id") > F.coalesce("hot_id", "first_id"), F.lit(False)).alias("repeats"))


def document_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id part mask good toxic`` per row of ``docs`` (``doc_id text source``), for ``audit_filters``.

    A null text is empty, a null source the part ``""``. Filter E fails if any row with a smaller id has the same text (by its SHA-256),
    removed or not; rows that share an id do not repeat each other, and a row without an id repeats nothing and is repeated by
    nothing. ``labels`` has ``doc_id quality toxic``; of repeated labels one with a 1 is enough, and a row without an id has none.
    Whole texts are read once; what follows moves ids and digests only.
    """
    body = F.coalesce("text", F.lit(""))
    measured = written(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_failures(F.col("text")).alias("mask"),
                                   F.unhex(F.sha2(body, 256)).alias("digest")), "measured")
    rated = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    bit = FILTERS.index("E")
    return _repeats(measured).join(rated, "doc_id", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("repeats"), 1 << bit).otherwise(0)).alias("mask"), "good", "toxic")
