"""Mixing sources to target weights: hierarchical token budgets over a domain, language and source tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendgrid.llm.frames import GAPS, fresh, words_of, written

_WHOLE = "decimal(38,0)"
#: Order keys of a leaf fall into so many ranges; only the range that holds a leaf's cut is sorted row by row.
RANGES = 4096


def order_key(doc_id: str, epoch: Column, seed: int) -> Column:
    """The place of a document in the seeded order of an epoch; equal ids share it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("none"))))


def share_budget(nodes: DataFrame, parent: Sequence[str], key: str) -> DataFrame:
    """``nodes`` with ``budget``: each parent's ``parent_budget`` dealt out by ``weight``, no node above its ``capacity``.

    What a full node cannot take goes to its siblings by their weights. Siblings are sorted by capacity / weight; up to the
    first one that its share does not fill, all are full, and the rest is dealt to the others. A weight of 0 gets nothing.
    Fractions of a token are dropped.
    """
    siblings = Window.partitionBy(*parent)
    fill = (F.col("capacity") / F.col("weight"))
    ranked = siblings.orderBy(fill, key)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    weighted = nodes.filter(F.col("weight") > 0)
    tokens_before = F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_WHOLE)
    weight_left = (F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(_WHOLE)
    open_share = weighted.withColumn("_before", tokens_before).withColumn("_left", weight_left)
    # the node is full if dealing the rest by weight gives it its capacity or more
    full = (F.col("parent_budget") - F.col("_before")) * F.col("weight") >= F.col("capacity") * F.col("_left")
    first_open = F.min(F.when(~full, F.struct(fill.alias("f"), F.col(key), F.col("_before"), F.col("_left")))).over(siblings)
    dealt = open_share.withColumn("_full", full).withColumn("_open", first_open)
    rest = F.expr("CAST((parent_budget - _open._before) * weight AS DECIMAL(38,0)) div CAST(_open._left AS DECIMAL(38,0))")
    budget = F.when(F.col("_full"), F.col("capacity")).otherwise(F.greatest(F.lit(0), rest.cast("long"))).cast("long")
    return dealt.withColumn("budget", budget).drop("_before", "_left", "_full", "_open")


def leaf_budgets(leaves: DataFrame, budget: Column, max_epochs: int) -> DataFrame:
    """Budgets of the leaves (``domain lang source tokens`` and the weights ``w_domain w_lang w_source``).

    A node can take ``max_epochs`` times the tokens below it, so a shortage is filled by siblings first and reaches an ancestor
    only if the whole subtree is short.
    """
    total = leaves.agg(F.sum("tokens").alias("all_tokens")).select(budget.cast("long").alias("parent_budget"))
    source = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast("long"))
    usable = source.filter(F.col("w_source") > 0)
    lang = usable.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"), F.max("w_domain").alias("w_domain"), F.max("w_lang").alias("weight"))
    domain = lang.filter(F.col("weight") > 0).groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.max("w_domain").alias("weight"))
    # one row of totals meets the few domains
    of_domain = share_budget(domain.withColumn("top", F.lit(1)).join(F.broadcast(total.withColumn("top", F.lit(1))), "top"), ["top"], "domain")
    of_lang = share_budget(lang.drop("w_domain").join(of_domain.select("domain", F.col("budget").alias("parent_budget")), "domain"), ["domain"], "lang")
    return share_budget(
        usable.withColumnRenamed("w_source", "weight").join(
            of_lang.select("domain", "lang", F.col("budget").alias("parent_budget")), ["domain", "lang"]),
        ["domain", "lang"], "source")


def default_domain(source: str = "source") -> Column:
    """The domain of a source: the remainder of its number by 4 (no number: the first domain)."""
    number = F.coalesce(F.regexp_extract(F.col(f"`{source}`"), r"([0-9]{1,9})$", 1).try_cast("long"), F.lit(0))
    return F.element_at(F.array(*[F.lit(x) for x in ("web", "books", "code", "forum")]), (number % 4 + 1).cast("int"))


#: Whole-number weights: of each domain, and of each language within its domain (others get 1). Sources weigh 1 each.
DOMAIN_WEIGHTS = {"web": 4, "books": 3, "code": 2, "forum": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def _lookup(column: Column, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for k, v in sorted(weights.items()):
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out.cast("long")


def mix_sources(docs: DataFrame, domain: Column | None = None, lang: str = "lang", source: str = "source", text: str = "text",
                doc_id: str = "doc_id", share: float = 0.5, max_epochs: int = 2, seed: int = 7, domain_weights=None,
                lang_weights=None, source_weights=None, counts: bool = False) -> DataFrame:
    """The documents chosen to fill a token budget by target weights, with ``copies``: how often each is to be read.

    The budget is ``share`` of all tokens (words). It is dealt down the tree by weight; what a node cannot take, even when read
    ``max_epochs`` times, goes to its siblings before its ancestors' siblings. A leaf with budget B and T tokens is read
    B div T times whole, and of the next epoch the documents are read whose tokens start within the first B mod T ones, in the
    order of MD5(seed, epoch, id). Documents without words are never chosen; missing languages, sources and domains are leaves
    named "none"; equal ids share their place. An empty table gives an empty result.

    No leaf is sorted whole: ranges of order keys are summed, and only the range that holds the cut is sorted. The cut is one
    key per leaf, so texts are filtered where they are read and never shuffled, unless the leaf table is too large to broadcast.
    """
    names = fresh(docs, "domain", "leaf_lang", "leaf_source", "n_tokens", "copies", "cut_epochs", "cut_key")
    at_domain, at_lang, at_source, tokens, copies, whole, cut = names
    missing = F.lit("none")
    tagged = (
        docs.withColumn(at_domain, F.coalesce(domain if domain is not None else default_domain(source), missing))
        .withColumn(at_lang, F.coalesce(F.col(f"`{lang}`").cast("string"), missing))
        .withColumn(at_source, F.coalesce(F.col(f"`{source}`").cast("string"), missing))
    )
    sized = written(tagged.select(F.col(at_domain).alias("domain"), F.col(at_lang).alias("lang"), F.col(at_source).alias("source"),
                                  F.col(f"`{doc_id}`").alias("doc_id"), F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("tokens")).filter("tokens > 0"), "mix-sizes")
    leaves = sized.groupBy("domain", "lang", "source").agg(F.sum("tokens").alias("tokens"))
    leaves = (leaves.withColumn("w_domain", _lookup(F.col("domain"), DOMAIN_WEIGHTS if domain_weights is None else domain_weights, 1))
              .withColumn("w_lang", _lookup(F.col("lang"), LANG_WEIGHTS if lang_weights is None else lang_weights, 1))
              .withColumn("w_source", _lookup(F.col("source"), source_weights or {}, 1)))
    budgets = leaf_budgets(leaves, F.floor(F.col("all_tokens") * share), max_epochs).filter("budget > 0").select(
        "domain", "lang", "source", (F.expr("budget div tokens")).cast("int").alias("epochs"), (F.col("budget") % F.col("tokens")).alias("rest"))
    leaf = ["domain", "lang", "source"]
    budgets = written(budgets, "mix-budgets")
    # documents of the last, partial epoch: sums by range, then row by row in the range of the cut
    keyed = sized.join(budgets.filter("rest > 0"), leaf).withColumn("key", order_key("doc_id", F.col("epochs"), seed))
    keyed = keyed.groupBy(*leaf, "rest", "key").agg(F.sum("tokens").alias("tokens"))
    keyed = keyed.withColumn("range", F.expr(f"CAST(conv(substring(key, 1, 4), 16, 10) AS INT) div {65536 // RANGES}"))
    sums = keyed.groupBy(*leaf, "rest", "range").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    last = sums.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("tokens") >= F.col("rest"))).select(*leaf, "range", "start")
    inside = Window.partitionBy(*leaf, "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (keyed.join(last, [*leaf, "range"]).withColumn("at", F.col("start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
            .filter(F.col("at") < F.col("rest")).groupBy(*leaf).agg(F.max("key").alias("cut")))
    plan = written(budgets.join(cuts, leaf, "left").select(*leaf, "epochs", "cut"), "mix-plan")
    filled = F.trim(F.col(f"`{text}`"), F.lit(GAPS)) != ""
    chosen = tagged.filter(filled).join(plan.toDF(at_domain, at_lang, at_source, whole, cut), [at_domain, at_lang, at_source])
    extra = F.when(order_key(doc_id, F.col(whole), seed) <= F.col(cut), 1).otherwise(0)
    result = chosen.withColumn(copies, (F.col(whole) + extra).cast("int")).filter(F.col(copies) > 0)
    more = [F.col(copies)] + ([F.col(at_domain), F.size(words_of(F.col(f"`{text}`"))).cast("long").alias(tokens)] if counts else [])
    return result.select(*[F.col(f"`{c}`") for c in docs.columns], *more)
