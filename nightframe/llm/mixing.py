"""Mixing sources to target weights: budgets down a tree of domain, language and source.

The token budget is divided down the tree by weights. A child that can't use its share takes what it has, and its
siblings take over the rest; a node asks for no more than its children can give, so a shortage reaches an
ancestor's siblings only when its own are exhausted. Each leaf fills its budget from seeded epochs, each the whole
leaf in another order, as a prefix of whole documents. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightframe.llm.common import SPACE, checkpoint

LEVELS = ("domain", "lang", "source")


def words(text: Column) -> Column:
    """Tokens of a text for the budget: its words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def share_out(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """``nodes`` with ``budget``: the parent's ``above``, divided by ``weight`` and bounded by ``supply``.

    Filled from the child that is exhausted first: while a child's supply is at most its share of what is left
    it gets all of it; from the first that isn't, the rest is divided by weight, rounded down. All in whole numbers.
    A weight of 0 gets nothing.
    """
    ratio = F.col("supply") / F.when(F.col("weight") > 0, F.col("weight"))
    by_rank = Window.partitionBy(*parent).orderBy(F.col("weight") <= 0, ratio, *order)
    before = by_rank.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(*parent)
    ranked = nodes.withColumns(
        {
            "left": F.col("above") - F.coalesce(F.sum("supply").over(before), F.lit(0)),
            "weights": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("exhausted", (F.col("weight") > 0) & (F.col("supply") * F.col("weights") <= F.col("weight") * F.col("left")))
    first = F.min(F.when(~F.col("exhausted"), F.struct(F.col("weight") <= 0, ratio, *order, "left", "weights")))
    open_part = first.over(all_rows)
    rest = F.when(F.col("weight") > 0, F.expr("weight * open_left div nullif(open_weights, 0)")).otherwise(F.lit(0))
    return (
        ranked.withColumns({"open_left": open_part["left"], "open_weights": open_part["weights"]})
        .withColumn("budget", F.when(F.col("exhausted"), F.col("supply")).otherwise(F.coalesce(rest, F.lit(0))).cast("long"))
        .drop("left", "weights", "exhausted", "open_left", "open_weights")
    )


def budgets(supply: DataFrame, weights: DataFrame, budget_percent: int, max_epochs: int) -> DataFrame:
    """``domain, lang, source, tokens, budget`` for each leaf of ``supply`` (a row per leaf with ``tokens``).

    ``weights`` has ``level, name, weight``: whole numbers for the names of a level; others weigh 1. The whole budget is
    ``budget_percent`` of all tokens. A leaf can give its tokens ``max_epochs`` times.
    """
    leaves = supply.withColumn("supply", F.col("tokens") * max_epochs)

    def weighted(nodes: DataFrame, level: str) -> DataFrame:
        own = weights.where(F.col("level") == level).select(F.col("name").alias("__name"), F.col("weight").cast("long").alias("weight"))
        joined = nodes.join(own, F.col(level) == F.col("__name"), "left").drop("__name")
        return joined.withColumn("weight", F.coalesce("weight", F.lit(1)))

    total = supply.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    domains = leaves.groupBy("domain").agg(F.sum("supply").alias("supply"))
    domains = domains.withColumn("above", F.lit(total * budget_percent // 100).cast("long"))
    domains = share_out(weighted(domains, "domain"), ["above"], ["domain"])
    langs = leaves.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    langs = langs.join(domains.select("domain", F.col("budget").alias("above")), "domain")
    langs = share_out(weighted(langs, "lang"), ["domain"], ["lang"])
    ends = leaves.join(langs.select("domain", "lang", F.col("budget").alias("above")), ["domain", "lang"])
    return share_out(weighted(ends, "source"), ["domain", "lang"], ["source"]).select(*LEVELS, "tokens", "budget")


def mix(
    docs: DataFrame,
    weights: DataFrame,
    domain: Column,
    budget_percent: int = 50,
    max_epochs: int = 2,
    seed: int = 7,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    max_sent_leaves: int = 100_000,
    prefix: str = "mix_",
) -> DataFrame:
    """The chosen rows of ``docs`` with ``mix_epoch``, ``mix_tokens`` and ``mix_budget`` (of the row's leaf).

    These three begin with ``prefix``; columns of ``docs`` that have their names are left out, all others are kept, whatever their names.
    An empty table, or one without words, has no rows. Texts of any length are counted whole.

    A leaf takes its whole epochs first; of the last one it takes the longest prefix of documents, in the order of the md5 of
    seed, epoch and id, that doesn't exceed the budget. Null ids, languages and sources count as the empty string;
    a text without words costs nothing and goes with its place in the order. Of rows with one id in a leaf, all go
    or none. Only sums per leaf and order range, and the documents of each leaf's last range, are shuffled; the texts never
    are, as the leaves' cuts, one row for each leaf of the tree, are joined to the documents.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = {"domain": "__nf_domain", "lang": "__nf_lang", "source": "__nf_source"}
    rows = docs.withColumns(
        {key["lang"]: name(lang), key["source"]: name(source), "__nf_id": name(id), "__nf_tokens": words(F.col(text)),
         key["domain"]: F.coalesce(domain.cast("string"), F.lit(""))}
    )
    narrow = checkpoint(rows.select(*[F.col(v).alias(k) for k, v in key.items()], F.col("__nf_id").alias("id"), F.col("__nf_tokens").alias("tokens")))
    supply = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    shared = checkpoint(budgets(supply, weights, budget_percent, max_epochs))
    leaf = list(LEVELS)
    # the epoch that a leaf doesn't finish, counted from 0, and what it may take of it
    plans = shared.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)))
    plans = plans.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    position = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("id")))
    placed = narrow.withColumnRenamed("tokens", "doc_tokens")
    ordered = placed.join(plans.where("rest > 0"), leaf).withColumn("place", position)
    # ranges of the order by its first digits: sums first, then only the range in which the budget ends
    ordered = ordered.withColumn("range", F.substring("place", 1, 3))
    sums = ordered.groupBy(*leaf, "rest", "range").agg(F.sum("doc_tokens").alias("n"))
    running = Window.partitionBy(*leaf).orderBy("range")
    sums = sums.withColumn("through", F.sum("n").over(running))
    last = (
        sums.where("through > rest").groupBy(*leaf).agg(F.min(F.struct("range", (F.col("through") - F.col("n")).alias("before"))).alias("m"))
        .select(*leaf, F.col("m.range").alias("range"), F.col("m.before").alias("before"))
    )
    inside = ordered.join(last, [*leaf, "range"])
    per_id = inside.groupBy(*leaf, "rest", "before", "place").agg(F.sum("doc_tokens").alias("n"))
    running = Window.partitionBy(*leaf).orderBy("place")
    over = per_id.withColumn("through", F.col("before") + F.sum("n").over(running)).where("through > rest")
    ends = over.groupBy(*leaf).agg(F.min("place").alias("cut"))  # the first that doesn't fit
    cuts = plans.join(ends, leaf, "left").select(
        *[F.col(k).alias(f"__nf_cut_{k}") for k in (*leaf, "whole", "rest", "cut", "budget")]
    )
    # one row per leaf: sent to every task if the tree is small, shuffled with the documents if it isn't
    cuts = F.broadcast(cuts) if shared.count() <= max_sent_leaves else cuts
    joined = rows.join(cuts, reduce(lambda a, b: a & b, [F.col(v) == F.col(f"__nf_cut_{k}") for k, v in key.items()]))
    whole, rest, cut = (F.col(f"__nf_cut_{k}") for k in ("whole", "rest", "cut"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), whole.cast("string"), F.col("__nf_id")))
    partly = (rest > 0) & (cut.isNull() | (place < cut))
    taken = whole + F.when(partly, 1).otherwise(0)
    out = joined.where(taken > 0).withColumn("__nf_epoch", F.explode(F.sequence(F.lit(0), taken.cast("int") - 1)))
    made = {f"{prefix}epoch": "__nf_epoch", f"{prefix}tokens": "__nf_tokens", f"{prefix}budget": "__nf_cut_budget"}
    kept = [c for c in docs.columns if c.lower() not in {m.lower() for m in made}]
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col(v).alias(k) for k, v in made.items()])
