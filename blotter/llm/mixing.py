"""Mixing to target weights: a tree of budgets and seeded token-prefixes of its leaves."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotter.llm.columns import others
from blotter.operators.joins import lookup
from blotter.session import materialise

LEVELS = ("domain", "lang", "source")
TOKEN = r"[^\x20\x09-\x0D]+"
DIGITS = 4


@dataclass(frozen=True)
class Mix:
    """``budget_pct``: tokens to draw, in percent of all; ``weights``: level -> name ->
    whole weight among its siblings (1 if unlisted, 0 for none); ``epochs``: how often a
    document may come at most."""

    budget_pct: int = 100
    epochs: int = 2
    seed: int = 42
    weights: dict[str, dict[str, int]] = field(default_factory=dict)


def domain_of(source: Column) -> Column:
    """A stand-in domain where the table has none: by the number at the end of the source."""
    number = F.try_to_number(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("999999999"))
    return (
        F.when(number % 3 == 0, "web").when(number % 3 == 1, "books").when(number % 3 == 2, "forum")
        .otherwise("other")
    )


def with_leaf(docs: DataFrame) -> DataFrame:
    """``docs`` with its leaf (``_domain``, ``_lang``, ``_source``) and ``_tokens``."""
    return docs.withColumns(
        {
            "_domain": domain_of(F.coalesce("source", F.lit(""))),
            "_lang": F.coalesce("lang", F.lit("unknown")),
            "_source": F.coalesce("source", F.lit("unknown")),
            "_tokens": F.coalesce(
                F.regexp_count(F.col("text"), F.lit(TOKEN)), F.lit(0)
            ).cast("bigint"),
        }
    )


def allot(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, leaf_tokens) with ``budget``: tokens to draw.

    A node's budget is split among its children by weight; a child that cannot take its
    share (all its leaves together, ``epochs`` times) takes all it has, and the rest goes
    to its siblings in the same way. As the capacity of a child is that of its whole
    subtree, a shortage moves to another subtree only when the own one is used up. Shares
    are whole tokens, rounded down. Counts stay in 64 bits up to 10^15 tokens and sums of
    weights up to 9000.
    """
    capacity = F.col("leaf_tokens") * mix.epochs
    total = leaves.agg(F.coalesce(F.sum("leaf_tokens"), F.lit(0))).first()[0]
    budget: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        above, keys = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        nodes = leaves.groupBy(*keys).agg(F.sum(capacity).alias("_cap"))
        weight = F.lit(1)
        for name, value in mix.weights.get(level, {}).items():
            weight = F.when(F.col(level) == name, F.lit(value)).otherwise(weight)
        nodes = nodes.withColumn("_w", weight.cast("bigint")).where(F.col("_w") > 0)
        if budget is None:
            nodes = nodes.withColumn("budget", F.lit(total * mix.budget_pct // 100))
        else:
            nodes = nodes.join(budget, above)
        ordered = Window.partitionBy(*above).orderBy(F.col("_cap") / F.col("_w"), level)
        whole = Window.partitionBy(*above)
        full = F.col("_cap") * F.col("_from") + F.col("_before") * F.col("_w") <= F.col(
            "budget"
        ) * F.col("_w")
        nodes = (
            nodes.withColumns(
                {
                    "_from": F.sum("_w").over(ordered.rowsBetween(0, Window.unboundedFollowing)),
                    "_before": F.sum("_cap").over(
                        ordered.rowsBetween(Window.unboundedPreceding, 0)
                    ) - F.col("_cap"),
                }
            )
            .withColumn("_full", full)
            .withColumns(
                {
                    "_taken": F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(whole),
                    "_open": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(whole),
                }
            )
        )
        share = F.when(F.col("_full"), F.col("_cap")).otherwise(
            F.expr("(budget - _taken) * _w div _open")
        )
        budget = nodes.select(*keys, share.alias("budget"))
    return leaves.join(budget, list(LEVELS))


def _order(epoch: Column, seed: int) -> Column:
    """Where a document comes in an epoch of its leaf."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.col("doc_id").cast("string")).cast("binary"))


def mix_sources(docs: DataFrame, mix: Mix, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Draw ``docs`` (doc_id, text, lang, source) so that tokens follow the target weights.

    A leaf's documents come in a seeded order of their own in each epoch. Whole epochs are
    taken while the leaf's budget lasts, and of the next one the longest prefix whose
    tokens do not exceed what is left. No leaf is sorted as a whole: sums by the first
    16 bits of the order find the slice in which the prefix ends, and only that slice is
    ranked.

    Returns the columns of ``docs`` (or ``keep`` of them), then domain, leaf_lang,
    leaf_source, epoch (from 0), n_tokens, leaf_tokens, budget, one row for each draw.
    Columns of ``docs`` with these names are replaced. Null lang or source is 'unknown',
    null text has no tokens and comes with any epoch that is taken in part or whole as
    far as the order reaches it. Repeated rows are drawn one by one, in any order among
    equal ones. A leaf of weight 0, or without tokens, is left out.
    """
    made = ("domain", "leaf_lang", "leaf_source", "epoch", "n_tokens", "leaf_tokens", "budget")
    kept = others(keep or docs.columns, made)
    marked = with_leaf(docs.select(*dict.fromkeys([*kept, "doc_id", "text", "lang", "source"])))
    marked = marked.withColumnsRenamed(
        {"_domain": "domain", "_lang": "leaf_lang", "_source": "leaf_source", "_tokens": "n_tokens"}
    )
    leaf = ["domain", "leaf_lang", "leaf_source"]
    # Tokens of whole texts are counted once.
    narrow = materialise(marked.select("doc_id", *leaf, "n_tokens"))
    if set(kept) <= {"doc_id"}:
        marked = narrow
    leaves = (
        narrow.groupBy(*leaf).agg(F.sum("n_tokens").alias("leaf_tokens"))
        .where(F.col("leaf_tokens") > 0)
        .withColumnsRenamed({"leaf_lang": "lang", "leaf_source": "source"})
    )
    shares = materialise(
        allot(materialise(leaves), mix)
        .withColumnsRenamed({"lang": "leaf_lang", "source": "leaf_source"})
        .withColumns(
            {"_epochs": F.expr("budget div leaf_tokens"), "_rest": F.expr("budget % leaf_tokens")}
        )
        .where("budget > 0")
        .withColumn("_last_epoch", F.expr("if(_rest > 0, _epochs, _epochs - 1)"))
    )

    def draws(frame: DataFrame, first: Column) -> DataFrame:
        return (
            lookup(frame, shares, leaf, "inner")
            .where(first <= F.col("_last_epoch"))
            .withColumn("epoch", F.explode(F.sequence(first, F.col("_last_epoch"))))
            .withColumn("_order", _order(F.col("epoch"), mix.seed))
            .withColumn("_slice", F.substring("_order", 1, DIGITS))
        )

    partial = F.col("epoch") == F.col("_epochs")
    slices = (
        draws(narrow, F.col("_epochs")).groupBy(*leaf, "_rest", "_slice").agg(F.sum("n_tokens").alias("_n"))
    )
    running = Window.partitionBy(*leaf).orderBy("_slice")
    cut = materialise(
        slices.withColumn(
            "_start", F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
        )
        .where(F.col("_start") + F.col("_n") > F.col("_rest"))
        .groupBy(*leaf)
        .agg(F.min(F.struct("_slice", "_start")).alias("_cut"))
        .select(*leaf, F.col("_cut._slice").alias("_last"), F.col("_cut._start").alias("_start"))
    )
    placed = lookup(draws(marked, F.lit(0).cast("bigint")), cut, leaf, "left")
    whole = placed.where(~partial | (F.col("_slice") < F.col("_last")))
    # The slice of a leaf in which its prefix ends: one part in 65 536 of the leaf.
    inside = Window.partitionBy(*leaf).orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    ending = (
        placed.where(partial & (F.col("_slice") == F.col("_last")))
        .withColumn("_upto", F.col("_start") + F.sum("n_tokens").over(inside))
        .where(F.col("_upto") <= F.col("_rest"))
        .drop("_upto")
    )
    return whole.unionByName(ending).select(*kept, *made)
