"""Mixing sources to target weights: token budgets flow down a tree, documents are taken by epochs.

The tree's levels are columns (domain, language, source); a null value is a node of its own. A budget is
given to the root. At every node it is shared among the children by weight; a child that cannot use its
share (its leaves hold too few tokens, even over all allowed epochs) gets what it can use, and its siblings
take up the rest by weight. Only what all children together cannot use stays with the parent's siblings.

A leaf then takes whole epochs of its documents, and of the next epoch the documents whose running token
count stays within the rest. Each epoch has an order of its own: the MD5 of seed, epoch and id. Null ids and
repeated rows come in the order of their text's hash. A null text has no tokens. An empty table gives an
empty result.

No leaf is ever in one task: its rows are spread over 4,096 bins by the first digits of the MD5.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import bin_offsets, keep_rows
from saldo.session import materialize


def weight_of(level: str, weights: Mapping[str, float]) -> Column:
    """Weights of a level's values; a value not named weighs 1."""
    out = F.lit(1.0)
    for value, weight in weights.items():
        out = F.when(F.col(level) == value, float(weight)).otherwise(out)
    return out


def share(nodes: DataFrame, parent: Sequence[str], level: str, weights: Mapping[str, float]) -> DataFrame:
    """Adds `given`: what each child gets of its parent's `budget`, at most its `room`."""
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = siblings.orderBy(F.col("room") / F.col("w"), level)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    after = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("w", weight_of(level, weights)).filter("w > 0")
    nodes = nodes.withColumn(
        "rate", (F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0))) / F.sum("w").over(after)
    )
    open_rate = F.when(F.col("room") / F.col("w") > F.col("rate"), F.col("rate"))
    nodes = nodes.withColumn("rate", F.max(open_rate).over(siblings))
    given = F.when(F.col("rate").isNull(), F.col("room").cast("double")).otherwise(
        F.least(F.col("room").cast("double"), F.col("w") * F.col("rate"))
    )
    return nodes.withColumn("given", given).drop("w", "rate")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], share_of_supply: float, epochs: int
) -> DataFrame:
    """`leaves` (levels, supply) with `budget`, whole tokens. It has one row per leaf that no weight of 0 shuts.

    The root's budget is a share of all leaves; a shut leaf gives no room to any node above it.
    """
    given = leaves.agg(F.floor(F.sum("supply") * share_of_supply).cast("double").alias("budget"))
    leaves = leaves.filter(reduce(and_, (weight_of(level, weights.get(level, {})) > 0 for level in levels)))
    leaves = leaves.withColumn("room", F.col("supply") * epochs)
    for k, level in enumerate(levels, 1):
        path, parent = list(levels[:k]), list(levels[: k - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("room").alias("room"))
        nodes = nodes.join(given, parent) if parent else nodes.crossJoin(F.broadcast(given))  # one row
        given = share(nodes, parent, level, weights.get(level, {})).select(*path, F.col("given").alias("budget"))
    return leaves.drop("room").join(given, list(levels)).withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("bigint"))


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, float]],
    share_of_supply: float = 0.5,
    epochs: int = 4,
    seed: str = "mix",
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, levels, tokens, leaf_budget, copies (how often it is taken; 0: not).

    Also text_hash, which tells rows of the same id apart. Nodes of weight 0 take nothing.
    """
    names = list(levels)
    tokens = F.ceil(F.octet_length(F.col(f"`{text_col}`")) / 4) if tokens is None else tokens
    rows = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
            F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"),
            *(F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in levels.items()),
        ),
        "leaves",
    )
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("supply"))
    budgets = materialize(leaf_budgets(leaves, names, weights, share_of_supply, epochs), "budgets")
    budgets = budgets.withColumn("whole", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(0)).withColumn(
        "rest", F.col("budget") - F.col("whole") * F.col("supply")
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = rows.join(budgets, names, "left").withColumn("key", key)
    rows = rows.withColumns({"coarse": F.substring("key", 1, 1), "fine": F.substring("key", 2, 2)})
    bins = rows.groupBy(*names, "coarse", "fine").agg(F.sum("tokens").alias("bin_tokens"))
    bins = bin_offsets(bins, names, "coarse", "fine", "bin_tokens", "before").drop("bin_tokens")
    bin_ = [*names, "coarse", "fine"]
    upto = Window.partitionBy(*bin_).orderBy("key", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("cum", F.sum("tokens").over(upto)).join(bins, bin_)
    partly = (F.col("rest") > 0) & (F.col("before") + F.col("cum") <= F.col("rest"))
    return rows.select(
        F.col("id").alias(id_col),
        *names,
        "tokens",
        F.coalesce("budget", F.lit(0)).alias("leaf_budget"),
        F.coalesce(F.col("whole") + partly.cast("bigint"), F.lit(0)).alias("copies"),
        "text_hash",
    )


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `mix` takes at least once."""
    chosen = mixed.filter("copies > 0").select(F.col(id_col).alias("id"), "text_hash").distinct()
    return keep_rows(docs, chosen, id_col, text_col)
