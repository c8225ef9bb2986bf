"""Connected components of links that may be as many as the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import materialize


def star(links: DataFrame, small: bool) -> DataFrame:
    """One star step: a node's neighbours (large: the larger ones; small: the others) hang on its least neighbour."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.join(least, "u")
    if small:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (u, v): the label is the least node of its component.

    Large and small stars take turns until nothing changes; each round is written, which cuts the lineage.
    """
    links = materialize(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    while True:
        state = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = state
        links = materialize(star(star(links, small=False), small=True), "links")
