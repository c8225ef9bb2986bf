"""Drift of features against a stored reference profile: population stability index and Kolmogorov-Smirnov distance.

A profile counts the rows of each feature per bin: (feature, edges, bin, n). Bins lie between quantiles of the
reference, the last of each row that ties with an edge below it; bin -1 holds nulls and NaN. Profiles with the same edges are merged by
adding their counts, so a profile of many days or partitions needs no second look at the rows. Building one is a
single scan with map-side combining; it has at most `bins + 1` rows per feature, whatever the table's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 16
#: PSI from which a change is moderate, and major.
MODERATE, MAJOR = 0.1, 0.25
#: Two-sample Kolmogorov-Smirnov coefficient at the five per cent level.
KS_COEFFICIENT = 1.36
#: Normal quantile of the same level, for the noise of the PSI.
NORMAL = 1.645
#: Rows added to every bin, so that an empty one has a share.
SMOOTHING = 0.5
#: Sketch entries of the quantiles: exact for tables up to this size, relative rank error 1 / ACCURACY beyond.
ACCURACY = 10_000


def _value(feature: str) -> Column:
    x = F.col(f"`{feature}`").cast("double")
    return F.when(~F.isnan(x), x)


def quantile_edges(reference: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Distinct inner edges of each feature's bins. One aggregate of mergeable sketches, one small row to the driver."""
    shares = [k / bins for k in range(1, bins)]
    row = reference.agg(*[F.percentile_approx(_value(f), shares, ACCURACY).alias(f"q{k}") for k, f in enumerate(features)]).first()
    return {f: sorted(set(row[k] or [])) for k, f in enumerate(features)}


def profile(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Rows of each feature per bin: bin k holds the values above the first k edges only."""
    def bin_of(feature: str, cuts: list[float]) -> Column:
        x = _value(feature)
        above = reduce(lambda a, b: a + b, [(x > F.lit(e)).cast("int") for e in cuts], F.lit(0))
        return F.when(x.isNull(), -1).otherwise(above)

    cells = [F.struct(F.lit(k).alias("k"), bin_of(f, cuts).alias("bin")) for k, (f, cuts) in enumerate(edges.items())]
    counts = df.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.k", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame([(k, f, cuts) for k, (f, cuts) in enumerate(edges.items())], "k int, feature string, edges array<double>")
    # One row per feature. A feature without rows is profiled with none.
    return names.join(counts, "k", "left").select("feature", "edges", F.coalesce("bin", F.lit(-1)).alias("bin"), F.coalesce("n", F.lit(0)).alias("n"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows that these were made of."""
    together = reduce(DataFrame.unionByName, profiles)
    return together.groupBy("feature", "edges", "bin").agg(F.sum("n").alias("n"))


def drift_report(reference: DataFrame, current: DataFrame) -> DataFrame:
    """One row per feature of the reference: rows, null rates, PSI, KS distance at the edges, and what to make of them.

    Both profiles must have the reference's edges. Between two samples of one distribution the PSI of B bins is about
    chi-squared with B - 1 degrees of freedom times (1/rows + 1/rows); below the five per cent limit of that (`psi_limit`) a
    feature counts as stable, however large the PSI of a few rows may be. A feature has drifted if it is not stable
    or if the KS distance of its non-null values is above the five per cent limit for so many rows. Without rows
    there is no verdict (level `unknown`).
    """
    grid = reference.select("feature", "edges").distinct().select(
        "feature", F.explode(F.sequence(F.lit(-1), F.size("edges"))).alias("bin"))
    side = lambda p, name: p.groupBy("feature", "bin").agg(F.sum("n").alias(name))
    cells = grid.join(side(reference, "a"), ["feature", "bin"], "left").join(side(current, "b"), ["feature", "bin"], "left")
    cells = cells.fillna(0, ["a", "b"])
    valid = lambda c: F.when(F.col("bin") >= 0, F.col(c)).otherwise(0)
    whole = Window.partitionBy("feature")  # at most bins + 1 rows
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = lambda c: (F.col(c) + SMOOTHING) / (F.sum(c).over(whole) + SMOOTHING * F.count(F.lit(1)).over(whole))
    below = lambda c: F.sum(valid(c)).over(upto) / F.when(F.sum(valid(c)).over(whole) > 0, F.sum(valid(c)).over(whole))
    cells = cells.select("feature", "bin", "a", "b", share("a").alias("p"), share("b").alias("q"), F.abs(below("a") - below("b")).alias("gap"))
    report = cells.groupBy("feature").agg(
        F.sum("a").alias("reference_rows"), F.sum("b").alias("current_rows"),
        F.sum(F.when(F.col("bin") < 0, F.col("a"))).alias("_null_a"), F.sum(F.when(F.col("bin") < 0, F.col("b"))).alias("_null_b"),
        F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"), F.max("gap").alias("ks"), (F.count(F.lit(1)) - 1).alias("_free"))
    a, b = F.col("reference_rows") - F.col("_null_a"), F.col("current_rows") - F.col("_null_b")
    rate = lambda n, d: F.col(n) / F.when(F.col(d) > 0, F.col(d))
    known = (F.col("reference_rows") > 0) & (F.col("current_rows") > 0)
    spread = F.lit(2.0) / (9 * F.col("_free"))
    chi = F.col("_free") * F.pow(1 - spread + NORMAL * F.sqrt(spread), F.lit(3.0))
    noise = chi * (F.lit(1.0) / F.col("reference_rows") + F.lit(1.0) / F.col("current_rows"))
    report = report.withColumns({
        "ks_limit": F.when((a > 0) & (b > 0), KS_COEFFICIENT * F.sqrt((a + b) / (a * b))), "psi_limit": F.when(known, noise)})
    moved = F.col("psi") > F.col("psi_limit")
    level = F.when(~known, "unknown").when(moved & (F.col("psi") >= MAJOR), "major").when(moved & (F.col("psi") >= MODERATE), "moderate").otherwise("stable")
    far = F.coalesce(F.col("ks") > F.col("ks_limit"), F.lit(False))
    return report.select(
        "feature", "reference_rows", "current_rows", rate("_null_a", "reference_rows").alias("reference_null_rate"),
        rate("_null_b", "current_rows").alias("current_null_rate"), F.when(known, F.col("psi")).alias("psi"), "psi_limit", "ks", "ks_limit",
        level.alias("level"), F.when(known, (level != "stable") | far).alias("drifted"))
