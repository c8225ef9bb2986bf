"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm import (
    byte_pairs, exact_dedup, language_id, mixing, oph, packing, periodic_runs, ranked_search, secret_scan, sharding, simhash,
    suffix_dedup, token_counts,
)
from saldo.llm.common import SPACE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The queries that read the documents only, as functions of them.
ON_DOCUMENTS: dict[str, Callable[[DataFrame], DataFrame]] = {}

#: Tree and target weights of the mix. Values that are not named weigh 1.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {"domain": {"domain0": 2.0, "domain1": 1.5}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 3, "mix-1"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(name: str):
    def register(fn):
        ON_DOCUMENTS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(documents(spark, sf_dir))
        return fn
    return register


def mix_levels():
    """A source's domain is its number modulo 4, as the documents carry no domain of their own."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint)"), F.lit(0))
    return {"domain": F.concat(F.lit("domain"), F.pmod(number, F.lit(4)).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


@query("op1_exact_dedup")
def _(docs):
    return exact_dedup.mark_duplicates(docs)


@query("op2_simhash")
def _(docs):
    found = simhash.near_duplicates(docs, simhash.SHINGLE)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_sharding")
def _(docs):
    return sharding.shard(docs, shards=8)


@query("op4_fingerprints")
def _(docs):
    return oph.with_edits(docs)


@query("op5_token_counts")
def _(docs):
    return token_counts.count_tokens(docs, limit=512)


@query("op6_suffix_dedup")
def _(docs):
    cut = suffix_dedup.remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.end - s.start)
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_mixing")
def _(docs):
    return mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED).drop("text_hash")


@query("op8_language_id")
def _(docs):
    judged = language_id.identify(docs)
    return judged.select(F.col("doc.doc_id").alias("doc_id"), "held_out", "lang_pred", "score", "rejected")


@query("op9_secret_scan")
def _(docs):
    found = secret_scan.scan(docs)

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    base = F.filter("secrets", lambda s: s.kind.isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *(count(k) for k in secret_scan.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )


@query("op10_packing")
def _(docs):
    return packing.pack(docs, packing.CAPACITY)


def planted_runs(docs: DataFrame) -> DataFrame:
    """id and text; in documents whose hashed id ends in 0, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", SPACE), lambda w: w != ""))
    rows = docs.select("doc_id", "text", F.floor(h / 10).cast("bigint").alias("g"), words.alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("bigint"))
    edited = F.col("n") > 0  # neither other documents nor those without words
    rows = rows.withColumn("a", F.when(edited, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.when(edited, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))

    def original(w, i):
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    return rows.select("doc_id", F.when(edited, F.concat_ws(" ", F.transform("words", original))).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def _(docs):
    found = periodic_runs.find_runs(planted_runs(docs)).withColumn("best", periodic_runs.most_repeated(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_byte_pairs")
def _(docs):
    return byte_pairs.round_trip(docs).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES["op13_ranked_search"] = op13
