"""Language ID by compression: the language whose dictionary makes a text smallest.

The model is one zstandard raw-content dictionary per language: slices of at most `SLICE_CHARS` characters
from the middle of at most `SAMPLE_ROWS` labelled rows per language, for every language found. Of more than
`LANGUAGES` languages each has fewer rows, one at least. These bounds are parameters; rows are chosen by a
hash of id and text, and repeated rows teach once.

A text is lower-cased, its ASCII characters other than letters become white space, runs of which become one
blank; so it is compressed whole, in blocks of 4 kB that each lean on the dictionary alone, so that a long text
is judged like a short one. The score is 1 - smallest / second smallest; of equal sizes the more frequent
language is named. A narrow margin (score below `MARGIN`) is a rejection, as is a text that is null or holds
no letter (`und`, score 0). With a single learned language the score is 1; with none every text is `und`. Rows with a null language
teach nothing. Each row is judged by itself: repeated rows give repeated results.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SAMPLE_ROWS = 256
SLICE_CHARS = 1000
LANGUAGES = 200
BLOCK = 4096
LEVEL = 6
#: Bytes of the dictionary put before each block, so that a block of few words is not stored as it is.
CARRIER = 64
#: Share by which the second best must be larger.
MARGIN = 0.002
LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(LETTERS_ONLY).split())


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    rows_per_language: int = SAMPLE_ROWS, slice_chars: int = SLICE_CHARS, languages: int = LANGUAGES,
) -> dict[str, bytes]:
    """Dictionary by language, the most frequent first: of `languages` or fewer, `rows_per_language` slices each; of more, as many in all."""
    rows = labelled.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("id", "text"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct("hash").alias("n_distinct"))
    counts = counts.orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return {}
    wanted = min(rows_per_language, max(1, rows_per_language * languages // len(counts)))
    # A hash below this bound leaves about four times the rows wanted of a language, and some of a language of few.
    bounds = {r.lang: int(min(1.0, max(4 * wanted, 64) / max(1, r.n_distinct)) * (1 << 30)) for r in counts}
    bound = F.element_at(F.from_json(F.lit(json.dumps(bounds)), "map<string,bigint>"), F.col("lang"))
    middle = F.greatest(F.lit(1), F.expr(f"cast((length(text) - {slice_chars}) / 2 as int) + 1"))
    picked = rows.withColumn("draw", F.pmod("hash", F.lit(1 << 30))).filter(F.col("draw") < bound)
    picked = picked.select("lang", "draw", "id", F.col("text").substr(middle, F.lit(slice_chars)).alias("slice"))
    picked = picked.filter(F.col("slice").rlike("[A-Za-z[^\\x00-\\x7F]]")).distinct()
    order = Window.partitionBy("lang").orderBy("draw", "id", "slice")
    sample = picked.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= wanted).collect()
    out: dict[str, list[bytes]] = {r.lang: [] for r in counts}
    for r in sorted(sample, key=lambda r: -r.n):
        out[r.lang].append(plain(r.slice))
    return {lang: b"\n".join(slices) for lang, slices in out.items() if any(slices)}


def compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor, bytes]]:
    out = []
    for lang in dictionaries:
        known = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        model = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        out.append((lang, model, dictionaries[lang][-CARRIER:]))
    return out


def judge(text: str | None, models: list[tuple[str, zstandard.ZstdCompressor, bytes]]) -> tuple[str, float]:
    if not models or text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    data = plain(text)
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = sorted((sum(len(m.compress(carrier + b)) for b in blocks), k) for k, (_, m, carrier) in enumerate(models))
    return models[sizes[0][1]][0], 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0


def predictor(dictionaries: dict[str, bytes], docs: DataFrame):
    """A column function text -> (lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models = compressors(shared.value)
        for batch in texts:
            yield pd.DataFrame([judge(t, models) for t in batch], columns=["lang_pred", "score"])

    return predict.asNondeterministic()  # else a filter on its result would run it twice


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: the CRC-32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """`docs` as struct `doc`, with held_out, lang_pred, score and rejected."""
    model = fit(docs.filter(~held_out(id_col)), id_col, text_col, lang_col)
    judged = docs.select(
        F.struct(F.col("*")).alias("doc"),
        held_out(id_col).alias("held_out"),
        predictor(model, docs)(F.col(f"`{text_col}`")).alias("p"),
    )
    return judged.select(
        "doc", "held_out", "p.lang_pred", "p.score",
        ((F.col("p.lang_pred") == "und") | (F.col("p.score") < margin)).alias("rejected"),
    )


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """The rows of `docs` that are not rejected."""
    return identify(docs, id_col, text_col, lang_col, margin).filter("not rejected").select("doc.*")
