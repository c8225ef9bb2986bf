import random

import pytest

#: Columns whose names the operators use themselves.
CLASHING = [
    "id", "doc", "digest", "row", "win", "n", "d", "e", "h", "key", "fp", "label", "rank", "spans", "kept", "size", "text_hash",
    "piece", "hash",
]


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns whose names clash."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", len(r[1] or ""), *range(len(CLASHING))) for r in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` int" for c in CLASHING)
        return spark.createDataFrame(full, schema).repartition(3)

    return make


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))
