from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names the operators use inside, on the input.
CLASHING = "text_hash STRING, score STRING, toxicity STRING, rest STRING, gone STRING, spans STRING, fp STRING"


def documents(spark: SparkSession, texts: list, ids: list | None = None, langs=None, sources=None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (
            i,
            t,
            "en" if langs is None else langs[k],
            "s" if sources is None else sources[k],
            None if t is None else len(t),
            *["x"] * 7,
        )
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, f"{DOCUMENT}, {CLASHING}")


def words(rng: random.Random, n: int, size: int = 400) -> str:
    """Invented words of one to three syllables."""
    parts = ["ka", "lo", "mi", "ren", "tus", "vel", "or", "an", "ish", "pra"]
    return " ".join("".join(rng.choice(parts) for _ in range(1 + rng.randrange(size) % 3)) for _ in range(n))


ODD_TEXTS = [None, "", " ", "\n\n", "a", "é", "word", "word", "\x00", "▁", "ﬁ　x", "\U0001f600" * 40]


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
