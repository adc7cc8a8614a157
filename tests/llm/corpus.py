"""Small corpora with the awkward rows every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns whose names the operators use inside
CLASHES = "id long, whole string, fp long, shard int, score double, _row string, size long, host string, pieces string"


def sentence(rng: random.Random, n: int) -> str:
    syllables = "an ther ing on st le ma ro ti ve que der ung ción éa".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def awkward() -> list[tuple]:
    rng = random.Random(4)
    long_text = sentence(rng, 9000)
    body = sentence(rng, 120)
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 4), (4, "One", "en", "b", 3),
        (5, "Two words", "en", None, 9), (6, body, "en", "a", len(body)), (7, body, "en", "b", len(body)),
        (8, body + " tail", "en", "a", len(body) + 5), (9, long_text, "de", "a", len(long_text)),
        (10, "x" * 70_000, "en", "c", 70_000), (11, "naïve 😀 façade 日本語 👩‍👩‍👧 \U0001f9ff\n\n  tabs\tand\r\nlines", "fr", "c", 40),
        (None, "an id is missing here", "en", "a", 21), (None, None, None, None, None),
        (12, body, "en", "a", len(body)), (12, body, "en", "a", len(body)),  # a repeated row
        (13, "same id first", "en", "a", 13), (13, "same id second", "en", "b", 14),
        (14, "line one here\nline one here\nline two\n\nline one here", "en", "b", 50),
        (15, "a b c a b c a b c d", "en", "b", 19), (16, "#$%& ** <> |", "en", "c", 12),
    ]
    rows += [(100 + i, sentence(rng, rng.randint(5, 90)), "en", rng.choice("aabcd"), 0) for i in range(60)]
    return rows


def frame(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashes:
        from pyspark.sql import functions as F
        for part in CLASHES.split(", "):
            name, kind = part.split()
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def text_of(row: tuple) -> str:
    return row[1] or ""
