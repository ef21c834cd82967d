"""Small documents that hold every case the operators must define, and brute-force helpers."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, key string, raw string, fp long, line string, n_removed long, rules string, row long, spans string, group long"
VOCABULARY = [f"w{k}{'abcdefgh'[k % 8] * (k % 5)}" for k in range(700)]


def prose(seed: int, words: int, lines: int = 1) -> str:
    rng = random.Random(seed)
    return "\n".join(" ".join(rng.choice(VOCABULARY) for _ in range(words)) for _ in range(lines))


def changed(text: str, every: int) -> str:
    """The text with one word in `every` replaced."""
    words = text.split(" ")
    return " ".join("zz" + w if k % every == every - 1 else w for k, w in enumerate(words))


def corpus() -> list[tuple]:
    base = prose(1, 40, 6)
    texts: list[tuple] = [(k, prose(100 + k, 30, 4)) for k in range(10, 30)]
    texts += [(1, base), (2, base), (3, changed(base, 60)), (4, changed(base, 55))]
    texts += [(5, prose(5, 60, 3)), (5, prose(5, 60, 3))]  # repeated rows
    texts += [(None, prose(7, 60)), (8, None), (9, ""), (None, None), (31, " \n\t"), (32, "short words")]
    texts += [(33, prose(33, 2000, 20)), (34, "é" * 500 + " " + prose(34, 50)), (35, "a" * 3000), (36, base[:900] + "\n" + prose(36, 80))]
    texts += [(37, "AbC, Dé  x\r\ny z 𝒳"), (38, (prose(38, 12) + "\n") * 9), (39, prose(1, 40, 6).upper())]
    return [(doc_id, text, "en", "k", "r", 1, "l", 2, "q", 3, "s", 4) for doc_id, text in texts]


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows: list) -> list[tuple]:
    return sorted((tuple(row) for row in rows), key=repr)
