"""The corpus pipeline: stages over documents, each stored and read again as the next one's input.

NULL texts count as empty, so the quality rules reject them; NULL ids stay. Rows repeated whole are one
document from the near-duplicate stage on. Columns other than doc_id and text are carried along under
any names, n_chars follows the text. An empty table passes every stage empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import decontamination, line_runs, near_text, packing, quality
from silverline.llm.common import table, under_plain_names
from silverline.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; every document stays, n_chars follows its text."""

    def work(plain: DataFrame) -> DataFrame:
        return line_runs.with_length(line_runs.drop_repeated_lines(plain)).select(*plain.columns)

    return under_plain_names(docs, work, ("doc_id", "text", "n_chars"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_text.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequences."""
    return packing.pack(docs, packing.public_packing())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# SQL has neither zstandard nor the tokenizer, so the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return kept
        path = scratch_path(spark, f"stage-{name}")
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
