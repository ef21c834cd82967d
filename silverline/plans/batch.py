"""Batch ingestion: all datasets of a run, their manifests, and then the batch's own."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.audit.manifests import batch_summary, iso
from silverline.plans.bronze import IngestRun, bronze_manifests, ingest_files
from silverline.session import path_exists, remove_path
from silverline.sources.writers import write_manifest

RESULT = "dataset string, success boolean, skipped boolean, files bigint, new_files bigint, row_count bigint, error string"
BATCH = (
    f"run_id string, timestamp string, datasets_processed bigint, successful bigint, skipped bigint, failed bigint, "
    f"results array<struct<{', '.join(field.strip().replace(' ', ': ', 1) for field in RESULT.split(','))}>>"
)
STARTED = "run_id string, timestamp string, datasets array<string>"


@dataclass(frozen=True)
class Export:
    """Where the files of a dataset lie."""

    dataset: str
    source: str
    glob: str = "*.csv"


def _starts(root: str) -> str:
    return f"{root}/_manifests/_batches_started"


def _batches(root: str) -> str:
    return f"{root}/_manifests/_batches"


def batch_manifests(spark: SparkSession, root: str) -> DataFrame:
    """The batches that ended, one row each; empty before the first."""
    path = _batches(root)
    return spark.read.schema(BATCH).json(path) if path_exists(spark, path) else spark.createDataFrame([], BATCH)


def unfinished_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batches that started and did not come to their end: (run_id, timestamp, datasets)."""
    path = _starts(root)
    if not path_exists(spark, path):
        return spark.createDataFrame([], STARTED)
    return spark.read.schema(STARTED).option("recursiveFileLookup", True).json(path)


def ingest_batch(spark: SparkSession, exports: Sequence[Export], root: str, run: IngestRun, batch_id: str) -> DataFrame:
    """Ingest every dataset and write the batch manifest; returns the results, one row per dataset.

    A dataset commits its own contents, so a dataset that fails takes nothing from the others: its
    result says why. The batch is marked as started until it ends. One that broke off is found by
    `unfinished_batches` and run again under its id: what it had committed is skipped, the rest is
    ingested. A batch in which everything was skipped leaves no manifest.
    """
    started = f"{_starts(root)}/{batch_id}"
    remove_path(spark, started)
    write_manifest(spark.createDataFrame([(batch_id, iso(run.event_time), [e.dataset for e in exports])], STARTED), started)
    results = [_result(spark, export, root, run) for export in exports]
    rows = spark.createDataFrame(results, RESULT)
    summary = batch_summary(rows, batch_id, run.event_time)
    if not summary.isEmpty() and batch_manifests(spark, root).where(F.col("run_id") == batch_id).isEmpty():
        write_manifest(summary, _batches(root))
    remove_path(spark, started)
    return rows


def _result(spark: SparkSession, export: Export, root: str, run: IngestRun) -> tuple:
    """What a dataset of the batch did. New is what carries the batch's time, whichever attempt landed it."""
    try:
        files = ingest_files(spark, export.source, export.dataset, root, run, export.glob).count()
        landed = bronze_manifests(spark, root, export.dataset).where(F.col("ingested_at") == run.stamp)
        new, rows = landed.agg(F.count("*"), F.coalesce(F.sum("row_count"), F.lit(0))).first()
        return export.dataset, True, new == 0, files, new, rows, None
    except (PySparkException, Py4JJavaError, KeyError, RuntimeError) as problem:
        return export.dataset, False, False, 0, 0, 0, str(problem)[:1000]
