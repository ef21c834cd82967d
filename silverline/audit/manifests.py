"""Manifest rows and summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.numbers import guarded_ratio, percent
from silverline.operators.joins import pair_results


def iso(moment: dt.datetime) -> str:
    return moment.isoformat(timespec="milliseconds") + "Z"


def run_status() -> list[Column]:
    """Counters over results with `success` and `skipped` flags."""
    ok, skipped = F.coalesce(F.col("success"), F.lit(False)), F.coalesce(F.col("skipped"), F.lit(False))
    return [
        F.count("*").alias("datasets_processed"),
        F.count_if(ok & ~skipped).alias("successful"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(~ok).alias("failed"),
    ]


def status_rollup(results: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """How many results succeeded, were skipped or failed, and the success rate in percent."""
    rolled = results.groupBy(*groups).agg(*run_status())
    passed = F.col("datasets_processed") - F.col("failed")
    return rolled.withColumn("success_rate", percent(passed, F.col("datasets_processed")))


def batch_summary(results: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    """One row per batch: counters and the results themselves.

    A batch holds one result per dataset, so the list stays short. Nothing is returned for a batch
    in which everything was skipped.
    """
    record = F.struct(*[F.col(f"`{name}`") for name in results.columns])
    summary = results.agg(*run_status(), F.collect_list(record).alias("results"))
    head = summary.select(F.lit(run_id).alias("run_id"), F.lit(iso(at)).alias("timestamp"), "*")
    return head.where((F.col("successful") > 0) | (F.col("failed") > 0))


def silver_manifest(
    bronze_rows: Column, silver_rows: Column, fields: dict[str, Column]
) -> list[Column]:
    """Columns of a silver manifest: identification, counts, filtered rows and their share."""
    filtered = bronze_rows - silver_rows
    return [
        *[value.alias(name) for name, value in fields.items()],
        bronze_rows.alias("bronze_rows"),
        silver_rows.alias("silver_rows"),
        filtered.alias("filtered_rows"),
        F.round(guarded_ratio(filtered, bronze_rows) * 100, 1).alias("filter_rate"),
    ]


def total_records(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records per run, summed over its files."""
    each = runs.select(*keys, F.explode_outer("files").alias("file"))
    return each.groupBy(*keys).agg(
        F.coalesce(F.sum("file.records"), F.lit(0)).alias("total_records"),
        F.count("file").alias("files"),
    )


def run_manifest(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Nested run manifests from run rows and file rows (both keyed by `run_id`).

    A run lists a handful of files.
    """
    listing = files.groupBy("run_id").agg(
        F.sort_array(F.collect_list(F.struct("name", "size_bytes", "kind", "records", "partial"))).alias("files")
    )
    duration = (F.col("end_time").cast("double") - F.col("start_time").cast("double")) * 1000
    return runs.join(listing, "run_id", "left").select(
        F.lit("1.0").alias("schema_version"),
        F.struct(
            F.col("run_id").alias("id"), "dataset", "label", "start_time", "end_time",
            F.round(duration).cast("long").alias("duration_ms"), "status", "error",
        ).alias("run"),
        F.struct("start_date", "end_date", "filter").alias("parameters"),
        F.coalesce("files", F.array().cast(listing.schema["files"].dataType)).alias("files"),
    )


def attach_validation(manifests: DataFrame, outcome: DataFrame, key: str = "dataset") -> DataFrame:
    """Add the outcome of a validation as a struct; manifests without one keep NULL."""
    rest = [name for name in outcome.columns if name != key]
    return manifests.join(outcome.select(key, F.struct(*rest).alias("validation")), key, "left")


def orchestration_audit(
    tasks: DataFrame, results: DataFrame, on: Sequence[str] = ("dataset", "kind", "label")
) -> DataFrame:
    """One row per task with its result, in task order."""
    return pair_results(tasks, results, on)


def orchestration_summary(audit: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Counters over paired tasks."""
    return audit.groupBy(*groups).agg(
        F.count("*").alias("tasks_total"),
        F.count_if(F.col("result.ok")).alias("tasks_succeeded"),
        F.count_if(~F.col("result.ok")).alias("tasks_failed"),
        F.count_if(F.col("result.skipped")).alias("tasks_skipped"),
    )


def reconcile(ours: Column, external: Column) -> dict[str, Column]:
    """Difference of two counts and the share captured, in percent."""
    return {
        "difference": external - ours,
        "percent_captured": percent(ours, external),
        "verdict": F.when(external > ours, "missing").when(external < ours, "extra").otherwise("match"),
    }


def consolidation_report(stats: DataFrame, external: int, at: dt.datetime) -> DataFrame:
    """Consolidation counters next to an external count."""
    return stats.withColumns(
        {
            "timestamp": F.lit(iso(at)),
            "external_count": F.lit(external).cast("long"),
            **reconcile(F.col("final_rows"), F.lit(external).cast("long")),
        }
    )
