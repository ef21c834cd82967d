"""Building a silver snapshot once per bronze state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.audit.ids import state_of
from silverline.audit.manifests import iso, silver_manifest
from silverline.plans.silver import SilverRun, find
from silverline.session import path_exists
from silverline.sources.files import list_files
from silverline.sources.readers import latest_partition, read_bronze
from silverline.sources.writers import write_manifest, write_silver_snapshot

MANIFEST = (
    "dataset string, snapshot_id string, transform_version string, bronze_state_hash string, bronze_files bigint, "
    "created_at string, silver_path string, bronze_rows bigint, silver_rows bigint, filtered_rows bigint, filter_rate double"
)


def built_states(spark: SparkSession, audit_path: str) -> DataFrame:
    """Manifests of earlier builds; empty before the first."""
    if not path_exists(spark, audit_path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(audit_path)


def build_silver(
    spark: SparkSession,
    dataset: str,
    bronze_root: str,
    silver_root: str,
    run: SilverRun,
    version: str | None = None,
    variant: str | None = None,
    bronze: str = "all",
    sort: bool = False,
) -> DataFrame:
    """Transform a dataset's bronze data, unless this state and version were built before.

    `bronze` is `all` (every file) or `latest` (the newest content only). Returns the manifest row,
    with `skipped` telling whether an earlier build was found.
    """
    transform = find(dataset, version, variant)
    rows = read_bronze(spark, bronze_root, dataset)
    # What is there is listed, not read: the state is made of file names.
    files = list_files(spark, f"{bronze_root}/{dataset}", "*.parquet").select("path")
    if bronze == "latest":
        parts = {name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1) for name in ("ingest_date", "sha256")}
        newest = files.agg(F.max(F.struct(*[part.alias(name) for name, part in parts.items()])).alias("p")).first()["p"]
        rows = latest_partition(rows, newest=newest)
        for name, part in parts.items():
            files = files.where(part == (newest[name] if newest else ""))
    elif bronze != "all":
        raise ValueError(f"unknown bronze selection: {bronze}")
    audit_path = f"{silver_root}/_manifests/{dataset}"
    state = state_of(files, transform.version).first()
    same = (F.col("bronze_state_hash") == state["bronze_state_hash"]) & (
        F.col("transform_version") == transform.version
    )
    earlier = built_states(spark, audit_path).where(same)
    if not earlier.isEmpty():
        return earlier.withColumn("skipped", F.lit(True))

    order = transform.sort_columns() if sort else None
    silver = transform(rows, run)
    path = write_silver_snapshot(silver, silver_root, dataset, transform.version, run.snapshot_id, order)
    written = f"{path}/version={transform.version}/snapshot={run.snapshot_id}"
    fields = {
        "dataset": F.lit(dataset),
        "snapshot_id": F.lit(run.snapshot_id),
        "transform_version": F.lit(transform.version),
        "bronze_state_hash": F.lit(state["bronze_state_hash"]),
        "bronze_files": F.lit(state["bronze_files"]).cast("long"),
        "created_at": F.lit(iso(run.processed_at)),
        "silver_path": F.lit(written),
    }
    # Both counts come from Parquet footers. Counting inside the writing job would count rows again
    # when a task is repeated or the data is sampled for sorting.
    kept = spark.read.schema(silver.schema).parquet(written).count()
    counts = F.lit(rows.count()).cast("long"), F.lit(kept).cast("long")
    manifest = spark.range(1).select(*silver_manifest(*counts, fields))
    write_manifest(manifest, audit_path)
    return manifest.withColumn("skipped", F.lit(False))
