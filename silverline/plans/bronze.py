"""Bronze ingestion: files land unchanged, with metadata, once per content."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.audit.ids import deterministic_run_id
from silverline.functions.text import row_hash
from silverline.operators.joins import members, not_in
from silverline.operators.keyed import latest_per_key, oldest_first
from silverline.operators.positions import with_positions, with_source_row
from silverline.plans.consolidation import AGE, consolidate, consolidated_order
from silverline.session import ensure_checkpointing, path_exists, remove_path
from silverline.sources.files import content_hashes, list_files, plain_path
from silverline.sources.readers import read_bronze, read_csv_registry, read_each
from silverline.sources.registry import FileSchema, schema_for
from silverline.sources.writers import write_bronze, write_manifest

MANIFEST = (
    "dataset string, source_file string, source_file_hash string, source_file_bytes bigint, row_count bigint, "
    "unique_rows bigint, run_id string, ingested_at string, schema_version string"
)


# Files that one job reads.
GROUP_FILES = 5_000


@dataclass(frozen=True)
class IngestRun:
    """Settings of one ingestion."""

    event_time: dt.datetime
    source_system: str = "export"
    code_version: str = "unknown"
    schema_version: str = "v0.1.0"
    row_hash_mode: str = "row"
    multiline: bool | None = None

    @property
    def ingest_date(self) -> str:
        return self.event_time.date().isoformat()

    @property
    def stamp(self) -> str:
        return self.event_time.isoformat(timespec="milliseconds") + "Z"


def bronze_metadata(
    columns: Sequence[str], run: IngestRun, file: Column, file_hash: Column, file_bytes: Column
) -> dict[str, Column]:
    """The metadata columns, apart from `source_row`."""
    return {
        "source_system": F.lit(run.source_system),
        "source_file": file,
        "source_file_hash": file_hash,
        "source_file_bytes": file_bytes.cast("long"),
        "ingested_at": F.lit(run.event_time.isoformat(sep=" ")).cast("timestamp"),
        "bronze_run_id": deterministic_run_id(F.lit(run.stamp), F.concat(file, file_hash), F.lit(run.code_version)),
        "row_hash": row_hash(columns, run.row_hash_mode),
        "ingest_date": F.lit(run.ingest_date),
        "sha256": file_hash,
    }


def manifest_path(root: str, dataset: str) -> str:
    return f"{root}/_manifests/{dataset}"


def bronze_manifests(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The committed contents of a dataset; empty before the first ingestion."""
    path = manifest_path(root, dataset)
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path)


def known_hashes(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Hashes of the contents that bronze holds whole: those with a manifest."""
    return bronze_manifests(spark, root, dataset).select(F.col("source_file_hash").alias("sha256")).distinct()


def drop_uncommitted(spark: SparkSession, root: str, dataset: str, contents: DataFrame) -> None:
    """Remove what an interrupted ingestion left of the given contents, on whatever date it ran."""
    base = f"{root}/{dataset}"
    if not path_exists(spark, base):
        return
    at = list_files(spark, base, "*.parquet").select(
        F.regexp_extract("path", "^(.*/sha256=[0-9a-f]{64})/", 1).alias("folder"), F.regexp_extract("path", "sha256=([0-9a-f]{64})", 1).alias("sha256")
    )
    # Usually none: one folder for each content of a run that broke off.
    for row in members(at, contents, ["sha256"]).select("folder").distinct().toLocalIterator():
        remove_path(spark, row["folder"])


def commit(spark: SparkSession, root: str, dataset: str, contents: DataFrame, run: IngestRun) -> DataFrame:
    """Write the manifests of contents just landed, once their rows are seen to be complete.

    Rows are numbered from 1 in each content, so a row that is missing or there twice shows in the
    numbers. `contents` has sha256, source_file and source_file_bytes; a content without rows counts.
    """
    landed = bronze_stats(spark, root, dataset, contents)
    rows = contents.join(landed, "sha256", "left").select(
        F.lit(dataset).alias("dataset"),
        "source_file",
        F.col("sha256").alias("source_file_hash"),
        "source_file_bytes",
        F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
        F.coalesce("unique_rows", F.lit(0)).cast("long").alias("unique_rows"),
        "run_id",
        F.lit(run.stamp).alias("ingested_at"),
        F.lit(run.schema_version).alias("schema_version"),
        (F.coalesce("row_count", F.lit(0)) != F.coalesce("last_row", F.lit(0))).alias("_holes"),
    )
    ensure_checkpointing(spark)
    rows = rows.checkpoint()
    broken = rows.where("_holes").select("source_file").first()
    if broken:
        raise RuntimeError(f"not all rows of {broken['source_file']} have landed; it stays uncommitted")
    write_manifest(rows.drop("_holes"), manifest_path(root, dataset))
    return rows.drop("_holes")


def new_files(hashes: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose content is not in bronze, one per content."""
    return latest_per_key(not_in(hashes, known, ["sha256"]), ["sha256"], oldest_first(["path"]))


def bronze_rows(
    spark: SparkSession, files: DataFrame, paths: Sequence[str], schema: FileSchema, run: IngestRun
) -> DataFrame:
    """The rows of the given files with their bronze metadata. The files are a group of bounded size, so their list is sent round."""
    numbered = read_each(
        spark, list(paths), schema, run.multiline, lambda part, whole: with_source_row(read_csv_registry(spark, part, schema, whole))
    )
    keyed = files.select(plain_path(F.col("path")).alias("_at"), "sha256", "source_file_bytes")
    joined = numbered.withColumn("_at", plain_path(F.col("_source_path"))).join(F.broadcast(keyed), "_at")
    metadata = bronze_metadata(schema.columns, run, F.col("_at"), F.col("sha256"), F.col("source_file_bytes"))
    return joined.withColumns(metadata).drop("_at", "_source_path", "_modified")


def _groups(spark: SparkSession, fresh: DataFrame, size: int) -> Iterator[tuple[list[str], DataFrame]]:
    """The files in groups of bounded size, each with its names; names come one after another, not all at once."""
    names = (row[0] for row in fresh.select("path").toLocalIterator())
    group, first = list(islice(names, size)), True
    while group:
        ahead = list(islice(names, size))
        if first and not ahead:
            yield group, fresh
        else:
            yield group, members(fresh, spark.createDataFrame([(name,) for name in group], "path string"), ["path"])
        group, first = ahead, False


def ingest_files(
    spark: SparkSession, source: str | Sequence[str], dataset: str, root: str, run: IngestRun, glob: str = "*.csv"
) -> DataFrame:
    """Ingest every file not yet committed to bronze. Returns one manifest row per file, new or skipped.

    Files are hashed once and land in groups of bounded size. A content is known when its manifest is
    written, which comes last: rows of a run that broke off are replaced. One ingestion of a dataset runs at a time.
    """
    schema = schema_for(dataset, run.schema_version)
    ensure_checkpointing(spark)
    hashes = content_hashes(spark, source, glob).checkpoint()
    fresh = new_files(hashes, known_hashes(spark, root, dataset)).checkpoint()
    added = spark.createDataFrame([], MANIFEST)
    # The reader needs names.
    for paths, group in _groups(spark, fresh, GROUP_FILES):
        drop_uncommitted(spark, root, dataset, group)
        write_bronze(bronze_rows(spark, group, paths, schema, run), root, dataset)
        added = added.unionByName(commit(spark, root, dataset, group.withColumn("source_file", plain_path(F.col("path"))), run))
    done = added.select(F.col("source_file").alias("_at"), "row_count", "unique_rows", "run_id", F.lit(True).alias("_new"))
    return (
        hashes.withColumn("_at", plain_path(F.col("path")))
        .join(done, "_at", "left")
        .select(
            F.lit(dataset).alias("dataset"),
            F.col("_at").alias("source_file"),
            F.col("sha256").alias("source_file_hash"),
            "source_file_bytes",
            "row_count",
            "unique_rows",
            "run_id",
            F.lit(run.stamp).alias("ingested_at"),
            F.lit(run.schema_version).alias("schema_version"),
            F.col("_new").isNull().alias("skipped"),
        )
    )


def ingest_consolidated(rows: DataFrame, allowances: DataFrame, dataset: str, root: str, run: IngestRun) -> DataFrame:
    """Consolidate purchase order exports, put them in order, and land them as one bronze content."""
    schema = schema_for(dataset, run.schema_version)
    spark = rows.sparkSession
    names = [F.col(f"`{name}`") for name in schema.columns]
    # The age of a row settles ties, which also lets a much repeated record be sorted by many tasks.
    kept = consolidate(rows, allowances).select(*names, *AGE[:-1], F.col(AGE[-1]).alias("_export_row"))
    order = [*consolidated_order(), *oldest_first([*AGE[:-1], "_export_row"])]
    placed = with_positions(kept, order, "source_row").select(*names, "source_row")
    digest = content_digest(placed, schema.columns).first()
    listed = spark.createDataFrame(
        [(digest["content_hash"], "consolidated", digest["content_bytes"])], "sha256 string, source_file string, source_file_bytes bigint"
    )
    skipped = not members(known_hashes(spark, root, dataset), listed, ["sha256"]).isEmpty()
    if not skipped:
        metadata = bronze_metadata(
            schema.columns, run, F.lit("consolidated"), F.lit(digest["content_hash"]), F.lit(digest["content_bytes"])
        )
        drop_uncommitted(spark, root, dataset, listed)
        write_bronze(placed.withColumns(metadata), root, dataset)
        commit(spark, root, dataset, listed, run)
    return bronze_stats(spark, root, dataset, listed).drop("last_row").withColumn("skipped", F.lit(skipped))


def content_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a hash of the rows as a set, and their size in bytes.

    Row hashes are added up piece by piece, so the result does not depend on the order of the rows
    and every task contributes a few numbers only.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("\\N")) for name in columns])
    hashed = df.select(F.sha2(text, 256).alias("h"), F.octet_length(text).alias("b"))
    pieces = [
        F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)
    ]
    return hashed.agg(
        F.sha2(F.concat_ws(":", F.count("*").cast("string"), *pieces), 256).alias("content_hash"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("content_bytes"),
    )


def bronze_stats(spark: SparkSession, root: str, dataset: str, contents: DataFrame) -> DataFrame:
    """What was written for the given contents: rows, distinct row hashes, last row number, run, first and last ingestion.

    The join prunes partitions at run time, so only those of these contents are read. Contents come in
    groups of bounded size; their list is sent round, so that the rows of one content are not gathered.
    """
    if not path_exists(spark, f"{root}/{dataset}"):
        empty = "sha256 string, row_count bigint, unique_rows bigint, last_row bigint, run_id string, min_ingest timestamp, max_ingest timestamp"
        return spark.createDataFrame([], empty)
    return write_back_stats(members(read_bronze(spark, root, dataset), F.broadcast(contents), ["sha256"]))


def write_back_stats(rows: DataFrame, group: str = "sha256") -> DataFrame:
    """Row statistics per content. All but the distinct hashes is combined before it moves; texts are keys only, so that nothing is sorted."""
    per_run = rows.groupBy(group, F.col("bronze_run_id").alias("run_id")).agg(
        F.count("*").alias("row_count"),
        F.max("source_row").alias("last_row"),
        F.min("ingested_at").alias("min_ingest"),
        F.max("ingested_at").alias("max_ingest"),
    )
    hashes = rows.select(group, "row_hash").distinct().groupBy(group).agg(F.count("row_hash").alias("unique_rows"))
    return (
        per_run.unionByName(hashes, allowMissingColumns=True)
        .groupBy(group)
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("unique_rows").alias("unique_rows"),
            F.max("last_row").alias("last_row"),
            F.min("run_id").alias("run_id"),
            F.min("min_ingest").alias("min_ingest"),
            F.max("max_ingest").alias("max_ingest"),
        )
    )
