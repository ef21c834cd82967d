"""Files as rows: discovery, content hashes, inventories."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators.joins import members
from silverline.sources.readers import path_fields, read_csv_tolerant, read_each
from silverline.sources.registry import FileSchema


# Files up to this size are hashed in memory; larger ones in pieces.
WHOLE_BYTES = 256 << 20
PIECE_BYTES = 8 << 20


def list_files(spark: SparkSession, root: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Path, modification time and size of every file below a folder. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "modificationTime", "length")
    )
    return files.withColumns(path_fields(F.col("path"), F.col("modificationTime")))


def discover_files(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Data files of successful runs: those in a `files/` folder whose run manifest says so."""
    folder = r"^(.*)/run_([^/]+)/"
    good = manifests.where(F.col("run.status") == "success").select(
        F.regexp_extract("manifest_path", folder, 2).alias("run_id")
    )
    return members(files.where(F.contains("path", F.lit("/files/"))), good.distinct(), ["run_id"])


def content_hashes(spark: SparkSession, paths: str | Sequence[str], glob: str = "*", whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """sha256, size and modification time of every file with content, whatever its size.

    Files of up to `whole_bytes` are hashed by the engine, in memory. Larger ones are read in pieces by
    the task that hashes them, which needs a file system that Arrow can open; on others every file is
    hashed in memory, which Spark bounds at 2 GiB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(paths)
    names = ["path", "sha256", "source_file_bytes", "modificationTime"]
    sized = files.withColumn("source_file_bytes", F.col("length"))
    large = sized.where(F.col("length") > whole_bytes).select("path", "source_file_bytes", "modificationTime")
    sample = large.first()
    if sample is None or not _arrow_path(sample["path"]):
        return sized.select("path", F.sha2("content", 256).alias("sha256"), "source_file_bytes", "modificationTime")
    small = sized.where(F.col("length") <= whole_bytes).select("path", F.sha2("content", 256).alias("sha256"), "source_file_bytes", "modificationTime")
    schema = "path string, sha256 string, source_file_bytes long, modificationTime timestamp"
    return small.select(*names).unionByName(large.mapInArrow(_hash_in_pieces, schema))


def _arrow_path(path: str) -> tuple | None:
    """(file system, path there) as Arrow opens it, or None."""
    from pyarrow import fs

    try:
        if path.startswith(("file:", "/")):
            return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
        scheme, _, rest = path.partition("://")
        return fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{quote(rest)}")
    except (ValueError, NotImplementedError, OSError):
        return None


def _hash_in_pieces(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        digests = []
        for path in batch["path"].to_pylist():
            system, name = _arrow_path(path)
            digest = hashlib.sha256()
            with system.open_input_stream(name, buffer_size=0) as stream:
                while piece := stream.read(PIECE_BYTES):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        arrays = [batch["path"], pa.array(digests, pa.string()), batch["source_file_bytes"], batch["modificationTime"]]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "sha256", "source_file_bytes", "modificationTime"])


def csv_record_counts(
    spark: SparkSession, paths: str | Sequence[str], schema: FileSchema, multiline: bool | None = None
) -> DataFrame:
    """Data rows per file (header and blank lines not counted)."""

    def read(part: str | Sequence[str], whole: bool) -> DataFrame:
        return read_csv_tolerant(spark, part, schema, whole).select(F.col("_metadata.file_path").alias("path"))

    return read_each(spark, paths, schema, multiline, read).groupBy("path").agg(F.count("*").alias("records"))


def plain_path(path: Column) -> Column:
    """The same spelling whichever reader reported the path."""
    return F.regexp_replace(path, "^file:/+", "/")


def file_inventory(files: DataFrame, counts: DataFrame, run_status: str = "success") -> DataFrame:
    """Name, size, kind, record count and, for failed runs, a partial mark for every file."""
    is_csv = F.lower("file_name").endswith(".csv")
    counted = counts.select(plain_path(F.col("path")).alias("_at"), "records")
    return (
        files.withColumn("_at", plain_path(F.col("path")))
        .join(counted, "_at", "left")
        .select(
            F.col("file_name").alias("name"),
            F.col("length").alias("size_bytes"),
            F.when(is_csv, "csv").otherwise("blob").alias("kind"),
            F.when(is_csv, F.coalesce("records", F.lit(0))).alias("records"),
            F.lit(run_status in ("error", "failed")).alias("partial"),
        )
    )


def checksum_lines(hashes: DataFrame, root: str) -> DataFrame:
    """`<sha256>  <relative path>` lines in sorted order, leaving out the checksum file itself."""
    relative = F.replace(plain_path(F.col("path")), plain_path(F.lit(root.rstrip("/") + "/")), F.lit(""))
    named = hashes.withColumn("_relative", relative)
    kept = named.where(~F.lower("_relative").endswith("checksums.sha256"))
    return kept.select(F.concat_ws("  ", "sha256", "_relative").alias("line")).orderBy("line")


def config_freshness(
    files: DataFrame, now: dt.datetime, min_bytes: int = 100, max_age_days: int = 30
) -> DataFrame:
    """One row: whether a configuration file exists, has content, and is recent enough."""
    age = (F.lit(now) - F.max("modificationTime")).cast("interval day to second")
    stats = files.agg(
        (F.count("*") > 0).alias("exists"),
        F.coalesce(F.max("length"), F.lit(0)).alias("size_bytes"),
        F.extract(F.lit("DAY"), age).alias("age_days"),
    )
    return stats.withColumns(
        {
            "has_content": F.col("size_bytes") >= min_bytes,
            "is_recent": F.coalesce(F.col("age_days") <= max_age_days, F.lit(False)),
        }
    ).withColumn("needs_refresh", ~(F.col("exists") & F.col("has_content") & F.col("is_recent")))
