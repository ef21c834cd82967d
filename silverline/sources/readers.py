"""Reading exports, bronze data and manifests."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.sources.registry import FileSchema

RUN_MANIFEST = (
    "schemaVersion string, "
    "run struct<id: string, dataset: string, label: string, startTime: string, endTime: string, "
    "durationMs: bigint, status: string, error: string>, "
    "input struct<parameters: struct<startDate: string, endDate: string, filter: string>, "
    "argv: array<string>, command: string>, "
    "output struct<outputDir: string, downloadDir: string, "
    "files: array<struct<name: string, sizeBytes: bigint, kind: string, records: bigint, partial: boolean>>>, "
    "source struct<system: string, url: string, finalUrl: string, accessedAt: string>"
)


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of an input that arrives in so few blocks that most cores would idle.

    Anything larger than a block for every fourth core is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 4 <= cores else df


def _csv(spark: SparkSession, options: dict[str, str], multiline: bool) -> DataFrameReader:
    return (
        spark.read.option("header", options.get("header", "true").lower())
        .option("sep", options.get("delimiter", ","))
        .option("quote", options.get("quote", '"'))
        .option("escape", options.get("escape", '"'))
        .option("nullValue", options.get("nullstr", ""))
        .option("multiLine", multiline)
    )


def unsplittable_files(spark: SparkSession, paths: Sequence[str] | str, quote: str = '"') -> list[str]:
    """The files whose records a reader of lines would get wrong, found in one splittable pass.

    A line break lies inside quotes exactly if some line before it ends with an odd number of quotes
    open, and then that line, or one before it, holds an odd number itself. So a file whose lines all
    hold an even number can be cut at any line break, wherever a block begins. Lines of blanks only and
    single carriage returns, which readers of lines and of whole files take differently, count too.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(F.col("_metadata.file_path").alias("path"), F.rtrim("value", F.lit("\r")).alias("line"))
    line = F.col("line")
    quotes = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
    odd = (quotes % 2 == 1) | ((line != "") & (F.trim(line) == "")) | F.contains(line, F.lit("\r"))
    # Names of the files that need it, not of all.
    return sorted(unquote(row["path"]) for row in lines.groupBy("path").agg(F.max(odd).alias("odd")).where("odd").select("path").toLocalIterator())


def read_each(
    spark: SparkSession,
    paths: Sequence[str] | str,
    schema: FileSchema,
    multiline: bool | None,
    read: Callable[[Sequence[str] | str, bool], DataFrame],
) -> DataFrame:
    """read(paths, multiline), once for the files that must be read whole and once for those that can be split.

    The argument decides for all files, then the schema; without either every file is looked at.
    `read` gets readers' own columns such as `_metadata`, which a union no longer has.
    """
    chosen = schema.multiline if multiline is None else multiline
    if chosen is not None:
        return read(paths, chosen)
    whole = unsplittable_files(spark, paths, schema.options.get("quote", '"'))
    if not whole:
        return read(paths, False)
    every = [unquote(path) for path in spark.read.text(paths).inputFiles()]
    rest = sorted(set(map(_local, every)) - set(map(_local, whole)))
    return read(whole, True).unionByName(read(rest, False)) if rest else read(paths, True)


def _local(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def read_csv_registry(
    spark: SparkSession, paths: Sequence[str] | str, schema: FileSchema, multiline: bool | None = None
) -> DataFrame:
    """Read with a fixed schema; a renamed, missing or extra column fails the job.

    `multiline` allows line breaks inside quotes, at the price of one task per file; without it large
    files are split. The argument decides, then the schema, then what the files hold.
    """

    def read(part: Sequence[str] | str, whole: bool) -> DataFrame:
        reader = _csv(spark, schema.options, whole).schema(schema.struct())
        return reader.option("mode", "FAILFAST").option("enforceSchema", False).csv(part)

    return read_each(spark, paths, schema, multiline, read)


def read_csv_tolerant(
    spark: SparkSession, paths: Sequence[str] | str, schema: FileSchema, multiline: bool | None = None
) -> DataFrame:
    """Read what can be read: short rows are padded, long rows cut, odd rows shown in `_corrupt`."""
    struct = T.StructType([*schema.struct().fields, T.StructField("_corrupt", T.StringType())])

    def read(part: Sequence[str] | str, whole: bool) -> DataFrame:
        reader = _csv(spark, schema.options, whole).schema(struct).option("mode", "PERMISSIVE")
        return reader.option("columnNameOfCorruptRecord", "_corrupt").csv(part)

    return read_each(spark, paths, schema, multiline, read)


def read_csv_inferred(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Types detected from every row; files are split where no record has a line break inside quotes."""
    whole = bool(unsplittable_files(spark, paths))
    return _csv(spark, {}, whole).option("inferSchema", True).option("samplingRatio", 1.0).csv(paths)


def union_csv_files(spark: SparkSession, paths: Sequence[str], schema: FileSchema, multiline: bool | None = None) -> DataFrame:
    """Rows of all files under one header, matched by position; blank lines drop out."""
    return read_csv_tolerant(spark, list(paths), schema, multiline).drop("_corrupt")


def path_fields(path: Column, modified: Column | None = None) -> dict[str, Column]:
    """What a path tells: `/YYYY/MM/DD/` as file date (else the file's own), run id, file name."""
    slashed = F.translate(path, "\\", "/")
    day = F.try_to_date(F.regexp_extract(slashed, r"(\d{4}/\d{2}/\d{2})", 1), "yyyy/MM/dd")
    run = F.regexp_extract(slashed, r"run_([^/]+)", 1)
    return {
        "file_date": day if modified is None else F.coalesce(day, modified.cast("date")),
        "run_id": F.coalesce(F.nullif(run, F.lit("")), F.lit("unknown")),
        "file_name": F.element_at(F.split(slashed, "/"), -1),
    }


def raw_with_provenance(
    spark: SparkSession, paths: Sequence[str] | str, schema: FileSchema, multiline: bool | None = None
) -> DataFrame:
    """Every raw row, with where it came from."""

    def read(part: Sequence[str] | str, whole: bool) -> DataFrame:
        rows = read_csv_tolerant(spark, part, schema, whole).drop("_corrupt")
        return rows.select("*", F.col("_metadata.file_path").alias("_full_path"), F.col("_metadata.file_modification_time").alias("file_modification_time"))

    named = read_each(spark, paths, schema, multiline, read)
    fields = path_fields(F.col("_full_path"))
    return named.select(
        *[F.col(f"`{name}`") for name in schema.columns],
        F.concat_ws("/", fields["run_id"], fields["file_name"]).alias("_origin_file"),
        F.col("file_modification_time").alias("_file_created"),
        "_full_path",
    )


def read_bronze(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """All bronze files of a dataset, with `ingest_date` and `sha256` as text columns."""
    base = f"{root}/{dataset}"
    rows = spark.read.option("basePath", base).parquet(base)
    return rows.withColumns({name: F.col(name).cast("string") for name in ("ingest_date", "sha256")})


def latest_partition(df: DataFrame, columns: Sequence[str] = ("ingest_date", "sha256"), newest: Row | None = None) -> DataFrame:
    """Rows of the newest partition by path order.

    The newest partition is known first, so that the filter prunes partitions: from a listing of the
    files where the caller has one, else from the partition columns alone.
    """
    if newest is None:
        newest = df.agg(F.max(F.struct(*columns)).alias("p")).first()["p"]
    if newest is None:
        return df.limit(0)
    for name in columns:
        df = df.where(F.col(name) == newest[name])
    return df


def read_manifests(
    spark: SparkSession, root: str, schema: str = RUN_MANIFEST, required: str = "run"
) -> DataFrame:
    """All run manifests under a folder. Files that are not valid JSON are left out."""
    rows = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "manifest.json")
        .json(root)
    )
    return rows.select("*", F.col("_metadata.file_path").alias("manifest_path")).where(F.col(required).isNotNull())


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(sql, **tables)


def describe(df: DataFrame) -> DataFrame:
    """Name, type and nullability of every column, as rows."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string, nullable boolean")


def load_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(Re)register a Parquet folder or file as a view; returns its row, year and month counts."""
    rows = spark.read.parquet(path)
    rows.createOrReplaceTempView(name)
    return coverage_counts(rows)


def coverage_counts(rows: DataFrame) -> DataFrame:
    """Row count, and distinct years and months where the table has them."""
    counts = [F.count("*").alias("row_count")]
    for part in ("year", "month"):
        known = part in rows.columns and "year" in rows.columns
        distinct = F.count_distinct(F.when(F.col("year").isNotNull(), F.col(part))) if known else F.lit(0)
        counts.append(distinct.cast("long").alias(f"{part}_count"))
    return rows.agg(*counts)
