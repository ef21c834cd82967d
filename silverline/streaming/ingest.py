"""Incremental ingestion: every new file once, repeated content skipped."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverline.operators.joins import members, not_in
from silverline.plans.bronze import IngestRun, ingest_files
from silverline.session import ensure_checkpointing, path_exists

FILE = "path string, modificationTime timestamp, length bigint, content binary"
EVENT_LOG = (
    "timestamp string, severity string, body string, attributes map<string,string>, traceId string, spanId string"
)


def stream_bronze(
    spark: SparkSession, source: str, dataset: str, root: str, checkpoint: str, run: IngestRun, glob: str = "*.csv", max_files: int = 1000
) -> StreamingQuery:
    """Ingest the files that arrived since the last call, in batches of up to `max_files`.

    The stream remembers which files it has seen, so a first call over a full folder is many batches of
    a bounded size. A batch keeps the names of its files in a table under its number, which a repeated
    batch writes again, and passes them to the bronze ingestion, which skips contents already there: a
    batch that is repeated after a failure adds nothing twice.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .load(source)
        .select("path")
    )

    def batch(names: DataFrame, number: int) -> None:
        session = names.sparkSession
        table = f"{batch_names_path(root, dataset)}/batch={number}"
        names.write.mode("overwrite").parquet(table)
        # No more than `max_files`, which the reader of a batch needs by name.
        paths = [row.path for row in session.read.schema("path string").parquet(table).toLocalIterator()]
        if paths:
            code = f"{run.code_version}-{number}"
            ingest_files(session, paths, dataset, root, replace(run, code_version=code), glob)

    return _start(files, batch, checkpoint)


def batch_names_path(root: str, dataset: str) -> str:
    """Where the names of the files of each batch are kept, by batch number."""
    return f"{root}/_manifests/_stream_{dataset}"


def _start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def daily_log_counts(logs: DataFrame, kind: str = "severity", lateness: str | None = None) -> DataFrame:
    """Records per day and kind, for a stream or a table of log records.

    Nothing is dropped unless `lateness` is set: the state is one number per day and kind. With it,
    days older than that leave the state, and records for them are ignored.
    """
    timed = logs.withColumn("event_time", F.to_timestamp("timestamp"))
    if lateness:
        timed = timed.withWatermark("event_time", lateness)
    counted = timed.groupBy(F.window("event_time", "1 day"), F.col(kind).alias("kind")).agg(F.count("*").alias("records"))
    return counted.select(F.col("window.start").cast("date").alias("day"), "kind", "records")


def stream_log_counts(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = EVENT_LOG,
    kind: str = "severity",
) -> StreamingQuery:
    """Keep daily counts of a folder of NDJSON logs up to date.

    Each batch rewrites the days it touched: its counts replace those of the same day and kind, and
    the day's other kinds stay. A batch that is repeated writes the same days again.
    """
    logs = spark.readStream.schema(schema).option("recursiveFileLookup", True).json(source)

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        ensure_checkpointing(session)
        fresh = rows.checkpoint()
        if path_exists(session, target):
            earlier = members(current_log_counts(session, target), fresh.select("day").distinct(), ["day"])
            fresh = fresh.unionByName(not_in(earlier, fresh, ["day", "kind"])).checkpoint()
        writer = fresh.withColumn("at", F.col("day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("at").parquet(target)

    writer = daily_log_counts(logs, kind).writeStream.outputMode("update").foreachBatch(batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_log_counts(spark: SparkSession, target: str) -> DataFrame:
    """The newest count per day and kind."""
    return spark.read.parquet(target).select("day", "kind", "records")
