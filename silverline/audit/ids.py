"""Identifiers and state hashes."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deterministic_run_id(event_time: Column, path: Column, code_version: Column, prefix: str = "bronze-") -> Column:
    """The same inputs give the same run id."""
    digest = F.sha2(F.concat(event_time, path, code_version), 256)
    return F.concat(F.lit(prefix), F.substring(digest, 1, 16))


def run_id(started: dt.datetime, code_version: str) -> str:
    """`run_<utc>_<code version>`."""
    return f"run_{started:%Y%m%dT%H%M%S}.{started.microsecond // 1000:03d}Z_{code_version}"


def snapshot_id(created: dt.datetime, token: str | None = None) -> str:
    """`snapshot_<utc>_<token>`, with a random token unless one is given."""
    stamp = f"{created:%Y-%m-%dT%H-%M-%S}-{created.microsecond // 1000:03d}Z"
    return f"snapshot_{stamp}_{token or uuid.uuid4().hex[:8]}"


def state_hash(files: DataFrame, version: str, path: str = "path") -> DataFrame:
    """One row: hash of a bronze state, from its sorted file names, their number and the version.

    A form for comparing with states hashed elsewhere: it holds the list of file names in one task.
    Builds identify their input by `state_of`.
    """
    listed = files.agg(F.array_sort(F.collect_list(path)).alias("files"))
    state = F.struct(F.col("files"), F.lit(version).alias("transform"), F.size("files").alias("count"))
    return listed.select(F.sha2(F.to_json(state), 256).alias("bronze_state_hash"), F.size("files").alias("bronze_files"))


def state_of(files: DataFrame, version: str, path: str = "path") -> DataFrame:
    """One row: the hash of a bronze state, for any number of files."""
    return state_digest(files, version, [], path)


def state_digest(files: DataFrame, version: str, groups: list[str], path: str = "path", prefix: int = 3) -> DataFrame:
    """Hash of a state per group, for any number of files.

    Names are hashed bucket by bucket (a bucket is a prefix of the name's own hash), then the bucket
    hashes are hashed: no task holds more than one bucket.
    """
    named = files.withColumn("_bucket", F.substring(F.sha2(path, 256), 1, prefix))
    buckets = named.groupBy(*groups, "_bucket").agg(
        F.count("*").alias("_n"),
        F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(path))), 256).alias("_hash"),
    )
    pairs = F.array_sort(F.collect_list(F.concat_ws(":", "_bucket", "_hash")))
    return buckets.groupBy(*groups).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("bronze_files"),
        F.sha2(F.concat_ws("\n", F.lit(version), F.concat_ws("\n", pairs)), 256).alias("bronze_state_hash"),
    )
