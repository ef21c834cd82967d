"""What the silver transforms share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.links import DEFAULT_HOST
from silverline.operators.keyed import latest_per_key, newest_first

BRONZE_METADATA = [
    "source_system",
    "source_file",
    "source_file_hash",
    "source_file_bytes",
    "source_row",
    "ingested_at",
    "bronze_run_id",
    "row_hash",
]

# Newest first, down to rows that are equal in every business column.
NEWEST = ["ingested_at", "source_row", "source_file", "source_file_hash", "row_hash"]


@dataclass(frozen=True)
class SilverRun:
    """What a transform needs to know about the run it is part of."""

    snapshot_id: str
    asof: dt.date
    processed_at: dt.datetime
    portal_host: str = DEFAULT_HOST

    @property
    def today(self) -> Column:
        return F.lit(self.asof)

    @property
    def now(self) -> Column:
        return F.lit(self.processed_at.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Transform:
    """One version of one dataset's silver layer."""

    dataset: str
    version: str
    build: Callable[[DataFrame, SilverRun], DataFrame]
    primary_key: str
    order: tuple[tuple[str, str], ...] = ()
    variant: str | None = None
    tags: tuple[str, ...] = field(default=())

    def __call__(self, bronze: DataFrame, run: SilverRun) -> DataFrame:
        return self.build(bronze, run)

    def sort_columns(self) -> list[Column]:
        """The output order, with the key last so that equal values can be split over tasks."""
        ways = [*self.order, (self.primary_key, "asc")]
        return [
            F.col(name).desc_nulls_last() if way == "desc" else F.col(name).asc_nulls_last() for name, way in ways
        ]


def raw(name: str) -> Column:
    """An exported column by its header."""
    return F.col(f"`{name}`")


def newest_version(bronze: DataFrame, key: str) -> DataFrame:
    """The newest bronze row of every record.

    Files of one run share their time, and their rows their numbers: file, content and row hash make
    the order total, so the winner does not depend on which task comes first.
    """
    return latest_per_key(bronze, [key], newest_first(NEWEST))


def lineage(version: str, run: SilverRun) -> list[Column]:
    """Lineage columns of the current generation of transforms."""
    return [
        raw("source_file_hash").alias("source_hash"),
        raw("row_hash"),
        raw("ingested_at").cast("timestamp_ntz").alias("bronze_ingested_at"),
        *silver_stamp(version, run),
    ]


def silver_stamp(version: str, run: SilverRun, named_after: str | None = None) -> list[Column]:
    """Version, time and snapshot; first-generation transforms add a name made of dataset and version."""
    columns = [F.lit(version).alias("transform_version")]
    if named_after:
        columns.append(F.lit(f"{named_after}_{version}.sql").alias("transform_sql"))
    return [*columns, run.now.alias("transformed_at"), F.lit(run.snapshot_id).alias("snapshot_id")]


def free_of(value: Column, words: list[str], ignore_case: bool) -> Column:
    """None of the words occurs in the text; NULL text does not pass."""
    ok = F.lit(True)
    for word in words:
        hit = value.ilike(f"%{word}%") if ignore_case else value.like(f"%{word}%")
        ok = ok & ~hit
    return ok
