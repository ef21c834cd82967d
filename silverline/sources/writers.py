"""Writing bronze, silver, typed and audit data.

Writes by date ask for a rebalance instead of one task per date: small dates are joined, a date
holding much of the data is split over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions.dates import as_date

# Rows per file at most; larger partitions continue in another file.
MAX_FILE_ROWS = 10_000_000


def _parquet(df: DataFrame, mode: str):
    return df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", MAX_FILE_ROWS)


def write_bronze(df: DataFrame, root: str, dataset: str) -> str:
    """Write below `ingest_date=…/sha256=…`; a content that is written again replaces itself."""
    path = f"{root}/{dataset}"
    writer = _parquet(df, "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("ingest_date", "sha256").parquet(path)
    return path


def write_silver_snapshot(
    df: DataFrame, root: str, dataset: str, version: str, snapshot: str, sort: Sequence | None = None
) -> str:
    """Write one snapshot as `version=…/snapshot=…`, globally sorted if asked for.

    The folder is replaced whole, so a build that is run again leaves one copy, also an empty one.
    """
    path = f"{root}/{dataset}"
    rows = df.orderBy(*sort) if sort else df
    _parquet(rows, "overwrite").parquet(f"{path}/version={version}/snapshot={snapshot}")
    return path


def write_year_month(df: DataFrame, path: str, date_column: str) -> str:
    """Typed Parquet by year and month; months present in `df` are replaced, others kept."""
    parted = df.withColumns(
        {
            "year": F.date_format(as_date(F.col(date_column)), "yyyy"),
            "month": F.date_format(as_date(F.col(date_column)), "MM"),
        }
    )
    balanced = parted.hint("rebalance", F.col("year"), F.col("month"))
    writer = _parquet(balanced, "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month").parquet(path)
    return path


def write_typed(df: DataFrame, path: str) -> str:
    _parquet(df, "overwrite").parquet(path)
    return path


def write_csv_ordered(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    """CSV with a header and a fixed column order; the row order of `df` is kept."""
    picked = df.select(*[F.col(f"`{name}`") for name in columns])
    writer = picked.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def append_ndjson(df: DataFrame, path: str, date_column: str = "date") -> str:
    """One JSON object per line, in a folder per day; days are gathered before they are written."""
    df.hint("rebalance", F.col(date_column)).write.mode("append").partitionBy(date_column).json(path)
    return path


def write_manifest(df: DataFrame, path: str) -> str:
    """Append audit rows."""
    df.write.mode("append").json(path)
    return path
