"""Consolidation: many overlapping exports of the same records become one deduplicated set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators.keyed import consolidation_stats, drop_keyless, keep_last_n
from silverline.operators.ordering import text_date_order
from silverline.operators.positions import with_source_row
from silverline.sources.readers import path_fields, read_csv_tolerant, read_each
from silverline.sources.registry import FileSchema

# Order of the exports, oldest first: day of the export, run, file, row in the file.
AGE = ["_file_date", "_run_id", "_source_path", "source_row"]
COUNT = "Duplicate Count"


def read_exports(spark, paths, schema: FileSchema, multiline: bool | None = None) -> DataFrame:
    """All rows of all exports with the columns that order them."""
    numbered = read_each(spark, paths, schema, multiline, lambda part, whole: with_source_row(read_csv_tolerant(spark, part, schema, whole)))
    fields = path_fields(F.col("_source_path"), F.col("_modified"))
    return numbered.withColumns({"_file_date": fields["file_date"], "_run_id": fields["run_id"]}).drop("_modified", "_corrupt")


def consolidate(rows: DataFrame, allowances: DataFrame, key: str = "PO #", count: str = COUNT) -> DataFrame:
    """Keep the newest instance of every record, or the newest N where the allowances say so."""
    return keep_last_n(drop_keyless(rows, [key], "blank"), [key], AGE, allowances, count)


def consolidated_order(date_column: str = "Sent Date", key: str = "PO #") -> list:
    """Output order: by day, rows without one last, then by key."""
    return text_date_order(date_column, key)


def statistics(rows: DataFrame, allowances: DataFrame, key: str = "PO #", count: str = COUNT) -> DataFrame:
    return consolidation_stats(drop_keyless(rows, [key], "blank"), [key], allowances, count)
