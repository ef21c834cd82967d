"""Positions in a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.session import ensure_checkpointing

_INDEX_MASK = (1 << 33) - 1


def with_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position of every row under a total order.

    Range-sorted once and cut off by a checkpoint, so that the partition a row sits in is fixed.
    The rows of a partition are already counted by their id; what is added is the number of rows
    in the partitions before, a table with one row per partition.
    """
    ensure_checkpointing(df.sparkSession)
    placed = df.orderBy(*order).checkpoint()
    tagged = placed.withColumns(
        {"_part": F.spark_partition_id(), "_index": F.monotonically_increasing_id().bitwiseAND(_INDEX_MASK)}
    )
    sizes = tagged.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition of the sorted data: a bounded table.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_before") + F.col("_index") + 1).cast("long"))
        .select(*[F.col(f"`{column}`") for column in df.columns], name)
    )


def with_source_row(df: DataFrame, name: str = "source_row") -> DataFrame:
    """1-based row number inside the file a row was read from. Call it right on the reader.

    Adds `_source_path` and `_modified` (the time of the file) as well. Large files are read in
    blocks. Rows are numbered inside their block; the sizes of the earlier blocks of the file come
    from a count per block. Where a block starts is fixed by the file, so reading the files for the
    count and again for the rows cannot disagree. The counts are sent round, a row a block, so the rows
    of a block stay where they were read.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_modification_time").alias("_modified"),
        F.monotonically_increasing_id().alias("_index"),
    )
    blocks = tagged.groupBy("_file", "_block").agg(
        F.count("*").alias("_size"), F.min("_index").alias("_first")
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    return (
        tagged.join(F.broadcast(offsets), ["_file", "_block"])
        .withColumn(name, (F.col("_before") + F.col("_index") - F.col("_first") + 1).cast("long"))
        .select(*[F.col(f"`{column}`") for column in df.columns], name, F.col("_file").alias("_source_path"), "_modified")
    )


def dimensions(df: DataFrame, keys: Mapping[str, str]) -> dict[str, DataFrame]:
    """Distinct values of several columns with their rank (NULL last), as one table per column.

    `keys` names the id of each column. The values of all columns are gathered in one pass, placed by
    one distributed sort along (column, value), and ranked by their distance from the first value of
    their column: the same for a domain of any size.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(f"`{c}`").cast("string").alias("value")) for c in keys]
    )
    values = df.select(F.inline(pairs)).distinct()
    # Values are compared as what they are, not as text.
    typed = [F.when(F.col("dimension") == c, F.col("value").cast(df.schema[c].dataType)).asc_nulls_last() for c in keys]
    placed = with_positions(values, [F.col("dimension"), *typed], "_at")
    first = {row["dimension"]: row["_first"] for row in placed.groupBy("dimension").agg(F.min("_at").alias("_first")).collect()}
    return {
        column: placed.where(F.col("dimension") == column).select(
            F.col("value").cast(df.schema[column].dataType).alias(column), (F.col("_at") - first.get(column, 1) + 1).alias(key)
        )
        for column, key in keys.items()
    }
