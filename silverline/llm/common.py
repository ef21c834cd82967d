"""What the text operators share: rows to and from Arrow batches, row keys, cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.session import ensure_checkpointing, scratch_path

# The white space that separates words: \x20 and \x09-\x0D. bytes.split() splits at exactly these.
SPACE = b" \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

# Text handed to Python in one Arrow batch. Rows are few and texts long, so rows are counted in bytes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The rows, stored in the shared folder: what follows never runs what came before again."""
    ensure_checkpointing(frame.sparkSession)
    return frame.checkpoint()


def store(frame: DataFrame, name: str) -> tuple[str, DataFrame]:
    """A new table in the shared folder with these rows, and its path: like `cut`, but compressed and read by column.

    The caller may remove the path once nothing reads the table any more.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return path, frame.sparkSession.read.schema(frame.schema).parquet(path)


def stored(frame: DataFrame, name: str) -> DataFrame:
    return store(frame, name)[1]


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def under_plain_names(docs: DataFrame, work: Callable[[DataFrame], DataFrame], known: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """work(docs), which keeps all columns, with every column it does not know under a plain name meanwhile.

    So columns may have dots in their names, or names that the work uses itself.
    """
    plain = [c if c in known else f"carried_{k}" for k, c in enumerate(docs.columns)]
    done = work(docs.toDF(*plain))
    return done.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])


def text_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes that name a document: rows equal in id and text share it, NULL text counts as empty."""
    return F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))))


def map_rows(
    frame: DataFrame, make: Callable[[], Callable[[list[dict]], list[dict]]], schema: str | StructType, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Rows from rows, in Python. `make` runs once a task and gives the function for a list of rows.

    Batches are bounded in bytes by slicing what Spark hands over, so long texts never pile up as
    Python objects. Output columns are exactly those of `schema`.
    """
    spark = frame.sparkSession
    out = pa_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, batch_bytes):
                rows = work(part.to_pylist())
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

    return frame.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    rows = batch.num_rows
    step = rows if batch.nbytes <= most else max(1, rows * most // batch.nbytes)
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def pa_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
