"""WARC archives: written by Spark's own writer, read back in splits, checked as chains.

A record is its version line, headers, an empty line, the payload and two line ends. Readers split
an archive at every occurrence of the version line, wherever tasks happen to begin, so an occurrence
inside a payload looks like a record too. Each occurrence therefore only proposes a link from its
offset to the offset after the length it states; pointer jumping from the start of the file keeps
the records that the chain reaches, and everything between them is payload. Before that, runs of
records that follow each other inside a split are contracted to one link each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import store, stored
from silverline.session import remove_path

MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits at a time are four base32 digits."""

    def spelled(digest: Column) -> Column:
        def digits(group: Column) -> Column:
            value = F.conv(F.substring(digest, group * 5 + 1, 5), 16, 10).cast("int")
            one = [F.substring(F.lit(_ALPHABET), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, 1) for shift in (15, 10, 5, 0)]
            return F.concat(*one)

        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), digits), "")

    # The lambda's variable holds the hash, so it is computed once per payload.
    return F.transform(F.array(F.sha1(payload)), spelled)[0]


def _line(name: str, value: Column) -> Column:
    """A header line, absent if the value is NULL; line ends inside a value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, max_records: int = 50_000) -> None:
    """One record per row of (page_id, url, html); each file is an archive.

    Of records with equal payloads, the one with the largest page_id is the response and the others
    revisit it, without payload. Payloads are compared by SHA-1; only (digest, page_id) is aggregated,
    with partial sums, so a payload that a third of the pages share is one row of the join. NULL html
    is an empty payload; a record without page_id revisits the largest, and is a response if none of
    its group has one; rows that share the largest page_id are all responses.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn(
        "digest", base32_sha1(F.col("payload"))
    )
    largest = rows.select("page_id", "digest").groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
    # Stored, so that Spark knows its size before payloads move: few repeats are sent round instead.
    largest = stored(largest.drop("n"), "largest")
    marked = rows.join(largest, "digest", "left").withColumn(
        "revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull(), F.lit(False))
    )
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.decode("payload", "UTF-8"))
    size = F.when(F.col("revisit"), F.lit(0)).otherwise(F.octet_length("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("largest").cast("string"), F.lit(">")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("Content-Length", size),
        F.lit("\r\n"),
        body,
    )
    # The writer ends every row with its line separator: here, the end of a record.
    marked.select(record.alias("value")).write.option("lineSep", _END).option("maxRecordsPerFile", max_records).mode("errorifexists").text(path)


def _segments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """What follows each version line, in order: (file, block, row, value). The first of a file precedes them all."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _with_offsets(segments: DataFrame) -> DataFrame:
    """The offset of the version line before each segment, from the lengths of what comes earlier in its file.

    Sums run inside a block, which has a bounded size, and then over the blocks of a file.
    """
    inside = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    blocks = segments.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    local = segments.withColumn("local", F.coalesce(F.sum(F.col("bytes") + len(MAGIC)).over(inside), F.lit(0)))
    return local.join(starts, ["file", "block"]).withColumn("offset", F.col("base") + F.col("local") - len(MAGIC)).drop("base", "local")


def _fields(head: Column) -> Column:
    """What the headers of a segment say."""

    def line(name: str) -> Column:
        found = F.regexp_extract(head, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def page(name: str) -> Column:
        return F.regexp_extract(head, rf"{name}: <urn:page:(-?\d+)>", 1).try_cast("long")

    return F.struct(
        (F.octet_length(head) + len(_END)).cast("long").alias("body"),
        line("Content-Length").try_cast("long").alias("size"),
        line("WARC-Type").alias("record_type"),
        page("WARC-Record-ID").alias("page_id"),
        page("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(line("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
    )


def _parsed(segments: DataFrame) -> DataFrame:
    """Header fields of each segment; `claimed` is the length of the record it would begin, NULL if it can't begin one.

    A payload may hold anything, so headers end at the first empty line and all lengths are bytes.
    """
    head = F.substring_index(F.col("value").cast("string"), _END, 1)
    read = segments.select(
        "file", "block", "row", F.octet_length("value").cast("long").alias("bytes"), "value", F.inline(F.transform(F.array(head), _fields))
    )
    claimed = F.when((F.col("body") <= F.col("bytes")) & (F.col("size") >= 0), F.col("body") + F.col("size") + len(_END) + len(MAGIC))
    whole = F.coalesce(claimed == F.col("bytes") + len(MAGIC), F.lit(False))
    payload = F.expr("substring(value, cast(body + 1 as int), cast(size as int))")
    return read.select(
        "file", "block", "row", "bytes", claimed.alias("claimed"), whole.alias("whole"), "record_type", "page_id", "refers_to",
        "stated_digest", "body", "size", F.when(whole, base32_sha1(payload)).alias("digest"),
    )


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) that the chain of each file reaches from offset 0, by pointer jumping.

    `links` has (file, offset, next). Each round doubles the stretch that a pointer jumps, so a file
    of n links takes log2(n) rounds; a round is two joins of numbers on (file, offset), and its tables
    go when the next round has its own.
    """
    spark = links.sparkSession
    jump, jumps = links, None
    path, found = store(links.filter("offset = 0").select("file", "offset"), "reached")
    n = found.count()
    while True:
        step = found.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        # An end of file is no record: keep what is the offset of a link.
        step = step.join(links.select("file", "offset"), ["file", "offset"], "left_semi")
        newer, found = store(found.unionByName(step).distinct(), "reached")
        remove_path(spark, path)
        path, more = newer, found.count()
        if more == n:
            if jumps:
                remove_path(spark, jumps)
            return found
        n = more
        onward = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        longer, jump = store(jump.join(onward, ["file", "next"]).select("file", "offset", F.col("far").alias("next")), "jumps")
        if jumps:
            remove_path(spark, jumps)
        jumps = longer


def runs(candidates: DataFrame) -> DataFrame:
    """The candidates (file, block, offset, next, ...) with `head`, the offset of the first candidate of their run.

    Inside a block a candidate whose record ends where the next candidate begins is one step from it;
    candidates joined by steps are a run. A run is cut where any other link lands inside it, so whether
    the chain reaches a run is the same for all of it, and the chain need only be followed from run to
    run: about one a block, where no payload holds a version line.
    """
    along = Window.partitionBy("file", "block").orderBy("offset")
    stepped = candidates.withColumn("step", F.coalesce(F.lead("offset").over(along) == F.col("next"), F.lit(False)))
    landed = stepped.filter(~F.col("step")).select("file", F.col("next").alias("offset")).distinct().withColumn("landed", F.lit(True))
    marked = stepped.join(landed, ["file", "offset"], "left")
    begins = F.col("landed").isNotNull() | ~F.coalesce(F.lag("step").over(along), F.lit(False))
    heads = marked.withColumn("begins", begins).withColumn("head", F.last(F.when(F.col("begins"), F.col("offset")), ignorenulls=True).over(along))
    return heads.drop("step", "landed", "begins")


def chained(candidates: DataFrame) -> DataFrame:
    """The candidates (file, block, offset, next, ...) that the chain of their file reaches."""
    cut_up = stored(runs(candidates), "runs")
    links = stored(cut_up.groupBy("file", F.col("head").alias("offset")).agg(F.max("next").alias("next")), "links")
    reached = reachable(links).withColumnRenamed("offset", "head")
    return cut_up.join(reached, ["file", "head"], "left_semi").drop("head")


def _owners(placed: DataFrame, records: DataFrame) -> DataFrame:
    """(file, offset, owner): for each segment the record that it lies in, from offsets alone.

    The owner is the last record at or before the segment: in the segment's own block, or the last of
    the earlier blocks that have one.
    """
    along = Window.partitionBy("file", "block").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = placed.select("file", "block", "offset").join(records.select("file", "offset", F.col("offset").alias("record")), ["file", "offset"], "left")
    own = marked.withColumn("own", F.last("record", ignorenulls=True).over(along))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = marked.groupBy("file", "block").agg(F.max("record").alias("last")).withColumn("carried", F.last("last", ignorenulls=True).over(before))
    return own.join(last.drop("last"), ["file", "block"]).select("file", "offset", F.coalesce("own", "carried").alias("owner"))


def _assembled(spark: SparkSession, path: str, placed: DataFrame, records: DataFrame) -> DataFrame:
    """Digests of payloads that hold version lines: their segments are read again and put together.

    Which segments these are follows from offsets; only they carry payload into a join, and only the
    segments of one record meet.
    """
    broken = stored(records.filter(~F.col("whole")).select("file", F.col("offset").alias("owner"), "body", "size", F.col("next").alias("end")), "broken")
    if broken.isEmpty():
        return broken.select("file", F.col("owner").alias("offset"), F.lit(None).cast("string").alias("put_together"))
    wanted = stored(_owners(placed, records).join(broken, ["file", "owner"]).filter(F.col("offset") < F.col("end")).drop("end"), "owners")
    again = _segments(spark, path).join(broken.select("file").distinct(), "file", "left_semi")
    values = _with_offsets(again.withColumn("bytes", F.octet_length("value").cast("long"))).select("file", "offset", "value")
    joined = values.join(wanted, ["file", "offset"]).groupBy("file", "owner", "body", "size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda s: s["value"]).alias("values")
    )
    raw = F.expr(f"aggregate(values, cast(null as binary), (a, v) -> case when a is null then v else concat(a, cast('{_sql(MAGIC)}' as binary), v) end)")
    cutout = F.expr("substring(raw, cast(body + 1 as int), cast(size as int))")
    return joined.withColumn("raw", raw).select("file", F.col("owner").alias("offset"), base32_sha1(cutout).alias("put_together"))


def _sql(text: str) -> str:
    return text.replace("\r", "\\r").replace("\n", "\\n")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, stated_digest, payload_bytes, payload_digest) of every record.

    Archives are read in splits of any size. Bytes and digest of a response are those of the payload
    that was read; a revisit takes them from the response it refers to.
    """
    parsed = stored(_parsed(_segments(spark, path)), "segments")
    placed = stored(_with_offsets(parsed).withColumn("next", F.col("offset") + F.col("claimed")), "placed")
    records = stored(chained(placed.filter("claimed is not null")), "records")
    records = records.join(_assembled(spark, path, placed, records), ["file", "offset"], "left").select(
        "page_id", "record_type", "refers_to", "stated_digest", F.col("size").alias("bytes"), F.coalesce("digest", "put_together").alias("digest")
    )
    responses = records.filter("record_type = 'response'")
    full = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("stated_digest")).agg(F.max("bytes").alias("full_bytes"))
    revisits = records.filter("record_type = 'revisit'").drop("bytes", "digest").join(full, ["refers_to", "stated_digest"], "left")
    return responses.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to", "stated_digest"
    ).unionByName(
        revisits.select("page_id", F.col("full_bytes").alias("payload_bytes"), F.when(F.col("full_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"), "record_type", "refers_to", "stated_digest")
    )
