"""Repeated runs of lines, found in a suffix array over line ids and deleted but for their first copy.

Documents are sequences of line ids. Lines that occur once end every run, so only repeated lines
enter the array. Distributed prefix doubling names the classes of equal suffix prefixes of 1, 2, 4, ...
lines: the name of a class is the smallest text position in it, that is, its first copy. A class of
two members or more is an interval of suffixes whose common prefix has at least that length.

A run counts if it has enough words. Any run with enough words is the union of its shortest
stretches with enough words, counted from either end, and each of these spans two overlapping
prefixes whose names are known. So a line goes if a stretch over it has an earlier copy, and
adjoining lines that go are the maximal repeated runs. Stretches never have more lines than words,
which bounds the doubling.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import SPACE_PATTERN, cut, stored, text_key


@dataclass(frozen=True)
class LineRuns:
    """Words a repeated run needs."""

    min_words: int = 10


def _lines(docs: DataFrame) -> DataFrame:
    """(key, doc_id, pos, no, words, line) of every line with a word: pos counts these, no counts all lines."""
    numbered = F.transform(F.split("text", "\n", -1), lambda line, no: F.struct(no.alias("no"), line.alias("line")))
    worded = F.filter(numbered, lambda x: F.length(F.btrim(x["line"], F.lit(" \t\n\x0b\x0c\r"))) > 0)
    rows = docs.filter("text is not null").select(text_key().alias("key"), "doc_id", F.posexplode(worded).alias("pos", "x"))
    inner = F.btrim(F.col("x.line"), F.lit(" \t\n\x0b\x0c\r"))
    return rows.select(
        "key", "doc_id", "pos", F.col("x.no").alias("no"), F.size(F.split(inner, SPACE_PATTERN, -1)).alias("words"), F.unhex(F.md5("x.line")).alias("line")
    )


def _repeated(lines: DataFrame) -> DataFrame:
    """The lines that occur at two places or more, in text order, with a number that follows it and their class name.

    Repeated rows are one document, so a line at the same place of the same key is one occurrence.
    """
    place = F.struct("doc_id", "key", "pos")
    classes = lines.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("final")).filter("first <> final").select("line")
    kept = lines.join(classes, "line", "left_semi").dropDuplicates(["key", "pos"])
    # Text order by range, documents whole; stored, so that the numbers stay.
    sorted_lines = cut(kept.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("key")).sortWithinPartitions("doc_id", "key", "pos"))
    numbered = sorted_lines.withColumn("at", F.monotonically_increasing_id())
    names = numbered.groupBy("line").agg(F.min("at").alias("name_0"))
    return cut(numbered.join(names, "line").drop("line"))


def _double(rows: DataFrame, level: int) -> DataFrame:
    """Names of the classes of twice as many lines, NULL where a suffix ends before or is alone."""
    reach = 1 << level
    name = f"name_{level}"
    along = Window.partitionBy("key").orderBy("pos")
    # Lines in between occur once: the run is broken where positions jump.
    ahead = F.when(F.lead("pos", reach).over(along) == F.col("pos") + reach, F.lead(name, reach).over(along))
    pairs = rows.withColumn("second", ahead)
    classes = (
        pairs.filter(F.col("second").isNotNull() & F.col(name).isNotNull())
        .groupBy(name, "second")
        .agg(F.min("at").alias(f"name_{level + 1}"), F.count("*").alias("members"))
        .filter("members > 1")
        .drop("members")
    )
    return cut(pairs.join(classes, [name, "second"], "left").drop("second"))


def _stretches(rows: DataFrame, how: LineRuns) -> DataFrame:
    """The shortest stretches with enough words that begin or end at each line: (key, at of the first line, lines, numbers)."""
    along = Window.partitionBy("key").orderBy("pos")
    most = how.min_words - 1
    line = F.struct("pos", "words", "no", "at")
    ahead = rows.select("key", F.collect_list(line).over(along.rowsBetween(0, most)).alias("x"), F.lit(1).alias("step"))
    behind = rows.select("key", F.reverse(F.collect_list(line).over(along.rowsBetween(-most, 0))).alias("x"), F.lit(-1).alias("step"))

    def counted(state: Column, item: Column) -> Column:
        # Stops at enough words, or where a line in between occurs once.
        first = state["size"] == 0
        joins = (first | (item["pos"] == state["next"])) & ~state["stop"] & (state["sum"] < how.min_words)
        return F.struct(
            F.when(joins, state["sum"] + item["words"]).otherwise(state["sum"]).alias("sum"),
            F.when(joins, state["size"] + 1).otherwise(state["size"]).alias("size"),
            F.when(joins, item["pos"] + F.col("step")).otherwise(state["next"]).alias("next"),
            (~joins).alias("stop"),
        )

    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("size"), F.lit(0).alias("next"), F.lit(False).alias("stop"))
    both = ahead.unionByName(behind).withColumn("s", F.aggregate("x", start, counted)).filter(F.col("s.sum") >= how.min_words)
    part = F.slice("x", 1, F.col("s.size"))
    part = F.when(F.col("step") > 0, part).otherwise(F.reverse(part))
    return both.select("key", part.alias("part")).select(
        "key", F.col("part")[0]["at"].alias("at"), F.size("part").alias("lines"), F.transform("part", lambda p: F.struct(p["no"].alias("no"), p["pos"].alias("pos"))).alias("numbers"), F.element_at("part", -1)["pos"].alias("last_pos")
    )


def removed_lines(docs: DataFrame, how: LineRuns | None = None) -> DataFrame:
    """(key, removed, n_runs): for each document that loses lines, their numbers and how many maximal runs they make."""
    how = how or LineRuns()
    # Texts are split and hashed once; what follows reads the hashes.
    rows = _repeated(stored(_lines(docs), "lines"))
    levels = how.min_words.bit_length() - 1
    for level in range(levels):
        rows = _double(rows, level)
    names = [f"name_{level}" for level in range(levels + 1)]
    stretches = _stretches(rows, how)
    # A stretch of l lines is named by the prefixes of the largest power of two that begin and end it.
    level = F.floor(F.log2(F.col("lines").cast("double")) + 1e-9).cast("int")
    stretches = stretches.withColumn("level", level)
    named = F.array(*[F.col(n) for n in names])
    head = rows.select("at", named.alias("head"))
    tail = rows.select("key", F.col("pos").alias("tail_pos"), named.alias("tail"))
    spanned = (
        stretches.withColumn("tail_pos", F.col("last_pos") + 1 - F.pow(F.lit(2), F.col("level")).cast("int"))
        .join(head, "at")
        .join(tail, ["key", "tail_pos"])
        .select("key", "at", "lines", "numbers", F.col("head")[F.col("level")].alias("a"), F.col("tail")[F.col("level")].alias("b"))
        .filter("a is not null and b is not null")
    )
    spanned = cut(spanned)
    firsts = spanned.groupBy("lines", "a", "b").agg(F.min("at").alias("first"), F.max("at").alias("final")).filter("first < final")
    later = spanned.join(firsts, ["lines", "a", "b"]).filter("at > first").select("key", F.explode("numbers").alias("x"))
    gone = later.select("key", "x.no", "x.pos").distinct()
    begins = F.lag("pos").over(Window.partitionBy("key").orderBy("pos"))
    return (
        gone.withColumn("begins", (F.coalesce(begins, F.lit(-2)) != F.col("pos") - 1).cast("long"))
        .groupBy("key")
        .agg(F.collect_list("no").alias("removed"), F.sum("begins").alias("n_runs"))
    )


def drop_repeated_lines(docs: DataFrame, how: LineRuns | None = None) -> DataFrame:
    """The documents with their columns; `text` without later copies of repeated runs; n_lines, n_removed, n_runs.

    First copies are first by (doc_id, key of id and text, line), NULL ids first. Lines are equal if
    their characters are; lines without a word are kept and neither join nor break a run. NULL text
    stays NULL; rows equal in id and text are one document and lose the same lines; an empty table
    gives no rows; names of other columns may be any but those of the counts, which are replaced.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    removed = removed_lines(docs.select("doc_id", "text"), how)
    keyed = docs.select(*[F.col(f"`{c}`") for c in own]).withColumn("__key", text_key())
    joined = keyed.join(removed.select(F.col("key").alias("__key"), F.col("removed").alias("__removed"), F.col("n_runs").alias("__runs")), "__key", "left")
    lines = F.split("text", "\n", -1)
    staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__removed"))
    text = F.transform(F.array(lines), lambda all_lines: F.array_join(F.transform(staying, lambda no: all_lines[no]), "\n"))[0]
    whole = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(text)
    counts = [
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).cast("long").alias("n_removed"),
        F.coalesce("__runs", F.lit(0)).cast("long").alias("n_runs"),
    ]
    return joined.select(*[whole.alias("text") if c == "text" else F.col(f"`{c}`") for c in own], *counts)


def with_length(docs: DataFrame) -> DataFrame:
    """The documents with n_chars of their text, where they have such a column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs
