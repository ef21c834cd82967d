"""Repeated byte strings, found by a distributed suffix array over content-chosen suffixes.

A string of `length` bytes that starts anywhere else too is removed wherever it occurs. Sorting the
suffixes at every byte would move `length` times the corpus, so suffixes are chosen by content: each
window of `length` bytes names one anchor among its first `choices` bytes, the place whose next few
bytes have the smallest hash (the first of equal ones). Equal windows name the same place, so two
windows can only be equal if the suffixes at their anchors begin alike.

1. Every anchor is a record: the hash of its leading bytes, the hash of its whole context (the union
   of its windows), and where it lies. Leading bytes that occur once are done with.
2. Records whose whole contexts agree are repeats, byte for byte, without moving text.
3. Where leading bytes agree and contexts differ, each distinct context is sent once. Sampled
   splitters range-partition these suffixes by their leading bytes; each bucket sorts its suffixes by
   multikey quicksort and resolves the windows inside it. Splitters only part suffixes with equal
   leading bytes where their contexts are too many bytes for one bucket. There, a window can go on in
   a neighbour if its part behind the anchor is a common prefix with the bucket's first or last
   suffix; such windows go to a comparison across boundaries.
4. Documents take their repeated windows back, and what no window covers is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import pa_schema, slices
from silverline.session import scratch_path


@dataclass(frozen=True)
class Repeats:
    """Bytes in a repeated string, places an anchor is chosen from, bytes hashed to choose it."""

    length: int = 400
    choices: int = 320
    gram: int = 16

    @property
    def lead(self) -> int:
        """Bytes after an anchor that lie in all of its windows."""
        return self.length - self.choices + 1

    @property
    def sorted_bytes(self) -> int:
        """Leading bytes by which suffixes are dealt where many share a start: twice those, so that what follows deals them."""
        return 2 * self.lead


# Window starts whose anchors are chosen at once.
_CHUNK = 1 << 20
_LOW = (1 << 24) - 1

_ANCHORS = "key binary, lo int, off int, size int, lead long, body long"
_SPAN = "array<struct<s:int, e:int>>"
_CHECKED = f"doc_id long, key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary, known {_SPAN}, mixed array<struct<lo:int, off:int, size:int, lead:long, body:long>>"
_CONTEXTS = "lead long, body long, n long, off int, context binary"
_RESOLVED = "lead long, body long, s int, e int, h1 long, h2 long, open boolean"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def choose(raw: object, how: Repeats) -> Iterator[tuple[int, int, int]]:
    """(anchor, first window start, last window start) over all windows of a text, given as an array of bytes."""
    import numpy as np

    windows = len(raw) - how.length + 1
    for begin in range(0, windows, _CHUNK):
        n = min(_CHUNK, windows - begin)
        part = raw[begin : begin + n + how.choices - 1 + how.gram - 1]
        grams = np.lib.stride_tricks.sliding_window_view(part, how.gram)
        halves = np.ascontiguousarray(grams).view("<u8")
        h = halves[:, 0] * np.uint64(0x9E3779B97F4A7C15) + halves[:, 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # The place in the low bits makes the smallest value the first of equal hashes.
        h = (h & ~np.uint64(_LOW)) | np.arange(len(h), dtype=np.uint64)
        width = how.choices
        rows = -(-len(h) // width)
        padded = np.full(rows * width, np.uint64(2**64 - 1))
        padded[: len(h)] = h
        padded = padded.reshape(rows, width)
        forward = np.minimum.accumulate(padded, axis=1).ravel()
        backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(backward[:n], forward[width - 1 : width - 1 + n])
        anchor = (least & np.uint64(_LOW)).astype(np.int64) + begin
        first = np.nonzero(np.diff(anchor, prepend=-1))[0]
        last = np.append(first[1:], n) - 1
        yield from zip(anchor[first].tolist(), (first + begin).tolist(), (last + begin).tolist(), strict=True)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _anchor_records(docs: DataFrame, how: Repeats) -> DataFrame:
    out = pa_schema(docs.sparkSession, _ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = [[], [], [], [], [], []]
                for key, raw in zip(part["key"].to_pylist(), part["raw"].to_pylist(), strict=True):
                    if raw is None or len(raw) < how.length:
                        continue
                    for anchor, lo, hi in choose(np.frombuffer(raw, dtype=np.uint8), how):
                        rows[0].append(key)
                        rows[1].append(lo)
                        rows[2].append(anchor - lo)
                        rows[3].append(hi - lo + 1)
                        rows[4].append(_signed(digest(raw[anchor : anchor + how.lead], 1)))
                        rows[5].append(_signed(digest(raw[lo : hi + how.length], anchor - lo)))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, out, strict=True)], schema=out)

    return docs.select("key", "raw").mapInArrow(run, _ANCHORS)


def covered(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges that the windows starting in the given inclusive ranges cover."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e + length))
        else:
            out.append((s, e + length))
    return out


def _kept(raw: bytes, starts: list[tuple[int, int]], length: int) -> dict:
    import hashlib

    digest, at, removed = hashlib.sha256(), 0, 0
    spans = covered(starts, length)
    for s, e in spans:
        digest.update(raw[at:s])
        removed += e - s
        at = e
    digest.update(raw[at:])
    return {"n_bytes": len(raw), "n_removed": removed, "n_spans": len(spans), "kept_sha256": digest.hexdigest()}


def _check(joined: DataFrame, how: Repeats) -> DataFrame:
    """Final results of documents whose anchors are all decided; text and anchors of the others."""
    out = pa_schema(joined.sparkSession, _CHECKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for row in part.to_pylist():
                    raw, anchors = row["raw"] or b"", row["anchors"] or []
                    known = [(a["lo"], a["lo"] + a["size"] - 1) for a in anchors if not a["mixed"]]
                    mixed = [a for a in anchors if a["mixed"]]
                    done = {} if mixed else _kept(raw, known, how.length)
                    rows.append(
                        {"doc_id": row["doc_id"], "key": row["key"], "text": raw if mixed else None, "mixed": mixed or None}
                        | {"known": [{"s": s, "e": e} for s, e in known] if mixed else None, **done}
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return joined.mapInArrow(run, _CHECKED)


def _contexts(waiting: DataFrame, how: Repeats) -> DataFrame:
    """Each distinct context once, with how often it occurs. A task sends a context only the first time it meets it."""
    out = pa_schema(waiting.sparkSession, _CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(batch):
                rows = []
                for row in part.to_pylist():
                    raw = row["text"]
                    for a in row["mixed"]:
                        name = (a["lead"], a["body"])
                        context = None if name in sent else raw[a["lo"] : a["lo"] + a["size"] - 1 + how.length]
                        sent.add(name)
                        rows.append({"lead": name[0], "body": name[1], "n": 1, "off": a["off"], "context": context})
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=out)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    found = waiting.select("text", "mixed").mapInArrow(run, _CONTEXTS)
    counts = found.groupBy("lead", "body").agg(F.sum("n").alias("n"), F.first("off").alias("off"), F.first("context", ignorenulls=True).alias("context"))
    return counts


def multikey_order(tokens: object) -> object:
    """The order of rows of tokens by multikey quicksort: three ways by one token, then the equal ones by the next."""
    import numpy as np

    order: list = []
    stack = [(np.arange(len(tokens)), 0)]
    while stack:
        rows, depth = stack.pop()
        if depth == tokens.shape[1] or len(rows) < 2:
            order.append(rows)
            continue
        if len(rows) <= 64:
            order.append(rows[np.lexsort(tokens[rows, depth:].T[::-1])])
            continue
        column = tokens[rows, depth]
        pivot = np.partition(column, len(column) // 2)[len(column) // 2]
        less, more = column < pivot, column > pivot
        stack += [(rows[more], depth), (rows[~less & ~more], depth + 1), (rows[less], depth)]
    return np.concatenate(order) if order else np.arange(0)


def _prefix_sums(data: object, base: int) -> tuple[object, object]:
    import numpy as np

    powers = np.cumprod(np.full(len(data) + 1, base, dtype=np.uint64))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return sums, powers


def _window_prints(data: object, places: object, length: int) -> tuple[object, object]:
    """Two 64-bit fingerprints of the windows of `length` bytes at the given places."""
    import numpy as np

    found = []
    for base in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95):
        sums, powers = _prefix_sums(data, base)
        inverse = np.cumprod(np.full(len(data) + 1, pow(base, -1, 1 << 64), dtype=np.uint64))
        h = (sums[places + length] - sums[places]) * inverse[places]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        found.append(h ^ (h >> np.uint64(29)))
        del sums, powers, inverse
    return found[0], found[1]


def resolve_bucket(
    lead: list, body: list, n: list, off: list, contexts: list[bytes], how: Repeats, begun: bool = False, goes_on: bool = False, wide: list[bool] | None = None
) -> pa.Table:
    """Repeated windows of a bucket's classes, and what it sends to the comparison across boundaries.

    That is each different window that may go on in a neighbour, once; those that the bucket itself
    found repeated only bear witness for others and are not open. Splitters never part suffixes with
    equal sorted bytes; `begun` and `goes_on` say that the bucket was cut out of one that held more,
    where they may be parted. `wide` marks the classes whose leading bytes other buckets may have too
    (all unless given).
    """
    import numpy as np

    count = len(contexts)
    sizes = np.array([len(c) - how.length + 1 for c in contexts])
    starts = np.cumsum([0, *(len(c) for c in contexts)])
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    # Suffixes by their leading bytes, eight in a token.
    depth = how.sorted_bytes
    width = -(-depth // 8) * 8
    heads = b"".join(c[o : o + depth].ljust(width, b"\0") for c, o in zip(contexts, off, strict=True))
    tokens = np.frombuffer(heads, dtype=">u8").reshape(count, width // 8).astype(np.uint64)
    order = multikey_order(tokens)
    letters = np.frombuffer(heads, dtype=np.uint8).reshape(count, width)[:, :depth]
    # Bytes behind the anchor that a class may share with a suffix of a neighbour.
    shared = np.zeros(count, dtype=np.int64)
    for edge_row, parted in ((order[0], begun), (order[-1], goes_on)):
        differs = letters != letters[edge_row]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), how.length if parted else depth - 1)
        shared = np.maximum(shared, common)
    if wide is not None:
        shared[~np.array(wide, dtype=bool)] = 0
    owner = np.repeat(np.arange(count), sizes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    h1, h2 = _window_prints(data, starts[owner] + inner, how.length)
    # Equal windows stand side by side once sorted; a class never holds a window twice.
    by = np.lexsort((h2, h1))
    equal = (h1[by][1:] == h1[by][:-1]) & (h2[by][1:] == h2[by][:-1])
    repeated = np.zeros(len(owner), dtype=bool)
    repeated[by[1:][equal]] = True
    repeated[by[:-1][equal]] = True
    repeated |= np.array(n)[owner] > 1
    leads = np.ones(len(owner), dtype=bool)
    leads[by[1:][equal]] = False
    lead_of, body_of = np.array(lead, dtype=np.int64), np.array(body, dtype=np.int64)
    # Runs of repeated windows inside a class.
    edge = repeated & np.concatenate([[True], ~repeated[:-1] | (owner[1:] != owner[:-1])])
    final = repeated & np.concatenate([~repeated[1:] | (owner[1:] != owner[:-1]), [True]])
    at, to = np.nonzero(edge)[0], np.nonzero(final)[0]
    behind = how.length - (np.array(off)[owner] - inner)
    border = np.nonzero((behind <= shared[owner]) & leads)[0]
    none = np.zeros(len(at), dtype=np.int64)
    rows = np.concatenate([at, border])
    missing = np.concatenate([np.ones(len(at), dtype=bool), np.zeros(len(border), dtype=bool)])
    return pa.table(
        {
            "lead": lead_of[owner[rows]],
            "body": body_of[owner[rows]],
            "s": pa.array(inner[rows], pa.int32()),
            "e": pa.array(inner[np.concatenate([to, border])], pa.int32()),
            "h1": pa.array(np.concatenate([none, h1[border].view(np.int64)]), pa.int64(), mask=missing),
            "h2": pa.array(np.concatenate([none, h2[border].view(np.int64)]), pa.int64(), mask=missing),
            "open": np.concatenate([np.zeros(len(at), dtype=bool), ~repeated[border]]),
        }
    )


# Context bytes that a task resolves at once. Leading bytes with more than half of it are wide: their suffixes may be parted.
_BUCKET = 8 << 20


def _resolve(classes: DataFrame, how: Repeats) -> DataFrame:
    out = pa_schema(classes.sparkSession, _RESOLVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], [], [], []]
        held, begun = 0, False

        def flush(goes_on: bool) -> Iterator[pa.RecordBatch]:
            if rows[0]:
                table = resolve_bucket(*rows[:5], how, begun, goes_on, rows[5]).select(out.names).cast(out)
                yield from table.to_batches(max_chunksize=1 << 16)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("lead", "body", "n", "off", "context", "wide")), strict=True):
                # Cut where the leading bytes change; wide ones anywhere.
                changes = bool(rows[0]) and rows[0][-1] != row[0]
                if held > _BUCKET // 2 if changes else held > _BUCKET and row[5]:
                    yield from flush(goes_on=not changes)
                    rows, held, begun = [[], [], [], [], [], []], 0, not changes
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
                held += len(row[4])
        yield from flush(goes_on=False)

    wide = classes.groupBy("lead").agg(F.sum(F.octet_length("context")).alias("bytes")).filter(F.col("bytes") > _BUCKET // 2)
    # At most one for each half bucket of contexts.
    marked = classes.join(F.broadcast(wide.select("lead", F.lit(True).alias("wide"))), "lead", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    start = F.expr(f"substring(context, off + 1, {how.lead})")
    more = F.when(F.col("wide"), F.expr(f"substring(context, off + 1 + {how.lead}, {how.sorted_bytes - how.lead})"))
    keyed = marked.withColumn("start", start).withColumn("more", more)
    bucketed = keyed.repartitionByRange("start", "more").sortWithinPartitions("start", "lead", "more").drop("start", "more")
    return bucketed.mapInArrow(run, _RESOLVED)


def _finish(waiting: DataFrame, how: Repeats) -> DataFrame:
    out = pa_schema(waiting.sparkSession, _RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for row in part.to_pylist():
                    starts = [(k["s"], k["e"]) for k in row["known"] or []]
                    starts += [(f["lo"] + r["s"], f["lo"] + r["e"]) for f in row["found"] or [] for r in f["spans"]]
                    rows.append({"doc_id": row["doc_id"], **_kept(row["text"], starts, how.length)})
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return waiting.select("doc_id", "text", "known", "found").mapInArrow(run, _RESULT)


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: compressed, and read by column."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path)


def remove_repeats(docs: DataFrame, how: Repeats | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document after repeated strings are removed.

    Strings are judged on the input: overlaps count, also within one document, and matches never
    cross documents. Equal texts share their anchors' records, so copies are aggregated and never
    paired. NULL text counts as empty; a NULL id stays NULL; repeated rows are documents of their
    own, so their strings repeat; an empty table gives no rows; columns other than doc_id and text
    are not looked at.
    """
    how = how or Repeats()
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw")).withColumn("key", F.unhex(F.md5("raw")))
    anchors = _stored(_anchor_records(texts, how), "anchors")
    leads = anchors.groupBy("lead").agg(F.count("*").alias("n"), F.min("body").alias("low"), F.max("body").alias("high")).filter("n > 1")
    # Stored, so that both sides of the join are plain exchanges, which Spark can split where a lead is frequent.
    leads = _stored(leads.select("lead", (F.col("low") != F.col("high")).alias("mixed")), "leads")
    shared = anchors.join(leads, "lead")
    lists = shared.groupBy("key").agg(F.collect_set(F.struct("lo", "off", "size", "lead", "body", "mixed")).alias("anchors"))
    checked = _stored(_check(texts.join(lists, "key", "left").select("doc_id", "key", "raw", "anchors"), how), "checked")
    done = checked.filter("mixed is null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    waiting = checked.filter("mixed is not null")
    resolved = _stored(_resolve(_stored(_contexts(waiting, how), "contexts"), how), "resolved")
    inside = resolved.filter("h1 is null").select("lead", "body", "s", "e")
    border = resolved.filter("h1 is not null")
    across = border.groupBy("h1", "h2").agg(F.count("*").alias("buckets")).filter("buckets > 1").select("h1", "h2")
    found = inside.unionByName(border.filter("open").join(across, ["h1", "h2"], "left_semi").select("lead", "body", "s", "e"))
    # Stored as leads are: a common passage is one class with a place in every document that holds it.
    spans = _stored(found.groupBy("lead", "body").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    places = waiting.select("key", F.explode("mixed").alias("m")).select("key", "m.lo", "m.lead", "m.body").distinct()
    by_text = places.join(spans, ["lead", "body"]).groupBy("key").agg(F.collect_list(F.struct("lo", "spans")).alias("found"))
    return done.unionByName(_finish(waiting.join(by_text, "key", "left"), how))
