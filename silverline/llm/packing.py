"""Best-fit packing: documents become token pieces, and pieces fill sequences of a fixed length.

Pieces as long as a sequence fill one each. The others, at most one for each document, are dealt
into groups of a bounded number of pieces; a group is packed best-fit decreasing, where a segment
tree over remaining capacities finds the tightest open sequence in logarithmic time. A group wastes
less than its last sequence, so thousands of pieces a group lose nothing that can be measured.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut, map_rows, pa_schema

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@dataclass(frozen=True)
class Packing:
    """Sequence length, the id that ends a document, where the tokenizer lies, and pieces in a group."""

    tokenizer: str
    ranks: str
    pattern: str
    length: int = 1024
    end_id: int = 2
    group_pieces: int = 16_384


class _Ids(dict):
    """Token ids of text segments as little-endian bytes, kept while a task meets them again."""

    LIMIT = 2_000_000

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> bytes:
        ids = self.encode(segment)
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(segment) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[segment] = found
        return found


def encoder(how: Packing) -> Callable[[str], bytes]:
    """Text to ids, as the tokenizers file gives them with add_special_tokens=False.

    No token spans the place before a single space that follows a visible character, so a text is
    split there and segments met before are looked up. Segments are encoded by the same vocabulary
    in rank form, which costs a tenth per call; tests hold both against each other. Two kinds of texts
    are encoded whole by the file itself: those with two spaces in a row, since a token may hold both,
    and those that spell a token added to the vocabulary, which the file gives as that token.
    """
    import base64
    import json
    import re

    import tiktoken

    with open(how.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(how.tokenizer, encoding="utf-8") as file:
        added = [token["content"] for token in json.load(file).get("added_tokens", [])]
    special = re.compile("|".join(map(re.escape, ["  ", *added])))
    plain = tiktoken.Encoding("bytes", pat_str=how.pattern, mergeable_ranks=ranks, special_tokens={})
    known = _Ids(plain.encode_ordinary)

    def encode(text: str) -> bytes:
        if special.search(text):
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(how.tokenizer) if "whole" not in known.__dict__ else known.whole
            known.whole = whole
            ids = whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        first, *rest = text.split(" ")
        return known[first] + b"".join(map(known.__getitem__, map(" ".__add__, rest)))

    return encode


def cut_points(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only longer documents are cut, and only the first piece may be short."""
    if total <= length:
        return [(0, total)]
    first = total % length
    starts = ([0] if first else []) + list(range(first, total, length))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], total], strict=True)]


def pieces(docs: DataFrame, how: Packing) -> DataFrame:
    """One row per piece: where it starts in its document, its length and the CRC-32 of its ids."""

    def make() -> Callable[[list[dict]], list[dict]]:
        encode = encoder(how)
        end = struct.pack("<I", how.end_id)

        def work(rows: list[dict]) -> list[dict]:
            out = []
            for row in rows:
                ids = encode(row["text"] or "") + end
                for number, (start, length) in enumerate(cut_points(len(ids) // 4, how.length)):
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    out.append({"doc_id": row["doc_id"], "piece": number, "start": start, "length": length, "ids_crc32": crc})
            return out

        return work

    return map_rows(docs.select("doc_id", "text"), make, _PIECES)


class OpenSequences:
    """A segment tree over remaining capacities 0..length: a leaf counts open sequences with that much room."""

    def __init__(self, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.waiting: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.waiting[room].append(sequence)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) of the tightest open sequence with at least that much room."""
        node = least + self.size
        if not self.count[node]:
            # Up to the first right sibling with an open sequence, then down to its smallest leaf.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.waiting[room].pop()


def best_fit_decreasing(lengths: list[int], length: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; pieces are placed longest first, each in the tightest open sequence."""
    tree, opened = OpenSequences(length), 0
    places = [(0, 0)] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        got = tree.take(lengths[item])
        if got is None:
            got = (length, opened)
            opened += 1
        room, sequence = got
        places[item] = (sequence, length - room)
        if room > lengths[item]:
            tree.add(room - lengths[item], sequence)
    return places


def pack(docs: DataFrame, how: Packing) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    Only numbers are shuffled, never text or ids. Groups are dealt by position in the stored table
    of pieces, so no id, length or source can make one group larger than another. Sequence ids are
    (group, sequence) in one number. NULL text counts as empty (its end id is its only token); a
    NULL id stays NULL; repeated rows are packed each; an empty table gives no rows; columns other
    than doc_id and text are not looked at.
    """
    stored = cut(pieces(docs, how))
    per_task = stored.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count_if(F.col("length") < how.length).alias("open"), F.count("*").alias("all")
    )
    # One number from the driver: how many groups there are.
    open_pieces = per_task.agg(F.sum("open")).first()[0] or 0
    groups = max(1, -(-open_pieces // how.group_pieces))
    numbered = stored.withColumn("row", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") >= how.length).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.filter(F.col("length") < how.length).withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    out = pa_schema(docs.sparkSession, _PLACED)

    def place(group: pa.Table) -> pa.Table:
        # The order within a group is fixed by the pieces themselves, then by their place in the stored table.
        group = group.sort_by([("length", "descending"), ("row", "ascending")])
        places = best_fit_decreasing(group["length"].to_pylist(), how.length)
        base = group["group"][0].as_py() << 32
        columns = {name: group[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
        columns["sequence_id"] = pa.array([base + s for s, _ in places], pa.int64())
        columns["offset"] = pa.array([o for _, o in places], pa.int64())
        return pa.table(columns, schema=out)

    packed = rest.groupBy("group").applyInArrow(lambda group: place(group), _PLACED)
    return full.unionByName(packed)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: its pieces in order and its number of tokens."""
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length"))).alias("pieces"),
    )


def public_packing(**settings: object) -> Packing:
    """The packing with the public byte-level vocabulary of this machine."""
    import public_tokenizers as tokenizers

    return Packing(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, **settings)


__all__ = ["Iterator", "OpenSequences", "Packing", "best_fit_decreasing", "cut_points", "pack", "pieces", "public_packing", "sequences"]
