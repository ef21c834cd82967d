"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has 64 bits, each decided by the majority of its shingle hashes. Distinct
fingerprints are dealt into tiles by the population counts of their four 16-bit lanes. Two
fingerprints within a radius differ by no more than it in the sum of lane count differences, so tile
pairs beyond that are never compared; all others are compared exactly, with exclusive-or and bit
counts, block against block. A block pair emits a spanning forest of its links, never all pairs of a
group, which keeps every component whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut, map_rows
from silverline.llm.components import components


@dataclass(frozen=True)
class SimHash:
    """Words in a shingle, seed of its XXH64, bits two linked fingerprints may differ in, fingerprints in a block."""

    words: int = 3
    seed: int = 42
    radius: int = 2
    block: int = 4096


def shingles(text: str, words: int) -> list[bytes]:
    """All word shingles, repeats included, A-Z lower-cased; fewer words than a shingle give the whole sequence."""
    found = text.encode().lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    joined = b" ".join(found)
    ends = list(itertools.accumulate(map(len, found), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    return [joined[start:end] for start, end in zip(starts, ends[words - 1 :], strict=False)]


def fingerprint(text: str, how: SimHash) -> int:
    """Unsigned; zero for a text without words."""
    import numpy as np
    import xxhash

    digest, seed = xxhash.xxh64_intdigest, how.seed
    found = shingles(text, how.words)
    if not found:
        return 0
    hashes = np.fromiter((digest(s, seed) for s in found), dtype="<u8", count=len(found))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, how: SimHash) -> DataFrame:
    """(doc_id, fp) of every document; fp holds the 64 bits as a signed number."""

    def make() -> Callable[[list[dict]], list[dict]]:
        def one(row: dict) -> dict:
            bits = fingerprint(row["text"] or "", how)
            return {"doc_id": row["doc_id"], "fp": bits - (1 << 64) if bits >> 63 else bits}

        return lambda rows: [one(row) for row in rows]

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, fp long")


def _lanes(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * lane).bitwiseAND(F.lit(0xFFFF))) for lane in range(4)]


def _number(lanes: list[Column]) -> Column:
    total = F.lit(0)
    for lane in lanes:
        total = total * 17 + lane
    return total.cast("int")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Lane count differences within the radius; of a step and its reverse only one, so tile pairs meet once."""
    every = itertools.product(range(-radius, radius + 1), repeat=4)
    return [step for step in every if sum(map(abs, step)) <= radius and step >= (0, 0, 0, 0)]


def forest(left: object, right: object, radius: int) -> tuple[list[int], list[int]]:
    """(fingerprint, smaller linked fingerprint) pairs that span the links between two arrays (or within one, given twice)."""
    import numpy as np

    a, b = np.asarray(left, dtype=np.int64), np.asarray(right, dtype=np.int64)
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    in_a, in_b = where[: len(a)], where[len(a) :]
    bits_a, bits_b = a.view(np.uint64), b.view(np.uint64)
    label = np.arange(len(nodes))
    rows = max(1, (1 << 20) // max(1, len(b)))
    for start in range(0, len(a), rows):
        near = np.bitwise_count(bits_a[start : start + rows, None] ^ bits_b[None, :]) <= radius
        i, j = np.nonzero(near)
        u, v = in_a[i + start], in_b[j]
        linked = u != v
        u, v = u[linked], v[linked]
        while len(u):
            low = np.minimum(label[u], label[v])
            np.minimum.at(label, label[u], low)
            np.minimum.at(label, label[v], low)
            while not np.array_equal(label, up := label[label]):
                label = up
            apart = label[u] != label[v]
            u, v = u[apart], v[apart]
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[moved].tolist(), nodes[label[moved]].tolist()


def tile_links(distinct: DataFrame, how: SimHash) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that span all pairs within the radius."""
    lanes = F.array(*_lanes(F.col("fp")))
    tiled = distinct.select("fp", lanes.alias("lanes"))
    # At most 17^4 tiles, however many fingerprints.
    sizes = tiled.groupBy("lanes").agg(F.ceil(F.count("*") / how.block).cast("int").alias("blocks"))
    blocked = (
        tiled.join(sizes, "lanes")
        .groupBy("lanes", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    blocks = cut(blocked.select(_number([F.col("lanes")[k] for k in range(4)]).alias("tile"), "lanes", "block", "fps"))
    steps = F.array(*[F.array(*[F.lit(d) for d in step]) for step in _steps(how.radius)])
    moved = [F.col("lanes")[k] + F.col("step")[k] for k in range(4)]
    inside = moved[0].between(0, 16) & moved[1].between(0, 16) & moved[2].between(0, 16) & moved[3].between(0, 16)
    left = (
        blocks.withColumn("step", F.explode(steps))
        .filter(inside)
        .select(F.col("tile").alias("of"), F.col("block").alias("left_block"), F.col("fps").alias("left"), _number(moved).alias("tile"))
    )
    right = blocks.select("tile", F.col("block").alias("right_block"), F.col("fps").alias("right"))
    pairs = left.join(right, "tile").filter("of <> tile or left_block <= right_block").select("left", "right")

    def make() -> Callable[[list[dict]], list[dict]]:
        def work(rows: list[dict]) -> list[dict]:
            out = []
            for row in rows:
                out += [{"a": a, "b": b} for a, b in zip(*forest(row["left"], row["right"], how.radius), strict=True)]
            return out

        return work

    return map_rows(pairs, make, "a long, b long")


def near_duplicates(docs: DataFrame, how: SimHash | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document: its fingerprint in hex and the smallest id it is linked to.

    Equal fingerprints are one node however many documents share them, so copies never multiply.
    NULL text counts as empty: fingerprint zero, linked like any other. A NULL id gets a fingerprint
    and the smallest known id of its group, NULL if there is none. Repeated rows each get a row; an
    empty table gives no rows; columns other than doc_id and text are not looked at.
    """
    how = how or SimHash()
    prints = cut(fingerprints(docs, how))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(tile_links(nodes.select("fp"), how))
    labelled = cut(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
