"""Exact top-k inner products from a bit-sliced index.

The index holds, for each block of rows and each attribute, one bitmap per bit of the quantised
attribute. The scores of all rows of a block against a query are bit slices too: a query component is
a sum of signed powers of two, so each of its digits adds the attribute's slices (or, for a negative
digit, their complements) at a shifted place, and carry-save adders on bitmaps put them together. The
largest rows are then selected from the most significant slice of the score downward; rows left at the
boundary are equal in all slices, and those with the smallest ids are taken, so results are exact.

Each block of queries meets each block of the index once, in a task that holds one of each; k rows a
query and block go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.common import map_rows, pa_schema, stored
from silverline.llm.vectors import matrix, whole_vectors

if TYPE_CHECKING:
    import numpy as np


@dataclass(frozen=True)
class TopK:
    """Quantisation of the attributes, results a query, rows of an index block, queries of a block."""

    scale: int = 256
    k: int = 5
    rows: int = 65_536
    queries: int = 64


def digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, sign) of signed binary digits, no two of them neighbours; they add up to the value."""
    place = 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            yield place, sign
            value -= sign
        value >>= 1
        place += 1


@dataclass
class Slices:
    """The bit slices of a block: attribute d of a row is low[d] plus the number that its bits spell."""

    count: int
    low: list[int]
    bits: list[list[np.ndarray]]
    flipped: list[list[np.ndarray]]

    @staticmethod
    def words(count: int) -> int:
        return -(-count // 64)

    @classmethod
    def pack(cls, x: np.ndarray) -> tuple[list[int], list[int], bytes]:
        """Lowest value and number of slices of each attribute, and all slices in a row."""
        import numpy as np

        low, widths, out = [], [], []
        for column in x.T:
            least = int(column.min())
            rest = (column - least).astype(np.uint64)
            width = int(rest.max()).bit_length()
            for place in range(width):
                raw = np.packbits((rest >> np.uint64(place)).astype(np.uint8) & 1, bitorder="little").tobytes()
                out.append(raw.ljust(8 * cls.words(len(x)), b"\0"))
            low.append(least)
            widths.append(width)
        return low, widths, b"".join(out)

    @classmethod
    def unpack(cls, count: int, low: list[int], widths: list[int], raw: bytes) -> Slices:
        import numpy as np

        every = np.frombuffer(raw, dtype="<u8").reshape(-1, cls.words(count))
        bits, at = [], 0
        for width in widths:
            bits.append([every[at + place] for place in range(width)])
            at += width
        return cls(count, low, bits, [[~b for b in slices] for slices in bits])

    def scores(self, query: list[int]) -> tuple[list[np.ndarray | None], int]:
        """Slices of the score of every row, least significant first, and what is to be added to all."""
        levels: list[list] = []
        constant = 0
        for value, low, bits, flipped in zip(query, self.low, self.bits, self.flipped):
            for place, sign in digits(value):
                # -v is its complement less the largest number of as many bits.
                constant += (low if sign > 0 else -(low + (1 << len(bits)) - 1)) << place
                while len(levels) < place + len(bits):
                    levels.append([])
                for j, bitmap in enumerate(bits if sign > 0 else flipped):
                    levels[place + j].append(bitmap)
        at = 0
        while at < len(levels):
            level = levels[at]
            if len(level) > 1 and at + 1 == len(levels):
                levels.append([])
            while len(level) > 2:
                a, b, c = level.pop(), level.pop(), level.pop()
                one = a ^ b
                level.append(one ^ c)
                levels[at + 1].append((a & b) | (one & c))
            if len(level) == 2:
                a, b = level
                levels[at] = [a ^ b]
                levels[at + 1].append(a & b)
            at += 1
        return [level[0] if level else None for level in levels], constant

    def top(self, query: list[int], k: int, leave_out: int | None) -> list[tuple[int, int]]:
        """(row, score) of the k largest scores; of equal ones the first rows. `leave_out` takes no part."""
        import numpy as np

        slices, constant = self.scores(query)
        open_ = np.frombuffer(np.packbits(np.ones(self.count, dtype=np.uint8), bitorder="little").tobytes().ljust(8 * self.words(self.count), b"\0"), dtype="<u8").copy()
        if leave_out is not None:
            open_[leave_out // 64] &= ~np.uint64(1 << leave_out % 64)
        sure = np.zeros_like(open_)
        for bitmap in reversed(slices):
            if bitmap is None:
                continue
            ahead = sure | (open_ & bitmap)
            count = int(np.bitwise_count(ahead).sum())
            if count > k:
                open_ &= bitmap
            else:
                sure, open_ = ahead, open_ & ~bitmap
                if count == k:
                    break
        rows = _first_bits(sure, k)
        rows += _first_bits(open_, k - len(rows))
        return [(row, constant + sum(1 << j for j, b in enumerate(slices) if b is not None and int(b[row // 64]) >> row % 64 & 1)) for row in rows]


def _first_bits(bitmap: np.ndarray, count: int) -> list[int]:
    import numpy as np

    found: list[int] = []
    if count > 0:
        for word in np.flatnonzero(bitmap)[:count].tolist():
            value = int(bitmap[word])
            while value and len(found) < count:
                found.append(word * 64 + (value & -value).bit_length() - 1)
                value &= value - 1
    return found


def bit_sliced(vectors: DataFrame, blocks: int) -> DataFrame:
    """The index over (row, vec_id, x): one row a block, its vectors in the order of their ids (NULL last)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"block long, row_ids array<long>, vec_ids array<{kind}>, low array<long>, widths array<int>, slices binary"
    out = pa_schema(vectors.sparkSession, schema)
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    placed = dealt.repartition(blocks, "block").sortWithinPartitions("block", F.col("vec_id").asc_nulls_last(), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def made(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            width = max(matrix(part["x"]).shape[1] for part in parts)
            low, widths, raw = Slices.pack(np.concatenate([matrix(part["x"], width) for part in parts]))
            ids = {name: [v for part in parts for v in part[name].to_pylist()] for name in ("row", "vec_id")}
            row = {"block": block, "row_ids": ids["row"], "vec_ids": ids["vec_id"], "low": low, "widths": widths, "slices": raw}
            return pa.RecordBatch.from_pylist([row], schema=out)

        block, parts = None, []
        for batch in batches:
            names = batch["block"].to_numpy()
            begins = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for begin, end in zip(begins, begins[1:]):
                if end > begin:
                    if parts and names[begin] != block:
                        yield made(block, parts)
                        parts = []
                    block = int(names[begin])
                    parts.append(batch.slice(begin, end - begin))
        if parts:
            yield made(block, parts)

    return placed.mapInArrow(run, schema)


def top_k(vectors: DataFrame, chosen: Column, how: TopK | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the largest inner products for each chosen row.

    Every row of (vec_id, embedding) but the query's own is a candidate, repeated rows included; of
    equal scores the smaller vec_id goes first, NULL last. Vectors that are NULL or hold NULL or
    non-finite components take no part; missing components of shorter vectors count as zero. Scores
    must fit 64 bits. Other columns are not read; an empty table gives no rows.
    """
    how = how or TopK()
    numbered = whole_vectors(vectors, how.scale).withColumn("row", F.monotonically_increasing_id())
    whole = stored(numbered, "vectors")
    asked = whole.filter(F.coalesce(chosen, F.lit(False)))
    index_blocks = max(1, -(-whole.count() // how.rows))
    query_blocks = max(1, -(-asked.count() // how.queries))
    index = stored(bit_sliced(whole, index_blocks), "bit-slices")
    queries = asked.groupBy(F.pmod(F.xxhash64("row"), F.lit(query_blocks)).alias("asked")).agg(
        F.collect_list(F.struct("row", "vec_id", "x")).alias("queries")
    )
    kind = vectors.schema["vec_id"].dataType.simpleString()
    pairs = index_blocks * query_blocks
    left = index.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).withColumn("asked", F.col("asked").cast("long"))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    # A pair of blocks is some seconds of work in few bytes, so pairs are dealt out by number, not by size.
    met = left.repartition(pairs, "block", "asked").join(right.repartition(pairs, "block", "asked"), ["block", "asked"])

    def make():
        def work(rows: list[dict]) -> list[dict]:
            found = []
            for row in rows:
                slices = Slices.unpack(len(row["row_ids"]), row["low"], row["widths"], row["slices"])
                own = {number: at for at, number in enumerate(row["row_ids"])}
                for query in row["queries"]:
                    for at, score in slices.top(query["x"], how.k, own.get(query["row"])):
                        found.append(
                            {"asked_row": query["row"], "query_id": query["vec_id"], "row": row["row_ids"][at], "vec_id": row["vec_ids"][at], "score": score}
                        )
            return found

        return work

    found = map_rows(met, make, f"asked_row long, query_id {kind}, row long, vec_id {kind}, score long", batch_bytes=1)
    best = Window.partitionBy("asked_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= how.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
