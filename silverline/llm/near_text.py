"""Groups of near-duplicate texts: SimHash tiles propose links, exact shingle similarity decides.

Distinct texts get 128-bit fingerprints of their sets of 5-word shingles, the same sets that decide,
so repeats inside a text weigh nothing. Texts whose sets
have a similarity of at least s have set sizes within that ratio, so tiles are size classes, cut into
bands of population counts; tile pairs whose sizes or counts lie too far apart are never compared,
all others are, block against block, with exclusive-or and bit counts.

Fingerprints cannot tell 0.75 from 0.8, so each text also carries the parity of its shingles in 512
buckets. Two parities differ in no more buckets than the sets differ in shingles, so a pair whose
parities differ in more than the similarity allows has no link for certain; it is never proposed.

A large group would propose all its pairs. Instead every text proposes its few nearest unlinked
partners, nearest first; these are verified, groups merge, and the next round goes on behind the last
partner proposed, between different groups only, with more partners each time. A text is done when it
has no partner left, so no candidate pair between different groups stays untried, and a group of n
near copies costs in the order of n pairs.

Every round's tables are written to the shared folder and removed when the next round has its own, so
plans stay short and the driver keeps no more of a corpus than names of files.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import fresh, map_rows, pa_schema, store, stored
from silverline.llm.components import components
from silverline.llm.simhash import shingles
from silverline.session import remove_path

_PLACE = 57  # bits of a text's number; the distance stands above them
_PARITY = tuple(f"parity_{k}" for k in range(8))  # words of 64 buckets each


@dataclass(frozen=True)
class NearTexts:
    """Words in a shingle, similarity, bits of 128, bits and size for small sets, texts in a block, first round's partners.

    A bit is the majority over a set's hashes. At similarity 0.8 two sets differ in a bit with a
    probability of 0.15 to 0.16, or 20 bits with a deviation of 4, so 37 bits miss at most one link in
    ten thousand at the limit and fewer above it; unrelated texts come that close once in a million
    pairs. Of 4 shingles against 5, the smallest sets that can be near without being equal, ties make
    it 0.19, so sets below 5 shingles are compared within 42 bits.
    """

    words: int = 5
    similarity: float = 0.8
    radius: int = 37
    small_radius: int = 42
    small_size: int = 5
    block: int = 16_384
    partners: int = 2

    @property
    def band(self) -> int:
        return max(1, self.radius // 2)

    @property
    def most(self) -> int:
        return max(self.radius, self.small_radius)


def _prints(how: NearTexts) -> Callable[[], Callable[[list[dict]], list[dict]]]:
    def make() -> Callable[[list[dict]], list[dict]]:
        import numpy as np
        import xxhash

        digest = xxhash.xxh3_128_digest

        def one(row: dict) -> dict:
            parts = set(shingles(row["text"] or "", how.words))
            halves, parity = [0, 0], [0] * len(_PARITY)
            if parts:
                raw = np.frombuffer(b"".join(map(digest, parts)), dtype=np.uint8).reshape(len(parts), 16)
                ones = np.zeros(128, dtype=np.int64)
                for start in range(0, len(raw), 1 << 14):
                    ones += np.unpackbits(raw[start : start + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
                halves = np.packbits(2 * ones > len(raw)).view("<i8").tolist()
                buckets = np.bincount(raw[:, :2].copy().view("<u2").ravel() % (64 * len(_PARITY)), minlength=64 * len(_PARITY))
                parity = np.packbits(buckets % 2 == 1).view("<i8").tolist()
            return {"key": row["key"], "doc_id": row["doc_id"], "low": halves[0], "high": halves[1], "size": len(parts)} | dict(zip(_PARITY, parity, strict=True))

        return lambda rows: [one(row) for row in rows]

    return make


def _first(owner: object, key: object, count: int) -> object:
    """The places of the `count` smallest keys of each owner."""
    import numpy as np

    order = np.lexsort((key, owner))
    sorted_owner = owner[order]
    begins = np.concatenate([[True], sorted_owner[1:] != sorted_owner[:-1]]) if len(order) else np.zeros(0, dtype=bool)
    start = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < count]


def propose(left: tuple, right: tuple, same: bool, partners: int, how: NearTexts) -> tuple | None:
    """(ids, partners, places): the nearest partners in one block for the active texts of the other, both ways, behind their last partner.

    A block is its texts' columns, in the order of `_STATE`.
    """
    import numpy as np

    ids_a, low_a, high_a, size_a, root_a, after_a, *parity_a = left
    ids_b, low_b, high_b, size_b, root_b, after_b, *parity_b = right
    low_a, high_a, low_b, high_b = (x.view(np.uint64) for x in (low_a, high_a, low_b, high_b))
    found: list[tuple] = []
    # A large group makes nearly every pair of a strip a candidate, so strips are narrow.
    rows = max(1, (1 << 18) // max(1, len(ids_b)))
    for begin in range(0, len(ids_a), rows):
        part = slice(begin, begin + rows)
        bits = np.bitwise_count(low_a[part, None] ^ low_b[None, :]) + np.bitwise_count(high_a[part, None] ^ high_b[None, :])
        i, j = np.nonzero(bits <= how.most)
        d = bits[i, j].astype(np.int64)
        i = i + begin
        keep = root_a[i] != root_b[j]
        if same:
            keep &= i < j
        small, large = np.minimum(size_a[i], size_b[j]), np.maximum(size_a[i], size_b[j])
        keep &= small >= how.similarity * large - 1e-9
        keep &= d <= np.where(small < how.small_size, how.small_radius, how.radius)
        i, j, d = i[keep], j[keep], d[keep]
        apart = np.zeros(len(i), dtype=np.int64)
        for x, y in zip(parity_a, parity_b, strict=True):
            apart += np.bitwise_count(x.view(np.uint64)[i] ^ y.view(np.uint64)[j])
        # Sets of a and b shingles that are near differ in (a + b) (1 - s) / (1 + s) shingles at most.
        keep = apart * (1 + how.similarity) <= (size_a[i] + size_b[j]) * (1 - how.similarity) + 1e-6
        i, j, d = i[keep], j[keep], d[keep]
        for own, other, after in ((ids_a[i], ids_b[j], after_a[i]), (ids_b[j], ids_a[i], after_b[j])):
            key = (d << _PLACE) | other
            open_ = key > after
            own, other, key = own[open_], other[open_], key[open_]
            best = _first(own, key, partners)
            found.append((own[best], other[best], key[best]))
    if not found:
        return None
    own, other, key = (np.concatenate(column) for column in zip(*found, strict=True))
    best = _first(own, key, partners)
    return own[best], other[best], key[best]


def _kept(frame: DataFrame) -> DataFrame:
    return stored(frame, "merging")


_STATE = ("id", "low", "high", "size", "root", "after", *_PARITY)
_DONE = (1 << 63) - 1


def _proposals(nodes: DataFrame, partners: int, how: NearTexts) -> tuple[str, DataFrame]:
    """(id, partners), stored: the nearest open partners of each active text, with their places in its order."""
    grade = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / math.log(1 / how.similarity) + 1e-9).cast("int")
    count = F.bit_count("low") + F.bit_count("high")
    tiled = nodes.select(*_STATE, grade.alias("grade"), F.floor(count / how.band).cast("int").alias("band"))
    sizes = tiled.groupBy("grade", "band").agg(F.ceil(F.count("*") / how.block).cast("int").alias("blocks"))
    blocks = (
        tiled.join(sizes, ["grade", "band"])
        .groupBy("grade", "band", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
        .agg(F.collect_list(F.struct(*_STATE)).alias("texts"), F.min("after").alias("open"))
    )
    path, blocks = store(blocks, "blocks")
    # Bands differ by two or three at most within the radius; of a step and its reverse only one is taken.
    reach = how.most // how.band + 1
    steps = [(g, b) for g in (0, 1) for b in range(-reach, reach + 1) if (g, b) >= (0, 0)]
    moves = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(b).alias("b")) for g, b in steps])
    left = blocks.withColumn("move", F.explode(moves)).select(
        (F.col("grade") + F.col("move.g")).alias("grade"), (F.col("band") + F.col("move.b")).alias("band"),
        ((F.col("move.g") == 0) & (F.col("move.b") == 0)).alias("home"), F.col("block").alias("left_block"), F.col("texts").alias("left"), F.col("open").alias("left_open"),
    )
    right = blocks.select("grade", "band", F.col("block").alias("right_block"), F.col("texts").alias("right"), F.col("open").alias("right_open"))
    pairs = (
        left.join(right, ["grade", "band"])
        .filter("not home or left_block <= right_block")
        .filter((F.col("left_open") < _DONE) | (F.col("right_open") < _DONE))
        .select("left", "right", (F.col("home") & (F.col("left_block") == F.col("right_block"))).alias("same"))
    )

    out = pa_schema(nodes.sparkSession, "id long, other long, key long")

    def columns(texts: pa.ListScalar) -> tuple:
        # Straight from Arrow: a block never becomes Python objects.
        return tuple(column.to_numpy(zero_copy_only=False) for column in texts.values.flatten())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                made = propose(columns(row["left"][0]), columns(row["right"][0]), row["same"][0].as_py(), partners, how)
                if made is not None and len(made[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in made], schema=out)

    found = pairs.mapInArrow(run, "id long, other long, key long")
    ordered = F.array_sort(F.collect_list(F.struct("key", "other")))
    proposed = store(found.groupBy("id").agg(F.slice(ordered, 1, partners).alias("partners")), "proposed")
    remove_path(nodes.sparkSession, path)
    return proposed


def _sets(texts: DataFrame, how: NearTexts) -> DataFrame:
    """(id, shingles): the sorted 64-bit hashes of each text's distinct shingles, as bytes."""

    def make() -> Callable[[list[dict]], list[dict]]:
        import numpy as np
        import xxhash

        def one(row: dict) -> dict:
            hashes = {xxhash.xxh3_64_intdigest(s) for s in shingles(row["text"] or "", how.words)}
            return {"id": row["id"], "shingles": np.array(sorted(hashes), dtype="<u8").tobytes()}

        return lambda rows: [one(row) for row in rows]

    return map_rows(texts, make, "id long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, how: NearTexts) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))

    def make() -> Callable[[list[dict]], list[dict]]:
        import numpy as np

        def good(row: dict) -> bool:
            x, y = np.frombuffer(row["x"], dtype="<u8"), np.frombuffer(row["y"], dtype="<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            joint = len(x) + len(y) - both
            return not joint or both >= how.similarity * joint - 1e-9

        return lambda rows: [{"a": row["a"], "b": row["b"]} for row in rows if good(row)]

    return map_rows(pairs.join(left, "a").join(right, "b"), make, "a long, b long")


def near_groups(docs: DataFrame, how: NearTexts | None = None) -> DataFrame:
    """(key, doc_id, group): for each distinct text its key (MD5 of the text), smallest id and group.

    Copies are one text however many there are. NULL text counts as empty; texts without words are
    one group; NULL ids sort last; an empty table gives no rows.
    """
    how = how or NearTexts()
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    carried = ("low", "high", "size", *_PARITY)
    prints = map_rows(keyed, _prints(how), "key binary, doc_id long, " + ", ".join(f"{c} long" for c in carried))
    distinct = prints.groupBy("key").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in carried])
    _, texts = store(distinct.withColumn("id", F.monotonically_increasing_id()), "texts")
    state = texts.select("id", *carried, F.col("id").alias("root"), F.lit(-1).cast("long").alias("after"))
    old, sets = None, None
    # Families whose members resemble each other without being near propose in vain; each round
    # offers more partners, so rounds are the logarithm of the largest such family.
    partners = how.partners
    while True:
        path, proposed = _proposals(state, partners, how)
        if proposed.isEmpty():
            break
        if sets is None:
            # Partners are mutual: whoever takes part in any round proposes in the first. Of the copies
            # of a text the one with the smallest id gives the set; rows repeated whole remain.
            needed = proposed.select("id").join(texts.select("id", F.col("key").alias("k"), F.col("doc_id").alias("d")), "id")
            chosen = keyed.join(needed, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("id", "text")
            _, sets = store(_sets(chosen, how).dropDuplicates(["id"]), "sets")
        flat = proposed.select("id", F.explode("partners").alias("p")).select(
            F.least("id", "p.other").alias("a"), F.greatest("id", "p.other").alias("b")
        )
        links = stored(_verified(flat.distinct(), sets, how), "links")
        roots = state.select("id", "root")
        ends = links.join(roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a").join(
            roots.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b"
        )
        merged = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")), _kept)
        # A text that proposed fewer than it may is done; the others go on behind their last partner.
        full = F.size("partners") >= partners
        last = F.when(full, F.element_at("partners", -1)["key"]).otherwise(F.lit(_DONE))
        newer, state = store(
            state.join(merged.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left")
            .join(proposed.select("id", last.alias("last")), "id", "left")
            .select("id", *carried, F.coalesce("over", "root").alias("root"), F.coalesce("last", F.lit(_DONE)).alias("after")),
            "state",
        )
        for gone in (path, old):
            if gone:
                remove_path(spark, gone)
        old = newer
        if state.filter(F.col("after") < _DONE).isEmpty():
            break
        partners *= 8
    return texts.select("id", "key", "doc_id").join(state.select("id", F.col("root").alias("group")), "id").drop("id")


def keep_one_of_each(docs: DataFrame, how: NearTexts | None = None) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns: the one with the smallest id.

    Of repeated rows one stays. A group whose ids are all NULL keeps one row. Other columns may have
    any names.
    """
    from pyspark.sql.window import Window

    _, groups = store(near_groups(docs.select("doc_id", "text"), how), "groups")
    best = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("b"))
    key, again, chosen_key, chosen_id = fresh(docs, "key", "again", "chosen_key", "chosen_id")
    chosen = best.select(F.col("b.key").alias(chosen_key), F.col("b.doc_id").alias(chosen_id))
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    # By text and id: of a text that a third of the rows share only the copies with its smallest id meet.
    kept = keyed.join(chosen, (F.col(key) == F.col(chosen_key)) & F.col("doc_id").eqNullSafe(F.col(chosen_id)))
    only = Window.partitionBy(key, "doc_id").orderBy(F.lit(0))
    return kept.withColumn(again, F.row_number().over(only)).filter(F.col(again) == 1).select(*names)
