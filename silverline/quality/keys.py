"""Key discovery: distinct counts over column combinations.

Rows that agree in a combination agree in each of its columns, so rows are dealt once by a column without
large classes (a pivot), and all combinations with that column are counted where the rows are. A job deals
rows once a pivot, and its files go when it ends.

To count all combinations, columns leave one after the other, those with most values first, each as the
pivot of the combinations with the columns still left. A task parts its rows by one column more at a time;
rows that are alone in their class are alone in every larger combination, so each combination hands on
only the others. Once the columns left have few distinct rows, these stand for all rows. Numbers and
times are compared one to one, all else by 128 bits of hash.

The rest is for combinations of columns with large classes whose rows do not repeat, and for searches that
need few combinations. Every column is hashed to two 64-bit words; a combination's words are the
exclusive-or of its columns' words, so looking at one more combination costs two operations a row. Counts
are then exact up to collisions of 128 bits. Cells of rows and combinations without a pivot are combined
before they move. The lattice is walked upwards by size, and most of it is never counted on the rows:

- what follows from smaller combinations is not counted: one that contains a key has as many values as
  there are rows, and a column that the rest determines adds nothing;
- a combination that nearly identifies rows leaves few of them unsettled. Rows that are alone in their
  class stay alone in every larger combination, so those are counted on the unsettled rows only;
- a search for counts near a target first takes theta sketches: of every combination, the words in
  one slice of the hashes are counted, and the other words of a row never leave its projection. Counts
  only grow with columns, so a combination whose sketch lies above the target rules out all that contain
  it, and one whose sketch lies below it all that it contains; large ones of columns with few values
  are therefore sketched first. Exact counts are taken of what the bounds leave over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverline.session import scratch_path

# Fixed value: how far a count may be off to be a close match.
CLOSE = 5

# Combinations hashed by one projection of all rows; more are hashed side by side. A method for many more would be too long for the JVM to compile.
BATCH = 8
# A column can be a pivot if no value of it has more rows than this.
LARGE_CLASS = 100_000
# Cells of rows and columns, or of rows and combinations, that one task holds, about.
TASK_CELLS = 3_000_000
# Combinations without a pivot that one job counts, and rows that one job deals, about.
UNDEALT = 64
DEALT_ROWS = 40_000_000
# Types whose hash is that of the value.
NATIVE = {"byte", "short", "integer", "long", "double", "float", "date", "timestamp"}
# Distinct rows of the columns left stand for all rows if they are at most this share of them.
FEWER_SHARE = 0.25
# A combination is sharp if at most this share of the rows can be unsettled under it.
UNSETTLED_SHARE = 0.5
# Sketch size (log2 of words at the goal, about) and the deviations of its error that bounds allow for.
SKETCH, DEVIATIONS = 14, 5.0

Combo = tuple[str, ...]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _files_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are deleted when it ends, so that many queries need no more disk than one."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Hashed:
    """The rows, stored once; their columns are hashed to two words wherever they are read."""

    def __init__(self, df: DataFrame, names: Sequence[str]) -> None:
        self.names = list(names)
        self.place = {name: k for k, name in enumerate(self.names)}
        picked = df.select(*[self._hashable(df, name).alias(f"v{k}") for k, name in enumerate(self.names)])
        # Rows are looked at hundreds of times from here on, so those of few blocks are dealt over all cores once.
        cores = df.sparkSession.sparkContext.defaultParallelism
        self.values = _stored(picked.repartition(cores) if picked.rdd.getNumPartitions() < cores else picked, "rows")
        self.rows = self.worded(self.values)
        self.total = self.values.count()
        self.pivots: list[int] = []

    @staticmethod
    def _hashable(df: DataFrame, name: str) -> Column:
        """Numbers and times are hashed as they are, NULL unlike any of them; all else as text, NULL as empty text."""
        value = F.col(f"`{name}`")
        return value if df.schema[name].dataType.typeName() in NATIVE else F.coalesce(value.cast("string"), F.lit(""))

    def worded(self, rows: DataFrame, *carried: str) -> DataFrame:
        """Two words a column; the column's number goes into the hash, since equal values of two columns must not cancel out."""
        words = [F.xxhash64(F.lit(2 * k + w), F.col(f"v{k}")).alias(f"{'ab'[w]}{k}") for k in range(len(self.names)) for w in (0, 1)]
        return rows.select(*carried, *words)

    def dealt(self, rows: DataFrame, place: int, cells: int) -> DataFrame:
        """Rows by the values of a column, `p`, in parts whose cells one task can hold."""
        return rows.withColumn("p", F.xxhash64(F.col(f"v{place}"))).repartition(self.parts(cells), "p")

    def parts(self, cells: int) -> int:
        return max(self.values.sparkSession.sparkContext.defaultParallelism, -(-cells // TASK_CELLS))

    def by_pivot(self, combos: Sequence[tuple[int, Combo]]) -> dict[int | None, list[tuple[int, Combo]]]:
        """Combinations by the pivot they are counted along, the pivot with most of them first; None where there is none."""
        rest, parts = list(combos), {}
        while rest:
            having = {pivot: [(i, combo) for i, combo in rest if self.names[pivot] in combo] for pivot in self.pivots}
            best = max(having, key=lambda pivot: len(having[pivot]), default=None)
            if best is None or not having[best]:
                parts[None] = rest
                break
            parts[best] = having[best]
            rest = [(i, combo) for i, combo in rest if self.names[best] not in combo]
        return parts

    def bits(self, combo: Combo) -> int:
        return sum(1 << self.place[name] for name in combo)

    def structs(self, combos: Sequence[tuple[int, Combo]]) -> str:
        """SQL for an array of (number, h1, h2) of numbered combinations; as text it is built and parsed in one call."""

        def word(letter: str, combo: Combo) -> str:
            return " ^ ".join(f"{letter}{self.place[name]}" for name in combo)

        return f"array({', '.join(f"named_struct('number', {i}, 'h1', {word('a', combo)}, 'h2', {word('b', combo)})" for i, combo in combos)})"

    def cells(self, rows: DataFrame, combos: Sequence[tuple[int, Combo]], *carried: str) -> DataFrame:
        """(number, h1, h2, carried) for every row and numbered combination."""
        starts = range(0, len(combos), BATCH)
        return reduce(DataFrame.unionByName, [rows.selectExpr(*carried, f"inline({self.structs(combos[at : at + BATCH])})") for at in starts])


def _distinct(cells: DataFrame) -> DataFrame:
    """(number, n): distinct words of each combination. Cells dealt by `p` stay where they are; repeats of others are dropped before the shuffle."""
    return cells.distinct().groupBy("number").agg(F.count("*").alias("n"))


def _collected(counts: Sequence[DataFrame]) -> dict[int, int]:
    """One number per combination, found in one job."""
    if not counts:
        return {}
    with _files_go(counts[0].sparkSession):
        # Whether files go is settled when a query is built, so this is a new one even where one count is asked for.
        return {row["number"]: row["n"] for row in reduce(DataFrame.unionByName, counts).select("number", "n").collect()}


def _chunks(items: Sequence, size: int) -> list:
    return [items[at : at + size] for at in range(0, len(items), size)]


class _Known:
    """What is known about the lattice: counts, keys, and columns that others determine, as sets of bits."""

    def __init__(self, hashed: _Hashed) -> None:
        self.hashed = hashed
        self.counts: dict[int, int] = {}
        self.keys: list[int] = []
        self.determined: dict[int, list[int]] = {}

    def add(self, combo: int, n: int) -> None:
        self.counts[combo] = n
        if n == self.hashed.total and not any(key & combo == key for key in self.keys):
            self.keys.append(combo)
        for k in range(len(self.hashed.names)):
            column = 1 << k
            rest = combo & ~column
            if combo & column and rest and self.counts.get(rest) == n:
                found = self.determined.setdefault(column, [])
                if not any(part & rest == part for part in found):
                    found.append(rest)

    def implied(self, combo: int) -> int | None:
        """The count, if it follows from smaller combinations."""
        if any(key & combo == key for key in self.keys):
            return self.hashed.total
        for column, parts in self.determined.items():
            rest = combo & ~column
            if combo & column and rest in self.counts and any(part & rest == part for part in parts):
                return self.counts[rest]
        return None


class _Unsettled:
    """The rows that share their class, for the sharp combinations that larger ones need."""

    def __init__(self, hashed: _Hashed) -> None:
        self.hashed = hashed
        self.tables: list[DataFrame] = []
        # By sharp combination: its table, its number there, its rows.
        self.places: dict[int, tuple[int, int, int]] = {}

    def source(self, combo: int) -> int:
        """The sharp combination with the fewest unsettled rows inside this one, 0 if there is none."""
        inside = [(size, sharp) for sharp, (_, _, size) in self.places.items() if sharp & combo == sharp]
        return min(inside)[1] if inside else 0

    def add(self, sharp: Sequence[tuple[int, Combo]]) -> None:
        """Store the unsettled rows of combinations none of which contains an earlier one."""
        if not sharp:
            return
        numbered = [(i, combo) for i, (_, combo) in enumerate(sharp)]
        hashed, kept = self.hashed, []
        values = [f"v{k}" for k in range(len(hashed.names))]
        for pivot, along in hashed.by_pivot(numbered).items():
            for chunk in _chunks(along, BATCH):
                rows = hashed.values.withColumn("p", F.lit(0)) if pivot is None else hashed.dealt(hashed.values, pivot, 4 * len(chunk) * hashed.total)
                cells = hashed.cells(hashed.worded(rows, "p", *values), chunk, "p", *values)
                # A class of a sharp combination is small: most of its rows are alone.
                alike = F.count("*").over(Window.partitionBy(*(() if pivot is None else ("p",)), "number", "h1", "h2"))
                # Larger combinations agree in this one too, so its words say where they can be counted.
                kept.append(cells.withColumn("alike", alike).where("alike > 1").select(F.col("number").alias("sharp"), F.col("h1").alias("class"), *values))
        with _files_go(hashed.values.sparkSession):
            self.tables.append(_stored(reduce(DataFrame.unionByName, kept), "unsettled"))
            sizes = {row["sharp"]: row["n"] for row in self.tables[-1].groupBy("sharp").agg(F.count("*").alias("n")).collect()}
        for i, (bits, _) in enumerate(sharp):
            self.places[bits] = (len(self.tables) - 1, i, sizes.get(i, 0))

    def counts(self, table: int, combos: dict[int, list[tuple[int, Combo]]], sizes: dict[int, int]) -> DataFrame:
        """Distinct counts on the rows of each sharp combination, which are dealt by its classes."""
        cases = " ".join(f"when {number} then {self.hashed.structs(of)}" for number, of in combos.items())
        cells = sum(sizes[number] * len(of) for number, of in combos.items())
        rows = self.tables[table].where(F.col("sharp").isin(*combos)).withColumnRenamed("class", "p").repartition(self.hashed.parts(cells), "p")
        return _distinct(self.hashed.worded(rows, "p", "sharp").selectExpr("p", f"inline(case sharp {cases} end)"))


def _exact(hashed: _Hashed, unsettled: _Unsettled, combos: Sequence[Combo]) -> dict[Combo, int]:
    """Distinct counts of several combinations in one job, each on as few rows as known."""
    if not combos:
        return {}
    whole, settled = [], {}
    # By table and sharp combination there; the rows of each.
    parts: dict[int, list[tuple[int, tuple[int, Combo]]]] = {}
    sizes: dict[int, dict[int, int]] = {}
    for i, combo in enumerate(combos):
        sharp = unsettled.source(hashed.bits(combo))
        if not sharp:
            settled[i] = 0
            whole.append((i, combo))
            continue
        table, number, size = unsettled.places[sharp]
        settled[i] = hashed.total - size
        if size:
            parts.setdefault(table, []).append((number, (i, combo)))
            sizes.setdefault(table, {})[number] = size
    work: list[tuple[int, list[DataFrame]]] = []
    for pivot, along in hashed.by_pivot(whole).items():
        if pivot is None:
            work += [(hashed.total * len(chunk), [_distinct(hashed.cells(hashed.rows, chunk))]) for chunk in _chunks(along, UNDEALT)]
            continue
        # The same rows for all of them: they move once.
        rows = hashed.worded(hashed.dealt(hashed.values, pivot, BATCH * hashed.total), "p")
        work.append((hashed.total, [_distinct(hashed.cells(rows, chunk, "p")) for chunk in _chunks(along, BATCH)]))
    for table, of in parts.items():
        counts = []
        for chunk in _chunks(sorted(of), 4 * BATCH):
            by_sharp: dict[int, list[tuple[int, Combo]]] = {}
            for number, numbered in chunk:
                by_sharp.setdefault(number, []).append(numbered)
            counts.append(unsettled.counts(table, by_sharp, sizes[table]))
        work.append((sum(sizes[table].values()), counts))
    found: dict[int, int] = {}
    moved, job = 0, []
    for size, counts in work:
        if job and moved + size > DEALT_ROWS:
            found |= _collected(job)
            moved, job = 0, []
        moved, job = moved + size, job + counts
    found |= _collected(job)
    return {combo: settled[i] + found.get(i, 0) for i, combo in enumerate(combos)}


def _columns(hashed: _Hashed) -> dict[Combo, int]:
    """Distinct counts of the columns, each read alone; those without large classes become pivots."""
    counts = [
        hashed.values.groupBy(f"v{k}").agg(F.count("*").alias("rows")).agg(F.lit(k).alias("number"), F.count("*").alias("n"), F.max("rows").alias("largest"))
        for k in range(len(hashed.names))
    ]
    with _files_go(hashed.values.sparkSession):
        found = {row["number"]: row for row in reduce(DataFrame.unionByName, counts).collect() if row["n"]}
    hashed.pivots = sorted((k for k, row in found.items() if row["largest"] <= LARGE_CLASS), key=lambda k: -found[k]["n"])
    return {(name,): found[k]["n"] if k in found else 0 for k, name in enumerate(hashed.names)}


def _sharp(hashed: _Hashed, known: _Known, unsettled: _Unsettled, measured: dict[Combo, int], size: int) -> list[tuple[int, Combo]]:
    """Of the combinations just measured, those whose unsettled rows open combinations of the next size are counted on.

    n classes of N rows leave at most 2 (N - n) rows that share theirs.
    """
    sharp = {
        hashed.bits(combo): (hashed.total - n, combo)
        for combo, n in measured.items()
        if 2 * (hashed.total - n) <= UNSETTLED_SHARE * hashed.total and n < hashed.total and not unsettled.source(hashed.bits(combo))
    }
    wanted = set()
    for combo in combinations(hashed.names, size) if sharp else ():
        bits = hashed.bits(combo)
        inside = [(extra, part) for part, (extra, _) in sharp.items() if part & bits == part]
        if inside and known.implied(bits) is None and not unsettled.source(bits):
            wanted.add(min(inside)[1])
    return [(bits, sharp[bits][1]) for bits in sorted(wanted)]


def _walked(hashed: _Hashed, names: Sequence[str], most: int) -> dict[Combo, int]:
    """Distinct counts of the combinations of some columns, size by size; what smaller ones imply is not counted."""
    known, unsettled = _Known(hashed), _Unsettled(hashed)
    out: dict[Combo, int] = {}
    for size in range(1, min(most, len(names)) + 1):
        counted = []
        for combo in combinations(names, size):
            n = known.implied(hashed.bits(combo))
            if n is None:
                counted.append(combo)
            else:
                known.add(hashed.bits(combo), n)
                out[combo] = n
        measured = _exact(hashed, unsettled, counted)
        for combo, n in measured.items():
            known.add(hashed.bits(combo), n)
        out |= measured
        unsettled.add(_sharp(hashed, known, unsettled, measured, size + 1))
    return out


def _coded(words: Sequence[np.ndarray]) -> tuple[np.ndarray, int]:
    """Equal words as equal numbers below a width; several words of a value count together."""
    values, codes = np.unique(words[0], return_inverse=True)
    for word in words[1:]:
        others, more = np.unique(word, return_inverse=True)
        values, codes = np.unique(codes * len(others) + more, return_inverse=True)
    return codes, len(values)


def _parted(classes: np.ndarray, codes: np.ndarray, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Classes of rows parted by codes: their number, the places of rows that share theirs, and the classes of these."""
    keys = classes * width + codes
    place = len(keys).bit_length()
    if 3 * place < 64:
        # Key and place fit into one number, which is sorted faster.
        packed = np.sort(keys << place | np.arange(len(keys)))
        keys, order = packed >> place, packed & ((1 << place) - 1)
    else:
        order = np.argsort(keys)
        keys = keys[order]
    sizes = np.diff(np.flatnonzero(np.diff(keys, prepend=-1)), append=len(keys))
    shared = sizes > 1
    return len(sizes), order[np.repeat(shared, sizes)], np.repeat(np.arange(np.count_nonzero(shared)), sizes[shared])


def _with_first(columns: Sequence[tuple[int, np.ndarray, int]], most: int) -> Iterator[tuple[int, int]]:
    """(bits, distinct values) of the combinations of up to `most` columns that hold the first, over some rows; columns are (bit, codes, width)."""

    def larger(bits: int, size: int, at: int, end: int, alone: int, rows: np.ndarray, classes: np.ndarray) -> Iterator[tuple[int, int]]:
        for k in range(at, end):
            bit, codes, width = columns[k]
            n, kept, inner = _parted(classes, codes[rows], width) if len(rows) else (0, rows, classes)
            yield bits | bit, alone + n
            if size + 1 < most:
                settled = alone + n - (int(inner[-1]) + 1 if len(inner) else 0)
                yield from larger(bits | bit, size + 1, k + 1, len(columns), settled, rows[kept], inner)

    count = len(columns[0][1])
    yield from larger(0, 0, 0, 1, 0, np.arange(count), np.zeros(count, dtype=np.int64))


def _along(hashed: _Hashed, names: Sequence[str], most: int) -> DataFrame:
    """(number, n): distinct counts of the combinations of these columns that hold the first one, along which rows are dealt."""
    places = [hashed.place[name] for name in names]
    # Hashes of numbers and times are one to one; a second word is for texts only.
    words = [2 if hashed.values.schema[f"v{k}"].dataType.typeName() == "string" else 1 for k in places]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(part.num_rows for part in parts):
            return
        columns, at = [], 0
        for k, of in zip(places, words):
            columns.append((1 << k, *_coded([np.concatenate([part.column(i).to_numpy() for part in parts]) for i in range(at, at + of)])))
            at += of
        parts.clear()
        found = list(_with_first(columns, most))
        # Numbers of wide tables are too large for a long.
        yield pa.RecordBatch.from_arrays([pa.array([str(bits) for bits, _ in found]), pa.array([n for _, n in found], pa.int64())], ["number", "n"])

    # Dealt by the value itself: a hash beside it would be the one word that does not compress.
    rows = hashed.values.select(*[f"v{k}" for k in places]).repartition(hashed.parts(len(places) * hashed.total), f"v{places[0]}")
    hashes = [F.xxhash64(F.lit(2 * k + w), F.col(f"v{k}")).alias(f"{'ab'[w]}{k}") for k, of in zip(places, words) for w in range(of)]
    return rows.select(*hashes).mapInArrow(run, "number string, n long").groupBy("number").agg(F.sum("n").alias("n"))


def _rows_left(hashed: _Hashed, order: Sequence[str]) -> list[int]:
    """How many distinct rows the columns have from each one on, about."""
    rows, last = hashed.values, []
    for name in reversed(order):
        k = hashed.place[name]
        rows, last = rows.select("*", F.xxhash64(f"v{k}", *last).alias(f"h{k}")), [f"h{k}"]
    return list(rows.agg(*[F.approx_count_distinct(f"h{hashed.place[name]}") for name in order]).first())


def _all_counts(hashed: _Hashed, most: int) -> dict[int, int]:
    """Distinct counts of all combinations of up to `most` columns, which stand for their bits."""
    columns = _columns(hashed)
    pivots = [hashed.names[k] for k in hashed.pivots]
    order = pivots + [name for name in hashed.names if name not in pivots]
    # In a small table every column is a pivot.
    few = [n <= FEWER_SHARE * hashed.total for n in _rows_left(hashed, order)] if hashed.total > LARGE_CLASS else [False] * len(order)
    dealt = next((at for at, enough in enumerate(few) if enough or at == len(pivots)), len(order))
    found = {hashed.bits(combo): n for combo, n in columns.items()}
    for chunk in _chunks(range(dealt), max(1, DEALT_ROWS // max(1, hashed.total))):
        found |= {int(number): n for number, n in _collected([_along(hashed, order[at:], most) for at in chunk]).items()}
    rest = [name for name in hashed.names if name in order[dealt:]]
    if rest and few[dealt] and hashed.total:
        fewer = _Hashed(hashed.values.select(*[F.col(f"v{hashed.place[name]}").alias(name) for name in rest]).distinct(), rest)
        counts = _all_counts(fewer, most)
        found |= {hashed.bits([name for k, name in enumerate(rest) if bits >> k & 1]): n for bits, n in counts.items()}
    elif rest:
        found |= {hashed.bits(combo): n for combo, n in _walked(hashed, rest, most).items()}
    return found


def combination_counts(df: DataFrame, columns: Sequence[str] | None = None, max_size: int | None = None) -> DataFrame:
    """Distinct count of every non-empty combination of up to `max_size` columns (NULL counts as empty text).

    All sizes unless `max_size` is given; combinations double with every column, so wide tables want it.
    `source` says whether a count follows from those of smaller combinations or only from the data.
    """
    names = list(columns or df.columns)
    most = min(max_size or len(names), len(names))
    hashed = _Hashed(df, names)
    counts, known = _all_counts(hashed, most), _Known(hashed)
    rows = []
    for size in range(1, most + 1):
        for combo in combinations(names, size):
            bits = hashed.bits(combo)
            how = "counted" if known.implied(bits) is None else "implied"
            known.add(bits, counts[bits])
            rows.append((" + ".join(combo), size, counts[bits], how, hashed.total))
    schema = "columns string, size int, unique_count bigint, source string, total_rows bigint"
    return df.sparkSession.createDataFrame(rows, schema)


def _slice_counts(hashed: _Hashed, combos: Sequence[Combo], share: int) -> dict[Combo, int]:
    """How many distinct words of each combination fall into one slice of `share` (a power of two) of all hashes."""

    def place(combo: Combo) -> str:
        # Words are hashed again: an exclusive-or alone spreads the combinations of a few values unevenly.
        return f"xxhash64({' ^ '.join(f'a{hashed.place[name]}' for name in combo)})"

    cells = []
    for batch in _chunks(list(enumerate(combos)), BATCH):
        # Most rows have no word in the slice; they go before they are taken apart.
        inside = hashed.rows.where(" OR ".join(f"({place(combo)} & {share - 1}) = 0" for _, combo in batch)) if share > 1 else hashed.rows
        words = ", ".join(f"named_struct('number', {i}, 'word', {place(combo)})" for i, combo in batch)
        cells.append(inside.selectExpr(f"inline(array({words}))").where(f"(word & {share - 1}) = 0"))
    found = _collected([part.distinct().groupBy("number").agg(F.count("*").alias("n")) for part in cells])
    return {combo: found.get(i, 0) for i, combo in enumerate(combos)}


def sketched_counts(hashed: _Hashed, combos: Sequence[Combo], goal: int | None = None, close: int = CLOSE) -> dict[Combo, tuple[float, float]]:
    """Bounds of the distinct counts of several combinations, close ones where they may come near the goal (the row count unless given).

    Theta sketches: every row's words are looked at, and those in one slice of the hashes are counted
    exactly, some 2^`SKETCH` of them at the goal. A coarser slice goes first if the goal is far below the row count.
    """
    goal = hashed.total if goal is None else goal
    shares = [1 << max(0, (n >> SKETCH).bit_length() - 1) for n in (hashed.total // 4, goal)]
    out: dict[Combo, tuple[float, float]] = {}
    for share in shares if shares[0] > 4 * shares[1] else shares[1:]:
        asked = [combo for combo in combos if combo not in out or out[combo][0] <= goal + close and out[combo][1] >= goal - close]
        # The means under which a count this far off would be `DEVIATIONS` deviations away.
        spread = DEVIATIONS**2 * (1 - 1 / share)
        for combo, n in (_slice_counts(hashed, asked, share) if asked else {}).items():
            off = (spread * (n + spread / 4)) ** 0.5
            out[combo] = (share * (n + spread / 2 - off), share * (n + spread / 2 + off))
    return out


def _far_below(hashed: _Hashed, columns_n: dict[Combo, int], goal: int, close: int, beyond: list[int]) -> dict[int, float]:
    """Large combinations, as bits, whose counts lie below the target, with a bound each; all they contain lies below it too.

    Every column is joined by the others, those with few values first, and the step that reaches the
    target is found by halving. What turns out to lie above it is added to `beyond`.
    """
    by_values = sorted(hashed.names, key=lambda name: columns_n[(name,)])
    chains = {name: (name, *(other for other in by_values if other != name)) for name in by_values if columns_n[(name,)] < goal - close}
    # Of each chain, the lengths between which the target is reached.
    ends = {name: (1, len(chain)) for name, chain in chains.items()}
    below: dict[int, float] = {}
    while open_ends := {name: -(-(low + high) // 2) for name, (low, high) in ends.items() if low < high}:
        middles = {hashed.bits(chains[name][:size]): chains[name][:size] for name, size in open_ends.items()}
        asked = [combo for bits, combo in middles.items() if not any(over & bits == over for over in beyond) and not any(bits & top == bits for top in below)]
        for combo, (low, high) in sketched_counts(hashed, asked, goal, close).items():
            if high < goal - close:
                below[hashed.bits(combo)] = high
            elif low > goal + close:
                beyond.append(hashed.bits(combo))
        for name, size in open_ends.items():
            bits = hashed.bits(chains[name][:size])
            ends[name] = (size, ends[name][1]) if any(bits & top == bits for top in below) else (ends[name][0], size - 1)
    return below


def near_counts(df: DataFrame, target: int | None = None, close: int = CLOSE, columns: Sequence[str] | None = None, max_size: int | None = None) -> DataFrame:
    """The combinations whose distinct count is within `close` of the target (the row count unless given).

    The same rows as `matches(combination_counts(df), target, close)`. Level by level, sketches bound the
    counts of the combinations that neither a smaller one nor a larger one has ruled out; only those
    whose bounds reach the target are counted exactly.
    """
    names = list(columns or df.columns)
    hashed = _Hashed(df, names)
    goal = hashed.total if target is None else target
    known, unsettled = _Known(hashed), _Unsettled(hashed)
    beyond: list[int] = []
    out = []
    # A combination has at most as many values as its parts have pairs of values.
    columns_n = _columns(hashed)
    most = {hashed.bits(combo): float(n) for combo, n in columns_n.items()}
    below = _far_below(hashed, columns_n, goal, close, beyond)
    for size in range(1, min(max_size or len(names), len(names)) + 1):
        maybe = []
        for combo in combinations(names, size):
            bits = hashed.bits(combo)
            if any(over & bits == over for over in beyond):
                continue
            n = known.implied(bits)
            if n is not None:
                known.add(bits, n)
                out.append((combo, n))
                continue
            if size > 1:
                pairs = [most.get(bits & ~(1 << k), float(hashed.total)) * most[1 << k] for k in map(hashed.place.get, combo)]
                most[bits] = min(*pairs, *(high for top, high in below.items() if bits & top == bits))
            if most[bits] >= goal - close:
                maybe.append(combo)
        exact = []
        bounds = {combo: (columns_n[combo],) * 2 for combo in maybe} if size == 1 else sketched_counts(hashed, maybe, goal, close)
        for combo, (low, high) in bounds.items():
            most[hashed.bits(combo)] = min(most[hashed.bits(combo)], high)
            if low > goal + close:
                beyond.append(hashed.bits(combo))
            elif high >= goal - close:
                exact.append(combo)
        measured = {combo: columns_n[combo] for combo in exact} if size == 1 else _exact(hashed, unsettled, exact)
        for combo, n in measured.items():
            known.add(hashed.bits(combo), n)
            out.append((combo, n))
            if n > goal + close:
                beyond.append(hashed.bits(combo))
        unsettled.add(_sharp(hashed, known, unsettled, measured, size + 1))
    rows = [(" + ".join(combo), len(combo), n, hashed.total) for combo, n in out]
    schema = "columns string, size int, unique_count bigint, total_rows bigint"
    return matches(df.sparkSession.createDataFrame(rows, schema), target, close)


def matches(counts: DataFrame, target: int | None = None, close: int = CLOSE) -> DataFrame:
    """Exact and close matches with a target count (the row count unless given)."""
    goal = F.col("total_rows") if target is None else F.lit(target)
    diff = (F.col("unique_count") - goal).cast("long")
    found = counts.withColumn("diff", diff).where(F.abs("diff") <= close)
    return found.withColumn("match", F.when(F.col("diff") == 0, "exact").otherwise("close"))


def closest(counts: DataFrame, target: int, k: int = 10) -> DataFrame:
    """The k combinations nearest to the target."""
    diff = (F.col("unique_count") - target).cast("long")
    return counts.withColumn("diff", diff).orderBy(F.abs("diff"), "columns").limit(k)


def common_counts(counts: DataFrame, k: int = 5) -> DataFrame:
    """The k distinct counts that occur most often."""
    grouped = counts.groupBy("unique_count").agg(F.count("*").alias("combinations"))
    return grouped.orderBy(F.desc("combinations"), F.desc("unique_count")).limit(k)
