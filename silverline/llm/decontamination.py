"""Benchmark decontamination: windows of a document that repeat a benchmark item.

A window has as many words as the item it may repeat. Windows get SimHash fingerprints; an index over
blocks of the items' fingerprints returns every item within the radius, and the exact similarity of
word shingles, repeats counted, decides. Only windows that share enough shingles with an item to reach
the similarity at all are fingerprinted: the words of a batch of texts are hashed at once, and most
texts share none.

The benchmark is the stated query set. It meets all documents in blocks of a bounded size, so a
benchmark of any size fits the tasks; documents are never shuffled.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import map_rows, under_plain_names

_PAIRS = "doc_id long, item_id long, similarity double, first_word long, n_windows long"
# Distinct words a task may keep the powers for: bytes of one batch of texts.
_BATCH = 2 << 20
_P = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2^64
_Q = 0xC2B2AE3D27D4EB4F


@dataclass(frozen=True)
class Contamination:
    """Words in a shingle, similarity that makes a window a repeat, bits a candidate may differ in, benchmark bytes in a block."""

    words: int = 5
    similarity: float = 0.8
    radius: int = 27
    block_bytes: int = 8 << 20


class Words:
    """Words of a batch of texts: A-Z lower-cased runs of letters, digits and bytes beyond ASCII, hashed together."""

    def __init__(self) -> None:
        import numpy as np

        self.np = np
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        self.inside = np.zeros(256, dtype=bool)
        self.inside[48:58] = self.inside[97:123] = self.inside[128:] = True
        self.powers = self.inverse = np.ones(0, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        np = self.np
        if len(self.powers) < size:
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.full(size, _P, dtype=np.uint64))
                self.inverse = np.cumprod(np.full(size, pow(_P, -1, 1 << 64), dtype=np.uint64))

    def mix(self, h: object) -> object:
        np = self.np
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    def split(self, raw: bytes) -> tuple[object, object, object, object]:
        """(folded bytes, starts, ends, hashes) of the words."""
        np = self.np
        text = self.fold[np.frombuffer(raw, dtype=np.uint8)]
        edge = np.diff(self.inside[text].astype(np.int8), prepend=0, append=0)
        starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        self._grow(len(text) + 1)
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.powers[: len(text)], out=sums[1:])
        hashes = self.mix((sums[ends] - sums[starts]) * self.inverse[starts])
        return text, starts, ends, hashes

    def grams(self, hashes: object, size: int) -> object:
        """A hash for every run of `size` words."""
        np = self.np
        n = max(0, len(hashes) - size + 1)
        total = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            total = total * np.uint64(_Q) + hashes[k : k + n]
        return self.mix(total)


def shingle_counts(words: list[bytes], size: int) -> Counter:
    if len(words) <= size:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[k:] for k in range(size)), strict=False))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: shared counts over joint counts."""
    shared = sum((a & b).values())
    joint = sum((a | b).values())
    return shared / joint if joint else 0.0


class BlockIndex:
    """Items by the eight bytes of their fingerprints: within radius r, some byte differs in r // 8 bits at most."""

    def __init__(self, prints: list[int], radius: int) -> None:
        near = [m for m in range(256) if m.bit_count() <= radius // 8]
        self.radius, self.prints = radius, prints
        self.tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(8)]
        for item, bits in enumerate(prints):
            for place in range(8):
                byte = bits >> (8 * place) & 255
                for mask in near:
                    self.tables[place][byte ^ mask].append(item)

    def within(self, bits: int) -> set[int]:
        """Every item whose fingerprint is within the radius."""
        found = set(itertools.chain.from_iterable(self.tables[p].get(bits >> (8 * p) & 255, ()) for p in range(8)))
        return {item for item in found if (self.prints[item] ^ bits).bit_count() <= self.radius}


class Items:
    """A block of the benchmark, made ready in a task."""

    def __init__(self, items: list[tuple[int, str]], how: Contamination) -> None:
        import numpy as np

        self.np, self.how, self.words = np, how, Words()
        self.ids, self.sizes, self.counts = [], [], []
        prints, rows = [], []
        for item_id, text in items:
            raw = (text or "").encode()
            folded, starts, ends, hashes = self.words.split(raw)
            if not len(starts):
                continue
            number = len(self.ids)
            size = min(how.words, len(starts))
            grams = self.words.grams(hashes, size)
            self.ids.append(item_id)
            self.sizes.append(len(starts))
            self.counts.append(shingle_counts(self._texts(folded, starts, ends), how.words))
            prints.append(self.prints(grams, len(grams))[0])
            rows += [(size, int(g), number) for g in set(grams.tolist())]
        self.index = BlockIndex([int(p) for p in prints], how.radius)
        # By shingle size: sorted hashes, the items of each, and a bitmap that passes few others.
        self.lookup = {}
        for size in sorted({r[0] for r in rows}):
            owners: dict[int, list[int]] = defaultdict(list)
            for _, gram, number in (r for r in rows if r[0] == size):
                owners[gram].append(number)
            keys = np.array(sorted(owners), dtype=np.uint64)
            bitmap = np.zeros(1 << 22, dtype=bool)
            bitmap[keys >> np.uint64(42)] = True
            self.lookup[size] = (keys, [owners[int(k)] for k in keys], bitmap)

    @staticmethod
    def _texts(folded: object, starts: object, ends: object) -> list[bytes]:
        raw = folded.tobytes()
        return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]

    def prints(self, grams: object, width: int) -> object:
        """Fingerprints of all runs of `width` shingles: bits set in over half of them."""
        np = self.np
        ones = np.unpackbits(np.ascontiguousarray(grams, dtype="<u8").view(np.uint8).reshape(len(grams), 8), axis=1, bitorder="little")
        sums = np.zeros((len(grams) + 1, 64), dtype=np.int32)
        np.cumsum(ones, axis=0, dtype=np.int32, out=sums[1:])
        total = sums[width:] - sums[:-width]
        return np.packbits(2 * total > width, axis=1, bitorder="little").view("<u8")[:, 0]

    def hits(self, raw: bytes) -> tuple[tuple, dict[int, dict[int, list[int]]]]:
        """The words of a batch, and for each shingle size and item the word numbers where it shares a shingle."""
        np = self.np
        split = self.words.split(raw)
        found: dict[int, dict[int, list[int]]] = {}
        for size, (keys, owners, bitmap) in self.lookup.items():
            grams = self.words.grams(split[3], size)
            maybe = np.nonzero(bitmap[grams >> np.uint64(42)])[0]
            if not len(maybe):
                continue
            place = np.searchsorted(keys, grams[maybe])
            place[place == len(keys)] = 0
            same = keys[place] == grams[maybe]
            at = found.setdefault(size, defaultdict(list))
            for word, key in zip(maybe[same].tolist(), place[same].tolist(), strict=True):
                for item in owners[key]:
                    at[item].append(word)
        return split, found

    def match(self, words: tuple, first: int, last: int, hits: list[tuple[int, int, list[int]]]) -> dict[int, list[tuple[float, int]]]:
        """Items repeated by the document with words first..last, each with (similarity, window's first word)."""
        np, how = self.np, self.how
        folded, starts, ends, hashes = words
        count = last - first
        tried: set[tuple[int, int]] = set()
        out: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for item, size, places in hits:
            length = min(self.sizes[item], count)
            size_here = min(how.words, length)
            if size_here != size:
                continue  # a document shorter than a shingle shares it only if it has as few words
            width, full = length - size + 1, self.sizes[item] - size + 1
            # Similarity s needs shared / (width + full - shared) >= s.
            need = how.similarity * (width + full) / (1 + how.similarity)
            marks = np.zeros(count - size + 2, dtype=np.int64)
            marks[np.array(places) - first + 1] = 1
            shared = np.cumsum(marks)
            windows = np.nonzero(shared[width:] - shared[:-width] >= need - 1e-9)[0]
            if not len(windows):
                continue
            low, high = int(windows[0]), int(windows[-1])
            grams = self.words.grams(hashes[first + low : first + high + length], size)
            prints = self.prints(grams, width)
            for window in windows.tolist():
                if (length, window) in tried:
                    continue
                tried.add((length, window))
                near = self.index.within(int(prints[window - low]))
                if not near:
                    continue
                span = slice(first + window, first + window + length)
                own = shingle_counts(self._texts(folded, starts[span], ends[span]), how.words)
                for other in near:
                    if min(self.sizes[other], count) == length and (score := similarity(own, self.counts[other])) >= how.similarity - 1e-12:
                        out[other].append((score, window))
        return out

    def repeats(self, texts: list[bytes]) -> list[dict[int, list[tuple[float, int]]]]:
        """For each text of a batch, the items it repeats."""
        np = self.np
        out: list[dict] = [{} for _ in texts]
        if not self.ids:
            return out
        split, found = self.hits(b"\0".join(texts))
        if not found:
            return out
        # Words of text k are numbered from bounds[k]; shingles over a border belong to no text.
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bounds = np.searchsorted(split[1], offsets)
        by_text: dict[int, list[tuple[int, int, list[int]]]] = defaultdict(list)
        for size, items in found.items():
            for item, words in items.items():
                owners = np.searchsorted(bounds, words, side="right") - 1
                for text, group in itertools.groupby(zip(owners.tolist(), words, strict=True), key=lambda p: p[0]):
                    places = [w for _, w in group if w + size <= bounds[text + 1]]
                    if places:
                        by_text[text].append((item, size, places))
        for text, hits in by_text.items():
            out[text] = self.match(split, int(bounds[text]), int(bounds[text + 1]), hits)
        return out


def _batches(rows: list[dict]) -> list[list[dict]]:
    out, size = [[]], 0
    for row in rows:
        if size > _BATCH:
            out.append([])
            size = 0
        out[-1].append(row)
        size += len(row["text"] or "")
    return out


def _blocks(benchmark: DataFrame, how: Contamination) -> Iterator[list[tuple[int, str]]]:
    """The benchmark on the driver, one block of bounded size after another."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, -(-size // how.block_bytes))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return ([(r["item_id"], r["text"]) for r in items.filter(number == block).orderBy("item_id", "text").collect()] for block in range(blocks))


def contaminated(docs: DataFrame, benchmark: DataFrame, how: Contamination | None = None) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_windows): the items each document repeats, with its best window.

    A document shorter than an item is one window. NULL texts and texts without words repeat nothing;
    NULL ids stay NULL; repeated rows and items each give their pairs; of equal windows the first is
    named; empty tables give no rows; other columns are not looked at. Items that share id and text
    give equal pairs, one for each.
    """
    how = how or Contamination()
    out = None
    for items in _blocks(benchmark, how):

        def make(items: list[tuple[int, str]] = items) -> Callable[[list[dict]], list[dict]]:
            block = Items(items, how)

            def work(rows: list[dict]) -> list[dict]:
                found = []
                for batch in _batches(rows):
                    for row, repeats in zip(batch, block.repeats([(r["text"] or "").encode() for r in batch]), strict=True):
                        for item, windows in sorted(repeats.items()):
                            score, first = max(windows, key=lambda w: (w[0], -w[1]))
                            found.append(
                                {"doc_id": row["doc_id"], "item_id": block.ids[item], "similarity": score, "first_word": first, "n_windows": len(windows)}
                            )
                return found

            return work

        pairs = map_rows(docs.select("doc_id", "text"), make, _PAIRS)
        out = pairs if out is None else out.unionByName(pairs)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, how: Contamination | None = None) -> DataFrame:
    """The documents that repeat no item, with all their columns, whatever their names."""
    return under_plain_names(docs, lambda plain: _clean(plain, benchmark, how or Contamination()))


def _clean(docs: DataFrame, benchmark: DataFrame, how: Contamination) -> DataFrame:
    for items in _blocks(benchmark, how):

        def make(items: list[tuple[int, str]] = items) -> Callable[[list[dict]], list[dict]]:
            block = Items(items, how)

            def work(rows: list[dict]) -> list[dict]:
                kept = []
                for batch in _batches(rows):
                    found = block.repeats([(r["text"] or "").encode() for r in batch])
                    kept += [row for row, repeats in zip(batch, found, strict=True) if not repeats]
                return kept

            return work

        docs = map_rows(docs, make, docs.schema)
    return docs
