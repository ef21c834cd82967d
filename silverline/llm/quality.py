"""Quality rules: text is judged by how well it compresses.

Prose of one length compresses within a narrow band. Repetition falls below the band, random
characters rise above it. zstandard ratios (compressed bytes / bytes) are taken over the whole
document and over fixed chunks; the limits depend on the length that was compressed, since short
inputs carry the frame's own bytes and find fewer matches.

The limits are fitted, not guessed: `fit_bands` takes a bounded sample of prose, makes repeated and
encoded text of the same lengths from it, and puts each limit of a length class midway between what
prose reached and what the other kind did.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from silverline.llm.common import SPACE, map_rows, under_plain_names

SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, doc_ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, kept boolean"
)


@dataclass(frozen=True)
class Band:
    """Ratios allowed for inputs of at least `size` bytes."""

    size: int
    low: float
    high: float


#: Least sizes of the length classes.
CLASSES = (0, 300, 600, 1200, 2400, 4800, 9600, 19200)

#: What `fit_bands` gives for 1,200 documents of prose of the tables at scale 0.1, rounded outwards.
FITTED = (
    Band(0, 0.0, 1e9), Band(300, 0.34, 0.77), Band(600, 0.28, 0.74), Band(1200, 0.25, 0.67),
    Band(2400, 0.23, 0.64), Band(4800, 0.21, 0.62), Band(9600, 0.2, 0.61), Band(19200, 0.2, 0.59),
)


@dataclass(frozen=True)
class CompressionRules:
    """Bands by length, for whole documents and for chunks; the share of bad chunks that rejects."""

    document: tuple[Band, ...] = FITTED
    chunk: tuple[Band, ...] = FITTED
    chunk_bytes: int = 4096
    bad_chunk_share: float = 0.25
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


def repeated_text(raw: bytes) -> bytes:
    """Text as long, of a tenth of it over and over."""
    part = raw[: max(40, len(raw) // 10)] + b" "
    return (part * (len(raw) // len(part) + 1))[: len(raw)]


def encoded_text(raw: bytes) -> bytes:
    """Text as long, of base64 digits that hold no pattern."""
    import base64
    import hashlib

    stream = b"".join(hashlib.sha512(raw[:64] + b"%d" % k).digest() for k in range(len(raw) // 64 + 1))
    return base64.b64encode(stream)[: len(raw)]


def fit_bands(prose: list[bytes], most: int = 1200, level: int = 3) -> tuple[Band, ...]:
    """Limits by length class from up to `most` texts, midway between prose and repeated or encoded text.

    Every length class is fitted on the texts cut to it, so a sample of long texts fits all of them. A
    class that no text reaches keeps the limits of the class before; below the first the frame's own
    bytes decide, and nothing is rejected.
    """
    import zstandard

    compress = zstandard.ZstdCompressor(level=level).compress

    def ratios(texts: list[bytes]) -> list[float]:
        return [len(compress(text)) / len(text) for text in texts]

    out = [Band(0, 0.0, 1e9)]
    for size, over in zip(CLASSES[1:], [*CLASSES[2:], 4 * CLASSES[-1]], strict=True):
        texts = [text[: over - 1] for text in prose[:most] if len(text) >= size]
        if not texts:
            out.append(Band(size, out[-1].low, out[-1].high))
            continue
        own, repeated, encoded = ratios(texts), ratios([repeated_text(t) for t in texts]), ratios([encoded_text(t) for t in texts])
        out.append(Band(size, (max(repeated) + min(own)) / 2, (max(own) + min(encoded)) / 2))
    return tuple(out)


def band_for(bands: tuple[Band, ...], size: int) -> Band:
    return max((band for band in bands if band.size <= size), key=lambda band: band.size)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    # Pairs get exact codes first, then pairs and third words: no hashing, no overflow.
    _, pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    starts = counts[windows] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= starts
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            repeats += line in seen
            seen.add(line)
    return repeats


def _judge(rules: CompressionRules) -> Callable[[], Callable[[list[dict]], list[dict]]]:
    def make() -> Callable[[list[dict]], list[dict]]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=rules.level).compress

        def judge(row: dict) -> dict:
            text = row["text"] or ""
            raw = text.encode()
            words = raw.split()
            repeats = repeated_words(words)
            failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
            ratio = len(compress(raw)) / len(raw) if raw else 0.0
            band = band_for(rules.document, len(raw))
            chunks = low = high = 0
            for start in range(0, len(raw), rules.chunk_bytes):
                chunk = raw[start : start + rules.chunk_bytes]
                limits = band_for(rules.chunk, len(chunk))
                part = len(compress(chunk)) / len(chunk)
                chunks += 1
                low += part < limits.low
                high += part > limits.high
            fits = band.low <= ratio <= band.high and low + high <= rules.bad_chunk_share * chunks
            return {
                "doc_id": row["doc_id"],
                "n_words": len(words),
                "word_chars": len(text) - (len(raw) - len(raw.translate(None, SPACE))),
                "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
                "n_dup_lines": duplicate_lines(raw),
                "n_repeat_words": repeats,
                "base_failed": failed,
                "doc_ratio": ratio,
                "n_chunks": chunks,
                "n_low_chunks": low,
                "n_high_chunks": high,
                "kept": fits and not failed,
            }

        return lambda rows: [judge(row) for row in rows]

    return make


def judge_quality(docs: DataFrame, rules: CompressionRules | None = None) -> DataFrame:
    """One row per document with its measures and whether it is kept.

    No shuffle: every document is judged by itself, whole. NULL text counts as empty and fails for
    its word count; a NULL id stays NULL; repeated rows are judged alike; an empty table gives no
    rows; columns other than doc_id and text are not looked at.
    """
    return map_rows(docs.select("doc_id", "text"), _judge(rules or CompressionRules()), SCHEMA)


def keep_good(docs: DataFrame, rules: CompressionRules | None = None) -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever their names."""
    return under_plain_names(docs, lambda plain: _kept(plain, rules or CompressionRules()))


def _kept(docs: DataFrame, rules: CompressionRules) -> DataFrame:
    found = _judge(rules)

    def make() -> Callable[[list[dict]], list[dict]]:
        judge = found()

        def work(rows: list[dict]) -> list[dict]:
            return [row for row, verdict in zip(rows, judge(rows), strict=True) if verdict["kept"]]

        return work

    return map_rows(docs, make, docs.schema)
