"""Quality rules by compression bands, after a base of counted facts.

Whole documents and fixed chunks are compressed with zstandard.  A ratio (bytes over
compressed bytes) above the upper limit of its length means repetition, one below the
lower limit means keys, binary or other text that does not compress.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import groups_of, hash_spans, shingle_hashes, text_bytes, word_spans


@dataclass(frozen=True)
class CompressionRules:
    """Limits by length in UTF-8 bytes: (from length, lowest ratio, highest ratio)."""

    bands: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 1e9),  # too short to tell
        (64, 0.6, 2.4),
        (256, 1.05, 2.8),
        (1024, 1.25, 3.2),
        (4096, 1.35, 3.8),
        (16384, 1.4, 4.6),
        (262144, 1.4, 6.0),
    )
    level: int = 3
    chunk: int = 1024
    #: Limits of a full chunk, and the share of chunks beyond them that rejects a text.
    chunk_low: float = 1.36
    chunk_high: float = 3.2
    chunk_share: float = 0.3


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def repeated_words(words: np.ndarray, n: int = 8) -> int:
    """Words covered by n-word windows that occur twice or more (the first included)."""
    if len(words) < n + 1:
        return 0
    windows = shingle_hashes(words, n)
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(np.isin(windows, twice))
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, twice = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            twice += 1
        elif line and not line.isspace():
            seen.add(line)
    return twice


def ratios(text: bytes, compress, chunk: int) -> tuple[float, list[float]]:
    """Ratio of the text and of its full chunks (a short text is its only chunk)."""
    if not text:
        return 1.0, []
    whole = len(text) / len(compress(text))
    if len(text) < 2 * chunk:
        return whole, []
    return whole, [chunk / len(compress(text[i : i + chunk])) for i in range(0, len(text) - chunk + 1, chunk)]


def in_bands(size: int, whole: float, chunks: list[float], rules: CompressionRules) -> bool:
    low, high = [(lo, hi) for at, lo, hi in rules.bands if size >= at][-1]
    if not low <= whole <= high:
        return False
    bad = sum(1 for r in chunks if not rules.chunk_low <= r <= rules.chunk_high)
    return not chunks or bad < rules.chunk_share * len(chunks) or bad == 0


def compression_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: CompressionRules = CompressionRules()) -> DataFrame:
    """Per row: key, the base counts, ``base_failed``, ratios and ``kept``.

    A null text is an empty one: no words, so the base rejects it.  Equal rows get equal
    results; an empty table gives an empty table; other columns are not read.  A text of
    one very long word or line is measured like any other.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=rules.level).compress
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            out: dict[str, list] = {c: [] for c in names}
            for i, j in groups_of(offsets):
                part = offsets[i : j + 1]
                base = int(part[0])
                data = raw[base : int(part[-1])]
                starts, ends, firsts = word_spans(raw, part)
                words = hash_spans(data, starts, ends)
                symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                chars = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
                for d in range(j - i):
                    a, b = int(part[d]) - base, int(part[d + 1]) - base
                    w0, w1 = int(firsts[d]), int(firsts[d + 1])
                    body = data[a:b].tobytes()
                    n, again = w1 - w0, repeated_words(words[w0:w1])
                    whole, chunks = ratios(body, compress, rules.chunk)
                    failed = n < 20 or 100 * again > 30 * n
                    row = (
                        n, int(chars[w1] - chars[w0]), int(symbols[b] - symbols[a]), duplicate_lines(body), again, failed,
                        not failed and in_bands(len(body), whole, chunks, rules),
                        whole, min(chunks, default=whole), max(chunks, default=whole),
                    )
                    for c, v in zip(names, row, strict=True):
                        out[c].append(v)
            arrays = [pa.array(out[c], t) for c, t in zip(names, arrow_types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [key, *names])

    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    names = [*longs, "base_failed", "kept", "ratio", "lowest_chunk", "highest_chunk"]
    arrow_types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in longs)
    schema += ", base_failed boolean, kept boolean, ratio double, lowest_chunk double, highest_chunk double"
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(judge, schema)
