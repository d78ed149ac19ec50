"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_dir

#: Bits of the pre-filter of `key_bitmap`: 4 MB, whatever the number of keys.
BITMAP_BITS = 1 << 25
_PAGE = 32768


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it again: cuts the lineage
    and survives the loss of any executor."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of `stored` that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, per_bucket: int = 50_000) -> DataFrame:
    """Gapless numbers from 0 within ``keys`` without bringing a key's rows together.

    Rows are dealt by a hash of ``order`` into buckets of about ``per_bucket`` rows,
    numbered there, and shifted by the sizes of the buckets before.  Rows equal in
    ``order`` share a bucket and are interchangeable.
    """
    total = df.agg(F.count(F.lit(1))).head()[0]
    buckets = max(1, -(-total // per_bucket))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    inner = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    )
    return (
        dealt.withColumn("__row", F.row_number().over(inner) - 1)
        .join(shifts, [*keys, "__bucket"])
        .withColumn(name, F.col("__shift") + F.col("__row"))
        .drop("__bucket", "__row", "__shift")
    )


def key_bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of ``BITMAP_BITS`` bits with the low bits of each long key set.

    Its size is fixed, so it may go to the driver and to each task.  It only thins out
    rows before an exact join: a full bitmap lets all rows pass and loses none.
    """
    bit = F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1))
    pages = (
        keys.where(F.col(column).isNotNull())
        .groupBy(F.bitmap_bucket_number(bit).alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    )
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in pages.toLocalIterator():
        # pages number from 1 for positive positions, from 0 for position 0
        raw = np.frombuffer(row["bits"], dtype=np.uint8)
        at = (row["page"] - 1) * (_PAGE // 8) if row["page"] > 0 else 0
        out[at : at + len(raw)] |= raw
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap (see `key_bitmap`)."""
    # Spark numbers bits of page p as (p - 1) * 32768 + position with position (v - 1) % 32768
    v = keys.astype(np.int64) & np.int64(BITMAP_BITS - 1)
    bit = np.where(v > 0, v - 1, 0)
    hit = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
    return (hit == 1) | (v == 0)


# --- words of whole texts, by numpy over the bytes of an Arrow column -----------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BLOCK = 1 << 18


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64 and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * _BLOCK)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, np.uint64(base & _MASK))
            row[0] = 1
            tables.append(np.cumprod(row, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a text column; a null counts as an empty text."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs.astype(np.int64)


def groups_of(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text) of the words ``[^\\x20\\x09-\\x0D]+``.

    Positions count from ``offsets[0]``; the last array has one entry more than texts.
    """
    base, end = int(offsets[0]), int(offsets[-1])
    solid = ~_SPACE[raw[base:end]]
    n = len(solid)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, dtype=bool)  # a new text begins here
    cut[offsets - base] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets - base)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans in ascending order of start (``fold``: A-Z as a-z).

    Any block of bytes is hashed with prefix sums, so no Python code runs per word.
    """
    table = _FOLDED if fold else _VALUE
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        a = int(starts[k])
        k1 = max(k + 1, int(np.searchsorted(ends, a + _BLOCK, "right")))
        seg = table[raw[a : int(ends[k1 - 1])]]
        up, down = _power_tables(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum(seg * up[: len(seg)], out=sums[1:])
        s, e = starts[k:k1] - a, ends[k:k1] - a
        out[k:k1] = (sums[e] - sums[s]) * down[s]
        k = k1
    return mix64(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_words(column: pa.Array, fold: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: (first text, end, word hashes, first word of each text)."""
    raw, offsets = text_bytes(column)
    for i, j in groups_of(offsets):
        part = offsets[i : j + 1]
        starts, ends, firsts = word_spans(raw, part)
        yield i, j, hash_spans(raw[int(part[0]) :], starts, ends, fold), firsts


_STEP = [np.uint64((pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64) | 1) & _MASK) for k in range(64)]


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (fewer words: of the whole sequence, none for none)."""
    m = len(words)
    if not m:
        return words
    n = min(n, m)
    out = np.full(m - n + 1, np.uint64(n * int(_STEP[63]) & _MASK))
    for k in range(n):
        out += words[k : m - n + 1 + k] * _STEP[k]
    return mix64(out)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def load(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")
