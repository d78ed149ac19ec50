"""SimHash near duplicates, compared by bit planes.

Fingerprints are one row each, whatever the number of documents that share one.  Of six
blocks of their bits, two fingerprints at radius 3 or less agree on at least three, so the
twenty choices of three blocks (32 or 33 bits) bring every such pair together once or more.
The members of a key are compared bit-sliced: plane j holds bit j of all members as packed
words; a block of members is compared with all later ones by adding plane after plane into
carry-save counters, and words whose lanes all exceed the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored
from millrace.llm.linking import components
from millrace.operators.skew import lookup

BITS = 64
#: Members compared in one group; a key with more is dealt into slices of half as many.
GROUP = 2048
#: Values compared with the planes at once.
QUERIES = 64
#: Groups of at most so many members are compared together, a lane per pair.
SMALL = 48
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_digests(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``words`` space-joined words (fewer words: of all), repeats included."""
    found = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return np.zeros(0, np.uint64)
    n = min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(found) - n + 1]
    joined, hashed = b" ".join(found), xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), (ends[n - 1 :] - 1).tolist(), strict=True)
    return np.fromiter((hashed(joined[a:b], seed) for a, b in spans), np.uint64, len(starts))


def fingerprint(digests: np.ndarray) -> int:
    """Bit j is set if more than half of the digests have it; 0 for none."""
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(digests), 1 << 15):
        ones += np.unpackbits(digests[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(digests), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, fp) with the 64 bits as a signed long."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_digests((t.as_py() or "").encode(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(sign, f"`{key}` {kind}, fp bigint")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Plane j (row j): bit j of every value, 64 values to a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _near(plane, words: int, radius: int) -> np.ndarray:
    """Lanes in which ``radius`` planes or fewer are set; ``plane(j, live)`` gives plane j's words.

    The planes are summed in vertical counters, three at a time by a carry-save adder; a lane
    past the radius sticks in ``over``.  Words with no lane left are abandoned.
    """
    live = np.arange(words)
    counters = [np.zeros(words, np.uint64) for _ in range(int(radius).bit_length())]
    over = np.zeros(words, np.uint64)
    none = np.uint64(0)
    for at in range(0, BITS, 3):
        x, y, z = (plane(j, live) if j < BITS else none for j in (at, at + 1, at + 2))
        odd = x ^ y
        for level, carry in enumerate((odd ^ z, (x & y) | (z & odd))):
            for c in range(level, len(counters)):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
        if at % 9 == 6 or at + 3 >= BITS:
            past = _above(counters, radius) | over
            keep = past != _FULL
            if not keep.all():
                live, over, past = live[keep], over[keep], past[keep]
                counters = [c[keep] for c in counters]
            if not len(live):
                return live
    lanes = np.flatnonzero(np.unpackbits((~past).astype("<u8").view(np.uint8), bitorder="little"))
    return live[lanes >> 6] * 64 + (lanes & 63)


def pairs_within(values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, k), i < k, of values that differ in ``radius`` bits or fewer.

    Blocks of values are compared with the planes of all that follow.
    """
    planes = bit_planes(values)
    for a in range(0, len(values), QUERIES):
        block = values[a : a + QUERIES]
        part = planes[:, a >> 6 :]
        flip = np.where((block[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1), _FULL, np.uint64(0))
        width = part.shape[1]
        found = _near(lambda j, live: part[j, live % width] ^ flip[j, live // width], len(block) * width, radius)
        one, two = a + found // (64 * width), (a >> 6) * 64 + found % (64 * width)
        ok = (two > one) & (two < len(values))
        yield one[ok], two[ok]


def pairs_of_small(values: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As `pairs_within` for many small groups at once; ``ends`` is each value's group end.

    Lane i of turn d is the pair (i, i + d) of one group.
    """
    at, d = np.arange(len(values)), 1
    while len(at := at[at + d < ends[at]]):
        for k in range(0, len(at), 1 << 16):
            one = at[k : k + (1 << 16)]
            planes = bit_planes(values[one] ^ values[one + d])
            found = _near(lambda j, live: planes[j, live], planes.shape[1], radius)
            one = one[found[found < len(one)]]
            yield one, one + d
        d += 1


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``, by comparison from the highest bit."""
    more, same = np.uint64(0), _FULL
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            same = same & counters[c]
        else:
            more = more | (same & counters[c])
            same = same & ~counters[c]
    return more


def spanned(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position in each position's component."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            for side in (label[a], label[b]):
                np.minimum.at(label, side, low)
            while (label[label] != label).any():
                label = label[label]
    return label


def _keyed(rows: DataFrame, radius: int) -> DataFrame:
    """(key, fp): a row per choice of ``radius`` of twice as many blocks of bits."""
    edges = [BITS * b // (2 * radius) for b in range(2 * radius + 1)]
    masks = [sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen) for chosen in combinations(range(2 * radius), radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = [F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(m).cast("bigint"))) for n, m in enumerate(signed)]
    return rows.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _compare(radius: int):
    """Spanning links (a, b) of each run of equal (key, x, y) in sorted rows (key, x, y, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = [c.to_numpy() for c in batch.columns]
            held = part if held is None else [np.concatenate(p) for p in zip(held, part, strict=True)]
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0)) + 1
            last = int(new[-1]) if len(new) else 0
            if last:
                yield links_of(held[3][:last], np.concatenate([[0], new]))
                held = [c[last:] for c in held]
        if held is not None and len(held[0]):
            yield links_of(held[3], np.array([0, len(held[0])]))

    def links_of(fps: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        values, sizes = fps.view(np.uint64), np.diff(cuts)
        small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        # groups keep their order among the small ones
        until = np.cumsum(sizes * (sizes <= SMALL))
        label = np.arange(len(values))
        label[small] = small[spanned(len(small), pairs_of_small(values[small], np.repeat(until, sizes * (sizes <= SMALL)), radius))]
        for g in np.flatnonzero(sizes > SMALL):
            i, j = int(cuts[g]), int(cuts[g + 1])
            label[i:j] = i + spanned(j - i, pairs_within(values[i:j], radius))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[label[moved]])], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) among distinct ``fp`` that join all fingerprints within ``radius`` bits.

    A key with more than GROUP members is dealt into slices, every two of which are a group of
    their own, so no task holds more than GROUP members at once.
    """
    keyed = _keyed(fps, radius)
    half = GROUP // 2
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slices = F.when(F.col("n") <= GROUP, 1).otherwise(F.ceil(F.col("n") / (half * 0.9))).cast("int")
    dealt = keyed.join(counts.select("key", slices.alias("s")), "key").withColumn("mine", F.pmod(F.xxhash64("fp", F.lit("slice")), "s").cast("int"))
    others = F.expr("case when s = 1 then array(struct(0 as x, 0 as y)) else "
                    "transform(filter(sequence(0, s - 1), o -> o != mine), o -> struct(least(o, mine) as x, greatest(o, mine) as y)) end")
    groups = dealt.select("key", F.explode(others).alias("at"), "fp").select("key", "at.x", "at.y", "fp")
    return groups.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "fp").mapInArrow(_compare(radius), "a bigint, b bigint")


def simhash_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (smallest key reachable).

    A text without words (null, empty, blank) has fingerprint 0 and is linked like any other;
    one with fewer words than a shingle is one shingle.  Rows with equal keys are one document:
    their fingerprints are linked.  A null key links nothing and has a null component.  Equal
    texts share a component; an empty table gives an empty table; other columns are not read.
    """
    signed = stored(fingerprints(docs, key, text, words), "signed")
    known = signed.where(F.col(key).isNotNull())
    classes = stored(known.groupBy("fp").agg(F.min(key).alias("low")), "classes")
    several = known.groupBy(key).agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a != z").select(key, "a")
    same = known.join(several, key).where("fp != a").select("a", F.col("fp").alias("b")).distinct()
    joined = stored(links(classes.select("fp"), radius).unionByName(same), "links")
    found = classes.join(components(joined).withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = found.groupBy("component").agg(F.min("low").alias("component_id"))
    named = stored(found.join(lowest, "component").select("fp", "component_id"), "named")
    discard(joined, classes)
    placed = lookup(signed, named, ["fp"])
    return placed.select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col(key).isNotNull(), F.col("component_id")).alias("component_id")
    )
