"""Line deduplication by a segment-partition edit join.

A line of length L is split into ``tau + 1`` segments; a line within ``tau`` edits keeps one
of them unchanged.  Segments are indexed by (L, number, content).  A line probes the
indexes of its own length and of up to ``tau`` less, with the substrings whose start can
still match once edits on both sides are counted.  Pairs that share a key are verified by
a banded bit-parallel edit distance.  Lengths and edits count characters.

Lines too short for edits are grouped by their digest alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import _MASK, _power_tables, groups_of, in_bitmap, key_bitmap, mix64, stored, text_bytes
from millrace.llm.linking import linked

TAU = 2
#: Shorter lines are compared by equality only: two edits would change what they say.
MIN_CHARS = 24
_FULL = (1 << 64) - 1
_ONE = np.uint64(0x9FB21C651E98DF25)
_TWO = np.uint64(0xD6E8FEB86659FD93)


def edit_distance(a: str, b: str, tau: int) -> int:
    """Edit distance of two strings, or ``tau + 1`` if it is more (``tau`` at most 31).

    Equal ends are cut off.  Then one column of the distance matrix after the other is kept
    as vertical differences of the cells within ``tau`` of the diagonal, in one 64-bit word
    that moves down with the diagonal (Hyyro's banded form of Myers' algorithm).
    """
    n = min(len(a), len(b))
    if abs(len(a) - len(b)) > tau:
        return tau + 1
    start = 0
    while start < n and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < n - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n <= 1:  # all of the longer goes, but for a character that is in it
        far = m - (n == 1 and b in a)
        return far if far <= tau else tau + 1
    if m <= tau:  # m is an upper bound; the band must be narrower than the strings
        return edit_distance(a, b, m - 1)
    # bit 63 is the row tau below the diagonal, bit 63 - d the row d above that
    up, down = (_FULL << (63 - tau)) & _FULL, 0
    score, mark = tau, 1 << 62
    for j in range(n):
        match = 0
        for d in range(2 * tau + 1):
            row = j + tau - d
            if 0 <= row < m and a[row] == b[j]:
                match |= 1 << (63 - d)
        zero = ((((match & up) + up) ^ up) | match | down) & _FULL
        right, left = (down | ~(zero | up)) & _FULL, zero & up
        if j < m - tau:  # the lowest row of the band follows the diagonal
            score += not zero >> 63
            if score > 2 * tau + n - m + tau:
                return tau + 1
        else:  # the last row of the matrix is in the band: go along it
            score += bool(right & mark) - bool(left & mark)
            mark >>= 1
        up, down = (left | ~((zero >> 1) | right)) & _FULL, (zero >> 1) & right
    return score if score <= tau else tau + 1


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


class _Lines:
    """Lines of a run of texts with prefix sums of their characters."""

    def __init__(self, raw: np.ndarray, part: np.ndarray, min_chars: int):
        data = raw[int(part[0]) : int(part[-1])]
        self.text = data.tobytes().decode("utf-8", "replace")
        self.chars = np.frombuffer(self.text.encode("utf-32-le"), dtype="<u4")
        first_byte = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        docs = first_byte[part - part[0]]  # character offsets of the texts
        breaks = np.flatnonzero(self.chars == 10)
        # a line begins at each text's start and after each line feed inside it
        inside = breaks[np.searchsorted(docs, breaks, "right") <= len(docs) - 1] if len(docs) > 1 else breaks
        begin = np.concatenate([docs[:-1], inside + 1])
        owner = np.concatenate([np.arange(len(docs) - 1), np.searchsorted(docs, inside, "right") - 1])
        order = np.lexsort((begin, owner))
        begin, owner = begin[order], owner[order]
        nexts = np.concatenate([begin[1:] - 1, docs[-1:]])
        last = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(owner) else np.zeros(0, bool)
        self.end = np.where(last, docs[owner + 1], nexts)
        self.begin, self.owner = begin, owner
        per_doc = np.bincount(owner, minlength=len(docs) - 1)
        self.number = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        up, self.down = _power_tables(len(self.chars) + 1)
        self.sums = np.zeros(len(self.chars) + 1, dtype=np.uint64)
        np.cumsum(mix64(self.chars.astype(np.uint64) * _ONE + _TWO) * up[: len(self.chars)], out=self.sums[1:])
        solid = np.concatenate([[0], np.cumsum((self.chars != 32) & ((self.chars < 9) | (self.chars > 13)))])
        keep = (self.end - self.begin >= min_chars) & (solid[self.end] > solid[self.begin])
        self.begin, self.end, self.owner, self.number = (x[keep] for x in (self.begin, self.end, self.owner, self.number))
        self.ids = mix64(self.part(self.begin, self.end) + (self.end - self.begin).astype(np.uint64) * _TWO).view(np.int64)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def keys(self, at: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """(line, key, indexed) of segments and probes of the chosen lines."""
        begin, size = self.begin[at], self.end[at] - self.begin[at]
        out = []
        for less in range(tau + 1):
            length = size - less  # of the indexed line
            base, extra = length // (tau + 1), length % (tau + 1)
            for i in range(tau + 1):  # the last `extra` segments are one longer
                wide = i - (tau + 1 - extra)
                start, width = base * i + np.maximum(wide, 0), base + (wide >= 0)
                for move in range(max(-i, less - (tau - i)), min(i, less + (tau - i)) + 1):
                    p = start + move
                    ok = (p >= 0) & (p + width <= size) & (width > 0)
                    s = begin[ok] + p[ok]
                    key = self.part(s, s + width[ok]) + length[ok].astype(np.uint64) * _TWO + np.uint64((i + 1) * int(_ONE) & _MASK)
                    out.append((at[ok], mix64(key).view(np.int64), less == 0 and move == 0))
        return out


def _lines_of(column: pa.Array, min_chars: int) -> Iterator[tuple[int, _Lines]]:
    raw, offsets = text_bytes(column)
    for i, j in groups_of(offsets, 1 << 19):
        yield i, _Lines(raw, offsets[i : j + 1], min_chars)


def line_table(docs: DataFrame, key: str, text: str, tau: int, min_chars: int, exact_chars: int) -> DataFrame:
    """(key, line_no, line_id, indexed keys, probe keys) of every line of ``exact_chars`` characters;
    keys once per batch and line, from ``min_chars`` characters on."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.zeros(0, dtype=np.int64)
            for first, lines in _lines_of(batch.column(1), min(exact_chars, min_chars)):
                n = len(lines.ids)
                if not n:
                    continue
                _, fresh = np.unique(lines.ids, return_index=True)
                fresh = np.sort(fresh[~np.isin(lines.ids[fresh], seen)])
                seen = np.concatenate([seen, lines.ids[fresh]])
                found = lines.keys(fresh[(lines.end - lines.begin)[fresh] >= min_chars], tau)
                lists = []
                for kind in (True, False):
                    at = np.concatenate([a for a, _, x in found if x is kind] or [np.zeros(0, np.int64)])
                    values = np.concatenate([k for _, k, x in found if x is kind] or [np.zeros(0, np.int64)])
                    order = np.argsort(at, kind="stable")
                    ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + lines.owner)), pa.array(lines.number.astype(np.int32)), pa.array(lines.ids), *lists],
                    [key, "line_no", "line_id", "segments", "probes"],
                )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.where(F.col(key).isNotNull()).select(F.col(key), F.col(text).cast("string"))
    return source.mapInArrow(split, f"`{key}` {kind}, line_no int, line_id bigint, segments array<bigint>, probes array<bigint>")


def _members(lines: DataFrame) -> DataFrame:
    """(key, id, indexed) of the keys that an indexed line shares with another line."""
    rows = lines.where(F.size("segments") > 0).select("line_id", "segments", "probes")
    exploded = rows.select("line_id", F.explode("segments").alias("key"), F.lit(True).alias("indexed")).unionByName(
        rows.select("line_id", F.explode("probes").alias("key"), F.lit(False).alias("indexed"))
    )
    shared = stored(
        exploded.groupBy("key").agg(
            F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.max("indexed").alias("indexed")
        ).where("indexed and low != high").select("key"), "keys",
    )
    bitmap = rows.sparkSession.sparkContext.broadcast(key_bitmap(shared, "key"))  # fixed size

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for column, indexed in ((1, True), (2, False)):
                lists = batch.column(column)
                keys = lists.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                hit = in_bitmap(bitmap.value, keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[hit]), batch.column(0).take(pa.array(owner[hit])), pa.array(np.full(int(hit.sum()), indexed))],
                    ["key", "id", "indexed"],
                )

    few = rows.mapInArrow(thin, "key bigint, id bigint, indexed boolean")
    return few.groupBy("key", "id").agg(F.max("indexed").alias("indexed")).join(shared, "key", "left_semi")


def gram_parities(chars: np.ndarray) -> list[int]:
    """For runs of 1, 2 and 3 characters, the parity of how often each of 64 or 128 buckets of
    them occurs, as longs.  One edit removes and adds at most q runs of q, so it changes at
    most 2 q parities."""
    out: list[int] = []
    values = mix64(chars.astype(np.uint64) + _ONE)
    grams = values
    for q in (1, 2, 3):
        if q > 1:
            grams = mix64(grams[:-1] * _TWO + values[q - 1 :]) if len(values) >= q else values[:0]
        size = 64 if q == 1 else 128
        odd = np.bincount((grams >> np.uint64(40)).astype(np.int64) % size, minlength=size) & 1
        out += np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()
    return out


def may_be_near(tau: int):
    """Test of two lines by their parities; it rules out no pair within ``tau`` edits."""

    def alike(x: Column, y: Column) -> Column:
        differ = [F.bit_count(x["grams"][i].bitwiseXOR(y["grams"][i])) for i in range(5)]
        return (differ[0] <= 2 * tau) & (differ[1] + differ[2] <= 4 * tau) & (differ[3] + differ[4] <= 6 * tau)

    return alike


def _texts(docs: DataFrame, ids: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(id, line, grams) of the wanted lines, from one more pass over the texts."""
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(ids, "id"))  # fixed size

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _lines_of(batch.column(0), min_chars):
                at = np.flatnonzero(in_bitmap(bitmap.value, lines.ids))
                _, once = np.unique(lines.ids[at], return_index=True)
                at = at[once]
                found = [lines.text[lines.begin[k] : lines.end[k]] for k in at]
                grams = [gram_parities(lines.chars[lines.begin[k] : lines.end[k]]) for k in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.ids[at]), pa.array(found, pa.string()), pa.array(grams, pa.list_(pa.int64()))], ["id", "line", "grams"]
                )

    source = docs.select(F.col(text).cast("string"))
    found = source.mapInArrow(pick, "id bigint, line string, grams array<bigint>").join(ids, "id", "left_semi")
    return found.groupBy("id").agg(F.first("line").alias("line"), F.first("grams").alias("grams"))


def _confirm(texts: DataFrame, tau: int):
    """Pairs (a, b) whose lines are within ``tau`` edits."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = [edit_distance(x, y, tau) <= tau for x, y in zip(one, two, strict=True)]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    def confirm(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("one")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("two")), "b")
            .where(F.abs(F.length("one") - F.length("two")) <= tau)
        )
        return both.select("a", "b", "one", "two").mapInArrow(near, "a bigint, b bigint")

    return confirm


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tau: int = TAU, min_chars: int = MIN_CHARS, exact_chars: int | None = None,
) -> DataFrame:
    """Every line that has an equal or near equal line elsewhere.

    One row per occurrence: key, line_no (from 0), line_id (a digest of the line), class_key
    and class_line_no (first occurrence of its class, by key and line number), class_lines
    (occurrences in the class), ``exact`` (the first occurrence has the same text) and
    ``kept`` (it is that first one).  A class joins lines by chains of at most ``tau`` edits.

    Lines of ``exact_chars`` (``min_chars`` if not given) to ``min_chars`` characters are joined
    with equal lines only.  Shorter ones or those without a word take no part, nor do rows
    with a null key; null and empty texts have no lines.  Rows with equal key and text count
    as one row and each comes out.  A very long line is compared whole.
    """
    lines = stored(line_table(docs, key, text, tau, min_chars, min_chars if exact_chars is None else exact_chars), "lines")
    shared = stored(_members(lines), "members")
    texts = stored(_texts(docs, shared.select("id").distinct(), text, min_chars), "texts")
    members = stored(shared.join(texts.select("id", "grams"), "id"), "members")
    classes = linked(members, _confirm(texts, tau), may_be_near(tau))
    each = lines.groupBy("line_id").agg(F.min(F.struct(key, "line_no")).alias("first"), F.count(F.lit(1)).alias("n"))
    named = each.join(classes.withColumnRenamed("id", "line_id"), "line_id", "left").withColumn("class", F.coalesce("component", "line_id"))
    total = named.groupBy("class").agg(
        F.min(F.struct("first", "line_id")).alias("top"), F.sum("n").alias("class_lines")
    ).where("class_lines > 1")
    info = named.select("line_id", "class").join(total, "class").select("line_id", "top", "class_lines")
    return lines.select(key, "line_no", "line_id").join(info, "line_id").select(
        key, "line_no", "line_id",
        F.col(f"top.first.{key}").alias("class_key"), F.col("top.first.line_no").alias("class_line_no"), "class_lines",
        (F.col("line_id") == F.col("top.line_id")).alias("exact"),
        ((F.col(key) == F.col(f"top.first.{key}")) & (F.col("line_no") == F.col("top.first.line_no"))).alias("kept"),
    )


def deduplicate_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tau: int = TAU, min_chars: int = MIN_CHARS, exact_chars: int | None = None,
) -> DataFrame:
    """``docs`` without the repeated lines; a text of which nothing is left goes.

    Columns stay as they are, but for ``n_chars``, which follows the text if it is there.
    Texts without a repeated line, rows with a null key and null texts stay unchanged; rows of
    equal key and different texts are documents of their own.
    """
    # a row goes by its key and its text, as rows of equal keys may hold different texts
    row = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text")))
    gone = repeated_lines(docs.select(row.alias("__row"), F.col(text)), "__row", text, tau, min_chars, exact_chars).where("not kept")
    per_doc = gone.groupBy(F.col("__row").alias("__key")).agg(F.collect_set("line_no").alias("__gone"))  # a document's own lines
    lines = F.split(F.col(text), "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    out = docs.withColumn("__row", row).join(per_doc, F.col("__row") == F.col("__key"), "left").withColumn(
        "__left", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(left)
    ).where(F.col("__gone").isNull() | (F.length(F.trim("__left")) > 0))
    columns = []
    for f in docs.schema.fields:
        if f.name == text:
            columns.append(F.col("__left").alias(text))
        elif f.name == "n_chars" and isinstance(f.dataType, T.IntegralType):
            columns.append(F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("__left")).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"`{f.name}`"))
    return out.select(*columns)
