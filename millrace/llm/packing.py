"""Best-fit packing of token sequences with linear grouping and few configurations.

The number of possible lengths is the capacity, so the whole corpus is described by one
count per length.  The plan is made from these counts alone:

1. lengths above a threshold are sorted and cut into groups of equal cardinality; each
   length counts as the largest of its group (linear grouping);
2. with so few sizes, the configurations (which sizes share a sequence) are optimised by
   a linear program with column generation, and rounded down;
3. actual documents take the places of their group, so that a sequence gains what the
   rounding had added;
4. what is left over and the small lengths go by decreasing best fit into the gaps.

Plans hold runs of like sequences, so their size depends on the capacity and not on the
corpus.  Rows then look up their place by (length, number within the length).
"""

from __future__ import annotations

import array
import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered, stored

CAPACITY = 2048
MEMO_ENTRIES = 400_000


# --- token ids --------------------------------------------------------------------------

#: White space other than a single blank or line feed between words.
_IRREGULAR = re.compile(r"[^\S \n]|[ \n][ \n]|[ \n]\Z|\x00")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


class _Units(dict):
    """Little-endian unsigned 32-bit ids by unit of text.

    A unit runs from white space to the next white space.  No match of the vocabulary's
    splitting pattern crosses from a word into the white space after it, so units are
    encoded alone.  A key stands for itself with a blank before it, or, marked with NUL
    or beginning with a line feed, for itself.  The strings of ``added`` tokens are matched
    first, longest at a place, and part the text.
    """

    def __init__(self, encode, added: dict[str, int]):
        super().__init__()
        self.encode = encode
        self.added = {token: array.array("I", [i]).tobytes() for token, i in added.items()}
        self.parting = re.compile("(%s)" % "|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def __missing__(self, unit: str) -> bytes:
        if len(unit) > 2 and unit[-1] in ".," and unit[-2].isalpha():
            ids = self[unit[:-1]] + self["\0" + unit[-1]]
        else:
            text = unit[1:] if unit[:1] == "\0" else unit if unit[:1] == "\n" else " " + unit
            ids = array.array("I", self.encode(text)).tobytes()
        self[unit] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        if self.parting and self.parting.search(text):
            parts = self.parting.split(text)
            return b"".join(self.added[part] if i % 2 else self.plain(part) for i, part in enumerate(parts))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if _IRREGULAR.search(text):
            units = ["\0" + u for u in _CUT.split(text)]
        else:
            units = text.replace("\n", " \n").split(" ")
            if units[0]:
                units[0] = "\0" + units[0]
            else:
                del units[0]
        return b"".join(map(self.__getitem__, units))


_encoders: dict[str, _Units] = {}


def token_units(vocabulary: str) -> _Units:
    """The memo of a vocabulary, one per Python worker; its added tokens are those of the ``.json`` file.

    ``vocabulary`` names a byte-level BPE of `public_tokenizers` by its ``.json`` file; the
    same vocabulary as ranks gives the same ids several times faster on short units.
    """
    if vocabulary not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary.replace(".json", ".tiktoken")), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(public_tokenizers.path(vocabulary), "rb") as f:
            added = {token["content"]: token["id"] for token in json.load(f)["added_tokens"]}
        coder = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encoders[vocabulary] = _Units(coder.encode_ordinary, added)
    return _encoders[vocabulary]


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first are full."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Pieces (key, piece, start, length, ids_crc32[, ids]) of all texts, ``end_id`` closing each."""
    end = array.array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = token_units(vocabulary)
        for batch in batches:
            keys, rows, part, start, length, crc, ids = batch.column(0), [], [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                raw = units.ids(value.as_py() or "") + end
                view = memoryview(raw)
                for p, (s, n) in enumerate(piece_bounds(len(raw) // 4, capacity)):
                    rows.append(row)
                    part.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(view[4 * s : 4 * (s + n)]))
                    if with_ids:
                        ids.append(np.frombuffer(view[4 * s : 4 * (s + n)], dtype="<u4").astype(np.int32))
            columns = [keys.take(pa.array(rows, pa.int64())), pa.array(part, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


# --- the plan ---------------------------------------------------------------------------


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: the linear program, rounded down.

    Columns enter by the knapsack over the dual prices; the basis starts with one size each.
    """
    m = len(sizes)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    need = np.array(demand, dtype=float)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(m))
        # best value for each capacity, and the size taken last
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        order = np.array(sizes)
        for c in range(min(sizes), capacity + 1):
            fits = np.flatnonzero((order <= c) & (price > 1e-12))
            best, pick = value[c - 1], -1
            if len(fits):
                gains = value[c - order[fits]] + price[fits]
                g = int(np.argmax(gains))
                if gains[g] > best + 1e-12:
                    best, pick = gains[g], int(fits[g])
            value[c], last[c] = best, pick
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if last[c] >= 0:
                column[last[c]] += 1
                c -= sizes[last[c]]
            else:
                c -= 1
        now, enter = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        rising = enter > 1e-9
        if not rising.any():
            break
        ratios = np.where(rising, now / np.where(rising, enter, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    use = np.floor(np.linalg.solve(basis, need) + 1e-7).astype(np.int64)
    return [(basis[:, k].astype(int), int(u)) for k, u in enumerate(use) if u > 0]


@dataclass
class _Run:
    """``n`` sequences alike: free room, and (length, first number, copies each, offset)."""

    n: int
    free: int
    parts: list[tuple[int, int, int, int]]

    def split(self, k: int) -> tuple[_Run, _Run]:
        head = _Run(k, self.free, list(self.parts))
        tail = _Run(self.n - k, self.free, [(ln, at + k * c, c, off) for ln, at, c, off in self.parts])
        return head, tail


def _take(queue: list[list[int]], n: int) -> list[tuple[int, int, int]]:
    """The next n documents of a queue of (length, first number, count) as such runs."""
    out = []
    while n:
        length, at, count = queue[0]
        k = min(n, count)
        out.append((length, at, k))
        n -= k
        if k == count:
            queue.pop(0)
        else:
            queue[0] = [length, at + k, count - k]
    return out


def _plan_once(counts: dict[int, int], capacity: int, threshold: int, groups: int) -> list[_Run]:
    runs: list[_Run] = []
    if counts.get(capacity):
        runs.append(_Run(counts[capacity], 0, [(capacity, 0, 1, 0)]))
    large = [[ln, 0, counts[ln]] for ln in sorted(counts, reverse=True) if threshold < ln < capacity]
    rest: list[list[int]] = []
    total = sum(r[2] for r in large)
    if total:
        per = -(-total // groups)
        queues: dict[int, list[list[int]]] = {}
        pool = [list(r) for r in large]
        while pool:
            group = _take(pool, min(per, sum(r[2] for r in pool)))
            queues.setdefault(group[0][0], []).extend([list(r) for r in group])
        sizes = sorted(queues, reverse=True)
        demand = [sum(r[2] for r in queues[s]) for s in sizes]
        for column, use in configurations(sizes, demand, capacity):
            made = [_Run(use, capacity, [])]
            for g, copies in enumerate(column):
                for _ in range(copies):
                    left = sum(r[2] for r in queues[sizes[g]])
                    if not left:
                        continue
                    filled, i = [], 0
                    todo = _take(queues[sizes[g]], min(left, sum(r.n for r in made)))
                    while i < len(made):
                        run = made[i]
                        i += 1
                        if not todo:
                            filled.append(run)
                            continue
                        length, at, count = todo.pop(0)
                        if count < run.n:
                            run, tail = run.split(count)
                            made.insert(i, tail)
                        elif count > run.n:
                            todo.insert(0, (length, at + run.n, count - run.n))
                        run.parts.append((length, at, 1, capacity - run.free))
                        run.free -= length
                        filled.append(run)
                    made = filled
            runs += [r for r in made if r.parts]
        rest = [r for s in sizes for r in queues[s]]
    rest += [[ln, 0, counts[ln]] for ln in counts if ln <= threshold]
    rest.sort(key=lambda r: (-r[0], r[1]))
    # decreasing best fit of whole runs: the tightest room is filled as often as it takes
    runs.sort(key=lambda r: r.free)
    keys = [r.free for r in runs]

    def put(run: _Run) -> None:
        i = bisect.bisect_left(keys, run.free)
        keys.insert(i, run.free)
        runs.insert(i, run)

    for length, at, count in rest:
        while count:
            i = bisect.bisect_left(keys, length)
            if i == len(runs):
                put(_Run(-(-count // (capacity // length)), capacity, []))
                i = bisect.bisect_left(keys, length)
            run = runs.pop(i)
            keys.pop(i)
            copies = run.free // length
            if count < copies:
                copies = count
            k = min(run.n, count // copies)
            if k < run.n:
                run, tail = run.split(k)
                put(tail)
            run.parts.append((length, at, copies, capacity - run.free))
            run.free -= copies * length
            at += k * copies
            count -= k * copies
            put(run)
    return runs


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, cuts=(4, 3, 8, 2, 16), groups=(24, 48)) -> list[_Run]:
    """The plan of fewest sequences over a few thresholds (capacity / cut) and group numbers.

    Stops at the first that meets the bound total length / capacity.
    """
    bound = -(-sum(ln * n for ln, n in counts.items()) // capacity)
    best: list[_Run] | None = None
    size = 0
    for g in groups:
        for cut in cuts:
            runs = [r for r in _plan_once(counts, capacity, capacity // cut, g) if r.parts]
            used = sum(r.n for r in runs)
            if best is None or used < size:
                best, size = runs, used
            if size == bound:
                return best
    return best or []


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k.json", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    A null or empty text is the end id alone.  Texts longer than the capacity are cut into
    full pieces after a shorter first one; no other text is cut.  Repeated rows are packed
    each.  An empty table gives an empty table.  Other columns of the input are not read.
    """
    pieces = stored(token_pieces(docs, key, text, capacity, vocabulary, 0, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows
    rows, base = [], 0
    for run in plan_sequences(counts, capacity):
        rows += [(ln, at, c, run.n * c, base, off) for ln, at, c, off in run.parts]
        base += run.n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 6)
    shift = np.int64(1) << np.int64(46)  # numbers within a length stay below it
    starts = table[:, 0] * shift + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            number = batch.column(batch.schema.get_field_index("number")).to_numpy()
            at = np.searchsorted(starts, length * shift + number, "right") - 1
            within = number - table[at, 1]
            keep = [i for i, f in enumerate(batch.schema) if f.name != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep]
                + [pa.array(table[at, 4] + within // table[at, 2]), pa.array(table[at, 5] + within % table[at, 2] * length)],
                [batch.schema.names[i] for i in keep] + ["sequence_id", "offset"],
            )

    ranked = numbered(pieces, ["length"], [key, "piece", "ids_crc32", "start"], "number")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*pieces.columns, "number").mapInArrow(place, fields + ", sequence_id bigint, `offset` bigint")
