"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so that a question keeps its template
when its parameters change.  Windows of the template are hashed and joined with those of
the benchmark; the windows of one occurrence must cover enough of the item; and the values
behind the placeholders must be consistent: one value of the item always stands for one
value of the text, as in a question with new parameters, and different names for different
names.  Else the match is a common phrase with chance values.

Beside them, windows of the bare words are joined in the same way, so that a verbatim copy is
found whatever its placeholders are: an item of numbers and names only, a very short one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import groups_of, hash_spans, in_bitmap, key_bitmap, mix64, shingle_hashes, text_bytes, word_spans


@dataclass(frozen=True)
class LeakRules:
    #: Tokens of a window; a shorter item is one window of its own size.
    window: int = 8
    #: Items of fewer tokens have no template; they are found verbatim only.
    least: int = 4
    #: Windows with fewer words beside placeholders are no evidence.
    literals: int = 3
    #: Share of an item's windows that one occurrence must hold.
    coverage: float = 0.5
    #: Shift in tokens that insertions and deletions may cause within an occurrence.
    slack: int = 8
    #: Verbatim copies are found whatever their capitals (A-Z and those of Latin-1).
    any_case: bool = False


# Units that count as such after a number.
UNITS = frozenset(
    """cent cents cm day days degree degrees dollar dollars euro euros feet foot ft g gallon gallons gb gram grams hour
    hours inch inches kb kg kilogram kilograms kilometer kilometers kilometre kilometres km l lb lbs liter liters litre
    litres m mb meter meters metre metres mg mile miles min minute minutes ml mm month months mph ounce ounces oz pence
    percent pound pounds second seconds sec ton tonne tonnes tons week weeks yard yards year years""".split()
)

def _table(members: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members.encode())] = True
    return out


_DIGITS = _table("0123456789")
_IN_NUMBER = _table("0123456789.,:/%+-")
_CORE = _table("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CORE[128:] = True
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_LOWER[128:] = True
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_STOP, _CLOSER = _table(".!?:"), _table("\"')]")
_LITERAL = np.uint64(0x5851F42D4C957F2D)
_PLACE = {name: mix64(np.array([k], dtype=np.uint64))[0] for k, name in enumerate(("number", "unit", "name"), 1)}


def _hash_of(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return hash_spans(raw, ends - [len(w) for w in words], ends, fold=True)


_UNIT_HASHES = np.sort(_hash_of(sorted(UNITS)))


@dataclass
class Tokens:
    """Canonical tokens of a run of texts."""

    codes: np.ndarray
    slot: np.ndarray
    begin: np.ndarray  # byte span of the word behind a token
    end: np.ndarray
    owner: np.ndarray  # text
    place: np.ndarray  # number within the text
    capital: np.ndarray  # a word written like a name
    words: np.ndarray  # hashes of the words themselves


def canonical(raw: np.ndarray, part: np.ndarray, any_case: bool = True) -> Tokens:
    """Bare words in lower case (A-Z and the capitals of Latin-1) or placeholders.

    ``words`` keeps the words behind them, as written unless ``any_case``.

    Words without a letter or digit are no tokens.  A number begins with a digit and has at
    most two bytes beside digits and their separators; a unit is one of UNITS after a number;
    a name is a capitalised word that does not begin a sentence, a line or a text.
    """
    base = int(part[0])
    data = raw[base : int(part[-1])]
    starts, ends, firsts = word_spans(raw, part)
    owner = np.repeat(np.arange(len(part) - 1), np.diff(firsts))
    solid = np.flatnonzero(_CORE[data])
    low = np.searchsorted(solid, starts)
    high = np.searchsorted(solid, ends)
    keep = high > low
    last = data[ends - 1]
    stop = _STOP[last] | (_CLOSER[last] & (ends - starts > 1) & _STOP[data[np.maximum(ends - 2, 0)]])
    n = len(starts)
    opens = np.ones(n, dtype=bool)  # begins a sentence, a line or a text
    if n > 1:
        opens[1:] = stop[:-1] | (owner[1:] != owner[:-1]) | (data[starts[1:] - 1] == 10)
    begin, end = solid[low[keep]], solid[high[keep] - 1] + 1
    owner, opens = owner[keep], opens[keep]
    folded = data
    wide = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    wide = wide[(data[wide] >= 0x80) & (data[wide] <= 0x9E) & (data[wide] != 0x97)]
    if len(wide):
        folded = data.copy()
        folded[wide] += 0x20
    codes = hash_spans(folded, begin, end, fold=True)
    others = np.concatenate([[0], np.cumsum(~_IN_NUMBER[data])])
    number = _DIGITS[data[begin]] & (others[end] - others[begin] <= 2)
    small = np.concatenate([[0], np.cumsum(_LOWER[data])])
    is_wide = np.zeros(len(data) + 1, dtype=bool)
    is_wide[wide] = True
    head = np.where(is_wide[np.minimum(begin + 1, len(data))], 2, 1)
    capital = (_UPPER[data[begin]] | (head == 2)) & (small[end] > small[np.minimum(begin + head, end)]) & ~number
    after = np.zeros(len(codes), dtype=bool)
    after[1:] = number[:-1] & (owner[1:] == owner[:-1])
    unit = after & ~number
    unit[unit] = np.isin(codes[unit], _UNIT_HASHES)
    capital &= ~unit
    name = capital & ~opens
    out = np.select([number, unit, name], [_PLACE["number"], _PLACE["unit"], _PLACE["name"]], codes)
    per = np.bincount(owner, minlength=len(part) - 1)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    words = codes if any_case else hash_spans(data, begin, end)
    return Tokens(out, number | unit | name, begin + base, end + base, owner, place, capital, words)


def template_windows(t: Tokens, n: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of the windows of ``n`` tokens within one text that say enough."""
    m = len(t.codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slots = np.concatenate([[0], np.cumsum(t.slot)])
    at = np.flatnonzero((t.owner[:m] == t.owner[n - 1 :]) & (n - (slots[n:] - slots[:m]) >= min(literals, n)))
    return at, shingle_hashes(t.codes, n)[at].view(np.int64)


def literal_windows(t: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of all windows of ``n`` words within one text."""
    m = len(t.words) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(t.owner[:m] == t.owner[n - 1 :])
    return at, mix64(shingle_hashes(t.words, n)[at] ^ _LITERAL).view(np.int64)


def _values(t: Tokens, raw: np.ndarray, at: int, n: int) -> list[str]:
    """Lower-case words behind the placeholders of a window, each marked with its kind."""
    out = []
    for k in np.flatnonzero(t.slot[at : at + n]) + at:
        word = raw[t.begin[k] : t.end[k]].tobytes().decode("utf-8", "replace").lower()
        out.append(("n:" if t.codes[k] == _PLACE["name"] else "v:") + word)
    return out


def item_windows(benchmark: DataFrame, item: str, text: str, rules: LeakRules) -> DataFrame:
    """(hash, item, item_pos, size, windows, item_values, literal) of the benchmark's windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            rows, hashes, place, size, total, values, literal = [], [], [], [], [], [], []
            for i in range(batch.num_rows):
                t = canonical(raw, offsets[i : i + 2], rules.any_case)
                if not len(t.codes):
                    continue
                n = min(rules.window, len(t.codes))
                at, found = literal_windows(t, n)
                rows += [i] * len(at)
                hashes += found.tolist()
                place += t.place[at].tolist()
                size += [n] * len(at)
                total += [len(at)] * len(at)
                values += [[]] * len(at)
                literal += [True] * len(at)
                if len(t.codes) < rules.least:
                    continue
                kinds = [(t, *template_windows(t, n, rules.literals))]
                if t.capital[0]:  # put into a sentence, its first word looks like a name
                    codes, slot = t.codes.copy(), t.slot.copy()
                    codes[0], slot[0] = _PLACE["name"], True
                    inner = replace(t, codes=codes, slot=slot)
                    at, found = template_windows(inner, n, rules.literals)
                    kinds.append((inner, at[at == 0], found[at == 0]))
                count = len(set(np.concatenate([at for _, at, _ in kinds]).tolist()))
                for shape, at, found in kinds:
                    for a, h in zip(at, found, strict=True):
                        rows.append(i)
                        hashes.append(h)
                        place.append(int(t.place[a]))
                        size.append(n)
                        total.append(count)
                        values.append(_values(shape, raw, a, n))
                        literal.append(False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), batch.column(0).take(pa.array(rows, pa.int64())), pa.array(place, pa.int32()),
                 pa.array(size, pa.int32()), pa.array(total, pa.int32()), pa.array(values, pa.list_(pa.string())), pa.array(literal, pa.bool_())],
                ["hash", item, "item_pos", "size", "windows", "item_values", "literal"],
            )

    kind = benchmark.schema[item].dataType.simpleString()
    source = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item), F.col(text).cast("string"))
    return source.mapInArrow(cut, f"hash bigint, `{item}` {kind}, item_pos int, size int, windows int, item_values array<string>, literal boolean")


def text_windows(docs: DataFrame, windows: DataFrame, key: str, text: str, rules: LeakRules) -> DataFrame:
    """(key, hash, pos, values) of the texts' windows that a bitmap of the benchmark's lets pass."""
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # at most `window` numbers
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(windows, "hash"))  # fixed size

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for i, j in groups_of(offsets):
                t = canonical(raw, offsets[i : j + 1], rules.any_case)
                rows, hashes, place, values = [], [], [], []
                for n in sizes:
                    at, found = literal_windows(t, n)
                    hit = in_bitmap(bitmap.value, found)
                    rows += (i + t.owner[at[hit]]).tolist()
                    hashes += found[hit].tolist()
                    place += t.place[at[hit]].tolist()
                    values += [[]] * int(hit.sum())
                    if n < rules.least:
                        continue
                    at, found = template_windows(t, n, rules.literals)
                    hit = in_bitmap(bitmap.value, found)
                    for a, h in zip(at[hit], found[hit], strict=True):
                        rows.append(i + t.owner[a])
                        hashes.append(h)
                        place.append(t.place[a])
                        values.append(_values(t, raw, a, n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(hashes, pa.int64()), pa.array(place, pa.int32()),
                     pa.array(values, pa.list_(pa.string()))],
                    [key, "hash", "pos", "values"],
                )

    kind = docs.schema[key].dataType.simpleString()
    source = docs.where(F.col(key).isNotNull()).select(F.col(key), F.col(text).cast("string"))
    return source.mapInArrow(probe, f"`{key}` {kind}, hash bigint, pos int, values array<string>")


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", rules: LeakRules = LeakRules(),
) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other parameters.

    One row per document and item: key, item, coverage (share of the item's windows in its
    best occurrence), first_token (of that occurrence), slots (placeholders compared, none
    if only its bare words were), changed (of them with another value) and verbatim.  An
    item without a token, null texts and null keys match nothing.  Equal items are each reported, equal
    rows are one document, an empty table on either side gives an empty table.
    """
    windows = item_windows(benchmark, item, item_text, rules)
    named = windows.select("hash", F.col(item).alias("__item"), "item_pos", "windows", "item_values", "literal")
    hits = text_windows(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), windows, "__key", "__text", rules)
    matched = hits.join(named, "hash").distinct()
    # shifts of one occurrence may fall on a border: two rounds of buckets, half a bucket apart
    shift, wide = F.col("pos") - F.col("item_pos"), 2 * rules.slack
    runs = matched.withColumn("run", F.explode(F.array(
        F.struct(F.lit(0).alias("round"), F.floor(shift / wide).alias("bucket")),
        F.struct(F.lit(1).alias("round"), F.floor((shift + rules.slack) / wide).alias("bucket")),
    )))
    occurrence = ["__key", "__item", "literal", "run"]
    # an item that repeats its template also matches itself some tokens on: of two matches at one
    # place of the item or of the text, the one whose exact shift has more of the windows is meant
    runs = runs.withColumn("shift", shift)
    runs = runs.withColumn("weight", F.struct(F.count(F.lit(1)).over(Window.partitionBy(*occurrence, "shift")), -F.col("shift")))
    top = {name: F.max("weight").over(Window.partitionBy(*occurrence, *by)) for name, by in
           {"main": [], "of_item": ["item_pos"], "of_text": ["pos"]}.items()}
    runs = runs.select("*", *[(F.col("weight") == best).alias(name) for name, best in top.items()])

    def part(which: Column) -> Column:
        return F.struct(
            F.size(F.collect_set(F.when(which, F.col("item_pos")))).alias("held"), F.min(F.when(which, F.col("pos"))).alias("first_token"),
            F.array_distinct(F.flatten(F.collect_set(F.when(which, F.arrays_zip("item_values", "values"))))).alias("pairs"),
        )

    # all matches, those aligned, those of the main shift, those with the item's own values:
    # any of them may be the occurrence; bounded, as it spans at most the item and its slack
    parts = [F.lit(True), F.col("of_item") & F.col("of_text"), F.col("main"), F.col("item_values") == F.col("values")]
    found = runs.groupBy(*occurrence).agg(
        F.max("windows").alias("windows"), F.array(*[part(p) for p in parts]).alias("parts")
    ).select("__key", "__item", "windows", F.inline("parts")).where((F.col("held") > 0) & (F.col("held") >= rules.coverage * F.col("windows")))
    items, texts = F.col("pairs.item_values"), F.col("pairs.values")
    names = F.filter("pairs", lambda p: p["item_values"].startswith("n:"))
    consistent = (F.size(F.array_distinct(items)) == F.size("pairs")) & (
        F.size(F.array_distinct(F.transform(names, lambda p: p["values"]))) == F.size(names)
    )
    changed = F.size(F.filter("pairs", lambda p: p["item_values"] != p["values"]))
    best = found.withColumn("changed", changed).where(consistent | (F.col("changed") == 0)).groupBy("__key", "__item").agg(
        F.max(F.struct(
            (F.col("held") / F.col("windows")).alias("coverage"), (-F.col("changed")).alias("unchanged"),
            (-F.col("first_token")).alias("at"), F.size("pairs").alias("slots"),
        )).alias("b")
    )
    return best.select(
        F.col("__key").alias(key), F.col("__item").alias(item), "b.coverage", (-F.col("b.at")).alias("first_token"),
        "b.slots", (-F.col("b.unchanged")).alias("changed"), (F.col("b.unchanged") == 0).alias("verbatim"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", rules: LeakRules = LeakRules()) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    found = leaks(docs, benchmark, key, text, rules=rules).select(F.col(key).alias("__leak")).distinct()
    return docs.join(found, docs[key] == F.col("__leak"), "left_anti")
