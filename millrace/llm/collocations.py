"""Phrase collocations from sorted count streams.

N-grams are counted over whole texts: words and pairs first, then the triples whose two
pairs are frequent (no other triple can be).  The counts are laid out as streams.  In prefix
order a word is followed by its pairs and each pair by its triples, so one lockstep pass
gives every n-gram the counts of the parts it begins with, and every pair its most frequent
extension to the right; the stream in suffix order gives the other side.  No count is looked
up by hash: the streams are range partitioned and small carries link their parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import discard, groups_of, hash_spans, in_bitmap, key_bitmap, mix64, stored, text_bytes
from millrace.operators.skew import fill_nearest


@dataclass(frozen=True)
class PhraseRules:
    #: Least occurrences of a candidate.
    least: int = 10
    #: A pair goes if a triple around it has this share (in hundredths) of its occurrences.
    covered: int = 50
    #: Phrases returned per language.
    top: int = 2000
    no_lang: str = "und"


_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text counted together before counts leave a task.
BLOCK = 1 << 21
_ROWS = 1 << 16


@dataclass
class _Block:
    """Words of a run of texts: a dictionary, each word's id, and whether it continues a piece."""

    words: pa.Array
    langs: np.ndarray
    ids: np.ndarray
    joined: np.ndarray


def _blocks(langs: pa.Array, texts: pa.Array) -> Iterator[tuple[_Block, pa.Array]]:
    """Blocks of texts with their languages; equal words of two languages have two ids."""
    names = pc.dictionary_encode(langs)
    lang_of, many = np.asarray(names.indices), max(1, len(names.dictionary))
    raw, offsets = text_bytes(texts)
    for i, j in groups_of(offsets, BLOCK):
        block = _block(raw[int(offsets[i]) : int(offsets[j])], offsets[i : j + 1] - offsets[i], lang_of[i:j], many)
        if block is not None:
            yield block, names.dictionary


def _block(raw: np.ndarray, offsets: np.ndarray, lang_of: np.ndarray, many: int) -> _Block | None:
    """The words of texts at ``offsets`` of ``raw``; its working arrays end with the call."""
    wide = len(raw) >= 1 << 31
    count = np.int64 if wide else np.int32
    data = _LOWER[raw]
    solid = ~_GAP[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:-1]
    starts = np.flatnonzero(first).astype(count)
    if not len(starts):
        return None
    # a break is any character between pieces, or the start of a text
    breaks = np.cumsum(_BREAK[data] | cut[:-1], dtype=count)[starts]
    joined = np.zeros(len(starts), dtype=bool)
    joined[1:] = breaks[1:] == breaks[:-1]
    kept = np.cumsum(solid, dtype=count)
    bounds = np.append(kept[starts] - 1, kept[-1]).astype(count)
    kind = pa.large_string() if wide else pa.string()
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[solid])]).dictionary_encode()
    lang = lang_of[np.searchsorted(offsets, starts, "right") - 1]
    own, ids = np.unique(np.asarray(words.indices).astype(np.int64) * many + lang, return_inverse=True)
    return _Block(words.dictionary.take(pa.array(own // many)).cast(pa.string()), own % many, ids, joined)


def _pairs(block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(positions of second words, id of the pair there, first words, second words of the pairs)."""
    at = np.flatnonzero(block.joined)
    size = len(block.words)
    codes, ids = np.unique(block.ids[at - 1] * size + block.ids[at], return_inverse=True)
    return at, ids, codes // size, codes % size


def _emit(langs: pa.Array, phrases: pa.Array, words: int, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(n), _ROWS):
        part = n[a : a + _ROWS]
        yield pa.RecordBatch.from_arrays(
            [langs[a : a + _ROWS], phrases[a : a + _ROWS], pa.array(np.full(len(part), words, np.int32)), pa.array(part.astype(np.int64))],
            ["lang", "phrase", "words", "f"],
        )


_COUNTS = "lang string, phrase string, words int, f bigint"


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and pairs, and of all words (words = 0) per language, block by block."""
    for batch in batches:
        for block, names in _blocks(batch.column(0), batch.column(1)):
            n = np.bincount(block.ids, minlength=len(block.words))
            langs = names.take(pa.array(block.langs))
            total = np.bincount(block.langs, weights=n, minlength=len(names))
            seen = np.flatnonzero(total)
            yield from _emit(names.take(pa.array(seen)), pa.array([""] * len(seen), pa.string()), 0, total[seen])
            yield from _emit(langs, block.words, 1, n)
            _, ids, one, two = _pairs(block)
            both = pc.binary_join_element_wise(block.words.take(pa.array(one)), block.words.take(pa.array(two)), " ")
            yield from _emit(langs.take(pa.array(one)), both, 2, np.bincount(ids, minlength=len(one)))


_SEED = [np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC3A5C85C97CB3127), np.uint64(0xB492B66FBE98F273)]


def _hashes(values: pa.Array) -> np.ndarray:
    raw, offsets = text_bytes(values)
    return hash_spans(raw, offsets[:-1], offsets[1:])


def _pair_hash(lang: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix64(lang * _SEED[0] + one * _SEED[1] + two * _SEED[2]).view(np.int64)


def _long(bitmap):
    """Counts of triples whose two pairs may be frequent, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names in _blocks(batch.column(0), batch.column(1)):
                at, ids, one, two = _pairs(block)
                words = _hashes(block.words)
                own = _hashes(names)[block.langs[one]]
                usable = in_bitmap(bitmap.value, _pair_hash(own, words[one], words[two]))
                follows = np.flatnonzero(np.diff(at) == 1)
                follows = follows[usable[ids[follows]] & usable[ids[follows + 1]]]
                codes, n = np.unique(ids[follows] * len(one) + ids[follows + 1], return_counts=True)
                left, right = codes // max(1, len(one)), codes % max(1, len(one))
                text = pc.binary_join_element_wise(*[block.words.take(pa.array(k)) for k in (one[left], two[left], two[right])], " ")
                yield from _emit(names.take(pa.array(block.langs[one[left]])), text, 3, n)

    return run


def _hashed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, one, two = (_hashes(c) for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array(_pair_hash(lang, one, two))], ["h"])


def ngram_counts(docs: DataFrame, text: str, lang: str, rules: PhraseRules) -> DataFrame:
    """(lang, words, w1, w2, w3, f): all words of a language (words = 0), and the n-grams of one
    to three words with ``least`` occurrences or more."""
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(rules.no_lang)).alias("lang"), F.col(text).cast("string").alias("text"))

    def counted(rows: DataFrame, name: str) -> DataFrame:
        totals = rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
        return stored(totals.where((F.col("f") >= rules.least) | (F.col("words") == 0)), name)

    short = counted(source.mapInArrow(_short, _COUNTS), "ngrams")
    parts = F.split("phrase", " ")
    pairs = short.where("words = 2").select("lang", parts[0].alias("one"), parts[1].alias("two")).mapInArrow(_hashed_pairs, "h bigint")
    bitmap = docs.sparkSession.sparkContext.broadcast(key_bitmap(pairs, "h"))  # fixed size
    long = counted(source.mapInArrow(_long(bitmap), _COUNTS), "ngrams")
    return short.unionByName(long).select(
        "lang", "words", *[F.when(F.col("words") > k, F.split("phrase", " ")[k]).alias(f"w{k + 1}") for k in range(3)], "f"
    )


def _contexts(stream: DataFrame, one: Column, two: Column, three: Column, tag: str) -> DataFrame:
    """``stream`` with the counts of its contexts, from one pass in the order (one, two, three).

    Adds ``n`` (all words), ``{tag}1`` (the context of one word), ``{tag}2`` (of two) and
    ``{tag}x`` (of a pair: its most frequent triple in that context).  Longer n-grams follow
    their context, triples by descending count.
    """
    keyed = stream.withColumns({
        "__a": one, "__b": two, "__n": F.when(F.col("words") == 3, -F.col("f")), "__c": F.when(F.col("words") == 3, three)
    })
    words = F.col("words")
    at = {
        "__0": (F.when(words == 0, F.struct("lang", "f")), "before"),
        "__1": (F.when(words == 1, F.struct("lang", "__a", "f")), "before"),
        "__2": (F.when(words == 2, F.struct("lang", "__a", "__b", "f")), "before"),
        "__3": (F.when(words == 3, F.struct("lang", "__a", "__b", "f")), "after"),
    }
    seen = fill_nearest(keyed, at, ["lang", "__a", "__b", "__n", "__c"])

    def count(name: str, *context: str) -> Column:
        same = [F.col(f"{name}.{c}") == F.col(c) for c in context]
        agreed = same[0]
        for s in same[1:]:
            agreed &= s
        return F.when(agreed, F.col(f"{name}.f"))

    return seen.withColumns({
        "n": count("__0", "lang"), f"{tag}1": count("__1", "lang", "__a"), f"{tag}2": count("__2", "lang", "__a", "__b"),
        f"{tag}x": count("__3", "lang", "__a", "__b"),
    }).drop("__a", "__b", "__c", "__n", *at)


def cut_score(left: str, right: str, k: int) -> Column:
    """(score, k, l, r) of the cut after k words; exact for counts of up to 15 digits."""
    f, left_n, right_n = (F.col(c).cast("decimal(15,0)") for c in ("f", left, right))
    above, below = f * f * F.lit(1_000_000).cast("decimal(7,0)"), left_n * right_n
    return F.struct(F.call_function("div", above, below).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", rules: PhraseRules = PhraseRules()) -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of two or three words occurs ``a`` times; its lowest-scoring cut leaves parts that
    occur ``l`` and ``r`` times; score = floor(1000000 * a * a / (l * r)), ties by a descending
    and the phrase's bytes.  A pair inside a triple with at least half of its occurrences goes.

    A null text has no words, a null language is ``und``; a text without words, or without two
    words in a piece, gives no phrase; equal rows all count.  An empty table, or one without a
    frequent phrase, gives an empty table.  Other columns are not read.
    """
    counts = stored(ngram_counts(docs, text, lang, rules), "streams")
    first, last = F.col("w1"), F.element_at(F.filter(F.array("w1", "w2", "w3"), lambda w: w.isNotNull()), -1)
    middle = F.when(F.col("words") == 3, F.col("w2")).when(F.col("words") == 2, F.col("w1"))
    before = stored(_contexts(counts, first, F.col("w2"), F.col("w3"), "p"), "prefix")
    after = _contexts(before.drop("n"), F.when(F.col("words") > 0, last), middle, F.col("w1"), "s")
    sides = stored(after, "suffix")
    discard(counts, before)

    cut = F.when(F.col("words") == 2, cut_score("p1", "s1", 1)).otherwise(F.least(cut_score("p1", "s2", 1), cut_score("p2", "s1", 2)))
    inside = (F.col("words") == 2) & (100 * F.greatest(F.coalesce("px", F.lit(0)), F.coalesce("sx", F.lit(0))) >= rules.covered * F.col("f"))
    phrases = sides.where(F.col("words") >= 2).where(~inside).withColumn("cut", cut).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the limit is applied in every task before rows of a language meet
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
