"""Toxicity by subword bags: vectors of byte n-grams, averaged into a linear softmax.

A word is the mean of the vectors of its n-grams (3 to 5 bytes, marked where they touch
the word's edge) and of the whole word, so a misspelling that was never seen shares most
of its vectors with the word it hides.  A text is the mean of words: of all its words in
the first round of training, then of the ``k`` words that tell most, found over the whole
text, since a few words make a long text toxic.  Vectors and softmax are trained jointly
in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import _FOLDED, _MASK, _power_tables, groups_of, hash_spans, mix64, text_bytes

BUCKETS = 1 << 17
TELLING = 4

_PART = np.ones(256, dtype=bool)  # bytes of words: letters, digits, everything beyond ASCII
for _c in range(128):
    _PART[_c] = chr(_c).isalnum()
_EDGE = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_LENGTH = np.uint64(0x8EBC6AF09C88C6E3)


def token_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first token of each text) of runs of letters and digits."""
    base, end = int(offsets[0]), int(offsets[-1])
    solid = _PART[raw[base:end]]
    n = len(solid)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets - base] = True
    start, stop = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:-1]
    stop[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets - base)


def word_grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of the spans and of the whole spans, by word."""
    buckets, owners = [], []
    k = 0
    while k < len(starts):  # spans ascend; blocks keep the prefix sums small
        a = int(starts[k])
        k1 = max(k + 1, int(np.searchsorted(ends, a + (1 << 18), "right")))
        seg = _FOLDED[raw[a : int(ends[k1 - 1])]]
        up, down = _power_tables(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum(seg * up[: len(seg)], out=sums[1:])
        s, e = starts[k:k1] - a, ends[k:k1] - a
        number = np.arange(k, k1)
        whole = mix64((sums[e] - sums[s]) * down[s] + _LENGTH)
        buckets.append((whole & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(number)
        for n in (3, 4, 5):
            count = np.maximum(e - s - n + 1, 0)
            owner = np.repeat(np.arange(k1 - k), count)
            p = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + s[owner]
            h = (sums[p + n] - sums[p]) * down[p] + np.uint64(n * int(_LENGTH) & _MASK)
            h += (p == s[owner]) * _EDGE[0] + (p + n == e[owner]) * _EDGE[1]
            buckets.append((mix64(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(owner + k)
        k = k1
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = np.concatenate(buckets)
    buckets.clear()  # the parts of both lists and both results never stand beside one another
    return joined, np.concatenate(owners)


def word_scores(table: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean of ``table`` over the n-grams of each span; equal words are computed once."""
    hashes = hash_spans(raw, starts, ends, fold=True)
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    bucket, owner = word_grams(raw, starts[first[order]], ends[first[order]])
    n = len(order)
    mean = np.bincount(owner, table[bucket], n) / np.maximum(np.bincount(owner, minlength=n), 1)
    return mean[rank[back]]


def telling_words(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores."""
    return np.arange(len(scores)) if len(scores) <= k else np.argpartition(scores, len(scores) - k)[-k:]


def telling_mean(scores: np.ndarray, k: int) -> float:
    """Mean of the ``k`` highest scores; missing words count as 0."""
    return float(scores[telling_words(scores, k)].sum()) / k


def bag_of(text: bytes, k: int) -> tuple[bytes, list[float]]:
    """A text as its distinct words, each up to ``k`` times, and how many tokens each of these
    stands for: training on it equals training on the whole text, whatever its length."""
    starts, ends, _ = token_spans(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    _, first, counts = np.unique(hash_spans(np.frombuffer(text, dtype=np.uint8), starts, ends, fold=True), return_index=True, return_counts=True)
    copies = np.minimum(counts, k)
    words = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    return b" ".join(w for w, n in zip(words, copies.tolist(), strict=True) for _ in range(n)), np.repeat(counts / copies, copies).tolist()


@dataclass(frozen=True)
class ToxicityModel:
    table: np.ndarray  # per bucket: vector times (weights of class 1 minus class 0)
    bias: float
    k: int = TELLING

    def score(self, mean: np.ndarray | float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.asarray(mean) + self.bias, -60, 60)))


def fit_subwords(
    texts: list[bytes], labels: np.ndarray, prior: float, dim: int = 8, k: int = TELLING, rounds: int = 16,
    steps: int = 12, rate: float = 0.03, decay: float = 1e-5, least: int = 5, miss_cost: float = 2.7, seed: int = 7,
    weights_of: Iterable[Sequence[float]] | None = None,
) -> ToxicityModel:
    """Vectors and softmax by Adam, all texts at once (``weights_of``: texts and weights of `bag_of`).

    ``prior`` is the share of class 1; a missed text of class 1 counts as ``miss_cost``
    texts of class 0 flagged in error, which shifts the bias by its logarithm.
    """
    labels = np.asarray(labels, dtype=float)
    if not len(labels) or labels.min() == labels.max():
        base = prior if len(labels) == 0 else float(labels.mean())
        base = min(max(base, 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(BUCKETS), float(np.log(base / (1 - base))), k)
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, ends, firsts = token_spans(raw, offsets)
    hashes = hash_spans(raw, starts, ends, fold=True)
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    word = rank[word]
    del hashes
    bucket, owner = word_grams(raw, starts[first[order]], ends[first[order]])
    nwords = len(order)
    share = 1.0 / np.bincount(owner, minlength=nwords)

    # n-grams of fewer than `least` texts say nothing: they keep a zero vector, as unseen ones do
    weight = np.ones(len(word)) if weights_of is None else np.concatenate([np.asarray(w, dtype=float) for w in weights_of])
    text_of_token = np.repeat(np.arange(len(texts)), np.diff(firsts))
    pairs = np.unique(word.astype(np.int64) * len(texts) + text_of_token)
    in_texts = np.bincount(pairs // len(texts), minlength=nwords).astype(float)
    del raw, starts, ends, first, order, rank, pairs
    known = np.bincount(bucket, in_texts[owner], BUCKETS) >= least

    rng = np.random.default_rng(seed)
    vectors = np.where(known[:, None], rng.normal(0, 0.01, (BUCKETS, dim)), 0.0)
    weights = rng.normal(0, 0.3, (dim, 2))
    biases = np.zeros(2)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, weights, biases)]
    step = 0

    def move(value: np.ndarray, grad: np.ndarray, moment: list[np.ndarray]) -> None:
        """A step of Adam, in place."""
        m, v = moment
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def scores() -> np.ndarray:
        table = vectors @ (weights[:, 1] - weights[:, 0])
        return np.bincount(owner, table[bucket], nwords) * share

    for turn in range(rounds):
        if turn == 0:
            which, token, times = text_of_token, word, weight
            size = np.maximum(np.bincount(text_of_token, weight, len(texts)), 1)
        else:
            now = scores()
            chosen = [firsts[d] + telling_words(now[word[firsts[d] : firsts[d + 1]]], k) for d in range(len(texts))]
            size = np.full(len(texts), k)
            which = np.repeat(np.arange(len(texts)), [len(c) for c in chosen])
            token = word[np.concatenate(chosen)]
            times = np.ones(len(token))
        target = labels
        balance = np.where(target == 1, 0.5 / max(target.mean(), 1e-9), 0.5 / max(1 - target.mean(), 1e-9)) / len(texts)
        for _ in range(steps):
            step += 1
            mean = np.bincount(which, scores()[token] * times, len(texts)) / size
            p = 1 / (1 + np.exp(-np.clip(mean + biases[1] - biases[0], -60, 60)))
            delta = (p - target) * balance
            on_word = np.bincount(token, (delta / size)[which] * times, nwords) * share
            pull = np.bincount(bucket, on_word[owner], BUCKETS)
            diff = weights[:, 1] - weights[:, 0]
            pull *= known
            toward = pull @ vectors
            move(weights, np.stack([-toward, toward], axis=1) + decay * weights, moments[1])
            move(biases, np.array([-delta.sum(), delta.sum()]), moments[2])
            for at in range(0, BUCKETS, 1 << 13):  # rows by rows: whole copies would take some 60 MB
                part = slice(at, at + (1 << 13))
                grad = np.outer(pull[part], diff) + decay * vectors[part]
                move(vectors[part], grad, [x[part] for x in moments[0]])
    odds = np.log(miss_cost * prior / (1 - prior))  # the classes had equal weight in training
    return ToxicityModel(vectors @ (weights[:, 1] - weights[:, 0]), float(biases[1] - biases[0] + odds), k)


# --- Spark ------------------------------------------------------------------------------


def held_out(key: str, mod: int, remainder: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(mod)) == remainder


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, key: str, text: str, k: int = TELLING
) -> tuple[list[tuple[bytes, int, np.ndarray]], float]:
    """At most ``per_class`` texts of each label among the rows ``learn`` as (words, label, weights)
    of `bag_of`, and the share of label 1.  Weights travel as bytes, which take a fifth of a list.

    The choice is by a hash of the key and so the same at each run.  Rows without a label
    or key are no examples; a key with two labels counts as 1, of its texts the least is read.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & learn)
        .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("__y"))
    )
    shares = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = None
    for y in (0, 1):
        part = known.where(F.col("__y") == y).orderBy(F.xxhash64(key), key).limit(per_class)
        ids = part if ids is None else ids.unionByName(part)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag_of((value.as_py() or "").encode(), k) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w for w, _ in found], pa.binary()), pa.array([np.array(n, dtype=">f8").tobytes() for _, n in found], pa.binary())],
                ["__y", "raw", "weights"],
            )

    # 2 * per_class keys at most are broadcast
    chosen = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).join(
        F.broadcast(ids.select(F.col(key).alias("__key"), "__y")), "__key"
    )
    texts = chosen.groupBy("__key", "__y").agg(F.min("__text").alias("__text")).select("__y", "__text")
    rows = texts.mapInArrow(bags, "`__y` int, raw binary, weights binary").collect()
    # positive numbers with the high byte first sort as their bytes do
    rows = sorted((bytes(r["raw"]), r["__y"], bytes(r["weights"])) for r in rows)
    rows = [(raw, y, np.frombuffer(w, dtype=">f8")) for raw, y, w in rows]
    total = sum(shares.values())
    prior = min(max(shares.get(1, 0) / total, 1e-3), 1 - 1e-3) if total else 0.5
    return rows, prior


def score_texts(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """(key, *keep, score) of every row; ``name`` is the name of the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS doubles

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            raw, offsets = text_bytes(batch.column(batch.num_columns - 1))
            out = np.zeros(batch.num_rows)
            for i, j in groups_of(offsets):
                part = offsets[i : j + 1]
                starts, ends, firsts = token_spans(raw, part)
                values = word_scores(m.table, raw[int(part[0]) :], starts, ends)
                out[i:j] = [telling_mean(values[firsts[d] : firsts[d + 1]], m.k) for d in range(j - i)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(m.score(out))], [key, *keep, name])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *keep))
    return docs.select(key, *keep, F.col(text).cast("string").alias("__text")).mapInArrow(rate, f"{kinds}, `{name}` double")


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 1500, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    rows, prior = labelled_sample(docs, labels, "toxic", learn, per_class, key, text)
    return fit_subwords([r for r, _, _ in rows], np.array([y for _, y, _ in rows]), prior, weights_of=[w for _, _, w in rows])


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7, per_class: int = 1500) -> DataFrame:
    """Per row: key, held_out, score, predicted.

    Labels are learned from at most ``per_class`` rows of each class whose crc32 of the key
    modulo 3 is not 1.  A null or empty text has the score of the bias alone, a null key is
    not held out, equal rows get equal scores, an empty table gives an empty table, and
    without labels of both classes every score is the share of label 1.
    """
    model = fit_toxicity(docs, labels, ~held_out(key, 3, 1), per_class, key, text)
    return score_texts(docs, model, key, text).select(
        key, F.coalesce(held_out(key, 3, 1), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
