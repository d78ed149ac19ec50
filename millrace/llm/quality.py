"""Quality by positive-unlabelled learning.

Trusted positives are the rows labelled 1; the other class is never read from labels.
Unlabelled web text is a mixture whose share of good text (the class prior) is estimated
first.  The classifier then minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the sigmoid loss, which no single text can dominate; while the bracket is negative, its gradient is followed upwards,
so that a flexible model cannot fit the positives it has seen.  The model is additive
over binned facts of the whole text, so a score can be explained bin by bin.

The mixture is the whole corpus, labelled rows included with their labels unread.  Bin
edges, score tails and the prior come from all its rows; the risk is minimised on bounded
samples of trusted positives and of the mixture.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import groups_of, hash_spans, shingle_hashes, stored, text_bytes, word_spans
from millrace.llm.toxicity import held_out
from millrace.operators.quantiles import exact_quantiles

FACTS = (
    "log_words", "word_bytes", "upper", "digits", "marks", "pipes", "bangs", "stops", "commas", "lines", "other_marks",
    "distinct", "top_word", "same_as_last", "again_3", "again_lines", "wide", "longest_word",
)
BINS = 16


def _classes() -> dict[str, list[int]]:
    marks = list(b"#*$%&<>")
    known = {*marks, *b"|!.,"}
    return {
        "upper": list(range(65, 91)), "digits": list(range(48, 58)), "marks": marks, "pipes": [124], "bangs": [33],
        "stops": [46], "commas": [44], "lines": [10],
        "other_marks": [c for c in range(33, 127) if not chr(c).isalnum() and c not in known],
        "wide": list(range(192, 256)),
    }


_CLASSES = _classes()


def facts_of(column: pa.Array) -> np.ndarray:
    """One row of FACTS per text, from all its bytes and words."""
    raw, offsets = text_bytes(column)
    out = np.zeros((len(column), len(FACTS)))
    for i, j in groups_of(offsets, 1 << 19):
        part = offsets[i : j + 1]
        base, n = int(part[0]), j - i
        data = raw[base : int(part[-1])]
        owner = np.repeat(np.arange(n) * 256, np.diff(part))
        bytes_of = np.bincount(owner + data, minlength=n * 256).reshape(n, 256)
        starts, ends, firsts = word_spans(raw, part)
        words = hash_spans(data, starts, ends)
        sizes = ends - starts
        for d in range(n):
            w = words[firsts[d] : firsts[d + 1]]
            m, got = len(w), {}
            per = max(m, 1)
            for name, codes in _CLASSES.items():
                got[name] = bytes_of[d, codes].sum() / per
            got["log_words"] = np.log1p(m)
            if m:
                _, counts = np.unique(w, return_counts=True)
                three = shingle_hashes(w, 3)
                got["word_bytes"] = sizes[firsts[d] : firsts[d + 1]].mean()
                got["longest_word"] = np.log(sizes[firsts[d] : firsts[d + 1]].max())
                got["distinct"] = np.log(len(counts)) / max(np.log(m), 0.7)  # does not fall with the length
                got["top_word"] = counts.max() / m
                got["same_as_last"] = float((w[1:] == w[:-1]).mean()) if m > 1 else 0.0
                got["again_3"] = 1 - len(np.unique(three)) / len(three)
                lines = [x for x in data[int(part[d]) - base : int(part[d + 1]) - base].tobytes().split(b"\n") if x]
                got["again_lines"] = 1 - len(set(lines)) / max(len(lines), 1)
            out[i + d] = [got.get(f, 0.0) for f in FACTS]
    return out


@dataclass(frozen=True)
class PuModel:
    """Bin edges by fact and the weight of each bin."""

    edges: tuple[np.ndarray, ...]
    weights: np.ndarray  # facts x (BINS + 1)
    bias: float
    prior: float

    def logits(self, facts: np.ndarray) -> np.ndarray:
        total = np.full(len(facts), self.bias)
        for f, edge in enumerate(self.edges):
            total += self.weights[f, np.searchsorted(edge, facts[:, f], "right")]
        return total

    def score(self, facts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(facts), -60, 60)))


def _one_hot(edges: tuple[np.ndarray, ...], facts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(facts), len(edges) * (BINS + 1)))
    for f, edge in enumerate(edges):
        out[np.arange(len(facts)), f * (BINS + 1) + np.searchsorted(edge, facts[:, f], "right")] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _adam(step, size: int, rounds: int, rate: float, start: np.ndarray | None = None) -> np.ndarray:
    w, m, v = np.zeros(size) if start is None else start.copy(), np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        g = step(w)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def tail_shares(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many scores reach each of the ascending thresholds."""
    slots = np.bincount(np.searchsorted(at, scores, "right"), minlength=len(at) + 1)
    return slots[::-1].cumsum()[::-1][1:]


def prior_of_tails(q_p: np.ndarray, n_p: int, q_u: np.ndarray, n_u: int, slack: float = 0.1) -> float:
    """Share of positives among the unlabelled: least ratio of the two tails of a score.

    Above any threshold the unlabelled hold at least prior times the positives' share; the
    threshold is chosen with a bound on the error of both shares.
    """
    error = np.sqrt(np.log(4 / slack) / (2 * n_u)) + np.sqrt(np.log(4 / slack) / (2 * n_p))
    best = int(np.argmin(q_u / q_p + (1 + slack) * error / q_p))
    return float(np.clip(q_u[best] / q_p[best], 0.01, 0.99))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """`prior_of_tails` of two arrays of scores."""
    n_p, n_u = len(positive), len(unlabelled)
    if not n_p or not n_u:
        return 0.5
    at = np.unique(positive)
    return prior_of_tails(tail_shares(positive, at) / n_p, n_p, tail_shares(unlabelled, at) / n_u, n_u)


#: Half of the edges part the bulk, half its upper and lower ends, where junk lies.
PROBS = sorted({*np.linspace(0.1, 0.9, BINS - 8).tolist(), 0.005, 0.01, 0.02, 0.05, 0.95, 0.98, 0.99, 0.995})


def constant(share: float) -> PuModel:
    return PuModel(tuple(np.zeros(0) for _ in FACTS), np.zeros((len(FACTS), BINS + 1)), float(np.log(share / (1 - share))), share)


class _Fit:
    """Positives and a sample of the mixture over given bin edges."""

    def __init__(self, edges: tuple[np.ndarray, ...], positive: np.ndarray, mixture: np.ndarray, decay: float, rounds: int):
        self.edges, self.decay, self.rounds = edges, decay, rounds
        self.xp, self.xu = (np.hstack([_one_hot(edges, x), np.ones((len(x), 1))]) for x in (positive, mixture))

    def model(self, w: np.ndarray, prior: float) -> PuModel:
        return PuModel(self.edges, w[:-1].reshape(len(FACTS), BINS + 1), float(w[-1]), prior)

    def apart(self) -> np.ndarray:
        """Weights of positives against the mixture, a convex problem."""
        xp, xu = self.xp, self.xu

        def slope(w: np.ndarray) -> np.ndarray:
            return xp.T @ (_sigmoid(xp @ w) - 1) / len(xp) + xu.T @ _sigmoid(xu @ w) / len(xu) + self.decay * w

        return _adam(slope, xp.shape[1], self.rounds // 2, 0.05)

    def risk(self, prior: float) -> PuModel:
        """The non-negative unbiased risk minimiser; the loss is not convex, so it starts from `apart`, at the prior's odds."""
        xp, xu = self.xp, self.xu

        def slope(w: np.ndarray) -> np.ndarray:
            p, u = _sigmoid(xp @ w), _sigmoid(xu @ w)
            up = prior * xp.T @ (p * (1 - p)) / len(xp)
            minus = xu.T @ (u * (1 - u)) / len(xu) - up
            return (minus - up if u.mean() >= prior * p.mean() else -minus) + self.decay * w

        start = self.apart() + np.eye(xp.shape[1])[-1] * np.log(prior / (1 - prior))
        return self.model(_adam(slope, xp.shape[1], self.rounds, 0.05, start), prior)


# --- Spark ------------------------------------------------------------------------------


def text_facts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, facts) of every row, from its whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(facts_of(batch.column(1))), pa.list_(pa.float64()))], [key, "facts"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(measure, f"`{key}` {kind}, facts array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FACTS))


def sample_facts(facts: DataFrame, keys: DataFrame, sample: int, key: str) -> np.ndarray:
    """Facts of at most ``sample`` of the distinct ``keys``, chosen by hash; the least of a repeated key."""
    ids = keys.select(F.col(key).alias("__key")).where("__key is not null").distinct().orderBy(F.xxhash64("__key"), "__key").limit(sample)
    chosen = facts.select(F.col(key).alias("__key"), "facts").join(F.broadcast(ids), "__key")
    rows = chosen.groupBy("__key").agg(F.min("facts").alias("facts")).orderBy("__key").collect()
    return np.array([r["facts"] for r in rows]).reshape(-1, len(FACTS))


def bin_edges(facts: DataFrame) -> tuple[np.ndarray, ...]:
    """Distinct quantiles of each fact over all rows."""
    names = [f"f{i}" for i in range(len(FACTS))]
    found = exact_quantiles(facts.select(*[F.col("facts")[i].alias(n) for i, n in enumerate(names)]), names, PROBS)
    return tuple(np.unique([v for v in found[n] if v is not None]) for n in names)


def prior_of_corpus(facts: DataFrame, model: PuModel, positive: np.ndarray) -> float:
    """The class prior from the tails of a score over all rows, at the scores of positives that
    the model has not seen (their number bounds the counts)."""
    logits = model.logits(positive)
    at = np.unique(logits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(len(at) + 1, dtype=np.int64)
        for batch in batches:
            slots += np.bincount(np.searchsorted(at, model.logits(_matrix(batch.column(0))), "right"), minlength=len(slots))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slots))), pa.array(slots)], ["slot", "n"])

    slots = np.zeros(len(at) + 1, dtype=np.int64)
    for r in facts.select("facts").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        slots[r["slot"]] = r["n"]
    n_u = int(slots.sum())
    return prior_of_tails(tail_shares(logits, at) / len(logits), len(logits), slots[::-1].cumsum()[::-1][1:] / n_u, n_u)


def fit_quality(
    facts: DataFrame, labels: DataFrame, learn: Column, sample: int = 3000, key: str = "doc_id", decay: float = 1e-3, rounds: int = 400
) -> PuModel:
    """The model of a table of `text_facts`; at most ``sample`` trusted positives and as many keys of
    the mixture fit the weights, all its rows ``learn`` give edges and prior."""
    mixture = facts.where(F.col(key).isNotNull() & learn)
    positive = sample_facts(facts, labels.where((F.col("quality") == 1) & learn).select(key), sample, key)
    unlabelled = sample_facts(mixture, mixture.select(key), sample, key)
    if not len(positive) or not len(unlabelled):
        return constant(0.99 if len(positive) else 0.5)
    edges = bin_edges(mixture)
    half = _Fit(edges, positive[::2], unlabelled[::2], decay, rounds)
    unseen = positive[1::2] if len(positive) > 1 else positive
    prior = prior_of_corpus(mixture, half.model(half.apart(), 0.5), unseen)
    return _Fit(edges, positive, unlabelled, decay, rounds).risk(prior)


def score_quality(facts: DataFrame, model: PuModel, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of `text_facts`."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], [key, "score"])

    return facts.mapInArrow(rate, f"`{key}` {facts.schema[key].dataType.simpleString()}, score double")


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.3, sample: int = 3000) -> DataFrame:
    """Per row: key, held_out, score, predicted.

    Labels are read only where crc32 of the key modulo 5 is not 0.  A null text counts as
    an empty one and gets the score of a text without words; a null key is not held out;
    equal rows get equal scores; an empty table gives an empty table; without positives or
    rows to learn from the score is a constant.
    """
    facts = stored(text_facts(docs, key, text), "facts")
    model = fit_quality(facts, labels, ~held_out(key, 5, 0), sample, key)
    return score_quality(facts, model, key).select(
        key, F.coalesce(held_out(key, 5, 0), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
