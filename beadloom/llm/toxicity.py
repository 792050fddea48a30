"""Toxicity by non-negative positive-unlabelled learning over hashed words and word beginnings.

Only confirmed toxic texts and unlabelled ones are learned from. The class prior is estimated from both, the risk
estimator is corrected by it and kept from going below zero, and every feature's weight pays a penalty that grows with
what chance alone would do to its frequency, so features of both signs stay only where the samples bear them out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm import words
from beadloom.llm.common import bounded, give_back, part, read, sampled, slices

#: Bounds of the training sample: confirmed toxic and unlabelled documents, and characters beyond which a document is
#: picked the more seldom the longer it is, so that their total is bounded as well.
TRAIN_TOXIC = 2500
TRAIN_UNLABELLED = 6000
TRAIN_CHARS = 40_000
#: Word beginnings of these lengths are features beside whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: A weight's penalty, as a share of what Chernoff's bound allows its feature's frequency to deviate by chance: the first
#: for many positives, the second for the third number or fewer.
PENALTY = (0.25, 0.5, 20)
#: Steps of a fit (fewer where only the order of scores counts), and rate of a step.
STEPS, ORDER_STEPS, RATE = 90, 40, 0.1
#: The prior that is assumed at first counts as much as so many positives; parts of the samples that are held out in turn.
ASSUMED, ASSUMED_AS, FOLDS = 0.1, 40, 2
#: Bits of the table that tells features of one text, which no step could move, from others.
SEEN_BITS = 24
#: Pairs (text, feature) that a sum takes at a time.
PAIRS = 1 << 16
THRESHOLD = 0.3


@dataclass
class Model:
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float
    prior: float


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, kind): the distinct features of each text, sorted by text and hash.

    Features are the lower-cased letter runs (kind 0) and their first n characters for each n of BEGINNINGS that they
    have (kind n).
    """
    data, begin = words.joined([t.lower().encode() for t in texts])
    starts, ends = words.letter_runs(data)
    text = np.searchsorted(begin, starts, "right") - 1
    h = words.hashes(data, starts, ends)
    fresh = _distinct(text, h)
    starts, ends, text, h = starts[fresh], ends[fresh], text[fresh], h[fresh]
    characters = np.flatnonzero((data & 0xC0) != 0x80)
    first, after = np.searchsorted(characters, starts), np.append(characters, data.size)
    parts = [(text, words.mix(h), np.zeros(len(text), np.int8))]
    for n in BEGINNINGS:
        end = after[np.minimum(first + n, characters.size)]
        on = end <= ends
        parts.append((text[on], words.mix(words.hashes(data, starts[on], end[on]) ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))), np.full(int(on.sum()), n, np.int8)))
    text, h, kind = (np.concatenate(x) for x in zip(*parts, strict=True))
    fresh = _distinct(text, h)
    return text[fresh], h[fresh], kind[fresh]


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the distinct pairs, in their order."""
    by = np.lexsort((b, a))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
    return by[fresh]


class Sample:
    """Features of a sample's texts: which text has which feature, as sorted pairs. Texts are dropped as they come."""

    def __init__(self, texts: Iterable[str], bytes_: int = 1 << 20):
        self.n, self.parts, held, size = 0, [], [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size > bytes_:
                self._add(held)
                held, size = [], 0
        self._add(held)

    def _add(self, texts: list[str]) -> None:
        if texts:
            text, h, kind = text_features(texts)
            self.parts.append(((text + self.n).astype(np.int32), h, kind))
            self.n += len(texts)

    def counted(self, seen: np.ndarray) -> None:
        for _, h, _ in self.parts:
            at, times = np.unique((h >> np.uint64(64 - SEEN_BITS)).astype(np.uint32), return_counts=True)
            seen[at] = np.minimum(seen[at] + times, 2)

    def keep(self, seen: np.ndarray) -> None:
        """Drops the pairs of features that only one text has (all but a few, by equal bits), a part at a time."""
        for k, (text, h, kind) in enumerate(self.parts):
            on = seen[h >> np.uint64(64 - SEEN_BITS)] > 1
            self.parts[k] = text[on], h[on], kind[on]

    def columns(self, names: np.ndarray) -> Columns:
        """The pairs with features as places in names; the parts go as they are turned."""
        rows, features = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        self.parts.reverse()
        while self.parts:
            text, h, _ = self.parts.pop()
            rows.append(text)
            features.append(np.searchsorted(names, h).astype(np.int32))
        return Columns(np.concatenate(rows), np.concatenate(features), self.n, len(names))


def named(samples: Iterable[Sample]) -> tuple[np.ndarray, np.ndarray]:
    """(names, kind): the distinct features of all samples in order, merged a part at a time."""
    names, kind = np.empty(0, np.uint64), np.empty(0, np.int8)
    for sample in samples:
        for _, h, kinds in sample.parts:
            fresh, first = np.unique(h, return_index=True)
            names, at = np.unique(np.concatenate([names, fresh]), return_index=True)
            kind = np.concatenate([kind, kinds[first]])[at]
    return names, kind


class Columns:
    """Pairs (row, feature number) of one sample as 32-bit numbers, for sums over rows and over features.

    Sums take PAIRS pairs at a time, in their order, so that no array of 64-bit numbers is as long as the pairs.
    """

    def __init__(self, row: np.ndarray, feature: np.ndarray, rows: int, width: int):
        self.row, self.feature, self.rows, self.width = row, feature, rows, width

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return _added(np.zeros(self.rows), self.row, weights, self.feature)

    def gradient(self, g: np.ndarray) -> np.ndarray:
        return _added(np.zeros(self.width), self.feature, g, self.row)

    def counts(self) -> np.ndarray:
        """Rows of each feature."""
        return _added(np.zeros(self.width, np.int64), self.feature, np.ones(1, np.int64))

    def of(self, rows: np.ndarray, features: np.ndarray) -> Columns:
        """Those of the chosen rows and features (booleans), numbered anew."""
        on = rows[self.row] & features[self.feature]
        row, feature = np.cumsum(rows, dtype=np.int32) - np.int32(1), np.cumsum(features, dtype=np.int32) - np.int32(1)
        return Columns(row[self.row[on]], feature[self.feature[on]], int(rows.sum()), int(features.sum()))


def _added(out: np.ndarray, at: np.ndarray, values: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """out with values[of[k]] added at at[k], for one k after another; without of the only value."""
    for k in range(0, len(at), PAIRS):
        np.add.at(out, at[k : k + PAIRS].astype(np.intp), values[0] if of is None else np.take(values, of[k : k + PAIRS]))
    return out


def chance(rate: np.ndarray, n: int, log_odds: float) -> np.ndarray:
    """The least deviation above each rate that n draws reach with a probability of exp(-log_odds) at most, by Chernoff's bound."""
    low, high = np.zeros_like(rate), np.full_like(rate, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(40):
            mid = (low + high) / 2
            u = mid / rate
            rare = n * rate * ((1 + u) * np.log1p(u) - u) >= log_odds
            low, high = np.where(rare, low, mid), np.where(rare, mid, high)
    return high


def risk(g_p: np.ndarray, g_u: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """(risk, its derivatives by the scores of positives and unlabelled) of the non-negative estimator, logistic loss l.

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]). Where the second part is negative, which only
    overfitting can cause, the derivatives are those that raise it again.
    """
    s_p, s_u = 0.5 * (1 + np.tanh(g_p / 2)), 0.5 * (1 + np.tanh(g_u / 2))
    negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
    on_p, on_u = -prior * s_p / len(g_p), s_u / len(g_u)
    value = prior * np.logaddexp(0, -g_p).mean() + max(0.0, negative)
    return (value, prior * (s_p - 1) / len(g_p) + on_p, on_u) if negative >= 0 else (value, -on_p, -on_u)


def nnpu(p: Columns, u: Columns, prior: float, penalty: np.ndarray, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(weights, bias) of a logistic classifier by the non-negative risk plus penalty * |weight|.

    Full batches with AdaGrad's step sizes; a weight leaves zero only where the slope exceeds its penalty. The last third
    of the steps is averaged, as the corrected part keeps turning around zero.
    """
    w, b = np.zeros(p.width), math.log(prior / (1 - prior))
    square, square_b = np.full(p.width, 1e-12), 1e-12
    mean, mean_b, last = np.zeros(p.width), 0.0, steps - steps // 3
    for t in range(steps):
        _, d_p, d_u = risk(p.sums(w) + b, u.sums(w) + b, prior)
        g, g_b = p.gradient(d_p) + u.gradient(d_u), d_p.sum() + d_u.sum()
        g = np.where(w != 0, g + penalty * np.sign(w), np.sign(g) * np.maximum(np.abs(g) - penalty, 0))
        square += g * g
        square_b += g_b * g_b
        moved = w - rate * g / np.sqrt(square)
        w = np.where((w != 0) & (np.sign(moved) != np.sign(w)), 0, moved)
        b -= rate * g_b / np.sqrt(square_b)
        if t >= last:
            mean, mean_b = mean + w / (steps - last), mean_b + b / (steps - last)
    return mean, mean_b


def calibrated(e_p: np.ndarray, e_u: np.ndarray, bias: float, prior: float, steps: int = 400) -> tuple[float, float]:
    """(scale, bias) for the evidence of texts, their scores less the bias, by the same risk.

    The penalty shrinks all weights alike; this takes it back. A text without evidence is no likelier toxic than any, so
    the bias stays below the prior's.
    """
    at, top, square = np.array([1.0, bias]), math.log(prior / (1 - prior)), np.full(2, 1e-12)
    for _ in range(steps):
        _, d_p, d_u = risk(at[0] * e_p + at[1], at[0] * e_u + at[1], prior)
        g = np.array([d_p @ e_p + d_u @ e_u, d_p.sum() + d_u.sum()])
        square += g * g
        at = at - 2 * RATE * g / np.sqrt(square)
        at[1] = min(at[1], top)
    return max(float(at[0]), 1e-3), float(at[1])


def prior_of(s_p: np.ndarray, s_u: np.ndarray) -> float:
    """The class prior from scores of positives and unlabelled that no fit has seen.

    Above every threshold lie at least prior times as many of the unlabelled as of the positives, as shares. So the
    prior is the least such ratio; the threshold is the one of the least upper bound, by one standard error either way.
    ASSUMED has a say that fades with the number of positives there.
    """
    s_p, s_u = np.sort(s_p)[::-1], np.sort(s_u)
    k_p = np.arange(1, len(s_p) + 1)
    last = np.append(s_p[1:] != s_p[:-1], True)  # of equal scores the last counts them all
    k_p, s_p = k_p[last], s_p[last]
    k_u = len(s_u) - np.searchsorted(s_u, s_p, "left")
    upper = (k_u + 1 + np.sqrt(k_u + 1)) / np.maximum(k_p - np.sqrt(k_p), 1e-9)
    best = int(upper.argmin())
    ratio = k_u[best] / len(s_u) / (k_p[best] / k_p[-1])
    return float(np.clip((ratio * k_p[best] + ASSUMED * ASSUMED_AS) / (k_p[best] + ASSUMED_AS), 1 / (len(s_u) + 1), 0.9))


def _penalties(p: Columns, u: Columns) -> np.ndarray:
    """A weight's penalty for each feature, for a prior of 1."""
    rate = (u.counts() + 0.5) / max(1, u.rows)
    share = PENALTY[0] + (PENALTY[1] - PENALTY[0]) * min(1.0, PENALTY[2] / max(1, p.rows))
    return share * chance(rate, p.rows, math.log(max(2, p.width)))


def _fit(p: Columns, u: Columns, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """nnpu() without the features that can never leave zero; their weights are 0."""
    penalty = prior * _penalties(p, u)
    can = (prior * p.counts() / p.rows > penalty) | (u.counts() / u.rows > penalty)
    all_p, all_u, w = np.ones(p.rows, bool), np.ones(u.rows, bool), np.zeros(p.width)
    w[can], b = nnpu(p.of(all_p, can), u.of(all_u, can), prior, penalty[can], steps)
    return w, b


def _held_out(p: Columns, u: Columns, prior: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores of all texts, each by a fit on the folds that it isn't in; 0 where a sample has one text."""
    fold_p, fold_u = np.arange(p.rows) % FOLDS, np.arange(u.rows) % FOLDS
    g_p, g_u, features = np.zeros(p.rows), np.zeros(u.rows), np.ones(p.width, bool)
    for k in range(FOLDS if min(p.rows, u.rows) > 1 else 0):
        w, b = _fit(p.of(fold_p != k, features), u.of(fold_u != k, features), prior, steps)
        g_p[fold_p == k], g_u[fold_u == k] = (p.sums(w) + b)[fold_p == k], (u.sums(w) + b)[fold_u == k]
    return g_p, g_u


def train(toxic: Iterable[str], unlabelled: Iterable[str], prior: float | None = None) -> Model | None:
    """A model from confirmed toxic texts and unlabelled ones (drawn from all); None without either.

    prior: share of toxic texts; None estimates it from scores by fits that haven't seen their texts. At last
    calibrated() scales the weights.
    Equal toxic texts count once, empty ones don't. Of features that the same texts have, the longest beginning stands
    for all.
    """
    toxic, unlabelled = Sample(sorted({t for t in toxic if t})), Sample(t for t in unlabelled if t)
    if not toxic.n or not unlabelled.n:
        return None
    seen = np.zeros(1 << SEEN_BITS, np.uint8)
    toxic.counted(seen)
    unlabelled.counted(seen)
    toxic.keep(seen)
    unlabelled.keep(seen)
    del seen
    names, kind = named((toxic, unlabelled))
    p, u = toxic.columns(names), unlabelled.columns(names)
    alike = np.zeros(len(names), np.uint64)  # a sum of random numbers of its texts tells a feature's texts
    random = words.mix(np.arange(1, toxic.n + unlabelled.n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for columns, shift in ((p, 0), (u, toxic.n)):
        _added(alike, columns.feature, random[shift:], columns.row)
    by = np.lexsort((names, -kind, alike))
    stands = np.zeros(len(names), bool)
    stands[by[np.append(True, alike[by][1:] != alike[by][:-1])[: len(by)]]] = True
    p = p.of(np.ones(p.rows, bool), stands)
    u, names = u.of(np.ones(u.rows, bool), stands), names[stands]
    if prior is None:
        prior = prior_of(*_held_out(p, u, ASSUMED, ORDER_STEPS))
    w, b = _fit(p, u, prior)
    scale, bias = calibrated(p.sums(w), u.sums(w), b, prior)
    return Model(names[w != 0], scale * w[w != 0], bias, prior)


def train_on(docs: DataFrame, labels: DataFrame, prior: float | None = None, toxic_docs: int = TRAIN_TOXIC, unlabelled_docs: int = TRAIN_UNLABELLED, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from documents (doc_id, text) and labels (doc_id, toxic), on bounded samples.

    Only labels of 1 are used as labels; the unlabelled sample is drawn from all of docs. prior: share of toxic
    documents; None estimates it. Rows with nulls aren't picked; a text of n characters is picked with max_chars / n
    times the probability of a short one if it is longer, so that both rows and characters are bounded. A document
    labelled more than once counts as toxic if any label says so.
    """
    labels = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic = 1").select("doc_id")
    n = labels.count()
    if not n:
        return None
    docs = docs.select("doc_id", "text").dropna()
    picked = F.broadcast(sampled(labels, min(1.0, toxic_docs / n), "doc_id").limit(2 * toxic_docs))
    toxic = bounded(docs.join(picked, "doc_id"), max_chars)
    rest = bounded(sampled(docs, min(1.0, unlabelled_docs / max(1, docs.count())), "doc_id", seed=12), max_chars)
    model = train(_texts(toxic), _texts(rest), prior)
    give_back()
    return model


def _texts(df: DataFrame) -> Iterator[str]:
    """The texts of a small df, in order of ids; a batch at a time becomes Python objects."""
    for batch in df.orderBy("doc_id").select("text").toArrow().to_batches(max_chunksize=256):
        yield from batch.column(0).to_pylist()


class Scorer:
    """Scores of texts; the model's features of distinct words are kept by the words' numbers."""

    def __init__(self, model: Model, cache: int = 2_000_000):
        self.model, self.cache = model, cache
        self._reset()

    def _reset(self) -> None:
        self.index, self.flat, self.offsets = words.Index(18), np.empty(0, np.int32), np.zeros(1, np.int64)

    def _new(self, runs: list[bytes]) -> None:
        names, word, h = self.model.features, np.empty(0, np.int64), np.empty(0, np.uint64)
        if len(names):
            word, h, _ = text_features([r.decode() for r in runs])
        at = np.minimum(np.searchsorted(names, h), max(0, len(names) - 1))
        hit = names[at] == h
        self.flat = np.concatenate([self.flat, at[hit].astype(np.int32)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(np.bincount(word[hit], minlength=len(runs)))])

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.index.size > self.cache:
            self._reset()
        data, begin = words.joined([t.lower().encode() for t in texts])
        starts, ends = words.letter_runs(data)
        rows = words.resolve(self.index, data, starts, ends, self._new)
        count = self.offsets[1:] - self.offsets[:-1]
        on = np.flatnonzero(count[rows])
        text = np.searchsorted(begin, starts[on], "right") - 1
        found, _ = words.gathered(self.flat, self.offsets, rows[on])
        width = max(1, len(self.model.features))
        pairs = np.unique(np.repeat(text, count[rows[on]]) * width + found)
        g = np.bincount(pairs // width, self.model.weights[pairs % width], len(texts)) + self.model.bias
        return 0.5 * (1 + np.tanh(g / 2))


def scores(model: Model, texts: list[str]) -> np.ndarray:
    return Scorer(model).scores(texts)


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): toxicity of every whole text, 0 to 1.

    A null text is an empty one, which scores as any text without a weighted feature. Without a model all score 0.
    A null id stays null. Repeated rows give repeated results, an empty table none. Other columns are ignored.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in slices(batches):
            found = scorer.scores(batch.column("text").to_pylist()) if scorer else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], names=["id", "score"])

    return df.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learn = part("doc_id", 4) != 2
    model = train_on(docs.filter(learn), read(spark, sf_dir, "labels").filter(learn))
    return predict(docs, model).select("doc_id", F.coalesce(part("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
