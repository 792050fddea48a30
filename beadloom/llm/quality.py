"""Document quality from line labels: a linear-chain conditional random field marks every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm import crf, words
from beadloom.llm.common import bounded, part, read, sampled, slices

#: Bounds of the training sample: documents of each label, and characters beyond which a document is picked the more
#: seldom the longer it is, so that their total is bounded as well.
TRAIN_EACH = 1500
TRAIN_CHARS = 40_000
#: Spliced training chains for each document of the sample; most blocks of a chain, and most lines of a block.
SPLICED, BLOCKS, BLOCK_LINES = 1.0, 5, 8
#: A document is kept if its score is at least this.
KEEP = 0.5

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[k for k in range(33, 127) if not chr(k).isalnum()]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    slope: float  # document score: logistic of slope * share of good text + shift
    shift: float


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line that isn't blank, bytes of each, number of such lines of each text).

    A line's own features: its length, its words' length and variety, shares of letters, capitals, digits and signs,
    words that end in odd signs, words equal to the one before, whether the line repeats in its text, how it begins and
    ends. To them come those of the line before and after (0 at the ends of a text) and marks for both ends.
    """
    data, begin = words.joined([t.encode() for t in texts])
    newline = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([[0], newline + 1, begin[1:]]))
    starts, ends = words.space_runs(data)
    h = words.hashes(data, starts, ends)
    line_of = np.searchsorted(cuts, starts, "right") - 1
    used, first = np.unique(line_of, return_index=True)  # lines with a word
    n = np.diff(np.append(first, len(starts))).astype(np.float64)
    if not len(used):
        return np.empty((0, 3 * 15 + 2)), np.empty(0), np.zeros(len(texts), np.int64)
    s, e = starts[first], ends[np.append(first[1:], len(starts)) - 1]
    size = (e - s).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return (total[e] - total[s]) / size

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), first) / n

    number = np.repeat(np.arange(len(used), dtype=np.uint64), n.astype(np.int64))
    keyed = words.mix(h ^ (number * np.uint64(0x9E3779B97F4A7C15)))
    by = np.lexsort((keyed, number))
    fresh = np.ones(len(keyed), bool)
    fresh[1:] = keyed[by][1:] != keyed[by][:-1]
    distinct = np.add.reduceat(fresh.astype(np.float64), first)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (number[1:] == number[:-1])
    text_of = np.searchsorted(begin, s, "right") - 1
    line_hash = words.mix(words.hashes(data, s, e) ^ (text_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    _, inverse, times = np.unique(line_hash, return_inverse=True, return_counts=True)
    own = np.stack(
        [
            np.log1p(n) / 5,
            np.log1p(size) / 7,
            np.minimum(per_word(ends - starts), 30) / 10,
            share(_LETTERS),
            share(_UPPER),
            share(data_digit := np.isin(np.arange(256), np.arange(48, 58))),
            share(_SIGN),
            share(_ODD),
            per_word(_ODD[data[ends - 1]]),
            per_word(ends - starts == 1),
            1 - distinct / n,
            per_word(same),
            (times[inverse] > 1).astype(np.float64),
            _UPPER[data[s]].astype(np.float64),
            np.isin(data[e - 1], [33, 46, 63]).astype(np.float64),
        ],
        axis=1,
    )
    del data_digit
    counts = np.bincount(text_of, minlength=len(texts))
    head, tail = np.ones(len(s)), np.ones(len(s))
    head[1:] = text_of[1:] != text_of[:-1]
    tail[:-1] = text_of[1:] != text_of[:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1] * (1 - head[1:, None])
    after[:-1] = own[1:] * (1 - tail[:-1, None])
    return np.hstack([own, before, after, head[:, None], tail[:, None]]), size, counts


def _in_parts(texts: list[str], part: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """line_features() of many texts, made from about `part` characters at a time."""
    found, own, size = [], [], 0
    for text in texts:
        own.append(text)
        size += len(text)
        if size > part:
            found.append(line_features(own))
            own, size = [], 0
    if own or not found:
        found.append(line_features(own))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _x(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([np.clip((features - mean) / scale, -6, 6), np.ones((len(features), 1))])


def good_lines(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of good, bytes) of each line that isn't blank, and the number of lines of each text."""
    features, size, counts = _in_parts(texts)
    if not len(features):
        return np.empty(0), size, counts
    scores = _x(features, model.mean, model.scale) @ model.weights
    return crf.marginals(scores, counts[counts > 0], model.transition)[:, 1], size, counts


def shares(p: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' marginals of each text; 0 for a text without lines."""
    end = np.cumsum(counts)
    good, all_ = (np.concatenate([[0], np.cumsum(v)]) for v in (p * size, size))
    good, all_ = good[end] - good[end - counts], all_[end] - all_[end - counts]
    return np.where(all_ > 0, good / np.maximum(all_, 1e-12), 0)


def spliced(texts: list[str], labels: np.ndarray, chains: int, rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """(texts, labels of their lines): blocks of consecutive lines from documents of alternating labels, joined.

    So lines stand beside lines of the other label, as in a document of which a part is bad. Blank lines are left out.
    """
    lines = [[line for line in t.split("\n") if line.strip(" \t\r\x0b\x0c")] for t in texts]
    by = [np.flatnonzero(labels == k) for k in (0, 1)]
    out, gold = [], []
    for _ in range(chains):
        label, own = int(rng.integers(2)), []
        for _ in range(int(rng.integers(2, BLOCKS + 1))):
            found = lines[by[label][rng.integers(len(by[label]))]]
            want = min(int(rng.integers(1, BLOCK_LINES + 1)), len(found))
            at = int(rng.integers(len(found) - want + 1))
            own += found[at : at + want]
            gold += [label] * want
            label = 1 - label
        out.append("\n".join(own))
    return out, np.array(gold, np.int64)


def train(rows: list[tuple[str, int]], seed: int = 7) -> Model | None:
    """A model from (text, label) rows, 1 for good; None if either label has no text with a line.

    Documents train as they are, every line with its document's label, and spliced with those of the other label, which
    teaches where labels change. A logistic curve over the share of good text is then fitted to the documents.
    """
    rows = sorted({(t, int(y)) for t, y in rows if t and t.strip(" \n\t\r\x0b\x0c")})
    if len({y for _, y in rows}) < 2:
        return None
    texts, y = [t for t, _ in rows], np.array([y for _, y in rows])
    more, gold = spliced(texts, y, int(SPLICED * len(texts)), np.random.default_rng(seed))
    features, size, counts = _in_parts([*texts, *more])
    own = counts[: len(texts)]
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    weights, transition = crf.fit(crf.Dense(_x(features, mean, scale)), np.arange(len(features)), np.concatenate([np.repeat(y, own), gold]), counts[counts > 0], 2, epochs=12, batch=50, l2=1e-3, seed=seed)
    model = Model(mean, scale, weights, transition, 1.0, 0.0)
    s = shares(*good_lines(model, texts))
    a, b = 4.0, -2.0
    for _ in range(2000):  # plain gradient descent with both labels weighing the same
        p = 1 / (1 + np.exp(-(a * s + b)))
        g = (p - y) / np.where(y == 1, (y == 1).sum(), (y == 0).sum())
        a, b = a - 2 * (g * s).sum() - 2e-4 * a, b - 2 * g.sum()
    model.slope, model.shift = float(max(a, 0.1)), float(b)
    return model


def train_on(docs: DataFrame, labels: DataFrame, each: int = TRAIN_EACH, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from documents (doc_id, text) with labels (doc_id, quality), on a sample of about `each` rows a label.

    Rows with nulls aren't picked; a text of n characters is picked with max_chars / n times the probability of a short
    one if it is longer, so that both rows and characters are bounded. A document labelled more than once counts as bad
    if any label says so.
    """
    labels = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for label in (0, 1):
        share = F.when(F.col("quality") == label, F.lit(min(1.0, each / max(1, n.get(label, 0))))).otherwise(share)
    picked = F.broadcast(sampled(labels, share, "doc_id").limit(4 * each))  # about 2 * each rows
    rows = bounded(docs.select("doc_id", "text").dropna().join(picked, "doc_id"), max_chars).select("text", "quality").collect()
    return train([tuple(r) for r in rows])


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, lines, good_lines): quality of every whole text, 0 to 1.

    A null or blank text has no good line and scores 0. Without a model every other text scores 0.5. Repeated rows give
    repeated results, an empty table none.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score, counts, good = scored(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score), pa.array(counts), pa.array(good)], names=["id", "score", "lines", "good_lines"])

    return df.mapInArrow(run, f"id {kind}, score double, lines bigint, good_lines bigint").withColumnRenamed("id", id_col)


def label_lines(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lines): for each text an array of (line, good) with the probability of good of each line that isn't blank.

    A null or blank text has an empty array; a null id stays null. Repeated rows give repeated results.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("line", pa.string()), ("good", pa.float64())])
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            p, _, counts = good_lines(model, texts)
            found, at = [], 0
            for t, n in zip(texts, counts.tolist(), strict=True):
                lines = [line for line in t.split("\n") if line.strip(" \t\r\x0b\x0c")]
                found.append([{"line": line, "good": float(g)} for line, g in zip(lines, p[at : at + n], strict=True)])
                at += n
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(item))], names=["id", "lines"])

    return df.mapInArrow(run, f"id {kind}, lines array<struct<line:string,good:double>>").withColumnRenamed("id", id_col)


def scored(model: Model | None, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, lines, good lines) of each text."""
    if model is None:
        counts = np.array([sum(1 for line in t.split("\n") if line.strip()) for t in texts], np.int64)
        return np.where(counts > 0, 0.5, 0.0), counts, np.zeros(len(texts), np.int64)
    p, size, counts = good_lines(model, texts)
    share = shares(p, size, counts)
    upto = np.concatenate([[0], np.cumsum(p >= 0.5)])
    end = np.cumsum(counts)
    score = np.where(counts > 0, 1 / (1 + np.exp(-(model.slope * share + model.shift))), 0.0)
    return score, counts.astype(np.int64), (upto[end] - upto[end - counts]).astype(np.int64)


def kept(df: DataFrame, model: Model | None, text: str = "text", threshold: float = KEEP) -> DataFrame:
    """The rows of df, with all columns, whose text scores at least threshold. A null or blank text scores 0 and goes."""
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            score, _, _ = scored(model, [t or "" for t in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(score >= threshold))

    return df.mapInArrow(run, schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train_on(docs, read(spark, sf_dir, "labels").filter(part("doc_id", 3) != 1))
    return predict(docs, model).select("doc_id", F.coalesce(part("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
