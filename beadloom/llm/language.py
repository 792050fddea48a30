"""Language of words and documents by a linear-chain conditional random field over code-switched text."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm import crf, words
from beadloom.llm.common import bounded, part, read, sampled, slices

#: Bounds of the training sample: documents, and characters beyond which one is picked the more seldom the longer it is,
#: so that their total is bounded as well.
TRAIN_DOCS = 2400
TRAIN_CHARS = 40_000
#: Hash buckets of the affix and n-gram features, and words of each language's lexicon.
BUCKETS = 1 << 16
LEXICON = 300
#: Code-switched training chains, and words of one at most.
CHAINS = 5000
CHAIN_WORDS = 40
#: Words of over HEAD + TAIL characters keep their first and last ones in the slots; long_features() has the rest.
HEAD, TAIL = 12, 8
#: Starts of n-grams of a long word that are hashed at a time.
WINDOW = 1 << 16
#: Distinct words that a worker keeps scores of.
CACHE = 1_000_000

_LETTER = re.compile(r"[^\W\d_]")
_SEED = np.uint64(0x8E9D5A3F1C2B4D67)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (features, languages)
    transition: np.ndarray
    lexicon: dict[str, int]  # word: the language whose lexicon has it


def _codes(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cut = [w if len(w) <= HEAD + TAIL else w[:HEAD] + w[-TAIL:] for w in found]
    codes = np.array(cut, dtype=f"U{HEAD + TAIL}").view(np.uint32).reshape(len(cut), HEAD + TAIL).astype(np.uint64)
    return codes, (codes != 0).sum(axis=1)


def _hashed(columns: np.ndarray, kind: int) -> np.ndarray:
    h = np.full(len(columns), kind, np.uint64) * _SEED
    for k in range(columns.shape[1]):
        h = (h ^ columns[:, k]) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return (words.mix(h) % np.uint64(BUCKETS)).astype(np.int32)


def long_features(word: str, window: int = WINDOW) -> Iterator[np.ndarray]:
    """Numbers of all 2- and 3-grams of a long word, in consecutive windows, and of the whole word."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    for at in range(0, len(codes) - 1, window):
        for n in (2, 3):
            own = codes[at : at + window + n - 1].astype(np.uint64)
            if len(own) >= n:
                yield _hashed(np.lib.stride_tricks.sliding_window_view(own, n), 20 + n)
    digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
    yield _hashed(np.frombuffer(digest, np.uint64).reshape(1, 1), 31)


def is_long(word: str) -> bool:
    return len(word) > HEAD + TAIL


def word_features(found: list[str], lexicon: dict[str, int], langs: int) -> np.ndarray:
    """Numbers of each word's features (slots of a row; BUCKETS + langs + 1 for none).

    Prefixes and suffixes of 1 to 3 characters, all 2- and 3-grams and the word itself are hashed into BUCKETS;
    after those come one feature for each language's lexicon and one that all words have. A long word's n-grams and the
    word itself don't fit the slots; long_features() gives them.
    """
    codes, size = _codes(found)
    short = np.array([not is_long(w) for w in found], bool)
    none, parts = BUCKETS + langs + 1, []

    for n in (1, 2, 3):
        fits = size >= n
        tail = np.take_along_axis(codes, np.maximum(size[:, None] - n + np.arange(n), 0), 1)
        parts += [np.where(fits, _hashed(codes[:, :n], n), none), np.where(fits, _hashed(tail, 10 + n), none)]
    for n in (2, 3):
        for k in range(HEAD + TAIL - n + 1):
            if not (fits := (size >= k + n) & short).any():
                break
            parts.append(np.where(fits, _hashed(codes[:, k : k + n], 20 + n), none))
    parts.append(np.where(short, _hashed(codes, 30), none))
    parts.append(np.array([BUCKETS + lexicon[w] if w in lexicon else none for w in found], np.int32))
    parts.append(np.full(len(found), BUCKETS + langs, np.int32))
    return np.stack(parts, axis=1).astype(np.int32)


def _found(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, begin = words.joined([t.lower().encode() for t in texts])
    starts, ends = words.letter_runs(data)
    return data, starts, ends, np.searchsorted(starts, begin)


class Scorer:
    """Emission scores of words; those of distinct words are kept."""

    def __init__(self, model: Model):
        self.model, self.table = model, np.vstack([model.weights, np.zeros(len(model.langs))]).astype(np.float32)
        self._reset()

    def _reset(self) -> None:
        self.index, self.scores, self.used = words.Index(18), np.empty((1 << 15, len(self.model.langs)), np.float32), 0

    def _new(self, runs: list[bytes]) -> None:
        for k in range(0, len(runs), 20_000):
            got = [r.decode() for r in runs[k : k + 20_000]]
            fresh = self.table[word_features(got, self.model.lexicon, len(self.model.langs))].sum(axis=1)
            for at, word in enumerate(got):
                if is_long(word):
                    fresh[at] += sum(self.table[own].sum(axis=0, dtype=np.float64) for own in long_features(word))
            while self.used + len(fresh) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
            self.scores[self.used : self.used + len(fresh)] = fresh
            self.used += len(fresh)

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(marginals of every word, cuts between texts, bytes, starts, ends)."""
        if self.index.size > CACHE:
            self._reset()
        data, starts, ends, cut = _found(texts)
        rows = words.resolve(self.index, data, starts, ends, self._new)
        sizes = np.diff(cut)
        return crf.marginals(self.scores[rows].astype(np.float64), sizes[sizes > 0], self.model.transition), cut, data, starts, ends


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """A model from (text, language) rows; None if they hold no word.

    Training chains are code-switched: runs of 3 to 16 words from documents of one to three languages, joined, with
    every word labelled with its document's language. So transitions learn how long a language lasts.
    """
    rows = sorted((t, g) for t, g in rows if t and g and _LETTER.search(t))
    if not rows:
        return None
    langs = sorted({g for _, g in rows})
    code = {g: k for k, g in enumerate(langs)}
    docs = [re.findall(r"[^\W\d_]+", t.lower()) for t, _ in rows]
    counts = [Counter() for _ in langs]
    for (_, g), found in zip(rows, docs, strict=True):
        counts[code[g]].update(found)
    totals = [max(1, sum(c.values())) for c in counts]
    lexicon: dict[str, int] = {}
    for k, own in enumerate(counts):
        for w, n in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if n > 1 and n / totals[k] >= 2 * max((c[w] / totals[i] for i, c in enumerate(counts) if i != k), default=0):
                lexicon[w] = k
    rng = np.random.default_rng(seed)
    by = [[d for d, (_, g) in enumerate(rows) if code[g] == k] for k in range(len(langs))]
    chain_words: list[str] = []
    gold: list[int] = []
    lengths: list[int] = []
    for _ in range(CHAINS):
        size = 0
        for k in rng.permutation(len(langs))[: rng.integers(1, min(3, len(langs)) + 1)]:
            found = docs[by[k][rng.integers(len(by[k]))]]
            want = int(min(rng.integers(3, 17), CHAIN_WORDS - size, len(found)))
            at = int(rng.integers(len(found) - want + 1))
            chain_words += found[at : at + want]
            gold += [int(k)] * want
            size += want
        if size:
            lengths.append(size)
    distinct = sorted(set(chain_words))
    number = {w: k for k, w in enumerate(distinct)}
    features = crf.Sparse(word_features(distinct, lexicon, len(langs)), BUCKETS + len(langs) + 1, {k: np.concatenate(list(long_features(w))) for k, w in enumerate(distinct) if is_long(w)})
    weights, transition = crf.fit(features, np.array([number[w] for w in chain_words]), np.array(gold), np.array(lengths), len(langs), epochs=3, batch=100)
    return Model(langs, weights, transition, lexicon)


def train_on(df: DataFrame, max_docs: int = TRAIN_DOCS, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from the text and lang of df, on a sample of about max_docs rows, as many of each language.

    Rows with a null text, lang or doc_id aren't picked; a text of n characters is picked with max_chars / n times the
    probability of a short one if it is longer, so that both rows and characters are bounded.
    """
    df = df.select("doc_id", "text", "lang").dropna()
    langs = sorted((r["lang"], r["count"]) for r in df.groupBy("lang").count().collect())
    each = max_docs // max(1, len(langs))
    share = F.lit(0.0)
    for lang, n in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(share)
    return train([(r["text"], r["lang"]) for r in bounded(sampled(df, share, "doc_id"), max_chars).select("text", "lang").limit(2 * max_docs).collect()])


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score, words): language of every whole text.

    Words are letter runs, lower-cased. lang_pred is the language with the largest sum of the words' marginals,
    weighted by length, and score its share; ties go to the first in alphabetical order. A text that is null or holds
    no letter, and any text without a model, gets `und` and score 0. Letters that form no word here (odd scripts) give
    the model's first language and an even share. Repeated rows give repeated results, an empty table none.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            langs, scores, counts = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            if scorer:
                marginal, cut, _, starts, ends = scorer.marginals(texts)
                sums = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(marginal * (ends - starts)[:, None], axis=0)])
                total = sums[cut[1:]] - sums[cut[:-1]]
                counts = np.diff(cut)
                best = total.argmax(axis=1)
                for k, t in enumerate(texts):
                    if counts[k]:
                        langs[k], scores[k] = model.langs[best[k]], total[k, best[k]] / total[k].sum()
                    elif _LETTER.search(t):
                        langs[k], scores[k] = model.langs[0], 1 / len(model.langs)
                    if counts[k] and not _LETTER.search(t):
                        langs[k], scores[k] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs), pa.array(np.clip(scores, 0, 1)), pa.array(counts)], names=["id", "lang_pred", "score", "words"])

    return df.mapInArrow(run, f"id {kind}, lang_pred string, score double, words bigint").withColumnRenamed("id", id_col)


def tag_words(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tags): for each text an array of (word, lang, p), every word with its likeliest language and marginal.

    A text without words gives an empty array.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        item = pa.struct([("word", pa.string()), ("lang", pa.string()), ("p", pa.float64())])
        for batch in slices(batches):
            marginal, cut, data, starts, ends = scorer.marginals(batch.column("text").to_pylist())
            raw, best = data.tobytes(), marginal.argmax(axis=1)
            tags = [{"word": raw[s:e].decode(), "lang": model.langs[b], "p": float(m[b])} for s, e, b, m in zip(starts.tolist(), ends.tolist(), best.tolist(), marginal, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([tags[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.list_(item))], names=["id", "tags"])

    return df.mapInArrow(run, f"id {kind}, tags array<struct<word:string,lang:string,p:double>>").withColumnRenamed("id", id_col)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train_on(docs.filter(part("doc_id", 3) != 1))
    return predict(docs, model).select("doc_id", F.coalesce(part("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
