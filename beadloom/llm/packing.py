"""Best-fit packing by the sum-of-squares rule, and the tokenised pieces that it packs."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beadloom.llm import words
from beadloom.llm.common import fresh, read, slices, stash

#: Runs whose ids a worker keeps; beyond that it starts anew.
CACHE = 3_000_000
#: White space outside ASCII.
_SPACES = regex.compile(r"[\x85\p{Z}]")
#: Pieces that one packing task takes, about.
SHARD = 100_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, for the word_bpe vocabulary.

    Its rules split at white space, then into letters, single digits and other signs, before the merges work on each
    piece by itself. So texts are cut into runs of one class, and the ids of a run are kept. Runs outside Latin script,
    texts with capitals or marks that Python and the tokenizer treat differently, and those that hold the name of an
    added token (such as <|endoftext|>) go through the tokenizer unsplit.
    """

    def __init__(self, path: str, cache: int = CACHE):
        self.tokenizer, self.cache = _tokenizer(path), cache
        self.merges = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self._reset()

    def _reset(self) -> None:
        self.index, self.flat, self.offsets, self.used = words.Index(18), np.empty(1 << 16, "<u4"), [0], 0

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        if not piece.isascii() or not piece.isprintable():
            piece = "".join([self.letters[b] for b in piece.encode()])
        return [t.id for t in self.merges(piece)]

    def _new(self, runs: list[bytes]) -> None:
        for run in map(bytes.decode, runs):
            if run.isalpha() and run.isascii():
                ids = self._piece(run)
            elif max(run) >= "\u0250" or not run.isprintable():
                ids = self._whole(run)
            else:
                ids = [i for p in self.split(run) for i in self._piece(p)]
            if self.used + len(ids) > self.flat.size:
                self.flat = np.concatenate([self.flat, np.empty(max(self.flat.size, len(ids)), "<u4")])
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.offsets.append(self.used)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.index.size > self.cache:
            self._reset()
        out: list[bytes] = [b""] * len(texts)
        plain: list[int] = []
        raw: list[bytes] = []
        for k, text in enumerate(texts):
            low, odd = text.lower(), False
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
                low = text.lower()
                odd = "Σ" in text or "İ" in text or not unicodedata.is_normalized("NFC", low)
                low = _SPACES.sub(" ", low)
            if odd or any(name in low for name in self.added):
                out[k] = np.asarray(self._whole(texts[k]), "<u4").tobytes()
                continue
            plain.append(k)
            raw.append(low.encode())
        if plain:
            data, begin = words.joined(raw)
            starts, ends = words.class_runs(data)
            rows = words.resolve(self.index, data, starts, ends, self._new)
            ids, upto = words.gathered(self.flat, np.asarray(self.offsets), rows)
            cut = np.concatenate([[0], upto])[np.searchsorted(starts, begin)]
            for k, a, b in zip(plain, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                out[k] = ids[a:b].tobytes()
        return out


def tokenised_pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each text's ids and end_id, cut only where longer than capacity.

    A null text is empty and gives one piece of end_id. ids (with_ids) are little-endian unsigned 32-bit bytes.
    Repeated rows give repeated pieces; an empty table gives none.
    """
    df = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema["id"].dataType.simpleString()
    end, width = np.asarray([end_id], "<u4").tobytes(), 4 * capacity

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in slices(batches):
            rows, pieces, lengths, sums, ids = [], [], [], [], []
            for k, found in enumerate(encoder.encode(batch.column("text").to_pylist())):
                found += end
                for piece, at in enumerate(range(0, len(found), width)):
                    cut = found[at : at + width]
                    rows.append(k)
                    pieces.append(piece)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(cut)
            at = pa.array(pieces, pa.int32())
            out = [batch.column("id").take(pa.array(rows, pa.int64())), at, pa.array(np.asarray(pieces, np.int64) * capacity), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array(ids, pa.binary())] if with_ids else [])], names=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return df.mapInArrow(encode, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids).withColumnRenamed("id", id_col)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, placed in the given order.

    N(g) counts open bins with residual gap g. An item goes where the sum of N(g)^2 over all gaps is smallest
    afterwards: into a bin of some gap, or into a new bin. Ties prefer the tightest gap, then an open bin.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for k, size in enumerate(sizes.tolist()):
        # change of the sum if a bin of gap g takes it, for g = size .. capacity - 1
        gaps = count[size:capacity]
        new = 2 * int(count[capacity - size]) + 1 if size < capacity else 0
        place = capacity
        if gaps.size:
            change = np.where(gaps > 0, 2 * (count[: capacity - size] - gaps) + 2, np.iinfo(np.int64).max)
            if gaps[0] > 0:
                change[0] = 1 - 2 * gaps[0]  # a perfect fit opens no gap
            best = int(change.argmin())
            if gaps[best] > 0 and change[best] <= new:
                place = size + best
        if place == capacity:
            bin_, used = used, used + 1
        else:
            bin_ = open_bins[place].pop()
            count[place] -= 1
        bins[k], offsets[k] = bin_, capacity - place
        if place > size:
            open_bins[place - size].append(bin_)
            count[place - size] += 1
    return bins, offsets


def pack(df: DataFrame, capacity: int = 2048, length: str = "length", shard_rows: int = SHARD) -> DataFrame:
    """df with sequence_id and offset (both bigint): places of at most `capacity` in gapless sequences.

    Rows are dealt evenly into shards of about shard_rows by a hash of the whole row, so no key makes a shard large and
    equal rows may meet in any shard; each shard is packed by itself, longest first, with the sum-of-squares rule.
    Lengths are 1 .. capacity; others, null too, raise an error. An empty df gives an empty result. Columns of df named
    sequence_id or offset are replaced, all others kept, whatever their names.
    """
    df = df.drop("sequence_id", "offset")
    (shard_of,) = fresh(df, "shard")
    n = df.count()
    if not n:
        return df.withColumns({"sequence_id": F.lit(None).cast("bigint"), "offset": F.lit(None).cast("bigint")}).filter("false")
    shards = -(-n // shard_rows)
    out = T.StructType([*df.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    df = df.withColumn(shard_of, F.pmod(F.xxhash64(*df.columns), F.lit(shards)).cast("int"))

    def place(table: pa.Table) -> pa.Table:
        shard = table.column(shard_of)[0].as_py()
        table = table.drop_columns([shard_of])
        keys = [(length, "descending"), *((c, "ascending") for c in table.column_names if c != length and not pa.types.is_nested(table.schema.field(c).type))]
        table = table.sort_by(keys)
        sizes = table.column(length).to_numpy()
        if table.column(length).null_count:
            raise ValueError(f"a null length; 1 to {capacity} can be packed")
        if sizes.min() < 1 or sizes.max() > capacity:
            raise ValueError(f"lengths from {sizes.min()} to {sizes.max()}; 1 to {capacity} can be packed")
        bins, offsets = sum_of_squares(sizes, capacity)
        return table.append_column("sequence_id", pa.array(bins + (shard << 40))).append_column("offset", pa.array(offsets))

    return df.groupBy(shard_of).applyInArrow(place, out)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_documents(df: DataFrame, tokenizer_path: str | None = None, capacity: int = 2048) -> DataFrame:
    """The pieces of tokenised_pieces() with their places; tokenised once, into a scratch table."""
    return pack(stash(tokenised_pieces(df, tokenizer_path or default_tokenizer(), capacity), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))
