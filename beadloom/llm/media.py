"""Media columns: texts as 8-bit WAV, short-time Fourier transforms, and spectral-peak pair fingerprints."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beadloom.llm.common import read, slices

#: Samples of a frame; payloads are padded to a positive multiple of it.
FRAME = 576
HOP = 288
RATE = 16_000
#: Peaks kept of a frame, and frames ahead with which they are paired.
PEAKS = 3
AHEAD = 2
PAD = 255
#: Frames that are transformed at a time.
BLOCK = 2048


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV with one unsigned 8-bit sample a byte."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


_WINDOW = np.hanning(FRAME).astype(np.float32)


def peaks(samples: np.ndarray) -> np.ndarray:
    """(frames, PEAKS) strongest local maxima of each frame's spectrum as bins, strongest first; -1 where fewer.

    Bins are compared by rounded magnitudes, ties to the lower bin, so the result doesn't hang on the last bits.
    """
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    out = np.empty((len(frames), PEAKS), np.int64)
    for k in range(0, len(frames), BLOCK):
        spectrum = np.abs(np.fft.rfft((frames[k : k + BLOCK].astype(np.float32) - 128) * _WINDOW, axis=1))
        mag = np.round(spectrum * 16).astype(np.int64)
        inner = mag[:, 1:-1]
        top = np.where((inner > mag[:, :-2]) & (inner >= mag[:, 2:]), inner, 0)
        score = top * 512 + (511 - np.arange(top.shape[1]))
        best = np.argpartition(-score, PEAKS - 1, axis=1)[:, :PEAKS]
        picked = np.take_along_axis(score, best, 1)
        by = np.argsort(-picked, axis=1)
        best, picked = np.take_along_axis(best, by, 1), np.take_along_axis(picked, by, 1)
        out[k : k + BLOCK] = np.where(picked >= 512, best + 1, -1)
    return out


def fingerprint(payload: bytes) -> np.ndarray:
    """Time-coded pairs of spectral peaks: frame << 32 | bin << 20 | later bin << 8 | frames between, sorted.

    Peaks of one frame are paired too (0 between, the lower bin first), so that one frame is enough. Frames are centred
    on multiples of HOP, with padding beyond both ends: the window is near 0 at its edges, where a short text would go
    unheard. A payload without peaks (padding alone, or one sign repeated) has no pairs, and the shortest texts, a few
    bytes in one window, can share theirs.
    """
    found = peaks(np.pad(np.frombuffer(payload, np.uint8), FRAME // 2, constant_values=PAD))
    parts = []
    for ahead in range(AHEAD + 1):
        if len(found) <= ahead:
            break
        a, b = found[: len(found) - ahead, :, None], found[ahead:, None, :]
        code = (np.arange(len(a), dtype=np.int64)[:, None, None] << 32) | (a << 20) | (b << 8) | ahead
        parts.append(code[(a >= 0) & (b >= 0) & ((ahead > 0) | (a < b))])
    return np.sort(np.concatenate(parts)) if parts else np.empty(0, np.int64)


def store_wav(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, media): every whole text as UTF-8, padded with bytes 255 to a positive multiple of FRAME, as WAV.

    A null text counts as empty: one frame of padding; a null id stays null. Repeated rows give repeated rows, an empty
    df none. Other columns are dropped, so none can clash.
    """
    df = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, media = [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                raw = value or b""
                sizes.append(len(raw))
                media.append(to_wav(raw + bytes([PAD]) * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["id", "n_bytes", "media"])

    return df.mapInArrow(encode, f"id {kind}, n_bytes bigint, media binary").withColumnRenamed("id", id_col)


def read_wav(df: DataFrame, media: str = "media") -> DataFrame:
    """df with payload (the samples that the wave module reads back) and fingerprint (array of bigint).

    A null media gives null for both. Repeated rows give repeated rows, an empty df none. Columns of df named payload or
    fingerprint are replaced, all others kept.
    """
    df = df.drop("payload", "fingerprint")
    schema = T.StructType([*df.schema.fields, T.StructField("payload", T.BinaryType()), T.StructField("fingerprint", T.ArrayType(T.LongType()))])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, media):
            payloads = [None if m is None else from_wav(m) for m in batch.column(media).to_pylist()]
            prints = [None if p is None else fingerprint(p) for p in payloads]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(payloads, pa.binary()), pa.array(prints, pa.list_(pa.int64()))], names=[*batch.schema.names, "payload", "fingerprint"])

    return df.mapInArrow(decode, schema)


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of what read_wav() returns, with the fingerprint itself. Nulls give nulls; other columns are dropped."""
    return df.select(
        id_col,
        "n_bytes",
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        F.length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws("-", F.size("fingerprint").cast("string"), F.hex(F.xxhash64("fingerprint"))).alias("feature"),
        "fingerprint",
    )


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_wav(store_wav(read(spark, sf_dir, "documents"))))
