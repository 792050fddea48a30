"""What the operators of this subpackage share: scratch tables, Arrow batches in bounded slices, hash splits."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 1 << 20
#: A key with more than 1 / PIECES of all rows is dealt into pieces of that size.
PIECES = 4096
#: Where each table of stash() lies, as long as somebody holds it.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Where none is set, a local session makes a temporary one; on a cluster, whose machines wouldn't share it, that is
    an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = "file://" + tempfile.mkdtemp(prefix="beadloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session may be gone; the folder is scratch space
        pass


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared scratch folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/beadloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete_at_exit, spark, path)
    kept = spark.read.schema(df.schema).parquet(path)
    _PATHS[kept] = path
    return kept


def drop(*stashed: DataFrame) -> None:
    """Deletes the files of stash() tables that nothing is going to read again; the rest go when the process ends."""
    for df in stashed:
        if path := _PATHS.pop(df, None):
            delete(df.sparkSession, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns, like the given ones, that no column of df has in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def part(column: str, parts: int) -> Column:
    """crc32 of the value as text, modulo parts; null for null."""
    return F.crc32(F.col(column).cast("string")) % parts


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `limit` bytes of the text column; a longer row stands alone."""
    for batch in batches:
        column, start, size = batch.column(text), 0, 0
        for k, n in enumerate(pc.binary_length(column).to_pylist()):
            if size and size + (n or 0) > limit:
                yield batch.slice(start, k - start)
                start, size = k, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def sampled(df: DataFrame, share: Column | float, *keys: str, seed: int = 11) -> DataFrame:
    """Rows picked by a hash of the keys, each with the given probability; the same rows at every run."""
    span = 1 << 30
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(span)) < (share if isinstance(share, Column) else F.lit(share)) * span)


def bounded(df: DataFrame, max_chars: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """df with each text of n characters, n > max_chars, kept with a probability of max_chars / n, by a hash of its id.

    So no length is left out, and the expected characters are at most max_chars a row.
    """
    return sampled(df, F.least(F.lit(1.0), F.lit(float(max_chars)) / F.greatest(F.length(text), F.lit(1))), id_col, seed=13)


def pieces(counts: DataFrame, key: str, of: int = PIECES, total: int | None = None) -> DataFrame:
    """(key, k) of the keys that hold more than 1 / of of all rows, for counts (key, n): into how many pieces each is dealt.

    These are fewer than `of` keys, so the table can be broadcast; a piece has about 1 / of of all rows at most. Given
    total, the sum of n, nothing runs here; else the sum is taken and the table written.
    """
    share = max(1, (total if total is not None else counts.agg(F.sum("n")).first()[0] or 0) // of)
    hot = counts.filter(F.col("n") > share).select(key, F.ceil(F.col("n") / share).cast("int").alias("k"))
    return hot if total is not None else stash(hot, "pieces")


def in_piece(df: DataFrame, key: str, hot: DataFrame, by: Column, piece: str = "p") -> DataFrame:
    """df with its rows' piece: by, a hash, modulo the pieces of its key; 0 for keys that aren't dealt."""
    at, k = fresh(df.withColumn(piece, F.lit(0)), "hot", "k")
    hot = F.broadcast(hot.select(F.col(key).alias(at), F.col("k").alias(k)))  # fewer than PIECES rows
    return df.join(hot, F.col(key) == F.col(at), "left").withColumn(piece, F.coalesce(F.pmod(by, F.col(k)), F.lit(0)).cast("int")).drop(at, k)


def in_all_pieces(df: DataFrame, key: str, hot: DataFrame, piece: str = "p") -> DataFrame:
    """df with a row for each piece of its key, so that a join by (key, piece) finds what one by key would."""
    dealt = df.join(F.broadcast(hot), key, "left")  # fewer than PIECES rows
    return dealt.withColumn(piece, F.explode(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1))).drop("k")


def give_back() -> None:
    """Gives what this process no longer uses of its memory back to the machine."""
    from beadloom.llm import words

    words.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving its memory back to the machine at its end: workers live on idle while later stages need memory."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped
