"""What the operators of this subpackage share: tables in the shared folder, joins that survive hot keys, text batches."""

from __future__ import annotations

import ctypes
import pickle
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a character class for Java's regular expressions and for RE2.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot when it holds one row in HOT_SHARE or more, so there are HOT_SHARE hot keys at most; each is dealt to FAN tasks.
HOT_SHARE, FAN = 256, 64
#: Python workers take a batch of rows in slices of about this many bytes of text.
SLICE_BYTES = 4_000_000
_own_dir: list[str] = []
_open: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local master has a temporary folder of its own; on a cluster there is no folder to guess, which is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="drillspark-"))
    return _own_dir[0]


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back, so a lost executor costs no earlier stage."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables made by ``store`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches of at most 1000 rows or 16 MB, for they hold a batch and what is made of it at once."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        if not 0 < int(re.sub(r"[^-\d]", "", spark.conf.get(key))) <= most:
            spark.conf.set(key, str(most))


def ship(spark: SparkSession, value):
    """Broadcast ``value`` with its classes by value, so executors need no copy of this package. ``unpacked`` opens it."""
    return uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(shared):
    """What ``ship`` has packed; a task opens a package once."""
    name, packed = shared
    if name not in _open:
        _open.clear()
        _open[name] = pickle.loads(packed.value)
    return _open[name]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_of(df: DataFrame, column: str) -> int:
    """The sum of a column as one number on the driver."""
    return int(df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0])


def _dealt_join(left: DataFrame, right: DataFrame, key: str, hot: list, row_id: Column, how: str) -> DataFrame:
    """Join on ``key``; rows of ``left`` with a hot key are dealt to FAN tasks, each of which has the hot rows of ``right``."""
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    left = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(row_id), F.lit(FAN)).cast("int")).otherwise(F.lit(0)))
    right = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(FAN - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def spread_lookup(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, row_id: Column, how: str = "inner", weights: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to ``right``, which has one row a key and in ``weight`` the rows that ``left`` has for it.

    Only hot keys come to the driver, at most HOT_SHARE of them; they are read from ``weights`` if that is named, so give it
    where ``right`` is no written table. ``row_id`` deals their rows out.
    """
    counted = right if weights is None else weights
    hot = [r[0] for r in counted.where(F.col(weight) * HOT_SHARE >= F.lit(total)).select(key).collect()]
    return _dealt_join(left, right, key, hot, row_id, how)


def deal_lookup(left: DataFrame, right: DataFrame, key: str, row_id: Column, seen: DataFrame, how: str = "inner") -> DataFrame:
    """Like ``spread_lookup`` where the rows a key has in ``left`` are those that it has in ``seen``, a written table."""
    total = seen.count()
    counts = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull() & (F.col("n") * HOT_SHARE >= F.lit(total)))
    return _dealt_join(left, right, key, [r[0] for r in counts.select(key).collect()], row_id, how)


def small_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str, rows: int, row_bytes: int, limit: int = 16_000_000) -> DataFrame:
    """Broadcast ``right`` only if its counted size is below ``limit`` bytes; else leave the join to Catalyst."""
    return left.join(F.broadcast(right) if rows * row_bytes <= limit else right, on, how)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut into slices with about ``most`` bytes of text; one longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Freed memory of Arrow and of the C library goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` for mapInArrow, with ``give_back`` when a task is done: reused workers would keep what it has freed beside all later tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def as_string(column: pa.Array) -> pa.Array:
    """64-bit offsets, nulls as empty texts."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and where each text's words begin (one place more than texts)."""
    parts = pc.ascii_split_whitespace(as_string(texts))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "")
    counts = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    offsets = offsets - offsets[0]
    return flat.filter(full), counts[offsets]


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash for each word; every distinct word is hashed once."""
    import xxhash

    coded = words.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return distinct[coded.indices.to_numpy()]


def wide_word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes for each word; every distinct word is hashed once."""
    import xxhash

    coded = words.dictionary_encode()
    raw = b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist())
    distinct, codes = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2), coded.indices.to_numpy()
    return distinct[codes, 0], distinct[codes, 1]


_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, one for each place where n words are left."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * _BASE + hashes[i : i + len(out)]
    return mix64(out)
