"""Shared pieces of the training-data operators: inputs, scratch tables, ids, words and hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with a null id take this key where an order of ids is needed, so they come last.
NO_ID = 2**63 - 1

#: Python's bytes.split() and the character class [\x20\x09-\x0D] name the same six separators.
SPACES = " \t\n\x0b\x0c\r"


#: Bytes that an Arrow batch to a Python worker may take; rows alone are no bound where texts are long.
BATCH_BYTES = 8 << 20

#: Rows of a file of a scratch table, where their number is known; see Scratch.save.
LEAST_ROWS = 2000


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on Arrow batches to BATCH_BYTES; a lower one stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; in local mode a temporary one may stand in where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='shardlog-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def smallest_hashed(df: DataFrame, cols: list[str], k: int, bins: int = 1 << 16) -> DataFrame:
    """The k rows of df with the smallest hashes of cols; rows are distinct in them.

    Rows are counted by the first bits of their hash (``bins`` numbers come to the driver, whatever the input); only those in the first
    bins that hold k rows are sorted.
    """
    h = F.pmod(F.xxhash64(*cols), F.lit(2**40))
    bin_ = F.floor(h / (2**40 // bins))
    counts = df.groupBy(bin_.alias("_bin")).count().toArrow()
    order = np.argsort(at := counts.column("_bin").to_numpy())
    full = np.cumsum(counts.column("count").to_numpy()[order]) >= k
    if full.any():
        df = df.where(bin_ <= int(at[order][full.argmax()]))
    return df.orderBy(h, *cols).limit(k)


class Scratch:
    """Intermediate tables in the shared folder. They cut lineage: a lost executor costs only the stage that was running. What is not
    dropped before goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read again. rows: about how many it has; files then hold LEAST_ROWS or more, where that still gives
        eight, so that small tables are not scattered over a cluster's many shuffle partitions."""
        if rows is not None and (files := max(8, -(-rows // LEAST_ROWS))) < partitions(self.spark):
            df = df.coalesce(files)
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows and about ``size`` bytes of text (one row at least), so that only a piece's texts
    are Python objects at once."""
    for b in batches:
        n = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                n += np.nan_to_num(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
        ends, at = np.cumsum(n), 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
            yield b.slice(at, to - at)
            at = to


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """bytes of a word -> 64-bit hash; remembers a bounded number of words."""

    def __init__(self, seed: int = 0, most: int = 150_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products of hashes are spread evenly."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive word hashes: a polynomial in an odd 64-bit base, then mixed. which: 0 or 1, two independent ones."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    base = _ODD[which]
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * base + h[k : len(h) - n + 1 + k]
    return mix(out)
