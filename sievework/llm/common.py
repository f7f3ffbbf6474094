"""Helpers shared by the corpus operators.

Text columns are read inside tasks as Arrow buffers: one byte array and one offset
array for a slice of rows, so that numpy works on whole slices and no row is handled
on its own.  Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where neither the context nor spark.checkpoint.dir names one, a local session gets a
    folder of its own and a cluster an error, since its machines share no temporary folder.
    """
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="sievework-")
    context.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage: df is computed now, into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Like cut(), as a Parquet table: smaller, and its columns can be read one by one.

    The shuffle files that it took go as soon as it is written.
    """
    spark = df.sparkSession
    path, before = new_path(spark), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, or a longer one, that none of df's columns has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the rows one after another, and len(column) + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, values = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Gives freed memory back to the system, so that a worker doesn't hold it while it waits."""
    pa.default_memory_pool().release_unused()
    if libc := getattr(ctypes.CDLL(None), "malloc_trim", None):
        libc(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end
    trim()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; no word crosses rows."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GOLDEN = 0x9E3779B97F4A7C15
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))
BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1), modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        _powers = np.full(max(n, 4096), BASE, np.uint64)
        _powers[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
    return _powers[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes; spans are in order, not empty, and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    local = np.arange(int(lengths.sum()), dtype=np.int32) - np.repeat(firsts.astype(np.int32), lengths)
    values = BYTE_CODE[data[local + np.repeat(starts.astype(np.int32), lengths)]]
    values *= powers(int(lengths.max()))[local]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of data[i : i + length] for each i, by doubling."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    block, size = BYTE_CODE[data], 1
    out, have, left = None, 0, length
    while True:
        if left & 1:
            out, have = (block, size) if out is None else (out[: len(data) - have - size + 1] * np.uint64(pow(BASE, size, 1 << 64)) + block[have : have + len(data) - have - size + 1], have + size)
        left >>= 1
        if not left:
            return mix(out[:n])
        block = block[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + block[size:]
        size *= 2


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)
