"""Helpers shared by the training-data operators: shared folders, Arrow text buffers, bounded sub-batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seed of every hash and permutation in this subpackage.
SEED = 20240611
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset and driver and executors are one process (local mode, as in tests) a temporary folder is
    set; on a cluster that is an error, as executors would write where nobody else can read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        folder = spark.sparkContext.getCheckpointDir() or ""
        if not folder:
            if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):  # local-cluster has executors of its own
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="docketflow-")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docketflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*tables: DataFrame, shuffles: bool = True) -> None:
    """Delete written tables that nothing reads any more and, after large ones, let Spark drop shuffle files nothing refers to."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables and shuffles:
        unshuffled(tables[0].sparkSession)


def unshuffled(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def buffers(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and int64 offsets of its values; null counts as the empty string."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64) if len(arr) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[off[0] : off[-1]]
    return raw, off - off[0]


def sub_batches(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about `limit` bytes of a text column, one row at least: bounds a task's memory."""
    if not batch.num_rows:
        return
    _, off = buffers(batch.column(batch.schema.get_field_index(column)))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Hand the memory that this process no longer uses to the system. Spark keeps a Python worker between tasks, and what an
    idle one holds counts beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives memory back after each batch it was handed and at the end of its task."""

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b
            del b
            give_back()

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(handed(batches))
        give_back()

    return tidied


def codepoints(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of concatenated UTF-8 values, and their offsets counted in code points."""
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), lead[off]


def beyond(points: np.ndarray, table: np.ndarray, rule: Callable[[str], int]) -> np.ndarray:
    """table[points], with the rule itself for code points beyond the table."""
    out = table[np.minimum(points, len(table) - 1)]
    far = points >= len(table)
    if far.any():
        rare, where = np.unique(points[far], return_inverse=True)
        out[far] = np.array([rule(chr(c)) for c in rare.tolist()], table.dtype)[where]
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each value, A-Z lower-cased.

    Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, as UTF-8 has no such byte
    inside a longer character. Returns hashes, offsets of each value's words, and the byte
    start and end of each word.
    """
    low = raw
    upper = (raw >= 65) & (raw <= 90)
    if upper.any():
        low = raw + (upper * np.uint8(32)).astype(np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    before = np.empty(len(raw), bool)
    after = np.empty(len(raw), bool)
    if len(raw):
        before[0] = True
        before[1:] = ~inside[:-1]
        after[-1] = True
        after[:-1] = ~inside[1:]
        cuts = off[(off > 0) & (off < len(raw))]
        before[cuts] = True
        after[cuts - 1] = True
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    table = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)) | np.uint64(1)
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 1 << 64)
    n = len(raw)
    with np.errstate(over="ignore"):
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.uint64(base)
        np.multiply.accumulate(power, out=power)
        back = np.ones(n + 1, np.uint64)
        back[1:] = np.uint64(inverse)
        np.multiply.accumulate(back, out=back)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[low] * power[:n], out=total[1:])
        h = mix64((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
    return h, np.searchsorted(start, off), start, end


def shingle_hashes(words: np.ndarray, woff: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each value's width-word shingles, in order and with repeats; a value with
    fewer words has its whole sequence as one shingle, a value without words none. Returns hashes and offsets."""
    count = np.diff(woff)
    shingles = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    off = np.concatenate([[0], np.cumsum(shingles)])
    owner = np.repeat(np.arange(len(count)), shingles)
    first = woff[:-1][owner] + (np.arange(off[-1]) - off[:-1][owner])
    left = np.minimum(count[owner], width)
    h = np.full(off[-1], SEED, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            here = k < left
            at = np.minimum(first + k, max(len(words) - 1, 0))
            h = np.where(here, mix64(h * np.uint64(0x9FB21C651E98DF25) + (words[at] if len(words) else 0)), h)
    return h, off


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the decimal text of an id, modulo parts; null where the id is."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts


def small_enough(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> bool:
    """Whether the counted rows of df, at row_bytes each, stay below what may be broadcast."""
    return df.count() * row_bytes <= limit


def measured_small(df: DataFrame, limit: int = 32 << 20) -> bool:
    """Whether the rows of df, strings by their bytes and other columns at 16, stay below what may be broadcast."""
    size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) + 32 if f.dataType.simpleString() == "string" else F.lit(16) for f in df.schema.fields), F.lit(0))
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that df lacks, one for each of `names`, for helper columns beside those of the caller."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out
