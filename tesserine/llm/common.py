"""Helpers that the corpus operators share: scratch tables, hot-key joins and word hashing."""

from __future__ import annotations

import ctypes
import gc
import itertools
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the session that the operators count on: Arrow batches bounded by rows and bytes, so that very long
    texts don't fill a worker's memory, and shuffle files that go when the action that wrote them ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one serves a local master;
    on a cluster other machines couldn't read it, so that is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tesserine-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here, a lost executor loses nothing."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of `materialize` that nothing will read any more."""
    for df in tables:
        if path := _WRITTEN.pop(df, None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def release() -> None:
    """Give a Python worker's free memory back: idle workers stay beside those of the next stage."""
    for kept in _HASHES:
        kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """run, whose worker releases its memory at the end of a task."""

    def all_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches)
        release()

    return all_of


def unused(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have, in any spelling of its letters."""
    taken = {c.lower() for c in df.columns}
    return next(name for k in itertools.count() if (name := f"_{stem}{k or ''}") not in taken)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


HOT_SHARE = 1000


def join_hot(rows: DataFrame, dim: DataFrame, keys: list[str], weight: str, total: int, *, how: str = "inner", salts: int = 64) -> DataFrame:
    """Join rows to dim, which has one row a key and the number of the key's rows in column weight.

    A key with more than one row in HOT_SHARE of all rows is hot. There are fewer than HOT_SHARE hot keys, whatever
    the input, so the list of them is broadcast; their rows are dealt over `salts` parts, and only their dim rows are
    repeated.
    """
    least = max(1, total // HOT_SHARE)
    hashed = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]  # maps can't be hashed
    hot = dim.where(F.col(weight) > least).select(*keys, F.lit(True).alias("_hot"))
    dealt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", dealt).drop("_hot")
    each = F.when(F.col(weight) > least, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.withColumn("_salt", F.explode(each))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


# ---- hashing of words and of their windows ----

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 2**64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n-1 of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        m = 1 << max(14, (n - 1).bit_length())
        for k, r in enumerate((_R, _R_INV)):
            x = np.full(m, r, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all 64 bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    p, q = _powers(len(values) + 1)
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:-1], out=c[1:])
    return mix((c[end] - c[start]) * q[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Hashes(dict):
    """64-bit seeded hashes of words; those of short words are kept, as most words of a text come again."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word, self.seed)
        if len(word) <= 32:
            if len(self) >= 1 << 17:
                self.clear()
            self[word] = h
        return h


_HASHES = (_Hashes(0x243F6A8885A308D3), _Hashes(0x13198A2E03707344))


def word_hashes(data: bytes, which: int = 0) -> np.ndarray:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of a UTF-8 text; two independent ones (which = 0, 1) make 128 bits."""
    words = data.split()
    return np.fromiter(map(_HASHES[which].__getitem__, words), np.uint64, len(words))


_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_CHUNKS = 8  # longer words are hashed one by one


def _word_hashes_at(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0x452821E638D01377) -> np.ndarray:
    """64-bit hashes of the words at start in data, which goes on for eight bytes after the last: chunks of eight bytes
    are mixed in one by one, so of two words of one size and one chunk no two share a hash."""
    chunk = np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))
    h = mix(mix(size.astype(np.uint64) * _R + np.uint64(seed)) ^ (chunk[start] & _FIRST_BYTES[np.minimum(size, 8)]))
    at = np.flatnonzero(size > 8)
    for k in range(1, _CHUNKS):
        at = at[size[at] > 8 * k]
        if not len(at):
            break
        x = chunk[start[at] + 8 * k] & _FIRST_BYTES[np.minimum(size[at] - 8 * k, 8)]
        h[at] = mix(h[at] ^ x)
    for i in np.flatnonzero(size > 8 * _CHUNKS):
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), seed)
    return h


def shingles_of_all(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, ends): of each text, A-Z lower-cased, the sorted distinct k-word shingles one after the other, as
    `shingles` has them but by hashes of their own; those of text i stand between ends[i] and ends[i + 1]."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n, (_, edge, data) = len(texts), texts.buffers()
    edge = np.frombuffer(edge, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    low = np.zeros(int(edge[-1] - edge[0]) + 8, np.uint8)
    if len(low) > 8:
        low[:-8] = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]]
        low[:-8] += ((low[:-8] - np.uint8(ord("A"))) < 26).view(np.uint8) << np.uint8(5)
    edge = edge - edge[0]
    space = (low[:-8] == 0x20) | ((low[:-8] - np.uint8(0x09)) < 5)
    first = np.ones(len(space) + 1, bool)  # whether a word may start here, or has ended before
    first[1:-1] = space[:-1]
    first[edge] = True
    start = np.flatnonzero(first[:-1] & ~space)
    first[:-1] |= space
    size = np.flatnonzero(first[1:] & ~space) + 1 - start
    words, m = _word_hashes_at(low, start, size), np.searchsorted(start, edge)
    # a window starts at each word that k - 1 others of its text follow; in a shorter text one at the first
    held, begin = np.diff(m), m[:-1]
    out, full = np.zeros(len(words), np.uint64), np.ones(len(words), bool)

    def spans(at: np.ndarray | slice, count: int, j: int) -> np.ndarray:
        p, total = _powers(max(j, 2))[0], np.zeros(count, np.uint64)
        for i in range(j):
            total += (words[i : i + count] if isinstance(at, slice) else words[at + i]) * p[i]
        return mix(total + np.uint64(j * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))

    if len(words) >= k:
        out[: len(words) - k + 1] = spans(slice(None), len(words) - k + 1, k)
    for j in range(1, k):
        full[m[1:][held >= j] - j] = False
    for j in np.unique(held[(held > 0) & (held < k)]):
        at = begin[held == j]
        out[at], full[at] = spans(at, len(at), int(j)), True
    out, ends = out[full], np.concatenate(([0], np.cumsum(full)))[m]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[ends[:-1][np.diff(ends) > 0]] = True
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[ends]


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k consecutive words; none if there are fewer."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    i = np.arange(n)
    return _spans_hash(words, i, i + k)


def shingles(data: bytes, k: int) -> np.ndarray:
    """The sorted distinct k-word shingles of a text; with fewer words, the whole sequence as one."""
    w = word_hashes(data)
    if not len(w):
        return w
    return np.unique(windows(w, min(k, len(w))))
