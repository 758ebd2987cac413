"""Best-fit packing of token sequences by length patterns fitted to the histogram."""

from __future__ import annotations

import base64
import json
import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.llm.common import materialize, trimmed

Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, how many), ...) and the number of sequences like this


@lru_cache(2)
def byte_bpe(ranks: str):
    """The byte-level BPE of a rank file. Its ids are those of the same vocabulary's JSON file in `tokenizers`, at a
    fourth of the time; a test compares them. The JSON file beside the rank file, if there is one, lists added tokens:
    these are the special tokens, which `ids_of` takes whole as `tokenizers` does."""
    import public_tokenizers
    import tiktoken

    path = ranks if "/" in ranks else public_tokenizers.path(ranks)
    with open(path, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    added, beside = [], path.removesuffix(".tiktoken") + ".json"
    if os.path.exists(beside):
        with open(beside, encoding="utf-8") as f:
            added = json.load(f).get("added_tokens") or []
    if any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{beside} has added tokens that are not plain literals")
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={x["content"]: x["id"] for x in added})


def ids_of(bpe, text: str | None) -> list[int]:
    """A text's ids; it is split at the added tokens first, and each of these is one id."""
    return bpe.encode(text or "", allowed_special="all", disallowed_special=())


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all have `limit` ids but the first, which may be shorter."""
    first = n - limit * ((n - 1) // limit)
    return [(0, first)] + [(s, limit) for s in range(first, n, limit)]


def pieces_of(docs: DataFrame, *, limit: int, end_id: int, ranks: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, _task, _nth): the pieces of all documents; _nth counts a task's pieces of a length."""

    def encode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, seen = byte_bpe(ranks), Counter()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array(ids_of(bpe, text) + [end_id], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), limit)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), seen[length]))
                    seen[length] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "_nth"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(
        trimmed(encode), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, _nth long"
    )
    return out.withColumn("_task", F.spark_partition_id())


def enumerate_patterns(lengths: np.ndarray, limit: int, most: int = 3) -> np.ndarray:
    """All multisets of at most `most` (1 to 3) of the lengths that fill a sequence; a row each, padded with 0."""
    there = np.zeros(limit + 1, bool)
    there[lengths] = True
    out = [np.array([[limit, 0, 0]])] if there[limit] else []
    if most >= 2:
        a = lengths[2 * lengths <= limit]
        a = a[there[limit - a]]
        out.append(np.stack([a, limit - a, np.zeros_like(a)], 1))
    if most >= 3:
        for a in lengths[3 * lengths <= limit]:
            b = lengths[(lengths >= a) & (a + 2 * lengths <= limit)]
            b = b[there[limit - a - b]]
            out.append(np.stack([np.full_like(b, a), b, limit - a - b], 1))
    return np.concatenate(out) if out else np.empty((0, 3), int)


def fit_repeats(patterns: np.ndarray, hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats x that bring the patterns' lengths near the histogram, by multiplicative steps.

    A length's error weighs as the length does, as long pieces are the hardest to place afterwards."""
    h = hist.astype(float)
    w = np.arange(len(h)) / (len(h) - 1)
    h[0] = 0
    at = patterns.ravel()

    def lengths(x):
        y = np.bincount(at, np.repeat(x, patterns.shape[1]), len(h))
        y[0] = 0
        return y

    fold = lambda y: y[patterns].sum(1)
    target = fold(w * h)
    x = target / max(1.0, target.sum()) * h.sum() / 2
    for _ in range(rounds):
        x *= target / np.maximum(fold(w * lengths(x)), 1e-12)
    return x


def best_fit(left: dict[int, int], limit: int) -> list[Pattern]:
    """Best-fit decreasing over a histogram: equal sequences are kept as one with a count, so the work grows with the
    number of lengths, not of pieces."""
    spaces: list[int] = []
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}

    def add(space: int, has: tuple[tuple[int, int], ...], n: int) -> None:
        if n:
            if space not in open_:
                insort(spaces, space)
            open_.setdefault(space, []).append((has, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo and (k := bisect_left(spaces, length)) < len(spaces):
            space = spaces[k]
            has, n = open_[space].pop()
            if not open_[space]:
                del open_[space]
                spaces.pop(k)
            each = min(space // length, todo)
            bins = min(n, todo // each)
            add(space - each * length, has + ((length, each),), bins)
            add(space, has, n - bins)
            todo -= bins * each
        each = limit // length
        add(limit - each * length, ((length, each),), todo // each)
        if todo % each:
            add(limit - todo % each * length, ((length, todo % each),), 1)
    return [x for group in open_.values() for x in group]


def plan(hist: np.ndarray, limit: int, most: int = 3) -> list[Pattern]:
    """Patterns with numbers of sequences that use each length exactly as often as hist (index: length) says."""
    left = hist.astype(np.int64).copy()
    lengths = np.flatnonzero(left)
    patterns = enumerate_patterns(lengths, limit, most)
    out: list[Pattern] = []
    if len(patterns):
        # full sequences need no fit; rounding with a low-discrepancy threshold keeps the sums over patterns
        x = fit_repeats(patterns, left)
        want = np.floor(x + (np.arange(len(x)) * 0.6180339887498949) % 1).astype(np.int64)
        want[(patterns[:, 1] == 0)] = left[limit]
        # patterns with the longest pieces draw first, then those of most repeats
        order = np.lexsort((-want, -patterns.max(1)))
        for k in order[want[order] > 0]:
            has = Counter(int(v) for v in patterns[k] if v)
            n = int(min(want[k], *(left[v] // q for v, q in has.items())))
            if n:
                for v, q in has.items():
                    left[v] -= n * q
                out.append((tuple(sorted(has.items(), reverse=True)), n))
    return out + best_fit({int(v): int(left[v]) for v in np.flatnonzero(left)}, limit)


def slots(patterns: list[Pattern]) -> pd.DataFrame:
    """(length, lo, hi, base, each, at): pieces of a length numbered lo..hi-1 go to sequences base + (number - lo) // each."""
    used: Counter = Counter()
    rows, base = [], 0
    for has, n in patterns:
        at = 0
        for length, each in has:
            rows.append((length, used[length], used[length] + n * each, base, each, at))
            used[length] += n * each
            at += length * each
        base += n
    return pd.DataFrame(rows, columns=["length", "lo", "hi", "base", "each", "at"]).astype("int64")


def pack(docs: DataFrame, *, limit: int = 1024, end_id: int = 2, ranks: str = "byte_bpe_50k.tiktoken", most: int = 3) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are its text's and end_id; a null text is empty and gives the end_id alone. Only documents of more
    than `limit` ids are cut. Repeated rows are packed each. Columns other than doc_id and text are ignored; an empty
    table gives an empty result.

    Texts are encoded where they lie and only numbers move after that. The driver sees the histogram of lengths, at
    most `limit` numbers: it enumerates the patterns of up to `most` lengths that fill a sequence, fits their repeats by
    non-negative least squares, rounds, and packs the residual lengths best-fit decreasing. A piece finds its place from
    its number among the pieces of its length: its number in its task plus those of earlier tasks. The table of places
    has a few rows a length and pattern, bounded by the limit and not by the data, and is broadcast.
    """
    spark = docs.sparkSession
    pieces = materialize(pieces_of(docs, limit=limit, end_id=end_id, ranks=ranks), "pieces")
    counts = pieces.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))), "lengths")
    hist = np.zeros(limit + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("_n")).collect():
        hist[length] = n
    places = slots(plan(hist, limit, most))
    table = spark.createDataFrame(places, "length long, lo long, hi long, base long, each long, at long") if len(places) else spark.createDataFrame([], "length long, lo long, hi long, base long, each long, at long")
    numbered = pieces.join(counts, ["_task", "length"]).withColumn("_number", F.col("_before") + F.col("_nth"))
    s = F.broadcast(table.withColumnRenamed("length", "_length"))
    hit = (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("lo")) & (F.col("_number") < F.col("hi"))
    nth = F.col("_number") - F.col("lo")
    return numbered.join(s, hit).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + F.floor(nth / F.col("each")).cast("long")).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")).alias("offset"),
    )
