"""Removal of repeated passages: fixed blocks as anchors, rolling probes, and extension to whole windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import mix, trimmed, windows, word_hashes

LOWEST = -(2**63)  # stands for a null doc_id
#: Windows of a chunk, column by column and by place in the chunk: places then compress to next to nothing.
_SPOTS = (("w", "<u8"), ("v", "<u8"), ("d", "<i8"), ("p", "<u4"))
#: Covered windows and the earlier window with the same words.
_COVERED = (("d", "<i8"), ("p", "<u4"), ("d0", "<i8"), ("p0", "<u4"))


def _bytes(t: str | None) -> bytes:
    return (t or "").encode("utf-8", "surrogatepass")


def _chunks(batches: Iterable[pd.DataFrame], window: int, flush: int) -> Iterator[list[tuple[int, np.ndarray, bytes]]]:
    """The documents of at least a window of words as (doc_id, word hashes, text), in chunks of about `flush` words."""
    held, size = [], 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            data = _bytes(text)
            words = word_hashes(data)
            if len(words) >= window:
                held.append((doc_id, words, data))
                size += len(words)
                if size >= flush:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _cut(part: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    edge = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edge)):
        yield int(p), int(edge[p]), int(edge[p + 1])


def _emit_blocks(block: int, window: int, bits: int, flush: int):
    """By part, the classes of a chunk's rolling windows: seen once or more, and whether one of them is an anchor."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for docs in _chunks(batches, window, flush):
            rolling = [windows(words, block) for _, words, _ in docs]
            anchor = np.concatenate([np.arange(len(h)) % block == 0 for h in rolling])
            cls, at, n = np.unique(np.concatenate(rolling) >> np.uint64(40 - bits), return_inverse=True, return_counts=True)
            anchored = np.bincount(at, anchor, len(cls)) > 0
            low = np.ascontiguousarray((cls & np.uint64(0xFFFFFF)).astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :3]
            kind = (n > 1) * 2 + anchored
            rows = []
            for p, a, b in _cut((cls >> np.uint64(24)).astype(np.int64), 1 << bits):
                rows.append((p, *(low[a:b][kind[a:b] == k].tobytes() for k in range(4))))
            yield pd.DataFrame(rows, columns=["part", "once", "once_anchor", "more", "more_anchor"])

    return trimmed(run)


def _hits(bits: int, log2_bits: int):
    """The part's slice of a bitmap over classes: those seen twice or more, one of them an anchor."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        low, n, anchored = [], [], []
        for name, count, is_anchor in (("once", 1, 0), ("once_anchor", 1, 1), ("more", 2, 0), ("more_anchor", 2, 1)):
            b = np.frombuffer(b"".join(pdf[name]), np.uint8).reshape(-1, 3).astype(np.int64)
            low.append(b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16))
            n.append(np.full(len(b), count))
            anchored.append(np.full(len(b), is_anchor))
        # counting by the class's own number: a part has 2**24 classes
        cls = np.concatenate(low)
        order = np.argsort(cls, kind="stable")
        cls, n, anchored = cls[order], np.concatenate(n)[order], np.concatenate(anchored)[order]
        first = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
        hit = cls[first][(np.add.reduceat(n, first) > 1) & (np.add.reduceat(anchored, first) > 0)]
        width = log2_bits - bits
        slice_ = np.zeros(1 << width, bool)
        slice_[_place(hit.astype(np.uint64), width)] = True
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "slice": [np.packbits(slice_, bitorder="little").tobytes()]})

    return run


def _place(low: np.ndarray, width: int) -> np.ndarray:
    return (mix(low) & np.uint64((1 << width) - 1)).astype(np.int64)


def _packed(columns, kinds) -> tuple[bytes, ...]:
    return tuple(np.ascontiguousarray(c.astype(kind)).tobytes() for c, (_, kind) in zip(columns, kinds, strict=True))


def _unpacked(pdf: pd.DataFrame, kinds) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(pdf[name]), kind) for name, kind in kinds]


def _emit_windows(hits: Broadcast, block: int, window: int, bits: int, flush: int):
    """Windows around anchor hits: the earliest of each chunk go to their part, later ones are covered already."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        log2_bits, bitmap = hits.value
        width = log2_bits - bits
        reach = window - block  # an anchor starts at most so far into a window
        for docs in _chunks(batches, window, flush):
            spots = []
            for doc_id, words, data in docs:
                cls = windows(words, block) >> np.uint64(40 - bits)
                at = ((cls >> np.uint64(24)).astype(np.int64) << width) | _place(cls & np.uint64(0xFFFFFF), width)
                hit = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                if not hit.any():
                    continue
                seen = np.concatenate(([0], np.cumsum(hit)))
                start = np.arange(len(words) - window + 1)
                # an anchor lies at one of the first `block` places of each window that holds its whole block
                near = start[seen[start + min(reach, block - 1) + 1] > seen[start]]
                if len(near):
                    # two independent hashes of each word: equal windows are told by 128 bits
                    spots.append((windows(words, window)[near], windows(word_hashes(data, 1), window)[near], np.full(len(near), doc_id, np.int64), near))
            if not spots:
                continue
            w, v, d, p = (np.concatenate(c) for c in zip(*spots, strict=True))
            order = np.lexsort((p, d, v, w))
            new = np.concatenate(([True], (w[order[1:]] != w[order[:-1]]) | (v[order[1:]] != v[order[:-1]])))
            first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # by place in order: the earliest with the same words
            chunk = min((d for d, _, _ in docs if d != LOWEST), default=int(mix(w[:1]).view(np.int64)[0]))
            part = (w >> np.uint64(64 - bits)).astype(np.int64)
            sent = order[new]
            sent = sent[np.lexsort((sent, part[sent]))]
            rows = [(k, chunk, *_packed((w[sent[a:b]], v[sent[a:b]], d[sent[a:b]], p[sent[a:b]]), _SPOTS), b"", b"") for k, a, b in _cut(part[sent], 1 << bits)]
            later = _later(d, p, order, first)
            if later.any():
                back = np.argsort(order[later])
                own, at = order[later][back], first[later][back]
                home = -1 - int(mix(np.array([chunk]).astype(np.uint64))[0] % np.uint64(1 << bits))
                d1, p1, d0, p0 = _packed((d[own], p[own], d[at], p[at]), _COVERED)
                rows.append((home, chunk, b"", b"", d1, p1, d0, p0))
            yield pd.DataFrame(rows, columns=["part", "chunk", "w", "v", "d", "p", "d0", "p0"])

    return trimmed(run)


def _later(d: np.ndarray, p: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """By place in order, whether a window starts later than the first with its words; a repeated row's don't."""
    return (d[order] != d[first]) | (p[order] != p[first])


def _resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of the windows with one word sequence all but the earliest are covered."""
    if int(pdf["part"].iloc[0]) < 0:  # decided in their chunk
        return pdf[["chunk", "d", "p", "d0", "p0"]]
    w, v, d, p = _unpacked(pdf, _SPOTS)
    chunk = np.repeat(pdf["chunk"].to_numpy(np.int64), [len(x) // 8 for x in pdf["w"]])
    order = np.lexsort((p, d, v, w))
    new = np.concatenate(([True], (w[order[1:]] != w[order[:-1]]) | (v[order[1:]] != v[order[:-1]])))
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    hit = _later(d, p, order, first)
    later, at = order[hit], first[hit]
    back = np.lexsort((p[later], d[later], chunk[later]))
    later, at = later[back], at[back]
    ids, begin = np.unique(chunk[later], return_index=True)
    ends = np.append(begin[1:], len(later))[: len(ids)]
    rows = [(c, *_packed((d[later[a:b]], p[later[a:b]], d[at[a:b]], p[at[a:b]]), _COVERED)) for c, a, b in zip(ids, begin, ends, strict=True)]
    return pd.DataFrame(rows, columns=["chunk", "d", "p", "d0", "p0"]).astype({"chunk": "int64"})


def _runs(window: int):
    """Hits extended: windows next to each other whose earlier windows are so too make one maximal exact repeat. The
    covered words of each document of a chunk are the union of its repeats, as maximal runs [start, end)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d, p, d0, p0 = _unpacked(pdf, _COVERED)
        order = np.lexsort((p, d))
        d, p, d0, p0 = d[order], p[order].astype(np.int64), d0[order], p0[order].astype(np.int64)
        apart = lambda *tests: np.flatnonzero(np.concatenate(([True], np.logical_or.reduce(tests))))
        whole = apart(d[1:] != d[:-1], p[1:] > p[:-1] + window)
        alike = apart(d[1:] != d[:-1], p[1:] != p[:-1] + 1, d0[1:] != d0[:-1], p0[1:] != p0[:-1] + 1)
        spans = lambda first: (p[first], p[np.append(first[1:], len(d)) - 1] + window)
        (starts, ends), (a, b) = spans(whole), spans(alike)
        ids, at = np.unique(d[whole], return_index=True)
        of = np.searchsorted(d[alike], ids)
        cuts, cuts_of = np.append(at, len(whole)), np.append(of, len(alike))
        repeats = [
            [{"start": int(a[k]), "end": int(b[k]), "from_doc": int(d0[alike[k]]), "from_start": int(p0[alike[k]])} for k in range(x, y)]
            for x, y in zip(cuts_of[:-1], cuts_of[1:], strict=True)
        ]
        cut = lambda c: [c[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return pd.DataFrame({"doc_id": ids, "starts": cut(starts), "ends": cut(ends), "repeats": repeats})

    return run


def repeated_runs(docs: DataFrame, *, window: int = 20, block: int = 10, flush: int = 1 << 21, log2_bits: int = 28) -> DataFrame:
    """(doc_id, starts, ends, repeats) of the documents with words that a window covers which also starts earlier.

    Earlier means in a document with a smaller doc_id, or earlier in the same one; null ids come first. Windows are
    judged on the input.
    starts and ends are maximal runs of covered words; repeats are the maximal exact repeats that they come from, each
    with the document and place of an earlier one: start, end, from_doc, from_start. doc_id should be a whole number and
    unique: rows that share one, or have none, are taken as one document, and repeated rows cover nothing of each other.

    Every window of `window` words holds a whole aligned block of `block` of them (window >= 2 * block - 1). The blocks
    of all documents are the index; all rolling windows of `block` words probe it, packed by hash part, so a third of
    the text's size moves. Blocks that occur elsewhere are marked in a bitmap of at most 2**log2_bits bits, whatever the
    input; a false mark costs work and changes nothing, and where the bitmap fills up, all windows move, about three times the text.
    Hits extend to the windows around them. Windows are the same where two hashes of 64 bits agree. Of windows with one word
    sequence a chunk of `flush` words sends its earliest, so a passage of any frequency sends one row a chunk. Covered
    windows side by side then extend to maximal repeats.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold an aligned block: window >= 2 * block - 1")
    spark = docs.sparkSession
    total = docs.count()
    # a part holds the windows of about a thousand documents, and at most 2**24 classes
    bits = min(20, max(6, (total // 1024).bit_length()))
    log2_bits = max(bits + 3, min(log2_bits, max(24, total.bit_length() + 12)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = rows.mapInPandas(_emit_blocks(block, window, bits, flush), "part int, once binary, once_anchor binary, more binary, more_anchor binary")
    bitmap = np.zeros(1 << (log2_bits - 3), np.uint8)
    width = 1 << (log2_bits - bits - 3)
    for part, slice_ in blocks.groupBy("part").applyInPandas(_hits(bits, log2_bits), "part int, slice binary").collect():
        bitmap[part * width : (part + 1) * width] = np.frombuffer(slice_, np.uint8)
    hits = spark.sparkContext.broadcast((log2_bits, bitmap))
    spots = rows.mapInPandas(_emit_windows(hits, block, window, bits, flush), "part int, chunk long, w binary, v binary, d binary, p binary, d0 binary, p0 binary")
    covered = spots.groupBy("part").applyInPandas(_resolve, "chunk long, d binary, p binary, d0 binary, p0 binary")
    repeats = "array<struct<start:long,end:long,from_doc:long,from_start:long>>"
    runs = covered.groupBy("chunk").applyInPandas(_runs(window), f"doc_id long, starts array<long>, ends array<long>, repeats {repeats}")
    # one row a document, also where rows in several chunks share an id
    return runs.groupBy("doc_id").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "repeats")])


def _keep(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text, starts, ends in zip(pdf["text"], pdf["starts"], pdf["ends"], strict=True):
            words = _bytes(text).split()
            kept = words
            if starts is not None:
                mask = np.ones(len(words), bool)
                for a, b in zip(starts, ends, strict=True):
                    mask[a:b] = False
                kept = [words[k] for k in np.flatnonzero(mask)]
            out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
        yield pd.concat([pdf[["_key", "_null"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])], axis=1)


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    Words are runs of characters other than ASCII white space, unchanged. A null or empty text has none. Columns other
    than doc_id and text are ignored; an empty table gives an empty result. See repeated_runs.
    """
    found = repeated_runs(docs, **options).select(F.col("doc_id").alias("_key"), "starts", "ends")
    # ids go to Python without nulls, which would turn them into floats
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    rows = docs.select(key.alias("_key"), F.col("doc_id").isNull().alias("_null"), F.col("text").cast("string").alias("text"))
    joined = rows.join(found, "_key", "left").select("_key", "_null", "text", "starts", "ends")
    out = joined.mapInPandas(trimmed(_keep), "_key long, _null boolean, n_words long, n_removed long, kept string")
    id_ = F.when(~F.col("_null"), F.col("_key")).cast(docs.schema["doc_id"].dataType)
    return out.select(id_.alias("doc_id"), "n_words", "n_removed", "kept")
