"""Ranked lexical search: the best documents of each query item, by branch and bound over frequent-pattern trees."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.llm.common import discard, materialize, release

#: Bytes that end a term become blanks, A-Z become lower case; bytes from 0x80 on are parts of terms.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
LOWEST = -(2**63)  # stands for a null doc_id


def terms(text: str | None) -> list[bytes]:
    """The terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of a text, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, found, times = [], [], []
        for i, text in enumerate(b.column("text").to_pylist()):
            for t, n in Counter(terms(text)).items():
                at.append(i)
                found.append(t)
                times.append(n)
        ids = b.column("item_id").take(pa.array(at, pa.int32()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary()), pa.array(times, pa.int64())], ["item_id", "term", "times"])


def _vectors(known: dict[bytes, int]):
    """Each document's number of terms and its vector over the known ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids, tfs = [], [], []
            for text in b.column("text"):
                found = terms(text.as_py())
                n.append(len(found))
                own = sorted((known[t], k) for t, k in Counter(found).items() if t in known)
                ids.append([t for t, _ in own])
                tfs.append([k for _, k in own])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, f.type) for x, f in zip((n, ids, tfs), list(_ARROW)[1:], strict=True))], schema=_ARROW)
        release()

    return run


# ---- one tree ----


class Tree:
    """The FP-tree of some documents' vectors, terms in descending document frequency.

    Documents are sorted by their term sequences, so each node is a run of them that shares a path; runs of at most `leaf`
    documents, and of documents with one and the same sequence, are leaves. By node: the documents, the least m in the subtree,
    and for each term that occurs there, on the path or below, the largest tf in the subtree. The latter are kept by term
    (a header table), so that the bounds of all nodes for an item take one pass over its terms' entries.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, at: np.ndarray, rank: np.ndarray, tf: np.ndarray, size: int, leaf: int):
        docs = len(ids)
        doc = np.repeat(np.arange(docs), np.diff(at))
        order = np.lexsort((rank, doc))
        rank, tf = rank[order], tf[order]
        paths = [rank[a:b].astype(">u4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        sort = sorted(range(docs), key=paths.__getitem__)
        lengths = np.diff(at)[sort]
        take = np.repeat(at[:-1][sort] - np.concatenate(([0], np.cumsum(lengths[:-1]))), lengths) + np.arange(lengths.sum()) if docs else np.empty(0, np.int64)
        self.ids, self.m, self.rank, self.tf = ids[sort], m[sort], rank[take], tf[take]
        self.at = np.concatenate(([0], np.cumsum(lengths)))
        self.size = size
        self._split([paths[k] for k in sort], leaf)

    def _split(self, paths: list[bytes], leaf: int) -> None:
        lo, hi, kids = [0], [len(paths)], [[]]
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            a, b = lo[node], hi[node]
            if b - a <= leaf or paths[a] == paths[b - 1]:
                continue
            first, last = (np.frombuffer(p, ">u4") for p in (paths[a], paths[b - 1]))
            n = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:n] != last[depth:n])
            depth = depth + int(differ[0]) if len(differ) else n
            # documents of the run share `depth` terms; they part by the next
            step = np.array([int.from_bytes(p[4 * depth : 4 * depth + 4]) if len(p) > 4 * depth else -1 for p in paths[a:b]])
            cut = np.concatenate(([0], np.flatnonzero(np.diff(step)) + 1, [b - a])) + a
            for x, y in self._packed(cut, leaf):
                kids[node].append(len(lo))
                todo.append((len(lo), depth))
                lo.append(x)
                hi.append(y)
                kids.append([])
        self.lo, self.hi, self.kids = np.array(lo), np.array(hi), kids
        self.least = np.array([self.m[a:b].min() if b > a else 0 for a, b in zip(lo, hi, strict=True)], np.int64)
        largest: list = [None] * len(lo)
        for node in range(len(lo) - 1, -1, -1):  # branches come after the node that they part
            if kids[node]:
                r, t = (np.concatenate(c) for c in zip(*(largest[k] for k in kids[node]), strict=True))
            else:
                x = slice(self.at[lo[node]], self.at[hi[node]])
                r, t = self.rank[x], self.tf[x]
            order = np.argsort(r, kind="stable")
            r, t = r[order], t[order]
            new = np.flatnonzero(np.concatenate((np.ones(min(1, len(r)), bool), r[1:] != r[:-1])))
            largest[node] = (r[new], np.maximum.reduceat(t, new) if len(new) else t)
        rank, most = (np.concatenate(c) for c in zip(*largest, strict=True))
        node = np.repeat(np.arange(len(lo)), [len(r) for r, _ in largest])
        order = np.argsort(rank, kind="stable")
        self.node, self.most = node[order], most[order]
        self.head = np.searchsorted(rank[order], np.arange(self.size + 1))

    @staticmethod
    def _packed(cut: np.ndarray, leaf: int) -> Iterator[tuple[int, int]]:
        """Runs between cuts; small neighbouring branches make one leaf, as long as it stays small."""
        a = int(cut[0])
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            if y - a > leaf and x > a:
                yield a, int(x)
                a = int(x)
        yield a, int(cut[-1])

    def bounds(self, ranks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """By node, a score that no document of its subtree exceeds: every term with its largest tf and the least m."""
        out = np.zeros(len(self.lo), np.int64)
        for r, w in zip(ranks, weights, strict=True):
            x = slice(self.head[r], self.head[r + 1])
            node, tf = self.node[x], self.most[x]
            out[node] += w * (1_000_000_000 * tf // (1000 * tf + 8 * self.least[node]))
        return out

    def search(self, ranks: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: list, k: int) -> None:
        """Depth first, the most promising branch before the others; branches that can't reach the k best so far are cut.
        best is a heap of (score, -doc_id); weight_of has the item's weights by rank, 0 for other terms."""
        bound = self.bounds(ranks, weights)
        todo = [0]
        while todo:
            node = todo.pop()
            if bound[node] <= 0 or (len(best) == k and bound[node] < best[0][0]):
                continue
            if self.kids[node]:
                todo += sorted(self.kids[node], key=bound.__getitem__)
                continue
            a, b = int(self.lo[node]), int(self.hi[node])
            x = slice(self.at[a], self.at[b])
            w = weight_of[self.rank[x]]
            hit = np.flatnonzero(w)
            doc = np.repeat(np.arange(a, b), np.diff(self.at[a : b + 1]))[hit]
            tf = self.tf[x][hit]
            score = np.zeros(b - a, np.int64)
            np.add.at(score, doc - a, w[hit] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[doc])))
            floor = best[0][0] if len(best) == k else 1
            for d in np.flatnonzero(score >= floor):
                found = (int(score[d]), -int(self.ids[a + d]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)


def _search(items: list[tuple[np.ndarray, np.ndarray]], rank_of: np.ndarray, docs: int, total: int, k: int, tree: int, leaf: int):
    """The k best documents of a task for each item; the bar that earlier trees of the task set holds for later ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]
        weight_of = np.zeros(len(rank_of), np.int64)

        def grow(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held, schema=_ARROW).combine_chunks()
            ids, n = (table.column(c).to_numpy() for c in ("doc_id", "n"))
            m = 25 + 75 * n * docs // total
            lists = table.column("terms").combine_chunks()
            at = lists.offsets.to_numpy().astype(np.int64)
            rank = rank_of[lists.values.to_numpy()[at[0] : at[-1]]]
            tfs = table.column("tfs").combine_chunks()
            tf_at = tfs.offsets.to_numpy()
            grown = Tree(ids, m, at - at[0], rank, tfs.values.to_numpy()[tf_at[0] : tf_at[-1]].astype(np.int64), len(rank_of), leaf)
            for own, (ranks, weights) in zip(best, items, strict=True):
                weight_of[ranks] = weights
                grown.search(ranks, weights, weight_of, own, k)
                weight_of[ranks] = 0

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= tree:
                grow(held)
                held, size = [], 0
        if size:
            grow(held)
        rows = [(i, -d, s) for i, own in enumerate(best) for s, d in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND)
        release()

    return run


def top_documents(documents: DataFrame, items: DataFrame, *, k: int = 10, terms_at_once: int = 1 << 18, tree: int = 8192, leaf: int = 32) -> DataFrame:
    """For each item the k documents with the highest scores above 0: item_id, rank (from 1), doc_id, score.

    Terms, weights and scores are integers as in `term_weight` and `term_score`; equal scores go by ascending doc_id, null first.
    A null or empty text has no terms. Every row of documents is a document, repeated ones too. Rows of items
    that share an item_id (null included) are one item with the terms of all of them; an item without hits has no row. doc_id must
    be a whole number; other columns are ignored; an empty table on either side gives an empty result.

    One pass over the documents keeps each one's number of terms and its vector over the items' terms. Their counts give
    weights and the order of terms by document frequency. Then each task builds FP-trees of about `tree` documents from
    the vectors that it reads, without a shuffle, and searches them for every item; it returns its k best. Items go in blocks with
    about `terms_at_once` (item, term) pairs, the bound of what tasks are sent; one item is never parted. Memory in a task is that
    of one tree.
    """
    spark = documents.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(_item_terms, f"item_id {kind}, term binary, times long")
    asked = materialize(asked.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "items")
    blocks = 1 + asked.count() // terms_at_once
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else asked
        found = _block(documents, own, k, tree, leaf).withColumn("item_id", F.col("item_id").cast(kind))
        out = found if out is None else out.unionByName(found)
    discard(asked)
    return out.select("item_id", "rank", F.when(F.col("doc_id") != LOWEST, F.col("doc_id")).cast(documents.schema["doc_id"].dataType).alias("doc_id"), "score")


def term_weight(docs: int, df: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _block(documents: DataFrame, asked: DataFrame, k: int, tree: int, leaf: int) -> DataFrame:
    spark = documents.sparkSession
    pairs = asked.collect()  # bounded by terms_at_once and the largest item
    known = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in pairs}))}
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    vectors = materialize(rows.mapInArrow(_vectors(known), _VECTORS), "vectors")
    docs, total = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    for t, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a known term
        df[t] = n
    rank_of = np.empty(len(known), np.int64)
    rank_of[np.lexsort((np.arange(len(known)), -df))] = np.arange(len(known))
    weight = [term_weight(docs, int(n)) for n in df]
    each: dict = {}
    for r in pairs:
        t = known[bytes(r.term)]
        if df[t]:
            each.setdefault(r.item_id, []).append((rank_of[t], weight[t] * r.times))
    names = sorted(each, key=lambda x: (x is not None, x))
    vectorised = [tuple(np.array(c, np.int64) for c in zip(*sorted(each[x]), strict=True)) for x in names]
    if not names:
        return spark.createDataFrame([], "item_id string, rank int, doc_id long, score long")
    found = vectors.where(F.size("terms") > 0).mapInArrow(_search(vectorised, rank_of, docs, total, k, tree, leaf), "item int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    called = spark.createDataFrame([(i, None if x is None else str(x)) for i, x in enumerate(names)], "item int, item_id string")
    return ranked.join(F.broadcast(called), "item").select("item_id", "rank", "doc_id", "score")
