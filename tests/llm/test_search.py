"""Lexical search against plain scoring, and against DuckDB."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tesserine.llm.lexical_search import Tree, top_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, term string, n int, rank int", "item_id long, text string, score string"


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "日本", "x y", " "]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    out = [None, "", " .,;", "W1 w1, w1_w1-w1@w1"]
    for i in range(n):
        kind = i % 5
        if kind == 0 and i > 10:
            out.append(r.choice(out[4:]))
        elif kind == 1:
            out.append("common words w0 w1 w2 " + r.choice(["", "w3"]))
        else:
            out.append(r.choice(" ,.\n").join(r.choices(vocabulary, weight, k=r.randrange(1, 40))))
    return [*out, "w5 " * 50_000]


def brute(docs, items, k=10):
    each = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in each), sum(c.total() for _, c in each)
    df = Counter(t for _, c in each for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(TERM.findall((t or "").translate(FOLD)))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in each:
            m = 25 + 75 * c.total() * n_docs // total if total else 0
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, n in q.items() if c[t])
            if s > 0:
                scores.append((-s, d is not None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "tree", "leaf", "at_once"), [(0, 8192, 32, 1 << 18), (1, 40, 4, 1 << 18), (2, 64, 1, 20)])
def test_against_plain_scores(spark, seed, tree, leaf, at_once):
    docs = [(i * 3 % 997 if i != 5 else None, t) for i, t in enumerate(texts(seed, 300))]
    docs += docs[20:23]
    items = [(i, t) for i, t in enumerate(texts(seed + 50, 12))] + [(None, "w1 w2"), (3, "w9 w9")]
    frame = spark.createDataFrame([(*x, "t", 1, 2) for x in docs], DOCS).repartition(3)
    found = top_documents(frame, spark.createDataFrame([(*x, "s") for x in items], ITEMS), tree=tree, leaf=leaf, terms_at_once=at_once)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a", "", 1, 1)], DOCS), spark.createDataFrame([(1, "a", "")], ITEMS)
    assert top_documents(docs.where("doc_id > 1"), items).count() == 0
    assert top_documents(docs, items.where("item_id > 1")).count() == 0
    assert top_documents(docs, items.withColumn("text", items["score"])).count() == 0


def test_bounds_hold_and_cut():
    r = np.random.default_rng(0)
    vectors = [np.sort(r.choice(40, r.integers(0, 9), replace=False, p=np.arange(40, 0, -1) / 820)) for _ in range(2000)]
    at = np.concatenate(([0], np.cumsum([len(v) for v in vectors])))
    tree = Tree(np.arange(2000), r.integers(25, 400, 2000), at, np.concatenate(vectors), r.integers(1, 20, at[-1]), 40, 8)
    ranks, weights = np.array([1, 3, 17, 30, 38]), np.array([10, 500, 2000, 5000, 7000])
    weight_of = np.zeros(40, np.int64)
    weight_of[ranks] = weights
    bound = tree.bounds(ranks, weights)
    w = weight_of[tree.rank]
    each = w * (10**9 * tree.tf // (1000 * tree.tf + 8 * np.repeat(tree.m, np.diff(tree.at))))
    score = np.array([each[a:b].sum() for a, b in zip(tree.at[:-1], tree.at[1:], strict=True)])
    for node, (a, b) in enumerate(zip(tree.lo, tree.hi, strict=True)):
        assert bound[node] >= score[a:b].max()
        assert all(bound[k] <= bound[node] for k in tree.kids[node])
    best = []
    tree.search(ranks, weights, weight_of, best, 10)
    assert sorted(best, reverse=True) == sorted(zip(score.tolist(), (-tree.ids).tolist()), reverse=True)[:10]
    leaves = [n for n in range(len(tree.lo)) if not tree.kids[n]]
    assert sum(bound[n] >= best[0][0] for n in leaves) < len(leaves) / 2  # the rest is never scored
