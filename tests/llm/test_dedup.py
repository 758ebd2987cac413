"""Exact dedup, the Jaccard join and substring dedup against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tesserine.llm.exact_dedup import drop_copies, exact_dedup
from tesserine.llm.fingerprints import fingerprint_pairs
from tesserine.llm.jaccard_join import Regions, Threshold, _short_lists, jaccard_components, one_of_each
from tesserine.llm.substring_dedup import remove_repeats, repeated_runs

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def corpus(seed=0, n=120):
    """Copies, near copies, shared passages and odd texts, from few words so that much repeats."""
    r = random.Random(seed)
    word = lambda: r.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(r.randrange(30))
    text = lambda k: " ".join(word() for _ in range(k))
    line, base = text(25), text(80).split()
    out = [(0, None), (1, ""), (2, "   "), (3, "one"), (4, "One"), (5, "a b c"), (6, "É b c d"), (7, "é b c d")]
    for i in range(8, n):
        kind = i % 6
        if kind == 0:
            words = list(base)
            for _ in range(r.randrange(3)):
                words[r.randrange(len(words))] = word()
            out.append((i, " ".join(words)))
        elif kind == 1:
            out.append((i, line + "\n" + text(r.randrange(5, 60))))
        elif kind == 2 and len(out) > 20:
            out.append((i, r.choice(out[8:])[1].upper()))
        elif kind == 3:
            t = text(22)
            out.append((i, t + " " + t + "\t" + text(3)))
        else:
            out.append((i, text(r.randrange(1, 90))))
    out.append((n, " ".join(text(5) for _ in range(2000))))
    r.shuffle(out)
    return out


def shingle_set(t, k):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, num, den):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(x), find(i)) for i, x in sets}


def test_exact_dedup(docs):
    rows = corpus()
    got = {r.doc_id: r for r in exact_dedup(docs(rows), keep="max").collect()}
    norm = {i: (t or "").translate(FOLD) for i, t in rows}
    for i, t in norm.items():
        same = [j for j, x in norm.items() if x == t]
        assert got[i].keep_id == max(same) and got[i].group_size == len(same)
        assert got[i].kept == (i == max(same)) and got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert {r.keep_id for r in exact_dedup(docs(rows)).collect() if r.kept} == {min(j for j, x in norm.items() if x == t) for t in norm.values()}


def test_exact_dedup_with_colliding_hashes(docs):
    rows = corpus(1)
    weak = lambda c: F.pmod(F.length(c), F.lit(3))
    a = sorted(map(tuple, exact_dedup(docs(rows), hash_of=weak).collect()))
    assert a == sorted(map(tuple, exact_dedup(docs(rows)).collect()))


def test_exact_dedup_edges(docs):
    assert exact_dedup(docs([])).count() == 0
    got = exact_dedup(docs([(None, "a"), (1, "A"), (1, "a"), (None, None)]), keep="max").collect()
    assert sorted((r.doc_id is None, r.keep_id or 0, r.group_size) for r in got) == [(False, 1, 3), (False, 1, 3), (True, 0, 1), (True, 1, 3)]
    assert drop_copies(docs([(1, "a"), (1, "a"), (2, "A"), (3, None)])).count() == 2
    # an id that names a kept and a dropped row, null ids, texts that differ in case
    rows = docs([(1, "a"), (1, "b"), (2, "a"), (None, "c"), (None, "C"), (4, "d"), (4, "D"), (4, None)])
    kept = drop_copies(rows)
    assert kept.columns == rows.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "b"), ("2", "a"), ("4", "D"), ("4", "None"), ("None", "C")]


@pytest.mark.parametrize("least", [16, 3])
@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (2, 80, 100)])
def test_jaccard_join(docs, least, k, num, den):
    """With a low `least` the regions of the crowded documents do most of the work."""
    rows = [(i, t) for i, t in corpus(2) if len(t or "") < 5000]
    plan = Regions(leaf=4, pivots=4, part=8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(rows), words=k, threshold=Threshold(num, den), least=least, plan=plan).collect()}
    assert got == brute_components(rows, k, num, den)


def chains(seed, groups=6, size=25):
    """Texts that drift word by word, so that likes of likes are not alike; some share a passage only."""
    r = random.Random(seed)
    rows, passage = [], [f"p{k}" for k in range(30)]
    for g in range(groups):
        words = [f"g{g}_{k}" for k in range(60)]
        for k in range(size):
            rows.append((len(rows), " ".join(words)))
            for _ in range(r.randrange(3)):
                words[r.randrange(60)] = f"x{r.randrange(50)}"
    for k in range(groups * 5):
        rows.append((len(rows), " ".join(passage + [f"y{r.randrange(9)}" for _ in range(k % 7)])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("plan", [Regions(leaf=8, pivots=6, part=16), Regions(leaf=3, pivots=2, part=5, levels=1), Regions(leaf=16, pivots=64, part=10, levels=4), Regions(weight=300)])
def test_jaccard_join_of_chains(docs, plan):
    """Pivots, regions, windows, far points and pairs of blocks, with regions of few points."""
    rows = chains(plan.leaf)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_components(docs(rows), words=2, threshold=Threshold(85, 100), least=3, plan=plan).collect()}
    assert got == brute_components(rows, 2, 85, 100)


def test_jaccard_join_of_one_large_cluster(docs):
    """Near copies of one text, with documents between the cluster and others that link with neither."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(i % 4):
            words[r.randrange(60)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base[: 40 + i] + [f"y{i}_{k}" for k in range(10)])) for i in range(12)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_components(docs(rows), words=2, threshold=Threshold(85, 100), least=4, plan=Regions(leaf=16, pivots=8, part=16)).collect()}
    assert got == brute_components(rows, 2, 85, 100)


def test_posting_lists_long_and_short():
    """Runs that span batches: short lists give pairs, long ones their points, whatever the batches."""
    import pandas as pd

    r = random.Random(3)
    rows = sorted((s, r.randrange(90, 110), x) for s, m in enumerate((1, 2, 5, 9, 40, 3, 8, 200, 2)) for x in range(m))
    want = {("long", s, x) for s, m in enumerate((1, 2, 5, 9, 40, 3, 8, 200, 2)) if m >= 8 for x in range(m)}
    by = {}
    for s, n, x in rows:
        by.setdefault(s, []).append((n, x))
    for list_ in by.values():
        if len(list_) < 8:
            want |= {("pair", *sorted((x, y))) for n, x in list_ for m, y in list_ if x < y and 100 * min(n, m) >= 85 * max(n, m)}
    for step in (1, 3, 17, 1000):
        frames = [pd.DataFrame(rows[i : i + step], columns=["s", "n", "x"]) for i in range(0, len(rows), step)]
        got = set()
        for out in _short_lists(8, Threshold(85, 100), hold=20)(iter(frames)):
            for a, b, s in out.itertuples(index=False):
                got.add(("long", s, a) if pd.isna(b) else ("pair", a, b))
        assert got == want


def test_jaccard_join_edges(docs):
    assert jaccard_components(docs([])).count() == 0
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_components(docs([(None, "a b"), (3, "A  b"), (2, "a b"), (4, None)])).collect())
    assert got == [(False, 2, 1, 2), (False, 3, 1, 2), (False, 4, 0, 4), (True, 0, 1, None)]
    rows = docs([(1, "a b c"), (2, "a b c"), (3, "d e f"), (None, "a b c")])
    kept = one_of_each(rows)
    assert kept.columns == rows.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]


def brute_repeats(rows, window):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        w = (t or "").encode().split()
        covered = [False] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            if x in seen:
                covered[k : k + window] = [True] * window
            seen.add(x)
        out[i] = (len(w), sum(covered), b" ".join(x for x, c in zip(w, covered, strict=True) if not c).decode())
    return out


@pytest.mark.parametrize(("flush", "bits"), [(1 << 22, 28), (100, 12)])
def test_substring_dedup(docs, flush, bits):
    """Small chunks and a crowded bitmap give the same result."""
    rows = corpus(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs(rows), flush=flush, log2_bits=bits).collect()}
    assert got == brute_repeats(rows, 20)


def test_substring_dedup_edges(docs):
    assert remove_repeats(docs([])).count() == 0
    t = " ".join(f"w{i}" for i in range(20))
    got = {r.doc_id: r.n_removed for r in remove_repeats(docs([(None, t), (1, t), (2, None), (3, t + " " + t)])).collect()}
    assert got == {None: 0, 1: 20, 2: 0, 3: 40}
    with pytest.raises(ValueError):
        remove_repeats(docs([]), window=18)
    big = 2**53 + 1
    got = sorted((str(r.doc_id), r.n_removed) for r in remove_repeats(docs([(None, "x"), (big, t), (big, t), (big + 1, t)])).collect())
    assert got == [(str(big), 0), (str(big), 0), (str(big + 1), 20), ("None", 0)]


def test_substring_repeats_are_maximal(docs):
    """A passage in the middle of others is one repeat, with the place that it comes from."""
    w = [f"w{i}" for i in range(50)]
    rows = [(5, " ".join(["a"] * 3 + w)), (7, " ".join(["b"] * 4 + w[10:45] + ["c"])), (9, " ".join(w[:5] + ["d"] + w[20:41]))]
    got = {r.doc_id: (r.starts, r.ends, [x.asDict() for x in r.repeats]) for r in repeated_runs(docs(rows)).collect()}
    assert got[7] == ([4], [39], [{"start": 4, "end": 39, "from_doc": 5, "from_start": 13}])
    assert got[9] == ([6], [27], [{"start": 6, "end": 27, "from_doc": 5, "from_start": 23}])
    assert set(got) == {7, 9}


def test_projections_of_long_documents():
    """Documents of sizes on both sides of a change of bins: alike ones always pass, others seldom do."""
    import numpy as np
    import pandas as pd

    from tesserine.llm.jaccard_join import _bins, _window_filter

    r = np.random.default_rng(2)
    t, keep = Threshold(80, 100), _window_filter(Threshold(80, 100)).func
    place = lambda s: np.minimum(np.bincount((s & np.uint64(_bins(len(s)) - 1)).astype(np.int64), minlength=_bins(len(s))), 255).astype(np.uint8).tobytes()
    like, unlike = [], []
    for n in (5, 300, 2040, 2049, 4090, 9000, 20_000):
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        for m in (0, n // 20, n // 10):
            b = np.unique(np.concatenate([a[m:], r.integers(0, 2**63, m, dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            like.append((place(a), place(b), len(a), len(b), t.linked(shared, len(a) + len(b))))
        if n >= 300:
            unlike.append((place(a), place(np.unique(r.integers(0, 2**63, n, dtype=np.uint64))), n, n))
    columns = lambda rows: [pd.Series([x[k] for x in rows]) for k in range(4)]
    assert all(k for k, row in zip(keep(*columns(like)), like, strict=True) if row[4])
    assert not keep(*columns(unlike)).any()


def thue_morse(n):
    """Two words of n letters that polynomial hashes modulo a power of two can't tell apart."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_fool_polynomial_hashes(docs):
    one, two = thue_morse(1024)
    common = [f"w{k}" for k in range(19)]
    rows = [(1, " ".join([*common, one])), (2, " ".join([*common, two])), (3, one), (4, two)]
    assert [r.n_removed for r in remove_repeats(docs(rows)).collect()] == [0] * 4
    got = {r.doc_id: r for r in jaccard_components(docs(rows), words=4, threshold=Threshold(100, 100)).collect()}
    assert all(got[i].component_id == i for i in got)
    found = {r.doc_id: r.fingerprint for r in fingerprint_pairs(docs(rows)).collect()}
    assert len({found[3], found[4]}) == len({found[1], found[2]}) == 2


def test_shingles_of_a_batch():
    """All texts of an Arrow array at once, whole or sliced, against sets of words: words of any size, any white space."""
    import numpy as np
    import pyarrow as pa

    from tesserine.llm.common import shingles_of_all

    r = random.Random(4)
    words = ["a", "B", "b", "É", "é", "\x00", "a\x00", "1234567", "12345678", "123456789", "x" * 63, "x" * 64, "x" * 65, "y" * 200]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", "\t", "\n", "\x0b", "\r ", "  \x0c"]) for _ in range(n))
    texts = [None, "", " ", "\n \t", *(text(r.choice([0, 1, 2, 3, 5, 20, 200])) for _ in range(150)), "a", ""]
    for k in (1, 2, 4, 30):
        for some, array in ((texts, pa.array(texts)), (texts[3:90], pa.array(texts).slice(3, 87)), ([], pa.array([], pa.string()))):
            flat, ends = shingles_of_all(array, k)
            got, want = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], [shingle_set(t, k) for t in some]
            assert [len(s) for s in got] == [len(s) for s in want]
            assert all((s[1:] > s[:-1]).all() for s in got)
            for _ in range(300 if some else 0):
                a, b = r.randrange(len(some)), r.randrange(len(some))
                assert len(np.intersect1d(got[a], got[b])) == len(want[a] & want[b])


def test_postings_are_dealt_evenly():
    """Prefixes hold the smallest shingles of a text; no part may get most of them."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from tesserine.llm.jaccard_join import _emit_postings, _lists_of_part

    rare = np.random.default_rng(3).integers(0, 2**60, (400, 20))  # the lowest sixteenth of all
    rare[1, 0] = rare[0, 0]
    batch = pa.RecordBatch.from_pydict({"x": pa.array(range(400), pa.int64()), "n": pa.array([100] * 400, pa.int64()), "rare": pa.array(rare.tolist(), pa.list_(pa.int64()))})
    parts = [row for b in _emit_postings(4)(iter([batch.slice(0, 150), batch.slice(150)])) for row in b.to_pylist()]
    size = [len(row["s"]) // 8 for row in parts]
    assert sum(size) == 8000 and len(size) == 16 and max(size) < 1000
    found = pd.concat(_lists_of_part(16, Threshold(85, 100))(pd.DataFrame([row])) for row in parts)
    assert found[["a", "b"]].to_numpy().tolist() == [[0, 1]]


def test_copies_are_hashed_once(docs, monkeypatch):
    """Copies add neither sketches nor counts: what many copies hold is no more frequent for it."""
    from tesserine.llm import jaccard_join

    tables, counts, write = {}, [], jaccard_join.materialize
    frequent = jaccard_join.frequent_shingles
    monkeypatch.setattr(jaccard_join, "materialize", lambda df, name: tables.setdefault(name, []).append(out := write(df, name)) or out)
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda *a, **b: counts.append(got := frequent(*a, **b)) or got)
    monkeypatch.setattr(jaccard_join, "discard", lambda *tables: None)
    some = [t for _, t in corpus(3, 40) if len(t or "") < 5000]
    rows = [(i, some[i % len(some)]) for i in range(20 * len(some))]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.class_size) for x in jaccard_components(docs(rows), words=4, threshold=Threshold(85, 100)).collect()}
    brute = brute_components(list(enumerate(some)), 4, 85, 100)
    sets = [frozenset(shingle_set(t, 4)) for t in some]
    assert {i: x[:2] for i, x in got.items()} == {i: (brute[i % len(some)] if sets[i % len(some)] else (0, i)) for i, _ in rows}
    assert all(got[i][2] == (20 * sets.count(sets[i % len(some)]) if sets[i % len(some)] else 1) for i, _ in rows)
    assert tables["sketch"][0].count() == len({t or "" for t in some})
    assert all(n <= len(set(some)) for n in counts[0][3])
