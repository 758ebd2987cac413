"""The conversation trie against a plain trie over dictionaries, and against DuckDB."""

import hashlib
import random
import re
import zlib

import pytest

from tesserine.llm.conversation_trie import RESULT, prefix_trie, sequences, share_heads

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string, pid long"


def conversations(seed, n=150):
    """Few texts, so that much is shared; copies, prefixes of others, odd turns."""
    r = random.Random(seed)
    texts = ["", "a b  c", "hello\tthere", "x y z", "one two three four", "é"]
    out = []
    for c in r.sample(range(-20, 4 * n), n):
        turns = r.randrange(1, 7) if r.random() < 0.9 else 30
        for t in range(turns):
            role = r.choice(["user", "assistant", None]) if r.random() < 0.1 else ("user", "assistant")[t % 2]
            text = texts[0] if r.random() < 0.5 else r.choice([*texts, None])
            out.append((c, None if t == 0 and r.random() < 0.2 else t, role, text))
    for c in range(5 * n, 5 * n + 60):  # one long run of copies
        out += [(c, 0, "user", "same"), (c, 1, "assistant", "same again")]
    r.shuffle(out)
    return out


def brute(rows, heads=True):
    own = {}
    for c, t, role, text in sorted(rows, key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        base = own.get(c - int(f"{c}"[-2:]) % 20 if c >= 0 else c + (-c) % 20, [])
        full[c] = base[:h] + turns[h:]
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        sub = [p for p in nodes if p[: len(path)] == path]
        kids = sum(len(p) == len(path) + 1 for p in sub)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in sub) for p in sub)
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in sub if p)
        ends = ",".join(map(str, sorted(c for c in members if len(full[c]) == len(path))))
        up = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), up, len(members), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "per", "group"), [(0, 10**6, 256), (1, 40, 256), (2, 12, 3), (3, 3, 2)])
def test_against_brute_force(spark, seed, per, group):
    rows = conversations(seed, 60)
    frame = spark.createDataFrame([(*x, 5, "k", 9) for x in rows], SCHEMA).repartition(5)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    got = prefix_trie(share_heads(sequences(frame)), turns_per_task=per, group=group)
    assert got.columns == list(RESULT)
    found = sorted((tuple(r) for r in got.collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", was)
    assert found == brute(rows)


def test_without_shared_heads_and_edges(spark):
    rows = [(1, None, None, None), (None, 0, "user", "lost"), (2, 0, "user", "w " * 20000), (2, 1, "", ""), (3, 0, "user", "w " * 20000)]
    frame = spark.createDataFrame([(*x, 1, "k", 1) for x in rows], SCHEMA)
    assert sorted((tuple(r) for r in prefix_trie(sequences(frame)).collect()), key=str) == brute(rows[:1] + rows[2:], heads=False)
    assert prefix_trie(sequences(frame.where("conv_id > 9"))).count() == 0
    one = prefix_trie(share_heads(sequences(frame.where("conv_id = 3")))).collect()  # base absent: its own first turns are gone
    h = zlib.crc32(b"3") % 4
    assert [r.depth for r in one] == ([0] if h else [1, 0])
    twice = prefix_trie(sequences(frame.where("conv_id = 1").union(frame.where("conv_id = 1")))).collect()
    assert sorted(r.depth for r in twice) == [0, 1, 2]
