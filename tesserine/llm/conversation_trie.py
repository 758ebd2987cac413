"""The prefix trie of conversations, grown from the common prefixes of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import discard, join_hot, materialize

WORD = r"[^\x20\x09-\x0D]+"
WIDTH = 16  # bytes of a turn's hash
#: Blocks of one merge. A block hands on two paths, so a merge reads at most twice as many rows.
GROUP = 256
NONE = 2**63 - 1  # least id of no conversation
NODE, OPEN, ENDS = 0, 1, 2
SCHEMA = (
    "kind int, pid long, side int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, parent_key binary, text string, words array<int>, totals array<array<long>>"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_ARROW = pa.schema(
    [("kind", pa.int32()), ("pid", pa.int64()), ("side", pa.int32())]
    + [(c, pa.int64()) for c in RESULT[:-1]]
    + [("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("text", pa.string())]
    + [("words", pa.list_(pa.int32())), ("totals", pa.list_(pa.list_(pa.int64())))]
)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, hashes, words): each conversation's turns in order, as hex hashes of (role, text) and numbers of words.

    Turns go by `turn`, null first; rows of one turn by their hash, so the order of rows in the table says nothing, and a
    repeated row is a further turn. A null role or text is empty. Rows without a conv_id belong to no conversation and are
    left out; other columns are ignored. A conversation's hashes (16 bytes a turn) must fit in a task's memory; its
    texts need not.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    words = F.regexp_count(text, F.lit(WORD))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), digest.alias("hash"), words.alias("words")).alias("t")
    )
    each = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return each.select("conv_id", F.col("t.hash").alias("hashes"), F.col("t.words").alias("words"))


def share_heads(seqs: DataFrame, *, of: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of another: of c the first h = crc32(c) mod `most` are taken from
    conversation c - c % of (all if it has fewer, none if it is absent), then c's own turns after its first h follow."""
    base = seqs.where(F.col("conv_id") % of == 0)
    base = base.select(F.col("conv_id").alias("_base"), *[F.slice(c, 1, most - 1).alias(f"_{c}") for c in ("hashes", "words")])
    rows = seqs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % of).join(base, "_base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")

    def rebuilt(c: str, kind: str):
        head = F.slice(F.coalesce(F.col(f"_{c}"), F.array().cast(f"array<{kind}>")), F.lit(1), h)
        return F.concat(head, F.slice(c, h + 1, F.size(c))).alias(c)

    return rows.select("conv_id", rebuilt("hashes", "string"), rebuilt("words", "int"))


# ---- the forest of one block of sorted conversations ----


class _Branch:
    """A run of neighbours [.., ..] that share one node at `depth`; `bag` holds by depth what is known of the nodes there
    that are not closed: [conversations, least id, children, leaves, tokens saved below, ids that end here, rows of children]."""

    __slots__ = ("depth", "bag", "rep", "stuck")

    def __init__(self, depth: int, bag: dict[int, list], rep: int, stuck: bool):
        self.depth, self.bag, self.rep, self.stuck = depth, bag, rep, stuck


def _digest(key: bytes, depth: int) -> bytes:
    return hashlib.sha256(key[: depth * WIDTH]).digest()[:WIDTH]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their start."""
    n = min(len(a), len(b)) // WIDTH
    x, y = (np.frombuffer(k, np.uint8, n * WIDTH).reshape(n, WIDTH) for k in (a, b))
    differ = (x != y).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


def _ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


class _Forest:
    """Union-find over the edges between neighbours, by descending common prefix: where two runs meet, all their deeper
    nodes are complete and are closed, and the node at that depth is theirs together. The first and the last conversation of a
    block that has neighbours stay open to the root; of the rest only what hangs on these two paths is handed on."""

    def __init__(self, keys: list[bytes], words: list, branches: list[_Branch], named: bool):
        self.keys, self.words, self.branches, self.named = keys, words, branches, named
        self.up = list(range(len(branches)))
        self.rows: list[list] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def close(self, b: _Branch, depth: int) -> None:
        key, words = self.keys[b.rep], self.words[b.rep]
        while b.depth > depth:
            at = b.depth
            n, least, kids, leaves, saved, ends, below = b.bag.pop(at)
            leaves = leaves if kids else 1
            saved += (n - 1) * int(words[at - 1]) if at else 0
            for k in below:
                self.rows[k][2] = least
            row = len(self.rows)
            own = _digest(key, at) if self.named else None
            self.rows.append([least, at, None, n, kids, leaves, saved, None if self.named else hashlib.sha256(_ids(ends).encode()).hexdigest(), own, None])
            b.depth -= 1
            if at:
                self.add(b.bag, at - 1, [n, least, 1, leaves, saved, [], [row]])

    def add(self, bag: dict[int, list], depth: int, more: list) -> None:
        """More for the node at a depth, from the right."""
        if (x := bag.get(depth)) is None:
            bag[depth] = more
            return
        x[0] += more[0]
        x[1] = min(x[1], more[1])
        for k in (2, 3, 4):
            x[k] += more[k]
        x[5].extend(more[5])
        x[6] = (x[6], more[6]) if len(x[6]) >= len(more[6]) else (more[6], x[6])
        x[6][0].extend(x[6][1])
        x[6] = x[6][0]

    def unite(self, i: int, j: int, depth: int) -> None:
        i, j = self.find(i), self.find(j)
        a, b = self.branches[i], self.branches[j]
        if a.stuck and b.stuck:
            return
        for x in (a, b):
            if not x.stuck:
                self.close(x, depth)
        bag = a.bag
        for d, more in b.bag.items():
            self.add(bag, d, more)
        keep = b if b.stuck else a
        keep.bag = bag
        root, other = (j, i) if b.stuck else (i, j)
        self.up[other] = root

    def grow(self) -> None:
        edges = np.array([_common(a, b) for a, b in zip(self.keys[:-1], self.keys[1:], strict=True)], np.int64)
        for k in np.argsort(-edges, kind="stable"):
            self.unite(int(k), int(k) + 1, int(edges[k]))


def _batches(columns: dict[str, list]) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    table = pa.table({f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW}, schema=_ARROW)
    yield from table.to_batches(max_chunksize=8192)


def _out(forest: _Forest, pid: int) -> Iterator[pa.RecordBatch]:
    """Closed nodes, the open paths, and the ids that end on these."""
    opened, ends = [], []
    for side, i in enumerate(k for k, u in enumerate(forest.up) if u == k and forest.branches[k].stuck):
        b = forest.branches[i]
        key, depth = forest.keys[b.rep], len(forest.keys[b.rep]) // WIDTH
        totals = [[0, NONE, 0, 0, 0] for _ in range(depth + 1)]
        for d, x in b.bag.items():
            totals[d] = x[:5]
            name = _digest(key, d)
            for k in x[6]:
                forest.rows[k][9] = name
            if x[5]:
                ends.append((name, side, _ids(x[5])))
        opened.append((side, key, forest.words[b.rep], totals))
    if forest.rows:
        names = [*RESULT, "key", "parent_key"]
        columns = dict(zip(names, map(list, zip(*forest.rows, strict=True)), strict=True))
        yield from _batches({"kind": [NODE] * len(forest.rows), "pid": [pid] * len(forest.rows)} | columns)
    if opened:
        side, key, words, totals = map(list, zip(*opened, strict=True))
        yield from _batches({"kind": [OPEN] * len(side), "pid": [pid] * len(side), "side": side, "key": key, "words": words, "totals": totals})
    if ends:
        key, side, text = map(list, zip(*ends, strict=True))
        yield from _batches({"kind": [ENDS] * len(key), "pid": [pid] * len(key), "key": key, "side": side, "text": text})


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one sorted partition; its first and last conversation stay open."""
    ids, keys, words = [], [], []
    for b in batches:
        ids += b.column("conv_id").to_pylist()
        keys += b.column("key").to_pylist()
        words += b.column("words").to_pylist()
    if ids:
        at = [len(k) // WIDTH for k in keys]
        branches = [_Branch(d, {d: [1, c, 0, 0, 0, [c], []]}, i, i in (0, len(ids) - 1)) for i, (c, d) in enumerate(zip(ids, at, strict=True))]
        forest = _Forest(keys, words, branches, False)
        forest.grow()
        yield from _out(forest, TaskContext.get().partitionId())


def _merge(last: bool, group: int):
    """The forest of neighbouring blocks, from their open paths; the last merge closes the root."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pid", "ascending"), ("side", "ascending")])
        keys, words, totals = (table.column(c).to_pylist() for c in ("key", "words", "totals"))
        pid = table.column("pid")[0].as_py() // group
        branches = [_Branch(len(t) - 1, {d: [*x, [], []] for d, x in enumerate(t)}, i, not last and i in (0, len(keys) - 1)) for i, t in enumerate(totals)]
        forest = _Forest(keys, words, branches, True)
        forest.grow()
        if last:
            forest.close(forest.branches[forest.find(0)], -1)
        return pa.Table.from_batches(_out(forest, pid), schema=_ARROW)

    return run


def _stream_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, sha256 of its texts joined by commas) from rows sorted by key: a text at a time is held."""
    key, state, done = None, None, []
    for b in batches:
        for k, text in zip(b.column("key").to_pylist(), b.column("text"), strict=True):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.as_py().encode())
            else:
                state.update(b"," + text.as_py().encode())
    if state is not None:
        done.append((key, state.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())], ["key", "sha"])


def prefix_trie(seqs: DataFrame, *, turns_per_task: int = 1 << 13, group: int = GROUP) -> DataFrame:
    """The trie of sequences (conv_id, hashes, words): one row for each distinct sequence of first turns, the empty one
    (the root) included.

    conv_id is the smallest member, that is conversation that starts with the sequence; depth; parent_conv_id the parent's
    (null at the root); n_convs members; n_children; n_leaves the childless nodes in the subtree, itself included;
    saved_tokens the sum over the subtree of (n_convs - 1) times the words of a node's last turn; ends_sha256 the digest of the
    members that end here, ascending and joined by commas. No sequences give no rows; a conv_id must be unique and not null.

    Sequences are range-partitioned and sorted; equal ones go by id, so that a group of copies of any size is cut as well.
    A partition closes all nodes but those on the paths of its first and last conversation. What it knows of these is all
    that it hands on, and neighbouring partitions merge by it, `group` at a time, until the root closes. Digests over ids of
    an open node are streamed from its partitions' parts. Children of open nodes learn their parent's id by a join.
    """
    spark = seqs.sparkSession
    keyed = seqs.select("conv_id", F.unhex(F.array_join("hashes", "")).alias("key"), F.col("words").cast("array<int>").alias("words"))
    rows = materialize(keyed, "sequences")
    turns = rows.agg(F.sum(F.size("words") + 1)).first()[0]
    if not turns:
        return spark.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in RESULT))
    # a task holds its partition's turn hashes: at most 64 times turns_per_task, fewer where tasks would lie idle
    parts = 1 + max(turns // (64 * turns_per_task), min(turns // turns_per_task, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    forests = [materialize(dealt.mapInArrow(_grow, SCHEMA), "forest")]
    discard(rows)
    blocks = forests[0].agg(F.max("pid")).first()[0] + 1
    while True:
        last = blocks <= group
        paths = forests[-1].where(F.col("kind") == OPEN)
        merged = paths.groupBy(F.floor(F.col("pid") / group).alias("block")).applyInArrow(_merge(last, group), SCHEMA)
        forests.append(materialize(merged, "merged"))
        if last:
            break
        blocks = -(-blocks // group)
    inner, outer = forests[0], forests[1]
    for more in forests[2:]:
        outer = outer.unionByName(more)
    names = [*RESULT, "key", "parent_key"]
    chunks = inner.where(F.col("kind") == ENDS).select("key", "pid", "side", "text")
    ends = chunks.repartition("key").sortWithinPartitions("key", "pid", "side").select("key", "text").mapInArrow(_stream_digest, "key binary, sha string")
    opened = outer.where(F.col("kind") == NODE).select(*names).join(ends, "key", "left")
    opened = materialize(opened.withColumn("ends_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256))).select(*names), "opened")
    nodes = inner.where(F.col("kind") == NODE).select(*names).unionByName(opened)
    parents = opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"), "n_children")
    waiting = nodes.where(F.col("parent_key").isNotNull()).drop("key", "parent_conv_id")
    parents = parents.withColumnRenamed("n_children", "_children")
    found = join_hot(waiting, parents, ["parent_key"], "_children", waiting.count()).withColumnRenamed("_parent", "parent_conv_id")
    return nodes.where(F.col("parent_key").isNull()).select(*RESULT).unionByName(found.select(*RESULT))
