"""SentencePiece encoding and decoding: the n best segmentations by a backward A-star search over the piece lattice."""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import _spans_hash, mix, trimmed

SPACE = "▁"


class Suffix:
    """A suffix of a segmentation: its first piece and a link to the suffix after it, so a queue grows by one link an entry.

    Suffixes are ordered as the tuples of their pieces' ids from the end. A second link further down, to the place that
    the skew binary numbers give, finds where two of them part in logarithmic time.
    """

    __slots__ = ("after", "jump", "depth", "ids", "at", "done", "lost")

    def __init__(self, after: Suffix | None, ids: tuple[int, ...], at: int, done: float, lost: float):
        self.after, self.ids, self.at, self.done, self.lost = after, ids, at, done, lost
        if after is None:
            self.depth, self.jump = 0, self
        else:
            self.depth = after.depth + 1
            j = after.jump
            self.jump = j.jump if after.depth - j.depth == j.depth - j.jump.depth else after

    def ancestor(self, depth: int) -> Suffix:
        x = self
        while x.depth > depth:
            x = x.jump if x.jump.depth >= depth else x.after
        return x

    def __lt__(self, other: Suffix) -> bool:
        depth = min(self.depth, other.depth)
        a, b = self.ancestor(depth), other.ancestor(depth)
        if a is b:
            return self.depth < other.depth
        while a.after is not b.after:
            a, b = (a.after, b.after) if a.jump is b.jump else (a.jump, b.jump)
        return a.ids < b.ids

    def path(self) -> tuple[int, ...]:
        out: list[int] = []
        x = self
        while x.after is not None:
            out += x.ids
            x = x.after
        return tuple(out)


class Lattice:
    """A piece vocabulary with scores and the searches over the lattices that it spans.

    Characters that no piece covers become byte pieces. A text's lattice is the concatenation of its chunks' lattices:
    a chunk starts at each run of spaces, and no piece reaches from another character into a space.
    """

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(len(self.names)) if sp.is_byte(i)}
        self.of_byte = {i: b for b, i in self.byte.items()}
        plain = [i for i in range(len(self.names)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        crossing = [i for i in plain if SPACE in self.names[i].lstrip(SPACE)]
        plain = [i for i in plain if SPACE not in self.names[i].lstrip(SPACE)]
        self.left_out = crossing
        # the file ranks its pieces by merges and holds no probabilities: those of a Zipf law by rank stand for them
        total = math.log(sum(1 / (k + 2) for k in range(len(plain))))
        self.ids = {self.names[i]: i for i in plain}
        self.score = {self.names[i]: -math.log(k + 2) - total for k, i in enumerate(plain)}
        self.byte_score = -math.log(len(plain) + 2) - total
        self.longest = max(map(len, self.score))
        heads: set[str] = set()
        for name in self.score:
            heads.update(name[:k] for k in range(1, len(name)))
        self.heads = heads
        self.cache: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def edges(self, chunk: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each place the pieces that end there: (start, score, ids)."""
        n = len(chunk)
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        score, ids, heads = self.score, self.ids, self.heads
        for i in range(n):
            single = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                name = chunk[i:j]
                s = score.get(name)
                if s is not None:
                    into[j].append((i, s, (ids[name],)))
                    single |= j == i + 1
                if name not in heads:
                    break
            if not single:
                raw = chunk[i].encode("utf-8", "surrogatepass")
                into[i + 1].append((i, self.byte_score * len(raw), tuple(self.byte[b] for b in raw)))
        return into

    def n_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations, best first; ties go to the smaller ids from the end.

        Forward: the best score of each prefix (Viterbi). Backward: from the end, an entry's priority is what the score
        of its suffix and the best score of the prefix left lose, which is exact, so entries leave the queue in order.
        Entries are linked, so memory grows with the length of the chunk.
        """
        into = self.edges(chunk)
        best = [0.0] + [-math.inf] * len(chunk)
        for j in range(1, len(chunk) + 1):
            best[j] = max(best[i] + s for i, s, _ in into[j])
        # what a suffix loses against the best is a sum of its pieces' losses: 0 along a best path, however long
        queue: list[tuple[float, Suffix]] = [(0.0, Suffix(None, (), len(chunk), 0.0, 0.0))]
        out: list[tuple[float, tuple[int, ...]]] = []
        while queue and len(out) < n:
            _, suffix = heapq.heappop(queue)
            at = suffix.at
            if at == 0:
                out.append((suffix.done, suffix.path()))
                continue
            for i, s, ids in into[at]:
                lost = suffix.lost + (best[at] - (best[i] + s))
                heapq.heappush(queue, (round(lost, 9), Suffix(suffix, ids, i, suffix.done + s, lost)))
        return out

    def chunk_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        key = chunk
        found = self.cache.get(key)
        if found is None or len(found[0]) != 0 and found[1] < n:
            if len(self.cache) >= 400_000:
                self.cache.clear()
            found = (self.n_best(chunk, n), n)
            if len(chunk) <= Block.LONG:
                self.cache[key] = found
        return found[0]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Runs of spaces with what follows them up to the next space; spaces are written as SPACE, one is put first."""
        out = []
        for part in (SPACE + text.replace(" ", SPACE)).split(SPACE)[1:]:
            if out and not out[-1].lstrip(SPACE):
                out[-1] += SPACE + part
            else:
                out.append(SPACE + part)
        return out

    def encode(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a text: (score, ids), best first; [] of an empty text is the one empty one."""
        if not text:
            return [(0.0, [])]
        parts = [self.chunk_best(c, n) for c in self.chunks(text)]
        best = math.fsum(p[0][0] for p in parts)
        # only the n - 1 chunks that lose least by their second choice can differ from the best in the n best
        loss = sorted((p[0][0] - p[1][0], k) for k, p in enumerate(parts) if len(p) > 1) if n > 1 else []
        movable = [k for _, k in loss[: n - 1]]
        out, queue, seen = [], [(0.0, (0,) * len(movable))], set()
        while queue and len(out) < n:
            lost, choice = heapq.heappop(queue)
            picked = dict(zip(movable, choice, strict=True))
            out.append((best - lost, [x for k, p in enumerate(parts) for x in p[picked.get(k, 0)][1]]))
            for m, k in enumerate(movable):
                c = choice[m] + 1
                if c < len(parts[k]):
                    new = choice[:m] + (c,) + choice[m + 1 :]
                    if new not in seen:
                        seen.add(new)
                        heapq.heappush(queue, (math.fsum(parts[k][0][0] - parts[k][c2][0] for k, c2 in zip(movable, new, strict=True)), new))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation."""
        raw = bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            if b is None:
                raw += self.names[i].encode()
            else:
                raw.append(b)
        return raw.decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]


@lru_cache(1)
def lattice(model: str) -> Lattice:
    return Lattice(model)


class Block:
    """The searches of Lattice for many texts at once.

    Equal chunks are searched once a block. Forward and backward best scores run over all chunks together, place by
    place; they give each chunk's best segmentation and what its second best loses. The n best of a text differ from
    its best only in the n - 1 chunks that lose least, and only those chunks are searched with A-star.
    """

    FREQUENT = 255
    LONG = 256  # characters: longer chunks are searched one by one

    def __init__(self, lat: Lattice):
        self.lat = lat
        nodes, chars = {"": 0}, {}
        for name in lat.score:
            for k in range(1, len(name) + 1):
                nodes.setdefault(name[:k], len(nodes))
        for key in nodes:
            if key:
                chars[key[-1]] = chars.get(key[-1], 0) + 1
        often = sorted(chars, key=lambda c: (-chars[c], c))[: self.FREQUENT]
        cls = {c: k + 1 for k, c in enumerate(often)}
        self.cls = np.zeros(0x110000, np.uint8)
        for c, k in cls.items():
            self.cls[ord(c)] = k
        self.next = np.zeros((len(nodes), self.FREQUENT + 1), np.uint16 if len(nodes) < 1 << 16 else np.int32)
        rare = []
        for key, node in nodes.items():
            if key:
                parent = nodes[key[:-1]]
                if key[-1] in cls:
                    self.next[parent, cls[key[-1]]] = node
                else:
                    rare.append(((parent << 21) | ord(key[-1]), node))
        rare.sort()
        self.rare_key = np.array([k for k, _ in rare] or [-1], np.int64)
        self.rare_node = np.array([v for _, v in rare] or [0], np.int32)
        self.none = len(lat.names)  # stands for no piece; above it are characters as bytes
        self.piece = np.full(len(nodes), self.none, np.int32)
        self.score = np.full(self.none + 1, -np.inf)
        for name, s in lat.score.items():
            self.piece[nodes[name]] = lat.ids[name]
            self.score[lat.ids[name]] = s
        raw = [b"" if i in lat.of_byte else name.encode() for i, name in enumerate(lat.names)]
        self.raw = [bytes([lat.of_byte[i]]) if i in lat.of_byte else b for i, b in enumerate(raw)]

    def _step(self, node: np.ndarray, point: np.ndarray) -> np.ndarray:
        c = self.cls[point]
        out = self.next[node, c].astype(np.int32)
        odd = np.flatnonzero(c == 0)
        if len(odd):
            key = (node[odd].astype(np.int64) << 21) | point[odd]
            at = np.minimum(np.searchsorted(self.rare_key, key), len(self.rare_key) - 1)
            out[odd] = np.where(self.rare_key[at] == key, self.rare_node[at], 0)
        return out

    def _chunk_paths(self, points: np.ndarray, start: np.ndarray, size: np.ndarray):
        """(score, loss, piece counts, pieces) of the best segmentation of chunks laid out in points."""
        n, total = len(start), len(points)
        end = start + size
        stop = np.repeat(end, size)
        deep = []  # by piece length less one: the piece from each place, or none
        node, at = np.zeros(total, np.int32), np.arange(total)
        for k in range(self.lat.longest):
            inside = at + k < stop[at]
            at, node = at[inside], node[inside]
            node = self._step(node, points[at + k])
            go = node > 0
            at, node = at[go], node[go]
            if not len(at):
                break
            row = np.full(total, self.none, np.int32)
            row[at] = self.piece[node]
            deep.append(row)
        if not deep:
            deep = [np.full(total, self.none, np.int32)]
        wide = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        bare = deep[0] == self.none
        one = np.where(bare, self.lat.byte_score * wide, self.score[deep[0]])
        gain = [one, *(self.score[row] for row in deep[1:])]
        # boundaries: chunk j has size[j] + 1 of them, from start[j] + j on
        shift = np.arange(n)
        first = start + shift
        best = np.full(total + n, -np.inf)
        best[first] = 0.0
        step = np.zeros(total + n, np.int8)
        top = np.zeros(total + n, np.int64)
        order = np.argsort(-size, kind="stable")
        longest = -np.sort(-size)
        for j in range(1, int(longest[0]) + 1):
            who = order[: np.searchsorted(-longest, -j, "right")]
            b = first[who] + j
            value, name, took = np.full(len(who), -np.inf), np.full(len(who), np.iinfo(np.int64).max), np.zeros(len(who), np.int8)
            for k in range(min(j, len(gain))):
                pos = start[who] + j - k - 1
                v = best[b - k - 1] + gain[k][pos]
                i = deep[k][pos].astype(np.int64)
                if k == 0:
                    # a character's first byte piece stands for its bytes among equals
                    i = np.where(bare[pos], 0, i)
                better = (v > value + 1e-9) | ((v > value - 1e-9) & (i < name) & np.isfinite(v))
                value = np.where(better, v, value)
                name = np.where(better, i, name)
                took = np.where(better, np.int8(k + 1), took)
            best[b], step[b], top[b] = value, took, name
        back = np.full(total + n, -np.inf)
        back[end + shift] = 0.0
        for j in range(1, int(longest[0]) + 1):
            who = order[: np.searchsorted(-longest, -j, "right")]
            b = end[who] + shift[who] - j
            value = np.full(len(who), -np.inf)
            for k in range(min(j, len(gain))):
                value = np.maximum(value, back[b + k + 1] + gain[k][end[who] - j])
            back[b] = value
        # backtrace, all chunks together
        on = [np.zeros(total, bool) for _ in gain]
        where, which, what = [], [], []
        cur, who = end.copy(), np.arange(n)
        while len(who):
            k = step[cur + shift[who]].astype(np.int64)
            pos = cur - k
            ids = np.empty(len(who), np.int64)
            for length in np.unique(k):
                m = k == length
                on[length - 1][pos[m]] = True
                ids[m] = deep[length - 1][pos[m]]
            ids = np.where(ids == self.none, self.none + 1 + points[pos], ids)
            where.append(who)
            which.append(pos)
            what.append(ids)
            left = pos > start[who]
            cur, who = pos[left], who[left]
        who, pos, ids = np.concatenate(where), np.concatenate(which), np.concatenate(what)
        along = np.argsort(pos, kind="stable")
        who, ids = who[along], ids[along]
        # the best path through any piece that the best one leaves out
        second = np.full(n, -np.inf)
        chunk_of = np.repeat(shift, size)
        for k, g in enumerate(gain):
            reach = np.flatnonzero(np.isfinite(g) & ~on[k])
            if len(reach):
                c = chunk_of[reach]
                np.maximum.at(second, c, best[reach + c] + g[reach] + back[reach + c + k + 1])
        score = best[end + shift]
        return score, score - second, np.bincount(who, minlength=n), ids

    def _spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids with characters as byte pieces, how many each became)."""
        odd = np.flatnonzero(ids > self.none)
        n = np.ones(len(ids), np.int64)
        if not len(odd):
            return ids, n
        parts = [[self.lat.byte[b] for b in chr(int(ids[k]) - self.none - 1).encode("utf-8", "surrogatepass")] for k in odd]
        n[odd] = [len(p) for p in parts]
        out = np.repeat(ids, n)
        at = np.concatenate(([0], np.cumsum(n)))[odd]
        for a, p in zip(at, parts, strict=True):
            out[a : a + len(p)] = p
        return out, n

    def encode(self, texts: list[str], n: int) -> list[list[tuple[float, np.ndarray, bool]]]:
        """For each text its n best segmentations (score, ids, whether they decode to the text), best first."""
        lat = self.lat
        full = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        points = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(t) for t in full], np.int64)
        if not len(points):
            return [[(0.0, np.empty(0, np.int64), True)] for _ in texts]
        text_start = np.cumsum(sizes) - sizes
        mark = points == ord(SPACE)
        opens = mark & ~np.concatenate(([False], mark[:-1]))
        opens[text_start[sizes > 0]] = True
        start = np.flatnonzero(opens)
        size = np.diff(np.append(start, len(points)))
        doc = np.searchsorted(text_start, start, "right") - 1
        # empty texts share their start with the next one: searchsorted gives the last, which holds the characters
        key = _spans_hash(mix(points.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)), start, start + size)
        key[size > self.LONG] = mix(np.flatnonzero(size > self.LONG).astype(np.uint64))  # a long chunk stands for itself
        _, rep, at = np.unique(key, return_index=True, return_inverse=True)
        short = size[rep] <= self.LONG
        score, loss, count, paths = np.zeros(len(rep)), np.full(len(rep), np.inf), np.zeros(len(rep), np.int64), []
        own = np.flatnonzero(short)
        laid = size[rep[own]]
        begin = np.cumsum(laid) - laid
        spots = np.repeat(start[rep[own]] - begin, laid) + np.arange(int(laid.sum()))
        if len(own):
            score[own], loss[own], count[own], ids = self._chunk_paths(points[spots], begin, laid)
            ids, became = self._spelled(ids)
            count[own] = np.add.reduceat(became, np.cumsum(count[own]) - count[own])
            paths.append(ids)
        text_of = lambda k: "".join(map(chr, points[start[k] : start[k] + size[k]]))
        longs = np.flatnonzero(~short)
        for u in longs:
            found = lat.n_best(text_of(rep[u]), 2)
            score[u], count[u] = found[0][0], len(found[0][1])
            loss[u] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            paths.append(np.array(found[0][1], np.int64))
        flat = np.concatenate(paths)
        offset = np.zeros(len(rep), np.int64)
        serial = np.concatenate([own, longs])
        offset[serial] = np.cumsum(count[serial]) - count[serial]
        # a text's ids are its chunks' paths one after the other
        c = count[at]
        ids_start = np.cumsum(c) - c
        ids_all = flat[np.repeat(offset[at] - ids_start, c) + np.arange(int(c.sum()))]
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        out: list[list[tuple[float, np.ndarray, bool]]] = []
        lost = loss[at]
        searched: dict[int, list[tuple[float, tuple[int, ...]]]] = {}
        for d, text in enumerate(texts):
            a, b = int(cuts[d]), int(cuts[d + 1])
            if a == b:
                out.append([(0.0, np.empty(0, np.int64), True)])
                continue
            lo = int(ids_start[a])
            ids = ids_all[lo : int(ids_start[b - 1] + c[b - 1])]
            best = float(score[at[a:b]].sum())
            raw = self.raw
            right = b"".join([raw[i] for i in ids.tolist()]) == full[d].encode("utf-8", "surrogatepass")
            found = [(best, ids, right)]
            near = lost[a:b]
            m = min(n - 1, len(near))
            pick = np.argpartition(near, m - 1)[:m] if m and m < len(near) else np.arange(m)
            bound = near[pick].max() if m else 0.0
            pick = np.flatnonzero(near <= bound + 1e-12) if m and np.isfinite(bound) else pick  # with all that tie at the bound
            pick = pick[np.isfinite(near[pick])]
            pick = pick[np.lexsort((pick, np.round(near[pick], 9)))][: n - 1]
            choices = []
            for k in pick:
                u = int(at[a + k])
                if u not in searched:
                    searched[u] = lat.n_best(text_of(rep[u]), n)
                choices.append(searched[u])
            queue, seen = [(0.0, (0,) * len(pick))], set()
            first = True
            while queue and len(found) < n + first:
                gone, choice = heapq.heappop(queue)
                if not first:
                    parts, good, last = [], right, 0
                    for p in sorted(range(len(pick)), key=lambda p: pick[p]):
                        k = a + int(pick[p])
                        parts += [ids[last : int(ids_start[k]) - lo], np.array(choices[p][choice[p]][1], np.int64)]
                        good = good and b"".join([raw[i] for i in choices[p][choice[p]][1]]) == text_of(k).encode("utf-8", "surrogatepass")
                        last = int(ids_start[k] + c[k]) - lo
                    found.append((best - gone, np.concatenate([*parts, ids[last:]]), good))
                    if len(found) == n:
                        break
                first = False
                for p in range(len(pick)):
                    q = choice[p] + 1
                    if q < len(choices[p]):
                        new = choice[:p] + (q,) + choice[p + 1 :]
                        if new not in seen:
                            seen.add(new)
                            heapq.heappush(queue, (round(sum(x[0][0] - x[r][0] for x, r in zip(choices, new, strict=True)), 9), new))
            out.append(found[:n])
        return out


@lru_cache(1)
def block_encoder(model: str) -> Block:
    return Block(lattice(model))


def _blocks(texts: list[str], most: int) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_pieces(docs: DataFrame, *, n: int = 4, model: str = "piece_bpe_32k.model", block: int = 1 << 20) -> DataFrame:
    """doc_id, rank (from 0), score, ids array<int>, decoded (what the ids stand for): up to n rows a document.

    A null or empty text has one segmentation without pieces; fewer than n rows come where a text has fewer
    segmentations. Spaces are kept as they are. A text that holds SPACE itself decodes to a space there. Repeated rows
    are encoded each; columns other than doc_id and text are ignored; an empty table gives an empty result. Each text
    is encoded whole, where it lies.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, lat = block_encoder(model), lattice(model)
        for pdf in batches:
            ids, rows = iter(pdf["doc_id"]), []
            for texts in _blocks([t or "" for t in pdf["text"]], block):
                for found in enc.encode(texts, n):
                    doc_id = next(ids)
                    rows += [(doc_id, rank, round(score, 6), x, lat.decode(x.tolist())) for rank, (score, x, _) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["doc_id", "rank", "score", "ids", "decoded"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(trimmed(run), f"doc_id {id_type}, rank int, score double, ids array<int>, decoded string")


def encode_digest(docs: DataFrame, *, n: int = 4, model: str = "piece_bpe_32k.model", block: int = 1 << 20) -> DataFrame:
    """One row a document: doc_id, n_pieces, score, gap (to the second best), n_found, ids_crc32 of all found ids in
    order, and whether every segmentation decodes to the text."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = block_encoder(model)
        for pdf in batches:
            rows = []
            for texts in _blocks([t or "" for t in pdf["text"]], block):
                for found in enc.encode(texts, n):
                    crc = 0
                    for _, ids, _ in found:
                        crc = zlib.crc32(np.append(ids, -1).astype("<i4").tobytes(), crc)
                    gap = round(found[0][0] - found[1][0], 6) if len(found) > 1 else None
                    rows.append((len(found[0][1]), round(found[0][0], 6), gap, len(found), crc, all(x[2] for x in found)))
            out = pd.DataFrame(rows, columns=["n_pieces", "score", "gap", "n_found", "ids_crc32", "decodes"]).astype({"gap": "float64"})
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(trimmed(run), f"doc_id {id_type}, n_pieces long, score double, gap double, n_found int, ids_crc32 long, decodes boolean")
