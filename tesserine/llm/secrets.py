"""Secret scans: rules verified only where a trigram inverted index says that they can match."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import release, trimmed, unused


@dataclass(frozen=True)
class Rule:
    """A named pattern; spans whose group has fewer than `least` characters are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.compiled().finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# The base patterns. The last two are runs of one class of characters, so matching only runs of the
# least length finds the same spans as matching all runs and dropping short ones.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

# ---- from a regex to a Boolean query over trigrams ----
# A query is a conjunction of disjunctions of conjunctions: a tuple of clauses, each a frozenset of alternatives,
# each a frozenset of trigrams. An empty query holds everywhere.

Query = tuple[frozenset[frozenset[bytes]], ...]
MOST = 64  # alternatives that are followed as exact strings; beyond, the run of literals is cut, which is only weaker


def _trigrams(s: bytes) -> frozenset[bytes]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _strings(op, arg) -> set[bytes] | None:
    """The strings that a node can match, if they are few; else None."""
    if op is sre.LITERAL:
        return {chr(arg).lower().encode()}
    if op is sre.IN:
        out: set[bytes] = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                out.add(chr(x).lower().encode())
            elif kind is sre.RANGE and x[1] - x[0] < 8:
                out |= {chr(c).lower().encode() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _exact(arg[3])
    if op is sre.BRANCH:
        sets = [_exact(x) for x in arg[1]]
        return set().union(*sets) if all(x is not None for x in sets) else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        if (x := _exact(inner)) is None or high == sre.MAXREPEAT or high > 2:
            return None
        out, run = (set() if low else {b""}), {b""}
        for k in range(1, high + 1):
            run = {a + b for a in run for b in x}
            if k >= low:
                out |= run
            if len(out) > MOST:
                return None
        return out
    return {b""} if op is sre.AT else None


def _exact(nodes) -> set[bytes] | None:
    out = {b""}
    for op, arg in nodes:
        if (x := _strings(op, arg)) is None or len(out) * len(x) > MOST:
            return None
        out = {a + b for a in out for b in x}
    return out


def _walk(nodes) -> list[frozenset[frozenset[bytes]]]:
    clauses, run = [], {b""}

    def close():
        nonlocal run
        if all(len(s) >= 3 for s in run):
            clauses.append(frozenset(_trigrams(s) for s in run))
        run = {b""}

    for op, arg in nodes:
        x = _strings(op, arg)
        if x is not None and len(run) * len(x) <= MOST:
            run = {a + b for a in run for b in x}
            continue
        close()
        if x is not None:
            run = x
        elif op is sre.SUBPATTERN:
            clauses += _walk(arg[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            clauses += _walk(arg[2])
        elif op is sre.BRANCH:
            each = [_walk(x) for x in arg[1]]
            if all(each):  # an alternative without mandatory trigrams makes the whole branch hold everywhere
                clauses.append(frozenset().union(*(e[0] for e in each)))
    close()
    return [c for c in clauses if all(c)]


@lru_cache(256)
def trigram_query(pattern: str) -> Query:
    """The trigrams (A-Z lower-cased) that each text with a match must hold; () if none are mandatory."""
    return tuple(_walk(_parser.parse(pattern, re.ASCII)))


# ---- the index ----


class TrigramIndex:
    """Postings of the wanted trigrams over a block of texts."""

    def __init__(self, texts: list[bytes], kinds: np.ndarray, lut: np.ndarray, size: int):
        data = kinds[np.frombuffer(b"\n".join(texts).lower(), np.uint8)]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        k = int(kinds.max()) + 1
        found = lut[(data[:-2] * k + data[1:-1]) * k + data[2:]] if len(data) > 2 else np.empty(0, np.int16)
        at = np.flatnonzero(found)
        doc = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(found[at].astype(np.int64) * len(texts) + doc)
        cut = np.searchsorted(pairs, np.arange(1, size + 2) * len(texts))
        self.postings = [pairs[a:b] - (k + 1) * len(texts) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
        self.n = len(texts)

    def candidates(self, query: list[list[list[int]]]) -> np.ndarray:
        """Texts for which the query over trigram numbers holds."""
        out = np.arange(self.n)
        for clause in query:
            any_of = np.unique(np.concatenate([self._all(x) for x in clause]))
            out = np.intersect1d(out, any_of, assume_unique=True)
        return out

    def _all(self, grams: list[int]) -> np.ndarray:
        lists = sorted((self.postings[g] for g in grams), key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


class Scanner:
    """Finds the spans of all rules in blocks of texts."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted({g for q in queries for clause in q for alt in clause for g in alt})
        number = {g: k for k, g in enumerate(grams)}
        self.size = len(grams)
        # bytes in no trigram are one kind, so the table of trigrams is small
        used = sorted({b for g in grams for b in g})
        self.kinds = np.zeros(256, np.int32)
        self.kinds[used] = np.arange(1, len(used) + 1)
        base = len(used) + 1
        self.lut = np.zeros(base**3, np.int16)
        for g, k in number.items():
            a, b, c = (int(self.kinds[x]) for x in g)
            self.lut[(a * base + b) * base + c] = k + 1
        self.queries = [[[[number[g] for g in alt] for alt in clause] for clause in q] for q in queries]

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule number, end) by start, then rule."""
        index = TrigramIndex([t.encode("utf-8", "surrogatepass") for t in texts], self.kinds, self.lut, self.size)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, query) in enumerate(zip(self.rules, self.queries, strict=True)):
            for d in index.candidates(query):
                out[d] += [(a, k, b) for a, b in rule.spans(texts[d])]
        return [sorted(x) for x in out]


@lru_cache(4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _scan_blocks(scanner: Scanner, texts: list[str], block: int) -> list[list[tuple[int, int, int]]]:
    """The spans of all texts, scanned in blocks of `block` characters, or one text."""
    spans: list = []
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= block or i == len(texts) - 1:
            spans += scanner.scan(texts[first : i + 1])
            first, size = i + 1, 0
    return spans


def _scan_batches(rules: tuple[Rule, ...], block: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _scanner(rules)
        kinds = [r.kind for r in rules]
        for pdf in batches:
            spans = _scan_blocks(scanner, [t or "" for t in pdf["text"]], block)
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "kind": [[kinds[k] for _, k, _ in x] for x in spans],
                    "start": [[a for a, _, _ in x] for x in spans],
                    "end": [[b for _, _, b in x] for x in spans],
                }
            )

    return trimmed(run)


def scan_secrets(docs: DataFrame, *, rules: tuple[Rule, ...] = BASE + MORE, block: int = 1 << 20) -> DataFrame:
    """One row a document: doc_id and the arrays kind, start, end of all spans, by start, then rule order.

    Offsets count code points, end is exclusive. A null text counts as empty; repeated rows are scanned each; columns
    other than doc_id and text are ignored; an empty table gives an empty result.

    The table is scanned as it lies, without a shuffle. Each block of texts gets its own inverted index over the
    trigrams that the rules' queries name; a rule is verified only on the texts that its query leaves, and a rule
    without mandatory trigrams (such as a run of hex digits) on all. A block is `block` characters, or one text.
    """
    kept = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInPandas(_scan_batches(tuple(rules), block), f"doc_id {id_type}, kind array<string>, start array<long>, end array<long>")


def span_digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256 and spans, from the arrays of scan_secrets."""
    each = F.transform(F.arrays_zip("kind", "start", "end"), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    kinds = [r.kind for r in base]
    of_base = F.filter(each, lambda s: F.substring_index(s, ":", 1).isin(kinds))
    counts = [(F.size("kind") - F.size(F.array_remove("kind", kind))).cast("long").alias(f"n_{kind}") for kind in kinds]
    return scanned.select("doc_id", *counts, F.sha2(F.array_join(of_base, ","), 256).alias("base_sha256"), F.array_join(each, ",").alias("spans"))


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with each union of overlapping spans replaced by the mask."""
    out, at, end = [], 0, -1
    for start, _, stop in spans:
        if start >= end:
            out += [text[max(at, end, 0) : start], mask]
        end = max(end, stop)
        at = end
    return "".join(out) + text[max(end, 0) :]


def redact(docs: DataFrame, *, rules: tuple[Rule, ...] = BASE + MORE, mask: str = "[secret]", block: int = 1 << 20) -> DataFrame:
    """docs with the secrets in text masked, where they lie; overlapping spans become one mask.

    A null text stays null. n_chars, if there, is counted anew where the text changed. Repeated rows are masked each.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = _scanner(tuple(rules))
        for texts in batches:
            found = _scan_blocks(scanner, [t or "" for t in texts], block)
            yield pd.Series([masked(t, x, mask) if x else t for t, x in zip(texts, found, strict=True)])
        release()

    clean = unused(docs, "clean")
    out = docs.withColumn(clean, F.pandas_udf(run, "string")(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        changed = ~F.col(clean).eqNullSafe(F.col("text"))
        out = out.withColumn("n_chars", F.when(changed, F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col(clean)).select(*docs.columns)
