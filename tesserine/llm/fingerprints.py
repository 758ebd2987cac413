"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import mix, shingles, trimmed

BINS, BITS, WORDS = 512, 8, 5


@lru_cache(4)
def _order(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin its own random order of all bins: (the k-th that it asks, the place of each). The distinct draws of a
    universal hash of bin and attempt come in such an order."""
    x = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins)
    asked = np.argsort(mix(x + np.uint64(0x51ED270B)), axis=1, kind="stable")
    place = np.empty_like(asked)
    np.put_along_axis(place, asked, np.broadcast_to(np.arange(bins), (bins, bins)), axis=1)
    return np.ascontiguousarray(asked.T), place.astype(np.uint16 if bins <= 1 << 16 else np.uint32)


def minhash(hashes: np.ndarray, bins: int = BINS) -> np.ndarray | None:
    """The densified bin minima of a set of 64-bit hashes; None for an empty set.

    The high bits of a hash choose its bin, the rest is the value. An empty bin takes the value of the first non-empty
    bin in its own random order, however few are non-empty, so that two sets agree in a filled bin with probability
    equal to their likeness.
    """
    if not len(hashes):
        return None
    shift = np.uint64(64 - (bins.bit_length() - 1))
    at = (hashes >> shift).astype(np.int64)
    low = hashes & ((np.uint64(1) << shift) - np.uint64(1))
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(out, at, low)
    full = np.zeros(bins, bool)
    full[at] = True
    own, empty = out.copy(), np.flatnonzero(~full)
    asked, place = _order(bins)
    for row in asked[:8]:  # most bins find one soon
        if not len(empty):
            break
        ask = row[empty]
        got = full[ask]
        out[empty[got]] = own[ask[got]]
        empty = empty[~got]
    if len(empty):
        filled = np.flatnonzero(full)
        out[empty] = own[filled[place[np.ix_(empty, filled)].argmin(1)]]
    return out


def fingerprint(text: str, *, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> bytes:
    """The packed low-order bits of the bin minima of a text's word shingles (A-Z lower-cased); empty without words."""
    m = minhash(shingles(text.encode("utf-8", "surrogatepass").lower(), words), bins)
    if m is None:
        return b""
    # the bin takes part in the hash whose bits are kept: two bins with one donor agree by chance independently
    value = (mix(m + mix(np.arange(1, bins + 1, dtype=np.uint64))) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    if bits == 8:
        return value.tobytes()
    return np.packbits(((value[:, None] >> np.arange(bits)[::-1]) & 1).astype(np.uint8)).tobytes()


def likeness(a: bytes, b: bytes, *, bits: int = BITS) -> float:
    """The share of equal bins, corrected for bins that agree by chance; two texts without words are alike."""
    if not a or not b:
        return float(a == b)
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if bits == 8:
        same = float((x == y).mean())
    else:
        same = float((np.unpackbits(x).reshape(-1, bits) == np.unpackbits(y).reshape(-1, bits)).all(1).mean())
    chance = 2.0**-bits
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def edit(text: str, following: str) -> str:
    """The last half of a text's code points replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprint_runs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by run and place; each is compared with the row after it in the run, the last of a run is a guest."""
    last = None
    for pdf in batches:
        rows = []
        for run, guest, null, doc_id, text in zip(pdf["_run"], pdf["_guest"], pdf["_null"], pdf["doc_id"], pdf["text"], strict=True):
            own = (run, guest, doc_id, text or "", fingerprint(text or ""), null)
            if last is not None and last[0] == run and not last[1]:
                edited = edit(last[3], own[3])
                print_ = fingerprint(edited)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((last[2], last[5], len(last[3]), digest, last[4].hex(), print_.hex(), likeness(last[4], print_), likeness(last[4], own[4])))
            last = own
        yield pd.DataFrame(rows, columns=["doc_id", "_null", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def fingerprint_pairs(docs: DataFrame, *, run_rows: int = 5000, most_runs: int = 20_000) -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    doc_id is a whole number. Each text is fingerprinted, and so is its edited text, whose last half comes from the next
    document by ascending doc_id (after the last: the first; a lone document follows itself). Null ids come first; rows with
    equal ids follow each other by text. A null text counts as empty; columns other than doc_id and text are ignored; an
    empty table gives an empty result.

    Documents are cut into runs of ascending ids at quantiles of doc_id; a run is a partition of its own, read as a sorted
    stream. Only the first document of each run is sent twice, as a guest at the end of the run before it, so each text
    moves once. There are at most `most_runs` runs, and one number of each reaches the driver: runs grow beyond that.
    """
    base = docs.select(F.col("doc_id").isNull().alias("_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = base.count()
    runs = min(most_runs, max(1, -(-total // run_rows)))
    marks = sorted(set(base.approxQuantile("doc_id", [k / runs for k in range(1, runs)], 0.1 / runs))) if runs > 1 else []
    spark = docs.sparkSession
    if marks:
        edges = spark.sparkContext.broadcast(np.array(marks))

        @F.pandas_udf("int")
        def run_of(x: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(edges.value, x.to_numpy(float), "right").astype("int32"))

        base = base.withColumn("_run", run_of(F.col("doc_id").cast("double")))
    else:
        base = base.withColumn("_run", F.lit(0))
    first = F.struct((~F.col("_null")).alias("given"), F.col("doc_id").alias("id"), F.sha2("text", 256).alias("digest"))
    heads = sorted(base.groupBy("_run").agg(F.min(first).alias("head")).collect())
    if heads:
        table = [(h["_run"], k, heads[k - 1]["_run"], h["head"]["given"], h["head"]["id"], h["head"]["digest"]) for k, h in enumerate(heads)]
    else:
        table = []
    guests = spark.createDataFrame(table, "_run int, _part int, _to int, _given boolean, _id long, _digest string")
    # a run's first row is found by id and digest; of rows alike in both, one is sent
    placed = base.join(F.broadcast(guests), "_run")
    of_last = (len(heads) or 1) - 1
    sent = placed.where((F.col("doc_id") == F.col("_id")) & (F.col("_null") != F.col("_given")) & (F.sha2("text", 256) == F.col("_digest"))).dropDuplicates(["_run"])
    before = F.when(F.col("_part") > 0, F.col("_part") - 1).otherwise(F.lit(of_last))
    sent = sent.select("_null", "doc_id", "text", F.col("_to").alias("_run"), before.alias("_part"), F.lit(True).alias("_guest"))
    rows = placed.select("_null", "doc_id", "text", "_run", "_part", F.lit(False).alias("_guest")).unionByName(sent)
    dealt = rows.repartitionById(max(len(heads), 1), "_part").sortWithinPartitions("_run", "_guest", F.col("_null").desc(), "doc_id", F.sha2("text", 256))
    out = dealt.drop("_part").mapInPandas(trimmed(_fingerprint_runs), SCHEMA)
    return out.select(F.when(~F.col("_null"), F.col("doc_id")).cast(docs.schema["doc_id"].dataType).alias("doc_id"), *[c.split()[0] for c in SCHEMA.split(", ")[2:]])


SCHEMA = "doc_id long, _null boolean, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
