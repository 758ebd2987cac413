"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import release, trimmed, unused

UNDETERMINED = "und"
_ROWS = 16_384  # n-gram vectors that a worker keeps


@lru_cache(1)
def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Encoder:
    """Bundles a text's n-gram vectors; an n-gram's vector binds its letters' random vectors, each permuted by place."""

    def __init__(self, dim: int, n: int, seed: int):
        self.dim, self.n, self.seed = dim, n, seed
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.at: dict[int, int] = {}
        self.grams = np.empty((1024, self.dim), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            if len(self.letters) >= _ROWS:
                self.letters.clear()
            self.letters[c] = np.random.default_rng((self.seed, c)).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1
        return self.letters[c]

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers of the vectors of n-grams, given as n 21-bit code points each."""
        if len(self.at) + len(codes) > _ROWS:
            self.clear()
        out = np.empty(len(codes), np.int64)
        for k, code in enumerate(codes.tolist()):
            row = self.at.get(code)
            if row is None:
                row = self.at[code] = len(self.at)
                if row >= len(self.grams):
                    self.grams = np.concatenate([self.grams, np.empty((len(self.grams), self.dim), np.int8)])
                v = np.ones(self.dim, np.int8)
                for place in range(self.n):
                    v = v * np.roll(self.letter((code >> (21 * place)) & 0x1FFFFF), place)
                self.grams[row] = v
            out[k] = row
        return out

    def ngrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """A text's distinct n-grams and their counts; None if it has no letter. Runs of other characters count as one space."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _is_letter()[points]
        if not letter.any():
            return None
        points = np.concatenate(([32], np.where(letter, points, 32), [32])).astype(np.int64)
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
        code = np.zeros(max(0, len(points) - self.n + 1), np.int64)
        for place in range(self.n):
            code = (code << 21) | points[place : place + len(code)]
        return np.unique(code, return_counts=True)

    def encode(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text; None if it has no letter."""
        found = self.ngrams(text)
        return None if found is None else self.bundle(*found)

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The unit vector of n-grams with counts."""
        out = np.zeros(self.dim, np.float32)
        for a in range(0, len(codes), _ROWS // 4):
            part = self.rows(codes[a : a + _ROWS // 4])
            out += counts[a : a + _ROWS // 4].astype(np.float32) @ self.grams[part].astype(np.float32)
        norm = float(np.sqrt((out.astype(np.float64) ** 2).sum()))
        return out / norm if norm else out


@lru_cache(2)
def encoder(dim: int, n: int, seed: int) -> Encoder:
    return Encoder(dim, n, seed)


def fit_profiles(labelled: DataFrame, *, dim: int = 1024, n: int = 3, seed: int = 7) -> dict[str, np.ndarray]:
    """Unit prototype of each value of lang: the bundle of the unit vectors of its texts.

    labelled has text and lang; rows without either are left out. Every row counts. Each task adds up its own rows and
    sends dim numbers a language, the sums are added by (lang, dimension), and languages x dim numbers reach the driver.
    """

    def partial(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, sums = encoder(dim, n, seed), {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"], strict=True):
                if (v := enc.encode(text)) is not None:
                    sums[lang] = sums.get(lang, 0.0) + v.astype(np.float64)
        for lang, v in sums.items():
            yield pd.DataFrame({"lang": lang, "place": np.arange(dim, dtype=np.int32), "value": np.round(v, 6)})

    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    parts = rows.mapInPandas(trimmed(partial), "lang string, place int, value double")
    # decimals add up the same in any order
    sums = parts.groupBy("lang", "place").agg(F.sum(F.col("value").cast("decimal(28,6)")).cast("double").alias("value"))
    out: dict[str, np.ndarray] = {}
    for lang, place, value in sums.toPandas().itertuples(index=False):
        out.setdefault(lang, np.zeros(dim))[place] = value
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(out.items())}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], *, dim: int = 1024, n: int = 3, seed: int = 7) -> DataFrame:
    """docs' columns with lang_pred and score: the language whose prototype has the largest cosine, and that cosine.

    Only text is read. A null text or one without a letter is "und" with score 0, as is every text if there are no
    profiles. Ties go to the first language by name; negative cosines count as 0. Columns named lang_pred or score
    are replaced, all others stay. Whole texts are encoded, row by row, without a shuffle.
    """
    names = sorted(profiles)
    matrix = np.array([profiles[k] for k in names], np.float64).reshape(len(names), dim)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(dim, n, seed)
        for batch in texts:
            best, score = [], []
            for text in batch:
                v = enc.encode(text) if names else None
                if v is None:
                    best.append(UNDETERMINED)
                    score.append(0.0)
                else:
                    cos = matrix @ v.astype(np.float64)
                    k = int(np.argmax(cos))
                    best.append(names[k])
                    score.append(float(min(1.0, max(0.0, cos[k]))))
            yield pd.DataFrame({"lang_pred": best, "score": score})
        release()

    udf = F.pandas_udf(predict, "lang_pred string, score double")
    kept, name = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")], unused(docs, "pred")
    out = docs.withColumn(name, udf(F.col("text").cast("string")))
    return out.select(*kept, F.col(name)["lang_pred"].alias("lang_pred"), F.col(name)["score"].alias("score"))


def weigh(docs: DataFrame, profiles: dict[str, np.ndarray], name: str = "_seen", *, dim: int = 1024, n: int = 3, seed: int = 7) -> DataFrame:
    """docs' columns and one called `name`: lang_pred and score as `identify` gives them, own (the cosine with the prototype of
    the row's lang, null without one) and grams (how many distinct n-grams the text has, 0 without a letter)."""
    names = sorted(profiles)
    at = {k: i for i, k in enumerate(names)}
    matrix = np.array([profiles[k] for k in names], np.float64).reshape(len(names), dim)

    def predict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        enc = encoder(dim, n, seed)
        for texts, langs in batches:
            rows = []
            for text, lang in zip(texts, langs, strict=True):
                found = enc.ngrams(text)
                if found is None or not names:
                    rows.append((UNDETERMINED, 0.0, None, 0 if found is None else len(found[0])))
                else:
                    cos = np.clip(matrix @ enc.bundle(*found).astype(np.float64), 0.0, 1.0)
                    k = int(np.argmax(cos))
                    rows.append((names[k], float(cos[k]), float(cos[at[lang]]) if lang in at else None, len(found[0])))
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "own", "grams"])
            yield out.astype({"own": "float64"})
        enc.clear()
        release()

    # else a filter and what stands above it would each evaluate it
    udf = F.pandas_udf(predict, "lang_pred string, score double, own double, grams long").asNondeterministic()
    return docs.withColumn(name, udf(F.col("text").cast("string"), F.col("lang").cast("string")))


def least_scores(seen: DataFrame, name: str = "_seen", *, share: float = 0.3, least: int = 5) -> list[float | None]:
    """By class of evidence (the whole part of log2 of the distinct n-grams) the least cosine of a text in a learned language.

    It is `share` of the median, to a thousandth, over all rows whose lang is the predicted one. A text's cosine grows
    with its distinct n-grams, whatever its length, so each class has its own bound; a class without such rows takes
    that of the next smaller one. Classes below `least` have none (null): their texts say too little to part a clean
    one from noise. seen comes from `weigh`; at most a thousand counts a class reach the driver.
    """
    s = F.col(name)
    agreed = seen.where((s["grams"] > 0) & (F.col("lang").cast("string") == s["lang_pred"]))
    cells = agreed.groupBy(evidence(s["grams"]).alias("cls"), F.round(s["score"] * 1000).cast("int").alias("cell")).agg(F.count("*").alias("n"))
    counts: dict[int, list[tuple[int, int]]] = {}
    for cls, cell, n in cells.collect():
        counts.setdefault(cls, []).append((cell, n))
    out: list[float | None] = []
    for cls in range(32):
        bound = out[-1] if out else None
        if cls >= least and cls in counts:
            left = sum(n for _, n in counts[cls]) / 2
            for cell, n in sorted(counts[cls]):
                left -= n
                if left <= 0:
                    bound = share * cell / 1000
                    break
        out.append(bound)
    return out


def evidence(grams):
    """The class of a text with so many distinct n-grams."""
    return F.least(F.floor(F.log2(F.greatest(grams, F.lit(1)))), F.lit(31)).cast("int")


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))
