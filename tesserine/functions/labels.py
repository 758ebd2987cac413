"""Column expressions: raw labels to targets, head activations, split names and digests."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EXCLUDED = -1  # class of a value that takes no part in an endpoint


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(raw: Column | str) -> Column:
    """A raw string as a double; null if it is no finite number (P5)."""
    x = F.expr("null").cast("double") if raw is None else col(raw).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def clean(raw: Column | str) -> Column:
    """Trimmed; the words nan and none, in either case, and empty text are null."""
    x = F.trim(col(raw))
    return F.when(F.lower(x).isin("nan", "none", ""), None).otherwise(x)


def categorical(raw: Column | str, mapping: Mapping[str, int]) -> Column:
    """The mapped class; values out of the map are excluded."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(col(raw), F.lit(""))), F.lit(EXCLUDED)).cast("int")


def binarize(x: Column | str, cut: Column | float) -> Column:
    """1 from the cut on, 0 below; missing is excluded."""
    return F.when(col(x).isNull(), EXCLUDED).otherwise((col(x) >= cut).cast("int"))


def discretize(x: Column | str, edges: Column | Sequence[float]) -> Column:
    """The number of edges at or below the value: a value on a cut goes up."""
    e = edges if isinstance(edges, Column) else F.array(*[F.lit(float(v)) for v in edges])
    return F.when(col(x).isNull(), EXCLUDED).otherwise(F.size(F.filter(e, lambda v: v <= col(x))))


def survival_bin(time: Column | str, edges: Column | Sequence[float]) -> Column:
    """The number of edges strictly below the time: a time on an edge stays in the lower bin."""
    e = edges if isinstance(edges, Column) else F.array(*[F.lit(float(v)) for v in edges])
    return F.when(col(time).isNotNull(), F.size(F.filter(e, lambda v: v < col(time))))


def log1p(x: Column | str) -> Column:
    """log(1 + x); a value of -1 or less is an error."""
    return F.when(col(x) <= -1, F.raise_error(F.lit("log1p of a value of -1 or less")).cast("double")).otherwise(F.log1p(col(x)))


def reader_or(raw: Column | str, default: str) -> Column:
    """The row's own reader in upper case, else the default."""
    return F.coalesce(F.upper(clean(raw)), F.lit(default))


def censor(time: Column | str, event: Column | str, horizon: float) -> tuple[Column, Column]:
    """(time, event) with follow-up ended at the horizon (P10)."""
    late = col(time) > horizon
    return F.when(late, F.lit(float(horizon))).otherwise(col(time)), F.when(late, 0).otherwise(col(event))


def standardize(x: Column, mean: Column, std: Column) -> Column:
    """(log1p(x) - mean) / std, where a std of 0 counts as 1; missing stays missing."""
    return (log1p(x) - mean) / F.when(std > 0, std).otherwise(1.0)


def unstandardize(x: Column, mean: Column, std: Column) -> Column:
    """A prediction back in the label's units."""
    return x * std + mean


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-col(x)))


def softmax(logits: Column | str) -> Column:
    top = F.array_max(col(logits))
    e = F.transform(col(logits), lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return F.transform(e, lambda v: v / total)


def hazards(logits: Column | str) -> Column:
    """The probability of the event in each bin, given survival up to it (M8)."""
    return F.transform(col(logits), lambda v: 1.0 / (1.0 + F.exp(-v)))


def survival(hazard: Column) -> Column:
    """The running product of 1 - hazard (M8)."""
    start = F.struct(F.lit(1.0).alias("s"), F.array().cast("array<double>").alias("out"))
    step = lambda a, h: F.struct((a["s"] * (1.0 - h)).alias("s"), F.array_append(a["out"], a["s"] * (1.0 - h)).alias("out"))
    return F.aggregate(hazard, start, step, lambda a: a["out"])


def survival_risk(logits: Column | str) -> Column:
    """Minus the sum of the survival curve: more is sooner (M9)."""
    return -F.aggregate(survival(hazards(logits)), F.lit(0.0), lambda a, v: a + v)


def argmax(probs: Column | str) -> Column:
    """The first position of the largest value."""
    return (F.array_position(col(probs), F.array_max(col(probs))) - 1).cast("int")


ACTIVATIONS = {
    "binary": sigmoid,
    "multiclass": softmax,
    "regression": col,
    "regression_vector": col,
    "survival": survival_risk,
}


def bin_ranges(edges: Sequence[float]) -> Column:
    """Labels of the bins between whole-numbered edges: 0-e1, e1-e2, ..., en+."""
    lows = [0, *map(int, edges)]
    return F.array(*[F.lit(f"{a}-{b}") for a, b in zip(lows, lows[1:], strict=False)], F.lit(f"{lows[-1]}+"))


def split_name(field: Column | str, outer: Column, inner: Column) -> Column:
    return F.format_string("%s_cv_o%d_i%d", col(field), outer, inner)


def split_parts(version: Column | str) -> dict[str, Column]:
    """field, strategy, outer and inner of a split version's name."""
    v = col(version)
    cv = r"^(.*)_cv_o(\d+)_i(\d+)$"
    whole = F.regexp_extract(v, cv, 1)
    part = lambda k: F.when(v.rlike(cv), F.regexp_extract(v, cv, k).cast("int"))
    return {
        "field": F.when(v.rlike(cv), whole).when(v.startswith("all_test_"), F.substring(v, 10, 10_000)),
        "strategy": F.when(v.rlike(cv), "nested_cv").when(v.startswith("all_test_"), "all_test").when(v == "all_predict", "all_predict"),
        "outer_fold": part(2),
        "inner_fold": part(3),
    }


def fold_parts(fold: Column | str, n_outer: int, n_inner: int) -> tuple[Column, Column]:
    """(outer, inner) of a flat fold number; null out of range."""
    f = col(fold)
    inside = (f >= 0) & (f < n_outer * n_inner)
    return F.when(inside, F.floor(f / n_inner).cast("int")), F.when(inside, F.pmod(f, F.lit(n_inner)).cast("int"))


def train_seed(arm: Column, seed: Column, rep: Column) -> Column:
    """A training seed below 2**31 - 1 from the identity of a trial."""
    text = F.concat_ws("|", arm, seed.cast("string"), rep.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long"), F.lit(2**31 - 1))


def train_seed_of(arm: str, seed: int, rep: int) -> int:
    """The same training seed, on the driver."""
    return int(hashlib.sha256(f"{arm}|{seed}|{rep}".encode()).hexdigest()[:12], 16) % (2**31 - 1)


def fold_order(seed: int, patient: Column) -> Column:
    """The text that deals patients at random: the same in any engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), patient.cast("string")))
