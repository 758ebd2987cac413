"""Arms against arms: per fold on shared patients, and over many random splits against a measured noise floor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.operators.ordered import attach_quantiles, with_pooled

Metric = Callable[[DataFrame, Sequence[str]], DataFrame]


def read_arm(records: DataFrame, arm: str, objective: str) -> DataFrame:
    """One arm's record; a missing arm or another endpoint type is refused."""
    rows = records.where(F.col("arm") == arm)
    kinds = {r[0] for r in rows.select("endpoint_type").distinct().collect()}
    if kinds != {objective}:
        raise ValueError(f"arm {arm!r}: expected {objective}, found {sorted(kinds) or 'nothing'}")
    return rows


def one_objective(fields: DataFrame) -> str:
    """The objective that all compared endpoints share."""
    kinds = sorted(r[0] for r in fields.select("objective").distinct().collect())
    if len(kinds) != 1:
        raise ValueError(f"compared endpoints have several objectives: {', '.join(kinds)}")
    return kinds[0]


def common_patients(arms: DataFrame, keys: Sequence[str] = ("field", "patient_id")) -> DataFrame:
    """The rows of patients that every arm scored."""
    n_arms = arms.select("arm").distinct().count()
    shared = arms.select("arm", *keys).distinct().groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") == n_arms).drop("_n")
    return arms.join(shared, list(keys), "left_semi")


def arm_coverage(arms: DataFrame) -> DataFrame:
    """Patients by arm and field before the intersection, and the gap to the widest arm (C4)."""
    n = arms.groupBy("field", "arm").agg(F.count_distinct("patient_id").alias("n_patients"))
    return n.withColumn("gap", F.max("n_patients").over(Window.partitionBy("field")) - F.col("n_patients"))


def scores(arms: DataFrame, metric: Metric) -> DataFrame:
    """(arm, field, outer_fold, metric) by fold and pooled, on the common patients."""
    return metric(with_pooled(common_patients(arms)), ["arm", "field", "outer_fold"])


def compare_arms(arms: DataFrame, reference: str, metric: Metric) -> DataFrame:
    """Each arm's metric, the reference's and the difference, by fold and pooled."""
    table = scores(arms, metric)
    ref = table.where(F.col("arm") == reference).select("field", "outer_fold", F.col("metric").alias("reference_metric"))
    return table.join(ref, ["field", "outer_fold"], "left").withColumn("delta", F.col("metric") - F.col("reference_metric"))


# ---- trials over many splits: (arm, field, seed, rep, metric) ----


def complete_seeds(trials: DataFrame, reps: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """(field, seed) for which every arm has all reps."""
    n_arms = trials.select("field", "arm").distinct().groupBy("field").agg(F.count("*").alias("_arms"))
    per = trials.where(F.col("rep").isin(*reps)).select("field", "arm", "seed", "rep").distinct().groupBy("field", "seed", "arm").agg(F.count("*").alias("_reps"))
    full = per.where(F.col("_reps") == len(reps)).groupBy("field", "seed").agg(F.count("*").alias("_have"))
    return full.join(n_arms, "field").where(F.col("_have") == F.col("_arms")).select("field", "seed")


def seed_table(trials: DataFrame) -> DataFrame:
    """(field, arm, seed, m0, m1, m2): the metrics of a seed's reps, complete seeds only."""
    rows = trials.join(complete_seeds(trials), ["field", "seed"], "left_semi")
    m = lambda k: F.max(F.when(F.col("rep") == k, F.col("metric"))).alias(f"m{k}")
    return rows.groupBy("field", "arm", "seed").agg(m(0), m(1), m(2))


def real_deltas(trials: DataFrame, reference: str) -> DataFrame:
    """Rep 0 of each arm minus rep 0 of the reference, by seed."""
    t = seed_table(trials)
    ref = t.where(F.col("arm") == reference).select("field", "seed", F.col("m0").alias("_ref"))
    return t.where(F.col("arm") != reference).join(ref, ["field", "seed"]).select("field", "arm", "seed", (F.col("m0") - F.col("_ref")).alias("delta"))


def null_deltas(trials: DataFrame) -> DataFrame:
    """Rep 1 minus rep 2 of each arm, by seed: what differs by noise alone."""
    return seed_table(trials).select("field", "arm", "seed", (F.col("m1") - F.col("m2")).alias("delta"))


def margin(nulls: DataFrame, level: float = 0.95, by: Sequence[str] = ("field",)) -> DataFrame:
    """The level's quantile of absolute null differences, all arms pooled."""
    out = nulls.groupBy(*by).agg(F.stddev_samp("delta").alias("null_sd"), F.count("*").alias("n_null"))
    return attach_quantiles(out, nulls, by, {"_q": (F.abs("delta"), (level,))}).select(*by, F.col("_q")[0].alias("margin"), "null_sd", "n_null")


def summarize_arms(trials: DataFrame, reference: str, level: float = 0.95) -> DataFrame:
    """By arm: median, mean, sd, SEM, quartiles, shares beyond the margin, where the median lies among null differences,
    and the ratio of sds (C8)."""
    real, nulls = real_deltas(trials, reference), null_deltas(trials)
    m = margin(nulls, level)
    joined = real.join(m, "field")
    per = joined.groupBy("field", "arm").agg(
        F.avg("delta").alias("mean"),
        F.stddev_samp("delta").alias("sd"),
        F.count("*").alias("n_seeds"),
        F.avg((F.col("delta") > F.col("margin")).cast("double")).alias("share_above"),
        F.avg((F.col("delta") < -F.col("margin")).cast("double")).alias("share_below"),
        F.first("margin").alias("margin"),
        F.first("null_sd").alias("null_sd"),
    )
    per = attach_quantiles(per, joined, ["field", "arm"], {"_q": ("delta", (0.25, 0.5, 0.75))})
    per = per.select("field", "arm", "n_seeds", F.col("_q")[1].alias("median"), "mean", "sd", (F.col("sd") / F.sqrt("n_seeds")).alias("sem"), F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"), "share_above", "share_below", "margin", F.try_divide("sd", F.when(F.col("null_sd") != 0, F.col("null_sd"))).alias("sd_ratio"))
    below = nulls.select("field", F.col("delta").alias("_null")).join(per.select("field", "arm", "median"), "field")
    place = below.groupBy("field", "arm").agg(F.avg((F.col("_null") < F.col("median")).cast("double")).alias("null_percentile"))
    return per.join(place, ["field", "arm"])


def margin_convergence(trials: DataFrame, ks: Sequence[int], level: float = 0.95) -> DataFrame:
    """The margin over the first k seeds, for each distinct k of 2 or more."""
    nulls = null_deltas(trials)
    seeds = nulls.select("field", "seed").distinct().withColumn("_rank", F.row_number().over(Window.partitionBy("field").orderBy("seed")))
    each = F.explode(F.array(*[F.lit(k) for k in sorted({k for k in ks if k >= 2})]))
    rows = nulls.join(seeds, ["field", "seed"]).withColumn("k", each).where(F.col("_rank") <= F.col("k"))
    out = margin(rows, level, ["field", "k"])
    return out.select("field", "k", "margin", "n_null")


def absolute_metrics(trials: DataFrame) -> DataFrame:
    """Mean and sd of the metric by arm and rep."""
    return trials.groupBy("field", "arm", "rep").agg(F.avg("metric").alias("mean"), F.stddev_samp("metric").alias("sd"), F.count("*").alias("n"))


def trial_coverage(trials: DataFrame) -> DataFrame:
    """Declared and scored patients by arm over seeds at rep 0 (C11)."""
    return trials.where(F.col("rep") == 0).groupBy("field", "arm").agg(F.sum("n_declared").alias("n_declared"), F.sum("n_test").alias("n_scored"))


def metric_family(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(field, outer_fold, metric, value) of the metrics of one family, pooled rows left out."""
    return per_fold.where(F.col("outer_fold") >= 0).unpivot(["field", "outer_fold"], list(metrics), "metric", "value").where(F.col("value").isNotNull())
