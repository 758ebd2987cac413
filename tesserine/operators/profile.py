"""Cohort statistics: target cuts, fit-only state, coverage, and the summaries of an analysis report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.functions.metrics import pearson
from tesserine.operators.ordered import attach_quantiles, running_sums
from tesserine.plans.contract import Binning


def cuts(df: DataFrame, value: str, binning: Binning, by: Sequence[str] = ()) -> DataFrame:
    """(edges, n): exact linear-interpolated cut points."""
    rows = df.where(F.col(value).isNotNull())
    if binning.edges:
        return rows.groupBy(*by).agg(F.array(*[F.lit(float(e)) for e in binning.edges]).alias("edges"), F.count("*").alias("n"))
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"))
    return attach_quantiles(counts, rows, by, {"edges": (value, binning.probabilities())}).select(*by, "edges", "n")


def field_coverage(valid: DataFrame) -> DataFrame:
    """Usable patients by field."""
    return valid.groupBy("field").agg(F.count_distinct("patient_id").alias("n_patients"))


def fit_moments(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean and population SD of the fit split: (0, 1) below two values, SD 0 counts as 1."""
    n = F.count(value)
    return df.groupBy(*by).agg(
        F.when(n < 2, 0.0).otherwise(F.avg(value)).alias("mean"),
        F.when((n < 2) | (F.stddev_pop(value) == 0), 1.0).otherwise(F.stddev_pop(value)).alias("std"),
        n.alias("n"),
    )


def pos_weight(df: DataFrame, by: Sequence[str], label: str = "label") -> DataFrame:
    """Negatives over positives of the fit split, 1 if a class is absent."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.groupBy(*by).agg(F.when((pos > 0) & (neg > 0), neg / F.greatest(pos, F.lit(1))).otherwise(1.0).alias("pos_weight"))


def balanced_weights(df: DataFrame, classes: int, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """n / (K n_c) for each class, 1 for an absent one."""
    counts = [F.count_if(F.col(label) == c).alias(f"_{c}") for c in range(classes)]
    one = df.where(F.col(label) >= 0).groupBy(*by).agg(*counts, F.count("*").alias("_n"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"_{c}").alias("n")) for c in range(classes)]))
    return one.select(*by, "_n", pairs.alias("_p")).select(*by, F.col("_p.class"), F.col("_p.n"), F.when(F.col("_p.n") > 0, F.col("_n") / (classes * F.greatest(F.col("_p.n"), F.lit(1)))).otherwise(1.0).alias("weight"))


def time_bins(df: DataFrame, bins: int, by: Sequence[str], time: str = "time", event: str = "event") -> DataFrame:
    """Interior edges of time bins: quantiles of event times, or of all times where events are too few."""
    probs = [j / bins for j in range(1, bins)]
    counts = df.groupBy(*by).agg(F.count_if(F.col(event) == 1).alias("n_events"))
    out = attach_quantiles(counts, df, by, {"_events": (F.when(F.col(event) == 1, F.col(time)), probs), "_all": (time, probs)})
    return out.select(*by, F.array_distinct(F.when(F.col("n_events") >= bins, F.col("_events")).otherwise(F.col("_all"))).alias("edges"), "n_events")


def gene_state(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population SD and variance of log1p by gene, missing skipped, two patients at least."""
    x = F.log1p(F.col("value"))
    out = long.where(F.col("value").isNotNull()).groupBy(*by, "gene_id").agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.var_pop(x).alias("variance"), F.count("*").alias("n"))
    return out.where("n >= 2")


def matrix_summary(long: DataFrame) -> DataFrame:
    """Patients, genes and the mean over genes of the mean log1p."""
    genes = long.groupBy("gene_id").agg(F.avg(F.log1p("value")).alias("m"))
    a = genes.agg(F.count("*").alias("n_genes"), F.avg("m").alias("mean_log1p"))
    return a.withColumn("n_patients", F.lit(long.select("patient_id").distinct().count()))


def slides_per_patient(slides: DataFrame, skew: float = 5.0) -> DataFrame:
    """Mean, median, least and most slides a patient, flagged where the most is `skew` times the mean."""
    n = slides.groupBy("patient_id").agg(F.count("*").alias("n"))
    out = n.agg(F.avg("n").alias("mean"), F.min("n").alias("min"), F.max("n").alias("max"), (F.max("n") >= skew * F.avg("n")).alias("skewed"))
    return attach_quantiles(out, n, (), {"_q": ("n", (0.5,))}).select("mean", F.col("_q")[0].alias("median"), "min", "max", "skewed")


def class_counts(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares by class; the excluded class is -1, missing is null."""
    n = df.groupBy(*by, label).agg(F.count("*").alias("n"))
    total = n.groupBy(*by).agg(F.sum(F.when(F.col(label) >= 0, F.col("n"))).alias("_t"))
    joined = n.join(total, list(by)) if by else n.join(F.broadcast(total))
    return joined.select(*by, label, "n", F.when(F.col(label) >= 0, 100.0 * F.col("n") / F.col("_t")).alias("percent"))


def imbalance(df: DataFrame, label: str = "label", by: Sequence[str] = (), ratio: float = 3.0) -> DataFrame:
    """Largest over smallest class that occurs, flagged from `ratio` on."""
    n = df.where(F.col(label) >= 0).groupBy(*by, label).agg(F.count("*").alias("n"))
    return n.groupBy(*by).agg((F.max("n") / F.min("n")).alias("ratio"), (F.max("n") >= ratio * F.min("n")).alias("imbalanced"))


def continuous_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """n, median, quartiles, range and missing."""
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.count_if(F.col(value).isNull()).alias("missing"))
    out = attach_quantiles(out, df, by, {"_q": (value, (0.25, 0.5, 0.75))})
    return out.select(*by, "n", F.col("_q")[1].alias("median"), F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"), "min", "max", "missing")


def survival_summary(df: DataFrame, by: Sequence[str] = (), time: str = "time", event: str = "event") -> DataFrame:
    """Events, censored, follow-up quartiles and the median time to event."""
    out = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(event) == 1).alias("events"),
        F.count_if(F.col(event) == 0).alias("censored"),
    )
    out = attach_quantiles(out, df, by, {"_q": (time, (0.25, 0.5, 0.75)), "_e": (F.when(F.col(event) == 1, F.col(time)), (0.5,))})
    return out.select(*by, "n", "events", "censored", *[F.col("_q")[k].alias(f"q{k + 1}") for k in range(3)], F.col("_e")[0].alias("median_event_time"))


def fold_balance(split: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Classes of the test patients of each outer fold."""
    test = split.where(F.col("category") == "test").select("field", "outer_fold", "patient_id").distinct()
    return test.join(labels, ["field", "patient_id"]).groupBy("field", "outer_fold", label).agg(F.count("*").alias("n"))


def split_composition(split: DataFrame) -> DataFrame:
    """Counts by category of one version of each outer fold."""
    first = split.groupBy("field", "outer_fold").agg(F.min("split_version").alias("split_version"))
    return split.join(first, ["field", "outer_fold", "split_version"]).groupBy("field", "outer_fold", "category").agg(F.count("*").alias("n"))


def geometry_summary(slides: DataFrame) -> DataFrame:
    """Slides, those without geometry, those with a mask, and megapixels."""
    return slides.agg(
        F.count("*").alias("n_slides"),
        F.count_if(F.col("width").isNull() | F.col("height").isNull()).alias("missing_geometry"),
        F.count_if(F.col("mask_path").isNotNull()).alias("with_mask"),
        F.avg(F.col("width") * F.col("height") / 1e6).alias("mean_megapixels"),
    )


def tile_counts(tiles: DataFrame, key: str = "slide_id") -> DataFrame:
    """Tiles by slide: reads the key column alone."""
    return tiles.groupBy(key).agg(F.count("*").alias("n_tiles"))


def tile_distribution(counts: DataFrame) -> DataFrame:
    """n, total, mean, range and percentiles of tiles a slide, with the spread p75 / max(p25, 1)."""
    out = counts.agg(
        F.count("*").alias("n"), F.sum("n_tiles").alias("total"), F.avg("n_tiles").alias("mean"), F.min("n_tiles").alias("min"), F.max("n_tiles").alias("max")
    )
    out = attach_quantiles(out, counts, (), {"_q": ("n_tiles", (0.05, 0.25, 0.5, 0.75, 0.95))})
    q = [F.col("_q")[k].alias(name) for k, name in enumerate(("p5", "p25", "median", "p75", "p95"))]
    return out.select("n", "total", "mean", "min", "max", *q, (F.col("_q")[3] / F.greatest(F.col("_q")[1], F.lit(1.0))).alias("spread"))


def padding_cost(counts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """For each bag size: padded slides and their share, mean copies of a padded slide's tiles, tiles covered."""
    rows = counts.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    small = F.col("n_tiles") < F.col("size")
    return rows.groupBy("size").agg(
        F.count_if(small).alias("n_padded"),
        F.avg(small.cast("double")).alias("share_padded"),
        F.avg(F.when(small, F.col("size") / F.col("n_tiles"))).alias("mean_copies"),
        (F.sum(F.least("n_tiles", "size")) / F.sum("n_tiles")).alias("coverage"),
    )


def recommend_bag(counts: DataFrame, ladder: Sequence[int], most_spread: float = 10.0) -> DataFrame:
    """The largest ladder size up to the 25th percentile, else the smallest; null where the spread is too wide."""
    d = tile_distribution(counts)
    fits = F.array_max(F.filter(F.array(*[F.lit(s) for s in sorted(ladder)]), lambda s: s <= F.col("p25")))
    return d.select("p25", "spread", F.when(F.col("spread") <= most_spread, F.coalesce(fits, F.lit(min(ladder)))).alias("num_tiles"))


def retained(counts: DataFrame) -> DataFrame:
    """The share of slides with at least as many tiles, at each count."""
    per = counts.groupBy("n_tiles").agg(F.count("*").alias("n"))
    total = counts.count()
    return running_sums(per.withColumn("_k", F.lit(0)), ["_k"], "n_tiles", ["n"], descending=True).select("n_tiles", (F.col("cum_n") / F.lit(total)).alias("retained"))


def regression_context(df: DataFrame, by: Sequence[str] = (), pred: str = "pred", label: str = "label") -> DataFrame:
    """Range over labels and predictions, median absolute error, Pearson and the labels' SD."""
    out = df.groupBy(*by).agg(
        F.least(F.min(label), F.min(pred)).alias("low"),
        F.greatest(F.max(label), F.max(pred)).alias("high"),
        pearson(pred, label).alias("pearson"),
        F.stddev_pop(label).alias("label_sd"),
    )
    out = attach_quantiles(out, df, by, {"_q": (F.abs(F.col(pred) - F.col(label)), (0.5,))})
    return out.select(*by, "low", "high", F.col("_q")[0].alias("median_abs_error"), "pearson", "label_sd")
