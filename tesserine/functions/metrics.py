"""Metrics of predictions by any grouping. An undefined metric is null, never 0."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserine.functions.labels import argmax
from tesserine.operators.ordered import attach_quantiles, row_numbers, running_min_above, running_sums
from tesserine.sources import sinks

#: At and above it a probability counts as positive.
CUT = 0.5


def _ratio(a, b) -> Column:
    return F.try_divide(a, F.when(b != 0, b))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation as an aggregate; null, not an error, where a side doesn't vary."""
    sd = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.when(sd > 0, sd))


def _beside(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two metric tables side by side; without a grouping each is one row."""
    return a.join(b, list(by), "left") if by else a.join(F.broadcast(b))


def _collapsed(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """One row a distinct score: its positives and negatives."""
    return df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )


def auroc(df: DataFrame, by: Sequence[str], score: str = "prob", label: str = "label") -> DataFrame:
    """Area under the ROC curve, half credit for ties; null with one class (M1)."""
    return _area(_collapsed(df, by, score, label), by, score)


def _area(scores: DataFrame, by: Sequence[str], score: str) -> DataFrame:
    c = running_sums(scores, by, score, ["neg"])
    area = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    return c.groupBy(*by).agg(_ratio(area, F.sum("pos") * F.sum("neg")).alias("auroc"))


def average_precision(df: DataFrame, by: Sequence[str], score: str = "prob", label: str = "label") -> DataFrame:
    """Sum of recall steps times precision over distinct thresholds, from the highest (M2)."""
    c = running_sums(_collapsed(df, by, score, label), by, score, ["pos", "neg"], descending=True)
    step = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return c.groupBy(*by).agg(_ratio(F.sum(step), F.sum("pos")).alias("average_precision"))


def confusion(df: DataFrame, by: Sequence[str], score: str = "prob", label: str = "label") -> DataFrame:
    """Counts and rates at the cut."""
    hit, true = F.col(score) >= CUT, F.col(label) == 1
    c = df.where(F.col(label).isin(0, 1)).groupBy(*by).agg(
        F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & ~true).alias("tn"), F.count_if(~hit & true).alias("fn")
    )
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    sens, spec = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    return c.select(
        *by,
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"),
        (F.col("tp") + F.col("fn")).alias("n_positive"),
        _ratio(tp + tn, n).alias("accuracy"),
        ((sens + spec) / 2).alias("balanced_accuracy"),
        sens.alias("sensitivity"),
        spec.alias("specificity"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tn, tn + fn).alias("npv"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        _ratio((tp + tn) / n - chance, 1 - chance).alias("kappa"),
    )


def binary_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """All binary metrics, a row a group."""
    return _beside(_beside(confusion(df, by), auroc(df, by), by), average_precision(df, by), by)


def _alike(df: DataFrame, by: Sequence[str], probs: str, label: str) -> DataFrame:
    """(by, _y, _probs, _p, _n): how many labelled rows of a group are equal, with their argmax. Written once into the shared folder, as
    several metrics read it."""
    rows = df.where(F.col(label) >= 0).groupBy(*by, F.col(label).alias("_y"), F.col(probs).alias("_probs")).agg(F.count("*").alias("_n"))
    path = sinks.fresh(df.sparkSession, "alike")
    rows.withColumn("_p", argmax("_probs")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _per_class(alike: DataFrame, by: Sequence[str], classes: int | None) -> DataFrame:
    each = alike.select(*by, "_n", "_y", "_p", F.posexplode("_probs").alias("class", "_score"))
    each = each if classes is None else each.where(F.col("class") < classes)
    is_true, is_said = F.col("_y") == F.col("class"), F.col("_p") == F.col("class")
    n = lambda hit: F.sum(F.when(hit, F.col("_n")).otherwise(0))
    keys = [*by, "class"]
    scores = each.groupBy(*keys, "_score").agg(n(is_true).alias("pos"), n(~is_true).alias("neg"), n(is_true & is_said).alias("tp"), n(is_said).alias("said"))
    tp, said, real = (F.sum(c) for c in ("tp", "said", "pos"))
    tp = tp.cast("double")
    counts = scores.groupBy(*keys).agg(real.alias("support"), _ratio(tp, said).alias("precision"), _ratio(tp, real).alias("recall"), _ratio(2 * tp, real + said).alias("f1"))
    # a missing score counts for precision and recall only
    return counts.join(_area(scores.where(F.col("_score").isNotNull()), keys, "_score"), keys, "left")


def multiclass_per_class(df: DataFrame, by: Sequence[str], classes: int | None = None, probs: str = "probs", label: str = "label") -> DataFrame:
    """Support, one-vs-rest AUROC, precision, recall and F1 of each class: of the first `classes`, or of all (M4)."""
    return _per_class(_alike(df, by, probs, label), by, classes)


def multiclass_metrics(df: DataFrame, by: Sequence[str], classes: int | None = None, probs: str = "probs", label: str = "label") -> DataFrame:
    """Macro AUROC, accuracy, balanced accuracy over supported classes and macro F1; undefined classes are skipped (M5)."""
    alike = _alike(df, by, probs, label)
    macro = _per_class(alike, by, classes).groupBy(*by).agg(
        F.avg("auroc").alias("macro_auroc"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg(F.when(F.col("support") > 0, F.coalesce("f1", F.lit(0.0)))).alias("macro_f1"),
    )
    known = F.when(F.col("_p").isNotNull(), F.col("_n"))
    hit = alike.groupBy(*by).agg(_ratio(F.sum(F.when(F.col("_y") == F.col("_p"), F.col("_n")).otherwise(0)), F.sum(known)).alias("accuracy"), F.sum("_n").alias("n"))
    return _beside(_beside(hit, macro, by), _kappa(alike, by), by)


def quadratic_kappa(df: DataFrame, by: Sequence[str], probs: str = "probs", label: str = "label") -> DataFrame:
    """Quadratic-weighted kappa from moments: no class grid is needed (M6)."""
    rows = df.where(F.col(label) >= 0)
    return _kappa(rows.groupBy(*by, F.col(label).alias("_y"), argmax(probs).alias("_p")).agg(F.count("*").alias("_n")), by)


def _kappa(said: DataFrame, by: Sequence[str]) -> DataFrame:
    y, p, n = F.col("_y").cast("double"), F.col("_p").cast("double"), F.col("_n")
    mean = lambda x: _ratio(F.sum(x * n), F.sum(F.when(x.isNotNull(), n)))
    seen = mean((y - p) * (y - p))
    chance = mean(y * y) - 2 * mean(y) * mean(p) + mean(p * p)
    return said.groupBy(*by).agg((1 - _ratio(seen, F.when(F.abs(chance) > 1e-12, chance))).alias("quadratic_kappa"))


def confusion_matrix(df: DataFrame, by: Sequence[str], classes: int, probs: str = "probs", label: str = "label") -> DataFrame:
    """Counts over the class grid, with each true class's shares."""
    seen = df.where(F.col(label) >= 0).groupBy(*by, F.col(label).alias("true"), argmax(probs).alias("pred")).agg(F.count("*").alias("n"))
    axis = F.sequence(F.lit(0), F.lit(classes - 1))
    grid = seen.select(*by).distinct().withColumn("true", F.explode(axis)).withColumn("pred", F.explode(axis))
    full = grid.join(seen, [*by, "true", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return full.withColumn("share", F.coalesce(_ratio(F.col("n"), F.sum("n").over(Window.partitionBy(*by, "true"))), F.lit(0.0)))


def spearman(df: DataFrame, by: Sequence[str], x: str, y: str, tie: str) -> DataFrame:
    """Correlation of ordinal ranks, ties by id; null where a side is constant."""
    ranked = row_numbers(row_numbers(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), by, x, tie, "_rx"), by, y, tie, "_ry")
    flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    return ranked.groupBy(*by).agg(F.when(~flat, pearson(F.col("_rx").cast("double"), F.col("_ry").cast("double"))).alias("spearman"))


def regression_metrics(df: DataFrame, by: Sequence[str], pred: str = "pred", label: str = "label", tie: str = "patient_id") -> DataFrame:
    """MAE, RMSE, R2, Pearson, Spearman (M7) and the slope and intercept of prediction on label."""
    rows = df.where(F.col(label).isNotNull() & ~F.isnan(label) & F.col(pred).isNotNull())
    e = F.col(pred) - F.col(label)
    flat = (F.min(pred) == F.max(pred)) | (F.min(label) == F.max(label))
    slope = F.when(F.min(label) != F.max(label), _ratio(F.covar_pop(pred, label), F.var_pop(label)))
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(F.min(label) != F.max(label), 1 - _ratio(F.avg(e * e), F.var_pop(label))).alias("r2"),
        F.when(~flat, pearson(pred, label)).alias("pearson"),
        slope.alias("slope"),
        (F.avg(pred) - slope * F.avg(label)).alias("intercept"),
    )
    return _beside(out, spearman(rows, by, pred, label, tie), by)


# ---- survival ----


def _ahead(time: np.ndarray, event: np.ndarray, risk: np.ndarray) -> tuple[float, float]:
    """(concordant, comparable) pairs: i before j in time, with an event at i. O(n log n).

    Two times first differ at one bit of their ranks. For each bit, the rows with equal higher bits are sorted by risk,
    and those with the bit set that come before each one without it are counted.
    """
    t, r = np.unique(time, return_inverse=True)[1], np.unique(risk, return_inverse=True)[1]
    hit = np.asarray(event) == 1
    pairs = float((len(t) - np.searchsorted(np.sort(t), t[hit], "right")).sum())
    good = 0.0
    for bit in range(int(t.max(initial=0)).bit_length()):
        order = np.lexsort((r, t >> (bit + 1)))
        above, risks, late = (t >> (bit + 1))[order], r[order], (t >> bit)[order] & 1
        seen = np.concatenate(([0], np.cumsum(late)))
        group = np.searchsorted(above, above, "left")
        new = np.concatenate(([True], (above[1:] != above[:-1]) | (risks[1:] != risks[:-1])))
        first = np.flatnonzero(new)
        low, high = first[np.cumsum(new) - 1], np.append(first[1:], len(order))[np.cumsum(new) - 1]
        asks = (late == 0) & hit[order]
        below, equal = seen[low] - seen[group], seen[high] - seen[low]
        good += float((below[asks] + equal[asks] / 2).sum())
    return good, pairs


BLOCK_ROWS, CUTS = 20_000, 1024


def _blocks(rows: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """rows with the block of a column's value: groups of more than BLOCK_ROWS rows are cut at about even quantiles."""
    grid = [k / CUTS for k in range(1, CUTS)]
    cuts = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx(column, grid, 5 * CUTS).alias("_q"))
    parts = F.least(F.ceil(F.col("_n") / BLOCK_ROWS), F.lit(CUTS)).cast("int")
    few = F.when(parts > 1, F.transform(F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))), lambda k: F.element_at("_q", F.floor(k * CUTS / parts).cast("int")))).otherwise(F.array().cast("array<double>"))
    cuts = cuts.select(*by, few.alias("_cuts"))
    held = rows.join(cuts, list(by)) if by else rows.join(F.broadcast(cuts))  # without a grouping one row
    # binary search: the number of cuts at or below the value
    at = F.aggregate(
        F.array(*[F.lit(1 << k) for k in range(CUTS.bit_length() - 1, -1, -1)]),
        F.lit(0),
        lambda k, step: F.when((k + step <= F.size("_cuts")) & (F.get("_cuts", k + step - 1) <= F.col(column)), k + step).otherwise(k),
    )
    return held.withColumn(name, F.when(F.size("_cuts") == 0, F.lit(0)).otherwise(at)).drop("_cuts")


def concordance(df: DataFrame, by: Sequence[str], time: str = "time", event: str = "event", risk: str = "risk") -> DataFrame:
    """Harrell's C: a pair counts if the earlier time has an event; equal risks count half; null without pairs.

    Pairs are split three ways: in one time block; in one risk block but different time blocks; and the rest, which the
    counts of the cells of both decide. Blocks hold about BLOCK_ROWS rows (with as many as tie), so no task holds a large group; a
    group has at most CUTS blocks a side.
    """
    rows = df.where(F.col(time).isNotNull() & F.col(risk).isNotNull()).select(
        *by, F.col(time).cast("double").alias("t"), F.col(event).cast("int").alias("e"), F.col(risk).cast("double").alias("r")
    )
    rows = _blocks(_blocks(rows, by, "t", "tb"), by, "r", "rb")
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by)
    counts = f"{schema}{', ' if by else ''}good double, pairs double"

    def inside(block_time: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            t = pdf["t"].to_numpy() if block_time else pdf["tb"].to_numpy(float)
            good, pairs = _ahead(t, pdf["e"].to_numpy(), pdf["r"].to_numpy())
            return pd.DataFrame([[*pdf[list(by)].iloc[0], good, pairs if block_time else 0.0]], columns=[*by, "good", "pairs"])

        return run

    def between(pdf: pd.DataFrame) -> pd.DataFrame:
        ts, rs = np.unique(pdf["tb"], return_inverse=True)[1], np.unique(pdf["rb"], return_inverse=True)[1]
        n, ev = np.zeros((ts.max() + 1, rs.max() + 1)), np.zeros((ts.max() + 1, rs.max() + 1))
        np.add.at(n, (ts, rs), pdf["n"])
        np.add.at(ev, (ts, rs), pdf["ev"])
        later = n[::-1].cumsum(0)[::-1] - n  # in later blocks, by cell
        lower = later.cumsum(1) - later  # of these in lower cells
        return pd.DataFrame([[*pdf[list(by)].iloc[0], float((ev * lower).sum()), float((ev * later.sum(1, keepdims=True)).sum())]], columns=[*by, "good", "pairs"])

    cells = rows.groupBy(*by, "tb", "rb").agg(F.count("*").alias("n"), F.sum("e").alias("ev"))
    parts = (
        rows.groupBy(*by, "tb").applyInPandas(inside(True), counts)
        .unionByName(rows.groupBy(*by, "rb").applyInPandas(inside(False), counts))
        .unionByName(cells.groupBy(*by).applyInPandas(between, counts))
    )
    return parts.groupBy(*by).agg(_ratio(F.sum("good"), F.sum("pairs")).alias("c_index"))


def kaplan_meier(df: DataFrame, by: Sequence[str], time: str = "time", event: str = "event") -> DataFrame:
    """A step a distinct time: at risk, events, survival; the curve starts at (0, 1).

    The product of the steps is a running sum of their logarithms, until a step at which all at risk have an event."""
    steps = df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("time")).agg(F.count("*").alias("n"), F.sum(F.col(event).cast("long")).alias("events"))
    at_risk = running_sums(steps, by, "time", ["n"], descending=True)
    left = 1 - F.col("events") / F.col("cum_n")
    logs = at_risk.withColumn("log", F.when(left > 0, F.log(left)).otherwise(0.0)).withColumn("end", (left <= 0).cast("int"))
    summed = running_sums(logs, by, "time", ["log", "end"])
    curve = summed.select(*by, "time", F.col("cum_n").alias("at_risk"), "events", F.when(F.col("cum_end") > 0, 0.0).otherwise(F.exp("cum_log")).alias("survival"))
    start = steps.groupBy(*by).agg(F.sum("n").alias("at_risk")).select(*by, F.lit(0.0).alias("time"), "at_risk", F.lit(0).cast("long").alias("events"), F.lit(1.0).alias("survival"))
    return start.unionByName(curve)


def km_by_risk(df: DataFrame, by: Sequence[str], time: str = "time", event: str = "event", risk: str = "risk") -> DataFrame:
    """Kaplan-Meier below and from the median risk on."""
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    median = attach_quantiles(counts, df, by, {"_q": (risk, (0.5,))}).select(*by, F.col("_q")[0].alias("_median"))
    halves = df.join(median, list(by)) if by else df.crossJoin(F.broadcast(median))  # without a grouping one row
    return kaplan_meier(halves.withColumn("risk_group", F.when(F.col(risk) >= F.col("_median"), "high").otherwise("low")), [*by, "risk_group"], time, event)


# ---- genes, in long form (gene_id, patient_id, pred, label) ----


def gene_pearson(df: DataFrame, by: Sequence[str] = ("gene_id",)) -> DataFrame:
    """Pearson per gene over patients; null where a side is constant."""
    rows = df.where(F.col("pred").isNotNull() & F.col("label").isNotNull())
    flat = (F.min("pred") == F.max("pred")) | (F.min("label") == F.max("label"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.when(~flat, pearson("pred", "label")).alias("pearson"), F.sqrt(F.avg((F.col("pred") - F.col("label")) ** 2)).alias("rmse"))


def gene_spearman(df: DataFrame, by: Sequence[str] = ("gene_id",)) -> DataFrame:
    """Spearman per gene."""
    return spearman(df, by, "pred", "label", "patient_id")


def gene_summary(per_gene: DataFrame, by: Sequence[str] = (), top: int = 100) -> DataFrame:
    """Mean Pearson, mean of the best `top`, median Spearman, genes scored and in all."""
    ranked = row_numbers(per_gene.withColumn("_key", F.lit(0)), [*by, "_key"], "pearson", "gene_id", "_rank", descending=True)
    best = (F.col("_rank") <= top) & F.col("pearson").isNotNull()
    out = ranked.groupBy(*by).agg(
        F.avg("pearson").alias("mean_pearson"),
        F.avg(F.when(best, F.col("pearson"))).alias("top_mean_pearson"),
        F.count("pearson").alias("n_scored"),
        F.count("*").alias("n_genes"),
    )
    out = attach_quantiles(out, ranked, by, {"_q": ("spearman", (0.5,))})
    return out.select(*by, "mean_pearson", "top_mean_pearson", F.col("_q")[0].alias("median_spearman"), "n_scored", "n_genes")


@F.pandas_udf(T.DoubleType())
def erfc(x: pd.Series) -> pd.Series:
    """The complementary error function."""
    from math import erfc as f

    return x.map(lambda v: None if v is None or v != v else f(v)).astype("float64")


def fisher_z(r: Column, n: Column) -> Column:
    """The size of Fisher's z of a correlation, in standard deviations."""
    inside = F.greatest(F.lit(-0.999999), F.least(F.lit(0.999999), r))
    return F.abs(F.atanh(inside)) * F.sqrt(F.greatest(n - 3, F.lit(0)))


def fisher_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation by Fisher's z."""
    return erfc(fisher_z(r, n) / F.sqrt(F.lit(2.0)))


def benjamini_hochberg(df: DataFrame, by: Sequence[str], p: str, tie: str, statistic: str | None = None) -> DataFrame:
    """df with rank, m and q_value: the step-up adjustment over each group's defined p-values.

    A statistic that falls as p grows gives the ranks where it is named: far tails, of which p is 0 to a double, keep their order."""
    keys = [*by, "_key"]
    rows = df.where(F.col(p).isNotNull()).withColumn("_key", F.lit(0))
    ranked = row_numbers(rows, keys, statistic or p, tie, "rank", descending=statistic is not None)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("m"))
    out = ranked.join(sizes, keys).withColumn("_raw", F.col(p) * F.col("m") / F.col("rank"))
    out = running_min_above(out, keys, "rank", "_raw", "_least")
    return out.withColumn("q_value", F.least(F.lit(1.0), F.col("_least"))).drop("_raw", "_key", "_least")


def significant_genes(per_gene: DataFrame, by: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """The number of genes whose Fisher p passes the step-up test."""
    p = per_gene.withColumn("p_value", fisher_p(F.col("pearson"), F.col("n")))
    q = benjamini_hochberg(p, by, "p_value", "gene_id")
    return q.groupBy(*by).agg(F.count_if(F.col("p_value") <= alpha * F.col("rank") / F.col("m")).alias("_k"), F.max(F.when(F.col("p_value") <= alpha * F.col("rank") / F.col("m"), F.col("rank"))).alias("n_significant")).drop("_k").fillna(0, ["n_significant"])


def williams_t(r12: Column, r13: Column, r23: Column, n: Column) -> Column:
    """Williams' t of two correlations that share a variable, n - 3 degrees of freedom."""
    det = 1 - r12 * r12 - r13 * r13 - r23 * r23 + 2 * r12 * r13 * r23
    mean = (r12 + r13) / 2
    below = 2 * det * (n - 1) / (n - 3) + mean * mean * (1 - r23) ** 3
    return (r12 - r13) * F.sqrt(_ratio((n - 1) * (1 + r23), F.when(below > 0, below)))


def beats_random(trained: DataFrame, random: DataFrame, by: Sequence[str] = (), alpha: float = 0.05, fdr: float = 0.2) -> DataFrame:
    """Genes that a trained model predicts better than a random one.

    beats: the trained correlation is above 0 with a two-sided Fisher p (p_own) below alpha; it is above the random one
    by Williams' test, one-sided p (p_better) below alpha and q_value, its step-up adjustment, below fdr; and the trained
    RMSE is smaller. Genes with an undefined correlation or of fewer than four patients have no p_better, no q_value and
    don't beat. Tails are those of the normal distribution."""
    both = trained.select(*by, "gene_id", "patient_id", "pred", "label").join(random.select(*by, "gene_id", "patient_id", F.col("pred").alias("base")), [*by, "gene_id", "patient_id"])
    per = both.groupBy(*by, "gene_id").agg(
        F.count("*").alias("n"),
        pearson("pred", "label").alias("r_trained"),
        pearson("base", "label").alias("r_random"),
        pearson("pred", "base").alias("r_between"),
        F.sqrt(F.avg((F.col("pred") - F.col("label")) ** 2)).alias("rmse_trained"),
        F.sqrt(F.avg((F.col("base") - F.col("label")) ** 2)).alias("rmse_random"),
    )
    defined = F.col("r_trained").isNotNull() & F.col("r_random").isNotNull() & F.col("r_between").isNotNull() & (F.col("n") >= 4)
    t = williams_t(F.col("r_trained"), F.col("r_random"), F.col("r_between"), F.col("n"))
    per = per.withColumn("williams_t", F.when(F.col("n") >= 4, t)).withColumn("p_own", F.when(F.col("n") >= 4, fisher_p(F.col("r_trained"), F.col("n"))))
    per = per.withColumn("p_better", F.when(defined, erfc(F.col("williams_t") / F.sqrt(F.lit(2.0))) / 2))
    q = benjamini_hochberg(per, by, "p_better", "gene_id").select(*by, "gene_id", "q_value")
    wins = (F.col("r_trained") > 0) & (F.col("p_own") < alpha) & (F.col("r_trained") > F.col("r_random")) & (F.col("p_better") < alpha)
    wins = wins & (F.col("q_value") < fdr) & (F.col("rmse_trained") < F.col("rmse_random"))
    return per.join(q, [*by, "gene_id"], "left").withColumn("beats", F.coalesce(wins, F.lit(False)))


# ---- curves ----


def roc_points(df: DataFrame, by: Sequence[str], score: str = "prob", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) over distinct scores, from (0, 0) on."""
    c = running_sums(_collapsed(df, by, score, label), by, score, ["pos", "neg"], descending=True)
    total = c.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    points = c.join(total, list(by)).select(*by, F.col(score).alias("threshold"), _ratio(F.col("cum_neg"), F.col("_n")).alias("fpr"), _ratio(F.col("cum_pos"), F.col("_p")).alias("tpr"))
    return total.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")).unionByName(points)


def roc_band(points: DataFrame, by: Sequence[str], fold: str = "outer_fold", grid: int = 201) -> DataFrame:
    """Mean and population SD over folds of the TPR interpolated on an even FPR grid."""
    steps = points.groupBy(*by, fold, "fpr").agg(F.max("tpr").alias("tpr"))
    w = Window.partitionBy(*by, fold).orderBy("fpr")
    segments = steps.select(*by, fold, "fpr", "tpr", F.lead("fpr").over(w).alias("fpr2"), F.lead("tpr").over(w).alias("tpr2"))
    last = grid - 1
    first = F.ceil(F.round(F.col("fpr") * last, 9)).cast("int")
    # a grid point belongs to the segment that starts at or before it
    end = F.when(F.col("fpr2").isNull(), F.lit(last)).otherwise(F.ceil(F.round(F.col("fpr2") * last, 9)).cast("int") - 1)
    cells = segments.withColumn("g", F.explode(F.when(end >= first, F.sequence(first, end)).otherwise(F.array().cast("array<int>"))))
    x = F.col("g") / last
    tpr = F.when(F.col("fpr2").isNull() | (F.col("fpr2") == F.col("fpr")), F.col("tpr")).otherwise(F.col("tpr") + (F.col("tpr2") - F.col("tpr")) * (x - F.col("fpr")) / (F.col("fpr2") - F.col("fpr")))
    return cells.withColumn("_tpr", tpr).groupBy(*by, "g").agg(F.avg("_tpr").alias("mean_tpr"), F.stddev_pop("_tpr").alias("sd_tpr")).withColumn("fpr", F.col("g") / last).drop("g")


def ovr_roc_points(df: DataFrame, by: Sequence[str], probs: str = "probs", label: str = "label") -> DataFrame:
    """One-vs-rest ROC points of each class."""
    each = df.where(F.col(label) >= 0).select(*by, F.col(label).alias("true"), F.posexplode(probs).alias("class", "prob"))
    return roc_points(each.withColumn("label", (F.col("true") == F.col("class")).cast("int")), [*by, "class"])


def _value(f: Callable[..., DataFrame], column: str) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    return lambda df, by: f(df, by).select(*by, F.col(column).alias("metric"))


#: objective -> key -> (metric over (df, by), chance level); higher is better, the first is the default.
METRICS: dict[str, dict[str, tuple[Callable[[DataFrame, Sequence[str]], DataFrame], float | None]]] = {
    "binary": {"auroc": (_value(auroc, "auroc"), 0.5), "average_precision": (_value(average_precision, "average_precision"), None)},
    "multiclass": {
        "macro_auroc": (lambda df, by: multiclass_metrics(df, by).select(*by, F.col("macro_auroc").alias("metric")), 0.5),
        "quadratic_kappa": (_value(quadratic_kappa, "quadratic_kappa"), 0.0),
    },
    "regression": {"r2": (_value(regression_metrics, "r2"), 0.0), "pearson": (_value(regression_metrics, "pearson"), 0.0), "spearman": (_value(regression_metrics, "spearman"), 0.0)},
    "survival": {"c_index": (_value(concordance, "c_index"), 0.5)},
    "regression_vector": {
        "mean_gene_pearson": (lambda df, by: gene_pearson(df, [*by, "gene_id"]).groupBy(*by).agg(F.avg("pearson").alias("metric")), 0.0),
    },
}


def resolve_metric(objective: str, key: str | None = None):
    """(key, function, chance level) of an objective's metric; unknown names are refused."""
    if objective not in METRICS:
        raise ValueError(f"unknown objective {objective!r}")
    key = key or next(iter(METRICS[objective]))
    if key not in METRICS[objective]:
        raise ValueError(f"{objective} has no metric {key!r}; it has {', '.join(METRICS[objective])}")
    return key, *METRICS[objective][key]
