"""Tiles to slides, slides to patients, models to ensembles, and the reports over folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.functions.labels import sigmoid
from tesserine.functions.metrics import auroc
from tesserine.operators.ordered import attach_quantiles


def vector_mean(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Element-wise mean of arrays (A1)."""
    long = df.select(*by, F.posexplode(column).alias("_pos", "_v")).groupBy(*by, "_pos").agg(F.avg(F.nanvl("_v", F.lit(None))).alias("_v"))
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_v")))
    return long.groupBy(*by).agg(F.transform(ordered, lambda s: s["_v"]).alias(column))


def slides_to_patients(preds: DataFrame, by: Sequence[str] = (), value: str = "prob", label: str = "label") -> DataFrame:
    """Mean over a patient's slides, with the patient's label (A1)."""
    keys = [*by, "patient_id"]
    if preds.schema[value].dataType.typeName() == "array":
        labels = preds.groupBy(*keys).agg(F.first(label).alias(label), F.count("*").alias("n_slides"))
        return vector_mean(preds, keys, value).join(labels, keys)
    return preds.groupBy(*keys).agg(F.avg(value).alias(value), F.first(label).alias(label), F.count("*").alias("n_slides"))


def pool_out_of_fold(preds: DataFrame, value: str = "prob", label: str = "label") -> DataFrame:
    """The out-of-fold record: slides averaged within each replicate, then replicates, a row a field and patient."""
    by = ["field", "outer_fold", "inner_fold"]
    per = slides_to_patients(preds, by, value, label)
    keys = ["field", "outer_fold", "patient_id"]
    if preds.schema[value].dataType.typeName() == "array":
        rest = per.groupBy(*keys).agg(F.first(label).alias(label), F.count("*").alias("n_replicates"))
        return vector_mean(per, keys, value).join(rest, keys)
    return per.groupBy(*keys).agg(F.avg(value).alias(value), F.first(label).alias(label), F.count("*").alias("n_replicates"))


def ensemble(patients: DataFrame, value: str = "prob", by: Sequence[str] = ("field",)) -> DataFrame:
    """Mean over models of each patient's prediction."""
    return patients.groupBy(*by, "patient_id").agg(F.avg(value).alias(value), F.count("*").alias("n_models"))


def external_ensembles(patients: DataFrame, value: str = "prob") -> DataFrame:
    """The grand ensemble over all models (model "grand") and one for each outer fold ("o0", ...)."""
    models = patients.withColumn("model", F.explode(F.array(F.lit("grand"), F.concat(F.lit("o"), F.col("outer_fold").cast("string")))))
    return models.groupBy("field", "model", "patient_id").agg(F.avg(value).alias(value), F.count("*").alias("n_models"))


def mean_std(per_fold: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("field",)) -> DataFrame:
    """(metric, mean, sd, n_folds) over folds; undefined folds are skipped (A5)."""
    long = per_fold.unpivot(list(by), list(metrics), "metric", "value")
    v = F.when(F.isnan("value"), None).otherwise(F.col("value"))
    return long.groupBy(*by, "metric").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"), F.count(v).alias("n_folds"))


def tiles_to_slides(tiles: DataFrame, by: Sequence[str] = ("slide_id",), logit: str = "logit", label: str = "label") -> DataFrame:
    """Mean tile probability of a slide, and the logit of it from summed probabilities and summed complements."""
    p, q = sigmoid(logit), sigmoid(-F.col(logit))
    rows = tiles.where(F.col(label) >= 0)
    return rows.groupBy(*by).agg(F.avg(p).alias("prob"), (F.log(F.sum(p)) - F.log(F.sum(q))).alias("logit"), F.first(label).alias("label"), F.count("*").alias("n_tiles"))


def pooled_slide_auroc(tiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUROC over slides pooled from tiles; null with one class or fewer than two slides."""
    # sums of one set of tiles in another order are the same score
    slides = tiles_to_slides(tiles, [*by, "slide_id"]).withColumn("prob", F.round("prob", 12))
    return auroc(slides, by, "prob", "label")


def fold_coverage(coverage: DataFrame) -> DataFrame:
    """Coverage over outer folds, one replicate of each."""
    one = coverage.dropDuplicates(["field", "outer_fold"])
    return one.groupBy("field").agg(
        F.sum("n_declared").alias("n_declared"), F.sum("n_scored").alias("n_scored"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("lost")))).alias("lost")
    )


def report(per_fold: DataFrame, metrics: Sequence[str], pooled: int = -1) -> DataFrame:
    """A row a fold, a mean and an sd row, and the pooled row, told apart by row_kind."""
    kind = F.when(F.col("outer_fold") == pooled, "pooled").otherwise("fold")
    rows = per_fold.select("field", kind.alias("row_kind"), "outer_fold", *metrics)
    folds = per_fold.where(F.col("outer_fold") != pooled)
    none = F.lit(None).cast("int").alias("outer_fold")
    for name, f in (("mean", F.avg), ("sd", F.stddev_pop)):
        rows = rows.unionByName(folds.groupBy("field").agg(*[f(m).alias(m) for m in metrics]).select("field", F.lit(name).alias("row_kind"), none, *metrics))
    return rows


def headline(rows: DataFrame, metric: str) -> DataFrame:
    """One line an endpoint on its primary metric."""
    value = lambda kind: F.max(F.when(F.col("row_kind") == kind, F.round(F.col(metric), 3)))
    out = rows.groupBy("field").agg(value("mean").alias("mean"), value("sd").alias("sd"), value("pooled").alias("pooled"))
    return out.withColumn("line", F.format_string(f"%s: {metric} %.3f ± %.3f over folds, %.3f pooled", "field", "mean", "sd", "pooled"))


def per_gene_table(per_gene: DataFrame) -> DataFrame:
    """Genes by correlation, best first, undefined last."""
    return per_gene.orderBy(F.col("pearson").desc_nulls_last(), "gene_id")


def score_groups(df: DataFrame, by: Sequence[str] = (), score: str = "prob", label: str = "label") -> DataFrame:
    """Five-number summary of scores by true class."""
    rows = df.where(F.col(label) >= 0)
    out = rows.groupBy(*by, label).agg(F.count("*").alias("n"))
    out = attach_quantiles(out, rows, [*by, label], {"_q": (score, (0.0, 0.25, 0.5, 0.75, 1.0))})
    return out.select(*by, label, "n", *[F.col("_q")[k].alias(name) for k, name in enumerate(("min", "q1", "median", "q3", "max"))])


def ovr_score_groups(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same for each class against the rest."""
    each = df.where(F.col("label") >= 0).select(*by, F.col("label").alias("_true"), F.posexplode("probs").alias("class", "prob"))
    return score_groups(each.withColumn("label", (F.col("_true") == F.col("class")).cast("int")), [*by, "class"])


def histogram(df: DataFrame, value: str, bins: int, low: float, high: float, by: Sequence[str] = (), *, log: bool = False) -> DataFrame:
    """(bin, low, high, n): even or log-spaced bins from low to high; the last holds its upper edge."""
    x: Column = F.log(F.col(value)) if log else F.col(value)
    a, b = (F.log(F.lit(float(low))), F.log(F.lit(float(high)))) if log else (F.lit(float(low)), F.lit(float(high)))
    k = F.least(F.floor((x - a) / (b - a) * bins), F.lit(bins - 1)).cast("int")
    rows = df.where(F.col(value).between(low, high)).groupBy(*by, k.alias("bin")).agg(F.count("*").alias("n"))
    edge = lambda j: F.exp(a + (b - a) * j / bins) if log else a + (b - a) * j / bins
    return rows.withColumn("low", edge(F.col("bin"))).withColumn("high", edge(F.col("bin") + 1))
