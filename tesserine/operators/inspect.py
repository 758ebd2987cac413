"""Run inspection: attention weights, survival curves, and where a slide stands among others."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.functions import metrics as M
from tesserine.operators.ordered import as_of, attach_quantiles, row_numbers, running_sums

_MODEL = ("outer_fold", "inner_fold")


def beats_on_error(preds: DataFrame, by: Sequence[str] = ("field",), key: str = "slide_id") -> DataFrame:
    """The share of slides that this one beats on absolute error."""
    rows = preds.withColumn("abs_error", F.abs(F.col("pred") - F.col("label")))
    n = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    ranked = row_numbers(rows, by, "abs_error", key, "_rank").join(F.broadcast(n), list(by))
    share = (F.col("_n") - F.col("_rank")) / F.greatest(F.col("_n") - 1, F.lit(1))
    return ranked.select(*preds.columns, "abs_error", share.alias("beats"))


def out_risks(slides: DataFrame, by: Sequence[str] = ("field",)) -> DataFrame:
    """The share of patients that this slide's patient out-risks."""
    patients = slides.groupBy(*by, "patient_id").agg(F.avg("risk").alias("_risk"))
    n = patients.groupBy(*by).agg(F.count("*").alias("_n"))
    share = row_numbers(patients, by, "_risk", "patient_id", "_rank").join(F.broadcast(n), list(by))
    share = share.select(*by, "patient_id", ((F.col("_rank") - 1) / F.greatest(F.col("_n") - 1, F.lit(1))).alias("out_risks"))
    return slides.join(share, [*by, "patient_id"])


def attention_weights(attention: DataFrame, model: Sequence[str] = _MODEL) -> DataFrame:
    """Softmax of the logits of each slide and model.

    The input is read once: a window takes the tiles of one slide and model, which the slide's area bounds, and spills them."""
    w = Window.partitionBy(*model, "slide_id")
    e = attention.where(F.col("slide_id").isNotNull()).withColumn("_e", F.exp(F.col("logit") - F.max("logit").over(w)))
    return e.select(*attention.columns, (F.col("_e") / F.sum("_e").over(w)).alias("weight"))


def attention_ensemble(attention: DataFrame, model: Sequence[str] = _MODEL) -> DataFrame:
    """Log of the mean weight of each tile over models, floored at the smallest double."""
    w = attention_weights(attention, model)
    floor = F.lit(sys.float_info.min)
    return w.groupBy("slide_id", "tile_idx").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.log(F.greatest(F.avg("weight"), floor)).alias("logit"))


def rank_agreement(attention: DataFrame, model: Sequence[str] = _MODEL) -> DataFrame:
    """Median over pairs of models of the Spearman of their tile logits; null below two models or two tiles."""
    named = attention.withColumn("_m", F.concat_ws("/", *[F.col(c).cast("string") for c in model]))
    ranked = row_numbers(named.select("slide_id", "tile_idx", "_m", "logit"), ["slide_id", "_m"], "logit", "tile_idx", "_r", near=["slide_id"])
    # the models of a tile are as many as the study has
    tiles = ranked.where(F.col("slide_id").isNotNull() & F.col("tile_idx").isNotNull()).groupBy("slide_id", "tile_idx").agg(F.collect_list(F.struct("_m", "_r")).alias("_all"))
    later = lambda a: F.transform(F.filter("_all", lambda b: a["_m"] < b["_m"]), lambda b: F.struct(a["_m"].alias("_m"), b["_m"].alias("_m2"), a["_r"].alias("_r"), b["_r"].alias("_r2")))
    pairs = tiles.select("slide_id", F.explode(F.flatten(F.transform("_all", later))).alias("_p")).select("slide_id", "_p.*")
    each = pairs.groupBy("slide_id", "_m", "_m2").agg(F.count("*").alias("_n"), M.pearson(F.col("_r").cast("double"), F.col("_r2").cast("double")).alias("_rho"))
    # a group holds a pair of models a row, whose number the study fixes
    found = each.where("_n >= 2").groupBy("slide_id").agg(F.round(F.percentile("_rho", 0.5), 12).alias("agreement"))
    return attention.select("slide_id").distinct().join(found, "slide_id", "left")


def attach_coordinates(logits: DataFrame, tiles: DataFrame) -> DataFrame:
    """Attention logits with tile coordinates, cut at the slide's own tiles."""
    return logits.join(tiles.select("slide_id", "tile_idx", "x", "y"), ["slide_id", "tile_idx"])


def survival_curves(preds: DataFrame, by: Sequence[str] = ("slide_id",)) -> DataFrame:
    """(by, t, s) at each interior edge, and the tail beyond the last (W9): preds has logits and time_edges."""
    s = L.survival(L.hazards("logits"))
    rows = preds.withColumn("_s", s).withColumn("tail", F.element_at("_s", -1))
    return rows.select(*by, "tail", F.explode(F.arrays_zip(F.col("time_edges").alias("t"), F.slice("_s", 1, F.size("time_edges")).alias("s"))).alias("_p")).select(*by, F.col("_p.t").alias("t"), F.col("_p.s").alias("s"), "tail")


def survival_at(curves: DataFrame, times: DataFrame, by: Sequence[str] = ("slide_id",)) -> DataFrame:
    """S(t) of each curve at each time: the step of the last edge at or before it, 1 before the first.

    times has the curve's key and t. An as-of join, so no time meets all edges.
    """
    return as_of(times, curves, by, "t", ["s"]).withColumn("s", F.coalesce("s", F.lit(1.0)))


def curve_ensemble(curves: DataFrame, model: Sequence[str] = _MODEL, by: Sequence[str] = ("slide_id",)) -> DataFrame:
    """Mean survival over models on the union of their edges.

    A model's curve changes at its own edges only, so the sum over models is a running sum of these steps along the
    union: no model meets the edges of the others."""
    steps = curves.withColumn("_step", F.col("s") - F.lag("s", 1, 1.0).over(Window.partitionBy(*by, *model).orderBy("t")))
    models = curves.groupBy(*by).agg(F.count_distinct(F.struct(*model)).alias("n_models"))
    grid = running_sums(steps.groupBy(*by, "t").agg(F.sum("_step").alias("_step")), by, "t", ["_step"])
    return grid.join(models, list(by)).select(*by, "t", (1 + F.col("cum__step") / F.col("n_models")).alias("s"), "n_models")


def survival_context(slides: DataFrame, by: Sequence[str] = ("field",)) -> DataFrame:
    """Patients, events and median follow-up over patients, not slides."""
    patients = slides.groupBy(*by, "patient_id").agg(F.first("time").alias("time"), F.first("event").alias("event"), F.avg("risk").alias("risk"))
    out = patients.groupBy(*by).agg(F.count("*").alias("n_patients"), F.sum("event").alias("n_events"))
    return attach_quantiles(out, patients, by, {"_q": ("time", (0.5,))}).select(*by, "n_patients", "n_events", F.col("_q")[0].alias("median_follow_up"))


def patient_curve(slides: DataFrame, by: Sequence[str] = ("field",)) -> DataFrame:
    """Kaplan-Meier over patients."""
    patients = slides.groupBy(*by, "patient_id").agg(F.first("time").alias("time"), F.first("event").alias("event"))
    return M.kaplan_meier(patients, by)


def walk(slides: DataFrame, scope: str, order: str = "slide_id") -> DataFrame:
    """Previous and next slide, and the place in the scope."""
    w = Window.partitionBy(scope).orderBy(order)
    whole = Window.partitionBy(scope)
    return slides.select(scope, order, F.lag(order).over(w).alias("previous"), F.lead(order).over(w).alias("next"), F.row_number().over(w).alias("place"), F.count("*").over(whole).alias("of"))


def run_records(preds: DataFrame, attention: DataFrame, inner: int | None = None) -> DataFrame:
    """One record a slide: its mean prediction, models and rank agreement, over all replicates or one."""
    if inner is not None:
        preds, attention = preds.where(F.col("inner_fold") == inner), attention.where(F.col("inner_fold") == inner)
    mean = preds.groupBy("slide_id").agg(F.avg("prob").alias("prob"), F.first("label").alias("label"), F.count("*").alias("n_models"))
    return mean.join(rank_agreement(attention), "slide_id", "left")


def class_names(mapping: dict[str, int], spark) -> DataFrame:
    """Display name of each class: its values, sorted and joined."""
    return name_classes(spark.createDataFrame(list(mapping.items()), "value string, class int"))


def name_classes(values: DataFrame) -> DataFrame:
    """Display names from rows (value, class)."""
    return values.groupBy("class").agg(F.array_join(F.array_sort(F.collect_set("value")), " / ").alias("name"))
