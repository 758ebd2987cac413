"""Fold models for Spark users: pooled features, weighted heads by pyspark.ml, losses and scoring with every fold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.functions import metrics as M
from tesserine.operators import profile
from tesserine.operators.checks import covered_by_all
from tesserine.operators.inspect import attention_weights
from tesserine.operators.rollup import slides_to_patients, vector_mean
from tesserine.sources import sinks

FOLD = ["outer_fold", "inner_fold"]


def mean_pool(tiles: DataFrame, by: Sequence[str] = ("slide_id",)) -> DataFrame:
    """Mean of a slide's tile vectors."""
    return vector_mean(tiles, by, "features")


def weighted_pool(tiles: DataFrame, by: Sequence[str] = ("slide_id",)) -> DataFrame:
    """Tile vectors weighted by the softmax of given logits."""
    w = attention_weights(tiles, [c for c in by if c != "slide_id"])
    long = w.select(*by, "weight", F.posexplode("features").alias("_pos", "_v")).groupBy(*by, "_pos").agg(F.sum(F.col("weight") * F.col("_v")).alias("_v"))
    return long.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_v"))), lambda s: s["_v"]).alias("features"))


def fuse(branches: Sequence[DataFrame], key: str = "patient_id") -> DataFrame:
    """Per-branch vectors, each scaled to length 1, side by side."""
    out = None
    for k, b in enumerate(branches):
        norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v))
        unit = b.select(key, F.transform("features", lambda v: v / F.greatest(norm, F.lit(1e-12))).alias(f"_f{k}"))
        out = unit if out is None else out.join(unit, key)
    return out.select(key, F.concat(*[F.col(f"_f{k}") for k in range(len(branches))]).alias("features"))


@dataclass(frozen=True)
class Modality:
    """A kind of input: its frame, and, if it can tell, the patients that it has."""

    frame: Callable[..., DataFrame]
    coverage: Callable[..., DataFrame] | None = None

    def __call__(self, **options) -> DataFrame:
        return self.frame(**options)


def _known(spec: Mapping[str, Mapping[str, object]], known: Mapping[str, Callable[..., DataFrame]]) -> None:
    if lost := sorted(set(spec) - set(known)):
        raise ValueError(f"unknown modalities: {', '.join(lost)}")


def streams(spec: Mapping[str, Mapping[str, object]], known: Mapping[str, Callable[..., DataFrame]]) -> dict[str, DataFrame]:
    """Named input frames from a spec; an unknown modality is refused."""
    _known(spec, known)
    return {name: known[name](**options) for name, options in spec.items()}


def covered_patients(patients: DataFrame, spec: Mapping[str, Mapping[str, object]], known: Mapping[str, Callable[..., DataFrame]]) -> DataFrame:
    """The patients that every required modality has; one that can't tell its coverage asks for nothing."""
    _known(spec, known)
    told = [known[name].coverage(**options) for name, options in spec.items() if getattr(known[name], "coverage", None)]
    return covered_by_all([patients, *told])


def ungated(inputs: Sequence[str], required: Sequence[str]) -> list[str]:
    """Modalities that a recipe uses and the study doesn't require."""
    return [m for m in inputs if m not in required]


@dataclass(frozen=True)
class Recipe:
    """The options of a head; unknown ones are refused by the constructor."""

    objective: str
    classes: int = 2
    class_weight: object = None
    reg: float = 0.01
    max_iter: int = 25
    n_bins: int = 4

    def unused(self) -> list[str]:
        """Options that the objective doesn't read."""
        out = ["class_weight"] if self.class_weight is not None and self.objective not in ("binary", "multiclass") else []
        return out + (["n_bins"] if self.n_bins != 4 and self.objective != "survival" else [])


def _with_weight(train: DataFrame, recipe: Recipe) -> DataFrame:
    if recipe.class_weight is None:
        return train.withColumn("weight", F.lit(1.0))
    if recipe.class_weight == "balanced":
        w = profile.balanced_weights(train, recipe.classes).select(F.col("class").alias("label"), "weight")
        return train.join(F.broadcast(w), "label")
    pairs = F.create_map(*[F.lit(x) for k, v in recipe.class_weight.items() for x in (int(k), float(v))])
    return train.withColumn("weight", pairs[F.col("label").cast("int")])


def fit_classification(train: DataFrame, recipe: Recipe) -> Callable[[DataFrame], DataFrame]:
    """A class-weighted logistic head: the function that adds prob or probs."""
    rows = _with_weight(train.where(F.col("label") >= 0), recipe).withColumn("_x", array_to_vector("features")).withColumn("_y", F.col("label").cast("double"))
    family = "binomial" if recipe.objective == "binary" else "multinomial"
    model = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="weight", regParam=recipe.reg, maxIter=recipe.max_iter, family=family, predictionCol="_p", rawPredictionCol="_r", probabilityCol="_q").fit(rows)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(df.withColumn("_x", array_to_vector("features"))).withColumn("probs", vector_to_array("_q"))
        out = out.withColumn("prob", F.col("probs")[1]) if recipe.objective == "binary" else out
        return out.drop("_x", "_p", "_r", "_q", *(["probs"] if recipe.objective == "binary" else []))

    return score


def fit_regression(train: DataFrame, recipe: Recipe) -> Callable[[DataFrame], DataFrame]:
    """A linear head on the z-scored target, scored in the target's own units."""
    state = profile.fit_moments(train, "label", []).first()
    rows = train.withColumn("_y", (F.col("label") - F.lit(state["mean"])) / F.lit(state["std"])).withColumn("_x", array_to_vector("features"))
    model = LinearRegression(featuresCol="_x", labelCol="_y", regParam=recipe.reg, maxIter=recipe.max_iter, predictionCol="_p").fit(rows)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(df.withColumn("_x", array_to_vector("features")))
        return out.withColumn("pred", L.unstandardize(F.col("_p"), F.lit(state["mean"]), F.lit(state["std"]))).drop("_x", "_p")

    return score


def person_period(df: DataFrame, edges: Column | Sequence[float]) -> DataFrame:
    """A row for each bin in which a patient is at risk; the last carries the event."""
    rows = df.withColumn("_last", L.survival_bin("time", edges))
    rows = rows.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    return rows.withColumn("hit", F.when(F.col("bin") == F.col("_last"), F.col("event")).otherwise(0)).drop("_last")


def fit_survival(train: DataFrame, recipe: Recipe) -> Callable[[DataFrame], DataFrame]:
    """A discrete-time hazard head: one logistic model a bin on the patients at risk in it."""
    edges = list(profile.time_bins(train, recipe.n_bins, []).first()["edges"])
    periods = person_period(train, edges).withColumn("_x", array_to_vector("features")).withColumn("_y", F.col("hit").cast("double"))
    models = []
    for k in range(len(edges) + 1):
        rows = periods.where(F.col("bin") == k)
        kinds = {r[0] for r in rows.select("_y").distinct().collect()}
        if len(kinds) == 2:
            models.append(LogisticRegression(featuresCol="_x", labelCol="_y", regParam=recipe.reg, maxIter=recipe.max_iter).fit(rows))
        else:  # one outcome only: a constant hazard near it
            models.append(20.0 if kinds == {1.0} else -20.0)

    def score(df: DataFrame) -> DataFrame:
        logits = []
        for m in models:
            if isinstance(m, float):
                logits.append(F.lit(m))
            else:
                dot = F.aggregate(F.zip_with("features", F.array(*[F.lit(float(c)) for c in m.coefficients]), lambda a, b: a * b), F.lit(float(m.intercept)), lambda a, v: a + v)
                logits.append(dot)
        out = df.withColumn("logits", F.array(*logits)).withColumn("time_edges", F.array(*[F.lit(float(e)) for e in edges]))
        return out.withColumn("risk", L.survival_risk("logits"))

    return score


def fit_genes(train: DataFrame, recipe: Recipe, part_rows: int = 20_000) -> Callable[[DataFrame], DataFrame]:
    """A ridge head a gene in closed form (X7, D8). train: features, patient_id, gene_id, value.

    A task adds up x x' and x z of at most about `part_rows` patients of one gene; the sums of a gene, one row a part, are
    solved together. Heads are genes x (features + 1) numbers.
    """
    stats = profile.gene_state(train.select("patient_id", "gene_id", "value"))
    rows = train.join(stats.select("gene_id", "mean", "std", F.col("n").alias("_n")), "gene_id").withColumn("z", L.standardize(F.col("value"), F.col("mean"), F.col("std")))
    parts = F.greatest(F.ceil(F.col("_n") / part_rows), F.lit(1)).cast("long")
    rows = rows.where(F.col("z").isNotNull()).select("gene_id", F.pmod(F.xxhash64("patient_id"), parts).alias("_part"), "features", "z")
    kind = train.schema["gene_id"].dataType.simpleString()

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.column_stack([np.array(pdf["features"].tolist(), float), np.ones(len(pdf))])
        return pd.DataFrame({"gene_id": [pdf["gene_id"].iloc[0]], "n": [len(x)], "xx": [(x.T @ x).ravel().tolist()], "xz": [(x.T @ pdf["z"].to_numpy()).tolist()]})

    def ridge(pdf: pd.DataFrame) -> pd.DataFrame:
        xx, xz, n = np.sum(np.array(pdf["xx"].tolist()), 0), np.sum(np.array(pdf["xz"].tolist()), 0), int(pdf["n"].sum())
        penalty = np.diag([recipe.reg * n] * (len(xz) - 1) + [0.0])
        w = np.linalg.lstsq(xx.reshape(len(xz), -1) + penalty, xz, rcond=None)[0]
        return pd.DataFrame({"gene_id": [pdf["gene_id"].iloc[0]], "w": [w.tolist()]})

    partial = rows.groupBy("gene_id", "_part").applyInPandas(sums, f"gene_id {kind}, n long, xx array<double>, xz array<double>")
    heads = partial.groupBy("gene_id").applyInPandas(ridge, f"gene_id {kind}, w array<double>")

    path = sinks.fresh(train.sparkSession, "heads")
    heads.write.parquet(path)
    heads = train.sparkSession.read.parquet(path)
    n_heads = heads.count()

    def score(df: DataFrame) -> DataFrame:
        return blocked_product(df, heads, n_heads)

    return score


def blocked_product(df: DataFrame, heads: DataFrame, n_heads: int, *, rows: int = 4096, genes: int = 256) -> DataFrame:
    """Every row of df with the score of every head: df's columns but features, gene_id and pred.

    heads: gene_id and w, the weights with the intercept last. Rows and heads are cut into blocks of about `rows` and `genes` by a hash of
    their ids, and a task multiplies one block of each. A row moves once a block of heads, a head once a block of
    rows; neither side is broadcast. The result has a row for every pair, as it is asked of every row.
    """
    parts, blocks = max(1, -(-df.count() // rows)), max(1, -(-n_heads // genes))
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = df.withColumn("_p", F.pmod(F.xxhash64("patient_id"), F.lit(parts)).cast("int")).withColumn("_g", axis(blocks))
    right = heads.select("gene_id", "w", F.pmod(F.xxhash64("gene_id"), F.lit(blocks)).cast("int").alias("_g")).withColumn("_p", axis(parts))
    kept = [c for c in df.columns if c not in ("features", "gene_id", "pred")]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + f", gene_id {heads.schema['gene_id'].dataType.simpleString()}, pred double"

    def multiply(x: pa.Table, w: pa.Table) -> pa.Table:
        if not (x.num_rows and w.num_rows):
            return pa.table({c: x.column(c).slice(0, 0) for c in kept} | {"gene_id": w.column("gene_id").slice(0, 0), "pred": pa.array([], pa.float64())})
        own = np.array(x.column("features").to_pylist(), float)
        weights = np.array(w.column("w").to_pylist(), float)
        pred = own @ weights[:, :-1].T + weights[:, -1]
        each, head = np.repeat(np.arange(len(own)), len(weights)), np.tile(np.arange(len(weights)), len(own))
        return pa.table({c: x.column(c).take(pa.array(each)) for c in kept} | {"gene_id": w.column("gene_id").take(pa.array(head)), "pred": pred.ravel()})

    return left.groupBy("_p", "_g").cogroup(right.groupBy("_p", "_g")).applyInArrow(multiply, schema)


FITS: dict[str, Callable[[DataFrame, Recipe], Callable[[DataFrame], DataFrame]]] = {
    "binary": fit_classification,
    "multiclass": fit_classification,
    "regression": fit_regression,
    "survival": fit_survival,
    "regression_vector": fit_genes,
}


@dataclass(frozen=True)
class Task:
    """What an endpoint's model needs: its fit, prediction column and metric; other objectives are refused."""

    recipe: Recipe

    def __post_init__(self):
        if self.recipe.objective not in FITS:
            raise ValueError(f"no task for objective {self.recipe.objective!r}")

    @property
    def value(self) -> str:
        return {"binary": "prob", "multiclass": "probs", "regression": "pred", "survival": "risk", "regression_vector": "pred"}[self.recipe.objective]

    def fit(self, train: DataFrame) -> Callable[[DataFrame], DataFrame]:
        return FITS[self.recipe.objective](train, self.recipe)


def losses(preds: DataFrame, by: Sequence[str], objective: str, weights: Mapping[int, float] | None = None) -> DataFrame:
    """The loss by group; excluded rows are dropped and none valid gives 0.

    binary: weighted BCE over logit; multiclass: weighted CE over logits, normalised by the weights; regression: MSE;
    survival: negative log-likelihood over logits and edges.
    """
    if objective == "regression":
        ok = F.col("label").isNotNull() & ~F.isnan("label")
        return preds.groupBy(*by).agg(F.coalesce(F.avg(F.when(ok, (F.col("pred") - F.col("label")) ** 2)), F.lit(0.0)).alias("loss"))
    if objective == "survival":
        last = L.survival_bin("time", F.col("time_edges"))
        h = F.transform(L.hazards("logits"), lambda v: F.least(F.greatest(v, F.lit(1e-7)), F.lit(1 - 1e-7)))
        lived = F.aggregate(F.slice(h, F.lit(1), last), F.lit(0.0), lambda a, v: a - F.log(1 - v))
        end = F.element_at(h, last + 1)
        nll = lived - F.when(F.col("event") == 1, F.log(end)).otherwise(F.log(1 - end))
        return preds.groupBy(*by).agg(F.coalesce(F.avg(F.when(F.col("time").isNotNull(), nll)), F.lit(0.0)).alias("loss"))
    w = F.lit(1.0) if not weights else F.try_element_at(F.create_map(*[F.lit(x) for k, v in weights.items() for x in (int(k), float(v))]), F.col("label").cast("int"))
    rows = preds.where(F.col("label") >= 0).withColumn("_w", w)
    if objective == "binary":
        soft = lambda x: F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
        each = F.when(F.col("label") == 1, F.col("_w") * soft(-F.col("logit"))).otherwise(soft(F.col("logit")))
        found = rows.groupBy(*by).agg(F.avg(each).alias("loss"))
    else:
        logp = F.log(F.element_at(L.softmax("logits"), F.col("label").cast("int") + 1))
        found = rows.groupBy(*by).agg(F.try_divide(F.sum(-F.col("_w") * logp), F.sum("_w")).alias("loss"))
    return preds.select(*by).distinct().join(found, list(by), "left").withColumn("loss", F.coalesce("loss", F.lit(0.0)))


def best_candidate(table: DataFrame, by: Sequence[str] = ("field", *FOLD)) -> DataFrame:
    """The candidate of least validation loss in each fold."""
    return table.groupBy(*by).agg(F.min_by("candidate", F.struct("loss", "candidate")).alias("candidate"), F.min("loss").alias("loss"))


def random_head(df: DataFrame, seed: int, value: str = "pred") -> DataFrame:
    """Scores of an unfitted head whose weights follow from a seed (X11)."""
    weights = F.transform("features", lambda v, k: v * (F.pmod(F.xxhash64(F.lit(seed), k), F.lit(2001)) - 1000) / 1000.0)
    return df.withColumn(value, F.aggregate(weights, F.lit(0.0), lambda a, v: a + v))


def score_predictions(preds: DataFrame, objective: str, value: str, key: str | None = None) -> DataFrame:
    """One model's raw predictions to (metric, n_patients, n_positive) at patient level."""
    _, metric, _ = M.resolve_metric(objective, key)
    patients = slides_to_patients(preds, [], value).withColumn("_all", F.lit(1))
    n = patients.agg(F.count("*").alias("n_patients"), F.sum((F.col("label") == 1).cast("int")).alias("n_positive")).withColumn("_all", F.lit(1))
    return metric(patients, ["_all"]).join(n, "_all").drop("_all")
