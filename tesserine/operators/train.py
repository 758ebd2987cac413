"""Seeded training of many linear heads together: every fold, recipe and training seed in the same passes over the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.operators.fit import Recipe
from tesserine.sources import sinks

TRAINED = ("binary", "multiclass", "regression")
OUTPUT = {"binary": "prob", "multiclass": "probs", "regression": "pred"}


@dataclass(frozen=True)
class Descent:
    """Mini-batch gradient descent with first and second moments of the gradients (Adam) and a falling rate.

    Rows are dealt to `batches` by a hash of their patient. An epoch takes each batch once, in an order that the training
    seed draws, as it draws the first weights. Rows of a batch are found by folder, so an epoch reads the rows once where
    all models share a seed, and at most `batches` times where each has its own."""

    epochs: int = 10
    batches: int = 4
    rate: float = 0.2
    start: float = 0.3  # standard deviation of the first weights
    at_once: int = 256  # models that one pass trains


@dataclass(frozen=True)
class Job:
    """One model to train: on the fit rows of a fold, by a recipe, from a training seed."""

    fold: int
    recipe: Recipe
    seed: int = 0


@dataclass(frozen=True)
class Head:
    """A trained linear head in the features' own units; a regression's output is in the label's units."""

    job: Job
    weights: np.ndarray  # (outputs, features)
    intercept: np.ndarray
    mean: float = 0.0
    std: float = 1.0


def arrange(items: DataFrame, split: DataFrame, batches: int) -> DataFrame:
    """items with the folds in which their patient is in fit, validate and test, written once by batch.

    split: fold (a whole number from 0), patient_id, category. Patients in no fold are left out."""
    in_ = lambda c: F.array_sort(F.collect_set(F.when(F.col("category") == c, F.col("fold").cast("int")))).alias(f"_{c}")
    roles = split.groupBy("patient_id").agg(*[in_(c) for c in ("fit", "validate", "test")])
    rows = items.join(roles, "patient_id").withColumn("_batch", F.pmod(F.xxhash64("patient_id"), F.lit(batches)).cast("int"))
    path = sinks.fresh(items.sparkSession, "arranged")
    rows.write.partitionBy("_batch").parquet(path)
    return items.sparkSession.read.schema(rows.schema).parquet(path)


def _members(folds: Iterable, n: int) -> np.ndarray:
    """(rows, folds): whether a row is in each of the first n folds."""
    sizes = [len(f) for f in folds]
    out = np.zeros((len(sizes), n), bool)
    if sum(sizes):
        row, at = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.asarray(f, np.int64) for f in folds])
        out[row[at < n], at[at < n]] = True
    return out


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.array(pdf["features"].tolist(), float)


def _summed(rows: DataFrame, columns: Sequence[str], of: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of the vectors that `of` gives for a batch of rows: each task sends one vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += of(pdf)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "value": total[at]})

    got = rows.select(*columns).mapInPandas(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(size)
    out[got["at"].to_numpy(np.int64)] = got["value"].to_numpy()
    return out


def _valid(y: np.ndarray, objective: str) -> np.ndarray:
    return np.isfinite(y) if objective == "regression" else np.isfinite(y) & (y >= 0)


def _moments(rows: DataFrame, folds: int, objective: str, classes: int, dim: int) -> dict[str, np.ndarray]:
    """By fold, over its fit rows: rows, mean and sd of each feature, mean and sd of the label, rows of each class. One pass."""
    width = 1 + 2 * dim + 2 + classes

    def of(pdf: pd.DataFrame) -> np.ndarray:
        x, y = _matrix(pdf), pdf["label"].to_numpy(float)
        good = _valid(y, objective)
        m = (_members(pdf["_fit"], folds) & good[:, None]).astype(float)
        y = np.where(good, y, 0.0)
        onehot = (y[:, None] == np.arange(classes)).astype(float)
        return np.concatenate([m.sum(0)[:, None], m.T @ x, m.T @ (x * x), m.T @ np.stack([y, y * y], 1), m.T @ onehot], 1).ravel()

    s = _summed(rows, ["_fit", "label", "features"], of, folds * width).reshape(folds, width)
    n = np.maximum(s[:, :1], 1)
    mean, square = s[:, 1 : 1 + dim] / n, s[:, 1 + dim : 1 + 2 * dim] / n
    sd = np.sqrt(np.maximum(square - mean**2, 0))
    y, y2 = s[:, 1 + 2 * dim] / n[:, 0], s[:, 2 + 2 * dim] / n[:, 0]
    y_sd = np.sqrt(np.maximum(y2 - y**2, 0))
    return {
        "n": s[:, 0],
        "mean": mean,
        "sd": np.where(sd > 1e-9 * np.maximum(1, np.abs(mean)), sd, 1.0),
        "y": np.where(s[:, 0] < 2, 0.0, y),
        "y_sd": np.where((s[:, 0] < 2) | (y_sd <= 0), 1.0, y_sd),
        "counts": s[:, 3 + 2 * dim :],
    }


def _class_weights(job: Job, counts: np.ndarray) -> np.ndarray:
    w = np.ones(len(counts))
    if job.recipe.class_weight == "balanced":
        w = np.where(counts > 0, counts.sum() / (len(counts) * np.maximum(counts, 1)), 1.0)
    elif job.recipe.class_weight is not None:
        for k, v in job.recipe.class_weight.items():
            w[int(k)] = v
    return w


def _outputs(z: np.ndarray, objective: str) -> np.ndarray:
    """(rows, models, outputs) of linear scores."""
    if objective == "binary":
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    if objective == "multiclass":
        e = np.exp(z - z.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True)
    return z


def _same_kind(jobs: Sequence[Job]) -> tuple[str, int, int]:
    """(objective, classes, outputs) of jobs that one pass can train."""
    kinds = {(j.recipe.objective, j.recipe.classes) for j in jobs}
    if len(kinds) != 1 or next(iter(kinds))[0] not in TRAINED:
        raise ValueError(f"jobs must share one objective of {', '.join(TRAINED)}")
    objective, classes = next(iter(kinds))
    return objective, (2 if objective == "binary" else classes if objective == "multiclass" else 0), (classes if objective == "multiclass" else 1)


def train(rows: DataFrame, jobs: Sequence[Job], how: Descent = Descent()) -> list[Head]:
    """The heads of all jobs, from rows of `arrange`.

    A step adds up the gradients of all models in one pass over their batches' rows; tasks send one number a weight. The
    moments that standardise features and labels come from each fold's fit rows, in one pass. The penalty is half of reg times the squared
    weights of standardised features, the loss is a weighted mean. Equal seeds give equal heads, whatever the partitioning."""
    out: list[Head] = []
    for a in range(0, len(jobs), how.at_once):
        out += _train(rows, jobs[a : a + how.at_once], how)
    return out


def _train(rows: DataFrame, jobs: Sequence[Job], how: Descent) -> list[Head]:
    objective, classes, k = _same_kind(jobs)
    first = rows.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("no rows to train on")
    dim, n_jobs, folds = first["n"], len(jobs), 1 + max(j.fold for j in jobs)
    known = _moments(rows, folds, objective, classes, dim)
    fold = np.array([j.fold for j in jobs])
    mean, sd = known["mean"][fold], known["sd"][fold]
    y_mean, y_sd = (known["y"][fold], known["y_sd"][fold]) if objective == "regression" else (np.zeros(n_jobs), np.ones(n_jobs))
    weight = np.array([_class_weights(j, known["counts"][j.fold]) for j in jobs]) if classes else np.ones((n_jobs, 1))
    reg = np.array([j.recipe.reg for j in jobs])[:, None, None]
    draws = [np.random.default_rng(j.seed) for j in jobs]
    w = np.stack([how.start * d.standard_normal((k, dim)) for d in draws])
    b = np.zeros((n_jobs, k))
    orders = np.array([np.concatenate([d.permutation(how.batches) for _ in range(how.epochs)]) for d in draws])
    m1 = [np.zeros_like(w), np.zeros_like(b)]
    m2 = [np.zeros_like(w), np.zeros_like(b)]
    size = n_jobs * k * (dim + 1) + n_jobs
    late: list[list[np.ndarray]] = []
    steps = orders.shape[1]
    for step in range(steps):
        turn = orders[:, step]
        own = w / sd[:, None, :]
        slope, base = own.reshape(n_jobs * k, dim).T, b - (own * mean[:, None, :]).sum(2)

        def of(pdf: pd.DataFrame, slope=slope, base=base, turn=turn) -> np.ndarray:
            x, y = _matrix(pdf), pdf["label"].to_numpy(float)
            good = _valid(y, objective)
            y = np.where(good, y, 0.0)
            mask = _members(pdf["_fit"], folds)[:, fold] & (pdf["_batch"].to_numpy()[:, None] == turn) & good[:, None]
            p = _outputs((x @ slope).reshape(len(x), n_jobs, k) + base, objective)
            if objective == "regression":
                target, of_row = ((y[:, None] - y_mean) / y_sd)[:, :, None], mask.astype(float)
            else:
                target = (y[:, None] == (np.arange(k) if k > 1 else np.ones(1))).astype(float)[:, None, :]
                of_row = mask * weight[:, y.astype(np.int64)].T
            r = (p - target) * of_row[:, :, None]
            return np.concatenate([(x.T @ r.reshape(len(x), -1)).T.ravel(), r.sum(0).ravel(), of_row.sum(0)])

        wanted = sorted({int(t) for t in turn})
        g = _summed(rows.where(F.col("_batch").isin(wanted)), ["_fit", "_batch", "label", "features"], of, size)
        gx, gs, n = g[: n_jobs * k * dim].reshape(n_jobs, k, dim), g[n_jobs * k * dim : -n_jobs].reshape(n_jobs, k), np.maximum(g[-n_jobs:], 1e-12)
        grad_w = (gx - gs[:, :, None] * mean[:, None, :]) / sd[:, None, :] / n[:, None, None] + reg * w
        grads = [np.round(grad_w, 10), np.round(gs / n[:, None], 10)]  # sums of other orders give the same steps
        rate = how.rate / (1 + 8 * step / steps)
        for value, grad, a, c in zip((w, b), grads, m1, m2, strict=True):
            a *= 0.8
            a += 0.2 * grad
            c *= 0.99
            c += 0.01 * grad**2
            value -= rate * (a / (1 - 0.8 ** (step + 1))) / (np.sqrt(c / (1 - 0.99 ** (step + 1))) + 1e-8)
        if step >= steps - max(1, how.batches):
            late.append([w.copy(), b.copy()])  # the last epoch's mean evens out its batches
    w, b = (np.mean([x[i] for x in late], axis=0) for i in (0, 1))
    own = w / sd[:, None, :]
    base = b - (own * mean[:, None, :]).sum(2)
    return [Head(j, own[i], base[i], float(y_mean[i]), float(y_sd[i])) for i, j in enumerate(jobs)]


def scored(heads: Sequence[Head], features: Column | str = "features") -> Column:
    """The outputs of all heads, one after the other, from one pass over the features."""
    objective = heads[0].job.recipe.objective
    slope = np.concatenate([h.weights for h in heads]).T
    base = np.stack([h.intercept for h in heads])
    mean, std = (np.array([getattr(h, c) for h in heads])[:, None] for c in ("mean", "std"))

    @F.pandas_udf("array<double>")
    def run(column: pd.Series) -> pd.Series:
        x = np.array(column.tolist(), float).reshape(len(column), slope.shape[0])
        p = _outputs((x @ slope).reshape(len(x), *base.shape) + base, objective)
        return pd.Series(list((p * std + mean).reshape(len(x), -1)))

    return run(F.col(features) if isinstance(features, str) else features)


def _value(all_: Column, at: Column, head: Head) -> Column:
    k = len(head.intercept)
    return F.slice(all_, at * k + 1, k) if head.job.recipe.objective == "multiclass" else F.element_at(all_, (at + 1).cast("int"))


def predict(rows: DataFrame, heads: Sequence[Head], category: str = "test", fold: str = "fold") -> DataFrame:
    """Every row of `category` in a head's fold with that head's output: the columns of items but features, and the fold."""
    of = {h.job.fold: i for i, h in enumerate(heads)}
    if len(of) != len(heads):
        raise ValueError("one head a fold")
    place = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])
    mine = F.filter(f"_{category}", lambda f: place[f].isNotNull())
    out = rows.where(F.size(mine) > 0).withColumn("_all", scored(heads)).withColumn(fold, F.explode(mine))
    return out.withColumn(OUTPUT[heads[0].job.recipe.objective], _value(F.col("_all"), place[F.col(fold)], heads[0])).drop("_all", "features", "_fit", "_validate", "_test", "_batch")


def losses_of(rows: DataFrame, heads: Sequence[Head], category: str = "validate") -> np.ndarray:
    """The mean loss of each head on its fold's rows of a category, in one pass: log loss, cross entropy or squared error of the z-score."""
    objective, folds = heads[0].job.recipe.objective, 1 + max(h.job.fold for h in heads)
    fold = np.array([h.job.fold for h in heads])
    slope, base = np.concatenate([h.weights for h in heads]).T, np.stack([h.intercept for h in heads])
    mean, std = (np.array([getattr(h, c) for h in heads]) for c in ("mean", "std"))

    def of(pdf: pd.DataFrame) -> np.ndarray:
        x, y = _matrix(pdf), pdf["label"].to_numpy(float)
        good = _valid(y, objective)
        y = np.where(good, y, 0.0)
        mask = _members(pdf[f"_{category}"], folds)[:, fold] & good[:, None]
        p = _outputs((x @ slope).reshape(len(x), *base.shape) + base, objective)
        if objective == "regression":
            each = (p[:, :, 0] - (y[:, None] - mean) / std) ** 2
        else:
            p = np.clip(p, 1e-9, 1 - 1e-9)
            right = np.take_along_axis(p, np.broadcast_to(y.astype(np.int64)[:, None, None], (*p.shape[:2], 1)), 2)[:, :, 0] if p.shape[2] > 1 else np.where(y[:, None] == 1, p[:, :, 0], 1 - p[:, :, 0])
            each = -np.log(right)
        return np.concatenate([(each * mask).sum(0), mask.sum(0)])

    got = _summed(rows, [f"_{category}", "label", "features"], of, 2 * len(heads))
    n = got[len(heads) :]
    return np.where(n > 0, got[: len(heads)] / np.maximum(n, 1), np.inf)


def sweep(items: DataFrame, split: DataFrame, recipes: Mapping[str, Recipe], folds: Sequence[tuple[int, int]], *, seed: int = 0, how: Descent = Descent()):
    """Fit each recipe on fit, keep the one of least loss on validate, predict test: (predictions, choices, heads).

    items: slide_id, patient_id, label, features. All folds and recipes share one arrangement of the rows, one pass for moments, the
    passes of the descent, one for the validation losses and one for the predictions; their number does not depend on
    the number of folds or recipes. heads has the chosen head of each (outer, inner)."""
    spark = items.sparkSession
    table = spark.createDataFrame([(o, i, k) for k, (o, i) in enumerate(folds)], "outer_fold int, inner_fold int, fold int")
    rows = arrange(items, split.join(F.broadcast(table), ["outer_fold", "inner_fold"]).select("fold", "patient_id", "category"), how.batches)
    jobs = [(k, name) for k in range(len(folds)) for name in recipes]
    heads = train(rows, [Job(k, recipes[name], seed) for k, name in jobs], how)
    found = losses_of(rows, heads)
    best = {k: min((found[i], name, i) for i, (f, name) in enumerate(jobs) if f == k) for k in range(len(folds))}
    chosen = [heads[best[k][2]] for k in range(len(folds))]
    preds = predict(rows, chosen).join(F.broadcast(table), "fold").drop("fold")
    choices = spark.createDataFrame([(*folds[k], name, float(loss)) for k, (loss, name, _) in best.items()], "outer_fold int, inner_fold int, candidate string, loss double")
    return preds, choices, {folds[k]: chosen[k] for k in range(len(folds))}


def score_with_all(heads: Mapping[tuple[int, int], Head], items: DataFrame) -> DataFrame:
    """An external or unlabelled cohort scored by every development fold, in one pass."""
    own = list(heads.values())
    folds = F.array(*[F.struct(F.lit(o).alias("outer_fold"), F.lit(i).alias("inner_fold")) for o, i in heads])
    out = items.withColumn("_all", scored(own)).select("*", F.posexplode(folds).alias("_at", "_fold"))
    out = out.withColumn(OUTPUT[own[0].job.recipe.objective], _value(F.col("_all"), F.col("_at"), own[0]))
    return out.withColumn("outer_fold", F.col("_fold.outer_fold")).withColumn("inner_fold", F.col("_fold.inner_fold")).drop("_all", "_at", "_fold", "features")


def run_trials(items: DataFrame, patients: DataFrame, recipe: Recipe, arm: str, field: str, seeds: Sequence[int], reps: Sequence[int], git_sha: str, *, test: float = 0.3, how: Descent = Descent()) -> DataFrame:
    """Draw, fit, score: a row a trial (X12). Reps of a seed share its split; each has its own training seed, which draws the
    first weights and the order of the batches, so reps differ as far as training does. All trials train in the same passes. n_declared counts
    the drawn test patients, n_test those that got a score."""
    from tesserine.functions import labels as L
    from tesserine.functions import metrics as M
    from tesserine.operators.rollup import slides_to_patients
    from tesserine.operators.splits import draw, split_digest

    spark = items.sparkSession
    trials = [(s, r) for s in seeds for r in reps]
    draws = None
    for s in seeds:
        one = draw(patients.withColumn("field", F.lit(field)), s, test).withColumn("seed", F.lit(s))
        draws = one if draws is None else draws.unionByName(one)
    path = sinks.fresh(spark, "draws")
    draws.write.parquet(path)
    draws = spark.read.parquet(path)
    table = spark.createDataFrame([(s, r, k, L.train_seed_of(arm, s, r)) for k, (s, r) in enumerate(trials)], "seed int, rep int, fold int, train_seed long")
    rows = arrange(items, draws.join(F.broadcast(table), "seed").select("fold", "patient_id", "category"), how.batches)
    heads = train(rows, [Job(k, recipe, L.train_seed_of(arm, s, r)) for k, (s, r) in enumerate(trials)], how)
    key, metric, _ = M.resolve_metric(recipe.objective)
    scored_ = slides_to_patients(predict(rows, heads), ["fold"], OUTPUT[recipe.objective])
    n = scored_.groupBy("fold").agg(F.count("*").cast("int").alias("n_test"))
    digest = split_digest(draws, ["seed", "field"]).select("seed", "split_hash")
    declared = draws.where(F.col("category") == "test").groupBy("seed").agg(F.countDistinct("patient_id").cast("int").alias("n_declared"))
    out = metric(scored_, ["fold"]).join(n, "fold").join(F.broadcast(table), "fold").join(digest, "seed").join(declared, "seed")
    return out.select(
        F.lit(arm).alias("arm"), F.lit(field).alias("field"), "seed", "rep", "metric", F.lit(key).alias("metric_key"), "n_declared", "n_test", "split_hash", "train_seed",
        F.lit(git_sha).alias("git_sha"),
    )
