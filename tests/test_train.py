"""Joint training: against closed forms and pyspark.ml, seeds, folds, and a trial's parts."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tesserine.operators import compare as C
from tesserine.operators import fit as X
from tesserine.operators import splits as S
from tesserine.operators import train as T

ITEMS = "slide_id long, patient_id string, features array<double>, label double, extra string"


def rows(seed=0, n=400, d=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) * np.array([1, 5, 0.2])[:d] + np.array([0, 3, -1])[:d]
    return x, r


def frame(spark, x, y):
    return spark.createDataFrame([(i, f"p{i // 2}", [float(v) for v in x[i]], float(y[i]), "e") for i in range(len(x))], ITEMS)


def split_of(spark, n, folds=2):
    """Fold f tests patients with i % (folds + 2) = f and validates the next ones."""
    out = []
    for f in range(folds):
        for i in range(n // 2):
            k = i % (folds + 2)
            out.append((f, f"p{i}", "test" if k == f else "validate" if k == f + 1 else "fit"))
    return spark.createDataFrame(out, "fold int, patient_id string, category string")


def test_regression_against_the_closed_form(spark):
    x, r = rows()
    y = x @ np.array([2.0, -0.5, 8.0]) + 4 + r.normal(size=len(x))
    table = T.arrange(frame(spark, x, y), split_of(spark, len(x)), 2)
    heads = T.train(table, [T.Job(f, X.Recipe("regression", reg=reg)) for f in (0, 1) for reg in (0.0, 0.5)], T.Descent(epochs=40, batches=2))
    for h in heads:
        fit = np.array([(i // 2) % 4 not in (h.job.fold, h.job.fold + 1) for i in range(len(x))])
        mean, sd, ym, ys = x[fit].mean(0), x[fit].std(0), y[fit].mean(), y[fit].std()
        z, t = (x[fit] - mean) / sd, (y[fit] - ym) / ys
        w = np.linalg.solve(z.T @ z / len(z) + h.job.recipe.reg * np.eye(3), z.T @ t / len(z))
        assert (h.mean, h.std) == (pytest.approx(ym), pytest.approx(ys))
        np.testing.assert_allclose(h.weights[0] * sd, w, atol=0.02)
        np.testing.assert_allclose(x @ h.weights[0] + h.intercept[0], ((x - mean) / sd) @ w, atol=0.05)


@pytest.mark.parametrize("weights", [None, "balanced"])
def test_logistic_against_pyspark(spark, weights):
    x, r = rows(1)
    y = (r.random(len(x)) < 1 / (1 + np.exp(-(x @ np.array([1.0, 0.3, 2.0]) + 2)))).astype(float)
    items = frame(spark, x, y)
    table = T.arrange(items, split_of(spark, len(x)), 2)
    heads = T.train(table, [T.Job(0, X.Recipe("binary", reg=0.05, class_weight=weights))], T.Descent(epochs=40, batches=2))
    part = items.join(split_of(spark, len(x)).where("fold = 0 AND category = 'fit'"), "patient_id").withColumn("v", array_to_vector("features"))
    n = dict(part.groupBy("label").count().collect())
    part = part.withColumn("w", F.lit(1.0) if weights is None else F.when(F.col("label") == 1, sum(n.values()) / 2 / n[1.0]).otherwise(sum(n.values()) / 2 / n[0.0]))
    model = LogisticRegression(featuresCol="v", weightCol="w", regParam=0.05).fit(part)
    got = 1 / (1 + np.exp(-(x @ heads[0].weights[0] + heads[0].intercept[0])))
    want = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    np.testing.assert_allclose(got, want, atol=0.03)


def test_multiclass_learns(spark):
    x, _ = rows(2)
    y = np.digitize(x[:, 0], [-0.5, 0.5])
    table = T.arrange(frame(spark, x, y), split_of(spark, len(x)), 2)
    heads = T.train(table, [T.Job(f, X.Recipe("multiclass", classes=3, reg=0.0)) for f in (0, 1)], T.Descent(epochs=20, batches=2))
    got = T.predict(table, heads).collect()
    assert np.mean([int(np.argmax(g.probs)) == int(g.label) for g in got]) > 0.85
    assert all(abs(sum(g.probs) - 1) < 1e-9 for g in got) and {g.extra for g in got} == {"e"}


def test_seeds_and_joint_training(spark):
    """Equal seeds give equal heads, also beside other models and over other partitions; unequal ones don't."""
    x, r = rows(3)
    y = (r.random(len(x)) < 0.5).astype(float)
    split, how = split_of(spark, len(x)), T.Descent(epochs=2, batches=3)
    recipe = X.Recipe("binary")
    table = T.arrange(frame(spark, x, y), split, 3)
    together = T.train(table, [T.Job(0, recipe, 7), T.Job(1, recipe, 7), T.Job(0, recipe, 8), T.Job(0, recipe, 7)], how)
    alone = T.train(T.arrange(frame(spark, x, y).repartition(7), split, 3), [T.Job(0, recipe, 7)], how)[0]
    np.testing.assert_allclose(together[0].weights, alone.weights, atol=1e-8)
    np.testing.assert_array_equal(together[0].weights, together[3].weights)
    assert np.abs(together[0].weights - together[2].weights).max() > 1e-3
    assert np.abs(together[0].weights - together[1].weights).max() > 1e-3


def test_passes_do_not_grow_with_folds(spark, monkeypatch):
    x, r = rows(4, 120)
    y = (r.random(len(x)) < 0.5).astype(float)
    split = split_of(spark, len(x), 4).withColumnRenamed("fold", "outer_fold").withColumn("inner_fold", F.lit(0))
    passes, plain = [], T._summed
    monkeypatch.setattr(T, "_summed", lambda *a: passes.append(1) or plain(*a))
    seen = {}
    for folds, recipes in (([(0, 0)], {"a": X.Recipe("binary")}), ([(k, 0) for k in range(4)], {"a": X.Recipe("binary"), "b": X.Recipe("binary", reg=1.0)})):
        passes.clear()
        preds, choices, heads = T.sweep(frame(spark, x, y), split, recipes, folds, how=T.Descent(epochs=2, batches=2))
        seen[len(folds)] = (len(passes), {(p.outer_fold, p.slide_id): p.prob for p in preds.collect()}, {c.outer_fold: c.candidate for c in choices.collect()})
        assert set(heads) == set(folds)
    assert seen[1][0] == seen[4][0] == 1 + 4 + 1
    if seen[4][2][0] == "a":
        assert all(abs(p - seen[4][1][k]) < 1e-8 for k, p in seen[1][1].items())
    assert len(seen[4][1]) == sum(1 for i in range(120) for f in range(4) if (i // 2) % 6 == f)


def test_trials_differ_by_training_and_repeat_themselves(spark):
    x, r = rows(5, 240)
    y = (r.random(len(x)) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    items = frame(spark, x, y)
    patients = items.groupBy("patient_id").agg(F.max("label").cast("int").alias("stratum"))
    lost = min(p.patient_id for p in S.draw(patients.withColumn("field", F.lit("f")), 1, 0.3).where("category = 'test'").collect())
    items = items.where(F.col("patient_id") != lost)
    how = T.Descent(epochs=2, batches=3)
    make = lambda seeds, reps: {(t.seed, t.rep): t for t in T.run_trials(items, patients, X.Recipe("binary"), "a", "f", seeds, reps, "x", how=how).collect()}
    got = make((1, 2), (0, 1, 2))
    assert len({round(got[1, k].metric, 9) for k in range(3)}) > 1 and got[1, 1].metric != got[1, 2].metric
    assert len({got[1, k].split_hash for k in range(3)}) == 1 and got[1, 0].split_hash != got[2, 0].split_hash
    assert len({t.train_seed for t in got.values()}) == 6
    declared = S.draw(patients.withColumn("field", F.lit("f")), 1, 0.3).where("category = 'test'").count()
    assert (got[1, 0].n_declared, got[1, 0].n_test) == (declared, declared - 1)
    again = make((1,), (2,))[1, 2]
    assert again.metric == pytest.approx(got[1, 2].metric, abs=1e-9) and again.train_seed == got[1, 2].train_seed
    trials = spark.createDataFrame([(*t[:5], "auroc") for t in got.values()], "arm string, field string, seed int, rep int, metric double, metric_key string")
    assert C.margin(C.null_deltas(trials)).first().margin > 0


def test_external_scores_by_all_heads(spark):
    heads = {(0, 0): T.Head(T.Job(0, X.Recipe("binary")), np.array([[1.0, 0.0]]), np.array([0.0])), (1, 0): T.Head(T.Job(1, X.Recipe("binary")), np.array([[0.0, 2.0]]), np.array([1.0]))}
    items = spark.createDataFrame([("a", [0.0, 0.5], None), ("b", [3.0, -0.5], 4)], "patient_id string, features array<double>, n int")
    got = {(r.patient_id, r.outer_fold): (r.prob, r.n) for r in T.score_with_all(heads, items).collect()}
    s = lambda z: pytest.approx(1 / (1 + np.exp(-z)))
    assert got == {("a", 0): (s(0), None), ("a", 1): (s(2), None), ("b", 0): (s(3), 4), ("b", 1): (s(0), 4)}


def test_gene_heads_against_ridge(spark):
    r = np.random.default_rng(6)
    x, genes = r.normal(size=(90, 4)), 7
    z = np.exp(x @ r.normal(size=(4, genes)) * 0.3 + r.normal(size=(90, genes)) * 0.1)
    items = spark.createDataFrame([(f"p{i}", [float(v) for v in x[i]]) for i in range(90)], "patient_id string, features array<double>")
    values = spark.createDataFrame([(f"p{i}", g, float(z[i, g])) for i in range(60) for g in range(genes) if (i + g) % 11], "patient_id string, gene_id int, value double")
    score = X.fit_genes(items.join(values, "patient_id"), X.Recipe("regression_vector", reg=0.1), part_rows=25)
    test = items.where(F.substring("patient_id", 2, 9).cast("int") >= 60).withColumn("n", F.lit(None).cast("int"))
    got = {(p.patient_id, p.gene_id): p.pred for p in score(test).collect()}
    assert len(got) == 30 * genes
    heads = {}
    for g in range(genes):
        at = np.array([i for i in range(60) if (i + g) % 11])
        t = np.log1p(z[at, g])
        t = (t - t.mean()) / t.std()
        xx = np.column_stack([x[at], np.ones(len(at))])
        heads[g] = np.linalg.solve(xx.T @ xx + np.diag([0.1 * len(at)] * 4 + [0.0]), xx.T @ t)
    for (p, g), v in got.items():
        assert v == pytest.approx(float(np.append(x[int(p[1:])], 1.0) @ heads[g]), abs=1e-9)
    few = spark.createDataFrame([(g, [float(v) for v in heads[g]]) for g in range(genes)], "gene_id int, w array<double>")
    blocked = {(p.patient_id, p.gene_id): p.pred for p in X.blocked_product(test, few, genes, rows=4, genes=2).collect()}
    assert set(blocked) == set(got) and all(blocked[k] == pytest.approx(got[k], abs=1e-9) for k in got)
