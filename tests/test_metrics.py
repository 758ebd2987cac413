"""Metrics against plain definitions, on ties, single classes and constants, and under changes that must not matter."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserine.functions import metrics as M
from tesserine.operators.ordered import row_numbers, running_sums, with_pooled


def frame(spark, rows, schema="g string, prob double, label int"):
    return spark.createDataFrame(rows, schema)


def plain_auroc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.fixture(scope="module")
def scored():
    r = random.Random(0)
    return [(g, r.choice([round(r.random(), 1), r.random(), 0.5]), r.randrange(2)) for g in "abc" for _ in range(60)] + [("one", 0.3, 1), ("one", 0.2, 1)]


def test_auroc_and_average_precision(spark, scored):
    got = {r.g: r.auroc for r in M.auroc(frame(spark, scored), ["g"]).collect()}
    ap = {r.g: r.average_precision for r in M.average_precision(frame(spark, scored), ["g"]).collect()}
    for g in "abc":
        pairs = [(s, y) for k, s, y in scored if k == g]
        assert got[g] == pytest.approx(plain_auroc(pairs))
        want, last = 0.0, 0.0
        for t in sorted({s for s, _ in pairs}, reverse=True):
            hit = [y for s, y in pairs if s >= t]
            rec = sum(hit) / sum(y for _, y in pairs)
            want += (rec - last) * sum(hit) / len(hit)
            last = rec
        assert ap[g] == pytest.approx(want)
    assert got["one"] is None and ap["one"] == 1.0


def test_auroc_ignores_monotone_maps_and_partitions(spark, scored):
    df = frame(spark, scored)
    same = lambda x: {r.g: r.auroc for r in M.auroc(x, ["g"]).collect()}
    a = same(df)
    assert a == same(df.repartition(7)) == same(df.withColumn("prob", F.exp(F.col("prob") * 3) * 1e6)) == same(df.withColumn("prob", F.col("prob") - 1000))
    assert same(df.where("label < 0")) == {}


def test_confusion_guards(spark):
    r = M.confusion(frame(spark, [("a", 0.9, 1), ("a", 0.5, 1)]), ["g"]).first()
    assert (r.accuracy, r.sensitivity, r.specificity, r.mcc, r.balanced_accuracy, r.n_positive) == (1.0, 1.0, None, None, None, 2)


def test_running_sums_and_ranks_with_any_values(spark):
    r = random.Random(1)
    rows = [("g", r.choice([r.gauss(0, 1e6), r.random(), 0.0, -3.0]), 1, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double, v int, id int")
    for down in (False, True):
        got = running_sums(df, ["g"], "x", ["v"], descending=down).collect()
        for a in got[::20]:
            assert a.cum_v == sum((b[1] >= a.x) if down else (b[1] <= a.x) for b in rows)
        order = [x.id for x in sorted(row_numbers(df, ["g"], "x", "id", descending=down).collect(), key=lambda x: x["rank"])]
        assert order == [b[3] for b in sorted(rows, key=lambda b: (-b[1] if down else b[1], b[3]))]


def test_regression_degenerate(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, "p"), ("a", 1.0, 2.0, "q"), ("b", 1.0, 1.0, "p"), ("b", 2.0, 3.0, "q"), ("b", 0.0, float("nan"), "r")], "g string, pred double, label double, patient_id string")
    got = {r.g: r for r in M.regression_metrics(df, ["g"]).collect()}
    assert (got["a"].pearson, got["a"].r2, got["a"].spearman, got["a"].mae) == (None, None, None, 1.0)
    assert got["b"].n == 2 and got["b"].pearson == pytest.approx(1.0) and got["b"].rmse == pytest.approx(math.sqrt(0.5))


def plain_c(rows):
    good = pairs = 0.0
    for t, e, r in rows:
        for u, _, s in rows:
            if e and u > t:
                pairs += 1
                good += (r > s) + (r == s) / 2
    return good / pairs if pairs else None


def test_concordance(spark):
    r = random.Random(2)
    rows = [("g", float(r.choice([r.randrange(30), r.randrange(2000)])), r.randrange(2), r.choice([r.random(), 0.5, r.gauss(0, 50)])) for _ in range(250)] + [("none", 1.0, 0, 1.0), ("none", 2.0, 0, 0.0)]
    got = {x.g: x.c_index for x in M.concordance(spark.createDataFrame(rows, "g string, time double, event int, risk double"), ["g"]).collect()}
    assert got["g"] == pytest.approx(plain_c([x[1:] for x in rows if x[0] == "g"])) and got["none"] is None


def test_kaplan_meier(spark):
    rows = [("g", 1.0, 1), ("g", 2.0, 0), ("g", 2.0, 1), ("g", 5.0, 1)]
    got = sorted((r.time, r.at_risk, r.events, round(r.survival, 6)) for r in M.kaplan_meier(spark.createDataFrame(rows, "g string, time double, event int"), ["g"]).collect())
    assert got == [(0.0, 4, 0, 1.0), (1.0, 4, 1, 0.75), (2.0, 3, 1, 0.5), (5.0, 1, 1, 0.0)]


def test_multiclass(spark):
    rows = [("a", [0.5, 0.5, 0.0], 0), ("a", [0.1, 0.8, 0.1], 1), ("a", [0.1, 0.2, 0.7], 1), ("a", [0.3, 0.3, 0.4], -1)]
    df = spark.createDataFrame(rows, "g string, probs array<double>, label int")
    per = {r["class"]: r for r in M.multiclass_per_class(df, ["g"], 3).collect()}
    assert per[2].support == 0 and per[2].auroc is None and per[0].recall == 1.0 and per[1].recall == 0.5
    m = M.multiclass_metrics(df, ["g"], 3).first()
    assert m.n == 3 and m.accuracy == pytest.approx(2 / 3) and m.balanced_accuracy == pytest.approx(0.75)
    perfect = M.quadratic_kappa(df.where("label = 0"), ["g"]).first()
    assert perfect.quadratic_kappa is None
    assert M.confusion_matrix(df, ["g"], 3).count() == 9


def test_genes(spark):
    r = np.random.default_rng(3)
    rows = [(f"g{g}", f"p{p}", float(x := r.normal()), float(x * (g > 10) + r.normal() * 0.3) if g else 1.0, float(r.normal())) for g in range(30) for p in range(40)]
    df = spark.createDataFrame(rows, "gene_id string, patient_id string, pred double, label double, base double")
    per = M.gene_pearson(df)
    assert {x.gene_id for x in per.where("pearson is null").collect()} == {"g0"}
    n = M.significant_genes(per).first().n_significant
    assert 18 <= n <= 22
    wins = M.beats_random(df.select("gene_id", "patient_id", "pred", "label"), df.select("gene_id", "patient_id", F.col("base").alias("pred"), "label")).where("beats").collect()
    assert len(wins) >= 15 and not {x.gene_id for x in wins} & {f"g{k}" for k in range(5)}
    null = M.beats_random(df.select("gene_id", "patient_id", F.col("base").alias("pred"), "label"), df.select("gene_id", "patient_id", "pred", "label")).where("beats").count()
    assert null == 0
    p = spark.createDataFrame([(f"g{k}", v) for k, v in enumerate([0.01, 0.04, 0.03, 0.5])], "gene_id string, p double")
    assert {x.gene_id: round(x.q_value, 6) for x in M.benjamini_hochberg(p, [], "p", "gene_id").collect()} == {"g0": 0.04, "g1": 0.053333, "g2": 0.053333, "g3": 0.5}
    tail = spark.createDataFrame([(0.0,), (1.0,), (-1.0,)], "x double").select(M.erfc("x").alias("y")).collect()
    assert [x.y for x in tail] == pytest.approx([math.erfc(v) for v in (0.0, 1.0, -1.0)])


def test_pooled_is_not_a_mean(spark):
    df = spark.createDataFrame([(0, 0.9, 1), (0, 0.8, 0), (1, 0.2, 1), (1, 0.1, 0)], "outer_fold int, prob double, label int")
    got = {r.outer_fold: r.auroc for r in M.auroc(with_pooled(df), ["outer_fold"]).collect()}
    assert got == {0: 1.0, 1: 1.0, -1: 0.75}


def test_registry_refuses():
    assert M.resolve_metric("survival")[0] == "c_index"
    for bad in (("x", None), ("binary", "r2")):
        with pytest.raises(ValueError):
            M.resolve_metric(*bad)


def test_buckets_are_monotone_and_many(spark):
    """Values far from 0 and close to each other fall in many buckets, in order."""
    from tesserine.operators.ordered import bucket

    r = random.Random(4)
    xs = [10 ** r.uniform(3, 9) for _ in range(2000)] + [-(10 ** r.uniform(-3, 9)) for _ in range(500)] + [0.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), float("nan"), None, 2.0**52, 2.0**52 - 0.5]
    got = [(row.x, row.b) for row in spark.createDataFrame([(x,) for x in xs], "x double").withColumn("b", bucket(F.col("x"))).orderBy("x").collect()]
    assert [b for _, b in got] == sorted(b for _, b in got)
    assert len({b for x, b in got if x is not None and 1e3 <= x <= 1e9}) > 1500


def test_concordance_in_blocks(spark, monkeypatch):
    """With small blocks most pairs are decided between blocks; the result is the same."""
    r = random.Random(9)
    rows = {g: [(float(r.choice([r.randrange(40), r.randrange(10_000)])), r.randrange(2), r.choice([round(r.random(), 1), r.random() * 1e6])) for _ in range(150)] for g in "ab"}
    df = spark.createDataFrame([(g, *x) for g in rows for x in rows[g]] + [("one", 3.0, 1, 0.5)], "g string, time double, event int, risk double")
    for size in (20_000, 20):
        monkeypatch.setattr(M, "BLOCK_ROWS", size)
        got = {x.g: x.c_index for x in M.concordance(df, ["g"]).collect()}
        assert got["one"] is None
        for g in rows:
            assert got[g] == pytest.approx(plain_c(rows[g]))
        assert M.concordance(df.where("g = 'a'"), []).first().c_index == pytest.approx(plain_c(rows["a"]))


def test_survival_reaches_zero(spark):
    rows = [("a", float(t), 1) for t in (5, 1, 3)] + [("b", 1e6, 0), ("b", 2e6, 1), ("b", 2e6, 0), ("b", 3e9, 0)]
    got = {(x.g, x.time): x.survival for x in M.kaplan_meier(frame(spark, rows, "g string, time double, event int"), ["g"]).collect()}
    assert got[("a", 5.0)] == 0.0 and got[("a", 3.0)] == pytest.approx(1 / 3) and got[("b", 2e6)] == pytest.approx(2 / 3) and got[("b", 3e9)] == pytest.approx(2 / 3)


def test_all_classes_are_scored(spark):
    k = 80
    rows = [("g", [1.0 if c == y else 0.0 for c in range(k)], y) for y in range(k)]
    df = spark.createDataFrame(rows, "g string, probs array<double>, label int")
    assert M.multiclass_per_class(df, ["g"]).count() == k
    assert M.resolve_metric("multiclass")[1](df, ["g"]).first().metric == 1.0


def test_beats_random_by_each_criterion(spark):
    """Against the definition in plain Python, with negative correlations and genes of three patients."""
    r = random.Random(12)
    rows, plain = [], {}
    for g in range(30):
        n = 3 if g == 29 else 40
        y = [r.gauss(0, 1) for _ in range(n)]
        sign = -1 if g % 5 == 0 else 1
        p = [sign * v * (0.2 + g / 20) + r.gauss(0, 1) for v in y]
        b = [v * 0.2 + r.gauss(0, 1) for v in y]
        rows += [(g, i, p[i], b[i], y[i]) for i in range(n)]
        r1, r2, r12 = (float(np.corrcoef(u, v)[0, 1]) for u, v in ((p, y), (b, y), (p, b)))
        e1, e2 = (float(np.sqrt(np.mean((np.array(u) - np.array(y)) ** 2))) for u in (p, b))
        if n >= 4:
            p1 = math.erfc(abs(math.atanh(r1)) * math.sqrt(n - 3) / math.sqrt(2))
            det = 1 - r1**2 - r2**2 - r12**2 + 2 * r1 * r2 * r12
            t = (r1 - r2) * math.sqrt((n - 1) * (1 + r12) / (2 * (n - 1) / (n - 3) * det + ((r1 + r2) / 2) ** 2 * (1 - r12) ** 3))
            plain[g] = (r1, r2, p1, math.erfc(t / math.sqrt(2)) / 2, e1, e2)
    tested = sorted(plain, key=lambda g: plain[g][3])
    q, least = {}, 1.0
    for k in range(len(tested), 0, -1):
        least = min(least, plain[tested[k - 1]][3] * len(tested) / k)
        q[tested[k - 1]] = least
    want = {g for g, (r1, r2, p1, p2, e1, e2) in plain.items() if r1 > 0 and p1 < 0.05 and r1 > r2 and p2 < 0.05 and q[g] < 0.2 and e1 < e2}
    df = spark.createDataFrame(rows, "gene_id int, patient_id int, pred double, base double, label double")
    got = M.beats_random(df.select("gene_id", "patient_id", "pred", "label"), df.select("gene_id", "patient_id", F.col("base").alias("pred"), "label")).collect()
    assert {x.gene_id for x in got if x.beats} == want and want
    for x in got:
        if x.gene_id in q:
            assert x.q_value == pytest.approx(q[x.gene_id]) and x.p_better == pytest.approx(plain[x.gene_id][3])
        else:
            assert x.q_value is None and not x.beats


def test_ranks_of_p_values_that_are_0(spark):
    """The largest z comes first although no double tells the p-values apart."""
    rows = [(f"g{k}", r, 50_000) for k, r in enumerate([0.43, 0.47, 0.45])]
    p = spark.createDataFrame(rows, "gene_id string, r double, n long").select("gene_id", M.fisher_z(F.col("r"), F.col("n")).alias("z"), M.fisher_p(F.col("r"), F.col("n")).alias("p"))
    got = M.benjamini_hochberg(p, [], "p", "gene_id", "z").collect()
    assert {x.p for x in got} == {0.0} and {x.gene_id: x["rank"] for x in got} == {"g1": 1, "g2": 2, "g0": 3}


def test_multiclass_metrics_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return row

    rows = [("a", k % 3, [0.2 + k % 5 / 10, 0.3, 0.5 - k % 5 / 10]) for k in range(60)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), "g string, label int, probs array<double>")
    got = M.multiclass_metrics(df, ["g"], 3).collect()
    assert got[0].n == 60 and seen.value == 60
