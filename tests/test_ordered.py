"""Exact quantiles and ordinal ranks over groups of any size, with ties."""

import random

import pytest
from pyspark.sql import functions as F

from tesserine.operators import ordered, profile
from tesserine.operators.ordered import attach_quantiles, row_numbers

PROBS = (0.0, 0.05, 0.25, 0.5, 0.77, 1.0)


def frame(spark, seed=0, n=600):
    r = random.Random(seed)
    value = lambda: r.choice([None, 0.0, -0.0, 1.0, 5.0, r.uniform(-3, 3), r.gauss(0, 1e9), r.uniform(0, 1e-9), float("inf"), -float("inf")])
    rows = [(r.choice(["a", "b", None]), r.choice([1, None]), value(), r.randrange(5)) for _ in range(n)] + [("empty", 1, None, None), ("one", 1, 7.0, 3), ("nan", 1, float("nan"), 1), ("nan", 1, 2.0, 1)]
    return spark.createDataFrame(rows, "g string, h int, x double, k int")


@pytest.mark.parametrize("by", [["g", "h"], ["g"], []])
def test_quantiles_equal_percentile(spark, by):
    df = frame(spark).repartition(5)
    probs = F.array(*[F.lit(p) for p in PROBS])
    want = df.groupBy(*by).agg(F.percentile("x", probs).alias("q"), F.percentile("k", 0.5).alias("m"))
    got = attach_quantiles(df.groupBy(*by).agg(F.count("*").alias("n")), df, by, {"q": ("x", PROBS), "m": ("k", (0.5,))})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    rows = lambda d: sorted((str([r[c] for c in by]), None if r.q is None else [str(v + 0.0) for v in r.q], r.m if not isinstance(r.m, list) else r.m[0]) for r in d.collect())
    assert rows(got) == rows(want)


def test_no_operator_keeps_a_group_in_one_buffer(spark):
    df = frame(spark).withColumn("time", F.abs("x")).withColumn("event", F.col("k") % 2)
    out = profile.survival_summary(df.where("x IS NOT NULL"), ["g"])
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tie", ["id", "name", "when"])
def test_ranks_with_heavy_ties(spark, monkeypatch, descending, tie):
    r = random.Random(1)
    rows = []
    for i in r.sample(range(100_000), 900):
        x = 4.0 if r.random() < 0.5 else 4.0001 if r.random() < 0.2 else r.choice([None, float("nan"), r.uniform(-5, 5), 3.9999])
        rows.append((r.choice("ab"), x, i, f"patient-{i:05d}" + r.choice(["", "é"])))
    df = spark.createDataFrame(rows, "g string, x double, id long, name string").withColumn("when", F.timestamp_seconds("id"))
    monkeypatch.setattr(ordered, "HOT_SHARE", 20)
    got = row_numbers(df, ["g"], "x", tie, descending=descending).collect()
    big = lambda x: (x is not None, (2, 0) if x is not None and x != x else (1, x or 0))  # noqa: E731  null, numbers, NaN
    for g in "ab":
        own = [q for q in got if q.g == g]
        key = lambda q: q[tie].encode() if tie == "name" else q[tie]
        tied = sorted(own, key=key)
        want = sorted(tied, key=lambda q: big(q.x), reverse=False)
        if descending:
            want = sorted(tied, key=lambda q: tuple(-v if isinstance(v, (int, float)) else v for v in (big(q.x)[0], *big(q.x)[1])))
        assert {q.id: q["rank"] for q in own} == {q.id: k for k, q in enumerate(want, 1)}


def test_one_value_in_half_of_all_rows_spreads_over_tasks(spark):
    n = 200_000
    df = spark.range(n).select(F.col("id"), F.concat(F.lit("patient-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(F.col("id") / 7.0 + 0.01).alias("x"), F.lit("g").alias("g"))
    out = row_numbers(df, ["g"], "x", "name")
    assert out.where("x = 1.0").agg(F.max("rank") - F.min("rank")).first()[0] == n // 2 - 1
    # the pieces of the tied value, as the operator deals them
    hot = df.where("x = 1.0").agg(F.min("name").alias("a"), F.max("name").alias("z"))
    sizes = df.where("x = 1.0").crossJoin(hot).groupBy(ordered._between(F.col("name"), "string", F.col("a"), F.col("z"), F.lit(11))).count()
    assert sizes.agg(F.max("count")).first()[0] <= n / 2 / 50


def test_as_of_join_against_a_scan(spark):
    r = random.Random(4)
    moment = lambda: r.choice([None, 0.0, r.uniform(-5, 5), float(r.randrange(-3, 3)), r.gauss(0, 1e6)])
    right = [(r.choice("ab"), moment(), r.randrange(100), "x") for _ in range(150)]
    left = [(k, r.choice("abc"), moment(), "l") for k in range(200)]
    got = ordered.as_of(spark.createDataFrame(left, "id int, g string, t double, _row string"), spark.createDataFrame(right, "g string, t double, v int, _row string"), ["g"], "t", ["v"])
    assert got.columns == ["id", "g", "t", "_row", "v"]
    found = {q.id: q.v for q in got.collect()}
    for k, g, t, _ in left:
        earlier = [(u, v) for h, u, v, _ in right if h == g and u is not None and t is not None and u <= t]
        assert found[k] == (max(earlier)[1] if earlier else None)
