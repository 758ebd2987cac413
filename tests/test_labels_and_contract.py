"""Target transforms, tie rules and the refusals of the contract."""

import pytest
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.plans.contract import Binarize, Binning, Cohort, Discretize, Endpoint, Study, class_weights, endpoint


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(("raw", "want"), [("3", 3.0), (" 4.5 ", 4.5), ("", None), ("nan", None), ("x", None), ("inf", None), ("-2e1", -20.0)])
def test_number(spark, raw, want):
    assert one(spark, L.number("v"), v=raw) == want


@pytest.mark.parametrize(("raw", "want"), [(" a ", "a"), ("NaN", None), ("None", None), ("", None), ("none ", None), ("no", "no")])
def test_clean(spark, raw, want):
    assert one(spark, L.clean("v"), v=raw) == want


def test_three_tie_rules(spark):
    """A value on a cut goes up for targets, a time on an edge goes down for survival bins."""
    edges = [10.0, 20.0]
    assert [one(spark, L.discretize("v", edges), v=x) for x in (9.0, 10.0, 20.0, 21.0)] == [0, 1, 2, 2]
    assert [one(spark, L.survival_bin("v", edges), v=x) for x in (9.0, 10.0, 20.0, 21.0)] == [0, 0, 1, 2]
    assert [one(spark, L.binarize("v", 10.0), v=x) for x in (9.9, 10.0)] == [0, 1]
    missing = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v").select(L.binarize("v", 1.0), L.discretize("v", edges), L.survival_bin("v", edges)).first()
    assert tuple(missing) == (-1, -1, None)


def test_log1p_refuses_minus_one(spark):
    assert one(spark, L.log1p("v"), v=0.0) == 0.0
    with pytest.raises(Exception, match="log1p"):
        one(spark, L.log1p("v"), v=-1.0)


def test_survival_activations(spark):
    got = one(spark, L.survival(L.hazards("v")), v=[0.0, 0.0])
    assert got == [0.5, 0.25] and one(spark, L.survival_risk("v"), v=[0.0, 0.0]) == -0.75
    assert one(spark, L.argmax("v"), v=[0.2, 0.4, 0.4]) == 1
    assert sum(one(spark, L.softmax("v"), v=[1000.0, 1001.0])) == pytest.approx(1.0)
    assert one(spark, L.bin_ranges([183, 365]), v=1) == ["0-183", "183-365", "365+"]


def test_split_names_round_trip(spark):
    df = spark.createDataFrame([("a_cv_b", 2, 1)], "field string, o int, i int").withColumn("v", L.split_name("field", F.col("o"), F.col("i")))
    got = df.select("v", *[c.alias(k) for k, c in L.split_parts("v").items()]).first()
    assert got.v == "a_cv_b_cv_o2_i1" and (got.field, got.strategy, got.outer_fold, got.inner_fold) == ("a_cv_b", "nested_cv", 2, 1)
    other = spark.createDataFrame([("all_test_er",), ("all_predict",), ("x",)], "v string").select(*[c.alias(k) for k, c in L.split_parts("v").items()]).collect()
    assert [(r.field, r.strategy) for r in other] == [("er", "all_test"), (None, "all_predict"), (None, None)]
    assert [tuple(r) for r in spark.createDataFrame([(0,), (7,), (15,), (-1,)], "f int").select(*L.fold_parts("f", 5, 3)).collect()] == [(0, 0), (2, 1), (None, None), (None, None)]


def test_censoring(spark):
    rows = spark.createDataFrame([(50.0, 1), (60.0, 1), (61.0, 1), (90.0, 0)], "t double, e int").select(*L.censor("t", "e", 60)).collect()
    assert [tuple(r) for r in rows] == [(50.0, 1), (60.0, 1), (60.0, 0), (60.0, 0)]


REFUSED = [
    lambda: Binning("quantile"),
    lambda: Binning("quantile", 1),
    lambda: Binning("median", edges=(1.0,)),
    lambda: Binning("threshold"),
    lambda: Binning("threshold", edges=(2.0, 1.0)),
    lambda: Binning("mode"),
    lambda: Binarize("threshold", edges=(1.0, 2.0)),
    lambda: Discretize("median"),
    lambda: Discretize("quantile", 2),
    lambda: Discretize("threshold", edges=(1.0,)),
    lambda: Endpoint("x", "ranking"),
    lambda: Endpoint("patient_id", "regression", numeric="identity"),
    lambda: Endpoint("x", "binary", mapping={"a": 0, "b": 1, "c": 2}),
    lambda: Endpoint("x", "binary", mapping={"a": 0, "b": 1}, numeric="identity"),
    lambda: Endpoint("x", "multiclass", mapping={"a": 0, "b": 1}),
    lambda: Endpoint("x", "regression"),
    lambda: Endpoint("x", "regression_vector", stratify="y"),
    lambda: Endpoint("x", "survival", time_column="t"),
    lambda: Cohort("c", {"y": endpoint("x", "continuous")}),
    lambda: Study("s", {"a": "validation"}, ("x",)),
    lambda: Study("s", {"a": "development"}, ()),
    lambda: Study("s", {"a": "development"}, ("x",), n_outer=1),
    lambda: Study("s", {"a": "development"}, ("x",), horizons={"y": 3.0}),
    lambda: Study("s", {"a": "development"}, ("x",), horizons={"x": 0.0}),
    lambda: Study("s", {"a": "other"}, ("x",)),
    lambda: class_weights({0: 1.0}, 2),
    lambda: class_weights({0: 1.0, 1: 0.0}, 2),
]


@pytest.mark.parametrize("build", REFUSED, ids=range(len(REFUSED)))
def test_contract_refuses(build):
    with pytest.raises(ValueError):
        build()


def test_contract(spark):
    er = endpoint("er", "binary", values=["neg", "pos"])
    ki = endpoint("ki67", "continuous", numeric="log1p")
    os_ = endpoint("os", "survival", time_column="t", event_column="e")
    grade = endpoint("grade", "multiclass", discretize=Discretize("quantile", 3))
    cohort = Cohort("c", {"er": er, "ki67": ki, "os": os_, "grade": grade})
    assert cohort.columns() == {"er", "ki67", "t", "e", "grade"} and ki.stratify == Binning("median")
    assert (er.classes, grade.classes, er.head_width(), grade.head_width(), os_.head_width(n_bins=4)) == (2, 3, 1, 3, 4)
    study = Study("s", {"c": "development", "d": "validation", "p": "predict"}, ("er", "os"))
    assert [study.strategy(x) for x in "cdp"] == ["nested_cv", "all_test", "all_predict"]
    assert set(study.contract(cohort).fields) == {"er", "os"}
    with pytest.raises(ValueError):
        Study("s", {"c": "development"}, ("zz",)).contract(cohort)
    df = spark.createDataFrame([("pos", "1"), ("?", "x"), (None, "")], "er string, grade string")
    assert [tuple(r) for r in df.select(er.target(), grade.target({"edges": [1.0, 2.0]})).collect()] == [(1, 1), (-1, -1), (-1, -1)]
    assert class_weights("balanced", 2) == "balanced" and class_weights({0: 1, 1: 2}, 2) == {0: 1, 1: 2}
