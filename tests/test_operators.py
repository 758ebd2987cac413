"""Splits, roll-ups, checks, comparison, sources and sinks, models and streams on small frames."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tesserine.functions import metrics as M
from tesserine.operators import checks as C
from tesserine.operators import compare as P
from tesserine.operators import fit as X
from tesserine.operators import inspect as I
from tesserine.operators import panels as G
from tesserine.operators import profile as A
from tesserine.operators import rollup as R
from tesserine.operators import splits as S
from tesserine.sources import commits, sheets, sinks


@pytest.fixture(scope="module")
def patients(spark):
    return spark.createDataFrame([("er", f"p{i:03}", int(i % 4 == 0)) for i in range(103)], "field string, patient_id string, stratum int").cache()


def test_nested_cv(spark, patients):
    split = S.nested_cv(patients, 5, 3, 42).toPandas()
    tests = split[split.category == "test"].groupby(["outer_fold", "inner_fold"]).patient_id.apply(frozenset)
    for k in range(5):
        assert len({tests[k, i] for i in range(3)}) == 1, "test is shared over inner folds"
    assert len(frozenset.union(*[tests[k, 0] for k in range(5)])) == 103 == sum(len(tests[k, 0]) for k in range(5))
    assert (split.groupby(["outer_fold", "inner_fold"]).patient_id.nunique() == 103).all() and (split.groupby(["outer_fold", "inner_fold"]).size() == 103).all()
    strata = {r.patient_id: r.stratum for r in patients.collect()}
    for k in range(5):
        assert abs(sum(strata[p] for p in tests[k, 0]) - 26 / 5) <= 1
        held = [frozenset(split[(split.outer_fold == k) & (split.inner_fold == i) & (split.category == "validate")].patient_id) for i in range(3)]
        assert not held[0] & held[1] and frozenset.union(*held) | tests[k, 0] == frozenset(strata)
    again = S.nested_cv(patients.repartition(9), 5, 3, 42).toPandas()
    key = ["outer_fold", "inner_fold", "patient_id"]
    assert split.sort_values(key).category.tolist() == again.sort_values(key).category.tolist()
    assert S.nested_cv(patients, 5, 3, 43).where("category = 'test'").exceptAll(S.nested_cv(patients, 5, 3, 42).where("category = 'test'")).count() > 0
    with pytest.raises(ValueError):
        S.nested_cv(patients, 1, 3, 42)


def test_draw_and_digest(spark, patients):
    d = S.draw(patients, 1, 0.2, 0.1)
    n = {(r.stratum, r.category): r["count"] for r in d.join(patients, ["field", "patient_id"]).groupBy("stratum", "category").count().collect()}
    assert n[1, "test"] == 5 and n[0, "test"] == 15 and sum(n.values()) == 103
    h = lambda x: S.split_digest(x).first().split_hash
    assert h(d) == h(d.repartition(5)) != h(S.draw(patients, 2, 0.2, 0.1)) and len(h(d)) == 16
    assert S.fit_set(codes=d).count() == 103
    with pytest.raises(ValueError):
        S.fit_set()


def test_bags_and_grid(spark):
    tiles = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(10)], "slide_id string, tile_idx int")
    got = S.bags(tiles, 5, 1).toPandas()
    assert got.groupby("slide_id").size().to_dict() == {"a": 5, "b": 5}
    assert sorted(got[got.slide_id == "a"].tile_idx.value_counts()) == [1, 2, 2] and got[got.slide_id == "b"].tile_idx.nunique() == 5
    slides = spark.createDataFrame([("a", 450, 230), ("b", 100, 900)], "slide_id string, width int, height int")
    assert {(r.slide_id, r.tx, r.ty) for r in S.tile_grid(slides, 224).collect()} == {("a", 0, 0), ("a", 1, 0)}
    mask = spark.createDataFrame([("a", 0, 0, 0.6), ("a", 0, 0, 0.2), ("a", 1, 0, 0.9)], "slide_id string, cx int, cy int, cover double")
    assert [r.tx for r in S.tile_grid(slides, 224, mask).collect()] == [1]


def test_slides_are_averaged_before_replicates(spark):
    rows = [("f", 0, 0, "s1", "p", 0.0, 1), ("f", 0, 0, "s2", "p", 1.0, 1), ("f", 0, 1, "s1", "p", 1.0, 1)]
    preds = spark.createDataFrame(rows, "field string, outer_fold int, inner_fold int, slide_id string, patient_id string, prob double, label int")
    r = R.pool_out_of_fold(preds).first()
    assert r.prob == 0.75 and r.n_replicates == 2
    v = preds.withColumn("prob", F.array("prob", 1 - F.col("prob")))
    assert R.pool_out_of_fold(v).first().prob == [0.75, 0.25]


def test_external_ensembles(spark):
    """The grand mean is 0.5 for all, while outer 0 ranks perfectly and outer 1 in reverse."""
    rows = [("f", o, i, f"p{k}", (0.9 if (k < 2) == (o == 0) else 0.1), int(k < 2)) for o in range(2) for i in range(2) for k in range(4)]
    df = spark.createDataFrame(rows, "field string, outer_fold int, inner_fold int, patient_id string, prob double, label int")
    got = R.external_ensembles(df).join(df.select("patient_id", "label").distinct(), "patient_id")
    assert {r.prob for r in got.where("model = 'grand'").collect()} == {0.5}
    assert {r.model: r.auroc for r in M.auroc(got, ["model"]).collect()} == {"grand": 0.5, "o0": 1.0, "o1": 0.0}


def test_confident_tiles_keep_a_finite_logit(spark):
    tiles = spark.createDataFrame([("a", 40.0, 1), ("a", 41.0, 1), ("b", -500.0, 0), ("c", 1.0, -1)], "slide_id string, logit double, label int")
    got = {r.slide_id: r for r in R.tiles_to_slides(tiles).collect()}
    assert set(got) == {"a", "b"} and 40 < got["a"].logit < 41 and got["b"].prob == pytest.approx(0)


def test_padding_and_recommendation(spark):
    count = lambda xs: spark.createDataFrame([(f"s{k}", x) for k, x in enumerate(xs)], "slide_id string, n_tiles long")
    assert A.recommend_bag(count(range(50, 150)), [10, 50, 100]).first().num_tiles == 50
    assert A.recommend_bag(count([2, 3, 4, 5]), [10, 50]).first().num_tiles == 10
    r = A.padding_cost(count([50, 50, 100, 200]), [100]).first()
    assert (r.n_padded, r.share_padded, r.mean_copies, r.coverage) == (2, 0.5, 2.0, 0.75)


def test_sheet_checks(spark):
    p = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "patient_id string, er string")
    s = spark.createDataFrame([("a", "1.svs"), ("a", "1.svs"), ("z", "2.svs")], "patient_id string, image_path string")
    got = {(r.kind, r.key) for r in C.validate_sheets(p, s, ["er", "grade"]).collect()}
    assert got == {("duplicate patient", "a"), ("duplicate slide", "1.svs"), ("orphan slide", "z"), ("missing column", "grade")}
    with pytest.raises(ValueError, match="duplicates"):
        C.refuse(C.repeated(p, ["patient_id"]), "duplicates")
    C.refuse(C.repeated(p, ["patient_id", "er"]), "none")
    assert [r.value for r in C.out_of_map(p, "er", {"x": 0}).collect()] == ["y"]
    rows, bad = C.one_row_per_patient(p.unionByName(p))
    assert rows.count() == 3 and [r.patient_id for r in bad.collect()] == ["a"]


def test_missing_by_objective(spark):
    df = spark.createDataFrame([(-1.0, [float("nan"), 1.0]), (float("nan"), [float("nan")] * 2)], "x double, v array<double>")
    got = df.select(C.is_missing(F.col("x"), "binary"), C.is_missing(F.col("x"), "regression"), C.is_missing(F.col("v"), "regression_vector")).collect()
    assert tuple(got[0]) == (True, False, False) and tuple(got[1])[1:] == (True, True)


def test_fold_checks(spark):
    folds = spark.createDataFrame([("f", 0, 0, "p"), ("f", 0, 1, "p"), ("f", 0, 1, "q"), ("f", 1, 0, "r")], "field string, outer_fold int, inner_fold int, patient_id string")
    assert [(r.outer_fold, r.inner_fold) for r in C.incomplete_grid(folds, 2, 2).collect()] == [(1, 1)]
    assert [r.patient_id for r in C.uneven_replicates(folds).collect()] == ["q"]


@pytest.fixture(scope="module")
def arms(spark):
    rows = [(a, "er", k % 2, f"p{k}", int(k % 3 == 0), ((k * 7 + n) % 11) / 11) for n, a in enumerate(["ref", "new"]) for k in range(40) if not (a == "new" and k == 5)]
    return spark.createDataFrame(rows, "arm string, field string, outer_fold int, patient_id string, label int, prob double")


def test_self_comparison_is_zero(arms):
    both = arms.where("arm = 'ref'").unionByName(arms.where("arm = 'ref'").withColumn("arm", F.lit("same")))
    metric = lambda df, by: M.auroc(df, by).withColumnRenamed("auroc", "metric")
    assert {r.delta for r in P.compare_arms(both, "ref", metric).collect()} == {0.0}
    got = P.compare_arms(arms, "ref", metric).collect()
    assert len(got) == 6 and {r.gap for r in P.arm_coverage(arms).collect()} == {0, 1}
    with pytest.raises(ValueError):
        P.read_arm(arms.withColumn("endpoint_type", F.lit("binary")), "zzz", "binary")


def test_trials(spark):
    rows = [(a, "er", s, r, 0.5 + 0.1 * (a == "new") + 0.01 * r + 0.001 * s) for a in ("ref", "new") for s in range(10) for r in range(3) if not (a == "new" and s == 9 and r == 2)]
    t = spark.createDataFrame(rows, "arm string, field string, seed int, rep int, metric double")
    assert P.complete_seeds(t).count() == 9
    r = P.summarize_arms(t, "ref").first()
    assert r.median == pytest.approx(0.1) and r.margin == pytest.approx(0.01) and (r.share_above, r.share_below, r.null_percentile) == (1.0, 0.0, 1.0)
    assert [(x.k, x.n_null) for x in P.margin_convergence(t, [1, 3, 3]).collect()] == [(3, 6)]


def test_step_lookup_is_right_continuous(spark):
    curves = spark.createDataFrame([("a", 10.0, 0.8), ("a", 20.0, 0.5)], "slide_id string, t double, s double")
    times = spark.createDataFrame([("a", x) for x in (0.0, 10.0, 15.0, 20.0, 99.0)], "slide_id string, t double")
    assert [(r.t, r.s) for r in I.survival_at(curves, times).orderBy("t").collect()] == [(0.0, 1.0), (10.0, 0.8), (15.0, 0.8), (20.0, 0.5), (99.0, 0.5)]


def test_rank_agreement(spark):
    rows = [(0, i, "s", k, 0, 0, float(k * (1 if i < 2 else -1))) for i in range(3) for k in range(5)] + [(0, 0, "one", 0, 0, 0, 1.0)]
    att = spark.createDataFrame(rows, "outer_fold int, inner_fold int, slide_id string, tile_idx int, x int, y int, logit double")
    assert {r.slide_id: r.agreement for r in I.rank_agreement(att).collect()} == {"s": -1.0, "one": None}
    assert I.attention_weights(att).groupBy("inner_fold", "slide_id").agg(F.sum("weight").alias("w")).where("abs(w - 1) > 1e-9").count() == 0


def test_panels(spark):
    matrix = spark.createDataFrame([("p", str(g), 1.0) for g in (100, 200, 300, 400)], "patient_id string, gene_id string, value double")
    panel = spark.createDataFrame([(0, "300"), (1, "999"), (2, "100")], "pos int, gene_id string")
    kept, lost = G.resolve_panel(panel, matrix)
    assert [r.gene_id for r in kept.collect()] == ["300", "100"] and [r.gene_id for r in lost.collect()] == ["999"]
    gmt = sheets.parse_gmt(spark.createDataFrame([("A\td\tx\ty",), ("B\td\ty\t\tz",), ("short\td",)], "value string"))
    sets = gmt.withColumn("set_pos", F.when(F.col("set_name") == "A", 0).otherwise(1))
    assert {(r.symbol, r.set_pos) for r in G.union_of_sets(sets, ["A", "B"]).collect()} == {("x", 0), ("y", 0), ("z", 1)}
    names = spark.createDataFrame([(0, "x", "100"), (1, "x", "200"), (2, "z", "999")], "pos int, symbol string, gene_id string")
    assert [r.gene_id for r in G.panel_from_sets(sets, ["A", "B"], names, matrix).collect()] == ["100"]
    with pytest.raises(ValueError):
        G.union_of_sets(sets, ["C"])


def test_sheet_sources(spark, tmp_path):
    (tmp_path / "p.csv").write_text("patient_id,er,n\nP1,NA,3\nP2,pos,\n")
    df = sheets.read_sheet(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in df.orderBy("patient_id").collect()] == [("P1", None, "3"), ("P2", "pos", None)]
    assert sheets.read_masks(spark, None).count() == 0
    (tmp_path / "m.csv").write_text("image_path,mask_path\na.svs, \nb.svs,b.png\n")
    assert [r.image_path for r in sheets.read_masks(spark, str(tmp_path / "m.csv")).collect()] == ["b.svs"]
    (tmp_path / "g.csv").write_text("Entrez_Gene_Id,Hugo\n300,a\n,b\n100,c\n")
    assert [r.gene_id for r in sheets.read_panel(spark, str(tmp_path / "g.csv")).orderBy("pos").collect()] == ["300", "100"]
    with pytest.raises(ValueError):
        sheets.read_panel(spark, str(tmp_path / "p.csv"))
    with pytest.raises(Exception, match="unknown project"):
        sheets.label_projects(spark.createDataFrame([("X",)], "project_id string"), {"Y": "a"}).collect()
    assert sheets.panel_path("full", "r", os.path.exists) is None and sheets.panel_path("hvg", "r", os.path.exists) == "r/hvg.csv"
    for k, metric in enumerate([0.5, "0.5x"]):
        (tmp_path / f"t{k}.json").write_text(json.dumps({"arm": "a", "field": "f", "seed": 1, "rep": 0, "metric": metric}, indent=1))
    assert sheets.read_trials(spark, str(tmp_path / "t0.json")).first().metric == 0.5
    with pytest.raises(Exception, match="no number"):
        sheets.read_trials(spark, str(tmp_path / "t1.json")).collect()
    (tmp_path / "masks").mkdir()
    (tmp_path / "masks" / "a.png").write_bytes(b"x")
    (tmp_path / "masks" / "b.png").write_bytes(b"")
    assert sheets.index_masks(spark, str(tmp_path / "masks"), ".png").count() == 1


def test_splits_round_trip(spark, tmp_path, patients):
    split = sinks.export_splits(S.nested_cv(patients, 2, 1, 1))
    split.withColumn("category", F.upper("category")).coalesce(1).write.option("header", True).csv(str(tmp_path / "s"))
    back = sheets.read_splits(spark, str(tmp_path / "s"))
    assert back.exceptAll(split).count() == 0 == split.exceptAll(back).count()
    spark.createDataFrame([("p", "v", "train")], "patient_id string, split_version string, category string").write.option("header", True).csv(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="unknown category"):
        sheets.read_splits(spark, str(tmp_path / "bad")).collect()


def test_manifest_and_records_round_trip(spark, tmp_path):
    one = spark.createDataFrame([("v", "p", "fit")], "split_version string, patient_id string, category string")
    tables = {t: spark.range(2) for t in sheets.MANIFEST} | {"split": one, "split_definitions": one.select("split_version", F.lit("d").alias("description"))}
    sinks.write_manifest(spark, tables, str(tmp_path / "m"))
    assert sheets.read_manifest(spark, str(tmp_path / "m"))["split"].columns == ["split_version", "patient_id", "category", "description"]
    preds = spark.createDataFrame([("f", 0, 1, "s", "p", 0.25, None)], "field string, outer_fold int, inner_fold int, slide_id string, patient_id string, prob double, time_edges array<double>")
    sinks.write_predictions(preds, str(tmp_path / "p"))
    back = sheets.read_predictions(spark, str(tmp_path / "p"), preds._jdf.schema().toDDL())
    assert back.select(preds.columns).collect() == preds.collect()
    with pytest.raises(Exception, match="time edges"):
        sheets.read_predictions(spark, str(tmp_path / "p"), preds._jdf.schema().toDDL(), require_edges=True).collect()
    trial = spark.createDataFrame([("a", "f", 1, 0, 0.5)], "arm string, field string, seed int, rep int, metric double")
    for _ in range(2):
        sinks.append_trial(trial, str(tmp_path / "t"))
    assert commits.read(spark, str(tmp_path / "t")).count() == 2
    state = spark.createDataFrame([("f", 0, 0, "rna", "1", 0, 0.0, 1.0)], "field string, outer_fold int, inner_fold int, stream string, gene_id string, pos int, mean double, std double")
    sinks.write_state(state, str(tmp_path / "s"))
    assert sinks.read_state(spark, str(tmp_path / "s"), "rna", "f").count() == 1
    with pytest.raises(ValueError):
        sinks.read_state(spark, str(tmp_path / "s"), "x", "f")
    assert sinks.read_target_stats(spark, str(tmp_path / "none"), os.path.exists) is None


def test_heads(spark):
    rows = [(f"p{k}", [float(k % 2), float(k % 5)], k % 2, float(10 * (k % 5) + k % 2)) for k in range(60)]
    df = spark.createDataFrame(rows, "patient_id string, features array<double>, label int, y double")
    score = X.Task(X.Recipe("binary", class_weight="balanced")).fit(df)
    assert M.auroc(score(df).withColumn("g", F.lit(1)), ["g"]).first().auroc == 1.0
    reg = X.fit_regression(df.drop("label").withColumnRenamed("y", "label"), X.Recipe("regression", reg=0.0))
    assert M.regression_metrics(reg(df.drop("label").withColumnRenamed("y", "label")), []).first().r2 == pytest.approx(1.0)
    with pytest.raises(ValueError):
        X.Task(X.Recipe("ranking"))
    with pytest.raises(TypeError):
        X.Recipe("binary", depth=3)
    assert X.Recipe("regression", class_weight="balanced").unused() == ["class_weight"] and X.ungated(["a", "b"], ["b"]) == ["a"]
    with pytest.raises(ValueError):
        X.streams({"x": {}}, {})
    empty = X.losses(df.withColumn("logit", F.lit(0.0)).withColumn("label", F.lit(-1)), ["patient_id"], "binary")
    assert {r.loss for r in empty.collect()} == {0.0}
