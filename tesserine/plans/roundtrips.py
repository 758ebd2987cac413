"""Registered queries that write a table to the shared folder and read it back, and of operators that have no other query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.functions import metrics as M
from tesserine.operators import checks as C
from tesserine.operators import compare as P
from tesserine.operators import fit
from tesserine.operators import inspect as I
from tesserine.operators import panels as G
from tesserine.operators import profile as A
from tesserine.operators import report as E
from tesserine.operators import rollup as R
from tesserine.operators import splits as S
from tesserine.plans.fixtures import Frames
from tesserine.plans.registry import _AUROC, _KM, _OOF, BY, POOLED, _auroc_ctes, query
from tesserine.sources import commits, sheets, sinks


def _csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("sep", sep).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _exists(t: Frames) -> Callable[[str], bool]:
    jvm, conf = t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()

    def exists(path: str) -> bool:
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    return exists


# ---- readers and writers ----


def _sheet(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "sheet")
    _csv(t.sheet, path)
    return sheets.read_sheet(t.spark, path)


query("s01_read_sheet", "sheet", _sheet, "SELECT patient_id, ki67, CASE WHEN segment <> '' THEN segment END AS segment FROM sheet")


def _manifest(t: Frames) -> DataFrame:
    split = S.all_test(t.strata).unionByName(S.all_predict(t.strata)).select("patient_id", "split_version", "category")
    labels = sheets.long_labels(t.sheet, "patient_id")
    tables = {
        "patient": t.patients.select("patient_id"), "patient_labels": labels, "image": t.slides.select("slide_id", "patient_id", "image_path"),
        "image_labels": t.slides.select("slide_id", F.lit("priority").alias("label"), F.col("o_orderpriority").alias("value")), "mask": t.slides.select("image_path", F.lit("m").alias("mask_path")),
        "split_definitions": split.select("split_version").distinct().withColumn("strategy", F.regexp_extract("split_version", "^(all_test|all_predict)", 1)), "split": split,
    }
    root = sinks.fresh(t.spark, "manifest")
    sinks.write_manifest(t.spark, {k: df.limit(0) for k, df in tables.items()}, root)  # an older state, which the swap replaces
    sinks.write_manifest(t.spark, tables, root)
    got = sheets.read_manifest(t.spark, root)
    sizes = [got[k].select(F.lit(k).alias("part"), F.lit("").alias("patient_id")).groupBy("part").agg(F.count("*").alias("n")) for k in sheets.MANIFEST if k != "split"]
    out = got["split"].groupBy(F.concat_ws("/", F.lit("split"), "strategy", "category").alias("part")).agg(F.count("*").alias("n"))
    for s in sizes:
        out = out.unionByName(s)
    return out


query("s03_s04_s25_j03_manifest", "strata sheet slides patients", _manifest,
    """l AS (SELECT ki67 AS v FROM sheet WHERE ki67 IS NOT NULL UNION ALL SELECT segment FROM sheet WHERE segment IS NOT NULL)
--
SELECT 'patient' AS part, count(*) AS n FROM patients UNION ALL SELECT 'patient_labels', count(*) FROM l UNION ALL SELECT 'image', count(*) FROM slides UNION ALL SELECT 'image_labels', count(*) FROM slides
UNION ALL SELECT 'mask', count(*) FROM slides UNION ALL SELECT 'split_definitions', 2 UNION ALL SELECT 'split/all_test/test', count(*) FROM strata UNION ALL SELECT 'split/all_predict/predict', count(DISTINCT patient_id) FROM strata""")


def _matrix(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "matrix")
    e = t.embeddings
    n = len(e.first()["embedding"]) if e.take(1) else 0
    e.select(F.col("vec_id").alias("patient_id"), *[(F.abs(F.col("embedding")[k].cast("double")) * 10).alias(str(k)) for k in range(n)]).write.parquet(path)
    return sheets.read_matrix(t.spark, path)


query("s05_read_matrix", "matrix", _matrix, "SELECT patient_id, gene_id, value FROM matrix", "value")


def _panel(t: Frames) -> DataFrame:
    root = sinks.fresh(t.spark, "panels")
    rows = t.part.select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey").cast("string")).alias("Entrez_Gene_Id"), "p_partkey", F.lit("x").alias("other"))
    _csv(rows.coalesce(1).sortWithinPartitions("p_partkey").drop("p_partkey"), f"{root}/small.csv")
    where = sheets.panel_path("small", root, _exists(t))
    assert sheets.panel_path(where, root, _exists(t)) == where and sheets.panel_path("full", root, _exists(t)) is None
    kept, _ = G.resolve_panel(sheets.read_panel(t.spark, where), t.matrix)
    names = t.nation.select(F.col("n_nationkey").cast("string").alias("gene_id"), F.col("n_name").alias("symbol"), F.col("n_nationkey").alias("pos"))
    return G.symbols(kept, names).select("pos", "gene_id", "symbol")


query("s06_p22_j06_j07_panel", "matrix", _panel,
    """p AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_partkey FROM part)
--
SELECT pos, CAST(p_partkey AS VARCHAR) AS gene_id, n_name AS symbol FROM p LEFT JOIN nation ON n_nationkey = p_partkey WHERE p_partkey % 10 <> 0 AND CAST(p_partkey AS VARCHAR) IN (SELECT gene_id FROM matrix)""")


def _listing(t: Frames) -> DataFrame:
    raw, flat = sinks.fresh(t.spark, "listing"), sinks.fresh(t.spark, "sidecar")
    project = F.struct(F.concat(F.lit("P-"), F.substring("o_orderpriority", 1, 1)).alias("project_id"))
    case = F.struct(F.col("o_custkey").cast("string").alias("submitter_id"), project.alias("project"))
    t.orders.select(F.col("o_orderkey").cast("string").alias("file_id"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".svs")).alias("file_name"), F.array(case).alias("cases")).write.json(raw)
    nested = t.spark.read.schema("file_id string, file_name string, cases array<struct<submitter_id: string, project: struct<project_id: string>>>").json(raw)
    _csv(sheets.flatten_listing(nested), flat, "\t")
    return sheets.read_listing(t.spark, flat, {f"P-{k}": "high" if k < 3 else "low" for k in range(1, 6)})


query("s08_s27_listing", "", _listing, "x AS (SELECT 'P-' || substr(o_orderpriority, 1, 1) AS p, * FROM orders)\n--\nSELECT CAST(o_orderkey AS VARCHAR) AS file_id, o_orderkey || '.svs' AS file_name, CAST(o_custkey AS VARCHAR) AS patient_id, p AS project_id, CASE WHEN p IN ('P-1', 'P-2') THEN 'high' ELSE 'low' END AS label FROM x")


def _trials(t: Frames) -> DataFrame:
    rows, files = sinks.fresh(t.spark, "trials"), sinks.fresh(t.spark, "trial-files")
    sinks.append_trial(t.trials.where("rep = 0"), rows)
    sinks.append_trial(t.trials.where("rep > 0"), rows)
    commits.read(t.spark, rows).write.option("maxRecordsPerFile", 1).json(files)
    return sheets.read_trials(t.spark, files).drop("git_sha")


query("s09_s10_trials", "trials", _trials, "SELECT arm, field, seed, rep, metric, metric_key, n_declared, n_test, split_hash, train_seed FROM trials", "metric")


def _predictions(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "predictions")
    preds = t.bins.withColumn("field", F.lit("os"))
    sinks.write_predictions(preds, path)
    sinks.write_predictions(preds.where("outer_fold = 1"), path)  # a fold written again replaces itself
    schema = "slide_id long, patient_id string, logits array<double>, time_edges array<double>, time double, event int, field string, outer_fold int, inner_fold int"
    got = sheets.read_predictions(t.spark, path, schema, require_edges=True)
    return got.select("field", "outer_fold", "inner_fold", "slide_id", "patient_id", F.col("logits")[0].alias("first"), F.col("time_edges")[0].alias("edge"), "time", "event")


query("s12_s13_s31_predictions", "bins", _predictions, "SELECT 'os' AS field, outer_fold, inner_fold, slide_id, patient_id, logits[1] AS first, time_edges[1] AS edge, time, event FROM bins", "first edge time")


def _stored(t: Frames, record: DataFrame, name: str) -> DataFrame:
    path = sinks.fresh(t.spark, name)
    sinks.write_record(record, path)
    return t.spark.read.parquet(path)


query("s15_record", "preds", lambda t: _stored(t, R.pool_out_of_fold(t.preds), "record"), f"{_OOF}\n--\nSELECT * FROM oof", "prob")
query("s23_attention_record", "attention", lambda t: _stored(t, t.attention, "attention").groupBy("slide_id", "inner_fold").agg(F.count("*").alias("n_tiles"), F.sum("logit").alias("total"), F.max("x").alias("x"), F.max("y").alias("y")), "SELECT slide_id, inner_fold, count(*) AS n_tiles, sum(logit) AS total, max(x) AS x, max(y) AS y FROM attention GROUP BY ALL", "total")
query("s19_t05_gene_table", "genes", lambda t: R.per_gene_table(M.gene_pearson(t.genes)), "SELECT gene_id, count(*) AS n, corr(pred, label) AS pearson, sqrt(avg((pred - label) ** 2)) AS rmse FROM genes GROUP BY gene_id", "pearson rmse")


def _splits(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "splits")
    split = S.all_test(t.strata).unionByName(S.all_predict(t.strata)).withColumn("category", F.upper("category"))
    _csv(sinks.export_splits(split), path)
    return S.restrict_import(sheets.read_splits(t.spark, path), t.patients.where("c_custkey % 3 = 0"))


query("s20_l10_export_import", "strata patients", _splits, """a AS (SELECT patient_id, 'all_test_' || field AS split_version, 'test' AS category FROM strata UNION ALL SELECT DISTINCT patient_id, 'all_predict', 'predict' FROM strata)
--
SELECT a.* FROM a JOIN patients USING (patient_id) WHERE c_custkey % 3 = 0""")


def _target_stats(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "target-stats")
    assert sinks.read_target_stats(t.spark, path, _exists(t)) is None
    sinks.write_record(t.reg.where("inner_fold = 0").groupBy("field").agg(F.percentile("label", 0.5).alias("threshold")), path)
    stats = sinks.read_target_stats(t.spark, path, _exists(t))
    return t.reg.join(F.broadcast(stats), "field").select("slide_id", "inner_fold", "threshold", L.binarize("label", F.col("threshold")).alias("label"))


query("s21_target_stats", "reg", _target_stats, "SELECT slide_id, inner_fold, m AS threshold, CAST(label >= m AS INT) AS label FROM reg, (SELECT quantile_cont(label, 0.5) AS m FROM reg WHERE inner_fold = 0)", "threshold")


def _state(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "state")
    fold = t.matrix.withColumn("outer_fold", (F.col("patient_id").cast("int") % 2))
    state = A.gene_state(fold, ["outer_fold"]).withColumn("field", F.lit("genes")).withColumn("inner_fold", F.lit(0))
    for stream in ("rna", "other"):
        sinks.write_state(state.withColumn("stream", F.lit(stream)), path)
    kept = sinks.read_state(t.spark, path, "rna", "genes").select("outer_fold", "gene_id", "mean", "std")
    other = fold.withColumn("outer_fold", 1 - F.col("outer_fold")).join(kept, ["outer_fold", "gene_id"])
    return other.select("outer_fold", "gene_id", "patient_id", L.standardize(F.col("value"), F.col("mean"), F.col("std")).alias("z"))


query("s22_x15_state_restored", "matrix", _state, """st AS (SELECT CAST(patient_id AS INT) % 2 AS o, gene_id, avg(ln(1 + value)) AS m, stddev_pop(ln(1 + value)) AS s FROM matrix GROUP BY ALL)
--
SELECT st.o AS outer_fold, gene_id, patient_id, (ln(1 + value) - m) / s AS z FROM matrix JOIN st USING (gene_id) WHERE st.o = 1 - CAST(patient_id AS INT) % 2""", "z")


def _features(t: Frames) -> DataFrame:
    path = sinks.fresh(t.spark, "features")
    e = t.embeddings
    e.select("vec_id", "label", F.concat(F.lit("m"), F.col("label") % 2).alias("model_name"), F.lit("h").alias("model_hash"), F.when(F.col("vec_id") % 5 == 0, 1.0).otherwise(0.5).alias("mpp"), F.lit(256).alias("tile_size")).write.parquet(path)
    return sheets.read_features(t.spark, path, "m0", "h", 0.5, 256).groupBy("label").agg(F.count("*").alias("n_tiles"))


query("s32_feature_namespace", "", _features, "x AS (SELECT * FROM embeddings WHERE label % 2 = 0 AND vec_id % 5 <> 0)\n--\nSELECT label, count(*) AS n_tiles FROM x GROUP BY label")


def _masks(t: Frames) -> DataFrame:
    root = sinks.fresh(t.spark, "masks")
    t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_custkey").cast("string").alias("value")).repartition(1).write.partitionBy("k").text(root)
    return sheets.index_masks(t.spark, root, ".txt").select(F.regexp_extract("mask_path", r"k=(\d+)", 1).cast("int").alias("nation"), "length").unionByName(sheets.index_masks(t.spark, root, ".png").select(F.lit(0).alias("nation"), "length"))


query("f12_index_masks", "", _masks, "x AS (SELECT CAST(c_nationkey AS INT) AS nation, length(CAST(c_custkey AS VARCHAR)) + 1 AS n FROM customer)\n--\nSELECT nation, CAST(sum(n) AS BIGINT) AS length FROM x GROUP BY nation")

# ---- checks, splits, panels ----

query("f23_arm_labels", "arms", lambda t: C.disagreeing(t.arms.withColumn("label", F.when((F.col("arm") == "wide") & (F.col("patient_id").cast("int") % 50 == 7), 1 - F.col("label")).otherwise(F.col("label"))), "label"), "SELECT DISTINCT field, patient_id, 0 AS low, 1 AS high FROM arms WHERE CAST(patient_id AS INT) % 50 = 7")
query("f24_short_of_arms", "arms", lambda t: C.short_of_arms(t.arms, ["field", "patient_id"]), "SELECT field, patient_id, count(DISTINCT arm) AS n_arms FROM arms GROUP BY ALL HAVING count(DISTINCT arm) < 3")
query("f28_recorded_genes", "matrix", lambda t: C.orphans(t.part.select(F.col("p_partkey").cast("string").alias("gene_id")), t.matrix, ["gene_id"]).select("gene_id"), "SELECT CAST(p_partkey AS VARCHAR) AS gene_id FROM part WHERE CAST(p_partkey AS VARCHAR) NOT IN (SELECT gene_id FROM matrix)")
query("f33_tile_labels", "tiles", lambda t: C.conflicting(t.tiles.withColumn("label", F.when((F.col("slide_id") % 31 == 0) & (F.col("tile_idx") == 1), 1 - F.col("label")).otherwise(F.col("label"))), "slide_id", "label").select("slide_id"), "SELECT slide_id FROM tiles WHERE slide_id % 31 = 0 GROUP BY slide_id HAVING count(*) > 1")
query("f34_claimed_slides", "attention", lambda t: C.coordinate_clashes(t.attention.withColumn("outer_fold", F.when((F.col("slide_id") % 89 == 0) & (F.col("inner_fold") == 1), F.col("outer_fold") + 1).otherwise(F.col("outer_fold")))), "SELECT DISTINCT slide_id, 'outer folds' AS kind FROM attention WHERE slide_id % 89 = 0")
query("f32_admitted_slides", "slides preds", lambda t: C.orphans(t.slides.where("slide_id % 3 <> 0").select("slide_id"), t.by_slide("preds").where("slide_id % 4 <> 0"), ["slide_id"]).withColumn("kind", F.lit("not predicted")).unionByName(C.orphans(t.by_slide("preds").where("slide_id % 4 <> 0").select("slide_id").distinct(), t.slides.where("slide_id % 3 <> 0"), ["slide_id"]).withColumn("kind", F.lit("not admitted"))),
    "SELECT slide_id, 'not predicted' AS kind FROM slides WHERE slide_id % 3 <> 0 AND (slide_id % 4 = 0 OR slide_id NOT IN (SELECT slide_id FROM preds)) UNION ALL SELECT DISTINCT slide_id, 'not admitted' FROM preds WHERE slide_id % 4 <> 0 AND slide_id % 3 = 0")
query("f36_non_finite_loss", "preds", lambda t: C.non_finite(t.preds.withColumn("loss", -F.log(F.when(F.col("slide_id") % 41 == 0, float("nan")).when(F.col("slide_id") % 43 == 0, float("inf")).otherwise(F.col("prob")))), "loss").select("slide_id", "inner_fold"), "SELECT slide_id, inner_fold FROM preds WHERE slide_id % 41 = 0 OR slide_id % 43 = 0")
query("l06_l07_fit_set", "strata", lambda t: S.fit_set(codes=S.population(t.strata.select("patient_id", F.lit("v").alias("split_version"), F.when(F.col("patient_id").cast("int") % 4 == 0, "test").when(F.col("patient_id").cast("int") % 4 == 1, "fit").when(F.col("patient_id").cast("int") % 4 == 2, "validate").otherwise("predict").alias("category")), "v")), "SELECT DISTINCT patient_id FROM strata WHERE CAST(patient_id AS INT) % 4 < 3")
query("l07_stored_fit_set", "strata", lambda t: S.fit_set(S.draw(t.strata, 7, 0.2, 0.1).withColumn("split_version", F.lit("v")), "v").groupBy().agg(F.count("*").alias("n")),
    "p AS (SELECT field, stratum, count(*) AS m FROM strata GROUP BY ALL)\n--\nSELECT CAST(sum(m - round(m * 0.2) - round(m * 0.1)) AS BIGINT) AS n FROM p")
query("p14_log_labels", "matrix", lambda t: t.matrix.select("patient_id", "gene_id", L.log1p("value").alias("label")), "SELECT patient_id, gene_id, ln(1 + value) AS label FROM matrix", "label")
query("p18_class_names", "sheet", lambda t: I.name_classes(t.patients.select(F.col("c_mktsegment").alias("value"), F.when(F.col("c_mktsegment") < "F", 0).otherwise(1).alias("class")).distinct()), "SELECT CASE WHEN c_mktsegment < 'F' THEN 0 ELSE 1 END AS class, string_agg(DISTINCT c_mktsegment, ' / ' ORDER BY c_mktsegment) AS name FROM customer GROUP BY 1")
query("t03_first_slides", "slides", lambda t: S.first_slides(t.slides.withColumn("pos", -F.col("slide_id")), 25, "pos").select("slide_id", "patient_id"), "SELECT slide_id, patient_id FROM slides ORDER BY slide_id DESC LIMIT 25")
_SETS = lambda t: sheets.parse_gmt(t.nation.select(F.concat_ws("\t", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.lit("set"), "n_name", F.lit("nobody")).alias("value"))).join(t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("set_name"), F.col("r_regionkey").alias("set_pos")), "set_name")
query("u02_panel_from_sets", "matrix", lambda t: G.panel_from_sets(_SETS(t), ["r1", "r3"], t.nation.select(F.col("n_name").alias("symbol"), F.col("n_nationkey").cast("string").alias("gene_id"), F.col("n_nationkey").alias("pos")), t.matrix).select("symbol", "gene_id"), "SELECT n_name AS symbol, CAST(n_nationkey AS VARCHAR) AS gene_id FROM nation WHERE n_regionkey IN (1, 3) AND CAST(n_nationkey AS VARCHAR) IN (SELECT gene_id FROM matrix)")

# ---- comparisons and reports ----


def _arms(t: Frames) -> DataFrame:
    records = t.arms.withColumn("endpoint_type", F.lit("binary")).withColumn("objective", F.lit("binary"))
    kind = P.one_objective(records)
    out = None
    for arm in ("base", "deep", "wide"):
        rows = P.read_arm(records, arm, kind).groupBy("arm", "field").agg(F.count("*").alias("n"), F.avg("prob").alias("mean"))
        out = rows if out is None else out.unionByName(rows)
    return out


query("c01_c12_read_arms", "arms", _arms, "SELECT arm, field, count(*) AS n, avg(prob) AS mean FROM arms GROUP BY ALL", "mean")
query("m24_score_predictions", "preds", lambda t: fit.score_predictions(t.preds, "binary", "prob"),
    f"""p AS (SELECT 1 AS k, patient_id, avg(prob) AS prob, first(label) AS label FROM preds GROUP BY patient_id), {_auroc_ctes("p", "k")}
--
SELECT {_AUROC} AS metric, (SELECT count(*) FROM p) AS n_patients, (SELECT count(*) FROM p WHERE label = 1) AS n_positive FROM w""", "metric")
query("m26_slide_regression", "reg", lambda t: E.slide_metrics(t.reg, "regression"),
    """rk AS (SELECT *, row_number() OVER (PARTITION BY field, outer_fold, inner_fold ORDER BY pred, slide_id) AS rx, row_number() OVER (PARTITION BY field, outer_fold, inner_fold ORDER BY label, slide_id) AS ry FROM reg)
--
SELECT field, outer_fold, inner_fold, 1 - avg((pred - label) ** 2) / var_pop(label) AS r2, avg(abs(pred - label)) AS mae, sqrt(avg((pred - label) ** 2)) AS rmse, corr(pred, label) AS pearson, corr(rx, ry) AS spearman FROM rk GROUP BY ALL""", "r2 mae rmse pearson spearman")
query("m26_slide_survival", "surv", lambda t: E.slide_metrics(t.surv, "survival", BY),
    """c AS (SELECT a.field, a.outer_fold, sum(CASE WHEN a.risk > b.risk THEN 1.0 WHEN a.risk = b.risk THEN 0.5 ELSE 0.0 END) / count(*) AS c_index
        FROM surv a JOIN surv b ON a.field = b.field AND a.outer_fold = b.outer_fold AND b.time > a.time WHERE a.event = 1 GROUP BY ALL)
--
SELECT * FROM c""", "c_index")
query("m26_slide_genes", "genes", lambda t: E.slide_metrics(t.genes.withColumn("field", F.lit("genes")), "regression_vector", ["field"]), "g AS (SELECT gene_id, corr(pred, label) AS r FROM genes GROUP BY gene_id)\n--\nSELECT 'genes' AS field, avg(r) AS mean_gene_pearson, count(r) AS n_scored FROM g", "mean_gene_pearson")

_FOLD_AUC = f"""{_OOF}, {POOLED.format(t="oof")}, {_auroc_ctes("pooled", "field, outer_fold")},
    au AS (SELECT field, outer_fold, {_AUROC} AS auroc, sum(p * dp / (dp + dn)) / sum(p) AS average_precision FROM w GROUP BY field, outer_fold),
    k AS (SELECT field, outer_fold, count(*) AS n_patients, count(*) FILTER (label = 1) AS n_positive, avg(CASE WHEN (prob >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
        (avg(CASE WHEN prob >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (label = 1) + avg(CASE WHEN prob < 0.5 THEN 1.0 ELSE 0.0 END) FILTER (label = 0)) / 2 AS balanced_accuracy FROM pooled GROUP BY ALL),
    fm AS (SELECT * FROM au JOIN k USING (field, outer_fold))"""
query("d02_d03_report_binary", "preds", lambda t: E.aggregate(t.preds, E.endpoint("binary"))[0],
    f"""{_FOLD_AUC}
--
SELECT field, outer_fold, CASE WHEN outer_fold = -1 THEN 'pooled' ELSE 'fold' END AS row_kind, auroc, average_precision, accuracy, balanced_accuracy, n_patients, n_positive FROM fm
UNION ALL SELECT field, NULL, 'mean', avg(auroc), avg(average_precision), avg(accuracy), avg(balanced_accuracy), NULL, NULL FROM fm WHERE outer_fold >= 0 GROUP BY field
UNION ALL SELECT field, NULL, 'sd', stddev_pop(auroc), stddev_pop(average_precision), stddev_pop(accuracy), stddev_pop(balanced_accuracy), NULL, NULL FROM fm WHERE outer_fold >= 0 GROUP BY field""",
    "auroc average_precision accuracy balanced_accuracy")
query("d03_external_binary", "preds", lambda t: E.external(t.preds, E.endpoint("binary")).select("field", "model", "auroc"),
    f"""rp AS (SELECT field, outer_fold, inner_fold, patient_id, avg(prob) AS prob, first(label) AS label FROM preds GROUP BY ALL), mo AS (SELECT *, unnest(['grand', 'o' || outer_fold]) AS model FROM rp),
    en AS (SELECT field, model, patient_id, avg(prob) AS prob, first(label) AS label FROM mo GROUP BY ALL), {_auroc_ctes("en", "field, model")}
--
SELECT field, model, {_AUROC} AS auroc FROM w GROUP BY ALL""", "auroc")
query("d06_finish_survival", "surv", lambda t: E.aggregate(t.surv.withColumn("inner_fold", F.lit(0)), E.endpoint("survival"))[1]["curve_by_risk"],
    f"""half AS (SELECT *, CASE WHEN risk >= (SELECT quantile_cont(risk, 0.5) FROM surv) THEN 'high' ELSE 'low' END AS risk_group FROM surv), {_KM.format(by='field, risk_group', t='half')}
--
SELECT * FROM cur""", "survival time")
query("d06_finish_genes", "genes", lambda t: E.aggregate(t.genes.withColumn("field", F.lit("genes")).withColumn("outer_fold", F.lit(0)).withColumn("inner_fold", F.lit(0)), E.endpoint("regression_vector"))[1]["genes"].select("gene_id", "pearson"), "SELECT gene_id, corr(pred, label) AS pearson FROM genes GROUP BY gene_id", "pearson")


def _streams(t: Frames) -> DataFrame:
    """Two halves of the vectors as named streams of a spec, fused."""
    def half(part: int) -> DataFrame:
        v = F.transform("embedding", lambda x: x.cast("double"))
        n = F.floor(F.size("embedding") / 2).cast("int")
        return t.embeddings.select(F.col("vec_id").alias("patient_id"), F.slice(v, F.lit(1) + n * part, n).alias("features"))

    got = fit.streams({"rna": {"part": 0}, "image": {"part": 1}}, {"rna": half, "image": half})
    return fit.fuse([got["rna"], got["image"]]).select("patient_id", F.posexplode("features").alias("pos", "value"))


query("x08_x18_d04_streams", "", _streams, """x AS (SELECT vec_id AS patient_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS v, len(embedding) // 2 AS h FROM embeddings),
    s AS (SELECT patient_id, pos // h AS part, sqrt(sum(v * v)) AS norm FROM x GROUP BY ALL)
--
SELECT patient_id, CAST(pos AS INT) AS pos, v / norm AS value FROM x JOIN s USING (patient_id) WHERE s.part = x.pos // x.h""", "value")


def _random_arm(t: Frames) -> DataFrame:
    """Genes against an unfitted arm: the heads' weights follow from a seed, one a gene."""
    x = t.embeddings.select(F.col("vec_id").cast("string").alias("patient_id"), F.transform("embedding", lambda v: v.cast("double")).alias("features"))
    base = fit.random_head(x, 11, "base")
    genes = t.genes.drop("base").join(base.select("patient_id", "base"), "patient_id")
    return M.beats_random(genes.select("gene_id", "patient_id", "pred", "label"), genes.select("gene_id", "patient_id", F.col("base").alias("pred"), "label"))


query("x11_m19_random_arm", "genes", _random_arm)
