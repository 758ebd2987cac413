"""All registered queries over the given tables, each with the DuckDB statement of the same rows.

A name starts with the identifiers of the operators that the query applies. Doubles are compared after rounding to six
digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserine.functions import labels as L
from tesserine.functions import metrics as M
from tesserine.operators import checks as C
from tesserine.operators import compare as P
from tesserine.operators import inspect as I
from tesserine.operators import panels as G
from tesserine.operators import profile as A
from tesserine.operators import rollup as R
from tesserine.operators import splits as S
from tesserine.operators.ordered import with_pooled
from tesserine.plans.contract import Binning
from tesserine.plans.fixtures import Frames, ctes
from tesserine.sources import sheets, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BY = ["field", "outer_fold"]


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits; no negative zero."""
    return df.select(*[(F.round(F.col(f"`{f.name}`"), 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema])


def query(name: str, uses: str, make: Callable[[Frames], DataFrame], sql: str | None = None, doubles: str = "") -> None:
    """Registers a query over the fixtures `uses` and its statement, whose columns `doubles` are rounded."""
    QUERIES[name] = lambda spark, sf_dir: _rounded(make(Frames(spark, sf_dir)))
    if sql is not None:
        head = f"WITH {ctes(uses)}, " if uses else "WITH "
        swap = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles.split())
        # the statement may start with more CTEs of its own
        more, _, body = sql.rpartition("\n--\n")
        star = f"SELECT * REPLACE ({swap}) FROM answer" if swap else "SELECT * FROM answer"
        ORACLES[name] = f"{head}{more + ', ' if more else ''}answer AS ({body}) {star}"


POOLED = "pooled AS (SELECT * REPLACE (unnest([outer_fold, -1])::INT AS outer_fold) FROM {t})"
_AUROC = "sum(p * (cn - n / 2.0)) / nullif(sum(p) * sum(n), 0)"


def _auroc_ctes(source: str, by: str, score: str = "prob", label: str = "label") -> str:
    return f"""c AS (SELECT {by}, {score} AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {source} WHERE {label} IN (0, 1) GROUP BY ALL),
        w AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY s) AS cn, sum(p) OVER (PARTITION BY {by} ORDER BY s DESC) AS dp, sum(n) OVER (PARTITION BY {by} ORDER BY s DESC) AS dn FROM c)"""


# ---- the flagship: tiles to slides to patients, per test fold and pooled ----

_FLAG = """deal AS (SELECT patient_id, CAST((row_number() OVER (ORDER BY stratum, md5(concat_ws('|', '42', patient_id)), patient_id) - 1) % 5 AS INT) AS outer_fold FROM strata),
    sl AS (SELECT slide_id, avg(1 / (1 + exp(-logit))) AS prob FROM tiles WHERE label >= 0 GROUP BY slide_id),
    pt AS (SELECT s.patient_id, avg(prob) AS prob FROM sl JOIN slides s ON s.slide_id = sl.slide_id GROUP BY s.patient_id),
    j AS (SELECT unnest([outer_fold, -1])::INT AS outer_fold, prob, stratum AS label FROM pt JOIN deal USING (patient_id) JOIN strata USING (patient_id))"""


def flagship(t: Frames) -> DataFrame:
    slides = R.tiles_to_slides(t.tiles).select("slide_id", "prob")
    patients = slides.join(t.slides.select("slide_id", "patient_id"), "slide_id").groupBy("patient_id").agg(F.avg("prob").alias("prob"))
    test = S.dealt(t.strata, 42).select("patient_id", F.col("stratum").alias("label"), F.pmod("place", F.lit(5)).cast("int").alias("outer_fold"))
    rows = with_pooled(patients.join(test, "patient_id"))
    return M.auroc(rows, ["outer_fold"]).join(M.confusion(rows, ["outer_fold"]).select("outer_fold", "n", "accuracy"), "outer_fold")


query(
    "flagship_oof_auroc", "tiles slides strata", flagship,
    f"""{_FLAG}, {_auroc_ctes("j", "outer_fold")}, a AS (SELECT outer_fold, {_AUROC} AS auroc FROM w GROUP BY outer_fold)
--
SELECT a.outer_fold, a.auroc, count(*) AS n, avg(CASE WHEN (j.prob >= 0.5) = (j.label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM a JOIN j USING (outer_fold) GROUP BY ALL""",
    "auroc accuracy",
)

# ---- metrics ----

query("m01_m02_auroc_average_precision", "preds", lambda t: M.auroc(with_pooled(t.preds), BY).join(M.average_precision(with_pooled(t.preds), BY), BY),
    f"""{POOLED.format(t="preds")}, {_auroc_ctes("pooled", "field, outer_fold")}
--
SELECT field, outer_fold, {_AUROC} AS auroc, sum(p * dp / (dp + dn)) / nullif(sum(p), 0) AS average_precision FROM w GROUP BY field, outer_fold""", "auroc average_precision")

query("m03_m23_confusion_metrics", "preds", lambda t: M.confusion(with_pooled(t.preds), BY),
    f"""{POOLED.format(t="preds")}, k AS (SELECT field, outer_fold, count(*) FILTER (prob >= 0.5 AND label = 1)::DOUBLE AS tp, count(*) FILTER (prob >= 0.5 AND label = 0)::DOUBLE AS fp,
        count(*) FILTER (prob < 0.5 AND label = 0)::DOUBLE AS tn, count(*) FILTER (prob < 0.5 AND label = 1)::DOUBLE AS fn FROM pooled GROUP BY ALL),
    r AS (SELECT *, tp + fp + tn + fn AS m, tp / nullif(tp + fn, 0) AS se, tn / nullif(tn + fp, 0) AS sp FROM k)
--
SELECT field, outer_fold, m::BIGINT AS n, (tp + fn)::BIGINT AS n_positive, (tp + tn) / m AS accuracy, (se + sp) / 2 AS balanced_accuracy, se AS sensitivity, sp AS specificity,
    tp / nullif(tp + fp, 0) AS "precision", tn / nullif(tn + fn, 0) AS npv, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1,
    (tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc,
    ((tp + tn) / m - ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (m * m)) / nullif(1 - ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (m * m), 0) AS kappa FROM r""",
    'accuracy balanced_accuracy sensitivity specificity "precision" npv f1 mcc kappa')

_PER_CLASS = """arg AS (SELECT *, list_position(probs, list_max(probs)) - 1 AS pred FROM pooled WHERE label >= 0),
    e AS (SELECT field, outer_fold, label AS t, pred, k AS class, probs[k + 1] AS prob, CASE WHEN label = k THEN 1 ELSE 0 END AS label FROM arg, (SELECT unnest(range(5))::INT AS k)), """ + _auroc_ctes("e", "field, outer_fold, class") + f""",
    au AS (SELECT field, outer_fold, class, {_AUROC} AS auroc FROM w GROUP BY ALL),
    n AS (SELECT field, outer_fold, class, count(*) FILTER (t = class) AS support, count(*) FILTER (pred = class) AS said, count(*) FILTER (t = class AND pred = class)::DOUBLE AS tp FROM e GROUP BY ALL),
    pc AS (SELECT n.field, n.outer_fold, n.class, support, tp / nullif(said, 0) AS prec, tp / nullif(support, 0) AS recall, 2 * tp / nullif(support + said, 0) AS f1, auroc
           FROM n JOIN au ON n.field = au.field AND n.outer_fold = au.outer_fold AND n.class = au.class)"""

query("m04_multiclass_per_class", "multi", lambda t: M.multiclass_per_class(with_pooled(t.multi), BY, 5).withColumnRenamed("precision", "prec"),
    f"""{POOLED.format(t="multi")}, {_PER_CLASS}
--
SELECT * FROM pc""", "prec recall f1 auroc")

query("m05_m06_multiclass_macro_and_kappa", "multi", lambda t: M.multiclass_metrics(with_pooled(t.multi), BY, 5),
    f"""{POOLED.format(t="multi")}, {_PER_CLASS}, ma AS (SELECT field, outer_fold, avg(auroc) AS macro_auroc, avg(recall) FILTER (support > 0) AS balanced_accuracy, avg(coalesce(f1, 0)) FILTER (support > 0) AS macro_f1 FROM pc GROUP BY ALL),
    cnt AS (SELECT field, outer_fold, label AS i, pred AS j, count(*)::DOUBLE AS o FROM arg GROUP BY ALL),
    mi AS (SELECT field, outer_fold, i, sum(o) AS r FROM cnt GROUP BY ALL), mj AS (SELECT field, outer_fold, j, sum(o) AS c FROM cnt GROUP BY ALL),
    ex AS (SELECT mi.field, mi.outer_fold, sum((i - j) * (i - j) * r * c) AS e FROM mi JOIN mj ON mi.field = mj.field AND mi.outer_fold = mj.outer_fold GROUP BY ALL),
    ob AS (SELECT field, outer_fold, sum((i - j) * (i - j) * o) AS d, sum(o) AS m, sum(o) FILTER (i = j) / sum(o) AS accuracy FROM cnt GROUP BY ALL)
--
SELECT ob.field, ob.outer_fold, accuracy, m::BIGINT AS n, macro_auroc, balanced_accuracy, macro_f1, 1 - d / nullif(e / m, 0) AS quadratic_kappa
FROM ob JOIN ex USING (field, outer_fold) JOIN ma USING (field, outer_fold)""", "accuracy macro_auroc balanced_accuracy macro_f1 quadratic_kappa")

query("a36_confusion_matrix", "multi", lambda t: M.confusion_matrix(t.multi, BY, 5),
    """arg AS (SELECT field, outer_fold, label, list_position(probs, list_max(probs)) - 1 AS pred FROM multi WHERE label >= 0),
    grid AS (SELECT * FROM (SELECT DISTINCT field, outer_fold FROM arg), (SELECT unnest(range(5))::INT AS t), (SELECT unnest(range(5))::INT AS p)),
    g AS (SELECT grid.field, grid.outer_fold, t AS "true", p AS pred, count(arg.label) AS n FROM grid LEFT JOIN arg ON arg.field = grid.field AND arg.outer_fold = grid.outer_fold AND label = t AND arg.pred = p GROUP BY ALL)
--
SELECT *, coalesce(n / nullif(sum(n) OVER (PARTITION BY field, outer_fold, "true"), 0), 0) AS share FROM g""", "share")

query("m07_m22_regression_metrics", "reg", lambda t: M.regression_metrics(with_pooled(R.pool_out_of_fold(t.reg, "pred")), BY),
    f"""rp AS (SELECT field, outer_fold, inner_fold, patient_id, avg(pred) AS pred, first(label) AS label FROM reg GROUP BY ALL),
    oof AS (SELECT field, outer_fold, patient_id, avg(pred) AS pred, first(label) AS label FROM rp GROUP BY field, outer_fold, patient_id), {POOLED.format(t="oof")},
    rk AS (SELECT *, row_number() OVER (PARTITION BY field, outer_fold ORDER BY pred, patient_id) AS rx, row_number() OVER (PARTITION BY field, outer_fold ORDER BY label, patient_id) AS ry FROM pooled)
--
SELECT field, outer_fold, count(*) AS n, avg(abs(pred - label)) AS mae, sqrt(avg((pred - label) ** 2)) AS rmse, 1 - avg((pred - label) ** 2) / var_pop(label) AS r2, corr(pred, label) AS pearson,
    regr_slope(pred, label) AS slope, regr_intercept(pred, label) AS intercept, corr(rx, ry) AS spearman FROM rk GROUP BY field, outer_fold""", "mae rmse r2 pearson slope intercept spearman")

query("m10_j14_concordance", "surv", lambda t: M.concordance(with_pooled(t.surv), BY),
    f"""{POOLED.format(t="surv")}
--
SELECT a.field, a.outer_fold, sum(CASE WHEN a.risk > b.risk THEN 1.0 WHEN a.risk = b.risk THEN 0.5 ELSE 0.0 END) / count(*) AS c_index
FROM pooled a JOIN pooled b ON a.field = b.field AND a.outer_fold = b.outer_fold AND b.time > a.time WHERE a.event = 1 GROUP BY a.field, a.outer_fold""", "c_index")

_KM = """st AS (SELECT {by}, time, count(*) AS n, sum(event)::BIGINT AS events FROM {t} GROUP BY ALL),
    km AS (SELECT *, (sum(n) OVER (PARTITION BY {by} ORDER BY time DESC))::BIGINT AS at_risk FROM st),
    cur AS (SELECT {by}, time, at_risk, events, product(1 - events / at_risk) OVER (PARTITION BY {by} ORDER BY time) AS survival FROM km
            UNION ALL SELECT {by}, 0.0, sum(n)::BIGINT, 0, 1.0 FROM st GROUP BY {by})"""

query("m11_w04_kaplan_meier", "surv", lambda t: M.kaplan_meier(t.surv, BY), f"{_KM.format(by='field, outer_fold', t='surv')}\n--\nSELECT * FROM cur", "survival time")
query("m12_km_by_risk", "surv", lambda t: M.km_by_risk(t.surv, ["field"]),
    f"""half AS (SELECT *, CASE WHEN risk >= (SELECT quantile_cont(risk, 0.5) FROM surv) THEN 'high' ELSE 'low' END AS risk_group FROM surv), {_KM.format(by='field, risk_group', t='half')}
--
SELECT * FROM cur""", "survival time")

query("m08_m09_survival_activation", "bins", lambda t: t.bins.select("slide_id", "inner_fold", L.survival_risk("logits").alias("risk"), L.survival(L.hazards("logits"))[3].alias("s_last"), L.survival_bin("time", F.col("time_edges")).alias("bin")),
    """h AS (SELECT *, list_transform(logits, lambda x: 1 - 1 / (1 + exp(-x))) AS q FROM bins)
--
SELECT slide_id, inner_fold, -(q[1] + q[1] * q[2] + q[1] * q[2] * q[3] + q[1] * q[2] * q[3] * q[4]) AS risk, q[1] * q[2] * q[3] * q[4] AS s_last, len(list_filter(time_edges, lambda e: e < time))::INT AS bin FROM h""", "risk s_last")

query("m13_m14_gene_correlations", "genes", lambda t: M.gene_pearson(t.genes).join(M.gene_spearman(t.genes), ["gene_id"]),
    """rk AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY pred, patient_id) AS rx, row_number() OVER (PARTITION BY gene_id ORDER BY label, patient_id) AS ry FROM genes)
--
SELECT gene_id, count(*) AS n, corr(pred, label) AS pearson, sqrt(avg((pred - label) ** 2)) AS rmse, corr(rx, ry) AS spearman FROM rk GROUP BY gene_id""", "pearson rmse spearman")

query("m15_t02_gene_summary", "genes", lambda t: M.gene_summary(M.gene_pearson(t.genes).join(M.gene_spearman(t.genes), ["gene_id"]), top=10),
    """rk AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY pred, patient_id) AS rx, row_number() OVER (PARTITION BY gene_id ORDER BY label, patient_id) AS ry FROM genes),
    g AS (SELECT gene_id, corr(pred, label) AS pearson, corr(rx, ry) AS spearman FROM rk GROUP BY gene_id), o AS (SELECT *, row_number() OVER (ORDER BY pearson DESC, gene_id) AS k FROM g)
--
SELECT avg(pearson) AS mean_pearson, avg(pearson) FILTER (k <= 10) AS top_mean_pearson, quantile_cont(spearman, 0.5) AS median_spearman, count(pearson) AS n_scored, count(*) AS n_genes FROM o""", "mean_pearson top_mean_pearson median_spearman")

def _erf(x: str) -> str:
    """The error function of x >= 0 as a series of positive terms; beyond 6 it is 1 to 15 digits."""
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 0.0 WHEN {x} > 6 THEN 1.0 ELSE exp(-({x}) * ({x})) * list_sum(list_transform(range(0, 200), lambda k: exp((2 * k + 1) * ln({x}) - lgamma(k + 1.5)))) END)"


def _fisher(r: str, n: str) -> str:
    z = f"(abs(atanh(greatest(-0.999999, least(0.999999, {r})))) * sqrt({n} - 3) / sqrt(2.0))"
    return f"(1 - {_erf(z)})"


# ordered by the statistic: far tails are 0 in SQL and tiny, but apart, in Spark
_STEP_UP = """k AS (SELECT *, row_number() OVER (ORDER BY {o}, gene_id) AS rank, count(*) OVER () AS m FROM {t} WHERE {p} IS NOT NULL),
    bh AS (SELECT *, least(1.0, min({p} * m / rank) OVER (ORDER BY rank DESC)) AS q_value FROM k)"""

query("m16_m17_d07_significant_genes", "genes", lambda t: M.benjamini_hochberg(M.gene_pearson(t.genes).withColumn("p_value", M.fisher_p(F.col("pearson"), F.col("n"))).withColumn("z", M.fisher_z(F.col("pearson"), F.col("n"))), [], "p_value", "gene_id", "z").select("gene_id", "p_value", "rank", "m", "q_value"),
    f"""g AS (SELECT gene_id, count(*) AS n, corr(pred, label) AS r FROM genes GROUP BY gene_id), pv AS (SELECT gene_id, abs(atanh(greatest(-0.999999, least(0.999999, r)))) * sqrt(n - 3) AS z, {_fisher("r", "n")} AS p_value FROM g), {_STEP_UP.format(p="p_value", o="-z", t="pv")}
--
SELECT gene_id, p_value, CAST(rank AS INT) AS rank, m, q_value FROM bh""", "p_value q_value")

query("m18_m19_j12_beats_random", "genes", lambda t: M.beats_random(t.genes.select("gene_id", "patient_id", "pred", "label"), t.genes.select("gene_id", "patient_id", F.col("base").alias("pred"), "label")),
    f"""g AS (SELECT gene_id, count(*) AS n, corr(pred, label) AS r_trained, corr(base, label) AS r_random, corr(pred, base) AS r_between, sqrt(avg((pred - label) ** 2)) AS rmse_trained, sqrt(avg((base - label) ** 2)) AS rmse_random FROM genes GROUP BY gene_id),
    d AS (SELECT *, 1 - r_trained ** 2 - r_random ** 2 - r_between ** 2 + 2 * r_trained * r_random * r_between AS det, (r_trained + r_random) / 2 AS mr FROM g),
    w AS (SELECT *, (r_trained - r_random) * sqrt((n - 1) * (1 + r_between) / (2 * det * (n - 1) / (n - 3) + mr * mr * (1 - r_between) ** 3)) AS williams_t, {_fisher("r_trained", "n")} AS p_own FROM d),
    pv AS (SELECT *, CASE WHEN williams_t >= 0 THEN (1 - {_erf("(williams_t / sqrt(2.0))")}) / 2 ELSE (1 + {_erf("(-williams_t / sqrt(2.0))")}) / 2 END AS p_better FROM w), {_STEP_UP.format(p="p_better", o="-williams_t", t="pv")}
--
SELECT gene_id, n, r_trained, r_random, r_between, rmse_trained, rmse_random, williams_t, p_own, p_better, q_value,
    r_trained > 0 AND p_own < 0.05 AND r_trained > r_random AND p_better < 0.05 AND q_value < 0.2 AND rmse_trained < rmse_random AS beats FROM bh""",
    "r_trained r_random r_between rmse_trained rmse_random williams_t p_own p_better q_value")

query("m20_roc_points", "preds", lambda t: M.roc_points(t.preds, BY).where(F.col("threshold") < 10),
    f"""{_auroc_ctes("preds", "field, outer_fold")}
--
SELECT field, outer_fold, s AS threshold, dn / sum(n) OVER (PARTITION BY field, outer_fold) AS fpr, dp / sum(p) OVER (PARTITION BY field, outer_fold) AS tpr FROM w""", "threshold fpr tpr")
query("m20_roc_band", "preds", lambda t: M.roc_band(M.roc_points(t.preds, BY), ["field"]),
    f"""{_auroc_ctes("preds", "field, outer_fold")},
    pts AS (SELECT field, outer_fold, dn / sum(n) OVER (PARTITION BY field, outer_fold) AS fpr, dp / sum(p) OVER (PARTITION BY field, outer_fold) AS tpr FROM w UNION ALL SELECT DISTINCT field, outer_fold, 0.0, 0.0 FROM w),
    st AS (SELECT field, outer_fold, fpr, max(tpr) AS tpr FROM pts GROUP BY ALL), sg AS (SELECT *, lead(fpr) OVER q AS f2, lead(tpr) OVER q AS t2 FROM st WINDOW q AS (PARTITION BY field, outer_fold ORDER BY fpr)),
    gr AS (SELECT unnest(range(201)) / 200.0 AS x),
    iv AS (SELECT field, outer_fold, x, CASE WHEN f2 IS NULL THEN tpr ELSE tpr + (t2 - tpr) * (x - fpr) / (f2 - fpr) END AS v FROM sg JOIN gr ON round(x, 9) >= round(fpr, 9) AND (f2 IS NULL OR round(x, 9) < round(f2, 9)))
--
SELECT field, avg(v) AS mean_tpr, stddev_pop(v) AS sd_tpr, x AS fpr FROM iv GROUP BY field, x""", "mean_tpr sd_tpr fpr")
query("m21_ovr_roc_points", "multi", lambda t: M.ovr_roc_points(t.multi, ["field", "inner_fold"]).where(F.col("threshold") < 10),
    f"""e AS (SELECT field, inner_fold, k AS class, probs[k + 1] AS prob, CASE WHEN label = k THEN 1 ELSE 0 END AS label FROM multi, (SELECT unnest(range(5))::INT AS k) WHERE label >= 0), {_auroc_ctes("e", "field, inner_fold, class")}
--
SELECT field, inner_fold, class, s AS threshold, dn / sum(n) OVER (PARTITION BY field, inner_fold, class) AS fpr, dp / sum(p) OVER (PARTITION BY field, inner_fold, class) AS tpr FROM w""", "threshold fpr tpr")
query("m24_m25_registry_score", "reg", lambda t: M.resolve_metric("regression", "r2")[1](R.slides_to_patients(t.reg, ["field", "outer_fold"], "pred"), BY),
    """p AS (SELECT field, outer_fold, patient_id, avg(pred) AS pred, first(label) AS label FROM reg GROUP BY ALL)
--
SELECT field, outer_fold, 1 - avg((pred - label) ** 2) / var_pop(label) AS metric FROM p GROUP BY field, outer_fold""", "metric")
query("m26_slide_level_metrics", "preds", lambda t: M.auroc(t.preds, [*BY, "inner_fold"]).join(M.confusion(t.preds, [*BY, "inner_fold"]).select(*BY, "inner_fold", "accuracy"), [*BY, "inner_fold"]),
    f"""{_auroc_ctes("preds", "field, outer_fold, inner_fold")}, a AS (SELECT field, outer_fold, inner_fold, {_AUROC} AS auroc FROM w GROUP BY ALL),
    b AS (SELECT field, outer_fold, inner_fold, avg(CASE WHEN (prob >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM preds GROUP BY ALL)
--
SELECT * FROM a JOIN b USING (field, outer_fold, inner_fold)""", "auroc accuracy")

# ---- roll-ups ----

query("a01_slides_to_patients", "preds", lambda t: R.slides_to_patients(t.preds, ["field", "outer_fold", "inner_fold"]), "SELECT field, outer_fold, inner_fold, patient_id, avg(prob) AS prob, first(label) AS label, count(*) AS n_slides FROM preds GROUP BY ALL", "prob")
query("a01_vector_mean", "multi", lambda t: R.slides_to_patients(t.multi, BY, "probs").select(*BY, "patient_id", "label", "n_slides", *[F.col("probs")[k].alias(f"p{k}") for k in range(5)]),
    "SELECT field, outer_fold, patient_id, first(label) AS label, count(*) AS n_slides, " + ", ".join(f"avg(probs[{k + 1}]) AS p{k}" for k in range(5)) + " FROM multi GROUP BY field, outer_fold, patient_id", "p0 p1 p2 p3 p4")
_OOF = """rp AS (SELECT field, outer_fold, inner_fold, patient_id, avg(prob) AS prob, first(label) AS label FROM preds GROUP BY ALL),
    oof AS (SELECT field, outer_fold, patient_id, avg(prob) AS prob, first(label) AS label, count(*) AS n_replicates FROM rp GROUP BY field, outer_fold, patient_id)"""
query("a02_s15_t06_out_of_fold_record", "preds", lambda t: R.pool_out_of_fold(t.preds), f"{_OOF}\n--\nSELECT * FROM oof", "prob")
query("a03_a35_ensemble", "preds", lambda t: R.ensemble(R.slides_to_patients(t.preds, ["field", "inner_fold"])), """rp AS (SELECT field, inner_fold, patient_id, avg(prob) AS prob FROM preds GROUP BY ALL)
--
SELECT field, patient_id, avg(prob) AS prob, count(*) AS n_models FROM rp GROUP BY field, patient_id""", "prob")
query("a04_s16_external_ensembles", "preds", lambda t: R.external_ensembles(R.slides_to_patients(t.preds, ["field", "outer_fold", "inner_fold"])), """rp AS (SELECT field, outer_fold, inner_fold, patient_id, avg(prob) AS prob FROM preds GROUP BY ALL)
--
SELECT field, model, patient_id, avg(prob) AS prob, count(*) AS n_models FROM (SELECT *, unnest(['grand', 'o' || outer_fold]) AS model FROM rp) GROUP BY ALL""", "prob")
_FOLDM = f"""{_OOF}, {POOLED.format(t="oof")}, {_auroc_ctes("pooled", "field, outer_fold")}, au AS (SELECT field, outer_fold, {_AUROC} AS auroc, sum(p * dp / (dp + dn)) / sum(p) AS average_precision FROM w GROUP BY field, outer_fold)"""


def _fold_metrics(t: Frames) -> DataFrame:
    rows = with_pooled(R.pool_out_of_fold(t.preds))
    return M.auroc(rows, BY).join(M.average_precision(rows, BY), BY)


query("a05_fold_mean_sd", "preds", lambda t: R.mean_std(_fold_metrics(t).where("outer_fold >= 0"), ["auroc", "average_precision"]), f"""{_FOLDM}
--
SELECT field, unnest(['auroc', 'average_precision']) AS metric, unnest([avg(auroc), avg(average_precision)]) AS mean, unnest([stddev_pop(auroc), stddev_pop(average_precision)]) AS sd, unnest([count(auroc), count(average_precision)]) AS n_folds FROM au WHERE outer_fold >= 0 GROUP BY field""", "mean sd")
query("a06_a40_s18_report", "preds", lambda t: R.report(_fold_metrics(t), ["auroc", "average_precision"]), f"""{_FOLDM}
--
SELECT field, CASE WHEN outer_fold = -1 THEN 'pooled' ELSE 'fold' END AS row_kind, outer_fold, auroc, average_precision FROM au
UNION ALL SELECT field, 'mean', NULL, avg(auroc), avg(average_precision) FROM au WHERE outer_fold >= 0 GROUP BY field
UNION ALL SELECT field, 'sd', NULL, stddev_pop(auroc), stddev_pop(average_precision) FROM au WHERE outer_fold >= 0 GROUP BY field""", "auroc average_precision")
query("a41_headline", "preds", lambda t: R.headline(R.report(_fold_metrics(t), ["auroc"]), "auroc").select("field", "mean", "sd", "pooled"), f"""{_FOLDM}
--
SELECT field, round(avg(auroc) FILTER (outer_fold >= 0), 3) AS mean, round(stddev_pop(auroc) FILTER (outer_fold >= 0), 3) AS sd, round(max(auroc) FILTER (outer_fold = -1), 3) AS pooled FROM au GROUP BY field""", "mean sd pooled")
query("a07_tiles_to_slides", "tiles", lambda t: R.tiles_to_slides(t.tiles), "SELECT slide_id, avg(1 / (1 + exp(-logit))) AS prob, ln(sum(1 / (1 + exp(-logit)))) - ln(sum(1 / (1 + exp(logit)))) AS logit, first(label) AS label, count(*) AS n_tiles FROM tiles WHERE label >= 0 GROUP BY slide_id", "prob logit")
query("a08_pooled_slide_auroc", "tiles", lambda t: R.pooled_slide_auroc(t.tiles.withColumn("part", F.pmod("slide_id", F.lit(4)).cast("int")), ["part"]),
    f"""sl AS (SELECT CAST(slide_id % 4 AS INT) AS part, slide_id, round(avg(1 / (1 + exp(-logit))), 12) AS prob, first(label) AS label FROM tiles WHERE label >= 0 GROUP BY ALL), {_auroc_ctes("sl", "part")}
--
SELECT part, {_AUROC} AS auroc FROM w GROUP BY part""", "auroc")
query("a38_score_groups", "preds", lambda t: R.score_groups(t.preds, BY), """SELECT field, outer_fold, label, count(*) AS n, min(prob) AS min, quantile_cont(prob, 0.25) AS q1, quantile_cont(prob, 0.5) AS median, quantile_cont(prob, 0.75) AS q3, max(prob) AS max FROM preds GROUP BY field, outer_fold, label""", "min q1 median q3 max")
query("a38_ovr_score_groups", "multi", lambda t: R.ovr_score_groups(t.multi, ["field"]), """e AS (SELECT field, k AS class, probs[k + 1] AS prob, CASE WHEN label = k THEN 1 ELSE 0 END AS label FROM multi, (SELECT unnest(range(5))::INT AS k) WHERE label >= 0)
--
SELECT field, class, label, count(*) AS n, min(prob) AS min, quantile_cont(prob, 0.25) AS q1, quantile_cont(prob, 0.5) AS median, quantile_cont(prob, 0.75) AS q3, max(prob) AS max FROM e GROUP BY ALL""", "min q1 median q3 max")
query("a37_histogram", "follow", lambda t: R.histogram(t.follow, "time", 12, -120, 120, ["event"]), """SELECT event, CAST(least(floor((time + 120) / 240 * 12), 11) AS INT) AS bin, count(*) AS n, -120 + 240 * CAST(least(floor((time + 120) / 240 * 12), 11) AS INT) / 12.0 AS low, -120 + 240 * (CAST(least(floor((time + 120) / 240 * 12), 11) AS INT) + 1) / 12.0 AS high FROM follow WHERE time BETWEEN -120 AND 120 GROUP BY ALL""", "low high")
query("a16_f16_a32_coverage", "", lambda t: R.fold_coverage(C.scored_coverage(t.documents.select(F.lit("quality").alias("field"), F.pmod("doc_id", F.lit(3)).cast("int").alias("outer_fold"), F.col("doc_id").alias("patient_id")), t.labels.select(F.lit("quality").alias("field"), F.pmod("doc_id", F.lit(3)).cast("int").alias("outer_fold"), F.col("doc_id").alias("patient_id")), BY)).select("field", "n_declared", "n_scored", F.size("lost").alias("n_lost"), F.array_min("lost").alias("first_lost")),
    """j AS (SELECT d.doc_id, l.doc_id AS got FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id)
--
SELECT 'quality' AS field, count(*) AS n_declared, count(got) AS n_scored, CAST(count(*) - count(got) AS INT) AS n_lost, min(doc_id) FILTER (got IS NULL) AS first_lost FROM j""")

# ---- targets ----

_NUM = "CASE WHEN isfinite(TRY_CAST(trim(ki67) AS DOUBLE)) THEN TRY_CAST(trim(ki67) AS DOUBLE) END"
query("p01_p02_p03_p05_p06_targets", "sheet", lambda t: t.sheet.select("patient_id", L.clean("segment").alias("clean"), L.number("ki67").alias("value"), L.categorical("segment", {"BUILDING": 0, "FURNITURE": 1, "MACHINERY": 2}).alias("class"), L.binarize(L.number("ki67"), F.lit(4500.0)).alias("high"), L.discretize(L.number("ki67"), [0.0, 3000.0, 6000.0]).cast("int").alias("level"), L.reader_or("segment", "OPENSLIDE").alias("reader")),
    f"""x AS (SELECT *, {_NUM} AS v, CASE WHEN lower(trim(segment)) IN ('nan', 'none', '') THEN NULL ELSE trim(segment) END AS cl FROM sheet)
--
SELECT patient_id, cl AS clean, v AS value, CAST(CASE segment WHEN 'BUILDING' THEN 0 WHEN 'FURNITURE' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE -1 END AS INT) AS class, CAST(CASE WHEN v IS NULL THEN -1 WHEN v >= 4500 THEN 1 ELSE 0 END AS INT) AS high,
    CAST(CASE WHEN v IS NULL THEN -1 ELSE (v >= 0)::INT + (v >= 3000)::INT + (v >= 6000)::INT END AS INT) AS level, coalesce(upper(cl), 'OPENSLIDE') AS reader FROM x""", "value")
query("p04_p11_p12_standardize", "matrix", lambda t: t.matrix.join(A.gene_state(t.matrix), "gene_id").select("gene_id", "patient_id", L.standardize(F.col("value"), F.col("mean"), F.col("std")).alias("z"), L.unstandardize(L.standardize(F.col("value"), F.col("mean"), F.col("std")), F.col("mean"), F.col("std")).alias("back")),
    """st AS (SELECT gene_id, avg(ln(1 + value)) AS m, stddev_pop(ln(1 + value)) AS s FROM matrix GROUP BY gene_id)
--
SELECT gene_id, patient_id, (ln(1 + value) - m) / s AS z, ln(1 + value) AS back FROM matrix JOIN st USING (gene_id)""", "z back")
query("p07_p08_j04_labels_long_wide", "sheet slides patients", lambda t: sheets.wide_labels(sheets.long_labels(t.sheet, "patient_id"), ["ki67", "segment"], t.slides, t.patients),
    "SELECT p.patient_id, ki67, segment, (SELECT count(*) FROM slides s WHERE s.patient_id = p.patient_id) AS n_slides FROM patients p JOIN sheet USING (patient_id)")
query("p10_censoring", "follow", lambda t: t.follow.select(*[c.alias(n) for c, n in zip(L.censor("time", "event", 60), ("time", "event"), strict=True)]).groupBy("event").agg(F.count("*").alias("n"), F.sum("time").alias("total")),
    "SELECT CAST(CASE WHEN time > 60 THEN 0 ELSE event END AS INT) AS event, count(*) AS n, sum(CASE WHEN time > 60 THEN 60.0 ELSE time END) AS total FROM follow GROUP BY 1", "total")
query("p13_activations", "bins", lambda t: t.bins.select("slide_id", "inner_fold", L.softmax("logits")[0].alias("first"), L.sigmoid(F.col("logits")[1]).alias("second"), L.argmax("logits").alias("top")),
    "SELECT slide_id, inner_fold, exp(logits[1]) / (exp(logits[1]) + exp(logits[2]) + exp(logits[3]) + exp(logits[4])) AS first, 1 / (1 + exp(-logits[2])) AS second, CAST(list_position(logits, list_max(logits)) - 1 AS INT) AS top FROM bins", "first second")
query("p15_p16_split_names", "preds", lambda t: t.preds.select("field", "outer_fold", "inner_fold").distinct().withColumn("v", L.split_name("field", F.col("outer_fold"), F.col("inner_fold"))).select(F.col("v").alias("split_version"), *[c.alias(n) for n, c in L.split_parts("v").items()], *[c.alias(n) for c, n in zip(L.fold_parts(F.col("outer_fold") * 3 + F.col("inner_fold"), 5, 3), ("flat_outer", "flat_inner"), strict=True)]),
    "SELECT DISTINCT field || '_cv_o' || outer_fold || '_i' || inner_fold AS split_version, field, 'nested_cv' AS strategy, outer_fold, CAST(inner_fold AS INT) AS inner_fold, outer_fold AS flat_outer, CAST(inner_fold AS INT) AS flat_inner FROM preds")
query("p19_a27_a39_geometry", "geometry", lambda t: A.geometry_summary(t.geometry), "SELECT count(*) AS n_slides, count(*) FILTER (width IS NULL OR height IS NULL) AS missing_geometry, count(mask_path) AS with_mask, avg(width * height / 1e6) AS mean_megapixels FROM geometry", "mean_megapixels")
query("p20_j05_stem_pairs", "slides", lambda t: sheets.pair_by_stem(t.slides.select("slide_id", "image_path"), t.slides.where(F.col("slide_id") % 3 == 0).select(F.concat(F.lit("/masks/"), F.col("slide_id").cast("string"), F.lit("_mask.png")).alias("mask_path"))),
    "SELECT slide_id, image_path, CASE WHEN slide_id % 3 = 0 THEN '/masks/' || slide_id || '_mask.png' END AS mask_path FROM slides")
query("p21_p17_survival_bins", "follow", lambda t: t.follow.select(L.survival_bin("time", [0.0, 30.0, 60.0, 90.0]).cast("int").alias("bin"), L.bin_ranges([30, 60, 90]).alias("names")).groupBy("bin").agg(F.count("*").alias("n"), F.array_join(F.first("names"), ",").alias("names")),
    "SELECT CAST((time > 0)::INT + (time > 30)::INT + (time > 60)::INT + (time > 90)::INT AS INT) AS bin, count(*) AS n, '0-30,30-60,60-90,90+' AS names FROM follow GROUP BY 1")

# ---- checks ----

query("f01_f03_valid_strata", "sheet", lambda t: C.strata_of_fields({"high": C.valid_strata(t.sheet, L.binarize(L.number("ki67"), F.lit(4500.0)), "binary"), "segment": C.valid_strata(t.sheet, L.categorical("segment", {"BUILDING": 0, "FURNITURE": 1}), "multiclass")}).groupBy("field", "stratum").agg(F.count("*").alias("n")),
    f"""x AS (SELECT 'high' AS field, CAST(CASE WHEN {_NUM} >= 4500 THEN 1 WHEN {_NUM} < 4500 THEN 0 END AS INT) AS stratum FROM sheet UNION ALL SELECT 'segment', CAST(CASE segment WHEN 'BUILDING' THEN 0 WHEN 'FURNITURE' THEN 1 END AS INT) FROM sheet)
--
SELECT field, stratum, count(*) AS n FROM x WHERE stratum IS NOT NULL GROUP BY field, stratum""")
query("f02_valid_survival", "follow", lambda t: C.valid_survival(t.follow, F.col("time"), F.col("event")).groupBy("stratum").agg(F.count("*").alias("n")), "SELECT event AS stratum, count(*) AS n FROM follow WHERE time > 0 GROUP BY event")
query("f04_unusable_values", "sheet", lambda t: C.unusable_values(t.sheet, "ki67", L.number("ki67").isNotNull()), f"SELECT 'ki67' AS \"column\", trim(ki67) AS value, count(DISTINCT patient_id) AS n_patients FROM sheet WHERE lower(trim(ki67)) NOT IN ('nan', 'none', '') AND {_NUM} IS NULL GROUP BY ALL")
query("f05_f06_u03_coverage", "matrix", lambda t: C.covered_by_all([t.matrix, t.labels.select(F.col("doc_id").cast("string").alias("patient_id"))]), "SELECT DISTINCT patient_id FROM matrix WHERE patient_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)")
query("f07_sheet_violations", "patients slides", lambda t: C.validate_sheets(t.patients.where("c_custkey % 9 <> 0").unionByName(t.patients.where("c_custkey % 50 = 1")), t.slides),
    """p AS (SELECT patient_id FROM patients WHERE c_custkey % 9 <> 0 UNION ALL SELECT patient_id FROM patients WHERE c_custkey % 50 = 1)
--
SELECT 'duplicate patient' AS kind, patient_id AS key, count(*) AS n FROM p GROUP BY patient_id HAVING count(*) > 1 UNION ALL SELECT 'duplicate slide', image_path, count(*) FROM slides GROUP BY image_path HAVING count(*) > 1
UNION ALL SELECT 'orphan slide', patient_id, count(*) FROM slides WHERE patient_id NOT IN (SELECT patient_id FROM p) GROUP BY patient_id""")
query("f08_s02_j02_mask_map", "slides geometry", lambda t: sheets.with_masks(t.slides.select("slide_id", "image_path"), t.geometry.where("mask_path is not null").select(F.concat(F.lit("/data/"), F.col("slide_id").cast("string"), F.lit(".svs")).alias("image_path"), "mask_path")).groupBy(F.col("mask_path").isNull().alias("no_mask")).agg(F.count("*").alias("n")), "SELECT mask_path IS NULL AS no_mask, count(*) AS n FROM geometry GROUP BY 1")
query("f09_f10_conflicts", "slides", lambda t: C.conflicting(C.one_row_per_patient(t.slides.select("patient_id", "o_orderpriority"))[0], "patient_id", "o_orderpriority"), "SELECT patient_id, count(DISTINCT o_orderpriority) AS n FROM slides GROUP BY patient_id HAVING count(DISTINCT o_orderpriority) > 1")
query("f11_f13_u04_orphans", "slides geometry", lambda t: C.orphans(t.slides.select("slide_id", "patient_id"), t.geometry.where("mask_path is not null"), ["slide_id"]), "SELECT slide_id, patient_id FROM slides WHERE slide_id NOT IN (SELECT slide_id FROM geometry WHERE mask_path IS NOT NULL)")
query("f14_missing_labels", "multi sheet", lambda t: t.multi.groupBy(C.is_missing(F.col("label"), "multiclass").alias("missing")).agg(F.count("*").alias("n")), "SELECT label < 0 AS missing, count(*) AS n FROM multi GROUP BY 1")
query("f15_minimum_tiles", "tiles", lambda t: C.at_least(t.tiles, 5), "SELECT slide_id FROM tiles GROUP BY slide_id HAVING count(*) >= 5")
query("f17_incomplete_grid", "preds", lambda t: C.incomplete_grid(t.preds.where("NOT (outer_fold = 2 AND inner_fold = 1)").select("field", "outer_fold", "inner_fold").distinct(), 5, 3), "SELECT 'er' AS field, CAST(2 AS INT) AS outer_fold, CAST(1 AS INT) AS inner_fold")
query("f18_undeclared", "preds multi", lambda t: C.undeclared(t.preds.select("field").unionByName(t.multi.select("field")).distinct(), t.preds.select("field").distinct()), "SELECT DISTINCT field, 'undeclared' AS kind FROM multi")
query("f19_u05_uneven_replicates", "preds", lambda t: C.uneven_replicates(t.preds.where("NOT (inner_fold = 1 AND CAST(patient_id AS INT) % 10 = 3)")),
    """r AS (SELECT DISTINCT field, outer_fold, inner_fold, patient_id FROM preds WHERE NOT (inner_fold = 1 AND CAST(patient_id AS INT) % 10 = 3)), n AS (SELECT field, outer_fold, count(DISTINCT inner_fold) AS n_inner FROM r GROUP BY ALL)
--
SELECT r.field, r.outer_fold, patient_id, count(*) AS n_scored, n_inner FROM r JOIN n USING (field, outer_fold) GROUP BY ALL HAVING count(*) < n_inner""")
query("f20_shared_with_development", "patients", lambda t: C.shared_with_development(t.patients.where("c_custkey % 2 = 0"), t.patients.where("c_custkey % 3 = 0")), "SELECT patient_id FROM patients WHERE c_custkey % 6 = 0")


def _import_checks(t: Frames) -> DataFrame:
    split = t.strata.select(F.lit("all_test_er").alias("split_version"), "patient_id", F.when(F.col("patient_id").cast("int") % 10 == 0, "fit").otherwise("test").alias("category")).where(F.col("patient_id").cast("int") % 7 != 0)
    spark = t.spark
    expected = spark.createDataFrame([("all_test_er", "er", "all_test"), ("all_predict", None, "all_predict")], "split_version string, field string, strategy string")
    return C.splits_violations(split, expected, t.patients.where("c_custkey % 13 <> 0"), t.strata.where(F.col("patient_id").cast("int") % 11 != 0).select("field", "patient_id"))


query("f21_l10_s20_import_violations", "strata patients", _import_checks,
    """i AS (SELECT patient_id, CAST(patient_id AS INT) AS k, CASE WHEN CAST(patient_id AS INT) % 10 = 0 THEN 'fit' ELSE 'test' END AS category FROM strata WHERE CAST(patient_id AS INT) % 7 <> 0)
--
SELECT 'all_predict' AS split_version, NULL AS patient_id, 'missing version' AS reason UNION ALL SELECT 'all_test_er', patient_id, 'unknown patient' FROM i WHERE k % 13 = 0
UNION ALL SELECT 'all_test_er', patient_id, 'category' FROM i WHERE category = 'fit' UNION ALL SELECT 'all_test_er', patient_id, 'invalid patient' FROM i WHERE k % 11 = 0 AND k % 13 <> 0
UNION ALL SELECT 'all_test_er', patient_id, 'uncovered patient' FROM strata WHERE CAST(patient_id AS INT) % 11 <> 0 AND CAST(patient_id AS INT) % 7 = 0""")
query("f22_j17_uncovered_pairs", "preds", lambda t: C.uncovered_pairs(t.preds, t.preds.select("patient_id"), t.preds),
    "SELECT DISTINCT p.patient_id, m.outer_fold, m.inner_fold FROM preds p, (SELECT DISTINCT outer_fold, inner_fold FROM preds) m WHERE p.outer_fold <> m.outer_fold")
query("f23_f24_arm_agreement", "arms", lambda t: C.disagreeing(t.arms.withColumn("outer_fold", F.when((F.col("arm") == "wide") & (F.col("patient_id").cast("int") % 100 == 5), 4).otherwise(F.col("outer_fold"))), "outer_fold"), "SELECT field, patient_id, min(outer_fold) AS low, CAST(4 AS INT) AS high FROM arms WHERE CAST(patient_id AS INT) % 100 = 5 GROUP BY ALL")
query("f25_f26_trial_violations", "trials", lambda t: C.trial_violations(t.trials.withColumn("split_hash", F.when((F.col("seed") == 3) & (F.col("arm") == "click"), "x").otherwise(F.col("split_hash"))).withColumn("metric", F.when((F.col("seed") == 4) & (F.col("rep") == 1), float("nan")).otherwise(F.col("metric")))),
    """x AS (SELECT * REPLACE (CASE WHEN seed = 3 AND arm = 'click' THEN 'x' ELSE split_hash END AS split_hash) FROM trials)
--
SELECT arm AS key, count(*) AS n, 'metric' AS kind FROM x WHERE seed = 4 AND rep = 1 GROUP BY arm UNION ALL SELECT CAST(seed AS VARCHAR), count(DISTINCT split_hash), 'split' FROM x GROUP BY seed HAVING count(DISTINCT split_hash) > 1
UNION ALL SELECT CAST(train_seed AS VARCHAR), count(*), 'train seed' FROM x GROUP BY train_seed HAVING count(*) > 1""")
query("f27_f28_uneven_keys", "preds", lambda t: C.uneven_keys(t.preds.where("NOT (outer_fold = 1 AND slide_id % 2 = 0)").withColumn("gene_id", F.col("slide_id") % 8), ["gene_id"]), """x AS (SELECT DISTINCT slide_id % 8 AS gene_id, outer_fold, inner_fold FROM preds WHERE NOT (outer_fold = 1 AND slide_id % 2 = 0))
--
SELECT gene_id, count(*) AS n_folds FROM x GROUP BY gene_id HAVING count(*) < (SELECT count(*) FROM (SELECT DISTINCT outer_fold, inner_fold FROM x))""")
query("f30_work_left", "trials", lambda t: C.work_left(t.trials.select("arm", "seed").distinct(), t.trials.where("rep = 0 AND seed % 2 = 0"), ["arm", "seed"]), "SELECT DISTINCT arm, seed FROM trials WHERE (arm, seed) NOT IN (SELECT (arm, seed) FROM trials WHERE rep = 0 AND seed % 2 = 0)")
query("f31_resolve_names", "slides", lambda t: C.resolve_names(t.slides.where("slide_id % 5 = 0").select(F.concat(F.col("slide_id").cast("string"), F.lit(".svs")).alias("name")).unionByName(t.slides.where("slide_id % 7 = 0").select(F.concat(F.lit("/other/"), F.col("slide_id").cast("string")).alias("name"))), t.slides), "SELECT slide_id || '.svs' AS name, slide_id FROM slides WHERE slide_id % 5 = 0 UNION ALL SELECT '/other/' || slide_id, NULL FROM slides WHERE slide_id % 7 = 0")
query("f33_f34_tile_conflicts", "tiles attention", lambda t: C.coordinate_clashes(t.attention.withColumn("x", F.when((F.col("slide_id") % 97 == 0) & (F.col("inner_fold") == 1), F.col("x") + 1).otherwise(F.col("x")))), "SELECT DISTINCT slide_id, 'coordinates' AS kind FROM attention WHERE slide_id % 97 = 0")
query("f35_plan_endpoints", "preds multi reg", lambda t: C.plan_endpoints(t.preds.select("field").unionByName(t.multi.select("field")).unionByName(t.reg.select("field")), t.preds.select("field").unionByName(t.reg.select("field")), t.preds.select("field", F.lit("binary").alias("objective")).distinct().unionByName(t.reg.select("field", F.lit("regression").alias("objective")).distinct()), ["binary"]),
    "SELECT * FROM (VALUES ('er', 'binary', NULL), ('segment', NULL, 'not in the contract'), ('balance', 'regression', 'not reportable')) v(field, objective, skipped)")
query("f36_f29_non_finite_imputed", "matrix", lambda t: t.matrix.withColumn("z", C.impute(F.when(F.col("pos") % 5 != 0, F.col("value")), "impute")).groupBy("gene_id").agg(F.sum("z").alias("total")), "SELECT gene_id, sum(CASE WHEN pos % 5 <> 0 THEN value ELSE 0 END) AS total FROM matrix GROUP BY gene_id", "total")

# ---- splits ----

query("l01_nested_cv", "strata", lambda t: S.nested_cv(t.strata, 5, 3, 42).groupBy("field", "outer_fold", "inner_fold", "category").agg(F.count("*").alias("n"), F.sum(F.col("patient_id").cast("long")).alias("id_sum")),
    """o AS (SELECT *, (row_number() OVER (ORDER BY stratum, md5(concat_ws('|', '42', patient_id)), patient_id) - 1) % 5 AS test FROM strata),
    r AS (SELECT k, patient_id, test, stratum, CASE WHEN test <> k THEN (row_number() OVER (PARTITION BY k, test = k ORDER BY stratum, md5(concat_ws('|', CAST(43 + k AS VARCHAR), patient_id)), patient_id) - 1) % 3 END AS val FROM o, (SELECT unnest(range(5)) AS k)),
    c AS (SELECT 'er' AS field, CAST(k AS INT) AS outer_fold, CAST(i AS INT) AS inner_fold, CASE WHEN test = k THEN 'test' WHEN val = i THEN 'validate' ELSE 'fit' END AS category, patient_id FROM r, (SELECT unnest(range(3)) AS i))
--
SELECT field, outer_fold, inner_fold, category, count(*) AS n, sum(CAST(patient_id AS BIGINT))::BIGINT AS id_sum FROM c GROUP BY ALL""")
query("l02_l06_l07_strategies", "strata", lambda t: S.all_test(t.strata).unionByName(S.all_predict(t.strata)).groupBy("split_version", "category").agg(F.count("*").alias("n")), "SELECT 'all_test_er' AS split_version, 'test' AS category, count(*) AS n FROM strata UNION ALL SELECT 'all_predict', 'predict', count(DISTINCT patient_id) FROM strata")
_DRAW = """p AS (SELECT *, row_number() OVER (PARTITION BY field, stratum ORDER BY md5(concat_ws('|', '7', patient_id)), patient_id) - 1 AS place, count(*) OVER (PARTITION BY field, stratum) AS m FROM strata),
    d AS (SELECT field, patient_id, CASE WHEN place < round(m * 0.2) THEN 'test' WHEN place < round(m * 0.2) + round(m * 0.1) THEN 'validate' ELSE 'fit' END AS category FROM p)"""
query("l03_stratified_draw", "strata", lambda t: S.draw(t.strata, 7, 0.2, 0.1), f"{_DRAW}\n--\nSELECT * FROM d")
query("l04_split_digest", "strata", lambda t: S.split_digest(S.draw(t.strata, 7, 0.2, 0.1)), f"""{_DRAW}, g AS (SELECT field, category, string_agg(patient_id, ',' ORDER BY patient_id) AS codes FROM d GROUP BY ALL)
--
SELECT field, substr(sha256(string_agg(category || ':' || codes, ';' ORDER BY category)), 1, 16) AS split_hash FROM g GROUP BY field""")
query("l05_train_seed", "trials", lambda t: t.trials.select("arm", "seed", "rep", L.train_seed(F.col("arm"), F.col("seed"), F.col("rep")).alias("train_seed")), "SELECT arm, seed, rep, CAST(('0x' || substr(sha256(concat_ws('|', arm, CAST(seed AS VARCHAR), CAST(rep AS VARCHAR))), 1, 12))::BIGINT % 2147483647 AS BIGINT) AS train_seed FROM trials")
query("l08_t04_head_per_class", "slides", lambda t: S.head_per_class(t.slides.select("slide_id", "o_orderpriority"), 7, "o_orderpriority", "slide_id"), "SELECT slide_id, o_orderpriority FROM slides QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY slide_id) <= 7")
query("l09_d09_bags", "tiles", lambda t: S.bags(t.tiles.select("slide_id", "tile_idx"), 6, 3), """r AS (SELECT slide_id, tile_idx, row_number() OVER (PARTITION BY slide_id ORDER BY md5(concat_ws('|', '3', CAST(slide_id AS VARCHAR), CAST(tile_idx AS VARCHAR))), tile_idx) - 1 AS k, count(*) OVER (PARTITION BY slide_id) AS n FROM tiles)
--
SELECT slide_id, tile_idx, b AS bag_pos FROM r, (SELECT unnest(range(6))::INT AS b) WHERE k < 6 AND b % least(n, 6) = k""")
query("l11_tile_grid", "geometry", lambda t: S.tile_grid(t.geometry, 224).groupBy("slide_id").agg(F.count("*").alias("n")), "SELECT slide_id, (width // 224) * (height // 224)::BIGINT AS n FROM geometry WHERE width >= 224 AND height >= 224")

# ---- profile ----

query("a09_a10_a11_cuts", "patients", lambda t: A.cuts(t.patients.withColumn("v", F.col("c_acctbal").cast("double")), "v", Binning("quantile", 4), ["c_mktsegment"]).select("c_mktsegment", *[F.col("edges")[k].alias(f"e{k}") for k in range(3)], "n"), "SELECT c_mktsegment, quantile_cont(c_acctbal::DOUBLE, 0.25) AS e0, quantile_cont(c_acctbal::DOUBLE, 0.5) AS e1, quantile_cont(c_acctbal::DOUBLE, 0.75) AS e2, count(*) AS n FROM patients GROUP BY c_mktsegment", "e0 e1 e2")
query("a12_field_coverage", "strata multi", lambda t: A.field_coverage(t.strata.select("field", "patient_id").unionByName(t.multi.where("label >= 0").select("field", "patient_id"))), "SELECT field, count(DISTINCT patient_id) AS n_patients FROM (SELECT field, patient_id FROM strata UNION ALL SELECT field, patient_id FROM multi WHERE label >= 0) GROUP BY field")
query("a13_fit_moments", "reg", lambda t: A.fit_moments(t.reg, "label", BY), "SELECT field, outer_fold, avg(label) AS mean, stddev_pop(label) AS std, count(*) AS n FROM reg GROUP BY ALL", "mean std")
query("a14_pos_weight", "preds", lambda t: A.pos_weight(t.preds, BY), "SELECT field, outer_fold, (count(*) FILTER (label = 0)) / (count(*) FILTER (label = 1)) AS pos_weight FROM preds GROUP BY ALL", "pos_weight")
query("a15_class_weights", "multi", lambda t: A.balanced_weights(t.multi, 6, BY).select(*BY, F.col("class").alias("cls"), "n", "weight"), """c AS (SELECT field, outer_fold, k AS cls, count(*) FILTER (label = k) AS n, count(*) AS m FROM multi, (SELECT unnest(range(6))::INT AS k) WHERE label >= 0 GROUP BY ALL)
--
SELECT field, outer_fold, cls, n, CASE WHEN n > 0 THEN m / (6.0 * n) ELSE 1.0 END AS weight FROM c""", "weight")
query("a16_time_bins", "surv", lambda t: A.time_bins(t.surv, 4, BY).select(*BY, *[F.col("edges")[k].alias(f"e{k}") for k in range(3)], "n_events"), "SELECT field, outer_fold, quantile_cont(time, 0.25) FILTER (event = 1) AS e0, quantile_cont(time, 0.5) FILTER (event = 1) AS e1, quantile_cont(time, 0.75) FILTER (event = 1) AS e2, count(*) FILTER (event = 1) AS n_events FROM surv GROUP BY field, outer_fold", "e0 e1 e2")
query("a17_a19_s05_gene_state", "matrix", lambda t: A.gene_state(t.matrix), "SELECT gene_id, avg(ln(1 + value)) AS mean, stddev_pop(ln(1 + value)) AS std, var_pop(ln(1 + value)) AS variance, count(*) AS n FROM matrix GROUP BY gene_id", "mean std variance")
query("a18_matrix_summary", "matrix", lambda t: A.matrix_summary(t.matrix), """g AS (SELECT gene_id, avg(ln(1 + value)) AS m FROM matrix GROUP BY gene_id)
--
SELECT count(*) AS n_genes, avg(m) AS mean_log1p, CAST((SELECT count(DISTINCT patient_id) FROM matrix) AS INT) AS n_patients FROM g""", "mean_log1p")
query("a20_slides_per_patient", "slides", lambda t: A.slides_per_patient(t.slides), """n AS (SELECT count(*) AS n FROM slides GROUP BY patient_id)
--
SELECT avg(n) AS mean, quantile_cont(n, 0.5)::DOUBLE AS median, min(n) AS min, max(n) AS max, max(n) >= 5 * avg(n) AS skewed FROM n""", "mean median")
query("a21_class_counts", "multi", lambda t: A.class_counts(t.multi, "label", BY), """c AS (SELECT field, outer_fold, label, count(*) AS n FROM multi GROUP BY ALL)
--
SELECT *, CASE WHEN label >= 0 THEN 100.0 * n / sum(n) FILTER (label >= 0) OVER (PARTITION BY field, outer_fold) END AS percent FROM c""", "percent")
query("a22_imbalance", "preds", lambda t: A.imbalance(t.preds, "label", BY), """c AS (SELECT field, outer_fold, label, count(*) AS n FROM preds GROUP BY ALL)
--
SELECT field, outer_fold, max(n) / min(n) AS ratio, max(n) >= 3 * min(n) AS imbalanced FROM c GROUP BY field, outer_fold""", "ratio")
query("a23_continuous_summary", "reg", lambda t: A.continuous_summary(t.reg, "label", BY), "SELECT field, outer_fold, count(label) AS n, quantile_cont(label, 0.5) AS median, quantile_cont(label, 0.25) AS q1, quantile_cont(label, 0.75) AS q3, min(label) AS min, max(label) AS max, count(*) - count(label) AS missing FROM reg GROUP BY ALL", "median q1 q3 min max")
query("a24_survival_summary", "surv", lambda t: A.survival_summary(t.surv, BY), "SELECT field, outer_fold, count(*) AS n, count(*) FILTER (event = 1) AS events, count(*) FILTER (event = 0) AS censored, quantile_cont(time, 0.25) AS q1, quantile_cont(time, 0.5) AS q2, quantile_cont(time, 0.75) AS q3, quantile_cont(time, 0.5) FILTER (event = 1) AS median_event_time FROM surv GROUP BY ALL", "q1 q2 q3 median_event_time")
query("a25_a26_fold_balance", "strata", lambda t: A.fold_balance(S.nested_cv(t.strata, 5, 2, 42), t.strata.withColumnRenamed("stratum", "label")), """o AS (SELECT *, (row_number() OVER (ORDER BY stratum, md5(concat_ws('|', '42', patient_id)), patient_id) - 1) % 5 AS test FROM strata)
--
SELECT field, CAST(test AS INT) AS outer_fold, stratum AS label, count(*) AS n FROM o GROUP BY ALL""")
query("a28_a31_s24_tile_distribution", "tiles", lambda t: A.tile_distribution(A.tile_counts(t.tiles)), """n AS (SELECT count(*) AS c FROM tiles GROUP BY slide_id)
--
SELECT count(*) AS n, sum(c)::BIGINT AS total, avg(c) AS mean, min(c) AS min, max(c) AS max, quantile_cont(c, 0.05)::DOUBLE AS p5, quantile_cont(c, 0.25)::DOUBLE AS p25, quantile_cont(c, 0.5)::DOUBLE AS median, quantile_cont(c, 0.75)::DOUBLE AS p75, quantile_cont(c, 0.95)::DOUBLE AS p95, quantile_cont(c, 0.75) / greatest(quantile_cont(c, 0.25), 1) AS spread FROM n""", "mean p5 p25 median p75 p95 spread")
query("a29_padding_cost", "tiles", lambda t: A.padding_cost(A.tile_counts(t.tiles), [2, 4, 8]), """n AS (SELECT count(*) AS c FROM tiles GROUP BY slide_id), x AS (SELECT c, s AS size FROM n, (SELECT unnest([2, 4, 8])::INT AS s))
--
SELECT size, count(*) FILTER (c < size) AS n_padded, avg(CASE WHEN c < size THEN 1.0 ELSE 0.0 END) AS share_padded, avg(size / c) FILTER (c < size) AS mean_copies, sum(least(c, size)) / sum(c) AS coverage FROM x GROUP BY size""", "share_padded mean_copies coverage")
query("a30_recommend_bag", "tiles", lambda t: A.recommend_bag(A.tile_counts(t.tiles), [1, 2, 4, 8]), """n AS (SELECT count(*) AS c FROM tiles GROUP BY slide_id), q AS (SELECT quantile_cont(c, 0.25)::DOUBLE AS p25, quantile_cont(c, 0.75) / greatest(quantile_cont(c, 0.25), 1) AS spread FROM n)
--
SELECT p25, spread, CASE WHEN spread <= 10 THEN coalesce((SELECT max(s) FROM (SELECT unnest([1, 2, 4, 8])::INT AS s) WHERE s <= p25), 1) END AS num_tiles FROM q""", "p25 spread")
query("a33_regression_context", "reg", lambda t: A.regression_context(t.reg, BY), "SELECT field, outer_fold, least(min(label), min(pred)) AS low, greatest(max(label), max(pred)) AS high, quantile_cont(abs(pred - label), 0.5) AS median_abs_error, corr(pred, label) AS pearson, stddev_pop(label) AS label_sd FROM reg GROUP BY ALL", "low high median_abs_error pearson label_sd")
query("w08_retained_share", "tiles", lambda t: A.retained(A.tile_counts(t.tiles)), """n AS (SELECT count(*) AS n_tiles FROM tiles GROUP BY slide_id)
--
SELECT n_tiles, sum(count(*)) OVER (ORDER BY n_tiles DESC) / (SELECT count(*) FROM n) AS retained FROM n GROUP BY n_tiles""", "retained")

# ---- comparison ----

_ARM_AUROC = lambda df, by: M.auroc(df, by).withColumnRenamed("auroc", "metric")
query("c02_c03_j09_j10_compare_arms", "arms", lambda t: P.compare_arms(t.arms, "base", _ARM_AUROC),
    f"""sh AS (SELECT field, patient_id FROM arms GROUP BY ALL HAVING count(DISTINCT arm) = 3), cm AS (SELECT arms.* FROM arms JOIN sh USING (field, patient_id)), {POOLED.format(t="cm")}, {_auroc_ctes("pooled", "arm, field, outer_fold")}, m AS (SELECT arm, field, outer_fold, {_AUROC} AS metric FROM w GROUP BY ALL)
--
SELECT m.field, m.outer_fold, m.arm, m.metric, r.metric AS reference_metric, m.metric - r.metric AS delta FROM m JOIN m r ON r.arm = 'base' AND r.field = m.field AND r.outer_fold = m.outer_fold""", "metric reference_metric delta")
query("c04_arm_coverage", "arms", lambda t: P.arm_coverage(t.arms), """n AS (SELECT field, arm, count(DISTINCT patient_id) AS n_patients FROM arms GROUP BY ALL)
--
SELECT *, max(n_patients) OVER (PARTITION BY field) - n_patients AS gap FROM n""")
_SEEDS = """n AS (SELECT field, count(DISTINCT arm) AS n FROM trials GROUP BY field), pr AS (SELECT field, seed, arm FROM trials GROUP BY ALL HAVING count(DISTINCT rep) = 3),
    ok AS (SELECT pr.field, seed FROM pr JOIN n USING (field) GROUP BY pr.field, seed, n.n HAVING count(*) = n.n),
    tb AS (SELECT field, arm, seed, max(metric) FILTER (rep = 0) AS m0, max(metric) FILTER (rep = 1) AS m1, max(metric) FILTER (rep = 2) AS m2 FROM trials JOIN ok USING (field, seed) GROUP BY ALL),
    re AS (SELECT a.field, a.arm, a.seed, a.m0 - r.m0 AS delta FROM tb a JOIN tb r ON r.arm = (SELECT min(arm) FROM trials) AND r.field = a.field AND r.seed = a.seed WHERE a.arm <> r.arm),
    nu AS (SELECT field, arm, seed, m1 - m2 AS delta FROM tb), mg AS (SELECT field, quantile_cont(abs(delta), 0.95) AS margin, stddev_samp(delta) AS null_sd, count(*) AS n_null FROM nu GROUP BY field)"""


def _reference(t: Frames) -> str:
    return t.trials.agg(F.min("arm")).first()[0]


query("c05_complete_seeds", "trials", lambda t: P.complete_seeds(t.trials), f"{_SEEDS}\n--\nSELECT * FROM ok")
query("c06_j11_u06_deltas", "trials", lambda t: P.real_deltas(t.trials, _reference(t)).withColumn("kind", F.lit("real")).unionByName(P.null_deltas(t.trials).withColumn("kind", F.lit("null"))), f"{_SEEDS}\n--\nSELECT *, 'real' AS kind FROM re UNION ALL SELECT *, 'null' FROM nu", "delta")
query("c07_margin", "trials", lambda t: P.margin(P.null_deltas(t.trials)), f"{_SEEDS}\n--\nSELECT * FROM mg", "margin null_sd")
query("c08_arm_summary", "trials", lambda t: P.summarize_arms(t.trials, _reference(t)), f"""{_SEEDS}, s AS (SELECT re.field, arm, count(*) AS n_seeds, quantile_cont(delta, 0.5) AS median, avg(delta) AS mean, stddev_samp(delta) AS sd, stddev_samp(delta) / sqrt(count(*)) AS sem, quantile_cont(delta, 0.25) AS q1, quantile_cont(delta, 0.75) AS q3,
    avg(CASE WHEN delta > margin THEN 1.0 ELSE 0.0 END) AS share_above, avg(CASE WHEN delta < -margin THEN 1.0 ELSE 0.0 END) AS share_below, margin, stddev_samp(delta) / null_sd AS sd_ratio FROM re JOIN mg USING (field) GROUP BY re.field, arm, margin, null_sd)
--
SELECT s.*, (SELECT avg(CASE WHEN nu.delta < s.median THEN 1.0 ELSE 0.0 END) FROM nu WHERE nu.field = s.field) AS null_percentile FROM s""", "median mean sd sem q1 q3 share_above share_below margin sd_ratio null_percentile")
query("c09_margin_convergence", "trials", lambda t: P.margin_convergence(t.trials, [1, 2, 5, 5, 10]), f"""{_SEEDS}, sr AS (SELECT field, seed, row_number() OVER (PARTITION BY field ORDER BY seed) AS r FROM (SELECT DISTINCT field, seed FROM nu))
--
SELECT nu.field, k, quantile_cont(abs(delta), 0.95) AS margin, count(*) AS n_null FROM nu JOIN sr USING (field, seed), (SELECT unnest([2, 5, 10])::INT AS k) WHERE r <= k GROUP BY nu.field, k""", "margin")
query("c10_c11_trial_tables", "trials", lambda t: P.absolute_metrics(t.trials).join(P.trial_coverage(t.trials), ["field", "arm"]), """c AS (SELECT field, arm, sum(n_declared)::BIGINT AS n_declared, sum(n_test)::BIGINT AS n_scored FROM trials WHERE rep = 0 GROUP BY ALL)
--
SELECT t.field, t.arm, rep, avg(metric) AS mean, stddev_samp(metric) AS sd, count(*) AS n, c.n_declared, n_scored FROM trials t JOIN c ON c.field = t.field AND c.arm = t.arm GROUP BY ALL""", "mean sd")
query("c13_metric_family", "preds", lambda t: P.metric_family(_fold_metrics(t), ["auroc", "average_precision"]), f"""{_FOLDM}
--
SELECT field, outer_fold, unnest(['auroc', 'average_precision']) AS metric, unnest([auroc, average_precision]) AS value FROM au WHERE outer_fold >= 0""", "value")

# ---- inspection ----

query("w01_w02_beats_on_error", "reg", lambda t: I.beats_on_error(t.reg, ["field", "inner_fold"]).select("slide_id", "inner_fold", "abs_error", "beats"), """x AS (SELECT slide_id, inner_fold, abs(pred - label) AS e FROM reg)
--
SELECT slide_id, inner_fold, e AS abs_error, (count(*) OVER w - row_number() OVER (PARTITION BY inner_fold ORDER BY e, slide_id)) / greatest(count(*) OVER w - 1, 1) AS beats FROM x WINDOW w AS (PARTITION BY inner_fold)""", "abs_error beats")
query("w03_out_risks", "surv slides", lambda t: I.out_risks(t.slides.select("slide_id", "patient_id").join(t.surv.select("field", "patient_id", "risk"), "patient_id")).select("slide_id", "out_risks"), """p AS (SELECT patient_id, (row_number() OVER (ORDER BY risk, patient_id) - 1) / greatest(count(*) OVER () - 1, 1) AS out_risks FROM surv WHERE patient_id IN (SELECT patient_id FROM slides))
--
SELECT slide_id, out_risks FROM slides JOIN p USING (patient_id)""", "out_risks")
query("w05_j16_attention_weights", "attention", lambda t: I.attention_weights(I.attach_coordinates(t.attention.drop("x", "y"), t.tiles)).select("inner_fold", "slide_id", "tile_idx", "x", "y", "weight"), "SELECT inner_fold, slide_id, tile_idx, x, y, exp(logit) / sum(exp(logit)) OVER (PARTITION BY inner_fold, slide_id) AS weight FROM attention", "weight")
query("w06_attention_ensemble", "attention", lambda t: I.attention_ensemble(t.attention), """w AS (SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY inner_fold, slide_id) AS weight FROM attention)
--
SELECT slide_id, tile_idx, first(x) AS x, first(y) AS y, ln(avg(weight)) AS logit FROM w GROUP BY slide_id, tile_idx""", "logit")
query("w07_w12_rank_agreement", "attention preds", lambda t: I.run_records(t.preds, t.attention), """r AS (SELECT *, row_number() OVER (PARTITION BY slide_id, inner_fold ORDER BY logit, tile_idx) AS k FROM attention),
    a AS (SELECT a.slide_id, CASE WHEN count(*) >= 2 THEN corr(a.k, b.k) END AS agreement FROM r a JOIN r b ON a.slide_id = b.slide_id AND a.tile_idx = b.tile_idx AND a.inner_fold = 0 AND b.inner_fold = 1 GROUP BY a.slide_id)
--
SELECT p.slide_id, avg(prob) AS prob, first(label) AS label, count(*) AS n_models, first(agreement) AS agreement FROM preds p LEFT JOIN a ON a.slide_id = p.slide_id GROUP BY p.slide_id""", "prob agreement")
_CURVES = """q AS (SELECT *, list_transform(logits, lambda x: 1 - 1 / (1 + exp(-x))) AS q FROM bins), cv AS (SELECT slide_id, outer_fold, inner_fold, unnest(time_edges) AS t, unnest([q[1], q[1] * q[2], q[1] * q[2] * q[3]]) AS s, q[1] * q[2] * q[3] * q[4] AS tail FROM q)"""
query("w09_survival_curves", "bins", lambda t: I.survival_curves(t.bins, ["slide_id", "inner_fold"]), f"{_CURVES}\n--\nSELECT slide_id, inner_fold, t, s, tail FROM cv", "t s tail")
query("w10_j15_u07_curve_ensemble", "bins", lambda t: I.curve_ensemble(I.survival_curves(t.bins, ["slide_id", "outer_fold", "inner_fold"])), f"""{_CURVES}, g AS (SELECT DISTINCT slide_id, t FROM cv), m AS (SELECT DISTINCT slide_id, inner_fold FROM cv),
    x AS (SELECT g.slide_id, g.t, m.inner_fold, coalesce(arg_max(cv.s, cv.t), 1.0) AS s FROM g JOIN m USING (slide_id) LEFT JOIN cv ON cv.slide_id = g.slide_id AND cv.inner_fold = m.inner_fold AND cv.t <= g.t GROUP BY ALL)
--
SELECT slide_id, t, avg(s) AS s, count(*) AS n_models FROM x GROUP BY slide_id, t""", "t s")
query("a34_survival_context", "surv slides", lambda t: I.survival_context(t.slides.select("slide_id", "patient_id").join(t.surv, "patient_id")), "SELECT field, count(*) AS n_patients, sum(event)::BIGINT AS n_events, quantile_cont(time, 0.5) AS median_follow_up FROM surv WHERE patient_id IN (SELECT patient_id FROM slides) GROUP BY field", "median_follow_up")
query("w11_walk", "slides", lambda t: I.walk(t.slides, "patient_id"), "SELECT patient_id, slide_id, lag(slide_id) OVER w AS previous, lead(slide_id) OVER w AS next, row_number() OVER w AS place, count(*) OVER (PARTITION BY patient_id) AS of FROM slides WINDOW w AS (PARTITION BY patient_id ORDER BY slide_id)")

# ---- joins, panels, sinks, heads without an iterative fit ----

query("j01_j08_j19_labels_to_tiles", "tiles slides strata", lambda t: t.tiles.select("slide_id", "tile_idx").join(t.slides.select("slide_id", "patient_id"), "slide_id").join(t.strata.select("patient_id", F.col("stratum").alias("label")), "patient_id"), "SELECT patient_id, slide_id, tile_idx, stratum AS label FROM tiles JOIN slides USING (slide_id) JOIN strata USING (patient_id)")
query("t01_t03_hvg_panel", "matrix", lambda t: G.hvg_panel(t.matrix, 10).withColumn("pos", F.col("pos").cast("long")), """v AS (SELECT gene_id, var_pop(ln(1 + value)) AS variance FROM matrix GROUP BY gene_id)
--
SELECT row_number() OVER (ORDER BY variance DESC, gene_id) - 1 AS pos, gene_id, variance FROM v QUALIFY row_number() OVER (ORDER BY variance DESC, gene_id) <= 10""", "variance")
query("j06_j07_s06_resolve_panel", "matrix", lambda t: G.resolve_panel(t.part.select(F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("gene_id")), t.matrix)[0], "SELECT p_partkey AS pos, CAST(p_partkey AS VARCHAR) AS gene_id FROM part WHERE CAST(p_partkey AS VARCHAR) IN (SELECT gene_id FROM matrix)")
query("s07_u01_u02_gene_sets", "matrix", lambda t: G.union_of_sets(sheets.parse_gmt(t.nation.select(F.concat_ws("\t", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.lit("set"), "n_name", F.concat(F.lit("g"), (F.col("n_nationkey") % 7).cast("string"))).alias("value"))).join(t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("set_name"), F.col("r_regionkey").alias("set_pos")), "set_name"), ["r0", "r2"]),
    """s AS (SELECT n_regionkey AS set_pos, unnest([n_name, 'g' || (n_nationkey % 7)]) AS symbol, unnest([0, 1])::INT AS pos FROM nation WHERE n_regionkey IN (0, 2))
--
SELECT symbol, min(struct_pack(a := set_pos, b := pos)).a AS set_pos, min(struct_pack(a := set_pos, b := pos)).b AS pos FROM s GROUP BY symbol""")
query("s14_readable_predictions", "multi", lambda t: sinks.readable_predictions(t.multi, "multiclass", 5).select("slide_id", "patient_id", "label", "pred", *[F.round(F.col(f"prob_{k}").cast("double"), 2).alias(f"p{k}") for k in range(5)]).groupBy("slide_id", "patient_id", "label").agg(F.sum("pred").alias("preds"), F.count("*").alias("n"), F.every(F.abs(F.col("p0") + F.col("p1") + F.col("p2") + F.col("p3") + F.col("p4") - 1) < 0.03).alias("whole")), "SELECT slide_id, patient_id, label, CAST(sum(list_position(probs, list_max(probs)) - 1) AS BIGINT) AS preds, count(*) AS n, true AS whole FROM multi GROUP BY ALL")
query("s17_s30_scalar_patients", "preds", lambda t: sinks.scalar_patients(R.slides_to_patients(t.preds, ["outer_fold"]), R.slides_to_patients(t.preds)), "SELECT patient_id, 'o' || outer_fold AS model, avg(prob) AS prediction, first(label) AS label FROM preds GROUP BY patient_id, outer_fold UNION ALL SELECT patient_id, 'grand', avg(prob), first(label) FROM preds GROUP BY patient_id", "prediction")
query("s11_s26_discover_folds", "preds", lambda t: sheets.discover_folds(t.preds, sinks.run_metadata(t.preds.where("outer_fold <> 3"), 5, 3, "x")).groupBy("outer_fold", "inner_fold").agg(F.count("*").alias("n")), "SELECT outer_fold, inner_fold, count(*) AS n FROM preds WHERE outer_fold <> 3 GROUP BY ALL")
query("s29_upsert_masks", "geometry", lambda t: sinks.upsert_masks(t.geometry.where("slide_id % 3 = 0").select(F.col("slide_id").cast("string").alias("image_path"), "mask_path"), t.geometry.where("slide_id % 2 = 0").select(F.col("slide_id").cast("string").alias("image_path"), F.lit("new").alias("mask_path"))), "SELECT CAST(slide_id AS VARCHAR) AS image_path, CASE WHEN slide_id % 3 = 0 THEN mask_path ELSE 'new' END AS mask_path FROM geometry WHERE slide_id % 3 = 0 OR slide_id % 2 = 0")
query("s28_sheets", "slides geometry", lambda t: sinks.sheets(t.slides.join(t.geometry, "slide_id"), ["o_orderpriority"])["masks"], "SELECT image_path, mask_path FROM slides JOIN geometry USING (slide_id) WHERE mask_path IS NOT NULL")
