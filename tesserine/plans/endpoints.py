"""Registered queries of single operators that the larger reports don't show: look-ups, readable outputs, coverage, refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.functions import metrics as M
from tesserine.operators import checks as C
from tesserine.operators import fit
from tesserine.operators import inspect as I
from tesserine.operators import ordered, rollup
from tesserine.plans.fixtures import Frames
from tesserine.plans.registry import _fisher, query
from tesserine.sources import sinks

query("p09_reader", "", lambda t: t.orders.select("o_orderkey", L.reader_or(F.when(F.col("o_orderkey") % 3 == 0, F.lower("o_orderpriority")).when(F.col("o_orderkey") % 3 == 1, F.lit(" nan ")), "DEFAULT").alias("reader")),
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN upper(o_orderpriority) ELSE 'DEFAULT' END AS reader FROM orders")

query("m16_significant_gene_count", "genes", lambda t: M.significant_genes(M.gene_pearson(t.genes.select("gene_id", F.col("base").alias("pred"), "label", (F.col("gene_id").cast("int") % 2).alias("half")), ["half", "gene_id"]), ["half"]),
    f"""g AS (SELECT CAST(gene_id AS INT) % 2 AS half, gene_id, count(*) AS n, corr(base, label) AS r FROM genes GROUP BY ALL), pv AS (SELECT *, {_fisher("r", "n")} AS p_value FROM g),
    k AS (SELECT *, row_number() OVER (PARTITION BY half ORDER BY p_value, gene_id) AS rank, count(*) OVER (PARTITION BY half) AS m FROM pv)
--
SELECT half, coalesce(max(CASE WHEN p_value <= 0.05 * rank / m THEN rank END), 0)::INT AS n_significant FROM k GROUP BY half""")


def _survival_at(t: Frames) -> DataFrame:
    times = t.bins.select("slide_id", "inner_fold").withColumn("t", F.explode(F.array(*[F.lit(v) for v in (50.0, 105.0, 300.0, 999.0)])))
    return I.survival_at(I.survival_curves(t.bins, ["slide_id", "inner_fold"]), times, ["slide_id", "inner_fold"])


query("j15_survival_look_up", "bins", _survival_at, """c AS (SELECT slide_id, inner_fold, time_edges, list_transform(logits, lambda x: 1 - 1 / (1 + exp(-x))) AS q FROM bins),
    a AS (SELECT *, unnest([50.0, 105.0, 300.0, 999.0])::DOUBLE AS t FROM c)
--
SELECT slide_id, inner_fold, t, CASE WHEN t < time_edges[1] THEN 1 WHEN t < time_edges[2] THEN q[1] WHEN t < time_edges[3] THEN q[1] * q[2] ELSE q[1] * q[2] * q[3] END AS s FROM a""", "s")


def _events_as_of(t: Frames) -> DataFrame:
    """Each event with the last earlier or equal purchase of its user: a group may be any user's whole history."""
    e = t.events.select("event_id", "user_id", "event_type", F.col("ts").alias("at"))
    bought = e.where("event_type = 'purchase'").select("user_id", "at", F.col("event_id").alias("bought"))
    return ordered.as_of(e.select("event_id", "user_id", "at"), bought, ["user_id"], "at", ["bought"]).select("event_id", "bought")


query("j15_as_of_events", "", _events_as_of, """e AS (SELECT event_id, user_id, event_type, ts FROM events),
    x AS (SELECT e.event_id, b.event_id AS bought, row_number() OVER (PARTITION BY e.event_id ORDER BY b.ts DESC NULLS LAST, b.event_id DESC) AS k FROM e LEFT JOIN e AS b ON b.event_type = 'purchase' AND b.user_id = e.user_id AND b.ts <= e.ts)
--
SELECT event_id, bought FROM x WHERE k = 1""")


def _readable_binary(t: Frames) -> DataFrame:
    """The formatted score of each prediction beside the score that it stands for."""
    named = t.preds.withColumn("slide_id", F.concat_ws("/", "slide_id", "inner_fold"))
    shown = sinks.readable_predictions(named, "binary").select("slide_id", "pred", F.col("prob").cast("double").alias("shown"))
    near = F.abs(F.col("shown") - F.col("prob")) <= 0.00005001
    return named.join(shown, "slide_id").select(F.split("slide_id", "/")[0].cast("long").alias("slide_id"), "inner_fold", "label", "pred", near.alias("right"))


query("s14_readable_binary", "preds", _readable_binary, "SELECT slide_id, inner_fold, label, (prob >= 0.5)::INT AS pred, true AS right FROM preds")
query("s14_readable_regression", "reg", lambda t: sinks.readable_predictions(t.reg, "regression").select("slide_id", "label", F.regexp_replace("pred", ",", "").cast("double").alias("shown"), F.regexp_replace("error", ",", "").cast("double").alias("error")).groupBy("slide_id").agg(F.count("*").alias("n"), F.every(F.abs(F.col("shown") - F.col("label") - F.col("error")) < 0.0002).alias("right")),
    "SELECT slide_id, count(*) AS n, true AS right FROM reg GROUP BY slide_id")
query("s14_readable_survival", "bins", lambda t: sinks.readable_predictions(t.bins.withColumn("label", F.lit(0)), "survival", edges=(100.0, 300.0, 600.0)).groupBy("slide_id").agg(F.count("*").alias("n"), F.every((F.col("hazard_0-100").cast("double") + F.col("survival_0-100").cast("double")).between(0.9998, 1.0002)).alias("right")),
    "SELECT slide_id, count(*) AS n, true AS right FROM bins GROUP BY slide_id")


def _external_record(t: Frames) -> DataFrame:
    """The grand and the outer ensembles, written and read back."""
    path = sinks.fresh(t.spark, "external")
    sinks.write_record(rollup.external_ensembles(rollup.slides_to_patients(t.preds, ["field", "outer_fold", "inner_fold"])), path)
    return t.spark.read.parquet(path)


query("s16_external_record", "preds", _external_record, """rp AS (SELECT field, outer_fold, inner_fold, patient_id, avg(prob) AS prob FROM preds GROUP BY ALL)
--
SELECT field, model, patient_id, avg(prob) AS prob, count(*) AS n_models FROM (SELECT *, unnest(['grand', 'o' || outer_fold]) AS model FROM rp) GROUP BY ALL""", "prob")

query("f28_other_panels", "preds", lambda t: C.other_panels(t.preds.withColumn("panel", F.when((F.col("outer_fold") == 1) & (F.col("inner_fold") == 0), None).when(F.col("outer_fold") == 2, "hvg_50").otherwise("hvg_100")), "hvg_100"),
    "SELECT DISTINCT field, outer_fold, inner_fold, CASE WHEN outer_fold = 2 THEN 'hvg_50' END AS panel FROM preds WHERE outer_fold = 2 OR (outer_fold = 1 AND inner_fold = 0)")
query("f29_refused_inputs", "matrix", lambda t: C.missing_inputs(t.matrix.withColumn("z", F.when(F.col("pos") % 9 == 0, None).when(F.col("pos") % 11 == 0, float("nan")).otherwise(F.col("value"))), "z").select("patient_id", "gene_id"),
    "SELECT patient_id, gene_id FROM matrix WHERE pos % 9 = 0 OR pos % 11 = 0")


def _coverage(t: Frames) -> DataFrame:
    """Patients that two modalities can vouch for; a third can't tell and asks for nothing."""
    known = {
        "rna": fit.Modality(lambda least: t.matrix, lambda least: t.matrix.where(F.col("value") >= least).select("patient_id").distinct()),
        "label": fit.Modality(lambda: t.labels, lambda: t.labels.select(F.col("doc_id").cast("string").alias("patient_id"))),
        "image": fit.Modality(lambda: t.embeddings),
    }
    return fit.covered_patients(t.patients.select("patient_id"), {"rna": {"least": 2.0}, "label": {}, "image": {}}, known)


query("d04_modality_coverage", "patients matrix", _coverage, "SELECT DISTINCT patient_id FROM patients WHERE patient_id IN (SELECT patient_id FROM matrix WHERE value >= 2) AND patient_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)")
