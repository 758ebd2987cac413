"""Registered queries of fold models and streams: iterative or stateful, so without a DuckDB statement unless SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserine.functions import metrics as M
from tesserine.operators import compare, fit, rollup, splits, train
from tesserine.plans.fixtures import Frames
from tesserine.plans.registry import ORACLES, QUERIES, _rounded, query
from tesserine.sources import sinks
from tesserine.streaming import jobs


def _items(t: Frames) -> DataFrame:
    """Embeddings as slides: their vector, and whether their label is even."""
    e = t.embeddings
    return e.select(F.col("vec_id").alias("slide_id"), F.col("vec_id").cast("string").alias("patient_id"), F.transform("embedding", lambda v: v.cast("double")).alias("features"), F.col("label").alias("kind"), (F.col("label") % 2).cast("int").alias("label"))


def _folds(items: DataFrame, n_outer: int) -> DataFrame:
    return splits.nested_cv(items.select(F.lit("kind").alias("field"), "patient_id", F.col("label").alias("stratum")), n_outer, 2, 42)


_FOLDS = [(o, i) for o in range(2) for i in range(2)]


def x03_x10_t07_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidates on each of four folds; the better by validation loss predicts test."""
    items = _items(Frames(spark, sf_dir))
    recipes = {"weak": fit.Recipe("binary", reg=1.0), "strong": fit.Recipe("binary", reg=0.01, class_weight="balanced")}
    preds, _, _ = train.sweep(items.drop("kind"), _folds(items, 2), recipes, _FOLDS)
    return _rounded(preds)


def x04_regression_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(Frames(spark, sf_dir)).withColumn("label", F.col("kind").cast("double"))
    score = fit.fit_regression(items.where(F.col("slide_id") % 3 != 0), fit.Recipe("regression"))
    return _rounded(M.regression_metrics(score(items.where(F.col("slide_id") % 3 == 0)), []))


def x05_survival_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(Frames(spark, sf_dir)).withColumn("time", F.col("kind") * 10.0 + F.col("slide_id") % 7).withColumn("event", (F.col("slide_id") % 3 != 0).cast("int"))
    score = fit.fit_survival(items.where(F.col("slide_id") % 2 == 0), fit.Recipe("survival"))
    return _rounded(score(items.where(F.col("slide_id") % 2 == 1)).select("slide_id", "risk", "time", "event"))


def x07_gene_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Frames(spark, sf_dir)
    items = _items(t).select("patient_id", "features")
    score = fit.fit_genes(items.where(F.col("patient_id").cast("int") % 2 == 0).join(t.matrix.select("patient_id", "gene_id", "value"), "patient_id"), fit.Recipe("regression_vector"))
    return _rounded(score(items.where(F.col("patient_id").cast("int") % 2 == 1)))


def x11_x13_x14_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cohort scored by all development folds, then its ensembles."""
    items = _items(Frames(spark, sf_dir))
    dev, ext = items.where(F.col("slide_id") % 2 == 0), items.where(F.col("slide_id") % 2 == 1)
    _, _, heads = train.sweep(dev.drop("kind"), _folds(dev, 2), {"one": fit.Recipe("binary")}, _FOLDS)
    scored = train.score_with_all(heads, ext.drop("kind")).withColumn("field", F.lit("kind"))
    return _rounded(rollup.external_ensembles(rollup.slides_to_patients(scored, ["field", "outer_fold", "inner_fold"])))


def x12_resplit_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(Frames(spark, sf_dir)).drop("kind")
    patients = items.select("patient_id", F.col("label").alias("stratum"))
    return _rounded(train.run_trials(items, patients, fit.Recipe("binary"), "base", "kind", (1, 2), (0, 1, 2), "none"))


def x12_c06_c07_margin_of_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The margin that resplit trials of two arms give: what differs between reps of a seed by training alone."""
    items = _items(Frames(spark, sf_dir)).drop("kind")
    patients = items.select("patient_id", F.col("label").alias("stratum"))
    trials = None
    for arm, recipe in (("base", fit.Recipe("binary")), ("strict", fit.Recipe("binary", reg=0.3))):
        one = train.run_trials(items, patients, recipe, arm, "kind", (1, 2, 3), (0, 1, 2), "none", how=train.Descent(epochs=4))
        trials = one if trials is None else trials.unionByName(one)
    path = sinks.fresh(spark, "trials")
    trials.write.parquet(path)
    trials = spark.read.parquet(path)
    real = compare.real_deltas(trials, "base").groupBy("field").agg(F.avg("delta").alias("mean_delta"))
    return _rounded(compare.margin(compare.null_deltas(trials)).join(real, "field"))


for f in (x03_x10_t07_sweep, x04_regression_head, x05_survival_head, x07_gene_heads, x11_x13_x14_external, x12_resplit_trials, x12_c06_c07_margin_of_trials):
    QUERIES[f.__name__] = f

query("x01_mean_pool", "", lambda t: fit.mean_pool(t.embeddings.select((F.col("vec_id") % 50).alias("slide_id"), F.transform("embedding", lambda v: v.cast("double")).alias("features"))).select("slide_id", F.col("features")[0].alias("first"), F.col("features")[63].alias("last")),
    "x AS (SELECT vec_id % 50 AS slide_id, embedding[1]::DOUBLE AS a, embedding[64]::DOUBLE AS b FROM embeddings)\n--\nSELECT slide_id, avg(a) AS first, avg(b) AS last FROM x GROUP BY slide_id", "first last")
query("x02_weighted_pool", "", lambda t: fit.weighted_pool(t.embeddings.select((F.col("vec_id") % 50).alias("slide_id"), F.col("vec_id").alias("tile_idx"), (F.col("label") / 3.0).alias("logit"), F.transform("embedding", lambda v: v.cast("double")).alias("features"))).select("slide_id", F.col("features")[0].alias("first"), F.col("features")[63].alias("last")),
    "x AS (SELECT vec_id % 50 AS slide_id, exp(label / 3.0) AS w, embedding[1]::DOUBLE AS a, embedding[64]::DOUBLE AS b FROM embeddings)\n--\nSELECT slide_id, sum(w * a) / sum(w) AS first, sum(w * b) / sum(w) AS last FROM x GROUP BY slide_id", "first last")
query("x05_d09_person_period", "follow", lambda t: fit.person_period(t.follow.where("time > 0"), [30.0, 60.0, 90.0]).groupBy("bin").agg(F.count("*").alias("n"), F.sum("hit").alias("hits")),
    "x AS (SELECT event, (time > 30)::INT + (time > 60)::INT + (time > 90)::INT AS lb FROM follow WHERE time > 0)\n--\nSELECT b AS bin, count(*) AS n, sum(CASE WHEN b = lb THEN event ELSE 0 END)::BIGINT AS hits FROM x, (SELECT unnest(range(4))::INT AS b) WHERE b <= lb GROUP BY b")
query("x06_losses", "preds bins", lambda t: fit.losses(t.preds.withColumn("logit", F.log(F.col("prob") / (1 - F.col("prob")))), ["field", "outer_fold"], "binary", {0: 1.0, 1: 2.0}).unionByName(fit.losses(t.bins.withColumn("field", F.lit("os")), ["field", "outer_fold"], "survival")),
    """h AS (SELECT *, list_transform(logits, lambda x: least(greatest(1 / (1 + exp(-x)), 1e-7), 1 - 1e-7)) AS h, len(list_filter(time_edges, lambda e: e < time)) AS b FROM bins),
    s AS (SELECT outer_fold, -(CASE WHEN b > 0 THEN ln(1 - h[1]) ELSE 0 END + CASE WHEN b > 1 THEN ln(1 - h[2]) ELSE 0 END + CASE WHEN b > 2 THEN ln(1 - h[3]) ELSE 0 END) - CASE WHEN event = 1 THEN ln(h[b + 1]) ELSE ln(1 - h[b + 1]) END AS l FROM h)
--
SELECT field, outer_fold, avg(CASE WHEN label = 1 THEN -2 * ln(prob) ELSE -ln(1 - prob) END) AS loss FROM preds GROUP BY ALL UNION ALL SELECT 'os', outer_fold, avg(l) FROM s GROUP BY outer_fold""", "loss")


# ---- streams, drained over what is there; each gives its batch twin's rows ----


def _shared(spark: SparkSession) -> str:
    return sinks.fresh(spark, "stream")


def _drained(spark: SparkSession, source: DataFrame, make, mode: str = "complete") -> DataFrame:
    root = _shared(spark)
    source.write.parquet(f"{root}/in")
    stream = jobs.tile_stream(spark, f"{root}/in", source.schema)
    out: dict[int, str] = {}

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/{number}")
        out[number] = f"{root}/out/{number}"

    make(stream).writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out[max(out)])


def r01_stream_tile_pooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_drained(spark, Frames(spark, sf_dir).tiles, jobs.running_slides))


def r02_stream_gene_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(jobs.pearson_of_sums(_drained(spark, Frames(spark, sf_dir).genes.select("gene_id", "patient_id", "pred", "label"), jobs.gene_sums)))


def r03_stream_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = Frames(spark, sf_dir).trials
    root = _shared(spark)
    trials.unionByName(trials).write.parquet(f"{root}/in")
    reference = trials.agg(F.min("arm")).first()[0]
    q = jobs.margin_on_arrival(jobs.tile_stream(spark, f"{root}/in", trials.schema), f"{root}/store", reference, lambda df, n: df.write.mode("overwrite").parquet(f"{root}/summary"), f"{root}/state")
    q.awaitTermination()
    return _rounded(spark.read.parquet(f"{root}/summary"))


for f, twin in ((r01_stream_tile_pooling, "a07_tiles_to_slides"), (r02_stream_gene_pearson, None), (r03_stream_trials, "c08_arm_summary")):
    QUERIES[f.__name__] = f
    if twin:
        ORACLES[f.__name__] = ORACLES[twin]
ORACLES["r02_stream_gene_pearson"] = ORACLES["m13_m14_gene_correlations"].replace("SELECT * REPLACE (round(pearson, 6) + 0.0 AS pearson, round(rmse, 6) + 0.0 AS rmse, round(spearman, 6) + 0.0 AS spearman) FROM answer", "SELECT gene_id, n, round(pearson, 6) + 0.0 AS pearson FROM answer")
