"""Writers: manifest, predictions, records, reports and state. Folders are replaced only when complete."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserine.functions import labels as L
from tesserine.sources import commits


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one serves a local master; on a
    cluster other machines couldn't read it, so that is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tesserine-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_manifest(spark: SparkSession, tables: dict[str, DataFrame], root: str, after: int | None = None) -> int:
    """All manifest tables under one root, committed together; see commits.replace."""

    def write(staged: str) -> None:
        for name, df in tables.items():
            df.write.parquet(f"{staged}/{name}")

    return commits.replace(spark, root, write, after)


def write_predictions(preds: DataFrame, path: str) -> None:
    """Fold predictions by field, outer and inner fold, lossless."""
    preds.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("field", "outer_fold", "inner_fold").parquet(path)


def readable_predictions(preds: DataFrame, objective: str, width: int = 1, edges: Sequence[float] = ()) -> DataFrame:
    """Predictions to four decimals with one column a class, hazard and survival interval."""
    f4 = lambda c: F.format_number(c, 4)
    keys = ["slide_id", "patient_id", "label"]
    if objective == "binary":
        return preds.select(*keys, f4(F.col("prob")).alias("prob"), (F.col("prob") >= 0.5).cast("int").alias("pred"))
    if objective == "multiclass":
        return preds.select(*keys, L.argmax("probs").alias("pred"), *[f4(F.col("probs")[k]).alias(f"prob_{k}") for k in range(width)])
    if objective == "regression":
        return preds.select(*keys, f4(F.col("pred")).alias("pred"), f4(F.col("pred") - F.col("label")).alias("error"))
    rows = preds.withColumn("_h", L.hazards("logits")).withColumn("_s", L.survival(F.col("_h")))
    names = ["-".join((str(int(a)), str(int(b)))) for a, b in zip([0, *edges], edges, strict=False)] + [f"{int(edges[-1])}+"]
    each = [f4(F.col(c)[k]).alias(f"{what}_{n}") for c, what in (("_h", "hazard"), ("_s", "survival")) for k, n in enumerate(names)]
    return rows.select("slide_id", "patient_id", "time", "event", f4(L.survival_risk("logits")).alias("risk"), *each)


def scalar_patients(per_outer: DataFrame, grand: DataFrame, value: str = "prob") -> DataFrame:
    """Long (patient_id, model, prediction, label) of the outer ensembles and the grand one."""
    a = per_outer.select("patient_id", F.concat(F.lit("o"), F.col("outer_fold").cast("string")).alias("model"), F.col(value).alias("prediction"), "label")
    return a.unionByName(grand.select("patient_id", F.lit("grand").alias("model"), F.col(value).alias("prediction"), "label"))


def per_fold_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Fold metrics of all endpoints; blank where an endpoint doesn't report a metric."""
    out = None
    for df in tables.values():
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def export_splits(split: DataFrame) -> DataFrame:
    """(patient_id, split_version, category) by version, then patient."""
    return split.select("patient_id", "split_version", "category").orderBy("split_version", "patient_id")


def write_sheets(rows: DataFrame, root: str, labels: Sequence[str]) -> None:
    """Patients, slides and masks sheets from gathered rows."""
    for name, df in sheets(rows, labels).items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{root}/{name}")


def sheets(rows: DataFrame, labels: Sequence[str]) -> dict[str, DataFrame]:
    return {
        "patients": rows.select("patient_id", *labels).distinct(),
        "slides": rows.select("patient_id", "image_path"),
        "masks": rows.where(F.col("mask_path").isNotNull()).select("image_path", "mask_path"),
    }


def upsert_masks(old: DataFrame, new: DataFrame) -> DataFrame:
    """The mask map with new masks merged in; existing rows stay."""
    n = new.select("image_path", F.col("mask_path").alias("_new"))
    return old.join(n, "image_path", "full_outer").select("image_path", F.coalesce("mask_path", "_new").alias("mask_path"))


def append_trial(trial: DataFrame, path: str) -> int:
    """Trial rows appended by one commit: whole or absent, also beside other writers (S10); commits.read reads them."""
    return commits.append(trial.coalesce(1), path)


def write_record(record: DataFrame, path: str) -> None:
    """The pooled out-of-fold record (S15), external ensembles (S16), attention (S23) or a cohort's predictions."""
    record.write.mode("overwrite").parquet(path)


def write_state(state: DataFrame, path: str) -> None:
    """Fold state by stream and field."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("field", "stream").parquet(path)


def read_state(spark: SparkSession, path: str, stream: str, field: str) -> DataFrame:
    """(outer_fold, inner_fold, gene_id, pos, mean, std) of one stream and field; none is an error."""
    rows = spark.read.parquet(path).where((F.col("stream") == stream) & (F.col("field") == field))
    if not rows.take(1):
        raise ValueError(f"no state of {stream}/{field} in {path}")
    return rows


def read_target_stats(spark: SparkSession, path: str, exists: Callable[[str], bool]) -> DataFrame | None:
    """Fold-invariant target statistics; absent is none, unreadable an error."""
    return spark.read.parquet(path) if exists(path) else None


def run_metadata(preds: DataFrame, n_outer: int, n_inner: int, git_sha: str) -> DataFrame:
    """A row a fold: grid, coverage and provenance, to be written last."""
    per = preds.groupBy("field", "outer_fold", "inner_fold").agg(F.count_distinct("patient_id").alias("n_patients"), F.count("*").alias("n_slides"))
    return per.select("*", F.lit(n_outer).alias("n_outer"), F.lit(n_inner).alias("n_inner"), F.lit(git_sha).alias("git_sha"))
