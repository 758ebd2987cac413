"""One call that reports an endpoint of any objective: what each objective predicts, counts, measures and adds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.functions import metrics as M
from tesserine.operators import checks, rollup
from tesserine.operators.ordered import with_pooled

BY = ("field", "outer_fold")


@dataclass(frozen=True)
class Endpoint:
    """An objective: its prediction column and its label's shape (D2, D5), its metrics (D1), its handlers (D3) and hook."""

    objective: str
    value: str  # column of the prediction
    shape: str  # of a label: "scalar", "survival" (time and event) or "vector" (a row a gene)
    metrics: Callable[[DataFrame, Sequence[str]], DataFrame]
    names: tuple[str, ...]  # of the metrics; the first is the primary one
    positive: Callable[[], Column] | None = None  # which patients count as positive
    extra: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    @property
    def primary(self) -> str:
        return self.names[0]

    def scored(self, preds: DataFrame) -> DataFrame:
        """The rows that have a label and a prediction."""
        missing = F.col("time").isNull() | F.col("event").isNull() if self.shape == "survival" else checks.is_missing(F.col("label"), "regression" if self.shape == "vector" else self.objective)
        return preds.where(~missing & F.col(self.value).isNotNull())

    def counts(self, patients: DataFrame, by: Sequence[str] = BY) -> DataFrame:
        """Patients and, where the objective has any, positives."""
        n = [F.count_distinct("patient_id").alias("n_patients")]
        if self.positive is not None:
            n.append(F.count_if(self.positive()).alias("n_positive"))
        return patients.groupBy(*by).agg(*n)


def _pool(preds: DataFrame, e: Endpoint, keys: Sequence[str]) -> DataFrame:
    """Mean prediction by keys, with what a patient's label holds."""
    if e.shape == "survival":
        return preds.groupBy(*keys).agg(F.avg(e.value).alias(e.value), F.first("time").alias("time"), F.first("event").alias("event"))
    if e.shape == "vector":
        return preds.groupBy(*keys, "gene_id").agg(F.avg(e.value).alias(e.value), F.first("label").alias("label"))
    if preds.schema[e.value].dataType.typeName() == "array":
        labels = preds.groupBy(*keys).agg(F.first("label").alias("label"))
        return rollup.vector_mean(preds, keys, e.value).join(labels, list(keys))
    return preds.groupBy(*keys).agg(F.avg(e.value).alias(e.value), F.first("label").alias("label"))


def out_of_fold(preds: DataFrame, e: Endpoint) -> DataFrame:
    """Slides to patients within a replicate, replicates to one record a patient of each outer fold."""
    per = _pool(e.scored(preds), e, [*BY, "inner_fold", "patient_id"])
    return _pool(per, e, [*BY, "patient_id"])


def aggregate(preds: DataFrame, e: Endpoint) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(report, what the hook adds): a row a fold, mean, sd and the pooled row, with the metrics of the objective."""
    record = out_of_fold(preds, e)
    rows = with_pooled(record)
    table = rollup.report(e.metrics(rows, BY).select(*BY, *e.names), e.names)
    counts = e.counts(rows)
    return table.join(counts, [*BY], "left"), {name: f(record) for name, f in e.extra.items()}


def external(preds: DataFrame, e: Endpoint) -> DataFrame:
    """Metrics of the grand ensemble and of every outer fold's on a cohort that no fold was fitted on (D3)."""
    per = _pool(e.scored(preds), e, [*BY, "inner_fold", "patient_id"])
    models = per.withColumn("model", F.explode(F.array(F.lit("grand"), F.concat(F.lit("o"), F.col("outer_fold").cast("string")))))
    record = _pool(models, e, ["field", "model", "patient_id"])
    return e.metrics(record, ("field", "model")).select("field", "model", *e.names)


def _gene_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return M.gene_pearson(df, [*by, "gene_id"]).groupBy(*by).agg(F.avg("pearson").alias("mean_gene_pearson"), F.count("pearson").alias("n_scored"))


#: Endpoint of each objective; a study may add its own.
ENDPOINTS = {
    "binary": Endpoint("binary", "prob", "scalar", M.binary_metrics, ("auroc", "average_precision", "accuracy", "balanced_accuracy"), lambda: F.col("label") == 1),
    "multiclass": Endpoint("multiclass", "probs", "scalar", M.multiclass_metrics, ("macro_auroc", "accuracy", "quadratic_kappa")),
    "regression": Endpoint(
        "regression", "pred", "scalar", M.regression_metrics, ("r2", "mae", "rmse", "pearson", "spearman"),
        extra={"range": lambda r: r.groupBy("field").agg(F.min("label").alias("low"), F.max("label").alias("high"))},
    ),
    "survival": Endpoint(
        "survival", "risk", "survival", M.concordance, ("c_index",), lambda: F.col("event") == 1,
        extra={"curve_by_risk": lambda r: M.km_by_risk(r, ["field"])},
    ),
    "regression_vector": Endpoint(
        "regression_vector", "pred", "vector", _gene_metrics, ("mean_gene_pearson", "n_scored"),
        extra={"genes": lambda r: rollup.per_gene_table(M.gene_pearson(r, ["gene_id"]))},
    ),
}


def endpoint(objective: str) -> Endpoint:
    """The endpoint of an objective; an unknown one is refused."""
    if objective not in ENDPOINTS:
        raise ValueError(f"unknown objective {objective!r}; known: {', '.join(ENDPOINTS)}")
    return ENDPOINTS[objective]


def slide_metrics(preds: DataFrame, objective: str, by: Sequence[str] = (*BY, "inner_fold")) -> DataFrame:
    """The objective's metrics over slides, as a fold's run shows them."""
    e = endpoint(objective)
    rows = e.scored(preds)
    if objective == "regression":
        return M.regression_metrics(rows, by, tie="slide_id").select(*by, *e.names)
    return e.metrics(rows, by).select(*by, *e.names)
