"""Reports of endpoints of any objective, and the errors that the readers and reports owe their callers."""

import pytest

from tesserine.operators import report as E
from tesserine.sources import sinks


def test_report_has_a_row_for_each_fold_and_its_summaries(spark):
    rows = [("f", o, i, f"p{o}_{k}", 0.1 + 0.8 * (k % 2) - 0.01 * i, k % 2) for o in range(2) for i in range(2) for k in range(6)]
    rows.append(("f", 0, 0, "lost", 0.5, -1))
    preds = spark.createDataFrame(rows, "field string, outer_fold int, inner_fold int, patient_id string, prob double, label int")
    table, extra = E.aggregate(preds, E.endpoint("binary"))
    got = {(x.row_kind, x.outer_fold): x for x in table.collect()}
    assert set(got) == {("fold", 0), ("fold", 1), ("pooled", -1), ("mean", None), ("sd", None)} and extra == {}
    assert got[("pooled", -1)].n_patients == 12 and got[("fold", 1)].n_positive == 3 and got[("mean", None)].auroc == 1.0


def test_hooks_and_vectors(spark):
    rows = [("f", 0, 0, f"p{k}", g, k + 0.1 * g, float(k)) for k in range(8) for g in range(3)]
    preds = spark.createDataFrame(rows, "field string, outer_fold int, inner_fold int, patient_id string, gene_id int, pred double, label double")
    table, extra = E.aggregate(preds, E.endpoint("regression_vector"))
    assert table.where("row_kind = 'pooled'").first().mean_gene_pearson == pytest.approx(1.0)
    assert {x.gene_id for x in extra["genes"].collect()} == {0, 1, 2}
    with pytest.raises(ValueError, match="unknown objective"):
        E.endpoint("none")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        sinks.shared_dir(Session())
