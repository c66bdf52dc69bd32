"""The forest's metrics, predictions, importances and folds, against each other and other fits (ML-3..11)."""
import numpy as np
import pytest

from movegrid.operators import model
from movegrid.plans import feature_queries as fq

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return sorted(tuple(r) for r in fq.q_model_forest_scored(spark, SF).collect())


def test_report_agrees_with_the_predictions(spark, scored):
    rows = fq.q_model_forest_report(spark, SF).collect()
    metric = {r.name: r.value for r in rows if r.section == "metric"}
    weight = [(r.name, r.value) for r in rows if r.section == "importance"]
    y, p, e = (np.array([r[i] for r in scored]) for i in (2, 3, 4))
    assert np.allclose(e, y - p) and metric["test_samples"] == len(scored) > 100
    assert metric["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()), rel=1e-9) and metric["mae"] == pytest.approx(np.abs(e).mean(), rel=1e-9)
    assert metric["r2"] == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    assert [n for n, _ in weight] == [n for n, _ in sorted(weight, key=lambda x: (-x[1], x[0]))] and sorted(n for n, _ in weight) == sorted(fq.MODEL_FEATURES)
    assert sum(v for _, v in weight) == pytest.approx(1) and weight[0][0] == "distance" and min(v for _, v in weight) >= 0


def test_forest_beats_the_mean_and_its_trees_stay_in_range(spark, scored):
    rows = fq.model_rows(spark, SF).collect()
    labels = [r.speed for r in rows]
    y, p = (np.array([r[i] for r in scored]) for i in (2, 3))
    assert min(labels) <= p.min() and p.max() <= max(labels)                    # a leaf predicts a mean of labels
    assert np.corrcoef(y, p)[0, 1] > 0.4 and ((y - p) ** 2).mean() < y.var()


def test_folds_are_held_out_and_agree_with_the_report(spark, scored):
    folds = fq.q_model_forest_folds(spark, SF).orderBy("fold").collect()
    n = fq.model_rows(spark, SF).count()
    assert [r.fold for r in folds] == [0, 1, 2, 3, 4] and sum(r.n for r in folds) == n - len(scored) and max(r.n for r in folds) - min(r.n for r in folds) <= 1
    y, e = (np.array([r[i] for r in scored]) for i in (2, 4))
    assert all(0 <= r.mae <= r.rmse for r in folds)
    assert np.mean([r.r2 for r in folds]) == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=0.35)


def test_concurrent_folds_equal_folds_one_by_one(spark, monkeypatch):
    tm = model.train(fq.model_rows(spark, "/root/testdata/sf0.001"), "linear", features=["distance", "Latitude"])
    many = sorted(map(tuple, model.cross_validate(tm, 4).collect()))
    monkeypatch.setattr(model, "FITS", 1)
    one = sorted(map(tuple, model.cross_validate(tm, 4).collect()))
    assert np.allclose(many, one, rtol=1e-9)


def test_feature_rows_are_gathered_by_their_number(spark):
    df = spark.range(1000).repartition(40)
    assert model.gathered(df, 1000).rdd.getNumPartitions() == 1
    assert model.gathered(df, 7 * model.TASK_ROWS - 1).rdd.getNumPartitions() == 7
