"""Validation in one scan, model records, full risk records of the boosted model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskframe.operators import models as ML
from riskframe.operators import quality as QL
from riskframe.operators import risk as RK
from riskframe.operators import treeshap as TS
from riskframe.sources import files as FS


def test_validation_counts_from_distinct_rows(spark):
    rows = [(1.0, 0, "a"), (1.0, 0, "a"), (None, 1, "b"), (float("nan"), 2, None), (1.0, None, "a"), (1.0, 0, "a")]
    df = spark.createDataFrame(rows, "Amount double, Class int, note string").repartition(3)
    got = QL.validation_counts(df).first().asDict()
    assert got == {"n_rows": 6, "duplicate_rows": 2, "n_missing__Amount": 2, "n_missing__Class": 1, "n_missing__note": 1,
                   "n_unexpected": 1, "n_fraud": 3}
    report = {r.check: r for r in QL.validation_report(df, min_rows=3).collect()}
    assert report["duplicate_rows"].observed == 2 and report["target_binary"].severity == "error"
    assert report["min_rows"].severity == "info" and "non_numeric_column" in report
    none = QL.validation_counts(df.limit(0)).first().asDict()
    assert set(none.values()) == {0}
    assert QL.validation_report(df.drop("Class")).where("check = 'target_binary' AND severity = 'error'").count() == 1


def test_validation_scans_once(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_tax", (F.col("l_returnflag") == "R").cast("int").alias("Class"))
    plan = QL.validation_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


@pytest.fixture(scope="module")
def boosted(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.5, 800)) > 0.6).astype(int)
    df = spark.createDataFrame([(i, *map(float, a), int(c)) for i, (a, c) in enumerate(zip(x, y))], "id long, V1 double, V2 double, V3 double, Class int")
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["V1", "V2", "V3"], outputCol="features"),
                            GBTClassifier(labelCol="Class", maxIter=12, maxDepth=3, seed=1)])
    return df, ML.TrainedModel("gradient_boosting", pipe.fit(df), ["V1", "V2", "V3"], 1.0)


def test_boosted_attributions_add_up_and_records_are_whole(spark, boosted):
    df, tm = boosted
    trees = TS.load_trees(spark, tm.model, "regressor")
    ex = TS.explain_rows(df, trees, tm.features, "id", average=False).join(df.drop("Class"), "id")
    scored = ML.score(tm, df, "id", ("Class",))
    out = {r.id: r for r in ML.full_record(RK.assess(scored), ex, tm.features).collect()}
    phis = {r.id: r for r in ex.collect()}
    assert len(out) == 800
    for i, r in out.items():
        e = phis[i]
        assert e.additivity_error < 1e-9
        assert abs(1 / (1 + np.exp(-2 * e.output)) - r.p) < 1e-9  # the margin is the model's
        phi = {f: e[f"phi_{f}"] for f in tm.features}
        up = sorted((f for f in phi if phi[f] > 0), key=lambda f: (-phi[f], f))
        down = sorted((f for f in phi if phi[f] < 0), key=lambda f: (phi[f], f))
        assert [x.feature for x in r.top_contributing_factors] == up and [x.feature for x in r.mitigating_factors] == down
        assert r.top_driver == (up[0] if up else None)
        assert abs(r.base_value + sum(phi.values()) - r.margin_value) < 1e-5
        assert r.description and r.legitimacy_disclaimer and r.summary_text.startswith("Key drivers: ")
        for group in (r.top_contributing_factors, r.mitigating_factors):
            assert not group or abs(sum(x.relative_impact for x in group) - 1) < 1e-3


def test_models_beyond_the_node_limit_are_refused(spark, boosted, monkeypatch):
    monkeypatch.setattr(TS, "MAX_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        TS.load_trees(spark, boosted[1].model, "regressor")


def test_model_record_round_trip(spark, boosted, tmp_path):
    df, tm = boosted
    FS.save_model_record(spark, str(tmp_path), tm.name, tm.model, 0.25, 0.875, 1.5, tm.features)
    model, record = FS.load_model_record(spark, str(tmp_path), tm.name)
    r = record.first()
    assert (r.model_name, r.threshold, r.composite_score, r.fit_seconds, r.features) == (tm.name, 0.25, 0.875, 1.5, tm.features)
    assert r.saved_at is not None
    again = ML.score(ML.TrainedModel(tm.name, model, tm.features, 0.0), df)
    assert again.exceptAll(ML.score(tm, df)).count() == 0
