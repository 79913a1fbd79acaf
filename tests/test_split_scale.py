"""Exact stratified splits, train-only scaling and weights."""

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import split as SP


def test_golden_split_sizes():
    q = SP.split_quotas({0: 283253, 1: 473}, 0.2, 0.2)
    assert sum(v[0] for v in q.values()) == 170235
    assert sum(v[1] for v in q.values()) == 56745
    assert sum(v[2] for v in q.values()) == 56746
    assert q[1] == (284, 94, 95)


def _fixture(spark, n=10000, pos_rate=0.2, seed=42):
    rng = np.random.default_rng(seed)
    y = (rng.uniform(size=n) < pos_rate).astype(int)
    amt = rng.exponential(88, n)
    t = rng.uniform(0, 172792, n)
    return spark.createDataFrame([(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(t, amt, y))],
                                 "id long, Time double, Amount double, Class int")


def test_split_exact_disjoint_and_stratified(spark):
    df = _fixture(spark)
    counts = SP.class_counts(df, "Class")
    q = SP.split_quotas(counts, 0.2, 0.2)
    sp = SP.stratified_split(df)
    got = {(r["split"], r["Class"]): r["count"] for r in sp.groupBy("split", "Class").count().collect()}
    for c, (a, b, t) in q.items():
        assert got.get(("train", c), 0) == a and got.get(("validation", c), 0) == b and got.get(("test", c), 0) == t
    assert sp.count() == df.count() and sp.select("id").distinct().count() == df.count()
    assert SP.leakage(sp).count() == 0


def test_split_deterministic(spark):
    df = _fixture(spark, n=2000)
    a = SP.stratified_split(df).select("id", "split")
    b = SP.stratified_split(df).select("id", "split")
    assert a.exceptAll(b).count() == 0


def test_scaler_train_only_invariants(spark):
    df = _fixture(spark)
    sp = SP.stratified_split(df)
    m = SP.fit_scaler(sp.filter(F.col("split") == "train"), ["Amount", "Time"], "Class")
    tr = m.transform(sp.filter(F.col("split") == "train"))
    st = tr.agg(F.avg("Amount"), F.stddev_pop("Amount"), F.avg("Time"), F.stddev_pop("Time")).first()
    assert abs(st[0]) < 1e-10 and abs(st[1] - 1) < 1e-10 and abs(st[2]) < 1e-10 and abs(st[3] - 1) < 1e-10
    again = SP.ScalerModel.from_json(m.to_json())
    assert again.stats == m.stats


def test_constant_column_std_one(spark):
    df = spark.createDataFrame([(1, 5.0, 0), (2, 5.0, 1)], "id long, Amount double, Class int")
    m = SP.fit_scaler(df, ["Amount"], "Class")
    assert m.stats["Amount"] == (5.0, 1.0)


def test_batch_equals_row_transform(spark):
    df = _fixture(spark, n=500)
    m = SP.fit_scaler(df, ["Amount", "Time"], "Class")
    full = {r["id"]: (r["Amount"], r["Time"]) for r in m.transform(df).collect()}
    for i in (0, 7, 99, 250, 499):
        one = m.transform(df.filter(F.col("id") == i)).first()
        assert abs(one["Amount"] - full[i][0]) < 1e-10 and abs(one["Time"] - full[i][1]) < 1e-10


def test_balanced_and_positive_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(100)], "id long, Class int")
    w = {r["Class"]: r["weight"] for r in SP.balanced_weights(df).select("Class", "weight").distinct().collect()}
    assert abs(w[1] - 100 / 20) < 1e-12 and abs(w[0] - 100 / 180) < 1e-12
    assert SP.positive_scale(df).first()["scale_pos_weight"] == 9.0
    none = spark.createDataFrame([(1, 0)], "id long, Class int")
    assert SP.positive_scale(none).first()["scale_pos_weight"] == 1.0


def test_stratified_sample_sizes(spark):
    df = _fixture(spark, n=5000, pos_rate=0.05)
    s = SP.stratified_sample(df, 1000)
    n_pos = s.filter("Class = 1").count()
    total_pos = df.filter("Class = 1").count()
    assert s.count() == 1000 and n_pos == max(1, int(1000 * total_pos / 5000))


def test_preflight_rules():
    import pytest
    SP.preflight({0: 100, 1: 10})
    with pytest.raises(ValueError):
        SP.preflight({0: 100})
    with pytest.raises(ValueError):
        SP.preflight({0: 100, 1: 9})
    with pytest.raises(ValueError):
        SP.preflight({0: 1, 1: 20, 2: 3})
