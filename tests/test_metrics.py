"""Metric formulas, golden confusion matrices, curves and kernels vs brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe import params as P
from riskframe.operators import metrics as M
from riskframe.operators import tradeoff as TO
from riskframe.operators.ordered import running_sums

GOLDEN = [  # tp, fp, tn, fn, precision, recall, f1, f2
    (81, 8, 56643, 13, 0.910112, 0.861702, 0.885246, 0.870968),
    (75, 6, 56645, 20, 0.925926, 0.789474, 0.852273, 0.813449),
]


@pytest.mark.parametrize("tp,fp,tn,fn,prec,rec,f1,f2", GOLDEN)
def test_golden_rates(spark, tp, fp, tn, fn, prec, rec, f1, f2):
    df = spark.createDataFrame([(tp, fp, tn, fn)], "tp long, fp long, tn long, fn long")
    r = M.with_rates(df).first()
    assert round(r["precision"], 6) == prec and round(r["recall"], 6) == rec
    assert round(r["f1_score"], 6) == f1 and round(r["f2_score"], 6) == f2


def test_golden_composite(spark):
    df = spark.createDataFrame([(0.870968, 0.881100, 0.973432, 0.885246)],
                               "f2_score double, pr_auc double, roc_auc double, f1_score double")
    assert round(df.select(M.composite()).first()[0], 4) == round(0.896642, 4)


def test_zero_division(spark):
    df = spark.createDataFrame([(0, 0, 10, 0)], "tp long, fp long, tn long, fn long")
    r = M.with_rates(df).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f2_score"] == 0.0


def _brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _brute_ap(y, p):
    order = np.unique(p)[::-1]
    P_ = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in order:
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        r = tp / P_
        ap += (r - prev_r) * tp / pred.sum()
        prev_r = r
    return ap


def test_auc_and_ap_vs_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 3000)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # heavy ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    r = M.auc_scores(df, n_buckets=16).first()
    assert abs(r["roc_auc"] - _brute_auc(y, p)) < 1e-12
    assert abs(r["pr_auc"] - _brute_ap(y, p)) < 1e-12


def test_one_class_auc_is_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    assert M.auc_scores(df).first()["roc_auc"] == 0.0


def test_running_sums_equals_single_window(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v), int(i)) for i, (g, v) in enumerate(zip(rng.integers(0, 3, 2000), rng.normal(size=2000)))]
    df = spark.createDataFrame(rows, "g int, v double, k int")
    got = running_sums(df, ["v", "k"], {"s": "k"}, partition_cols=["g"], n_buckets=7)
    w = Window.partitionBy("g").orderBy("v", "k").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("k").over(w))
    j = got.join(ref, ["g", "v", "k"])
    assert j.count() == 2000 and j.filter(F.col("cum_s") != F.col("ref")).count() == 0


def test_threshold_search_lowest_tie(spark):
    # all scores equal -> every grid threshold below it ties; the lowest wins
    df = spark.createDataFrame([(1, 0.99), (0, 0.99)], "y int, p double")
    assert abs(M.threshold_search(df).first()["threshold"] - 0.05) < 1e-12


def test_threshold_search_vs_loop(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 1500)
    p = np.clip(rng.normal(0.3 + 0.3 * y, 0.25), 0, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    best, best_t = -1.0, 0.5
    for t in P.ThresholdSearch().grid():
        pred = p >= t
        tp = (pred & (y == 1)).sum(); fp = (pred & (y == 0)).sum(); fn = (~pred & (y == 1)).sum()
        s = 5 * tp / (5 * tp + 4 * fn + fp) if (5 * tp + 4 * fn + fp) else 0.0
        if s > best:
            best, best_t = s, t
    assert abs(M.threshold_search(df).first()["threshold"] - best_t) < 1e-12


def test_tradeoff_fp_monotone_and_custom_grid(spark):
    rng = np.random.default_rng(5)
    rows = [(int(a), float(b), float(c)) for a, b, c in
            zip(rng.integers(0, 2, 800), rng.uniform(0, 1, 800), rng.exponential(88, 800))]
    df = spark.createDataFrame(rows, "y int, p double, Amount double")
    cv = TO.tradeoff_curve(df).orderBy("threshold").collect()
    fps = [r["fp"] for r in cv]
    assert all(a >= b for a, b in zip(fps, fps[1:]))
    assert len(cv) == 19
    custom = TO.tradeoff_curve(df, P.CostParams(grid=(0.9, 0.1, 0.5, 0.3))).collect()
    assert len(custom) == 4 and [r["threshold"] for r in sorted(custom, key=lambda r: r["grid_index"])] == [0.1, 0.3, 0.5, 0.9]


def test_precision_is_one_without_alerts(spark):
    df = spark.createDataFrame([(1, 0.001, 10.0), (0, 0.002, 5.0)], "y int, p double, Amount double")
    top = TO.tradeoff_curve(df).filter(F.col("threshold") == 0.95).first()
    assert top["precision"] == 100.0 and top["tp"] == 0 and top["fp"] == 0


def test_downsample_positions(spark):
    n = 101
    df = spark.range(n).select(F.col("id").alias("point_no"))
    kept = sorted(r[0] for r in M.downsample_curve(df, "point_no", 30).collect())
    expected = sorted(set(int(x) for x in np.linspace(0, n - 1, 30)))
    assert kept == expected


def test_running_sums_many_buckets_and_descending(spark):
    rng = np.random.default_rng(12)
    vals = np.round(rng.normal(size=4000), 4)
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "v double, k int")
    for desc in (False, True):
        got = running_sums(df, ["v", "k"], {"s": F.lit(1).cast("bigint")}, descending=desc, n_buckets=700)
        order = [F.col("v").desc(), F.col("k").desc()] if desc else [F.col("v"), F.col("k")]
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        ref = df.withColumn("ref", F.sum(F.lit(1)).over(w))
        j = got.join(ref, ["v", "k"])
        assert j.count() == 4000 and j.filter(F.col("cum_s") != F.col("ref")).count() == 0
