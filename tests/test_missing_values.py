"""Rows without an entity, class or score are neither lost nor made up."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators import queue as Q
from riskframe.operators import risk as RK
from riskframe.operators import split as SP
from riskframe.operators import tradeoff as TO
from riskframe.operators import velocity as VE
from riskframe.operators.quantiles import exact_quantiles
from riskframe.sources.files import read_jsonl
from riskframe.streaming import queries as SQ


def events(spark, rows):
    return spark.createDataFrame(rows, "id long, entity string, ts long, Amount double").withColumn("ts", F.timestamp_seconds("ts"))


def test_velocity_keeps_null_entities_and_resubmitted_ids(spark):
    df = events(spark, [(1, "a", 100, 1.0), (2, None, 110, 2.0), (3, None, 120, 3.0), (4, "a", 130, 4.0), (4, "a", 500, 5.0)])
    out = {(r.id, r.Amount): (r.w_count, r.w_sum) for r in VE.sliding_features(df, windows={"w": 60}).collect()}
    assert out == {(1, 1.0): (1, 1.0), (2, 2.0): (1, 2.0), (3, 3.0): (2, 5.0), (4, 4.0): (2, 5.0), (4, 5.0): (1, 5.0)}
    gaps = {(r.id, r.Amount): r.seconds_since_prev for r in VE.previous_event(df).collect()}
    assert gaps == {(1, 1.0): None, (2, 2.0): None, (3, 3.0): 10.0, (4, 4.0): 30.0, (4, 5.0): 370.0}


def test_split_refuses_rows_without_class(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 20 != 0, (F.col("id") % 3 == 0).cast("int")).alias("Class"))
    with pytest.raises(ValueError, match="no class"):
        SP.stratified_split(df)


def test_assessment_without_probability(spark):
    df = spark.createDataFrame([(1, None), (2, math.nan), (3, 0.9), (4, -1.0)], "id long, p double")
    out = {r.id: r for r in RK.assess(df).collect()}
    for i in (1, 2):
        assert [out[i][c] for c in ("probability", "risk_score", "risk_category", "decision", "is_flagged", "status_label", "description")] == [None] * 7
    assert out[3].decision == "REVIEW" and out[4].risk_score == 0


def test_metrics_leave_missing_scores_out(spark):
    rows = [(i, i % 3 == 0, i / 100) for i in range(100)]
    clean = spark.createDataFrame([(i, int(y), p) for i, y, p in rows], "id long, y int, p double")
    more = clean.union(spark.createDataFrame([(200 + i, i % 2, None if i % 3 else math.nan) for i in range(50)], "id long, y int, p double"))
    a, b = (M.metrics_report(x, threshold=0.5).first().asDict() for x in (clean, more))
    assert a == b and a["n_samples"] == 100


def test_dollars_are_exact(spark):
    df = spark.createDataFrame([(1, 0.004)] * 500, "y int, Amount double")
    assert TO.cost_assumptions(df).first().total_fraud_dollars == 2.0


def test_queue_fills_missing_priorities_by_row(spark):
    df = spark.createDataFrame([(1, 95, 1200.0, True, 7, "P9"), (2, 95, 1200.0, True, None, None)],
                               "id long, risk_score int, Amount double, is_flagged boolean, priority_score int, priority_tier string")
    out = {r.id: r for r in Q.queue_view(df).collect()}
    assert out[1].priority_score == 7 and out[1].priority_tier == "P9"
    assert out[2].priority_score >= 350 and out[2].priority_tier.startswith("P1")


def test_grouped_quantiles_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(None if g == 2 else f"g{g}", float(v)) for g in range(3) for v in np.round(rng.exponential(5, 400 + g), 1)]
    rows += [("g0", None), ("g1", math.nan), ("one", 4.0)]
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", probs, ["g"]).collect()}
    for g in {r[0] for r in rows}:
        v = [x for k, x in rows if k == g and x is not None and x == x]
        for q in probs:
            assert got[g, q] == pytest.approx(np.quantile(v, q), abs=1e-12)


def test_json_lines_keep_malformed_ones_aside(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "q.jsonl").write_text('{"id": 1}\n\n{"id": \n{"id": 2}\n')
    good, bad = read_jsonl(spark, str(tmp_path / "q.jsonl"), T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r.id for r in good.collect()) == [1, 2] and [r[0] for r in bad.collect()] == ['{"id": ']


def test_stream_of_a_directory_table(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = str(tmp_path / "events.parquet")
    src.repartition(3).write.parquet(path)
    out = SQ.run_available(spark, SQ.record_stream(SQ.event_stream(spark, path)), "test-dir")
    assert out.count() == src.count()
