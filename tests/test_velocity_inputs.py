"""Velocity features vs brute force (hot entity), payload validation, text hygiene."""

import datetime as dt

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.functions import columns as C
from riskframe.operators import features as FE
from riskframe.operators import queue as Q
from riskframe.operators import velocity as VE


def _events(spark, n=3000, seed=9):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2024, 1, 1)
    ents = np.where(rng.uniform(size=n) < 0.4, 0, rng.integers(1, 20, n))  # entity 0 is hot
    secs = np.sort(rng.integers(0, 3 * 86400, n))
    secs[5] = secs[4]  # peers at the same instant
    rows = [(int(i), int(e), base + dt.timedelta(seconds=int(s)), float(round(rng.exponential(50), 2)))
            for i, (e, s) in enumerate(zip(ents, secs))]
    return spark.createDataFrame(rows, "id long, entity long, ts timestamp_ntz, Amount double")


def test_sliding_stats_equal_range_window(spark):
    df = _events(spark)
    win = {"w5m": 300, "w1h": 3600}
    got = VE.sliding_features(df, windows=win)
    m = F.unix_micros(F.col("ts").cast("timestamp"))
    ref = df
    for n, s in win.items():
        w = Window.partitionBy("entity").orderBy(m).rangeBetween(-s * 1_000_000, 0)
        ref = ref.withColumn(f"r_{n}_c", F.count(F.lit(1)).over(w)).withColumn(
            f"r_{n}_s", F.sum(F.col("Amount").cast("decimal(18,2)")).over(w).cast("double"))
    j = got.join(ref.drop("entity", "ts", "Amount"), "id")
    bad = j.filter((F.col("w5m_count") != F.col("r_w5m_c")) | (F.col("w1h_count") != F.col("r_w1h_c"))
                   | (F.abs(F.col("w1h_sum") - F.col("r_w1h_s")) > 1e-9))
    assert j.count() == 3000 and bad.count() == 0


def _frames_of(rows, seconds):
    """(count, exact sum, mean and deviation without the row itself) by brute force."""
    from fractions import Fraction
    out = {}
    for i, e, t, a in rows:
        own = [(j, Fraction(str(b or 0))) for j, f, u, b in rows
               if f == e and (u is None and t is None or u is not None and t is not None and t - dt.timedelta(seconds=seconds) <= u <= t)]
        rest = [b for j, b in own if j != i]
        mean = sum(rest) / len(rest) if rest else None
        std = float(sum((b - mean) ** 2 for b in rest) / len(rest)) ** 0.5 if rest else None
        out[i] = (len(own), float(sum(b for _, b in own)), None if mean is None else float(mean), std)
    return out


def _near(x, y, tolerance):
    return (x is None) == (y is None) and (x is None or abs(x - y) <= tolerance * max(1.0, abs(y)))


def test_both_ways_of_sliding_stats_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(500):
        e = [None, "hot", "hot", "x", ""][rng.integers(0, 5)]
        t = None if rng.uniform() < 0.03 else base + dt.timedelta(seconds=int(rng.integers(0, 40)) * 300, microseconds=int(rng.integers(0, 2)))
        rows.append((i, e, t, None if rng.uniform() < 0.1 else float(round(rng.normal(0, 100), 2))))
    df = spark.createDataFrame(rows, "id long, entity string, ts timestamp_ntz, Amount double").repartition(5)
    windows = {"a": 600, "b": 3600, "c": 7200}
    want = {n: _frames_of(rows, s) for n, s in windows.items()}
    for hot_rows in (None, 20):  # 20: "hot" has more in a block, and goes the other way
        got = VE.sliding_stats(df, "entity", "ts", "id", "Amount", windows, moments=True, hot_rows=hot_rows).collect()
        assert len(got) == len(rows)
        for r in got:
            if hot_rows and r.ts is None:
                continue  # rows without a time: only the block way makes them peers
            for n in windows:
                count, total, mean, std = want[n][r.id]
                assert r[f"{n}_count"] == count and float(r[f"{n}_sum"]) == total
                assert _near(r[f"{n}_mean"], mean, 1e-9) and _near(r[f"{n}_std"], std, 1e-6)


def test_velocity_ratio_is_stable_for_large_amounts(spark):
    base = dt.datetime(2024, 1, 1)
    noise = [0.0, 0.5, 0.25, 0.75, 0.5, 0.0, 1.0, 0.25]
    rows = [(i, 7, base + dt.timedelta(hours=i), 1e9 + x) for i, x in enumerate(noise)]
    rows += [(100 + i, 8, base + dt.timedelta(hours=i), 1e12) for i in range(5)]  # no spread at all
    df = spark.createDataFrame(rows, "id long, entity long, ts timestamp_ntz, Amount double")
    for hot in (VE.HOT_ROWS, 2):
        before, VE.HOT_ROWS = VE.HOT_ROWS, hot
        try:
            out = {r.id: r for r in VE.velocity_ratio(df).collect()}
        finally:
            VE.HOT_ROWS = before
        for i in range(1, len(noise)):
            past = np.array(noise[:i])
            assert abs(out[i].history_mean - 1e9 - past.mean()) < 1e-6 and abs(out[i].history_std - past.std()) < 1e-9
        assert all(out[100 + i].history_std == 0 and out[100 + i].velocity_ratio == 0 for i in range(1, 5))
        assert out[0].history_std is None and out[0].velocity_ratio is None


def test_sliding_stats_shuffle_two_rows_an_event(spark):
    df = _events(spark, 200)
    out = VE.sliding_features(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and plan.count("Generate explode") == 1
    assert "MapInArrow" in plan


def test_groups_across_batches_stay_whole():
    import pyarrow as pa
    keys = [None, None, 1, 1, 1, 2, 3, 3, 3, 3, 4]
    b = pa.record_batch([pa.array(keys), pa.array(range(len(keys)))], names=["k", "v"])
    for size in range(1, 12):
        parts = list(VE.whole_groups((b.slice(i, size) for i in range(0, len(keys), size)), ("k",)))
        assert [x for t in parts for x in t["v"].to_pylist()] == list(range(len(keys)))
        groups = [(k, t["_g"][i].as_py(), n) for n, t in enumerate(parts) for i, k in enumerate(t["k"].to_pylist())]
        assert len({(g, n) for _, g, n in groups}) == 5 and len(set(groups)) == 5


def test_previous_event_gap(spark):
    df = _events(spark, n=500)
    got = {r["id"]: r["seconds_since_prev"] for r in VE.previous_event(df).collect()}
    m = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("entity").orderBy(m, "id")
    ref = df.withColumn("g", (m - F.lag(m).over(w)) / 1e6).collect()
    for r in ref:
        assert (got[r["id"]] is None and r["g"] is None) or abs(got[r["id"]] - r["g"]) < 1e-9


def test_travel_speed_fixture(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, 7, base, 52.52, 13.40), (2, 7, base + dt.timedelta(hours=1), 48.85, 2.35),
            (3, 7, base + dt.timedelta(hours=10), 48.86, 2.35)]
    df = spark.createDataFrame(rows, "id long, card long, ts timestamp_ntz, lat double, lon double")
    out = {r["id"]: r for r in VE.travel_speed(df, "card", "ts", "id", "lat", "lon").collect()}
    assert out[1]["kmh_from_prev"] is None or out[1]["km_from_prev"] is None
    assert 850 < out[2]["km_from_prev"] < 900 and out[2]["impossible_travel"] is False
    assert out[3]["kmh_from_prev"] < 1 and out[3]["impossible_travel"] is False


def test_payload_validation_reasons(spark):
    rows = [("1", None, None, "text"), ("2", "-50", None, None), ("3", "NaN", None, None),
            ("4", "100", None, "Infinity"), ("5", "100", "abc", None), ("6", "999999999", None, None),
            ("7", "12.5", None, None), ("8", None, "5", None)]
    df = spark.createDataFrame(rows, "k string, amount string, time string, v14 string")
    out = {r["k"]: r for r in FE.validate_rows(df, {"Amount": "amount", "Time": "time", "V14": "v14"}).collect()}
    assert out["1"]["reject_reason"] == "Missing required field: 'Amount'."
    assert "non-negative" in out["2"]["reject_reason"]
    assert "finite" in out["3"]["reject_reason"]
    assert "V14" in out["4"]["reject_reason"]
    assert "Time" in out["5"]["reject_reason"]
    assert "cap" in out["6"]["reject_reason"]
    assert out["7"]["reject_reason"] is None and out["7"]["clean_Time"] == 0.0 and out["7"]["clean_V14"] == 0.0
    assert out["8"]["reject_reason"].startswith("Missing required field")


def test_notes_escaped_and_status_whitelist(spark):
    rows = [(1, 1, " escalated_tier_2 ", "<script>alert('x') & \"y\"</script>"), (1, 2, "bogus", "later"),
            (2, 1, None, "x" * 1500)]
    acts = spark.createDataFrame(rows, "queue_id long, action_seq long, status_raw string, notes_raw string")
    c = {(r["queue_id"], r["action_seq"]): r for r in Q.clean_actions(acts).collect()}
    assert c[(1, 1)]["notes"] == "&lt;script&gt;alert(&#x27;x&#x27;) &amp; &quot;y&quot;&lt;/script&gt;"
    assert c[(1, 1)]["status"] == "ESCALATED_TIER_2" and c[(1, 1)]["status_valid"]
    assert not c[(1, 2)]["status_valid"]
    assert c[(2, 1)]["status"] == "CONFIRMED_FRAUD" and len(c[(2, 1)]["notes"]) == 1000


def test_triage_latest_wins_and_unknown_rejected(spark):
    queue = spark.createDataFrame([(1, "PENDING_REVIEW"), (2, "PENDING_REVIEW")], "id long, status string")
    acts = spark.createDataFrame([(1, 1, "escalated_tier_2", "a"), (1, 2, "confirmed_fraud", ""),
                                  (9, 1, "confirmed_fraud", "b")],
                                 "queue_id long, action_seq long, status_raw string, notes_raw string")
    state, rejected = Q.apply_actions(queue, acts)
    s = {r["id"]: r for r in state.collect()}
    assert s[1]["status"] == "CONFIRMED_FRAUD" and s[1]["analyst_notes"] == "a" and s[2]["status"] == "PENDING_REVIEW"
    assert [r["queue_id"] for r in rejected.collect()] == [9]


def test_feature_expressions(spark):
    df = spark.createDataFrame([(100.0, -10.0), (90000.0, None), (21600.0, 0.0)], "Time double, Amount double")
    out = FE.engineer(df).collect()
    assert out[0]["log_amount"] == 0.0 and out[1]["log_amount"] == 0.0
    assert abs(out[1]["hour_of_day"] - 1.0) < 1e-12 and out[1]["is_night"] == 1
    assert out[2]["is_night"] == 0
    dup = spark.createDataFrame([(1.0, 2.0)] * 3, "Time double, Amount double")
    assert FE.engineer(dup).count() == 3 and FE.engineer(dup, drop_duplicates=True).count() == 1
    assert C is not None
