"""Boundary tables for scores, categories, decisions and priorities."""

import pytest
from pyspark.sql import functions as F

from riskframe import params as P
from riskframe.functions import columns as C
from riskframe.operators import queue as Q
from riskframe.operators import risk as RK


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_score_rounding(spark):
    cases = [(-10.5, 0), (-0.0001, 0), (0.0, 0), (0.004, 0), (0.005, 1), (0.914, 91), (0.916, 92),
             (1.0, 100), (1.0001, 100), (5.0, 100), (0.305, 31), (0.285, 28)]
    got = _one(spark, [(p,) for p, _ in cases], "p double", C.risk_score("p"))
    assert got == [s for _, s in cases]


def test_score_rejects_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.5,)], "p double")
    ok, bad = RK.quarantine_probability(df)
    assert ok.count() == 1 and bad.count() == 2


@pytest.mark.parametrize("policy,cases", [
    (P.RiskPolicy(), [(0, "LOW RISK"), (30, "LOW RISK"), (31, "MEDIUM RISK"), (70, "MEDIUM RISK"),
                      (71, "HIGH RISK"), (100, "HIGH RISK")]),
])
def test_category_by_score(spark, policy, cases):
    got = _one(spark, [(s,) for s, _ in cases], "s int", C.risk_category("s", policy))
    assert got == [c for _, c in cases]


def test_category_by_probability(spark):
    cases = [(0.3049, "LOW RISK"), (0.3050, "MEDIUM RISK"), (0.7049, "MEDIUM RISK"), (0.7050, "HIGH RISK")]
    got = _one(spark, [(p,) for p, _ in cases], "p double", C.risk_category(C.risk_score("p")))
    assert got == [c for _, c in cases]
    custom = P.RiskPolicy(low_max=15, medium_max=50)
    cases = [(0.15, "LOW RISK"), (0.16, "MEDIUM RISK"), (0.50, "MEDIUM RISK"), (0.51, "HIGH RISK")]
    got = _one(spark, [(p,) for p, _ in cases], "p double", C.risk_category(C.risk_score("p"), custom))
    assert got == [c for _, c in cases]


def test_decision_inclusive_threshold(spark):
    cases = [(0.2772, "ACCEPT"), (0.2773, "REVIEW"), (0.2774, "REVIEW")]
    got = _one(spark, [(p,) for p, _ in cases], "p double", C.decision("p", 0.2773))
    assert got == [d for _, d in cases]


def test_decision_override_and_decoupling(spark):
    assert _one(spark, [(0.12,)], "p double", C.decision("p", 0.10)) == ["REVIEW"]
    assert _one(spark, [(0.75,)], "p double", C.decision("p", 0.80)) == ["ACCEPT"]
    df = RK.assess(spark.createDataFrame([(0.25,)], "p double"), threshold=0.20).first()
    assert df["risk_category"] == "LOW RISK" and df["decision"] == "REVIEW"


def test_invalid_policy_rejected():
    with pytest.raises(ValueError):
        P.RiskPolicy(low_max=70, medium_max=30).validate()
    with pytest.raises(ValueError):
        P.RiskPolicy(threshold=1.5).validate()


def test_alias_canonicalisation(spark):
    rows = [("LOW RISK", "ALLOW"), ("low", "MONITOR"), ("HIGH RISK", "FLAGGED FOR INVESTIGATION")]
    df = RK.canonical_labels(spark.createDataFrame(rows, "risk_category string, decision string")).collect()
    assert [r["category_canonical"] for r in df] == ["LOW", "LOW", "HIGH"]
    assert [r["decision_canonical"] for r in df] == ["ACCEPT", "REVIEW", "REVIEW"]


def test_priority_tiers(spark):
    df = spark.createDataFrame([(95, 1200.0, True), (10, 15.0, False), (2, 0.5, True)],
                               "risk_score int, Amount double, is_flagged boolean")
    out = Q.prioritise(df).collect()
    assert out[0]["priority_tier"].startswith("P1") and out[0]["priority_score"] >= 350
    assert out[1]["priority_tier"].startswith("P4") and out[1]["priority_score"] < 100
    assert out[2]["exposure_factor"] == 1.0


def test_priority_half_even(spark):
    # 2 * (1 + log10(1)) * 1.25 = 2.5 -> 2 (half-even); 6 * 1.25 = 7.5 -> 8
    df = spark.createDataFrame([(2, 1.0, True), (6, 1.0, True)], "risk_score int, Amount double, is_flagged boolean")
    assert [r["priority_score"] for r in Q.prioritise(df).collect()] == [2, 8]


def test_policy_history_table_against_a_scan(spark):
    import datetime as dt
    import random
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: None if rng.random() < 0.05 else t0 + dt.timedelta(minutes=rng.randrange(60))
    keys = ["hot", "hot", "x", None, "never"]
    events = [(i, rng.choice(keys), at(), {"k": 1}) for i in range(600)]
    policies = [(j, rng.choice(keys[:4]), at(), rng.choice((0.1, 0.5, 0.9, None, 1.5, float("nan")))) for j in range(120)]
    df = spark.createDataFrame(events, "id long, policy_key string, ts timestamp_ntz, extra map<string,int>").repartition(5)
    pol = spark.createDataFrame(policies, "policy_id long, policy_key string, effective_from timestamp_ntz, threshold double")
    got = {r.id: (r.policy_threshold, r.policy_from and r.policy_from.replace(tzinfo=None)) for r in RK.policy_as_of_table(df, pol).collect()}
    assert len(got) == len(events)
    for i, k, t, _ in events:
        known = [(f, j, v) for j, key, f, v in policies
                 if key == k and f is not None and t is not None and f <= t and v is not None and 0 <= v <= 1]
        last = max(known, default=None)
        assert got[i][0] == (last[2] if last else None), (i, k, t)
    assert RK.policy_as_of_table(df, pol.limit(0)).where("policy_threshold IS NOT NULL").count() == 0
