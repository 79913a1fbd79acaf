"""Risk scoring queries (R1-R9, F14) over scored ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit
from ..operators import risk as RK
from ..sources.tables import transactions
from .registry import TX, R, register

T0 = P.DEFAULT_THRESHOLD
CUSTOM = P.RiskPolicy(low_max=15, medium_max=50)
POLICY_CHANGES = (("2024-01-08 00:00:00", 0.35), ("2024-01-15 12:00:00", 0.2), ("2024-01-22 06:30:00", 0.5))


def _score_sql(p: str = "p") -> str:
    return (f"CASE WHEN {p} IS NULL OR isnan({p}) THEN NULL ELSE "
            f"CAST(floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, {p})) * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) END")


def _cat_sql(score: str, low: int, med: int, vals) -> str:
    return f"CASE WHEN {score} <= {low} THEN '{vals[0]}' WHEN {score} <= {med} THEN '{vals[1]}' ELSE '{vals[2]}' END"


@register("r01_score", f"SELECT id, {R('p')} AS p, {_score_sql()} AS risk_score FROM {TX}")
def r01_score(spark, sf_dir):
    """Clamp to [0,1] then int(floor(p*100 + 0.5))."""
    tx = transactions(spark, sf_dir)
    return tx.select("id", "p", C.risk_score("p").alias("risk_score"))


@register("r02_category", f"""
SELECT id, risk_score,
  {_cat_sql('risk_score', 30, 70, P.CATEGORY_LABELS)} AS risk_category,
  {_cat_sql('risk_score', 30, 70, P.CATEGORY_COLORS)} AS color,
  {_cat_sql('risk_score', 15, 50, P.CATEGORY_LABELS)} AS risk_category_custom
FROM (SELECT id, {_score_sql()} AS risk_score FROM {TX})""")
def r02_category(spark, sf_dir):
    """R2: category by score with default (30/70) and custom (15/50) boundaries."""
    tx = transactions(spark, sf_dir).select("id", C.risk_score("p").alias("risk_score"))
    return tx.select("id", "risk_score", C.risk_category("risk_score").alias("risk_category"),
                     C.risk_color("risk_score").alias("color"),
                     C.risk_category("risk_score", CUSTOM).alias("risk_category_custom"))


@register("r03_decision", f"""
SELECT id,
  CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= 0.2773::DOUBLE THEN 'REVIEW' ELSE 'ACCEPT' END AS decision,
  CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= 0.2773::DOUBLE THEN '{P.STATUS_FLAGGED}' ELSE '{P.STATUS_CLEARED}' END AS status_label,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= 0.2773::DOUBLE AS is_flagged,
  CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= 0.5::DOUBLE THEN 'REVIEW' ELSE 'ACCEPT' END AS decision_override
FROM {TX}""")
def r03_decision(spark, sf_dir):
    """P >= t -> REVIEW (inclusive), with a per-call override t = 0.5."""
    tx = transactions(spark, sf_dir)
    return tx.select("id", C.decision("p", T0).alias("decision"), C.status_label("p", T0).alias("status_label"),
                     C.flagged("p", T0).alias("is_flagged"), C.decision("p", 0.5).alias("decision_override"))


def _assess_sql(t_sql: str, src: str = TX, extra: str = "") -> str:
    pc = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, p))"
    sc = _score_sql()
    cat = _cat_sql(sc, 30, 70, P.CATEGORY_LABELS)
    return f"""
SELECT id{extra}, {R(pc, 6)} AS probability, {sc} AS risk_score, {cat} AS risk_category,
  {_cat_sql(sc, 30, 70, P.CATEGORY_COLORS)} AS color,
  CASE WHEN {pc} >= {t_sql} THEN 'REVIEW' ELSE 'ACCEPT' END AS decision,
  {pc} >= {t_sql} AS is_flagged,
  CASE WHEN {pc} >= {t_sql} THEN '{P.STATUS_FLAGGED}' ELSE '{P.STATUS_CLEARED}' END AS status_label,
  CAST({pc} >= {t_sql} AS INTEGER) AS prediction,
  {R(t_sql, 4)} AS decision_threshold,
  CASE WHEN {pc} >= {t_sql}
    THEN printf('Transaction FLAGGED FOR INVESTIGATION: probability %s exceeds decision threshold %s (risk score: %d/100, %s).',
                printf('%.4f', {R(pc, 4)}), printf('%.4f', {R(t_sql, 4)}), {sc}, {cat})
    ELSE printf('Transaction cleared automatically under current operational threshold (risk score: %d/100, %s). NOTE: ACCEPT is an operational clearance, not a guarantee of transaction legitimacy.', {sc}, {cat})
  END AS description,
  '{P.LEGITIMACY_DISCLAIMER}' AS legitimacy_disclaimer
FROM {src}"""


ASSESS_COLS = ["id", "probability", "risk_score", "risk_category", "color", "decision", "is_flagged",
               "status_label", "prediction", "decision_threshold", "description", "legitimacy_disclaimer"]


@register("r04_assessment", _assess_sql("0.2773::DOUBLE"))
def r04_assessment(spark, sf_dir):
    """The full assessment record for every row."""
    return RK.assess(transactions(spark, sf_dir)).select(*ASSESS_COLS)


@register("r05_batch_override", _assess_sql("0.1::DOUBLE"))
def r05_batch_override(spark, sf_dir):
    """Batch assessment with a per-call threshold."""
    return RK.assess(transactions(spark, sf_dir), threshold=0.1).select(*ASSESS_COLS)


@register("r06_canonical_labels", f"""
SELECT id, trim(replace(upper(cat), ' RISK', '')) AS category_canonical,
  CASE WHEN trim(upper(status_label)) IN ('ACCEPT', 'ALLOW') THEN 'ACCEPT'
       WHEN trim(upper(status_label)) IN ('REVIEW', 'MONITOR', 'FLAGGED FOR INVESTIGATION') THEN 'REVIEW'
       ELSE trim(upper(status_label)) END AS status_canonical,
  CASE WHEN trim(upper(legacy)) IN ('ACCEPT', 'ALLOW') THEN 'ACCEPT'
       WHEN trim(upper(legacy)) IN ('REVIEW', 'MONITOR', 'FLAGGED FOR INVESTIGATION') THEN 'REVIEW'
       ELSE trim(upper(legacy)) END = decision AS legacy_matches
FROM (SELECT id, {_cat_sql(_score_sql(), 30, 70, P.CATEGORY_LABELS)} AS cat,
        CASE WHEN p >= 0.2773::DOUBLE THEN 'REVIEW' ELSE 'ACCEPT' END AS decision,
        CASE WHEN p >= 0.2773::DOUBLE THEN '{P.STATUS_FLAGGED}' ELSE '{P.STATUS_CLEARED}' END AS status_label,
        CASE WHEN p >= 0.2773::DOUBLE THEN 'monitor' ELSE 'allow' END AS legacy FROM {TX})""")
def r06_canonical_labels(spark, sf_dir):
    """Alias canonicalisation (LOW RISK == LOW, MONITOR/ALLOW legacy names)."""
    a = RK.assess(transactions(spark, sf_dir), with_text=False)
    legacy = F.when(F.col("is_flagged"), F.lit("monitor")).otherwise(F.lit("allow"))
    return a.select("id", C.canonical_category("risk_category").alias("category_canonical"),
                    C.canonical_decision("status_label").alias("status_canonical"),
                    (C.canonical_decision(legacy) == F.col("decision")).alias("legacy_matches"))


def _candidate_policies(tx):
    """Candidate (low_max, medium_max, threshold) proposals derived per user."""
    return tx.groupBy("entity").agg(
        (F.min("Amount").cast("int") % 101).alias("low_max"),
        (F.max("Amount").cast("int") % 101).alias("medium_max"),
        (F.avg("p") * dlit(2.5) - dlit(0.2)).alias("threshold"))


@register("r07_policy_validity", f"""
SELECT entity, low_max, medium_max, {R('threshold')} AS threshold,
  CASE WHEN NOT (low_max >= 0 AND low_max < medium_max AND medium_max <= 100)
         THEN 'category boundaries must satisfy 0 <= low_max < medium_max <= 100'
       WHEN threshold IS NULL OR isnan(threshold) OR threshold < 0.0::DOUBLE OR threshold > 1.0::DOUBLE
         THEN 'decision_threshold must lie within [0.0, 1.0]' END AS violation
FROM (SELECT entity, CAST(trunc(min("Amount")) AS INTEGER) % 101 AS low_max, CAST(trunc(max("Amount")) AS INTEGER) % 101 AS medium_max,
        avg(p) * 2.5::DOUBLE - 0.2::DOUBLE AS threshold FROM {TX} GROUP BY entity)""")
def r07_policy_validity(spark, sf_dir):
    """Policy rows checked against 0 <= low < medium <= 100 and 0 <= t <= 1."""
    pol = _candidate_policies(transactions(spark, sf_dir))
    return pol.withColumn("violation", RK.policy_violations(F.col("low_max"), F.col("medium_max"),
                                                            F.col("threshold")))


@register("r08_effective_threshold", f"""
SELECT id, t_eff, CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= t_eff THEN 'REVIEW' ELSE 'ACCEPT' END AS decision
FROM (SELECT id, p, coalesce(CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0::DOUBLE END,
        CASE WHEN event_type = 'purchase' THEN 0.4::DOUBLE END, 0.2773::DOUBLE) AS t_eff FROM {TX})""")
def r08_effective_threshold(spark, sf_dir):
    """Per-row override (click rows: props.k %) > policy (purchase: 0.4) > default."""
    tx = transactions(spark, sf_dir)
    override = F.when(F.col("event_type") == "click",
                      F.get_json_object("props", "$.k").cast("double") / dlit(100.0))
    policy_t = F.when(F.col("event_type") == "purchase", dlit(0.4))
    t = RK.effective_threshold(override, policy_t)
    return tx.select("id", t.alias("t_eff"), C.decision("p", t).alias("decision"))


def _asof_sql() -> str:
    cases = " + ".join(f"CAST(ts >= TIMESTAMP '{a}' AS INTEGER)" for a, _ in POLICY_CHANGES)
    arr = "[" + ", ".join(f"{b!r}::DOUBLE" for _, b in POLICY_CHANGES) + "]"
    return f"""
SELECT id, policy_index, policy_threshold, t_eff,
  CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) >= t_eff THEN 'REVIEW' ELSE 'ACCEPT' END AS decision
FROM (SELECT id, p, policy_index, CASE WHEN policy_index > 0 THEN {arr}[policy_index] END AS policy_threshold,
        coalesce(CASE WHEN policy_index > 0 THEN {arr}[policy_index] END, 0.2773::DOUBLE) AS t_eff
      FROM (SELECT id, p, ({cases}) AS policy_index FROM {TX}))"""


@register("r09_policy_as_of", _asof_sql())
def r09_policy_as_of(spark, sf_dir):
    """Threshold changes apply to later rows only (as-of lookup by event time)."""
    tx = RK.policy_as_of(transactions(spark, sf_dir), "ts", POLICY_CHANGES)
    t = RK.effective_threshold(F.lit(None), F.col("policy_threshold"))
    return tx.select("id", "policy_index", "policy_threshold", t.alias("t_eff"),
                     C.decision("p", t).alias("decision"))


# A policy history of five keys, from every 97th event.
_HISTORY = f"(SELECT entity % 5 AS policy_key, id AS policy_id, ts AS effective_from, p2 AS threshold FROM {TX} WHERE id % 97 = 0)"


@register("r09_policy_table", f"""
WITH pol AS (SELECT policy_key, effective_from, arg_max(threshold, policy_id) AS threshold FROM {_HISTORY} GROUP BY ALL),
e AS (SELECT *, entity % 5 AS policy_key FROM {TX})
SELECT e.id, pol.threshold AS policy_threshold, pol.effective_from AS policy_from, coalesce(pol.threshold, 0.2773::DOUBLE) AS t_eff,
  CASE WHEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, e.p)) >= coalesce(pol.threshold, 0.2773::DOUBLE) THEN 'REVIEW' ELSE 'ACCEPT' END AS decision
FROM e ASOF LEFT JOIN pol ON e.policy_key = pol.policy_key AND e.ts >= pol.effective_from""")
def r09_policy_table(spark, sf_dir):
    """Decisions under the thresholds that a policy history table had put in force."""
    tx = transactions(spark, sf_dir).withColumn("policy_key", F.col("entity") % 5)
    policies = tx.where(F.col("id") % 97 == 0).select(
        "policy_key", F.col("id").alias("policy_id"), F.col("ts").alias("effective_from"), F.col("p2").alias("threshold"))
    out = RK.policy_as_of_table(tx.select("id", "policy_key", "ts", "p"), policies)
    t = RK.effective_threshold(F.lit(None), F.col("policy_threshold"))
    return out.select("id", "policy_threshold", F.col("policy_from").cast("timestamp_ntz").alias("policy_from"), t.alias("t_eff"),
                      C.decision("p", t).alias("decision"))


@register("f14_rounding_rules", f"""
SELECT id, {_score_sql('p')} AS score_half_up,
  CAST(round_even(("Amount" / 7.0::DOUBLE)::DOUBLE, 0) AS INTEGER) AS amount_half_even,
  {R('"Amount" / 7.0::DOUBLE', 2)} AS amount_2dp
FROM {TX}""")
def f14_rounding_rules(spark, sf_dir):
    """half-up score rounding, half-even integer rounding, n-digit report rounding."""
    tx = transactions(spark, sf_dir)
    return tx.select("id", C.risk_score("p").alias("score_half_up"),
                     F.rint(F.col("Amount") / dlit(7.0)).cast("int").alias("amount_half_even"),
                     C.rnd(F.col("Amount") / dlit(7.0), 2).alias("amount_2dp"))


NULL_P = f"(SELECT id, CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN 'NaN'::DOUBLE ELSE p END AS p FROM {TX})"


@register("r04n_missing_probability", f"""
SELECT id, CASE WHEN ok THEN {R('greatest(0.0::DOUBLE, least(1.0::DOUBLE, p))', 6)} END AS probability,
  CASE WHEN ok THEN {_score_sql()} END::DOUBLE AS risk_score, CASE WHEN ok THEN {_cat_sql(_score_sql(), 30, 70, P.CATEGORY_LABELS)} END AS risk_category,
  CASE WHEN ok THEN CASE WHEN p >= 0.2773::DOUBLE THEN 'REVIEW' ELSE 'ACCEPT' END END AS decision
FROM (SELECT *, p IS NOT NULL AND NOT isnan(p) AS ok FROM {NULL_P})""")
def r04n_missing_probability(spark, sf_dir):
    """R4 on rows without a probability (NULL, NaN): no score, tier or decision is made up."""
    p = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("p"))
    tx = transactions(spark, sf_dir).withColumn("p", p)
    return RK.assess(tx).select("id", "probability", F.col("risk_score").cast("double").alias("risk_score"), "risk_category", "decision")
