"""Cost trade-off queries (T1-T6) over the scored ``events`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..operators import metrics as M
from ..operators import tradeoff as TO
from ..sources.tables import transactions
from .registry import TX, R, register, values_table

CUSTOM_GRID = (0.9, 0.2, 0.5, 0.35)
CUSTOM_COST = P.CostParams(cost_per_false_alert=25.0, fraud_multiplier=1.5, grid=CUSTOM_GRID)


def _grid_sql(grid) -> str:
    g = sorted(float(x) for x in grid)
    return values_table("g", ("grid_index", "threshold"), list(enumerate(g)))


def _curve_sql(cost: P.CostParams) -> str:
    c, m = float(cost.cost_per_false_alert), float(cost.fraud_multiplier)
    return f"""
WITH tx AS {TX}, g AS {_grid_sql(cost.grid)},
c AS (
  SELECT g.grid_index, g.threshold,
    count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y = 1) AS tp,
    count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y = 0) AS fp,
    count(*) FILTER (WHERE tx.p < g.threshold AND tx.y = 0) AS tn,
    count(*) FILTER (WHERE tx.p < g.threshold AND tx.y = 1) AS fn,
    coalesce(sum(CASE WHEN tx.p >= g.threshold AND tx.y = 1 THEN tx."Amount"::DECIMAL(18,2) END), 0)::DOUBLE AS caught,
    coalesce(sum(CASE WHEN tx.p < g.threshold AND tx.y = 1 THEN tx."Amount"::DECIMAL(18,2) END), 0)::DOUBLE AS escaped
  FROM g, tx GROUP BY g.grid_index, g.threshold),
r AS (
  SELECT *, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS rec,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 1.0::DOUBLE END AS prec,
         fp * {c!r}::DOUBLE AS alert, fp * {c!r}::DOUBLE + escaped * {m!r}::DOUBLE AS net
  FROM c)
SELECT grid_index, {R('threshold', 4)} AS threshold, {R('rec * 100', 2)} AS recall,
  {R('prec * 100', 2)} AS precision,
  {R('CASE WHEN prec + rec > 0 THEN 2.0::DOUBLE * prec * rec / (prec + rec) ELSE 0.0::DOUBLE END', 4)} AS f1_score,
  {R('CASE WHEN 4.0::DOUBLE * prec + rec > 0 THEN 5.0::DOUBLE * prec * rec / (4.0::DOUBLE * prec + rec) ELSE 0.0::DOUBLE END', 4)} AS f2_score,
  tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn,
  {R('caught', 2)} AS fraud_caught_dollars, {R('escaped', 2)} AS fraud_escaped_dollars,
  {R('alert', 2)} AS alert_review_cost, {R('net', 2)} AS net_financial_cost, net AS _net
FROM r"""


def _curve(spark, sf_dir, cost=P.CostParams()):
    return TO.tradeoff_curve(transactions(spark, sf_dir), cost)


@register("t01_tradeoff_curve",
          f"SELECT * EXCLUDE (_net) FROM ({_curve_sql(P.CostParams())})")
def t01_tradeoff_curve(spark, sf_dir):
    """Per-threshold counts, rates, dollars and costs on the default grid."""
    return _curve(spark, sf_dir)


@register("t02_cost_optimal",
          f"""SELECT arg_min(threshold, (_net, threshold)) AS cost_optimal_threshold,
                     {R('min(_net)', 2)} AS min_total_cost
              FROM ({_curve_sql(P.CostParams())})""")
def t02_cost_optimal(spark, sf_dir):
    """Argmin of net cost, lowest tied threshold."""
    return TO.cost_optimal(_curve(spark, sf_dir))


def _policy_sql() -> str:
    demo = values_table("d", ("target_index", "target"), list(enumerate(float(x) for x in P.DEMO_THRESHOLDS)))
    return f"""
WITH cv AS ({_curve_sql(P.CostParams())}), d AS {demo},
m AS (SELECT d.target_index, d.target,
        arg_min(cv.grid_index, (abs(cv.threshold - d.target), cv.grid_index)) AS gi
      FROM d, cv GROUP BY d.target_index, d.target)
SELECT m.target_index, m.target, cv.* EXCLUDE (_net),
  CASE WHEN abs(m.target - 0.2773::DOUBLE) < 0.0001::DOUBLE THEN '{P.POLICY_ACTIVE[0]}'
       WHEN m.target <= 0.10::DOUBLE THEN '{P.POLICY_AGGRESSIVE[0]}'
       WHEN m.target >= 0.70::DOUBLE THEN '{P.POLICY_LOW_FRICTION[0]}'
       ELSE '{P.POLICY_BALANCED[0]}' END AS policy_name,
  CASE WHEN abs(m.target - 0.2773::DOUBLE) < 0.0001::DOUBLE THEN '{P.POLICY_ACTIVE[1]}'
       WHEN m.target <= 0.10::DOUBLE THEN '{P.POLICY_AGGRESSIVE[1]}'
       WHEN m.target >= 0.70::DOUBLE THEN '{P.POLICY_LOW_FRICTION[1]}'
       ELSE '{P.POLICY_BALANCED[1]}' END AS badge
FROM m JOIN cv ON cv.grid_index = m.gi"""


@register("t03_policy_table", _policy_sql())
def t03_policy_table(spark, sf_dir):
    """T3 (+J2 nearest-match join): demonstration thresholds -> nearest grid row + policy name."""
    return TO.policy_table(_curve(spark, sf_dir))


@register("t04_cost_assumptions", f"""
SELECT count(*) FILTER (WHERE y = 1)::BIGINT AS total_fraud_count,
  {R('coalesce(sum(CASE WHEN y = 1 THEN "Amount"::DECIMAL(18,2) END), 0)::DOUBLE', 2)} AS total_fraud_dollars,
  15.0::DOUBLE AS cost_per_false_alert, 1.0::DOUBLE AS fraud_multiplier
FROM {TX}""")
def t04_cost_assumptions(spark, sf_dir):
    """T4: total positives and positive dollars."""
    return TO.cost_assumptions(transactions(spark, sf_dir))


@register("t05_custom_grid", f"SELECT * EXCLUDE (_net) FROM ({_curve_sql(CUSTOM_COST)})")
def t05_custom_grid(spark, sf_dir):
    """T5: caller grid (unsorted input is sorted) and caller costs."""
    return _curve(spark, sf_dir, CUSTOM_COST)


SENSITIVITY = (0.1, 0.2, 0.2773, 0.3, 0.5, 0.7, 0.9)


@register("t06_sensitivity", f"""
SELECT threshold, precision, recall, f1_score, f2_score
FROM ({_curve_sql(P.CostParams(grid=SENSITIVITY))})""")
def t06_sensitivity(spark, sf_dir):
    """Threshold sensitivity table computed from data (never constants)."""
    cv = _curve(spark, sf_dir, P.CostParams(grid=SENSITIVITY))
    return cv.select("threshold", "precision", "recall", "f1_score", "f2_score")
