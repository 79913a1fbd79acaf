"""Attribution queries (X2-X10) on the ``embeddings`` feature matrix with a
rule-given linear model (coefficient of V_k = ((k mod 7) - 3) / 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain as XP
from ..sources.tables import N_V, feature_rows, transactions
from .registry import TX, R, VROWS, register

FEATS = [f"V{k}" for k in range(1, N_V + 1)]
COEFS = [((k % 7) - 3) / 4.0 for k in range(1, N_V + 1)]


def attributions(spark, sf_dir):
    return XP.linear_attributions(feature_rows(spark, sf_dir), FEATS, COEFS)


def _long_sql() -> str:
    parts = []
    for i, (f, c) in enumerate(zip(FEATS, COEFS)):
        parts.append(f"SELECT id, {i} AS feature_index, '{f}' AS feature, \"{f}\" AS value, "
                     f"{c!r}::DOUBLE * (\"{f}\" - (SELECT avg(\"{f}\") FROM {VROWS()})) AS phi FROM {VROWS()}")
    return "(" + " UNION ALL ".join(parts) + ")"


ATT = _long_sql()


@register("x02_linear_attributions", f"SELECT id, feature, {R('value')} AS value, {R('phi')} AS phi FROM {ATT}")
def x02_linear_attributions(spark, sf_dir):
    """Linear SHAP coef_j (x_j - mean_j) as long rows."""
    return XP.explode_attr(attributions(spark, sf_dir)).select("id", "feature", "value", "phi")


def _topk_sql(k: int = 5) -> str:
    return f"""
WITH a AS (SELECT *, CASE WHEN phi > 0 THEN 1 WHEN phi < 0 THEN -1 END AS sign FROM {ATT}),
r AS (SELECT *, row_number() OVER (PARTITION BY id, sign ORDER BY phi * -sign, feature_index) AS rank,
        sum(abs(phi)) OVER (PARTITION BY id, sign) AS tot FROM a WHERE sign IS NOT NULL)
SELECT id, CASE WHEN sign > 0 THEN 'top' ELSE 'mitigating' END AS "group", rank, feature,
  {R('value', 4)} AS feature_value, {R('phi', 4)} AS shap_value,
  CASE WHEN sign > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction,
  {R('abs(phi) / tot', 4)} AS relative_impact
FROM r WHERE rank <= {k}"""


@register("x03_topk_factors", _topk_sql())
def x03_topk_factors(spark, sf_dir):
    """Top-5 risk-increasing and mitigating factors per row with sign-wise shares."""
    return XP.top_factors(attributions(spark, sf_dir), 5)


RANK_ALL_SQL = f"""
SELECT id, row_number() OVER (PARTITION BY id ORDER BY abs(phi) DESC, feature_index) AS rank, feature,
  {R('value', 4)} AS feature_value, {R('phi', 4)} AS shap_value,
  CASE WHEN phi > 0.000001::DOUBLE THEN 'increases_risk' WHEN phi < -0.000001::DOUBLE THEN 'decreases_risk' ELSE 'neutral' END AS direction,
  {R('abs(phi) / (sum(abs(phi)) OVER (PARTITION BY id) + 0.000000000001::DOUBLE)', 4)} AS relative_impact
FROM {ATT}"""


@register("x04_rank_all", RANK_ALL_SQL)
def x04_rank_all(spark, sf_dir):
    """All features ranked by |phi| with the ±1e-6 neutral band."""
    return XP.rank_all(attributions(spark, sf_dir))


GLOBAL_SQL = f"""
WITH g AS (SELECT feature_index, feature, avg(abs(phi)) AS m FROM {ATT} GROUP BY ALL)
SELECT row_number() OVER (ORDER BY m DESC, feature_index) AS rank, feature, {R('m', 6)} AS mean_abs_shap,
  {R('m / ((SELECT sum(m) FROM g) + 0.000000000001::DOUBLE)', 4)} AS importance_share FROM g"""


@register("x05_global_importance", GLOBAL_SQL)
def x05_global_importance(spark, sf_dir):
    """Mean |phi| per feature over all rows (no sample cap), rank and share."""
    return XP.global_importance(attributions(spark, sf_dir))


@register("x06_top_n", f"SELECT * FROM ({GLOBAL_SQL}) WHERE rank <= 10")
def x06_top_n(spark, sf_dir):
    """The 10 most important features."""
    return XP.top_n(XP.global_importance(attributions(spark, sf_dir)), 10)


@register("x08_case_selection", f"""
(SELECT id, y, {R('p')} AS p, 'fraud_high_confidence' AS "case" FROM {TX} WHERE y = 1 AND p >= 0.9::DOUBLE ORDER BY id LIMIT 1)
UNION ALL (SELECT id, y, {R('p')} AS p, 'legitimate' FROM {TX} WHERE y = 0 ORDER BY id LIMIT 1)""")
def x08_case_selection(spark, sf_dir):
    """First true positive with p >= 0.90 and first legitimate row."""
    tx = transactions(spark, sf_dir).select("id", "y", "p")
    return XP.select_cases(tx)


@register("x09_top_driver", f"""
WITH a AS (SELECT *, CASE WHEN phi > 0 THEN 1 WHEN phi < 0 THEN -1 END AS sign FROM {ATT}),
r AS (SELECT *, row_number() OVER (PARTITION BY id, sign ORDER BY phi * -sign, feature_index) AS rank FROM a WHERE sign = 1)
SELECT v.id, r.feature AS top_driver FROM {VROWS()} v LEFT JOIN r ON r.id = v.id AND r.rank = 1""")
def x09_top_driver(spark, sf_dir):
    """Rank-1 risk-increasing feature per row (NULL when none)."""
    return XP.top_driver(attributions(spark, sf_dir))


@register("x10_attribution_spread", f"""
WITH g AS ({GLOBAL_SQL}), s AS (SELECT a.*, g.rank FROM {ATT} a JOIN g USING (feature) WHERE g.rank <= 15)
SELECT feature, rank, count(*)::BIGINT AS n, {R('corr(value, phi)')} AS value_phi_corr,
  {R('quantile_cont(phi, 0.05)')} AS phi_q05, {R('quantile_cont(phi, 0.25)')} AS phi_q25,
  {R('quantile_cont(phi, 0.5)')} AS phi_q50, {R('quantile_cont(phi, 0.75)')} AS phi_q75,
  {R('quantile_cont(phi, 0.95)')} AS phi_q95 FROM s GROUP BY feature, rank""")
def x10_attribution_spread(spark, sf_dir):
    """Per-feature spread of phi (beeswarm data) for the 15 most important features."""
    return XP.attribution_spread(attributions(spark, sf_dir), 15)


@register("x07_narrative", None)
def x07_narrative(spark, sf_dir):
    """One summary line per row from its top-3 features."""
    return XP.narrative(attributions(spark, sf_dir), 3)
