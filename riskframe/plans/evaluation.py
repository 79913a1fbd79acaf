"""Evaluation queries (E1-E14, M5, M8) over scored ``events``.

``p`` is continuous (about one distinct score per row, exercising the
bucketed running sums); ``p2`` has heavy ties (half-credit AUC paths).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import dlit, hash_uniform
from ..operators import metrics as M
from ..sources.tables import transactions
from .registry import TX, R, register

T0 = P.DEFAULT_THRESHOLD


def _rates_sql(src: str) -> str:
    return f"""
SELECT tp, fp, tn, fn,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS recall,
  CASE WHEN 2.0::DOUBLE * tp + fn + fp > 0 THEN 2.0::DOUBLE * tp / (2.0::DOUBLE * tp + 1.0::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END AS f1_score,
  CASE WHEN 5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp > 0 THEN 5.0::DOUBLE * tp / (5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END AS f2_score,
  CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn)::DOUBLE / (tp + fp + tn + fn) ELSE 0.0::DOUBLE END AS accuracy,
  CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0.0::DOUBLE END AS specificity
FROM ({src})"""


def _counts_sql(t: float, pcol: str = "p", t_expr: str | None = None) -> str:
    te = t_expr or f"{float(t)!r}::DOUBLE"
    return f"""SELECT
  count(*) FILTER (WHERE {pcol} >= {te} AND y = 1)::BIGINT AS tp,
  count(*) FILTER (WHERE {pcol} >= {te} AND y <> 1)::BIGINT AS fp,
  count(*) FILTER (WHERE NOT ({pcol} >= {te}) AND y <> 1)::BIGINT AS tn,
  count(*) FILTER (WHERE NOT ({pcol} >= {te}) AND y = 1)::BIGINT AS fn
FROM {TX}"""


def _rounded(cols: list[str], d: int = 6) -> str:
    return ", ".join(f"{R(c, d)} AS {c}" for c in cols)


RATE_COLS = ["precision", "recall", "f1_score", "f2_score", "accuracy", "specificity"]


@register("e01_confusion", _counts_sql(T0))
def e01_confusion(spark, sf_dir):
    """Confusion counts at the default threshold, p >= t inclusive."""
    return M.confusion(transactions(spark, sf_dir), T0)


@register("e02_rates", f"SELECT tp, fp, tn, fn, {_rounded(RATE_COLS)}, 0.2773::DOUBLE AS threshold "
                      f"FROM ({_rates_sql(_counts_sql(T0))})")
def e02_rates(spark, sf_dir):
    """Precision / recall / F1 / F2 / accuracy with zero division -> 0."""
    return M.threshold_metrics(transactions(spark, sf_dir), T0)


@register("e03_specificity", f"SELECT {R('specificity')} AS specificity FROM ({_rates_sql(_counts_sql(0.6))})")
def e03_specificity(spark, sf_dir):
    """Tn / (tn + fp)."""
    return M.threshold_metrics(transactions(spark, sf_dir), 0.6).select("specificity")


def _groups_sql(pcol: str) -> str:
    return f"""
WITH g AS (SELECT {pcol}::DOUBLE AS score, sum(y)::BIGINT AS pos, count(*)::BIGINT AS n FROM {TX} GROUP BY 1),
c AS (SELECT score, pos, n - pos AS neg,
        sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(n - pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        row_number() OVER (ORDER BY score DESC) AS point_no FROM g),
t AS (SELECT sum(pos) AS "P", sum(neg) AS "N" FROM c)"""


def _auc_sql(pcol: str) -> str:
    return f"""{_groups_sql(pcol)}
SELECT {R('CASE WHEN any_value(t."P") > 0 AND any_value(t."N") > 0 THEN sum(neg * (2 * (tp - pos) + pos))::DOUBLE / (2.0::DOUBLE * any_value(t."P") * any_value(t."N")) ELSE 0.0::DOUBLE END')} AS roc_auc,
       {R('CASE WHEN any_value(t."P") > 0 THEN sum(pos::DOUBLE * tp::DOUBLE / (tp + fp)::DOUBLE) / any_value(t."P") ELSE 0.0::DOUBLE END')} AS pr_auc
FROM c, t"""


@register("e04_roc_auc", f"SELECT roc_auc FROM ({_auc_sql('p2')})")
def e04_roc_auc(spark, sf_dir):
    """Exact ROC-AUC with half credit for tied scores (tied score column p2)."""
    return M.auc_scores(transactions(spark, sf_dir), p="p2").select("roc_auc")


@register("e05_pr_auc", f"SELECT pr_auc FROM ({_auc_sql('p2')})")
def e05_pr_auc(spark, sf_dir):
    """E5: average precision (step sum, not trapezoid)."""
    return M.auc_scores(transactions(spark, sf_dir), p="p2").select("pr_auc")


@register("e05b_auc_continuous", _auc_sql("p"))
def e05b_auc_continuous(spark, sf_dir):
    """E4+E5 on the continuous score (many range buckets)."""
    return M.auc_scores(transactions(spark, sf_dir), p="p")


@register("e06_pr_curve", f"""{_groups_sql('p')}
SELECT point_no::BIGINT AS point_no, {R('score')} AS threshold,
  {R('CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END')} AS precision,
  {R('CASE WHEN t."P" = 0 THEN 1.0::DOUBLE ELSE tp::DOUBLE / t."P" END')} AS recall
FROM c, t
UNION ALL SELECT (SELECT count(*) FROM c) + 1, NULL, 1.0::DOUBLE, 0.0::DOUBLE""")
def e06_pr_curve(spark, sf_dir):
    """One point per distinct score plus the closing (precision 1, recall 0)."""
    return M.pr_curve(transactions(spark, sf_dir))


_ROC_SQL = f"""{_groups_sql('p')}
SELECT 0::BIGINT AS point_no, 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT point_no::BIGINT, {R('score')},
  {R('CASE WHEN t."N" > 0 THEN fp::DOUBLE / t."N" ELSE 0.0::DOUBLE END')},
  {R('CASE WHEN t."P" > 0 THEN tp::DOUBLE / t."P" ELSE 0.0::DOUBLE END')}
FROM c, t"""


@register("e07_roc_curve", _ROC_SQL)
def e07_roc_curve(spark, sf_dir):
    """fpr/tpr per distinct score, all points kept, from (0, 0)."""
    return M.roc_curve(transactions(spark, sf_dir))


def _search_sql(metric_beta2: float) -> str:
    grid = P.ThresholdSearch().grid()
    vals = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(grid))
    b2 = float(metric_beta2)
    return f"""
WITH g AS (SELECT * FROM (VALUES {vals}) g(i, threshold)),
c AS (SELECT g.threshold,
        count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y = 1) AS tp,
        count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y <> 1) AS fp,
        count(*) FILTER (WHERE tx.p < g.threshold AND tx.y = 1) AS fn
      FROM g, {TX} tx GROUP BY g.threshold),
s AS (SELECT threshold, CASE WHEN {1 + b2!r}::DOUBLE * tp + {b2!r}::DOUBLE * fn + fp > 0
        THEN {1 + b2!r}::DOUBLE * tp / ({1 + b2!r}::DOUBLE * tp + {b2!r}::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END AS score FROM c)"""


@register("e08_threshold_search", f"""{_search_sql(4.0)}
SELECT {R('arg_max(threshold, (score, -threshold))')} AS threshold, {R('max(score)')} AS best_score FROM s""")
def e08_threshold_search(spark, sf_dir):
    """F2-optimal threshold over linspace(.05, .95, 100); lowest tie wins."""
    return M.threshold_search(transactions(spark, sf_dir))


# --- several "models": scores derived from the data --------------------------
def model_scores(spark, sf_dir) -> dict[str, DataFrame]:
    """Three scorers over the same rows: the ratio score, its coarse twin, and
    the stratified dummy baseline (M5: class 1 with probability = prior,
    one-hot probabilities, fixed threshold 0.5)."""
    tx = transactions(spark, sf_dir)
    prior = tx.agg(F.avg(F.col("y").cast("double")).alias("prior")).select("prior").scalar()
    dummy = tx.select("id", "y", (hash_uniform("id", 42) < prior).cast("double").alias("p"))
    return {"value_ratio": tx.select("id", "y", "p"),
            "value_ratio_coarse": tx.select("id", "y", F.col("p2").alias("p")),
            "dummy_baseline": dummy}


def model_metrics(spark, sf_dir) -> DataFrame:
    tx = transactions(spark, sf_dir)
    prior = tx.agg(F.avg(F.col("y").cast("double")).alias("prior")).select("prior").scalar()
    scores = {"value_ratio": F.col("p"), "value_ratio_coarse": F.col("p2"),
              "dummy_baseline": (hash_uniform("id", 42) < prior).cast("double")}
    each = F.array(*[F.struct(F.lit(k).alias("model"), v.alias("p")) for k, v in scores.items()])
    long = tx.select("y", F.explode(each).alias("s")).select("s.model", "y", "s.p")
    return M.metrics_reports(long, thresholds={"dummy_baseline": 0.5})


def _dummy_sql() -> str:
    return f"""(SELECT id, y, CASE WHEN ('0x' || substring(md5(CAST(id AS VARCHAR) || '|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE
        < (SELECT avg(y::DOUBLE) FROM {TX}) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p FROM {TX})"""


def _report_sql(model: str, src: str, threshold_sql: str) -> str:
    return f"""
(WITH tx AS {src},
g AS (SELECT p::DOUBLE AS score, sum(y)::BIGINT AS pos, count(*)::BIGINT AS n FROM tx GROUP BY 1),
c AS (SELECT score, pos, n - pos AS neg,
        sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(n - pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM g),
t AS (SELECT sum(pos) AS "P", sum(neg) AS "N" FROM c),
a AS (SELECT CASE WHEN any_value(t."P") > 0 AND any_value(t."N") > 0 THEN sum(neg * (2 * (tp - pos) + pos))::DOUBLE / (2.0::DOUBLE * any_value(t."P") * any_value(t."N")) ELSE 0.0::DOUBLE END AS roc_auc,
         CASE WHEN any_value(t."P") > 0 THEN sum(pos::DOUBLE * tp::DOUBLE / (tp + fp)::DOUBLE) / any_value(t."P") ELSE 0.0::DOUBLE END AS pr_auc FROM c, t),
th AS (SELECT {threshold_sql} AS threshold),
k AS (SELECT th.threshold, count(*)::BIGINT AS n_samples, count(*) FILTER (WHERE y = 1)::BIGINT AS n_fraud,
        count(*) FILTER (WHERE y <> 1)::BIGINT AS n_legitimate,
        count(*) FILTER (WHERE p >= th.threshold AND y = 1)::BIGINT AS tp,
        count(*) FILTER (WHERE p >= th.threshold AND y <> 1)::BIGINT AS fp,
        count(*) FILTER (WHERE NOT (p >= th.threshold) AND y <> 1)::BIGINT AS tn,
        count(*) FILTER (WHERE NOT (p >= th.threshold) AND y = 1)::BIGINT AS fn FROM tx, th GROUP BY th.threshold),
r AS (SELECT k.*, a.roc_auc, a.pr_auc,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS recall,
  CASE WHEN 2.0::DOUBLE * tp + fn + fp > 0 THEN 2.0::DOUBLE * tp / (2.0::DOUBLE * tp + 1.0::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END AS f1_score,
  CASE WHEN 5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp > 0 THEN 5.0::DOUBLE * tp / (5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END AS f2_score,
  CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn)::DOUBLE / (tp + fp + tn + fn) ELSE 0.0::DOUBLE END AS accuracy,
  CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0.0::DOUBLE END AS specificity
  FROM k, a)
SELECT '{model}' AS model, *, 0.35::DOUBLE * f2_score + 0.30::DOUBLE * pr_auc + 0.20::DOUBLE * roc_auc + 0.15::DOUBLE * f1_score AS composite_score,
  list_filter([CASE WHEN recall < 0.70::DOUBLE THEN printf('recall=%.4f < 0.70', {R('recall', 4)}) END,
               CASE WHEN precision < 0.10::DOUBLE THEN printf('precision=%.4f < 0.10', {R('precision', 4)}) END,
               CASE WHEN roc_auc < 0.90::DOUBLE THEN printf('roc_auc=%.4f < 0.90', {R('roc_auc', 4)}) END], lambda x: x IS NOT NULL) AS gate_failures
FROM r)"""


def _search_threshold_sql(src: str) -> str:
    grid = P.ThresholdSearch().grid()
    vals = ", ".join(f"({t!r}::DOUBLE)" for t in grid)
    return f"""(WITH g AS (SELECT * FROM (VALUES {vals}) g(threshold)),
      c AS (SELECT g.threshold, count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y = 1) AS tp,
              count(*) FILTER (WHERE tx.p >= g.threshold AND tx.y <> 1) AS fp,
              count(*) FILTER (WHERE tx.p < g.threshold AND tx.y = 1) AS fn FROM g, {src} tx GROUP BY g.threshold)
      SELECT arg_max(threshold, (CASE WHEN 5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp > 0 THEN 5.0::DOUBLE * tp / (5.0::DOUBLE * tp + 4.0::DOUBLE * fn + fp) ELSE 0.0::DOUBLE END, -threshold)) FROM c)"""


_SRC = {
    "value_ratio": f"(SELECT id, y, p FROM {TX})",
    "value_ratio_coarse": f"(SELECT id, y, p2 AS p FROM {TX})",
    "dummy_baseline": _dummy_sql(),
}
REPORTS_SQL = " UNION ALL ".join(
    f"SELECT * FROM {_report_sql(m, s, '0.5::DOUBLE' if m == 'dummy_baseline' else _search_threshold_sql(s))}"
    for m, s in _SRC.items())
REPORT_COLS = ["precision", "recall", "f1_score", "f2_score", "accuracy", "specificity",
               "roc_auc", "pr_auc", "composite_score", "threshold"]


def _rep_select(extra: str = "") -> str:
    return (f"SELECT model, n_samples, n_fraud, n_legitimate, tp, fp, tn, fn, {_rounded(REPORT_COLS)}, "
            f"gate_failures, len(gate_failures) = 0 AS passes_gates{extra} FROM ({REPORTS_SQL})")


@register("e13_metrics_report", _rep_select())
def e13_metrics_report(spark, sf_dir):
    """E13 (+M8 fixed-threshold evaluation for the dummy): one report row per model."""
    return model_metrics(spark, sf_dir)


@register("e09_composite", f"SELECT model, {R('composite_score')} AS composite_score FROM ({REPORTS_SQL})")
def e09_composite(spark, sf_dir):
    """.35 F2 + .30 PR + .20 ROC + .15 F1."""
    return model_metrics(spark, sf_dir).select("model", "composite_score")


@register("e10_gates", f"SELECT model, gate_failures, len(gate_failures) = 0 AS passes_gates FROM ({REPORTS_SQL})")
def e10_gates(spark, sf_dir):
    """Minimum gates recall/precision/roc with failure messages."""
    return model_metrics(spark, sf_dir).select("model", "gate_failures", "passes_gates")


@register("e11_ranking", f"""
SELECT model, {R('composite_score')} AS composite_score, passes_gates,
  row_number() OVER (ORDER BY composite_score DESC, model) AS rank,
  (row_number() OVER (ORDER BY composite_score DESC, model)) = 1 AND passes_gates AS selected
FROM ({_rep_select()})""")
def e11_ranking(spark, sf_dir):
    """Ranking table; the winner is rank 1 only if it passes the gates."""
    return (M.rank_models(model_metrics(spark, sf_dir))
            .select("model", "composite_score", "passes_gates", F.col("rank").cast("bigint").alias("rank"),
                    "selected"))


@register("e12_selection", f"""
SELECT model, passes_gates AS from_passing_pool FROM ({_rep_select()})
WHERE model <> 'dummy_baseline'
ORDER BY passes_gates::INT DESC, composite_score DESC, model LIMIT 1""")
def e12_selection(spark, sf_dir):
    """Best composite among non-dummy models, passing pool first."""
    return M.select_best(model_metrics(spark, sf_dir))


@register("e14_curve_downsample", f"""
WITH roc AS ({_ROC_SQL}), n AS (SELECT count(*) AS n FROM roc),
k AS (SELECT DISTINCT CAST(floor(i * (n.n - 1)::DOUBLE / 29.0::DOUBLE) AS BIGINT) AS pos FROM range(30) r(i), n)
SELECT roc.* FROM roc, n WHERE n.n <= 30 OR roc.point_no IN (SELECT pos FROM k)""")
def e14_curve_downsample(spark, sf_dir):
    """ROC curve reduced to int(linspace(0, n-1, 30)) positions."""
    return M.downsample_curve(M.roc_curve(transactions(spark, sf_dir)), "point_no", 30)


@register("m05_dummy", f"SELECT id, y, p AS dummy_p FROM {_dummy_sql()}")
def m05_dummy(spark, sf_dir):
    """M5: stratified dummy baseline from a seeded md5 uniform (one-hot proba)."""
    return model_scores(spark, sf_dir)["dummy_baseline"].withColumnRenamed("p", "dummy_p")


@register("e04n_missing_scores", _auc_sql("p2").replace(f"FROM {TX}", f"FROM (SELECT * FROM {TX}) WHERE id % 7 <> 0", 1))
def e04n_missing_scores(spark, sf_dir):
    """E4+E5 where some scores are NULL: those rows take no part."""
    tx = transactions(spark, sf_dir)
    return M.auc_scores(tx.withColumn("p2", F.when(F.col("id") % 7 != 0, F.col("p2"))), p="p2")
