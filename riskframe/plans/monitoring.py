"""Drift, distribution and telemetry queries.

Cohorts come from event time: reference = before 2024-01-21, live = after.
Quantile edges are rounded to 9 places on both sides of the oracle check so
last-ulp interpolation differences cannot move a row across an edge.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import sig
from ..operators import distribution as DS
from ..operators import drift as DR
from ..operators import profile as PR
from ..operators import queue as Q
from ..operators import risk as RK
from ..operators import telemetry as TL
from ..session import scratch_path
from ..sources.tables import card_transactions, transactions
from .registry import CARD, TX, R, S, register

SPLIT_TS = "2024-01-21 00:00:00"
FEATS = list(P.DRIFT_FEATURES)


def _cohorts(df: DataFrame):
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return df.filter(F.col("ts") < cut), df.filter(F.col("ts") >= cut)


def _score_long(df: DataFrame) -> DataFrame:
    return df.select(F.lit("score").alias("feature"), F.col("p").alias("value"))


# ---------------------------------------------------------------------- SQL
def _long_sql(src: str, feats: list[str], where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, \"{f}\"::DOUBLE AS value FROM {src} WHERE {where} "
        f"AND \"{f}\" IS NOT NULL AND NOT isnan(\"{f}\")" for f in feats)


REF_W = f"ts < TIMESTAMP '{SPLIT_TS}'"
LIVE_W = f"ts >= TIMESTAMP '{SPLIT_TS}'"


def _psi_sql(ref: str, live: str, lo: str, hi: str, labels=P.PSI_STATUS) -> str:
    qs = ", ".join(R(f"quantile_cont(value, {i / 10!r})", 9) for i in range(1, 10))
    return f"""
WITH ref AS ({ref}), live AS ({live}),
e AS (SELECT feature, [{qs}] AS inner_edges FROM ref GROUP BY feature),
rb AS (SELECT ref.feature, len(list_filter(e.inner_edges, lambda x: x <= ref.value)) AS bin, count(*) AS c
       FROM ref JOIN e USING (feature) WHERE ref.value >= {lo} AND ref.value <= {hi} GROUP BY ALL),
lb AS (SELECT live.feature, len(list_filter(e.inner_edges, lambda x: x <= live.value)) AS bin, count(*) AS c
       FROM live JOIN e USING (feature) WHERE live.value >= {lo} AND live.value <= {hi} GROUP BY ALL),
g AS (SELECT e.feature, b.range::INTEGER AS bin FROM e, range(10) b),
j AS (SELECT g.feature, g.bin, coalesce(rb.c, 0) AS r, coalesce(lb.c, 0) AS a FROM g
      LEFT JOIN rb ON rb.feature = g.feature AND rb.bin = g.bin LEFT JOIN lb ON lb.feature = g.feature AND lb.bin = g.bin),
t AS (SELECT feature, sum(r) AS tr, sum(a) AS ta FROM j GROUP BY feature),
s AS (SELECT j.feature, any_value(t.tr)::BIGINT AS tot_ref, any_value(t.ta)::BIGINT AS tot_live,
        sum(((j.a + 0.0001::DOUBLE) / (t.ta + 0.001::DOUBLE) - (j.r + 0.0001::DOUBLE) / (t.tr + 0.001::DOUBLE))
            * ln(((j.a + 0.0001::DOUBLE) / (t.ta + 0.001::DOUBLE)) / ((j.r + 0.0001::DOUBLE) / (t.tr + 0.001::DOUBLE)))) AS raw
      FROM j JOIN t USING (feature) GROUP BY j.feature)
SELECT feature, tot_ref, tot_live, {R('greatest(raw, 0.0::DOUBLE)', 4)} AS psi_score,
  CASE WHEN {R('greatest(raw, 0.0::DOUBLE)', 4)} < 0.10::DOUBLE THEN '{labels[0]}'
       WHEN {R('greatest(raw, 0.0::DOUBLE)', 4)} < 0.25::DOUBLE THEN '{labels[1]}' ELSE '{labels[2]}' END AS status
FROM s"""


def _ecdf_sql(ref: str, live: str) -> str:
    return f"""
WITH ref AS ({ref}), live AS ({live}),
u AS (SELECT feature, value, 1 AS r FROM ref UNION ALL SELECT feature, value, 0 FROM live),
g AS (SELECT feature, value, count(*) FILTER (WHERE r = 1) AS cr, count(*) FILTER (WHERE r = 0) AS cl FROM u GROUP BY ALL),
c AS (SELECT feature, value, sum(cr) OVER w AS fr, sum(cl) OVER w AS fl,
        lead(value) OVER (PARTITION BY feature ORDER BY value) AS nv FROM g
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT feature, sum(cr) AS nr, sum(cl) AS nl FROM g GROUP BY feature),
sd AS (SELECT feature, stddev_pop(value) AS sr FROM ref GROUP BY feature),
x AS (SELECT c.feature, c.value, c.nv, abs(c.fr::DOUBLE / t.nr - c.fl::DOUBLE / t.nl) AS gap FROM c JOIN t USING (feature))
SELECT x.feature, {S('max(gap)')} AS ks_statistic,
  {S('coalesce(sum(CASE WHEN nv IS NOT NULL THEN gap * (nv - value) END), 0.0::DOUBLE) / CASE WHEN any_value(sd.sr) > 0.000001::DOUBLE THEN any_value(sd.sr) ELSE 1.0::DOUBLE END')} AS wasserstein_distance
FROM x JOIN sd USING (feature) GROUP BY x.feature"""


SCORE_REF = f"SELECT 'score' AS feature, p AS value FROM {TX} WHERE {REF_W}"
SCORE_LIVE = f"SELECT 'score' AS feature, p AS value FROM {TX} WHERE {LIVE_W}"
FEAT_REF = _long_sql(CARD, FEATS, REF_W)
FEAT_LIVE = _long_sql(CARD, FEATS, LIVE_W)


@register("d01_psi_scores", _psi_sql(SCORE_REF, SCORE_LIVE, "-0.00001::DOUBLE", "1.00001::DOUBLE", P.PSI_STATUS_TRACKER))
def d01_psi_scores(spark, sf_dir):
    """D1+D3: score PSI, reference-quantile bins with outer edges -1e-5 / 1+1e-5."""
    ref, live = _cohorts(transactions(spark, sf_dir))
    out = DR.psi(_score_long(ref), _score_long(live), outer=(-1e-5, 1 + 1e-5), edge_digits=9,
                 status_labels=P.PSI_STATUS_TRACKER)
    return out.select("feature", "tot_ref", "tot_live", "psi_score", "status")


@register("d02_psi_features", _psi_sql(FEAT_REF, FEAT_LIVE, "'-inf'::DOUBLE", "'inf'::DOUBLE"))
def d02_psi_features(spark, sf_dir):
    """D2+D3: PSI per monitored feature with ±inf outer edges."""
    ref, live = _cohorts(card_transactions(spark, sf_dir))
    out = DR.psi(DR.to_long(ref, FEATS), DR.to_long(live, FEATS), edge_digits=9)
    return out.select("feature", "tot_ref", "tot_live", "psi_score", "status")


@register("d04_ks_wasserstein", _ecdf_sql(FEAT_REF, FEAT_LIVE), digits=None)
def d04_ks_wasserstein(spark, sf_dir):
    """D4+D6: two-sample KS statistic and standardised Wasserstein-1 per feature."""
    ref, live = _cohorts(card_transactions(spark, sf_dir))
    e = DR.ecdf_distances(DR.to_long(ref, FEATS), DR.to_long(live, FEATS))
    return e.select("feature", sig("ks_statistic").alias("ks_statistic"),
                    sig("wasserstein_distance").alias("wasserstein_distance"))


def _ks_pvalue_sql(ref: str, live: str, terms: int = 100) -> str:
    en = "sqrt(nr::DOUBLE * nl::DOUBLE / (nr + nl)::DOUBLE)"
    term = "pow(-1.0::DOUBLE, (k - 1)::DOUBLE) * exp(-2.0::DOUBLE * (k * k)::DOUBLE * lam * lam)"
    return f"""
WITH ref AS ({ref}), live AS ({live}),
u AS (SELECT feature, value, 1 AS r FROM ref UNION ALL SELECT feature, value, 0 FROM live),
g AS (SELECT feature, value, count(*) FILTER (WHERE r = 1) AS cr, count(*) FILTER (WHERE r = 0) AS cl FROM u GROUP BY ALL),
c AS (SELECT feature, value, sum(cr) OVER w AS fr, sum(cl) OVER w AS fl FROM g
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT feature, sum(cr) AS nr, sum(cl) AS nl FROM g GROUP BY feature),
k AS (SELECT c.feature, max(abs(c.fr::DOUBLE / t.nr - c.fl::DOUBLE / t.nl)) AS d, any_value(t.nr) AS nr,
        any_value(t.nl) AS nl FROM c JOIN t USING (feature) GROUP BY c.feature),
l AS (SELECT feature, d, ({en} + 0.12::DOUBLE + 0.11::DOUBLE / {en}) * d AS lam FROM k)
SELECT feature, {R('d')} AS ks_statistic,
  {R(f"CASE WHEN lam < 0.001::DOUBLE THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, 2.0::DOUBLE * "
     f"list_reduce(list_transform(range(1, {terms + 1}), lambda k: {term}), lambda a, b: a + b))) END")} AS p_value
FROM l"""


@register("d05_ks_pvalue", _ks_pvalue_sql(FEAT_REF, FEAT_LIVE))
def d05_ks_pvalue(spark, sf_dir):
    """Asymptotic KS p-value (the Kolmogorov series with the effective
    sample size; the oracle evaluates the same series in the same order)."""
    ref, live = _cohorts(card_transactions(spark, sf_dir))
    e = DR.ecdf_distances(DR.to_long(ref, FEATS), DR.to_long(live, FEATS))
    return e.select("feature", "ks_statistic",
                    DR.ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_live")).alias("p_value"))


@register("d07_feature_moments", f"""
WITH ref AS ({FEAT_REF}), live AS ({FEAT_LIVE})
SELECT r.feature, {S('r.m')} AS ref_mean, {S('r.s')} AS ref_std, {S('l.m')} AS stream_mean, {S('l.s')} AS stream_std
FROM (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM ref GROUP BY 1) r
JOIN (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM live GROUP BY 1) l USING (feature)""", digits=None)
def d07_feature_moments(spark, sf_dir):
    """Reference and live mean / population std per feature."""
    ref, live = _cohorts(card_transactions(spark, sf_dir))
    m = DR.moments(DR.to_long(ref, FEATS), DR.to_long(live, FEATS))
    return m.select("feature", *[sig(c).alias(c) for c in ("ref_mean", "ref_std", "stream_mean", "stream_std")])


@register("d08_overall_drift", f"""
SELECT CASE WHEN max(sev) = 2 THEN 'CRITICAL' WHEN max(sev) = 1 THEN 'MODERATE' ELSE 'STABLE' END AS overall_drift_status,
  count(*)::BIGINT AS monitored_feature_count
FROM (SELECT CASE status WHEN 'CRITICAL' THEN 2 WHEN 'MODERATE' THEN 1 ELSE 0 END AS sev
      FROM ({_psi_sql(FEAT_REF, FEAT_LIVE, "'-inf'::DOUBLE", "'inf'::DOUBLE")}))""")
def d08_overall_drift(spark, sf_dir):
    """Worst feature status, feature count."""
    ref, live = _cohorts(card_transactions(spark, sf_dir))
    p = DR.psi(DR.to_long(ref, FEATS), DR.to_long(live, FEATS), edge_digits=9)
    return DR.overall_status(p)


@register("d09_feature_filter", f"""
SELECT feature, count(*)::BIGINT AS n_values FROM ({_long_sql(CARD, FEATS, 'true')})
GROUP BY feature HAVING count(*) >= 3""")
def d09_feature_filter(spark, sf_dir):
    """Monitored features present (absent names skipped) with at least 3 values."""
    ct = card_transactions(spark, sf_dir)
    long = DR.to_long(ct, FEATS + ["NotAColumn"], min_values=3)
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))


@register("d10_flatten_records", f"""
SELECT id, {R('"V14"', 3)} AS "V14", {R('"Amount"', 3)} AS "Amount", NULL::DOUBLE AS "V99" FROM {CARD}""")
def d10_flatten_records(spark, sf_dir):
    """Nested raw_features map -> columns; absent keys stay NULL (no invented defaults)."""
    ct = Q.feature_map(card_transactions(spark, sf_dir))
    return DR.flatten_map(ct.select("id", "raw_features"), "raw_features", ["V14", "Amount", "V99"]).drop("raw_features")


# ------------------------------------------------------------- distributions
SCORES_SQL = f"(SELECT id, ts, p, CAST(floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS risk_score FROM {TX})"


def _scores(spark, sf_dir):
    return RK.assess(transactions(spark, sf_dir), with_text=False)


_PERCENTILES_SQL = """
SELECT name, prob, CAST(trunc(v) AS INTEGER) AS value FROM (
  SELECT unnest(['p10', 'p25', 'p50', 'p75', 'p90', 'p95', 'p99', 'p99_9']) AS name,
         unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999]::DOUBLE[]) AS prob,
         unnest(quantile_cont(risk_score, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999])) AS v
  FROM {src})"""


@register("b01_percentiles", _PERCENTILES_SQL.format(src=SCORES_SQL))
def b01_percentiles(spark, sf_dir):
    """B1: p10 ... p99.9 of the integer scores (linear interpolation, truncated)."""
    return DS.score_percentiles(_scores(spark, sf_dir))


def _hist_sql(expr: str, edges, labels, src: str) -> str:
    inner = "[" + ", ".join(f"{float(e)!r}::DOUBLE" for e in edges[1:-1]) + "]"
    lab = "[" + ", ".join(f"'{x}'" for x in labels) + "]"
    n = len(labels)
    return f"""
WITH b AS (SELECT least(len(list_filter({inner}, lambda e: e <= {expr})), {n - 1}) AS bin FROM {src}
           WHERE {expr} >= {float(edges[0])!r}::DOUBLE AND {expr} <= {float(edges[-1])!r}::DOUBLE),
c AS (SELECT bin, count(*) AS c FROM b GROUP BY bin), t AS (SELECT sum(c) AS t FROM c)
SELECT r.range::INTEGER AS bin, {lab}[r.range + 1] AS label, coalesce(c.c, 0)::BIGINT AS count,
  coalesce({R('coalesce(c.c, 0)::DOUBLE / t.t * 100.0::DOUBLE', 2)}, 0.0::DOUBLE) AS pct
FROM range({n}) r LEFT JOIN c ON c.bin = r.range, t"""


@register("b02_score_histogram", _hist_sql("risk_score::DOUBLE", P.SCORE_HIST_EDGES,
                                           [f"{P.SCORE_HIST_EDGES[i]}-{P.SCORE_HIST_EDGES[i + 1] - 1}" for i in range(10)],
                                           SCORES_SQL))
def b02_score_histogram(spark, sf_dir):
    """B2: score histogram on 0,10,...,90,101 (last bin closed), empty bins kept."""
    return DS.score_histogram(_scores(spark, sf_dir))


@register("b03_ecdf", f"""
SELECT x AS score_threshold, {R('count(*) FILTER (WHERE risk_score <= x)::DOUBLE / count(*) * 100.0::DOUBLE', 2)} AS cumulative_pct
FROM {SCORES_SQL}, (SELECT range::INTEGER AS x FROM range(0, 101, 5)) GROUP BY x""")
def b03_ecdf(spark, sf_dir):
    """% of scores <= x at x = 0, 5, ..., 100."""
    return DS.score_ecdf(_scores(spark, sf_dir))


@register("b04_category_summary", f"""
SELECT category, count, {R('count::DOUBLE / n * 100.0::DOUBLE', 2)} AS pct FROM (
  SELECT unnest(['low', 'medium', 'high']) AS category,
         unnest([count(*) FILTER (WHERE risk_score <= 30), count(*) FILTER (WHERE risk_score BETWEEN 31 AND 70),
                 count(*) FILTER (WHERE risk_score >= 71)])::BIGINT AS count, count(*) AS n FROM {SCORES_SQL})""")
def b04_category_summary(spark, sf_dir):
    """Low / medium / high counts and shares."""
    return DS.category_summary(_scores(spark, sf_dir))


B5_EDGES = [i * 0.1 for i in range(10)] + [1.0]


@register("b05_prob_histogram", _hist_sql("p", B5_EDGES, [f"{i * 10}-{(i + 1) * 10}%" for i in range(10)], TX))
def b05_prob_histogram(spark, sf_dir):
    """Probability histogram on exact linspace(0, 1, 11) edges."""
    return DS.probability_histogram(transactions(spark, sf_dir))


# ------------------------------------------------------------------ telemetry
def _log(spark, sf_dir):
    return TL.transaction_log(_scores(spark, sf_dir))


LOG_SQL = f"(SELECT * FROM {SCORES_SQL})"


def _window_sql(n: int) -> str:
    return f"(SELECT * FROM {SCORES_SQL} ORDER BY ts DESC, id DESC LIMIT {n})"


@register("l02_buffer", f"SELECT id, ts, risk_score FROM {_window_sql(P.LOG_MAX_ITEMS)}")
def l02_buffer(spark, sf_dir):
    """L2: retention of the newest 2000 log rows (a top-N over the log)."""
    return TL.newest(_log(spark, sf_dir), P.LOG_MAX_ITEMS).select("id", "ts", "risk_score")


def _rolling_sql(n: int) -> str:
    w = _window_sql(n)
    return f"""
SELECT (SELECT count(*) FROM {SCORES_SQL})::BIGINT AS total_processed, count(*)::BIGINT AS recent_window_size,
  count(*) FILTER (WHERE p >= 0.2773::DOUBLE)::BIGINT AS suspected_fraud_count,
  count(*) FILTER (WHERE risk_score > 70)::BIGINT AS high_risk_count,
  count(*) FILTER (WHERE risk_score BETWEEN 31 AND 70)::BIGINT AS medium_risk_count,
  count(*) FILTER (WHERE risk_score <= 30)::BIGINT AS low_risk_count,
  coalesce({R('count(*) FILTER (WHERE p >= 0.2773::DOUBLE)::DOUBLE / count(*) * 100.0::DOUBLE', 2)}, 0.0::DOUBLE) AS fraud_rate_pct
FROM {w}"""


@register("l03_rolling_telemetry", _rolling_sql(P.TELEMETRY_WINDOW))
def l03_rolling_telemetry(spark, sf_dir):
    """L3: newest 500 rows: category counts, flagged count, fraud rate %."""
    return TL.rolling_summary(_log(spark, sf_dir), P.TELEMETRY_WINDOW)


@register("l03b_rolling_histogram", _hist_sql("p", B5_EDGES, [f"{i * 10}-{(i + 1) * 10}%" for i in range(10)],
                                              _window_sql(P.TELEMETRY_WINDOW)))
def l03b_rolling_histogram(spark, sf_dir):
    """L3: probability histogram of the newest 500 rows."""
    return DS.probability_histogram(TL.newest(_log(spark, sf_dir), P.TELEMETRY_WINDOW))


@register("l03c_rolling_psi", _psi_sql(SCORE_REF, f"SELECT 'score' AS feature, p AS value FROM {_window_sql(P.TELEMETRY_WINDOW)}",
                                       "-0.00001::DOUBLE", "1.00001::DOUBLE", P.PSI_STATUS_TRACKER))
def l03c_rolling_psi(spark, sf_dir):
    """L3: PSI of the newest 500 scores against the reference cohort."""
    log = _log(spark, sf_dir)
    ref, _ = _cohorts(log)
    live = TL.newest(log, P.TELEMETRY_WINDOW)
    out = DR.psi(_score_long(ref), _score_long(live), outer=(-1e-5, 1 + 1e-5), edge_digits=9,
                 status_labels=P.PSI_STATUS_TRACKER, min_rows=5)
    return out.select("feature", "tot_ref", "tot_live", "psi_score", "status")


@register("l05_rolling_drift", _psi_sql(FEAT_REF, _long_sql(f"(SELECT * FROM {CARD} ORDER BY ts DESC, id DESC LIMIT 250)", FEATS, "true"),
                                        "'-inf'::DOUBLE", "'inf'::DOUBLE"))
def l05_rolling_drift(spark, sf_dir):
    """Feature PSI of the newest 250 rows against the reference cohort."""
    ct = card_transactions(spark, sf_dir)
    ref, _ = _cohorts(ct)
    live = TL.newest(ct, P.DRIFT_WINDOW)
    out = DR.psi(DR.to_long(ref, FEATS), DR.to_long(live, FEATS, min_values=3), edge_digits=9)
    return out.select("feature", "tot_ref", "tot_live", "psi_score", "status")


@register("l05_profile_drift", f"""
WITH psi AS ({_psi_sql(FEAT_REF, _long_sql(f"(SELECT * FROM {CARD} ORDER BY ts DESC, id DESC LIMIT 250)", FEATS, "true"), "'-inf'::DOUBLE", "'inf'::DOUBLE")}),
far AS ({_ecdf_sql(FEAT_REF, _long_sql(f"(SELECT * FROM {CARD} ORDER BY ts DESC, id DESC LIMIT 250)", FEATS, "true"))}),
r AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM ({FEAT_REF}) GROUP BY 1),
l AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s
      FROM ({_long_sql(f"(SELECT * FROM {CARD} ORDER BY ts DESC, id DESC LIMIT 250)", FEATS, "true")}) GROUP BY 1)
SELECT psi.*, ks_statistic, wasserstein_distance, {S('r.m')} AS ref_mean, {S('r.s')} AS ref_std, {S('l.m')} AS stream_mean, {S('l.s')} AS stream_std
FROM psi JOIN far USING (feature) JOIN r USING (feature) JOIN l USING (feature)""", digits=None)
def l05_profile_drift(spark, sf_dir):
    """The newest 250 rows against the stored profile of the reference cohort: all drift figures per feature."""
    ct = card_transactions(spark, sf_dir)
    root = scratch_path(spark, f"profile/{uuid.uuid4().hex[:12]}")
    PR.save_profile(_cohorts(ct)[0], root, 1, FEATS, edge_digits=9)
    out = PR.profile_drift(TL.newest(ct, P.DRIFT_WINDOW), root)
    return out.select("feature", "tot_ref", "tot_live", "psi_score", "status",
                      *[sig(c).alias(c) for c in ("ks_statistic", "wasserstein_distance", "ref_mean", "ref_std", "stream_mean", "stream_std")])


def _exact_ks_sql(ref: str, live: str) -> str:
    """The share of lattice paths that reach the statistic, walked step by step."""
    return f"""
WITH RECURSIVE ref AS ({ref}), live AS ({live}),
u AS (SELECT feature, value, 1 AS r FROM ref UNION ALL SELECT feature, value, 0 FROM live),
g AS (SELECT feature, value, count(*) FILTER (WHERE r = 1) AS cr, count(*) FILTER (WHERE r = 0) AS cl FROM u GROUP BY ALL),
c AS (SELECT feature, sum(cr) OVER w AS fr, sum(cl) OVER w AS fl FROM g
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT feature, sum(cr)::BIGINT AS n, sum(cl)::BIGINT AS m FROM g GROUP BY feature),
k AS (SELECT feature, any_value(n) AS n, any_value(m) AS m, max(abs(fr * m - fl * n))::BIGINT AS reach FROM c JOIN t USING (feature) GROUP BY feature),
walk(feature, s, x, p) AS (
  SELECT feature, 0::BIGINT, 0::BIGINT, 1.0::DOUBLE FROM k
  UNION ALL
  SELECT feature, s, x, sum(p) FROM (
    SELECT w.feature, w.s + 1 AS s, w.x + d.dx AS x, k.n, k.m, k.reach,
      w.p * CASE WHEN d.dx = 1 THEN k.n - w.x ELSE k.m - (w.s - w.x) END / (k.n + k.m - w.s) AS p
    FROM walk w JOIN k USING (feature), (VALUES (0), (1)) d(dx) WHERE w.s < k.n + k.m)
  WHERE p > 0 AND abs(x * m - (s - x) * n) < reach GROUP BY feature, s, x)
SELECT k.feature, {R('k.reach::DOUBLE / (k.n * k.m)')} AS ks_statistic, {R('1.0::DOUBLE - coalesce(w.p, 0.0::DOUBLE)')} AS p_value
FROM k LEFT JOIN walk w ON w.feature = k.feature AND w.s = k.n + k.m"""


def _window_of(first: int, last: int) -> str:
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, id DESC) AS rn FROM {CARD}) WHERE rn > {first} AND rn <= {last})")


@register("d05_ks_exact", _exact_ks_sql(_long_sql(_window_of(250, 750), FEATS, "true"), _long_sql(_window_of(0, 250), FEATS, "true")))
def d05_ks_exact(spark, sf_dir):
    """Exact p-values of the newest 250 rows against the 500 before them."""
    newest = TL.newest(card_transactions(spark, sf_dir), 750)
    live = TL.newest(newest, P.DRIFT_WINDOW)
    ref = newest.join(live.select("id"), "id", "left_anti")
    e = DR.ecdf_distances(DR.to_long(ref, FEATS), DR.to_long(live, FEATS))
    return e.select("feature", "ks_statistic", DR.ks_two_sample_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_live")).alias("p_value"))


@register("l06_history_distribution", f"""
SELECT category, count, {R('count::DOUBLE / n * 100.0::DOUBLE', 2)} AS pct FROM (
  SELECT unnest(['low', 'medium', 'high']) AS category,
         unnest([count(*) FILTER (WHERE risk_score <= 30), count(*) FILTER (WHERE risk_score BETWEEN 31 AND 70),
                 count(*) FILTER (WHERE risk_score >= 71)])::BIGINT AS count, count(*) AS n FROM {_window_sql(P.LOG_MAX_ITEMS)})""")
def l06_history_distribution(spark, sf_dir):
    """Category distribution over the buffered (newest 2000) scores."""
    return DS.category_summary(TL.newest(_log(spark, sf_dir), P.LOG_MAX_ITEMS))


_BUFFERED = _window_sql(P.LOG_MAX_ITEMS)


def _buffered(spark, sf_dir):
    return TL.newest(_log(spark, sf_dir), P.LOG_MAX_ITEMS)


@register("l06_percentiles", _PERCENTILES_SQL.format(src=_BUFFERED))
def l06_percentiles(spark, sf_dir):
    """Percentiles of the buffered scores."""
    return DS.score_percentiles(_buffered(spark, sf_dir)).select("name", "prob", "value")


@register("l06_histogram", _hist_sql("risk_score::DOUBLE", P.SCORE_HIST_EDGES,
                                     [f"{P.SCORE_HIST_EDGES[i]}-{P.SCORE_HIST_EDGES[i + 1] - 1}" for i in range(10)], _BUFFERED))
def l06_histogram(spark, sf_dir):
    """Histogram of the buffered scores."""
    return DS.score_histogram(_buffered(spark, sf_dir))


@register("l06_ecdf", f"""
SELECT x AS score_threshold, {R('count(*) FILTER (WHERE risk_score <= x)::DOUBLE / count(*) * 100.0::DOUBLE', 2)} AS cumulative_pct
FROM {_BUFFERED}, (SELECT range::INTEGER AS x FROM range(0, 101, 5)) GROUP BY x""")
def l06_ecdf(spark, sf_dir):
    """Empirical distribution of the buffered scores."""
    return DS.score_ecdf(_buffered(spark, sf_dir))


def _kpis_sql() -> str:
    from .evaluation import _report_sql
    rep = _report_sql("value_ratio", f"(SELECT id, y, p FROM {TX})", "0.2773::DOUBLE")
    pct = lambda c: R(f"{c} * 100.0::DOUBLE", 2)
    return f"""
WITH roll AS ({_rolling_sql(P.TELEMETRY_WINDOW)}), rep AS (SELECT * FROM {rep})
SELECT total_processed, suspected_fraud_count, high_risk_count, fraud_rate_pct, {pct('precision')} AS model_precision,
  {pct('recall')} AS model_recall, {R('f2_score', 4)} AS model_f2, {R('pr_auc', 4)} AS model_pr_auc, {R('roc_auc', 4)} AS model_roc_auc,
  {pct('specificity')} AS model_specificity, {R('threshold', 4)} AS operating_threshold, n_samples::BIGINT AS test_sample_count
FROM roll, rep"""


@register("l04_kpis", _kpis_sql())
def l04_kpis(spark, sf_dir):
    """L4: the ten KPIs of the overview with the operating threshold (its preview is k07)."""
    from ..operators import metrics as M
    rep = M.metrics_report(transactions(spark, sf_dir), threshold=P.DEFAULT_THRESHOLD)
    pct = lambda c: C.rnd(F.col(c) * 100.0, 2).alias(f"model_{c}")
    rep = rep.select(pct("precision"), pct("recall"), C.rnd("f2_score", 4).alias("model_f2"), C.rnd("pr_auc", 4).alias("model_pr_auc"),
                     C.rnd("roc_auc", 4).alias("model_roc_auc"), pct("specificity"), C.rnd("threshold", 4).alias("operating_threshold"),
                     F.col("n_samples").alias("test_sample_count")).first()  # one row of figures
    roll = TL.rolling_summary(_log(spark, sf_dir), P.TELEMETRY_WINDOW)
    return roll.select("total_processed", "suspected_fraud_count", "high_risk_count", "fraud_rate_pct",
                       *[F.lit(v).alias(k) for k, v in rep.asDict().items()])


@register("l07_empty_state", f"""
SELECT (SELECT count(*) FROM {SCORES_SQL} WHERE ts > TIMESTAMP '2100-01-01')::BIGINT AS total_processed,
  0::BIGINT AS recent_window_size, 0::BIGINT AS suspected_fraud_count, 0::BIGINT AS high_risk_count,
  0::BIGINT AS medium_risk_count, 0::BIGINT AS low_risk_count, 0.0::DOUBLE AS fraud_rate_pct""")
def l07_empty_state(spark, sf_dir):
    """Telemetry of an empty log: zero counts, 0.0 rate, nothing invented."""
    log = _log(spark, sf_dir).filter(F.col("ts") > F.lit("2100-01-01").cast("timestamp_ntz"))
    return TL.rolling_summary(log, P.TELEMETRY_WINDOW)


@register("l04_overview", f"""
WITH roll AS ({_rolling_sql(P.TELEMETRY_WINDOW)}),
g AS (SELECT p::DOUBLE AS score, sum(y)::BIGINT AS pos, count(*)::BIGINT AS n FROM {TX} GROUP BY 1),
c AS (SELECT score, pos, n - pos AS neg,
        sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(n - pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM g),
t AS (SELECT sum(pos) AS "P", sum(neg) AS "N" FROM c),
a AS (SELECT {R('sum(neg * (2 * (tp - pos) + pos))::DOUBLE / (2.0::DOUBLE * any_value(t."P") * any_value(t."N"))')} AS roc_auc FROM c, t)
SELECT roll.total_processed, roll.suspected_fraud_count, roll.fraud_rate_pct, a.roc_auc,
  (SELECT count(*) FROM {SCORES_SQL} WHERE p >= 0.2773::DOUBLE)::BIGINT AS queue_candidates
FROM roll, a""")
def l04_overview(spark, sf_dir):
    """L4: KPI row combining rolling telemetry, the score's ROC-AUC and the queue size."""
    from ..operators import metrics as M
    log = _log(spark, sf_dir)
    roll = TL.rolling_summary(log, P.TELEMETRY_WINDOW)
    auc = M.auc_scores(transactions(spark, sf_dir))
    queue = log.agg(F.count_if(F.col("is_flagged")).cast("bigint").alias("n"))
    return roll.select("total_processed", "suspected_fraud_count", "fraud_rate_pct",
                       auc.select("roc_auc").scalar().alias("roc_auc"),
                       queue.select("n").scalar().alias("queue_candidates"))
