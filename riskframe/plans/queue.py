"""Investigation-queue queries.

Triage actions come from ``conversations`` (target item = conv_id, order =
turn, status text by role, notes = the message text) and from ``pages``
(HTML-bearing notes), so escaping, whitelisting, latest-action-wins and
unknown-id rejection all run on the given tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..operators import queue as Q
from ..operators import risk as RK
from ..sources.tables import card_transactions, table, transactions
from .registry import TX, R, register

T0 = P.DEFAULT_THRESHOLD


def scored(spark, sf_dir):
    return RK.assess(transactions(spark, sf_dir), with_text=False)


_PC = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, p))"
_SCORE = f"CAST(floor({_PC} * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER)"
SCORED_SQL = f"""(SELECT *, {_SCORE} AS risk_score, {_PC} >= 0.2773::DOUBLE AS is_flagged FROM {TX})"""


def _prio_sql(src: str = SCORED_SQL, cols: str = "id, risk_score, \"Amount\", is_flagged") -> str:
    s = "greatest(0, least(100, risk_score))"
    amt = 'greatest(0.0::DOUBLE, "Amount")'
    ps = (f"CAST(round_even({s}::DOUBLE * (1.0::DOUBLE + log10(greatest({amt}, 1.0::DOUBLE))) * "
          f"CASE WHEN is_flagged THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END, 0) AS INTEGER)")
    tier_idx = (f"CASE WHEN priority_score >= 350 OR ({s} >= 80 AND {amt} >= 250.0::DOUBLE) THEN 1 "
                f"WHEN priority_score >= 200 OR {s} >= 70 THEN 2 WHEN priority_score >= 100 OR {s} >= 35 THEN 3 ELSE 4 END")

    def arr(k):
        return "[" + ", ".join(f"'{t[k]}'" if isinstance(t[k], str) else str(t[k]) for t in P.PRIORITY_TIERS) + "]"

    return f"""(SELECT *, {arr(0)}[ti] AS priority_tier, {arr(1)}[ti] AS badge_class, {arr(2)}[ti] AS priority_color,
       {arr(3)}[ti] AS sla, CAST({arr(4)}[ti] AS INTEGER) AS sla_minutes
FROM (SELECT *, {tier_idx} AS ti FROM (SELECT *, {ps} AS priority_score,
        {R('1.0::DOUBLE + log10(greatest(' + amt + ', 1.0::DOUBLE))', 2)} AS exposure_factor FROM {src})))"""


PRIO_COLS = ["id", "risk_score", "Amount", "is_flagged", "priority_score", "exposure_factor",
             "priority_tier", "badge_class", "priority_color", "sla", "sla_minutes"]
PRIO_SQL_COLS = ", ".join('"Amount"' if c == "Amount" else c for c in PRIO_COLS)


@register("k01_priority", f"SELECT id, risk_score, \"Amount\", is_flagged, priority_score, exposure_factor FROM {_prio_sql()}")
def k01_priority(spark, sf_dir):
    """K1: score * (1 + log10(max(amt,1))) * (1.25 if flagged), half-even."""
    return Q.prioritise(scored(spark, sf_dir)).select(*PRIO_COLS[:6])


@register("k02_tier_sla", f"SELECT {PRIO_SQL_COLS}, ts + to_minutes(sla_minutes) AS sla_due FROM {_prio_sql()}")
def k02_tier_sla(spark, sf_dir):
    """K2: tier, badge, colour, SLA text and due time."""
    return Q.sla_due(Q.prioritise(scored(spark, sf_dir))).select(*PRIO_COLS, "sla_due")


QUEUE_SQL = f"""(SELECT *, 'PENDING_REVIEW' AS status FROM {_prio_sql(f'(SELECT * FROM {SCORED_SQL} WHERE is_flagged)')}
  ORDER BY ts DESC, id DESC LIMIT 100)"""
QUEUE_COLS = ["id", "ts", "Amount", "risk_score", "priority_score", "priority_tier", "status"]
QUEUE_SQL_COLS = ", ".join('"Amount"' if c == "Amount" else c for c in QUEUE_COLS)


def _queue(spark, sf_dir, max_items=P.QUEUE_MAX_ITEMS):
    return Q.enqueue(scored(spark, sf_dir), max_items=max_items)


@register("k03_enqueue", f"SELECT {QUEUE_SQL_COLS} FROM {QUEUE_SQL}")
def k03_enqueue(spark, sf_dir):
    """K3: flagged rows, newest first, the 100 newest kept (queue retention)."""
    return _queue(spark, sf_dir).select(*QUEUE_COLS)


def _actions(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    status = (F.when(F.col("role") == "user", F.lit(" confirmed_fraud "))
              .when(F.col("role") == "assistant", F.lit("Dismissed_False_Alarm"))
              .otherwise(F.lit("archive")))
    return conv.select(F.col("conv_id").alias("queue_id"), F.col("turn").alias("action_seq"),
                       status.alias("status_raw"), F.col("text").alias("notes_raw"))


ACTIONS_SQL = """(SELECT conv_id AS queue_id, turn AS action_seq,
  CASE WHEN role = 'user' THEN ' confirmed_fraud ' WHEN role = 'assistant' THEN 'Dismissed_False_Alarm' ELSE 'archive' END AS status_raw,
  text AS notes_raw FROM conversations)"""


def _esc_sql(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = f"replace({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    return x


CLEAN_ACTIONS_SQL = f"""(SELECT *, upper(trim(coalesce(status_raw, 'CONFIRMED_FRAUD'))) AS status,
  upper(trim(coalesce(status_raw, 'CONFIRMED_FRAUD'))) IN ({", ".join(f"'{s}'" for s in P.QUEUE_STATUSES)}) AS status_valid,
  {_esc_sql("substring(coalesce(notes_raw, ''), 1, 1000)")} AS notes FROM {ACTIONS_SQL})"""
FULL_QUEUE_SQL = f"""(SELECT *, 'PENDING_REVIEW' AS status FROM {_prio_sql(f'(SELECT * FROM {SCORED_SQL} WHERE is_flagged)')})"""


@register("k05_triage_state", f"""
WITH a AS (SELECT * FROM {CLEAN_ACTIONS_SQL} WHERE status_valid),
l AS (SELECT queue_id AS id, arg_max(status, action_seq) AS st, max(action_seq) AS updated_seq,
        arg_max(notes, CASE WHEN length(notes) > 0 THEN action_seq END) AS analyst_notes,
        count(*)::BIGINT AS n_actions FROM a GROUP BY queue_id)
SELECT q.id, coalesce(l.st, q.status) AS status, coalesce(l.updated_seq, -1)::BIGINT AS updated_seq, l.analyst_notes, coalesce(l.n_actions, 0)::BIGINT AS n_actions
FROM {FULL_QUEUE_SQL} q LEFT JOIN l ON q.id = l.id""")
def k05_triage_state(spark, sf_dir):
    """Status per queue item from its latest valid action (history kept)."""
    state, _ = Q.apply_actions(_queue(spark, sf_dir, None), _actions(spark, sf_dir))
    return state.select("id", "status", F.coalesce("updated_seq", F.lit(-1)).cast("bigint").alias("updated_seq"),
                        "analyst_notes", "n_actions")


@register("j03_rejected_actions", f"""
SELECT queue_id, action_seq, status, 'not found' AS reject_reason FROM {CLEAN_ACTIONS_SQL}
WHERE queue_id NOT IN (SELECT id FROM {FULL_QUEUE_SQL})
UNION ALL
SELECT queue_id, action_seq, status, 'invalid status' FROM {CLEAN_ACTIONS_SQL}
WHERE NOT status_valid AND queue_id IN (SELECT id FROM {FULL_QUEUE_SQL})""")
def j03_rejected_actions(spark, sf_dir):
    """Actions on unknown ids (left anti) or with a status outside the whitelist."""
    _, rejected = Q.apply_actions(_queue(spark, sf_dir, None), _actions(spark, sf_dir))
    return rejected.select("queue_id", "action_seq", "status", "reject_reason")


@register("k04_queue_view", f"""
WITH a AS (SELECT * FROM {CLEAN_ACTIONS_SQL} WHERE status_valid),
l AS (SELECT queue_id AS id, arg_max(status, action_seq) AS st FROM a GROUP BY queue_id),
s AS (SELECT q.id, q.priority_score, coalesce(l.st, q.status) AS status FROM {FULL_QUEUE_SQL} q LEFT JOIN l ON q.id = l.id)
SELECT id, coalesce(priority_score, 0) AS sort_key, status FROM s WHERE status = 'PENDING_REVIEW'""")
def k04_queue_view(spark, sf_dir):
    """K4: items still PENDING_REVIEW, sorted by priority (missing -> 0), then id."""
    state, _ = Q.apply_actions(_queue(spark, sf_dir, None), _actions(spark, sf_dir))
    view = Q.queue_view(state, status="PENDING_REVIEW")
    return view.select("id", F.coalesce("priority_score", F.lit(0)).alias("sort_key"), "status")


@register("f13_status_filter", f"""
WITH a AS (SELECT * FROM {CLEAN_ACTIONS_SQL} WHERE status_valid),
l AS (SELECT queue_id AS id, arg_max(status, action_seq) AS st FROM a GROUP BY queue_id)
SELECT q.id, l.st AS status FROM {FULL_QUEUE_SQL} q JOIN l ON q.id = l.id WHERE l.st = 'CONFIRMED_FRAUD'""")
def f13_status_filter(spark, sf_dir):
    """equality filter on the derived status."""
    state, _ = Q.apply_actions(_queue(spark, sf_dir, None), _actions(spark, sf_dir))
    return state.filter(F.col("status") == "CONFIRMED_FRAUD").select("id", "status")


@register("k06_bootstrap", f"""
SELECT id, risk_score, is_flagged, priority_score, priority_tier, 'PENDING_REVIEW' AS status, y AS true_label
FROM {_prio_sql(f'(SELECT * FROM {SCORED_SQL} WHERE is_flagged OR risk_score >= 30)')}""")
def k06_bootstrap(spark, sf_dir):
    """K6: flagged or score >= 30 rows from the labelled cohort, with the true label."""
    return Q.bootstrap(scored(spark, sf_dir)).select(
        "id", "risk_score", "is_flagged", "priority_score", "priority_tier", "status", "true_label")


@register("k07_recent_preview", f"SELECT {QUEUE_SQL_COLS} FROM {QUEUE_SQL} ORDER BY ts DESC, id DESC LIMIT 8")
def k07_recent_preview(spark, sf_dir):
    """K7: first 8 queue items (total order: newest, then id)."""
    return _queue(spark, sf_dir).select(*QUEUE_COLS).orderBy(F.col("ts").desc(), F.col("id").desc()).limit(8)


@register("k08_sla_breach", f"""
SELECT id, sla, ts + to_minutes(sla_minutes) AS sla_due,
  {R('(epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts + to_minutes(sla_minutes))) / 60000000.0::DOUBLE')} AS minutes_overdue
FROM {FULL_QUEUE_SQL}
WHERE ts + to_minutes(sla_minutes) < (SELECT max(ts) FROM events)""")
def k08_sla_breach(spark, sf_dir):
    """K8: open items past their SLA at the latest event time."""
    q = _queue(spark, sf_dir, None)
    as_of = table(spark, sf_dir, "events").agg(F.max("ts").alias("m")).select("m").scalar()
    return Q.sla_breaches(q, as_of).select("id", "sla", "sla_due", "minutes_overdue")


@register("k09_feature_map", f"""
SELECT id, k AS feature, {R('v', 3)} AS value FROM (
  SELECT e.event_id AS id, unnest(['Amount', 'Time', 'V14', 'V12', 'V10', 'V4', 'V11', 'V3']) AS k,
         unnest([e.value, (epoch_us(e.ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000.0::DOUBLE,
                 CAST(m.embedding[14] AS DOUBLE), CAST(m.embedding[12] AS DOUBLE), CAST(m.embedding[10] AS DOUBLE),
                 CAST(m.embedding[4] AS DOUBLE), CAST(m.embedding[11] AS DOUBLE), CAST(m.embedding[3] AS DOUBLE)]) AS v
  FROM events e JOIN embeddings m ON e.event_id % (SELECT count(*) FROM embeddings) = m.vec_id % (SELECT count(*) FROM embeddings))""")
def k09_feature_map(spark, sf_dir):
    """K9: eight named raw features rounded to 3 places as a map (exploded for the check)."""
    ct = Q.feature_map(card_transactions(spark, sf_dir))
    return ct.select("id", F.explode("raw_features").alias("feature", "value"))


@register("f11_escape_notes", f"""
SELECT page_id, {_esc_sql("substring(coalesce(html, ''), 1, 1000)")} AS notes,
  length(substring(coalesce(html, ''), 1, 1000)) AS raw_chars FROM pages""")
def f11_escape_notes(spark, sf_dir):
    """notes cut to 1000 characters, then HTML-escaped (& first, ' -> &#x27;)."""
    pg = table(spark, sf_dir, "pages")
    raw = F.substring(F.coalesce(F.col("html"), F.lit("")), 1, P.NOTES_MAX_CHARS)
    return pg.select("page_id", C.sanitise_notes("html").alias("notes"), F.length(raw).alias("raw_chars"))


@register("f12_status_whitelist", f"""
SELECT queue_id, action_seq, status, status_valid FROM {CLEAN_ACTIONS_SQL}""")
def f12_status_whitelist(spark, sf_dir):
    """strip + upper, then whitelist check."""
    return Q.clean_actions(_actions(spark, sf_dir)).select("queue_id", "action_seq", "status", "status_valid")
