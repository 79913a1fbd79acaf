"""Streaming queries (L1, L8-L10, W7): each drains a file stream of the given
table (``availableNow``) and returns the sink table; the oracle is the batch
SQL of the same computation (stream == batch). Where order of arrival matters, the
table's rows arrive in four parts, and the stream is restarted for each."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import map_events, table
from ..streaming import live as LV
from ..streaming import queries as SQ
from .registry import TX, R, register
from .velocity import WINDOWS, _w12_sql

_PC = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, p))"


def _events(spark, sf_dir, copies: int = 1):
    s = SQ.event_stream(spark, f"{sf_dir}/events.parquet")
    for _ in range(copies - 1):
        s = s.unionByName(SQ.event_stream(spark, f"{sf_dir}/events.parquet"))
    return s


@register("l01_record_stream", f"""
SELECT id, ts, "Amount", {R(_PC)} AS probability,
  CAST(floor({_PC} * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS risk_score,
  {_PC} >= 0.2773::DOUBLE AS is_flagged FROM {TX}""")
def l01_record_stream(spark, sf_dir):
    """L1: every streamed transaction scored and appended to the log (idempotent per batch)."""
    rec = SQ.record_stream(_events(spark, sf_dir))
    out = SQ.run_available(spark, rec, "l01")
    return out.select("id", "ts", "Amount", "probability", "risk_score", "is_flagged")


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, f"stream/{name}-{uuid.uuid4().hex[:12]}")


def _tx_stream(spark, path: str, p=None):
    ev = map_events(SQ.file_stream(spark, path, SQ.EVENTS_SCHEMA))
    ev = ev if p is None else ev.withColumn("p", p)
    return ev.withColumn("ts_event", F.col("ts").cast("timestamp"))


def _arrive(spark, sf_dir, name: str, delay_us, drain) -> str:
    """Writes ``events`` in PARTS parts by the time of arrival (event time plus
    ``delay_us``) and calls ``drain(stream)`` after each: a stream that is stopped and
    started again. Returns the run's folder."""
    root = _run_dir(spark, name)
    ev = table(spark, sf_dir, "events")
    arrives = F.unix_micros(F.col("ts").cast("timestamp")) + delay_us
    part = F.least(F.lit(PARTS - 1), F.floor((arrives - F.lit(T0_US)) / F.lit(PART_US)))
    for k in range(PARTS):
        ev.where(part == k).write.mode("append").parquet(f"{root}/in")
        drain(_tx_stream(spark, f"{root}/in"), root)
    return root


# Arrival of the events: parts of eight days; the time base of sources.tables.EPOCH.
PARTS, PART_US, T0_US = 4, 8 * 24 * LV.HOUR_US, 1_704_067_200_000_000


# ------------------------------------------------------------------ L1: the live chain
def _bad_p():
    k = F.col("id") % 97
    return (F.when(k == 3, F.lit(None).cast("double")).when(k == 5, F.lit(float("nan")))
            .when(k == 7, F.col("p") + 1.0).otherwise(F.col("p")))


_LIVE = f"""(SELECT *, CASE WHEN id % 97 = 3 OR id % 97 = 5 THEN 'probability must be numeric'
    WHEN id % 97 = 7 AND p + 1.0::DOUBLE > 1 THEN 'probability must lie in [0, 1]' END AS reject_reason,
  CASE WHEN id % 97 = 7 THEN p + 1.0::DOUBLE ELSE p END AS live_p FROM {TX})"""


def _chain(spark, sf_dir):
    """The record chain over ``events`` with some unusable scores."""
    ledger = LV.Ledger(spark, _run_dir(spark, "l01"))
    LV.start(_tx_stream(spark, f"{sf_dir}/events.parquet", _bad_p()), LV.record_chain(ledger), f"{ledger.root}/checkpoint")
    return ledger


@register("l01_live_log", f"""
SELECT id, ts, "Amount", {R('live_p')} AS probability, CAST(floor(live_p * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS risk_score,
  live_p >= 0.2773::DOUBLE AS is_flagged, true AS stamped FROM {_LIVE} WHERE reject_reason IS NULL""")
def l01_live_log(spark, sf_dir):
    """L1: the log that the live chain keeps: every record with a usable score, stamped."""
    return _chain(spark, sf_dir).read("log").select(
        "id", "ts", "Amount", "probability", "risk_score", "is_flagged", F.col("logged_at").isNotNull().alias("stamped"))


def _live_queue_sql() -> str:
    from .queue import _prio_sql
    src = f"""(SELECT id, ts, "Amount", live_p >= 0.2773::DOUBLE AS is_flagged,
      CAST(floor(live_p * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS risk_score FROM {_LIVE}
      WHERE reject_reason IS NULL AND live_p >= 0.2773::DOUBLE)"""
    return f"SELECT id, risk_score, priority_score, priority_tier, sla_minutes, 'PENDING_REVIEW' AS status FROM {_prio_sql(src)}"


@register("l01_live_queue", _live_queue_sql())
def l01_live_queue(spark, sf_dir):
    """L1: the queue items that the live chain added, with their priority."""
    return _chain(spark, sf_dir).read("queue").select("id", "risk_score", "priority_score", "priority_tier", "sla_minutes", "status")


@register("l01_live_quarantine", f"SELECT id, reject_reason FROM {_LIVE} WHERE reject_reason IS NOT NULL")
def l01_live_quarantine(spark, sf_dir):
    """L1: the records that the live chain refused, with the reason."""
    return _chain(spark, sf_dir).read("quarantine").select("id", "reject_reason")


# ------------------------------------------------------------------ L8: windows that close
# A tenth of the events arrives three days late, the others within the hour.
def _lateness():
    return F.when(F.col("event_id") % 10 == 0, F.lit(72 * LV.HOUR_US)).otherwise(F.col("event_id") % 60 * F.lit(60_000_000))


_ARRIVALS = f"""
WITH e AS (SELECT *, epoch_us(date_trunc('day', ts)) + 86400000000 AS closes_us, epoch_us(ts) AS us,
    least({PARTS - 1}, (epoch_us(ts) + CASE WHEN id % 10 = 0 THEN {72 * LV.HOUR_US} ELSE id % 60 * 60000000 END - {T0_US}) // {PART_US}) AS part
  FROM {TX}),
marks AS (SELECT part, max(max(us)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LV.HOUR_US} AS mark
  FROM e GROUP BY part),
placed AS (SELECT e.*, coalesce(closes_us <= mark, false) AS late FROM e JOIN marks USING (part))"""


def _windows(spark, sf_dir):
    ledgers = []

    def drain(stream, root):
        ledgers.append(LV.Ledger(spark, f"{root}/tables"))
        LV.start(stream, LV.closing_windows(ledgers[-1]), f"{root}/checkpoint")

    _arrive(spark, sf_dir, "l08", _lateness(), drain)
    return ledgers[-1]


@register("l08_closed_windows", f"""{_ARRIVALS}
SELECT to_timestamp(closes_us / 1000000 - 86400)::TIMESTAMP AS window_start, count(*)::BIGINT AS n,
  count(*) FILTER (WHERE {_PC} >= 0.2773::DOUBLE)::BIGINT AS flagged, {R('sum("Amount"::DECIMAL(18,2))::DOUBLE', 2)} AS dollars,
  closes_us <= (SELECT max(us) FROM e) - {LV.HOUR_US} AS final
FROM placed WHERE NOT late GROUP BY closes_us""")
def l08_closed_windows(spark, sf_dir):
    """Daily windows from events out of order: each written once when the watermark passes its end."""
    return LV.all_windows(_windows(spark, sf_dir)).select("window_start", "n", "flagged", F.col("dollars").cast("double").alias("dollars"),
                                                          "final")


@register("l08_late_rows", f"{_ARRIVALS} SELECT id, ts, 'window closed' AS reason FROM placed WHERE late")
def l08_late_rows(spark, sf_dir):
    """The events that came after their window had closed."""
    return _windows(spark, sf_dir).read("late").select("id", "ts", "reason")


@register("l08_accounting", f"""{_ARRIVALS}
SELECT count(*)::BIGINT AS n_in, count(*) FILTER (WHERE late)::BIGINT AS n_late, count(*) FILTER (WHERE NOT late)::BIGINT AS n_windows
FROM placed""")
def l08_accounting(spark, sf_dir):
    """Every event is in a window or among the late ones."""
    ledger = _windows(spark, sf_dir)
    late = ledger.read("late").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    held = LV.all_windows(ledger).agg(F.sum("n").alias("n")).select("n").scalar()
    return ledger.manifests().agg(F.sum("n_in").alias("n_in")).select("n_in", late.alias("n_late"), held.alias("n_windows"))


@register("l08_tumbling_telemetry", f"""
SELECT date_trunc('day', ts) AS window_start, count(*)::BIGINT AS n,
  count(*) FILTER (WHERE {_PC} >= 0.2773::DOUBLE)::BIGINT AS flagged,
  {R('sum("Amount"::DECIMAL(18,2))::DOUBLE', 2)} AS dollars FROM {TX} GROUP BY 1""")
def l08_tumbling_telemetry(spark, sf_dir):
    """Daily event-time windows of counts, flags and dollars from the stream."""
    ledger = LV.Ledger(spark, _run_dir(spark, "l08t"))
    LV.start(_events(spark, sf_dir), LV.closing_windows(ledger), f"{ledger.root}/checkpoint")
    return LV.all_windows(ledger).select("window_start", "n", "flagged", F.col("dollars").cast("double").alias("dollars"))


@register("l09_dedup_stream", f"""SELECT DISTINCT id, "Amount" FROM {TX}""")
def l09_dedup_stream(spark, sf_dir):
    """The events stream submitted twice; resubmitted ids dropped within the watermark."""
    dd = SQ.dedup_resubmitted(_events(spark, sf_dir, copies=2))
    out = SQ.run_available(spark, dd.select("id", "Amount"), "l09")
    return out.select("id", "Amount")


@register("l10_queue_state_stream", """
WITH a AS (SELECT conv_id AS queue_id, turn AS action_seq,
  upper(trim(CASE WHEN role = 'user' THEN ' confirmed_fraud ' WHEN role = 'assistant' THEN 'Dismissed_False_Alarm' ELSE 'archive' END)) AS status
  FROM conversations)
SELECT queue_id, arg_max(status, action_seq) AS status, max(action_seq) AS updated_seq, count(*)::BIGINT AS n_actions
FROM a WHERE status IN ('PENDING_REVIEW', 'CONFIRMED_FRAUD', 'DISMISSED_FALSE_ALARM', 'ESCALATED_TIER_2')
GROUP BY queue_id""")
def l10_queue_state_stream(spark, sf_dir):
    """Queue status per item: one value of state each, the changed ones written per batch."""
    ledger = LV.Ledger(spark, _run_dir(spark, "l10"))
    acts = SQ.action_stream(spark, f"{sf_dir}/conversations.parquet")
    LV.start(LV.queue_states(acts), LV.state_changes(ledger), f"{ledger.root}/checkpoint", mode="update")
    return LV.current_states(ledger).select("queue_id", "status", "updated_seq", "n_actions")


@register("w07_event_velocity", _w12_sql())
def w07_event_velocity(spark, sf_dir):
    """The features of w01 for each event of a stream out of order, emitted as it is complete."""
    ledgers = []

    def drain(stream, root):
        ledgers.append(LV.Ledger(spark, f"{root}/tables"))
        features = LV.event_velocity(stream, WINDOWS)
        LV.start(features, LV.keep_rows(ledgers[-1], "features"), f"{root}/checkpoint")

    root = _arrive(spark, sf_dir, "w07", F.col("event_id") % 60 * F.lit(60_000_000), drain)
    # a heartbeat long after the last event: all of them are complete
    table(spark, sf_dir, "events").agg(
        F.lit(None).cast("long").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("user_id", "long"), ("event_type", "string"), ("value", "double"), ("props", "string"))]
    ).write.mode("append").parquet(f"{root}/in")
    drain(_tx_stream(spark, f"{root}/in"), root)
    out = ledgers[-1].read("features")
    return out.select("id", *[c for n in WINDOWS for c in (
        F.col(f"{n}_count"), (F.col(f"{n}_units").cast("decimal(30,0)") / LV.UNIT).cast("double").alias(f"{n}_sum"))])


@register("w07_streaming_velocity", f"""
WITH e AS (SELECT entity, ts, "Amount", time_bucket(INTERVAL 15 MINUTE, ts) AS b FROM {TX}),
w AS (SELECT entity, b - to_minutes(15 * k) AS window_start, "Amount" FROM e, range(4) r(k))
SELECT entity, window_start, count(*)::BIGINT AS n, {R('sum("Amount"::DECIMAL(18,2))::DOUBLE', 2)} AS amount
FROM w GROUP BY entity, window_start""")
def w07_streaming_velocity(spark, sf_dir):
    """Per-user 1-hour windows sliding every 15 minutes, from the stream."""
    ledger = LV.Ledger(spark, _run_dir(spark, "w07"))
    LV.start(SQ.streaming_velocity(_events(spark, sf_dir)), LV.keep_rows(ledger, "windows"), f"{ledger.root}/checkpoint", mode="update")
    out = LV.newest_rows(ledger, "windows", ["entity", "window_start"])
    return out.select("entity", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n",
                      F.col("amount").cast("double").alias("amount"))
