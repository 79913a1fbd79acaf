"""Investigation queue: priority, tiers, enqueue, triage actions, views.

The queue's state is not a rewritten file: it is the scored, flagged rows plus
an append-only ``actions`` table; the current status of an item is derived
from its latest valid action (so history is kept and replays are idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit


def prioritise(df: DataFrame, score: str = "risk_score", amount: str = "Amount",
               flagged: str = "is_flagged") -> DataFrame:
    """K1+K2: priority score (half-even rounding), exposure factor, tier, badge, SLA."""
    prio = C.priority_score(score, amount, flagged)
    out = df.withColumns({"priority_score": prio,
                          "exposure_factor": C.rnd(C.exposure_factor(amount), 2)})
    return out.withColumns(C.priority_fields(score, amount, F.col("priority_score")))


def sla_due(df: DataFrame, ts: str = "ts") -> DataFrame:
    """K2: due time = enqueue time + SLA."""
    return df.withColumn("sla_due", F.col(ts) + F.make_dt_interval(mins=F.col("sla_minutes")))


def enqueue(scored: DataFrame, ts: str = "ts", key: str = "id",
            max_items: int | None = P.QUEUE_MAX_ITEMS) -> DataFrame:
    """K3: flagged rows only, newest first; keep the ``max_items`` newest.

    The cap is the queue's defined retention (a top-N report): a
    ``TakeOrderedAndProject`` keeps N rows per partition, never a full sort.
    ``max_items=None`` keeps every flagged row.
    """
    q = prioritise(scored.filter(F.col("is_flagged"))).withColumn("status", F.lit(P.INITIAL_QUEUE_STATUS))
    if max_items is None:
        return q
    return q.orderBy(F.col(ts).desc(), F.col(key).desc()).limit(max_items)


def clean_actions(actions: DataFrame, status: str = "status_raw", notes: str = "notes_raw") -> DataFrame:
    """normalise status (strip/upper, default CONFIRMED_FRAUD), check the
    whitelist, cut notes to 1000 characters and HTML-escape them."""
    st = C.normalise_status(status)
    return actions.withColumns({
        "status": st,
        "status_valid": st.isin(*P.QUEUE_STATUSES),
        "notes": C.sanitise_notes(notes),
    })


def apply_actions(queue: DataFrame, actions: DataFrame, key: str = "id",
                  target: str = "queue_id", seq: str = "action_seq") -> tuple[DataFrame, DataFrame]:
    """Current queue state from the latest valid action per item.

    Returns (queue with status / updated_seq / analyst_notes, rejected actions).
    Notes only change when the action carries non-empty notes. Actions for
    unknown ids are rejected (left anti join), as are invalid statuses.
    The per-id reduction is a ``max_by`` aggregate with map-side combine, so
    a hot item does not gather its actions in one task.
    """
    acts = clean_actions(actions)
    valid = acts.filter(F.col("status_valid"))
    latest = valid.groupBy(F.col(target).alias(key)).agg(
        F.max_by("status", F.col(seq)).alias("_status"),
        F.max(seq).alias("updated_seq"),
        F.max_by("notes", F.when(F.length("notes") > 0, F.col(seq))).alias("_notes"),
        F.count(F.lit(1)).alias("n_actions"),
    )
    state = (queue.join(latest, key, "left")
             .withColumn("status", F.coalesce(F.col("_status"), F.col("status")))
             .withColumn("analyst_notes", F.col("_notes"))
             .withColumn("n_actions", F.coalesce(F.col("n_actions"), F.lit(0).cast("bigint")))
             .drop("_status", "_notes"))
    unknown = acts.join(queue.select(F.col(key).alias(target)), target, "left_anti") \
        .withColumn("reject_reason", F.lit("not found"))
    invalid = acts.filter(~F.col("status_valid")).join(
        queue.select(F.col(key).alias(target)), target, "left_semi") \
        .withColumn("reject_reason", F.lit("invalid status"))
    return state, unknown.unionByName(invalid)


def _fill_priority(q: DataFrame) -> DataFrame:
    """Rows without a priority get theirs; the others keep what they have."""
    base = q.select("risk_score", "Amount", "is_flagged")
    made = [c for c in prioritise(base).columns if c in q.columns and c not in base.columns]
    fresh = prioritise(q.withColumnsRenamed({c: f"_had_{c}" for c in made}))
    missing = F.col("_had_priority_score").isNull()
    return fresh.select(*[F.when(missing, F.col(c)).otherwise(F.col(f"_had_{c}")).alias(c) if c in made else F.col(c)
                          for c in q.columns])


def queue_view(queue: DataFrame, status: str | None = None, sort_by: str = "priority_score",
               descending: bool = True, key: str = "id") -> DataFrame:
    """K4 + F13: back-fill missing priority, filter by status, sort (missing -> 0)."""
    q = queue
    if "priority_score" not in q.columns:
        q = prioritise(q)
    elif {"risk_score", "Amount", "is_flagged"} <= set(q.columns):
        q = _fill_priority(q)
    if status is not None:
        q = q.filter(F.col("status") == F.lit(status))
    s = F.coalesce(F.col(sort_by), F.lit(0))
    return q.orderBy(s.desc() if descending else s.asc(), F.col(key).asc())


def sla_breaches(queue: DataFrame, as_of, ts: str = "ts",
                 open_statuses: Sequence[str] = ("PENDING_REVIEW", "ESCALATED_TIER_2")) -> DataFrame:
    """K8: open items whose SLA deadline passed before ``as_of``."""
    q = sla_due(queue, ts)
    return q.filter(F.col("status").isin(*open_statuses) & (F.col("sla_due") < as_of)) \
        .withColumn("minutes_overdue",
                    (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("sla_due").cast("timestamp")))
                    / dlit(60e6))


def feature_map(df: DataFrame, names: Sequence[str] = P.QUEUE_FEATURES, digits: int = 3) -> DataFrame:
    """K9: keep the named raw features present, rounded, as a map column."""
    present = [n for n in names if n in df.columns]
    m = F.map_from_arrays(F.array(*[F.lit(n) for n in present]),
                          F.array(*[C.rnd(F.col(n), digits) for n in present]))
    return df.withColumn("raw_features", m)


def bootstrap(scored: DataFrame, label: str = "y", min_score: int = 30) -> DataFrame:
    """K6: flagged rows or rows with score >= 30 from a labelled cohort, with the true label."""
    return prioritise(scored.filter(F.col("is_flagged") | (F.col("risk_score") >= min_score))) \
        .withColumn("status", F.lit(P.INITIAL_QUEUE_STATUS)) \
        .withColumn("true_label", F.col(label).cast("int"))
