"""Risk scoring and decisions over DataFrames.

Everything is a column expression, so a batch, a stream and a single row all
run the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import darray, dlit
from .ordered import BUCKET, assign_bucket, default_buckets, range_edges


def quarantine_probability(df: DataFrame, p: str = "p") -> tuple[DataFrame, DataFrame]:
    """Split rows whose probability is NULL or NaN (they cannot be scored)."""
    bad = F.col(p).isNull() | F.isnan(F.col(p))
    return df.filter(~bad), df.filter(bad).withColumn("reject_reason", F.lit("probability must be numeric"))


def assess(df: DataFrame, p: str = "p", policy: P.RiskPolicy = P.RiskPolicy(),
           threshold: float | Column | None = None, with_text: bool = True) -> DataFrame:
    """Probability -> score, category, colour, decision, flags, text.

    ``threshold`` overrides the policy threshold; a Column gives a per-row
    threshold (R8/R9). A NULL or NaN probability gives NULL throughout: such rows
    belong to :func:`quarantine_probability`, not to either decision.
    """
    policy.validate()
    t = threshold if isinstance(threshold, Column) else dlit(policy.threshold if threshold is None else threshold)
    prob = C.clamp01(p)
    score = C.risk_score(p)
    cat = C.risk_category(score, policy)
    flag = prob >= t
    cols = {
        "probability": C.rnd(prob, 6),
        "risk_score": score,
        "risk_category": cat,
        "color": C.risk_color(score, policy),
        "decision": C.by_flag(flag, P.DECISION_REVIEW, P.DECISION_ACCEPT),
        "is_flagged": flag,
        "status_label": C.by_flag(flag, P.STATUS_FLAGGED, P.STATUS_CLEARED),
        "prediction": flag.cast("int"),
        "decision_threshold": C.rnd(t, 4),
    }
    if with_text:
        p4 = F.format_string("%.4f", C.rnd(prob, 4))
        t4 = F.format_string("%.4f", C.rnd(t, 4))
        cols["description"] = F.when(
            flag,
            F.format_string("Transaction FLAGGED FOR INVESTIGATION: probability %s exceeds decision "
                            "threshold %s (risk score: %d/100, %s).", p4, t4, score, cat),
        ).when(
            ~flag, F.format_string("Transaction cleared automatically under current operational threshold "
                            "(risk score: %d/100, %s). NOTE: ACCEPT is an operational clearance, not a "
                            "guarantee of transaction legitimacy.", score, cat))
        cols["legitimacy_disclaimer"] = F.lit(P.LEGITIMACY_DISCLAIMER)
    return df.withColumns(cols)


def canonical_labels(df: DataFrame, category: str = "risk_category", decision: str = "decision") -> DataFrame:
    """Alias-insensitive forms (LOW == LOW RISK; REVIEW == MONITOR == FLAGGED ...)."""
    return df.withColumns({"category_canonical": C.canonical_category(category),
                           "decision_canonical": C.canonical_decision(decision)})


def policy_violations(low: Column, medium: Column, t: Column) -> Column:
    """NULL when valid, else the first violated rule."""
    return (F.when(~((low >= 0) & (low < medium) & (medium <= 100)),
                   F.lit("category boundaries must satisfy 0 <= low_max < medium_max <= 100"))
            .when(t.isNull() | F.isnan(t) | (t < dlit(0.0)) | (t > dlit(1.0)),
                  F.lit("decision_threshold must lie within [0.0, 1.0]")))


def effective_threshold(row_override: Column, policy_t: Column, default: float = P.DEFAULT_THRESHOLD) -> Column:
    """Explicit per-row override > policy value > default."""
    return F.coalesce(row_override.cast("double"), policy_t.cast("double"), dlit(default))


def policy_as_of(df: DataFrame, ts: str, changes: Sequence[tuple[str, float]]) -> DataFrame:
    """Threshold in force at each row's time (as-of join on effective_from).

    ``changes`` are (effective_from, threshold) pairs - the policy history is a
    short list, so the lookup is an index (number of change times <= ts)
    computed per row from literals instead of a range join; rows before the
    first change get NULL (caller's default applies).
    """
    ch = sorted((str(a), float(b)) for a, b in changes)
    if not ch:
        return df.withColumn("policy_threshold", F.lit(None).cast("double"))
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    edges = [F.unix_micros(F.lit(a).cast("timestamp")) for a, _ in ch]
    idx = F.lit(0)
    for e in edges:  # a handful of policy changes: linear is fine and exact
        idx = idx + (micros >= e).cast("int")
    arr = darray([b for _, b in ch])
    return df.withColumns({
        "policy_index": idx,
        "policy_threshold": F.when(idx > 0, F.element_at(arr, F.greatest(idx, F.lit(1)))),
    })


def policy_as_of_table(df: DataFrame, policies: DataFrame, key: str = "policy_key", ts: str = "ts",
                       effective: str = "effective_from", order: str = "policy_id", threshold: str = "threshold") -> DataFrame:
    """Each row of ``df`` with the threshold that the history table ``policies`` had put in
    force for its key at its time (``policy_threshold``, ``policy_from``).

    Rows and changes are put in one order of time per key and the last change is carried
    forward; the order is cut into ranges of time, each with what was in force when it began,
    so that a key with a third of all rows is spread over many tasks. Of several changes at
    one instant the one of the greatest ``order`` counts. Changes without a time or a valid
    threshold (R7) are no changes; a row without a time, or before the first change of its
    key, gets NULL (the caller's default applies); NULL keys have their own history."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    events = df.select(F.col(key).alias("_k"), t.alias("_t"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_o"),
                       F.lit(None).cast("double").alias("_p"), row.alias("_row"))
    value, since = F.col(threshold).cast("double"), F.unix_micros(F.col(effective).cast("timestamp"))
    changes = policies.where(since.isNotNull() & (value >= dlit(0.0)) & (value <= dlit(1.0))).select(
        F.col(key).alias("_k"), since.alias("_t"), F.lit(0).alias("_kind"), F.col(order).cast("long").alias("_o"), value.alias("_p"),
        F.lit(None).cast(events.schema["_row"].dataType).alias("_row"))
    edges = range_edges(events, "_t", default_buckets(df.sparkSession))
    both = assign_bucket(events.unionByName(changes), "_t", edges)
    change = F.when(F.col("_kind") == 0, F.struct("_t", "_o", "_p"))
    # the last change of each range, then of all ranges before it: at most one row per key and range
    per = both.groupBy("_k", BUCKET).agg(F.max(change).alias("_last"))
    earlier = Window.partitionBy("_k").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_k").alias("_pk"), F.col(BUCKET).alias("_pb"), F.last("_last", ignorenulls=True).over(earlier).alias("_begin"))
    so_far = Window.partitionBy("_k", BUCKET).orderBy("_t", "_kind", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("_now", F.last(change, ignorenulls=True).over(so_far)).where(F.col("_kind") == 1)
    out = placed.join(per, F.col("_k").eqNullSafe(F.col("_pk")) & (F.col(BUCKET) == F.col("_pb")))
    held = F.when(F.col("_t").isNotNull(), F.coalesce("_now", "_begin"))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns], held["_p"].alias("policy_threshold"),
                      F.timestamp_micros(held["_t"]).alias("policy_from"))
