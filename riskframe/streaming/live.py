"""Live operators with state: the record chain (L1), windows that close (L8), queue state
(L10) and velocity per event (W7).

All results go to a :class:`~riskframe.streaming.ledger.Ledger`, so a replayed batch or a
restart in mid-stream leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import queue as Q
from ..operators import risk as RK
from .ledger import Ledger, start

HOUR_US = 3_600_000_000
LOG_COLUMNS = ["id", "ts", "entity", "Amount", "probability", "risk_score", "risk_category", "decision", "is_flagged"]
QUEUE_COLUMNS = ["id", "ts", "Amount", "probability", "risk_score", "risk_category", "decision", "is_flagged", "status",
                 "priority_score", "priority_tier", "badge_class", "sla", "sla_minutes"]


# ------------------------------------------------------------------ L1
def refusal(key: str = "id", p: str = "p"):
    """Why a record cannot be logged, or NULL."""
    return (F.when(F.col(key).isNull(), F.lit("id is missing"))
            .when(F.col(p).isNull() | F.isnan(F.col(p)), F.lit("probability must be numeric"))
            .when((F.col(p) < 0) | (F.col(p) > 1), F.lit("probability must lie in [0, 1]")))


def record_chain(ledger: Ledger, threshold: float | None = None):
    """L1: the writer of one micro-batch of scored transactions. Each becomes a row of
    ``log`` (stamped ``logged_at``, one time per batch) and, if flagged, a row of ``queue`` with
    its priority; a record without a usable id or probability goes to ``quarantine`` with the
    reason. The three appear together, once: a replayed batch changes none of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger.is_committed(batch_id):
            return
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = batch.withColumn("reject_reason", refusal()).persist()  # three sinks, one pass over the source
        try:
            n = rows.agg(F.count(F.lit(1)).alias("n_in"), F.count("reject_reason").alias("n_side")).first()
            good = RK.assess(rows.where(F.col("reject_reason").isNull()), threshold=threshold, with_text=False)
            ledger.write("log", batch_id, good.select(*LOG_COLUMNS, F.lit(now).cast("timestamp_ntz").alias("logged_at")))
            ledger.write("queue", batch_id, Q.enqueue(good, max_items=None).select(*QUEUE_COLUMNS))
            ledger.write("quarantine", batch_id, rows.where(F.col("reject_reason").isNotNull())
                         .select("id", "ts", "Amount", "p", "reject_reason"))
            ledger.commit(batch_id, n_in=n["n_in"], n_out=n["n_in"] - n["n_side"], n_side=n["n_side"])
        finally:
            rows.unpersist()

    return write


# ------------------------------------------------------------------ L8
def closing_windows(ledger: Ledger, window_us: int = 24 * HOUR_US, delay_us: int = HOUR_US):
    """The writer of one micro-batch of scored transactions that finalises event-time
    windows. The watermark is the greatest event time of the batches before, less the delay. A
    row whose window has closed, or that has no time, goes to ``late``; the others add to
    their windows' partial counts (one row per window and batch). Windows that the batch's own
    greatest time closes are summed up and written to ``windows`` once, and never change."""
    length = F.lit(window_us)

    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger.is_committed(batch_id):
            return
        last = ledger.before(batch_id)
        closed = last.get("closed_us")
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        rows = RK.assess(batch, with_text=False).withColumns({"_us": us, "closes_us": us - F.pmod(us, length) + length})
        no_time = F.col("_us").isNull()
        is_late = no_time | (F.col("closes_us") <= F.lit(closed)) if closed is not None else no_time
        rows = rows.withColumn("_late", is_late).persist()
        try:
            n = rows.agg(F.count(F.lit(1)).alias("n_in"), F.count_if("_late").alias("n_side"), F.max("_us").alias("max_us")).first()
            ledger.write("late", batch_id, rows.where("_late").select(
                "id", "ts", "Amount", "is_flagged", F.when(no_time, "no event time").otherwise("window closed").alias("reason")))
            part = rows.where("NOT _late").groupBy("closes_us").agg(
                F.count(F.lit(1)).alias("n"), F.count_if("is_flagged").alias("flagged"),
                F.sum(F.col("Amount").cast("decimal(30,6)")).alias("dollars"))
            ledger.write("partials", batch_id, part.coalesce(1))
        finally:
            rows.unpersist()
        times = [t for t in (last.get("max_us"), n["max_us"]) if t is not None]
        newest = max(times, default=None)
        until = closed if newest is None else max(newest - delay_us, closed if closed is not None else newest - delay_us)
        done = ledger.read("partials", also=batch_id).where(F.lit(until is not None) & (F.col("closes_us") <= F.lit(until or 0)))
        if closed is not None:
            done = done.where(F.col("closes_us") > F.lit(closed))
        ledger.write("windows", batch_id, summed(done, window_us).coalesce(1))
        ledger.commit(batch_id, n_in=n["n_in"], n_out=n["n_in"] - n["n_side"], n_side=n["n_side"], max_us=newest, closed_us=until)

    return write


def summed(partials: DataFrame, window_us: int) -> DataFrame:
    out = partials.groupBy("closes_us").agg(*[F.sum(c).alias(c) for c in ("n", "flagged", "dollars")])
    return out.select(F.timestamp_micros(F.col("closes_us") - F.lit(window_us)).cast("timestamp_ntz").alias("window_start"),
                      "closes_us", "n", "flagged", F.col("dollars").cast("decimal(38,6)").alias("dollars"))


def all_windows(ledger: Ledger, window_us: int = 24 * HOUR_US) -> DataFrame:
    """The closed windows (``final``) and, as they stand, those still open."""
    closed = ledger.manifests().agg(F.max("closed_us").alias("c")).select("c").scalar()
    still = ledger.read("partials").where(closed.isNull() | (F.col("closes_us") > closed))
    return (ledger.read("windows").drop("batch_id").withColumn("final", F.lit(True))
            .unionByName(summed(still, window_us).withColumn("final", F.lit(False))).drop("closes_us"))


# ------------------------------------------------------------------ L10
ACTION_STATE = "status string, seq long, notes string, notes_seq long, n_actions long, first_seq long"
ACTION_ROW = "queue_id long, status string, updated_seq long, analyst_notes string, n_actions long, first_seq long"
_PARTIAL = "queue_id long, status string, seq long, notes string, notes_seq long, n long, first_seq long, at timestamp"


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per item of the actions in a batch of rows."""
    rows = rows.sort_values("seq", kind="stable")
    out = rows.groupby("queue_id", sort=False).agg(status=("status", "last"), seq=("seq", "last"), n=("n", "sum"),
                                                    first_seq=("first_seq", "min"), at=("at", "max")).reset_index()
    noted = rows[rows["notes_seq"].notna()].sort_values("notes_seq", kind="stable").drop_duplicates("queue_id", keep="last")
    return out.merge(noted[["queue_id", "notes", "notes_seq"]], on="queue_id", how="left")


def queue_states(actions: DataFrame, ttl_us: int | None = None, delay: str = "1 hour") -> DataFrame:
    """The state of each queue item that a micro-batch changed (update mode): its latest
    valid action by ``action_seq``, the latest notes that are not empty, and the number of its
    valid actions. One value per item is kept. With ``ttl_us`` (needs a column ``ts`` of event
    times) an item without actions for that long is forgotten; a later action starts a new
    value, told apart by ``first_seq``, which :func:`current_states` puts together.

    A hot item's actions shrink to one row per Arrow batch before they are shuffled."""
    acts = Q.clean_actions(actions).where(F.col("status_valid") & F.col("queue_id").isNotNull() & F.col("action_seq").isNotNull())
    at = F.col("ts").cast("timestamp") if ttl_us is not None else F.lit(None).cast("timestamp")
    has_notes = F.length("notes") > 0
    rows = acts.select("queue_id", "status", F.col("action_seq").alias("seq"), F.when(has_notes, F.col("notes")).alias("notes"),
                       F.when(has_notes, F.col("action_seq")).alias("notes_seq"), F.lit(1).cast("long").alias("n"),
                       F.col("action_seq").alias("first_seq"), at.alias("at"))

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield _newest(f)[[c.split()[0] for c in _PARTIAL.split(", ")]]

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        status, seq, notes, notes_seq, n, first = state.get if state.exists else (None, None, None, None, 0, None)
        latest = None
        for f in frames:
            for r in f.itertuples():
                if seq is None or r.seq >= seq:
                    status, seq = r.status, int(r.seq)
                if r.notes_seq == r.notes_seq and r.notes_seq is not None and (notes_seq is None or r.notes_seq >= notes_seq):
                    notes, notes_seq = r.notes, int(r.notes_seq)
                n += int(r.n)
                first = int(r.first_seq) if first is None else min(first, int(r.first_seq))
                if ttl_us is not None and r.at == r.at:
                    latest = r.at if latest is None else max(latest, r.at)
        state.update((status, seq, notes, notes_seq, n, first))
        if latest is not None:
            due = (latest.value // 1000 + ttl_us) // 1000
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"queue_id": [key[0]], "status": [status], "updated_seq": [seq], "analyst_notes": [notes],
                            "n_actions": [n], "first_seq": [first]})

    small, timeout = rows.mapInPandas(shrink, _PARTIAL), GroupStateTimeout.NoTimeout
    if ttl_us is not None:
        small, timeout = small.withWatermark("at", delay), GroupStateTimeout.EventTimeTimeout
    return small.groupBy("queue_id").applyInPandasWithState(update, ACTION_ROW, ACTION_STATE, "update", timeout)


def state_changes(ledger: Ledger):
    """Writer of the items that a batch changed: bytes written follow the changes, not the
    table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ledger.is_committed(batch_id):
            ledger.write("states", batch_id, batch)
            ledger.commit(batch_id)

    return write


def current_states(ledger: Ledger) -> DataFrame:
    """One row per item: its newest state, summed over the values it had if some were
    forgotten in between."""
    newest = ledger.read("states").groupBy("queue_id", "first_seq").agg(F.max_by(
        F.struct("status", "updated_seq", "analyst_notes", "n_actions"), "batch_id").alias("s"))
    return newest.groupBy("queue_id").agg(
        F.max_by("s.status", "s.updated_seq").alias("status"), F.max("s.updated_seq").alias("updated_seq"),
        F.max_by("s.analyst_notes", F.when(F.col("s.analyst_notes").isNotNull(), F.col("s.updated_seq"))).alias("analyst_notes"),
        F.sum("s.n_actions").alias("n_actions"))


# ------------------------------------------------------------------ W7
#: Amounts are kept as whole millionths.
UNIT = 1_000_000


#: Groups of entities that share a state: a call costs as much for one entity as for thousands.
#: Part of a stream's checkpoint: a running stream keeps its number.
BUCKETS = 256


def event_velocity(stream: DataFrame, windows: dict[str, int], delay: str = "2 hours", ts: str = "ts_event",
                   buckets: int = BUCKETS) -> DataFrame:
    """Per event, ``{name}_count`` and ``{name}_sum`` over the events of its entity in
    [t - W, t] (W in seconds, peers included), emitted once, as soon as the watermark says that
    every event up to t has arrived; so events may arrive in any order within ``delay``.

    Entities are dealt to ``buckets`` by hash. The state of a bucket is its events of the
    longest window before the watermark and those after it (32 and 40 bytes each); a timer
    calls it when the next event is due or its history has passed out of every window. A row
    without an id is a heartbeat: it moves the watermark and is no event. A NULL entity is an
    entity. Rows behind the watermark are dropped by Spark; rows without a time have no place in
    any window and are dropped, too."""
    names, spans = list(windows), [int(w) * UNIT for w in windows.values()]
    longest = max(spans)
    schema = "entity long, id long, " + ", ".join(f"{n}_count long, {n}_units long" for n in names)
    amount = (F.col("Amount").cast("decimal(30,6)") * UNIT).cast("long")
    zero, entity = F.lit(0).cast("long"), F.col("entity").cast("long")
    rows = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int").alias("bucket"), F.unix_micros(ts).alias("t"),
        F.coalesce(amount, zero).alias("a"), F.coalesce(entity, zero).alias("e"), entity.isNull().cast("long").alias("none"),
        F.coalesce(F.col("id").cast("long"), zero).alias("id"), F.col("id").isNotNull().alias("event"), F.col(ts))

    def arrays(blob: bytes | None, n: int) -> np.ndarray:
        return np.frombuffer(blob or b"", np.int64).reshape(n, -1)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        past, due = (arrays(b, n) for b, n in zip(state.get if state.exists else (None, None), (4, 5), strict=True))
        if not state.hasTimedOut:
            fresh = [f.loc[f["event"], ["t", "a", "e", "none", "id"]].to_numpy(np.int64).T for f in frames]
            due = np.concatenate([due, *fresh], axis=1)
        mark = state.getCurrentWatermarkMs() * 1000
        ready = due[0] <= mark
        if ready.any():
            now = due[:, ready]
            past = np.concatenate([past, now[:4]], axis=1)
            own = np.append(np.zeros(past.shape[1] - now.shape[1], np.int64), np.arange(1, now.shape[1] + 1))
            order = np.lexsort((past[0], past[2], past[3]))
            past, own = past[:, order], own[order]
            yield pd.DataFrame(_frames(past, own, now[4], names, spans))
            due = due[:, ~ready]
        past = past[:, past[0] >= mark - longest]  # later events are after the mark
        if not past.shape[1] and not due.shape[1]:
            if state.exists:
                state.remove()
            return
        state.update((past.tobytes(), due.tobytes()))
        call = int(due[0].min()) if due.shape[1] else int(past[0].max()) + longest
        state.setTimeoutTimestamp(max(call // 1000 + 1, mark // 1000 + 1))

    return rows.groupBy("bucket").applyInPandasWithState(
        update, schema, "past binary, due binary", "append", GroupStateTimeout.EventTimeTimeout)


def _frames(past: np.ndarray, own: np.ndarray, ids: np.ndarray, names: list[str], spans: list[int]) -> dict:
    """Frames of the rows with a number ``own`` (place + 1 in ``ids``) among the rows (t, a, entity,
    none) of many entities, sorted by entity and time."""
    edge = (past[2:, 1:] != past[2:, :-1]).any(axis=0)
    group = np.append(0, np.cumsum(edge))
    # places of (entity, time) by the times' ranks: no overflow, however far the times are apart
    times = np.unique(past[0])
    stride = len(times) + 1
    place = group * stride + np.searchsorted(times, past[0])
    asks = np.flatnonzero(own)
    at, start = past[0][asks], group[asks] * stride
    until = np.searchsorted(place, start + np.searchsorted(times, at, side="right"))
    total = np.append(0, np.cumsum(past[1]))
    out = {"entity": pd.arrays.IntegerArray(past[2][asks].copy(), past[3][asks] == 1), "id": ids[own[asks] - 1]}
    for n, span in zip(names, spans, strict=True):
        since = np.searchsorted(place, start + np.searchsorted(times, at - span))
        out[f"{n}_count"], out[f"{n}_units"] = until - since, total[until] - total[since]
    return out


def keep_rows(ledger: Ledger, table: str):
    """Writer that adds a batch's rows to a table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ledger.is_committed(batch_id):
            ledger.write(table, batch_id, batch)
            ledger.commit(batch_id)

    return write


def newest_rows(ledger: Ledger, table: str, keys: list[str]) -> DataFrame:
    """Of a table that an update-mode stream keeps, each key's row of the last batch that changed it."""
    rows = ledger.read(table)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


__all__ = ["Ledger", "all_windows", "closing_windows", "current_states", "event_velocity", "keep_rows", "newest_rows", "queue_states",
           "record_chain", "start", "state_changes"]
