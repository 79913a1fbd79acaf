"""Live operators: restarts, replays, rows out of order and late, hot keys, expiry."""

import os
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskframe.session import scratch_path
from riskframe.streaming import live as LV
from riskframe.streaming import queries as SQ

T0 = datetime(2024, 1, 1)
TX = "id long, entity long, ts timestamp_ntz, Amount double, p double"
ACTIONS = "queue_id long, action_seq long, status_raw string, notes_raw string, ts timestamp_ntz"
DAY = 24 * LV.HOUR_US


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path)


def arrive(spark, root, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(f"{root}/in")


def bytes_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


# ------------------------------------------------------------------ L1
def test_record_chain_commits_three_tables_once(spark, root):
    ledger = LV.Ledger(spark, f"{root}/tables")
    rows = [(1, 7, T0, 900.0, 0.9), (2, 7, T0, 5.0, 0.1), (3, 7, T0, 5.0, None), (None, 7, T0, 5.0, 0.5),
            (4, 7, None, None, float("nan")), (5, None, T0, 1.0, 1.5), (2, 7, T0, 5.0, 0.1)]
    write = LV.record_chain(ledger)
    LV.start(arrive(spark, root, rows, TX), write, f"{root}/checkpoint")

    def tables():
        return {t: sorted(map(str, ledger.read(t).collect())) for t in ("log", "queue", "quarantine")}

    before = tables()
    assert [len(before[t]) for t in ("log", "queue", "quarantine")] == [3, 1, 4]
    assert {r.reject_reason for r in ledger.read("quarantine").collect()} == {
        "id is missing", "probability must be numeric", "probability must lie in [0, 1]"}
    item = ledger.read("queue").first()
    assert (item.id, item.status, item.priority_tier) == (1, "PENDING_REVIEW", item.priority_tier) and item.priority_score > 0
    assert ledger.manifests().select("batch_id", "n_in", "n_out", "n_side").collect() == [(0, 7, 3, 4)]
    again = spark.createDataFrame(rows, TX)
    write(again, 0)  # a replay after the commit
    assert tables() == before
    # a batch that failed before its commit is invisible, and written anew by its replay
    ledger.write("log", 1, ledger.read("log").drop("batch_id"))
    assert tables() == before
    write(spark.createDataFrame([(9, 1, T0, 2.0, 0.2)], TX), 1)
    assert sorted(r.id for r in ledger.read("log").collect()) == [1, 2, 2, 9]
    LV.start(arrive(spark, root, [], TX), write, f"{root}/checkpoint")  # nothing new, or an empty batch


# ------------------------------------------------------------------ L8
def test_windows_close_once_and_late_rows_are_kept(spark, root):
    at = lambda d, h=0.0: T0 + timedelta(days=d, hours=h)
    batches = [
        [(1, 1, at(0, 1), 1.5, 0.9), (2, 1, at(0, 23), 2.5, 0.1), (3, 1, at(1, 0.5), 4.0, 0.2)],  # mark: day 0, 23:30
        [(4, 1, at(0, 5), 8.0, 0.9), (5, 1, at(1, 1), 16.0, 0.9)],  # in time; closes day 0 (mark: day 1, 00:00)
        [(6, 1, at(0, 6), 32.0, 0.9), (7, 1, at(3, 2), 64.0, 0.1), (8, 1, None, 1.0, 0.1)],  # 6 is late; closes day 1
        [(9, 1, at(2, 9), 128.0, 0.1), (10, 1, at(3, 3), 256.0, None)],  # day 2 has closed without a row
    ]
    seen = []
    for i, rows in enumerate(batches):  # each batch after a restart
        ledger = LV.Ledger(spark, f"{root}/tables")
        LV.start(arrive(spark, root, rows, TX), LV.closing_windows(ledger), f"{root}/checkpoint")
        seen.append(sorted((r.window_start.day - 1, r.n, r.flagged, float(r.dollars)) for r in ledger.read("windows").collect()))
    assert seen == [[], [(0, 3, 2, 12.0)], [(0, 3, 2, 12.0), (1, 2, 1, 20.0)], [(0, 3, 2, 12.0), (1, 2, 1, 20.0)]]
    assert sorted((r.id, r.reason) for r in ledger.read("late").collect()) == [
        (6, "window closed"), (8, "no event time"), (9, "window closed")]
    every = LV.all_windows(ledger).collect()
    assert sorted((r.window_start.day - 1, r.n, r.final) for r in every) == [(0, 3, True), (1, 2, True), (3, 2, False)]
    n = ledger.manifests().agg(F.sum("n_in"), F.sum("n_out"), F.sum("n_side")).first()
    assert tuple(n) == (10, 7, 3) and sum(r.n for r in every) == 7
    LV.closing_windows(ledger)(spark.createDataFrame(batches[1], TX), 1)  # a replay
    assert sorted((r.window_start.day - 1, r.n) for r in ledger.read("windows").collect()) == [(0, 3), (1, 2)]


# ------------------------------------------------------------------ L10
def brute_states(rows):
    out = {}
    for item, seq, status, notes, _ in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[1]):
        status = (status if status is not None else "CONFIRMED_FRAUD").strip().upper()
        if status in ("PENDING_REVIEW", "CONFIRMED_FRAUD", "DISMISSED_FALSE_ALARM", "ESCALATED_TIER_2"):
            s, q, m, n = out.get(item, (None, None, None, 0))
            out[item] = (status, seq, notes if notes else m, n + 1)
    return out


def states(ledger):
    return {r.queue_id: (r.status, r.updated_seq, r.analyst_notes, r.n_actions) for r in LV.current_states(ledger).collect()}


def test_queue_state_after_restarts_equals_the_batch_result(spark, root):
    rng = random.Random(5)
    pool = ["confirmed_fraud", " Dismissed_False_Alarm", "ESCALATED_TIER_2", "nonsense", None]
    every, sizes = [], []
    for batch in range(4):
        n = 3000 if batch == 0 else 4  # one item has a third of the actions
        rows = [(0 if rng.random() < 0.34 else rng.randrange(800), 10_000 * (3 - batch if batch == 2 else batch) + i, rng.choice(pool),
                 rng.choice(("", None, f"note {i}")), None) for i in range(n)]
        every += rows
        ledger = LV.Ledger(spark, f"{root}/tables")
        LV.start(LV.queue_states(arrive(spark, root, rows, ACTIONS)), LV.state_changes(ledger), f"{root}/checkpoint", mode="update")
        sizes.append(bytes_of(ledger.part("states", batch)))
        assert states(ledger) == brute_states(every)
    changed = ledger.read("states").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in changed}[3] <= 4  # only the items that changed are written
    assert max(sizes[1:]) < sizes[0] / 2
    # null keys and sequence numbers take no part
    LV.start(LV.queue_states(arrive(spark, root, [(None, 1, "x", "y", None), (3, None, "confirmed_fraud", "", None)], ACTIONS)),
             LV.state_changes(ledger), f"{root}/checkpoint", mode="update")
    assert states(ledger) == brute_states(every)


def test_forgotten_items_go_on_where_they_were(spark, root):
    at = lambda h: T0 + timedelta(hours=h)
    batches = [[(1, 1, "escalated_tier_2", "a", at(0)), (2, 2, "confirmed_fraud", "b", at(0.5))],
               [(2, 3, "confirmed_fraud", "", at(30))], [(2, 4, "confirmed_fraud", "", at(31))],
               [(1, 5, "dismissed_false_alarm", "", at(32))]]  # item 1 has been forgotten by now
    every = []
    for rows in batches:
        every += rows
        ledger = LV.Ledger(spark, f"{root}/tables")
        LV.start(LV.queue_states(arrive(spark, root, rows, ACTIONS), ttl_us=10 * LV.HOUR_US), LV.state_changes(ledger),
                 f"{root}/checkpoint", mode="update")
        assert states(ledger) == brute_states(every)
    values = ledger.read("states").where("queue_id = 1").select("first_seq").distinct().count()
    assert values == 2


# ------------------------------------------------------------------ W7
def brute_velocity(rows, windows):
    by = defaultdict(list)
    for i, e, t, a, _ in rows:
        by[e].append((t, i, a or 0.0))
    return {i: tuple(x for w in windows.values() for x in (
        sum(t - timedelta(seconds=w) <= u <= t for u, _, _ in own),
        round(1e6 * sum(b for u, _, b in own if t - timedelta(seconds=w) <= u <= t)))) for own in by.values() for t, i, _ in own}


def test_event_velocity_out_of_order_with_restarts(spark, root):
    rng = random.Random(12)
    windows = {"a": 600, "b": 7200}
    rows = []
    for i in range(900):
        minute = rng.randrange(0, 1200)
        entity = 5 if rng.random() < 0.34 else rng.choice((1, 2, 3, None))
        rows.append((i, entity, T0 + timedelta(minutes=minute, microseconds=rng.choice((0, 0, 1))), rng.choice((1.25, 3.5, None)), 0.5))
    rows.sort(key=lambda r: (r[2] + timedelta(minutes=r[0] % 100), r[0]))  # up to 100 minutes late
    want = brute_velocity(rows, windows)
    got, last = {}, 0
    heartbeat = [(None, None, T0 + timedelta(days=3), None, None)]
    for part in (rows[:300], rows[300:310], rows[310:], heartbeat):
        ledger = LV.Ledger(spark, f"{root}/tables")
        stream = arrive(spark, root, part, TX).withColumn("ts_event", F.col("ts").cast("timestamp"))
        LV.start(LV.event_velocity(stream, windows, delay="2 hours"), LV.keep_rows(ledger, "features"), f"{root}/checkpoint")
        found = ledger.read("features").collect()
        got = {r.id: (r.a_count, r.a_units, r.b_count, r.b_units) for r in found}
        assert len(got) == len(found) >= last  # each event once
        assert all(want[i] == x for i, x in got.items())
        last = len(found)
    assert got == want


def test_file_stream_reads_one_file_or_a_folder(spark, root):
    spark.createDataFrame([(1, 1, T0, 1.0, 0.5)], TX).coalesce(1).write.parquet(f"{root}/t")
    one = SQ.file_stream(spark, f"{root}/t", spark.createDataFrame([], TX).schema)
    assert SQ.run_available(spark, one, "t").count() == 1
    assert scratch_path(spark, "x")


def test_event_velocity_calls_states_of_many_entities_at_once(spark, root):
    """Many entities share a state, also a NULL one and one with the number that stands for it."""
    windows = {"a": 600}
    rows = [(i, [None, 0, -7, *range(1, 600)][i % 602], T0 + timedelta(seconds=i), 1.0 + i % 5, 0.5) for i in range(1800)]
    heartbeat = [(None, None, T0 + timedelta(days=3), None, None)]
    for part in (rows, heartbeat):
        ledger = LV.Ledger(spark, f"{root}/tables")
        stream = arrive(spark, root, part, TX).withColumn("ts_event", F.col("ts").cast("timestamp"))
        features = LV.event_velocity(stream, windows, delay="2 hours", buckets=4)
        LV.start(features, LV.keep_rows(ledger, "features"), f"{root}/checkpoint")
    assert {r.id: (r.a_count, r.a_units) for r in ledger.read("features").collect()} == brute_velocity(rows, windows)
    state = spark.read.format("statestore").load(f"{root}/checkpoint")
    assert state.count() <= 4  # one state a bucket, not one an entity
    assert {r.entity for r in ledger.read("features").collect()} == {r[1] for r in rows}
