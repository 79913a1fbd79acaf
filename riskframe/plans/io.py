"""Source and sink queries (S1-S9): each writes data derived from the given
tables to the shared scratch folder, reads it back through the operator
under test, and is checked against the SQL of the original data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rnd
from ..operators import metrics as M
from ..operators import risk as RK
from ..session import scratch_path
from ..sources import files as FS
from ..sources.tables import N_V, card_transactions, transactions
from .evaluation import _ROC_SQL, REPORT_COLS
from .evaluation import _report_sql as _metrics_sql
from .registry import CARD, TX, R, register
from .splits import SPLIT_SQL, split_frame

VCOLS = [f"V{k}" for k in range(1, N_V + 1)]


def _dir(spark, name: str) -> str:
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex[:12]}")


@register("s01_csv_scan", f'''SELECT {R('"Time"')} AS "Time", {R('"Amount"')} AS "Amount", {R('"V1"')} AS "V1",
  {R('"V28"')} AS "V28", "Class" FROM {CARD}''')
def s01_csv_scan(spark, sf_dir):
    """The card table written as CSV, read back with a declared schema (FAILFAST)."""
    path = _dir(spark, "csv")
    ct = card_transactions(spark, sf_dir).select("Time", *VCOLS, "Amount", "Class")
    FS.write_csv(ct, path)
    back = FS.read_csv(spark, path, FS.card_schema())
    return back.select("Time", "Amount", "V1", "V28", "Class")


@register("s02_split_scan", f'SELECT id, "Class", "Amount" FROM {SPLIT_SQL} WHERE split = \'train\'')
def s02_split_scan(spark, sf_dir):
    """S2+S3: splits written partitioned by split; reading 'train' prunes the others."""
    path = _dir(spark, "splits")
    FS.write_splits(split_frame(spark, sf_dir).select("id", "Class", "Amount", "split"), path)
    return FS.read_split(spark, path, "train").select("id", "Class", "Amount")


LOG_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("risk_score", T.IntegerType()),
                           T.StructField("decision", T.StringType()), T.StructField("logged_at", T.StringType())])


@register("s04_jsonl_log", f"""
SELECT id, CAST(floor(greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) * 100.0::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS risk_score,
  CASE WHEN p >= 0.2773::DOUBLE THEN 'REVIEW' ELSE 'ACCEPT' END AS decision, run FROM (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 'part1' ELSE 'part2' END AS run FROM {TX})""")
def s04_jsonl_log(spark, sf_dir):
    """Scored records appended as JSON lines in two runs (each run its own partition)."""
    path = _dir(spark, "log")
    rec = RK.assess(transactions(spark, sf_dir), with_text=False).select(
        "id", "risk_score", "decision", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logged_at"), "ts")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    FS.append_log(rec.filter(F.col("ts") < cut).drop("ts"), path, "part1")
    FS.append_log(rec.filter(F.col("ts") >= cut).drop("ts"), path, "part2")
    FS.append_log(rec.filter(F.col("ts") >= cut).drop("ts"), path, "part2")  # a retried write: no duplicates
    back = FS.read_log(spark, path, T.StructType(LOG_SCHEMA.fields + [T.StructField("run", T.StringType())]))
    return back.select("id", "risk_score", "decision", "run")


QUEUE_ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()),
                           T.StructField("status", T.StringType())])


@register("s05_jsonl_queue_scan", f"""
SELECT count(*) FILTER (WHERE event_type <> 'error')::BIGINT AS good_rows,
  count(*) FILTER (WHERE event_type = 'error')::BIGINT AS malformed_lines,
  {R('sum(CASE WHEN event_type <> \'error\' THEN value END)', 2)} AS good_amount FROM events""")
def s05_jsonl_queue_scan(spark, sf_dir):
    """Queue JSON lines with a declared schema; malformed lines (here: every
    'error' event written truncated) are set aside, blank lines skipped."""
    path = _dir(spark, "queue")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("value").alias("amount"),
                              F.lit("PENDING_REVIEW").alias("status")))
    text = F.when(F.col("event_type") == "error", F.expr("substring(to_json(named_struct('id', event_id)), 1, 5)")) \
        .otherwise(line)
    ev.select(text.alias("value")).write.mode("overwrite").text(path)
    good, bad = FS.read_jsonl(spark, path, QUEUE_ITEM)
    g = good.agg(F.count(F.lit(1)).alias("good_rows"), rnd(F.sum("amount"), 2).alias("good_amount"))
    b = bad.agg(F.count(F.lit(1)).alias("malformed_lines"))
    return g.select("good_rows", b.select("malformed_lines").scalar().alias("malformed_lines"), "good_amount")


@register("s07_model_roundtrip", None)
def s07_model_roundtrip(spark, sf_dir):
    """A fitted pipeline saved and loaded transforms identically (max |diff| = 0)."""
    from .models import prepared, trained
    from ..operators import models as ML
    data, _ = prepared(spark, sf_dir)
    tm = trained(spark, sf_dir, "logistic_regression")
    path = _dir(spark, "model")
    FS.save_model(tm.model, path)
    loaded = ML.TrainedModel(tm.name, FS.load_model(path), tm.features, 0.0)
    test = data.filter(F.col("split") == "test")
    a = ML.score(tm, test, "id", ()).withColumnRenamed("p", "p_a")
    b = ML.score(loaded, test, "id", ()).withColumnRenamed("p", "p_b")
    return a.join(b, "id").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p_a") - F.col("p_b"))).alias("max_abs_diff"))


@register("s07_model_record", None)
def s07_model_record(spark, sf_dir):
    """A model saved with its record, loaded again: threshold, composite and duration beside
    the number of test rows that the loaded model scores as before."""
    from .models import prepared, trained
    from ..operators import models as ML
    data, _ = prepared(spark, sf_dir)
    tm = trained(spark, sf_dir, "logistic_regression")
    val = ML.score(tm, data.filter(F.col("split") == "validation"), "id", ("Class",)).withColumnRenamed("Class", "y")
    report = M.metrics_report(val).select("threshold", "composite_score").first()
    root = _dir(spark, "models")
    FS.save_model_record(spark, root, tm.name, tm.model, report["threshold"], report["composite_score"], tm.fit_seconds, tm.features)
    model, record = FS.load_model_record(spark, root, tm.name)
    test = data.filter(F.col("split") == "test")
    again = ML.score(ML.TrainedModel(tm.name, model, tm.features, 0.0), test, "id", ()).withColumnRenamed("p", "again")
    same = ML.score(tm, test, "id", ()).join(again, "id").agg(F.count_if(F.col("p") == F.col("again")).alias("n"))
    return record.select("model_name", "threshold", "composite_score", F.col("fit_seconds") > 0, F.size("features").alias("n_features"),
                         F.col("saved_at").isNotNull().alias("stamped"), same.select("n").scalar().alias("n_same")) \
        .withColumnRenamed("(fit_seconds > 0)", "timed")


FULL_COLS = ["model", "n_samples", "n_fraud", "n_legitimate", "tp", "fp", "tn", "fn", *REPORT_COLS]


@register("s08_full_metrics", f"""
SELECT 'run-1' AS run, model, n_samples, n_fraud, n_legitimate, tp, fp, tn, fn, {", ".join(f"{R(c)} AS {c}" for c in REPORT_COLS)}
FROM {_metrics_sql('value_ratio', f'(SELECT id, y, p FROM {TX})', '0.2773::DOUBLE')}""")
def s08_full_metrics(spark, sf_dir):
    """Every figure of a metrics report, appended under its run and read back."""
    path = _dir(spark, "reports")
    rep = M.metrics_report(transactions(spark, sf_dir), threshold=0.2773).withColumn("model", F.lit("value_ratio"))
    for _ in range(2):  # the second write is a retry: no duplicates
        FS.append_log(rep.select(*FULL_COLS), path, "run-1", fmt="parquet")
    return spark.read.parquet(path).select("run", *FULL_COLS)


@register("s08_curve_sink", _ROC_SQL)
def s08_curve_sink(spark, sf_dir):
    """The ROC curve beside the report, appended under its run and read back."""
    path = _dir(spark, "curves")
    FS.append_log(M.roc_curve(transactions(spark, sf_dir)), path, "run-1", fmt="parquet")
    return spark.read.parquet(path).select("point_no", "threshold", "fpr", "tpr")


@register("s08_metrics_sink", f"""
SELECT 'ratio_score' AS model, 'all' AS split, tp, fp, tn, fn FROM (
  SELECT count(*) FILTER (WHERE p >= 0.2773::DOUBLE AND y = 1)::BIGINT AS tp,
         count(*) FILTER (WHERE p >= 0.2773::DOUBLE AND y <> 1)::BIGINT AS fp,
         count(*) FILTER (WHERE NOT (p >= 0.2773::DOUBLE) AND y <> 1)::BIGINT AS tn,
         count(*) FILTER (WHERE NOT (p >= 0.2773::DOUBLE) AND y = 1)::BIGINT AS fn FROM {TX})""")
def s08_metrics_sink(spark, sf_dir):
    """A metrics row appended to a report table keyed by (run, model, split)."""
    path = _dir(spark, "metrics")
    rep = M.threshold_metrics(transactions(spark, sf_dir)).select(
        F.lit("ratio_score").alias("model"), F.lit("all").alias("split"), "tp", "fp", "tn", "fn")
    FS.append_log(rep, path, "run-1", fmt="parquet")
    return spark.read.parquet(path).select("model", "split", "tp", "fp", "tn", "fn")


@register("s09_cached_scores", f'SELECT t.id, {R("t.p")} AS p, {R('c."V14"')} AS "V14" FROM {TX} t JOIN {CARD} c ON c.id = t.id')
def s09_cached_scores(spark, sf_dir):
    """Probabilities written once, then joined back by key (not by position)."""
    path = _dir(spark, "scores")
    FS.write_scores(transactions(spark, sf_dir).select("id", "p"), path)
    scores = spark.read.parquet(path)
    feats = card_transactions(spark, sf_dir).select("id", "V14")
    return scores.join(feats, "id", "inner").select("id", "p", "V14")


@register("s06_actions_log", """
WITH a AS (SELECT conv_id AS queue_id, turn AS action_seq,
  upper(trim(CASE WHEN role = 'user' THEN ' confirmed_fraud ' WHEN role = 'assistant' THEN 'Dismissed_False_Alarm' ELSE 'archive' END)) AS status
  FROM conversations)
SELECT queue_id, arg_max(status, action_seq) AS status, count(*)::BIGINT AS n_actions
FROM a WHERE status IN ('PENDING_REVIEW', 'CONFIRMED_FRAUD', 'DISMISSED_FALSE_ALARM', 'ESCALATED_TIER_2')
GROUP BY queue_id""")
def s06_actions_log(spark, sf_dir):
    """Triage actions appended (two runs, one retried) to an append-only
    table; the current status is derived from it, never rewritten in place."""
    from ..operators import queue as Q
    from .queue import _actions
    path = _dir(spark, "actions")
    acts = Q.clean_actions(_actions(spark, sf_dir)).select("queue_id", "action_seq", "status", "status_valid", "notes")
    FS.append_log(acts.filter(F.col("action_seq") < 3), path, "run-1", fmt="parquet")
    FS.append_log(acts.filter(F.col("action_seq") >= 3), path, "run-2", fmt="parquet")
    FS.append_log(acts.filter(F.col("action_seq") >= 3), path, "run-2", fmt="parquet")  # retry: same rows
    log = spark.read.parquet(path).filter(F.col("status_valid"))
    return log.groupBy("queue_id").agg(F.max_by("status", "action_seq").alias("status"),
                                       F.count(F.lit(1)).alias("n_actions"))
