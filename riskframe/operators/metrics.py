"""Evaluation of scored rows ``(y, p)``: confusion counts, F-beta, AUCs, curves,
threshold search, composite score, gates, ranking and selection (E1-E14).

Two kernels serve every metric:

* **score groups** - ``groupBy(p)`` -> (pos, n) per distinct score, then running
  sums in descending score order through :func:`ordered.running_sums`; all
  curve and AUC maths runs over that frame (exact, tie-aware);
* **grid buckets** - each row is bucketed once against a sorted threshold grid
  (a log-depth CASE tree), so any number of thresholds costs one scan plus a
  table of ``len(grid) + 1`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import darray, count_edges_le, dlit, rnd, safe_div
from ..session import materialize
from .ordered import running_sums


def _counts_at(df: DataFrame, threshold: float | Column, y: str, p: str) -> DataFrame:
    t = threshold if isinstance(threshold, Column) else dlit(threshold)
    pred = F.col(p) >= t
    pos = F.col(y) == 1
    return df.agg(
        F.count_if(pred & pos).cast("bigint").alias("tp"),
        F.count_if(pred & ~pos).cast("bigint").alias("fp"),
        F.count_if(~pred & ~pos).cast("bigint").alias("tn"),
        F.count_if(~pred & pos).cast("bigint").alias("fn"),
    )


def confusion(df: DataFrame, threshold: float = P.DEFAULT_THRESHOLD,
              y: str = "y", p: str = "p") -> DataFrame:
    """One row tp, fp, tn, fn with ``p >= t`` positive."""
    return _counts_at(df, threshold, y, p)


def fbeta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    """(1+b^2) tp / ((1+b^2) tp + b^2 fn + fp); 0 when the denominator is 0."""
    b2 = float(beta) ** 2
    num = dlit(1.0 + b2) * tp.cast("double")
    den = dlit(1.0 + b2) * tp.cast("double") + dlit(b2) * fn.cast("double") + fp.cast("double")
    return safe_div(num, den, 0.0)


def with_rates(df: DataFrame) -> DataFrame:
    """E2/E3 from tp/fp/tn/fn columns; every zero division gives 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return df.select(
        "*",
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        fbeta(tp, fp, fn, 1.0).alias("f1_score"),
        fbeta(tp, fp, fn, 2.0).alias("f2_score"),
        safe_div(tp + tn, n).alias("accuracy"),
        safe_div(tn, tn + fp).alias("specificity"),
    )


def threshold_metrics(df: DataFrame, threshold: float = P.DEFAULT_THRESHOLD,
                      y: str = "y", p: str = "p") -> DataFrame:
    """E1+E2+E3 at a fixed threshold (also M8: held-out evaluation)."""
    return with_rates(_counts_at(df, threshold, y, p)).withColumn("threshold", dlit(threshold))


# --------------------------------------------------------------------------
# Score-group kernel
# --------------------------------------------------------------------------
def scored_rows(df: DataFrame, p: str = "p") -> DataFrame:
    """The rows that have a score: NULL and NaN take no part in any metric."""
    x = F.col(p).cast("double")
    return df.filter(x.isNotNull() & ~F.isnan(x))


def score_groups(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scored_rows(df, p).groupBy(F.col(p).cast("double").alias("score")).agg(
        F.sum(F.col(y).cast("bigint")).alias("pos"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("neg", F.col("n") - F.col("pos"))


def curve_points(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """One row per distinct score (descending): pos/neg at that score and
    cumulative tp/fp/point_no for 'predict positive when p >= score'."""
    return _points_of(counted_scores(df, y, p), n_buckets)


def counted_scores(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """:func:`score_groups`, written once: the rows are read once, and the bucket edges, the
    buckets' totals and the curve all read the counts."""
    return materialize(score_groups(df, y, p), "score-groups")


def _points_of(g: DataFrame, n_buckets: int | None) -> DataFrame:
    return running_sums(
        g, ["score"], {"tp": "pos", "fp": "neg", "point": F.lit(1).cast("bigint")},
        descending=True, n_buckets=n_buckets,
    ).select("score", "pos", "neg",
             F.col("cum_tp").alias("tp"), F.col("cum_fp").alias("fp"),
             F.col("cum_point").alias("point_no"))


def _totals(g: DataFrame) -> tuple[int, int]:
    """Positives and negatives of counted scores (two numbers)."""
    t = g.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"), F.coalesce(F.sum("neg"), F.lit(0)).alias("N")).first()
    return t["P"], t["N"]


def auc_scores(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """E4 ROC-AUC (ties get half credit) and E5 average precision (step sum).

    ROC-AUC = Σ neg_i (2 tp_above_i + pos_i) / (2 P N), computed in exact
    decimal; one class only -> 0.0. AP = Σ (pos_i / P) * (tp_i / k_i).
    """
    return _auc_from(curve_points(df, y, p, n_buckets).groupBy())


def _auc_from(points, *keys: str) -> DataFrame:
    """(keys..., roc_auc, pr_auc) of grouped curve points."""
    dec = "decimal(38,0)"
    agg = points.agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(F.col("neg").cast(dec) * (F.lit(2).cast(dec) * (F.col("tp") - F.col("pos")).cast(dec)
                                         + F.col("pos").cast(dec))).alias("auc_num"),
        F.sum(F.col("pos").cast("double") * F.col("tp").cast("double")
              / (F.col("tp") + F.col("fp")).cast("double")).alias("ap_num"),
    )
    P_, N_ = F.col("P"), F.col("N")
    return agg.select(
        *keys, F.when((P_ > 0) & (N_ > 0),
               F.col("auc_num").cast("double") / (dlit(2.0) * P_.cast("double") * N_.cast("double")))
        .otherwise(dlit(0.0)).alias("roc_auc"),
        F.when(P_ > 0, F.col("ap_num") / P_.cast("double")).otherwise(dlit(0.0)).alias("pr_auc"),
    )


def pr_curve(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """precision/recall per distinct score plus the final (1, 0) point.

    ``point_no`` 1 is the highest score; the closing point has NULL threshold.
    """
    g = counted_scores(df, y, p)
    cp, P_ = _points_of(g, n_buckets), F.lit(_totals(g)[0]).cast("bigint")
    pts = cp.select(
        F.col("point_no"),
        F.col("score").alias("threshold"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.when(P_ == 0, dlit(1.0)).otherwise(F.col("tp") / P_.cast("double")).alias("recall"),
    )
    closing = (g.agg(F.count(F.lit(1)).alias("k"))
               .select((F.col("k") + 1).alias("point_no"), F.lit(None).cast("double").alias("threshold"),
                       dlit(1.0).alias("precision"), dlit(0.0).alias("recall")))
    return pts.unionByName(closing)


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """fpr/tpr for every distinct score (all points kept) after the (0, 0) start."""
    g = counted_scores(df, y, p)
    cp = _points_of(g, n_buckets)
    positives, negatives = (F.lit(t).cast("bigint") for t in _totals(g))
    pts = cp.select(
        F.col("point_no"),
        F.col("score").alias("threshold"),
        safe_div(F.col("fp"), negatives).alias("fpr"),
        safe_div(F.col("tp"), positives).alias("tpr"),
    )
    start = cp.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("point_no"), dlit(float("inf")).alias("threshold"),
        dlit(0.0).alias("fpr"), dlit(0.0).alias("tpr"))
    return start.unionByName(pts)


def downsample_curve(curve: DataFrame, order_col: str = "point_no", max_points: int = 30) -> DataFrame:
    """Keep points at int(linspace(0, n-1, max_points)) when n > max_points.

    ``order_col`` is a dense 0- or 1-based position. The selection is a
    filter against the count; two numbers reach the driver.
    """
    curve = materialize(curve, "curve")  # counted, then filtered
    st = curve.agg(F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_o0")).first()
    n = F.lit(int(st["_n"])).cast("bigint")
    pos = F.col(order_col) - F.lit(int(st["_o0"] or 0)).cast("bigint")
    m = max_points
    # position i is kept when some k in [0, m) has floor(k*(n-1)/(m-1)) == i;
    # the smallest candidate is k = ceil(i*(m-1)/(n-1)).
    k_lo = F.ceil(pos * F.lit(m - 1) / (n - 1).cast("double"))
    keep = (n <= m) | ((k_lo < F.lit(m)) & (F.floor(k_lo * (n - 1) / F.lit(m - 1).cast("double")) == pos))
    return curve.filter(keep)


# --------------------------------------------------------------------------
# Grid-bucket kernel
# --------------------------------------------------------------------------
def grid_frame(spark: SparkSession, grid: Sequence[float]) -> DataFrame:
    """Small table (i, threshold) from literals, sorted ascending."""
    g = sorted(float(x) for x in grid)
    arr = darray(g)
    return spark.range(len(g)).select(F.col("id").cast("int").alias("i"),
                                      F.element_at(arr, F.col("id").cast("int") + 1).alias("threshold"))


def grid_counts(df: DataFrame, grid: Sequence[float], y: str = "y", p: str = "p",
                amount: str | None = None) -> DataFrame:
    """Per threshold (ascending): tp, fp, tn, fn (and positive dollars caught /
    escaped when ``amount`` is given), from one bucketed pass over ``df``."""
    g = sorted(float(x) for x in grid)
    T = len(g)
    spark = df.sparkSession
    b = count_edges_le(p, g)
    aggs = [F.sum(F.col(y).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")]
    if amount:
        aggs.append(F.sum(F.when(F.col(y) == 1, F.col(amount).cast("decimal(30,6)"))).alias("amt_pos"))
    buckets = scored_rows(df, p).groupBy(b.alias("b")).agg(*aggs)
    dense = spark.range(T + 1).select(F.col("id").cast("int").alias("b"))
    full = dense.join(buckets, "b", "left").na.fill(0, ["pos", "n"])
    if amount:
        full = full.withColumn("amt_pos", F.coalesce("amt_pos", F.lit(0).cast("decimal(30,6)")))
    # suffix over buckets > i (rows with p >= t_i); the table has T+1 rows.
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.col("b"), F.sum("pos").over(w).alias("s_pos"), F.sum("n").over(w).alias("s_n"),
            F.sum("pos").over(Window.partitionBy()).alias("P"), F.sum("n").over(Window.partitionBy()).alias("N_all")]
    if amount:
        cols += [F.sum("amt_pos").over(w).alias("s_amt"), F.sum("amt_pos").over(Window.partitionBy()).alias("A")]
    suf = full.select(*cols)
    # threshold i predicts positive for buckets b >= i+1
    out = grid_frame(spark, g).join(suf, F.col("b") == F.col("i") + 1, "inner")
    sel = [
        "i", "threshold",
        F.col("s_pos").cast("bigint").alias("tp"),
        (F.col("s_n") - F.col("s_pos")).cast("bigint").alias("fp"),
        ((F.col("N_all") - F.col("P")) - (F.col("s_n") - F.col("s_pos"))).cast("bigint").alias("tn"),
        (F.col("P") - F.col("s_pos")).cast("bigint").alias("fn"),
    ]
    if amount:
        sel += [F.col("s_amt").alias("caught_amt"), (F.col("A") - F.col("s_amt")).alias("escaped_amt"),
                F.col("A").alias("total_pos_amt")]
    return out.select(*sel)


def threshold_search(df: DataFrame, search: P.ThresholdSearch = P.ThresholdSearch(),
                     y: str = "y", p: str = "p") -> DataFrame:
    """Maximise F2 (or F1) over linspace(low, high, steps); the lowest tied t wins."""
    beta = 2.0 if search.metric == "f2_score" else 1.0
    gc = grid_counts(df, search.grid(), y, p)
    scored = gc.select("threshold", fbeta(F.col("tp"), F.col("fp"), F.col("fn"), beta).alias("score"))
    return scored.agg(
        F.max_by("threshold", F.struct(F.col("score"), -F.col("threshold"))).alias("threshold"),
        F.max("score").alias("best_score"),
    )



# --------------------------------------------------------------------------
# Report, composite, gates, ranking, selection
# --------------------------------------------------------------------------
def composite(weights: dict = P.COMPOSITE_WEIGHTS) -> Column:
    return (dlit(weights["f2"]) * F.col("f2_score") + dlit(weights["pr_auc"]) * F.col("pr_auc")
            + dlit(weights["roc_auc"]) * F.col("roc_auc") + dlit(weights["f1"]) * F.col("f1_score"))


def gate_failures(gates: dict = P.MIN_GATES) -> Column:
    """Array of failure messages (empty = passes)."""
    checks = [
        F.when(F.col("recall") < dlit(gates["recall"]),
               F.format_string(f"recall=%.4f < {gates['recall']:.2f}", rnd("recall", 4))),
        F.when(F.col("precision") < dlit(gates["precision"]),
               F.format_string(f"precision=%.4f < {gates['precision']:.2f}", rnd("precision", 4))),
        F.when(F.col("roc_auc") < dlit(gates["roc_auc"]),
               F.format_string(f"roc_auc=%.4f < {gates['roc_auc']:.2f}", rnd("roc_auc", 4))),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def metrics_reports(df: DataFrame, group: str = "model", thresholds: dict | None = None,
                    search: P.ThresholdSearch = P.ThresholdSearch(), weights: dict = P.COMPOSITE_WEIGHTS,
                    gates: dict = P.MIN_GATES, y: str = "y", p: str = "p",
                    n_buckets: int | None = None) -> DataFrame:
    """E13 for several models at once: ``df`` is long (group, y, p). The rows are
    counted once per (group, score) and written; the grid search, the counts at the
    chosen thresholds and both AUCs all read those counts. ``thresholds`` fixes the
    threshold of some groups; the others are searched. The driver sees groups x
    (grid + 2) counts and two numbers per group."""
    spark, fixed = df.sparkSession, {k: float(v) for k, v in (thresholds or {}).items() if v is not None}
    counted = scored_rows(df, p).groupBy(F.col(group).alias("g"), F.col(p).cast("double").alias("score")).agg(
        F.sum((F.col(y) == 1).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
    counted = materialize(counted.withColumn("neg", F.col("n") - F.col("pos")), "score-counts")

    grid = [float(t) for t in search.grid()]
    edges = sorted({*grid, *fixed.values()})
    rows = counted.groupBy("g", count_edges_le("score", edges).alias("b")).agg(
        F.sum("pos").alias("pos"), F.sum("n").alias("n")).collect()
    above: dict = {}  # group -> per edge (tp, fp) of scores >= edge, then the totals
    for g in sorted({r.g for r in rows}):
        tp, fp = [0] * (len(edges) + 1), [0] * (len(edges) + 1)
        for r in rows:
            if r.g == g:
                for b in range(r.b + 1):
                    tp[b] += r.pos
                    fp[b] += r.n - r.pos
        above[g] = tp, fp
    beta2 = 4.0 if search.metric == "f2_score" else 1.0

    def at(g, t):
        tp, fp = above[g]
        i = edges.index(t) + 1
        return tp[i], fp[i], fp[0] - fp[i], tp[0] - tp[i]

    def score(g, t):
        tp, fp, _, fn = at(g, t)
        d = (1.0 + beta2) * tp + beta2 * fn + fp
        return (1.0 + beta2) * tp / d if d > 0 else 0.0

    auc = {r.g: r for r in _auc_from(running_sums(
        counted, ["score"], {"tp": "pos", "fp": "neg"}, partition_cols=["g"], descending=True, n_buckets=n_buckets)
        .select("g", "pos", "neg", F.col("cum_tp").alias("tp"), F.col("cum_fp").alias("fp")).groupBy("g"), "g").collect()}
    made = []
    for g in above:
        t = fixed[g] if g in fixed else min(grid, key=lambda t, g=g: (-score(g, t), t))
        tp, fp, tn, fn = at(g, t)
        made.append((g, tp + fp + tn + fn, tp + fn, fp + tn, tp, fp, tn, fn, t, auc[g].roc_auc, auc[g].pr_auc))
    rep = spark.createDataFrame(made, f"{group} string, n_samples long, n_fraud long, n_legitimate long, tp long, fp long, "
                                      "tn long, fn long, threshold double, roc_auc double, pr_auc double")
    rep = with_rates(rep)
    rep = rep.withColumn("composite_score", composite(weights))
    fails = gate_failures(gates)
    return rep.withColumn("gate_failures", fails).withColumn("passes_gates", F.size(fails) == 0)


def metrics_report(df: DataFrame, threshold: float | None = None,
                   search: P.ThresholdSearch = P.ThresholdSearch(),
                   weights: dict = P.COMPOSITE_WEIGHTS, gates: dict = P.MIN_GATES,
                   y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """One row with counts, rates, AUCs, threshold (searched when None),
    composite and gate outcome."""
    if threshold is None:
        # one number reaches the driver; as a scalar subquery Spark would
        # re-run the search once per reference to it (no subquery reuse)
        threshold = float(threshold_search(df, search, y, p).first()["threshold"])
    t = dlit(threshold)
    scored = scored_rows(df, p).select(F.col(y).alias("_y"), F.col(p).cast("double").alias("_p"))
    pred = F.col("_p") >= t
    pos = F.col("_y") == 1
    counts = scored.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(pos).cast("bigint").alias("n_fraud"),
        F.count_if(~pos).cast("bigint").alias("n_legitimate"),
        F.count_if(pred & pos).cast("bigint").alias("tp"),
        F.count_if(pred & ~pos).cast("bigint").alias("fp"),
        F.count_if(~pred & ~pos).cast("bigint").alias("tn"),
        F.count_if(~pred & pos).cast("bigint").alias("fn"),
    )
    counts = counts.withColumn("threshold", t)
    # both AUCs from ONE run of the curve pipeline: two numbers reach the
    # driver (scalar subqueries are not reused, so each would re-run it)
    a = auc_scores(df, y, p, n_buckets).first()
    rep = with_rates(counts).withColumns({"roc_auc": dlit(a["roc_auc"]), "pr_auc": dlit(a["pr_auc"])})
    rep = rep.withColumn("composite_score", composite(weights))
    fails = gate_failures(gates)
    return rep.withColumn("gate_failures", fails).withColumn("passes_gates", F.size(fails) == 0)


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rank by composite (desc, then model name), winner = rank 1 and passing."""
    w = Window.orderBy(F.col("composite_score").desc(), F.col("model"))
    return (metrics.withColumn("rank", F.row_number().over(w))
            .withColumn("selected", (F.col("rank") == 1) & F.col("passes_gates")))


def select_best(metrics: DataFrame, exclude: Sequence[str] = ("dummy_baseline",)) -> DataFrame:
    """Among non-excluded models, best composite of the passing pool, or
    of all when none passes. An empty pool gives no row."""
    pool = metrics.filter(~F.col("model").isin(*exclude))
    # one row per model: this window runs over a handful of rows
    w = Window.orderBy(F.col("passes_gates").cast("int").desc(), F.col("composite_score").desc(),
                       F.col("model"))
    return (pool.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("model", F.col("passes_gates").alias("from_passing_pool")))
