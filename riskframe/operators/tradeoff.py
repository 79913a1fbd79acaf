"""Threshold trade-off and cost optimisation.

One bucketed pass over the scored rows (see :func:`metrics.grid_counts`)
yields counts and positive dollars for every grid threshold; all the rest is
arithmetic on a table with one row per threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import darray, count_edges_le, dlit, rnd
from .metrics import grid_counts


def tradeoff_curve(df: DataFrame, cost: P.CostParams = P.CostParams(),
                   y: str = "y", p: str = "p", amount: str = "Amount") -> DataFrame:
    """T1 (and T5 with a caller grid): one row per threshold, ascending.

    recall % and precision % (precision is 1.0 when nothing is flagged), F1/F2
    from those rates, dollars caught / escaped (exact decimal sums), alert
    cost ``fp * c`` and net cost ``alert + escaped * multiplier`` (+ optional
    friction per alert).
    """
    gc = grid_counts(df, cost.grid, y, p, amount=amount)
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    P_ = (F.col("tp") + F.col("fn")).cast("double")
    recall = F.when(P_ > 0, tp / P_).otherwise(dlit(0.0))
    precision = F.when((F.col("tp") + F.col("fp")) > 0, tp / (tp + fp)).otherwise(dlit(1.0))
    f1 = F.when(precision + recall > 0, dlit(2.0) * precision * recall / (precision + recall)).otherwise(dlit(0.0))
    f2 = F.when(dlit(4.0) * precision + recall > 0,
                dlit(5.0) * precision * recall / (dlit(4.0) * precision + recall)).otherwise(dlit(0.0))
    caught = F.col("caught_amt").cast("double")
    escaped = F.col("escaped_amt").cast("double")
    alert = fp * dlit(cost.cost_per_false_alert)
    net = alert + escaped * dlit(cost.fraud_multiplier) + fp * dlit(cost.friction_per_alert)
    return gc.select(
        F.col("i").alias("grid_index"),
        rnd("threshold", 4).alias("threshold"),
        rnd(recall * 100, 2).alias("recall"),
        rnd(precision * 100, 2).alias("precision"),
        rnd(f1, 4).alias("f1_score"),
        rnd(f2, 4).alias("f2_score"),
        "tp", "fp", "tn", "fn",
        rnd(caught, 2).alias("fraud_caught_dollars"),
        rnd(escaped, 2).alias("fraud_escaped_dollars"),
        rnd(alert, 2).alias("alert_review_cost"),
        rnd(net, 2).alias("net_financial_cost"),
        net.alias("_net_raw"),
        F.col("total_pos_amt").cast("double").alias("_total_pos_amt"),
    )


def cost_optimal(curve: DataFrame) -> DataFrame:
    """Argmin of the unrounded net cost; the lowest tied threshold wins."""
    return curve.agg(
        F.min_by("threshold", F.struct(F.col("_net_raw"), F.col("threshold"))).alias("cost_optimal_threshold"),
        rnd(F.min("_net_raw"), 2).alias("min_total_cost"),
    )


def cost_assumptions(df: DataFrame, cost: P.CostParams = P.CostParams(),
                     y: str = "y", amount: str = "Amount") -> DataFrame:
    """T4: total positives and total positive dollars (exact decimal sum)."""
    return df.agg(
        F.count_if(F.col(y) == 1).cast("bigint").alias("total_fraud_count"),
        F.round(F.coalesce(F.sum(F.when(F.col(y) == 1, F.col(amount).cast("decimal(30,6)"))),
                           F.lit(0).cast("decimal(30,6)")).cast("double"), 2).alias("total_fraud_dollars"),
    ).withColumns({"cost_per_false_alert": dlit(cost.cost_per_false_alert),
                   "fraud_multiplier": dlit(cost.fraud_multiplier)})


def nearest_rows(curve: DataFrame, targets: Sequence[float], keys: Sequence[float],
                 key: str = "threshold") -> DataFrame:
    """For each target the curve row with the smallest |key - target|; the
    first row in curve order wins ties.

    ``keys`` are the curve's sorted key values (the grid, known to the caller).
    The insertion point j of a target among them leaves only rows j-1 and j as
    candidates, so the match is an equi-join on ``grid_index`` with two
    candidates per target - never a target x grid product.
    """
    spark = curve.sparkSession
    ks = sorted(round(float(k), 4) for k in keys)
    arr = darray(targets)
    tg = spark.range(len(targets)).select(F.col("id").cast("int").alias("target_index"),
                                          F.element_at(arr, F.col("id").cast("int") + 1).alias("target"))
    j = count_edges_le("target", ks)
    tg = tg.select("*", F.explode(F.array(j - 1, j)).alias("grid_index"))
    cand = tg.join(curve, "grid_index", "inner")
    best = cand.groupBy("target_index", "target").agg(
        F.min_by(F.struct(*[F.col(c) for c in curve.columns]),
                 F.struct(F.abs(F.col(key) - F.col("target")), F.col("grid_index"))).alias("row"))
    return best.select("target_index", "target", "row.*")


def policy_table(curve: DataFrame, keys: Sequence[float] = P.TRADEOFF_GRID,
                 demo: Sequence[float] = P.DEMO_THRESHOLDS,
                 active: float = P.DEFAULT_THRESHOLD) -> DataFrame:
    """Demonstration thresholds matched to the nearest grid row, named by
    rules applied in order (≈ active, ≤ 0.10, ≥ 0.70, else)."""
    rows = nearest_rows(curve, demo, keys)
    t = F.col("target")
    name = (F.when(F.abs(t - dlit(active)) < dlit(1e-4), F.array(*map(F.lit, P.POLICY_ACTIVE)))
            .when(t <= dlit(0.10), F.array(*map(F.lit, P.POLICY_AGGRESSIVE)))
            .when(t >= dlit(0.70), F.array(*map(F.lit, P.POLICY_LOW_FRICTION)))
            .otherwise(F.array(*map(F.lit, P.POLICY_BALANCED))))
    return rows.withColumn("policy_name", name[0]).withColumn("badge", name[1])
