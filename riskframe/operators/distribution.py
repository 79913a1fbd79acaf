"""Score distributions (B1-B5): percentiles, histograms, ECDF, categories.

Histograms are edge-literal binning + ``groupBy(bin)`` with the empty bins
kept by joining a dense bin table; percentiles use the exact distributed
quantiles; ECDF points come from one pass of conditional counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit
from .quantiles import exact_quantiles


def score_percentiles(df: DataFrame, score: str = "risk_score",
                      points: Sequence[tuple[str, float]] = P.SCORE_PERCENTILES) -> DataFrame:
    """B1: linear-interpolated percentiles of integer scores, truncated to int."""
    q = exact_quantiles(df, score, [p for _, p in points])
    names = F.array(*[F.lit(n) for n, _ in points])
    return q.select(F.element_at(names, F.col("q_index") + 1).alias("name"), F.col("prob"),
                    F.col("quantile").cast("int").alias("value"))


def _dense_hist(df: DataFrame, bin_col, labels: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    lab = F.array(*[F.lit(x) for x in labels])
    dense = spark.range(len(labels)).select(F.col("id").cast("int").alias("bin"))
    counts = df.select(bin_col.alias("bin")).filter(F.col("bin").isNotNull()).groupBy("bin") \
        .agg(F.count(F.lit(1)).alias("count"))
    h = dense.join(counts, "bin", "left").na.fill(0, ["count"])
    total = counts.agg(F.sum("count").alias("t")).select("t").scalar()
    return h.select("bin", F.element_at(lab, F.col("bin") + 1).alias("label"), "count",
                    F.coalesce(C.rnd(F.try_divide(F.col("count").cast("double"), total.cast("double")) * dlit(100.0), 2),
                               dlit(0.0)).alias("pct"))


def score_histogram(df: DataFrame, score: str = "risk_score", edges: Sequence[int] = P.SCORE_HIST_EDGES) -> DataFrame:
    """B2: bins [0,10), [10,20) ... [90,101] (last closed), labels '0-9' .. '90-100'."""
    labels = [f"{edges[i]}-{edges[i + 1] - 1}" for i in range(len(edges) - 1)]
    return _dense_hist(df, C.histogram_bin(score, edges), labels)


def score_ecdf(df: DataFrame, score: str = "risk_score", step: int = 5, top: int = 100) -> DataFrame:
    """% of scores <= x for x = 0, 5, ... 100 (one scan)."""
    xs = list(range(0, top + 1, step))
    s = F.col(score)
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(s <= x).alias(f"c{x}") for x in xs])
    arr = F.array(*[F.struct(F.lit(x).alias("score_threshold"), F.col(f"c{x}").alias("c")) for x in xs])
    return agg.select("n", F.explode(arr).alias("r")).select(
        "r.score_threshold",
        F.coalesce(C.rnd(F.try_divide(F.col("r.c").cast("double"), F.col("n").cast("double")) * dlit(100.0), 2),
                   dlit(0.0)).alias("cumulative_pct"))


def category_summary(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """<= 30 low, 31-70 medium, >= 71 high: counts and %."""
    s = F.col(score)
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(s <= 30).alias("low"),
                 F.count_if((s >= 31) & (s <= 70)).alias("medium"), F.count_if(s >= 71).alias("high"))
    arr = F.array(*[F.struct(F.lit(k).alias("category"), F.col(k).alias("count")) for k in ("low", "medium", "high")])
    return agg.select("n", F.explode(arr).alias("r")).select(
        "r.category", F.col("r.count").cast("bigint").alias("count"),
        F.coalesce(C.rnd(F.try_divide(F.col("r.count").cast("double"), F.col("n").cast("double")) * dlit(100.0), 2),
                   dlit(0.0)).alias("pct"))


def probability_histogram(df: DataFrame, p: str = "p", n_bins: int = 10) -> DataFrame:
    """Bins on the exact linspace(0, 1, n_bins+1) edges (last bin closed);
    ``floor(p * 10)`` would misplace values such as 0.3."""
    step = 1.0 / n_bins
    edges = [i * step for i in range(n_bins + 1)]
    edges[-1] = 1.0
    labels = [f"{i * 100 // n_bins}-{(i + 1) * 100 // n_bins}%" for i in range(n_bins)]
    return _dense_hist(df, C.histogram_bin(p, edges), labels)
