"""Drift between a reference cohort and a live cohort.

* PSI: reference quantile edges (exact, distributed), each row binned by
  counting interior edges <= x (numpy.histogram semantics, repeated edges
  included), +1e-4 smoothing, sum (a - r) ln(a / r).
* KS and Wasserstein-1: one ``groupBy(feature, value)`` with reference / live
  counts, then running sums in value order per feature (range-bucketed, so a
  feature with billions of distinct values is not one task).

Every function takes long input ``(feature, value)`` (a single score is the
feature ``'score'``), so all monitored features run in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit
from ..session import materialize
from .ordered import running_sums
from .quantiles import exact_quantiles

SMOOTH = 1e-4


def to_long(df: DataFrame, features: Sequence[str], min_values: int = 0) -> DataFrame:
    """(feature, value) rows for the monitored features present in
    ``df``; NULL and NaN dropped; features with fewer than ``min_values`` values
    are skipped (a grouped count, joined back)."""
    present = [f for f in features if f in df.columns]
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in present])
    long = df.select(F.explode(arr).alias("r")).select("r.*").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if min_values > 0:
        keep = long.groupBy("feature").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_values)
        long = long.join(keep.select("feature"), "feature", "left_semi")
    return long


def flatten_map(df: DataFrame, map_col: str, keys: Sequence[str]) -> DataFrame:
    """Nested ``raw_features`` map -> one column per key (NULL when absent)."""
    return df.withColumns({k: F.col(map_col)[k] for k in keys})


def psi_edges(ref: DataFrame, n_bins: int = 10, outer: tuple[float, float] | None = None,
              edge_digits: int | None = None) -> DataFrame:
    """(feature, edges array of n_bins+1) from reference quantiles; the outer
    edges are replaced by ``outer`` (default ±inf)."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(ref, "value", probs, ["feature"])
    if edge_digits is not None:
        q = q.withColumn("quantile", C.rnd("quantile", edge_digits))
    lo, hi = outer if outer is not None else (float("-inf"), float("inf"))
    q = q.withColumn("quantile", F.when(F.col("q_index") == 0, dlit(lo))
                     .when(F.col("q_index") == n_bins, dlit(hi)).otherwise(F.col("quantile")))
    return q.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_index", "quantile"))), lambda s: s["quantile"]).alias("edges"))


def _bin(x: Column, edges: Column, n_bins: int) -> Column:
    interior = F.slice(edges, 2, n_bins - 1)
    inside = (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when(inside, F.size(F.filter(interior, lambda e: e <= x)))


def psi(ref: DataFrame, live: DataFrame, n_bins: int = 10, outer: tuple[float, float] | None = None,
        edge_digits: int | None = None, status_labels: Sequence[str] = P.PSI_STATUS,
        min_rows: int = 0) -> DataFrame:
    """D1/D2/D3 per feature: psi (max 0, 4 places), status and colour.

    ``min_rows``: when either cohort of a feature has fewer rows the result is
    0.0 / first status (the insufficient-data convention)."""
    edges = materialize(psi_edges(ref, n_bins, outer, edge_digits), "psi-edges")  # read three times
    # one row per monitored feature: bounded by the feature list
    edges = F.broadcast(edges)

    def counts(df: DataFrame, name: str) -> DataFrame:
        b = df.join(edges, "feature").select("feature", _bin(F.col("value"), F.col("edges"), n_bins).alias("bin"))
        return b.filter(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias(name))

    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    full = grid.join(counts(ref, "n_ref"), ["feature", "bin"], "left") \
        .join(counts(live, "n_live"), ["feature", "bin"], "left").na.fill(0, ["n_ref", "n_live"])
    per = full.groupBy("feature").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_live").alias("tot_live"),
        F.collect_list(F.struct("bin", "n_ref", "n_live")).alias("bins"))
    return psi_of_bins(per, n_bins, status_labels, min_rows)


def psi_of_bins(per: DataFrame, n_bins: int = 10, status_labels: Sequence[str] = P.PSI_STATUS, min_rows: int = 0) -> DataFrame:
    """PSI of (feature, tot_ref, tot_live, bins array of (bin, n_ref, n_live))."""
    sm = dlit(SMOOTH)
    denom_r = F.col("tot_ref") + dlit(SMOOTH * n_bins)
    denom_a = F.col("tot_live") + dlit(SMOOTH * n_bins)

    def term(acc, s):
        r = (s["n_ref"] + sm) / denom_r
        a = (s["n_live"] + sm) / denom_a
        return acc + (a - r) * F.log(a / r)

    raw = F.aggregate(F.array_sort(F.col("bins")), dlit(0.0), term)
    score = C.rnd(F.greatest(raw, dlit(0.0)), 4)
    enough = (F.col("tot_ref") >= min_rows) & (F.col("tot_live") >= min_rows)
    score = F.when(enough, score).otherwise(dlit(0.0))
    return per.select("feature", "tot_ref", "tot_live", score.alias("psi_score"),
                      C.psi_status(score, status_labels).alias("status"), C.psi_color(score).alias("color"))


def ecdf_distances(ref: DataFrame, live: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """D4 + D6 per feature: KS statistic and Wasserstein-1 on reference-standardised
    values (population std of the reference; std <= 1e-6 -> 1)."""
    both = ref.select("feature", "value", F.lit(1).alias("_r")).unionByName(
        live.select("feature", "value", F.lit(0).alias("_r")))
    g = both.groupBy("feature", "value").agg(F.count_if(F.col("_r") == 1).alias("c_ref"),
                                             F.count_if(F.col("_r") == 0).alias("c_live"))
    return distances_of_counts(g, ref.groupBy("feature").agg(F.stddev_pop("value").alias("std_ref")), n_buckets)


def distances_of_counts(g: DataFrame, stats: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """The distances of (feature, value, c_ref, c_live), values distinct within a feature;
    ``stats`` has the reference's ``std_ref`` per feature."""
    g = materialize(g, "value-counts")  # the edges, the buckets' totals, the sums and the sizes read the counts
    rs = running_sums(g, ["value"], {"ref": "c_ref", "live": "c_live"}, partition_cols=["feature"],
                      n_buckets=n_buckets, with_next=True)
    tot = g.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_live").alias("n_live"))
    x = rs.join(tot, "feature").select(
        "feature", "value", "next_value",
        F.abs(F.col("cum_ref") / F.col("n_ref").cast("double") - F.col("cum_live") / F.col("n_live").cast("double"))
        .alias("gap"))
    agg = x.groupBy("feature").agg(
        F.max("gap").alias("ks_statistic"),
        F.sum(F.when(F.col("next_value").isNotNull(), F.col("gap") * (F.col("next_value") - F.col("value"))))
        .alias("w_raw"))
    scale = F.when(F.col("std_ref") > dlit(1e-6), F.col("std_ref")).otherwise(dlit(1.0))
    return agg.join(stats, "feature").join(tot, "feature").select(
        "feature", "n_ref", "n_live", "ks_statistic",
        (F.coalesce(F.col("w_raw"), dlit(0.0)) / scale).alias("wasserstein_distance"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov p-value with the effective sample
    size correction: Q_KS((sqrt(ne) + 0.12 + 0.11/sqrt(ne)) D), ne = nm/(n+m)."""
    en = F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    lam = (en + dlit(0.12) + dlit(0.11) / en) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), dlit(0.0),
                         lambda acc, k: acc + F.pow(dlit(-1.0), (k - 1).cast("double"))
                         * F.exp(dlit(-2.0) * (k * k).cast("double") * lam * lam))
    p = dlit(2.0) * series
    return F.when(lam < dlit(1e-3), dlit(1.0)).otherwise(F.least(dlit(1.0), F.greatest(dlit(0.0), p)))


#: Rows of the larger cohort up to which the p-value is exact.
EXACT_ROWS = 10_000


def exact_ks_tail(d: float, n: int, m: int) -> float:
    """P(D >= d) of two samples of n and m values without ties under one distribution, exactly:
    the share of the lattice paths from (0, 0) to (n, m) that come to a point with
    |x / n - y / m| >= d. Paths are walked step by step as a chain of drawing without
    replacement, and what leaves the band is added up, so that small tails keep their digits."""
    reach = round(d * n * m)
    if reach <= 0:
        return 1.0
    x = np.arange(n + 1)
    inside, out = np.zeros(n + 1), 0.0
    inside[0] = 1.0
    for k in range(n + m):
        y, left = k - x, n + m - k
        step = inside * np.clip(m - y, 0, None) / left
        step[1:] += inside[:-1] * (n - x[:-1]) / left
        over = np.abs(x * m - (y + 1) * n) >= reach
        out += float(step[over].sum())
        step[over] = 0.0
        inside = step
    return min(1.0, out)


def _exact_tails(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """One number for each of a few features; NULL above EXACT_ROWS."""
    return pd.Series([None if a is None or a != a or max(b, c) > EXACT_ROWS or min(b, c) < 1 else exact_ks_tail(a, int(b), int(c))
                      for a, b, c in zip(d, n, m, strict=True)], dtype="float64")


def ks_two_sample_pvalue(d: Column, n: Column, m: Column) -> Column:
    """The exact two-sided p-value up to EXACT_ROWS rows in the larger cohort, the
    Kolmogorov series above; NULL without a statistic or with an empty cohort."""
    return F.when(d.isNotNull() & (n > 0) & (m > 0), F.coalesce(F.pandas_udf(_exact_tails, T.DoubleType())(d, n, m), ks_pvalue(d, n, m)))


def moments(ref: DataFrame, live: DataFrame) -> DataFrame:
    """Reference and live mean / population std per feature (3 places)."""
    r = ref.groupBy("feature").agg(F.avg("value").alias("ref_mean"), F.stddev_pop("value").alias("ref_std"))
    a = live.groupBy("feature").agg(F.avg("value").alias("stream_mean"), F.stddev_pop("value").alias("stream_std"))
    return r.join(a, "feature")


def feature_drift(ref_df: DataFrame, live_df: DataFrame, features: Sequence[str] = P.DRIFT_FEATURES,
                  min_live: int = 3, edge_digits: int | None = None, n_buckets: int | None = None) -> DataFrame:
    """D2-D9 combined: one row per monitored feature with psi, KS, p-value,
    Wasserstein, status, colour and moments."""
    ref = to_long(ref_df, features)
    live = to_long(live_df, features, min_values=min_live)
    ref = ref.join(live.select("feature").distinct(), "feature", "left_semi")
    p = psi(ref, live, edge_digits=edge_digits)
    e = ecdf_distances(ref, live, n_buckets)
    mo = moments(ref, live)
    out = p.join(e.drop("n_ref", "n_live"), "feature").join(mo, "feature")
    return out.withColumn("p_value", ks_two_sample_pvalue(F.col("ks_statistic"), F.col("tot_ref"), F.col("tot_live")))


def overall_status(drift: DataFrame) -> DataFrame:
    """CRITICAL if any, else MODERATE if any, else STABLE."""
    sev = F.when(F.col("status") == P.PSI_STATUS[2], 2).when(F.col("status") == P.PSI_STATUS[1], 1).otherwise(0)
    arr = F.array(*[F.lit(s) for s in P.PSI_STATUS])
    return drift.agg(F.coalesce(F.max(sev), F.lit(0)).alias("_s"), F.count(F.lit(1)).alias("monitored_feature_count")) \
        .select(F.element_at(arr, F.col("_s") + 1).alias("overall_drift_status"), "monitored_feature_count")
