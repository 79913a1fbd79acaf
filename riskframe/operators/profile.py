"""Stored reference profile for drift: what live windows are compared with.

A version of a profile is two tables below one shared folder:

* ``ecdf/version=V``: (feature, value, c), the reference's values with their counts. Counts of two
  references add up, so profiles merge without their rows.
* ``summary/version=V``: per feature n, mean, population deviation, the PSI edges and the counts of
  their bins. It is written last and makes the version visible.

A live window then reads a few summary rows for PSI and moments, and the counted values for the
distances; the reference's rows are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import columns as C
from ..functions.columns import dlit
from .drift import _bin, distances_of_counts, ks_two_sample_pvalue, psi_of_bins, to_long
from .ordered import running_sums

N_BINS = 10


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(feature, q_index, quantile) of (feature, value, c), linear between the two ranks
    around each probability as in :func:`quantiles.exact_quantiles`."""
    rs = running_sums(counts, ["value"], {"n": "c"}, partition_cols=["feature"])
    n = counts.groupBy("feature").agg(F.sum("c").alias("_n"))
    at = F.array(*[F.struct(F.lit(i).alias("q"), (dlit(p) * (F.col("_n") - 1).cast("double")).alias("h")) for i, p in enumerate(probs)])
    here = F.filter("_at", lambda s: (F.least(F.floor(s["h"]) + 1, F.col("_n") - 1) >= F.col("cum_n") - F.col("c"))
                    & (F.floor(s["h"]) < F.col("cum_n")))  # the value holds one of the two ranks
    found = rs.join(n.withColumn("_at", at), "feature").select("feature", "value", "cum_n", "c", "_n", F.explode(here).alias("s"))
    low = (F.floor("s.h") >= F.col("cum_n") - F.col("c")) & (F.floor("s.h") < F.col("cum_n"))
    up = F.least(F.floor("s.h") + 1, F.col("_n") - 1)
    high = (up >= F.col("cum_n") - F.col("c")) & (up < F.col("cum_n"))
    two = found.groupBy("feature", F.col("s.q").alias("q_index"), (F.col("s.h") - F.floor("s.h")).alias("t")).agg(
        F.max(F.when(low, F.col("value"))).alias("a"), F.max(F.when(high, F.col("value"))).alias("b"))
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    lerp = F.when(t >= dlit(0.5), b - (b - a) * (dlit(1.0) - t)).otherwise(a + (b - a) * t)
    return two.select("feature", "q_index", lerp.alias("quantile"))


def summarise(counts: DataFrame, edge_digits: int | None = None) -> DataFrame:
    """The summary of counted values."""
    q = quantiles_of_counts(counts, [i / N_BINS for i in range(N_BINS + 1)])
    if edge_digits is not None:
        q = q.withColumn("quantile", C.rnd("quantile", edge_digits))
    q = q.withColumn("quantile", F.when(F.col("q_index") == 0, dlit(float("-inf")))
                     .when(F.col("q_index") == N_BINS, dlit(float("inf"))).otherwise(F.col("quantile")))
    edges = q.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q_index", "quantile"))), lambda s: s["quantile"]).alias("edges"))
    w, v = F.col("c").cast("double"), F.col("value")
    mean = counts.groupBy("feature").agg(F.sum("c").alias("n"), (F.sum(v * w) / F.sum(w)).alias("mean")).join(edges, "feature")
    binned = counts.join(mean, "feature").withColumn("bin", _bin(v, F.col("edges"), N_BINS))
    per = binned.groupBy("feature", "n", "mean", "edges", "bin").agg(F.sum("c").alias("k"), F.sum((v - F.col("mean")) ** 2 * w).alias("m2"))
    return per.groupBy("feature", "n", "mean", "edges").agg(
        F.sqrt(F.sum("m2") / F.first("n")).alias("std"), F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias("bins"))


def save_profile(reference: DataFrame, root: str, version: int, features: Sequence[str] = P.DRIFT_FEATURES,
                 edge_digits: int | None = None) -> None:
    """Writes version ``version`` of the profile of a wide reference table."""
    counts = to_long(reference, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    _write(counts, root, version, edge_digits)


def merge_profiles(spark: SparkSession, root: str, versions: Sequence[int], version: int, edge_digits: int | None = None) -> None:
    """Writes the profile of several references together, from their counts alone."""
    parts = [spark.read.parquet(f"{root}/ecdf/version={v}") for v in versions]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    _write(every.groupBy("feature", "value").agg(F.sum("c").alias("c")), root, version, edge_digits)


def _write(counts: DataFrame, root: str, version: int, edge_digits: int | None) -> None:
    spark = counts.sparkSession
    counts.write.mode("overwrite").parquet(f"{root}/ecdf/version={version}")
    written = spark.read.parquet(f"{root}/ecdf/version={version}")
    summarise(written, edge_digits).write.mode("overwrite").parquet(f"{root}/summary/version={version}")


def latest_version(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/summary").agg(F.max("version").alias("v")).first()["v"]


def profile_drift(live: DataFrame, root: str, version: int | None = None, min_live: int = 3) -> DataFrame:
    """One row per monitored feature of ``live`` (wide) with at least ``min_live`` values: PSI,
    status, colour, KS, p-value, Wasserstein, and both sides' moments."""
    spark = live.sparkSession
    version = latest_version(spark, root) if version is None else version
    summary = spark.read.parquet(f"{root}/summary/version={version}")
    features = [r["feature"] for r in summary.select("feature").collect()]  # the monitored features
    rows = to_long(live, features, min_values=min_live)
    seen = rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c_live"))
    own = seen.join(F.broadcast(summary.select("feature", "edges")), "feature").withColumn("bin", _bin(F.col("value"), F.col("edges"), N_BINS))
    live_bins = own.groupBy("feature", "bin").agg(F.sum("c_live").alias("k")).groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias("live_bins"))
    both = summary.join(live_bins, "feature")
    grid = F.sequence(F.lit(0), F.lit(N_BINS - 1))
    zero = F.lit(0).cast("long")
    bins = F.transform(grid, lambda b: F.struct(b.alias("bin"), F.coalesce(F.col("bins")[b], zero).alias("n_ref"),
                                                F.coalesce(F.col("live_bins")[b], zero).alias("n_live")))
    count = lambda f: F.aggregate("bins2", zero, lambda acc, s: acc + s[f])
    per = both.select("feature", bins.alias("bins2"))
    per = per.select("feature", F.col("bins2").alias("bins"), count("n_ref").alias("tot_ref"), count("n_live").alias("tot_live"))
    ecdf = spark.read.parquet(f"{root}/ecdf/version={version}").join(F.broadcast(live_bins.select("feature")), "feature", "left_semi")
    g = ecdf.select("feature", "value", F.col("c").alias("c_ref"), zero.alias("c_live")).unionByName(
        seen.select("feature", "value", zero.alias("c_ref"), "c_live")).groupBy("feature", "value").agg(
        F.sum("c_ref").alias("c_ref"), F.sum("c_live").alias("c_live"))
    far = distances_of_counts(g, summary.select("feature", F.col("std").alias("std_ref")))
    mine = rows.groupBy("feature").agg(F.avg("value").alias("stream_mean"), F.stddev_pop("value").alias("stream_std"))
    out = psi_of_bins(per, N_BINS).join(far.drop("n_ref", "n_live"), "feature").join(
        summary.select("feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std")), "feature").join(mine, "feature")
    return out.withColumn("p_value", ks_two_sample_pvalue(F.col("ks_statistic"), F.col("tot_ref"), F.col("tot_live")))
