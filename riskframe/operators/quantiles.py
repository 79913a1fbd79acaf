"""Exact quantiles (linear interpolation) without a single-task value buffer.

Spark's exact ``percentile`` keeps a value->count map per group and merges it
in one task, which does not survive billions of distinct doubles. Here rows
are counted per (group, range bucket); the counts say which bucket holds each
of the two ranks around a requested probability, and only the distinct values of those
buckets are sorted, with their counts: a value that a third of all rows share is one
row. All other rows are read and counted, never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dlit
from .ordered import BUCKET, assign_bucket, default_buckets, range_edges

def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                    n_buckets: int | None = None) -> DataFrame:
    """Rows (group..., q_index, prob, quantile); NULL and NaN values are ignored.

    Matches ``numpy.quantile(method='linear')``: h = (n-1) q, value =
    lerp(x[floor h], x[ceil h], h - floor h) with numpy's two-sided lerp.
    """
    groups = list(group_cols)
    v = F.col(value).cast("double")
    clean = df.select(*groups, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    edges = range_edges(clean, "_v", n_buckets or default_buckets(df.sparkSession))
    base = assign_bucket(clean, "_v", edges)
    # rank span of every (group, bucket): at most groups x buckets rows
    w = Window.partitionBy(*groups).orderBy(BUCKET) if groups else Window.partitionBy(F.lit(0)).orderBy(BUCKET)
    spans = base.groupBy(*groups, BUCKET).agg(F.count(F.lit(1)).alias("_c"))
    spans = spans.withColumn("_end", F.sum("_c").over(w)).withColumn("_start", F.col("_end") - F.col("_c"))
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    spans = spans.withColumn("_n", F.max("_end").over(whole))

    # the two ranks around each probability, kept where their bucket holds them
    parr = F.array(*[F.struct(F.lit(i).alias("q_index"), dlit(p).alias("prob")) for i, p in enumerate(probs)])
    tg = spans.select("*", F.explode(parr).alias("_q")).select(
        *groups, BUCKET, "_start", "_end", "_n", "_q.q_index", "_q.prob",
        (F.col("_q.prob") * (F.col("_n") - 1).cast("double")).alias("_h"))
    tg = tg.withColumns({"_lo": F.floor("_h"), "_t": F.col("_h") - F.floor("_h")})
    tg = tg.withColumn("_hi", F.least(F.col("_lo") + 1, F.col("_n") - 1))
    picks = tg.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col(BUCKET).alias("_pb"), "_start", "_end", "q_index", "prob", "_t",
                      F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("_lo").alias("rank")),
                                        F.struct(F.lit(1).alias("side"), F.col("_hi").alias("rank")))).alias("_s"))
    picks = picks.select("*", "_s.side", "_s.rank").drop("_s").where((F.col("rank") >= F.col("_start")) & (F.col("rank") < F.col("_end")))
    # only buckets that hold a wanted rank are sorted
    wanted = picks.groupBy(*[f"_g_{g}" for g in groups], "_pb").agg(
        F.collect_list(F.struct("q_index", "prob", "_t", "side", (F.col("rank") - F.col("_start") + 1).alias("at"))).alias("_picks"))
    match = F.col(BUCKET) == F.col("_pb")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    # a repeated value is one row with its count before it is shuffled
    near = base.join(wanted, match, "left_semi").groupBy(*groups, BUCKET, "_v").agg(F.count(F.lit(1)).alias("_m"))
    order = Window.partitionBy(*groups, BUCKET).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = near.withColumn("_i", F.sum("_m").over(order)).join(wanted, match, "inner")
    here = F.filter("_picks", lambda x: (x["at"] <= F.col("_i")) & (x["at"] > F.col("_i") - F.col("_m")))
    joined = placed.select(*groups, "_v", here.alias("_picks")).where(
        F.size("_picks") > 0).select(*groups, "_v", F.explode("_picks").alias("_p")).select(*groups, "_v", "_p.*")
    vals = joined.groupBy(*groups, "q_index", "prob", "_t").agg(
        F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_b"))
    a, b, t = F.col("_a"), F.col("_b"), F.col("_t")
    diff = b - a
    lerp = F.when(t >= dlit(0.5), b - diff * (dlit(1.0) - t)).otherwise(a + diff * t)
    return vals.select(*groups, "q_index", "prob", lerp.alias("quantile"))
