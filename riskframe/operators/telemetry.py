"""Transaction log and rolling telemetry.

"Last N" windows are count-based in the behaviour being matched; on a table
they are a top-N by (ts desc, id desc) - ``TakeOrderedAndProject`` keeps N
rows per partition, so the cost stays bounded by N, not by the log size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.columns import dlit


def transaction_log(scored: DataFrame, ts: str = "ts", key: str = "id") -> DataFrame:
    """L1: the append-only log record of each scored transaction. The id comes
    from the source (never a fresh ``uuid()``, which changes on task retry)."""
    return scored.withColumn("logged_at", F.col(ts))


def newest(log: DataFrame, n: int, ts: str = "ts", key: str = "id") -> DataFrame:
    """The ``n`` newest log rows (total order: ts desc, id desc)."""
    return log.orderBy(F.col(ts).desc(), F.col(key).desc()).limit(n)


def rolling_summary(log: DataFrame, n: int, ts: str = "ts", key: str = "id") -> DataFrame:
    """Counts over the newest ``n`` rows; an empty log gives zeros, never
    invented numbers."""
    total = log.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()
    w = newest(log, n, ts, key)
    s = F.col("risk_score")
    agg = w.agg(
        F.count(F.lit(1)).alias("recent_window_size"),
        F.count_if(F.col("is_flagged")).cast("bigint").alias("suspected_fraud_count"),
        F.count_if(s > 70).cast("bigint").alias("high_risk_count"),
        F.count_if((s >= 31) & (s <= 70)).cast("bigint").alias("medium_risk_count"),
        F.count_if(s <= 30).cast("bigint").alias("low_risk_count"),
    )
    rate = F.coalesce(C.rnd(F.try_divide(F.col("suspected_fraud_count").cast("double"),
                                         F.col("recent_window_size").cast("double")) * dlit(100.0), 2), dlit(0.0))
    return agg.select(total.cast("bigint").alias("total_processed"), "recent_window_size", "suspected_fraud_count",
                      "high_risk_count", "medium_risk_count", "low_risk_count", rate.alias("fraud_rate_pct"))
