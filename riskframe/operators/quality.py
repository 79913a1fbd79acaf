"""Data validation and profiling (Q1-Q21).

Column-wise statistics are computed in one wide ``agg`` (one scan, partial
aggregation) and the single result row is then unpivoted into a long
``(feature, ...)`` table; nothing row-sized is exploded for them. Exact
medians/quartiles use :mod:`quantiles`.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.columns import dlit, rnd
from ..session import materialize
from .quantiles import exact_quantiles

V_PATTERN = re.compile(r"^V[0-9]+$")
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC)


def missing(df: DataFrame, c: str) -> Column:
    """pandas 'missing': NULL, or NaN for floating columns."""
    dt = df.schema[c].dataType
    x = F.col(c)
    return (x.isNull() | F.isnan(x)) if isinstance(dt, (T.FloatType, T.DoubleType)) else x.isNull()


def _long(row_df: DataFrame, names: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Unpivot a one-row frame with columns ``{stat}__{name}`` into (feature, stat...)."""
    structs = [F.struct(F.lit(n).alias("feature"), *[F.col(f"{s}__{n}").alias(s) for s in stats]) for n in names]
    return row_df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- hard checks -------------------------------------------------------------
def row_count(df: DataFrame, min_rows: int = 200_000) -> DataFrame:
    """Q1: row count and the minimum-rows verdict."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("meets_min_rows", F.col("n_rows") >= min_rows)


def target_check(df: DataFrame, target: str = P.TARGET) -> DataFrame:
    """Q2: target present, its distinct non-null values and the unexpected ones.

    The value list is bounded by ``max_listed`` distinct values per report.
    """
    if target not in df.columns:
        return df.sparkSession.range(1).select(F.lit(False).alias("target_present"),
                                               F.lit(None).cast("bigint").alias("n_classes"),
                                               F.lit(None).cast("bigint").alias("n_unexpected"),
                                               F.lit(None).cast("bigint").alias("n_null_target"))
    y = F.col(target)
    return df.agg(
        F.lit(True).alias("target_present"),
        F.count_distinct(y).alias("n_classes"),
        F.count_if(y.isNotNull() & ~y.isin(0, 1)).cast("bigint").alias("n_unexpected"),
        F.count_if(y.isNull()).cast("bigint").alias("n_null_target"),
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """Q3+Q4: per column missing count and whether the column is entirely missing."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(missing(df, c)).cast("bigint").alias(f"n_missing__{c}") for c in cols])
    return _missing_rows(agg.withColumnRenamed("_n", "n_rows"), cols)


def _missing_rows(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column of the one-row frame (n_rows, n_missing__<column>)."""
    flags = {f"all_missing__{c}": (F.col(f"n_missing__{c}") == F.col("n_rows")) & (F.col("n_rows") > 0) for c in cols}
    return _long(counts.withColumns(flags), cols, ["n_missing", "all_missing"]).withColumnRenamed("feature", "column")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Q5: full-row duplicates beyond the first of each group (NULLs equal).

    A grouped count with map-side combine: a row repeated a billion times
    collapses before the shuffle.
    """
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def schema_table(df: DataFrame, target: str = P.TARGET, scale_cols: Sequence[str] = P.SCALE_COLUMNS) -> DataFrame:
    """Q6+Q7+Q19: (column, dtype, numeric, role) from the schema, plus expected
    scale columns that are absent (role 'missing_scale'). No job runs."""
    rows = []
    for f in df.schema.fields:
        c = f.name
        if c == target:
            role = "target"
        elif c in scale_cols:
            role = "scale"
        elif V_PATTERN.match(c) or c in P.PASSTHROUGH_EXTRA:
            role = "passthrough"
        else:
            role = "unassigned"
        rows.append((c, f.dataType.simpleString(), is_numeric(f.dataType), role))
    for c in scale_cols:
        if c not in df.columns and c not in ("log_amount", "hour_of_day"):
            rows.append((c, None, None, "missing_scale"))
    schema = "column string, dtype string, numeric boolean, role string"
    return df.sparkSession.createDataFrame(rows, schema)


# --- soft checks / stats --------------------------------------------------------
def class_balance(df: DataFrame, target: str = P.TARGET, band: tuple = (0.001, 0.005)) -> DataFrame:
    """Q8+Q9: fraud / legit counts, rate % (6 places), '1:k' ratio, rate-band flag."""
    y = F.col(target)
    return _balance(df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(y.cast("bigint")), F.lit(0)).alias("n_fraud")), band)


def _balance(agg: DataFrame, band: tuple) -> DataFrame:
    n, f = F.col("n_rows"), F.col("n_fraud")
    rate = f.cast("double") / n.cast("double")
    return agg.select(
        "n_rows", "n_fraud", (n - f).alias("n_legitimate"),
        rnd(rate * dlit(100.0), 6).alias("fraud_rate_pct"),
        F.concat(F.lit("1:"), ((n - f) / F.greatest(f, F.lit(1))).cast("bigint").cast("string")).alias("imbalance_ratio"),
        ((rate < dlit(band[0])) | (rate > dlit(band[1]))).alias("rate_outside_band"),
    )


def moment_stats(df: DataFrame, c: str) -> DataFrame:
    """Q10+Q11: mean, sample std, min, max, bias-corrected skewness (G1) and
    excess kurtosis (G2), zero count."""
    x = F.col(c).cast("double")
    agg = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                 F.min(x).alias("min"), F.max(x).alias("max"), F.skewness(x).alias("g1"),
                 F.kurtosis(x).alias("g2"), F.count_if(x == 0).cast("bigint").alias("zeros"))
    n = F.col("n").cast("double")
    skew = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return agg.select("n", "mean", "std", "min", "max", skew.alias("skewness"), kurt.alias("kurtosis"), "zeros")


def amount_stats(df: DataFrame, c: str = "Amount") -> DataFrame:
    """Q10: moment stats plus the exact median."""
    med = exact_quantiles(df, c, [0.5]).select(F.col("quantile").alias("median"))
    return moment_stats(df, c).withColumn("median", med.select("median").scalar())


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q12: count/mean/std/min/25%/50%/75%/max per column (long table)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"), F.stddev_samp(x).alias(f"std__{c}"),
                 F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    base = _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("r")).select("r.*")
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"])
    qw = q.groupBy("feature").agg(*[F.max(F.when(F.col("q_index") == i, F.col("quantile"))).alias(n)
                                    for i, n in enumerate(["q25", "q50", "q75"])])
    return base.join(qw, "feature", "left")


def time_stats(df: DataFrame, time: str = "Time") -> DataFrame:
    """Q13: time range in hours; count and share of night rows (hour < 6)."""
    t = F.col(time).cast("double")
    night = ((t % dlit(86400.0)) / dlit(3600.0)) < dlit(6.0)
    return df.agg((F.max(t) / dlit(3600.0)).alias("time_range_hours"),
                  F.count_if(night).cast("bigint").alias("night_count"),
                  (F.avg(night.cast("double")) * dlit(100.0)).alias("night_pct"))


def top_correlations(df: DataFrame, target: str = P.TARGET, k: int = 10) -> DataFrame:
    """Q14: |Pearson r| of each numeric column with the target, top k, NaN last."""
    cols = [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name != target]
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"r__{c}") for c in cols])
    long = _long(agg, cols, ["r"]).withColumn("abs_corr", F.abs(F.nanvl(F.col("r"), F.lit(None))))
    return long.orderBy(F.col("abs_corr").desc_nulls_last(), F.col("feature")).limit(k) \
        .select("feature", "abs_corr")


def class_stats(df: DataFrame, target: str = P.TARGET, amount: str = "Amount", time: str = "Time") -> DataFrame:
    """Q15: per-class Amount mean/median/max/std and Time mean/min/max."""
    a, t = F.col(amount).cast("double"), F.col(time).cast("double")
    base = df.groupBy(F.col(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(a).alias("amount_mean"), F.max(a).alias("amount_max"),
        F.stddev_samp(a).alias("amount_std"), F.avg(t).alias("time_mean"), F.min(t).alias("time_min"),
        F.max(t).alias("time_max"))
    med = exact_quantiles(df.withColumn("class", F.col(target)), amount, [0.5], ["class"]) \
        .select("class", F.col("quantile").alias("amount_median"))
    return base.join(med, "class", "left")


def class_mean_diff(df: DataFrame, features: Sequence[str], target: str = P.TARGET, k: int = 5) -> DataFrame:
    """Q16: per-feature class means and |difference|, top k."""
    y = F.col(target)
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(F.when(y == 0, x)).alias(f"mean0__{c}"), F.avg(F.when(y == 1, x)).alias(f"mean1__{c}")]
    long = _long(df.agg(*aggs), features, ["mean0", "mean1"])
    long = long.withColumn("abs_diff", F.abs(F.col("mean1") - F.col("mean0")))
    return long.orderBy(F.col("abs_diff").desc_nulls_last(), F.col("feature")).limit(k)


def value_counts(df: DataFrame, target: str = P.TARGET) -> DataFrame:
    """Q17 (+F7 share columns): rows per class, % of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("pct", rnd(F.col("n") / total.cast("double") * dlit(100.0), 2))


def column_ranges(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Q18: min/max/mean/population-free std per feature plus global min/max."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}"),
                 F.avg(x).alias(f"mean__{c}"), F.stddev_samp(x).alias(f"std__{c}")]
    long = _long(df.agg(*aggs), features, ["min", "max", "mean", "std"])
    # two numbers reach the driver once (scalar subqueries would re-scan per use)
    g = long.agg(F.min("min").alias("lo"), F.max("max").alias("hi")).first()
    lit = lambda v: dlit(v) if v is not None else F.lit(None).cast("double")
    return long.withColumns({"global_min": lit(g["lo"]), "global_max": lit(g["hi"])})


def validation_counts(df: DataFrame, target: str = P.TARGET) -> DataFrame:
    """All counts of the report from one scan: equal rows are counted first (with map-side
    combine), and every other count is a sum over the distinct rows' counts."""
    c = F.col("_c")
    total = lambda x, name: F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(name)
    aggs = [total(c, "n_rows"), total(c - 1, "duplicate_rows")]
    aggs += [total(F.when(missing(df, x), c), f"n_missing__{x}") for x in df.columns]
    if target in df.columns:
        y = F.col(target)
        aggs += [total(F.when(y.isNotNull() & ~y.isin(0, 1), c), "n_unexpected"), total(y.cast("bigint") * c, "n_fraud")]
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).agg(*aggs)


def validation_report(df: DataFrame, target: str = P.TARGET, min_rows: int = 200_000,
                      scale_cols: Sequence[str] = ("Amount", "Time"),
                      band: tuple = (0.001, 0.005)) -> DataFrame:
    """Q20: long table (check, severity, observed, message); severity 'error'
    rows are the hard failures, 'warning' the soft ones, 'info' passes."""
    spark = df.sparkSession
    n_rows = F.col("n_rows")
    counts = materialize(validation_counts(df, target), "validation")  # one row
    mc = _missing_rows(counts, df.columns)
    parts = []
    rc = counts.withColumn("meets_min_rows", n_rows >= min_rows)
    parts.append(rc.select(F.lit("min_rows").alias("check"),
                           F.when(F.col("meets_min_rows"), "info").otherwise("error").alias("severity"),
                           n_rows.cast("double").alias("observed"),
                           F.format_string(f"Row count %d (minimum {min_rows})", n_rows).alias("message")))
    if target in df.columns:
        parts.append(counts.select(F.lit("target_binary").alias("check"),
                               F.when(F.col("n_unexpected") == 0, "info").otherwise("error").alias("severity"),
                               F.col("n_unexpected").cast("double").alias("observed"),
                               F.format_string("%d target values outside {0,1}", F.col("n_unexpected")).alias("message")))
        cb = _balance(counts.select("n_rows", "n_fraud"), band)
        parts.append(cb.select(F.lit("fraud_rate_band").alias("check"),
                               F.when(F.col("rate_outside_band"), "warning").otherwise("info").alias("severity"),
                               F.col("fraud_rate_pct").alias("observed"),
                               F.format_string("Fraud rate %s%% (ratio %s)", F.col("fraud_rate_pct").cast("string"),
                                               F.col("imbalance_ratio")).alias("message")))
    else:
        parts.append(spark.range(1).select(F.lit("target_binary").alias("check"), F.lit("error").alias("severity"),
                                           F.lit(None).cast("double").alias("observed"),
                                           F.lit(f"Target column '{target}' not found").alias("message")))
    parts.append(mc.filter("all_missing").select(F.lit("all_null_column").alias("check"), F.lit("error").alias("severity"),
                                                 F.col("n_missing").cast("double").alias("observed"),
                                                 F.concat(F.lit("Column entirely missing: "), F.col("column")).alias("message")))
    parts.append(mc.filter(F.col("n_missing") > 0).select(
        F.lit("missing_values").alias("check"), F.lit("warning").alias("severity"),
        F.col("n_missing").cast("double").alias("observed"),
        F.concat(F.lit("Missing values in "), F.col("column")).alias("message")))
    parts.append(counts.select(F.lit("duplicate_rows").alias("check"),
                            F.when(F.col("duplicate_rows") > 0, "warning").otherwise("info").alias("severity"),
                            F.col("duplicate_rows").cast("double").alias("observed"),
                            F.format_string("%d duplicate rows", F.col("duplicate_rows")).alias("message")))
    non_num = [f.name for f in df.schema.fields if not is_numeric(f.dataType) and f.name != target]
    missing_scale = [c for c in scale_cols if c not in df.columns]
    extra = [("non_numeric_column", "warning", None, f"Non-numeric column: {c}") for c in non_num]
    extra += [("scale_column_missing", "warning", None, f"Expected scale column '{c}' not found") for c in missing_scale]
    if extra:
        parts.append(spark.createDataFrame(extra, "check string, severity string, observed double, message string"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def raise_on_errors(report: DataFrame) -> DataFrame:
    """Raise when the report holds any hard error; all of them are listed (there are a
    few per column at most)."""
    errs = report.filter(F.col("severity") == "error").select("message").collect()
    if errs:
        raise ValueError("Validation failed: " + "; ".join(r["message"] for r in errs))
    return report


def split_profile(df: DataFrame, split: str = "split", target: str = P.TARGET) -> DataFrame:
    """Rows, positives and positive rate per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.sum(F.col(target).cast("bigint")).alias("n_fraud")) \
        .withColumn("fraud_rate", F.col("n_fraud") / F.col("n_rows").cast("double"))

