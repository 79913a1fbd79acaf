"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text becomes a vector of transformed statistics (length, word length, symbols,
repeated lines, repeated five-word windows, capitals). Per language and source the
minimum-covariance-determinant estimate is found by concentration steps: from a start at
the medians and quartile ranges, take the share ``SUBSET`` of the group with the smallest
distances, estimate mean and covariance from it, measure all distances again, and so on.
A text is rejected if its squared Mahalanobis distance, scaled so that the group's median
is that of a chi-square variable, exceeds ``cutoff()``; a floor under every variance keeps
statistics that are constant in a group (no symbols at all) from making tiny differences
count. Everything is DataFrame expressions: one scan computes the statistics, every step
is a grouped aggregate (partial sums, so a source with a third of all rows is no hot
task) and a join with the few numbers of each group.

Groups of under ``SMALLEST`` rows are pooled by language, and those of such languages
together; a pool that is still smaller rejects nothing by the method.

Defined results: a null or empty text has no words and fails the base rule; null
languages or sources are groups of their own; equal rows get equal verdicts; extra
columns pass through ``filter_quality`` unchanged and are ignored by ``judge_quality``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, table

# The given base rule's word and window patterns and limits.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

#: Parameters: share of a group in the estimate, steps, rows of the smallest group, and
#: the normal quantile whose chi-square counterpart is the cutoff.
SUBSET, STEPS, SMALLEST, QUANTILE = 0.75, 3, 50, 5.0
#: The statistics and the least standard deviation each is given.
STATS = {"length": 0.5, "word_length": 0.12, "symbols": 0.05, "dup_lines": 0.15, "repeats": 0.12, "capitals": 0.10}
P = len(STATS)
NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def chi_square(z: float, p: int = P) -> float:
    """Chi-square quantile by Wilson and Hilferty's cube."""
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def cutoff() -> float:
    return chi_square(QUANTILE)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__q_*`` columns. Arrays that several expressions use are columns
    of their own, so that they are computed once a row."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    out = docs.withColumn("__q_w", F.array_remove(F.split(t, f"{SPACE}+"), ""))
    out = out.withColumns({
        "__q_n_words": F.size("__q_w").cast("long"),
        "__q_word_chars": F.length(F.array_join("__q_w", "")).cast("long"),
        "__q_n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "__q_capitals": (F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}+", ""))).cast("double"),
        "__q_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
        "__q_h": F.expr(f"CASE WHEN size(__q_w) >= {WINDOW} THEN transform(sequence(1, size(__q_w) - {WINDOW - 1}), "
                        f"i -> xxhash64(slice(__q_w, i, {WINDOW}))) ELSE cast(array() AS array<bigint>) END"),
    }).drop("__q_w")
    out = out.withColumns({
        "__q_n_lines": F.size("__q_lines").cast("double"),
        "__q_n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
        # (hash, place) in order, only for texts in which some window repeats
        "__q_s": F.expr("CASE WHEN size(array_distinct(__q_h)) < size(__q_h) THEN "
                        "array_sort(transform(__q_h, (x, i) -> struct(x AS x, i AS i))) END"),
    }).drop("__q_lines", "__q_h")
    out = out.withColumn("__q_p", F.expr(
        "array_sort(transform(filter(__q_s, (e, j) -> (j > 0 AND e.x = __q_s[j - 1].x) OR "
        "(j < size(__q_s) - 1 AND e.x = __q_s[j + 1].x)), e -> e.i))")).drop("__q_s")
    # each repeated window adds its words up to the next one's start
    out = out.withColumn("__q_n_repeat_words", F.expr(
        f"CASE WHEN __q_p IS NULL THEN 0L ELSE aggregate(zip_with(slice(__q_p, 1, size(__q_p) - 1), "
        f"slice(__q_p, 2, size(__q_p) - 1), (a, b) -> least(b - a, {WINDOW})), {WINDOW}L, (s, x) -> s + x) END")).drop("__q_p")
    n = F.greatest(F.col("__q_n_words"), F.lit(1))
    chars = F.greatest(F.col("__q_word_chars"), F.lit(1))
    z = {
        "length": F.log1p("__q_n_words"),
        "word_length": F.log(chars / n),
        "symbols": F.sqrt(F.col("__q_n_symbols") / chars),
        "dup_lines": F.sqrt(F.col("__q_n_dup_lines") / F.greatest(F.col("__q_n_lines"), F.lit(1.0))),
        "repeats": F.sqrt(F.col("__q_n_repeat_words") / n),
        "capitals": F.sqrt(F.col("__q_capitals") / chars),
    }
    return out.withColumns({f"__q_z{i}": z[k] for i, k in enumerate(STATS)} | {
        "__q_base_failed": (F.col("__q_n_words") < LEAST_WORDS)
        | (100 * F.col("__q_n_repeat_words") > MOST_REPEATED * F.col("__q_n_words")),
        # keeps Spark from writing these expressions into a later filter, where an
        # array that is used ten times would be computed ten times
        "__q_row": F.monotonically_increasing_id(),
    }).drop("__q_capitals", "__q_n_lines")


Z = [f"__q_z{i}" for i in range(P)]


def key(c: str) -> Column:
    """Null-safe group key part: a null differs from every string."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))


def with_pools(stats: DataFrame) -> DataFrame:
    """Group sizes decide the pool (``__q_g``) of each (language, source)."""
    sizes = stats.groupBy("__q_lang", "__q_source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = sizes.where(F.col("n") < SMALLEST).groupBy("__q_lang").agg(F.sum("n").alias("m"))
    pools = sizes.join(by_lang, "__q_lang", "left")
    pool = (F.when(F.col("n") >= SMALLEST, F.concat_ws("\x1f", "__q_lang", "__q_source"))
            .when(F.col("m") >= SMALLEST, F.col("__q_lang")).otherwise(F.lit("")))
    return pools.select("__q_lang", "__q_source", pool.alias("__q_g"))


def _distance_columns(df: DataFrame) -> DataFrame:
    """``__q_d``: squared Mahalanobis distance by forward substitution with the Cholesky
    factor; a column for each substitution keeps expressions small."""
    for i in range(P):
        rest = F.col(Z[i]) - F.col(f"__q_m{i}")
        for j in range(i):
            rest = rest - F.col(f"__q_l{i}_{j}") * F.col(f"__q_y{j}")
        df = df.withColumn(f"__q_y{i}", rest / F.col(f"__q_l{i}_{i}"))
    total = sum((F.col(f"__q_y{i}") * F.col(f"__q_y{i}") for i in range(1, P)), F.col("__q_y0") * F.col("__q_y0"))
    return df.withColumn("__q_d", total).drop(*[f"__q_y{i}" for i in range(P)])


def _factor(moments: DataFrame) -> DataFrame:
    """Cholesky factor of each group's covariance plus the variance floors."""
    floor = [f * f for f in STATS.values()]
    for i in range(P):
        for j in range(i + 1):
            v = F.col(f"c{i}_{j}") + (F.lit(floor[i]) if i == j else F.lit(0.0))
            for k in range(j):
                v = v - F.col(f"__q_l{i}_{k}") * F.col(f"__q_l{j}_{k}")
            moments = moments.withColumn(f"__q_l{i}_{j}", F.sqrt(F.greatest(v, F.lit(1e-12))) if i == j else v / F.col(f"__q_l{j}_{j}"))
    return moments.drop(*[f"c{i}_{j}" for i in range(P) for j in range(i + 1)])


def fit_groups(stats: DataFrame) -> DataFrame:
    """Per pool: mean, Cholesky factor and the scale that brings the median distance
    to the chi-square median. ``stats`` has ``__q_g`` and the statistics."""
    quart = [F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i, c in enumerate(Z)]
    start = stats.groupBy("__q_g").agg(F.count(F.lit(1)).alias("n"), *quart)
    start = start.select("__q_g", "n", *[F.col(f"q{i}")[1].alias(f"__q_m{i}") for i in range(P)],
                         *[(((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 if i == j else F.lit(0.0)) ** 2).alias(f"c{i}_{j}")
                           for i in range(P) for j in range(i + 1)])
    groups = materialize(_factor(start), "quality-groups")
    for _ in range(STEPS):
        measured = _distance_columns(stats.join(groups.drop("n"), "__q_g")).select("__q_g", "__q_d", *Z)
        edge = measured.groupBy("__q_g").agg(F.percentile_approx("__q_d", SUBSET, 2000).alias("edge"))
        near = measured.join(materialize(edge, "quality-edges"), "__q_g").where(F.col("__q_d") <= F.col("edge"))
        aggs = [F.avg(Z[i]).alias(f"__q_m{i}") for i in range(P)]
        aggs += [F.covar_pop(Z[i], Z[j]).alias(f"c{i}_{j}") for i in range(P) for j in range(i + 1)]
        moments = near.groupBy("__q_g").agg(F.count(F.lit(1)).alias("n"), *aggs)
        groups = materialize(_factor(moments), "quality-groups")
    measured = _distance_columns(stats.join(groups.drop("n"), "__q_g"))
    scale = measured.groupBy("__q_g").agg(F.percentile_approx("__q_d", 0.5, 2000).alias("__q_middle"), F.count(F.lit(1)).alias("__q_rows"))
    # never below 1: floors make distances small where statistics hardly vary
    return materialize(groups.drop("n").join(scale, "__q_g").withColumn(
        "__q_scale", F.greatest(F.col("__q_middle") / F.lit(chi_square(0.0)), F.lit(1.0))), "quality-groups")


def _judge(stats: DataFrame, groups: DataFrame) -> DataFrame:
    judged = _distance_columns(stats.join(groups, "__q_g", "left"))
    d = F.when(F.col("__q_rows") >= SMALLEST, F.col("__q_d") / F.col("__q_scale"))
    return judged.withColumn("__q_distance", d).withColumn(
        "__q_kept", ~F.col("__q_base_failed") & (F.col("__q_distance").isNull() | (F.col("__q_distance") <= cutoff())))


def _grouped(docs: DataFrame) -> DataFrame:
    return with_statistics(docs).withColumns({"__q_lang": key("lang"), "__q_source": key("source")})


def _fit(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    narrow = materialize(_grouped(docs_of(docs, "doc_id", "text", "lang", "source")).drop("text", "lang", "source", "__q_row"), "quality-stats")
    pools = materialize(with_pools(narrow), "quality-pools")
    stats = narrow.join(pools, ["__q_lang", "__q_source"])
    return stats, pools, fit_groups(stats)


def judge_quality(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): the counts, the base
    rule, the distance and the verdict."""
    stats, _, groups = _fit(docs)
    return _judge(stats, groups).select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"__q_{c}").alias(c) for c in NUMBERS],
        F.col("__q_base_failed").alias("base_failed"), F.col("__q_kept").alias("kept"), F.col("__q_distance").alias("distance"))


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged. The texts are read
    again for the verdict rather than shuffled to it."""
    _, pools, groups = _fit(docs)
    judged = _judge(_grouped(docs).join(pools, ["__q_lang", "__q_source"]), groups)
    return judged.where("__q_kept AND __q_row >= 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return judge_quality(table(spark, sf_dir, "documents"))
