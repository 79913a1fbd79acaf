"""Validation and profiling queries (Q1-Q21, F4-F7, F10) on the card-layout
view of the given tables (``events`` x ``embeddings``) and on ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.columns import sig
from ..operators import features as FE
from ..operators import quality as QL
from ..sources.tables import N_V, card_transactions, lineitem_profile, table, transactions
from .registry import CARD, TX, R, S, register

VCOLS = [f"V{k}" for k in range(1, N_V + 1)]
QV = '", "'.join(VCOLS)


def card(spark, sf_dir) -> DataFrame:
    return card_transactions(spark, sf_dir).drop("p", "entity", "ts")


def _sig_all(df: DataFrame, skip=()) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() == "double" and f.name not in skip:
            out.append(sig(f.name if f.name.isidentifier() else F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


CARD_COLS = ["id", "Time", *VCOLS, "Amount", "Class"]
CARD_SEL = ", ".join(f'"{c}"' for c in CARD_COLS)


@register("q01_min_rows", f"SELECT count(*)::BIGINT AS n_rows, count(*) >= 200000 AS meets_min_rows FROM {CARD}")
def q01_min_rows(spark, sf_dir):
    """Q1: row count vs the 200 000 minimum."""
    return QL.row_count(card(spark, sf_dir))


@register("q02_target_check", f"""
SELECT true AS target_present, count(DISTINCT "Class")::BIGINT AS n_classes,
  count(*) FILTER (WHERE "Class" IS NOT NULL AND "Class" NOT IN (0, 1))::BIGINT AS n_unexpected,
  count(*) FILTER (WHERE "Class" IS NULL)::BIGINT AS n_null_target FROM {CARD}""")
def q02_target_check(spark, sf_dir):
    """Q2: the target is present and binary."""
    return QL.target_check(card(spark, sf_dir))


def _missing_sql(src: str, cols: list[str], floats: set[str]) -> str:
    parts = []
    for c in cols:
        cond = f'"{c}" IS NULL OR isnan("{c}")' if c in floats else f'"{c}" IS NULL'
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {cond})::BIGINT AS n_missing, "
                     f"count(*) AS n FROM {src}")
    return " UNION ALL ".join(parts)


LI_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "Class"]
LI_SQL = """(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  CAST(l_returnflag = 'R' AS INTEGER) AS "Class" FROM lineitem)"""


VOID_SQL = f'(SELECT *, nullif("Amount", "Amount") AS "Void" FROM {CARD})'
# every column of lineitem; the first line of each order is submitted twice
TWICE_SQL = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)"


def submitted_twice(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.unionByName(li.filter("l_linenumber = 1"))


@register("q03_all_null_columns", f"""
SELECT "column" FROM ({_missing_sql(VOID_SQL, [*CARD_COLS, 'Void'], {*CARD_COLS, 'Void'} - {'id', 'Class'})}) WHERE n_missing = n AND n > 0""")
def q03_all_null_columns(spark, sf_dir):
    """Q3: columns that are entirely missing (NULL or NaN): the table has one, ``Void``."""
    ct = card(spark, sf_dir).select(*CARD_COLS).withColumn("Void", F.nullif("Amount", "Amount"))
    return QL.missing_counts(ct).filter("all_missing").select("column")


@register("q04_missing_counts", f"""
SELECT "column", n_missing, n_missing = n AND n > 0 AS all_missing
FROM ({_missing_sql(CARD, CARD_COLS, set(CARD_COLS) - {'id', 'Class'})})""")
def q04_missing_counts(spark, sf_dir):
    """Q4: missing count per column (NULL or NaN)."""
    return QL.missing_counts(card(spark, sf_dir).select(*CARD_COLS))


@register("q05_duplicates", f"""
SELECT coalesce(sum(c - 1), 0)::BIGINT AS duplicate_rows, count(*)::BIGINT AS distinct_rows FROM (
  SELECT *, count(*) AS c FROM {TWICE_SQL} GROUP BY ALL)""")
def q05_duplicates(spark, sf_dir):
    """Q5: full-row duplicates beyond the first, over all columns."""
    return QL.duplicate_rows(submitted_twice(spark, sf_dir))


@register("q06_schema_roles", None)
def q06_schema_roles(spark, sf_dir):
    """Q6/Q7/Q19 (schema only): dtype, numeric flag and role per column."""
    ct = FE.engineer(card(spark, sf_dir))
    return QL.schema_table(ct)


@register("q08_class_balance", f"""
SELECT n_rows, n_fraud, n_rows - n_fraud AS n_legitimate, {R('n_fraud::DOUBLE / n_rows * 100.0::DOUBLE', 6)} AS fraud_rate_pct,
  '1:' || CAST(trunc((n_rows - n_fraud) / greatest(n_fraud, 1)) AS BIGINT) AS imbalance_ratio,
  (n_fraud::DOUBLE / n_rows < 0.001::DOUBLE OR n_fraud::DOUBLE / n_rows > 0.005::DOUBLE) AS rate_outside_band
FROM (SELECT count(*)::BIGINT AS n_rows, coalesce(sum("Class"), 0)::BIGINT AS n_fraud FROM {CARD})""")
def q08_class_balance(spark, sf_dir):
    """Q8+Q9: class counts, rate, imbalance ratio and the expected-rate band."""
    return QL.class_balance(card(spark, sf_dir))


def _moments_sql(col: str, src: str) -> str:
    x = f'"{col}"'
    return f"""
WITH b AS (SELECT {x}::DOUBLE AS x FROM {src}), m AS (SELECT avg(x) AS mu, count(x) AS n FROM b),
mo AS (SELECT any_value(m.n) AS n, avg(pow(x - m.mu, 2)) AS m2, avg(pow(x - m.mu, 3)) AS m3,
         avg(pow(x - m.mu, 4)) AS m4 FROM b, m)
SELECT n::BIGINT AS n, {S('(SELECT avg(x) FROM b)')} AS mean, {S('(SELECT stddev_samp(x) FROM b)')} AS std,
  {S('(SELECT min(x) FROM b)')} AS min, {S('(SELECT max(x) FROM b)')} AS max,
  {S('m3 / pow(m2, 1.5) * sqrt(n::DOUBLE * (n - 1)) / (n - 2)', 6)} AS skewness,
  {S('(n - 1)::DOUBLE / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / (m2 * m2) - 3.0::DOUBLE) + 6)', 6)} AS kurtosis,
  (SELECT count(*) FILTER (WHERE x = 0) FROM b)::BIGINT AS zeros
FROM mo"""


def _stats_sql(col: str, src: str) -> str:
    base = _moments_sql(col, src)
    return f"SELECT *, {S(f'(SELECT quantile_cont(\"{col}\"::DOUBLE, 0.5) FROM {src})')} AS median FROM ({base})"


def _stats_spark(df: DataFrame, col: str) -> DataFrame:
    st = QL.amount_stats(df, col)
    return st.select("n", *[sig(F.col(c)).alias(c) for c in ("mean", "std", "min", "max")],
                     sig("skewness", 6).alias("skewness"), sig("kurtosis", 6).alias("kurtosis"),
                     "zeros", sig("median").alias("median"))


@register("q10_amount_stats", _stats_sql("Amount", CARD), digits=None)
def q10_amount_stats(spark, sf_dir):
    """Q10: Amount mean, sample std, min, max, exact median, corrected skewness, zeros."""
    return _stats_spark(card(spark, sf_dir), "Amount")


@register("q11_kurtosis", f"SELECT kurtosis FROM ({_stats_sql('l_extendedprice', 'lineitem')})", digits=None)
def q11_kurtosis(spark, sf_dir):
    """Q11: excess kurtosis with small-sample correction (lineitem prices)."""
    return _stats_spark(table(spark, sf_dir, "lineitem"), "l_extendedprice").select("kurtosis")


DESCRIBE_COLS = ["Time", "Amount", "V1", "V2", "V14"]


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        x = f'"{c}"::DOUBLE'
        parts.append(f"""SELECT '{c}' AS feature, count({x})::BIGINT AS count, {S(f'avg({x})')} AS mean,
  {S(f'stddev_samp({x})')} AS std, {S(f'min({x})')} AS min, {S(f'max({x})')} AS max,
  {S(f'quantile_cont({x}, 0.25)')} AS q25, {S(f'quantile_cont({x}, 0.5)')} AS q50,
  {S(f'quantile_cont({x}, 0.75)')} AS q75 FROM {CARD}""")
    return " UNION ALL ".join(parts)


@register("q12_describe", _describe_sql(), digits=None)
def q12_describe(spark, sf_dir):
    """Q12: describe() per column with exact quartiles."""
    return _sig_all(QL.describe(card(spark, sf_dir), DESCRIBE_COLS))


@register("q13_time_stats", f"""
SELECT {S('max("Time") / 3600.0::DOUBLE')} AS time_range_hours,
  count(*) FILTER (WHERE ("Time" % 86400.0::DOUBLE) / 3600.0::DOUBLE < 6.0::DOUBLE)::BIGINT AS night_count,
  {S('avg(CAST(("Time" % 86400.0::DOUBLE) / 3600.0::DOUBLE < 6.0::DOUBLE AS DOUBLE)) * 100.0::DOUBLE')} AS night_pct
FROM {CARD}""", digits=None)
def q13_time_stats(spark, sf_dir):
    """Q13: time range in hours and the night share."""
    return _sig_all(QL.time_stats(card(spark, sf_dir)))


def _corr_sql() -> str:
    cols = ["Time", *VCOLS, "Amount"]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr(\"{c}\"::DOUBLE, \"Class\"::DOUBLE) AS r FROM {CARD}" for c in cols)
    return f"""SELECT feature, {S('abs(r)', 6)} AS abs_corr FROM ({parts})
WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, feature LIMIT 10"""


@register("q14_top_correlations", _corr_sql(), digits=None)
def q14_top_correlations(spark, sf_dir):
    """Q14: top-10 |Pearson r| with the target."""
    df = card(spark, sf_dir).drop("id")
    out = QL.top_correlations(df)
    return out.select("feature", sig("abs_corr", 6).alias("abs_corr"))


@register("q15_class_stats", f"""
SELECT "Class" AS class, count(*)::BIGINT AS n, {S('avg("Amount")')} AS amount_mean, {S('max("Amount")')} AS amount_max,
  {S('stddev_samp("Amount")')} AS amount_std, {S('avg("Time")')} AS time_mean, {S('min("Time")')} AS time_min,
  {S('max("Time")')} AS time_max, {S('quantile_cont("Amount", 0.5)')} AS amount_median
FROM {CARD} GROUP BY "Class" """, digits=None)
def q15_class_stats(spark, sf_dir):
    """Q15: per-class amount and time statistics (exact per-class median)."""
    return _sig_all(QL.class_stats(card(spark, sf_dir)))


def _mean_diff_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CASE WHEN \"Class\" = 0 THEN \"{c}\" END) AS mean0, "
        f"avg(CASE WHEN \"Class\" = 1 THEN \"{c}\" END) AS mean1 FROM {CARD}" for c in VCOLS)
    return f"""SELECT feature, {S('mean0')} AS mean0, {S('mean1')} AS mean1, {S('abs(mean1 - mean0)')} AS abs_diff
FROM ({parts}) ORDER BY abs(mean1 - mean0) DESC, feature LIMIT 5"""


@register("q16_class_mean_diff", _mean_diff_sql(), digits=None)
def q16_class_mean_diff(spark, sf_dir):
    """Q16: V-column means per class, top 5 absolute differences."""
    return _sig_all(QL.class_mean_diff(card(spark, sf_dir), VCOLS))


@register("q17_value_counts", f"""
SELECT "Class" AS class, count(*)::BIGINT AS n,
  {R('count(*)::DOUBLE / (SELECT count(*) FROM ' + CARD + ') * 100.0::DOUBLE', 2)} AS pct
FROM {CARD} GROUP BY "Class" """)
def q17_value_counts(spark, sf_dir):
    """Q17 (+F7): rows per class and share of all rows."""
    return QL.value_counts(card(spark, sf_dir))


def _ranges_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min(\"{c}\") AS min, max(\"{c}\") AS max, avg(\"{c}\") AS mean, "
        f"stddev_samp(\"{c}\") AS std FROM {CARD}" for c in VCOLS)
    return f"""SELECT feature, {S('min')} AS min, {S('max')} AS max, {S('mean')} AS mean, {S('std')} AS std,
  {S('min(min) OVER ()')} AS global_min, {S('max(max) OVER ()')} AS global_max FROM ({parts})"""


@register("q18_column_ranges", _ranges_sql(), digits=None)
def q18_column_ranges(spark, sf_dir):
    """Q18: per-feature min/max/mean/std and the global min/max over V columns."""
    return _sig_all(QL.column_ranges(card(spark, sf_dir), VCOLS))


@register("q19_column_catalogue", f"""
WITH m AS ({_missing_sql(CARD, CARD_COLS, set(CARD_COLS) - {'id', 'Class'})})
SELECT m."column", CASE WHEN m."column" = 'Class' THEN 'target'
  WHEN m."column" IN ('Amount', 'Time') THEN 'scale'
  WHEN regexp_matches(m."column", '^V[0-9]+$') THEN 'passthrough' ELSE 'unassigned' END AS role,
  m.n_missing FROM m""")
def q19_column_catalogue(spark, sf_dir):
    """Q19: role of each column joined to its missing count."""
    df = card(spark, sf_dir).select(*CARD_COLS)
    roles = QL.schema_table(df).select("column", "role")
    return roles.join(QL.missing_counts(df).select("column", "n_missing"), "column", "inner")


def _report_sql() -> str:
    floats = set(CARD_COLS) - {"id", "Class"}
    keys = ", ".join(f'"{c}"' for c in CARD_COLS)
    pct = R('n_fraud::DOUBLE / n_rows * 100.0::DOUBLE', 6)
    return f"""
WITH c AS (SELECT {CARD_SEL} FROM {CARD}),
m AS ({_missing_sql('c', CARD_COLS, floats)}),
k AS (SELECT count(*)::BIGINT AS n_rows, coalesce(sum("Class"), 0)::BIGINT AS n_fraud,
        count(*) FILTER (WHERE "Class" IS NOT NULL AND "Class" NOT IN (0, 1))::BIGINT AS n_unexpected FROM c),
b AS (SELECT {pct} AS pct, '1:' || CAST(trunc((n_rows - n_fraud) / greatest(n_fraud, 1)) AS BIGINT) AS ratio,
        (n_fraud::DOUBLE / n_rows < 0.001::DOUBLE OR n_fraud::DOUBLE / n_rows > 0.005::DOUBLE) AS outside FROM k),
d AS (SELECT coalesce(sum(cnt - 1), 0)::BIGINT AS dup FROM (SELECT count(*) AS cnt FROM c GROUP BY {keys}))
SELECT 'min_rows' AS "check", CASE WHEN n_rows >= 200000 THEN 'info' ELSE 'error' END AS severity,
  {R('n_rows::DOUBLE')} AS observed, printf('Row count %d (minimum 200000)', n_rows) AS message FROM k
UNION ALL SELECT 'target_binary', CASE WHEN n_unexpected = 0 THEN 'info' ELSE 'error' END, {R('n_unexpected::DOUBLE')},
  printf('%d target values outside {{0,1}}', n_unexpected) FROM k
UNION ALL SELECT 'fraud_rate_band', CASE WHEN outside THEN 'warning' ELSE 'info' END, {R('pct')},
  'Fraud rate ' || CAST(pct AS VARCHAR) || '% (ratio ' || ratio || ')' FROM b
UNION ALL SELECT 'all_null_column', 'error', {R('n_missing::DOUBLE')}, 'Column entirely missing: ' || "column"
  FROM m WHERE n_missing = n AND n > 0
UNION ALL SELECT 'missing_values', 'warning', {R('n_missing::DOUBLE')}, 'Missing values in ' || "column" FROM m WHERE n_missing > 0
UNION ALL SELECT 'duplicate_rows', CASE WHEN dup > 0 THEN 'warning' ELSE 'info' END, {R('dup::DOUBLE')},
  printf('%d duplicate rows', dup) FROM d"""


@register("q20_validation_report", _report_sql())
def q20_validation_report(spark, sf_dir):
    """Q20: long (check, severity, observed, message) report; hard rows are errors."""
    return QL.validation_report(card(spark, sf_dir).select(*CARD_COLS))


# --- feature expressions (F1-F7, F10) ----------------------------------------------
@register("f01_log_amount", f"""SELECT id, {S('ln(1 + greatest(coalesce(CASE WHEN isnan("Amount") THEN 0.0::DOUBLE ELSE "Amount" END, 0.0::DOUBLE), 0.0::DOUBLE))')} AS log_amount FROM {TX}""", digits=None)
def f01_log_amount(spark, sf_dir):
    """log1p(max(coalesce(Amount, 0), 0))."""
    return transactions(spark, sf_dir).select("id", sig(C.log_amount("Amount")).alias("log_amount"))


@register("f02_hour_of_day", f"""SELECT id, {R('(greatest(coalesce("Time", 0.0::DOUBLE), 0.0::DOUBLE) % 86400.0::DOUBLE) / 3600.0::DOUBLE', 9)} AS hour_of_day FROM {TX}""", digits=None)
def f02_hour_of_day(spark, sf_dir):
    """(max(Time, 0) mod 86400) / 3600, fractional hours."""
    return transactions(spark, sf_dir).select("id", C.rnd(C.hour_of_day("Time"), 9).alias("hour_of_day"))


@register("f03_is_night", f"""SELECT id, CAST((greatest(coalesce("Time", 0.0::DOUBLE), 0.0::DOUBLE) % 86400.0::DOUBLE) / 3600.0::DOUBLE < 6.0::DOUBLE AS INTEGER) AS is_night FROM {TX}""")
def f03_is_night(spark, sf_dir):
    """1 when hour_of_day < 6."""
    return transactions(spark, sf_dir).select("id", C.is_night(C.hour_of_day("Time")).alias("is_night"))


@register("f04_drop_columns", f'SELECT id, "Amount", "Class" FROM {CARD}')
def f04_drop_columns(spark, sf_dir):
    """drop listed columns, ignoring names that are absent."""
    df = card(spark, sf_dir).select("id", "Time", "Amount", "Class")
    return FE.drop_columns(df, ["Time", "no_such_column"])


@register("f05_dedup", f"SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT DISTINCT * FROM {TWICE_SQL})")
def f05_dedup(spark, sf_dir):
    """drop full-row duplicates (all columns, target included)."""
    return FE.dedup(submitted_twice(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_extendedprice")


@register("f06_xy_split", f'SELECT id, "Amount", "Time", CAST("Class" AS INTEGER) AS y FROM {CARD}')
def f06_xy_split(spark, sf_dir):
    """features and target separated; the target cast to int."""
    x, y = FE.x_y(card(spark, sf_dir).select("id", "Amount", "Time", "Class"), key="id")
    return x.join(y, "id")


@register("f07_share", f"""
SELECT event_type, count(*)::BIGINT AS n,
  {R('count(*)::DOUBLE / sum(count(*)) OVER () * 100.0::DOUBLE', 2)} AS pct FROM events GROUP BY event_type""")
def f07_share(spark, sf_dir):
    """counts turned into shares of the total (%, 2 places)."""
    ev = table(spark, sf_dir, "events")
    return FE.share(ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "n")


@register("f10_defaults", f"""
SELECT event_id AS id, coalesce(TRY_CAST(json_extract_string(props, '$.Time') AS DOUBLE), 0.0::DOUBLE) AS "Time",
  coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0::DOUBLE) AS "V1",
  coalesce(TRY_CAST(json_extract_string(props, '$.V2') AS DOUBLE), 0.0::DOUBLE) AS "V2" FROM events""")
def f10_defaults(spark, sf_dir):
    """absent Time / V fields of a JSON payload default to 0.0."""
    ev = table(spark, sf_dir, "events")
    payload = FE.parse_payload(ev.select(F.col("event_id").alias("id"), "props"), "props",
                               {"Time": "$.Time", "V1": "$.k", "V2": "$.V2"})
    return payload.select("id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("Time", "V1", "V2")])


def _payload(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    amount = (F.when(F.col("event_type") == "signup", F.lit("n/a"))
              .when(F.col("event_type") == "error", F.concat(F.lit("-"), F.col("value").cast("string")))
              .otherwise(F.col("value").cast("string")))
    v14 = F.when((F.col("event_type") == "view") & (F.col("value") > 400), F.lit("Infinity"))
    return ev.select(F.col("event_id").alias("id"), amount.alias("amount_raw"),
                     F.get_json_object("props", "$.k").alias("time_raw"), v14.alias("v14_raw"))


def _f09_sql() -> str:
    amt = ("CASE WHEN event_type = 'signup' THEN 'n/a' WHEN event_type = 'error' THEN '-' || CAST(value AS VARCHAR) "
           "ELSE CAST(value AS VARCHAR) END")
    v14 = "CASE WHEN event_type = 'view' AND value > 400 THEN 'Infinity' END"
    a = "TRY_CAST(a_raw AS DOUBLE)"
    t = "TRY_CAST(t_raw AS DOUBLE)"
    v = "TRY_CAST(v_raw AS DOUBLE)"
    return f"""
SELECT id, coalesce(
  CASE WHEN a_raw IS NULL THEN 'Missing required field: ''Amount''.' END,
  CASE WHEN {a} IS NULL THEN printf('Invalid ''Amount'': must be numeric, got ''%s''.', a_raw) END,
  CASE WHEN isnan({a}) OR isinf({a}) THEN 'Invalid ''Amount'': must be a finite number. NaN and Infinity values are prohibited.' END,
  CASE WHEN {a} < 0 THEN 'Invalid ''Amount'': must be non-negative.' END,
  CASE WHEN {a} > 10000000.0::DOUBLE THEN 'Invalid ''Amount'': exceeds maximum transaction cap of $10,000,000.' END,
  CASE WHEN t_raw IS NOT NULL AND {t} IS NULL THEN printf('Invalid ''Time'': must be numeric, got ''%s''.', t_raw) END,
  CASE WHEN t_raw IS NOT NULL AND (isnan({t}) OR isinf({t}) OR {t} < 0) THEN 'Invalid ''Time'': must be a non-negative finite number.' END,
  CASE WHEN v_raw IS NOT NULL AND {v} IS NULL THEN printf('Invalid ''V14'': must be numeric, got ''%s''.', v_raw) END,
  CASE WHEN v_raw IS NOT NULL AND (isnan({v}) OR isinf({v})) THEN 'Invalid ''V14'': must be a finite number. NaN and Infinity values are prohibited.' END
) AS reject_reason, coalesce({t}, 0.0::DOUBLE) AS clean_Time, coalesce({v}, 0.0::DOUBLE) AS clean_V14
FROM (SELECT event_id AS id, {amt} AS a_raw, json_extract_string(props, '$.k') AS t_raw, {v14} AS v_raw FROM events)"""


@register("f09_validate_rows", _f09_sql())
def f09_validate_rows(spark, sf_dir):
    """ordered payload checks -> first failing reason; absent fields -> 0.0."""
    out = FE.validate_rows(_payload(spark, sf_dir), {"Amount": "amount_raw", "Time": "time_raw", "V14": "v14_raw"})
    return out.select("id", "reject_reason", "clean_Time", "clean_V14")
