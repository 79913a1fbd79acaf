"""Split, scaling, weighting, sampling and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..operators import features as FE
from ..operators import split as SP
from ..operators import quality as QL
from ..sources.tables import card_transactions, table
from .registry import CARD, R, register

SCALE = ["Amount", "Time", "log_amount", "hour_of_day"]


def card_features(spark, sf_dir):
    return FE.engineer(card_transactions(spark, sf_dir).drop("p", "entity", "ts"))


def split_frame(spark, sf_dir):
    return SP.stratified_split(card_features(spark, sf_dir), key="id", target="Class")


BASE_SQL = f"""(SELECT c.*, ln(1 + greatest(c."Amount", 0.0::DOUBLE)) AS log_amount,
    (greatest(c."Time", 0.0::DOUBLE) % 86400.0::DOUBLE) / 3600.0::DOUBLE AS hour_of_day,
    ('0x' || substring(md5(CAST(c.id AS VARCHAR) || '|42'), 1, 15))::BIGINT AS h FROM {CARD} c)"""

SPLIT_SQL = f"""(WITH base AS {BASE_SQL},
cc AS (SELECT "Class" AS c, count(*)::HUGEINT AS n FROM base GROUP BY 1),
t AS (SELECT sum(n) AS tot1, CAST(ceil(0.2::DOUBLE * sum(n)) AS HUGEINT) AS n_test FROM cc),
a1 AS (SELECT c, n, (n * (tot1 - n_test)) // tot1 AS fl, (n * (tot1 - n_test)) % tot1 AS rem, tot1 - n_test AS d FROM cc, t),
a1r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, n ASC, c DESC) AS rk, d - sum(fl) OVER () AS need FROM a1),
tv AS (SELECT c, n, fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS ntv FROM a1r),
t2 AS (SELECT sum(ntv) AS tot2, CAST(ceil(0.25::DOUBLE * sum(ntv)) AS HUGEINT) AS n_val FROM tv),
a2 AS (SELECT c, ntv, (ntv * (tot2 - n_val)) // tot2 AS fl, (ntv * (tot2 - n_val)) % tot2 AS rem, tot2 - n_val AS d FROM tv, t2),
a2r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, ntv ASC, c DESC) AS rk, d - sum(fl) OVER () AS need FROM a2),
q AS (SELECT c, fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS ntr, ntv FROM a2r),
r AS (SELECT b.*, row_number() OVER (PARTITION BY "Class" ORDER BY h, id) AS rn FROM base b)
SELECT r.* EXCLUDE (rn, h), CASE WHEN rn <= ntr THEN 'train' WHEN rn <= ntv THEN 'validation' ELSE 'test' END AS split
FROM r JOIN q ON r."Class" = q.c)"""


@register("p02_split", f"SELECT id, \"Class\", split FROM {SPLIT_SQL}")
def p02_split(spark, sf_dir):
    """Exact stratified 60/20/20 split (test first, then validation), seeded md5 order."""
    return split_frame(spark, sf_dir).select("id", "Class", "split")


@register("q21_split_profile", f"""
SELECT split, count(*)::BIGINT AS n_rows, sum("Class")::BIGINT AS n_fraud,
  {R('sum("Class")::DOUBLE / count(*)')} AS fraud_rate FROM {SPLIT_SQL} GROUP BY split""")
def q21_split_profile(spark, sf_dir):
    """Q21: rows, positives and positive rate per split."""
    return QL.split_profile(split_frame(spark, sf_dir), target="Class")


def _scale_sql() -> str:
    st = ", ".join(f'avg("{c}") AS m_{c}, CASE WHEN coalesce(stddev_pop("{c}"), 0) = 0 THEN 1.0::DOUBLE '
                   f'ELSE stddev_pop("{c}") END AS s_{c}' for c in SCALE)
    cols = ", ".join(f"{R(f'(s.\"{c}\" - st.m_{c}) / st.s_{c}')} AS \"{c}\"" for c in SCALE)
    return f"""WITH s AS {SPLIT_SQL}, st AS (SELECT {st} FROM s WHERE split = 'train')
SELECT s.id, s.split, {cols}, {R('s."V14"')} AS "V14", CAST(s.hour_of_day < 6.0::DOUBLE AS INTEGER) AS is_night FROM s, st"""


@register("p03_scale", _scale_sql())
def p03_scale(spark, sf_dir):
    """P3+P4+P5: train-only standard scaling (population std, 0 -> 1), fitted order."""
    sp = split_frame(spark, sf_dir).withColumn("is_night", F.col("is_night"))
    model = SP.fit_scaler(sp.filter(F.col("split") == "train"), SCALE, "Class")
    out = model.transform(sp)
    return out.select("id", "split", *SCALE, "V14", "is_night")


@register("p06_fit_metadata", f"""
SELECT split, count(*)::BIGINT AS n_rows, sum("Class")::BIGINT AS n_fraud,
  sum(CAST("Class" = 0 AS BIGINT))::BIGINT AS n_legit, 33 AS n_features FROM {SPLIT_SQL} GROUP BY split""")
def p06_fit_metadata(spark, sf_dir):
    """Split sizes and class distribution with the fitted feature count."""
    sp = split_frame(spark, sf_dir)
    model = SP.fit_scaler(sp.filter(F.col("split") == "train"), SCALE, "Class")
    return SP.fit_metadata(sp, model, "Class")


@register("p08_class_weight", f"""
SELECT "Class", count(*)::BIGINT AS n, {R('(SELECT count(*) FROM ' + CARD + ')::DOUBLE / (2 * count(*))')} AS weight
FROM {CARD} GROUP BY "Class" """)
def p08_class_weight(spark, sf_dir):
    """Balanced class weights n / (2 n_c)."""
    w = SP.balanced_weights(card_features(spark, sf_dir), "Class")
    return w.groupBy("Class").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"))


@register("p09_pos_weight", f"""
SELECT n_pos, n_neg, CASE WHEN n_pos > 0 THEN {R('n_neg::DOUBLE / n_pos', 2)} ELSE 1.0::DOUBLE END AS scale_pos_weight
FROM (SELECT sum(CAST("Class" = 1 AS BIGINT))::BIGINT AS n_pos, sum(CAST("Class" = 0 AS BIGINT))::BIGINT AS n_neg FROM {CARD})""")
def p09_pos_weight(spark, sf_dir):
    """Positive-class scale weight round(n_neg / n_pos, 2)."""
    return SP.positive_scale(card_features(spark, sf_dir), "Class")


@register("p11_seeded_sample", f"""
SELECT id FROM {BASE_SQL} ORDER BY h, id LIMIT 1000""")
def p11_seeded_sample(spark, sf_dir):
    """Deterministic 1000-row sample (seeded hash order)."""
    return SP.seeded_sample(card_features(spark, sf_dir), 1000).select("id")


@register("p12_head_per_class", f"""
SELECT id, "Class" FROM (SELECT id, "Class", row_number() OVER (PARTITION BY "Class" ORDER BY id) AS rn FROM {CARD})
WHERE ("Class" = 1 AND rn <= 12) OR ("Class" = 0 AND rn <= 8)""")
def p12_head_per_class(spark, sf_dir):
    """First 12 positives and first 8 negatives by id, unioned."""
    return SP.union_cohorts(card_features(spark, sf_dir), 12, 8, "id", "Class").select("id", "Class")


@register("j05_leakage", f"SELECT a.id FROM {SPLIT_SQL} a WHERE a.split = 'train' AND a.id IN (SELECT id FROM {SPLIT_SQL} WHERE split = 'test')")
def j05_leakage(spark, sf_dir):
    """Ids in both train and test (empty)."""
    return SP.leakage(split_frame(spark, sf_dir)).select("id")


@register("j06_stratified_sample", f"""
WITH b AS {BASE_SQL}, cc AS (SELECT count(*) AS n, sum("Class") AS f FROM b),
qq AS (SELECT greatest(1, CAST(trunc(1000 * f::DOUBLE / n) AS BIGINT)) AS npos FROM cc),
r AS (SELECT id, "Class", row_number() OVER (PARTITION BY "Class" ORDER BY h, id) AS rn FROM b)
SELECT id, "Class" FROM r, qq WHERE ("Class" = 1 AND rn <= npos) OR ("Class" = 0 AND rn <= 1000 - npos)""")
def j06_stratified_sample(spark, sf_dir):
    """Stratified 1000-row sample keeping the class ratio (exact sizes)."""
    return SP.stratified_sample(card_features(spark, sf_dir), 1000, "id", "Class").select("id", "Class")


@register("j01_keyed_join", """
SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def j01_keyed_join(spark, sf_dir):
    """Alignment by key (not position): documents joined to their labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "inner").select("doc_id", "n_chars", "quality", "toxic")
