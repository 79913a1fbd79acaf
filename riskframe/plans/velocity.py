"""Entity velocity queries (W1-W4, W6) over ``events`` keyed by ``user_id``
(card) and the ``props.k`` code (merchant)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import sig
from ..operators import velocity as VE
from ..sources.tables import card_transactions, transactions
from .registry import CARD, TX, R, S, register

WINDOWS = {"w5m": 300, "w30m": 1800, "w1h": 3600, "w24h": 86400, "w7d": 604800}


def _frame(sec: int, part: str = "entity") -> str:
    return (f"(PARTITION BY {part} ORDER BY epoch_us(ts) RANGE BETWEEN {sec * 1_000_000} PRECEDING "
            f"AND CURRENT ROW)")


def _w12_sql() -> str:
    cols = []
    for n, sec in WINDOWS.items():
        cols.append(f"count(*) OVER {_frame(sec)} AS {n}_count")
        cols.append(f"{R(f'(sum(\"Amount\"::DECIMAL(18,2)) OVER {_frame(sec)})::DOUBLE')} AS {n}_sum")
    return f"SELECT id, {', '.join(cols)} FROM {TX}"


@register("w01_sliding_count_sum", _w12_sql())
def w01_sliding_count_sum(spark, sf_dir):
    """W1+W2: per-user event count and amount sum over [t-W, t] for 5m/30m/1h/24h/7d."""
    tx = transactions(spark, sf_dir).select("id", "entity", "ts", "Amount")
    out = VE.sliding_features(tx, windows=WINDOWS)
    return out.select("id", *[c for n in WINDOWS for c in (f"{n}_count", f"{n}_sum")])


def _w3_sql() -> str:
    """In whole cents: n * q - s * s is exact, so equal amounts have a deviation of 0."""
    fr = _frame(30 * 86400)
    mean, std = "(s::DOUBLE / (n * 100)::DOUBLE)", "sqrt((n * q - s * s)::DOUBLE / (n * n * 10000)::DOUBLE)"
    return f"""
SELECT id, n AS history_count, CASE WHEN n > 0 THEN {R(mean)} END AS history_mean,
  CASE WHEN n > 0 THEN {R(std)} END AS history_std,
  CASE WHEN n > 0 THEN {R(f'("Amount" - {mean}) / ({std} + 0.000000001::DOUBLE)')} END AS velocity_ratio
FROM (SELECT id, "Amount", (count(*) OVER {fr}) - 1 AS n, (sum(c) OVER {fr}) - c AS s, (sum(c * c) OVER {fr}) - c * c AS q
      FROM (SELECT *, CAST("Amount"::DECIMAL(18,2) * 100 AS HUGEINT) AS c FROM {TX}))"""


@register("w03_velocity_ratio", _w3_sql())
def w03_velocity_ratio(spark, sf_dir):
    """Amount against the user's previous 30 days (current row excluded)."""
    tx = transactions(spark, sf_dir).select("id", "entity", "ts", "Amount")
    out = VE.velocity_ratio(tx)
    return out.select("id", "history_count", "history_mean", "history_std", "velocity_ratio")


@register("w04_gap_burst", f"""
SELECT id, {R('gap')} AS seconds_since_prev, coalesce(gap < 15.0::DOUBLE, false) AS is_burst FROM (
  SELECT id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY entity ORDER BY epoch_us(ts), id)) / 1000000.0::DOUBLE AS gap
  FROM {TX})""")
def w04_gap_burst(spark, sf_dir):
    """Seconds since the user's previous event and the < 15 s burst flag."""
    tx = transactions(spark, sf_dir).select("id", "entity", "ts")
    return VE.previous_event(tx).select("id", "seconds_since_prev", "is_burst")


def _w6_sql() -> str:
    card10 = _frame(600)
    amt1h = _frame(3600)
    m24 = _frame(86400, "merchant")
    return f"""
SELECT id, card_count_10m, card_amount_1h,
  CASE WHEN mc > 1 THEN {R('(ms - y)::DOUBLE / (mc - 1)')} END AS merchant_fraud_rate_24h
FROM (SELECT id, y, count(*) OVER {card10} AS card_count_10m,
        {R(f'(sum("Amount"::DECIMAL(18,2)) OVER {amt1h})::DOUBLE')} AS card_amount_1h,
        count(*) OVER {m24} AS mc, sum(y) OVER {m24} AS ms
      FROM (SELECT *, json_extract_string(props, '$.k') AS merchant FROM {TX}))"""


@register("w06_named_windows", _w6_sql())
def w06_named_windows(spark, sf_dir):
    """Card count 10m, card amount 1h, merchant fraud rate 24h excluding the current row."""
    tx = transactions(spark, sf_dir).select("id", "entity", "ts", "Amount", "y",
                                            F.get_json_object("props", "$.k").alias("merchant"))
    out = VE.named_windows(tx, card="entity", merchant="merchant")
    return out.select("id", "card_count_10m", "card_amount_1h", "merchant_fraud_rate_24h")


NULL_ENTITY = f"(SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE entity END AS entity, ts, \"Amount\" FROM {TX})"


def _without_entity(spark, sf_dir):
    tx = transactions(spark, sf_dir).select("id", "entity", "ts", "Amount")
    return tx.withColumn("entity", F.when(F.col("id") % 3 != 0, F.col("entity")))


@register("w01n_null_entity", f"""
SELECT id, count(*) OVER {_frame(3600)} AS w1h_count, {R(f'(sum("Amount"::DECIMAL(18,2)) OVER {_frame(86400)})::DOUBLE')} AS w24h_sum
FROM {NULL_ENTITY}""")
def w01n_null_entity(spark, sf_dir):
    """W1+W2 with a third of the events without an entity: NULL is a group, no event is lost."""
    out = VE.sliding_features(_without_entity(spark, sf_dir), windows={"w1h": 3600, "w24h": 86400})
    return out.select("id", "w1h_count", "w24h_sum")


@register("w04n_null_entity", f"""
SELECT id, {R('(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY entity ORDER BY epoch_us(ts), id)) / 1000000.0::DOUBLE')} AS seconds_since_prev
FROM {NULL_ENTITY}""")
def w04n_null_entity(spark, sf_dir):
    """W4 with events without an entity."""
    return VE.previous_event(_without_entity(spark, sf_dir)).select("id", "seconds_since_prev")


# Places on the globe from two vector columns (the tables have no coordinates).
_LAT, _LON = "greatest(-90.0::DOUBLE, least(90.0::DOUBLE, \"V1\" * 45.0::DOUBLE))", "greatest(-180.0::DOUBLE, least(180.0::DOUBLE, \"V2\" * 90.0::DOUBLE))"
_KM = ("2.0::DOUBLE * 6371.0088::DOUBLE * asin(sqrt(pow(sin(radians(la - pla) / 2), 2) + cos(radians(pla)) * cos(radians(la)) "
       "* pow(sin(radians(lo - plo) / 2), 2)))")


@register("w05_travel_speed", f"""
WITH c AS (SELECT id, entity, ts, {_LAT} AS la, {_LON} AS lo FROM {CARD}),
j AS (SELECT *, lag(la) OVER w AS pla, lag(lo) OVER w AS plo, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS us FROM c
      WINDOW w AS (PARTITION BY entity ORDER BY epoch_us(ts), id)),
k AS (SELECT id, {_KM} AS km, us / 3600000000.0::DOUBLE AS hours FROM j)
SELECT id, {S('km', 7)} AS km_from_prev, {S('CASE WHEN hours > 0 THEN km / hours WHEN km > 0 THEN NULL ELSE 0.0::DOUBLE END', 7)} AS kmh_from_prev,
  coalesce(CASE WHEN hours > 0 THEN km / hours > 900.0::DOUBLE ELSE km > 0 END, false) AS impossible_travel FROM k""", digits=None)
def w05_travel_speed(spark, sf_dir):
    """Distance and speed since the user's previous event, and whether it is possible."""
    clip = lambda c, top, by: F.greatest(F.lit(-top), F.least(F.lit(top), F.col(c) * F.lit(by)))
    ct = card_transactions(spark, sf_dir).select("id", "entity", "ts", clip("V1", 90.0, 45.0).alias("la"), clip("V2", 180.0, 90.0).alias("lo"))
    out = VE.travel_speed(ct, "entity", "ts", "id", "la", "lo")
    speed = F.when(~F.col("kmh_from_prev").isin(float("inf")), F.col("kmh_from_prev"))
    return out.select("id", sig("km_from_prev", 7).alias("km_from_prev"), sig(speed, 7).alias("kmh_from_prev"), "impossible_travel")
