"""Readers for the given parquet tables and their mapping onto the risk data model.

The test tables carry no card transactions, so the logical inputs are derived
from them (never synthesised):

* ``transactions``: ``events`` -> id, entity, ts, Time, Amount, y, p, p2
* ``feature_rows``: ``embeddings`` -> id, V1..V28, Class (label 0 is positive)
* ``lineitem_profile``: ``lineitem`` numeric columns, Class = returnflag 'R'

Only the referenced columns are read, so Parquet column pruning and filter
pushdown apply to every plan built on these.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import dlit

EPOCH = "2024-01-01 00:00:00"
N_V = 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ts_utc(c: str = "ts"):
    """Parquet ``ts`` is TIMESTAMP_NTZ; event-time operators need TIMESTAMP (UTC session)."""
    return F.col(c).cast("timestamp")


def map_events(ev: DataFrame) -> DataFrame:
    """Scored transaction view of ``events`` rows (batch or stream).

    Amount = value; Time = seconds since 2024-01-01; y = event_type is 'error';
    p = value / (value + 50) is a score without transcendental functions so any
    engine reproduces it bit for bit; p2 = floor(p*100)/100 has many ties.
    """
    p = F.col("value") / (F.col("value") + dlit(50.0))
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("entity"),
        F.col("ts"),
        ((F.unix_micros(ts_utc()) - F.unix_micros(F.lit(EPOCH).cast("timestamp"))) / dlit(1e6)).alias("Time"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        p.alias("p"),
        (F.floor(p * dlit(100.0)) / dlit(100.0)).alias("p2"),
        F.col("event_type"),
        F.col("props"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`map_events` over the ``events`` table."""
    return map_events(table(spark, sf_dir, "events"))


def feature_rows(spark: SparkSession, sf_dir: str, n_v: int = N_V) -> DataFrame:
    """V1..V28 from the first 28 embedding dimensions; Class = (label = 0)."""
    em = table(spark, sf_dir, "embeddings")
    cols = [F.col("embedding")[k - 1].cast("double").alias(f"V{k}") for k in range(1, n_v + 1)]
    return em.select(F.col("vec_id").alias("id"), *cols,
                     (F.col("label") == 0).cast("int").alias("Class"))


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("Class"),
    )


def card_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in the card-data layout: id, entity, ts, Time, V1..V28, Amount, Class, p.

    ``events`` gives Time/Amount/Class, ``embeddings`` the V columns, aligned by
    the key ``slot = event_id % n_vectors`` (an equi-join on a derived key, so
    every event keeps one feature vector and the row count grows with
    ``events``). Spark decides from its size whether the vector
    table is broadcast.
    """
    tx = transactions(spark, sf_dir)
    fr = feature_rows(spark, sf_dir).drop("Class")
    n_vec = fr.count()
    vcols = [f"V{k}" for k in range(1, N_V + 1)]
    fr = fr.select((F.col("id") % F.lit(n_vec)).alias("slot"), *vcols)
    return (tx.withColumn("slot", F.col("id") % F.lit(n_vec))
            .join(fr, "slot", "inner")
            .select("id", "entity", "ts", "Time", *vcols, "Amount",
                    F.col("y").alias("Class"), "p"))
