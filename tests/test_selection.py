"""Seeded selection against a full sort: ends, repeated keys, missing keys, deep refinement."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskframe.operators import selection as SE
from riskframe.operators import split as SP


def order(key, seed):
    if key is None:
        return (1 << 60, 0, "")
    return (int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:15], 16), 0, key)


def brute(rows, seed, bands):
    """Per class, how many rows of each key get each label."""
    out = Counter()
    for c, own in bands.items():
        keys = sorted((k for k, d in rows if d == c), key=lambda k: order(k, seed))
        at = 0
        for label, n in own:
            for k in keys[at:at + n]:
                out[c, k, label] += 1
            at += n
    return out


@pytest.mark.parametrize("first,step,few", [(11, 12, 5000), (2, 3, 1), (1, 7, 4)])
def test_bands_equal_a_sort(spark, monkeypatch, first, step, few):
    for name, value in (("FIRST_BITS", first), ("NEXT_BITS", step), ("FEW", few)):
        monkeypatch.setattr(SE, name, value)
    rng = random.Random(first)
    rows = [(f"k{rng.randrange(150)}" if rng.random() < 0.6 else f"u{i}", rng.choice("aab")) for i in range(400)]
    rows += [("hot", "a")] * 150 + [(None, "a")] * 7 + [(None, None)] * 3 + [("x", None)] * 2
    n = Counter(c for _, c in rows)
    hot = sum(order(k, 5) < order("hot", 5) for k, c in rows if c == "a")
    bands = {"a": [("p", hot + 60), ("q", 30), ("r", n["a"] - hot - 93), ("s", 1)], "b": [("p", 0), ("q", n["b"])],
             None: [("p", 4), ("q", 100)]}
    df = spark.createDataFrame([(k, c, i, "w" * 50) for i, (k, c) in enumerate(rows)], "k string, c string, i long, wide string").repartition(6)
    got = SE.label_bands(df, "k", "c", 5, bands, "band").collect()
    assert sorted(r.i for r in got) == list(range(len(rows)))
    assert Counter((r.c, r.k, r.band) for r in got if r.band) == brute(rows, 5, bands)


def test_rows_are_not_shuffled_to_be_split(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7 == 0).cast("int").alias("Class"), *[F.rand(1).alias(f"V{i}") for i in range(20)])
    out = SP.stratified_split(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    counts = {(r["split"], r["Class"]): r["count"] for r in out.groupBy("split", "Class").count().collect()}
    want = SP.split_quotas({0: 5000 - 715, 1: 715}, 0.2, 0.2)
    assert counts == {(s, c): n for c, q in want.items() for s, n in zip(("train", "validation", "test"), q)}


def test_empty_and_too_many_classes(spark, monkeypatch):
    none = spark.createDataFrame([], "id long, Class int")
    assert SE.label_bands(none, "id", "Class", 1, {0: [("a", 3)]}, "band").collect() == []
    monkeypatch.setattr(SE, "MOST_BUCKETS", 10)
    with pytest.raises(ValueError, match="classes"):
        SE.histogram(spark.range(50).withColumn("Class", F.col("id")), "id", "Class", 1)
