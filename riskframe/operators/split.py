"""Exact stratified splits, train-only scaling, class weights, samples.

Exact quotas: per-class sizes follow the largest-remainder allocation used
by stratified shuffle splitting (train drawn first, the rest is test);
within a class, rows are ordered by a seeded md5 key. Where each part ends in that
order is found by counting (:mod:`selection`), and rows are compared with the ends: no row is
ranked or shuffled, whatever the classes' sizes.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import dlit, hash_key60, rnd
from .selection import histogram, label_bands

MAX_CLASSES = 10_000


def allocate(counts: dict, n_draw: int) -> dict:
    """Largest-remainder allocation of ``n_draw`` over class counts (exact
    integer arithmetic); ties go to the rarer class, then the larger label."""
    total = sum(counts.values())
    if total == 0:
        return {c: 0 for c in counts}
    base = {c: (n * n_draw) // total for c, n in counts.items()}
    rem = {c: (n * n_draw) % total for c, n in counts.items()}
    need = n_draw - sum(base.values())
    order = sorted(counts, key=lambda c: (-rem[c], counts[c], -c if isinstance(c, (int, float)) else 0))
    for c in order[:need]:
        base[c] += 1
    return base


def split_quotas(counts: dict, test_size: float, val_size: float) -> dict:
    """Per class: (n_train, n_val, n_test) for test-first then validation splits."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    trainval = allocate(counts, n - n_test)
    n_tv = sum(trainval.values())
    rel = val_size / (1.0 - test_size)
    n_val = math.ceil(rel * n_tv)
    train = allocate(trainval, n_tv - n_val)
    return {c: (train[c], trainval[c] - train[c], counts[c] - trainval[c]) for c in counts}


def class_counts(df: DataFrame, target: str) -> dict:
    """Rows per class (one small aggregate; bounded by the number of classes)."""
    rows = df.groupBy(target).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"target '{target}' has more than {MAX_CLASSES} classes")
    return {r[target]: int(r["count"]) for r in rows}


def preflight(counts: dict, min_positives: int = 10) -> None:
    """Exactly two classes and at least ``min_positives`` positives."""
    if counts.get(None):
        raise ValueError(f"{counts[None]} rows have no class; drop or label them before a split")
    classes = list(counts)
    if len(classes) != 2:
        raise ValueError(f"Expected exactly 2 classes, got {sorted(classes)}")
    if counts.get(1, 0) < min_positives:
        raise ValueError(f"Need at least {min_positives} positive samples, got {counts.get(1, 0)}")


def stratified_split(df: DataFrame, key: str = "id", target: str = P.TARGET,
                     params: P.SplitParams = P.SplitParams(), check: bool = True) -> DataFrame:
    """Adds ``split`` in {'train','validation','test'} with exact per-class quotas."""
    counted = histogram(df, key, target, params.seed)
    counts = {c: sum(b.values()) for c, b in counted.items()}
    if check:
        preflight(counts)
    quotas = split_quotas(counts, params.test_size, params.val_size)
    bands = {c: list(zip(("train", "validation", "test"), q, strict=True)) for c, q in quotas.items()}
    return label_bands(df, key, target, params.seed, bands, "split", counted)


# --------------------------------------------------------------------------
# Train-only standard scaling
# --------------------------------------------------------------------------
@dataclass
class ScalerModel:
    """Fitted state: per column (mean, population std); std 0 -> 1."""
    stats: dict = field(default_factory=dict)
    scale_cols: list = field(default_factory=list)
    passthrough: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - mean) / std for scaled columns, then passthrough columns, in the
        fitted order; other columns are kept after them."""
        out = df.withColumns({c: (F.col(c).cast("double") - dlit(self.stats[c][0])) / dlit(self.stats[c][1])
                              for c in self.scale_cols})
        first = self.scale_cols + self.passthrough
        return out.select(*first, *[c for c in out.columns if c not in first])

    @property
    def feature_order(self) -> list:
        return self.scale_cols + self.passthrough

    def to_json(self) -> str:
        return json.dumps({"stats": self.stats, "scale_cols": self.scale_cols, "passthrough": self.passthrough})

    @classmethod
    def from_json(cls, s: str) -> "ScalerModel":
        d = json.loads(s)
        return cls({k: tuple(v) for k, v in d["stats"].items()}, d["scale_cols"], d["passthrough"])

    def stats_frame(self, spark) -> DataFrame:
        rows = [(c, float(m), float(s)) for c, (m, s) in self.stats.items()]
        return spark.createDataFrame(rows, "feature string, mean double, std double")


def passthrough_columns(df: DataFrame, scale_cols: Sequence[str], target: str = P.TARGET) -> list:
    """V[0-9]+ columns in name order then is_night; overlap with scaled columns is an error."""
    import re
    vs = sorted([c for c in df.columns if re.match(r"^V[0-9]+$", c)], key=lambda c: int(c[1:]))
    extra = [c for c in P.PASSTHROUGH_EXTRA if c in df.columns]
    pt = vs + extra
    overlap = set(pt) & set(scale_cols)
    if overlap:
        raise ValueError(f"Columns both scaled and passed through: {sorted(overlap)}")
    return [c for c in pt if c != target]


def fit_scaler(train: DataFrame, scale_cols: Sequence[str] = P.SCALE_COLUMNS,
               target: str = P.TARGET) -> ScalerModel:
    """One aggregate over the training rows only; a handful of numbers
    (two per scaled column) reach the driver."""
    cols = [c for c in scale_cols if c in train.columns]
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]).first()
    stats = {}
    for c in cols:
        s = row[f"s_{c}"]
        stats[c] = (float(row[f"m_{c}"]), float(s) if s not in (None, 0.0) and s == s else 1.0)
    return ScalerModel(stats, cols, passthrough_columns(train, cols, target))


def fit_metadata(split_df: DataFrame, model: ScalerModel, target: str = P.TARGET) -> DataFrame:
    """Sizes and class distribution per split (scaler stats: ``model.stats_frame``)."""
    return split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(target).cast("bigint")).alias("n_fraud"),
        F.sum((F.col(target) == 0).cast("bigint")).alias("n_legit"),
    ).withColumn("n_features", F.lit(len(model.feature_order)))


# --------------------------------------------------------------------------
# Class weights
# --------------------------------------------------------------------------
def balanced_weights(df: DataFrame, target: str = P.TARGET, name: str = "weight") -> DataFrame:
    """N / (n_classes * n_c) per row's class (sklearn 'balanced')."""
    counts = class_counts(df, target)
    n, k = sum(counts.values()), len(counts)
    w = F.lit(None).cast("double")
    for c, nc in counts.items():
        w = F.when(F.col(target) == F.lit(c), dlit(n / (k * nc))).otherwise(w)
    return df.withColumn(name, w)


def positive_scale(df: DataFrame, target: str = P.TARGET) -> DataFrame:
    """round(n_neg / n_pos, 2), 1.0 when there are no positives (one row)."""
    agg = df.agg(F.sum((F.col(target) == 1).cast("bigint")).alias("n_pos"),
                 F.sum((F.col(target) == 0).cast("bigint")).alias("n_neg"))
    return agg.select("n_pos", "n_neg", F.when(F.col("n_pos") > 0,
                      rnd(F.col("n_neg") / F.col("n_pos").cast("double"), 2)).otherwise(dlit(1.0))
                      .alias("scale_pos_weight"))


def positive_weight_column(df: DataFrame, scale: float, target: str = P.TARGET, name: str = "weight") -> DataFrame:
    return df.withColumn(name, F.when(F.col(target) == 1, dlit(scale)).otherwise(dlit(1.0)))


# --------------------------------------------------------------------------
# Samples and heads (P11, P12, J4, J6), leakage
# --------------------------------------------------------------------------
def seeded_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """A deterministic sample of ``n`` rows (smallest seeded hashes) - the
    sampling operator itself, executed as a per-partition top-n."""
    return df.withColumn("_h", hash_key60(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def head_per_class(df: DataFrame, n: dict, key: str = "id", target: str = P.TARGET) -> DataFrame:
    """The first n_c rows of each class by ``key``: one top-n per class
    (``TakeOrderedAndProject``: n rows per partition, never a full sort)."""
    out = None
    for c, k in n.items():
        part = df.filter(F.col(target) == F.lit(c)).orderBy(key).limit(int(k))
        out = part if out is None else out.unionByName(part)
    return out


def union_cohorts(df: DataFrame, n_pos: int = 12, n_neg: int = 8, key: str = "id",
                  target: str = P.TARGET) -> DataFrame:
    """The first positives and first negatives unioned (by name)."""
    pos = head_per_class(df.filter(F.col(target) == 1), {1: n_pos}, key, target)
    neg = head_per_class(df.filter(F.col(target) == 0), {0: n_neg}, key, target)
    return pos.unionByName(neg)


def stratified_sample(df: DataFrame, n: int, key: str = "id", target: str = P.TARGET, seed: int = 42) -> DataFrame:
    """``max(1, int(n * frac_pos))`` positives + the rest negatives, chosen
    in seeded-hash order within each class (exact sizes)."""
    counted = histogram(df, key, target, seed)
    counts = {c: sum(b.values()) for c, b in counted.items()}
    total = sum(counts.values())
    n_pos = max(1, int(n * counts.get(1, 0) / total)) if total else 0
    bands = {1: [("in", min(n_pos, counts.get(1, 0)))], 0: [("in", min(n - n_pos, counts.get(0, 0)))]}
    return label_bands(df, key, target, seed, bands, "_in", counted).where(F.col("_in").isNotNull()).drop("_in")


def leakage(split_df: DataFrame, key: str = "id", a: str = "train", b: str = "test") -> DataFrame:
    """Keys present in both splits (must be empty)."""
    left = split_df.filter(F.col("split") == a).select(key)
    right = split_df.filter(F.col("split") == b).select(key)
    return left.join(right, key, "left_semi")
