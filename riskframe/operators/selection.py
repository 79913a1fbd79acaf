"""Exact selection in a seeded order, without ranking rows.

The rows of each class stand in the order of (60-bit hash of the key, key). Where the first n
of them end is found by counting: a histogram of the hash's leading bits per class
says which bucket holds the n-th row, and the next pass counts only that bucket's rows
by their next bits, until few are left; their keys are counted one by one. What reaches
the driver is bounded: the histogram (``MOST_BUCKETS`` rows), then ``FEW`` keys for each
end looked for. Rows are then told apart by comparing their own hash and key with the ends:
whole rows are never shuffled or sorted.

Rows that share a class and key with an end but are not all wanted (a repeated key) are
written and numbered, part by part; only they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_key60
from ..session import materialize

KEY_BITS = 61  # 60 bits of hash; a missing key comes after them
FIRST_BITS, NEXT_BITS = 11, 12
MOST_BUCKETS, FEW = 200_000, 5_000


@dataclass(frozen=True)
class End:
    """The first n rows of a class: those before (hash, key), and ``take`` of the ``ties`` rows
    that have both."""
    hash: int
    key: Any
    take: int
    ties: int


def order_hash(key: str, seed: int) -> Column:
    return F.coalesce(hash_key60(key, seed), F.lit(1 << 60))


def histogram(df: DataFrame, key: str, target: str, seed: int) -> dict[Any, dict[int, int]]:
    """Rows per class and leading bits of the order (one grouped count)."""
    bucket = F.shiftright(order_hash(key, seed), KEY_BITS - FIRST_BITS)
    rows = df.groupBy(F.col(target).alias("c"), bucket.alias("b")).count().limit(MOST_BUCKETS + 1).collect()
    if len(rows) > MOST_BUCKETS:
        raise ValueError(f"target '{target}' has more than {MOST_BUCKETS >> FIRST_BITS} classes")
    out: dict[Any, dict[int, int]] = {}
    for r in rows:
        out.setdefault(r["c"], {})[r["b"]] = r["count"]
    return out


def find_ends(df: DataFrame, key: str, target: str, seed: int, counted: dict[Any, dict[int, int]],
              wanted: dict[Any, Sequence[int]]) -> dict[tuple[Any, int], End]:
    """The :class:`End` of the first n rows of a class, for each (class, n) with
    0 < n < the class's rows."""
    open_: dict[tuple[Any, int], tuple[int, int, int]] = {}  # (class, n): leading bits, rows before the bucket, rows in it
    for c, ns in wanted.items():
        for n in ns:
            if 0 < n < sum(counted.get(c, {}).values()):
                open_[c, n] = _bucket_of(counted[c], n, 0)
    ends: dict[tuple[Any, int], End] = {}
    shift, h = KEY_BITS - FIRST_BITS, order_hash(key, seed)
    while open_:
        few = {k: v for k, v in open_.items() if v[2] <= FEW or shift == 0}
        many = {k: v for k, v in open_.items() if k not in few}
        if few:
            ends |= _end_by_key(df, key, target, h, shift, few)
        if not many:
            break
        step = min(NEXT_BITS, shift)
        at = sorted({(str(c), v[0]): (c, v[0]) for (c, _), v in many.items()}.values(), key=str)
        which = _which(target, h, shift, at)
        rows = df.select(which.alias("i"), F.shiftright(h, shift - step).alias("b")).where(F.col("i").isNotNull()) \
            .groupBy("i", "b").count().collect()  # at most 2^NEXT_BITS buckets of each
        inner: dict[int, dict[int, int]] = {}
        for r in rows:
            inner.setdefault(r["i"], {})[r["b"]] = r["count"]
        shift -= step
        open_ = {(c, n): _bucket_of(inner[at.index((c, v[0]))], n, v[1]) for (c, n), v in many.items()}
    return ends


def _bucket_of(counts: dict[int, int], n: int, before: int) -> tuple[int, int, int]:
    for b in sorted(counts):
        if before + counts[b] >= n:
            return b, before, counts[b]
        before += counts[b]
    raise ValueError("the rows changed between passes")


def _which(target: str, h: Column, shift: int, at: list[tuple[Any, int]]) -> Column:
    out = F.lit(None).cast("int")
    for i, (c, bits) in enumerate(at):
        out = F.when(F.col(target).eqNullSafe(F.lit(c)) & (F.shiftright(h, shift) == F.lit(bits)), F.lit(i)).otherwise(out)
    return out


def _end_by_key(df: DataFrame, key: str, target: str, h: Column, shift: int, few: dict) -> dict[tuple[Any, int], End]:
    at = sorted({(str(c), v[0]): (c, v[0]) for (c, _), v in few.items()}.values(), key=str)
    rows = df.select(_which(target, h, shift, at).alias("i"), h.alias("h"), F.col(key).alias("k")) \
        .where(F.col("i").isNotNull()).groupBy("i", "h", "k").count()
    # in order of the keys' own type; FEW rows of each end at most, or the keys of one hash
    found = rows.orderBy("i", "h", F.col("k").asc_nulls_last()).collect()
    out = {}
    for (c, n), (bits, before, _) in few.items():
        for r in (r for r in found if r["i"] == at.index((c, bits))):
            if before + r["count"] >= n:
                out[c, n] = End(r["h"], r["k"], n - before, r["count"])
                break
            before += r["count"]
    return out


def label_bands(df: DataFrame, key: str, target: str, seed: int, bands: dict[Any, Sequence[tuple[str, int]]], name: str,
                counted: dict[Any, dict[int, int]] | None = None) -> DataFrame:
    """``df`` with a column of labels: in each class, the first rows in the seeded order get the
    first label, as many as it says, the next rows the next one; the rest gets NULL."""
    counted = histogram(df, key, target, seed) if counted is None else counted
    reach = {c: [sum(n for _, n in list(b)[:i + 1]) for i in range(len(b))] for c, b in bands.items()}
    ends = find_ends(df, key, target, seed, counted, reach)
    h = order_hash(key, seed)
    k = F.col(key)

    def label(tie: Column | None) -> Column:
        out = F.lit(None).cast("string")
        for c, own in bands.items():
            size, value = sum(counted.get(c, {}).values()), F.lit(None).cast("string")
            for (text, _), n in reversed(list(zip(own, reach[c], strict=True))):
                if n <= 0:
                    continue
                if n >= size:
                    value = F.lit(text)
                    continue
                e = ends[c, n]
                same = (h == F.lit(e.hash)) & k.eqNullSafe(F.lit(e.key))
                first = (h < F.lit(e.hash)) | ((h == F.lit(e.hash)) & F.coalesce(k < F.lit(e.key), F.lit(False)))
                inside = first | same if e.take == e.ties else first if tie is None else first | (same & (tie <= F.lit(e.take)))
                value = F.when(inside, F.lit(text)).otherwise(value)
            out = F.when(F.col(target).eqNullSafe(F.lit(c)), value).otherwise(out)
        return out

    torn = F.lit(False)
    for (c, _), e in ends.items():
        if e.take < e.ties:
            torn = torn | (F.col(target).eqNullSafe(F.lit(c)) & (h == F.lit(e.hash)) & k.eqNullSafe(F.lit(e.key)))
    if all(e.take == e.ties for e in ends.values()):
        return df.withColumn(name, label(None))
    same = materialize(df.where(torn).withColumn("_part", F.spark_partition_id()), "repeated-keys")
    group = [F.col(target).alias("_c"), F.col(key).alias("_k"), "_part"]
    sizes = same.groupBy(*group).count()
    before = Window.partitionBy("_c", "_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_c", "_k", F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    numbered = same.withColumn("_i", F.row_number().over(Window.partitionBy(target, key, "_part").orderBy(F.lit(0))))
    match = F.col(target).eqNullSafe(F.col("_c")) & F.col(key).eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p"))
    numbered = numbered.join(sizes, match).withColumn("_tie", F.col("_before") + F.col("_i"))
    apart = numbered.withColumn(name, label(F.col("_tie"))).select(*df.columns, name)
    return df.where(~torn).withColumn(name, label(None)).unionByName(apart)
