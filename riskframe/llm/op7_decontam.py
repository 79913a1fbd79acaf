"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search,
exact weighted-shingle verification.

Texts and items are lower-cased and split into words of letters and digits. A text can
only be similar to an item if they share a five-word shingle, so a window is looked at
wherever one is shared: it starts as far before the shared place as the item's own
shingle stands from the item's start and is as long as that item. Every window's words
give a 64-bit SimHash. Two fingerprints within ``RADIUS`` bits agree on at least one of
``RADIUS + 1`` disjoint blocks of bits, so an equi-join on (window length, block number,
block bits) finds every item within the radius of a window, not only the one that led
to it. Each such pair is verified: the share of the item's shingles, weighted by their
rarity among the items, that stand in the window must reach ``SIMILARITY``.

No radius holds every window of that share: a few changed words of a short item flip
more bits than unrelated texts differ in. So the items themselves are verified beside
that. An item's rarest shingles that weigh more than ``1 - SIMILARITY`` of it are its
prefix; a window without any of them has a share under ``SIMILARITY``. Where a text holds
a prefix shingle, all windows around it are measured, so every text and item with such a
window is found, whatever their fingerprints, and its similarity is its best window's.

All steps are DataFrame expressions and equi-joins. Only the items' tables are broadcast,
and only below ``BROADCAST_ROWS`` rows (beyond that the joins shuffle). The texts are
read three times, once for shared places and once each for the windows' words and the
words around prefix shingles; what is shuffled follows the places found. A passage that
a third of all texts hold gives one window a text, like any other.

Defined results: null or empty texts and items match nothing; items of under five words
are one shingle of all their words; equal rows get equal verdicts; extra columns pass
through ``drop_contaminated`` unchanged; empty tables give empty or clean results. A null
``item_id`` is a match without an id: it contaminates but is not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, table

#: Parameters.
SHINGLE, SIMILARITY, RADIUS, BITS = 5, 0.8, 11, 64
BROADCAST_ROWS = 500_000
#: Rounding of sums: a share of just SIMILARITY counts in any order of addition.
TIE = 1e-9


def words(c: str):
    text = F.lower(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "")


def shingles(w: str, k: str) -> str:
    """SQL: hashes of all runs of k words of array column w."""
    return (f"CASE WHEN size({w}) >= {k} AND {k} > 0 THEN transform(sequence(1, size({w}) - {k} + 1), "
            f"i -> xxhash64(slice({w}, i, {k}))) ELSE cast(array() AS array<bigint>) END")


def with_fingerprint(df: DataFrame, w: str, out: str) -> DataFrame:
    """SimHash of the words in array column ``w``, each counted as often as it stands.
    Four 16-bit lanes of a long add up a bit each, so sixteen sums give all 64 counts."""
    df = df.withColumn("__s_h", F.transform(F.col(w), lambda x: F.xxhash64(x)))
    lane = 0x0001000100010001
    df = df.withColumns({f"__s_{b}": F.expr(f"aggregate(__s_h, 0L, (s, h) -> s + (shiftrightunsigned(h, {b}) & {lane}L))")
                         for b in range(16)})
    n = F.size(F.col(w))
    fp = F.lit(0).cast("long")
    for b in range(16):
        for x in range(4):
            count = F.shiftrightunsigned(F.col(f"__s_{b}"), 16 * x).bitwiseAND(F.lit(0xFFFF))
            fp = fp.bitwiseOR(F.when(2 * count > n, F.shiftleft(F.lit(1).cast("long"), 16 * x + b)).otherwise(F.lit(0).cast("long")))
    return df.withColumn(out, fp).drop("__s_h", *[f"__s_{b}" for b in range(16)])


def block_edges(radius: int = RADIUS, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 blocks that cover all bits."""
    n = radius + 1
    at = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:], strict=False)]


def blocks(fp: str, radius: int = RADIUS):
    return F.array(*[F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << w) - 1).cast("long")).alias("bits"))
                     for i, (a, w) in enumerate(block_edges(radius))])


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint behind a check of the size."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """One row per item with words: its key, shingle length, shingles and fingerprint."""
    df = docs_of(benchmark, "item_id", "text").withColumn("w", words("text")).drop("text")
    df = df.withColumn("n", F.size("w")).where("n > 0")
    df = df.withColumn("k", F.least(F.col("n"), F.lit(SHINGLE))).withColumn("item", F.xxhash64("item_id", "w"))
    df = df.dropDuplicates(["item"]).withColumn("h", F.expr(shingles("w", "k")))
    return materialize(with_fingerprint(df, "w", "fp").drop("w"), "decontam-items")


SHARE = "aggregate(sv, 0D, (a, x) -> a + IF(array_contains({}, x.s), x.v, 0D)) / aggregate(sv, 0D, (a, x) -> a + x.v)"


def by_prefix(docs: DataFrame, weighted: DataFrame, shared: DataFrame, similarity: float, n_shingles: int) -> DataFrame:
    """(key, item, item_id, similarity) of every text and item with a window that
    reaches ``similarity``. ``shared`` has the texts' places (key, k, h, pos) of shingles
    of items. A window that holds a prefix shingle at p lies within p - (n - k) and p + n,
    and can be moved on to a place of a shingle of the item without losing any: those
    are the windows measured."""
    ranked = weighted.withColumn("sv", F.expr("array_sort(sv, (a, b) -> CASE WHEN a.v > b.v THEN -1 WHEN a.v < b.v THEN 1 "
                                              "WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 ELSE 0 END)"))
    limit = 1 - similarity + 2 * TIE  # of the whole weight
    ranked = ranked.withColumn("total", F.expr("aggregate(sv, 0D, (a, x) -> a + x.v)"))
    # the longest run of rarest shingles that weighs no more than the limit, and one more
    size = F.expr(f"aggregate(sv, named_struct('n', 0, 'w', 0D), (a, x) -> IF(a.w <= total * {limit!r}D, "
                  f"named_struct('n', a.n + 1, 'w', a.w + x.v), a), a -> a.n)")
    prefix = ranked.withColumn("size", size).select("item", "n", "k", F.expr("explode(transform(slice(sv, 1, size), x -> x.s))").alias("h"))
    at = shared.join(small(prefix, n_shingles), ["k", "h"])
    # places of one item within its length are one region
    regions = at.groupBy("key", "item", "n", "k", F.floor(F.col("pos") / F.col("n")).alias("part")).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"))
    regions = materialize(regions.groupBy("key").agg(F.collect_set(F.struct("item", "n", "k", "first", "last")).alias("regions")), "decontam-regions")
    again = docs_of(docs, "doc_id", "text").select(row_key().alias("key"), F.col("text"))
    found = again.join(small(regions, regions.count()), "key").dropDuplicates(["key"])
    found = found.withColumn("w", words("text")).select("key", "w", F.explode("regions").alias("x")).select("key", "x.*", F.expr(
        "slice(w, greatest(x.first - (x.n - x.k), 0) + 1, x.last + x.n - greatest(x.first - (x.n - x.k), 0))").alias("w"))
    found = found.withColumn("wh", F.expr(shingles("w", "k"))).drop("w", "first", "last")
    found = found.join(small(ranked.select("item", "item_id", "sv"), n_shingles), "item").where(F.expr(SHARE.format("wh")) >= similarity - TIE)
    own = found.withColumn("ss", F.expr("transform(sv, x -> x.s)"))
    starts = own.withColumn("starts", F.expr("filter(sequence(1, size(wh)), i -> array_contains(ss, wh[i - 1]))"))
    windows = F.expr("transform(starts, i -> slice(wh, i, n - k + 1))")
    best = F.expr("array_max(transform(windows, y -> " + SHARE.format("y") + "))")
    return starts.withColumn("windows", windows).select("key", "item", "item_id", best.alias("similarity")).where(F.col("similarity") >= similarity - TIE)


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(key, item_id, similarity) of every text and item verified; ``key`` is ``row_key``."""
    items = benchmark_items(benchmark)
    n_items, n_shingles = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("h")), F.lit(0))).first()
    lengths = sorted(r.k for r in items.select("k").distinct().collect())  # at most SHINGLE numbers
    posted = items.select("n", "k", F.posexplode("h").alias("ipos", "h")).distinct()

    rows = docs_of(docs, "doc_id", "text").select(row_key().alias("key"), words("text").alias("w"))
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.expr(shingles("w", str(k))).alias("hs")) for k in lengths]) if lengths \
        else F.expr("cast(array() AS array<struct<k:int,hs:array<bigint>>>)")
    if len(lengths) == 1:
        places = rows.select("key", F.lit(lengths[0]).alias("k"), F.posexplode(F.expr(shingles("w", str(lengths[0])))).alias("pos", "h"))
    else:
        places = rows.select("key", F.explode(each).alias("x")).select("key", F.col("x.k").alias("k"), F.posexplode("x.hs").alias("pos", "h"))
    held = materialize(places.join(small(posted.select("k", "h").distinct(), n_shingles), ["k", "h"]), "decontam-shared")
    shared = held.join(small(posted, n_shingles), ["k", "h"]).select("key", F.greatest(F.col("pos") - F.col("ipos"), F.lit(0)).alias("start"), "n")
    wanted = materialize(shared.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("windows")), "decontam-places")

    again = docs_of(docs, "doc_id", "text").select(row_key().alias("key"), F.col("text"))
    found = again.join(small(wanted, wanted.count()), "key").dropDuplicates(["key"])
    windows = found.withColumn("w", words("text")).select("key", "w", F.explode("windows").alias("x")).select(
        "key", F.expr("slice(w, x.start + 1, x.n)").alias("w"), F.col("x.n").alias("n"))
    windows = windows.withColumn("wh", F.expr(shingles("w", f"least(n, {SHINGLE})")))
    windows = with_fingerprint(windows, "w", "fp").select("key", "n", "fp", F.array_distinct("wh").alias("wh")).distinct()
    probes = windows.select("*", F.explode(blocks("fp", radius)).alias("b")).select("key", "n", "fp", "wh", "b.*")

    rarity = items.select(F.explode(F.array_distinct("h")).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    weighted = items.select("item", F.explode(F.array_distinct("h")).alias("s")).join(small(rarity, n_shingles), "s").groupBy("item").agg(
        F.collect_list(F.struct("s", F.log1p(F.lit(float(max(n_items, 1))) / F.col("df")).alias("v"))).alias("sv"))
    weighted = items.select("item_id", "item", "n", "k", "fp").join(weighted, "item")
    weighted = materialize(weighted.withColumnRenamed("fp", "ifp"), "decontam-index")
    index = weighted.select("item", "item_id", "n", "ifp", "sv", F.explode(blocks("ifp", radius)).alias("b")).select(
        "item", "item_id", "n", "ifp", "sv", "b.*")
    near = probes.join(small(index, n_items * (radius + 1)), ["n", "block", "bits"])
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
    near = near.select("key", "item", "item_id", F.expr(SHARE.format("wh")).alias("similarity")).where(F.col("similarity") >= similarity - TIE)
    return near.unionByName(by_prefix(docs, weighted, held, similarity, n_shingles)).groupBy(
        "key", "item").agg(F.first("item_id").alias("item_id"), F.max("similarity").alias("similarity"))


def row_key():
    """Equal (doc_id, text) rows share a key and a verdict."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_set(F.col("item_id").cast("long"))).alias("items"), F.max("similarity").alias("similarity"))


def find_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the items found in it."""
    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"))
    return rows.join(materialize(verdicts(docs, benchmark), "decontam-verdicts"), "key", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any item, all columns unchanged."""
    found = materialize(leaks(docs, benchmark).select(F.col("key").alias("__key")).distinct(), "decontam-keys")
    kept = docs.withColumn("__key", row_key()).join(small(found, found.count()), "__key", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` against every item of ``benchmark``."""
    return find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
