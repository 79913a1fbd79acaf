"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

A text is lower-cased (A-Z), split at ASCII white space and becomes its five-word
shingles. A shingle's weight is (1 + ln tf) * idf, with a damped inverse document
frequency ``1 + DAMP * ln(N / df) / ln N`` (df and N over all documents), so that a
passage many texts share counts less, but the copies of one text still count fully.
Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per text; texts that
agree on a band of samples are candidates, and every candidate pair that is followed is
verified by the exact weighted Jaccard similarity, which must reach ``SIMILARITY``.
Classes are the connected components of the verified links; equal texts are one node.

How the work is spread:
* A scan cuts the documents into chunks of some MB; per chunk the distinct shingles,
  split by hash range into buckets, are sent to count df over all chunks, and only
  those with df >= 2 come back. Chunks and buckets grow with the data, not in size.
* A shingle of df 1 can be in no intersection. So a text whose weight on shingles of
  df >= 2 is under ``SIMILARITY`` of its total has no partner; only the others are
  sampled (an exact bound: no link is lost by it).
* In each bucket of a band one member, the one whose buckets are largest (the least
  edited copy of a group), is compared with all others. That joins most groups.
* Buckets that still hold several classes go on. Those with at most ``FEW`` members outside the
  largest class, or ``WHOLE`` members in all, are finished: their members outside the largest class
  are compared with all others, block by block in the tasks, and only links leave a task.
* In a larger one all members are compared with the lightest one, L. Two members that are not
  both similar to L reach ``SIMILARITY`` only with a shingle in common that L lacks or weighs
  less (the rest of what they share weighs too little), so they meet again in a bucket of
  (L, shingle). A member unlike L is posted with the fewest of its shingles outside L that
  suffice, one like L with all (few). So it goes on for ``LEVELS`` levels; what is undecided
  in the last one is finished by blocks, too, so no link is lost (a bucket of n unlike texts that
  the levels do not part costs n * n comparisons, and n / ``BLOCK`` copies of its rows).
* No pairs within a bucket are emitted, and a bucket is never gathered in a task: leaders
  are aggregates, members join them or are dealt in blocks, and Spark splits skewed joins.
* Components by alternating large-star and small-star steps on the links.

Defined results: null and empty texts have no shingles and are equal texts of one class;
texts of under five words are one shingle; equal rows share a class; a null ``doc_id``
keeps its row (the class id is the smallest id of the class, null if all are null); extra
columns pass through ``drop_near_duplicates`` unchanged; an empty table has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, free_worker, materialize, mix64, shingle_hashes, slices, table, trim, trimmed, word_hashes

#: Parameters.
SHINGLE, SIMILARITY, BANDS, ROWS, DAMP = 5, 0.8, 16, 4, 0.1
#: Characters per chunk of documents, and shingles per bucket of hashes (about).
CHUNK, BUCKET = 4_000_000, 1_000_000
#: Members outside the largest class of a bucket, or in all of it, that are compared with all
#: of it at once.
FEW, WHOLE = 32, 2000
#: Members, and total weight (no less than the shingles), of a block of a bucket.
BLOCK, BLOCK_WEIGHT = 500, 500_000
#: Levels of buckets, before those still undecided are compared whole.
LEVELS = 3
#: Steps of the component search before it fails (it needs a few).
STEPS = 60

PARTS = "chunk long, bucket int, n_docs int, n_shingles long, payload binary"


def digest(text: str | None) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))


# ---------------------------------------------------------------- chunks
def pack_docs(texts: dict[bytes, bytes]) -> bytes:
    import zstandard

    keys, bodies = list(texts), list(texts.values())
    head = np.array([len(keys), *map(len, bodies)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(keys) + b"".join(bodies))


def unpack_docs(payload: bytes) -> list[tuple[bytes, bytes]]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    size = np.frombuffer(data, np.int64, n, 8)
    at = 8 + 8 * n
    keys = [data[at + 16 * i:at + 16 * i + 16] for i in range(n)]
    ends = at + 16 * n + np.cumsum(size)
    return [(k, data[e - s:e]) for k, s, e in zip(keys, size.tolist(), ends.tolist(), strict=True)]


def pack_hashes(hashes: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted 32-bit hashes as differences in byte planes, and their document counts
    (only those over 1 with their places)."""
    import zstandard

    steps = np.diff(hashes, prepend=np.uint32(0)).astype(np.uint32)
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes() if len(steps) else b""
    more = np.flatnonzero(times > 1).astype(np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(
        np.array([len(hashes), len(more)], np.int64).tobytes() + planes + more.tobytes() + times[more].astype(np.uint32).tobytes())


def unpack_hashes(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(payload)
    n, m = (int(x) for x in np.frombuffer(data, np.int64, 2))
    planes = np.frombuffer(data, np.uint8, 4 * n, 16).reshape(4, n).T
    hashes = np.cumsum(np.ascontiguousarray(planes).view(np.uint32).ravel(), dtype=np.uint32)
    times = np.ones(n, np.int64)
    more = np.frombuffer(data, np.uint32, 2 * m, 16 + 4 * n).reshape(2, m)
    times[more[0]] = more[1]
    return hashes, times


def chunk_parts(docs: DataFrame, bucket_bits: int) -> DataFrame:
    """Per chunk one row with its distinct texts (bucket -1), and per bucket of hashes
    one with the distinct shingles (32 bits of the hash below the bucket's) and how
    many of the chunk's documents hold each."""

    def run(batches):
        from pyspark import TaskContext

        free_worker()
        part, seq = TaskContext.get().partitionId(), 0
        texts: dict[bytes, bytes] = {}
        copies: dict[bytes, int] = {}
        size = n_docs = 0

        def flush():
            arrays, times = [], []
            for key, body in texts.items():
                s = np.unique(shingle_hashes(word_hashes(body.lower()), SHINGLE))
                arrays.append(s)
                times.append(np.full(len(s), copies[key], np.int64))
            every = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
            order = np.argsort(every, kind="stable")
            every, n = every[order], np.concatenate(times)[order] if times else np.zeros(0, np.int64)
            first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            shingles, counts = every[first], np.add.reduceat(n, first) if len(first) else n
            rows = [(-1, n_docs, len(shingles), pack_docs(texts))]
            top = (shingles >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(shingles), np.int64)
            low = ((shingles >> np.uint64(32 - bucket_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            edges = np.searchsorted(top, np.arange((1 << bucket_bits) + 1))
            for b in range(1 << bucket_bits):
                lo, hi = edges[b], edges[b + 1]
                if hi > lo:
                    rows.append((b, 0, 0, pack_hashes(low[lo:hi], counts[lo:hi])))
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq] * len(rows), pa.int64()), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], names=["chunk", "bucket", "n_docs", "n_shingles", "payload"])

        for b in slices(batches, 250):
            for text in b.column(0).to_pylist():
                body, key = (text or "").encode("utf-8", "surrogatepass"), digest(text)
                n_docs += 1
                copies[key] = copies.get(key, 0) + 1
                if copies[key] == 1:
                    texts[key] = body
                    size += len(body)
                if size >= CHUNK:
                    yield flush()
                    texts, copies, size, n_docs, seq = {}, {}, 0, 0, seq + 1
        if n_docs:
            yield flush()

    return docs_of(docs, "text").select(F.col("text").cast("string")).mapInArrow(trimmed(run), PARTS)


def bucket_bits(docs: DataFrame) -> int:
    """Buckets of about BUCKET shingles, from the corpus' size in characters (a
    shingle starts every six or so)."""
    chars = docs_of(docs, "text").agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    return min(20, max(0, math.ceil(math.log2(max(1, chars / 6 / BUCKET)))))


def frequent(parts: DataFrame) -> DataFrame:
    """Per chunk and bucket the shingles with df >= 2 and their df. A bucket's task
    holds one array per chunk of 32-bit hashes, BUCKET of them in all."""

    def count(t: pa.Table) -> pa.Table:
        chunks = t.column("chunk").to_pylist()
        sets = [unpack_hashes(p) for p in t.column("payload").to_pylist()]
        every = np.concatenate([h for h, _ in sets])
        order = np.argsort(every, kind="stable")
        every, n = every[order], np.concatenate([c for _, c in sets])[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        df = np.add.reduceat(n, first)
        shared, df = every[first][df >= 2], df[df >= 2]
        out = []
        for h, _ in sets:
            at = np.minimum(np.searchsorted(shared, h), max(0, len(shared) - 1))
            hit = shared[at] == h if len(shared) else np.zeros(len(h), bool)
            out.append(pack_hashes(h[hit], df[at[hit]]))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": t.column("bucket"), "payload": pa.array(out, pa.binary())})

    return parts.where("bucket >= 0").select("chunk", "bucket", "payload").groupBy("bucket").applyInArrow(
        count, "chunk long, bucket int, payload binary")


# ---------------------------------------------------------------- sampling
def uniforms(x: np.ndarray, n: int) -> list[np.ndarray]:
    """n uniform numbers in (0, 1) per hash: 21 bits each, three from a mix."""
    out: list[np.ndarray] = []
    while len(out) < n:
        x = mix64(x + np.uint64(0x9E3779B97F4A7C15))
        for shift in (43, 22, 1):
            out.append(((x >> np.uint64(shift)) & np.uint64(0x1FFFFF)).astype(np.float32) * np.float32(2.0**-21) + np.float32(2.0**-22))
    return out[:n]


SEEDS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def samples(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling (Ioffe 2010): per sample the chosen
    shingle and its quantised weight level, as one hash."""
    out = np.zeros(len(SEEDS), np.uint64)
    log_weight = np.log(weights).astype(np.float32)
    best = np.full(len(SEEDS), np.inf, np.float32)
    for at in range(0, len(shingles), 512):  # pieces that stay in the cache
        s, lw = shingles[at:at + 512], log_weight[at:at + 512]
        u1, u2, u3, u4, beta = uniforms((s[None, :] ^ SEEDS[:, None]).ravel(), 5)
        r = -np.log(u1 * u2)
        level = np.floor(np.tile(lw, len(SEEDS)) / r + beta)
        log_a = np.log(-np.log(u3 * u4)) - r * (level - beta + 1)
        log_a, level = log_a.reshape(len(SEEDS), -1), level.reshape(len(SEEDS), -1)
        pick = log_a.argmin(axis=1)
        row = np.arange(len(SEEDS))
        value, better = log_a[row, pick], log_a[row, pick] < best
        best = np.where(better, value, best)
        chosen = mix64(s[pick] + level[row, pick].astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        out = np.where(better, chosen, out)
    return out


def band_keys(sample: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for row in range(ROWS):
        keys = mix64(keys + sample[row::ROWS][:BANDS])
    return keys.view(np.int64)


def weigh(shingles: np.ndarray, times: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    scale = DAMP / math.log(n) if n > 1 else 0.0
    return (1 + np.log(times)) * (1 + scale * np.log(n / np.maximum(df, 1)))


TEXTS = "node binary, total double, shingles binary, weights binary, bands array<long>"


def sample_texts(parts: DataFrame, shared: DataFrame, n: int, bits: int) -> DataFrame:
    """Per distinct text of a chunk that can have a partner: its band keys, total
    weight, and the shingles of df >= 2 with their weights."""

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        free_worker()
        hashes, dfs = [], []
        for b, payload in sorted(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True)):
            h, df = unpack_hashes(payload)
            hashes.append((np.uint64(b) << np.uint64(32)) | h.astype(np.uint64))
            dfs.append(df)
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        df_of = np.concatenate(dfs) if dfs else np.zeros(0, np.int64)
        out = [[] for _ in range(5)]
        for payload in left.column("payload").to_pylist():
            for key, body in unpack_docs(payload):
                s, times = np.unique(shingle_hashes(word_hashes(body.lower()), SHINGLE), return_counts=True)
                if not len(s):
                    continue
                ids = s >> np.uint64(32 - bits)
                at = np.minimum(np.searchsorted(every, ids), max(0, len(every) - 1))
                hit = every[at] == ids if len(every) else np.zeros(len(s), bool)
                df = np.where(hit, df_of[at], 1) if len(every) else np.ones(len(s), np.int64)
                w = weigh(s, times, df, n).astype(np.float16).astype(np.float64)
                if w[hit].sum() < (SIMILARITY - 1e-9) * w.sum():
                    continue
                # 32 bits tell a text's shingles apart; the few that fall together are one
                short, which = np.unique(ids[hit].astype(np.uint32), return_inverse=True)
                row = (key, float(w.sum()), short.tobytes(), np.bincount(which, w[hit]).astype(np.float16).tobytes(), band_keys(samples(s, w)).tolist())
                for col, v in zip(out, row, strict=True):
                    col.append(v)
        kinds = [pa.binary(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        del hashes, dfs, every, df_of
        trim()  # the chunk's arrays, before the next one's
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["node", "total", "shingles", "weights", "bands"])

    bodies = parts.where("bucket < 0").select(F.col("chunk").alias("home"), "payload")
    return bodies.groupBy("home").cogroup(shared.groupBy("chunk")).applyInArrow(sample, TEXTS)


# ---------------------------------------------------------------- links
#: Part of a similar pair's total weight that it shares at least, and what is left for rounding.
SHARE, SLACK = SIMILARITY / (1 + SIMILARITY), 1e-3


def compare(a: tuple, b: tuple) -> tuple[float, float, np.ndarray]:
    """Of (total, shingles, weights) features: weighted Jaccard similarity, common weight,
    and the weights of ``a`` beyond those of ``b``."""
    _, ia, ib = np.intersect1d(a[1], b[1], assume_unique=True, return_indices=True)
    shared = np.minimum(a[2][ia], b[2][ib]).astype(np.float64)
    both = float(shared.sum())
    beyond = a[2].astype(np.float64)
    beyond[ia] -= shared
    return both / max(a[0] + b[0] - both, 1e-12), both, beyond


def outside(a: tuple, b: tuple, similar: bool, both: float, beyond: np.ndarray) -> np.ndarray:
    """Shingles of ``a`` that weigh more there than in ``b``, which is no heavier: all, or of an
    ``a`` unlike ``b`` the first ones in an order of all texts, so many that the rest cannot
    hold what ``a`` must share beyond ``b`` with a similar text."""
    ids, weights = a[1][beyond > 0], beyond[beyond > 0]
    if similar:
        return ids
    need = SHARE * (a[0] + max(b[0], SIMILARITY * a[0])) - both - SLACK * a[0]
    order = np.argsort(mix64(ids), kind="stable")
    rest = np.cumsum(weights[order][::-1])[::-1]
    return ids[order][rest >= need]


def verify(pairs: DataFrame, texts: DataFrame, onward: bool = False) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) that reach SIMILARITY. ``onward``: of all pairs,
    similarity null below it, with the total of a and the shingles that carry it on. The
    second join's many rows of one leader are a skewed join, which Spark splits."""
    def side(x):
        return texts.select(F.col("node").alias(x), F.struct("total", "shingles", "weights").alias(f"f{x}"))

    schema = "a binary, b binary, similarity double" + (", total double, onward array<int>" if onward else "")
    kinds = [pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.list_(pa.int32())][:5 if onward else 3]
    names = ["a", "b", "similarity", "total", "onward"][:len(kinds)]

    def check(batches):
        for batch in slices(batches, 100):
            rows = []
            for a, b, *f in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                fa, fb = ((x["total"], np.frombuffer(x["shingles"], np.uint32), np.frombuffer(x["weights"], np.float16)) for x in f)
                s, both, beyond = compare(fa, fb)
                similar = s >= SIMILARITY - 1e-6
                if onward:
                    rows.append((a, b, s if similar else None, fa[0], outside(fa, fb, similar, both, beyond).view(np.int32)))
                elif similar:
                    rows.append((a, b, s))
            cols = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "fa", "fb")
    return both.mapInArrow(trimmed(check), schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of the links with the smallest node of its component."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "neardup-edges")
    seen = None
    for _ in range(STEPS):
        # large star: the larger neighbours of each node go to its smallest neighbour
        ways = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "neardup-edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {STEPS} steps")
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def links_of(texts: DataFrame) -> DataFrame:
    """Verified links (a, b) between different texts: those to the central member of each
    bucket, then those that join the buckets' classes further."""
    rows = texts.select("node", F.explode("bands").alias("band"))
    sizes = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = materialize(rows.join(sizes, "band"), "neardup-bands")
    central = rows.groupBy("node").agg(F.sum("size").alias("central"))
    rows = rows.select("band", "node").join(central, "node")
    leaders = rows.groupBy("band").agg(F.max(F.struct("central", "node")).alias("x")).select("band", F.col("x.node").alias("leader"))
    links = materialize(verify(led_pairs(rows, leaders), texts), "neardup-links")
    held = texts.select("node", "total", "bands")
    for level in range(LEVELS):
        rows = materialize(undecided(held, components(links)), "neardup-rows")
        at_once = F.lit(level + 1 == LEVELS) | (F.col("others") <= FEW) | (F.col("size") <= WHOLE)
        links = links.union(materialize(block_links(rows.where(at_once), texts), "neardup-links"))
        rows = rows.where(~at_once)
        if rows.isEmpty():
            break
        leaders = rows.groupBy("band").agg(F.min(F.struct("total", "node")).alias("x")).select("band", F.col("x.node").alias("leader"))
        seen = materialize(verify(led_pairs(rows, leaders), texts, onward=True), "neardup-seen")
        links = links.union(seen.where("similarity IS NOT NULL").select("a", "b", "similarity"))
        held = seen.select(F.col("a").alias("node"), "total", F.expr("transform(onward, x -> xxhash64(b, x))").alias("bands"))
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "similarity").dropDuplicates(["a", "b"])


def led_pairs(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    return rows.join(leaders, "band").where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()


def block_links(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of the similar members of each bucket that are of different classes. The
    members outside the largest class ask (block i of the bucket) all members (block j): a
    task holds one pair of blocks, and a member is copied once per block that it meets."""
    keys = ["band", "i", "j"]

    def blocks(n, weight):
        return F.ceil(F.greatest(F.col(n) / BLOCK, F.col(weight) / BLOCK_WEIGHT, F.lit(1.0)))

    dealt = rows.withColumns({"outer": F.col("root") != F.col("top"), "n_i": blocks("others", "other_weight"), "n_j": blocks("size", "weight")})
    dealt = dealt.withColumns({"my_i": F.pmod(F.xxhash64("node"), F.col("n_i")), "my_j": F.pmod(F.xxhash64("node"), F.col("n_j"))})
    dealt = dealt.withColumn("at", F.explode(F.expr("""concat(
        transform(sequence(0L, n_i - 1), k -> struct(k AS i, my_j AS j, false AS asks)),
        if(outer, transform(sequence(0L, n_j - 1), k -> struct(my_i AS i, k AS j, true AS asks)), array()))""")))
    dealt = dealt.select("node", "band", "at.*", "root", "outer").join(texts.select("node", "total", "shingles", "weights"), "node")
    dealt = dealt.select(*keys, "asks", "node", "root", "outer", "total", "shingles", "weights")

    def run(batches):
        key, asking, members = None, [], []

        def done():
            cols = list(zip(*similar_across(asking, members), strict=True)) or [[]] * 3
            kinds = pa.binary(), pa.binary(), pa.float64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["a", "b", "similarity"])

        for batch in slices(batches, 100):
            for *at, asks, node, root, outer, total, shingles, weights in zip(*(batch.column(c).to_pylist() for c in range(10)), strict=True):
                if at != key:
                    if asking and members:
                        yield done()
                    key, asking, members = at, [], []
                row = (node, root, outer, total, np.frombuffer(shingles, np.uint32), np.frombuffer(weights, np.float16))
                (asking if asks else members).append(row)
        if asking and members:
            yield done()

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimmed(run), "a binary, b binary, similarity double")


def similar_across(asking: list[tuple], members: list[tuple]) -> list[tuple]:
    """(a, b, similarity) of the similar pairs of the two lists of (node, root, outer, total,
    shingles, weights) with different roots; of two outer ones, which meet twice, once."""
    members = sorted(members, key=lambda m: m[3])
    totals, ends = np.array([m[3] for m in members]), np.cumsum([len(m[4]) for m in members])
    starts = np.append(0, ends[:-1])
    known, place = np.unique(np.concatenate([m[4] for m in members]), return_inverse=True)
    weights = np.concatenate([m[5] for m in members]).astype(np.float64)
    own, out = np.zeros(len(known)), []
    for node, root, _, total, shingles, w in asking:
        # a similar pair's totals differ by the factor SIMILARITY at most
        lo, hi = np.searchsorted(totals, total * (SIMILARITY - 1e-5)), np.searchsorted(totals, total / (SIMILARITY - 1e-5), "right")
        if lo == hi:
            continue
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        hit = known[at] == shingles
        own[at[hit]] = w[hit]
        shared = np.minimum(own[place[starts[lo]:ends[hi - 1]]], weights[starts[lo]:ends[hi - 1]])
        both = np.add.reduceat(shared, starts[lo:hi] - starts[lo])
        own[at[hit]] = 0
        s = both / np.maximum(total + totals[lo:hi] - both, 1e-12)
        for k in np.flatnonzero(s >= SIMILARITY - 1e-6):
            other, other_root, outer = members[lo + k][:3]
            if other_root != root and (not outer or node < other):
                out.append((node, other, float(s[k])))
    return out


def undecided(held: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, node, total, root) of the buckets that hold more than one class, with the
    largest class ``top``, and the number and weight of all members and of the ``others`` outside
    it. Of buckets of the same members there is one."""
    rows = held.join(roots, "node", "left").select("node", "total", F.coalesce("root", "node").alias("root"), F.explode("bands").alias("band"))
    sizes = rows.groupBy("band", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("w"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sign")).groupBy("band").agg(
        F.max(F.struct("n", "root", "w")).alias("x"), F.sum("n").alias("size"), F.sum("w").alias("weight"), F.sum("sign").alias("sign"))
    mixed = sizes.where("size > x.n").groupBy("sign", "size", F.col("x.root").alias("top")).agg(
        F.min(F.struct("band", "weight", F.expr("size - x.n").alias("others"), F.expr("weight - x.w").alias("other_weight"))).alias("y"))
    mixed = mixed.select("size", "top", "y.*")
    return rows.join(mixed, "band").select("band", "node", "total", "root", "top", "size", "weight", "others", "other_weight")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text digest ``node``, ``root``) of the texts with links, and the links."""
    bits = bucket_bits(docs)
    parts = materialize(chunk_parts(docs, bits), "neardup-chunks")
    n = int(parts.agg(F.sum("n_docs")).first()[0] or 0)
    texts = sample_texts(parts, frequent(parts), n, bits)
    # a text may stand in several chunks: all have the same features
    texts = materialize(texts.groupBy("node").agg(*[F.first(c).alias(c) for c in ("total", "shingles", "weights", "bands")]), "neardup-texts")
    links = materialize(links_of(texts), "neardup-links")
    return components(links), links


def with_node(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__node``, the digest of the text."""
    def run(x):
        import pandas as pd

        return pd.Series([digest(t) for t in x], dtype=object)

    return docs.withColumn("__node", F.pandas_udf(run, "binary")(F.col("text").cast("string")))


def find_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): class_id, the smallest doc_id of its
    class; class_size, its documents; n_links, verified links of its text to others."""
    roots, links = classes(docs)
    rows = materialize(with_node(docs_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))).select(
        "doc_id", F.col("__node").alias("node")), "neardup-docs")
    return label(rows, roots, links)


def label(rows: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(
        F.count(F.lit(1)).alias("n_links"))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = nodes.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    named = nodes.join(groups, "root").join(degree, "node", "left").select("node", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.join(named, "node").select("doc_id", "class_id", "class_size", "n_links")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, all columns unchanged: the one with the smallest
    doc_id (of equal rows any one)."""
    roots, _ = classes(docs)
    keyed = with_node(docs)
    rows = materialize(keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("__node").alias("node"),
                                    F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "neardup-docs")
    nodes = rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best"))
    best = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).groupBy("root").agg(
        F.min(F.struct("best", "node")).alias("x")).select(F.col("x.node").alias("__node"), F.col("x.best.row").alias("__row"))
    kept = keyed.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).join(best, ["__node", "__row"])
    return kept.dropDuplicates(["__node", "__row"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return find_classes(table(spark, sf_dir, "documents"))
