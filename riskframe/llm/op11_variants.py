"""Spelling variant grouping by Bloom-guided neighbourhoods.

The vocabulary (words, with their counts) is one Spark aggregation. Words one edit apart
are found without comparing words with each other: each word generates its edits, each
edit is probed against blocked Bloom filters of the vocabulary, sharded by word length
and broadcast, and only the positives are shuffled to an exact join with the vocabulary,
where the false positives fall out.

* Edits are hashed, not built: a word's hash is a polynomial of its code points, so the
  hash after a deletion or replacement follows from prefix and suffix sums. One of two
  near words is enough to find the pair, so a word generates its deletions (the longer
  word finds the shorter one; insertions are not needed) and the replacements by a
  larger code point of the vocabulary's alphabet.
* A filter shard holds the words of one length (and, beyond ``SHARD_WORDS`` of them, of one
  slice of the hashes). Shards are broadcast in passes of at most ``PASS_BYTES``: a larger
  vocabulary takes more passes, not more memory.
* A positive is a row of numbers (edit's hash, word's hash, place, code point); texts are
  joined back for the survivors only, and an edit must equal the word found letter by letter.
* Forms have at least five times the count of their word, so a chain of forms has at most
  log5 of the largest count as steps; roots take the logarithm of that as rounds of joins.

Defined results: a null or empty text has no runs; a null ``doc_id`` hashes as an empty
string; equal rows count each time; words of any length take part (long ones are probed in
slices); ties of the largest count go to the smallest word in code-point order; no
documents, or no word often enough, give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, free_worker, materialize, mix64, slices, table

# Fixed values of the contract.
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
DROP_MODULUS = 199

#: Distinct words that a counting task holds before it hands its counts on.
HELD_WORDS = 300_000
#: Words of a filter shard, bits per word, and bytes of the filters of one pass.
SHARD_WORDS = 1_000_000
BITS_PER_WORD = 16
PASS_BYTES = 64_000_000
#: Lengths from here on share their shards.
LONG = 64
#: Edits hashed at a time.
CHUNK_EDITS = 1_000_000

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_LETTERS)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


# ------------------------------------------------------------------ vocabulary
def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of runs of letters with the contract's deletions, of at least
    MIN_LETTERS code points. A frequent word is summed in its task before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        held: Counter = Counter()
        for b in slices(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text:
                    add_runs(held, key, text)
                if len(held) >= HELD_WORDS:
                    yield counted(held)
                    held = Counter()
        if held:
            yield counted(held)

    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    parts = rows.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def add_runs(held: Counter, key: str | None, text: str) -> None:
    """The text's words of at least MIN_LETTERS code points, as bytes of Latin-1 (one per
    code point; characters outside it are in no run)."""
    runs = Counter(_RUN.findall(text.encode("latin-1", "replace").translate(_LOWER)))
    start = zlib.crc32(f"{key or ''}:".encode())
    for run, k in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DROP_MODULUS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LETTERS:
                continue
        held[run] += k


def counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held]),
                                       pa.array(list(held.values()), pa.int64())], names=["word", "n"])


# ------------------------------------------------------------------ hashes of words and edits
def code_points(words: list[str], length: int) -> np.ndarray:
    """Matrix (words, length) of the code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hash(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) * powers(points.shape[1])).sum(axis=1, dtype=np.uint64)


def shard_of(length: np.ndarray | int):
    return np.minimum(length, LONG)


def with_hash(words: DataFrame) -> DataFrame:
    """(word, n, length, shard, hash) of (word, n)."""
    schema = "word string, n long, length int, shard int, hash long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = np.array(b.column(0).to_pylist(), object)
            length = np.fromiter(map(len, texts), np.int32, len(texts))
            hashes = np.zeros(len(texts), np.uint64)
            for size in np.unique(length):
                own = length == size
                hashes[own] = word_hash(code_points(list(texts[own]), int(size)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(length), pa.array(shard_of(length).astype(np.int32)),
                 pa.array(hashes.view(np.int64))], names=["word", "n", "length", "shard", "hash"])

    return words.mapInArrow(run, schema)


# ------------------------------------------------------------------ filters
def bits_of(hashes: np.ndarray, length: np.ndarray | int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block (a 64-bit word of the filter) and mask of four bits of each hash."""
    x = mix64(hashes + np.uint64(1) * np.asarray(length, np.uint64))
    y = mix64(x ^ np.uint64(0xD6E8FEB86659FD93))
    mask = np.zeros(len(x), np.uint64)
    for i in range(4):
        mask |= np.uint64(1) << ((y >> np.uint64(6 * i)) & np.uint64(63))
    return (x % np.uint64(blocks)).astype(np.int64), mask


def slice_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return (mix64(hashes ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(n)).astype(np.int32)


def blocks_for(words: int) -> int:
    return max(1024, words * BITS_PER_WORD // 64)


def build_filters(vocabulary: DataFrame, slices_of: dict[int, int], blocks: dict[int, int]) -> DataFrame:
    """(shard, slice, filter) of (shard, length, hash): one group is one shard's slice, of
    about SHARD_WORDS words at most."""
    schema = "shard int, slice int, filter binary"
    with_slice = "shard int, slice int, length int, hash long"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = np.asarray(b.column(0))
            hashes = np.asarray(b.column(2)).view(np.uint64)
            part = np.zeros(len(shard), np.int32)
            for s in np.unique(shard):
                own = shard == s
                part[own] = slice_of(hashes[own], slices_of[int(s)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(part), b.column(1), b.column(2)],
                                             names=["shard", "slice", "length", "hash"])

    def build(key: tuple, group: pa.Table) -> pa.Table:
        shard, part = (k.as_py() for k in key)
        bits = np.zeros(blocks[shard], np.uint64)
        block, mask = bits_of(group.column("hash").to_numpy().view(np.uint64), group.column("length").to_numpy(), len(bits))
        np.bitwise_or.at(bits, block, mask)
        return pa.table([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([bits.tobytes()])],
                        names=["shard", "slice", "filter"])

    rows = vocabulary.select("shard", "length", "hash").mapInArrow(deal, with_slice)
    return rows.groupBy("shard", "slice").applyInArrow(build, schema)


# ------------------------------------------------------------------ probing
EDIT = "edit long, length int, own long, place int, put int"


def edits(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks (word's row, place, code point put there or 0 for a deletion, hash, length) of
    the deletions, and of the replacements by larger code points, of words of one length. In
    a run of equal letters only the first is deleted: the others give the same word."""
    m, size = points.shape
    p = powers(size + 1)
    terms = points.astype(np.uint64) * p[:size]
    whole = terms.sum(axis=1, dtype=np.uint64)
    step = max(1, CHUNK_EDITS // max(1, m))
    for lo in range(0, size, step):  # places, in slices: a word of any length
        hi = min(size, lo + step)
        before = terms[:, :lo].sum(axis=1, dtype=np.uint64)[:, None] + np.cumsum(terms[:, lo:hi], axis=1, dtype=np.uint64)
        after = whole[:, None] - before
        left = before - terms[:, lo:hi] + after * np.uint64(_INVERSE)
        fresh = np.ones((m, hi - lo), bool)
        prior = points[:, max(lo - 1, 0):hi - 1]
        fresh[:, (1 if lo == 0 else 0):] = points[:, max(lo, 1):hi] != prior
        row, at = np.nonzero(fresh)
        yield row, at + lo, np.zeros(len(row), np.int32), left[row, at], size - 1
        per = max(1, CHUNK_EDITS // max(1, m * (hi - lo)))
        for a in range(0, len(alphabet), per):
            letters = alphabet[a:a + per]
            larger = letters[None, None, :] > points[:, lo:hi, None]
            row, at, which = np.nonzero(larger)
            put = letters[which]
            old = points[row, at + lo]
            yield (row, at + lo, put.astype(np.int32),
                   whole[row] + (put.astype(np.uint64) - old.astype(np.uint64)) * p[at + lo], size)


def probe(vocabulary: DataFrame, filters: dict, slices_of: dict[int, int], alphabet: list[int]) -> DataFrame:
    """Edits of the vocabulary's words that the broadcast filters let through."""
    spark = vocabulary.sparkSession
    shared = spark.sparkContext.broadcast((filters, slices_of, alphabet))
    wanted = {s for s, _ in filters}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, parts, points_of = shared.value
        table_of = {k: np.frombuffer(v, np.uint64) for k, v in given.items()}
        letters = np.array(points_of, np.uint32)
        for b in batches:
            words, length = np.array(b.column(0).to_pylist(), object), np.asarray(b.column(1))
            for size in np.unique(length):
                size = int(size)
                if not {shard_of(size), shard_of(size - 1)} & wanted:
                    continue
                own = words[length == size]
                step = max(1, CHUNK_EDITS // (size * (1 + len(letters))))
                for i in range(0, len(own), step):
                    points = code_points(list(own[i:i + step]), size)
                    mine = word_hash(points)
                    for row, place, put, hashes, result in edits(points, letters):
                        shard = int(shard_of(result))
                        if shard not in wanted or result < MIN_LETTERS or not len(hashes):
                            continue
                        part = slice_of(hashes, parts[shard])
                        hit = np.zeros(len(hashes), bool)
                        for k in np.unique(part):
                            bits = table_of.get((shard, int(k)))
                            if bits is not None:
                                at = np.flatnonzero(part == k) if parts[shard] > 1 else slice(None)
                                block, mask = bits_of(hashes[at], result, len(bits))
                                hit[at] = (bits[block] & mask) == mask
                        found = np.flatnonzero(hit)
                        if len(found):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(hashes[found].view(np.int64)), pa.array(np.full(len(found), result, np.int32)),
                                 pa.array(mine[row[found]].view(np.int64)), pa.array(place[found].astype(np.int32)),
                                 pa.array(put[found])], names=["edit", "length", "own", "place", "put"])

    return vocabulary.select("word", "length").mapInArrow(run, EDIT)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n), each unordered pair of near words once, of a written
    vocabulary (word, n, length, shard, hash)."""
    sizes = {r["shard"]: r["count"] for r in vocabulary.groupBy("shard").count().collect()}  # at most LONG rows
    slices_of = {s: -(-n // SHARD_WORDS) for s, n in sizes.items()}
    blocks = {s: blocks_for(-(-n // slices_of[s])) for s, n in sizes.items()}
    letters = sorted(ord(r["c"]) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"))
                     .distinct().collect() if r["c"])  # at most the letters of the contract's class
    filters = materialize(build_filters(vocabulary, slices_of, blocks), "variant-filters")
    found = None
    for wanted in passes(slices_of, blocks):
        rows = filters.where(F.concat_ws(":", "shard", "slice").isin([f"{s}:{k}" for s, k in wanted]))
        got = {(r["shard"], r["slice"]): bytes(r["filter"]) for r in rows.collect()}  # PASS_BYTES at most
        part = materialize(probe(vocabulary, got, slices_of, letters), "variant-edits")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vocabulary.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    other = vocabulary.select(F.col("hash").alias("edit"), "length", F.col("word").alias("near"), F.col("n").alias("near_n"))
    own = vocabulary.select(F.col("hash").alias("own"), F.col("length").alias("own_length"), "word", "n")
    hit = found.join(other, ["edit", "length"])
    hit = hit.withColumn("own_length", F.col("length") + (F.col("put") == 0).cast("int")).join(own, ["own", "own_length"])
    edit = F.concat(F.substring("word", 1, F.col("place")), F.when(F.col("put") > 0, F.chr(F.col("put"))).otherwise(""),
                    F.substring("word", F.col("place") + 2, F.col("own_length")))
    return hit.where(edit == F.col("near")).select("word", "n", "near", "near_n")


def passes(slices_of: dict[int, int], blocks: dict[int, int]) -> list[list[tuple[int, int]]]:
    """Shard slices dealt to passes of at most PASS_BYTES of filters (one slice at least)."""
    out, size = [], 0
    for s in sorted(slices_of):
        for k in range(slices_of[s]):
            bytes_of = 8 * blocks[s]
            if not out or size + bytes_of > PASS_BYTES:
                out.append([])
                size = 0
            out[-1].append((s, k))
            size += bytes_of
    return out


# ------------------------------------------------------------------ forms and roots
def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per row of ``words`` (word, n; distinct words of at least MIN_LETTERS code
    points): form, root, n, n_near, form_n."""
    vocabulary = materialize(with_hash(words.select("word", F.col("n").cast("long"))), "variant-words")
    pairs = materialize(near_pairs(vocabulary), "variant-pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    form_n = -F.col("best.rank")
    is_form = form_n >= F.lit(ratio) * F.col("n")
    forms = materialize(
        vocabulary.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, form_n).alias("form_n")), "variant-forms")
    links = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    top = vocabulary.agg(F.max("n").alias("n")).first()["n"]  # one number
    steps = math.log(max(top or 1, 1) / MIN_COUNT, ratio) if top and top > MIN_COUNT else 0
    for _ in range(max(0, math.ceil(math.log2(steps + 1)))):  # each round doubles the steps followed
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = materialize(links.join(ahead, "root", "left")
                            .select("word", F.coalesce("beyond", "root").alias("root")), "variant-roots")
    return forms.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary_of(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return count_words(docs).where(F.col("n") >= min_count)


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of ``documents`` with their near words, forms and roots."""
    return group_variants(vocabulary_of(table(spark, sf_dir, "documents")))
