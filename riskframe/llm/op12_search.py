"""Ranked lexical search of many queries at once, by shared sub-expressions.

An item's score of a document is a sum over the item's terms, and items share terms. The
items are therefore compiled, in blocks, into one query-sharing DAG:

* Mining: each item is its terms in one global order (held by most items first). In
  rounds, pairs at most ``REACH`` places apart that stand in two items or more become one new
  node, the pair of the most items first, until no such pair is shared. A node stands for the set of terms below
  it; sets that several items share are nodes of several items.
* Accumulators: documents are reduced once to their postings of the block's terms (term
  numbers and counts, written as a table). A task fills a matrix (term or node, document)
  with the terms' parts of the score and adds up every node's two children once, level by
  level; each shared set's partial document accumulator is thus worked out once.
* Combination: an item adds the few nodes that are left of it, and a task hands on no more
  than the ten best documents of each item.

N and L are sums over all documents, document frequencies a grouped count of the postings.
A block holds about ``BLOCK_TERMS`` terms of items, whatever the number of items, so what is
broadcast is bounded; another block is another pass over the documents.

Defined results: a null or empty text has no terms and is no document of the statistics; a
null ``doc_id`` is kept and comes last among equal scores; equal rows of documents are documents
of their own; rows of ``benchmark`` with one ``item_id`` (null, too) are one item of all their
terms; an item without a hit has no row; equal scores rank by doc_id; a text of any length is
one row of postings; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import docs_of, free_worker, materialize, slices, table

# Fixed values of the contract: the weight's scale, and the parts of a posting's score.
SCALE, TOP, TF, NORM, BASE, SLOPE = 1000, 1_000_000_000, 1000, 8, 10, 90

BEST = 10
#: Terms of the items of a block (with repeats over items), about.
BLOCK_TERMS = 100_000
#: Places of an item's order within which pairs are looked for.
REACH = 16
#: Numbers in a task's accumulator matrix.
CELLS = 4_000_000

# ASCII letters and digits, and every byte of the characters from U+0080 on.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


# ------------------------------------------------------------------ the DAG
class Plan:
    """Items of a block as sums over a DAG. Nodes below ``len(terms)`` are terms; node
    ``len(terms) + i`` is the sum of the two nodes ``pairs[i]``."""

    def __init__(self, items: dict):
        self.items = sorted(items, key=lambda x: (x is not None, x or 0))
        held = Counter(t for ts in items.values() for t in set(ts))
        self.terms = [t for t, _ in sorted(held.items(), key=lambda x: (-x[1], x[0]))]
        number = {t: i for i, t in enumerate(self.terms)}
        sums = [sorted(number[t] for t in set(items[k])) for k in self.items]
        self.pairs: list[tuple[int, int]] = []
        self.levels: list[tuple[int, int]] = []  # nodes of each round; their children are of earlier ones
        while True:
            at = len(self.pairs)
            sums = self.share(sums)
            if len(self.pairs) == at:
                break
            self.levels.append((at, len(self.pairs)))
        self.sums = [np.array(x, np.int64) for x in sums]
        self.left, self.right = (np.array([p[i] for p in self.pairs], np.int64) for i in (0, 1))

    def share(self, sums: list[list[int]]) -> list[list[int]]:
        """One round of mining: every pair within reach that two items share, the pair of
        the most items first, becomes a node in each item where it is still whole."""
        where = defaultdict(list)
        for k, nodes in enumerate(sums):
            for i, a in enumerate(nodes):
                for b in nodes[i + 1:i + 1 + REACH]:
                    where[a, b].append(k)
        used: dict[int, set] = defaultdict(set)
        made: dict[int, list[int]] = defaultdict(list)
        for pair, items in sorted(((p, i) for p, i in where.items() if len(i) > 1), key=lambda x: (-len(x[1]), x[0])):
            free = [k for k in items if used[k].isdisjoint(pair)]
            if len(free) > 1:
                node = len(self.terms) + len(self.pairs)
                self.pairs.append(pair)
                for k in free:
                    used[k].update(pair)
                    made[k].append(node)
        # new nodes stand first, those of the most items before the others, as their terms did
        return [made[k] + [n for n in nodes if n not in used[k]] if k in made else nodes
                for k, nodes in enumerate(sums)]

    def scores(self, values: np.ndarray) -> np.ndarray:
        """(item, document) from the terms' values (term, document)."""
        n = len(self.terms)
        acc = np.zeros((n + len(self.pairs), values.shape[1]), np.int64)
        acc[:n] = values
        for lo, hi in self.levels:
            acc[n + lo:n + hi] = acc[self.left[lo:hi]] + acc[self.right[lo:hi]]
        return np.array([acc[x].sum(axis=0) for x in self.sums], np.int64).reshape(len(self.sums), values.shape[1])


# ------------------------------------------------------------------ documents
def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, ids, counts) of every document with a term: all its terms counted in
    ``n``; the numbers and counts of those in ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        number = {t: i for i, t in enumerate(shared.value)}
        for b in slices(batches, 500):
            keys, sizes, ids, counts = [], [], [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = terms_of(text)
                if found:
                    tf = Counter(filter(number.__contains__, found))
                    keys.append(key)
                    sizes.append(len(found))
                    ids.append([number[t] for t in tf])
                    counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "ids", "counts"])

    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, ids array<int>, counts array<long>")


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def best_documents(posted: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """(item, doc_id, score): the ``best`` documents of each item in each task, at least."""
    shared = posted.sparkSession.sparkContext.broadcast((plan, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag, w = shared.value
        top = Best(len(dag.items), best)
        rows = max(1, CELLS // max(1, len(dag.terms) + len(dag.pairs)))
        for b in slices(batches, rows):
            size, ids, counts = b.column(1), b.column(2), b.column(3)
            values = np.zeros((len(dag.terms), b.num_rows), np.int64)
            doc = np.repeat(np.arange(b.num_rows), np.diff(ids.offsets.to_numpy()))
            term, tf = ids.flatten().to_numpy(), counts.flatten().to_numpy()
            m = BASE + (SLOPE * size.to_numpy() * n_docs) // n_terms
            values[term, doc] = w[term] * ((TOP * tf) // (TF * tf + NORM * m[doc]))
            top.add(dag.scores(values), b.column(0).to_pylist())
        yield from top.rows()

    return posted.mapInArrow(run, "item int, doc_id long, score long")


class Best:
    """The best documents of each item so far: highest score, then smallest doc_id, null last."""

    def __init__(self, items: int, size: int):
        self.size = size
        self.kept: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)  # a score below it is not among the best

    def add(self, scores: np.ndarray, keys: list) -> None:
        for k in np.flatnonzero((scores.max(axis=1, initial=0) >= self.least) & (scores > 0).any(axis=1)):
            own = scores[k]
            i = np.flatnonzero((own > 0) & (own >= self.least[k]))
            if len(i) > 4 * self.size:  # ties of the last place stay
                i = i[own[i] >= np.partition(own[i], -self.size)[-self.size]]
            self.kept[k] += [(-int(own[j]), keys[j] is None, keys[j] or 0) for j in i]
            if len(self.kept[k]) > self.size:
                self.kept[k] = sorted(self.kept[k])[:self.size]
                self.least[k] = -self.kept[k][-1][0]

    def rows(self) -> Iterator[pa.RecordBatch]:
        flat = [(k, None if null else key, -score) for k, x in enumerate(self.kept) for score, null, key in x]
        if flat:
            cols = list(zip(*flat, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.int64())], names=["item", "doc_id", "score"])


# ------------------------------------------------------------------ search
def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[dict]:
    """Items (item_id -> distinct terms) in blocks of about ``block_terms`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(set(terms_of(t))) for t in b.column(1).to_pylist()], pa.list_(pa.binary()))],
                names=["item_id", "terms"])

    rows = docs_of(items, "item_id", "text").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    found = materialize(rows.mapInArrow(run, "item_id long, terms array<binary>"), "search-items")
    total = found.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0  # one number
    n = max(1, -(-total // block_terms))
    for block in range(n):
        out: dict = defaultdict(set)
        for r in found.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block).collect():  # a block of the queries
            out[r["item_id"]].update(map(bytes, r["terms"]))
        out = {k: v for k, v in out.items() if v}
        if out:
            yield out


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents (doc_id, text) of each item
    (item_id, text)."""
    spark, parts = docs.sparkSession, []
    for block in item_blocks(items, block_terms):
        plan = Plan(block)
        posted = materialize(postings(docs, plan.terms), "search-postings")
        stats = posted.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
        if not stats["n_docs"]:
            continue
        df = np.zeros(len(plan.terms), np.int64)
        for r in posted.select(F.explode("ids").alias("term")).groupBy("term").count().collect():  # a block's terms
            df[r["term"]] = r["count"]
        hits = materialize(best_documents(posted, plan, weight(stats["n_docs"], df), stats["n_docs"], stats["n_terms"], best)
                           .withColumn("part", F.spark_partition_id()), "search-hits")
        names = spark.createDataFrame([(i, k) for i, k in enumerate(plan.items)], "item int, item_id long")
        parts.append(ranked(hits, best).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ranked(hits: DataFrame, best: int) -> DataFrame:
    """The best of the tasks' best, first within groups of tasks, so that no task sees an
    item's rows of all tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    groups = max(1, int((hits.agg(F.max("part").alias("n")).first()["n"] or 0) ** 0.5))
    some = Window.partitionBy("item", F.col("part") % groups).orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    return (hits.withColumn("place", F.row_number().over(some)).where(F.col("place") <= best)
            .withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= best))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
posting AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM posting, total GROUP BY term),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS value
  FROM posting JOIN weight USING (term) JOIN size USING (doc_id), total),
scored AS (SELECT item_id, doc_id, sum(value)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
