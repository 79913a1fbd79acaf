"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document (or abstain), once on whether
it is good prose and once on whether it is toxic; rows of ``labels`` are one labeller
more, as fallible as the others. Beside two fixed lists of English insults, a toxicity
labeller knows the words that the labelled rows show to be toxic in each language (column
``lang``, if there is one): a word's log odds of standing in a toxic row against a clean
one, less ``BOUND`` standard errors, reach ``LIFT``, in ``SUPPORT`` toxic rows at least. Two
such words vote toxic, none votes not toxic; it abstains in between and for languages
without such words. A labeller is not as good in every language (the fixed lists are
silent in all but English), so toxicity is estimated apart for each language that has
such words, and for the others together. Expectation maximisation over the counts of vote
patterns (a few thousand at most, whatever the corpus) estimates each labeller's
accuracy, abstentions included, and gives every pattern a posterior probability. The
posteriors of a bounded sample of documents (``SAMPLE`` expected per side, drawn by hash)
train a linear scorer over hashed words and votes, which scores every document.

Work: one scan for the labelled rows' words, counted by Spark, one for votes, one for the
sampled documents' features, one for the scores; only labelled texts are ever shuffled,
where ``labels`` are too many for a broadcast. Through the driver go the pattern counts, the
sample's features and the weights, all of bounded size, and the toxic words, which grow
with the vocabulary.

Defined results: a null or empty text has no words: the short-text labeller votes bad;
null or repeated ``doc_id``s in ``labels`` (averaged; ties abstain) do no harm; rows without
a label just lack that vote; equal rows get equal scores; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, docs_of, map_rows, materialize, slices, table

#: Parameters: words that insult, as two labellers.
INSULTS = ("clown", "idiot", "loser", "moron", "scum", "trash")
SLURS = ("disgusting", "pathetic", "stupid", "worthless")
#: Learned toxic words: least odds ratio, standard errors taken off, least toxic rows, words that vote.
LIFT, BOUND, SUPPORT, HITS = 5.0, 1.64, 3, 2
#: Labels that are broadcast; more are joined by shuffling the texts.
BROADCAST_ROWS = 2_000_000
#: From which ratio on a detector of one defect votes bad; it abstains below.
LIMITS = {"symbols": 0.08, "repeats": 0.2, "capitals": 0.4, "dup_lines": 0.4, "few_distinct": 0.75}
LEAST_WORDS, ENOUGH_WORDS, WORD_LENGTH = 10, 30, (3.0, 9.0)
#: Expected sampled documents per side and target; hash size; passes; rate; ridge.
SAMPLE, HASH_BITS, EPOCHS, RATE, RIDGE = 5000, 18, 6, 0.3, 1e-4
ROUNDS = 60

QUALITY = ("short", *LIMITS, "word_length", "labelled")
TOXIC = ("insults", "slurs", "learned", "labelled")
ABSTAIN, NO, YES = 0, 1, 2
INSULT, SLUR = (re.compile(rf"\b(?:{'|'.join(x)})\b", re.I) for x in (INSULTS, SLURS))

LETTERS = re.compile(r"[^\W\d_]+")


def ratios(text: str) -> dict[str, float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, chars = max(1, len(words)), max(1, sum(map(len, words)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return {
        "words": len(words),
        "symbols": (len(raw) - len(raw.translate(None, b"#*$%&|<>"))) / chars,
        "repeats": sum(map(eq, words, words[1:])) / n,
        "capitals": (len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / chars,
        "dup_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "few_distinct": 1 - len(set(words)) / n if len(words) < 200 else 0.0,
        "word_length": sum(map(len, words)) / n,
    }


def votes(text: str | None) -> tuple[list[int], list[int]]:
    """Votes of the heuristics on good quality and on toxicity."""
    text = text or ""
    r = ratios(text)
    q = [NO if r["words"] < LEAST_WORDS else YES if r["words"] >= ENOUGH_WORDS else ABSTAIN]
    q += [NO if r[k] >= bad else ABSTAIN for k, bad in LIMITS.items()]
    q.append(ABSTAIN if WORD_LENGTH[0] <= r["word_length"] <= WORD_LENGTH[1] else NO)
    low = text.lower()
    t = [YES if any(w in low for w in ws) and p.search(text) else ABSTAIN for ws, p in ((INSULTS, INSULT), (SLURS, SLUR))]
    return q, t


def code(v: list[int]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


def decode(c: int, n: int) -> list[int]:
    return [c // 3**i % 3 for i in range(n)]


def row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def with_language(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang, which is empty where it is missing."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs_of(docs, "doc_id", "text", *(["lang"] if "lang" in docs.columns else [])).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))


def toxic_words(docs: DataFrame, known: DataFrame) -> dict[str, frozenset]:
    """Per language the words of LETTERS that the labelled rows show to be toxic."""
    def count(batches):
        counts: dict[tuple[str, str], list[int]] = {}

        def out():
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in counts], pa.string()), "word": pa.array([k[1] for k in counts], pa.string()),
                "a": pa.array([v[1] for v in counts.values()], pa.int64()), "b": pa.array([v[0] for v in counts.values()], pa.int64())})

        for batch in slices(batches):
            for lang, toxic, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for word in {"", *LETTERS.findall((text or "").lower())}:  # "" counts the rows
                    counts.setdefault((lang, word), [0, 0])[toxic] += 1
                if len(counts) > 200_000:
                    yield out()
                    counts.clear()
        yield out()

    sides = materialize(known.where("l_toxic <> 0.5").select("doc_id", (F.col("l_toxic") > 0.5).cast("int").alias("toxic")), "weak-sides")
    rows = with_language(docs).join(F.broadcast(sides) if sides.count() <= BROADCAST_ROWS else sides, "doc_id").select("lang", "toxic", "text")
    # a, b: toxic and clean rows with the word; n, m: all toxic and clean rows
    each = rows.mapInArrow(count, "lang string, word string, a long, b long").groupBy("lang", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    each = materialize(each.where((F.col("a") >= SUPPORT) | (F.col("word") == "")), "weak-words")
    whole = each.where("word = ''").select("lang", F.col("a").alias("n"), F.col("b").alias("m"))
    each = each.where("word <> ''").join(whole, "lang")
    cells = [F.expr(x) + 0.5 for x in ("a", "n - a", "b", "m - b")]
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    error = F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))
    found: dict[str, set] = {}
    for r in each.where(odds - BOUND * error >= math.log(LIFT)).select("lang", "word").collect():  # a small part of the vocabulary
        found.setdefault(r.lang, set()).add(r.word)
    return {k: frozenset(v) for k, v in found.items()}


def learned_vote(text: str | None, words: frozenset | None) -> int:
    have = set(LETTERS.findall((text or "").lower())) if words else None
    if not have:
        return ABSTAIN
    hits = len(have & words)
    return YES if hits >= HITS else ABSTAIN if hits else NO


def vote_rows(docs: DataFrame, learned: dict[str, frozenset] | None = None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(learned or {})

    def make():
        known = sent.value
        # above the votes, a code says which estimate it belongs to
        group = {x: 3 ** len(TOXIC) * (i + 1) for i, x in enumerate(sorted(known))}

        def run(cols):
            both = [votes(t) for t in cols[2]]
            last = [learned_vote(t, known.get(x)) for t, x in zip(cols[2], cols[3], strict=True)]
            return [cols[0], cols[1], [code(q) for q, _ in both], [
                code([*t, v]) + group.get(x, 0) for (_, t), v, x in zip(both, last, cols[3], strict=True)]]

        return run

    rows = with_language(docs).select("doc_id", row_key(), "text", "lang")
    return map_rows(rows, "doc_id long, key long, quality long, toxic long", make)


def estimate(patterns: list[tuple[int, int]], n: int, prior: float = 0.5, no_weight: float = 1.0) -> dict[int, float]:
    """Posterior of the positive class per pattern: EM for labellers that are
    independent given the class, each with its own distribution of votes. It starts at
    the share of positive votes; ``no_weight`` says how much a negative one counts
    there (more than 1 where labellers are detectors of single defects)."""
    if not patterns:
        return {}
    v = np.array([decode(c, n) for c, _ in patterns])
    weight = np.array([k for _, k in patterns], float)
    yes, no = (v == YES).sum(1), no_weight * (v == NO).sum(1)
    post = np.clip((yes + prior) / (yes + no + 1.0), 0.02, 0.98)
    onehot = np.stack([v == x for x in range(3)])
    for _ in range(ROUNDS):
        chance = (weight * post).sum() / weight.sum()
        log_odds = np.full(len(v), math.log((chance + 1e-9) / (1 - chance + 1e-9)))
        for j in range(n):
            p = np.array([(weight * post * onehot[x][:, j]).sum() for x in range(3)]) + 1.0
            q = np.array([(weight * (1 - post) * onehot[x][:, j]).sum() for x in range(3)]) + 1.0
            log_odds += np.log(p / p.sum())[v[:, j]] - np.log(q / q.sum())[v[:, j]]
        post = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return {c: float(p) for (c, _), p in zip(patterns, post, strict=True)}


# ---------------------------------------------------------------- scorer
class Features:
    """Hashed distinct words (scaled so that their squares add up to 1) and votes."""

    def __init__(self):
        self.known = WordHashes()
        self.mask = np.uint64((1 << HASH_BITS) - 1)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = list(set((text or "").encode("utf-8", "surrogatepass").lower().split()))
        q, t = votes(text)
        flags = np.array([j * 3 + x for j, x in enumerate([*q, *t])], np.int64) + (1 << HASH_BITS)
        index = (self.known.array(words) & self.mask).astype(np.int64)
        value = np.full(len(index), 1 / math.sqrt(max(1, len(index))), np.float32)
        return np.append(index, flags), np.append(value, np.ones(len(flags), np.float32))


#: Of the votes, neither labels nor learned words (which are words) are features.
WIDTH = (1 << HASH_BITS) + 3 * (len(QUALITY) + len(TOXIC) - 3)


def train(rows: list[tuple[bytes, bytes, float, float]]) -> np.ndarray:
    """Logistic regression by AdaGrad on (indices, values, target, weight)."""
    w, seen, bias, bias_seen = np.zeros(WIDTH), np.full(WIDTH, 1e-8), 0.0, 1e-8
    data = [(np.frombuffer(i, np.int64), np.frombuffer(x, np.float32), y, k) for i, x, y, k in sorted(rows)]
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for j in order.permutation(len(data)):
            i, x, y, k = data[j]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w[i] @ x) + bias))))
            g = k * (p - y) * x + RIDGE * w[i]
            np.add.at(seen, i, g * g)
            np.add.at(w, i, -RATE * g / np.sqrt(seen[i]))
            gb = k * (p - y)
            bias_seen += gb * gb
            bias -= RATE * gb / math.sqrt(bias_seen)
    return np.append(w, bias).astype(np.float32)


def fit(docs: DataFrame, voted: DataFrame, posteriors: dict[str, dict[int, float]]) -> dict[str, np.ndarray]:
    """Weights per target from a hash sample of documents on either side."""
    spark, weights = docs.sparkSession, {}
    for name, post in posteriors.items():
        sides = voted.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()  # patterns: bounded
        count = [sum(r.n for r in sides if (post[r[name]] >= 0.5) == side) for side in (False, True)]
        rate = [min(1.0, SAMPLE / max(1, c)) for c in count]
        patterns = spark.createDataFrame([(c, p, rate[p >= 0.5]) for c, p in post.items()] or [(-1, 0.0, 0.0)], f"{name} long, target double, rate double")
        unit = F.shiftrightunsigned(F.xxhash64("key", F.lit(name)), 11).cast("double") / float(1 << 53)
        chosen = voted.select("key", name).distinct().join(F.broadcast(patterns), name).where(unit < F.col("rate")).select("key", "target", "rate")

        def make():
            f = Features()

            def run(cols):
                both = [f.of(t) for t in cols[2]]
                return [cols[0], cols[1], [i.tobytes() for i, _ in both], [x.tobytes() for _, x in both]]

            return run

        # about 2 * SAMPLE keys, whatever the corpus
        texts = docs_of(docs, "doc_id", "text").withColumn("key", row_key()).join(F.broadcast(chosen), "key").dropDuplicates(["key"])
        rows = map_rows(texts.select("target", "rate", F.col("text").cast("string")), "target double, rate double, i binary, x binary", make).collect()
        # a side drawn thinly counts more, up to a limit that keeps steps stable
        top = max([1.0, *(1 / r.rate for r in rows)])
        weights[name] = train([(r.i, r.x, r.target, max(0.2, (1 / r.rate) / top)) for r in rows])
    return weights


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): posterior probabilities of good
    quality and toxicity, the scorer's probabilities, and the verdicts."""
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.avg(F.col(c).cast("double")).alias(f"l_{c}") for c in ("quality", "toxic")])
    base = materialize(vote_rows(docs, toxic_words(docs, known)), "weak-votes")

    def vote(c):
        return F.when(F.col(c) > 0.5, YES).when(F.col(c) < 0.5, NO).otherwise(ABSTAIN)

    voted = base.join(known, "doc_id", "left").withColumns({
        "quality": F.col("quality") + vote("l_quality") * 3 ** (len(QUALITY) - 1),
        "toxic": F.col("toxic") + vote("l_toxic") * 3 ** (len(TOXIC) - 1)}).drop("l_quality", "l_toxic")
    voted = materialize(voted, "weak-patterns")
    posteriors = {}
    for name, n, prior, no_weight in (("quality", len(QUALITY), 0.5, 2.0), ("toxic", len(TOXIC), 0.02, 1.0)):
        counts = sorted((r[0], r[1]) for r in voted.groupBy(name).agg(F.count(F.lit(1))).collect())  # at most 3^n rows a group
        posteriors[name] = {}
        for group in sorted({c // 3**n for c, _ in counts}):
            posteriors[name] |= estimate([x for x in counts if x[0] // 3**n == group], n, prior, no_weight)
    weights = fit(docs, voted, posteriors)
    sent = spark.sparkContext.broadcast(weights)

    def make():
        f, w = Features(), sent.value

        def run(cols):
            out = {k: [] for k in w}
            for text in cols[1]:
                i, x = f.of(text)
                for k, v in w.items():
                    out[k].append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(v[:-1][i] @ x) + float(v[-1]))))))
            return [cols[0], out["quality"], out["toxic"]]

        return run

    scored = map_rows(docs_of(docs, "doc_id", "text").select(row_key(), F.col("text").cast("string")), "key long, good_score double, toxic_score double", make)
    scored = scored.groupBy("key").agg(F.first("good_score").alias("good_score"), F.first("toxic_score").alias("toxic_score"))
    for name in posteriors:
        rows = spark.createDataFrame(list(posteriors[name].items()) or [(-1, 0.0)], f"{name} long, p_{name} double")
        voted = voted.join(F.broadcast(rows), name)
    # the verdicts average what the votes say of a document and what its words say
    both = {"good": (F.col("p_quality") + F.col("good_score")) / 2 >= 0.5, "toxic": (F.col("p_toxic") + F.col("toxic_score")) / 2 >= 0.5}
    return voted.join(scored, "key").select(
        "doc_id", F.col("p_quality").alias("good_posterior"), F.col("p_toxic").alias("toxic_posterior"), "good_score", "toxic_score",
        *[v.alias(k) for k, v in both.items()], (both["good"] & ~both["toxic"]).alias("kept"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, with ``labels`` as one of the labellers."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
