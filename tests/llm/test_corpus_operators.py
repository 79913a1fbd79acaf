"""Near-dedup, language model, weak labels, decontamination, quality rules and the
pipeline: brute force, held-out accuracy, and odd inputs."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from riskframe.llm import op2_neardup as dup
from riskframe.llm import op4_lm as lm
from riskframe.llm import op6_quality_model as weak
from riskframe.llm import op7_decontam as dec
from riskframe.llm import op8_quality as rules

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, node string, n long, h long, rows long, word string, scale double"
VOCABULARY = [a + b + c for a in ("th", "er", "on", "an", "re") for b in ("a", "in", "or", "es") for c in ("", "t", "ly", "ing", "nd")]


def docs(spark, rows, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "n", 1, 2, 3, "w", 0.5) for i, t in rows], EXTRA)


def prose(rng, n):
    out = []
    while len(out) < n:
        k = rng.randint(5, 12)
        s = [rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(k)]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return " ".join(out[:n])


def edited(rng, text, share):
    w = text.split()
    for i in rng.sample(range(len(w)), int(share * len(w))):
        w[i] = "new" + str(rng.randint(0, 10**6))
    return " ".join(w)


ODD = [(9001, None), (9002, ""), (9003, " \n"), (None, "a b c"), (None, "a b c"), (9004, "one"), (9005, "x" * 6000 + " y z")]


# ------------------------------------------------------------------ near duplicates
def weighted_jaccard(texts):
    """Pairwise similarities by the definition, df over all documents."""
    bags = []
    for t in texts:
        w = (t or "").lower().split()
        k = min(5, len(w))
        bags.append(collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else collections.Counter())
    df = collections.Counter(s for b in bags for s in b)
    n = len(texts)
    weight = [{s: float(np.float16((1 + math.log(c)) * (1 + dup.DAMP * math.log(n / df[s]) / math.log(n)))) for s, c in b.items()} for b in bags]

    def sim(i, j):
        a, b = weight[i], weight[j]
        both = sum(min(v, b[s]) for s, v in a.items() if s in b)
        total = sum(a.values()) + sum(b.values()) - both
        return both / total if total else 1.0

    return sim


def test_near_duplicate_classes_match_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randint(20, 120))) for i in range(60)]
    for g in range(8):
        base = prose(rng, 150)
        rows += [(100 + 20 * g + j, edited(rng, base, rng.choice([0, 0, 0.005, 0.01, 0.02, 0.05]))) for j in range(8)]
    shared = prose(rng, 60)  # a passage that many clean documents share
    rows += [(500 + i, prose(rng, 100) + " " + shared) for i in range(30)]
    rows += ODD
    got = dup.find_classes(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = [t for _, t in rows]
    sim = weighted_jaccard(texts)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or ((texts[i] or "").split() and (texts[j] or "").split() and sim(i, j) >= dup.SIMILARITY):
                parent[root(i)] = root(j)
    want = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        want[root(i)].append(k)
    first = {k: min((x for x in ks if x is not None), default=None) for ks in want.values() for k in ks}
    size = {k: len(ks) for ks in want.values() for k in ks}
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(k, first[k], size[k]) for k, _ in rows}


def test_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(2)
    base = prose(rng, 300)
    rows = [(0, base)] + [(i, edited(rng, base, 0.01)) for i in range(1, 300)] + [(1000 + i, prose(rng, 50)) for i in range(100)]
    got = {r.doc_id: r for r in dup.find_classes(docs(spark, rows)).collect()}
    assert {got[i].class_id for i in range(300)} == {0} and all(got[1000 + i].class_size == 1 for i in range(100))


def test_no_link_is_lost_among_texts_that_share_a_long_passage(spark):
    """Buckets of hundreds of texts just under the threshold hide pairs above it."""
    rng = random.Random(21)
    shared = prose(rng, 400)
    own = [prose(rng, 48) for _ in range(300)]
    rows = [(i, f"{o} {shared}") for i, o in enumerate(own)]
    rows += [(1000 + i, f"{edited(rng, own[i], 0.1)} {shared}") for i in range(80)]
    sim = weighted_jaccard([t for _, t in rows])
    assert min(sim(i, 300 + i) for i in range(80)) > 0.9
    got = {r.doc_id: r.class_id for r in dup.find_classes(docs(spark, rows)).collect()}
    want = {frozenset(x) for x in _classes(len(rows), sim)}
    by_class = collections.defaultdict(set)
    for k, (i, _) in enumerate(rows):
        by_class[got[i]].add(k)
    assert all(got[i] == got[1000 + i] for i in range(80))
    assert {frozenset(x) for x in by_class.values()} == want


def _classes(n, sim):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if sim(i, j) >= dup.SIMILARITY:
                parent[root(i)] = root(j)
    out = collections.defaultdict(set)
    for i in range(n):
        out[root(i)].add(i)
    return out.values()


def crowd():
    """(node, total, shingles, weights, bands) of 41 texts with most shingles in common, two of them
    alike, in one bucket with light texts that keep the levels from parting them."""
    ids = np.arange(1, 2000, dtype=np.uint32)
    ids = ids[np.argsort(dup.mix64(ids), kind="stable")].tolist()  # in the order of postings
    shared, rest = ids[:19], iter(ids[19:])
    pair = [next(rest) for _ in range(5)]
    sets = {b"z0": [next(rest)]}
    sets |= {b"y%d" % i: [s, next(rest), next(rest)] for i, s in enumerate(shared[:6])}
    sets |= {b"m%02d" % k: shared + (pair if k in (3, 17) else [next(rest) for _ in range(5)]) + [next(rest)] for k in range(41)}
    return [(bytearray(k), float(len(x)), bytearray(np.sort(np.array(x, np.uint32)).tobytes()), bytearray(np.ones(len(x), np.float16).tobytes()), [1])
            for k, x in sets.items()]


@pytest.mark.parametrize("sizes", [{}, {"WHOLE": 0}, {"WHOLE": 0, "BLOCK": 7, "BLOCK_WEIGHT": 100}])
def test_link_in_a_bucket_that_the_levels_do_not_part(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(dup, name, value, raising=False)
    texts = spark.createDataFrame(crowd(), dup.TEXTS).localCheckpoint()
    got = {(bytes(r.a), bytes(r.b)): r.similarity for r in dup.links_of(texts).collect()}
    assert got == {(b"m17", b"m03"): pytest.approx(24 / 26)}


def test_blocks_find_the_similar_pairs_of_a_bucket(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(dup, "BLOCK", 6)
    core, rows = rng.choice(500, 60, replace=False), []
    for i in range(50):
        ids = np.unique(np.concatenate([core[rng.random(60) < rng.uniform(0.8, 1)], rng.choice(30, rng.integers(0, 12)) + 500])).astype(np.uint32)
        weights = rng.choice([1.0, 1.05, 1.7], len(ids), p=[0.6, 0.3, 0.1]).astype(np.float16)
        rows.append((b"%02d" % i, float(weights.astype(float).sum()), ids, weights))
    root = {r[0]: rows[i - i % 3][0] if i < 24 else rows[i][0] for i, r in enumerate(rows)}
    want = {frozenset((x[0], y[0])) for x in rows for y in rows if root[x[0]] != root[y[0]] and dup.compare(x[1:], y[1:])[0] >= dup.SIMILARITY}
    texts = spark.createDataFrame([(bytearray(k), t, bytearray(x.tobytes()), bytearray(w.tobytes()), [1, 2]) for k, t, x, w in rows], dup.TEXTS)
    roots = spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in root.items()], "node binary, root binary")
    bucket = dup.undecided(texts.select("node", "total", "bands"), roots).localCheckpoint()
    assert bucket.count() == 50  # two buckets of the same members are one
    got = [frozenset((bytes(r.a), bytes(r.b))) for r in dup.block_links(bucket, texts).collect()]
    assert len(want) > 50 and set(got) == want and len(got) == len(want)


def test_shingles_outside_the_leader_keep_every_similar_pair():
    """Any two texts that are similar, and not both similar to a third, lightest one, meet
    in a shingle that it lacks or weighs less."""
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(12000):
        core = rng.choice(400, 60, replace=False)
        texts = []
        for _ in range(3):
            ids = np.unique(np.concatenate([core[rng.random(60) < rng.uniform(0.8, 1)], rng.choice(30, rng.integers(0, 12)) + 400]))
            ids = ids.astype(np.uint32)
            weights = rng.choice([1.0, 1.05, 1.7], len(ids), p=[0.6, 0.3, 0.1]).astype(np.float16)
            texts.append((float(weights.astype(float).sum()), ids, weights))
        lead, x, y = sorted(texts, key=lambda t: t[0])
        if dup.compare(x, y)[0] < dup.SIMILARITY:
            continue
        seen = [dup.compare(t, lead) for t in (x, y)]
        if all(s >= dup.SIMILARITY for s, _, _ in seen):
            continue
        keys = [set(dup.outside(t, lead, s >= dup.SIMILARITY - 1e-6, both, beyond).tolist()) for t, (s, both, beyond) in zip((x, y), seen, strict=True)]
        assert keys[0] & keys[1]
        met += 1
    assert met > 100


def test_drop_near_duplicates_keeps_rows_whole(spark):
    rng = random.Random(4)
    base = prose(rng, 200)
    rows = [(5, base), (3, edited(rng, base, 0.005)), (7, base), (7, base), (8, prose(rng, 80)), *ODD]
    df = docs(spark, rows)
    out = dup.drop_near_duplicates(df)
    kept = out.collect()
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([3, 8, 9001, 9003, None, 9004, 9005], key=repr)
    assert dup.drop_near_duplicates(docs(spark, [])).count() == 0 and dup.find_classes(docs(spark, [])).count() == 0


def test_weighted_sampling_estimates_similarity():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    common = np.minimum(a[100:], b[:200]).sum()
    true = common / (a.sum() + b.sum() - common)
    hits = np.mean([np.mean(dup.samples(ids[:300] + np.uint64(k), a) == dup.samples(ids[100:] + np.uint64(k), b)) for k in range(60)])
    assert abs(hits - true) < 0.03


def test_packed_hashes():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**32, 5000).astype(np.uint32))
    t = rng.integers(1, 300, len(h))
    a, b = dup.unpack_hashes(dup.pack_hashes(h, t))
    assert (a == h).all() and (b == t).all() and len(dup.unpack_hashes(dup.pack_hashes(h[:0], t[:0]))[0]) == 0
    d = {b"k" * 16: b"text", b"m" * 16: b""}
    assert dict(dup.unpack_docs(dup.pack_docs(d))) == d


# ------------------------------------------------------------------ language model
def test_language_model(spark):
    rng = random.Random(6)
    junk = next(i for i in range(9100, 9200) if lm.fold(i) == lm.HELD)
    rows = [(i, prose(rng, rng.randint(10, 200))) for i in range(400)] + ODD + [(junk, "".join(rng.choice("qxzjkv") for _ in range(300)))]
    got = lm.score_documents(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    counts = collections.Counter()

    def tokens(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]

    held = {k: zlib.crc32((b"" if k is None else str(k).encode())) % 5 == 1 for k, _ in rows}
    for k, t in rows:
        if not held[k]:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(k), held[k], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)),
                   round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for k, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    by = {r.doc_id: r for r in got}
    unseen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.bits_per_byte for r in unseen) / len(unseen) < 2.5  # far below 8, and below junk
    assert by[junk].bits_per_byte > 4
    assert lm.score_documents(docs(spark, [])).count() == 0


def test_word_probabilities_add_up():
    """All words of up to one byte and longer ones together cannot exceed 1."""
    empty = int(lm.quantise(np.zeros(1), np.zeros(1))[0])
    tables = [np.full(1 << b, empty, np.int16) for b in lm.BITS]
    refined = np.full(lm.NODES * lm.BUCKETS, 0.5)
    words = sorted([b"", *(bytes([i]) for i in range(256) if i != 32)])
    total = (10 ** lm.word_scores(words, tables, lm.first_weights(), refined)).sum()
    assert abs(total - (1 / 256 + 255 / 256**2)) < 1e-6


def test_word_tree_equals_words():
    rng = random.Random(1)
    words = sorted({b""} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))) for _ in range(300)})
    ev, c = lm.Events(words), np.arange(1.0, len(words := words) + 1)
    full = [w + b" " for w in words]
    below = ev.mass(c)
    for e in range(0, len(ev.at), 7):
        prefix = full[ev.word[e]][:ev.place[e] + 1]
        assert below[e] == sum(x for x, w in zip(c, full, strict=True) if w.startswith(prefix))
    value = ev.byte + ev.place * 1000.0
    assert np.allclose(ev.totals(value), [sum(b + i * 1000.0 for i, b in enumerate(w)) for w in full])


def test_language_model_reads_words_in_order(spark):
    """A text whose neighbouring words the training texts have scores above the same words in
    another order."""
    rng = random.Random(12)
    free = [i for i in range(20_000, 30_000) if lm.fold(i) != lm.HELD]
    held = [i for i in range(30_000, 40_000) if lm.fold(i) == lm.HELD]
    names = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    after = {w: rng.sample(names, 3) for w in names}

    def chain(n):
        out = [rng.choice(names)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    rows, tests = [(i, " ".join(chain(80))) for i in free[:150]], [chain(60) for _ in range(20)]
    mixed_up = [rng.sample(t, len(t)) for t in tests]
    rows += list(zip(held, (" ".join(t) for t in tests))) + list(zip(held[100:], (" ".join(t) for t in mixed_up)))
    rows.append((rows[0][0] + 1_000_000, rows[0][1]))
    by = {r.doc_id: r for r in lm.score_documents(docs(spark, rows)).collect()}
    for a, b in zip(held[:20], held[100:120], strict=True):
        assert by[a].base_score == pytest.approx(by[b].base_score) and 1.3 * by[a].score > by[b].score
    assert by[rows[0][0]].score == by[rows[-1][0]].score


def test_counts_after_a_word_are_exact():
    rng = random.Random(2)
    words = sorted({b""} | {bytes(rng.choice(b"ab\x01!") for _ in range(rng.randint(1, 5))) for _ in range(80)})
    at = sorted({(rng.randrange(6), rng.randrange(len(words))) for _ in range(250)})
    before, follower = (np.array(x) for x in zip(*at))
    counts = np.array([rng.randrange(4) for _ in at], float)
    pairs = lm.Pairs(words, before, follower)
    reach, ev = pairs.passing(pairs.ev.mass(counts)), pairs.ev
    code = ["".join(f"{x:08b}" for x in words[w] + b" ") for w in follower]
    for e in range(len(ev.at)):
        j = ev.word[e]
        for t in range(9):
            prefix = code[j][:8 * ev.place[e] + t]
            assert reach[t, e] == sum(c for c, b, x in zip(counts, before, code) if b == before[j] and x.startswith(prefix))
    assert [words[follower[ev.word[e]]] for e in ev.owners()[ev.start]] == [words[min(follower[i] for i in range(len(at)) if before[i] == before[j]
            and (words[follower[i]] + b" ")[0] == (words[follower[j]] + b" ")[0])] for j in range(len(at))]


def test_probabilities_after_a_word_add_up():
    """Each byte alone after one word: the probabilities and those of going on add up to 1."""
    rng = np.random.default_rng(3)
    tables = [rng.integers(0, 6, 1 << b).astype(np.int16) * 256 + rng.integers(100, 156, 1 << b).astype(np.int16) for b in lm.BITS]
    words = sorted([b"", *(bytes([i]) for i in range(256) if i != 32)])
    follower = np.arange(len(words))
    weights, table = lm.first_weights(), lm.log10_table(np.tile(lm.squash(np.linspace(-8, 8, lm.BUCKETS)), lm.NODES))
    pairs = lm.Pairs(words, np.zeros(len(words), int), follower)
    sums = lm.Sums(words, follower, tables, weights)
    value = np.zeros(len(pairs.ev.byte))
    counts = rng.integers(0, 5, len(words)).astype(float)
    second = lm.first_pair_weights()
    for some, steps in sums.steps(follower[pairs.ev.word], pairs.ev.place, pairs.ev.byte, pairs.passing(pairs.ev.mass(counts))):
        for node, bit, s, cell, x in steps:
            value[some] += lm.log10_of(second[0][cell] * s + second[1][cell] * x, node, bit, table)
    assert abs((10 ** value[pairs.ev.place == 0]).sum() - 1) < 1e-5


def test_packed_pairs():
    rng = np.random.default_rng(4)
    x, big = rng.integers(0, 70_000, 500), np.array([0, 1 << 40, 5])
    for words in ([b"", b"a", b"bc"], [b""], []):
        a, w, b, c = lm.unpack(lm.pack(x, words, big, x[:0]), 1)
        assert (a == x).all() and w == words and (b == big).all() and len(c) == 0
    for limit in (70_000, 1 << 62):
        keys, at = lm.distinct(x, limit)
        assert (keys == np.unique(x)).all() and (keys[at] == x).all()
    assert [len(y) for y in lm.distinct(x[:0], 10)] == [0, 0]


# ------------------------------------------------------------------ weak labels
def test_em_recovers_accuracies():
    rng = random.Random(8)
    patterns, truth = collections.Counter(), collections.defaultdict(list)
    for _ in range(20000):
        y = rng.random() < 0.7
        votes = [weak.ABSTAIN if rng.random() < 0.2 else (weak.YES if y else weak.NO) if rng.random() < a else (weak.NO if y else weak.YES)
                 for a in (0.95, 0.85, 0.75, 0.6)]
        c = weak.code(votes)
        patterns[c] += 1
        truth[c].append(y)
    post = weak.estimate(sorted(patterns.items()), 4)
    right = sum(sum((post[c] >= 0.5) == y for y in ys) for c, ys in truth.items()) / 20000
    majority = sum(sum((sum(v == weak.YES for v in weak.decode(c, 4)) >= sum(v == weak.NO for v in weak.decode(c, 4))) == y for y in ys)
                   for c, ys in truth.items()) / 20000
    assert right > majority and right > 0.93 and weak.estimate([], 3) == {}


def test_classifier_finds_junk_and_insults(spark):
    rng = random.Random(9)
    rows, quality, toxic = [], {}, {}
    for i in range(300):
        t = prose(rng, rng.randint(40, 150))
        if i % 5 == 0:
            w = t.split()
            t = " | ".join(w) if i % 2 else " ".join(x for x in w[:12] for _ in range(6))
            quality[i] = 0
        elif i % 7 == 0:
            t = t + " You " + rng.choice(weak.INSULTS) + " and " + rng.choice(weak.SLURS) + " thing."
            toxic[i] = 1
        rows.append((i, t))
    labels = [(i, quality.get(i, 1) ^ (rng.random() < 0.05), toxic.get(i, 0) ^ (rng.random() < 0.05)) for i in range(0, 300, 3)]
    labels += [(None, 1, 0), (3, None, None), (6, 1, 0), (6, 0, 1)]
    lab = spark.createDataFrame([(i, None if q is None else int(q), None if t is None else int(t), "x") for i, q, t in labels],
                                "doc_id long, quality int, toxic int, text string")
    got = weak.classify(docs(spark, rows + ODD), lab).collect()
    assert len(got) == len(rows) + len(ODD)
    by = {r.doc_id: r for r in got}
    assert all(by[i].good == bool(quality.get(i, 1)) for i in range(300))
    assert all(by[i].toxic == bool(toxic.get(i, 0)) for i in range(300))
    assert not by[9002].good and not by[9001].kept
    empty = weak.classify(docs(spark, []), lab.limit(0))
    assert empty.count() == 0


def test_toxic_words_are_learned_per_language(spark):
    rng = random.Random(10)
    mean = {"fr": ["vaurien", "crétin", "ordure", "minable"], "de": ["trottel", "abschaum", "versager", "widerlich"]}
    rows, toxic = [], {}
    for i in range(400):
        lang = ("fr", "de", "en")[i % 3]
        toxic[i] = lang in mean and i % 8 == 0
        # the other language's word is harmless
        tail = " ".join(rng.sample(mean[lang], 3)) if toxic[i] else mean["fr"][i % 4] if lang == "de" else ""
        rows.append((i, f"{prose(rng, rng.randint(40, 120))} {tail}.", lang))
    df = spark.createDataFrame(rows + [(None, None, None), (9001, "", "fr")], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1, int(toxic[i])) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in weak.classify(df, lab).collect()}
    assert len(got) == 402
    assert all((got[i].toxic_posterior >= 0.5) == got[i].toxic == toxic[i] for i in range(200, 400))
    assert weak.classify(df.drop("lang"), lab).where("toxic").count() > 0


# ------------------------------------------------------------------ decontamination
def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(8, 60))) for i in range(40)] + [(90, "tiny item"), (91, None), (92, ""), (None, "an item without id in here")]
    rows = [(i, prose(rng, 100)) for i in range(60)]
    rows += [(100 + i, prose(rng, 30) + " " + t + " " + prose(rng, 10)) for i, (_, t) in enumerate(items[:40])]
    rows += [(200 + i, prose(rng, 30) + " " + t.upper().replace(".", " !") + " end") for i, (_, t) in enumerate(items[:10])]
    rows += [(300 + i, prose(rng, 5) + " " + " ".join(t.split()[:len(t.split()) // 2]) + " " + prose(rng, 40)) for i, (_, t) in enumerate(items[:20])]
    rows += [(400, "a Tiny, item!"), (401, "so an item without id in here is"), *ODD]
    bench = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, n long")
    got = {r.doc_id: r for r in dec.find_contaminated(docs(spark, rows), bench).collect() if r.doc_id is not None}
    for k, t in rows:
        if k is None:
            continue
        have, found = words(t), set()
        for i, item in items:
            w = words(item)
            n = min(5, len(w))
            need = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set()
            if need:
                best = max((len(need & {tuple(have[a:a + len(w)][j:j + n]) for j in range(len(w) - n + 1)}) / len(need)
                            for a in range(max(1, len(have) - len(w) + 1))), default=0)
                if best == 1.0:  # whole copies must be found, halves must not
                    found.add(i)
        assert set(got[k].item_ids) == found - {None} and got[k].contaminated == bool(found), (k, got[k], found)
    df = docs(spark, rows)
    kept = dec.drop_contaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, _ in rows if k is None or not got[k].contaminated}
    assert dec.find_contaminated(docs(spark, []), bench).count() == 0
    assert dec.find_contaminated(df, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_tolerates_a_changed_word(spark):
    rng = random.Random(13)
    item = prose(rng, 50)
    w = item.split()
    w[25] = "changed"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = dec.find_contaminated(docs(spark, [(1, "x y " + " ".join(w) + " z"), (2, prose(rng, 60))]), bench)
    assert {r.doc_id: r.contaminated for r in got.collect()} == {1: True, 2: False}


def test_decontamination_finds_edited_short_items(spark):
    rng = random.Random(14)
    opening = prose(rng, 6).split()
    items = [(i, (opening if i % 10 == 0 else []) + prose(rng, rng.randint(9, 30)).split()) for i in range(120)]
    rows = []
    for i, item in items:
        for c in (1, 2, 3):
            w = list(item)
            for j in range(c):  # at an end, in the middle, or inserted
                place = (j, len(w) - 1 - j, len(w) // 2, None)[(i + c) % 4]
                if place is None:
                    w.insert(rng.randrange(len(w)), f"more{j}")
                else:
                    w[place] = f"new{j}"
            rows.append((1000 * c + i, " ".join([prose(rng, rng.randint(0, 20)), *w, prose(rng, rng.randint(0, 20)), *(w if i % 7 == 0 else [])])))
    found = [[words(w) for w in item] for _, item in items]
    need = [[tuple(w[j:j + min(5, len(w))]) for j in range(max(1, len(w) - 4))] for w in (sum(x, []) for x in found)]
    df = collections.Counter(s for x in need for s in set(x))
    want = {}
    for k, text in rows:
        have = words(text)
        for (i, _), x in zip(items, need, strict=True):
            weight = {s: math.log1p(len(items) / df[s]) for s in x}
            size = len(x[0])
            at = [tuple(have[j:j + size]) for j in range(len(have) - size + 1)]
            best = max((sum(weight[s] for s in set(at[a:a + len(x)]) if s in weight) for a in range(max(1, len(at)))), default=0) / sum(weight.values())
            if best >= 0.8 - 1e-9:
                want[k, i] = best
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert len({k for k, _ in want}) > 150
    got = dec.find_contaminated(docs(spark, rows), bench).collect()
    assert {(r.doc_id, i) for r in got for i in r.item_ids} == set(want)
    assert all(abs(r.similarity - max([want[r.doc_id, i] for i in r.item_ids], default=0)) < 1e-9 for r in got)


def test_blocks_cover_the_radius():
    edges = dec.block_edges()
    assert len(edges) == dec.RADIUS + 1 and sum(w for _, w in edges) == 64 and edges[0][0] == 0


def test_fingerprint_is_the_majority_of_word_bits(spark):
    df = spark.createDataFrame([(["a", "b", "b", "c d"],), (["x"],), ([],)], "w array<string>")
    from pyspark.sql import functions as F
    got = dec.with_fingerprint(df, "w", "fp").withColumn("hs", F.transform("w", lambda x: F.xxhash64(x))).collect()
    for r in got:
        fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r.hs) > len(r.hs))
        assert r.fp & (2**64 - 1) == fp


# ------------------------------------------------------------------ quality rules
def brute_numbers(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = collections.defaultdict(list)
    for i in range(len(ws) - 4):
        grams[tuple(ws[i:i + 5])].append(i)
    covered = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n_dup = len(lines) - len(set(lines))
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), n_dup, len(covered), len(ws) < 10 or 100 * len(covered) > 20 * len(ws)


def test_quality_numbers_match_brute_force(spark):
    rng = random.Random(14)
    rows = [(i, "".join(rng.choice("ab \n#é😀") for _ in range(rng.randint(0, 300)))) for i in range(60)] + ODD
    rows += [(200, "a b c d e f a b c d e f g"), (201, "x " * 40), (202, "l1 w\nl1 w\n l1 w\n\n\n#\n#"), (203, "a b c d e a b c d e")]
    got = rules.judge_quality(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=repr) == \
        sorted(((k, *brute_numbers(t)) for k, t in rows), key=repr)
    assert rules.judge_quality(docs(spark, [])).count() == 0


def test_outliers_are_rejected_and_clean_texts_stay(spark):
    rng = random.Random(15)
    clean = [(i, prose(rng, rng.choice([15, 40, 100, 400, 3000]))) for i in range(200)]
    junk = [(900 + i, " ".join(w + "###|" for w in prose(rng, 100).split())) for i in range(10)]
    df = docs(spark, clean + junk).union(docs(spark, [(2000 + i, prose(rng, 50)) for i in range(3)], None, None))
    out = rules.filter_quality(df)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == df.columns and kept == {k for k, _ in clean} | {2000, 2001, 2002}
    verdict = {r.doc_id: r.kept for r in rules.judge_quality(df).collect()}
    assert {k for k, v in verdict.items() if v} == kept


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark, tmp_path):
    rng = random.Random(16)
    base, item = prose(rng, 120), prose(rng, 30)
    rows = [(i, prose(rng, rng.randint(30, 200))) for i in range(80)]
    rows += [(100, base), (101, edited(rng, base, 0.01)), (102, base), (103, prose(rng, 40) + " " + item), (104, "too short"), (105, None),
             (106, prose(rng, 50) + " write to some.one@mail.example now")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(range(80)) | {100, 106}
    import hashlib
    texts = dict(rows)
    by = {r.doc_id: r for r in got}
    assert by[5].decoded_sha256 == hashlib.sha256(texts[5].encode()).hexdigest()
    assert by[106].decoded_sha256 == hashlib.sha256(texts[106].replace("some.one@mail.example", "[EMAIL]").encode()).hexdigest()


@pytest.mark.parametrize("name", ["op1_license", "op10_url"])
def test_registered(name):
    import __spark_entry__ as entry
    assert name in entry.queries() and "pipeline" in entry.queries()


# ------------------------------------------------------------------ memory of workers
def test_steps_hand_their_memory_back_at_their_end(monkeypatch):
    from riskframe.llm import common

    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    got = common.trimmed(lambda batches: (b + 1 for b in batches))(iter([1, 2, 3]))
    assert next(got) == 2 and not calls  # not between batches
    assert list(got) == [3, 4] and calls == [1]
