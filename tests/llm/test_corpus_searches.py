"""Spelling variants, ranked search and packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskframe.llm import op11_variants as variants
from riskframe.llm import op12_search as search
from riskframe.llm import op13_packing as packing

DOCS = "doc_id long, text string, source string, lang string, word string, n long, ids string, part int"


def docs(spark, rows, source=lambda i: "s"):
    return spark.createDataFrame([(i, t, source(k), "en", "x", 1, "y", 0) for k, (i, t) in enumerate(rows)], DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "colour colour harbour"), (4, "colour"), (4, "colour"), (5, "é" * 3000),
       (6, "x" * 70000 + " colours")]
LOWER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ spelling variants
def brute_variants(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    n = {w: k for w, k in found.items() if len(w) >= 6 and k >= 5}
    near = {w: set() for w in n}
    for w in n:
        for x in n:
            if abs(len(w) - len(x)) <= 1 and one_edit(w, x):
                near[w].add(x)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variant_rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def spelt(rng, n):
    """Texts of words around a few stems, some frequent, some misspelt, in any case."""
    stems = ["colourful", "harbours", "àéîöüÿ", "Müllerin", "aaaaaa", "abababab", "straÞen", "letters", "lettres"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(120):
            w = list(rng.choice(stems[:rng.choice((2, 4, 9))]))
            if rng.random() < 0.4:
                for _ in range(rng.choice((1, 1, 2, 3))):
                    k = rng.randrange(len(w))
                    kind = rng.random()
                    if kind < 0.34:
                        w[k] = rng.choice("aeÿÞ")
                    elif kind < 0.67:
                        w.insert(k, rng.choice("aeÿ"))
                    elif len(w) > 1:
                        del w[k]
            words.append("".join(w).upper() if rng.random() < 0.1 and w[0].isascii() else "".join(w))
        rows.append((i, rng.choice((" ", ", ", "Ā", "1")).join(words)))
    return rows


def test_variants_match_brute_force(spark):
    rows = ODD + spelt(random.Random(3), 60)
    rows += [(100 + i, "y" * 3000 + " " + "y" * 3001 + " " + "y" * 2999 + "z") for i in range(6)]  # long words are near, too
    rows += [(300, "lanternfish " * 130 + "lanternfisk " * 26 + "lantarnfisk " * 5)]
    got = variant_rows(variants.group_variants(variants.vocabulary_of(docs(spark, rows))))
    want = brute_variants(rows)
    assert len(want) > 100 and any(r[1] and r[1] != r[2] for r in want)  # chains of forms
    assert got == want


def test_variants_in_small_shards_and_passes(spark, monkeypatch):
    for name, value in (("SHARD_WORDS", 20), ("PASS_BYTES", 10_000), ("HELD_WORDS", 7), ("CHUNK_EDITS", 50)):
        monkeypatch.setattr(variants, name, value)
    rows = spelt(random.Random(4), 25)
    assert len(variants.passes({6: 4, 7: 3}, {6: 1024, 7: 1024})) == 7
    assert variant_rows(variants.group_variants(variants.vocabulary_of(docs(spark, rows)))) == brute_variants(rows)


def test_variants_of_nothing(spark):
    for rows in ([], ODD[:4]):
        assert variants.group_variants(variants.vocabulary_of(docs(spark, rows))).collect() == []


def test_edits_are_those_of_the_words():
    words = ["aabcca", "zzzzzz", "abcdef"]
    alphabet = np.array(sorted(map(ord, set("".join(words)))), np.uint32)
    points = variants.code_points(words, 6)
    got = Counter()
    for row, place, put, hashes, size in variants.edits(points, alphabet):
        for r, i, c, h in zip(row, place, put, hashes):
            w = words[r]
            x = w[:i] + (chr(c) if c else "") + w[i + 1:]
            assert len(x) == size and int(variants.word_hash(variants.code_points([x], size))[0]) == int(h)
            got[w, x] += 1
    assert set(got.values()) == {1}
    want = {(w, w[:i] + w[i + 1:]) for w in words for i in range(6)}
    want |= {(w, w[:i] + chr(c) + w[i + 1:]) for w in words for i in range(6) for c in alphabet if chr(c) > w[i]}
    assert set(got) == want


# ------------------------------------------------------------------ ranked search
def brute_search(rows, items, best=10):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    texts = [(i, Counter(split(t))) for i, t in rows]
    texts = [(i, c) for i, c in texts if c]
    n_docs, n_terms = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = []
    for item, terms in asked.items():
        hits = []
        for key, c in texts:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                hits.append((-score, key is None, key or 0))
        out += [(item, k + 1, None if none else key, -s) for k, (s, none, key) in enumerate(sorted(hits)[:best])]
    return sorted(out, key=repr)


ITEMS = "item_id long, text string, doc_id long, terms string"


def test_search_matches_brute_force(spark):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("Le", "la", "ÀÉ", "x1", "日本", "de") for b in "abcdefgh"]
    text = lambda n: rng.choice((" ", "_", ", ", "-")).join(words[int(rng.random() ** 3 * len(words))] for _ in range(n))
    rows = ODD + [(i, text(rng.choice((3, 40, 200)))) for i in range(10, 300)] + [(7, "la la"), (7, "la la"), (9, text(30000))]
    items = [(i, text(rng.choice((1, 8, 30)))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "colour"), (53, "nowhere"), (None, "lea dea"), (40, "lea"), (40, "leb lea")]
    ds, its = docs(spark, rows), spark.createDataFrame([(i, t, 0, "z") for i, t in items], ITEMS)
    want = brute_search(rows, items)
    for block in (100_000, 150):  # one block of items, and several
        got = search.search(ds.repartition(5), its, block_terms=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_search_of_nothing(spark):
    none, some = docs(spark, []), docs(spark, [(1, "a b")])
    items = spark.createDataFrame([(1, "a", 0, "z")], ITEMS)
    assert search.search(none, items).collect() == [] and search.search(some, items.limit(0)).collect() == []
    assert search.search(docs(spark, ODD[:3]), items).collect() == []


def test_plan_shares_sums():
    rng = random.Random(2)
    items = {i: {f"t{int(rng.random() ** 3 * 60)}".encode() for _ in range(20)} for i in range(50)}
    plan = search.Plan(items)
    values = np.array([[rng.randrange(1000) for _ in range(7)] for _ in plan.terms])
    number = {t: i for i, t in enumerate(plan.terms)}
    want = np.array([values[[number[t] for t in items[k]]].sum(axis=0) for k in plan.items])
    assert (plan.scores(values) == want).all()
    adds = len(plan.pairs) + sum(len(x) - 1 for x in plan.sums)
    assert adds < 0.7 * sum(len(x) - 1 for x in items.values())


# ------------------------------------------------------------------ packing
@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


def check_pieces(pieces, encoded, length):
    """Every id in exactly one piece, sequences gapless; their sizes."""
    left = Counter()
    by_sequence, by_doc = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault((p.doc_id, p.source, p.doc_tokens), []).append((p.start, tuple(ids)))
    for (key, source, n), parts in by_doc.items():
        parts.sort()
        copies = sum(s == 0 for s, _ in parts)  # equal rows are packed each
        assert sum(len(x) for _, x in parts) == copies * n
        left[key, source, n] += copies
        whole = [x for x in encoded if x[0] == key and x[1] == source and len(x[2]) == n]
        assert len(whole) == copies
        if copies == 1:
            assert [i for s, x in parts for i in x] == whole[0][2]
            assert [s for s, _ in parts] == list(np.cumsum([0] + [len(x) for _, x in parts[:-1]]))
    assert sum(left.values()) == len(encoded)
    sizes = []
    for k in sorted(by_sequence):
        at = 0
        for o, n in sorted(by_sequence[k]):
            assert o == at
            at += n
        sizes.append(at)
    assert sorted(by_sequence) == list(range(len(sizes)))
    full = sum(len(x[2]) for x in encoded) // length
    assert sizes[:full] == [length] * full and all(s & (s - 1) == 0 for s in sizes[full:]) and sizes[full:] == sorted(set(sizes[full:]), reverse=True)
    return sizes


def test_packing_keeps_every_id(spark, tokenizer):
    rng = random.Random(1)
    rows = ODD + [(20 + i, "".join(rng.choice("abc DÉñß\n12½²,.'s日本😀​\x1c İΣσ<|endoftext|> é") for _ in range(400)))
                  for i in range(30)]
    rows += [(70 + i, " ".join(rng.choice(("Hello", "world,", "it's", "ÜBER", "naïve.")) for _ in range(rng.choice((5, 3000)))))
             for i in range(60)]
    source = lambda k: (None, "", "hot", "hot", "b", "c")[k % 6]
    encoded = [(i, source(k), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for k, (i, t) in enumerate(rows)]
    got = packing.pack(docs(spark, rows, source).repartition(4, "lang", "doc_id"), length=512, grain=16).collect()
    check_pieces(got, encoded, 512)


def test_packing_follows_targets(spark):
    rng = random.Random(8)
    rows = [(i, "word " * rng.randrange(1, 400)) for i in range(300)]
    source = lambda k: "abc"[min(2, k % 5)]
    for targets in (None, {"a": 2, "b": 1, "c": 1}):
        got = packing.pack(docs(spark, rows, source).repartition(6), targets=targets, length=1024, grain=64).collect()
        total = Counter()
        for p in got:
            total[p.source] += p.length
        goal = {s: n / sum(total.values()) for s, n in total.items()} if targets is None else {"a": 0.5, "b": 0.25, "c": 0.25}
        # until the first queue is empty, what each has been given stays near its target
        whole = int(min(total[s] / goal[s] for s in total) // 1024) - 1
        assert whole > 10
        served = Counter()
        for k in range(whole):
            for p in got:
                if p.sequence_id == k:
                    served[p.source] += p.length
            for s in total:
                assert abs(served[s] - goal[s] * 1024 * (k + 1)) <= 1024


def serve(totals, shares, grains):
    """Deficit round-robin, step by step: the queue whose deficit covers its next grain first."""
    given, order = [0] * len(totals), []
    while any(g < t for g, t in zip(given, totals)):
        k = min((q for q in range(len(totals)) if given[q] < totals[q]),
                key=lambda q: (min(given[q] + grains[q], totals[q]) / shares[q], q))
        n = min(grains[k], totals[k] - given[k])
        order.append((k, given[k], n))
        given[k] += n
    return order


def test_places_are_those_of_a_sequential_round_robin():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(1, 7)
        totals = [rng.choice((1, 5, 64, 1000, rng.randrange(1, 5000))) for _ in range(n)]
        targets = [rng.choice((1, 1, 2, 7)) for _ in range(n)] if rng.random() < 0.5 else totals
        q = packing.Queues(totals, list(map(float, targets)), 256, rng.choice((1, 16, 100)))
        at, whole = 0, sum(totals) // 256
        for k, start, size in serve(totals, q.share.tolist(), q.grain.tolist()):
            assert q.place(np.array([k]), np.array([start // int(q.grain[k])])).tolist() == [at]
            got = q.pieces(np.array([k]), np.array([start]), np.array([size]))
            for _, i, m, s, o in zip(*got):
                begin = s * 256 if s < whole else q.tail()[s - whole]
                assert begin + o == at + i and m > 0
            assert got[2].sum() == size
            at += size


def test_packing_of_small_sources_and_nothing(spark, tokenizer):
    rows = [(i, "some words here") for i in range(1500)]
    encoded = [(i, f"s{i}", [*tokenizer.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows]
    rows.append((2000, "long " * 5000))  # the others are below the least share, and wait in one queue
    encoded.append((2000, "s1500", [*tokenizer.encode(rows[-1][1], add_special_tokens=False).ids, 2]))
    check_pieces(packing.pack(docs(spark, rows, lambda k: f"s{k}").repartition(3)).collect(), encoded, 4096)
    assert packing.pack(docs(spark, [])).collect() == []
    with pytest.raises(ValueError, match="target"):
        packing.pack(docs(spark, rows[:3], lambda k: "ab"[k % 2]), targets={"a": 1})
