"""Personal data: fixed span patterns plus information-theoretic sanitisation.

The protected entities are the values that the span patterns find (an address, a
number), and credentials: unbroken runs of at least ``SECRET_LENGTH`` letters and digits, mixed,
whose characters carry ``SECRET_BITS`` of information each or more (no word or number does).
The corpus tells how strongly other terms give an entity away: over all
documents, ``df(t)`` is the number of documents with term t, ``df(e)`` the number with
entity e, and ``df(t, e)`` the number in which t stands within ``WINDOW`` words of e.
Pointwise mutual information ``log2(df(t, e) * N / (df(t) * df(e)))`` divided by the
entity's information content ``log2(N / df(e))`` is the disclosure: 1 if the term
always comes with the entity, 0 if they are independent. A term is masked near the
entity if disclosure reaches ``GENERALISE`` and at least ``SUPPORT`` different contexts
show the pair (copies of one passage are one context); from ``REMOVE`` on it is removed.

Work: one scan finds spans and contexts per document; pairs are counted by Spark after
a partial aggregation; only the candidates' terms are counted over the corpus in a
second scan, behind a bitmap of fixed size (false hits drop out in the join). No
group of documents, contexts or terms is ever gathered in one task or on the driver.

Defined results: a null or empty text has no spans (digest of the empty string); equal
rows get equal results; a null ``doc_id`` is kept; extra columns are ignored by
``find_spans`` and kept by ``sanitise``. All steps are linear in the text's length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, map_rows, materialize, mix64, table, trimmed

# The given kinds, in order, and their patterns. The patterns written
# below give the same matches: an email's local part is the whole run before the @, and
# a look-behind only keeps a match from being tried inside a run of digits again.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

#: Parameters of credentials: least length, digits and letters, and bits per character.
SECRET_LENGTH, SECRET_DIGITS, SECRET_LETTERS, SECRET_BITS = 20, 4, 4, 3.0
SECRET = re.compile(r"[A-Za-z0-9+/_=]{%d,}" % SECRET_LENGTH)

#: Parameters: words on either side of an entity, least number of different contexts,
#: disclosure from which a term is generalised, and from which it is removed.
WINDOW, SUPPORT, GENERALISE, REMOVE = 8, 2, 0.75, 0.95
#: Characters on either side of an entity in which its words are looked for.
REACH = 400
#: Letters of the shortest term; slots of the bitmap of candidate terms.
SHORTEST, SLOTS = 3, 1 << 20
TERM = re.compile(r"[^\W\d_]{%d,}" % SHORTEST)
MASK = {"secret": "[SECRET]", "email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "cut": ""}

FOUND = ("doc_id long, key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base array<string>, secrets array<string>, near array<struct<entity:string,term:string,start:int,end:int,context:long>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = last + len(text[last:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        last = m.end() if m else at + 1
        if m:
            out.append((start, last))
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [x.lstrip("0") or "0" for x in m[0].split(".")]
            if all(len(x) <= 3 and int(x) <= 255 for x in parts):
                out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def secret_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Credentials outside the base spans."""
    inside, out = sorted((a, b) for _, a, b in base), []
    for m in SECRET.finditer(text):
        run = m[0]
        digits = sum(map(run.count, "0123456789"))
        letters = len(run) - digits - sum(map(run.count, "+/_="))
        if digits < SECRET_DIGITS or letters < SECRET_LETTERS or any(x < m.end() and m.start() < y for x, y in near_spans(inside, *m.span())):
            continue
        if -sum(k / len(run) * math.log2(k / len(run)) for k in Counter(run).values()) >= SECRET_BITS:
            out.append(("secret", m.start(), m.end()))
    return out


def contexts(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The terms within WINDOW words and REACH characters of each span, outside all
    spans; ``context`` is a hash of the terms around the span."""
    import xxhash

    inside = sorted((a, b) for _, a, b in spans)
    out = []
    for kind, a, b in spans:
        value = text[a:b].lower() if kind in ("email", "secret") else "".join(c for c in text[a:b] if c in "0123456789.")
        lo, hi = max(0, a - REACH), min(len(text), b + REACH)
        before = [m for m in TERM.finditer(text, lo, a) if m.start() > lo or lo == 0]
        after = [m for m in TERM.finditer(text, b, hi) if m.end() < hi or hi == len(text)]
        found = before[-WINDOW:] + after[:WINDOW]
        found = [m for m in found if not any(x < m.end() and m.start() < y for x, y in near_spans(inside, m.start(), m.end()))]
        context = xxhash.xxh3_64_intdigest("\n".join(m[0].lower() for m in found).encode()) - (1 << 63)
        out += [{"entity": f"{kind}:{value}", "term": m[0].lower(), "start": m.start(), "end": m.end(), "context": context}
                for m in found]
    return out


def near_spans(inside: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    from bisect import bisect_left

    i = bisect_left(inside, (start, start))
    return inside[max(0, i - 4):i + 4]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_base(docs: DataFrame) -> DataFrame:
    """Base spans, counts and contexts of each row; ``key`` tells texts apart."""

    def make():
        def scan(cols):
            out = [[] for _ in range(10)]
            for doc_id, key, text in zip(*cols, strict=True):
                spans = base_spans(text or "")
                kinds = [s[0] for s in spans]
                secrets = secret_spans(text, spans) if text and DIGIT.search(text) else []
                row = (doc_id, key, *(kinds.count(k) for k in KINDS),
                       hashlib.sha256(joined(spans).encode()).hexdigest(), [joined([s]) for s in spans],
                       [joined([s]) for s in secrets], contexts(text, spans + secrets) if spans or secrets else [])
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            return out

        return scan

    rows = docs_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, FOUND, make)


def row_key():
    """Equal (doc_id, text) rows share a key: their spans are equal, too."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def slots_of(terms: list[str]) -> np.ndarray:
    import xxhash

    h = np.fromiter((xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in terms), np.uint64, len(terms))
    return (mix64(h) % np.uint64(SLOTS)).astype(np.int64)


def term_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(term, df): documents that hold each candidate term. A bitmap of SLOTS bits
    goes to the tasks, whatever the number of candidates; hits outside the candidates
    drop out in the join."""
    marked = candidates.select("term").mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"slot": pa.array(np.unique(slots_of(b.column(0).to_pylist())), pa.int64())})
                         for b in batches), "slot long").distinct()
    bitmap = np.zeros(SLOTS, bool)
    bitmap[[r.slot for r in marked.collect()]] = True  # at most SLOTS numbers
    packed = np.packbits(bitmap)
    if not bitmap.any():
        return candidates.select("term", F.lit(0).cast("long").alias("df")).limit(0)

    def count(batches):
        import xxhash

        bits = np.unpackbits(packed).astype(bool)
        known: dict[str, bool] = {}
        counts: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "df": pa.array(list(counts.values()), pa.int64())})

        for b in batches:
            for text in b.column(0).to_pylist():
                for t in set(TERM.findall(text.lower() if text else "")):
                    hit = known.get(t)
                    if hit is None:
                        if len(known) > 300_000:
                            known.clear()
                        h = mix64(np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))], np.uint64))[0]
                        hit = known[t] = bool(bits[int(h) % SLOTS])
                    if hit:
                        counts[t] = counts.get(t, 0) + 1
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        yield out()

    seen = docs_of(docs, "text").select(F.col("text").cast("string")).mapInArrow(trimmed(count), "term string, df long")
    return seen.groupBy("term").agg(F.sum("df").alias("df")).join(candidates.select("term").distinct(), "term")


def disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the pairs to mask."""
    n = found.count()
    near = found.where(F.size("near") > 0).select("key", F.explode("near").alias("x")).select("key", "x.*")
    entity = near.groupBy("entity").agg(F.countDistinct("key").alias("df_e"))
    pairs = near.groupBy("entity", "term").agg(F.countDistinct("context").alias("contexts"), F.countDistinct("key").alias("df_te"))
    pairs = materialize(pairs.where(F.col("contexts") >= SUPPORT), "pii-pairs")
    counts = term_counts(docs, pairs)
    scored = pairs.join(counts, "term").join(entity, "entity")
    content = F.log2(F.lit(float(max(n, 1))) / F.col("df_e"))
    mutual = F.log2(F.col("df_te") * F.lit(float(max(n, 1))) / (F.col("df") * F.col("df_e")))
    ratio = F.when(content > 0, mutual / content).otherwise(F.lit(0.0))
    return scored.select("entity", "term", ratio.alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts (``n_found``: of all spans), digest of
    the base spans, all spans as text, and ``key`` (equal rows share one)."""
    found = materialize(find_base(docs), "pii-found")
    flagged = disclosing(found, docs)
    near = found.where(F.size("near") > 0).select("key", F.explode("near").alias("x")).select("key", "x.*")
    more = near.join(flagged, ["entity", "term"]).groupBy("key", "start", "end").agg(F.max("disclosure").alias("d"))
    kind = F.when(F.col("d") >= REMOVE, F.lit("cut")).otherwise(F.lit("term"))
    more = more.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(kind.alias("kind"), "start", "end"))).alias("more"))
    order = F.transform("more", lambda x: F.struct(F.when(x["kind"] == "term", 0).otherwise(1).alias("o"), x["start"].alias("s"),
                                                   F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")).alias("t")))
    more = more.select("key", F.transform(F.array_sort(order), lambda x: x["t"]).alias("more"))
    rows = found.select("doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "secrets")
    n_terms, n_secret = F.coalesce(F.size("more"), F.lit(0)).cast("long"), F.size("secrets").cast("long")
    return rows.join(more, "key", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.array_join(F.concat("base", "secrets", F.coalesce("more", F.array().cast("array<string>"))), ",").alias("spans"),
        n_terms.alias("n_terms"), n_secret.alias("n_secret"),
        (F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + n_secret + n_terms).alias("n_found"), "key")


def mask(text: str | None, spans: str | None) -> str | None:
    """The text with every span replaced by its kind's mask; overlapping spans are one."""
    if not text or not spans:
        return text
    cuts = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in spans.split(",")))
    out, at = [], 0
    for a, b, k in cuts:
        if a >= at:
            out += [text[at:a], MASK[k]]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` (if there is
    one) renewed; rows without personal data stay as they are."""
    spans = find_spans(docs).where(F.col("spans") != "").groupBy("key").agg(F.max("spans").alias("__spans"))
    masked = F.pandas_udf(_mask_series, "string")
    keyed = docs.withColumn("__key", row_key())
    both = keyed.join(spans.withColumnRenamed("key", "__key"), "__key", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col("__spans")))
    out = both.withColumn("text", text).drop("__key", "__spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _mask_series(text, spans):
    import pandas as pd

    return pd.Series([mask(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return find_spans(table(spark, sf_dir, "documents")).drop("key")
