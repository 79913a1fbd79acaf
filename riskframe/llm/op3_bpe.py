"""Byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

Each Spark task splits its documents into pre-tokens and hands every pre-token it
has not met before to a DuckDB connection inside the task. There a pre-token is a
set of token-position rows; the recursive query joins neighbouring positions with
the merge table and contracts each word's leftmost pair of the lowest rank until
no pair merges. Decoding joins ids with the vocabulary and concatenates the pieces
with an ordered aggregation. A document's result is put together from its words.

Defined results: a null or empty text has no tokens (``n_tokens`` 0, both digests
of the empty string); equal rows give equal results; a null ``doc_id`` is kept;
extra columns of the input are ignored. Texts are never cut: pre-tokens longer than
``LONG`` bytes use a form of the same step that contracts all non-overlapping
occurrences of the lowest pair at once wherever that equals the one-by-one order,
so a run of a million equal characters takes tens of steps, not a million.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Set
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEPT, docs_of, map_rows, table, trim

#: Pre-tokens above this many bytes take the set-wise contraction.
LONG = 64
#: Pre-tokens per recursive query, and bytes of them: bounds DuckDB's working set.
CHUNK_WORDS, CHUNK_BYTES = 15_000, 200_000
#: Characters of text whose words are looked up at a time.
GROUP_CHARS = 2_000_000
#: Words remembered in a worker between batches and tasks; beyond that the ones met
#: first, which hold the frequent ones, stay and the others are worked out again.
CACHE, KEEP = 300_000, 180_000
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: One contraction per word and step: the leftmost pair of the lowest rank.
ENCODE = """
WITH RECURSIVE step AS (
  SELECT w, pos, id, false AS done FROM init
  UNION ALL
  (WITH neighbours AS (
     SELECT w, pos, id, lead(id) OVER o AS nid, lead(pos) OVER o AS npos, lead(w) OVER o AS nw
     FROM step WHERE NOT done WINDOW o AS (ORDER BY w, pos)),
   pairs AS MATERIALIZED (
     SELECT w, pos, id, npos, m.merged FROM neighbours
     LEFT JOIN merges m ON m.l = id AND m.r = nid AND nw = w),
   best AS MATERIALIZED (
     SELECT w, min((merged::BIGINT << 32) + pos) AS k, arg_min(npos, (merged::BIGINT << 32) + pos) AS gone
     FROM pairs WHERE merged IS NOT NULL GROUP BY w)
   SELECT p.w, p.pos, CASE WHEN p.pos = (k & 4294967295) THEN (k >> 32)::INT ELSE id END, k IS NULL
   FROM pairs p LEFT JOIN best USING (w) WHERE k IS NULL OR p.pos <> gone)
)
SELECT w, pos, id FROM step WHERE done
"""

#: The same fixpoint for long words: every second pair of each run of adjacent
#: lowest pairs is contracted at once, unless a token that holds the merged one at
#: its edge has a lower rank (then merging could lower the minimum: leftmost only).
ENCODE_LONG = """
WITH RECURSIVE step AS (
  SELECT w, pos, id, false AS done FROM init
  UNION ALL
  (WITH neighbours AS (
     SELECT w, pos, id, row_number() OVER o AS i, lead(id) OVER o AS nid, lead(w) OVER o AS nw
     FROM step WHERE NOT done WINDOW o AS (ORDER BY w, pos)),
   pairs AS MATERIALIZED (
     SELECT w, pos, id, i, m.merged FROM neighbours
     LEFT JOIN merges m ON m.l = id AND m.r = nid AND nw = w),
   best AS MATERIALIZED (
     SELECT w, min(merged) AS low, arg_min(i, (merged::BIGINT << 32) + pos) AS head
     FROM pairs WHERE merged IS NOT NULL GROUP BY w),
   hits AS MATERIALIZED (
     SELECT w, i FROM (
       SELECT p.w, i, head, low, i - row_number() OVER (PARTITION BY p.w ORDER BY i) AS run
       FROM pairs p JOIN best USING (w) WHERE merged = low)
     WHERE CASE WHEN EXISTS (SELECT 1 FROM inverted v WHERE v.id = low) THEN i = head
                ELSE true END
     QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY i) % 2 = 1)
   SELECT p.w, p.pos, CASE WHEN h.i IS NOT NULL THEN low ELSE p.id END, low IS NULL
   FROM pairs p LEFT JOIN best b ON b.w = p.w LEFT JOIN hits h ON h.i = p.i
   LEFT JOIN hits eaten ON eaten.i = p.i - 1 AND eaten.w = p.w
   WHERE eaten.i IS NULL)
)
SELECT w, pos, id FROM step WHERE done
"""

#: Ordered aggregation: ids as text and the decoded bytes as hex. The rows are put
#: in order first, which one thread keeps; ``encode`` checks the round trip and
#: takes the slower form, ordered inside each aggregate, should it ever fail.
DECODE = """
SELECT w, string_agg(id::VARCHAR, ',') AS ids, string_agg(piece, '') AS bytes
FROM (SELECT w, pos, id, piece FROM tokens JOIN vocabulary USING (id) ORDER BY w, pos) GROUP BY w
"""
DECODE_STRICT = """
SELECT w, string_agg(id::VARCHAR, ',' ORDER BY pos) AS ids, string_agg(piece, '' ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY w
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, merged): every way to put a token together from two tokens. Plain numbers
    only: a tuple a row would leave tens of MB of holes in the worker's memory."""
    rows = array("i")
    for t, k in ranks.items():
        for i in range(1, len(t)):
            left, right = ranks.get(t[:i]), ranks.get(t[i:])
            if left is not None and right is not None:
                rows.extend((left, right, k))
    cols = np.array(rows, np.int32).reshape(-1, 3)
    return pa.table([pa.array(np.ascontiguousarray(c)) for c in cols.T], names=["l", "r", "merged"])


def inverted_tokens(ranks: dict[bytes, int]) -> pa.Table:
    """Tokens that stand at the edge of some token with a lower rank."""
    out = {ranks[z] for t, k in ranks.items() for i in range(1, len(t))
           for z in (t[:i], t[i:]) if ranks.get(z, -1) > k}
    return pa.table([pa.array(sorted(out), pa.int32())], names=["id"])


class Codec:
    """One task's DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self.con.execute("SET temp_directory = ''")
        vocabulary = pa.table([pa.array(list(self.ranks.values()), pa.int32()),
                               pa.array([t.hex() for t in self.ranks])], names=["id", "piece"])
        for name, t in (("merges", merge_table(self.ranks)), ("inverted", inverted_tokens(self.ranks)),
                        ("vocabulary", vocabulary)):
            self.con.register("given", t)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")
        del vocabulary, t
        trim()  # what the tables were made of, before the texts
        self.cache: dict[str, bytes] = {}  # ids as text
        self.odd: dict[str, bytes] = {}  # decoded bytes, where they are not the word's own
        self.exact = regex.compile(pattern)
        # The standard library's classes differ from the pattern's only for numbers
        # that are not decimal digits; texts of these ranges have none.
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.plain = re.compile(plain)
        self.other = re.compile("[^\x00-\x7f\xc0-ɏ]")

    def split(self, text: str) -> list[str]:
        return (self.exact if self.other.search(text) else self.plain).findall(text)

    def words(self, words: Set[str]) -> dict[str, bytes]:
        """The ids of each word as text."""
        if len(self.cache) + len(words) > CACHE:
            self.cache = dict(islice(self.cache.items(), KEEP))
        todo = []
        for w in words - self.cache.keys():
            todo.append((w, w.encode("utf-8", "surrogatepass")))
        todo.sort(key=lambda x: len(x[1]))
        at = 0
        while at < len(todo):
            end, size, long = at, 0, len(todo[at][1]) > LONG
            while end < len(todo) and end - at < CHUNK_WORDS and (end == at or size + len(todo[end][1]) <= CHUNK_BYTES) \
                    and (len(todo[end][1]) > LONG) == long:
                size += len(todo[end][1])
                end += 1
            self.encode(todo[at:end], long)
            at = end
        return self.cache

    def encode(self, chunk: list[tuple[str, bytes]], long: bool) -> None:
        raw = [b for _, b in chunk]
        whole = [self.ranks.get(b) for b in raw]  # a word that is a token is that token
        size = np.array([1 if k is not None else len(b) for b, k in zip(raw, whole, strict=True)], np.int64)
        data = b"".join(b if k is None else b"\0" for b, k in zip(raw, whole, strict=True))
        ids = self.byte_id[np.frombuffer(data, np.uint8)]
        starts = np.cumsum(size) - size
        for i, k in enumerate(whole):
            if k is not None:
                ids[starts[i]] = k
        init = pa.table([np.repeat(np.arange(len(raw), dtype=np.int32), size),
                         (np.arange(len(ids)) - np.repeat(starts, size)).astype(np.int32), ids], names=["w", "pos", "id"])
        self.con.register("init", init)
        tokens = self.con.sql(ENCODE_LONG if long else ENCODE).to_arrow_table()
        self.con.register("tokens", tokens)
        for query in (DECODE, DECODE_STRICT):
            out = self.con.sql(query).to_arrow_table()
            rows = list(zip(out.column("w").to_pylist(), out.column("ids").to_pylist(),
                            map(bytes.fromhex, out.column("bytes").to_pylist()), strict=True))
            if all(raw[w] == decoded for w, _, decoded in rows):
                break
        for v in ("init", "tokens"):
            self.con.unregister(v)
        for w, text, decoded in rows:
            self.cache[chunk[w][0]] = text.encode()
            if decoded != raw[w]:
                self.odd[chunk[w][0]] = decoded

    def decoded(self, words: list[str]) -> bytes:
        """The words' decoded bytes, put together."""
        if self.odd and not self.odd.keys().isdisjoint(words):
            return b"".join(self.odd.get(w) or w.encode("utf-8", "surrogatepass") for w in words)
        return "".join(words).encode("utf-8", "surrogatepass")

    def documents(self, cols: list) -> list:
        """Digest columns of a batch (doc ids, texts)."""
        keys, texts = cols
        out: tuple[list, list, list] = ([], [], [])
        at = 0
        while at < len(texts):  # some MB of text at a time
            trim()  # the lists and tables of the group before
            end, size, split = at, 0, []
            met: dict[str, str] = {}  # equal words are one object, not one per place
            while end < len(texts) and (end == at or size < GROUP_CHARS):
                words = self.split(texts[end] or "")
                split.append(list(map(met.setdefault, words, words)))
                size += len(texts[end] or "")
                end += 1
            known = self.words(met.keys())
            for words in split:
                ids = b",".join(map(known.__getitem__, words))
                out[0].append(ids.count(b",") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids).hexdigest())
                out[2].append(hashlib.sha256(self.decoded(words)).hexdigest())
            at = end
        return [keys, *out]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec: tasks that run in the same Python worker share it."""
    key = (path, pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(path, pattern)
        KEPT.append(_CODECS.clear)
    return _CODECS[key]


def public_vocabulary(name: str = VOCABULARY) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the number of tokens and the
    digests of the ids and of the decoded bytes. ``path`` is the rank file's place
    on every executor; None takes the installed public vocabulary."""

    def make():
        p, q = public_vocabulary()
        return codec(path or p, pattern or q).documents

    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, SCHEMA, make, keep=True)


def encode_texts(texts: list[str | None], path: str | None = None) -> list[list[int]]:
    """Ids of a few texts (for tests and interactive use)."""
    p, q = public_vocabulary()
    c = codec(path or p, q)
    out = []
    for t in texts:
        words = c.split(t or "")
        known = c.words(set(words))
        out.append([int(i) for w in words for i in known[w].split(b",")])
    return out


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, encoded and decoded."""
    return encode_documents(table(spark, sf_dir, "documents"))
