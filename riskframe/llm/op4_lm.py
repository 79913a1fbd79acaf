"""Language-model scoring: online logistic context mixing over bits.

A text is lower-cased (A-Z), split into words at ASCII white space, and coded in order as each
word's bytes and a closing space; the end of the text is an empty word. Every bit is
predicted from the word so far by several predictors. Predictor k hashes its context (the last k bytes of
the word, or all of them, and the bits of the byte so far) into a fixed table of bit
counts. Their predictions, as log odds, are added with gated weights: the weight of a
predictor depends on how often its context was seen and on how often the two longest
contexts were. To that sum a second mixer adds what the word before tells: the exact counts
of the bit after the same word before and the same bytes, weighted by how often these were seen
and how sure the first sum is. An adaptive probability map, selected by the bits so far, then refines the result, and the
mean of both is the bit's probability. The sum over bits is the text's log10 probability
(``bits_per_byte`` is the same sum per coded byte). A text's first word follows the empty word.

Learning uses the documents whose crc32(doc_id as text) mod 5 is not 1. Counts come from
all their words; weights and map are learnt online (in steps over batches of words, one
run per shard, weights averaged over the shards) on the documents of remainder 4 against
counts of the others, so that they see words as unknown as a held-out text has them. For
scoring, the counts of both are added and the state is frozen, so that equal words after equal words cost
the same everywhere. A bit's contexts reach back to the start of the word before, so each distinct pair of
neighbouring words is coded once, and in sorted order only the bytes behind the part it shares with the pair before.

Work on Spark: one scan turns documents into chunks: their word numbers in order, and their pairs dealt
over buckets by the first word. A bucket holds all pairs of its first words: their followers, sorted,
are a tree whose nodes' counts are exact and grow with the corpus. What a pair costs goes
back to the chunks, which add it up along their texts. What is shuffled are packed pairs. Tables, weights and map have a
fixed size (``model_bytes``) whatever the corpus; only they go through the driver.
All different followers of one word meet in one task.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` counts as
an empty string in the split; equal rows score the same; extra columns are ignored; no
training words at all: every token is unknown and the model gives every bit 1/2.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, materialize, mix64, slices, table, trim, trimmed

#: Parameters. Bytes of context (99: the whole word so far) and table sizes in bits.
ORDERS = (1, 2, 3, 4, 6, 99)
BITS = (16, 19, 22, 22, 22, 22)
#: Levels of a context's count; gates (the levels of the two longest contexts, up to 7
#: each); buckets of the map; learning rate; the bits' floor, so that no text has
#: probability 0.
LEVELS, GATES, BUCKETS, RATE, FLOOR = 12, 64, 33, 0.05, 1.0 / 4096
#: Bytes per chunk of documents, words per sorted piece (and bytes per online
#: step), slots per block of a table (a batch of 1000 blocks is some 10 MB to a task).
CHUNK, STEP, BLOCK = 14_000_000, 16_384, 1 << 14
FOLDS, HELD, TUNE = 5, 1, 4
#: Distinct words per counting or learning task (about): a task holds its words and
#: the tables of one predictor, and tasks grow with the vocabulary.
SHARD = 400_000
#: Characters of text per bucket of pairs (about), pairs coded at a time (a word's followers stay
#: together), and byte events whose bits are mixed at a time.
BUCKET, PAIRS, EVENTS = 10_000_000, 50_000, 32_768
#: Cells of the second mixer for each level: whole log odds of the first sum, up to 7. Steps of a kept
#: first sum: 1024 are 1.
SURE, SUM_STEP = 8, 1.0 / 1024
#: Steps of a bit's log odds from which its probability is read, for 1 and up to 8 either way.
FINE, FINEST = 32, 512
MULTIPLIER = 0x9E3779B97F4A7C15
NODES = 256

RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, bits_per_byte double")


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def encoded(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of all texts in order, and per text how many tokens it has, the end counted, and
    how many bytes are coded."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.large_string()))))
    home, words = np.asarray(pc.list_parent_indices(lists)), lists.flatten()
    size = np.asarray(pc.binary_length(words))
    some = size > 0  # an empty text is one empty word
    if not some.all():
        home, size, words = home[some], size[some], words.filter(pa.array(some))
    count = np.bincount(home, minlength=len(texts))
    return words.cast(pa.large_binary()).dictionary_encode(), count + 1, np.bincount(home, size, len(texts)).astype(np.int64) + count + 1


# ---------------------------------------------------------------- packing
def pack(*parts: np.ndarray | list[bytes]) -> bytes:
    """Arrays of whole numbers from 0 as planes of bytes, lists of words joined by spaces, pressed."""
    import zstandard

    out, sizes = [], []
    for x in parts:
        if isinstance(x, list):
            out.append(b" ".join(x))
            sizes += [len(x), len(out[-1])]
            continue
        width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
        planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        out.append(np.ascontiguousarray(planes.T).tobytes())
        sizes += [len(x), len(out[-1])]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(parts), *sizes], np.int64).tobytes() + b"".join(out))


def unpack(data: bytes, words: int = -1) -> list:
    """What was packed; part ``words`` as a list of words, the others as 64-bit numbers."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(data, np.int64, 2 * int(np.frombuffer(data, np.int64, 1)[0]), 8).reshape(-1, 2)
    out, at = [], 8 + 16 * len(sizes)
    for k, (n, size) in enumerate(sizes.tolist()):
        if k == words:
            out.append(data[at:at + size].split(b" ") if n else [])
        else:
            x = np.zeros((n, 8), np.uint8)
            if n:
                x[:, :size // n] = np.frombuffer(data, np.uint8, size, at).reshape(-1, n).T
            out.append(x.view("<i8").ravel())
        at += size
    return out


# ---------------------------------------------------------------- chunks
CHUNKS = "chunk long, bucket int, blob binary"


def numbered(cat: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (word before * n + word) of a chunk's word numbers in order, and each
    word's pair. Every text ends with word 0, so the first word of each follows word 0."""
    before = np.append(0, cat[:-1])
    return distinct(before * n + cat, n * n)


def distinct(keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (from 0 and under ``limit``), sorted, and each key's place among them."""
    shift = len(keys).bit_length()
    if limit.bit_length() + shift > 63:
        return np.unique(keys, return_inverse=True)
    both = np.sort((keys << shift) | np.arange(len(keys)))
    key, at = both >> shift, np.empty(len(keys), np.int64)
    new = np.append(True, key[1:] != key[:-1])
    at[both & ((1 << shift) - 1)] = np.cumsum(new) - 1
    return key[new[:len(key)]], at


def by_bucket(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, places in ascending order) of each bucket that occurs."""
    small = len(bucket) > 0 and int(bucket.max()) < 1 << 16  # these are sorted by their digits
    order = np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, first[1:]), strict=True))


def heads(before: np.ndarray) -> np.ndarray:
    """Where another word before begins."""
    return np.flatnonzero(np.append(True, before[1:] != before[:-1])) if len(before) else np.zeros(0, np.int64)


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Two kinds of rows per chunk of documents: per bucket its distinct pairs of neighbouring words with
    their counts in the two training parts, and one (without bucket) of its documents: all their
    words in order. Words are numbered in the order of their bytes."""

    def flush(chunk, docs):
        ids, texts = (pa.chunked_array([d.column(k) for d in docs]).combine_chunks() for k in (0, 1))
        coded, sizes, n_bytes = encoded(texts)
        words = [b"", *coded.dictionary.to_pylist()]
        order, rank_of = np.asarray(pc.sort_indices(pa.array(words, pa.binary()))), np.empty(len(words), np.int64)
        rank_of[order] = np.arange(len(words))
        words = [words[i] for i in order.tolist()]  # the end token is word 0
        n, ends = len(words), np.cumsum(sizes) - 1
        cat, inside = np.zeros(int(sizes.sum()), np.int64), np.ones(int(sizes.sum()), bool)
        inside[ends] = False
        cat[inside] = rank_of[1 + np.asarray(coded.indices)]
        home = np.fromiter(map(zlib.crc32, words), np.int64, n) % buckets
        none, folds = np.asarray(ids.is_null()), [fold(i) for i in ids.to_pylist()]
        out = [(None, pack(np.asarray(ids.fill_null(0)).view(np.uint64), none, sizes, n_bytes, cat, home))]
        pairs, at = numbered(cat, n)
        part = np.repeat(np.array([0 if f == HELD else 1 + (f == TUNE) for f in folds]), sizes)
        fit, tune = (np.bincount(at[part == k], minlength=len(pairs)) for k in (1, 2))
        before, word = pairs // n, pairs % n
        used, code = np.zeros(n, bool), np.zeros(n, np.int64)
        for b, use in by_bucket(home[before]):
            p, w = before[use], word[use]
            used[p] = used[w] = True
            local, first = np.flatnonzero(used), heads(p)
            used[local], code[local] = False, np.arange(len(local))
            out.append((b, pack([words[i] for i in local.tolist()], code[p[first]], np.diff(np.append(first, len(p))), code[w], fit[use], tune[use])))
        return [pa.RecordBatch.from_arrays([pa.array([chunk] * len(some), pa.int64()), pa.array([x[0] for x in some], pa.int32()),
                                            pa.array([x[1] for x in some], pa.binary())], names=["chunk", "bucket", "blob"])
                for some in (out[i:i + 100] for i in range(0, len(out), 100))]

    def run(batches):
        from pyspark import TaskContext

        part, seq, size, held = TaskContext.get().partitionId(), 0, 0, []
        for b in slices(batches):
            held.append(b)
            size += pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            if size >= CHUNK:
                yield from flush((part << 32) + seq, held)
                seq, size, held = seq + 1, 0, []
                trim()
        if held:
            yield from flush((part << 32) + seq, held)

    return docs.mapInArrow(trimmed(run), CHUNKS)


MERGED = "bucket int, pairs binary, chunks array<bigint>, places array<binary>"


def merge(rows: pa.Table) -> pa.Table:
    """One row per bucket: its distinct pairs in sorted order with the sums of their counts, and
    where the pairs of each chunk are among them."""
    parts = [unpack(x, 0) for x in rows.column("blob").to_pylist()]
    coded = pa.chunked_array([pa.array(p[0], pa.binary()) for p in parts]).combine_chunks().dictionary_encode()
    order, rank = np.asarray(pc.sort_indices(coded.dictionary)), np.empty(len(coded.dictionary), np.int64)
    rank[order] = np.arange(len(order))
    words, each = coded.dictionary.take(pa.array(order)).to_pylist(), rank[np.asarray(coded.indices)]
    keys = []
    for p, own in zip(parts, np.split(each, np.cumsum([len(p[0]) for p in parts])[:-1]), strict=True):
        keys.append(np.repeat(own[p[1]], p[2]) * len(words) + own[p[3]])
    pairs, at = distinct(np.concatenate(keys), len(words) ** 2)
    fit, tune = (np.zeros(len(pairs), np.int64) for _ in range(2))
    places = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
    for p, place in zip(parts, places, strict=True):  # no pair twice in a chunk
        fit[place] += p[4]
        tune[place] += p[5]
    before = pairs // len(words)
    first = heads(before)
    blob = pack(words, before[first], np.diff(np.append(first, len(pairs))), pairs % len(words), fit, tune)
    return pa.table({"bucket": rows.column("bucket").slice(0, 1).cast(pa.int32()), "pairs": pa.array([blob], pa.binary()),
                     "chunks": pa.array([rows.column("chunk").to_pylist()], pa.list_(pa.int64())),
                     "places": pa.array([[pack(np.diff(x, prepend=0)) for x in places]], pa.list_(pa.binary()))})


def vocabulary(batches):
    """Each word that has a word behind it (all have: the end, the next text) and its counts."""
    for b in batches:
        for blob in b.column(0).to_pylist():
            words, before, runs, _, fit, tune = unpack(blob, 0)
            first = np.cumsum(runs) - runs
            for at in range(0, len(before), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in before[some].tolist()], pa.binary()),
                     *(pa.array(np.add.reduceat(c, first)[some], pa.int64()) for c in (fit, tune))], names=["word", "fit", "tune"])


# ---------------------------------------------------------------- bit events
class Events:
    """The bytes of some sorted words (and their closing spaces) as a tree: a byte that
    a word shares with the word before it, after the same bytes, is one event."""

    def __init__(self, words: list[bytes], fresh: np.ndarray | None = None):
        """``fresh``: words that share nothing with the word before them."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.n, self.start = len(words), np.cumsum(size) - size
        self.flat = np.frombuffer(b"".join([w + b" " for w in words]), np.uint8)
        place = np.arange(len(self.flat)) - np.repeat(self.start, size)
        self.lcp = np.zeros(self.n, np.int64)
        same, i = np.arange(1, self.n), 0
        if fresh is not None:
            same = same[~fresh[1:]]
        while len(same):
            same = same[np.minimum(size[same], size[same - 1]) > i]
            same = same[self.flat[self.start[same] + i] == self.flat[self.start[same - 1] + i]]
            i += 1
            self.lcp[same] = i
        self.lcp = np.minimum(self.lcp, size - 1)  # equal words keep an event
        word = np.repeat(np.arange(self.n), size)
        self.at = np.flatnonzero(place >= self.lcp[word])
        self.byte, self.place, self.word = self.flat[self.at], place[self.at], word[self.at]
        self.first = np.cumsum(size - self.lcp) - (size - self.lcp)  # a word's first event

    def shared(self):
        """Per place, as long as words share it: these words, and per run of words that share the same
        byte its event, its first word and the end of the run."""
        words, i = np.flatnonzero(self.lcp > 0), 0
        while len(words):
            cut = np.flatnonzero(np.diff(words) != 1)
            head, end = words[np.append(0, cut + 1)] - 1, words[np.append(cut, len(words) - 1)] + 1
            yield i, words, self.first[head] + i - self.lcp[head], head, end
            i += 1
            words = words[self.lcp[words] > i]

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """Per event the counts of all words below it."""
        out, total = counts[self.word], np.append(0, np.cumsum(counts))
        for _, _, event, head, end in self.shared():
            out[event] = total[end] - total[head]
        return out

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Per word the sum over all its bytes."""
        out = np.bincount(self.word, values, self.n)
        for _, words, event, head, end in self.shared():
            out[words] += np.repeat(values[event], end - head - 1)
        return out

    def owners(self) -> np.ndarray:
        """The event of each byte of all words."""
        out = np.zeros(len(self.flat), np.int64)
        out[self.at] = np.arange(len(self.at))
        for i, words, event, head, end in self.shared():
            out[self.start[words] + i] = np.repeat(event, end - head - 1)
        return out

    def whole(self) -> np.ndarray:
        """Hash of all bytes of the word before each event: a difference of running
        sums, brought to the word's start by the inverse power of the multiplier."""
        def powers(base):
            out = np.full(len(self.flat), np.uint64(base), np.uint64)
            out[:1] = 1
            return np.multiply.accumulate(out)

        with np.errstate(over="ignore"):
            terms = (self.flat.astype(np.uint64) + np.uint64(1)) * powers(MULTIPLIER)
            before = np.cumsum(terms, dtype=np.uint64) - terms
            start = self.at - self.place
            return (before[self.at] - before[start]) * powers(pow(MULTIPLIER, -1, 1 << 64))[start]

    def contexts(self, only: int | None = None) -> list[np.ndarray]:
        """One 64-bit hash per predictor (or the one asked for) and event."""
        out = []
        for k, order in enumerate(ORDERS):
            if only is not None and k != only:
                continue
            if order == 99:
                h = self.whole() + self.place.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
            else:
                h = np.zeros(len(self.at), np.uint64)
                for i in range(1, order + 1):
                    use = np.flatnonzero(self.place >= i)
                    h[use] = h[use] * np.uint64(0x100000001B3) + self.flat[self.at[use] - i] + np.uint64(2)
            out.append(mix64(h + np.uint64(0x51ED270B * (k + 1))))
        return out


def bits(byte: np.ndarray):
    """(node, bit) of each bit position: eight pairs of arrays."""
    node = np.ones(len(byte), np.int64)
    for i in range(8):
        bit = (byte >> (7 - i)) & 1
        yield node, bit
        node = node * 2 + bit


def pieces(batches, n_columns: int):
    """Sorted pieces of STEP words: lists of words and their count columns."""
    for b in batches:
        for at in range(0, b.num_rows, STEP):
            piece = b.slice(at, STEP)
            yield piece.column(0).to_pylist(), [np.asarray(piece.column(j)).astype(np.float64) for j in range(1, n_columns + 1)], piece


_NODE_KEYS = np.arange(256, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    h = context ^ _NODE_KEYS.take(node)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h >>= np.uint64(64 - bits)
    return h.view(np.int64)


# ---------------------------------------------------------------- tables
BLOCKS = "predictor int, block int, part binary"


def count_blocks(words: DataFrame, shards: int) -> DataFrame:
    """Bit counts of each shard's words: per predictor and block of slots the counts
    (fit ones, fit zeros, tune ones, tune zeros). The blocks of all shards are added
    in sorted order, one block in memory at a time."""

    def count(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        held = []
        for words_, counts, _ in pieces(batches, 2):
            ev = Events(words_)
            masses = [ev.mass(c).astype(np.uint32) for c in counts]
            held.append((ev, [(np.flatnonzero(m), m[m > 0]) for m in masses]))
        sums = part = None
        for k, size in enumerate(BITS):
            del sums, part  # before the next table is made
            sums, part = np.zeros((4, 1 << size), np.uint32), None
            for ev, masses in held:
                (context,) = ev.contexts(k)
                for node, bit in bits(ev.byte):
                    s = slots(context, node, size)
                    s += (bit == 0) * np.int64(1 << size)
                    for j, (use, mass) in enumerate(masses):
                        np.add.at(sums[2 * j:2 * j + 2].reshape(-1), s.take(use), mass)
            for i in range(0, 1 << size, BLOCK):
                part = sums[:, i:i + BLOCK]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"predictor": pa.array([k], pa.int32()), "block": pa.array([i // BLOCK], pa.int32()),
                                                      "part": pa.array([press.compress(packed(part))], pa.binary())})

    def add(batches):
        import zstandard

        expand = zstandard.ZstdDecompressor()
        at, total = None, None

        def done():
            fit, whole = quantise(total[0], total[1]), quantise(total[0] + total[2], total[1] + total[3])
            return pa.RecordBatch.from_pydict({"predictor": pa.array([at[0]], pa.int32()), "block": pa.array([at[1]], pa.int32()),
                                               "part": pa.array([fit.tobytes() + whole.tobytes()], pa.binary())})

        for b in slices(batches, 100):
            for k, i, part in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                values = unpacked(expand.decompress(part))
                if at == (k, i):
                    total = total + values
                else:
                    if at is not None:
                        yield done()
                    at, total = (k, i), values
        if at is not None:
            yield done()

    trained = words.where(F.col("fit") + F.col("tune") > 0).select("word", "fit", "tune")
    trained = trained.repartitionByRange(shards, "word").sortWithinPartitions("word")
    parts = trained.mapInArrow(trimmed(count), BLOCKS)
    return parts.repartition("predictor", "block").sortWithinPartitions("predictor", "block").mapInArrow(trimmed(add), BLOCKS)


def packed(part: np.ndarray) -> bytes:
    """Counts as bytes, those from 255 on also in full behind them."""
    flat = part.ravel()
    large = np.flatnonzero(flat >= 255).astype(np.uint32)
    return np.minimum(flat, 255).astype(np.uint8).tobytes() + large.tobytes() + flat[large].tobytes() + np.uint32(len(flat)).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data[-4:], np.uint32)[0])
    flat = np.frombuffer(data, np.uint8, n).astype(np.float64)
    large, full = np.frombuffer(data[n:-4], np.uint32).reshape(2, -1)
    flat[large] = full
    return flat.reshape(4, -1)


def quantise(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Two bytes a slot: the level of its count, and log odds in steps of 1/12."""
    n = ones + zeros
    odds = np.log((ones + 0.3) / (zeros + 0.3))
    level = np.minimum(LEVELS - 1, np.ceil(np.log2(n + 1)))
    return np.clip(np.rint(odds * 12), -127, 127).astype(np.int16) + 256 * level.astype(np.int16) + 128


def gather_tables(blocks: DataFrame) -> tuple[list, list]:
    """Tables for learning the weights and for scoring: per predictor (log odds, level).
    At most ``model_bytes()`` pass through the driver, whatever the corpus."""
    empty = int(quantise(np.zeros(1), np.zeros(1))[0])
    made = [[np.full(1 << b, empty, np.int16) for b in BITS] for _ in range(2)]
    for r in blocks.toLocalIterator():
        part = np.frombuffer(r.part, np.int16)
        n = len(part) // 2
        for j in range(2):
            made[j][r.predictor][r.block * BLOCK:r.block * BLOCK + n] = part[j * n:(j + 1) * n]
    return made[0], made[1]


def model_bytes() -> int:
    return 2 * 2 * sum(1 << b for b in BITS)


# ---------------------------------------------------------------- mixing
def first_weights() -> np.ndarray:
    """(predictor, level, gate): contexts never seen count nothing."""
    w = np.full((len(ORDERS), LEVELS, GATES), 0.25)
    w[:, 0] = 0.0
    return w


def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def mixed(tables: list, contexts: list[np.ndarray], node: np.ndarray, weights: np.ndarray):
    """Sum of weighted log odds; per predictor its log odds and its weight's cell."""
    found = [t.take(slots(c, node, b)) for t, c, b in zip(tables, contexts, BITS, strict=True)]
    levels = [v >> 8 for v in found]
    gate = np.minimum(levels[-1], 7) * 8 + np.minimum(levels[-2], 7)
    total, inputs = np.zeros(len(node), weights.dtype), []
    for k, (v, level) in enumerate(zip(found, levels, strict=True)):
        x, cell = ((v & 255) - 128).astype(np.float32) * np.float32(1.0 / 12), (level * GATES + gate).astype(np.int64)
        total += weights[k].ravel().take(cell) * x
        inputs.append((x, cell))
    return total, inputs


def bucket(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.clip(total, -7.999, 7.999) * ((BUCKETS - 1) / 16.0) + (BUCKETS - 1) / 2.0
    low = at.astype(np.int64)
    return low, at - np.floor(at)


def learn(words: DataFrame, sent, shards: int) -> np.ndarray:
    """The predictors' weights, averaged over the shards' online runs."""
    tuned = words.where("tune > 0").select("word", "tune").repartitionByRange(shards, "word").sortWithinPartitions("word")

    def online(batches):
        w, seen = first_weights(), np.zeros((len(ORDERS), LEVELS, GATES))
        for words_, (tune,), _ in pieces(batches, 1):
            ev = Events(words_)
            contexts, mass = ev.contexts(), ev.mass(tune)
            mixed_up = np.random.default_rng(len(words_)).permutation(len(mass))
            for at in range(0, len(mixed_up), STEP):
                use = mixed_up[at:at + STEP]
                some, times = [c[use] for c in contexts], mass[use]
                for node, bit in bits(ev.byte[use]):
                    total, inputs = mixed(sent.value, some, node, w)
                    error = (bit - squash(total)) * times
                    for k, (x, cell) in enumerate(inputs):
                        down = error * x
                        seen[k] += np.bincount(cell, down * down, LEVELS * GATES).reshape(LEVELS, GATES)
                        w[k] += RATE * np.bincount(cell, down, LEVELS * GATES).reshape(LEVELS, GATES) / np.sqrt(seen[k] + 1.0)
        yield pa.RecordBatch.from_pydict({"state": pa.array([(w * seen).tobytes() + seen.tobytes()], pa.binary())})

    total = added(tuned.mapInArrow(trimmed(online), "state binary"), shards, 2 * len(ORDERS) * LEVELS * GATES).reshape(2, len(ORDERS), LEVELS, GATES)
    return np.where(total[1] > 0, total[0] / np.maximum(total[1], 1e-300), first_weights())


def added(states: DataFrame, shards: int, size: int) -> np.ndarray:
    """Sum of the shards' states (arrays of one size): first in about as many tasks
    as the square root of the shards, then those few sums on the driver."""
    def add(batches):
        total = np.zeros(size)
        for b in batches:
            for state in b.column(0).to_pylist():
                total += np.frombuffer(state)
        yield pa.RecordBatch.from_pydict({"state": pa.array([total.tobytes()], pa.binary())})

    some = states.repartition(max(1, math.isqrt(shards))).mapInArrow(add, "state binary")
    return sum((np.frombuffer(r.state) for r in some.collect()), np.zeros(size))


def word_sums(ev: Events, tables, weights) -> np.ndarray:
    """[bit, event]: the first mixer's sums, in whole ``SUM_STEP``."""
    contexts, out, weights = ev.contexts(), np.empty((8, len(ev.byte)), np.int16), weights.astype(np.float32)
    for at in range(0, len(ev.byte), EVENTS):
        some = slice(at, at + EVENTS)
        use = [c[some] for c in contexts]
        for t, (node, _) in enumerate(bits(ev.byte[some])):
            total = mixed(tables, use, node, weights)[0]
            out[t, some] = np.rint(np.clip(total, -31, 31) * np.float32(1 / SUM_STEP))
    return out


def log10_table(refined: np.ndarray) -> np.ndarray:
    """[bit, node, log odds in steps] log10 probability of the bit, by the mean of the mixed sum and its map."""
    x = (np.arange(FINEST) - FINEST // 2) / FINE
    low, part = bucket(x)
    cell = np.arange(NODES)[:, None] * BUCKETS + low
    p = 0.5 * squash(x) + 0.5 * (refined[cell] * (1 - part) + refined[cell + 1] * part)
    p = np.clip(p, FLOOR, 1 - FLOOR)
    return np.log10(np.stack([1 - p, p])).astype(np.float32)


def log10_of(total: np.ndarray, node: np.ndarray, bit: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.rint(np.minimum(np.maximum(total * np.float32(FINE), -FINEST // 2), FINEST // 2 - 1)).astype(np.int64)
    at += (bit * np.int64(NODES) + node) * FINEST + FINEST // 2
    return table.ravel().take(at)


def word_scores(words: list[bytes], tables, weights, refined) -> np.ndarray:
    """log10 probability of each word with its closing space, when nothing is known of the word
    before; ``words`` are sorted."""
    ev, table = Events(words), log10_table(refined)
    sums, total = word_sums(ev, tables, weights), np.zeros(len(ev.byte))
    for t, (node, bit) in enumerate(bits(ev.byte)):
        total += log10_of(sums[t] * np.float32(SUM_STEP), node, bit, table)
    return ev.totals(total)


# ---------------------------------------------------------------- pairs
class Pairs:
    """Some words' followers, sorted by both, as trees of byte events."""

    def __init__(self, words: list[bytes], before: np.ndarray, follower: np.ndarray):
        fresh = np.append(True, before[1:] != before[:-1])
        self.words, self.follower = words, follower
        self.ev = ev = Events([words[i] for i in follower.tolist()], fresh)
        deepest = int(ev.place.max(initial=0))
        self.order = np.argsort(ev.place.astype(np.uint16) if deepest < 1 << 16 else ev.place, kind="stable")
        word, place = ev.word[self.order], ev.place[self.order]
        #: In ``order``, events after the same bytes stand together; where the next such group begins.
        self.new = np.where(place == 0, fresh[word], ev.lcp[word] < place)
        if (ev.byte < 32).any():  # they stand behind the closing space, which ends a shorter word
            self.order = self.order[np.lexsort((ev.byte[self.order], np.cumsum(self.new)))]

        size = np.diff(np.append(np.flatnonzero(self.new), len(self.new)))
        several = np.repeat(size > 1, size)  # the others are alone after their bytes
        self.order, self.new = self.order[several], self.new[several]

    def passing(self, mass: np.ndarray) -> np.ndarray:
        """[9, event]: the counts that reach each of the byte's eight bits, and the byte's own."""
        out, byte = np.empty((9, len(mass)), np.float32), self.ev.byte[self.order]
        out[:] = mass
        below, new = np.append(0, np.cumsum(mass[self.order])), self.new.copy()
        for t in range(8):
            if t:
                high = byte >> (8 - t)
                new[1:] |= high[1:] != high[:-1]
            at = np.append(np.flatnonzero(new), len(new))
            out[t, self.order] = np.repeat(np.diff(below[at]), np.diff(at))
        return out


class Sums:
    """The first mixer's sums of the bits of ``needed`` ones of the words, two bytes each."""

    def __init__(self, words: list[bytes], needed: np.ndarray, tables, weights):
        self.start, size, kept, event = np.zeros(len(words), np.int64), [0, 0], [], []
        for at in range(0, len(needed), 2 * STEP):
            some = needed[at:at + 2 * STEP]
            ev = Events([words[i] for i in some.tolist()])
            kept.append(word_sums(ev, tables, weights))
            event.append((ev.owners() + size[0]).astype(np.int32))
            self.start[some] = ev.start + size[1]
            size = [size[0] + len(ev.at), size[1] + len(ev.flat)]
        self.kept, self.event = np.concatenate(kept, axis=1), np.concatenate(event)

    def steps(self, follower: np.ndarray, place: np.ndarray, byte: np.ndarray, reach: np.ndarray):
        """Of byte events (a follower, a place in it, and [9, event] what of the counts reaches each
        bit and the byte): a slice of them, and per bit (node, bit, the first sum, its cell, the log
        odds in favour of 1 by the word before)."""
        for at in range(0, len(byte), EVENTS):
            some, out = slice(at, at + EVENTS), []
            event = self.event[self.start[follower[some]] + place[some]]
            for t, (node, bit) in enumerate(bits(byte[some])):
                kept, n = self.kept[t].take(event), reach[t, some]
                s = kept * np.float32(SUM_STEP)
                ones = np.where(bit == 1, reach[t + 1, some], n - reach[t + 1, some])  # the same for both values of the bit
                odds = np.log((ones + np.float32(0.3)) / (n - ones + np.float32(0.3)))
                level = np.clip((n.view(np.int32) >> 23) - 126, 0, LEVELS - 1)  # binary digits of the count
                cell = level * SURE + np.minimum(np.abs(kept) >> 10, SURE - 1)
                out.append((node, bit, s, cell.astype(np.int64), odds))
            yield some, out


def first_pair_weights() -> np.ndarray:
    """(first sum or word before, cell): words before that were never seen count nothing."""
    w = np.ones((2, LEVELS * SURE), np.float32)
    w[1] = 0.3
    w[1, :SURE] = 0.0
    return w


def pair_pieces(blob: bytes, wanted: Callable) -> tuple[list[bytes], np.ndarray, Iterator[tuple]]:
    """A bucket's words, the followers of the pairs that are ``wanted`` by their two counts, and its pieces:
    words before, followers, counts."""
    words, before, runs, follower, fit, tune = unpack(blob, 0)
    ends = np.cumsum(runs)
    cuts = np.unique(np.append(0, ends[np.searchsorted(ends, np.arange(PAIRS, ends[-1] + PAIRS, PAIRS).clip(max=ends[-1]))])).tolist()
    whole = np.repeat(before, runs)
    return words, np.unique(follower[wanted(fit, tune)]), ((whole[lo:hi], follower[lo:hi], fit[lo:hi], tune[lo:hi]) for lo, hi in itertools.pairwise(cuts))


def learn_pairs(merged: DataFrame, sent, weights: np.ndarray, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """The second mixer's weights, averaged over the tasks' online runs, and the map, counted along them."""

    def online(batches):
        w, seen, counts = first_pair_weights(), np.zeros((2, LEVELS * SURE)), np.zeros(2 * NODES * BUCKETS)
        for blob in (b.column(0)[i].as_py() for b in batches for i in range(b.num_rows)):
            words, needed, parts = pair_pieces(blob, lambda fit, tune: tune > 0)
            if not len(needed):
                continue
            sums = Sums(words, needed, sent.value, weights)
            for before, follower, fit, tune in parts:
                tried = np.zeros(len(words), bool)
                tried[before[tune > 0]] = True
                use = tried[before] & (fit + tune > 0)
                before, follower, fit, tune = (x[use] for x in (before, follower, fit, tune))
                own = np.flatnonzero(tune)
                if not len(own):
                    continue
                pairs = Pairs(words, before, follower)
                ev = Events([words[i] for i in follower[own].tolist()], np.append(True, np.diff(before[own]) != 0))
                steps = 1 + len(ev.byte) // EVENTS
                mixed_up = np.concatenate([np.arange(k, len(ev.byte), steps) for k in range(steps)])  # each step has words of all letters
                pair, place, mass = own[ev.word[mixed_up]], ev.place[mixed_up], ev.mass(tune[own].astype(np.float64))[mixed_up]
                reach = pairs.passing(pairs.ev.mass(fit.astype(np.float64)))[:, pairs.ev.owners()[pairs.ev.start[pair] + place]]
                for some, steps in sums.steps(follower[pair], place, ev.byte[mixed_up], reach):
                    times = mass[some]
                    for node, bit, s, cell, x in steps:
                        total = w[0, cell] * s + w[1, cell] * x
                        low, part = bucket(total)
                        at, upper = (bit * np.int64(NODES) + node) * BUCKETS + low, times * part
                        counts += np.bincount(at, times - upper, len(counts))
                        counts += np.bincount(at + 1, upper, len(counts))
                        error = (bit - squash(total)) * times
                        for k, part in enumerate((s, x)):
                            down = error * part
                            seen[k] += np.bincount(cell, down * down, LEVELS * SURE)
                            w[k] += RATE * np.bincount(cell, down, LEVELS * SURE) / np.sqrt(seen[k] + 1.0)
            trim()
        yield pa.RecordBatch.from_pydict({"state": pa.array([(w * seen).tobytes() + seen.tobytes() + counts.tobytes()], pa.binary())})

    cells = 2 * LEVELS * SURE
    sums = added(merged.select("pairs").mapInArrow(trimmed(online), "state binary"), tasks, 2 * cells + 2 * NODES * BUCKETS)
    total, counts = sums[:2 * cells].reshape(2, 2, -1), sums[2 * cells:].reshape(2, -1)
    own = squash((np.arange(BUCKETS) - (BUCKETS - 1) / 2.0) * (16.0 / (BUCKETS - 1)))
    prior = np.tile(own, NODES)
    return (np.where(total[1] > 0, total[0] / np.maximum(total[1], 1e-300), first_pair_weights()).astype(np.float32),
            ((counts[1] + 20.0 * prior) / (counts.sum(axis=0) + 20.0)).astype(np.float32))


def pair_scores(words: list[bytes], before: np.ndarray, follower: np.ndarray, counts: np.ndarray, sums: Sums, second, table) -> np.ndarray:
    """log10 probability of each follower with its closing space after its word before; pairs of numbers
    of sorted words, sorted, with all the followers of a word before."""
    pairs = Pairs(words, before, follower)
    ev, value = pairs.ev, np.zeros(len(pairs.ev.byte))
    for some, steps in sums.steps(follower[ev.word], ev.place, ev.byte, pairs.passing(ev.mass(counts.astype(np.float64)))):
        for node, bit, s, cell, x in steps:
            value[some] += log10_of(second[0].take(cell) * s + second[1].take(cell) * x, node, bit, table)
    return ev.totals(value)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    buckets = 1 + int(rows.select(F.sum(F.length("text"))).first()[0] or 0) // BUCKET
    made = materialize(chunks(rows, buckets), "lm-chunks")
    dealt = made.where(F.col("bucket").isNotNull()).repartition(buckets, "bucket")
    merged = materialize(dealt.groupBy("bucket").applyInArrow(merge, MERGED), "lm-pairs")
    words = materialize(merged.select("pairs").mapInArrow(trimmed(vocabulary), "word binary, fit long, tune long"), "lm-words")
    n, v = words.select(F.sum(F.col("fit") + F.col("tune")), F.sum(F.when(F.col("fit") + F.col("tune") > 0, 1).otherwise(0))).first()
    n, v = int(n or 0), int(v or 0)
    shards = 2 + v // SHARD
    fit, whole = gather_tables(materialize(count_blocks(words, shards), "lm-tables"))
    sent = spark.sparkContext.broadcast(fit)
    weights = learn(words, sent, shards)
    second, refined = learn_pairs(merged, sent, weights, buckets)
    sent.unpersist()
    sent = spark.sparkContext.broadcast((whole, second, log10_table(refined)))

    def score(batches):
        tables, *mixers = sent.value
        for bucket, blob, chunk_ids, places in ([b.column(k)[i].as_py() for k in range(4)] for b in batches for i in range(b.num_rows)):
            words_, needed, parts = pair_pieces(blob, lambda fit, tune: fit >= 0)
            sums = Sums(words_, needed, tables, weights)
            before, logp, c = [], [], []
            for p, follower, fit, tune in parts:
                before.append(p)
                logp.append(pair_scores(words_, p, follower, fit + tune, sums, *mixers).astype(np.float32))
                first = heads(p)
                c.append(np.repeat(np.add.reduceat(fit + tune, first), np.diff(np.append(first, len(p)))))
            before, logp, c = np.concatenate(before), np.concatenate(logp), np.concatenate(c)
            for chunk, place in zip(chunk_ids, places, strict=True):
                at = np.cumsum(unpack(place)[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()),
                     pa.array([pack(logp[at].view(np.uint32), c[at][heads(before[at])])], pa.binary())], names=["chunk", "bucket", "blob"])
            trim()

    scored = merged.mapInArrow(trimmed(score), CHUNKS)
    texts = made.where(F.col("bucket").isNull()).select(F.col("chunk").alias("home"), F.col("blob").alias("texts"))
    floor = n + 0.5 * (v + 1)

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, none, sizes, n_bytes, cat, home = unpack(right.column("texts")[0].as_py())
        pairs, at = numbered(cat, len(home))
        before = pairs // len(home)
        logp, c, blobs = np.zeros(len(pairs)), np.zeros(len(home), np.int64), dict(zip(left.column("bucket").to_pylist(), left.column("blob").to_pylist(), strict=True))
        for b, use in by_bucket(home[before]):
            found, counts = unpack(blobs[b])
            logp[use] = found.astype(np.uint32).view(np.float32)
            c[before[use][heads(before[use])]] = counts
        first = np.cumsum(sizes) - sizes
        held = [fold(None if x else i) == HELD for i, x in zip(ids.tolist(), none.tolist(), strict=True)]
        score = np.add.reduceat(logp[at], first)
        cols = (pa.array(ids, mask=none > 0), held, sizes, np.add.reduceat((c[cat] > 0).astype(np.int64), first), np.full(len(ids), n),
                np.add.reduceat(np.log10((c + 0.5) / floor)[cat], first), score, -score / np.log10(2) / n_bytes)
        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names=names)

    return scored.groupBy("chunk").cogroup(texts.groupBy("home")).applyInArrow(add, RESULT)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``."""
    return score_documents(table(spark, sf_dir, "documents"))
