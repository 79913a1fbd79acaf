"""Mixture-controlled packing: deficit round-robin over source queues.

Every document becomes its token ids and an end id. The ids of a source stand one after
the other in the source's queue, and sequences of ``LENGTH`` ids are filled from the queues so
that each holds the target proportions as nearly as whole grains allow:

* A queue is served a grain at a time, about the ids it is due in one sequence. Its deficit
  grows by its target share with every id that is packed; grain k is served as soon as the
  deficit covers it, the queues in the order in which that happens (ties: the queue's
  number). What a queue is owed at the end of a sequence is carried to the next one, and an
  empty queue leaves its share to the others, so every id is packed.
* With shares fixed, the moment at which a deficit covers grain k is k + 1 grains over the
  share, whatever happened in the other queues. The place of a grain is the sum of what
  each queue has been served by then: one integer division per queue. A task therefore
  knows the deficits at any point without the sequences before it, and partitions carry
  deficits without waiting for each other.
* The stream is cut every ``LENGTH`` ids. The rest that does not fill a sequence is cut into
  sequences of powers of two, so nothing is padded.

Ids are computed once and written. Queue positions come from running totals of the written
parts (one row per part and source), never from a window over documents. Shares are whole
numbers of ``SHARES`` parts; sources below ``LEAST_SHARE`` of the ids wait in one shared queue,
so there are at most 1 / ``LEAST_SHARE`` + 1 queues, whatever the number of sources.

Defined results: a null or empty text is the end id alone; a null source is a source of
its own; a null ``doc_id`` is kept; equal rows are packed each; a text of any length is
encoded whole and spread over as many grains as it takes; no documents give no pieces;
extra columns are ignored. Which document stands first in a queue follows the order of the
written parts.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEPT, docs_of, free_worker, materialize, slices, table

LENGTH = 4096
VOCABULARY = "word_bpe_49k.json"
#: The id after each document (a fixed value of the contract).
END = 2
#: Least ids of a grain: a source with a smaller share of a sequence takes part in every
#: few of them.
GRAIN = 128
#: Resolution of the target shares, and the share below which sources share a queue.
SHARES = 1 << 18
LEAST_SHARE = 1 / 1024
#: Ids of a queue that the arithmetic can hold: SHARES times as many stay within 63 bits.
MOST_IDS = 1 << 44
#: Words, and parts of words, remembered in a worker; once full, others are worked out anew.
CACHE = 600_000
#: Numbers at a time in the arithmetic of places.
CELLS = 1_000_000


# ------------------------------------------------------------------ encoding
class Encoder:
    """A worker's tokenizer. White space never reaches a token, so a text's ids are its
    words' ids, one after the other; words are remembered, and the words of plain letters
    not met before are put together from their parts, which are remembered as well."""

    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
    #: Characters whose lower case, normal form and class are the same by every standard.
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([END], self.dtype).tobytes()
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        spelt = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(33, 256)) if self.PLAIN.fullmatch(c)}
        self.spelt = str.maketrans(spelt)
        self.words = _Words(self)
        self.parts: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """The text's ids and the end id, packed."""
        return b"".join(map(self.words.__getitem__, text.encode("utf-8", "surrogatepass").split())) + self.end

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def word(self, word: str) -> bytes:
        low = word.lower()
        known = self.parts.get(low)
        if known is not None:
            return known
        if low[-1] in ".,":
            known, mark = self.parts.get(low[:-1]), self.parts.get(low[-1])
            if known is not None and mark is not None and low[:-1].isalpha():
                return known + mark
        if not self.PLAIN.fullmatch(word):
            return self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        return b"".join([self.part(x) for x in self.PIECES.findall(low)])

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.packed([t.id for t in self.model.tokenize(part.translate(self.spelt))])
            if len(self.parts) < CACHE:
                self.parts[part] = ids
        return ids


class _Words(dict):
    """The ids of words met before; the first CACHE of them are kept, which the frequent
    ones are among."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encoder.word(word.decode("utf-8", "replace"))
        if len(self) < CACHE:
            self[word] = ids
        return ids


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: tasks that run in the same Python worker share it."""
    if path not in _ENCODERS:
        free_worker()
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
        KEPT.append(_ENCODERS.clear)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(part, source, doc_id, before, tokens, width, ids): ``before`` counts the ids of the
    source's earlier rows in the part; ``ids`` are little-endian numbers of ``width`` bytes."""
    schema = "part int, source string, doc_id long, before long, tokens long, width int, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if path is None:
            import public_tokenizers

            enc = encoder(public_tokenizers.path(VOCABULARY))
        else:
            enc = encoder(path)
        part, totals, width = TaskContext.get().partitionId(), {}, enc.dtype.itemsize
        for b in slices(batches, 200):
            source = b.column(1).to_pylist()
            ids = [enc.ids(t or "") for t in b.column(2).to_pylist()]
            tokens = [len(x) // width for x in ids]
            before = []
            for s, n in zip(source, tokens, strict=True):
                before.append(totals.get(s, 0))
                totals[s] = before[-1] + n
            m = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * m, pa.int32()), pa.array(source, pa.string()), b.column(0), pa.array(before, pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([width] * m, pa.int32()), pa.array(ids, pa.binary())],
                names=["part", "source", "doc_id", "before", "tokens", "width", "ids"])

    rows = docs_of(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------------ queues
class Queues:
    """Sizes and shares of the queues, and where a grain stands in the packed stream."""

    def __init__(self, totals: list[int], targets: list[float], length: int = LENGTH, grain: int = GRAIN):
        self.length = length
        self.total = np.array(totals, np.int64)
        if len(totals) and int(self.total.max()) > MOST_IDS:
            raise ValueError(f"a queue holds more than {MOST_IDS} ids")
        whole = sum(targets)
        if not all(t > 0 for t in targets):
            raise ValueError("every source with documents needs a target above 0")
        self.share = np.array([max(1, round(SHARES * t / whole)) for t in targets], np.int64)
        self.grain = np.maximum(grain, length * self.share // max(1, int(self.share.sum())))

    @property
    def packed(self) -> int:
        return int(self.total.sum())

    def place(self, queue: np.ndarray, grain: np.ndarray) -> np.ndarray:
        """Ids packed before each (queue, number of the grain)."""
        out = np.zeros(len(queue), np.int64)
        step = max(1, CELLS // max(1, len(self.total)))
        every = np.arange(len(self.total))[None, :]
        for i in range(0, len(queue), step):
            q, k = queue[i:i + step, None], grain[i:i + step, None]
            end = np.minimum((k + 1) * self.grain[q], self.total[q])
            covered = end * self.share[None, :] - (every > q)  # of equal moments, lower queues come first
            whole = covered // (self.share[q] * self.grain[None, :]) * self.grain[None, :]
            done = self.total[None, :] * self.share[q] <= covered
            served = np.where(done, self.total[None, :], np.minimum(whole, self.total // self.grain * self.grain))
            out[i:i + step] = np.where(every == q, k * self.grain[q], served).sum(axis=1)
        return out

    def pieces(self, queue: np.ndarray, start: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, ...]:
        """The pieces of documents that stand at ``start`` in their queues: the document's row,
        first id in the document, length, sequence, offset; by document and first id."""
        grain = self.grain[queue]
        k = start // grain
        n = (start + tokens - 1) // grain - k + 1
        row = np.repeat(np.arange(len(start)), n)
        k = k[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        lo = np.maximum(k * grain[row], start[row])
        size = np.minimum((k + 1) * grain[row], (start + tokens)[row]) - lo
        at = self.place(queue[row], k) + lo - k * grain[row]
        first = lo - start[row]
        out = []
        while len(at):  # what does not end in its sequence goes on in the next one
            sequence, begin, end = self.sequence_of(at)
            fits = np.minimum(size, end - at)
            out.append((row, first, fits, sequence, at - begin))
            more = size > fits
            row, first, at, size = row[more], (first + fits)[more], (at + fits)[more], (size - fits)[more]
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
        order = np.lexsort((cols[1], cols[0]))
        return tuple(c[order] for c in cols)

    def tail(self) -> list[int]:
        """Where the sequences of powers of two begin that hold the rest."""
        at, rest = self.packed // self.length * self.length, self.packed % self.length
        out = []
        while rest:
            out.append(at)
            at += 1 << (rest.bit_length() - 1)
            rest -= 1 << (rest.bit_length() - 1)
        return out

    def sequence_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence of each place of the stream, and that sequence's first place and end."""
        full = self.packed // self.length
        sequence = places // self.length
        begin = sequence * self.length
        end = begin + self.length
        late = sequence >= full
        if late.any():
            tail = np.array([*self.tail(), self.packed], np.int64)
            i = np.searchsorted(tail, places[late], side="right") - 1
            sequence[late], begin[late], end[late] = full + i, tail[i], tail[i + 1]
        return sequence, begin, end


def place_rows(encoded: DataFrame, targets: dict | None, length: int, grain: int) -> tuple[DataFrame, Queues]:
    """The written rows of ``encode`` with their queue and position in it."""
    per = materialize(encoded.groupBy("part", "source").agg(F.sum("tokens").alias("tokens")), "packing-totals")
    of_source = per.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = per.agg(F.sum("tokens").alias("n")).first()["n"] or 0  # one number
    large = of_source.where(F.col("tokens") >= F.lit(total * LEAST_SHARE)).collect()  # 1 / LEAST_SHARE rows at most
    large = sorted(large, key=lambda r: (r["source"] is not None, r["source"] or ""))
    sizes = [r["tokens"] for r in large]
    rest = total - sum(sizes)
    known = [r["source"] for r in large]
    goal = [float((targets or {}).get(s, 0) if targets is not None else n) for s, n in zip(known, sizes, strict=True)]
    if rest:
        sizes.append(rest)
        goal.append(float(rest) if targets is None else float(targets.get(REST, 0)))
    queues = Queues(sizes, goal, length, grain)
    number = F.lit(len(known))
    for i, s in enumerate(known):
        number = F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(i)).otherwise(number)
    per = per.withColumn("queue", number.cast("int"))
    # running totals over the parts of a queue, then over the sources of a part
    parts = per.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("queue", "part", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    within = Window.partitionBy("queue", "part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("inner", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    base = materialize(per.join(parts, ["queue", "part"]).select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), "queue", (F.col("base") + F.col("inner")).alias("base")),
        "packing-positions")
    match = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    return encoded.join(base, match).select("doc_id", "source", "queue", (F.col("base") + F.col("before")).alias("start"), "tokens",
                                            "width", "ids"), queues


def wide_ids(column: pa.Array, width: np.ndarray) -> np.ndarray:
    """The ids of all rows, one after the other, as 32-bit numbers."""
    for w in (2, 4):
        if (width == w).all():
            return np.frombuffer(b"".join(column.to_pylist()), f"<u{w}").astype("<u4")
    return np.concatenate([np.frombuffer(x, f"<u{w}").astype("<u4") for x, w in zip(column.to_pylist(), width, strict=True)] or
                          [np.zeros(0, "<u4")])


#: Key of the shared queue of small sources in ``targets``.
REST = "*"


def pack(docs: DataFrame, path: str | None = None, targets: dict | None = None, length: int = LENGTH,
         grain: int = GRAIN) -> DataFrame:
    """Pieces (doc_id, source, start, length, ids, doc_tokens, sequence_id, offset) of all
    documents (doc_id, source, text); ``ids`` are little-endian unsigned 32-bit numbers.

    ``targets`` gives each source's proportion (any positive numbers; the shared queue of
    small sources has the key ``REST``); None takes the sources' own proportions of the
    ids, so that all queues end together."""
    schema = "doc_id long, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    placed, queues = place_rows(materialize(encode(docs, path), "packing-ids"), targets, length, grain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            b = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in b.columns], names=b.schema.names)
            queue, start, tokens = (b.column(c).to_numpy().astype(np.int64) for c in ("queue", "start", "tokens"))
            row, first, size, sequence, offset = queues.pieces(queue, start, tokens)
            # by row and first id, the pieces' ids stand in the order of the column
            ids = wide_ids(b.column("ids"), b.column("width").to_numpy())
            ends = np.concatenate([[0], np.cumsum(4 * size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), b.column("source").take(pa.array(row)), pa.array(first), pa.array(size),
                 pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                 pa.array(tokens[row]), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, schema)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, packed; each piece with the checksum of its ids."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "source")
