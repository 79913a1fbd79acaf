"""Helpers shared by the training-data operators: table reads, Arrow row maps,
word splitting and stable 64-bit hashing."""

from __future__ import annotations

import contextlib
import os
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize  # noqa: F401  (re-exported for the operators)

#: ASCII white space; ``bytes.split()`` without arguments splits on exactly these.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Rows of text per Arrow batch: Spark's own 10,000 are tens of MB of text in the JVM
#: and again in each Python worker.
BATCH_ROWS = 1000
_ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def docs_of(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns: extra columns of the input never reach an operator.
    Limits the session's Arrow batches to BATCH_ROWS rows, unless they are smaller."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS_PER_BATCH, "10000")) <= BATCH_ROWS:
        conf.set(_ROWS_PER_BATCH, str(BATCH_ROWS))
    return df.select(*[F.col(f"`{c}`") for c in cols])


def map_rows(df: DataFrame, schema: T.StructType | str,
             make: Callable[[], Callable[[list], list]], keep: bool = False) -> DataFrame:
    """``mapInArrow`` over column lists. ``make`` runs once per task and returns
    the function from a batch's columns to the result's columns, so that state
    built per task (connections, automata) is shared by its batches. ``keep``: what an
    earlier task left in the worker is still of use."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker_state(keep):
            fn = make()
            for b in slices(batches):
                out = fn([b.column(i).to_pylist() for i in range(b.num_columns)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


#: What frees the state that an operator keeps in its Python worker between tasks. It runs
#: before another operator's work in the worker, and when the worker has been idle for IDLE_S
#: seconds: a stage without Python gets the memory back.
KEPT: list[Callable[[], None]] = []
IDLE_S = 2.0
_STATE = threading.RLock()
_idle: list[threading.Timer] = []


@contextlib.contextmanager
def worker_state(keep: bool) -> Iterator[None]:
    """A task's use of its worker. ``keep``: it takes over what an earlier task left."""
    with _STATE:
        while _idle:
            _idle.pop().cancel()
        if not keep:
            free_worker()
    try:
        yield
    finally:
        with _STATE:
            if KEPT:
                timer = threading.Timer(IDLE_S, lambda: free_if_idle(timer))
                timer.daemon = True
                _idle.append(timer)
                timer.start()


def free_if_idle(timer: threading.Timer) -> None:
    with _STATE:
        if timer in _idle:  # no task has begun since
            _idle.clear()
            free_worker()


def free_worker() -> None:
    with _STATE:
        if KEPT:
            for free in KEPT:
                free()
            KEPT.clear()
            trim()


def trim() -> None:
    """Hands freed memory back to the system, where the libraries can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def trimmed(run: Callable) -> Callable:
    """A function of Arrow batches that hands its memory back at its end: workers live on, and
    what each of an executor's keeps adds to the next stage's."""
    def wrapped(batches):
        yield from run(batches)
        trim()

    return wrapped


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, which bounds the Python objects made of
    them at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def to_arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema as convert

    return convert(schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit multiply-xorshift hash, element-wise (wraps around)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes of a word that is hashed by the table of powers; longer ones are hashed whole.
LONGEST = 4096
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_POWERS = np.full(LONGEST, np.uint64(0x9E3779B97F4A7C15), np.uint64)
_POWERS[0] = 1
_POWERS = np.multiply.accumulate(_POWERS)


def word_hashes(body: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text (runs of bytes other than ASCII space)."""
    b = np.frombuffer(body, np.uint8)
    word = _WORD[b]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = np.flatnonzero(edge == -1) - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    terms = (b[word].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, LONGEST - 1)]
    out = mix64(np.add.reduceat(terms, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(size > LONGEST):
        import xxhash

        out[i] = xxhash.xxh3_64_intdigest(body[starts[i]:starts[i] + size[i]])
    return out


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; remembers at most ``limit`` words per task and
    starts afresh beyond that, so memory stays bounded and results do not change."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; a shorter text is one run of its words;
    a text without words has none."""
    m = len(word_hashes)
    if m == 0:
        return word_hashes
    n = min(n, m)
    out = np.zeros(m - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:m - n + 1 + i]
        out ^= out >> np.uint64(29)
    return mix64(out + np.uint64(n))
