"""What the operators of this subpackage share: table access, lineage cuts, joins on crowded keys and workers' state."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._lineage import checkpoint_folder, remove
from ..operators._lineage import settle as cut

__all__ = ["by_bytes", "checkpoint_folder", "cut", "cut_few", "forget", "join_crowded", "own_broadcasts", "per_worker", "remove", "share", "slices", "small_batches", "spread", "table", "texts", "WordTable"]

#: Bytes a worker's word cache may hold before it is emptied, and what an entry takes beside its values. A cache is
#: only a shortcut: an emptied one is filled again and results do not change.
CACHE_BYTES = 48 << 20
CACHE_ENTRY = 170
#: Words longer than this many bytes are computed each time rather than cached.
CACHE_WORD_BYTES = 48
#: Rows of a key from which its partner is broadcast rather than shuffled, and the number of such keys at most. Further
#: crowded keys are joined like all others.
CROWDED_ROWS = 50_000
CROWDED_KEYS = 4096
#: Bytes of rows that go to a Python worker at once; a longer row goes by itself. Spark's own bound of 64 MB is held several
#: times over by each task: in buffers of the JVM, which double as they grow, and in the worker with what it makes of them.
BATCH_BYTES = 8 << 20

#: Per-worker state by model key. Workers are reused between tasks, so caches and loaded vocabularies stay warm.
_WORKER: dict[str, object] = {}
_BROADCASTS: list[list[Broadcast]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir``, by whatever file system Spark knows."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as the cluster has cores, if its files gave fewer. Results do not depend on it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bound of Arrow batches to ``BATCH_BYTES``. Results do not depend on it. It stays lowered, as what
    an operator returns is computed later."""
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def share(spark: SparkSession, value: object) -> Broadcast:
    """``value`` as a broadcast variable; within ``own_broadcasts`` it is destroyed at the block's end."""
    out = spark.sparkContext.broadcast(value)
    if _BROADCASTS:
        _BROADCASTS[-1].append(out)
    return out


@contextmanager
def own_broadcasts() -> Iterator[None]:
    """Destroys at its end the broadcast variables that were made within: what they serve must be written by then."""
    _BROADCASTS.append([])
    try:
        yield
    finally:
        for held in _BROADCASTS.pop():
            held.destroy()


def cut_few(df: DataFrame) -> DataFrame:
    """``cut`` for rows of a few numbers each: in no more files than two for each core, whatever the number of partitions."""
    return cut(df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism))


def join_crowded(rows: DataFrame, partner: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``partner``, which has one row for each ``key`` (never null). Rows of a crowded key stay where
    they are and meet a broadcast of that key's partner; all others are shuffled."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > CROWDED_ROWS)
    crowded = cut_few(counts.orderBy(F.desc("_n"), key).limit(CROWDED_KEYS).select(key))
    if crowded.isEmpty():
        return rows.join(partner, key)
    few = F.broadcast(crowded)
    rest = rows.join(few, key, "left_anti").join(partner, key)
    return rest.unionByName(rows.join(F.broadcast(partner.join(few, key, "left_semi")), key))


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def per_worker(key: str, make: Callable[[], object]) -> object:
    """The worker's object under ``key``, made on first use. A worker keeps one object only, as tasks of an operator use one."""
    if key not in _WORKER:
        forget()
        _WORKER[key] = make()
    return _WORKER[key]


def forget() -> None:
    """Drops what an earlier operator left in this worker, and gives its memory and that of earlier tasks back to the system."""
    _WORKER.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: its memory is reused, if not returned
        pass


class WordTable:
    """Maps words to rows of a float table that ``score`` fills for words not met before."""

    def __init__(self, score: Callable[[list[bytes]], np.ndarray], width: int):
        self.score, self.width = score, width
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.values = np.zeros((1024, self.width), np.float32)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """A row of values for each word, in order."""
        if len(self.rows) * (CACHE_ENTRY + 4 * self.width) > CACHE_BYTES:
            self.clear()
        rows = self.rows
        at = list(map(rows.get, words))
        new = []
        if None in at:
            gaps = [i for i, x in enumerate(at) if x is None]
            new = list({words[i] for i in gaps})
            first = len(rows)
            rows.update(zip(new, range(first, first + len(new)), strict=True))
            if len(rows) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros((len(rows), self.width), np.float32)])
            self.values[first : len(rows)] = self.score(new)
            for i in gaps:
                at[i] = rows[words[i]]
        out = self.values[np.array(at, np.int64)] if words else self.values[:0]
        if any(len(w) > CACHE_WORD_BYTES for w in new):
            self.clear()
        return out


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, stop, texts) of stretches of a string column of about ``most`` bytes each: only one of them is held as bytes, as
    a batch may have very long texts. Null is the empty text."""
    raw = column.cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(raw):
        before = ends[start] - lengths[start]
        stop = min(int(np.searchsorted(ends, before + most)) + 1, len(raw))
        yield start, stop, texts(raw.slice(start, stop - start))
        start = stop


def by_bytes(items: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``items`` that hold about ``most`` bytes each, so that memory follows the range and not the batch."""
    start = size = 0
    for i, x in enumerate(items):
        size += len(x)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(items):
        yield start, len(items)
