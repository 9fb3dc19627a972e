"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens. Rounds visit the queues in turn; a visit adds the queue's quantum, its target share of
a window, to the queue's deficit counter, and takes as many whole tokens as the counter holds. What is left of a token
stays in the counter for the next round. A queue that runs dry drops out, and the others go on in their proportions. The
tokens so taken, one after the other, are cut into windows, which therefore hold the sources in target proportions.

Counters are whole numbers (65,536ths of a token), so what a queue has been served after any round follows from the
round's number alone. Deficits carry across windows and partitions without one task waiting for another.

A source that is owed less than a 256th of a window would give pieces of a few tokens. All such sources take turns in one
more queue, the tail: a turn is ``TURN`` tokens, and turns go in the order in which the sources' own counters reach them.
So each window holds the tail's share, and the tail's sources follow in proportion to their weights, however many they are.

Places in a queue follow from the data, not from tasks: documents are dealt to slots by a hash, and go by doc_id in a slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared, tokens

#: A source owed at least one so-manieth of a window has a queue of its own: there can be no more of them.
MOST_QUEUES = 256
#: Tokens of a tail source's turn.
TURN = 256
#: A token in units of the deficit counters, as a power of two.
UNIT_BITS = 16
#: Documents of a slot, about; slots are a power of two, so many that one holds the places of a bounded stretch.
SLOT_DOCUMENTS = 256
MOST_SLOTS = 1 << 20
#: Weights are counted in units of the largest one over this.
WEIGHT_UNITS = 1 << 32
#: Rounds whose counters are computed at once.
_ROUNDS = 4096

_ENCODED = "doc_id long, source string, mark long, n_tokens long, ids binary"
_PLACED = "doc_id long, source string, queue int, first long, start long, length long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, queue int"


def _names(schema: str) -> list[str]:
    return [x.split()[0].strip("`") for x in schema.split(", ")]


def _encode(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press = tokens.encoder(path), zstandard.ZstdCompressor(1).compress
        end = b"" if end_id is None else np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            for i, j, docs in _shared.slices(batch["text"]):
                ids = [x + end for x in encode.encode(docs)]
                n = [len(x) // encode.dtype.itemsize for x in ids]
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(i, j - i) for c in ("doc_id", "source", "mark")), pa.array(n, pa.int64()), pa.array(map(press, ids), pa.binary())], _names(_ENCODED))

    return run


# --- the schedule -----------------------------------------------------------------------------------------------------


def quantum(weight: int, all_weights: int, window: int) -> int:
    """A queue's share of a window, in units of the deficit counters; one at least, so that no queue waits for ever."""
    return max(1, (weight * window << UNIT_BITS) // all_weights)


class Schedule:
    """Deficit round-robin of at most ``MOST_QUEUES`` + 1 queues: what each has been served after how many rounds."""

    def __init__(self, totals: list[int], quanta: list[int], packets: list[int] | None = None):
        """``packets``: the tokens that a queue gives at once; its deficit waits until it holds so many."""
        self.n, self.quantum = np.array(totals, np.int64), np.array(quanta, np.int64)
        self.packet = np.ones(len(totals), np.int64) if packets is None else np.array(packets, np.int64)
        #: The round in which a queue runs dry; beyond it nothing changes, so products stay small.
        self.dry = np.array([self.round_of(q, np.array([n - 1]))[0] if n else 0 for q, n in enumerate(self.n.tolist())])

    def round_of(self, queue: int, token: np.ndarray) -> np.ndarray:
        """The round, from 1, that takes a queue's tokens."""
        size, quantum = int(self.packet[queue]), int(self.quantum[queue])
        return -(-(((token // size + 1) * size) << UNIT_BITS) // quantum)

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that so many rounds have taken from each queue, a row for each entry."""
        counted = (np.minimum(rounds[:, None], self.dry) * self.quantum) >> UNIT_BITS
        return np.minimum(self.n, counted // self.packet * self.packet)

    def stretches(self, queue: int, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """For stretches of a queue's tokens: (index, first token, tokens, place in all that is served) of the parts that
        one round takes each."""
        low, high = self.round_of(queue, first), self.round_of(queue, first + n - 1)
        times = high - low + 1
        index = np.repeat(np.arange(len(n)), times)
        rounds = np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times) + low[index]
        begin, stop, place = (np.empty(len(index), np.int64) for _ in range(3))
        for i in range(0, len(index), _ROUNDS):
            part = slice(i, i + _ROUNDS)
            now, row = np.unique(rounds[part], return_inverse=True)
            before, after = self.served(now - 1), self.served(now)
            ahead = before.sum(axis=1) + (after[:, :queue] - before[:, :queue]).sum(axis=1)
            begin[part] = np.maximum(first[index[part]], before[row, queue])
            stop[part] = np.minimum((first + n)[index[part]], after[row, queue])
            place[part] = ahead[row] + begin[part] - before[row, queue]
        taken = stop > begin
        return index[taken], begin[taken], (stop - begin)[taken], place[taken]


def _cut_into_windows(index: np.ndarray, begin: np.ndarray, length: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Parts cut at the windows' edges; those that follow each other in text and window alike are one."""
    low, high = place // window, (place + length - 1) // window
    times = high - low + 1
    at = np.repeat(np.arange(len(place)), times)
    number = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + low[at]
    left, right = np.maximum(place[at], number * window), np.minimum((place + length)[at], (number + 1) * window)
    begin, index, length, offset = begin[at] + left - place[at], index[at], right - left, left - number * window
    new = np.ones(len(at), bool)
    new[1:] = (index[1:] != index[:-1]) | (number[1:] != number[:-1]) | (offset[1:] != offset[:-1] + length[:-1]) | (begin[1:] != begin[:-1] + length[:-1])
    starts = np.flatnonzero(new)
    return index[starts], begin[starts], np.add.reduceat(length, starts) if len(starts) else length, number[starts], offset[starts]


# --- places in queues -------------------------------------------------------------------------------------------------


def _place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole slots, in each first the sources' queues and places and then documents in order, to documents with
    their first token's place in their source's queue."""
    now, places = None, {}
    for batch in rows:
        columns = {c: batch[c].to_pylist() for c in ("slot", "source", "queue", "base", "n_tokens")}
        documents, queues, firsts = [], [], []
        for i, (slot, source, queue, base, n) in enumerate(zip(*columns.values(), strict=True)):
            if slot != now:
                now, places = slot, {}
            if base is not None:
                places[source] = [queue, base]
            elif n:
                at = places[source]
                documents.append(i)
                queues.append(at[0])
                firsts.append(at[1])
                at[1] += n
        if documents:
            kept = batch.take(pa.array(documents))
            n = kept["n_tokens"]
            yield pa.RecordBatch.from_arrays([kept["doc_id"], kept["source"], pa.array(queues, pa.int32()), pa.array(firsts, pa.int64()), pa.array(np.zeros(len(documents), np.int64)), n, n, kept["ids"]], _names(_PLACED))


def _in_order(encoded: DataFrame, bases: DataFrame, tasks: int) -> DataFrame:
    """The input of ``_place``: a slot's rows in one task, sorted."""
    docs = encoded.select("slot", "source", F.lit(None).cast("int").alias("queue"), F.lit(None).cast("long").alias("base"), "doc_id", "mark", "n_tokens", "ids")
    heads = bases.select("slot", "source", "queue", "base", *(F.lit(None).cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("mark", "long"), ("n_tokens", "long"), ("ids", "binary"))))
    return docs.unionByName(heads).repartition(tasks, "slot").sortWithinPartitions("slot", F.col("base").isNull(), "doc_id", "mark", "source")


def _pieces(schedule: Schedule, window: int, dtype: np.dtype):
    """Rows of documents' stretches to pieces in windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _shared.forget()
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            queues = batch["queue"].to_numpy()
            first, start, n = (batch[c].to_numpy() for c in ("first", "start", "length"))
            for queue in np.unique(queues).tolist():
                rows = np.flatnonzero(queues == queue)
                index, begin, length, number, offset = _cut_into_windows(*schedule.stretches(queue, first[rows], n[rows]), window)
                inside = begin - first[rows][index]
                crc, at = np.empty(len(index), np.int64), -1
                for p, (d, s, m) in enumerate(zip(index.tolist(), inside.tolist(), length.tolist(), strict=True)):
                    if d != at:
                        at, ids = d, memoryview(np.frombuffer(unpress(batch["ids"][int(rows[d])].as_py()), dtype).astype("<u4")).cast("B")
                    crc[p] = zlib.crc32(ids[4 * s : 4 * (s + m)])
                own = pa.array(rows[index])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(own), *(pa.array(x) for x in (start[rows][index] + inside, length, crc)), batch["doc_tokens"].take(own), pa.array(number), pa.array(offset), pa.array(np.full(len(index), queue, np.int32))], _names(_PIECES)
                )

    return run


# --- the tail ---------------------------------------------------------------------------------------------------------


def _turns(sources: DataFrame) -> DataFrame:
    """(source, turn, tokens, due) of each turn of each tail source: due is when its counter reaches the turn's end."""
    blocks = sources.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / (TURN << 16)))))
    last = F.least(F.floor((F.col("tokens") - 1) / TURN), F.col("block") * 65536 + 65535)
    each = blocks.withColumn("turn", F.explode(F.sequence(F.col("block") * 65536, last)))
    return each.select("source", "turn", F.least(F.lit(TURN).cast("long"), F.col("tokens") - F.col("turn") * TURN).alias("length"), ((F.col("turn") + 1) * TURN / F.col("weight")).alias("due"))


def _turn_places(sources: DataFrame, tasks: int) -> DataFrame:
    """(of_source, of_turn, place): where in the tail each turn begins. Turns are sorted by ranges, and a running sum goes
    through each range from where the ranges before it end."""
    ranged = _shared.cut(_turns(sources).repartitionByRange(tasks, "due", "source", "turn").sortWithinPartitions("due", "source", "turn"))
    sums = {r[0]: r[1] for r in ranged.groupBy(F.spark_partition_id()).agg(F.sum("length")).collect()}  # a row for each task
    bases, total = {}, 0
    for part in sorted(sums):
        bases[part] = total
        total += sums[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = bases.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            n = batch["length"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["source"], batch["turn"], pa.array(at + np.cumsum(n) - n)], ["of_source", "of_turn", "place"])
            at += int(n.sum())

    return ranged.select("source", "turn", "length").mapInArrow(run, "of_source string, of_turn long, place long")


def _cut_into_turns(dtype: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress, press = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(1).compress
        for placed in _place(batches):
            for doc_id, source, first, n, ids in zip(*(placed[c].to_pylist() for c in ("doc_id", "source", "first", "length", "ids")), strict=True):
                raw, size = unpress(ids), dtype.itemsize
                starts = np.array([0, *range(TURN - first % TURN, n, TURN)])
                stops = np.append(starts[1:], n)
                k = len(starts)
                parts = [press(raw[a * size : b * size]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * k, pa.int64()), pa.array([source] * k, pa.string()), pa.array((first + starts) // TURN), pa.array((first + starts) % TURN), pa.array(starts), pa.array(stops - starts), pa.array([n] * k, pa.int64()), pa.array(parts, pa.binary())],
                    ["doc_id", "source", "turn", "inside", "start", "length", "doc_tokens", "ids"],
                )

    return run


def _tail(encoded: DataFrame, bases: DataFrame, sources: DataFrame, queue: int, tasks: int, dtype: np.dtype) -> DataFrame:
    """The tail sources' documents cut by turns, each at its place in the tail's queue."""
    parts = _in_order(encoded, bases, tasks).mapInArrow(_cut_into_turns(dtype), "doc_id long, source string, turn long, inside long, start long, length long, doc_tokens long, ids binary")
    places = _turn_places(sources, tasks)
    joined = parts.join(places, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("turn") == F.col("of_turn")))
    return joined.select("doc_id", "source", F.lit(queue).alias("queue"), (F.col("place") + F.col("inside")).alias("first"), "start", "length", "doc_tokens", "ids")


# --- packing ----------------------------------------------------------------------------------------------------------


def _weight(spark, weights: dict[str | None, float] | None, sources: DataFrame) -> DataFrame:
    """``sources`` (source, tokens) with each one's weight as a whole number."""
    if weights is None:
        return sources.withColumn("weight", F.col("tokens"))
    if min(weights.values(), default=1) <= 0:
        raise ValueError("weights must be positive: every document is packed")
    top = max([1.0, *weights.values()])
    units = lambda w: max(1, round(w / top * WEIGHT_UNITS))
    given = spark.createDataFrame([(k, units(w)) for k, w in weights.items()], "of_source string, units long")
    return sources.join(given, F.col("source").eqNullSafe(F.col("of_source")), "left").select("source", "tokens", F.coalesce("units", F.lit(units(1.0))).alias("weight"))


def pack_by_mixture(docs: DataFrame, *, weights: dict[str | None, float] | None = None, window: int = 4096, end_id: int | None = 2, tokenizer: str | None = None) -> DataFrame:
    """Cuts every document's ids (its text's, then ``end_id``) into windows that hold the sources in target proportions.

    ``weights`` maps sources to target shares (sources it lacks get 1); by default a source's share is its share of all
    tokens, so that each window mirrors the corpus. Every id lies in exactly one piece, and every window but the last
    holds ``window`` ids. Returns a row for each piece; ``start`` counts in the document, ``offset`` in the window, and
    ``queue`` numbers the sources that have a queue of their own, largest first, and last the tail.

    The same documents give the same pieces on any cluster. Null text is the empty text; with ``end_id`` it has one
    token, without one it has no piece. Null sources form a source of their own. Rows repeated or with a null doc_id are
    packed as often as they stand there. Other columns are ignored. An empty table gives no rows.
    """
    spark, path = docs.sparkSession, tokenizer or tokens.vocabulary()
    dtype = tokens.WordEncoder(path).dtype
    text = F.col("text").cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"), text.alias("text"))
    encoded = _shared.cut(given.mapInArrow(_encode(path, end_id), _ENCODED))
    rows, size = encoded.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    if not size:
        return spark.createDataFrame([], _PIECES)
    slots = min(MOST_SLOTS, max(64, 1 << (rows // SLOT_DOCUMENTS).bit_length()))
    encoded = encoded.withColumn("slot", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(slots)))
    per_slot = _shared.cut(encoded.groupBy("source", "slot").agg(F.sum("n_tokens").alias("tokens")))
    sources = _shared.cut(_weight(spark, weights, per_slot.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")))
    all_weights = sources.agg(F.sum("weight")).first()[0]
    owed = F.col("weight").cast("decimal(38, 0)") * MOST_QUEUES >= F.lit(all_weights).cast("decimal(38, 0)")
    # At most MOST_QUEUES rows, as their shares add up to one at most.
    own = sources.where(owed).orderBy(F.desc("tokens"), F.col("source").asc_nulls_first()).collect()
    rest = sources.where(~owed).agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    totals, quanta, packets = [r["tokens"] for r in own], [quantum(r["weight"], all_weights, window) for r in own], [1] * len(own)
    if rest[0]:
        totals.append(rest[0])
        quanta.append(quantum(rest[1], all_weights, window))
        packets.append(1 if quanta[-1] >> UNIT_BITS >= min(TURN, window // MOST_QUEUES) else TURN)
    schedule = Schedule(totals, quanta, packets)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (1 << 26))
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_slot.select("source", "slot", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    named = F.broadcast(spark.createDataFrame([(r["source"], k) for k, r in enumerate(own)], "name string, queue int"))
    is_own: Column = F.col("source").eqNullSafe(F.col("name"))
    run = _pieces(schedule, window, dtype)
    out = _in_order(encoded.join(named, is_own, "left_semi"), bases.join(named, is_own).drop("name"), tasks).mapInArrow(lambda batches: run(_place(batches)), _PIECES)
    if not rest[0]:
        return out
    tail = _tail(encoded.join(named, is_own, "left_anti"), bases.join(named, is_own, "left_anti").withColumn("queue", F.lit(-1)), sources.where(~owed), len(own), tasks, dtype)
    return out.unionByName(tail.mapInArrow(run, _PIECES))
