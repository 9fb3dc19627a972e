"""Order-dependent work over whole tables without a task that holds them all: rows are dealt to tasks by ranges, and what one
task needs of those before it is a row each that the driver adds up (as many rows as there are tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _lineage


def numbered(ranged: DataFrame) -> DataFrame:
    """Rows with the number of their range, ``_part``. It is stored with them: a task's own number is another one where
    what is read becomes part of a union or of fewer tasks."""
    return ranged.withColumn("_part", F.spark_partition_id())


def running(df: DataFrame, order: list[str], amount: str, out: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows before each, along ``order`` and apart for each of ``keys``. Keys may be
    as crowded as they like; equal places are taken in any order."""
    mark = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    ranged = _lineage.settle(numbered(df.withColumns({"_key": mark, "_amount": F.col(amount).cast("double")}).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)))
    at = F.monotonically_increasing_id()
    sums = ranged.select("_part", at.alias("at"), "_key", "_amount").groupBy("_part", "_key").agg(F.sum("_amount").alias("s"), F.min("at").alias("a"), F.max("at").alias("b"))
    ends = sums.groupBy("_part").agg(F.min_by("_key", "a").alias("first"), F.max_by("_key", "b").alias("last"), F.max_by("s", "b").alias("s"), F.count("*").alias("n")).orderBy("_part").collect()
    carry, held = {}, (None, 0.0)
    for r in ends:
        carry[r["_part"]] = held[1] if held[0] == r["first"] else 0.0
        held = r["last"], r["s"] + (carry[r["_part"]] if r["n"] == 1 else 0.0)
    kind, names = dict(df.dtypes)[amount], df.columns
    whole = not kind.startswith(("double", "float", "decimal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            part, key, x = batch["_part"].to_numpy(), batch["_key"].to_numpy(), batch["_amount"].to_numpy(zero_copy_only=False)
            fresh = np.append(now is None or part[0] != now[0], part[1:] != part[:-1])
            starts = np.flatnonzero(fresh | np.append(now is not None and key[0] != now[1], key[1:] != key[:-1]))
            before = np.cumsum(x) - x
            base = np.full(len(x), total)
            if len(starts):
                begin = np.where(fresh[starts], [carry.get(p, 0.0) for p in part[starts].tolist()], 0.0) - before[starts]
                base[starts[0] :] = np.repeat(begin, np.diff(np.append(starts, len(x))))
            before = before + base
            now, total = (part[-1], key[-1]), float(before[-1] + x[-1])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(np.rint(before).astype(np.int64) if whole else before)], [*names, out])

    types = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return ranged.mapInArrow(run, f"{types}, `{out}` {'long' if whole else 'double'}")


def percentiles(df: DataFrame, value: str, shares: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, n, q): the linear percentiles of a column, an array in the order of ``shares``; null and NaN are left out. Ranks
    come from counts of distinct values, so no key's values are gathered."""
    x = F.col(value).cast("double")
    counts = df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, x.alias("_v")).agg(F.count("*").alias("_c"))
    placed = running(counts, ["_v"], "_c", "_before", keys)
    held = [F.col(k) for k in keys]
    n = counts.groupBy(*(c.alias(f"_k{i}") for i, c in enumerate(held))).agg(F.sum("_c").alias("n"))
    match = F.lit(True)
    for i, c in enumerate(held):
        match = match & c.eqNullSafe(F.col(f"_k{i}"))
    both = placed.join(n, match)
    picks = []
    for i, share in enumerate(shares):
        place = (F.col("n") - 1) * share
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picks.append(F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")), F.col("_v"))).alias(f"{side}{i}"))
    out = both.groupBy(*keys).agg(F.max("n").alias("n"), *picks)
    between = lambda i, share: F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * ((F.col("n") - 1) * share - F.floor((F.col("n") - 1) * share))
    return out.select(*keys, "n", F.array(*(between(i, s) for i, s in enumerate(shares))).alias("q"))


def by_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted by ranges, on disk: ranges in the order of ``_part`` hold ascending stretches of it."""
    return _lineage.settle(numbered(df.repartitionByRange(*order).sortWithinPartitions(*order)))
