"""Connected components of links between keys: by one task where links are few, else by hooking and contraction with joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

#: Links, 16 bytes each, that one task connects.
FEW_LINKS = 1_000_000


def component_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of links, in order, and for each the place in that order of its component's smallest one."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[: len(a)], number[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    while (label[label] != label).any():
        label = label[label]
    return nodes, label


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(batch["a"].to_numpy(), batch["b"].to_numpy()) for batch in batches]
    if held:
        nodes, label = component_labels(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "root"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b: whole numbers), root being the component's smallest node.

    Up to ``FEW_LINKS`` links go to one task. Beyond, in rounds, nothing is gathered.
    Each round hooks every root to its smallest neighbour, follows the hooks to their ends and replaces the links by
    those between different roots, once each. Roots without a smaller neighbour stay; the number of links falls
    with every round, and so does the number of rounds needed: about the logarithm of the longest chain.
    Links from a node to itself, repeated and reversed links do no harm; links with a null end are ignored.
    """
    links = _shared.cut_few(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null"))
    if links.limit(FEW_LINKS + 1).count() <= FEW_LINKS:
        return _shared.cut_few(links.repartition(1).mapInArrow(_in_one_task, "node long, root long"))
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    root = _shared.cut_few(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
    root = _followed(root)
    while True:
        links = _shared.cut_few(_contracted(links, root).distinct())
        if links.isEmpty():
            return root
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hooks = _followed(_shared.cut_few(hooks))
        hop = hooks.select(F.col("node").alias("old"), F.col("root").alias("new"))
        root = _shared.cut_few(root.join(hop, root["root"] == hop["old"], "left").select("node", F.coalesce("new", "root").alias("root")))


def _contracted(links: DataFrame, root: DataFrame) -> DataFrame:
    one, two = root.select(F.col("node").alias("a"), F.col("root").alias("ra")), root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
    return ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _followed(root: DataFrame) -> DataFrame:
    """Each node with the end of its chain of hooks, by doubling."""
    while True:
        up = root.select(F.col("node").alias("up"), F.col("root").alias("end"))
        moved = _shared.cut_few(root.join(up, root["root"] == up["up"], "left").select("node", F.coalesce("end", "root").alias("root"), (F.coalesce("end", "root") != F.col("root")).alias("moved")))
        root = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return root
