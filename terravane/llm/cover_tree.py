"""Exact top-k inner products by dual-tree search of cover trees.

Queries and data are indexed alike: vectors are dealt to cells of near pivots (a bounded, documented sample; it decides
only who is with whom, never what is found), cells are cut into blocks of bounded size, and a block's vectors and its
queries each get a cover tree. A search walks pairs of nodes, one of either tree, best bound first. If centres q, c have
covering radii s, r, no pair below has a product above q.c + s|c| + r|q| + s*r; the node pair is pruned when that is
under the worst kth score of the query group. Query groups and block groups form a grid of tasks, whose partial answers
are merged by query.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared

#: Vectors of a block at most, of a tree's leaf at most, and centres of a node at most.
BLOCK_ROWS = 8192
LEAF_ROWS = 256
MOST_CENTRES = 64
#: Pivots at most, drawn from this many rows at most.
MOST_PIVOTS = 1024
PIVOT_SAMPLE = 20_000
#: Queries of a query group, about.
GROUP_QUERIES = 4096
#: If the norms' product is no greater, every sum on the way to an inner product is exact in double precision; up to the
#: second limit it is exact in whole numbers of 64 bits.
EXACT = float(1 << 53)
LARGEST = float(1 << 62)


class CoverTree:
    """A cover tree over rows of ``points``; rows are reordered so that a node's are a range.

    A node covers its rows by a radius around its centre. Its children halve the radius, and their centres are further
    apart than that; the first child keeps the centre. Children of few rows are gathered in leaves around the centre.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.leaf = leaf
        self.nodes: list[tuple[int, int, float, tuple[int, ...]]] = []  # start, stop, radius, children
        self.centres: list[np.ndarray] = []
        self._order: list[np.ndarray] = []
        self._placed = 0
        if len(points):
            middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
            away = np.sqrt(((points - points[middle]) ** 2).sum(axis=1))
            self._build(points, np.arange(len(points)), points[middle], away)
        order = np.concatenate(self._order) if self._order else np.zeros(0, np.int64)
        self.points, self.ids = points[order], ids[order]
        self.centre = np.array(self.centres).reshape(len(self.nodes), points.shape[1])
        self.norm = np.sqrt((self.centre**2).sum(axis=1))
        self.radius = np.array([n[2] for n in self.nodes])

    def _node(self, start: int, stop: int, centre: np.ndarray, radius: float, children: tuple[int, ...]) -> int:
        self.nodes.append((start, stop, radius, children))
        self.centres.append(centre)
        return len(self.nodes) - 1

    def _leaf(self, rows: np.ndarray, centre: np.ndarray, away: np.ndarray) -> int:
        self._order.append(rows)
        self._placed += len(rows)
        return self._node(self._placed - len(rows), self._placed, centre, float(away.max()), ())

    def _build(self, points: np.ndarray, rows: np.ndarray, centre: np.ndarray, away: np.ndarray) -> int:
        radius = float(away.max())
        if len(rows) <= self.leaf:
            return self._leaf(rows, centre, away)
        start, children, rest = self._placed, [], []
        if radius > 0:
            new, left, left_away, own_away = centre, np.arange(len(rows)), away, away
            for k in range(MOST_CENTRES):
                near = own_away <= radius / 2
                if near.sum() > self.leaf // 4 and near.sum() < len(rows):
                    children.append(self._build(points, rows[left[near]], new, own_away[near]))
                else:
                    rest.append(left[near])
                left, left_away = left[~near], left_away[~near]
                if not len(left):
                    break
                new = points[rows[left[left_away.argmax() if k % 2 else 0]]]
                own_away = np.sqrt(((points[rows[left]] - new) ** 2).sum(axis=1))
            rest.append(left)
        else:
            rest.append(np.arange(len(rows)))
        few = np.concatenate(rest)
        few = few[np.argsort(away[few], kind="stable")]
        for i in range(0, len(few), self.leaf):
            part = few[i : i + self.leaf]
            children.append(self._leaf(rows[part], centre, away[part]))
        return self._node(start, self._placed, centre, radius, tuple(children))

    def dump(self) -> bytes:
        out = io.BytesIO()
        flat = [c for n in self.nodes for c in n[3]]
        np.savez(out, points=_narrow(self.points), ids=self.ids, centre=self.centre, radius=self.radius, span=np.array([n[:2] for n in self.nodes]).reshape(-1, 2), degree=np.array([len(n[3]) for n in self.nodes]), children=np.array(flat, np.int64))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        self, z = cls.__new__(cls), np.load(io.BytesIO(data))
        self.points, self.ids, self.centre, self.radius = z["points"].astype(np.float64), z["ids"], z["centre"], z["radius"]
        self.norm = np.sqrt((self.centre**2).sum(axis=1))
        children, stop = z["children"].tolist(), np.cumsum(z["degree"]).tolist()
        self.nodes = [(a, b, r, tuple(children[e - d : e])) for (a, b), r, d, e in zip(z["span"].tolist(), self.radius.tolist(), z["degree"].tolist(), stop, strict=True)]
        return self


def _narrow(points: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    for kind in (np.int16, np.int32):
        if np.abs(points).max(initial=0) <= np.iinfo(kind).max:
            return points.astype(kind)
    return points


class BestK:
    """The k best (score, id) of each query of a tree: higher scores first, smaller ids among equal ones. ``whole``: scores
    are 64-bit whole numbers, for products beyond what double precision holds."""

    def __init__(self, queries: CoverTree, k: int, whole: bool = False):
        self.k, self.ids, self.whole = k, queries.ids, whole
        self.none = np.iinfo(np.int64).min if whole else -np.inf
        self.score = np.full((len(self.ids), k), self.none)
        self.found = np.full((len(self.ids), k), np.iinfo(np.int64).max)

    def products(self, queries: np.ndarray, data: np.ndarray) -> np.ndarray:
        return queries.astype(np.int64) @ data.astype(np.int64).T if self.whole else queries @ data.T

    def offer(self, start: int, stop: int, scores: np.ndarray, ids: np.ndarray) -> None:
        worst, last = self.score[start:stop, -1:], self.found[start:stop, -1:]
        better = (scores > worst) | (scores == worst) & (ids < last)
        better &= ids != self.ids[start:stop, None]
        if not better.any():
            return
        counts = better.sum(axis=1)
        if counts.max() > 2 * self.k:  # keep what can be among a query's best, ties included
            part = np.where(better, scores, self.none)
            least = np.partition(part, part.shape[1] - self.k, axis=1)[:, part.shape[1] - self.k, None] if part.shape[1] > self.k else self.none
            better &= scores >= least
        row, col = np.nonzero(better)
        touched = np.unique(row)
        held = np.repeat(touched, self.k)
        rows = np.concatenate([held, row])
        score = np.concatenate([self.score[start + touched].ravel(), scores[row, col]])
        found = np.concatenate([self.found[start + touched].ravel(), ids[col]])
        order = np.lexsort((found, ~score if self.whole else -score, rows))  # ~ falls as its number rises, the least one too
        rows, score, found = rows[order], score[order], found[order]
        first = np.searchsorted(rows, touched)
        take = first[:, None] + np.arange(self.k)
        self.score[start + touched], self.found[start + touched] = score[take], found[take]


def search(queries: CoverTree, data: CoverTree, best: BestK) -> int:
    """Adds to ``best`` what ``data`` holds for ``queries``. Returns the number of leaf pairs that were compared."""
    if not queries.nodes or not data.nodes:
        return 0
    compared = 0

    def bounds(qs: list[int], cs: list[int]) -> np.ndarray:
        q, c = np.array(qs), np.array(cs)
        exact = np.einsum("ij,ij->i", queries.centre[q], data.centre[c])
        return exact + queries.radius[q] * data.norm[c] + data.radius[c] * queries.norm[q] + queries.radius[q] * data.radius[c]

    roots = len(queries.nodes) - 1, len(data.nodes) - 1
    stack = [(float(bounds([roots[0]], [roots[1]])[0]), *roots)]
    while stack:
        bound, q, c = stack.pop()
        start, stop, s, below = queries.nodes[q]
        if bound + abs(bound) * 1e-12 + 1e-6 < best.score[start:stop, -1].min():  # beyond what rounding may have taken
            continue
        first, last, r, under = data.nodes[c]
        if not below and not under:
            compared += 1
            best.offer(start, stop, best.products(queries.points[start:stop], data.points[first:last]), data.ids[first:last])
            continue
        if under and (r >= s or not below):
            pairs = [(q, x) for x in under]
        else:
            pairs = [(x, c) for x in below]
        limit = bounds([a for a, _ in pairs], [b for _, b in pairs])
        stack.extend((float(limit[i]), *pairs[i]) for i in np.argsort(limit, kind="stable").tolist())
    return compared


def _cells(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cell = batch["dims"].to_numpy(), np.zeros(batch.num_rows, np.int32)
            values = batch["vec"].flatten().to_numpy()
            start = np.cumsum(dims) - dims
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                if d in pivots and len(pivots[d]) > 1:
                    for i in range(0, len(rows), 2000):
                        x = values[start[rows[i : i + 2000], None] + np.arange(d)]
                        cell[rows[i : i + 2000]] = ((pivots[d] ** 2).sum(axis=1) - 2 * x @ pivots[d].T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["dims"], batch["vec"], batch["is_query"], pa.array(cell)], ["vec_id", "dims", "vec", "is_query", "cell"])

    return run


def _trees(table: pa.Table) -> pa.Table:
    """The vectors of a block to its trees, of all of them and of its queries."""
    table = table.combine_chunks()
    d = table["dims"][0].as_py()
    points = np.asarray(table["vec"].combine_chunks().flatten(), np.float64).reshape(table.num_rows, d)
    ids, wanted = table["vec_id"].to_numpy(), table["is_query"].to_numpy()
    queries = CoverTree(points[wanted], ids[wanted], 64) if wanted.any() else None
    return pa.table({"dims": pa.array([d], pa.int32()), "cell": table["cell"][:1], "salt": table["salt"][:1], "data": pa.array([CoverTree(points, ids).dump()], pa.binary()), "queries": pa.array([queries and queries.dump()], pa.binary())})


def _search_groups(k: int, whole: bool):
    """(group, dims, tree, is_query) rows of whole groups, queries first, to partial answers."""

    def answers(trees: list[CoverTree], best: list[BestK]) -> Iterator[pa.RecordBatch]:
        for b in best:
            row, rank = np.nonzero(b.score != b.none)
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(b.ids[row]), pa.array(b.found[row, rank]), pa.array(b.score[row, rank].astype(np.int64))], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees, best = None, [], []
        for batch in batches:
            for group, dims, is_query, blob in zip(batch["group"].to_pylist(), batch["dims"].to_pylist(), batch["is_query"].to_pylist(), batch["tree"], strict=True):
                if (group, dims) != now:
                    yield from answers(trees, best)
                    now, trees, best = (group, dims), [], []
                tree = CoverTree.load(blob.as_py())
                if is_query:
                    trees.append(tree)
                    best.append(BestK(tree, k, whole))
                else:
                    for q, b in zip(trees, best, strict=True):
                        search(q, tree, b)
        yield from answers(trees, best)

    return run


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: float = 64.0) -> DataFrame:
    """The k highest integer inner products of each query with every other row, after ``floor(scale * x)`` of each component.

    ``vectors`` has vec_id and embedding (array of numbers); ``is_query`` says of a row whether it is a query. Returns
    query_id, rank from 1, vec_id, score; ties go to the smaller vec_id; fewer than k rows where there are fewer.

    A row's vector takes no part if it is null or holds a null or non-finite component, or if vec_id is null. Rows that
    repeat a vec_id and its vector count once; rows of the query's own vec_id are never among its answers. Vectors of
    different lengths do not meet. Components are doubles; vectors whose norms' product is beyond 2**62 raise
    OverflowError. Other columns are ignored.
    """
    spark = vectors.sparkSession
    vec = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    finite = ~F.exists(F.col("embedding").cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    given = given.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    given = _shared.cut(given.groupBy("vec_id", "vec").agg(F.max("is_query").alias("is_query")).withColumn("dims", F.size("vec")))
    by_length = _shared.cut(given.groupBy("dims").agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("q")))
    rows, n_queries = by_length.agg(F.sum("n"), F.sum("q")).first()
    if not rows:
        return spark.createDataFrame([], "query_id long, `rank` int, vec_id long, score long")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    largest, asking = given.agg(F.max(norm), F.max(F.when(F.col("is_query"), norm))).first()
    if largest * (asking or 0.0) > LARGEST:
        raise OverflowError("an inner product may be beyond 2**62")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows * n_queries // (1 << 34))
    most = min(BLOCK_ROWS, max(LEAF_ROWS, rows // (4 * tasks)))
    # Pivots are a sample by hash, of a size that does not depend on the number of rows.
    part = int((1 << 30) * min(1.0, PIVOT_SAMPLE / rows))
    drawn = given.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < part).join(by_length, "dims")
    turn = F.row_number().over(Window.partitionBy("dims").orderBy(F.xxhash64("vec_id"), "vec_id"))
    drawn = drawn.select("dims", "vec", F.xxhash64("vec_id").alias("h"), turn.alias("k"), F.greatest(F.lit(1), F.floor(F.col("n") / most)).alias("wanted"))
    pivots: dict[int, list] = {}
    for r in drawn.where("k <= wanted").orderBy("h", "vec").limit(MOST_PIVOTS).select("dims", "vec").collect():
        pivots.setdefault(r["dims"], []).append(r["vec"])
    placed = _shared.cut(given.select("vec_id", "dims", "vec", "is_query").mapInArrow(_cells({d: np.array(p, np.float64).reshape(len(p), d) for d, p in pivots.items()}), "vec_id long, dims int, vec array<double>, is_query boolean, cell int"))
    # Cells of more than ``most`` rows: no more than rows / most, some hundred bytes for each block.
    salts = placed.groupBy("dims", "cell").count().where(F.col("count") > most).select("dims", "cell", F.ceil(F.col("count") / most).cast("int").alias("salts"))
    salted = placed.join(salts, ["dims", "cell"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("salts")), F.lit(0)).cast("int")).drop("salts")
    blocks = _shared.cut(salted.select("dims", "cell", "salt", "vec_id", "vec", "is_query").groupBy("dims", "cell", "salt").applyInArrow(_trees, "dims int, cell int, salt int, data binary, queries binary"))
    across = max(math.ceil(n_queries / GROUP_QUERIES), math.ceil(math.sqrt(tasks)))
    along = math.ceil(tasks / across)
    mark = F.xxhash64("dims", "cell", "salt")
    ask = blocks.where("queries is not null").select((F.pmod(mark, F.lit(across)) * along).alias("base"), "dims", "queries").select(F.explode(F.sequence(F.col("base"), F.col("base") + (along - 1))).alias("group"), "dims", F.lit(True).alias("is_query"), F.col("queries").alias("tree"))
    hold = blocks.select(F.pmod(F.xxhash64("cell", "salt", "dims"), F.lit(along)).alias("at"), "dims", "data").select(F.explode(F.sequence(F.col("at"), F.col("at") + (across - 1) * along, F.lit(along))).alias("group"), "dims", F.lit(False).alias("is_query"), F.col("data").alias("tree"))
    grid = ask.union(hold).repartition(tasks, "group").sortWithinPartitions("group", "dims", F.desc("is_query"))
    partial = grid.select("group", "dims", "is_query", "tree").mapInArrow(_search_groups(k, largest * (asking or 0.0) > EXACT), "query_id long, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = partial.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(by_query))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
