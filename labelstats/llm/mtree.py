"""Exact top-k by inner product: best-first search in paged metric trees.

Vectors of whole numbers are dealt to groups by a hash; each group is an M-tree. A page holds
entries with their distances to the page's routing object; pages above hold routing objects
with covering radii. For the largest inner product to be the least distance, a vector x gets
one more coordinate, sqrt(M - |x|^2) with M the largest squared length in the tree, and a query
gets zero there. Search takes pages in order of their least possible distance. By the triangle
inequality, entries and pages whose stored distances show that they are too far away are left
out before any distance to them is computed. Bounds are loosened by rounding errors and scores
are exact integers, so the result is that of comparing all.

A bounded sample of the vectors (``SEEDS``) gives each query a first bound; it only saves
work. Of equal vectors only the ``k + 1`` smallest ids can be among the results, so the rest
are dropped before the shuffle: no vector is hot. A task holds one group and reads the queries
in batches.

Defined results: vectors that are null, or hold a null or a component that is not finite, and
rows without an id take no part. Rows that repeat an id and its vector count once. Vectors
meet those of their own length only. Ties go to the smaller id. Components and scores beyond
64 bits stop at the largest. Queries with fewer than k candidates get all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PAGE = 128
FAN = 16
#: Vectors of a group, at most on average; small tables are cut finer, for more tasks.
GROUP = 1 << 18
SMALL_GROUP, SMALL_GROUPS = 2048, 48
SEEDS = 2048
#: Queries that are searched together.
TOGETHER = 512
EXACT = float(1 << 53)
LEAST = -(1 << 63)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices, exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return np.array([[min(max(int(v), LEAST), -LEAST - 1) for v in row] for row in wide], np.int64).reshape(
        len(a), len(b)
    )


class Node:
    """A page: its routing object, covering radius, and distance to the object above."""

    __slots__ = ("routing", "radius", "above", "children", "entries", "apart")

    def __init__(self, routing: int, radius: float) -> None:
        self.routing, self.radius, self.above = routing, radius, 0.0
        self.children: list[Node] = []
        self.entries = self.apart = None


class MTree:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, page: int = PAGE, fan: int = FAN) -> None:
        self.vectors, self.ids = vectors, ids
        wide = vectors.astype(np.float64)
        squares = (wide**2).sum(axis=1)
        self.largest = float(squares.max(initial=0.0))
        self.points = np.column_stack([wide, np.sqrt(np.maximum(self.largest - squares, 0))])
        nodes = [self.leaf(part) for part in self.parts(np.arange(len(ids)), page)]
        while len(nodes) > 1:
            nodes = [self.parent(nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        self.root = nodes[0]

    def far(self, place: int, among: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[among] - self.points[place]) ** 2).sum(axis=1))

    def parts(self, members: np.ndarray, page: int) -> Iterator[np.ndarray]:
        """Pages of near points: halves by the difference of distances to two far points."""
        waiting = [members]
        while waiting:
            part = waiting.pop()
            if len(part) <= page:
                yield part
                continue
            centre = ((self.points[part] - self.points[part].mean(axis=0)) ** 2).sum(axis=1)
            one = part[np.argmax(centre)]
            first = self.far(one, part)
            second = self.far(part[np.argmax(first)], part)
            order = np.argsort(first - second, kind="stable")
            waiting += [part[order[len(part) // 2 :]], part[order[: len(part) // 2]]]

    def middle(self, members: np.ndarray) -> int:
        return int(members[np.argmin(((self.points[members] - self.points[members].mean(axis=0)) ** 2).sum(axis=1))])

    def leaf(self, members: np.ndarray) -> Node:
        routing = self.middle(members)
        apart = self.far(routing, members)
        node = Node(routing, float(apart.max()))
        node.entries, node.apart = members, apart
        return node

    def parent(self, children: list[Node]) -> Node:
        members = np.array([c.routing for c in children])
        routing = self.middle(members)
        apart = self.far(routing, members)
        node = Node(routing, float(max(d + c.radius for d, c in zip(apart, children))))
        for d, c in zip(apart.tolist(), children):
            c.above = d
        node.children, node.apart = children, apart
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> list[list[tuple]]:
        """For each query up to k of (score, id), best first, that are no worse than ``floor``
        and not the query's ``own`` id. Scores below the floor may be missing."""
        count = len(queries)
        wide = np.column_stack([queries.astype(np.float64), np.zeros(count)])
        base = (wide**2).sum(axis=1) + self.largest
        slack = 1e-9 * np.sqrt(base) + 1e-6
        found: list[list[tuple]] = [[] for _ in range(count)]  # heaps of (score, -id)
        bound = floor.astype(np.float64)

        def reach(rows: np.ndarray) -> np.ndarray:
            """The distance of the worst score that still counts."""
            return np.sqrt(np.maximum(base[rows] - 2 * np.maximum(bound[rows], -EXACT * EXACT), 0)) + slack[rows]

        def distance(rows: np.ndarray, places: list[int] | np.ndarray) -> np.ndarray:
            points = self.points[places]
            squares = (wide[rows] ** 2).sum(axis=1)[:, None] + (points**2).sum(axis=1)
            return np.sqrt(np.maximum(squares - 2 * wide[rows] @ points.T, 0))

        every = np.arange(count)
        to_root = distance(every, [self.root.routing])[:, 0]
        turn = 0
        heap = [(0.0, turn, self.root, every, to_root)]
        while heap:
            _, _, node, rows, away = heapq.heappop(heap)
            # What was near enough when the page was put down may be too far by now.
            near = away - node.radius <= reach(rows) + slack[rows]
            rows, away = rows[near], away[near]
            if not len(rows):
                continue
            if node.entries is None:
                radii = np.array([c.radius for c in node.children])
                limit = (reach(rows) + slack[rows])[:, None]
                possible = np.abs(away[:, None] - node.apart) - radii <= limit
                for i in np.flatnonzero(possible.any(axis=0)).tolist():
                    child, which = node.children[i], possible[:, i]
                    d = distance(rows[which], [child.routing])[:, 0]
                    turn += 1
                    least = float(np.maximum(d - child.radius, 0).min())
                    heapq.heappush(heap, (least, turn, child, rows[which], d))
                continue
            possible = np.abs(away[:, None] - node.apart) <= (reach(rows) + slack[rows])[:, None]
            entries = node.entries[possible.any(axis=0)]
            if not len(entries):
                continue
            scores = products(queries[rows], self.vectors[entries])
            good = (scores >= bound[rows][:, None]) & (self.ids[entries] != own[rows][:, None])
            for r, e in zip(*(x.tolist() for x in np.nonzero(good))):
                row = int(rows[r])
                item = (int(scores[r, e]), -int(self.ids[entries[e]]))
                if len(found[row]) < k:
                    heapq.heappush(found[row], item)
                else:
                    heapq.heappushpop(found[row], item)
                if len(found[row]) == k:
                    bound[row] = max(bound[row], found[row][0][0])
        return [[(s, -i) for s, i in sorted(f, reverse=True)] for f in found]


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, x): floor of the scaled components, of the rows that take part, each once."""
    good = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.where(good).select(F.col(key).cast("long").alias("id"), x.alias("x")).distinct()


def matrix_of(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """(query_id, rank, id, score) of the queries among the rows against all other rows.

    ``is_query`` is a condition on the column ``id``. Counts the rows once when called."""
    every = whole_vectors(rows, key, vector, scale)
    same = Window.partitionBy("x").orderBy("id")
    some = every.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    count = rows.count()
    groups = max(-(-count // GROUP), min(SMALL_GROUPS, -(-count // SMALL_GROUP)), 1)
    # A sample of fixed size, by hash.
    seeds = [(r["id"], r["x"]) for r in some.orderBy(F.xxhash64("x"), "id").limit(SEEDS).collect()]
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {len(x) for _, x in seeds}:
        own = [(i, x) for i, x in seeds if len(x) == dim]
        by_dim[dim] = np.array([i for i, _ in own]), np.array([x for _, x in own], np.int64).reshape(len(own), dim)
    shared = rows.sparkSession.sparkContext.broadcast(by_dim)

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ids = batch.column("dim").to_numpy(), batch.column("id").to_numpy()
            floor = np.full(len(ids), LEAST, np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                seed_ids, seed_x = shared.value.get(dim, (np.zeros(0), np.zeros((0, dim), np.int64)))
                if len(seed_ids) <= k:
                    continue
                for start in range(0, len(at), TOGETHER):
                    part = at[start : start + TOGETHER]
                    scores = products(matrix_of(batch.column("x").take(pa.array(part)), dim), seed_x)
                    scores[seed_ids == ids[part][:, None]] = LEAST
                    floor[part] = np.partition(scores, len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("x"), batch.column("dim"), pa.array(floor)],
                ["id", "x", "dim", "floor"],
            )

    entries = some.select(
        F.size("x").alias("dim"),
        F.pmod(F.xxhash64("x", "id"), F.lit(groups)).cast("int").alias("group"),
        F.lit(0).alias("turn"),
        "id",
        "x",
        F.lit(0).cast("long").alias("floor"),
    )
    queries = (
        every.where(is_query)
        .select("id", "x", F.size("x").alias("dim"))
        .mapInArrow(floors, "id long, x array<bigint>, dim int, floor long")
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        .select("dim", "group", F.lit(1).alias("turn"), "id", "x", "floor")
    )
    together = (
        entries.unionByName(queries)
        .repartition("dim", "group")
        .sortWithinPartitions("dim", "group", "turn", "id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree, current = [], None, None
        for batch in batches:
            dims, grps, turns = (batch.column(c).to_numpy() for c in ("dim", "group", "turn"))
            change = (dims[1:] != dims[:-1]) | (grps[1:] != grps[:-1]) | (turns[1:] != turns[:-1])
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part, dim = batch.slice(a, b - a), int(dims[a])
                if (dim, int(grps[a])) != current:
                    held, tree, current = [], None, (dim, int(grps[a]))
                ids, x = part.column("id").to_numpy(), matrix_of(part.column("x"), dim)
                if turns[a] == 0:
                    held.append((ids, x))
                    continue
                if held:
                    tree = MTree(np.concatenate([v for _, v in held]), np.concatenate([i for i, _ in held]))
                    held = []
                if tree is None:
                    continue
                floor = part.column("floor").to_numpy()
                for at in range(0, len(ids), TOGETHER):
                    span = slice(at, at + TOGETHER)
                    found = tree.search(x[span], ids[span], floor[span], k)
                    flat = [(int(q), n, i, s) for n, (q, f) in enumerate(zip(ids[span], found)) for s, i in f]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in flat], pa.int64()),
                            part.column("x").slice(at, TOGETHER).take(pa.array([r[1] for r in flat], pa.int64())),
                            pa.array([r[2] for r in flat], pa.int64()),
                            pa.array([r[3] for r in flat], pa.int64()),
                        ],
                        ["query_id", "x", "id", "score"],
                    )

    found = together.mapInArrow(run, "query_id long, x array<bigint>, id long, score long")
    best = Window.partitionBy("query_id", "x").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def op3(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("id") % 50 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )
