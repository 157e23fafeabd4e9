"""Exact top-k inner products by a Voronoi join.

Vectors become whole numbers, ``floor(scale * x)``. Pivots split queries and data into cells of the nearest pivot. One
pass gives summaries: per cell the radius R of its queries (largest distance to the pivot), their number, and
the largest distance of its data. A second one finds for each query cell a floor t that every query's k-th score reaches:
x scores at least ``p.x - R|x|`` with every query of the cell of pivot p, and t is the k-th largest such bound. Data
go to a query cell only if ``p.x + R|x|``, the most that they can score there, reaches t; where already the
radius of a data cell shows that none of it can, its vectors are not looked at. Each pair of a query block and a slice of its
data is then solved by one task, as products of matrices, and the best of all slices are ranked.

Blocks and slices have a bounded number of vectors and are dealt by hashed ids and block numbers, so that copies or a
cell that holds most of the table are spread like all others. On vectors without clusters the bounds
exclude nothing, and each query cell gets all data, ``pivots`` times in all.

Left out: null vectors, vectors with null or non-finite entries, empty ones and those of another than the commonest length. A
query is an id: if it stands on several rows, the one with the smallest vector asks. Rows with a query's own id are no
candidates of it. Null ids don't ask; as candidates they come last among equal scores (the largest 64-bit
id is read as null). Scores beyond 64 bits are cut to the nearest 64-bit number after ranking. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plantlake.llm.common import written
from plantlake.llm.vectors import matrix, usable

#: Bytes of queries that a task holds, data vectors that it goes through, and scores that it holds at a time.
BLOCK_BYTES, SLICE, TILE = 96 << 20, 4_000_000, 2_000_000
#: Copies of a query's id up to which its floor is sought.
OWN = 1000
NO_ID = (1 << 63) - 1


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * values)


def packed(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the smallest type that holds them all."""
    most = np.abs(x).max(initial=0)
    kind = next((k for k, top in (("<i1", 127), ("<i2", 32767), ("<i4", 2 ** 31 - 1)) if most <= top), "<f8")
    return kind, x.astype(kind).tobytes()


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, as whole numbers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.T.astype(np.float32)).astype(np.int64)
    if bound < 1 << 53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return exact(a) @ exact(b).T


class Best:
    """The ``k`` best candidates of each query so far: higher scores first, equal ones by id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k = ids, queries, k
        self.scores, self.ids = np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0), np.int64)
        self.real = np.empty((len(ids), 0), bool)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        if not len(ids):
            return
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        rows = max(1, TILE // len(ids))
        made = [self._tile(k, min(k + rows, len(self.own)), ids, x) for k in range(0, len(self.own), rows)]
        self.scores, self.ids, self.real = (np.concatenate(c) for c in zip(*made))

    def _tile(self, a: int, b: int, ids: np.ndarray, x: np.ndarray):
        found = products(self.queries[a:b], x)
        allowed = ids != self.own[a:b, None]
        n = min(self.k, len(ids))
        if found.dtype == object:
            at = np.stack([sorted(range(len(ids)), key=lambda j: (not ok[j], -row[j], j))[:n] for row, ok in zip(found, allowed)])
        else:
            # One number that orders by score and then by place, i.e. by id.
            least, most = int(found.min()) - 1, int(found.max())
            if (most - least + 1) * len(ids) < 1 << 62:
                ranked = np.where(allowed, found - least, 0) * len(ids) - np.arange(len(ids))
                at = np.argpartition(-ranked, n - 1, axis=1)[:, :n]
            else:
                at = np.lexsort((np.broadcast_to(np.arange(len(ids)), found.shape), -found, ~allowed), axis=1)[:, :n]
        scores = np.concatenate([self.scores[a:b], np.take_along_axis(found, at, 1)], axis=1)
        names = np.concatenate([self.ids[a:b], ids[at]], axis=1)
        real = np.concatenate([self.real[a:b], np.take_along_axis(allowed, at, 1)], axis=1)
        keep = np.lexsort((names, -scores, ~real), axis=1)[:, :self.k]
        return tuple(np.take_along_axis(c, keep, 1) for c in (scores, names, real))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query = np.broadcast_to(self.own[:, None], self.ids.shape)[self.real]
        scores = self.scores[self.real]
        if scores.dtype == object:
            scores = np.clip(scores, -(1 << 63), (1 << 63) - 1).astype(np.int64)
        return query, self.ids[self.real], scores


@dataclass(frozen=True)
class Cells:
    """Pivots with the summaries of their cells."""

    pivots: np.ndarray
    radius: np.ndarray  #: of the queries; negative without queries
    queries: np.ndarray  #: number of queries
    reach: np.ndarray  #: largest distance of data to the pivot; negative without data
    floors: np.ndarray

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return (np.square(self.pivots).sum(axis=1) - 2 * (x @ self.pivots.T)).argmin(axis=1)

    def reachable(self) -> np.ndarray:
        """``[query cell, data cell]``: whether some vector of the data cell may reach the floor, by the cells alone."""
        sizes = np.sqrt(np.square(self.pivots).sum(axis=1))
        most = self.pivots @ self.pivots.T + np.outer(sizes, self.reach) + np.outer(self.radius, sizes) + np.outer(self.radius, self.reach)
        return (self.radius[:, None] >= 0) & (self.reach >= 0) & (most >= self.floors[:, None] - slack(most))

    def most(self, cell: int, x: np.ndarray) -> np.ndarray:
        return x @ self.pivots[cell] + self.radius[cell] * np.sqrt(np.square(x).sum(axis=1))


def slack(x: np.ndarray) -> np.ndarray:
    """More than the rounding of a bound."""
    return 1e-9 * np.abs(x) + 1e-6


def summarised(rows: DataFrame, size: int, k: int, pivots: int, scale: int) -> Cells:
    """``rows`` as (vec_id, v, asks): all data, and the queries once more. ``k``: places that a floor must leave room
    for, 0 for no floors. The driver gets ``pivots`` vectors, a few numbers and one bound per cell."""
    # The vector with the least hash of each bucket of hashes: distinct ones, whatever has most copies.
    picked = rows.where("not asks").groupBy(F.pmod(F.xxhash64("v"), F.lit(pivots)).alias("bucket")).agg(F.min_by("v", F.xxhash64("v", F.lit(1))).alias("v"))
    found = sorted(tuple(r.v) for r in picked.select("v").collect())
    centres = whole(np.array(found, np.float64), scale)
    count = len(centres)
    base = Cells(centres, np.full(count, -1.0), np.zeros(count, np.int64), np.full(count, -1.0), np.full(count, -np.inf))

    def distances(batches):
        radius, reach, asked = base.radius.copy(), base.reach.copy(), base.queries.copy()
        for b in batches:
            x, asks = whole(matrix(b.column(1), size), scale), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            cell = base.nearest(x)
            d = np.sqrt(np.square(x - centres[cell]).sum(axis=1))
            np.maximum.at(reach, cell[~asks], d[~asks])
            np.maximum.at(radius, cell[asks], d[asks])
            np.add.at(asked, cell[asks], 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count)), pa.array(radius), pa.array(reach), pa.array(asked)], names=["cell", "radius", "reach", "asked"])

    seen = rows.mapInArrow(distances, "cell long, radius double, reach double, asked long").groupBy("cell").agg(F.max("radius"), F.max("reach"), F.sum("asked"))
    _, radius, reach, asked = (np.array(c) for c in zip(*sorted(map(tuple, seen.collect()))))
    if not k:
        return Cells(centres, radius, asked, reach, base.floors)
    live = np.flatnonzero(radius >= 0)

    def bounds(batches):
        best = [np.empty(0)] * len(live)
        for b in batches:
            x = whole(matrix(b.column(0), size), scale)
            long = np.sqrt(np.square(x).sum(axis=1))
            for at, cell in enumerate(live):
                least = x @ centres[cell] - radius[cell] * long
                both = np.concatenate([best[at], least - slack(least)])
                best[at] = np.partition(both, len(both) - k)[-k:] if len(both) > k else both
        for at, cell in enumerate(live):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best[at]), cell)), pa.array(best[at])], names=["cell", "least"])

    order = Window.partitionBy("cell").orderBy(F.desc("least"))
    ranked = rows.where("not asks").select("v").mapInArrow(bounds, "cell long, least double").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    floors = base.floors.copy()
    for r in ranked.where(F.col("at") == k).collect():
        floors[r.cell] = r.least
    return Cells(centres, radius, asked, reach, floors)


def dealt(cells: Cells, size: int, total: int, tasks: int) -> tuple[np.ndarray, int]:
    """``(query blocks of each cell, slices of its data)``."""
    blocks = -(-cells.queries // max(1, BLOCK_BYTES // (8 * size)))
    return blocks, max(-(-total // SLICE), -(-tasks // max(int(blocks.sum()), 1)))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = 8, scale: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each id divisible by ``every`` the ``k`` best of all other rows."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    rows, size = usable(vectors, id_col, vector_col)
    if not size:
        return spark.createDataFrame([], schema)
    asking = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"), F.count("*").alias("copies"))
    asking = written(asking, "voronoi-queries")
    total, copies = rows.count(), asking.agg(F.max("copies")).first()[0]
    if not copies:
        return spark.createDataFrame([], schema)
    rows = rows.withColumn("asks", F.lit(False)).unionAll(asking.select("vec_id", "v", F.lit(True).alias("asks")))
    # The rows of a query's own id are among the data.
    cells = summarised(rows, size, k + copies if copies <= OWN else 0, pivots, scale)
    blocks, slices = dealt(cells, size, total, int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(blocks)])
    reachable = cells.reachable()
    live = np.flatnonzero(blocks)

    def deal(batches):
        """Blocks of vectors for the solving tasks; task ``block * slices + slice``."""
        turn = TaskContext.get().partitionId()
        for batch in batches:
            x = whole(matrix(batch.column(1), size), scale)
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            asks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            cell, out = cells.nearest(x), []

            def block(task: int, query: bool, chosen: np.ndarray) -> None:
                out.append((task, query, ids[chosen].astype("<i8").tobytes(), *packed(x[chosen])))

            for i in live:
                mine = np.flatnonzero(asks & (cell == i))
                part = first[i] + (ids[mine] // every) % blocks[i]
                for b in np.unique(part):
                    for s in range(slices):
                        block(b * slices + s, True, mine[part == b])
                near = np.flatnonzero(~asks & reachable[i][cell])
                most = cells.most(i, x[near])
                near = near[most >= cells.floors[i] - slack(most)]
                if len(near):
                    for b in range(first[i], first[i + 1]):
                        block(b * slices + turn % slices, False, near)
            turn += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.bool_(), pa.binary(), pa.string(), pa.binary()))],
                                                 names=["task", "asks", "ids", "kind", "x"])

    def solve(batches):
        current, best, asked = None, None, []

        def done():
            if best is None:
                return
            query, ids, scores = best.rows()
            for a in range(0, len(query), 100_000):
                some = ids[a:a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(query[a:a + 100_000]), pa.array(some, mask=some == NO_ID), pa.array(scores[a:a + 100_000])],
                                                 names=["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                task, asks, ids, kind, x = (c[at].as_py() for c in batch.columns)
                if task != current:
                    yield from done()
                    current, best, asked = task, None, []
                ids = np.frombuffer(ids, "<i8")
                x = np.frombuffer(x, kind).reshape(len(ids), size).astype(np.float64)
                if asks:
                    asked.append((ids, x))
                elif asked or best is not None:
                    if best is None:
                        best, asked = Best(np.concatenate([i for i, _ in asked]), np.concatenate([v for _, v in asked]), k), []
                    best.add(ids, x)
        yield from done()

    dealt_blocks = rows.mapInArrow(deal, "task int, asks boolean, ids binary, kind string, x binary")
    placed = dealt_blocks.repartitionById(int(first[-1]) * slices, "task").sortWithinPartitions("task", F.desc("asks"))
    parts = placed.mapInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
