"""k nearest neighbours, k-distance curve, and the epsilon neighbourhood."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY
from ..session import cut_lineage
from .ordering import global_row_number, percentiles
from .space import CHUNK_ROWS, SINGLE_DIMS, Copies, Part, Space, build_space, collapse_copies, kth_limits, look, matrix_of, near_pairs, per_cell, search

NEIGHBOUR = "point bigint, neighbour bigint, distance double"


#: Share of all rows that a query must look into, and rows there must be, for all to be streamed past all; rows and bytes of vectors of a pack.
STREAM_SHARE, STREAM_ROWS, PACK_ROWS, PACK_BYTES = 0.5, 1 << 14, 1 << 15, 32 << 20
#: Pairs that wait before the lists of the best are made anew.
WAITING = 1 << 17


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


class Best:
    """The k nearest so far of some queries: ``dist`` and ``near``, whose last distances lower ``limits``."""

    def __init__(self, limits: np.ndarray, k: int):
        self.limits, self.k = limits, k
        self.dist, self.near = np.full((len(limits), k), np.inf), np.zeros((len(limits), k), dtype=np.int64)

    def add(self, pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], ids: np.ndarray) -> None:
        waiting, held = [], 0
        for qi, xi, d in pairs:
            waiting.append((qi, ids[xi], d))
            held += len(qi)
            if held >= WAITING:
                self._merge(waiting)
                waiting, held = [], 0
        if held:
            self._merge(waiting)

    def _merge(self, waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        qi, other, d = (np.concatenate(c) for c in zip(*waiting))
        rows = np.unique(qi)
        who, far = np.concatenate([np.repeat(rows, self.k), qi]), np.concatenate([self.dist[rows].ravel(), d])
        other = np.concatenate([self.near[rows].ravel(), other])
        order = np.lexsort((other, far, who))
        who, far, other = who[order], far[order], other[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who, side="left")
        best = rank < self.k
        self.dist[who[best], rank[best]], self.near[who[best], rank[best]] = far[best], other[best]
        self.limits[rows] = np.minimum(self.limits[rows], self.dist[rows, self.k - 1])


def _nearest(k: int):
    """Kernel: the k best of this block for each visiting query."""

    def kernel(q: pa.Table, x: pa.Table, parts: list[Part]) -> pa.Table:
        qv, xv, ids, limits = matrix_of(q.column("vec")), matrix_of(x.column("vec")), _column(x, "point"), _column(q, "limit").copy()
        free = np.flatnonzero(np.isinf(limits))
        if len(free):  # without a limit all rows are looked into
            limits[free] = kth_limits(qv[free], xv[: max(k, CHUNK_ROWS)], k, limits[free])
        best = Best(limits, k)
        best.add(near_pairs(qv, xv, limits, parts), ids)
        dist, near = best.dist, best.near
        qi, rank = np.nonzero(np.isfinite(dist))
        return pa.table({"point": _column(q, "point")[qi], "neighbour": near[qi, rank], "distance": dist[qi, rank]})

    return kernel


def nearest_points(space: Space, k: int) -> DataFrame:
    """The k nearest distinct points of every point, itself included: ``point``, ``neighbour``, ``distance``, ``rank``."""
    cells = space.cells.select("point", "vec", "cell")
    if space.single:
        bounded = cells.select("point", "vec", F.lit(float("inf")).alias("limit"))
    else:
        bounded = _bounded(space, k)
    if not space.single and _meets_most(space, bounded):
        found = _streamed(space, bounded, k)
    else:
        found = search(space, look(space, bounded), _nearest(k), NEIGHBOUR)
    best = Window.partitionBy("point").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _meets_most(space: Space, bounded: DataFrame) -> bool:
    """Whether the cells save little, as some thousand queries tell: then blocks would be sent to each other for nothing."""
    rows = int(space.sizes.sum())
    if rows < STREAM_ROWS or space.pivots.shape[1] < SINGLE_DIMS:
        return False
    some = look(space, bounded.filter(F.pmod(F.xxhash64("point"), F.lit(max(1, rows // 1024))) == 0)).select("visit").toArrow()
    cells = some.column("visit").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return bool(space.sizes[cells].sum() >= STREAM_SHARE * rows * max(1, some.num_rows))


def _streamed(space: Space, bounded: DataFrame, k: int) -> DataFrame:
    """The k best of every point of ``bounded``: a task keeps the lists of a pack of points while all packs pass by.

    Packs are written once and read by every task, so nothing but the packs and the lists is sent.
    """
    spark, width, rows = bounded.sparkSession, space.pivots.shape[1], int(space.sizes.sum())
    few = min(3 * spark.sparkContext.defaultParallelism, -(-rows // space.block_rows))
    packs = max(-(-rows // PACK_ROWS), -(-rows * width * 8 // PACK_BYTES), few)
    kind = np.float32 if dict(bounded.dtypes)["vec"] == "array<float>" else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if b.num_rows]
        if given:
            table = pa.Table.from_batches(given)
            lists = [_column(table, "point"), matrix_of(table.column("vec")).astype(kind), _column(table, "limit")]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in lists], ["point", "vec", "limit"])

    packed = cut_lineage(bounded.select("point", "vec", "limit").repartition(packs, "point").mapInArrow(pack, "point binary, vec binary, limit binary")).rdd

    def vectors(row) -> np.ndarray:
        return np.frombuffer(row["vec"], kind).astype(np.float64).reshape(-1, width)

    def run(pairs):
        held = {}
        for mine, other in pairs:
            x, name = vectors(other), bytes(mine["point"][:8])
            if name not in held:
                q, limits = vectors(mine), np.frombuffer(mine["limit"]).copy()
                free = np.flatnonzero(np.isinf(limits))
                if len(free):
                    limits[free] = kth_limits(q[free], x[: max(k, CHUNK_ROWS)], k, limits[free])
                held[name] = np.frombuffer(mine["point"], np.int64), q, Best(limits, k)
            _, q, best = held[name]
            best.add(near_pairs(q, x, best.limits, [(np.arange(len(q)), 0, len(x))]), np.frombuffer(other["point"], np.int64))
        for ids, _, best in held.values():
            qi, rank = np.nonzero(np.isfinite(best.dist))
            yield ids[qi].tobytes(), best.near[qi, rank].tobytes(), best.dist[qi, rank].tobytes()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                columns = [pa.array(np.frombuffer(x, t)) for x, t in zip(row, (np.int64, np.int64, np.float64))]
                yield pa.RecordBatch.from_arrays(columns, ["point", "neighbour", "distance"])

    lists = packed.cartesian(packed).coalesce(packs).mapPartitions(run)
    return spark.createDataFrame(lists, "point binary, neighbour binary, distance binary").mapInArrow(unpack, NEIGHBOUR)


def _bounded(space: Space, k: int) -> DataFrame:
    """Queries with a first search radius: the k-th nearest in the query's own block, or among the pivots."""
    pivots, block_rows = space.pivots, space.block_rows
    blocks = np.maximum(1, np.ceil(space.sizes / block_rows)).astype(int)

    def own_block(t: pa.Table) -> pa.Table:
        v = matrix_of(t.column("vec"))
        limit = np.full(len(v), np.inf)
        for candidates in (v, pivots):
            limit = kth_limits(v, candidates, k, limit)
        return pa.table({"point": t.column("point"), "vec": t.column("vec"), "limit": pa.array(limit)})

    own = space.cells.select("point", "vec", "cell").withColumn("block", F.pmod(F.xxhash64("point"), per_cell(blocks, F.col("cell"))))
    kind = dict(space.cells.dtypes)["vec"]
    return cut_lineage(own.groupBy("cell", "block").applyInArrow(own_block, f"point bigint, vec {kind}, limit double"))


def expand_copies(found: DataFrame, copies: Copies, k: int, include_self: bool = True) -> DataFrame:
    """Distinct-point neighbours to row neighbours: ``key``, ``neighbour``, ``distance``, ``rank``.

    All copies of a vector have the same neighbour rows in (distance, key) order,
    so lists are cut per point, using only each point's k lowest member keys.
    Without self, one more row is taken and the row itself dropped.
    """
    take = k if include_self else k + 1
    found = found.select("point", "neighbour", "distance")
    if copies.any:
        lowest = Window.partitionBy("point").orderBy("key")
        few = copies.members.withColumn("_r", F.row_number().over(lowest)).filter(F.col("_r") <= take)
        found = found.join(few.select(F.col("point").alias("neighbour"), F.col("key").alias("_member")), "neighbour")
        found = found.select("point", F.col("_member").alias("neighbour"), "distance")
    ordered = Window.partitionBy("point").orderBy("distance", "neighbour")
    cut = found.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= take)
    rows = cut.withColumnRenamed("point", "key") if not copies.any else copies.members.join(cut, "point").drop("point")
    if include_self:
        return rows.select("key", "neighbour", "distance", "rank")
    others = rows.filter(F.col("key") != F.col("neighbour"))
    again = Window.partitionBy("key").orderBy("distance", "neighbour")
    return others.withColumn("rank", F.row_number().over(again)).filter(F.col("rank") <= k).select(
        "key", "neighbour", "distance", "rank")


def knn(df: DataFrame, k: int, key: str = KEY, vec: str = "vec", include_self: bool = True, **space: int) -> DataFrame:
    """Exact k nearest neighbours (Euclidean): ``key``, ``neighbour``, ``distance``, ``rank``.

    A row is its own first neighbour by default; ties are broken by key.
    """
    copies = collapse_copies(df, key, vec)
    built = build_space(copies.points, copies.size, **space)
    found = nearest_points(built, k if include_self else k + 1)
    return expand_copies(found, copies, k, include_self).withColumnRenamed("key", key)


def unit_vectors(df: DataFrame, vec: str = "vec") -> DataFrame:
    """For cosine neighbours: on unit vectors, squared Euclidean distance is twice the cosine distance."""
    from ..functions.vectors import l2_normalize

    return df.withColumn(vec, l2_normalize(F.col(vec)))


def k_distance_curve(df: DataFrame, k: int, key: str = KEY, vec: str = "vec", **space: int) -> DataFrame:
    """Distance to the k-th neighbour (self is the first) with its position in sorted order."""
    kth = knn(df, k, key, vec, **space).filter(F.col("rank") == k).select(key, "distance")
    return global_row_number(kth, ["distance", key])


def suggest_eps(curve: DataFrame, probability: float = 0.95) -> DataFrame:
    return percentiles(curve, "distance", [probability]).select(F.col("value").alias("eps"))
