"""Exact neighbour search by Voronoi cells.

A sample of the points serves as pivots (their number is capped, so they travel
as a small constant).  Every point lives in the cell of its nearest pivot.  A
query carries a search radius and visits only the cells that can hold something
within it: for cell j the distance is at least

    (|q p_j|^2 - |q p_home|^2) / (2 |p_home p_j|)     (it lies beyond the bisector)
    |q p_j| - radius_j                                (it lies inside a ball)

and a cell with |q p_j| + radius_j within the radius is wholly inside, so it is
counted or linked as one thing without a visit.  Points of a dense region, however
many, mostly see such cells.

Near cells form regions, some eight of them until a region's vectors reach
64 MB.  A query travels once to each region it visits, with the list of cells
to look into there, and rows travel to the blocks of visitors of their region,
so each vector is sent a bounded number of times, however many cells there are.
Regions and their visitors are cut into blocks of bounded size, so a hot cell is
many tasks, and a task returns a reduced answer (k best, a count, a spanning
forest), never its pairs.  Equal vectors are collapsed to one weighted point
first: a third of all rows being copies costs one point.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import list_column, matrix_of
from ..session import cut_lineage

#: Target points per cell, rows per block of a task, and the most pivots ever used.
CELL_ROWS, BLOCK_ROWS, MAX_PIVOTS = 2048, 4096, 2048
#: Regions the cells are grouped into, the bytes of vectors a block may have in large spaces, and the pairs compared at once.
REGIONS, BLOCK_BYTES, CHUNK_ROWS, CHUNK_PAIRS = 8, 64 << 20, 2048, 1 << 20
#: Components from which candidates are found in single precision.
SINGLE_DIMS = 16
#: Relative slack that keeps rounding from pruning a true neighbour.
SLACK = 1e-9


@dataclass
class Copies:
    """Distinct vectors ``(point, vec, weight)`` and the mapping ``(key, point)`` from rows to them."""

    points: DataFrame
    members: DataFrame
    rows: int
    size: int

    @property
    def any(self) -> bool:
        return self.size < self.rows


def collapse_copies(df: DataFrame, key: str, vec: str = "vec") -> Copies:
    """Group equal vectors; a point is named by its least row key.

    Vectors whose components are all exact in single precision travel as floats; tasks compute in double all the same.
    """
    rows = cut_lineage(df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec")))
    wide = F.exists("vec", lambda x: ~x.cast("float").cast("double").eqNullSafe(x))
    n, double = rows.agg(F.count(F.lit(1)), F.max(wide)).first()
    if not double:
        rows = rows.withColumn("vec", F.col("vec").cast("array<float>"))
    points = cut_lineage(rows.groupBy("vec").agg(F.min("key").alias("point"), F.count(F.lit(1)).alias("weight")))
    m = points.count()
    if n == m:
        members = rows.select("key", F.col("key").alias("point"))
    else:
        members = cut_lineage(rows.join(points.select("vec", "point"), "vec").select("key", "point"))
    return Copies(points.select("point", "vec", "weight"), members, n, m)


#: Queries (their rows) and the range of data rows that these look into.
Part = tuple[np.ndarray, int, int]


def near_pairs(q: np.ndarray, x: np.ndarray, limits: np.ndarray, parts: list[Part]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs and exact distances of the (query, data) pairs of ``parts`` within each query's limit, piece by piece.

    A matrix product finds candidates; only those are measured by direct
    differences.  ``limits`` may be lowered between two pieces.  Long vectors
    are multiplied in single precision, with room for its rounding.
    """
    shift = x.mean(axis=0)
    xs, qs = x - shift, q - shift
    xx, qq = (xs * xs).sum(axis=1), (qs * qs).sum(axis=1)
    size = qq + xx.max()
    room, slack, kind = 1e-11 * (size + 1.0), 0.0, np.float64
    if x.shape[1] >= SINGLE_DIMS and size.max(initial=0.0) < 1e30:
        # A sum of n terms, all rounded, is off by n + 4 times 2^-24 of their absolute sum at most, here 2 (qq + xx) + limit^2.
        slack, kind = (x.shape[1] + 16) * 2.0**-24, np.float32
    # One product gives the squared distance less the squared limit.
    right = np.concatenate([xs, (1.0 - 2.0 * slack) * xx[:, None], np.ones((len(x), 1))], axis=1).astype(kind)
    for rows, begin, end in parts:
        for low in range(begin, end, CHUNK_ROWS):
            high = min(low + CHUNK_ROWS, end)
            step = max(1, CHUNK_PAIRS // (high - low))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                square = limits[some] * limits[some] * (1.0 + slack)
                left = np.concatenate([-2.0 * qs[some], np.ones((len(some), 1)), ((1.0 - 2.0 * slack) * qq[some] - square - room[some])[:, None]], axis=1).astype(kind)
                hits = np.flatnonzero((left @ right[low:high].T).ravel() <= 0)
                for at in range(0, len(hits), 1 << 17):
                    qi, xi = np.divmod(hits[at : at + (1 << 17)], high - low)
                    qi, xi = some[qi], xi + low
                    diff = q[qi] - x[xi]
                    dist = np.sqrt((diff * diff).sum(axis=1))
                    keep = dist <= limits[qi]
                    yield qi[keep], xi[keep], dist[keep]


def kth_limits(q: np.ndarray, x: np.ndarray, k: int, limits: np.ndarray) -> np.ndarray:
    """Limits tightened to just above the k-th nearest of ``x``, where ``x`` has that many."""
    if len(x) < k:
        return limits
    out = limits.copy()
    shift = x.mean(axis=0)
    xs = x - shift
    xx = (xs * xs).sum(axis=1)
    step = max(1, 4_000_000 // len(x))
    for start in range(0, len(q), step):
        qs = q[start : start + step] - shift
        qq = (qs * qs).sum(axis=1)
        approx = qq[:, None] + xx[None, :] - 2.0 * (qs @ xs.T)
        kth = np.partition(approx, k - 1, axis=1)[:, k - 1]
        room = 2e-11 * (qq + xx.max() + 1.0)
        out[start : start + step] = np.minimum(out[start : start + step], np.sqrt(np.maximum(kth, 0.0) + room))
    return out


@dataclass
class Space:
    """Pivots plus the cells of a point set."""

    pivots: np.ndarray
    cells: DataFrame  # point, vec, weight, cell, reach (distance to the pivot)
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    radii: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block_rows: int = BLOCK_ROWS

    @property
    def single(self) -> bool:
        """One block holds everything, so no pruning pass is worth it."""
        return len(self.pivots) == 1 and self.sizes.max(initial=0) <= self.block_rows


def build_space(
    points: DataFrame, size: int, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS
) -> Space:
    """Choose pivots by hash order and put every point into its nearest pivot's cell."""
    wanted = min(max(1, -(-size // cell_rows)), max_pivots)
    chosen = points.orderBy(F.md5(F.col("point").cast("string").cast("binary"))).limit(wanted).select("vec").collect()
    pivots = np.array([row["vec"] for row in chosen], dtype=np.float64).reshape(len(chosen), -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = to_pivots(matrix_of(batch.column("vec")), pivots)
                cell = d.argmin(axis=1)
                columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell", "reach"])

    kinds = ", ".join(f"{n} {t}" for n, t in points.dtypes)
    cells = cut_lineage(points.mapInArrow(place, f"{kinds}, cell int, reach double"))
    space = Space(pivots, cells, block_rows=block_rows)
    return restrict(space, cells)


def restrict(space: Space, cells: DataFrame) -> Space:
    """The same pivots over a subset of the points (or with more columns)."""
    sizes, radii, weights = (np.zeros(len(space.pivots)) for _ in range(3))
    weight = F.sum("weight") if "weight" in cells.columns else F.count(F.lit(1))
    stats = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("r"), weight.alias("w"))
    for row in stats.collect():
        sizes[row["cell"]], radii[row["cell"]], weights[row["cell"]] = row["n"], row["r"], row["w"]
    return Space(space.pivots, cells, sizes, radii, weights, space.block_rows)


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to all pivots, by direct differences per pivot."""
    out = np.empty((len(vectors), len(pivots)))
    for j, p in enumerate(pivots):
        diff = vectors - p
        out[:, j] = np.sqrt((diff * diff).sum(axis=1))
    return out


def look(space: Space, queries: DataFrame, inside: bool = False, owner: np.ndarray | None = None) -> DataFrame:
    """Add ``visit``, the cells each query must look into, and ``inside``, the cells wholly within its limit.

    ``queries`` has ``vec`` and ``limit``.  Without ``inside`` such cells are
    visited like others.  ``owner`` names the component that fills a whole cell
    (-1 for none); a query with a ``component`` column skips its own cells.
    """
    pivots, sizes, radii = space.pivots, space.sizes, space.radii
    between = to_pivots(pivots, pivots)
    slack = SLACK * (1.0 + between.max(initial=0.0))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = to_pivots(matrix_of(batch.column("vec")), pivots)
            limit = batch.column("limit").to_numpy(zero_copy_only=False)[:, None]
            home = d.argmin(axis=1)
            nearest = d[np.arange(len(d)), home]
            gap = between[home]
            with np.errstate(divide="ignore", invalid="ignore"):
                beyond = np.where(gap > 0, (d * d - (nearest * nearest)[:, None]) / (2.0 * gap), 0.0)
            reached = (np.maximum(beyond, d - radii) <= limit + slack) & (sizes > 0)
            if owner is not None:
                reached &= owner[None, :] != batch.column("component").to_numpy(zero_copy_only=False)[:, None]
            whole = reached & (d + radii <= limit - slack) if inside else np.zeros_like(reached)
            columns = [*batch.columns, _index_lists(reached & ~whole), _index_lists(whole)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "visit", "inside"])

    kinds = ", ".join(f"{n} {t}" for n, t in queries.dtypes)
    return queries.mapInArrow(spread, f"{kinds}, visit array<int>, inside array<int>")


def _index_lists(mask: np.ndarray) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(mask.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.nonzero(mask)[1].astype(np.int32)))


Kernel = Callable[[pa.Table, pa.Table, list[Part]], pa.Table]


def group_cells(pivots: np.ndarray, sizes: np.ndarray, rows: int) -> np.ndarray:
    """The region of each cell: cells are halved across their longest extent until a region has at most ``rows`` rows."""
    region, number = np.zeros(len(pivots), dtype=int), 0
    work = [np.arange(len(pivots))]
    while work:
        cells = work.pop()
        if len(cells) == 1 or sizes[cells].sum() <= rows:
            region[cells] = number
            number += 1
            continue
        p = pivots[cells]
        one = p[((p - p[0]) ** 2).sum(axis=1).argmax()]
        two = p[((p - one) ** 2).sum(axis=1).argmax()]
        order = np.argsort(p @ (two - one), kind="stable")
        upto = np.cumsum(sizes[cells][order])
        cut = min(max(int(np.searchsorted(upto, upto[-1] / 2)) + 1, 1), len(cells) - 1)
        work += [cells[order[:cut]], cells[order[cut:]]]
    return region


def _by_region(looked: DataFrame, region: np.ndarray) -> DataFrame:
    """One row per query and region that it visits, with the cells to look into there."""
    total = int(region.max()) + 1

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("visit")
            cell = lists.flatten().to_numpy(zero_copy_only=False)
            if len(cell):
                row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                key = row * total + region[cell]
                order = np.argsort(key, kind="stable")
                keys, first = np.unique(key[order], return_index=True)
                bounds = pa.array(np.append(first, len(key)).astype(np.int32))
                cells = pa.ListArray.from_arrays(bounds, pa.array(cell[order].astype(np.int32)))
                kept = batch.drop_columns(["visit", "inside"]).take(pa.array(keys // total))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array((keys % total).astype(np.int32)), cells], [*kept.schema.names, "region", "cells"])

    kinds = ", ".join(f"{n} {t}" for n, t in looked.drop("visit", "inside").dtypes)
    return looked.mapInArrow(spread, f"{kinds}, region int, cells array<int>")


def _parts(lists: pa.Array, cell: np.ndarray) -> list[Part]:
    """Which queries look into which rows; ``cell`` rises.  Neighbouring cells with the same queries are one part."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(flat, kind="stable")
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))[order]
    names, starts = np.unique(cell, return_index=True)
    low, high = (np.searchsorted(flat[order], names, side=side) for side in ("left", "right"))
    out: list[Part] = []
    for a, b, start, end in zip(low.tolist(), high.tolist(), starts.tolist(), [*starts[1:].tolist(), len(cell)]):
        rows = row[a:b]
        if out and out[-1][2] == start and np.array_equal(out[-1][0], rows):
            out[-1] = (rows, out[-1][1], end)
        elif len(rows):
            out.append((rows, start, end))
    return out


def per_cell(values: np.ndarray, cell: Column) -> Column:
    """A per-cell constant looked up by cell number."""
    return F.element_at(F.array(*[F.lit(int(x)) for x in values]), cell + 1)


def block_size(space: Space) -> int:
    """Rows of a block in :func:`search`.

    A fixed part of the points, few or many, so that a vector is sent to some fourteen blocks at most; only blocks of 64 MB
    of vectors grow no more.
    """
    bounded = max(1, BLOCK_BYTES // (8 * max(1, space.pivots.shape[1])))
    part = -(-int(space.sizes.sum()) * 4 // (3 * REGIONS))
    return max(space.block_rows // 2, min(part, bounded), 1)


def search(space: Space, looked: DataFrame, kernel: Kernel, schema: str) -> DataFrame:
    """Run ``kernel(queries, data, parts)`` on every block pair a query can find something in.

    ``looked`` comes from :func:`look` and has what the kernel wants; ``parts``
    say which queries look into which rows.  Hot regions: data is cut into
    blocks that each visitor goes to, and visitors are cut into blocks that each
    data block is sent to.
    """
    rows = block_size(space)
    region = group_cells(space.pivots, space.sizes, rows)
    total = int(region.max()) + 1
    visits, visitors = _by_region(looked, region), np.zeros(total)
    for row in visits.groupBy("region").count().collect():
        visitors[row["region"]] = row["count"]
    data_blocks = np.maximum(1, np.ceil(np.bincount(region, weights=space.sizes, minlength=total) / rows)).astype(int)
    query_blocks = np.maximum(1, np.ceil(visitors / rows)).astype(int)
    here = F.col("region")
    block_of = lambda counts: F.pmod(F.xxhash64("point"), per_cell(counts, here)).cast("int")
    every = lambda counts: F.explode(F.sequence(F.lit(0), per_cell(counts, here) - 1))
    left = visits.withColumn("qb", block_of(query_blocks)).withColumn("db", every(data_blocks))
    data = space.cells.withColumn("region", per_cell(region, F.col("cell")).cast("int"))
    right = data.withColumn("db", block_of(data_blocks)).withColumn("qb", every(query_blocks))
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return pa.table({n: [] for n in names}, schema=empty)
        x = x.take(pa.array(np.argsort(x.column("cell").to_numpy(), kind="stable")))
        return kernel(q, x, _parts(q.column("cells").combine_chunks(), x.column("cell").to_numpy())).cast(empty)

    empty = arrow_schema(schema)
    keys = ["region", "qb", "db"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


__all__ = [
    "Copies", "Part", "Space", "arrow_schema", "block_size", "build_space", "collapse_copies", "group_cells", "kth_limits", "list_column",
    "look", "matrix_of", "near_pairs", "per_cell", "restrict", "search", "to_pivots",
]
