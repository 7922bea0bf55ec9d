"""Embedding near-duplicates with an inverted multi-index.

Vectors of length one are cut into halves with a codebook each; the pairs of
codewords are the cells of a product grid.  From a vector, cells are visited in
the order of what they can still hold: a near copy lies at most ``reach`` away
in some direction, so the chance that it fell beyond the boundary towards
another codeword is known from the distance to that boundary, and the chance
for a cell is the product over both halves (the multi-sequence order).  The
traversal ends once the cells left out hold less than ``1 - recall``.  That
reckons with differences in no preferred direction; asked for a recall of 1 the
traversal takes every cell that a vector within ``reach`` can lie in at all,
whatever the directions: one whose boundaries in both halves are near enough.

Every vector is stored in the inverted list of its cell.  Lists are grouped by
the first codeword and cut into blocks, visitors are cut into blocks too, and
one task joins one block with one block: what it verifies by exact cosine in
double precision leaves it as counts and as a spanning forest, never as pairs.
Equal vectors are one weighted entry.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import map_batches, spread, stored

COSINE = 0.95
#: The share of links that the traversal must reach at least.
RECALL = 0.9999
#: Codewords per half: about the square root of the vectors per cell below, within these bounds.
PER_CELL = 16
CODEWORDS = (4, 4096)
#: Bound of the sample the codebooks are fitted on, per codeword.
SAMPLE = 48
ROUNDS = 12
BLOCK = 4096
SEED = 4


@dataclass(frozen=True)
class Grid:
    """Codebooks of both halves, and the distances between codewords."""

    first: np.ndarray
    second: np.ndarray
    cut: int

    def halves(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.first, unit[:, : self.cut]), (self.second, unit[:, self.cut :])]


def codebook(points: np.ndarray, size: int, draw: np.random.Generator) -> np.ndarray:
    """Lloyd's iterations from a random start; empty codewords keep their place."""
    centres = points[draw.permutation(len(points))[:size]].copy()
    for _ in range(ROUNDS):
        nearest = np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def boundary_gaps(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own codeword, and the distance to the boundary towards each codeword; 0 for the own one."""
    squares = np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T, 0)
    own = np.argmin(squares, axis=1)
    apart = np.sqrt(np.maximum((centres**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * centres @ centres.T, 1e-30))
    rows = np.arange(len(points))
    gap = (squares - squares[rows, own][:, None]) / (2 * apart[own])
    gap[rows, own] = 0.0
    return own, gap


def boundary_chances(own: np.ndarray, gap: np.ndarray, spread_: float) -> np.ndarray:
    """For each codeword the chance that a near copy lies beyond the boundary to it."""
    chance = 0.5 * (1 - _erf(gap / (spread_ * sqrt(2))))
    chance[np.arange(len(own)), own] = 1.0
    return chance


_GRID = np.linspace(0, 6, 1201)
_ERF = np.array([erf(x) for x in _GRID])


def _erf(x: np.ndarray) -> np.ndarray:
    return np.interp(x, _GRID, _ERF)


def visited_cells(chance_a: np.ndarray, chance_b: np.ndarray, missed: float) -> tuple[np.ndarray, np.ndarray]:
    """Multi-sequence traversal of one row: cells by falling chance until the rest is under ``missed``."""
    a, b = np.flatnonzero(chance_a > missed / 64), np.flatnonzero(chance_b > missed / 64)
    product = np.outer(chance_a[a], chance_b[b]).ravel()
    order = np.argsort(-product, kind="stable")
    left = np.cumsum(product[order][::-1])[::-1]
    count = max(1, int(np.searchsorted(-left, -missed, side="right")))
    i, j = np.divmod(order[:count], len(b))
    return a[i], b[j]


def reachable_cells(gap_a: np.ndarray, gap_b: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """All cells of one row that can hold something within ``reach``: crossing both boundaries takes the root of both squares."""
    room = reach * (1 + 1e-9) + 1e-9
    a, b = np.flatnonzero(gap_a <= room), np.flatnonzero(gap_b <= room)
    i, j = np.nonzero(np.add.outer(gap_a[a] ** 2, gap_b[b] ** 2) <= room * room)
    return a[i], b[j]


def can_link() -> Column:
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & good & F.exists("embedding", lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array) -> np.ndarray:
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) % rows:
        raise ValueError("vectors of one length are needed")
    matrix = flat.reshape(rows, -1)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return matrix / np.sqrt((matrix**2).sum(axis=1, keepdims=True))


def fit_grid(vectors: DataFrame, count: int, dims: int) -> Grid:
    size = 1 << max(0, round(np.log2(max(1.0, sqrt(count / PER_CELL)))))
    size = int(min(max(size, CODEWORDS[0]), CODEWORDS[1], count))
    most = SAMPLE * size
    rows = vectors
    if count > most:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int((1 << 30) * 0.9 * most / count))
    taken = rows.select("embedding").limit(most).collect()
    if not taken:
        taken = vectors.select("embedding").limit(1).collect()
    sample = np.array([r[0] for r in taken], np.float64)
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
    cut = max(1, dims // 2)
    draw = np.random.Generator(np.random.PCG64(SEED))
    return Grid(codebook(sample[:, :cut], size, draw), codebook(sample[:, cut:], size, draw) if dims > 1 else np.zeros((1, 0)), cut)


def traverse(vectors: DataFrame, grid: Grid, cosine: float, recall: float) -> DataFrame:
    """``id, weight, unit, list, own, cells``: each vector once for every first codeword it visits.

    Cells are visited only upwards in grid order, so a pair of cells meets once.
    """
    reach = sqrt(max(0.0, 2 - 2 * cosine))
    shared = vectors.sparkSession.sparkContext.broadcast(grid)

    def make():
        grid = shared.value
        spread_ = max(reach / sqrt(grid.cut + grid.second.shape[1]), 1e-9)

        def work(batch: pa.RecordBatch):
            unit = unit_rows(batch.column(2))
            ids, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            (own_a, gap_a), (own_b, gap_b) = (boundary_gaps(points, centres) for centres, points in grid.halves(unit))
            if recall < 1:
                a, b = boundary_chances(own_a, gap_a, spread_), boundary_chances(own_b, gap_b, spread_)
            wide = len(grid.second)
            out: list[list] = [[], [], [], [], []]
            for row in range(len(unit)):
                home = own_a[row] * wide + own_b[row]
                i, j = visited_cells(a[row], b[row], 1 - recall) if recall < 1 else reachable_cells(gap_a[row], gap_b[row], reach)
                cell = np.unique(np.append(i * wide + j, home))
                cell = cell[cell >= home]
                first = cell // wide
                for lst in np.unique(first):
                    out[0].append(row)
                    out[1].append(int(lst))
                    out[2].append(int(own_b[row]) if lst == own_a[row] else -1)
                    out[3].append((cell[first == lst] % wide).astype(np.int32))
            at = np.array(out[0], np.int64)
            vec = pa.FixedSizeListArray.from_arrays(pa.array(unit[at].ravel()), unit.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(weights[at]), vec, pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.list_(pa.int32()))],
                ["id", "weight", "unit", "list", "own", "cells"])

        return work

    return map_batches(vectors, make, "id bigint, weight bigint, unit array<double>, list int, own int, cells array<int>")


def join_blocks(cosine: float):
    """Verify the visitors of one block against the inverted lists of another."""

    def run(key, table):
        role = table.column("role").to_numpy()
        ids, weights = table.column("id").to_numpy(), table.column("weight").to_numpy()
        unit = unit_rows(table.column("unit").combine_chunks())
        own = table.column("own").to_numpy()
        stored_rows, guests = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        stored_rows = stored_rows[np.argsort(own[stored_rows], kind="stable")]
        homes = own[stored_rows]
        cells = table.column("cells").combine_chunks()
        counts = np.zeros(len(ids), np.int64)
        parent = np.arange(len(ids))
        cell_of = cells.flatten().to_numpy()
        guest_of = np.repeat(np.arange(len(ids)), np.diff(cells.offsets.to_numpy()))
        chosen = role[guest_of] == 1
        cell_of, guest_of = cell_of[chosen], guest_of[chosen]
        order = np.argsort(cell_of, kind="stable")
        cell_of, guest_of = cell_of[order], guest_of[order]
        for cell in np.unique(cell_of):
            a, b = np.searchsorted(homes, [cell, cell + 1])
            if a == b:
                continue
            lo, hi = np.searchsorted(cell_of, [cell, cell + 1])
            residents = stored_rows[a:b]
            for at in range(lo, hi, 512):
                visitors = guest_of[at : min(at + 512, hi)]
                near = unit[visitors] @ unit[residents].T >= cosine
                # Within one cell both sides hold the same vectors: take each pair once.
                inside = own[visitors] == cell
                near &= ~(inside[:, None] & (ids[visitors][:, None] >= ids[residents][None, :]))
                x, y = np.nonzero(near)
                if len(x):
                    x, y = visitors[x], residents[y]
                    np.add.at(counts, x, weights[y])
                    np.add.at(counts, y, weights[x])
                    join_sets(parent, x, y)
        name = {}
        for row in range(len(ids)):
            name.setdefault(int(ids[row]), row)
        # A vector may be here as resident and as guest; both rows are one vertex.
        same = np.array([name[int(i)] for i in ids])
        join_sets(parent, np.arange(len(ids)), same)
        root = roots(parent)
        touched = np.flatnonzero(counts > 0)
        return pa.table({"id": pa.array(ids[touched]), "n": pa.array(counts[touched]), "root": pa.array(ids[root[touched]])})

    return run


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def join_sets(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Union of many pairs at once: roots take the least root they meet until nothing moves."""
    while len(x):
        parent[:] = roots(parent)
        a, b = parent[x], parent[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def links(table: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``.

    Two rows link if the cosine of their vectors is at least ``cosine``.  Null
    and zero vectors, and those with null or non-finite components, link with
    nothing and are their own component.  Rows with equal vectors link; a
    repeated ``vec_id`` is as many vectors.  A null ``vec_id`` has no links, a
    null component and is not kept.  An empty table gives no rows; other columns
    are ignored.  Vectors of different lengths raise.
    """
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("ok", can_link())
    vectors = stored(spread(rows.filter("ok")).select("vec_id", "embedding"), "vectors")
    none = rows.filter("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    groups = vectors.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    groups = stored(groups.withColumn("id", F.monotonically_increasing_id()), "groups")  # numbered once, then read
    count = groups.count()
    if not count:
        return _kept(none)
    dims = groups.select(F.size("embedding").alias("n")).distinct().limit(2).collect()
    if len(dims) > 1:
        raise ValueError("vectors of one length are needed")
    grid = fit_grid(groups, count, dims[0][0])
    visits = stored(traverse(groups.select("id", "weight", "embedding"), grid, cosine, recall), "visits")
    totals = visits.groupBy("list").agg(F.sum(F.when(F.col("own") >= 0, 1).otherwise(0)).alias("residents"), F.count(F.lit(1)).alias("guests")) \
        .select("list", F.greatest(F.lit(1), F.ceil(F.col("residents") / BLOCK)).cast("int").alias("rb"),
                F.greatest(F.lit(1), F.ceil(F.col("guests") / BLOCK)).cast("int").alias("gb"))
    # One row per codeword of the first half: at most CODEWORDS[1] of them.
    placed = visits.join(F.broadcast(totals), "list")
    residents = placed.filter("own >= 0").select(
        "list", F.pmod(F.xxhash64("id"), "rb").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("gb") - 1)).alias("g"),
        F.lit(0).alias("role"), "id", "weight", "unit", "own", F.array().cast("array<int>").alias("cells"))
    guests = placed.select(
        "list", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"), F.pmod(F.xxhash64(F.lit(SEED), "id"), "gb").cast("int").alias("g"),
        F.lit(1).alias("role"), "id", "weight", "unit", "own", "cells")
    found = stored(residents.unionByName(guests).groupBy("list", "r", "g").applyInArrow(
        join_blocks(cosine), "id bigint, n bigint, root bigint"), "found")
    totals = found.groupBy("id").agg(F.sum("n").alias("n"))
    classes = components(found.filter("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")))
    named = stored(groups.join(totals, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        "embedding", "least", F.coalesce("component", "id").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = vectors.join(named.join(least, "component").select("embedding", "n_links", "component_id"), "embedding")
    return _kept(linked.select("vec_id", "n_links", "component_id").unionByName(none))


def _kept(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: All pairs in DuckDB's SQL; components by the least id that links reach.
LINK_SQL = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON e.vec_id = d.a LEFT JOIN least l ON e.vec_id = l.a
"""
