"""Neighbour search, clustering and reduction against brute force on small point sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starglean.operators import components, dbscan, density, kmeans, metrics, neighbors, reduce
from starglean.operators.space import collapse_copies, near_pairs

MANY_CELLS = {"cell_rows": 12, "block_rows": 9}
DOUBLE_ROWS = "review_id long, vec array<double>"


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], DOUBLE_ROWS)


@pytest.fixture(scope="module")
def cloud():
    """Blobs, noise, and a third of all rows equal."""
    rng = np.random.default_rng(5)
    blobs = np.concatenate([rng.normal(c, 0.15, (25, 3)) for c in ([0, 0, 0], [2, 0, 1], [0, 3, 0])])
    return np.concatenate([blobs, rng.uniform(-2, 4, (15, 3)), np.tile([[2.0, 0.0, 1.0]], (45, 1))])


def distances(points):
    return np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))


@pytest.mark.parametrize("space", [{}, MANY_CELLS])
@pytest.mark.parametrize("include_self", [True, False])
def test_knn(spark, cloud, space, include_self):
    k, d = 6, distances(cloud)
    found = neighbors.knn(frame(spark, cloud), k, include_self=include_self, **space).collect()
    got = {}
    for r in found:
        got.setdefault(r["review_id"], {})[r["rank"]] = r["neighbour"]
    for i in range(len(cloud)):
        order = sorted((j for j in range(len(cloud)) if include_self or j != i), key=lambda j: (d[i, j], j))[:k]
        assert [got[i][n + 1] for n in range(k)] == order


def brute_dbscan(points, eps, min_samples):
    near = distances(points) <= eps
    core = near.sum(1) >= min_samples
    label, n = np.full(len(points), -1), 0
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], n
        while stack:
            for j in np.flatnonzero(near[stack.pop()]):
                if core[j] and label[j] < 0:
                    label[j] = n
                    stack.append(j)
        n += 1
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        label[i] = reach.min() if len(reach) else -1
    return label


@pytest.mark.parametrize("eps, min_samples, space", [
    (0.3, 4, {}), (0.3, 4, MANY_CELLS), (0.6, 8, MANY_CELLS), (1.5, 20, MANY_CELLS), (0.05, 3, MANY_CELLS), (0.01, 60, {}),
])
def test_dbscan(spark, cloud, eps, min_samples, space):
    rows = dbscan.dbscan(frame(spark, cloud), eps, min_samples, **space).collect()
    found = np.array([r["cluster"] for r in sorted(rows)])
    assert found.tolist() == brute_dbscan(cloud, eps, min_samples).tolist()


def test_dbscan_toy_set(spark):
    points = [[1, 2], [1.1, 2.1], [0.9, 1.8], [8, 8], [8.2, 7.9], [7.9, 8.1], [5, 0], [5.1, 0.1], [4.9, -0.1], [20, 20]]
    scaled = reduce.standardize(frame(spark, points))
    rows = sorted(dbscan.dbscan(scaled, 0.5, 2).select("review_id", "cluster").collect())
    labels = [r["cluster"] for r in rows]
    assert labels[:3] == [0] * 3 and len(set(labels[3:6])) == 1 and len(set(labels[6:9])) == 1 and labels[9] == -1


def brute_density(points, min_cluster_size, min_samples):
    """The hierarchy by direct recursion over all edge weights."""
    d = distances(points)
    core = np.sort(d, axis=1)[:, min_samples]
    mr = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(mr, np.inf)

    def parts(nodes, below):
        left, out = set(nodes), []
        while left:
            stack = [left.pop()]
            part = set(stack)
            while stack:
                i = stack.pop()
                new = [j for j in left if mr[i, j] < below]
                left.difference_update(new)
                part.update(new)
                stack.extend(new)
            out.append(part)
        return out

    weights = sorted({w for w in mr[np.isfinite(mr)]}, reverse=True)

    def grow(nodes, birth, start):
        stability, alive = 0.0, set(nodes)
        for at in range(start, len(weights)):
            w = weights[at]
            if w == 0:
                break
            big = [p for p in parts(alive, w) if len(p) >= min_cluster_size]
            kept = set().union(*big) if big else set()
            if len(big) == 1:
                stability += (len(alive) - len(kept)) * (1 / w - birth)
                alive = kept
                continue
            stability += len(alive) * (1 / w - birth)
            return [(set(nodes), stability, [grow(p, 1 / w, at + 1) for p in big])]
        return [(set(nodes), stability, [])]

    def pick(tree):
        nodes, stability, children = tree[0]
        chosen = [pick(c) for c in children]
        below = sum(s for s, _ in chosen)
        return (stability, [nodes]) if stability >= below else (below, [n for _, ns in chosen for n in ns])

    root = grow(range(len(points)), 0.0, 0)
    clusters = [n for c in root[0][2] for n in pick(c)[1]]
    label = np.full(len(points), -1)
    for n, nodes in enumerate(sorted(clusters, key=min)):
        label[list(nodes)] = n
    return label


@pytest.mark.parametrize("min_cluster_size, min_samples, space", [(5, 3, MANY_CELLS), (10, 5, {}), (4, 1, {})])
def test_density_is_exact(spark, min_cluster_size, min_samples, space):
    rng = np.random.default_rng(11)
    points = np.concatenate([rng.normal(c, s, (18, 2)) for c, s in (([0, 0], 0.1), ([1.2, 0], 0.2), ([4, 4], 0.3))] + [rng.uniform(-2, 6, (6, 2))])
    rows = density.density_clusters(frame(spark, points), min_cluster_size, min_samples, **space).collect()
    found = [r["cluster"] for r in sorted(rows)]
    expected = brute_density(points, min_cluster_size, min_samples).tolist()
    first_seen = lambda labels: [{x: i for i, x in reversed(list(enumerate(labels)))}[x] if x >= 0 else -1 for x in labels]
    assert first_seen(found) == first_seen(expected)


def test_components_on_chain_star_and_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(60)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(61)} == {100} and {got[200 + i] for i in range(9)} == {200}
    assert len(got) == 111


def test_copies_collapse(spark, cloud):
    copies = collapse_copies(frame(spark, cloud), "review_id")
    assert copies.rows == 135 and copies.size == 91
    assert copies.points.agg(F.max("weight"), F.sum("weight")).first() == (45, 135)


def test_davies_bouldin_blocks_and_guards(spark, cloud):
    df = kmeans.kmeans(frame(spark, cloud), 6)
    stats = metrics.spreads(df, "cluster").persist()
    small = dict(map(tuple, metrics.worst_ratios(stats, "cluster", 6, block=2).collect()))
    whole = dict(map(tuple, metrics.worst_ratios(stats, "cluster", 6).collect()))
    assert small == pytest.approx(whole)
    assert metrics.davies_bouldin(df.withColumn("cluster", F.lit(1)), "cluster").first()["dbi"] is None


def test_lloyd_steps_never_cost_more(spark, cloud):
    df, centres, costs = frame(spark, cloud), cloud[[0, 30, 60, 80]], []
    for _ in range(4):
        assigned = kmeans.assign_nearest(df, centres)
        moved = kmeans.lloyd_update(assigned).orderBy("cluster").collect()
        labels = np.array([r["cluster"] for r in sorted(assigned.select("review_id", "cluster").collect())])
        costs.append(((cloud - centres[labels]) ** 2).sum())
        for r in moved:
            centres[r["cluster"]] = r["centroid"]
    assert all(a >= b - 1e-9 for a, b in zip(costs, costs[1:]))


def test_restarts_keep_the_cheapest(spark, cloud):
    df = frame(spark, cloud)
    single = [kmeans.fit_kmeans(df, 4, seed=42 + i).summary.trainingCost for i in range(3)]
    assert kmeans.fit_kmeans(df, 4, seed=42, n_init=3).summary.trainingCost == pytest.approx(min(single))


def test_pca_is_centred_and_orthogonal(spark, cloud):
    projected, kept = reduce.pca(frame(spark, cloud + 5), 2)
    x = np.array([r["embedding_pca"] for r in projected.collect()])
    cov = np.cov(cloud.T)
    assert np.abs(x.mean(0)).max() < 1e-5 and abs((x[:, 0] * x[:, 1]).mean()) < 1e-5
    assert kept == pytest.approx(100 * np.sort(np.linalg.eigvalsh(cov))[-2:].sum() / np.trace(cov), abs=1e-6)


def test_local_scale_meets_its_target(spark, cloud):
    d = distances(cloud[:60])
    lists = [sorted(row)[1:10] for row in d.tolist()]
    df = spark.createDataFrame([(x, x[0]) for x in lists], "ds array<double>, rho double")
    sigmas = [r[0] for r in df.select(reduce.local_scale(F.col("ds"), F.col("rho"), float(np.log2(10)))).collect()]
    for ds, sigma in zip(lists, sigmas):
        assert sum(np.exp(-(x - ds[0]) / sigma) for x in ds) == pytest.approx(np.log2(10), rel=1e-6)


def test_layout_separates_two_groups(spark):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(0, 0.2, (20, 2)), rng.normal(1.5, 0.2, (20, 2))])
    laid = reduce.neighbour_reduction(frame(spark, points), 1, 10).collect()
    x = np.array([r["embedding_umap_15"][0] for r in sorted(laid, key=lambda r: r["review_id"])])
    assert (x[:20].mean() > 0) != (x[20:].mean() > 0)


def test_vector_check(spark):
    assert reduce.check_vectors(frame(spark, [[1, 2], [3, 4]])) == 2
    with pytest.raises(ValueError):
        reduce.check_vectors(frame(spark, [[1, 2], [3]]))
    with pytest.raises(TypeError):
        reduce.check_vectors(spark.range(1).withColumn("vec", F.lit(1)))


def test_density_takes_any_key(spark, cloud):
    small = density.density_clusters(frame(spark, cloud[:40]), 5, 3)
    wide = frame(spark, cloud[:40]).withColumn("review_id", F.col("review_id") + F.lit(2**62))
    large = density.density_clusters(wide, 5, 3)
    assert sorted((r["review_id"] - 2**62, r["cluster"]) for r in large.collect()) == sorted((r["review_id"], r["cluster"]) for r in small.collect())


def test_vectors_travel_a_bounded_number_of_times():
    """As cells grow in number, the regions that vectors are sent to do not; a hot cell is a region of its own."""
    from starglean.operators import space

    rng = np.random.default_rng(5)
    for cells in (40, 400, 1600):
        sizes = rng.integers(1, 4000, cells).astype(float)
        region = space.group_cells(rng.normal(size=(cells, 8)), sizes, int(sizes.sum()) * 4 // (3 * space.REGIONS))
        assert 8 <= region.max() + 1 <= 2 * space.REGIONS and (np.bincount(region) > 0).all()
    assert space.group_cells(np.array([[0.0], [1.0], [9.0]]), np.array([1.0, 2.0, 900.0]), 5).tolist() in ([0, 0, 1], [1, 1, 0])


def test_each_query_meets_the_cells_it_visits():
    import pyarrow as pa

    from starglean.operators import space

    rng = np.random.default_rng(6)
    q, x = rng.normal(size=(30, 3)), rng.normal(size=(40, 3))
    cell = np.sort(rng.integers(0, 6, 40))
    visits = [sorted(rng.choice(6, rng.integers(0, 7), replace=False).tolist()) for _ in q]
    found = sorted((int(i), int(j)) for qi, xi, _ in space.near_pairs(q, x, np.full(30, 1.2), space._parts(pa.array(visits, pa.list_(pa.int32())), cell)) for i, j in zip(qi, xi))
    assert found == [(i, j) for i in range(30) for j in range(40) if cell[j] in visits[i] and np.linalg.norm(q[i] - x[j]) <= 1.2]


def test_a_vector_is_sent_to_a_dozen_blocks_or_so():
    """Regions that a query visits, and blocks of visitors that a row is sent to, in a space without pruning."""
    from starglean.operators import space

    rng = np.random.default_rng(7)
    sizes = rng.integers(1000, 3000, 200).astype(float)
    rows = int(sizes.sum()) * 4 // (3 * space.REGIONS)
    regions = space.group_cells(rng.normal(size=(200, 8)), sizes, rows).max() + 1
    assert regions + np.ceil(sizes.sum() / rows) <= 16


def test_a_vector_is_sent_to_as_many_blocks_in_a_small_space_as_in_a_large_one():
    from starglean.operators import space

    rng = np.random.default_rng(8)
    for cells in (8, 16, 64, 256):
        built = space.Space(rng.normal(size=(cells, 64)), None, np.full(cells, 2048.0))
        rows = space.block_size(built)
        regions = space.group_cells(built.pivots, built.sizes, rows).max() + 1
        assert regions + np.ceil(cells * 2048 / rows) == 14


def test_vectors_exact_in_single_precision_travel_as_floats(spark):
    rng = np.random.default_rng(9)
    exact = np.concatenate([rng.normal(size=(70, 4)).astype(np.float32).astype(float), np.tile([[0.5, -2.0, 0.0, 3.0]], (9, 1))])
    for points, kind in ((exact, "array<float>"), (exact + 1e-12, "array<double>"), (exact * 1e60, "array<double>")):
        copies = collapse_copies(frame(spark, points), "review_id")
        assert dict(copies.points.dtypes)["vec"] == kind and (copies.rows, copies.size) == (79, 71)
        assert np.array([r["vec"] for r in copies.points.orderBy("point").collect()]).tolist() == points[:71].tolist()
        d = distances(points)
        for where in ({}, MANY_CELLS):
            found = {(r["review_id"], r["rank"]): (r["neighbour"], r["distance"]) for r in neighbors.knn(frame(spark, points), 3, **where).collect()}
            for i in range(len(points)):
                best = sorted((d[i, j], j) for j in range(len(points)))[:3]
                assert [found[i, n + 1][0] for n in range(3)] == [j for _, j in best]
                assert np.allclose([found[i, n + 1][1] for n in range(3)], [x for x, _ in best], rtol=1e-12, atol=0)


def test_a_component_that_differs_beyond_single_precision_is_no_copy(spark):
    copies = collapse_copies(frame(spark, [[1.0, 2.0], [1.0 + 1e-12, 2.0], [1.0, 2.0]]), "review_id")
    assert copies.size == 2 and sorted(tuple(r) for r in copies.members.collect()) == [(0, 0), (1, 1), (2, 0)]


def test_components_in_one_task_and_by_steps(spark):
    draw = np.random.default_rng(11)
    edges = spark.createDataFrame(draw.integers(0, 60, (40, 2)).tolist() + [[7, 7], [90, 91], [91, 90]], "src long, dst long")
    one, steps = (sorted(map(tuple, components.components(edges, task_edges=most).collect())) for most in (components.TASK_EDGES, 0))
    assert one == steps and (91, 90) in one


@pytest.mark.parametrize("kind", ["float32", "float64"])
def test_streamed_packs_give_the_nearest(spark, monkeypatch, kind):
    """Vectors that all cells must look into pass by in packs; copies and outliers among them."""
    draw = np.random.default_rng(12)
    points = draw.random((150, 20)).astype(kind).astype(float)
    points[:5], points[5:10] = points[20:25], points[5:10] + 50
    d, k, streamed = distances(points), 7, []
    monkeypatch.setattr(neighbors, "STREAM_ROWS", 0)
    monkeypatch.setattr(neighbors, "PACK_ROWS", 40)
    monkeypatch.setattr(neighbors, "_streamed", lambda *given, inner=neighbors._streamed: streamed.append(1) or inner(*given))
    got = {}
    for r in neighbors.knn(frame(spark, points), k, **MANY_CELLS).collect():
        got.setdefault(r["review_id"], {})[r["rank"]] = r["neighbour"]
    assert streamed
    for i in range(len(points)):
        assert [got[i][n + 1] for n in range(k)] == sorted(range(len(points)), key=lambda j: (d[i, j], j))[:k]


@pytest.mark.parametrize("scale", [1e-12, 1.0, 1e9])
def test_pairs_found_in_single_precision_are_all(scale):
    draw = np.random.default_rng(13)
    points = np.concatenate([draw.normal(0, 0.01, (60, 24)), draw.normal(3, 0.01, (60, 24)), draw.normal(0, 40, (6, 24))]) * scale
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    limits = np.sort(d, axis=1)[:, 9]
    pairs = {(a, b) for q, x, _ in near_pairs(points, points, limits, [(np.arange(126), 0, 126)]) for a, b in zip(q.tolist(), x.tolist())}
    assert pairs == {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= limits[:, None]))}
