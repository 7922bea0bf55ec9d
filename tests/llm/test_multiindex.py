import numpy as np
import pytest

from starglean.llm import multiindex


def brute(rows):
    """Links and components of all rows by the full cosine matrix."""
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = np.array([rows[k][1] for k in ok], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(ok))
    while True:
        new = np.array([min([label[k], *label[near[k]]]) for k in range(len(ok))])
        new = new[new]
        if (new == label).all():
            break
        label = new
    least = {}
    for k, r in zip(label, ok):
        least[k] = min(least.get(k, rows[r][0]), rows[r][0])
    out = [[i, 0, i, i is not None] for i, _ in rows]
    for k, r in enumerate(ok):
        out[r] = [rows[r][0], int(near[k].sum()), least[label[k]], rows[r][0] == least[label[k]]]
    return sorted(map(tuple, out), key=repr)


def got(frame):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect()), key=repr)


def test_clustered_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(60, 16))
    points = centres[draw.integers(0, 60, 900)] + 0.25 * draw.normal(size=(900, 16))
    rows = [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)] + [(900 + i, [float(np.float32(x)) for x in points[0]]) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    expected = brute(rows)
    found = got(multiindex.links(frame))
    links = sum(r[1] for r in expected)
    assert sum(r[1] for r in found) >= 0.99 * links
    assert all(a[1] <= b[1] for a, b in zip(sorted(found, key=lambda r: r[0]), sorted(expected, key=lambda r: r[0])))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []),
            (None, [1.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (9, [-1.0, 0.0]), (9, None), (0, [0.99, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("vec_id", "embedding", "1 AS id", "2 AS weight", "3 AS n_links")
    assert got(multiindex.links(frame)) == brute(rows)
    assert multiindex.links(frame.limit(0)).collect() == []
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    with pytest.raises(ValueError):
        multiindex.links(uneven)


def test_recall_on_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected, found = brute(rows), got(multiindex.links(table))
    assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in expected)
    assert found == expected


def test_traversal_visits_until_the_rest_is_small():
    a, b = np.array([1.0, 0.2, 0.001]), np.array([0.1, 1.0, 0.0])
    i, j = multiindex.visited_cells(a, b, 0.01)
    left = np.outer(a, b).sum() - (a[i] * b[j]).sum()
    assert left < 0.01 and (i[0], j[0]) == (0, 1)


def test_recall_of_one_finds_links_in_any_direction(spark):
    """Differences along one axis, vectors near a circle, a falling spectrum: the traversal by bounds loses none."""
    rng = np.random.default_rng(44)
    base = rng.normal(size=(500, 16))
    axis = np.concatenate([base, base + np.eye(16)[rng.integers(16, size=500)] * rng.uniform(0.5, 1.6, (500, 1))])
    angle = rng.uniform(0, 2 * np.pi, 600)
    circle = np.concatenate([np.stack([np.cos(angle), np.sin(angle)], 1), rng.normal(0, 0.05, (600, 14))], axis=1)
    spectrum = rng.normal(size=(700, 16)) / np.arange(1, 17)
    for x in (axis, circle, spectrum):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = unit @ unit.T >= 0.95
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
        got = {r.vec_id: r.n_links for r in multiindex.links(df, recall=1.0).collect()}
        assert got == dict(enumerate((near.sum(1) - 1).tolist()))
