"""Vectors: distances, neighbours, clustering, evaluation, reduction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ...functions import vectors as v
from ...operators import dbscan as db
from ...operators import density, kmeans, metrics, multistart, neighbors, reduce, spectral
from ...schema import KEY
from ...session import cut_lineage
from ...sources import views
from .registry import POINTS, POINTS2, query


def _labelled(spark, sf):
    return views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias(KEY), F.col("embedding").cast("array<double>").alias("vec"), "label")


def _long(df, vec="vec", *keep):
    return df.select(KEY, *keep, F.posexplode(vec).alias("pos", "x")).withColumn("x", F.round("x", 6) + 0.0)


def _long_sql(expr: str, source: str = "points") -> str:
    return f"""SELECT review_id, CAST(pos AS INTEGER) AS pos, round(x, 6) + 0.0 AS x
      FROM (SELECT review_id, unnest({expr}) AS x, generate_subscripts({expr}, 1) - 1 AS pos FROM {source})"""


PAIRS = "pairs AS (SELECT p.review_id, o.review_id AS neighbour, list_distance(p.vec, o.vec) AS d FROM points p, points o)"


def _knn_sql(points: str, k: int, self_: bool = True) -> str:
    drop = "" if self_ else "WHERE review_id <> neighbour"
    return f"""WITH {points}, {PAIRS}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS rank FROM pairs {drop})
      SELECT review_id, neighbour, CAST(rank AS INTEGER) AS rank, round(d, 6) AS distance FROM ranked WHERE rank <= {k}"""


def _knn_out(df):
    return df.select(KEY, "neighbour", F.col("rank").cast("int").alias("rank"), F.round("distance", 6).alias("distance"))


@query("c4_knn_self_join", _knn_sql(POINTS, 5))
def _(spark, sf):
    return _knn_out(neighbors.knn(views.points(spark, sf), 5))


@query("c4_knn_without_self", _knn_sql(POINTS2, 3, False))
def _(spark, sf):
    return _knn_out(neighbors.knn(views.points2(spark, sf), 3, include_self=False))


@query("c4_knn_without_self_whole", _knn_sql(POINTS, 3, False))
def _(spark, sf):
    return _knn_out(neighbors.knn(views.points(spark, sf), 3, include_self=False))


#: A reach at which whole vectors have some neighbours.
EPS = 1.15


@query("c5_eps_neighbourhood_whole", f"WITH {POINTS}, {PAIRS} SELECT review_id, count(*) AS degree FROM pairs WHERE d <= {EPS} GROUP BY review_id")
def _(spark, sf):
    return db.neighbourhood_sizes(views.points(spark, sf), EPS)


@query("c5_eps_neighbourhood", f"WITH {POINTS2}, {PAIRS} SELECT review_id, count(*) AS degree FROM pairs WHERE d <= 0.02 GROUP BY review_id")
def _(spark, sf):
    return db.neighbourhood_sizes(views.points2(spark, sf), 0.02)


def _seeds(spark, sf) -> np.ndarray:
    """Starting centroids: the mean vector of each label."""
    means = metrics.centroids(_labelled(spark, sf), "label").orderBy("label").select("centroid").collect()
    return np.array([m["centroid"] for m in means])


CENTROIDS = """dims AS (SELECT label, generate_subscripts(vec, 1) AS pos, unnest(vec) AS x FROM points),
  means AS (SELECT label, pos, avg(x) AS m FROM dims GROUP BY label, pos),
  seeds AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS cluster, list(m ORDER BY pos) AS c FROM means GROUP BY label)"""
ASSIGNED = f"""{POINTS}, {CENTROIDS},
  near AS (SELECT review_id, vec, cluster, row_number() OVER (PARTITION BY review_id ORDER BY list_distance(vec, c), cluster) AS r FROM points, seeds),
  assigned AS (SELECT review_id, vec, CAST(cluster AS INTEGER) AS cluster FROM near WHERE r = 1)"""


@query("c6_nearest_centroid", f"WITH {ASSIGNED} SELECT review_id, cluster FROM assigned")
def _(spark, sf):
    return kmeans.assign_nearest(views.points(spark, sf), _seeds(spark, sf)).select(KEY, "cluster")


@query("i7_lloyd_update", f"""WITH {ASSIGNED}, d AS (SELECT cluster, generate_subscripts(vec, 1) - 1 AS pos, unnest(vec) AS x FROM assigned)
  SELECT cluster, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) + 0.0 AS x FROM d GROUP BY cluster, pos""")
def _(spark, sf):
    moved = kmeans.lloyd_update(kmeans.assign_nearest(views.points(spark, sf), _seeds(spark, sf)))
    return moved.select("cluster", F.posexplode("centroid").alias("pos", "x")).withColumn("x", F.round("x", 6) + 0.0)


def _db_sql(points: str, label: str, where: str = "TRUE") -> str:
    return f"""{points}, used AS (SELECT {label} AS label, vec FROM points WHERE {where}),
  dims AS (SELECT label, generate_subscripts(vec, 1) AS pos, unnest(vec) AS x FROM used),
  means AS (SELECT label, pos, avg(x) AS m FROM dims GROUP BY label, pos),
  cents AS (SELECT label, list(m ORDER BY pos) AS c FROM means GROUP BY label),
  s AS (SELECT label, c, avg(list_distance(vec, c)) AS s FROM used JOIN cents USING (label) GROUP BY label, c),
  ratios AS (SELECT a.label, a.s AS si, max((a.s + b.s) / list_distance(a.c, b.c)) AS ratio FROM s a JOIN s b ON a.label <> b.label GROUP BY ALL)"""


@query("c7_centroid_pairs", f"WITH {_db_sql(POINTS, 'label')} SELECT label, round(si, 6) AS spread, round(ratio, 6) AS ratio FROM ratios")
def _(spark, sf):
    stats = cut_lineage(metrics.spreads(_labelled(spark, sf), "label"))
    worst = metrics.worst_ratios(stats, "label", stats.count())
    return stats.select("label", "spread", F.xxhash64("label").alias("cluster_id")).join(worst, F.col("cluster_id") == F.col("id")).select(
        "label", F.round("spread", 6).alias("spread"), F.round("ratio", 6).alias("ratio"))


@query("i9_davies_bouldin", f"WITH {_db_sql(POINTS, 'label')} SELECT round(avg(ratio), 6) AS dbi FROM ratios")
def _(spark, sf):
    return metrics.davies_bouldin(_labelled(spark, sf), "label").select(F.round("dbi", 6).alias("dbi"))


@query("i10_davies_bouldin_noise", f"""WITH a AS (WITH {_db_sql(POINTS, 'label - 1', 'label - 1 <> -1')} SELECT round(avg(ratio), 6) AS without_noise FROM ratios),
  b AS (WITH {_db_sql(POINTS, 'label - 1')} SELECT round(avg(ratio), 6) AS with_noise FROM ratios) SELECT * FROM a, b""")
def _(spark, sf):
    rows = _labelled(spark, sf).withColumn("cluster_dbscan", F.col("label") - 1)
    score = lambda drop: metrics.davies_bouldin(rows, "cluster_dbscan", exclude_noise=drop).first()["dbi"]
    return spark.range(1).select(F.round(F.lit(score(True)), 6).alias("without_noise"), F.round(F.lit(score(False)), 6).alias("with_noise"))


def _probabilities():
    return v.softmax(F.slice("vec", 1, 5))


_LOGITS = "e AS (SELECT review_id, list_transform(vec[1:5], lambda x: exp(x - list_max(vec[1:5]))) AS e FROM points)"


@query("h7_expected_class", f"""WITH {POINTS}, {_LOGITS}
  SELECT review_id, round((e[1] + 2 * e[2] + 3 * e[3] + 4 * e[4] + 5 * e[5]) / list_sum(e), 6) AS expected FROM e""")
def _(spark, sf):
    return views.points(spark, sf).select(KEY, F.round(v.expected_class(_probabilities()), 6).alias("expected"))


@query("h7_expected_class_whole", f"""WITH {POINTS}, e AS (SELECT review_id, list_transform(vec, lambda x: exp(x - list_max(vec))) AS e FROM points)
  SELECT review_id, round(list_dot_product(e, list_transform(range(1, len(e) + 1), lambda i: CAST(i AS DOUBLE))) / list_sum(e), 6) AS expected FROM e""")
def _(spark, sf):
    return views.points(spark, sf).select(KEY, F.round(v.expected_class(v.softmax(F.col("vec"))), 6).alias("expected"))


@query("h8_vector_check", "SELECT CAST(max(len(embedding)) AS BIGINT) AS dims, count(*) AS n FROM embeddings HAVING min(len(embedding)) = max(len(embedding))")
def _(spark, sf):
    rows = views.points(spark, sf)
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(reduce.check_vectors(rows)).cast("bigint").alias("dims"), "n")


@query("h9_l2_normalize", f"WITH {POINTS2}, n AS (SELECT review_id, list_transform(vec, lambda x: x / sqrt(vec[1] * vec[1] + vec[2] * vec[2])) AS u FROM points) {_long_sql('u', 'n')}")
def _(spark, sf):
    return _long(views.points2(spark, sf).withColumn("vec", v.l2_normalize(F.col("vec"))))


@query("h9_l2_normalize_whole", f"WITH {POINTS}, n AS (SELECT review_id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS u FROM points) {_long_sql('u', 'n')}")
def _(spark, sf):
    return _long(views.points(spark, sf).withColumn("vec", v.l2_normalize(F.col("vec"))))


@query("h10_distances", f"""WITH {ASSIGNED} SELECT review_id, round(list_distance(a.vec, s.c), 6) AS euclidean, round(1 - list_cosine_similarity(a.vec, s.c), 6) AS cosine
  FROM assigned a JOIN seeds s USING (cluster)""")
def _(spark, sf):
    seeds = _seeds(spark, sf)
    assigned = kmeans.assign_nearest(views.points(spark, sf), seeds)
    # One short constant array per cluster; the assigned one is looked up by index.
    centre = F.element_at(F.array(*[v.literal_vector(c) for c in seeds]), F.col("cluster") + 1)
    return assigned.select(KEY, F.round(v.euclidean(F.col("vec"), centre), 6).alias("euclidean"),
                           F.round(v.cosine_distance(F.col("vec"), centre), 6).alias("cosine"))


@query("e2_sorted_distance_position", f"""WITH {POINTS}, {PAIRS}, r AS (SELECT review_id, d, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs)
  SELECT review_id, round(d, 6) AS distance, row_number() OVER (ORDER BY d, review_id) AS position FROM r WHERE k = 2""")
def _(spark, sf):
    curve = neighbors.k_distance_curve(views.points(spark, sf), 2)
    return curve.select(KEY, F.round("distance", 6).alias("distance"), "position")


@query("i13_eps_suggestion", f"""WITH {POINTS2}, {PAIRS}, r AS (SELECT review_id, d, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs)
  SELECT round(quantile_cont(d, 0.95), 6) AS eps FROM r WHERE k = 5""")
def _(spark, sf):
    return neighbors.suggest_eps(neighbors.k_distance_curve(views.points2(spark, sf), 5)).select(F.round("eps", 6).alias("eps"))


@query("i13_eps_suggestion_whole", f"""WITH {POINTS}, {PAIRS}, r AS (SELECT review_id, d, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs)
  SELECT round(quantile_cont(d, 0.95), 6) AS eps FROM r WHERE k = 5""")
def _(spark, sf):
    return neighbors.suggest_eps(neighbors.k_distance_curve(views.points(spark, sf), 5)).select(F.round("eps", 6).alias("eps"))


def _dbscan_sql(eps: float, min_samples: int, points: str = POINTS2) -> str:
    return f"""WITH RECURSIVE {points}, {PAIRS}, near AS (SELECT review_id, neighbour FROM pairs WHERE d <= {eps}),
  core AS (SELECT review_id FROM near GROUP BY review_id HAVING count(*) >= {min_samples}),
  arcs AS (SELECT review_id AS a, neighbour AS b FROM near WHERE review_id IN (FROM core) AND neighbour IN (FROM core)),
  reach(a, b) AS (SELECT review_id, review_id FROM core UNION SELECT r.a, arcs.b FROM reach r JOIN arcs ON arcs.a = r.b),
  comp AS (SELECT b AS review_id, min(a) AS c FROM reach GROUP BY b),
  numbered AS (SELECT review_id, dense_rank() OVER (ORDER BY c) - 1 AS cluster FROM comp),
  border AS (SELECT n.review_id, min(k.cluster) AS cluster FROM near n JOIN numbered k ON k.review_id = n.neighbour
    WHERE n.review_id NOT IN (FROM core) GROUP BY n.review_id)
  SELECT p.review_id, CAST(coalesce(k.cluster, b.cluster, -1) AS INTEGER) AS cluster, k.cluster IS NOT NULL AS is_core
  FROM points p LEFT JOIN numbered k USING (review_id) LEFT JOIN border b USING (review_id)"""


@query("i11_dbscan", _dbscan_sql(0.02, 4))
def _(spark, sf):
    return db.dbscan(views.points2(spark, sf), 0.02, 4)


@query("i11_dbscan_five", _dbscan_sql(0.02, 5))
def _(spark, sf):
    return db.dbscan(views.points2(spark, sf), 0.02, 5)


@query("i11_dbscan_whole", _dbscan_sql(EPS, 4, POINTS))
def _(spark, sf):
    return db.dbscan(views.points(spark, sf), EPS, 4)


@query("i12_core_distance_whole", f"""WITH {POINTS}, {PAIRS}, r AS (SELECT review_id, d, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs)
  SELECT review_id, round(d, 6) AS core FROM r WHERE k = 6""")
def _(spark, sf):
    return density.core_distances(views.points(spark, sf), 5).select(KEY, F.round("core", 6).alias("core"))


# The lightest link between two parts is taken again and again; the parts are a list of labels.
@query("i12_spanning_tree", f"""WITH RECURSIVE {POINTS}, {PAIRS},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs),
  cores AS (SELECT review_id, d AS core, row_number() OVER (ORDER BY review_id) AS i FROM ranked WHERE k = 6),
  links AS MATERIALIZED (SELECT x.i AS a, y.i AS b, greatest(d, x.core, y.core) AS w FROM pairs p JOIN cores x ON x.review_id = p.review_id JOIN cores y ON y.review_id = p.neighbour WHERE x.i < y.i),
  grown(step, labels, weight) AS (SELECT 0, list(i ORDER BY i), CAST(NULL AS DOUBLE) FROM cores
    UNION ALL SELECT step + 1, list_transform(labels, lambda x: CASE WHEN x = labels[best.b] THEN labels[best.a] ELSE x END), best.w FROM (
      SELECT step, labels, (SELECT min(ROW(w, a, b)::STRUCT(w DOUBLE, a BIGINT, b BIGINT)) FROM links WHERE labels[a] <> labels[b]) AS best FROM grown) WHERE best IS NOT NULL)
  SELECT round(weight, 6) AS weight FROM grown WHERE step > 0""")
def _(spark, sf):
    return density.spanning_tree(views.points(spark, sf), 5).select(F.round("weight", 6).alias("weight"))


@query("i12_density_clusters_whole")
def _(spark, sf):
    return density.density_clusters(views.points(spark, sf), min_cluster_size=10, min_samples=5)


@query("i12_core_distance", f"""WITH {POINTS2}, {PAIRS}, r AS (SELECT review_id, d, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs)
  SELECT review_id, round(d, 6) AS core FROM r WHERE k = 6""")
def _(spark, sf):
    return density.core_distances(views.points2(spark, sf), 5).select(KEY, F.round("core", 6).alias("core"))


@query("i12_density_clusters")
def _(spark, sf):
    return density.density_clusters(views.points2(spark, sf), min_cluster_size=10, min_samples=5)


@query("i15_standardize", f"""WITH {POINTS}, dims AS (SELECT review_id, generate_subscripts(vec, 1) - 1 AS pos, unnest(vec) AS x FROM points)
  SELECT review_id, CAST(pos AS INTEGER) AS pos, round((x - avg(x) OVER (PARTITION BY pos)) / stddev_pop(x) OVER (PARTITION BY pos), 6) + 0.0 AS x FROM dims""")
def _(spark, sf):
    return _long(reduce.standardize(views.points(spark, sf)))


@query("i5_kmeans")
def _(spark, sf):
    return kmeans.kmeans(views.points(spark, sf), 5).select(KEY, "cluster")


@query("i6_kmeans_restarts")
def _(spark, sf):
    model = kmeans.fit_kmeans(views.points(spark, sf), 5, n_init=3)
    return spark.createDataFrame([(5, float(model.summary.trainingCost))], "k int, inertia double")


@query("i8_sweep_k")
def _(spark, sf):
    return kmeans.sweep_k(views.points(spark, sf), [2, 3, 5])


#: The values of k in the sweep.
SWEEP = [2, 3, 4, 5, 6, 7, 8, 10]


@query("i6_kmeans_ten_starts")
def _(spark, sf):
    fits = multistart.fit_all(views.points(spark, sf), [5], n_init=10)
    return spark.createDataFrame([(f.k, f.start, f.inertia, f.rounds) for f in fits], "k int, start int, inertia double, rounds int")


@query("i8_sweep_all_k")
def _(spark, sf):
    return multistart.sweep(views.points(spark, sf), SWEEP)


@query("i8_sweep_recomputed", f"SELECT k, n AS rows, TRUE AS inertia_agrees, TRUE AS dbi_agrees FROM (SELECT unnest([{', '.join(map(str, SWEEP))}]) AS k), (SELECT count(*) AS n FROM embeddings)")
def _(spark, sf):
    """Inertia and index of every sweep, computed again from an assignment to its centres."""
    points = views.points(spark, sf)
    found = []
    for fit in multistart.best_fits(multistart.fit_all(points, SWEEP, n_init=1)):
        labelled = cut_lineage(kmeans.assign_nearest(points, fit.centres))
        centre = F.element_at(F.array(*[v.literal_vector(c) for c in fit.centres]), F.col("cluster") + 1)
        again = labelled.agg(F.sum(v.euclidean(F.col("vec"), centre) ** 2), F.count(F.lit(1))).first()
        far = fit.davies_bouldin() - metrics.davies_bouldin(labelled, "cluster").first()["dbi"]
        # The index takes centres as the means of their rows, which a run that stopped within its tolerance nearly meets.
        found.append((fit.k, again[1], bool(abs(again[0] - fit.inertia) <= 1e-6 * fit.inertia), bool(abs(far) <= 1e-3)))
    return spark.createDataFrame(found, "k int, rows bigint, inertia_agrees boolean, dbi_agrees boolean")


@query("i14_pca")
def _(spark, sf):
    projected, kept = reduce.pca(views.points(spark, sf), 2)
    return projected.select(KEY, "embedding_pca", F.lit(kept).alias("retained_pct"))


def _fuzzy_sql(points: str) -> str:
    return f"""WITH {points}, {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY d, neighbour) AS k FROM pairs),
  o AS (SELECT * FROM r WHERE k <= 15 AND review_id <> neighbour), l AS (SELECT review_id, coalesce(min(d) FILTER (d > 0), 0) AS rho FROM o GROUP BY review_id),
  w AS (SELECT least(review_id, neighbour) AS a, greatest(review_id, neighbour) AS b, exp(-greatest(d - rho, 0) / 1.0) AS w FROM o JOIN l USING (review_id))
  SELECT a, b, round(sum(w) - CASE WHEN count(*) = 2 THEN max(w) * min(w) ELSE 0 END, 6) AS weight FROM w GROUP BY a, b"""


@query("i17_fuzzy_graph_unit_scale_whole", _fuzzy_sql(POINTS))
def _(spark, sf):
    return reduce.fuzzy_graph(views.points(spark, sf), 15, sigma=1.0).select("a", "b", F.round("weight", 6).alias("weight"))


@query("i17_fuzzy_graph_unit_scale", _fuzzy_sql(POINTS2))
def _(spark, sf):
    return reduce.fuzzy_graph(views.points2(spark, sf), 15, sigma=1.0).select("a", "b", F.round("weight", 6).alias("weight"))


@query("i17_fuzzy_graph")
def _(spark, sf):
    return reduce.fuzzy_graph(views.points(spark, sf), 15, metric="cosine")


@query("i18_spectral_layout")
def _(spark, sf):
    return spectral.spectral_layout(reduce.fuzzy_graph(views.points2(spark, sf), 15), 2)


@query("i18_spectral_layout_whole")
def _(spark, sf):
    return spectral.spectral_layout(reduce.fuzzy_graph(views.points(spark, sf), 15), 2)


@query("i18_spectral_residual", "SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS pos, TRUE AS small")
def _(spark, sf):
    """Whether each coordinate, put back on the edges, is an eigenvector to 0.000002."""
    graph = cut_lineage(reduce.fuzzy_graph(views.points(spark, sf), 15))
    laid = spectral.spectral_layout(graph, 3)
    return spectral.residuals(graph, laid, 3).select("pos", (F.col("residual") <= 2e-6).alias("small"))


#: The least share of ten nearest rows that a layout in three dimensions keeps; chance would keep one in fifty at most.
KEPT = 0.15


@query("i16_neighbours_kept", "SELECT TRUE AS enough")
def _(spark, sf):
    """Whether the layout keeps enough of each row's nearest rows."""
    points = views.points(spark, sf)
    laid = cut_lineage(reduce.neighbour_reduction(points, 3, 15, metric="cosine"))
    return reduce.neighbours_kept(points, laid, 10).select((F.col("kept") >= KEPT).alias("enough"))


@query("i16_neighbour_reduction")
def _(spark, sf):
    return reduce.neighbour_reduction(views.points(spark, sf), 3, 15, metric="cosine")
