"""Clustering (L4, L6-L8) and cluster-quality metrics.

K-Means and PCA are MLlib (distributed); Ward is in ``models/ward.py``. Quality metrics
are aggregates: inertia and scatter are sums of distances to the row's
centroid, Davies-Bouldin joins the k centroids with themselves. The silhouette
is the exact Euclidean one (``models/silhouette.py``, for profiles: quadratic
work); ``squared_silhouette`` is MLlib's linear form for tables of facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.operators.materialize import materialize
from citypulse.operators.models.silhouette import silhouette
from citypulse.operators.models.ward import ward


def _vec(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def kmeans_restarts(df: DataFrame, cols: Sequence[str], k: int, n_init: int = 10,
                    seed: int = 42, max_iter: int = 300):
    """L4: ``n_init`` K-Means fits with different seeds, keep the lowest
    inertia (sklearn's restarts). Returns (model, assigned DataFrame, cost)."""
    # iterative fits read the input many times: cut its lineage first
    data = materialize(_vec(df, cols))

    def one(i: int):
        km = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=1e-6, featuresCol="features",
                    predictionCol="cluster_id", initMode="k-means||")
        m = km.fit(data)
        return i, m, m.summary.trainingCost

    # independent restarts: submitted concurrently, Spark schedules the jobs
    with ThreadPoolExecutor(max_workers=min(n_init, 8)) as pool:
        fits = sorted(pool.map(one, range(n_init)), key=lambda t: t[0])
    best = min(fits, key=lambda t: (round(t[2], 12), t[0]))
    model = best[1]
    return model, model.transform(data).drop("features"), best[2]


def _mean_distance(assigned: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(label, n, centroid struct, sse, scatter): one row per cluster."""
    cents = assigned.groupBy(label).agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("_c"))
    joined = assigned.join(cents, label)
    square = sum((F.pow(F.col(c) - F.col(f"_c.{c}"), 2) for c in cols), F.lit(0.0))
    per = joined.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(square).alias("sse"),
                                    F.avg(F.sqrt(square)).alias("scatter"))
    return per.join(cents, label)


def inertia(assigned: DataFrame, cols: Sequence[str], label: str = "cluster_id") -> DataFrame:
    """Sum of squared distances to the cluster means."""
    return _mean_distance(assigned, cols, label).agg(F.sum("sse").alias("inertia"))


def davies_bouldin(assigned: DataFrame, cols: Sequence[str], label: str = "cluster_id") -> DataFrame:
    """Mean over clusters of the worst (scatter_i + scatter_j) / distance
    of centroids; the self-join is over the k centroids. NULL for k < 2."""
    per = _mean_distance(assigned, cols, label)
    left = per.select(F.lit(1).alias("g"), F.col(label).alias("i"), F.col("scatter").alias("si"), F.col("_c").alias("ci"))
    right = per.select(F.lit(1).alias("g"), F.col(label).alias("j"), F.col("scatter").alias("sj"), F.col("_c").alias("cj"))
    apart = F.sqrt(sum((F.pow(F.col(f"ci.{c}") - F.col(f"cj.{c}"), 2) for c in cols), F.lit(0.0)))
    ratio = F.when(apart > 0, (F.col("si") + F.col("sj")) / apart).otherwise(F.lit(float("inf")))
    worst = left.join(right, "g").where("i != j").groupBy("i").agg(F.max(ratio).alias("r"))
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def squared_silhouette(assigned: DataFrame, cols: Sequence[str], label: str = "cluster_id") -> float | None:
    """Squared-Euclidean silhouette; None where it is undefined (a single
    cluster, or no row)."""
    if len(assigned.select(label).distinct().limit(2).collect()) < 2:
        return None
    return float(ClusteringEvaluator(featuresCol="features", predictionCol=label).evaluate(
        _vec(assigned.withColumn(label, F.col(label).cast("int")), cols)))


def cluster_quality(assigned: DataFrame, cols: Sequence[str], label: str = "cluster_id") -> DataFrame:
    """M9-M11 of a labelled table: (k, silhouette, inertia, davies_bouldin)."""
    cols = list(cols)
    k = assigned.agg(F.countDistinct(label).alias("k"))
    s = silhouette(assigned, cols, label)
    return k.select("k", F.lit(s).cast("double").alias("silhouette"),
                    inertia(assigned, cols, label).select("inertia").scalar().alias("inertia"),
                    davies_bouldin(assigned, cols, label).select("davies_bouldin").scalar().alias("davies_bouldin"))


def choose_k(df: DataFrame, cols: Sequence[str], ks: Sequence[int], n_init: int = 10):
    """L4: try each k, keep the best silhouette (ties -> smaller k). The table
    has one row per candidate with its inertia (elbow, M10); a k that is not
    below the number of rows is reported as rejected."""
    rows, best = [], None
    df = materialize(df)
    n = df.count()
    for k in ks:
        if k >= n:
            rows.append((k, None, None, "rejected: not below the row count"))
            continue
        model, assigned, cost = kmeans_restarts(df, cols, k, n_init)
        s = silhouette(assigned, cols)
        rows.append((k, s, float(cost), "fitted"))
        if s is not None and (best is None or s > best[1] + 1e-12):
            best = (k, s, model, assigned)
    table = df.sparkSession.createDataFrame(rows, "k int, silhouette double, inertia double, status string")
    if best is None:
        raise ValueError(f"no k of {list(ks)} can be fitted to {n} rows")
    return best[0], best[2], best[3], table


def rank_labels(assigned: DataFrame, cols: Sequence[str], label: str = "cluster_id",
                names: Sequence[str] = ("Low risk", "Medium risk", "High risk")) -> DataFrame:
    """Order clusters by the mean of their centroid coordinates (pandas
    ``rank(method='first')``: ties by cluster id) and name them."""
    cents = assigned.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])
    comp = sum((F.col(c) for c in cols), F.lit(0.0)) / len(cols)
    ranked = cents.withColumn("composite", comp).withColumn(
        "rank", F.row_number().over(Window.orderBy("composite", label)))
    m = F.create_map(*[x for i, nm in enumerate(names, 1) for x in (F.lit(i), F.lit(nm))])
    ranked = ranked.withColumn("risk_level", F.coalesce(
        m[F.col("rank")], F.concat(F.lit("Cluster "), F.col("rank").cast("string"))))
    return assigned.join(ranked.select(label, "risk_level"), on=label)


def centroid_rule_labels(centroids: DataFrame, co2: str = "co2_kg", pm25: str = "pm25",
                         threshold: float = 0.4) -> DataFrame:
    """Name pollution clusters from their (scaled) centroid coordinates."""
    hi_c, hi_p = F.col(co2) > threshold, F.col(pm25) > threshold
    # The reference's cluster names.
    return centroids.withColumn(
        "cluster_label",
        F.when(hi_c & hi_p, "High Emission & High Pollution")
         .when(hi_c & ~hi_p, "High Emission, Clean Air")
         .when(~hi_c & hi_p, "High Pollution, Low Emission")
         .otherwise("Clean & Green Zone"))


def pca2(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """First two principal components of already-standardised columns
    (MLlib PCA does not centre; standardised inputs are centred)."""
    data = _vec(df, cols)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(data)
    arr = vector_to_array(F.col("pc"))
    return (model.transform(data).withColumn("pc1", arr[0]).withColumn("pc2", arr[1])
                 .drop("features", "pc"))


def hierarchical_clusters(df: DataFrame, cols: Sequence[str], k: int = 3) -> DataFrame:
    """``df`` with its Ward cluster of ``k``."""
    return ward(df, cols, k)[0]
