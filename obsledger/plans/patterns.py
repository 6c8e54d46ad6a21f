"""Unsupervised jobs on standardised rows and the findings drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.models import clusters, density, isolation
from obsledger.operators import insight
from obsledger.operators.metering import Meter
from obsledger.session import cut_lineage


def find_patterns(scaled: DataFrame, key: str, cols: Sequence[str], k: int = 4, eps: float = 0.5,
                  min_samples: int = 5, components: int = 3, contamination: float = 0.05,
                  restarts: int = 10, trees: int = 100, run_id: str = "run_001", silhouette_share: float = 1.0) -> dict[str, DataFrame]:
    """Labelled rows and findings of k-means, density clusters, principal components and isolation forest.

    "metrics" holds the run's metric rows: inertia, silhouette (plain distances, from ``silhouette_share`` of the rows), cluster
    and noise counts, explained variance, anomaly shares, seconds. Fits and labels everything.
    """
    meter = Meter(scaled.sparkSession, run_id)
    runs = meter.step("KMeans", "training_time_seconds", lambda: clusters.fit_kmeans_runs(scaled, cols, k, restarts))
    grouped = cut_lineage(clusters.assign(scaled, runs.centroids(scaled.sparkSession), cols))
    meter.values("KMeans", {"n_clusters": k, "inertia": runs.inertia[runs.best], "rounds": runs.rounds[runs.best], "converged": runs.converged[runs.best],
                            "silhouette_score": clusters.silhouette(grouped, "cluster", cols, "euclidean", silhouette_share)})
    dense = meter.step("DBSCAN", "training_time_seconds", lambda: cut_lineage(density.dbscan(scaled, key, cols, eps, min_samples)))
    meter.values("DBSCAN", density.measures(dense))
    noisy = not dense.where("dbscan_cluster = -1").isEmpty()
    meter.value("DBSCAN", "silhouette_score", 0.0 if noisy else clusters.silhouette(dense, "dbscan_cluster", cols, "euclidean", silhouette_share))
    loadings, variance = meter.step("PCA", "training_time_seconds", lambda: clusters.fit_pca(scaled, cols, components))
    for r in variance.collect():  # a row for each component
        meter.value("PCA", f"explained_ratio_{r['component']}", r["explained_ratio"])
    forest = meter.step("IsolationForest", "training_time_seconds", lambda: isolation.fit_iforest(scaled, [key], cols, trees))
    odd = meter.step("IsolationForest", "prediction_time_seconds", lambda: cut_lineage(isolation.detect(scaled, forest, cols, contamination)))
    meter.values("IsolationForest", odd.agg(F.sum("is_anomaly").alias("n_anomalies"),
                                            (100 * F.avg("is_anomaly")).alias("anomaly_percentage")).first().asDict())
    noise, sizes = insight.density_insights(dense, "dbscan_cluster", cols)
    return {
        "kmeans": grouped, "dbscan": dense, "pca": clusters.project(scaled, loadings), "isolation": odd,
        "loadings": loadings, "variance": variance, "metrics": meter.rows(),
        "kmeans_insights": insight.cluster_insights(grouped, "cluster", cols),
        "dbscan_insights": noise, "dbscan_sizes": sizes,
        "pca_insights": insight.loading_insights(loadings, variance),
        "isolation_insights": insight.contrast_insights(odd, "is_anomaly", cols),
        "cross_insights": insight.cross_insights(grouped, odd, [key], "cluster", "is_anomaly"),
    }
