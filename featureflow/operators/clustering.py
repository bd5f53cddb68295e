"""K-means, silhouette and cluster chart data."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.vectors import require_vector
from featureflow.operators.reduction import planar
from featureflow.sources.settle import lay_out

# Default number of clusters and seed.
CLUSTERS = 10
SEED = 42


def train_kmeans(
    df: DataFrame, features: str = "features_pca", k: int = CLUSTERS, seed: int = SEED, key: str | None = None,
    partitions: int | None = None,
) -> tuple[KMeansModel, DataFrame]:
    """(model, frame with ``cluster``). Start centres come from k-means||, a few passes over the rows.

    With a ``key`` the rows are laid out by it for the fit, so the centres do not depend on the input's splits.
    """
    require_vector(df, features)
    rows = df.select(features) if key is None else lay_out(df.select(key, features), key, partitions)
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(rows)
    return model, model.transform(df)


def n_clusters(df: DataFrame, cluster: str = "cluster") -> int:
    return df.agg(F.count_distinct(cluster).alias("n")).head()["n"]


def silhouette(df: DataFrame, features: str = "features_pca", cluster: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance; NaN for fewer than two clusters.

    Computed from per-cluster sums, so the work is rows x clusters, not pairs of rows.
    """
    require_vector(df, features)
    if n_clusters(df, cluster) <= 1:
        return float("nan")
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette").evaluate(df)


def cluster_chart(
    df: DataFrame, key: str, features: str = "features_pca", cluster: str = "cluster", label: str = "label",
    sample_size: int | None = None,
) -> DataFrame:
    """2-D coordinates, cluster and label of all rows, or of a hash sample of ``sample_size`` rows."""
    narrow = df.select(key, features, cluster, label)
    return planar(narrow, features, key, sample_size).select(key, "x", "y", cluster, label)
