import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from featureflow.functions import vectors
from featureflow.operators import classification, clustering
from featureflow.plans import jobs


@pytest.fixture(scope="module")
def blobs(spark):
    """Three well-separated classes in four dimensions."""
    rng = np.random.default_rng(2)
    centres = np.array([[0, 0, 0, 0], [10, 10, 0, 0], [0, 10, 10, 10]])
    rows = [
        (f"p{i}", "abc"[i % 3], [float(v) for v in centres[i % 3] + rng.normal(0, 0.3, 4)]) for i in range(150)
    ]
    return vectors.to_vector(spark.createDataFrame(rows, "path string, label string, features_pca array<double>"), "features_pca").cache()


def test_label_index(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"] + [(None,)], "label string")
    got = {r["label"]: r["label_indexed"] for r in classification.label_index(df).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_label_index_of_numbers_equals_indexer(spark):
    """Equal counts are ordered by the text of the label, as the indexer does: 1, 10, 2."""
    rows = spark.range(36).selectExpr("id % 12 as label", "array(cast(id as double)) as features_pca")
    rows = vectors.to_vector(rows, "features_pca")
    model = classification.train_classifier(rows, num_trees=1)
    table = classification.label_index(rows).orderBy("label_indexed").collect()
    assert [str(r["label"]) for r in table] == model.stages[0].labels
    assert [r["label_indexed"] for r in table] == [float(i) for i in range(12)]
    assert classification.label_index(rows.limit(0)).count() == 0


def test_label_index_equals_indexer(blobs):
    model = classification.train_classifier(blobs, num_trees=3)
    table = classification.label_index(blobs).orderBy("label_indexed").collect()
    assert [r["label"] for r in table] == model.stages[0].labels


def test_model_job(blobs):
    model, metrics, clustered = jobs.model_job(blobs, jobs.ModelConfig(clusters=3, trees=10))
    assert metrics.head().asDict() == {"accuracy": 1.0, "f1_score": 1.0, "precision": 1.0, "recall": 1.0}
    pairs = clustered.select("label", "cluster").distinct().collect()
    assert len(pairs) == 3 and len({r["cluster"] for r in pairs}) == 3


def test_predictions_are_labels(blobs):
    model = classification.train_classifier(blobs, num_trees=5)
    _, predictions = classification.evaluate_classifier(model, blobs)
    for c in ("label_indexed", "rawPrediction", "probability", "prediction", "predicted_label"):
        assert c in predictions.columns
    assert predictions.filter("label <> predicted_label").count() == 0
    matrix = classification.confusion_matrix(predictions, dense=True)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in matrix.collect()}
    assert len(cells) == 9 and cells["a", "a"] == 50 and cells["a", "b"] == 0


def test_unseen_label(blobs):
    train = blobs.filter("label <> 'c'")
    model = classification.train_classifier(train, num_trees=3)
    with pytest.raises(Exception):
        classification.predict(model, blobs).collect()
    skipping = classification.train_classifier(train, num_trees=3, handle_invalid="skip")
    assert classification.predict(skipping, blobs).count() == 100


def test_vector_guard(spark):
    df = spark.createDataFrame([("a", [1.0])], "label string, features_pca array<double>")
    for call in (classification.train_classifier, clustering.train_kmeans, clustering.silhouette):
        with pytest.raises(TypeError):
            call(df)


def test_metrics_equal_evaluators(spark):
    rng = np.random.default_rng(4)
    actual = rng.integers(0, 4, 500)
    predicted = np.where(rng.random(500) < 0.6, actual, rng.integers(0, 5, 500))
    predicted[predicted == 2] = 1
    df = spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "label double, prediction double")
    row = classification.class_metrics(df, "label", "prediction").head()
    names = {"accuracy": "accuracy", "f1_score": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=theirs)
        assert row[ours] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_metrics_edges(spark):
    empty = spark.createDataFrame([], "label string, predicted_label string")
    assert classification.class_metrics(empty).head()["accuracy"] is None
    for dense in (False, True):
        assert classification.confusion_matrix(empty, dense=dense).count() == 0
    nulls = spark.createDataFrame([("a", "a"), ("a", None), (None, "b")], "label string, predicted_label string")
    assert classification.class_metrics(nulls).head()["accuracy"] == 1.0


def test_sparse_cells_of_many_classes(spark):
    """As many classes as there are: a sparse matrix has the cells that occur, null labels none."""
    df = spark.range(12_000).selectExpr("cast(id as string) as label", "if(id % 2 = 0, cast(id as string), null) as predicted_label")
    assert classification.confusion_matrix(df).count() == 6000


def test_kmeans_rows_are_on_their_nearest_centre(blobs):
    model, assigned = clustering.train_kmeans(blobs, k=3)
    centres = np.array(model.clusterCenters())
    for row in assigned.collect():
        distances = ((row["features_pca"].toArray() - centres) ** 2).sum(axis=1)
        assert distances.argmin() == row["cluster"]


def test_silhouette_equals_brute_force(blobs):
    _, assigned = clustering.train_kmeans(blobs, k=4)
    rows = assigned.collect()
    x = np.array([r["features_pca"].toArray() for r in rows])
    c = np.array([r["cluster"] for r in rows])
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, c == other].mean() for other in set(c) - {c[i]})
        scores.append((b - a) / max(a, b))
    assert clustering.silhouette(assigned) == pytest.approx(np.mean(scores))


def test_silhouette_of_one_cluster(blobs):
    assert math.isnan(clustering.silhouette(blobs.withColumn("cluster", F.lit(0))))


def test_cluster_chart(blobs):
    _, assigned = clustering.train_kmeans(blobs, k=3)
    chart = clustering.cluster_chart(assigned, "path", sample_size=60)
    assert chart.columns == ["path", "x", "y", "cluster", "label"] and chart.count() == 60


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_models_do_not_depend_on_the_splits(blobs, parts):
    """Forest votes and k-means centres are the same for any input partitioning."""
    noisy = blobs.withColumn("label", F.when(F.hash("path") % 5 == 0, "a").otherwise(F.col("label")))

    def outcome(df):
        model = classification.train_classifier(df, num_trees=4, key="path", partitions=3)
        votes = sorted((r["path"], tuple(r["rawPrediction"].toArray())) for r in model.transform(df).collect())
        means, _ = clustering.train_kmeans(df, k=3, key="path", partitions=3)
        return votes, np.array(means.clusterCenters())

    expected, centres = outcome(noisy.coalesce(2))
    votes, other = outcome(noisy.repartition(parts))
    assert votes == expected
    np.testing.assert_allclose(other, centres, rtol=1e-12)
