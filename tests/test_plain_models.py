"""The models of the catalog on the embeddings as they are, against brute force."""

import numpy as np
import pytest

from featureflow.functions import vectors
from featureflow.operators import classification, clustering, sampling
from featureflow.plans import catalog, jobs

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    return vectors.to_vector(catalog._embeddings(spark, ROOT)).cache()


@pytest.fixture(scope="module")
def points(plain):
    return {r["vec_id"]: (r["label"], r["features"].toArray()) for r in plain.select("vec_id", "label", "features").collect()}


def test_kmeans_gives_the_nearest_centre(spark, plain, points):
    model, _ = clustering.train_kmeans(plain, "features", key="vec_id")
    centres = np.array(model.clusterCenters())
    want = {i: (label, int(((centres - x) ** 2).sum(1).argmin())) for i, (label, x) in points.items()}
    assert {r["vec_id"]: (r["label"], r["cluster"]) for r in catalog.QUERIES["kmeans_assign_plain"](spark, ROOT).collect()} == want
    chart = catalog.QUERIES["cluster_chart_plain"](spark, ROOT).collect()
    assert {r["vec_id"]: (r["label"], r["cluster"]) for r in chart} == want
    x = np.array([points[r["vec_id"]][1] for r in chart])
    values, directions = np.linalg.eigh(np.cov(x.T))
    plane = x @ directions[:, [-1, -2]]
    got = np.array([(r["x"], r["y"]) for r in chart])
    for axis in range(2):
        a, b = plane[:, axis] - plane[:, axis].mean(), got[:, axis] - got[:, axis].mean()
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-5


def test_forest_gives_the_vote_of_its_trees(spark, plain, points, tmp_path):
    train, test = sampling.train_test(sampling.stratified_split(plain, "label", "vec_id"))
    model = classification.train_classifier(train, "label", "features", key="vec_id")
    forest, labels = model.stages[1], model.stages[0].labels
    held = {r["vec_id"] for r in test.select("vec_id").collect()}
    ids = sorted(held)
    x = np.array([points[i][1] for i in ids])
    votes = np.zeros((len(ids), len(labels)))

    def walk(node, rows):
        if node.subtreeDepth() == 0:
            counts = np.array(list(node.impurityStats().stats()))
            votes[rows] += counts / counts.sum()
        elif len(rows):
            left = x[rows, node.split().featureIndex()] <= node.split().threshold()
            walk(node.leftChild(), rows[left])
            walk(node.rightChild(), rows[~left])

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), np.arange(len(ids)))
    got = {r["vec_id"]: r for r in catalog.QUERIES["rf_predict_plain"](spark, ROOT).collect()}
    assert set(got) == held
    for i, own in zip(ids, votes, strict=True):
        assert own[int(got[i]["prediction"])] >= own.max() - 1e-9
        assert got[i]["label"] == points[i][0] and got[i]["predicted_label"] == labels[int(got[i]["prediction"])]
        assert labels[int(got[i]["label_indexed"])] == str(points[i][0])


def test_coordinates_of_the_demonstration(spark):
    ids = catalog._table(spark, ROOT, "embeddings", "vec_id").withColumnRenamed("vec_id", "image_id")
    demo = vectors.to_vector(jobs.synthetic_rows(ids, "image_id")).select("image_id", "features").collect()
    place = {r["image_id"]: n for n, r in enumerate(demo)}
    x = np.array([r["features"].toArray() for r in demo])
    values, directions = np.linalg.eigh(np.cov(x.T))
    want = x @ directions[:, ::-1][:, :100]
    rows = catalog.QUERIES["synthetic_coordinates"](spark, ROOT).toArrow()
    got = np.full_like(want, np.nan)
    got[[place[i] for i in rows["image_id"].to_pylist()], rows["component"].to_numpy()] = rows["value"].to_numpy()
    assert rows.num_rows == got.size
    signs = np.sign((want * got).sum(0))
    assert np.abs(want * signs - got).max() < 1e-4
