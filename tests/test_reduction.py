import numpy as np
import pytest

from featureflow.functions import vectors
from featureflow.operators import reduction
from featureflow.plans import jobs
from featureflow.sources.tables import VARIANCE_TABLE, driver_rows


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(3.0, 1.0, (300, 8)) @ rng.normal(size=(8, 8)) + 50
    df = spark.createDataFrame([(i, "ab"[i % 2], [float(v) for v in row]) for i, row in enumerate(x)], "i int, label string, features array<double>")
    return vectors.to_vector(df).cache(), x


def eigen(x):
    values, vecs = np.linalg.eigh(np.cov(x.T))
    return values[::-1], vecs[:, ::-1]


def coordinates(df, column="features_pca"):
    return np.array([r[column].toArray() for r in df.orderBy("i").collect()])


@pytest.mark.parametrize("engine", ["moments", "ml"])
def test_fit_matches_eigenvalues(cloud, engine):
    df, x = cloud
    values, vecs = eigen(x)
    model = reduction.fit_pca(df, 5, engine=engine)
    np.testing.assert_allclose(model.explained_variance, values[:5] / values.sum(), rtol=1e-8)
    for i in range(5):
        assert abs(abs(model.components[:, i] @ vecs[:, i]) - 1) < 1e-8
        assert model.components[np.abs(model.components[:, i]).argmax(), i] > 0


def test_engines_agree(cloud):
    df, _ = cloud
    a = coordinates(reduction.apply_pca(df, 3))
    b = coordinates(reduction.apply_pca(df, 3, engine="ml"))
    np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-8)


def test_projection_is_not_centred(cloud):
    df, x = cloud
    model = reduction.fit_pca(df, 8)
    out = coordinates(reduction.project(df, model))
    np.testing.assert_allclose(out, x @ model.components, rtol=1e-9)
    np.testing.assert_allclose(out.var(axis=0, ddof=1), eigen(x)[0], rtol=1e-8)
    centred = coordinates(reduction.project(df, model, centre=True))
    np.testing.assert_allclose(centred.mean(axis=0), 0, atol=1e-8)


def test_smaller_fit_is_prefix(cloud):
    df, _ = cloud
    full = reduction.fit_pca(df, None)
    small = reduction.fit_pca(df, 3)
    np.testing.assert_allclose(full.first(3).components, small.components, atol=1e-9)
    assert full.explained_variance.sum() == pytest.approx(1.0)
    assert (np.diff(full.explained_variance) <= 1e-12).all()
    with pytest.raises(ValueError):
        full.first(9)


def test_partitioning_does_not_matter(cloud):
    df, _ = cloud
    expected = reduction.fit_pca(df.coalesce(1), 4).components
    for n in (4, 7):
        np.testing.assert_allclose(reduction.fit_pca(df.repartition(n), 4).components, expected, atol=1e-9)


def test_null_vectors_stay_null(cloud, spark):
    df, _ = cloud
    model = reduction.fit_pca(df, 2)
    holes = vectors.to_vector(spark.createDataFrame([(1, None), (2, [1.0] * 8), (3, None)], "i int, features array<float>"))
    got = {r["i"]: r["features_pca"] for r in reduction.project(holes, model).collect()}
    assert got[1] is None and got[3] is None
    np.testing.assert_allclose(got[2].toArray(), np.ones(8) @ model.components)
    assert reduction.project(holes.limit(0), model).count() == 0


def test_guards(cloud, spark):
    df, _ = cloud
    arrays = spark.createDataFrame([([1.0],)], "features array<double>")
    for call in (lambda: reduction.fit_pca(arrays, 1), lambda: reduction.explained_variance(arrays), lambda: reduction.apply_pca(arrays, 1)):
        with pytest.raises(TypeError):
            call()
    for k in (0, 9):
        with pytest.raises(ValueError):
            reduction.fit_pca(df, k)
    with pytest.raises(ValueError):
        reduction.fit_pca(df.limit(0), 1)
    with pytest.raises(ValueError):
        reduction.fit_pca(df.limit(1), 1)
    with pytest.raises(ValueError):
        reduction.fit_pca(df, 1, engine="x")


def test_constant_columns(spark):
    df = vectors.to_vector(spark.createDataFrame([([1.0, 5.0],), ([2.0, 5.0],), ([4.0, 5.0],)], "features array<double>"))
    model = reduction.fit_pca(df, 2)
    np.testing.assert_allclose(model.explained_variance, [1, 0], atol=1e-12)
    flat = vectors.to_vector(spark.createDataFrame([([1.0, 5.0],)] * 3, "features array<double>"))
    np.testing.assert_allclose(reduction.fit_pca(flat, 2).explained_variance, [0, 0])


def test_variance_table_stops_at_threshold(cloud):
    df, x = cloud
    values = eigen(x)[0]
    cumulative = np.cumsum(values / values.sum())
    k, table = reduction.optimal_pca_k(df, threshold=0.9)
    rows = table.orderBy("k").collect()
    assert k == int(np.argmax(cumulative >= 0.9)) + 1 == len(rows)
    np.testing.assert_allclose([r["cum_variance"] for r in rows], cumulative[:k])
    k, table = reduction.optimal_pca_k(df, max_k=1, threshold=0.999999)
    assert k == 1 and reduction.optimal_k(table, 0.999999).head()["reached"] is False


@pytest.fixture(scope="module")
def curve(spark):
    return driver_rows(spark, [(1, 0.5, 0.5), (2, 0.3, 0.8), (3, 0.15, 0.95), (5, 0.03, 0.98)], VARIANCE_TABLE)


@pytest.mark.parametrize("threshold,k,reached", [(0.5, 1, True), (0.81, 3, True), (0.95, 3, True), (0.99, 5, False)])
def test_optimal_k(curve, threshold, k, reached):
    row = reduction.optimal_k(curve, threshold).head()
    assert (row["k"], row["reached"]) == (k, reached)


@pytest.mark.parametrize("requested,threshold,k", [(2, 0.95, 2), (4, 0.95, 3), (4, 0.999, 5)])
def test_k_fallback(curve, requested, threshold, k):
    assert reduction.k_fallback(curve, requested, threshold).head()["k"] == k


def test_curve(curve):
    rows = reduction.variance_curve(curve, 0.9).orderBy("k").collect()
    assert [r["chosen"] for r in rows] == [False, False, True, False]
    rows = reduction.variance_curve(curve, 0.9, requested=5).orderBy("k").collect()
    assert [r["chosen"] for r in rows] == [False, False, False, True]
    factors = reduction.reduction_factors(curve, 10).orderBy("k").collect()
    assert [(r["reduction_factor"], r["percent_reduction"]) for r in factors][:2] == [(10.0, 90.0), (5.0, 80.0)]


def test_planar(cloud):
    df, x = cloud
    got = np.array([(r["x"], r["y"]) for r in reduction.planar(df, "features").orderBy("i").collect()])
    vecs = eigen(x)[1][:, :2]
    expected = (x - x.mean(axis=0)) @ vecs
    np.testing.assert_allclose(np.abs(got), np.abs(expected), atol=1e-8)
    assert reduction.planar(df, "features", "i", 50).count() == 50
    with pytest.raises(ValueError):
        reduction.planar(df, "features", sample_size=5)


def test_reduce_job(cloud):
    df, x = cloud
    reduced, variance = jobs.reduce_job(df, jobs.ReduceConfig(threshold=0.9))
    assert reduced.columns == ["i", "label", "features_pca"]
    assert vectors.vector_length(reduced, "features_pca") == variance.count()
    report = jobs.report_job(reduced, variance).head()
    assert report["n_rows"] == 300 and report["k"] == variance.count() and report["balance"] == "balanced"
    means = {r["label"]: r for r in jobs.class_means(reduced, components=1).collect()}
    assert means["a"]["percent"] == 50.0


def test_synthetic_job(spark, tmp_path):
    out = jobs.synthetic_job(spark, 40, str(tmp_path / "demo"), d=16, k=4)
    assert out.columns == ["image_id", "fruit_label", "pca_features"] and out.count() == 40
    demo = jobs.synthetic_rows(spark.range(10).withColumnRenamed("id", "image_id"), "image_id", 6)
    wide = jobs.wide_features(demo, "features", 6, keep=("image_id",))
    assembled = vectors.assemble(wide, [f"f_{i}" for i in range(6)], "features_vector")
    a = {r["image_id"]: tuple(r["features"]) for r in demo.collect()}
    assert a == {r["image_id"]: tuple(r["features_vector"].toArray()) for r in assembled.collect()}


@pytest.mark.parametrize("spectrum", ["steep", "flat", "rank"])
def test_range_finder_equals_the_moments(spark, spectrum):
    rng = np.random.default_rng(7)
    scale = {"steep": 0.9 ** np.arange(160), "flat": 1 + 0.2 * rng.random(160), "rank": (np.arange(160) < 9).astype(float)}[spectrum]
    turn, _ = np.linalg.qr(rng.normal(size=(160, 160)))
    x = rng.normal(size=(900, 160)) * scale @ turn + 1000
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "features array<double>").repartition(5)
    df = vectors.to_vector(df)
    full = reduction.fit_pca(df, 30)
    found = reduction.leading_components(df, 30, extra=10)
    k = 9 if spectrum == "rank" else 30
    np.testing.assert_allclose(found.explained_variance, full.explained_variance, atol=1e-9)
    assert found.residual < 1e-6
    overlap = np.abs(np.sum(found.components[:, :k] * full.components[:, :k], axis=0))
    np.testing.assert_allclose(overlap, 1, atol=1e-6)
    table = reduction.explained_variance(df, 5, None, engine="random").collect()
    np.testing.assert_allclose([r["individual_variance"] for r in table], full.explained_variance[:5], atol=1e-9)


def test_range_finder_holds_no_square_matrix(spark):
    """d x d doubles would be 7 GB."""
    d = 30_002
    rows = spark.range(40).selectExpr(f"transform(sequence(0, {d - 1}), j -> cast((j % 7 = id % 7) as double) * (id + 1)) as features")
    found = reduction.leading_components(rows, 3, extra=2, passes=4)
    x = np.array([[float(j % 7 == i % 7) * (i + 1) for j in range(7)] for i in range(40)])  # columns that agree, 4286 of each
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    np.testing.assert_allclose(found.explained_variance, (values / values.sum())[:3], rtol=1e-3)
    assert found.components.shape == (d, 3)


def test_range_finder_rejects_what_moments_reject(spark):
    with pytest.raises(ValueError):
        reduction.leading_components(spark.createDataFrame([([1.0, float("nan")],), ([2.0, 1.0],)], "features array<double>"), 1)
    with pytest.raises(ValueError):
        reduction.leading_components(spark.createDataFrame([([1.0, 2.0],)], "features array<double>"), 1)
    with pytest.raises(ValueError):
        reduction.leading_components(spark.createDataFrame([([1.0, 2.0],), ([2.0, 1.0],)], "features array<double>"), 3)
