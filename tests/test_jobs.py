import numpy as np
import pytest

from conftest import picture, png_bytes
from featureflow.functions import vectors
from featureflow.operators import images, inventory
from featureflow.plans import jobs


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("flow")
    for i in range(12):
        folder = base / "set" / ("A" if i % 2 else "B 1")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.png").write_bytes(png_bytes(picture(i)))
    (base / "set" / "A" / "bad.png").write_bytes(b"nothing")
    featurize = jobs.FeaturizeConfig(factory=images.colour_features(16, 2, 4), factory_name="small", length=32)
    reduce = jobs.ReduceConfig(threshold=0.9)
    report = jobs.image_job(spark, str(base / "set"), str(base / "out"), featurize, reduce)
    return base, featurize, reduce, report.head()


def test_image_job(spark, flow):
    base, _, _, report = flow
    out = str(base / "out")
    assert (report["n_rows"], report["n_classes"], report["balance"], report["variance"], report["reached"]) == (12, 2, "balanced", "reached", True)
    reasons = {r["reason"]: r["n"] for r in spark.read.parquet(f"{base}/out/results/validation.parquet").collect()}
    assert reasons == {"OK": 12, "corrupt": 1}
    final = spark.read.parquet(f"{out}/final_results.parquet")
    assert final.columns == ["path", "label", "features_pca"] and final.count() == 12
    assert vectors.vector_length(final, "features_pca") == report["k"]
    assert spark.read.option("header", True).csv(f"{out}/final_results.csv").columns == ["path", "label"]
    log = spark.read.parquet(f"{out}/logs/run.parquet").head()
    assert (log["step"], log["rows"]) == ("final_results", 12)
    expected = ["final_results.parquet", "cache/features.parquet", "results/pca_variance.parquet", "results/features_pca.parquet"]
    assert inventory.integrity_status(inventory.integrity_check(spark, out, expected)).head()["status"] == "OK"


def test_reduce_stage_is_reused_and_follows_its_settings(spark, flow, monkeypatch):
    base, _, reduce, _ = flow
    features, out = str(base / "out/cache/features.parquet"), str(base / "out/results")
    fits = []
    real = jobs.reduce_job
    monkeypatch.setattr(jobs, "reduce_job", lambda *a: fits.append(1) or real(*a))
    jobs.stored_reduce_job(spark, features, out, reduce)
    assert not fits
    reduced, variance = jobs.stored_reduce_job(spark, features, str(base / "other"), jobs.ReduceConfig(threshold=0.5))
    assert len(fits) == 1 and variance.count() <= spark.read.parquet(f"{out}/pca_variance.parquet").count()
    values = np.array([r["features_pca"].toArray() for r in reduced.collect()])
    assert values.shape == (12, variance.count())


def test_a_missed_threshold_is_reported(spark, flow):
    base = flow[0]
    rows = spark.read.parquet(str(base / "out/cache/features.parquet")).filter("features is not null")
    reduced, variance = jobs.reduce_job(rows, jobs.ReduceConfig(max_k=1, threshold=0.999))
    assert jobs.report_job(reduced, variance, threshold=0.999).head()["reached"] is False


def test_sampled_flow(spark, flow, tmp_path):
    base, featurize, reduce, _ = flow
    report = jobs.image_job(spark, str(base / "set"), str(tmp_path / "out"), featurize, reduce, sample_size=8).head()
    assert 7 <= report["n_rows"] <= 8


def test_index_job(spark, flow):
    base = flow[0]
    root, out = str(base / "set"), str(base / "index.parquet")
    assert jobs.index_job(spark, root).count() == 13
    assert jobs.index_job(spark, root, out, sample_size=5).count() == 5
    assert jobs.index_job(spark, root, out, sample_size=5, refresh=True).count() == 5
    assert jobs.index_job(spark, root, out).count() == 13
