import os

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.linalg import Vectors

from featureflow.operators import inventory
from featureflow.sources import files, store


@pytest.fixture
def frame(spark):
    rows = [(i, "ab"[i % 2], Vectors.dense([i, i + 0.5])) for i in range(6)]
    return spark.createDataFrame(rows, ["image_id", "fruit_label", "pca_features"])


def test_parquet_modes(spark, frame, tmp_path):
    path = str(tmp_path / "out.parquet")
    store.write_parquet(frame, path, overwrite=False)
    with pytest.raises(PySparkException):
        store.write_parquet(frame, path, overwrite=False)
    store.write_parquet(frame.limit(2), path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.schema["pca_features"].dataType == frame.schema["pca_features"].dataType
    store.write_parquet(frame, str(tmp_path / "by"), partition_by=["fruit_label"])
    assert spark.read.parquet(str(tmp_path / "by")).filter("fruit_label = 'a'").count() == 3


def test_csv(spark, frame, tmp_path):
    path = str(tmp_path / "one.csv")
    store.write_csv(frame.repartition(3), path, single_file=True)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["image_id", "fruit_label"] and back.count() == 6
    assert len(list((tmp_path / "one.csv").glob("part-*.csv"))) == 1


def test_csv_json_vectors(spark, frame, tmp_path):
    source, path = str(tmp_path / "f.parquet"), str(tmp_path / "all.csv")
    store.write_parquet(frame.repartition(3), source)
    store.parquet_to_csv(spark, source, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.count() == 6
    assert back.filter("image_id = 2").head()["pca_features"] == "[2.0,2.5]"
    with pytest.raises(ValueError):
        store.csv_ready(frame, "other")


def test_expanded_csv(spark, frame, tmp_path):
    path = str(tmp_path / "wide.csv")
    store.write_expanded_csv(frame, path)
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert back.columns == ["image_id", "fruit_label", "pca_0", "pca_1"]
    assert tuple(back.filter("image_id = 3").head()) == (3, "b", 3.0, 3.5)


def test_materialize(spark, tmp_path):
    path, calls = str(tmp_path / "stage.parquet"), []

    def compute(n=3):
        calls.append(n)
        return spark.range(n)

    for params in ({"k": 1}, {"k": 1}, {"k": 2}):
        assert store.materialize(spark, path, compute, params).count() == 3
    assert len(calls) == 2
    store.materialize(spark, path, compute, {"k": 2}, refresh=True)
    assert len(calls) == 3
    assert store.invalidate(spark, path) and not store.invalidate(spark, path)
    store.materialize(spark, path, compute, {"k": 2})
    assert len(calls) == 4


def test_materialize_follows_sources(spark, tmp_path):
    source, path, calls = tmp_path / "in", str(tmp_path / "stage.parquet"), []
    source.mkdir()

    def compute():
        calls.append(1)
        return spark.read.text(str(source))

    (source / "a.txt").write_text("x\n")
    for _ in range(2):
        assert store.materialize(spark, path, compute, sources=[str(source)]).count() == 1
    (source / "b.txt").write_text("y\nz\n")
    assert store.materialize(spark, path, compute, sources=[str(source)]).count() == 3
    assert len(calls) == 2


def test_half_written_stage_is_not_reused(spark, tmp_path):
    path = str(tmp_path / "stage.parquet")
    spark.range(1).write.parquet(path)
    assert store.materialize(spark, path, lambda: spark.range(5)).count() == 5


def test_run_log(spark, frame, tmp_path):
    log = str(tmp_path / "log.parquet")
    assert store.write_logged(frame, str(tmp_path / "a.parquet"), log, "reduce", "k=2") == 6
    store.log_step(spark, log, "done")
    rows = spark.read.parquet(log).orderBy("ts").collect()
    assert [(r["step"], r["details"], r["rows"]) for r in rows] == [("reduce", "k=2", 6), ("done", "", None)]
    assert spark.read.parquet(log).columns == ["ts", "step", "details", "rows"]


def test_keep_in_memory(frame):
    kept = store.keep_in_memory(frame)
    assert kept.is_cached and kept.count() == 6
    assert not kept.unpersist().is_cached


@pytest.fixture
def tree(spark, tmp_path):
    root = tmp_path / "outputs"
    spark.range(10).repartition(3).write.parquet(str(root / "final_results.parquet"))
    spark.range(4).selectExpr("id", "id * 2 as b").write.parquet(str(root / "cache" / "variance.parquet"))
    spark.range(0).write.parquet(str(root / "cache" / "empty.parquet"))
    (root / "results").mkdir()
    (root / "results" / "bad.parquet").write_bytes(b"PAR1 not really PAR1")
    (root / "plots").mkdir()
    (root / "plots" / "v.png").write_bytes(b"12345")
    (root / "plots" / "v.SVG").write_bytes(b"123")
    return str(root)


def test_inventory(spark, tree):
    got = {r["dataset"]: r for r in inventory.dataset_inventory(spark, tree).collect()}
    assert set(got) == {"final_results.parquet", "cache/variance.parquet", "cache/empty.parquet", "results/bad.parquet"}
    final = got["final_results.parquet"]
    assert (final["rows"], final["n_columns"], final["columns"], final["part_files"]) == (10, 1, ["id"], 3)
    assert got["cache/variance.parquet"]["columns"] == ["id", "b"] and got["cache/empty.parquet"]["rows"] == 0
    assert got["results/bad.parquet"]["readable"] is False and got["results/bad.parquet"]["rows"] is None
    assert final["size_bytes"] > 0


def test_inventory_isolates_a_bad_part(spark, tree):
    from pathlib import Path

    good = next(Path(tree, "final_results.parquet").glob("part-*.parquet"))
    (good.parent / "part-zzz.parquet").write_bytes(b"garbage that is no parquet file")
    for crc in good.parent.glob(".part-zzz*"):
        crc.write_bytes(b"")
    got = {r["dataset"]: r["readable"] for r in inventory.dataset_inventory(spark, tree).collect()}
    assert got["final_results.parquet"] is False and got["cache/variance.parquet"] is True


def test_integrity(spark, tree):
    expected = ["final_results.parquet", "cache/empty.parquet", "cache/none.parquet", "results/bad.parquet"]
    checked = inventory.integrity_check(spark, tree, expected)
    got = {r["path"]: (r["exists"], r["valid"], r["rows"]) for r in checked.collect()}
    assert got == {
        "final_results.parquet": (True, True, 10),
        "cache/empty.parquet": (True, False, 0),
        "cache/none.parquet": (False, False, 0),
        "results/bad.parquet": (True, False, 0),
    }
    assert tuple(inventory.integrity_status(checked).head()) == (4, 1, "INCOMPLETE")
    assert inventory.integrity_status(checked.filter("valid")).head()["status"] == "OK"


def test_tree_reports(spark, tree):
    parts = {r["directory"].rsplit("/", 1)[1]: r for r in inventory.part_files(spark, tree).collect()}
    assert parts["final_results.parquet"]["part_files"] == 3 and parts["final_results.parquet"]["crc_files"] >= 3
    assert parts["plots"]["part_files"] == 0
    seen = [(len(folders), [os.path.getsize(os.path.join(at, f)) for f in names]) for at, folders, names in os.walk(tree)]
    size = inventory.directory_size(spark, tree).head()
    assert tuple(size) == (sum(len(b) for _, b in seen), sum(n for n, _ in seen), sum(sum(b) for _, b in seen))
    assert size["files"] > inventory.input_files(spark, tree).head()[0]  # Spark's listing hides some
    charts = {(r["path"].rsplit("/", 1)[1], r["length"]) for r in inventory.chart_files(spark, tree).collect()}
    assert charts == {("v.png", 5), ("v.SVG", 3)}
    with pytest.raises(FileNotFoundError):
        inventory.directory_size(spark, tree + "/nothing")


def test_objects(spark, tree):
    listing = inventory.object_listing(spark, tree)
    keys = {r["key"] for r in listing.collect()}
    assert "plots/v.png" in keys and not any(k.startswith("/") for k in keys)
    types = {r["type"]: r for r in inventory.object_types(inventory.classify_objects(listing, diagnostic=True)).collect()}
    assert types["plots"]["bytes"] == 8 and types["results"]["objects"] == 4
    ordered = inventory.listing_by_size(inventory.classify_objects(listing)).filter("type = 'plots'").collect()
    assert [r["key"] for r in ordered] == ["plots/v.png", "plots/v.SVG"]
    found = {r["expected"]: r["found"] for r in inventory.expected_results(listing, ["final_results.parquet", "nope"]).collect()}
    assert found == {"final_results.parquet": True, "nope": False}
    assert inventory.expected_results(listing.limit(0), ["a"]).head()["found"] is False


def test_inspect(spark, tree):
    profile, sample = inventory.inspect(spark, tree + "/cache/variance.parquet", 2)
    assert {r["column"] for r in profile.collect()} == {"id", "b"} and sample.count() == 2
    assert files.readable(spark, tree + "/results/bad.parquet") is None
