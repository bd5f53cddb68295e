import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import functions as F

from featureflow.functions import hashing, paths, rules, vectors
from featureflow.sources import tables


def column(df, c):
    return [r[c] for r in df.collect()]


def test_label_from_path(spark):
    rows = ["s3a://b/data/Test/Apple Red/a.jpg", "x", "a/b", "a/b/", None, "/100%/é.png"]
    df = tables.driver_rows(spark, [(r,) for r in rows], "path string")
    assert column(df.select(paths.label_from_path("path").alias("l")), "l") == ["Apple Red", None, "a", "b", None, "100%"]


def test_label_from_pattern(spark):
    rows = [("d/Test/Banana/1.jpg",), ("d/Train/Banana/1.jpg",), ("Test//x",)]
    df = tables.driver_rows(spark, rows, "p string")
    assert column(paths.labelled_by_pattern(df, "p", "l"), "l") == ["Banana"]


def test_extension(spark):
    rows = [("a.JPG",), ("a.jpeg",), ("a.png",), ("a.gif",), ("png",), ("a.png.txt",)]
    df = tables.driver_rows(spark, rows, "p string").filter(paths.has_extension("p"))
    assert column(df, "p") == ["a.JPG", "a.jpeg", "a.png"]


def test_class_name(spark):
    df = tables.id_range(spark, 7, 7, "i").select("i", paths.class_name("class_id").alias("n")).orderBy("i")
    assert column(df, "n") == [*paths.CLASS_NAMES, "Grape_White", "Grape_White"]


def test_object_types(spark):
    keys = ["results/a", "cache/b", "plots/c", "test/d", "other/e", "x/final_results.parquet", "cache/final_results"]
    df = tables.driver_rows(spark, [(k,) for k in keys], "key string")
    listing = column(df.select(paths.object_type("key").alias("t")), "t")
    assert listing == ["results", "cache", "plots", "test", "test", "test", "cache"]
    diagnostic = column(df.select(paths.diagnostic_type("key").alias("t")), "t")
    assert diagnostic == ["results", "cache", "plots", "test", "other", "results", "results"]


def test_hash_is_partition_free(spark):
    base = spark.range(500)
    results = []
    for n in (1, 4, 7):
        df = base.repartition(n).select("id", hashing.uniform("id", 7).alias("u"))
        results.append(sorted((r["id"], r["u"]) for r in df.collect()))
    assert results[0] == results[1] == results[2]
    assert 0 <= min(u for _, u in results[0]) and max(u for _, u in results[0]) < 1
    assert abs(np.mean([u for _, u in results[0]]) - 0.5) < 0.05


def test_vector_round_trip(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [])], "i int, features array<float>")
    converted = vectors.to_vector(df)
    assert vectors.is_vector(converted, "features") and converted.columns == ["i", "features"]
    rows = {r["i"]: r["features"] for r in converted.collect()}
    assert rows[1] == Vectors.dense([1.0, 2.0]) and rows[2] is None and rows[3] == DenseVector([])
    back = {r["i"]: r["a"] for r in converted.select("i", vectors.as_array(converted, "features").alias("a")).collect()}
    assert back == {1: [1.0, 2.0], 2: None, 3: []}


def test_vector_guard(spark):
    with pytest.raises(TypeError):
        vectors.require_vector(spark.createDataFrame([([1.0],)], "features array<double>"), "features")


def test_assemble_null_raises(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        vectors.assemble(df, ["a", "b"], "v").collect()


def test_expand(spark):
    df = vectors.to_vector(spark.createDataFrame([(1, "x", [1.0, 2.0]), (2, "y", None)], "i int, l string, v array<double>"), "v")
    out = vectors.expand(df, "v")
    assert out.columns == ["i", "l", "pca_0", "pca_1"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 1.0, 2.0), (2, "y", None, None)]
    ragged = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    with pytest.raises(PySparkException):
        vectors.expand(ragged, "v", length=2).collect()


def test_shape(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<float>")
    assert tuple(vectors.shape(df, "v").head()) == (3, 2, 1, 2)
    assert tuple(vectors.shape(df.limit(0), "v").head()) == (0, 0, None, None)
    assert column(df.select(vectors.head_values(df, "v", 1).alias("h")), "h") == [[1.0], [1.0], None]


def test_replicate_and_synthetic(spark):
    df = tables.replicate(spark.range(5), 200)
    assert df.count() == 1000 and df.select("id", "copy").distinct().count() == 1000
    a = spark.range(20).select("id", tables.synthetic_features("id", 8).alias("v"))
    b = spark.range(20).repartition(5).select("id", tables.synthetic_features("id", 8).alias("v"))
    assert sorted(map(tuple, ((r["id"], tuple(r["v"])) for r in a.collect()))) == sorted(
        (r["id"], tuple(r["v"])) for r in b.collect()
    )
    wide = spark.range(3).select("id", *tables.random_features(4, [1, 2]))
    assert wide.columns == ["id", "f_0", "f_1", "f_2", "f_3"]
    first = wide.head()
    assert first["f_0"] == first["f_2"] and first["f_0"] != first["f_1"]


def test_rules(spark):
    row = spark.range(1).select(
        rules.ratio(F.lit(1), F.lit(0)).alias("zero"),
        rules.percent_reduction(F.lit(1280), F.lit(56)).alias("percent"),
        rules.reduction_factor(F.lit(1280), F.lit(56)).alias("factor"),
        rules.balance_verdict(F.lit(0.8)).alias("b"),
        rules.variance_verdict(F.lit(0.81)).alias("v"),
        rules.overall_verdict(F.lit(0.81), F.lit(0.71)).alias("o"),
        rules.overall_verdict(F.lit(0.81), F.lit(0.7)).alias("p"),
        rules.bar_steps(F.lit(1), F.lit(3)).alias("s"),
    ).head()
    assert row["zero"] is None
    assert row["percent"] == pytest.approx(95.625) and row["factor"] == pytest.approx(1280 / 56)
    assert (row["b"], row["v"], row["o"], row["p"], row["s"]) == ("unbalanced", "reached", "success", "partial success", 8)
