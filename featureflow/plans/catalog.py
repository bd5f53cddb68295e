"""Named queries over the standard tables, one per operator.

``embeddings`` plays the feature table, ``pages.url`` the image path, ``documents.lang`` a skewed label (one
language holds most rows), ``lineitem`` the volume. Every query runs over whole tables.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import paths, rules, vectors
from featureflow.operators import (
    classes,
    classification,
    clustering,
    gram,
    images,
    inventory,
    quality,
    reduction,
    sampling,
    statistics,
)
from featureflow.plans import jobs
from featureflow.sources import files, stages, store, tables, walk
from featureflow.sources.settle import spread

Query = Callable[[SparkSession, str], DataFrame]

URL_LABEL = r"example\.[a-z]+/([^/]+)/"
URL_TYPES = (("results", "en/"), ("cache", "fr/"), ("plots", "de/"))
URL_MARKER = ("results", "utm_source")
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EXPECTED_DATASETS = ("embeddings.parquet", "documents.parquet", "final_results.parquet")
CHECK_GRID = 8
CHECK_BINS = 16


def _table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/{name}.parquet", columns or None)


def _r(value: str | Column, digits: int = 6) -> Column:
    """Rounded, with -0.0 turned into 0.0."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: _r(c, digits) for c in columns})


def _embeddings(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "embeddings").withColumnRenamed("embedding", "features")


def _measures(spark: SparkSession, root: str, *keep: str) -> DataFrame:
    return vectors.assemble(_table(spark, root, "lineitem", *keep, *MEASURES), MEASURES, "features").select(*keep, "features")


def _diagonal(spark: SparkSession, root: str) -> DataFrame:
    return reduction.diagonal_variance_table(statistics.component_variance(_embeddings(spark, root), first=None))


def _pair(spark: SparkSession, root: str, *keep: str) -> DataFrame:
    rows = _table(spark, root, "lineitem", *keep, "l_quantity", "l_extendedprice")
    return vectors.assemble(rows, ["l_quantity", "l_extendedprice"], "features")


# --- sources -----------------------------------------------------------------------------------------------


def row_count(spark: SparkSession, root: str) -> DataFrame:
    return classes.row_count(_table(spark, root, "lineitem"))


def range_classes(spark: SparkSession, root: str) -> DataFrame:
    rows = tables.with_class_id(_table(spark, root, "customer", "c_custkey"), "c_custkey", 5)
    return rows.select(F.col("c_custkey").alias("image_id"), "class_id")


def replicate_rows(spark: SparkSession, root: str) -> DataFrame:
    return tables.replicate(_table(spark, root, "supplier", "s_suppkey", "s_name"), 200)


def synthetic_features(spark: SparkSession, root: str) -> DataFrame:
    values = tables.synthetic_features("vec_id", images.FEATURE_LENGTH)
    rows = spread(_table(spark, root, "embeddings", "vec_id"), "vec_id").select("vec_id", values.alias("v"))
    return rows.select(
        "vec_id",
        F.size("v").alias("n"),
        _r(F.col("v")[0], 9).alias("first_value"),
        _r(F.element_at("v", -1), 9).alias("last_value"),
        _r(F.array_max("v"), 9).alias("max_value"),
        _r(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


def parquet_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Customers written, and replaced by what is computed from them."""
    path = store.scratch(spark) + "/customers.parquet"
    store.write_parquet(_table(spark, root, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)
    stored = spark.read.parquet(path)
    store.write_parquet(stored.withColumn("c_acctbal", _r(F.col("c_acctbal") * 2, 2)), path, partition_by=["c_nationkey"])
    return spark.read.parquet(path).withColumn("c_nationkey", F.col("c_nationkey").cast("long"))


def csv_round_trip(spark: SparkSession, root: str) -> DataFrame:
    """Embeddings as Parquet, turned into CSV with JSON vectors, and read again."""
    path = store.scratch(spark)
    store.write_parquet(vectors.to_vector(_embeddings(spark, root)).select("vec_id", "label", "features"), f"{path}/features.parquet")
    store.parquet_to_csv(spark, f"{path}/features.parquet", f"{path}/features.csv")
    rows = spark.read.option("header", True).option("escape", '"').schema("vec_id long, label long, features string").csv(f"{path}/features.csv")
    values = F.from_json("features", "array<double>")
    return rows.select("vec_id", "label", F.size(values).alias("n"), _r(F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).alias("total"))


def logged_write(spark: SparkSession, root: str) -> DataFrame:
    """The run log after two tables were written."""
    path = store.scratch(spark)
    for name in ("orders", "supplier"):
        store.write_logged(_table(spark, root, name), f"{path}/{name}.parquet", f"{path}/run.parquet", name, "whole table")
    return spark.read.parquet(f"{path}/run.parquet").select("step", "details", "rows")


def stage_update(spark: SparkSession, root: str) -> DataFrame:
    """Orders as source files of a stage: some are new, some changed, some gone when it is brought up to date.

    ``run`` tells which of the two runs computed a row.
    """
    path, key = store.scratch(spark) + "/stage", F.col("o_orderkey")
    orders = _table(spark, root, "orders", "o_orderkey", "o_custkey")
    listing = orders.select(
        F.concat(F.lit("/orders/"), key).alias("path"), F.col("o_custkey").alias("length"), F.timestamp_micros(key).alias("modificationTime"), key
    )
    before = listing.where("o_orderkey % 5 <> 0").withColumn("length", F.col("length") + F.when(key % 7 == 0, 1).otherwise(0))
    gone = orders.select(F.concat(F.lit("/gone/"), key).alias("path"), F.lit(1).cast("long").alias("length"), F.timestamp_micros(key).alias("modificationTime"), key)
    for run, state in ((1, before.unionByName(gone)), (2, listing)):
        def compute(part: DataFrame | None, run: int = run, state: DataFrame = state) -> DataFrame:
            rows = state if part is None else part
            return rows.select("path", F.col("length").alias("size"), F.lit(run).alias("run"))

        done = stages.follow(spark, path, state, compute)
    return done


def vector_shape(spark: SparkSession, root: str) -> DataFrame:
    return vectors.shape(_embeddings(spark, root), "features")


def dataset_inventory(spark: SparkSession, root: str) -> DataFrame:
    found = inventory.dataset_inventory(spark, root)
    names = F.array_join("columns", ",").alias("columns")
    return found.select("dataset", "readable", "rows", "n_columns", names, (F.col("size_bytes") > 0).alias("has_bytes"), "part_files")


def part_files(spark: SparkSession, root: str) -> DataFrame:
    """Part and checksum files of the folders that orders are written to, one for each status."""
    path = store.scratch(spark) + "/orders.parquet"
    orders = _table(spark, root, "orders", "o_orderkey", "o_orderstatus")
    store.write_parquet(orders.repartition(3, "o_orderstatus"), path, partition_by=["o_orderstatus"])
    found = inventory.part_files(spark, path).where("part_files > 0")
    return found.select(paths.base_name("directory").alias("directory"), "part_files", "crc_files")


def directory_size(spark: SparkSession, root: str) -> DataFrame:
    """Files and folders of the same, all counted, hidden and empty ones too."""
    path = store.scratch(spark) + "/orders.parquet"
    orders = _table(spark, root, "orders", "o_orderkey", "o_orderstatus")
    store.write_parquet(orders.repartition(3, "o_orderstatus"), path, partition_by=["o_orderstatus"])
    return inventory.directory_size(spark, path).select("files", "directories", (F.col("bytes") > 0).alias("has_bytes"))


def integrity(spark: SparkSession, root: str) -> DataFrame:
    return inventory.integrity_check(spark, root, EXPECTED_DATASETS)


def integrity_status(spark: SparkSession, root: str) -> DataFrame:
    expected = tables.driver_rows(spark, [(p,) for p in EXPECTED_DATASETS], "path string")
    checked = inventory.expected_against(inventory.dataset_inventory(spark, root), expected)
    return inventory.integrity_status(checked)


# --- labels and rules --------------------------------------------------------------------------------------


def path_label(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "pages", "page_id", "url").withColumn("label", paths.label_from_path("url"))


def path_label_regex(spark: SparkSession, root: str) -> DataFrame:
    return paths.labelled_by_pattern(_table(spark, root, "pages", "page_id", "url"), "url", "label", URL_LABEL)


def class_names(spark: SparkSession, root: str) -> DataFrame:
    rows = tables.with_class_id(_table(spark, root, "orders", "o_orderkey"), "o_orderkey", len(paths.CLASS_NAMES))
    return rows.withColumn("fruit_label", paths.class_name("class_id"))


def url_class(spark: SparkSession, root: str) -> DataFrame:
    pages = _table(spark, root, "pages", "url", "html")
    key = F.regexp_replace("url", "^https?://[^/]+/", "")
    listing = pages.select(key.alias("key"), F.length("html").cast("long").alias("size"))
    typed = listing.withColumn("type", paths.object_type("key", URL_TYPES))
    return inventory.object_types(typed)


def url_class_marked(spark: SparkSession, root: str) -> DataFrame:
    key = F.regexp_replace("url", "^https?://[^/]+/", "")
    pages = _table(spark, root, "pages", "page_id", "url").withColumn("key", key)
    return pages.select("page_id", paths.object_type("key", URL_TYPES, "other", URL_MARKER).alias("type"))


def expected_results(spark: SparkSession, root: str) -> DataFrame:
    listing = _table(spark, root, "pages", "url").withColumnRenamed("url", "key")
    return inventory.expected_results(listing, ["utm_source", "final_results"])


# --- classes -----------------------------------------------------------------------------------------------


def class_counts(spark: SparkSession, root: str) -> DataFrame:
    return classes.class_distribution(_table(spark, root, "embeddings", "label"))


def class_share(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(classes.class_share(_table(spark, root, "documents", "lang"), "lang"), "percent")


def class_relative(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(classes.class_relative(_table(spark, root, "documents", "lang"), "lang"), "relative")


def class_balance(spark: SparkSession, root: str) -> DataFrame:
    balance = classes.class_balance(_table(spark, root, "events", "event_type"), "event_type")
    return _rounded(balance, "balance_ratio", "spread_percent")


def distinct_classes(spark: SparkSession, root: str) -> DataFrame:
    return classes.n_classes(_table(spark, root, "documents", "source"), "source")


def class_list(spark: SparkSession, root: str) -> DataFrame:
    return classes.distinct_classes(_table(spark, root, "documents", "source"), "source")


def class_sample(spark: SparkSession, root: str) -> DataFrame:
    return classes.class_sample(path_label(spark, root), "label", "url")


# --- quality -----------------------------------------------------------------------------------------------


def null_profile(spark: SparkSession, root: str) -> DataFrame:
    holes = _table(spark, root, "events").withColumns(
        {
            "event_type": F.nullif("event_type", F.lit("error")),
            "value": F.when(F.col("value") < 100, F.col("value")),
            "user_id": F.when(F.col("user_id") % 7 > 0, F.col("user_id")),
        }
    )
    profile = _rounded(quality.null_profile(holes), "percent_null")
    return profile.withColumn("dtype", F.regexp_replace("dtype", "_ntz$", ""))


def frame_summary(spark: SparkSession, root: str) -> DataFrame:
    profile, _ = quality.summary(_table(spark, root, "documents"))
    return profile.select("column", "dtype", "n_rows", "n_null")


def frame_check(spark: SparkSession, root: str) -> DataFrame:
    return quality.frame_check(_table(spark, root, "lineitem"), ["l_orderkey", "label"], 1000).select("rule", "passed")


# --- feature statistics ------------------------------------------------------------------------------------


def _stats(df: DataFrame) -> DataFrame:
    return _rounded(statistics.feature_stats(df), "min_value", "max_value", "mean_value", "std_value")


def feature_stats(spark: SparkSession, root: str) -> DataFrame:
    return _stats(_embeddings(spark, root))


def lineitem_feature_stats(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(_stats(_measures(spark, root)), "mean_value", "std_value", digits=4)


def feature_histogram(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(statistics.feature_histogram(_embeddings(spark, root)), "bin_start", "bin_end")


def class_box_stats(spark: SparkSession, root: str) -> DataFrame:
    box = statistics.class_box_stats(_embeddings(spark, root))
    return _rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high")


def lineitem_box_stats(spark: SparkSession, root: str) -> DataFrame:
    box = statistics.class_box_stats(_measures(spark, root, "l_returnflag"), label="l_returnflag")
    return _rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high")


def component_correlation(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(statistics.component_correlation(_embeddings(spark, root)), "corr")


def component_variance(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(statistics.component_variance(_embeddings(spark, root)), "variance", digits=8)


def covariance_long(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(gram.covariance_long(_embeddings(spark, root)), "covariance", digits=8)


def lineitem_covariance(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(gram.covariance_long(_measures(spark, root)), "covariance", digits=3)


def total_variance(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(gram.total_variance(_embeddings(spark, root)), "total_variance")


# --- vectors -----------------------------------------------------------------------------------------------


def assemble_columns(spark: SparkSession, root: str) -> DataFrame:
    rows = _measures(spark, root, "l_orderkey", "l_linenumber")
    return vectors.expand(rows, "features", "v_", len(MEASURES))


def expand_vector(spark: SparkSession, root: str) -> DataFrame:
    return vectors.expand(vectors.to_vector(_embeddings(spark, root)), "features", "pca_")


# --- sampling and splits -----------------------------------------------------------------------------------


def hash_sample(spark: SparkSession, root: str) -> DataFrame:
    return sampling.hash_sample(_table(spark, root, "documents", "doc_id", "lang"), "doc_id", 100)


def min_class_filter(spark: SparkSession, root: str) -> DataFrame:
    return sampling.min_class_filter(_table(spark, root, "events", "event_id", "user_id"), "user_id", 70)


def excluded_classes(spark: SparkSession, root: str) -> DataFrame:
    return sampling.excluded_classes(_table(spark, root, "events", "user_id"), "user_id", 70)


def balance_exact(spark: SparkSession, root: str) -> DataFrame:
    return sampling.cap_classes(_table(spark, root, "documents", "doc_id", "lang"), "lang", "doc_id", 100)


def balance_bernoulli(spark: SparkSession, root: str) -> DataFrame:
    return sampling.cap_classes(
        _table(spark, root, "documents", "doc_id", "lang"), "lang", "doc_id", 100, method="bernoulli"
    )


def balance_dataset(spark: SparkSession, root: str) -> DataFrame:
    events = _table(spark, root, "events", "event_id", "user_id")
    return sampling.balance_dataset(events, "user_id", "event_id", max_per_class=65, min_per_class=60)


def reduction_report(spark: SparkSession, root: str) -> DataFrame:
    events = _table(spark, root, "events", "event_id", "user_id")
    flags = sampling.balance_flags(events, "user_id", "event_id", max_per_class=65, min_per_class=60)
    return _rounded(classes.reduction_report(flags), "percent_reduction")


def hash_split(spark: SparkSession, root: str) -> DataFrame:
    return sampling.hash_split(_table(spark, root, "documents", "doc_id"), "doc_id")


def stratified_split(spark: SparkSession, root: str) -> DataFrame:
    return sampling.stratified_split(_table(spark, root, "documents", "doc_id", "lang"), "lang", "doc_id")


def split_report(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(classes.split_report(stratified_split(spark, root)), "percent")


def union_splits(spark: SparkSession, root: str) -> DataFrame:
    train, test = sampling.train_test_split(
        _table(spark, root, "documents", "doc_id", "lang"), label="lang", key="doc_id"
    )
    return sampling.union_all(train, test)


def prepare_data(spark: SparkSession, root: str) -> DataFrame:
    train, test = sampling.prepare_data(_embeddings(spark, root), "label", "features", key="vec_id")
    parts = sampling.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))
    return parts.select("vec_id", "label", "part", F.size("features").alias("length"))


# --- reduction ---------------------------------------------------------------------------------------------


def variance_curve(spark: SparkSession, root: str) -> DataFrame:
    curve = reduction.variance_curve(_diagonal(spark, root), 0.95)
    return _rounded(curve, "individual_variance", "cum_variance")


def optimal_k(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(reduction.optimal_k(_diagonal(spark, root), 0.9), "cum_variance")


def k_fallback(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(reduction.k_fallback(_diagonal(spark, root), 500, 0.8), "cum_variance")


def reduction_factor(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(
        reduction.reduction_factors(_diagonal(spark, root), 64), "reduction_factor", "percent_reduction"
    )


def quality_verdict(spark: SparkSession, root: str) -> DataFrame:
    report = jobs.report_job(_embeddings(spark, root), _diagonal(spark, root))
    return _rounded(report, "explained_variance", "balance_ratio", "spread_percent")


def pca_variance(spark: SparkSession, root: str) -> DataFrame:
    table = reduction.explained_variance(vectors.to_vector(_embeddings(spark, root)))
    return _rounded(table, "individual_variance", "cum_variance")


def pca_variance_random(spark: SparkSession, root: str) -> DataFrame:
    """The first eight rows of the same table by the range finder, which holds no covariance matrix."""
    table = reduction.explained_variance(vectors.to_vector(_embeddings(spark, root)), 8, None, engine="random")
    return _rounded(table, "individual_variance", "cum_variance")


def pca_variance_pair(spark: SparkSession, root: str) -> DataFrame:
    table = reduction.explained_variance(_pair(spark, root), threshold=None)
    return _rounded(table, "individual_variance", "cum_variance", digits=9)


def pca_spectrum(spark: SparkSession, root: str) -> DataFrame:
    """Sum and sum of squares of all variance shares; trace and Frobenius norm of the covariance fix them."""
    shares = reduction.explained_variance(vectors.to_vector(_embeddings(spark, root)), threshold=None)
    v = F.col("individual_variance")
    return shares.agg(F.count(v).alias("k"), _r(F.sum(v)).alias("shares"), _r(F.sum(v * v), 8).alias("squares"))


def pca_project(spark: SparkSession, root: str) -> DataFrame:
    """Every coordinate on the components that explain 95 %, in long form."""
    reduced, _ = jobs.reduce_job(_embeddings(spark, root))
    values = vectors.as_array(reduced, "features_pca")
    long = reduced.select("vec_id", "label", F.posexplode(values).alias("component", "value"))
    return _rounded(long, "value")


def pca_project_pair(spark: SparkSession, root: str) -> DataFrame:
    reduced = reduction.apply_pca(_pair(spark, root, "l_orderkey", "l_linenumber"), 2)
    flat = vectors.expand(reduced, "features_pca", "pca_", 2, ["l_orderkey", "l_linenumber"])
    return _rounded(flat, "pca_0", "pca_1", digits=4)


def pca_planar_pair(spark: SparkSession, root: str) -> DataFrame:
    flat = reduction.planar(_pair(spark, root, "l_orderkey", "l_linenumber"), "features")
    return _rounded(flat.select("l_orderkey", "l_linenumber", "x", "y"), "x", "y", digits=4)


def pca_norms(spark: SparkSession, root: str) -> DataFrame:
    """With all components the projection is a rotation: every row keeps its length."""
    reduced = reduction.apply_pca(vectors.to_vector(_embeddings(spark, root)), 64)
    squares = F.aggregate(vectors.as_array(reduced, "features_pca"), F.lit(0.0), lambda a, x: a + x * x)
    return reduced.select("vec_id", _r(F.sqrt(squares)).alias("norm"))


def pca_first(spark: SparkSession, root: str) -> DataFrame:
    """Coordinates on the first three components."""
    reduced = reduction.apply_pca(vectors.to_vector(_embeddings(spark, root)), 3)
    return _rounded(vectors.expand(reduced, "features_pca", "pca_", 3, ["vec_id"]), "pca_0", "pca_1", "pca_2")


def pca_2d(spark: SparkSession, root: str) -> DataFrame:
    flat = reduction.planar(vectors.to_vector(_embeddings(spark, root)), "features")
    return _rounded(flat.select("vec_id", "label", "x", "y"), "x", "y")


def synthetic_reduction(spark: SparkSession, root: str) -> DataFrame:
    """The 1280-column demonstration in one row: projected rows and their length, and what fixes the whole spectrum."""
    ids = _table(spark, root, "embeddings", "vec_id").withColumnRenamed("vec_id", "image_id")
    demo = vectors.to_vector(jobs.synthetic_rows(ids, "image_id"))
    model = reduction.fit_up_to(demo, images.FEATURE_LENGTH)
    reduced = reduction.project(demo, model.first(reduction.DEFAULT_K), output="pca_features")
    values = reduced.select("image_id", F.posexplode(vectors.as_array(reduced, "pca_features")).alias("component", "value"))
    sizes = values.groupBy("image_id").agg((F.max("component") + 1).alias("length"))
    shares = model.explained_variance
    return sizes.groupBy("length").agg(F.count("*").alias("n_rows")).select(
        "length", "n_rows", _r(F.lit(float(shares.sum()))).alias("shares"), _r(F.lit(float((shares**2).sum())), 8).alias("squares")
    )


def synthetic_coordinates(spark: SparkSession, root: str) -> DataFrame:
    """The projected coordinates of the 1280-column demonstration, every row, in long form."""
    ids = _table(spark, root, "embeddings", "vec_id").withColumnRenamed("vec_id", "image_id")
    demo = vectors.to_vector(jobs.synthetic_rows(ids, "image_id"))
    model = reduction.fit_up_to(demo, images.FEATURE_LENGTH)
    reduced = reduction.project(demo, model.first(reduction.DEFAULT_K), output="pca_features")
    values = reduced.select("image_id", F.posexplode(vectors.as_array(reduced, "pca_features")).alias("component", "value"))
    return _rounded(values, "value")


def reduce_report(spark: SparkSession, root: str) -> DataFrame:
    reduced, variance = jobs.reduce_job(_embeddings(spark, root))
    return _rounded(jobs.report_job(reduced, variance), "explained_variance", "balance_ratio", "spread_percent")


def class_means(spark: SparkSession, root: str) -> DataFrame:
    """Flagship: reduce the feature table, then count, share and mean of the first components per class."""
    reduced, _ = jobs.reduce_job(_embeddings(spark, root))
    return _rounded(jobs.class_means(reduced), "mean_0", "mean_1", "mean_2", "percent")


# --- models ------------------------------------------------------------------------------------------------


def label_index(spark: SparkSession, root: str) -> DataFrame:
    return classification.label_index(_table(spark, root, "documents", "source"), "source")


def label_index_ids(spark: SparkSession, root: str) -> DataFrame:
    """Numeric labels of several digits: equal counts go by the text of the label."""
    return classification.label_index(_table(spark, root, "events", "user_id"), "user_id")


def class_metrics(spark: SparkSession, root: str) -> DataFrame:
    metrics = classification.class_metrics(_table(spark, root, "labels", "quality", "toxic"), "quality", "toxic")
    return _rounded(metrics, *metrics.columns)


def confusion_matrix(spark: SparkSession, root: str) -> DataFrame:
    return classification.confusion_matrix(_table(spark, root, "labels", "quality", "toxic"), "quality", "toxic", dense=True)


def silhouette(spark: SparkSession, root: str) -> DataFrame:
    rows = vectors.to_vector(_embeddings(spark, root))
    score = clustering.silhouette(rows, "features", "label")
    return tables.driver_rows(spark, [(score,)], "silhouette double").select(_r("silhouette").alias("silhouette"))


def _separable(spark: SparkSession, root: str) -> DataFrame:
    """The embeddings with every tenth position raised by 100, beginning at the label: one cluster for each label."""
    raised = F.transform("features", lambda x, i: x.cast("double") + F.when(i % 10 == F.col("label"), 100.0).otherwise(0.0))
    return vectors.to_vector(_embeddings(spark, root).withColumn("features", raised))


def _label_of_cluster(assigned: DataFrame) -> DataFrame:
    """``cluster`` replaced by the smallest label in it, which does not depend on the clusters' numbers."""
    named = assigned.groupBy("cluster").agg(F.min("label").alias("cluster_label"))
    return assigned.join(named, "cluster").drop("cluster")


def rf_predict(spark: SparkSession, root: str) -> DataFrame:
    """Classes that can be told apart: every prediction is the label."""
    rows = _separable(spark, root)
    train, test = sampling.train_test(sampling.stratified_split(rows, "label", "vec_id"))
    model = classification.train_classifier(train, "label", "features", key="vec_id")
    return classification.predict(model, test).select("vec_id", "label", "label_indexed", "prediction", "predicted_label")


def kmeans_assign(spark: SparkSession, root: str) -> DataFrame:
    """Clusters that lie apart: each is one label."""
    _, assigned = clustering.train_kmeans(_separable(spark, root), "features", key="vec_id")
    return _label_of_cluster(assigned.select("vec_id", "label", "cluster"))


def cluster_chart(spark: SparkSession, root: str) -> DataFrame:
    """The clusters of ``kmeans_assign`` over the plane of the embeddings themselves, all rows."""
    _, assigned = clustering.train_kmeans(_separable(spark, root), "features", key="vec_id")
    plain = vectors.to_vector(_embeddings(spark, root)).join(assigned.select("vec_id", "cluster"), "vec_id")
    return _rounded(_label_of_cluster(clustering.cluster_chart(plain, "vec_id", "features")), "x", "y")


def rf_predict_plain(spark: SparkSession, root: str) -> DataFrame:
    """The forest fitted on the embeddings as they are; the label is no input of the features."""
    train, test = sampling.train_test(sampling.stratified_split(vectors.to_vector(_embeddings(spark, root)), "label", "vec_id"))
    model = classification.train_classifier(train, "label", "features", key="vec_id")
    return classification.predict(model, test).select("vec_id", "label", "label_indexed", "prediction", "predicted_label")


def kmeans_assign_plain(spark: SparkSession, root: str) -> DataFrame:
    """The clusters of the embeddings as they are."""
    _, assigned = clustering.train_kmeans(vectors.to_vector(_embeddings(spark, root)), "features", key="vec_id")
    return assigned.select("vec_id", "label", "cluster")


def cluster_chart_plain(spark: SparkSession, root: str) -> DataFrame:
    """The clusters of ``kmeans_assign_plain`` over the plane, all rows."""
    _, assigned = clustering.train_kmeans(vectors.to_vector(_embeddings(spark, root)), "features", key="vec_id")
    return _rounded(clustering.cluster_chart(assigned, "vec_id", "features"), "x", "y")


# --- images ------------------------------------------------------------------------------------------------


def _grey_images(spark: SparkSession, root: str) -> DataFrame:
    """Every embedding drawn as an 8 x 8 grey image: value v becomes pixel floor((v + 1) * 127.5)."""
    pixel = lambda v: F.lpad(F.hex(F.floor((v.cast("double") + 1) * 127.5).cast("long")), 2, "0")
    data = F.unhex(F.array_join(F.transform("features", pixel), ""))
    image = F.struct(
        F.lit(CHECK_GRID).alias("height"),
        F.lit(CHECK_GRID).alias("width"),
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        data.alias("data"),
    )
    return spread(_embeddings(spark, root), "vec_id").select("vec_id", image.alias("image"))


def image_features(spark: SparkSession, root: str) -> DataFrame:
    factory = images.colour_features(CHECK_GRID, CHECK_GRID, CHECK_BINS)
    done = images.featurise(_grey_images(spark, root), factory, on_error="fail")
    plane = CHECK_GRID * CHECK_GRID
    tiles, shares = F.slice("features", 1, plane), F.slice("features", plane + 1, CHECK_BINS)
    return done.select(
        "vec_id",
        "status",
        F.size("features").alias("length"),
        F.aggregate(tiles, F.lit(0).cast("long"), lambda a, x: a + F.round((x + 1) * 127.5).cast("long")).alias("pixel_sum"),
        _r(F.array_max(tiles), 5).alias("tile_max"),
        _r(F.array_max(shares), 5).alias("largest_share"),
        _r(F.aggregate(shares, F.lit(0.0), lambda a, x: a + x), 5).alias("share_sum"),
    )


def image_failures(spark: SparkSession, root: str) -> DataFrame:
    """Planted cut, missing and small images: status and features of all rows for two ways to treat errors."""
    whole = _grey_images(spark, root)
    cut = F.struct("image.height", "image.width", "image.nChannels", "image.mode", F.substring("image.data", 1, 10).alias("data"))
    small = F.struct(F.lit(1).alias("height"), F.lit(2).alias("width"), "image.nChannels", "image.mode", F.substring("image.data", 1, 2).alias("data"))
    kind = F.col("vec_id") % 10
    image = F.when(kind == 1, cut).when(kind == 2, small).when(kind != 3, F.col("image"))
    planted = whole.select("vec_id", F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("label"), image.alias("image"))
    checked = images.validate_images(planted, min_size=(CHECK_GRID, CHECK_GRID))
    factory, length = images.colour_features(CHECK_GRID, CHECK_GRID, CHECK_BINS), 4 * (CHECK_GRID * CHECK_GRID + CHECK_BINS)
    out = None
    for mode in ("zero", "null"):
        done = images.featurise(checked.drop("valid"), factory, length, mode, reason="reason")
        rows = done.select(
            "vec_id", F.lit(mode).alias("mode"), "status", "reason", F.size("features").alias("length"),
            F.exists("features", lambda x: x != 0).alias("any_value"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _colour_images(spark: SparkSession, root: str) -> DataFrame:
    """All 64 numbers of every embedding, and two zeros, as a colour image of 2 rows and 11 columns, blue, green, red."""
    pixel = lambda v: F.lpad(F.hex(F.floor((v.cast("double") + 1) * 127.5).cast("long")), 2, "0")
    data = F.unhex(F.concat(F.array_join(F.transform("features", pixel), ""), F.lit("0000")))
    sides = {"height": 2, "width": 11, "nChannels": 3, "mode": 16}
    image = F.struct(*(F.lit(v).alias(k) for k, v in sides.items()), data.alias("data"))
    return spread(_embeddings(spark, root), "vec_id").select("vec_id", image.alias("image"))


def image_descriptor(spark: SparkSession, root: str) -> DataFrame:
    """The default 1280-number descriptor of every image at full input size, told by means of its tiles and shares."""
    done = images.featurise(_colour_images(spark, root), on_error="fail")
    mean = lambda values, power: F.aggregate(values, F.lit(0.0), lambda a, x: a + x**power) / 256
    plane = lambda p: F.struct(
        p.alias("plane"),
        F.transform(F.slice("features", p * 320 + 1, 256), lambda v: v.cast("double")).alias("tiles"),
        F.aggregate(F.slice("features", p * 320 + 257, 64), F.lit(0.0), lambda a, x: a + x).alias("shares"),
    )
    planes = F.transform(F.sequence(F.lit(0), F.lit(3)), plane)
    rows = done.select("vec_id", F.size("features").alias("length"), F.explode(planes).alias("p")).select("vec_id", "length", "p.*")
    return rows.select(
        "vec_id", "plane", "length", _r(mean("tiles", 1), 2).alias("mean_tile"), _r(mean("tiles", 2), 2).alias("mean_square"), _r("shares", 4).alias("share_sum")
    )


def _png(side: int, grey: bytes) -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = b"".join(b"\0" + grey[i : i + side] for i in range(0, side * side, side))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def _image_files(spark: SparkSession, root: str) -> str:
    """A folder in the scratch folder with every embedding as a grey PNG of 8 x 8 pixels, one folder for each label.

    Tasks write the files, so the scratch folder must be a local or mounted one.
    """
    folder = store.scratch(spark)
    place = walk.local_path(files.qualified(spark, folder))
    if place is None:
        raise ValueError("this query writes files and needs a local or mounted scratch folder")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for vec_id, label, grey in zip(rows["vec_id"], rows["label"], rows["grey"], strict=True):
                os.makedirs(f"{place}/{label}", exist_ok=True)
                with open(f"{place}/{label}/{vec_id}.png", "wb") as out:
                    out.write(_png(8, bytes(grey.tolist())))
            yield pd.DataFrame({"n": [len(rows)]})

    grey = F.transform("features", lambda v: F.floor((v.cast("double") + 1) * 127.5).cast("int"))
    rows = _embeddings(spark, root).select("vec_id", "label", grey.alias("grey"))
    rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return folder


def image_scan(spark: SparkSession, root: str) -> DataFrame:
    """Image files, scanned and decoded: the sum of each one's pixels."""
    scanned = files.scan_images(spark, _image_files(spark, root))
    name = F.regexp_replace(paths.base_name("path"), r"\.png$", "").cast("long").alias("vec_id")
    pixels = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(F.hex("image.data"), i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    return scanned.select(name, "label", "image.height", "image.width", "image.nChannels", F.aggregate(pixels, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """Per class what the listings of an image folder find: index, binary scan, chart listing, input files."""
    folder = _image_files(spark, root)
    found = {
        "indexed": files.image_index(spark, folder).select("label"),
        "scanned": files.scan_binary(spark, folder, "*.png").where("length(content) = length").select(paths.label_from_path("path").alias("label")),
        "charts": inventory.chart_files(spark, folder).select(paths.label_from_path("path").alias("label")),
    }
    each = [frame.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "label", "n") for kind, frame in found.items()]
    every = inventory.input_files(spark, folder).select(F.lit("inputs").alias("kind"), F.lit("").alias("label"), F.col("files").alias("n"))
    return sampling.union_all(*each, every)


def inspect_dataset(spark: SparkSession, root: str) -> DataFrame:
    profile, _ = inventory.inspect(spark, f"{root}/supplier.parquet")
    return profile.select("column", "dtype", "n_rows", "n_null")


def image_validation(spark: SparkSession, root: str) -> DataFrame:
    height = F.when(F.col("p_size") == 50, -1).otherwise((F.col("p_partkey") % 64).cast("int"))
    width = F.when(F.col("p_size") == 50, -1).otherwise(F.col("p_size"))
    image = F.when(F.col("p_size") != 49, F.struct(height.alias("height"), width.alias("width")))
    parts = _table(spark, root, "part", "p_partkey", "p_size").select("p_partkey", image.alias("image"))
    return images.validate_images(parts).select("p_partkey", "reason", "valid")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        row_count, range_classes, replicate_rows, synthetic_features, vector_shape, parquet_round_trip,
        csv_round_trip, logged_write, stage_update, dataset_inventory, part_files, directory_size, integrity,
        integrity_status, path_label, path_label_regex, class_names, url_class, url_class_marked, expected_results,
        class_counts, class_share, class_relative, class_balance, distinct_classes, class_list, class_sample,
        null_profile, frame_summary, frame_check, feature_stats, lineitem_feature_stats, feature_histogram,
        class_box_stats, lineitem_box_stats, component_correlation, component_variance, covariance_long,
        lineitem_covariance, total_variance, assemble_columns, expand_vector, hash_sample, min_class_filter,
        excluded_classes, balance_exact, balance_bernoulli, balance_dataset, reduction_report, hash_split,
        stratified_split, split_report, union_splits, prepare_data, variance_curve, optimal_k, k_fallback,
        reduction_factor, quality_verdict, pca_variance, pca_variance_pair, pca_variance_random, pca_spectrum, pca_project,
        pca_project_pair, pca_planar_pair, pca_norms, pca_first, pca_2d, synthetic_reduction, synthetic_coordinates, reduce_report, class_means,
        label_index, label_index_ids, class_metrics, confusion_matrix, silhouette, rf_predict, kmeans_assign, cluster_chart,
        rf_predict_plain, kmeans_assign_plain, cluster_chart_plain,
        image_features, image_failures, image_descriptor, image_validation, image_scan, image_files, inspect_dataset,
    )
}
