"""The four flows: featurise, reduce, model, report; and the synthetic demonstration.

Stages hand over through ``store.materialize``: each is written once, read back, and reused only for the
same parameters over the same source files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import paths, rules, vectors
from featureflow.operators import classes, classification, clustering, images, reduction, sampling
from featureflow.sources import files, stages, store, tables
from featureflow.sources.settle import spread


@dataclass(frozen=True)
class ReduceConfig:
    features: str = "features"
    max_k: int = reduction.MAX_K
    threshold: float = reduction.THRESHOLD
    engine: str = "moments"


@dataclass(frozen=True)
class ModelConfig:
    key: str = "path"
    label: str = "label"
    features: str = "features_pca"
    train_ratio: float = 0.8
    min_per_class: int = 5
    max_per_class: int | None = None
    clusters: int = clustering.CLUSTERS
    trees: int = classification.NUM_TREES
    seed: int = 42


@dataclass(frozen=True)
class FeaturizeConfig:
    min_size: tuple[int, int] = (images.MIN_SIDE, images.MIN_SIDE)
    on_error: str = "null"
    length: int = images.FEATURE_LENGTH
    factory: Callable[[], Callable] | None = field(default=None, compare=False)
    factory_name: str | None = None
    average_bytes: int | None = None
    batch: int = images.BATCH
    batch_bytes: int = images.BATCH_BYTES
    refresh: bool = False

    def __post_init__(self) -> None:
        if self.factory is not None and not self.factory_name:
            raise ValueError("a factory needs a factory_name")


def index_job(
    spark: SparkSession, root: str, output: str | None = None, sample_size: int | None = None, refresh: bool = False
) -> DataFrame:
    """Image index ``path, label``, kept in ``output`` when given."""
    if output is None:
        return files.image_index(spark, root, sample_size)
    return store.materialize(
        spark, output, lambda: files.image_index(spark, root, sample_size), {"sample_size": sample_size}, [root], refresh
    )


def featurize_job(
    spark: SparkSession, root: str, output: str, config: FeaturizeConfig = FeaturizeConfig(), index: DataFrame | None = None
) -> DataFrame:
    """Scan, validate, featurise, write: ``path, label, features, status, error, reason``, one row for each indexed image.

    Without an ``index`` the images one level below the root count, as ``index_job`` lists them. An image that
    validation rejects has status ``rejected`` and its reason; ``classes.reason_report`` sums the reasons up.
    ``average_bytes`` of a file packs the scan's tasks for many small files; the network gets ``batch`` images at a
    time, or fewer if their pixels exceed ``batch_bytes``. A later run computes only images that are new or changed and
    drops those that are gone; read the result with ``stages.read_stage``.
    """

    meta = files.list_files(spark, root).select(paths.same_uri("path").alias("__uri"), "length", "modificationTime")
    wanted = files.image_index(spark, root) if index is None else index
    listing = wanted.select("path", "label").join(meta, paths.same_uri("path") == F.col("__uri"), "left").drop("__uri")

    def compute(part: DataFrame | None) -> DataFrame:
        """Features of a part of the listing, or of all of it."""
        todo = listing if part is None else part
        scanned = files.indexed_images(spark, root, index if part is None else part)
        checked = images.validate_images(scanned, todo.select("path", "label"), min_size=config.min_size)
        return images.featurise_checked(
            checked, config.factory, config.length, config.on_error, batch=config.batch, batch_bytes=config.batch_bytes
        )

    params = {
        "factory": [config.factory_name, images.factory_digest(config.factory)],
        "length": config.length,
        "on_error": config.on_error,
        "min_size": list(config.min_size),
    }
    conf = images.arrow_conf(config.batch_bytes)
    if config.average_bytes is not None:
        conf |= files.scan_conf(config.average_bytes)
    with store.settings(spark, conf):
        return stages.follow(spark, output, listing, compute, params, config.refresh)


def reduce_job(df: DataFrame, config: ReduceConfig = ReduceConfig()) -> tuple[DataFrame, DataFrame]:
    """(reduced frame with ``features_pca``, variance table); features may be arrays or ML vectors.

    One fit gives both the choice of k and the loadings, so the rows are read twice: once to sum the moments
    and once, lazily, to project.
    """
    model = reduction.fit_up_to(df, config.max_k, config.features, config.engine)
    variance = reduction.variance_table(df.sparkSession, model, config.threshold)
    k = reduction.optimal_k(variance, config.threshold).head()["k"]
    return reduction.project(df, model.first(k), config.features).drop(config.features), variance


def stored_reduce_job(
    spark: SparkSession, features: str, output: str, config: ReduceConfig = ReduceConfig(), refresh: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``reduce_job`` on a stored feature set: ``<output>/features_pca.parquet`` and ``<output>/pca_variance.parquet``.

    Rows without features are left out. Both results are reused for the same settings over the same files,
    and a change of either recomputes them together.
    """
    computed: dict[str, DataFrame] = {}

    def stage(name: str) -> Callable[[], DataFrame]:
        def compute() -> DataFrame:
            if not computed:
                rows = stages.read_stage(spark, features).filter(F.col(config.features).isNotNull())
                computed["reduced"], computed["variance"] = reduce_job(rows, config)
            return computed[name]

        return compute

    params = vars(config)
    variance = store.materialize(spark, f"{output}/pca_variance.parquet", stage("variance"), params, [features], refresh)
    reduced = store.materialize(spark, f"{output}/features_pca.parquet", stage("reduced"), params, [features], refresh)
    return reduced, variance


def image_job(
    spark: SparkSession, root: str, output: str, featurize: FeaturizeConfig = FeaturizeConfig(),
    reduce: ReduceConfig = ReduceConfig(), sample_size: int | None = None,
) -> DataFrame:
    """Images to reduced vectors: index, features, variance table, ``final_results`` as Parquet and CSV, run log, report.

    ``sample_size`` runs the flow on a sample of the index. ``results/validation.parquet`` tells how many images each
    reason of the validation took.
    """
    features = f"{output}/cache/features.parquet"
    index = None if sample_size is None else index_job(spark, root, f"{output}/cache/index.parquet", sample_size)
    done = featurize_job(spark, root, features, featurize, index)
    store.write_parquet(classes.reason_report(done), f"{output}/results/validation.parquet")
    reduced, variance = stored_reduce_job(spark, features, f"{output}/results", reduce)
    final = reduced.select("path", "label", "features_pca")
    store.write_logged(final, f"{output}/final_results.parquet", f"{output}/logs/run.parquet", "final_results")
    store.write_csv(final, f"{output}/final_results.csv")
    return report_job(final, variance, threshold=reduce.threshold)


def model_job(
    df: DataFrame, config: ModelConfig = ModelConfig(), output: str | None = None
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(classifier, its metrics on the test part, frame with clusters). The split rows are stored in ``output`` or cached."""
    balanced = sampling.balance_dataset(
        df, config.label, config.key, max_per_class=config.max_per_class, min_per_class=config.min_per_class,
        seed=config.seed,
    )
    split = sampling.stratified_split(balanced, config.label, config.key, config.train_ratio, config.seed)
    # the caps and the split are read by both fits and the metrics: computed once
    split = store.keep_in_memory(split) if output is None else store.rewritten(split, f"{output}/split.parquet")
    train, test = sampling.train_test(split)
    classifier = classification.train_classifier(
        train, config.label, config.features, num_trees=config.trees, seed=config.seed, key=config.key
    )
    metrics, _ = classification.evaluate_classifier(classifier, test, config.label)
    rows = split.drop("split")
    _, clustered = clustering.train_kmeans(rows, config.features, config.clusters, config.seed, config.key)
    return classifier, metrics, clustered


def report_job(
    reduced: DataFrame, variance: DataFrame, label: str = "label", threshold: float = reduction.THRESHOLD
) -> DataFrame:
    """One row: rows, classes, components, explained variance, whether it reached the threshold, balance, verdicts."""
    balance = classes.class_balance(reduced, label)
    last = reduction.optimal_k(variance, threshold)
    explained = last.select("cum_variance").scalar()
    ratio = F.col("balance_ratio")
    return balance.select(
        F.col("total").alias("n_rows"),
        "n_classes",
        last.select("k").scalar().alias("k"),
        explained.alias("explained_variance"),
        last.select("reached").scalar().alias("reached"),
        ratio,
        "spread_percent",
        rules.balance_verdict(ratio).alias("balance"),
        rules.variance_verdict(explained).alias("variance"),
        rules.overall_verdict(explained, ratio).alias("overall"),
    )


def class_means(reduced: DataFrame, label: str = "label", features: str = "features_pca", components: int = 3) -> DataFrame:
    """Per class: rows, share, and mean of the first components."""
    values = vectors.as_array(reduced, features)
    narrow = reduced.select(label, *[F.try_element_at(values, F.lit(i + 1)).alias(f"c{i}") for i in range(components)])
    per_class = narrow.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"mean_{i}") for i in range(components)]
    )
    total = per_class.agg(F.sum("n")).scalar()
    return per_class.withColumn("percent", rules.ratio(F.col("n"), total) * 100)


def synthetic_rows(
    ids: DataFrame, id_col: str, d: int = images.FEATURE_LENGTH, seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """``id, label, features`` with class names by id and reproducible uniform features.

    An id of 8 bytes becomes a row of 8 * d bytes, so the ids are spread first; size ``partitions`` by the output.
    """
    labelled = tables.with_class_id(spread(ids.select(id_col), id_col, partitions), id_col, len(paths.CLASS_NAMES))
    return labelled.select(
        id_col,
        paths.class_name("class_id").alias("fruit_label"),
        tables.synthetic_features(id_col, d, seed).alias("features"),
    )


def wide_features(df: DataFrame, features: str | Column, d: int, prefix: str = "f_", keep: tuple[str, ...] = ()) -> DataFrame:
    """One column per feature, as a source of ``assemble``."""
    source = F.col(features) if isinstance(features, str) else features
    return df.select(*keep, *[source[i].alias(f"{prefix}{i}") for i in range(d)])


def synthetic_job(
    spark: SparkSession, rows: int, output: str | None = None, d: int = images.FEATURE_LENGTH, k: int = reduction.DEFAULT_K
) -> DataFrame:
    """Ids, labels, features, assembled vector, PCA; written to Parquet when ``output`` is given."""
    demo = synthetic_rows(tables.id_range(spark, rows, len(paths.CLASS_NAMES)), "image_id", d)
    ready = vectors.to_vector(demo)
    result = reduction.apply_pca(ready, k, output="pca_features").select("image_id", "fruit_label", "pca_features")
    if output is not None:
        store.write_parquet(result, output)
        result = spark.read.parquet(output)
    return result
