"""Principal components: variance table, choice of k, projection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.functions import rules
from featureflow.functions.vectors import as_array, require_vector, to_vector, vector_length
from featureflow.operators import gram
from featureflow.operators.sampling import hash_sample
from featureflow.sources.tables import VARIANCE_TABLE

# Search limit, variance threshold and default number of components.
MAX_K = 200
THRESHOLD = 0.95
DEFAULT_K = 100
# Columns of the range finder beyond those asked for, and passes over the rows at most.
EXTRA = 20
PASSES = 10


@dataclass(frozen=True)
class PcaModel:
    """d x k loadings, explained-variance shares of the k components, and the column means."""

    components: np.ndarray
    explained_variance: np.ndarray
    mean: np.ndarray
    residual: float = 0.0  # of an approximate fit: largest |C v - w v| over the components, as a share of the first w

    @property
    def k(self) -> int:
        return self.components.shape[1]

    def first(self, k: int) -> PcaModel:
        """The model with the first k components; equal to a fit with that k."""
        if not 1 <= k <= self.k:
            raise ValueError(f"k must be between 1 and {self.k}")
        return PcaModel(self.components[:, :k], self.explained_variance[:k], self.mean, self.residual)


def fit_pca(df: DataFrame, k: int | None, column: str = "features", engine: str = "moments") -> PcaModel:
    """Fit k components (all for None), in one pass over the vectors but for ``random``.

    ``engine='moments'`` sums the covariance with the distributed Gram job and decomposes the d x d matrix on
    the driver. ``engine='ml'`` is ``pyspark.ml.feature.PCA``; same result, slower decomposition for large d.
    ``engine='random'`` is for vectors so wide that d x d numbers are too many: see ``leading_components``.
    The sign of a component is fixed: its loading of largest magnitude is positive.
    """
    require_vector(df, column)
    return _fit(df, k, column, engine)


def _fit(df: DataFrame, k: int | None, column: str, engine: str) -> PcaModel:
    """The fit itself; arrays are taken as they are stored, without a vector in between, but for ``ml``."""
    residual = 0.0
    if engine == "ml":
        d = vector_length(df, column)
        if d is None:
            raise ValueError(f"no vectors in column '{column}'")
        k = _checked_k(k, d)
        rows = df.filter(F.col(column).isNotNull())
        model = PCA(k=k, inputCol=column, outputCol="__pca").fit(rows)
        loadings, shares = model.pc.toArray(), model.explainedVariance.toArray()
        mean = np.zeros(d)
    elif engine == "moments":
        pivot = gram.pivot_vector(df, column)
        k = _checked_k(k, len(pivot))
        _, mean, cov = gram.covariance(df, column, pivot)
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][:k]
        total = values.clip(min=0.0).sum()
        shares = values[order].clip(min=0.0) / total if total > 0 else np.zeros(k)
        loadings = vectors[:, order]
    elif engine == "random":
        found = leading_components(df, vector_length(df, column) if k is None else k, column)
        loadings, shares, mean, residual = found.components, found.explained_variance, found.mean, found.residual
        k = found.k
    else:
        raise ValueError("engine must be 'moments', 'ml' or 'random'")
    largest = np.abs(loadings).argmax(axis=0)
    signs = np.where(loadings[largest, np.arange(k)] < 0, -1.0, 1.0)
    return PcaModel(loadings * signs, shares, mean, residual)


def leading_components(
    df: DataFrame, k: int, column: str = "features", extra: int = EXTRA, passes: int = PASSES, tolerance: float = 1e-9, seed: int = 42
) -> PcaModel:
    """The first k components by a randomised range finder, without d x d numbers anywhere.

    Each pass over the rows multiplies the covariance with d x (k + extra) numbers: random ones first, then what the
    last product has that is orthogonal to all directions found. The components are the best in the span of those
    directions (a block Krylov space). It ends when every component's residual is below ``tolerance`` times the first
    variance, when the directions span everything, or after ``passes``; the model tells the residual. The driver holds
    2 x passes x d x (k + extra) numbers, a task d x (k + extra).
    """
    n, mean, squares = gram.column_moments(df, column, gram.pivot_vector(df, column))
    d, total = len(mean), squares.sum() / (n - 1)
    k = _checked_k(k, d)
    block, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, min(d, k + extra))))
    directions, products = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(passes):
        product = gram.covariance_product(df, column, n, mean, block)
        directions, products = np.hstack([directions, block]), np.hstack([products, product])
        inner = directions.T @ products
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        loadings = directions @ vectors
        largest = max(values[0], 0.0)
        residual = np.linalg.norm(products @ vectors - loadings * values, axis=0).max()
        rest = product
        for _ in range(2):  # once more, for what rounding left
            rest = rest - directions @ (directions.T @ rest)
        left, sizes, _ = np.linalg.svd(rest, full_matrices=False)
        block = left[:, sizes > 1e-13 * largest][:, : d - directions.shape[1]]
        if residual <= tolerance * largest or not block.shape[1]:
            break
    shares = values.clip(min=0.0) / total if total > 0 else np.zeros(k)
    return PcaModel(loadings, shares, mean, float(residual / largest) if largest > 0 else 0.0)


def _checked_k(k: int | None, d: int) -> int:
    k = d if k is None else k
    if not 1 <= k <= d:
        raise ValueError(f"k must be between 1 and {d}, got {k}")
    return k


def project(
    df: DataFrame, model: PcaModel, column: str = "features", output: str = "features_pca", centre: bool = False
) -> DataFrame:
    """Add ``output`` = x . components as an ML vector; one matrix product per Arrow batch, no shuffle.

    As in Spark ML the vectors are not centred unless asked. The loadings (d*k numbers) are broadcast once.
    """
    d = model.components.shape[0]
    loadings = df.sparkSession.sparkContext.broadcast(model.components)
    shift = -(model.mean @ model.components) if centre else np.zeros(model.k)

    @F.arrow_udf("array<double>")
    def multiply(v: pa.Array) -> pa.Array:
        present = v.is_valid().to_numpy(zero_copy_only=False)
        out = gram.matrix(v.drop_null(), d) @ loadings.value + shift
        offsets = np.zeros(len(v) + 1, dtype=np.int32)
        np.cumsum(np.where(present, out.shape[1], 0), out=offsets[1:])
        return pa.ListArray.from_arrays(
            pa.array(offsets, mask=np.append(~present, False)), pa.array(out.reshape(-1))
        )

    projected = df.withColumn("__projected", multiply.asNondeterministic()(as_array(df, column, gram.stored_precision(df, column))))
    vector = F.when(F.col("__projected").isNotNull(), array_to_vector("__projected"))
    return projected.withColumn(output, vector).drop("__projected")


def variance_table(spark: SparkSession, model: PcaModel, threshold: float | None = THRESHOLD) -> DataFrame:
    """``k, individual_variance, cum_variance`` up to the first k that reaches ``threshold``."""
    cumulative = np.cumsum(model.explained_variance)
    last = model.k
    if threshold is not None and (cumulative >= threshold).any():
        last = int(np.argmax(cumulative >= threshold)) + 1
    rows = [(i + 1, float(model.explained_variance[i]), float(cumulative[i])) for i in range(last)]
    return spark.createDataFrame(rows, VARIANCE_TABLE)


def explained_variance(
    df: DataFrame, max_k: int = MAX_K, threshold: float | None = THRESHOLD, column: str = "features",
    engine: str = "moments",
) -> DataFrame:
    """Variance table of a frame: a single fit, as the shares of a smaller fit are a prefix of a larger one."""
    require_vector(df, column)
    return variance_table(df.sparkSession, fit_up_to(df, max_k, column, engine), threshold)


def fit_up_to(df: DataFrame, max_k: int, column: str = "features", engine: str = "moments") -> PcaModel:
    """The first ``max_k`` components, or all when the vectors are shorter; arrays and ML vectors alike."""
    if engine == "ml":
        df = to_vector(df, column)
    if engine != "moments":
        return _fit(df, min(max_k, vector_length(df, column) or max_k), column, engine)
    model = _fit(df, None, column, engine)
    return model.first(min(max_k, model.k))


def optimal_k(variance: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row ``k, cum_variance, reached``: smallest k over the threshold, else the largest k of the table."""
    hit = F.col("cum_variance") >= threshold
    found = variance.agg(
        F.min(F.when(hit, F.struct("k", "cum_variance"))).alias("best"), F.max(F.struct("k", "cum_variance")).alias("last")
    )
    chosen = F.coalesce("best", "last")
    return found.select(
        chosen["k"].alias("k"), chosen["cum_variance"].alias("cum_variance"), F.col("best").isNotNull().alias("reached")
    )


def k_fallback(variance: DataFrame, requested: int, threshold: float = THRESHOLD) -> DataFrame:
    """One row: the requested k if the table has it, else the smallest over the threshold, else the largest."""
    row = F.struct("k", "cum_variance")
    found = variance.agg(
        F.max(F.when(F.col("k") == requested, row)).alias("asked"),
        F.min(F.when(F.col("cum_variance") >= threshold, row)).alias("best"),
        F.max(row).alias("last"),
    )
    chosen = F.coalesce("asked", "best", "last")
    return found.select(
        F.lit(requested).alias("requested"), chosen["k"].alias("k"), chosen["cum_variance"].alias("cum_variance")
    )


def variance_curve(variance: DataFrame, threshold: float = THRESHOLD, requested: int | None = None) -> DataFrame:
    """Chart data of the variance table with the threshold line and the chosen point marked."""
    chosen = optimal_k(variance, threshold) if requested is None else k_fallback(variance, requested, threshold)
    return variance.select(
        "k",
        "individual_variance",
        "cum_variance",
        F.lit(threshold).alias("threshold"),
        (F.col("k") == chosen.select("k").scalar()).alias("chosen"),
    )


def diagonal_variance_table(variances: DataFrame, value: str = "variance") -> DataFrame:
    """Variance table of already uncorrelated components, given their variances (one row per component)."""
    total = variances.agg(F.sum(value)).scalar()
    by_size = Window.orderBy(F.col(value).desc())
    share = rules.ratio(F.col(value), total)
    return variances.select(
        F.row_number().over(by_size).alias("k"),
        share.alias("individual_variance"),
        rules.ratio(F.sum(value).over(by_size.rowsBetween(Window.unboundedPreceding, 0)), total).alias("cum_variance"),
    )


def reduction_factors(variance: DataFrame, d: int) -> DataFrame:
    """Reduction factor d/k and percent reduction of every k of the table."""
    k = F.col("k")
    return variance.select(
        "k",
        rules.reduction_factor(F.lit(d), k).alias("reduction_factor"),
        rules.percent_reduction(F.lit(d), k).alias("percent_reduction"),
    )


def optimal_pca_k(
    df: DataFrame, max_k: int = MAX_K, threshold: float = THRESHOLD, column: str = "features"
) -> tuple[int, DataFrame]:
    """(k, variance table)."""
    table = explained_variance(df, max_k, threshold, column)
    return optimal_k(table, threshold).head()["k"], table


def apply_pca(
    df: DataFrame, k: int = DEFAULT_K, column: str = "features", output: str = "features_pca", engine: str = "moments"
) -> DataFrame:
    """Fit and project; wrap in ``store.materialize`` to compute once."""
    require_vector(df, column)
    return project(df, fit_pca(df, k, column, engine), column, output)


def planar(
    df: DataFrame, column: str = "features_pca", key: str | None = None, sample_size: int | None = None, seed: int = 42
) -> DataFrame:
    """Centred two-dimensional coordinates ``x, y`` for display, of all rows or of a hash sample."""
    if sample_size is not None:
        if key is None:
            raise ValueError("a sample needs a key")
        df = hash_sample(df, key, sample_size, seed)
    flat = project(df, fit_pca(df, 2, column), column, "__planar", centre=True)
    at = as_array(flat, "__planar")
    return flat.withColumn("x", at[0]).withColumn("y", at[1]).drop("__planar")
