"""Array and ML-vector columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def require_vector(df: DataFrame, column: str) -> None:
    """Plan-time guard of the reduction and model operators."""
    found = df.schema[column].dataType
    if not isinstance(found, VectorUDT):
        raise TypeError(f"column '{column}' must be an ML vector, found {found.simpleString()}; use to_vector first")


def to_vector(df: DataFrame, column: str = "features") -> DataFrame:
    """Numeric array column to a dense vector under the same name; a null array stays null."""
    if is_vector(df, column):
        return df
    vector = F.when(F.col(column).isNotNull(), array_to_vector(F.col(column).cast("array<double>")))
    return df.withColumn(column, vector)


def as_array(df: DataFrame, column: str, dtype: str = "float64") -> Column:
    """The column as a numeric array, whether it is stored as array or as ML vector.

    ``dtype='float32'`` leaves a stored ``array<float>`` as it is, which halves what is sent to Python.
    """
    found = df.schema[column].dataType
    if isinstance(found, VectorUDT):
        return F.when(F.col(column).isNotNull(), vector_to_array(F.col(column), dtype))
    if not isinstance(found, T.ArrayType):
        raise TypeError(f"column '{column}' must be an array or ML vector, found {found.simpleString()}")
    if dtype == "float32" and isinstance(found.elementType, T.FloatType):
        return F.col(column)
    return F.col(column).cast("array<float>" if dtype == "float32" else "array<double>")


def vector_length(df: DataFrame, column: str) -> int | None:
    """Length of the first non-null vector, read with a one-row job; None for a frame without vectors."""
    row = df.select(as_array(df, column).alias("v")).filter(F.col("v").isNotNull()).select(F.size("v").alias("n")).head()
    return None if row is None else row["n"]


def assemble(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """N numeric columns into one vector; a null input raises when the row is computed."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def expand(
    df: DataFrame, column: str, prefix: str = "pca_", length: int | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Vector column to scalar columns ``prefix0 .. prefix{n-1}`` after the ``keep`` columns.

    ``length`` saves the one-row job that looks the length up. A row of another length raises.
    """
    n = length if length is not None else vector_length(df, column) or 0
    keep = [c for c in df.columns if c != column] if keep is None else list(keep)
    values = as_array(df, column)
    checked = F.when(
        values.isNull() | (F.size(values) == n), values
    ).otherwise(F.raise_error(F.concat(F.lit(f"vector length differs from {n}: "), F.size(values).cast("string"))))
    staged = df.select(*keep, checked.alias("__values"))
    return staged.select(*keep, *[F.col("__values")[i].alias(f"{prefix}{i}") for i in range(n)])


def shape(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, non-null vectors, shortest and longest vector."""
    values = as_array(df, column, "float32")
    return df.select(values.alias("v")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("v").alias("n_vectors"),
        F.min(F.when(F.col("v").isNotNull(), F.size("v"))).alias("min_length"),
        F.max(F.when(F.col("v").isNotNull(), F.size("v"))).alias("max_length"),
    )


def head_values(df: DataFrame, column: str, n: int = 10) -> Column:
    """First ``n`` elements, for a look at a vector."""
    return F.slice(as_array(df, column), 1, n)


def elements(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Long form: the ``keep`` columns and one ``x`` per vector element (inside the scan stage, no shuffle)."""
    return df.select(*keep, F.explode(as_array(df, column)).alias("x"))
