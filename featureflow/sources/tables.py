"""Tables, declared rows, derived ids, replication and synthetic features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.hashing import hash_number, key_hash

PRIME = (1 << 31) - 1

# Schemas of the data model.
IMAGE_INDEX = T.StructType([T.StructField("path", T.StringType()), T.StructField("label", T.StringType())])
VARIANCE_TABLE = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("individual_variance", T.DoubleType()),
        T.StructField("cum_variance", T.DoubleType()),
    ]
)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan, narrowed to ``columns``."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def driver_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str | list[str]) -> DataFrame:
    """A handful of declared rows (expected paths, variance tables) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def id_range(spark: SparkSession, n: int, classes: int, id_col: str = "image_id") -> DataFrame:
    """Ids 0 .. n-1 with their class id."""
    return with_class_id(spark.range(n).withColumnRenamed("id", id_col), id_col, classes)


def with_class_id(df: DataFrame, id_col: str, classes: int, output: str = "class_id") -> DataFrame:
    return df.withColumn(output, F.col(id_col) % F.lit(classes))


def replicate(df: DataFrame, times: int, copy_col: str = "copy") -> DataFrame:
    """Every row ``times`` times, numbered from 1; a generator inside the scan stage, so nothing is shuffled."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.lit(times))))


def synthetic_features(key: str | Column, d: int, seed: int = 42) -> Column:
    """Array of ``d`` reproducible uniforms in [0, 1); element i depends on seed, i and the row key only.

    One digest per row gives a start s and a step t; element i is ``(s + i t)^5 mod p / p``. The fifth power
    permutes the residues modulo the prime p, so the values stay uniform, in plain long arithmetic.
    """
    digest = key_hash(key, seed)
    row = F.array(hash_number(digest, 7), hash_number(F.substring(digest, 9, 7), 7) + 1)
    prime = F.lit(PRIME).cast("long")
    positions = F.sequence(F.lit(0).cast("long"), F.lit(d - 1).cast("long"))

    def fifth_power(x: Column) -> Column:
        square = (x * x) % prime
        return ((square * square) % prime * x) % prime / F.lit(float(PRIME))

    # The nested transforms bind the digest numbers, and each residue, to a variable: one digest per row.
    def row_values(start_step: Column) -> Column:
        residues = F.transform(positions, lambda i: (start_step[0] + i * start_step[1]) % prime)
        return F.transform(residues, fifth_power)

    return F.transform(F.array(row), row_values)[0]


def random_features(d: int, seeds: Sequence[int], prefix: str = "f_") -> list[Column]:
    """``d`` columns of ``rand(seed_i)``. Values depend on the partitioning; prefer ``synthetic_features``."""
    return [F.rand(seeds[i % len(seeds)]).alias(f"{prefix}{i}") for i in range(d)]
