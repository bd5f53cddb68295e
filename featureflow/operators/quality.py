"""Null profiles, frame summaries and frame checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import rules

def null_profile(df: DataFrame) -> DataFrame:
    """``column, dtype, n_rows, n_null, percent_null``: all columns in one pass, then turned to long form."""
    if not df.columns:
        return df.sparkSession.createDataFrame(
            [], "column string, dtype string, n_rows long, n_null long, percent_null double"
        )
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.lit(dtype).alias("dtype"), F.col(f"null_{i}").alias("n_null")
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    long = wide.select("n_rows", F.inline(F.array(*entries)))
    return long.select(
        "column",
        "dtype",
        "n_rows",
        "n_null",
        (rules.ratio(F.col("n_null"), F.col("n_rows")) * 100).alias("percent_null"),
    )


def summary(df: DataFrame, sample_size: int = 5) -> tuple[DataFrame, DataFrame]:
    """(profile, sample): the profile carries row count, types and nulls; its rows are the columns."""
    return null_profile(df), df.limit(sample_size)


def frame_check(df: DataFrame | None, expected_columns: Sequence[str] = (), min_rows: int = 1, spark=None) -> DataFrame:
    """One row per rule: ``rule, detail, passed``. Rows are counted; on Parquet that reads footers only.

    A missing frame fails every rule; that needs ``spark`` or an active session.
    """
    if df is None:
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            raise ValueError("a missing frame needs a session: pass spark")
        rules_failed = ["frame", "min_rows", *[f"column:{c}" for c in expected_columns]]
        return spark.createDataFrame([(r, "no frame", False) for r in rules_failed], "rule string, detail string, passed boolean")
    columns = [
        F.struct(
            F.lit(f"column:{c}").alias("rule"),
            F.lit("present" if c in df.columns else "missing").alias("detail"),
            F.lit(c in df.columns).alias("passed"),
        )
        for c in expected_columns
    ]
    frame = F.struct(F.lit("frame").alias("rule"), F.lit("given").alias("detail"), F.lit(True).alias("passed"))
    seen = df.agg(F.count(F.lit(1)).alias("n"))
    rows = F.struct(
        F.lit("min_rows").alias("rule"),
        F.concat(F.lit("at least "), F.lit(str(min_rows))).alias("detail"),
        (F.col("n") >= min_rows).alias("passed"),
    )
    return seen.select(F.inline(F.array(frame, rows, *columns)))


def is_valid(df: DataFrame | None, expected_columns: Sequence[str] = (), min_rows: int = 1) -> bool:
    """All rules of ``frame_check`` pass."""
    if df is None or not set(expected_columns) <= set(df.columns):
        return False
    return frame_check(df, expected_columns, min_rows).agg(F.bool_and("passed").alias("ok")).head()["ok"]
