"""Class distributions and the reports built on them.

Rows are reduced to one row per class by a partial aggregate before the shuffle, so a class that holds a
third of the data sends one row per task. Totals are scalar subqueries over the class table, not windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions import rules


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_distribution(df: DataFrame, label: str = "label", by: str = "count") -> DataFrame:
    """Class table ordered by size (largest first, ties by label) or by label."""
    order = [F.col("n").desc(), F.col(label)] if by == "count" else [F.col(label)]
    return class_counts(df, label).orderBy(*order)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """The class list."""
    return df.select(label).distinct()


def n_classes(df: DataFrame, label: str = "label", approximate: bool = False) -> DataFrame:
    """Number of classes. A null label is not a class."""
    counter = F.approx_count_distinct(label) if approximate else F.count_distinct(label)
    return df.agg(counter.alias("n_classes"))


def class_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percent of all rows per class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (rules.ratio(F.col("n"), total) * 100).alias("percent"))


def class_relative(df: DataFrame, label: str = "label") -> DataFrame:
    """Class size relative to the largest class, and its 25-step bar length."""
    counts = class_counts(df, label)
    largest = counts.agg(F.max("n")).scalar()
    return counts.select(
        label,
        "n",
        rules.ratio(F.col("n"), largest).alias("relative"),
        rules.bar_steps(F.col("n"), largest).alias("steps"),
    )


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: smallest, largest, total, min/max ratio and spread in percent of the total."""
    per_class = class_counts(df, label).agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        F.sum("n").alias("total"),
    )
    return per_class.select(
        "n_classes",
        "min_n",
        "max_n",
        "total",
        rules.ratio(F.col("min_n"), F.col("max_n")).alias("balance_ratio"),
        rules.ratio((F.col("max_n") - F.col("min_n")) * 100, F.col("total")).alias("spread_percent"),
    )


def class_sample(df: DataFrame, label: str = "label", value: str = "path", shown: int | None = None) -> DataFrame:
    """One value per class (the smallest); ``shown`` limits a preview to the first classes by label."""
    sample = df.groupBy(label).agg(F.min(value).alias(f"sample_{value}"))
    return sample if shown is None else sample.orderBy(label).limit(shown)


def reduction_report(df: DataFrame, keep: str = "keep") -> DataFrame:
    """Rows before and after a filter, from one pass over its boolean column (null counts as rejected)."""
    counts = df.agg(F.count(F.lit(1)).alias("initial"), F.count_if(F.col(keep)).alias("final"))
    return counts.select(
        "initial",
        "final",
        (F.col("initial") - F.col("final")).alias("rejected"),
        rules.percent_reduction(F.col("initial"), F.col("final")).alias("percent_reduction"),
    )


def split_report(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share per split."""
    return class_share(df, split)


def reason_report(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
