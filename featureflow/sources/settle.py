"""Class tables: bring them to the rows without a shuffle where they are small, and layouts for iterative fits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes, and bytes of their values as text, that a class table may have to be sent to every task.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class ClassTable:
    """A table with one row per class, and whether it was found small enough to broadcast."""

    frame: DataFrame
    small: bool


def settle_classes(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> ClassTable:
    """Computes a class table once: a small one, at most ``max_rows`` rows, comes to the driver and becomes a local table.

    A larger one is written to the scratch folder, and joined by shuffles that adaptive execution balances.
    """
    rows, held = [], 0
    for row in df.limit(max_rows + 1).toLocalIterator():
        rows.append(row)
        held += sum(len(str(v).encode()) for v in row)
        if len(rows) > max_rows or held > BROADCAST_BYTES:
            from featureflow.sources import store  # which needs this module

            return ClassTable(store.rewritten(df, store.scratch(df.sparkSession)), False)
    return ClassTable(df.sparkSession.createDataFrame(rows, df.schema), True)


def join_classes(rows: DataFrame, classes: ClassTable, label: str, how: str = "inner") -> DataFrame:
    """Join rows with a class table on the (null-safe) label.

    A small table is broadcast, so the rows are not shuffled. For a larger one adaptive execution picks the join from
    the sizes it meets and splits the partitions of classes that hold much of the rows.
    """
    right = classes.frame.withColumnRenamed(label, "__right")
    right = F.broadcast(right) if classes.small else right
    return rows.join(right, F.col(label).eqNullSafe(F.col("__right")), how).drop("__right")


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Narrow rows hashed over all slots, ahead of a step that makes each of them large or costly."""
    session = df.sparkSession
    slots = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(partitions or slots, key)


def lay_out(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows placed by the hash of their key and sorted by it: one shuffle before an iterative fit.

    The fit then uses all slots even if the input came in few splits, and its result does not depend on how
    the input was split. Give ``partitions`` to get the same model on clusters of different size.
    """
    return spread(df, key, partitions).sortWithinPartitions(key)
