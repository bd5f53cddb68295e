"""Running totals over any number of rows, sorted by ranges and summed in two steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.sources.store import rewritten, scratch


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], value: str, output: str) -> DataFrame:
    """``df`` with ``output``: the total of ``value`` up to each row, in the order given, among rows with the same ``by``.

    Rows are dealt out by ranges of (by, order) and summed within their task; what the tasks before hold of the same
    ``by`` is added to that. So neither a large group nor the whole is ever in one task. Ties come in any order. The
    sums within tasks are written to the scratch folder; the table of the tasks' totals has a row for each task and
    each ``by`` that it holds. ``by`` may be null; names that begin with two underscores are taken.
    """
    placed = df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy("__part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rewritten(placed.withColumn("__inside", F.sum(value).over(inside)), scratch(df.sparkSession))
    totals = summed.groupBy("__part", *by).agg(F.max("__inside").alias("__total"))
    earlier = Window.partitionBy(*by or [F.lit(0)]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("__before", F.coalesce(F.sum("__total").over(earlier), F.lit(0))).where("__before > 0")
    before = before.select(F.col("__part").alias("__p"), *(F.col(c).alias(f"__{c}") for c in by), "__before")
    same = F.col("__part") == F.col("__p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    total = F.col("__inside") + F.coalesce("__before", F.lit(0))
    return summed.join(before, same, "left").select(*df.columns, total.alias(output))
