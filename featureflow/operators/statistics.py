"""Statistics over feature vectors: every element of every row, never a sample of the first rows.

Counts, sums and histograms are made where the rows are; what is shuffled is a short list or a sketch for each task, and
for exact quantiles the counts of the few values around them. NaN and infinite elements take no part; ``feature_stats`` returns their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import rules
from featureflow.functions.vectors import as_array
from featureflow.operators import gram
from featureflow.operators.classes import class_counts
from featureflow.operators.numbering import running_total
from featureflow.sources.settle import ClassTable, join_classes, settle_classes

QUARTILES = (0.25, 0.5, 0.75)
#: Size parameter of the sketches, and the share of a group's values on either side of a rank that its bracket takes in:
#: nearly three times the sketches' error.
SKETCH_SIZE = 1000
SKETCH_MARGIN = 0.012
#: Values of a bracket that one task may order.
BRACKET_VALUES = 500_000


def finite(values: Column) -> Column:
    """The array without null, NaN and infinite elements."""
    return F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _elements(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(finite elements, row of each) of a list column without null lists."""
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    keep = np.isfinite(x)
    return x[keep], row[keep]


def feature_stats(df: DataFrame, column: str = "features") -> DataFrame:
    """min, max, mean and population standard deviation over all finite vector elements, and the number of others.

    Null elements are not counted at all. Each task sends its count, mean and squares around it, which add up exactly.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = others = 0
        mean = squares = 0.0
        low, high = np.inf, -np.inf
        for batch in batches:
            lists = batch.column("v")
            x, _ = _elements(lists)
            flat = lists.flatten()
            others += len(flat) - flat.null_count - len(x)
            if len(x):
                own, shift = x.mean(), x.mean() - mean
                squares += ((x - own) ** 2).sum() + shift**2 * n * len(x) / (n + len(x))
                mean += shift * len(x) / (n + len(x))
                n += len(x)
                low, high = min(low, x.min()), max(high, x.max())
        yield pa.record_batch([pa.array([v]) for v in (n, others, float(low), float(high), float(mean), float(squares))], ["n", "others", "low", "high", "mean", "squares"])

    rows = df.select(as_array(df, column).alias("v")).filter(F.col("v").isNotNull())
    parts = rows.mapInArrow(partial, "n long, others long, low double, high double, mean double, squares double")
    used = F.col("n") > 0
    one = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_values"),
        F.coalesce(F.sum("others"), F.lit(0)).alias("n_nonfinite"),
        F.min(F.when(used, F.col("low"))).alias("min_value"),
        F.max(F.when(used, F.col("high"))).alias("max_value"),
        rules.ratio(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean_value"),
        F.collect_list(F.when(used, F.struct("n", "mean", "squares"))).alias("tasks"),
    )
    between = lambda a, t: a + t["squares"] + t["n"] * (t["mean"] - F.col("mean_value")) * (t["mean"] - F.col("mean_value"))
    squares = F.aggregate("tasks", F.lit(0.0), between)
    return one.select("n_values", "n_nonfinite", "min_value", "max_value", "mean_value", F.sqrt(rules.ratio(squares, F.col("n_values"))).alias("std_value"))


def feature_histogram(df: DataFrame, column: str = "features", bins: int = 50) -> DataFrame:
    """Counts of finite elements in ``bins`` equal bins between minimum and maximum, the last bin closed; empty bins included.

    As in numpy, a constant column gets a range of one centred on the value.
    """
    rows = df.select(finite(as_array(df, column)).alias("v")).filter(F.size("v") > 0)
    low_high = rows.agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.struct((F.col("lo") - 0.5).alias("lo"), (F.col("hi") + 0.5).alias("hi")))
        .otherwise(F.struct("lo", "hi"))
        .alias("r")
    )
    bounds = low_high.select("r").scalar()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bins, np.int64)
        for batch in batches:
            if batch.num_rows:
                low, high = batch.column("lo")[0].as_py(), batch.column("hi")[0].as_py()
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                at = np.floor((x - low) / (high - low) * bins).astype(np.int64)
                total += np.bincount(np.minimum(at, bins - 1), minlength=bins)
        yield pa.record_batch([pa.array(np.arange(bins, dtype=np.int32)), pa.array(total)], ["bin", "c"])

    placed = rows.select("v", bounds["lo"].alias("lo"), bounds["hi"].alias("hi")).mapInArrow(counted, "bin int, c long")
    counts = placed.groupBy("bin").agg(F.sum("c").alias("n"))
    frame = low_high.filter(F.col("r.lo").isNotNull()).select(
        F.col("r.lo").alias("lo"),
        ((F.col("r.hi") - F.col("r.lo")) / bins).alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact interpolated quantiles per group: ``group, n, quantiles array``; ``value`` is a number or an array of them.

    Two passes over the rows. The first sums up each group in a KLL sketch, which brackets the wanted ranks. The second
    counts what lies below each bracket, and each value inside it; a running total over those finds the ranks. No group
    is gathered or sorted in one task, and no bracket that is large. A sketch may err: a rank that its bracket missed is noticed by the counts, and the
    second pass is repeated with wider brackets. The passes run when the frame is built. Null groups are a group;
    nulls, NaN and infinite values are left out.
    """
    probabilities = sorted(probabilities)
    values = F.col(value) if isinstance(df.schema[value].dataType, T.ArrayType) else F.array(value)
    each = df.select(F.col(group).alias("g"), F.explode(values.cast("array<double>")).alias("x"))
    each = each.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")))
    sketches = each.groupBy("g").agg(F.count("x").alias("n"), F.kll_sketch_agg_double("x", SKETCH_SIZE).alias("sketch"))
    sketches = settle_classes(sketches).frame
    largest = sketches.agg(F.max("n")).head()[0] or 0
    margin = SKETCH_MARGIN
    while True:
        found = _ranked(each, sketches, probabilities, margin, 2 * margin * largest <= BRACKET_VALUES)
        if found.frame.where(F.exists("ranked", lambda x: x["low"].isNull() | x["high"].isNull())).isEmpty():
            break
        margin *= 8
    at = [F.lit(q) * (F.col("n") - 1) for q in probabilities]
    own = [F.col("ranked")[i] for i in range(len(probabilities))]
    quantiles = [x["low"] + (x["high"] - x["low"]) * (a - F.floor(a)) for x, a in zip(own, at, strict=True)]
    return found.frame.select(F.col("g").alias(group), "n", F.array(*quantiles).alias("quantiles"))


def _ranked(each: DataFrame, sketches: DataFrame, probabilities: Sequence[float], margin: float, few: bool) -> ClassTable:
    """``g, n, ranked``: for each probability slot, low, high, the values at the two ranks it lies between.

    A value is null where the bracket, ``margin`` on either side of the probability, does not hold it. ``few``: the
    brackets are so small that a task may order the values of one; else ranges of values are dealt out to the tasks.
    """
    def bound(q: float) -> Column:
        if 0 <= q <= 1:
            return F.kll_sketch_get_quantile_double("sketch", F.lit(q))
        return F.lit(float("-inf") if q < 0 else float("inf"))

    names = [(f"lo{i}", f"hi{i}") for i in range(len(probabilities))]
    brackets = [b.alias(name) for q, own in zip(probabilities, names, strict=True) for b, name in zip((bound(q - margin), bound(q + margin)), own, strict=True)]
    near = join_classes(each, settle_classes(sketches.select("g", "n", *brackets)), "g")
    below = F.lit(float("-inf"))  # all values under a bracket, which no finite value is
    slots = [
        F.when(F.col("x") <= F.col(hi), F.struct(F.lit(i).alias("slot"), F.when(F.col("x") < F.col(lo), below).otherwise(F.col("x")).alias("x")))
        for i, (lo, hi) in enumerate(names)
    ]
    counts = near.select("g", "n", F.explode(F.array(*slots)).alias("s")).where("s is not null").groupBy("g", "n", "s.slot", "s.x").agg(F.count("*").alias("c"))
    if few:
        upto = counts.withColumn("upto", F.sum("c").over(Window.partitionBy("g", "slot").orderBy("x")))
    else:
        upto = running_total(counts, ["g", "slot"], ["x"], "c", "upto")
    at = F.element_at(F.array(*map(F.lit, probabilities)), F.col("slot") + 1) * (F.col("n") - 1)

    def value_at(rank: Column) -> Column:
        here = (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto")) & (F.col("x") > below)
        return F.max(F.when(here, F.col("x")))

    ranked = upto.groupBy("g", "n", "slot").agg(value_at(F.floor(at)).alias("low"), value_at(F.ceil(at)).alias("high"))
    lists = ranked.groupBy("g", "n").agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("ranked"))
    empty = F.transform(F.sequence(F.lit(0), F.lit(len(probabilities) - 1)), lambda i: F.struct(i.alias("slot"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))
    whole = F.when(F.size("ranked") == len(probabilities), F.col("ranked")).otherwise(empty)  # a slot without any value missed its rank
    return settle_classes(lists.withColumn("ranked", whole))


def class_box_stats(df: DataFrame, column: str = "features", label: str = "label", classes: int | None = None) -> DataFrame:
    """Box-plot numbers of all feature values of each label: quartiles and 1.5 IQR whiskers.

    ``classes`` limits a chart to the first labels in order.
    """
    if classes is not None:
        chosen = class_counts(df, label).orderBy(label).limit(classes).select(F.col(label).alias("__g"))
        df = df.join(chosen, F.col(label).eqNullSafe(F.col("__g")), "left_semi")
    rows = df.select(label, as_array(df, column).alias("v")).filter(F.col("v").isNotNull())
    quartiles = exact_quantiles(rows, label, "v").select(
        label,
        "n",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    fenced = join_classes(rows, settle_classes(quartiles), label)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    # null, NaN and infinite elements are not between finite fences
    inside = F.filter("v", lambda x: (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach))
    return fenced.withColumn("v", inside).groupBy(label, "n", "q1", "median", "q3").agg(
        F.min(F.array_min("v")).alias("whisker_low"), F.max(F.array_max("v")).alias("whisker_high")
    )


def component_variance(df: DataFrame, column: str = "features", first: int | None = None) -> DataFrame:
    """Population variance per vector position: one summary buffer of d numbers per task, no exploded rows.

    ``first`` limits a chart to the first positions.
    """
    values = as_array(df, column)
    vectors = df.select(values.alias("v")).filter(F.col("v").isNotNull()).select(array_to_vector("v").alias("v"))
    one = vectors.agg(Summarizer.metrics("variance", "count").summary(F.col("v")).alias("s")).select(
        vector_to_array("s.variance").alias("variance"), F.col("s.count").alias("n")
    )
    rows = one.select("n", F.posexplode("variance").alias("position", "sample_variance")).select(
        "position",
        (F.col("sample_variance") * rules.ratio(F.col("n") - 1, F.col("n"))).alias("variance"),
    )
    return rows if first is None else rows.filter(F.col("position") < first)


def component_correlation(df: DataFrame, column: str = "features", components: int | None = None) -> DataFrame:
    """Pearson correlation of all components, or the first ones, long form ``i, j, corr``, zero-based.

    Null where a component is constant. Built on the distributed second moments of those components.
    """
    values = as_array(df, column)
    narrow = df.select((values if components is None else F.slice(values, 1, components)).alias("v"))
    cells = gram.covariance_long(narrow, "v")
    scale = cells.filter(F.col("i") == F.col("j")).select(F.col("i").alias("k"), F.sqrt("covariance").alias("s"))
    left = scale.select(F.col("k").alias("i"), F.col("s").alias("s_i"))
    right = scale.select(F.col("k").alias("j"), F.col("s").alias("s_j"))
    paired = cells.join(left, "i").join(right, "j")
    corr = rules.ratio(F.col("covariance"), F.col("s_i") * F.col("s_j"))
    return paired.select("i", "j", F.when(F.col("i") == F.col("j"), corr * 0 + 1).otherwise(corr).alias("corr"))
