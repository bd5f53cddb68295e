"""Class filters, caps, samples and splits.

All of them order or pick rows by ``md5(seed|key)``, so they give the same rows for any partitioning. ``key``
should identify a row. Where it does not, copies of a key stay on the same side of a split, so they cannot leak;
a cap still keeps exactly its number of rows, and takes any of the copies of the key it ends in.

Taking the first m rows of every class is done without gathering a class anywhere: a histogram of
(class, first hash digits) finds the bucket where the class reaches m, further passes over that bucket alone look at
the next digits until it is small, a last one finds the exact hash, and the result is a filter ``hash <= cut`` over
the rows. The rows themselves, with their vectors, are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions import rules
from featureflow.functions.hashing import key_hash, split_bucket, uniform
from featureflow.operators.classes import class_counts
from featureflow.sources.settle import BROADCAST_ROWS, ClassTable, join_classes, settle_classes

#: Hash digits of one pass, digits of a hash, and rows of a bucket that one task may put in order.
DIGITS = 3
HASH_DIGITS = 32
BUCKET_ROWS = 1_000_000


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows, cheapest first; not reproducible across layouts."""
    return df.limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Reproducible sample of n rows: those with the smallest key hashes, and any copies of the last key up to n."""
    found = _smallest(df.select(key_hash(key, seed).alias("h")), n)
    if found is None:
        return df
    cut, excess = found
    if not excess:
        return df.filter(key_hash(key, seed) <= cut)
    return cap_classes(df.withColumn("__all", F.lit(0)), "__all", key, n, seed).drop("__all")


def _smallest(hashes: DataFrame, n: int) -> tuple[str, int] | None:
    """(hash up to which there are n rows at least, how many more there are); None if all rows are wanted.

    One histogram of the first digits tells the bucket that holds the n-th; another one of it follows only where that
    bucket is more than one task should order.
    """
    prefix, before, digits = "", 0, 0
    while True:
        digits = min(digits + DIGITS, HASH_DIGITS)
        near = hashes.filter(F.col("h").startswith(prefix))
        buckets = near.groupBy(F.substring("h", 1, digits).alias("b")).count().collect()  # 16 ** DIGITS rows at most
        size = 0
        if n <= 0:
            return "", 0
        if not prefix and sum(r["count"] for r in buckets) <= n:
            return None
        for bucket in sorted(buckets, key=lambda r: r["b"]):
            if before + bucket["count"] >= n:
                prefix, size = bucket["b"], bucket["count"]
                break
            before += bucket["count"]
        if size <= BUCKET_ROWS or digits == HASH_DIGITS:
            break
    per_key = hashes.filter(F.col("h").startswith(prefix)).groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    upto = F.lit(before) + F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy("h"))
    last = per_key.withColumn("upto", upto).filter(F.col("upto") >= n).agg(F.min(F.struct("h", "upto")).alias("at")).head()["at"]
    return last["h"], last["upto"] - n


def _edges(counts: DataFrame) -> DataFrame:
    """The bucket in which each class reaches its target: ``__class, __n, __target, __prefix, __before, __size``.

    counts: ``__class, __n, __target, __before`` (rows in earlier buckets), ``__bucket`` (hash digits so far), ``__c``.
    """
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy("__class").orderBy("__bucket"))
    placed = counts.withColumn("__upto", upto)
    edge = F.col("__upto") >= F.col("__target")
    at = F.min(F.when(edge, F.struct("__bucket", "__c")))
    return placed.groupBy("__class").agg(
        F.first("__n").alias("__n"),
        F.first("__target").alias("__target"),
        at["__bucket"].alias("__prefix"),
        F.coalesce(F.max(F.when(~edge, F.col("__upto"))), F.first("__before")).alias("__before"),
        at["__c"].alias("__size"),
    )


def class_cuts(
    df: DataFrame, label: str, key: str, target: Callable[[Column], Column], seed: int = 42, max_rows: int = BROADCAST_ROWS
) -> ClassTable:
    """Table ``__class, __n, __cut, __excess``: rows with ``md5(seed|key) <= __cut`` are the first ``target(n)`` of the class.

    ``target`` makes an expression of the class size. ``__cut`` is '' where nothing is taken and null where the whole
    class is. ``__excess`` is how many rows beyond the target the cut takes, because the key it ends in has copies; 0 for
    unique keys. The names keep out of the way of the caller's columns.
    """
    keyed = df.select(F.col(label).alias("__class"), key_hash(key, seed).alias("__h"))
    histogram = keyed.groupBy("__class", F.substring("__h", 1, DIGITS).alias("__bucket")).agg(F.count(F.lit(1)).alias("__c"))
    counts = histogram.withColumn("__n", F.sum("__c").over(Window.partitionBy("__class"))).withColumn("__target", target(F.col("__n")))
    whole = settle_classes(_edges(counts.withColumn("__before", F.lit(0).cast("long"))), max_rows)
    inside = (F.col("__target") > 0) & (F.col("__target") < F.col("__n"))
    edges, digits = ClassTable(whole.frame.filter(inside), whole.small), DIGITS
    while digits < HASH_DIGITS and (edges.frame.agg(F.max("__size")).head()[0] or 0) > BUCKET_ROWS:
        near = join_classes(keyed, edges, "__class").filter(F.col("__h").startswith(F.col("__prefix")))
        digits = min(digits + DIGITS, HASH_DIGITS)
        bucket = F.substring("__h", 1, digits).alias("__bucket")
        counts = near.groupBy("__class", "__n", "__target", "__before", bucket).agg(F.count(F.lit(1)).alias("__c"))
        edges = settle_classes(_edges(counts), max_rows)
    in_edge = join_classes(keyed, edges, "__class").filter(F.col("__h").startswith(F.col("__prefix")))
    per_key = in_edge.groupBy("__class", "__h", "__target", "__before").agg(F.count(F.lit(1)).alias("__c"))
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy("__class").orderBy("__h"))
    cuts = (
        per_key.withColumn("__upto", upto)
        .filter(F.col("__upto") >= F.col("__target"))
        .groupBy("__class")
        .agg(F.min(F.struct(F.col("__h").alias("cut"), (F.col("__upto") - F.col("__target")).alias("excess"))).alias("__at"))
    )
    right = cuts.select(F.col("__class").alias("__other"), "__at.cut", "__at.excess")
    joined = whole.frame.join(right, F.col("__class").eqNullSafe(F.col("__other")), "left")
    cut = F.when(F.col("__target") <= 0, F.lit("")).otherwise(F.col("cut"))
    excess = F.coalesce("excess", F.lit(0).cast("long"))
    return settle_classes(joined.select("__class", "__n", cut.alias("__cut"), excess.alias("__excess")), max_rows)


def _sizes(df: DataFrame, label: str, max_rows: int) -> ClassTable:
    """``__class, __n``."""
    return settle_classes(df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n")), max_rows)


def _with_class(rows: DataFrame, classes: ClassTable, label: str) -> DataFrame:
    """The rows with the columns of their class, which all begin with two underscores."""
    right = F.broadcast(classes.frame) if classes.small else classes.frame
    return rows.join(right, F.col(label).eqNullSafe(F.col("__class"))).drop("__class")


def _taken(key: str, seed: int) -> Column:
    return F.col("__cut").isNull() | (key_hash(key, seed) <= F.col("__cut"))


def _drop_excess(copies: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Turns ``__keep`` off for ``__excess`` of the copies of each class's last key, by the row numbers in ``__id``.

    The copies are numbered where they lie: counts per (class, partition) find the partition in which the
    allowed number is reached, and only that partition's row numbers are ranked.
    """
    placed = copies.select(F.col(label).alias("__class"), "__id", "__excess")
    part = F.shiftright("__id", 33)
    sizes = placed.groupBy("__class", part.alias("__part")).agg(F.count(F.lit(1)).alias("__c"), F.first("__excess").alias("__x"))
    by_class = Window.partitionBy("__class")
    totals = sizes.withColumn("__upto", F.sum("__c").over(by_class.orderBy("__part"))).withColumn(
        "__allowed", F.sum("__c").over(by_class) - F.col("__x")
    )
    reached = F.col("__upto") >= F.col("__allowed")
    edges = settle_classes(
        totals.filter(reached)
        .groupBy("__class")
        .agg(F.min(F.struct("__part", (F.col("__allowed") - F.col("__upto") + F.col("__c")).alias("__need"))).alias("__e"))
        .select("__class", F.col("__e.__part").alias("__edge"), "__e.__need"),
        max_rows,
    )
    ids = join_classes(placed.select("__class", "__id"), edges, "__class").filter(part == F.col("__edge"))
    ranked = ids.withColumn("__rank", F.row_number().over(by_class.orderBy("__id")))
    last = ranked.filter(F.col("__rank") <= F.col("__need")).groupBy("__class").agg(F.max("__id").alias("__last"))
    cut = _with_class(copies, settle_classes(last, max_rows), label)
    return cut.withColumn("__keep", F.col("__id") <= F.col("__last")).drop("__last")


def min_class_filter(
    df: DataFrame, label: str = "label", min_rows: int = 5, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of the classes with at least ``min_rows`` rows. Above 1, null labels go as well; at 1 nothing does."""
    if min_rows <= 1:
        return df
    sizes = df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    large = settle_classes(sizes.filter((F.col("__n") >= min_rows) & F.col("__class").isNotNull()).select("__class"), max_rows)
    right = F.broadcast(large.frame) if large.small else large.frame
    return df.join(right, F.col(label) == F.col("__class"), "left_semi")


def excluded_classes(df: DataFrame, label: str = "label", min_rows: int = 5) -> DataFrame:
    """One row: classes below the minimum."""
    return class_counts(df, label).agg(F.count_if(F.col("n") < min_rows).alias("excluded_classes"))


def balance_flags(
    df: DataFrame,
    label: str = "label",
    key: str = "path",
    max_per_class: int | None = None,
    min_per_class: int = 5,
    seed: int = 42,
    method: str = "exact",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The frame with a boolean ``keep``: class large enough, and row within the cap of its class.

    ``method='exact'`` keeps exactly ``max_per_class`` rows of a larger class, the first in hash order.
    ``method='bernoulli'`` keeps each row with probability ``min(1, cap/n)``, so the cap is approximate. A column
    ``keep`` of the caller's is replaced; names that begin with two underscores are taken.
    """
    flagged = _flagged(df, label, key, max_per_class, min_per_class, seed, method, max_rows)
    return flagged.select(*(c for c in df.columns if c.lower() != "keep"), F.col("__keep").alias("keep"))


def _flagged(
    df: DataFrame, label: str, key: str, max_per_class: int | None = None, min_per_class: int = 5, seed: int = 42,
    method: str = "exact", max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The frame, all its columns as they are, with ``__keep``."""
    if method not in ("exact", "bernoulli"):
        raise ValueError("method must be 'exact' or 'bernoulli'")
    large = F.lit(True)
    if min_per_class > 1:
        large = (F.col("__n") >= min_per_class) & F.col(label).isNotNull()
    if max_per_class is None:
        if min_per_class <= 1:
            return df.withColumn("__keep", F.lit(True))
        classes, taken = _sizes(df, label, max_rows), F.lit(True)
    elif method == "exact":
        classes = class_cuts(df, label, key, lambda n: F.lit(max_per_class).cast("long"), seed, max_rows)
        taken = _taken(key, seed)
    else:
        classes = _sizes(df, label, max_rows)
        taken = uniform(key, seed) < rules.ratio(F.lit(max_per_class), F.col("__n"))
    copied = method == "exact" and max_per_class is not None and not classes.frame.filter("__excess > 0").isEmpty()
    if not copied:
        return _with_class(df, classes, label).withColumn("__keep", large & taken).select(*df.columns, "__keep")
    # row numbers before any join: the same for each branch of the plan
    numbered = df.withColumn("__id", F.monotonically_increasing_id())
    flagged = _with_class(numbered, classes, label).withColumn("__keep", large & taken)
    ends_in = F.coalesce(F.col("__keep") & (F.col("__excess") > 0) & (key_hash(key, seed) == F.col("__cut")), F.lit(False))
    copies = _drop_excess(flagged.filter(ends_in), label, max_rows)
    return flagged.filter(~ends_in).select(*df.columns, "__keep").unionByName(copies.select(*df.columns, "__keep"))


def balance_dataset(df: DataFrame, label: str = "label", key: str = "path", **options) -> DataFrame:
    """Minimum class size, then class cap; options as in ``balance_flags``."""
    return _flagged(df, label, key, **options).filter("__keep").drop("__keep")


def cap_classes(df: DataFrame, label: str, key: str, max_per_class: int, seed: int = 42, **options) -> DataFrame:
    """At most ``max_per_class`` rows of every class."""
    return balance_dataset(df, label, key, max_per_class=max_per_class, min_per_class=1, seed=seed, **options)


def sample_by_class(df: DataFrame, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Spark's stratified Bernoulli sample for given fractions; a class without a fraction is dropped."""
    return df.sampleBy(label, fractions, seed)


def hash_split(df: DataFrame, key: str, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``split`` = train/test by the key's hash bucket; a projection, nothing is shuffled."""
    train = split_bucket(key, seed) < F.lit(train_ratio * 10000)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def stratified_split(
    df: DataFrame, label: str = "label", key: str = "path", train_ratio: float = 0.8, seed: int = 42,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds ``split``: the first ceil(ratio * n) rows of every class are train. Null labels are a class."""
    cuts = class_cuts(df, label, key, lambda n: F.ceil(F.lit(train_ratio) * n), seed, max_rows)
    side = F.when(_taken(key, seed), "train").otherwise("test")
    return _with_class(df, cuts, label).withColumn("split", side).drop("__n", "__cut", "__excess")


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two parts of a frame with a ``split`` column."""
    return df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split")


def train_test_split(
    df: DataFrame, train_ratio: float = 0.8, stratify_by_label: bool = True, seed: int = 42,
    label: str = "label", key: str = "path",
) -> tuple[DataFrame, DataFrame]:
    """Stratified or plain hash split into (train, test)."""
    if stratify_by_label:
        return train_test(stratified_split(df, label, key, train_ratio, seed))
    return train_test(hash_split(df, key, train_ratio, seed))


def prepare_data(
    df: DataFrame, label: str = "label", features: str = "features_pca", train_ratio: float = 0.8,
    key: str = "path", seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Project key, label and features, then split by hash."""
    return train_test(hash_split(df.select(key, label, features), key, train_ratio, seed))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name."""
    for other in others:
        first = first.unionByName(other)
    return first
