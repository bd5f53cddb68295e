import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from featureflow.operators import classes, sampling
from featureflow.sources import settle


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds most rows, one has a single row, some labels are null."""
    label = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 1, F.lit(None).cast("string"))
        .when(F.col("id") == 2, F.lit("single"))
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
    )
    return spark.range(3000).select(F.concat(F.lit("p"), F.col("id")).alias("path"), label.alias("label")).cache()


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def by_class(rows):
    groups = defaultdict(list)
    for path, label in rows:
        groups[label].append(path)
    return {k: sorted(v, key=digest) for k, v in groups.items()}


@pytest.mark.parametrize("cap", [1, 40, 61, 1000, 5000])
@pytest.mark.parametrize("max_rows", [0, 1000])
def test_exact_cap_is_first_in_hash_order(skewed, cap, max_rows):
    expected = sorted((p, k) for k, v in by_class(rows_of(skewed)).items() if k is not None for p in v[:cap])
    got = sampling.cap_classes(skewed, "label", "path", cap, max_rows=max_rows)
    assert rows_of(got.filter("label is not null")) == expected
    assert got.filter("label is null").count() == min(cap, skewed.filter("label is null").count())


@pytest.mark.parametrize("ratio", [0.0, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("max_rows", [0, 1000])
def test_stratified_split(skewed, ratio, max_rows):
    split = sampling.stratified_split(skewed, "label", "path", ratio, max_rows=max_rows)
    train, test = sampling.train_test(split)
    got = defaultdict(set)
    for r in train.collect():
        got[r["label"]].add(r["path"])
    for label, ordered in by_class((r["path"], r["label"]) for r in skewed.collect()).items():
        assert got[label] == set(ordered[: math.ceil(ratio * len(ordered))])
    assert rows_of(sampling.union_all(train, test).fillna("?")) == rows_of(skewed.fillna("?"))
    assert train.join(test, "path").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_partition_independence(skewed, parts):
    df = skewed.repartition(parts)
    assert rows_of(sampling.stratified_split(df).fillna("?")) == rows_of(sampling.stratified_split(skewed).fillna("?"))
    assert rows_of(sampling.hash_split(df, "path").fillna("?")) == rows_of(sampling.hash_split(skewed, "path").fillna("?"))
    assert rows_of(sampling.hash_sample(df, "path", 50).fillna("?")) == rows_of(
        sampling.hash_sample(skewed, "path", 50).fillna("?")
    )


def test_copies_of_a_key_stay_together(spark):
    """A third of all rows are copies of one key; every copy lands on the same side and nothing is lost."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("path"), F.lit("a").alias("label")
    )
    split = sampling.stratified_split(df)
    assert split.count() == 3000
    assert split.groupBy("path").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("max_rows", [0, 1000])
@pytest.mark.parametrize("cap", [1, 500, 1000, 1500, 3999])
def test_cap_is_exact_with_copies_of_a_key(spark, cap, max_rows):
    """A third of the rows share one key: the cap is still met exactly, and no other row changes sides."""
    df = spark.range(0, 4000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("path"),
        F.when(F.col("id") < 3000, "a").otherwise("b").alias("label"),
        "id",
    )
    flags = sampling.balance_flags(df, max_per_class=cap, min_per_class=1, max_rows=max_rows)
    rows = flags.collect()
    assert len(rows) == 4000 and len({r["id"] for r in rows}) == 4000
    kept = Counter(r["label"] for r in rows if r["keep"])
    assert kept == {"a": min(cap, 3000), "b": min(cap, 1000)}
    for label in "ab":
        mine = [r for r in rows if r["label"] == label]
        hashes = [digest(r["path"]) for r in mine if r["keep"]]
        assert all(digest(r["path"]) >= max(hashes) for r in mine if not r["keep"])


def test_key_hash_of_hot_class_stays_out_of_one_task(spark):
    """The per-class ranking only sees the rows of one hash bucket."""
    df = spark.range(200_000).select(F.col("id").alias("path"), F.lit("hot").alias("label"))
    assert sampling.cap_classes(df, "label", "path", 77_777).count() == 77_777


def test_min_class_filter(skewed):
    for max_rows in (0, 1000):
        kept = sampling.min_class_filter(skewed, "label", 5, max_rows)
        assert {r["label"] for r in kept.select("label").distinct().collect()} == {"hot", *[f"c{i}" for i in range(7)]}
        assert kept.count() == skewed.filter("label is not null and label <> 'single'").count()
    assert sampling.min_class_filter(skewed, "label", 1).count() == 3000
    assert sampling.excluded_classes(skewed, "label", 5).head()[0] == 1


def test_balance_dataset_report(skewed):
    flags = sampling.balance_flags(skewed, max_per_class=100, min_per_class=5)
    counts = Counter(r["label"] for r in flags.filter("keep").collect())
    assert None not in counts and "single" not in counts and counts["hot"] == 100
    report = classes.reduction_report(flags).head()
    assert (report["initial"], report["final"]) == (3000, sum(counts.values()))
    assert report["rejected"] == 3000 - report["final"]
    assert report["percent_reduction"] == pytest.approx(100 * report["rejected"] / 3000)
    assert classes.reduction_report(flags.limit(0)).head()["percent_reduction"] is None


def test_bernoulli_cap_is_approximate(skewed):
    kept = sampling.cap_classes(skewed, "label", "path", 300, method="bernoulli")
    n = kept.filter("label = 'hot'").count()
    assert 230 < n < 370
    assert kept.filter("label = 'c1'").count() <= 300
    fractions = {"hot": 0.5}
    assert {r["label"] for r in sampling.sample_by_class(skewed, "label", fractions).select("label").distinct().collect()} == {"hot"}
    with pytest.raises(ValueError):
        sampling.balance_flags(skewed, method="other")


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "path string, label string")
    assert sampling.stratified_split(empty).count() == 0
    assert sampling.balance_dataset(empty, max_per_class=3).count() == 0
    one = spark.createDataFrame([("a", "x")], "path string, label string")
    assert rows_of(sampling.stratified_split(one)) == [("a", "x", "train")]


def test_prepare_data(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("path"), F.lit("a").alias("label"),
                                  F.array(F.lit(1.0)).alias("features_pca"), F.lit(1).alias("extra"))
    train, test = sampling.prepare_data(df)
    assert train.columns == ["path", "label", "features_pca"]
    assert train.count() + test.count() == 1000 and 750 < train.count() < 850
    plain = sampling.train_test_split(df, stratify_by_label=False)
    assert rows_of(plain[0].select("path")) == rows_of(train.select("path"))


def test_rows_are_not_shuffled(skewed):
    """With few classes the result is a filter over the scan: no exchange of the rows themselves."""
    plan = sampling.stratified_split(skewed)._jdf.queryExecution().optimizedPlan().toString()
    physical = sampling.stratified_split(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "BroadcastHashJoin" in physical
    assert "Exchange hashpartitioning" not in physical and "Window" not in physical


def test_shuffled_join_equals_broadcast(skewed):
    table = settle.settle_classes(classes.class_counts(skewed))
    assert table.small and not settle.settle_classes(classes.class_counts(skewed), max_rows=1).small
    a = settle.join_classes(skewed, table, "label")
    b = settle.join_classes(skewed, settle.ClassTable(classes.class_counts(skewed), False), "label")
    assert rows_of(a.fillna("?")) == rows_of(b.select(*a.columns).fillna("?"))
    assert a.count() == 3000


@pytest.mark.parametrize("rows", [1, 30, 5000])
def test_buckets_are_refined_until_small(skewed, monkeypatch, rows):
    """However small a bucket has to be, also below one row per bucket, the cap takes the same rows."""
    expected = rows_of(sampling.cap_classes(skewed, "label", "path", 123).fillna("?"))
    monkeypatch.setattr(sampling, "BUCKET_ROWS", rows)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    assert rows_of(sampling.cap_classes(skewed, "label", "path", 123).fillna("?")) == expected


def test_copies_end_the_refinement(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 10)
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("path"), F.lit("a").alias("label"))
    assert sampling.cap_classes(df, "label", "path", 400).count() == 400


def test_hash_sample_takes_the_smallest_hashes(skewed):
    paths = sorted((r["path"] for r in skewed.collect()), key=digest)
    for n in (0, 1, 777, 5000):
        assert sorted(r["path"] for r in sampling.hash_sample(skewed, "path", n).collect()) == sorted(paths[:n])


def test_no_folder_is_written(skewed, spark):
    before = spark.sparkContext.getCheckpointDir()
    assert sampling.balance_dataset(skewed, max_per_class=10).count() > 0
    assert spark.sparkContext.getCheckpointDir() == before


@pytest.mark.parametrize("label", ["label", "n", "cut", "excess", "keep"])
def test_callers_columns_may_have_any_name(spark, label):
    """Columns named like those of the class tables stay what they are; any of them may be the label."""
    others = [c for c in ("label", "n", "N_", "cut", "excess", "target", "split_", "keep") if c != label]
    rows = [(str(i), "abc"[(i > 5) + (i > 20)], *[f"{c}{i}" for c in others]) for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("path", label, *others))).repartition(3)
    for done, sizes in (
        (sampling.balance_dataset(df, label, "path", max_per_class=10, min_per_class=7), {"b": 10, "c": 10}),
        (sampling.balance_dataset(df, label, "path", max_per_class=1000, method="bernoulli"), {"a": 6, "b": 15, "c": 39}),
        (sampling.cap_classes(df, label, "path", 4), {"a": 4, "b": 4, "c": 4}),
        (sampling.min_class_filter(df, label, 15), {"b": 15, "c": 39}),
    ):
        assert done.columns == df.columns
        got = done.collect()
        assert {r[label]: 0 for r in got}.keys() == sizes.keys() and all(sum(r[label] == c for r in got) == k for c, k in sizes.items())
        assert all(r[c] == f"{c}{r['path']}" for r in got for c in others)
    split = sampling.stratified_split(df, label, "path", 0.5)
    assert split.columns == [*df.columns, "split"] and split.where("split = 'train'").count() == 3 + 8 + 20
    flags = sampling.balance_flags(df, label, "path", max_per_class=10)
    assert flags.columns == [c for c in df.columns if c != "keep"] + ["keep"] and flags.where("keep").count() == 26
    assert sampling.hash_sample(df, "path", 11).count() == 11


def test_hash_sample_refines_its_bucket(skewed, monkeypatch):
    want = sorted(r["path"] for r in sampling.hash_sample(skewed, "path", 321).collect())
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 3)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    assert sorted(r["path"] for r in sampling.hash_sample(skewed, "path", 321).collect()) == want


def test_hash_sample_of_copies(spark):
    df = spark.range(1000).selectExpr("cast(id % 10 as string) as path", "id")
    for n in (1, 150, 999, 1000):
        assert sampling.hash_sample(df, "path", n).count() == n
    assert sampling.hash_sample(df.limit(0), "path", 5).count() == 0
