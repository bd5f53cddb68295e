import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.operators import classes, gram, quality, statistics
from featureflow.operators.numbering import running_total
from featureflow.sources import tables


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(1000.0, [1, 2, 3, 4, 0.1, 5, 6, 7, 8, 9, 2, 1], (400, 12))
    labels = [["b", "a", "c", "f", "e", "d", "g"][i % 7] for i in range(400)]
    frame = spark.createDataFrame([(i, labels[i], [float(v) for v in x[i]]) for i in range(400)], "i int, label string, features array<double>")
    return frame.cache(), x, np.array(labels)


def test_feature_stats(features):
    df, x, _ = features
    row = statistics.feature_stats(df).head()
    assert row["n_values"] == x.size
    assert (row["min_value"], row["max_value"]) == (x.min(), x.max())
    assert row["mean_value"] == pytest.approx(x.mean()) and row["std_value"] == pytest.approx(x.std())


def test_histogram_equals_numpy(features, spark):
    df, x, _ = features
    got = statistics.feature_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins=50)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())
    flat = spark.createDataFrame([([2.0, 2.0],)], "features array<double>")
    assert [r["n"] for r in statistics.feature_histogram(flat, bins=4).orderBy("bin").collect()] == [0, 0, 2, 0]
    assert statistics.feature_histogram(df.limit(0)).count() == 0


def test_box_stats(features):
    df, x, labels = features
    assert sorted(r["label"] for r in statistics.class_box_stats(df, classes=5).collect()) == ["a", "b", "c", "d", "e"]
    got = {r["label"]: r for r in statistics.class_box_stats(df).collect()}
    assert sorted(got) == ["a", "b", "c", "d", "e", "f", "g"]
    for label, row in got.items():
        v = x[labels == label].ravel()
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert row["n"] == len(v)
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx([q1, med, q3])
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())


@pytest.mark.parametrize("kind", ["normal", "zeros", "heavy", "tiny", "signed"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    n = 3 if kind == "tiny" else 60_000
    x = rng.normal(size=n)
    if kind == "zeros":
        x[rng.random(n) < 0.6] = 0.0
        x[rng.random(n) < 0.1] = -0.0
    if kind == "heavy":
        x = np.exp(20 * x)
    if kind == "signed":
        x = np.sign(x) * 10.0 ** rng.integers(-300, 300, n)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(x)], "g int, x double")
    probabilities = (0.0, 0.25, 0.5, 0.999, 1.0)
    for row in statistics.exact_quantiles(df, "g", "x", probabilities).collect():
        expected = np.quantile(x[row["g"] :: 2], probabilities)
        assert row["n"] == len(x[row["g"] :: 2])
        np.testing.assert_allclose(row["quantiles"], expected, rtol=1e-9)


@pytest.mark.parametrize("margin", [0.0, 1e-6, 5.0])
def test_ranks_that_brackets_miss_are_found(spark, monkeypatch, margin):
    """A coarse sketch and brackets far too narrow, or wider than everything: the result stays exact."""
    monkeypatch.setattr(statistics, "SKETCH_SIZE", 8)
    monkeypatch.setattr(statistics, "BRACKET_VALUES", 100 if margin else 10**9)
    monkeypatch.setattr(statistics, "SKETCH_MARGIN", max(margin, 1e-4))
    x = np.random.default_rng(9).normal(size=4000).round(3)
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)], "g int, x double").repartition(5)
    for row in statistics.exact_quantiles(df, "g", "x", (0.0, 0.01, 0.5, 1.0)).collect():
        np.testing.assert_allclose(row["quantiles"], np.quantile(x[row["g"] :: 2], (0.0, 0.01, 0.5, 1.0)), rtol=1e-12)


def test_running_totals_over_tasks(spark):
    rows = [(None if i % 5 == 0 else "ab"[i % 2], i * 7 % 1000, i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, o int, c int").repartition(6)
    got = {(r["g"], r["o"]): r["upto"] for r in running_total(df, ["g"], ["o"], "c", "upto").collect()}
    for g in (None, "a", "b"):
        total = 0
        for _, o, c in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            total += c
            assert got[g, o] == total
    assert [r["n"] for r in running_total(df.withColumn("one", F.lit(1)), [], [F.col("o").desc()], "one", "n").orderBy(F.desc("o")).collect()] == list(range(1, 1001))
    assert running_total(df.limit(0), ["g"], ["o"], "c", "upto").count() == 0


def test_many_groups_and_null_groups(spark):
    """More groups than any limit of a broadcast table in this session, and a null one."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, (F.col("id") / 3).cast("int")).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: (r["n"], r["quantiles"]) for r in statistics.exact_quantiles(df, "g", "x", (0.5,)).collect()}
    assert len(got) == 2001 and got[7] == (2, [22.5]) and got[None] == (2000, [2998.5])


def test_values_that_are_no_numbers_take_no_part(spark):
    rows = [("a", [1.0, 2.0, float("nan"), None]), ("a", [3.0, float("inf"), -float("inf")]), ("b", [float("nan")]), ("b", None), ("c", [])]
    df = spark.createDataFrame(rows, "label string, features array<double>")
    row = statistics.feature_stats(df).head()
    assert (row["n_values"], row["n_nonfinite"], row["min_value"], row["max_value"], row["mean_value"]) == (3, 4, 1.0, 3.0, 2.0)
    assert row["std_value"] == pytest.approx(np.std([1, 2, 3]))
    assert [r["n"] for r in statistics.feature_histogram(df, bins=4).orderBy("bin").collect()] == [1, 0, 1, 1]
    assert [(r["label"], r["n"], r["median"], r["whisker_low"], r["whisker_high"]) for r in statistics.class_box_stats(df).collect()] == [("a", 3, 2.0, 1.0, 3.0)]
    empty = statistics.feature_stats(df.limit(0)).head()
    assert (empty["n_values"], empty["mean_value"], empty["std_value"]) == (0, None, None)


def test_no_exploded_vectors(features):
    df, _, _ = features
    for frame in (statistics.feature_stats(df), statistics.class_box_stats(df)):
        assert "Generate explode(v" not in frame._jdf.queryExecution().executedPlan().toString()


def test_components(features):
    df, x, _ = features
    variance = statistics.component_variance(df).orderBy("position").collect()
    assert [r["variance"] for r in variance] == pytest.approx(x.var(axis=0).tolist())
    corr = np.zeros((12, 12))
    for r in statistics.component_correlation(df).collect():
        corr[r["i"], r["j"]] = r["corr"]
    np.testing.assert_allclose(corr, np.corrcoef(x.T), atol=1e-9)
    assert statistics.component_correlation(df, components=3).count() == 9 and statistics.component_variance(df, first=4).count() == 4


def test_covariance(features, spark):
    df, x, _ = features
    cov = np.zeros((12, 12))
    for r in gram.covariance_long(df).collect():
        cov[r["i"], r["j"]] = r["covariance"]
    np.testing.assert_allclose(cov, np.cov(x.T), atol=1e-8)
    n, mean, local = gram.covariance(df)
    assert n == 400
    np.testing.assert_allclose(mean, x.mean(axis=0))
    np.testing.assert_allclose(local, np.cov(x.T), atol=1e-8)
    assert gram.total_variance(df).head()[0] == pytest.approx(np.trace(np.cov(x.T)))
    with_null = df.unionByName(spark.createDataFrame([(-1, "z", None)], df.schema))
    assert gram.covariance(with_null)[0] == 400


def test_moments_do_not_compute_the_vectors_twice(spark):
    """No null filter that the optimiser could push below the expression that makes the vectors."""
    made = spark.range(20).select(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: (i * F.col("id")).cast("double")).alias("features"))
    plan = gram.moments(made, "features", np.zeros(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("transform(") == 1


def test_covariance_guards(spark):
    one = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    with pytest.raises(ValueError):
        gram.covariance(one)
    with pytest.raises(ValueError):
        gram.covariance(one.limit(0))
    nan = spark.createDataFrame([([1.0, float("nan")],), ([1.0, 2.0],)], "features array<double>")
    with pytest.raises(ValueError):
        gram.covariance(nan)
    ragged = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>")
    with pytest.raises(Exception, match="length"):
        gram.covariance(ragged.coalesce(1))


def test_moments_keep_the_tasks_of_the_scan(spark):
    """The number of tasks is the scan's, however many slots there are; wide vectors go strip by strip."""
    x = np.random.default_rng(8).normal(size=(50, 600))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>").repartition(37)
    assert "Coalesce" not in gram.moments(df, "features", x[0])._jdf.queryExecution().executedPlan().toString()
    n, mean, cov = gram.covariance(df)
    assert n == 50
    np.testing.assert_allclose(mean, x.mean(axis=0), atol=1e-9)
    np.testing.assert_allclose(cov, np.cov(x.T), atol=1e-9)
    plan = gram.moments(df, "features", x[0], tasks=2)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 2" in plan


def test_class_reports(spark):
    df = tables.driver_rows(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4)], "label string, v int")
    assert [tuple(r) for r in classes.class_distribution(df).collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert classes.n_classes(df).head()[0] == 2 and classes.n_classes(df, approximate=True).head()[0] == 2
    assert classes.distinct_classes(df).count() == 3
    assert {r["label"]: r["percent"] for r in classes.class_share(df).collect()} == {"a": 50.0, "b": 25.0, None: 25.0}
    assert {r["label"]: r["steps"] for r in classes.class_relative(df).collect()} == {"a": 25, "b": 12, None: 12}
    assert [tuple(r) for r in classes.class_sample(df, value="v", shown=1).collect()] == [(None, 4)]
    empty = df.limit(0)
    assert classes.class_share(empty).count() == 0
    assert classes.class_balance(empty).head()["balance_ratio"] is None


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (None, None, None)], "a int, `b.c` string, v array<double>")
    got = {r["column"]: (r["dtype"], r["n_rows"], r["n_null"], r["percent_null"]) for r in quality.null_profile(df).collect()}
    assert got == {"a": ("int", 2, 1, 50.0), "b.c": ("string", 2, 2, 100.0), "v": ("array<double>", 2, 1, 50.0)}
    assert {r["percent_null"] for r in quality.null_profile(df.limit(0)).collect()} == {None}
    assert quality.null_profile(df.select()).count() == 0
    profile, sample = quality.summary(df, 1)
    assert profile.count() == 3 and sample.count() == 1


def test_frame_check(spark):
    df = spark.range(3)
    assert quality.is_valid(df, ["id"], 3) and not quality.is_valid(df, ["id"], 4)
    assert not quality.is_valid(df, ["id", "x"]) and not quality.is_valid(None) and not quality.is_valid(df.limit(0))
    failed = quality.frame_check(None, ["id"], spark=spark)
    assert quality.frame_check(None, ["id"]).count() == 3
    assert [r["passed"] for r in failed.collect()] == [False, False, False]


@pytest.mark.parametrize("tasks, below", [(1, 0), (64, 0), (65, 1), (4096, 1), (4097, 2), (800_000, 3)])
def test_levels_follow_the_tasks(spark, tasks, below):
    assert gram.levels(spark.range(1), tasks) == below


def test_no_sum_gets_a_row_of_every_task(spark):
    """Partial sums of 300 tasks, merged in levels: each key of a level gets at most FAN rows."""
    rows = spark.range(300 * 3).select((F.col("id") % 300).alias("task"), (F.col("id") / 300).cast("int").alias("i"), F.array(F.col("id") * 1.0, F.lit(1.0)).alias("s"))
    for below in (0, 1, 2):
        found = {r["i"]: r["s"] for r in gram.summed(rows, below).collect()}
        assert found == {i: [sum(range(300 * i, 300 * i + 300)) * 1.0, 300.0] for i in range(3)}
    first = rows.groupBy(F.floor(F.col("task") / gram.FAN).alias("g"), "i").count()
    assert first.agg(F.max("count")).head()[0] <= gram.FAN
    plan = gram.summed(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_moments_do_not_depend_on_levels(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=(500, 6))
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "features array<double>").repartition(9)
    monkeypatch.setattr(gram, "FAN", 2)
    monkeypatch.setattr(gram, "levels", lambda *_: 3)
    n, mean, cov = gram.covariance(df)
    assert n == 500
    np.testing.assert_allclose(mean, x.mean(axis=0))
    np.testing.assert_allclose(cov, np.cov(x.T))
    n, mean, squares = gram.column_moments(df, "features", x[0])
    np.testing.assert_allclose(squares, ((x - x.mean(axis=0)) ** 2).sum(axis=0))
