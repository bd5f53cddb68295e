import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.llm import block_search, norm_search
from featureflow.llm import vectors as grids
from featureflow.llm.vectors import first_k

SCHEMA = "vec_id long, embedding array<double>, score string"


def vectors(seed: int, n: int = 300, dim: int = 12) -> list[tuple]:
    """Clusters of unlike lengths, many exact copies, zero vectors, and rows that take no part."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dim))
    x = centres[r.integers(0, 5, n)] + r.normal(size=(n, dim)) * 0.3
    x *= r.lognormal(0, 1, n)[:, None]
    x[: n // 3] = x[0]
    x[n // 3 : n // 3 + 4] = 0
    rows = [(int(i) * 5, v.tolist(), "x") for i, v in enumerate(x)]
    bad = [None, [], [1.0, None] * (dim // 2), [float("nan")] * dim, [float("inf")] * dim]
    return rows + [(100_000 + 20 * i, v, "bad") for i, v in enumerate(bad)] + [(None, x[5].tolist(), "bad"), (100_200, [1.0, 2.0], "short"), (100_220, [3.0, 1.0], "short")]


def brute_force(rows: list[tuple], k: int, zero: bool) -> dict:
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            found = sorted((-float((v * w).sum()), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out[i] = [(j, -s) for s, j in found]
    return {i: found for i, found in out.items() if found}


def lists(frame) -> dict:
    out: dict = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize(("cell", "queries"), [(4096, 1024), (64, 16)])
@pytest.mark.parametrize("seed", range(2))
def test_exact_top_k(spark, monkeypatch, seed, cell, queries):
    monkeypatch.setattr(norm_search, "CELL_ROWS", cell)
    monkeypatch.setattr(norm_search, "QUERY_ROWS", queries)
    rows = vectors(seed)
    frame = spark.createDataFrame(rows, SCHEMA).select("vec_id", norm_search.integers("embedding").alias("vector"), "score").repartition(4)
    whole = [(i, v if not v or any(c is None or not np.isfinite(c) for c in v) else np.floor(64 * np.array(v)).tolist(), s) for i, v, s in rows]
    assert lists(norm_search.top_k(frame, frame.where("vec_id % 20 = 0"), 7)) == brute_force(whole, 7, True)


@pytest.mark.parametrize(("cell", "tile"), [(4096, 1024), (64, 20)])
@pytest.mark.parametrize("seed", range(2))
def test_nearest(spark, monkeypatch, seed, cell, tile):
    monkeypatch.setattr(block_search, "CELL_ROWS", cell)
    monkeypatch.setattr(block_search, "QUERY_ROWS", cell)
    monkeypatch.setattr(block_search, "TILE", tile)
    rows = vectors(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, want = lists(block_search.nearest(frame, frame.where("vec_id % 20 = 0"), 7)), brute_force(rows, 7, False)
    assert {q: [j for j, _ in found] for q, found in got.items()} == {q: [j for j, _ in found] for q, found in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12, atol=0) for q in want)


def test_bounds_hold():
    r = np.random.default_rng(3)
    x, y = r.normal(size=(40, 30)), r.normal(size=(50, 30)) * r.lognormal(0, 2, 50)[:, None]
    product, error = block_search.tile_bounds(block_search.quantised(x), block_search.quantised(y), np.sqrt((y**2).sum(1)))
    assert (np.abs(product - x @ y.T) <= error).all()
    assert (error < 0.05 * np.sqrt((x**2).sum(1))[:, None] * np.sqrt((y**2).sum(1))).all()


def test_pruning_loses_nothing():
    r = np.random.default_rng(4)
    c = np.floor(r.normal(size=(500, 8)) * 20)
    lengths = np.sqrt((c**2).sum(1))
    order = np.argsort(-lengths)
    c, lengths = c[order], lengths[order]
    unit = c / lengths[:, None]
    for q in np.floor(r.normal(size=(30, 8)) * 20):
        scores = c @ q
        for bound in np.quantile(scores, [0.3, 0.9, 0.99, 1.0]):
            near = norm_search.survivors(q, float(np.sqrt(q @ q)), float(bound), unit, lengths)
            assert set(np.flatnonzero(scores >= bound)) <= set(np.arange(500)[near])


def dominant_vectors(dim: int) -> np.ndarray:
    """Whole numbers where one or two components outweigh the others, with copies and multiples of one direction, and opposites."""
    r = np.random.default_rng(dim)
    x = np.floor(r.normal(size=(400, dim)) * 20) * (r.random((400, dim)) < 0.5)
    x[np.arange(200), r.integers(0, dim, 200)] += r.choice([-300, 300], 200)
    one_hot = np.eye(dim)[r.integers(0, dim, 60)] * r.choice([-300, -200, 200, 300], 60)[:, None]
    return np.vstack((x, one_hot, x[:40], -x[:40], 2 * x[40:60]))


@pytest.mark.parametrize("dim", [1, 2, 3, 4, 12])
def test_pruning_loses_nothing_near_an_axis(dim):
    c = dominant_vectors(dim)
    lengths = np.sqrt((c**2).sum(1))
    c, lengths = c[np.argsort(-lengths, kind="stable")], np.sort(lengths)[::-1]
    unit = c / np.maximum(lengths, 1e-300)[:, None]
    for q in c[:: 1 + len(c) // 120]:
        scores, length = c @ q, float(np.sqrt(q @ q))
        for cosine in (0.3, 0.5, 0.55, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0):
            bound = cosine * length * lengths[0]
            near = norm_search.survivors(q, length, bound, unit, lengths)
            assert set(np.flatnonzero(scores >= bound)) <= set(np.arange(len(c))[near])


@pytest.mark.parametrize("dim", [2, 4, 12])
def test_exact_top_k_near_an_axis(spark, monkeypatch, dim):
    monkeypatch.setattr(norm_search, "CELL_ROWS", 64)
    rows = [(i * 5, v.tolist(), "x") for i, v in enumerate(dominant_vectors(dim))]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("embedding", "vector").repartition(4)
    assert lists(norm_search.top_k(frame, frame.where("vec_id % 20 = 0"), 7)) == brute_force(rows, 7, True)


def test_no_queries_no_candidates_few_candidates(spark):
    frame = spark.createDataFrame([(20, [1.0, 0.0], "a"), (21, [0.0, 2.0], "b")], SCHEMA)
    for found in (block_search.nearest(frame.limit(0), frame), block_search.nearest(frame, frame.limit(0))):
        assert found.count() == 0
    whole = frame.withColumn("vector", F.col("embedding"))
    for found in (norm_search.top_k(whole.limit(0), whole), norm_search.top_k(whole, whole.limit(0))):
        assert found.count() == 0
    assert lists(norm_search.top_k(whole, whole.where("vec_id = 20"))) == {20: [(21, 0)]}
    assert lists(block_search.nearest(frame.unionByName(frame), frame.where("vec_id = 20"))) == {20: [(21, 0.0), (21, 0.0)]}


def test_ties_at_the_border_go_to_small_ids():
    assert first_k(np.array([1, 5, 5, 5, 2]), np.array([9, 8, 7, 6, 5]), 2).tolist() == [3, 2]


def test_rounds_grow_and_meet_every_cell_once():
    assert grids.rounds([1]) == [[(0, 1)]]
    assert grids.rounds([20, 3]) == [[(0, 1), (0, 0)], [(1, 16), (0, 1)], [(16, 20), (1, 3)]]
    many = grids.rounds([100_000] * 16)
    assert len(many) == 7  # grows with the number's logarithm
    for bucket in range(16):
        assert sum(y - x for own in many for x, y in [own[bucket]]) == 100_000


class Counted:
    """Sizes of the plans and rows returned by the cells of all rounds."""

    def __init__(self, monkeypatch):
        self.plans, self.rows = [], 0
        round_ = grids._round

        def counted(*args):
            found = round_(*args).cache()
            self.plans.append(len(args[0].sparkSession._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")))
            self.rows += found.count()
            return found

        monkeypatch.setattr(grids, "_round", counted)


@pytest.mark.parametrize(("search", "column"), [(norm_search.top_k, "vector"), (block_search.nearest, "embedding")])
def test_cells_after_the_first_return_what_may_enter_the_list(spark, monkeypatch, search, column):
    for module in (norm_search, block_search):
        monkeypatch.setattr(module, "CELL_ROWS", 64)
    r = np.random.default_rng(7)
    plans = []
    for n in (3000, 12_000):
        x = np.floor(r.normal(size=(n, 4)) * 50) + 1000 * (r.random((n, 1)) < 0.1)
        frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, {column} array<double>")
        with monkeypatch.context() as patch:
            counted = Counted(patch)
            got = lists(search(frame, frame.where("vec_id % 1000 = 0"), 5))
        for q, found in got.items():
            want = sorted((-float(x[q] @ x[j]), j) for j in range(n) if j != q)[:5]
            assert found == [(j, -s) for s, j in want]
        assert counted.rows < len(got) * 5 * n / 64 / 2  # k rows from each cell would be twice that
        plans.append(max(counted.plans))
    assert plans[1] < 1.2 * plans[0]


@pytest.mark.parametrize("search", [norm_search.top_k, block_search.nearest])
def test_rows_that_share_an_id_spread_over_cells(spark, monkeypatch, search):
    for module in (norm_search, block_search):
        monkeypatch.setattr(module, "CELL_ROWS", 64)
    column = "vector" if search is norm_search.top_k else "embedding"
    frame = spark.createDataFrame([(7, [float(i % 50), 1.0]) for i in range(1000)] + [(20, [1.0, 0.0])], f"vec_id long, {column} array<double>")
    cells = []
    inner = grids._round

    def counted(rows, *args):
        cells.append(max(r["count"] for r in rows.groupBy("bucket", "sub").count().collect()))
        return inner(rows, *args)

    monkeypatch.setattr(grids, "_round", counted)
    assert lists(search(frame, frame.where("vec_id = 20"), 25)) == {20: [(7, 49.0)] * 20 + [(7, 48.0)] * 5}
    assert max(cells) <= 120


def test_lengths_that_underflow_or_overflow(spark):
    rows = [(20, [1e200, 0.0]), (1, [1e-200, 0.0]), (2, [3e-200, 1e-300]), (3, [-1e-200, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [j for j, _ in lists(block_search.nearest(frame, frame.where("vec_id = 20"), 2))[20]] == [2, 1]
    whole = spark.createDataFrame([(20, [4e9, 0.0]), (1, [4e9, 1.0])], "vec_id long, vector array<double>")
    with pytest.raises(ValueError, match="63 bits"):
        norm_search.top_k(whole, whole.where("vec_id = 20"))
