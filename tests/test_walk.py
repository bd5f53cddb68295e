"""Trees listed and footers read by tasks."""

import os

import pytest

from featureflow.operators import inventory
from featureflow.sources import walk


@pytest.fixture
def tree(spark, tmp_path):
    root = tmp_path / "out é%20"
    (root / "a" / "b" / "c").mkdir(parents=True)
    (root / "nothing").mkdir()
    (root / "a" / "b" / ".hidden").write_bytes(b"12")
    (root / "a" / "b" / "empty.txt").write_bytes(b"")
    (root / "a" / "_SUCCESS").write_bytes(b"")
    (root / "a" / "b" / "c" / "x+y.png").write_bytes(b"123")
    (root / "back").symlink_to(root / "a")
    (root / "lost").symlink_to(root / "never")
    spark.range(10).selectExpr("id", "id % 2 as k").write.partitionBy("k").parquet(str(root / "a" / "keyed.parquet"))
    spark.range(7).repartition(2).write.parquet(str(root / "plain.parquet"))
    (root / "hollow.parquet").mkdir()
    (root / "a" / "torn.parquet").write_bytes(b"PAR1 nothing PAR1")
    return root


def plain(root) -> set[tuple]:
    found = set()
    for at, folders, files in os.walk(root):
        for name in folders + files:
            path = os.path.join(at, name)
            is_dir = os.path.isdir(path)
            found.add((os.path.relpath(path, root), is_dir, 0 if is_dir else os.lstat(path).st_size if not os.path.exists(path) else os.path.getsize(path)))
    return found


def listed(frame, root) -> set[tuple]:
    rows = [(os.path.relpath(walk.local_path(r["path"]), root), r["directory"], r["length"]) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_everything_is_listed(spark, tree):
    assert listed(walk.walk(spark, str(tree)), tree) == plain(tree)
    assert listed(walk.walk(spark, str(tree / "nothing")), tree) == set()
    with pytest.raises(FileNotFoundError):
        walk.walk(spark, str(tree / "never"))


def test_the_driver_lists_what_tasks_cannot_open(spark, tree, monkeypatch):
    for name in ("back", "lost"):  # Hadoop follows links
        (tree / name).unlink()
    monkeypatch.setattr(walk, "opens_in_tasks", lambda uri: False)
    raw = {(p, d, n) for p, d, n in plain(tree) if not p.endswith(".crc")}  # its local client hides checksums
    assert listed(walk.walk(spark, str(tree)), tree) == raw


@pytest.mark.parametrize("by_tasks", [True, False])
def test_inventory_of_awkward_trees(spark, tree, monkeypatch, by_tasks):
    if not by_tasks:
        monkeypatch.setattr(inventory, "opens_in_tasks", lambda uri: False)
    got = {r["dataset"]: r for r in inventory.dataset_inventory(spark, str(tree)).collect()}
    assert set(got) == {"a/keyed.parquet", "plain.parquet", "hollow.parquet", "a/torn.parquet"}
    keyed = got["a/keyed.parquet"]
    assert (keyed["readable"], keyed["rows"], keyed["n_columns"], keyed["columns"]) == (True, 10, 2, ["id", "k"])
    assert (got["plain.parquet"]["rows"], got["plain.parquet"]["part_files"]) == (7, 2)
    assert got["plain.parquet"]["size_bytes"] == sum(f.stat().st_size for f in (tree / "plain.parquet").iterdir())
    for bad in ("hollow.parquet", "a/torn.parquet"):
        assert (got[bad]["readable"], got[bad]["rows"], got[bad]["columns"]) == (False, None, None)


def test_integrity_of_any_path(spark, tree):
    expected = ["a/keyed.parquet", "plain.parquet", "hollow.parquet", "a", "a/b/c/x+y.png", "plain", "nothing"]
    got = {r["path"]: (r["exists"], r["valid"], r["rows"]) for r in inventory.integrity_check(spark, str(tree), expected).collect()}
    assert got["a/keyed.parquet"] == (True, True, 10) and got["plain.parquet"] == (True, True, 7)
    assert got["hollow.parquet"] == got["a/b/c/x+y.png"] == got["nothing"] == (True, False, 0)
    assert got["a"] == (True, False, 0) and got["plain"] == (False, False, 0)


def test_jobs_do_not_grow_with_the_datasets(spark, tmp_path):
    counts = []
    for n in (2, 25):
        root = tmp_path / f"of{n}"
        spark.range(3).coalesce(1).write.parquet(str(root / "one.parquet"))
        data = next((root / "one.parquet").glob("part-*.parquet")).read_bytes()
        for i in range(1, n):
            (root / f"d{i}.parquet").mkdir()
            (root / f"d{i}.parquet" / "part-0.parquet").write_bytes(data)
        spark.sparkContext.setJobGroup(f"inventory {n}", "")
        assert inventory.dataset_inventory(spark, str(root)).agg({"rows": "sum"}).head()[0] == 3 * n
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"inventory {n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_footers_tell_errors_apart(spark, tree):
    paths = [f"file:{tree}/a/torn.parquet", f"file:{tree}/never.parquet"] + [f"file:{p}" for p in (tree / "plain.parquet").glob("part-*.parquet")]
    got = {r["path"]: r for r in walk.footers(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    assert len(got) == 4 and sum(r["rows"] or 0 for r in got.values()) == 7
    assert got[paths[0]]["error"] and got[paths[1]]["error"].startswith("FileNotFoundError")
