from conftest import picture, png_bytes
from featureflow.streaming import incremental


def test_new_files_are_indexed_once(spark, tmp_path):
    root, out, checkpoint = tmp_path / "set", str(tmp_path / "index"), str(tmp_path / "checkpoint")
    (root / "A").mkdir(parents=True)
    (root / "A" / "1.png").write_bytes(png_bytes(picture(1)))
    (root / "A" / "skip.txt").write_text("x")

    def run():
        query = incremental.append_new(incremental.stream_index(spark, str(root)), out, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r["path"].rsplit("/", 1)[1], r["label"]) for r in spark.read.parquet(out).collect())

    assert run() == [("1.png", "A")]
    assert run() == [("1.png", "A")]
    (root / "A" / "2.png").write_bytes(png_bytes(picture(2)))
    assert run() == [("1.png", "A"), ("2.png", "A")]
