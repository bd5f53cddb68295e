import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import picture, png_bytes
from featureflow.functions import paths
from featureflow.operators import images
from featureflow.plans import jobs
from featureflow.sources import files

VALID = {"a 1.png", "b+2.PNG", "c%3.png", "d%20.png", "é.png"}


def names(df):
    return {r["path"].rsplit("/", 1)[1] for r in df.select("path").collect()}


def test_index(spark, image_set):
    root, good = image_set
    index = files.image_index(spark, root)
    assert names(index) == {n.split("/")[1] for n in good} | {"broken.png", "cut.png"}
    assert {r["label"] for r in index.collect()} == {"Apple Red", "Banana", "Tiny"}
    with pytest.raises(FileNotFoundError):
        files.image_index(spark, root + "/missing")


def test_index_sample_is_stable(spark, image_set):
    root, _ = image_set
    a = files.image_index(spark, root, 4)
    assert a.count() == 4 and names(a) == names(files.image_index(spark, root, 4))
    assert files.image_index(spark, root, 1000).count() == files.image_index(spark, root).count()


def test_binary_scan(spark, image_set):
    root, _ = image_set
    df = files.scan_binary(spark, root, "*.PNG")
    assert df.columns == ["path", "modificationTime", "length", "content"]
    row = df.head()
    assert row["length"] == len(row["content"]) and names(df) == {"b+2.PNG"}


def test_metadata_scan_reads_no_content(spark, image_set):
    plan = files.list_files(spark, image_set[0])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_scan_images_paths_match_index(spark, image_set):
    root, _ = image_set
    decoded = files.scan_images(spark, root)
    index = files.image_index(spark, root)
    assert index.join(decoded, "path", "left_anti").count() == 0


def test_validate(spark, image_set):
    root, _ = image_set
    checked = images.validate_images(files.indexed_images(spark, root), files.image_index(spark, root))
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in checked.collect()}
    assert {n for n, r in reasons.items() if r == "OK"} == VALID
    assert reasons["broken.png"] == reasons["cut.png"] == "corrupt"
    assert reasons["small.png"] == "too small: 8x8" and reasons["narrow.png"] == "too small: 31x100"
    assert names(images.valid_images(files.indexed_images(spark, root), files.image_index(spark, root))) == VALID
    sample = files.image_index(spark, root, 4)
    assert names(files.indexed_images(spark, root, sample)) == names(sample)


def test_validate_options(spark, image_set):
    root, _ = image_set
    scan = files.scan_images(spark, root)
    assert {"small.png", "narrow.png"} <= names(images.valid_images(scan, check_size=False))
    assert "broken.png" not in names(images.valid_images(scan, check_size=False))
    assert "narrow.png" in names(images.valid_images(scan, min_size=(31, 32)))


def test_validate_missing_rows(spark, image_set):
    root, _ = image_set
    index = files.image_index(spark, root).unionByName(
        spark.createDataFrame([(f"{root}/Banana/empty.png", "Banana")], "path string, label string")
    )
    for listing in (None, files.list_files(spark, root)):
        checked = images.validate_images(files.indexed_images(spark, root), index, listing)
        assert checked.filter("reason = 'unreadable'").count() == 1 and checked.count() == index.count()


def test_no_exchange_moves_pixels(spark, image_set):
    root, _ = image_set
    checked = images.validate_images(files.indexed_images(spark, root), files.image_index(spark, root), files.list_files(spark, root))
    plan = images.featurise_checked(checked)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert not any("data" in line or "image" in line for line in moved)
    assert plan.count("ormat: image") <= 1 or plan.count("FileScan image") <= 1


def plain_resize(block, size):
    """Plain bilinear resize, one output pixel at a time."""
    h, w = block.shape[:2]
    out = np.zeros((size, size, block.shape[2]))
    for i in range(size):
        for j in range(size):
            y = min(max((i + 0.5) * h / size - 0.5, 0), h - 1)
            x = min(max((j + 0.5) * w / size - 0.5, 0), w - 1)
            y0, x0 = int(y), int(x)
            y1, x1 = min(y0 + 1, h - 1), min(x0 + 1, w - 1)
            top = block[y0, x0] * (1 - (x - x0)) + block[y0, x1] * (x - x0)
            bottom = block[y1, x0] * (1 - (x - x0)) + block[y1, x1] * (x - x0)
            out[i, j] = top * (1 - (y - y0)) + bottom * (y - y0)
    return out


@pytest.mark.parametrize("shape", [(5, 9, 3), (20, 7, 3), (12, 12, 3), (1, 1, 3)])
def test_resize(shape):
    block = np.random.default_rng(1).integers(0, 256, shape).astype(np.uint8)
    np.testing.assert_allclose(images.resize(block, 12).transpose(1, 2, 0), plain_resize(block.astype(float), 12), atol=1e-3)


def descriptor(block, size, grid, bins):
    rgb = block if block.ndim == 3 else np.repeat(block[:, :, None], 3, axis=2)
    x = plain_resize(rgb[:, :, :3].astype(float), size) / 127.5 - 1
    planes = [x[:, :, 0], x[:, :, 1], x[:, :, 2], x @ np.array([0.299, 0.587, 0.114])]
    step, out = size // grid, []
    for p in planes:
        out += [p[i * step : (i + 1) * step, j * step : (j + 1) * step].mean() for i in range(grid) for j in range(grid)]
        cells = np.minimum(np.floor((p + 1) * bins / 2), bins - 1).astype(int)
        out += [(cells == b).mean() for b in range(bins)]
    return np.array(out)


def test_featurise(spark, image_set):
    root, good = image_set
    factory = images.colour_features(16, 4, 8)
    done = images.featurise(files.scan_images(spark, root), factory, batch=2).collect()
    by_name = {r["path"].rsplit("/", 1)[1]: r for r in done}
    for name, block in good.items():
        row = by_name[name.split("/")[1]]
        assert row["status"] == "ok" and row["error"] is None
        expected = descriptor(block, 16, 4, 8)
        got = np.array(row["features"])
        for plane in range(4):
            tiles = slice(plane * 24, plane * 24 + 16)
            np.testing.assert_allclose(got[tiles], expected[tiles], atol=1e-4)
            shares = slice(plane * 24 + 16, plane * 24 + 24)
            assert np.abs(got[shares] - expected[shares]).sum() < 0.05 and got[shares].sum() == pytest.approx(1, abs=1e-5)
    assert by_name["broken.png"]["features"] is None and by_name["broken.png"]["status"] == "error"
    assert "corrupt" in by_name["cut.png"]["error"]


def test_default_length(spark, image_set):
    done = images.featurise(images.valid_images(files.scan_images(spark, image_set[0])))
    assert {len(r["features"]) for r in done.collect()} == {images.FEATURE_LENGTH}
    assert dict(done.dtypes)["features"] == "array<float>" and "image" not in done.columns


def test_on_error(spark, image_set):
    scan = files.scan_images(spark, image_set[0])
    factory = images.colour_features(8, 2, 4)
    total = scan.count()
    zero = images.featurise(scan, factory, 32, "zero").filter("status = 'error'").collect()
    assert len(zero) == 2 and all(r["features"] == [0.0] * 32 for r in zero)
    assert images.featurise(scan, factory, 32, "drop").count() == total - 2
    with pytest.raises(Exception, match="corrupt"):
        images.featurise(scan, factory, 32, "fail").collect()
    with pytest.raises(ValueError):
        images.featurise(scan, factory, 32, "other")


def test_factory_runs_once_per_task(spark):
    def factory():
        made = np.random.default_rng().integers(1 << 40)
        return lambda blocks: np.full((len(blocks), 1), made, dtype=np.float64)

    image = F.struct(F.lit(2).alias("height"), F.lit(2).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
                     F.unhex(F.lit("00112233")).alias("data"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 200, 1, 3).select("id", F.spark_partition_id().alias("p"), image.alias("image"))
        done = images.featurise(df, factory).select("p", F.col("features")[0].alias("m")).distinct()
        assert done.count() == 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_featurise_adds_no_exchange(spark, image_set):
    done = images.featurise(images.valid_images(files.scan_images(spark, image_set[0])))
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("on_error", ["null", "zero", "drop"])
def test_each_image_is_inferred_once(spark, image_set, on_error):
    scan = images.valid_images(files.scan_images(spark, image_set[0]))
    done = images.featurise(scan, on_error=on_error).filter("status = 'ok' and size(features) > 0")
    assert done._jdf.queryExecution().executedPlan().toString().count("EvalPython [") == 1


def test_jpeg(spark, tmp_path):
    (tmp_path / "Kiwi").mkdir()
    jvm = spark._jvm
    buffered = jvm.java.awt.image.BufferedImage(48, 36, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    jvm.javax.imageio.ImageIO.write(buffered, "jpg", jvm.java.io.File(str(tmp_path / "Kiwi" / "k.JPEG")))
    row = files.scan_images(spark, str(tmp_path)).head()
    assert (row["label"], row["image"]["height"], row["image"]["width"]) == ("Kiwi", 36, 48)
    assert names(files.scan_binary(spark, str(tmp_path), "*.JPEG")) == {"k.JPEG"}


def test_job_and_refresh(spark, tmp_path):
    root, out = tmp_path / "set", str(tmp_path / "features.parquet")
    (root / "A").mkdir(parents=True)
    (root / "A" / "1.png").write_bytes(png_bytes(picture(1)))
    config = jobs.FeaturizeConfig(factory=images.colour_features(8, 2, 4), factory_name="small", length=32)
    first = jobs.featurize_job(spark, str(root), out, config)
    assert [len(r["features"]) for r in first.collect()] == [32]
    (root / "A" / "2.png").write_bytes(png_bytes(picture(2)))
    assert jobs.featurize_job(spark, str(root), out, config).count() == 2


def test_another_factory_is_not_served_the_old_features(spark, tmp_path):
    root, out = tmp_path / "set", str(tmp_path / "features.parquet")
    (root / "A").mkdir(parents=True)
    (root / "A" / "1.png").write_bytes(png_bytes(picture(1)))
    with pytest.raises(ValueError, match="factory_name"):
        jobs.FeaturizeConfig(factory=images.colour_features(8, 2, 4))
    lengths = []
    for size, bins in ((8, 4), (8, 6), (8, 4)):
        config = jobs.FeaturizeConfig(factory=images.colour_features(size, 2, bins), factory_name="same")
        lengths.append(len(jobs.featurize_job(spark, str(root), out, config).head()["features"]))
    assert lengths == [32, 40, 32]


def test_rejected_images_stay_with_their_reason(spark, image_set, tmp_path):
    root, _ = image_set
    config = jobs.FeaturizeConfig(factory=images.colour_features(8, 2, 4), factory_name="small", length=32, average_bytes=2000)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    done = {r["path"].rsplit("/", 1)[1]: r for r in jobs.featurize_job(spark, root, str(tmp_path / "f"), config).collect()}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert set(done) == names(files.image_index(spark, root))
    assert {n for n, r in done.items() if r["status"] == "ok"} == VALID
    assert (done["small.png"]["status"], done["small.png"]["reason"], done["small.png"]["features"]) == ("rejected", "too small: 8x8", None)
    assert done["broken.png"]["reason"] == "corrupt"
    sample = files.image_index(spark, root, 3)
    assert names(jobs.featurize_job(spark, root, str(tmp_path / "s"), config, sample)) == names(sample)


def test_batches_are_cut_by_pixels(spark, tmp_path):
    """One large image among small ones: no batch of several images has more bytes than the limit."""
    (tmp_path / "set" / "A").mkdir(parents=True)
    for i in range(20):
        side = 1500 if i == 7 else 40
        (tmp_path / "set" / "A" / f"{i}.png").write_bytes(png_bytes(picture(i, side, side)))

    def factory():
        def featurise(blocks):
            held = sum(b.shape[0] * b.shape[1] * 3 for b in blocks)
            return np.array([[len(blocks), held]] * len(blocks), np.float32)

        return featurise

    limit = 3 * 40 * 40 * 3
    config = jobs.FeaturizeConfig(factory=factory, factory_name="sizes", length=2, batch=8, batch_bytes=limit)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    done = jobs.featurize_job(spark, str(tmp_path / "set"), str(tmp_path / "f"), config).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    seen = sorted({tuple(r["features"]) for r in done})
    assert len(done) == 20 and all(held <= limit or n == 1 for n, held in seen) and (1.0, 1500 * 1500 * 3.0) in seen
    assert list(images.batch_borders([], 3, 10)) == []
    assert list(images.batch_borders([4, 4, 4, 50, 1, 1, 1, 1], 3, 10)) == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]


def test_error_text_is_whole(spark):
    def factory():
        def fail(blocks):
            raise ValueError("x" * 3000)

        return fail

    image = F.struct(F.lit(1).alias("height"), F.lit(1).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), F.unhex(F.lit("00")).alias("data"))
    row = images.featurise(spark.range(1).select(image.alias("image")), factory).head()
    assert len(row["error"]) == len("ValueError: ") + 3000


def test_passthrough(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "i int, embedding array<float>")
    got = {r["i"]: (r["features"], r["status"]) for r in images.passthrough(df, "embedding").collect()}
    assert got == {1: ([1.0], "ok"), 2: (None, "error")}


def test_conf():
    conf = files.scan_conf(5_000, 1000)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 10_000_000
    assert images.arrow_conf(30_000) == {"spark.sql.execution.arrow.maxBytesPerBatch": "30000"}
    assert paths.CLASS_NAMES[0] == "Apple_Red"


def field(number, wire, payload):
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    key = varint(number << 3 | wire)
    return key + varint(payload) if wire == 0 else key + varint(len(payload)) + payload


def pooling_model():
    """A network with one global average pooling node, in ONNX wire format."""
    def value(name, dims):
        shape = b"".join(field(1, 2, field(1, 0, d) if isinstance(d, int) else field(2, 2, d.encode())) for d in dims)
        tensor = field(1, 0, 1) + field(2, 2, shape)
        return field(1, 2, name.encode()) + field(2, 2, field(1, 2, tensor))

    node = field(1, 2, b"x") + field(2, 2, b"y") + field(4, 2, b"GlobalAveragePool")
    graph = field(1, 2, node) + field(2, 2, b"g") + field(11, 2, value("x", ["n", 3, 16, 16])) + field(12, 2, value("y", ["n", 3, 1, 1]))
    return field(1, 0, 8) + field(7, 2, graph) + field(8, 2, field(2, 0, 13))


def test_onnx(spark, image_set, tmp_path):
    pytest.importorskip("onnxruntime")
    model = tmp_path / "pool.onnx"
    model.write_bytes(pooling_model())
    root, good = image_set
    factory = images.onnx_features(spark, str(model), 16, channels_first=True)
    done = {r["path"].rsplit("/", 1)[1]: r for r in images.featurise(files.scan_images(spark, root), factory, 3).collect()}
    block = good["Apple Red/a 1.png"]
    expected = (plain_resize(block.astype(float), 16) / 127.5 - 1).mean(axis=(0, 1))
    np.testing.assert_allclose(done["a 1.png"]["features"], expected, atol=1e-4)
    assert done["broken.png"]["status"] == "error"
