"""Image validation and featurisation.

Input rows carry a decoded ``image`` struct (height, width, nChannels, mode, data; rows of BGR pixels). A
featuriser is made by a factory that runs once per Python task and is then called for every Arrow batch:
``factory() -> f(list of h x w x channels uint8 arrays) -> n x d float32``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions.paths import same_uri

# Model input size, feature length, smallest valid side, pixel scaling x / 127.5 - 1.
INPUT_SIZE = 224
FEATURE_LENGTH = 1280
MIN_SIDE = 32
PIXEL_SCALE = 127.5

#: Images the network gets at once, and bytes of decoded pixels that it gets at once unless one image has more.
BATCH = 32
BATCH_BYTES = 64 << 20

LUMA = np.array([0.299, 0.587, 0.114], dtype=np.float32)


def validity_reason(
    image: str | Column = "image", check_corruption: bool = True, check_size: bool = True,
    min_size: tuple[int, int] = (MIN_SIDE, MIN_SIDE),
) -> Column:
    """``OK``, ``unreadable`` (no row), ``corrupt`` (height -1) or ``too small: WxH``; min_size is (width, height)."""
    image = F.col(image) if isinstance(image, str) else image
    height, width = image["height"], image["width"]
    reason = F.when(height.isNull(), "unreadable")
    if check_corruption or check_size:
        reason = reason.when(height < 0, "corrupt")
    if check_size:
        small = (width < min_size[0]) | (height < min_size[1])
        reason = reason.when(
            small, F.concat(F.lit("too small: "), width.cast("string"), F.lit("x"), height.cast("string"))
        )
    return reason.otherwise("OK")


def validate_images(
    images: DataFrame, index: DataFrame | None = None, listing: DataFrame | None = None, **checks
) -> DataFrame:
    """Adds ``reason`` and ``valid``. With an ``index`` (path, label), its files without an image row are ``unreadable``.

    Images carry their own verdict, so no join ever moves pixels: only paths are compared. ``images`` are the ones of
    the index (``files.indexed_images``); ``listing`` (path) tells which files have a row, where a scan of metadata
    is cheaper than the images' paths.
    """
    if index is not None:
        have = (images if listing is None else listing).select(same_uri("path").alias("__uri"))
        missing = index.join(have, same_uri("path") == F.col("__uri"), "left_anti")
        images = images.unionByName(missing.select("path", "label"), allowMissingColumns=True)
    return images.withColumn("reason", validity_reason("image", **checks)).withColumn("valid", F.col("reason") == "OK")


def valid_images(images: DataFrame, index: DataFrame | None = None, **checks) -> DataFrame:
    return validate_images(images, index, **checks).filter("valid").drop("valid", "reason")


def pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """h x w x 3 RGB; grey is repeated, alpha dropped."""
    if height <= 0 or width <= 0:
        raise ValueError("corrupt image")
    block = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(block, 3, axis=2)
    return block[:, :, 2::-1]


def taps(n: int, size: int) -> np.ndarray:
    """size x n bilinear weights, pixel centres aligned."""
    at = np.clip((np.arange(size, dtype=np.float32) + 0.5) * n / size - 0.5, 0, n - 1)
    low = np.floor(at).astype(np.int64)
    weights = np.zeros((size, n), dtype=np.float32)
    weights[np.arange(size), low] = 1 - (at - low)
    weights[np.arange(size), np.minimum(low + 1, n - 1)] += at - low
    return weights


def resize(block: np.ndarray, size: int) -> np.ndarray:
    """Bilinear resize of an h x w x c array to c planes of size x size: rows @ plane @ columns."""
    planes = block.astype(np.float32).transpose(2, 0, 1)
    height, width = block.shape[:2]
    if (height, width) == (size, size):
        return planes
    return taps(height, size) @ planes @ taps(width, size).T


def scaled(block: np.ndarray, size: int = INPUT_SIZE) -> np.ndarray:
    """Resized planes in [-1, 1], the input range of the usual mobile networks."""
    return resize(block, size) / np.float32(PIXEL_SCALE) - np.float32(1)


def colour_features(size: int = INPUT_SIZE, grid: int = 16, bins: int = 64) -> Callable[[], Callable]:
    """Factory of the default descriptor; needs no weights.

    For red, green, blue and luma: means of a grid x grid tiling, then a ``bins`` histogram as shares. The
    default lengths give 4 * (16*16 + 64) = 1280 numbers.
    """
    if size % grid:
        raise ValueError("size must be a multiple of grid")

    def factory() -> Callable[[list[np.ndarray]], np.ndarray]:
        step = size // grid

        def featurise(blocks: list[np.ndarray]) -> np.ndarray:
            n = len(blocks)
            planes = np.empty((n, 4, size, size), np.float32)
            for plane, block in zip(planes, blocks):
                plane[:3] = resize(block, size)
            planes[:, :3] /= np.float32(PIXEL_SCALE)
            planes[:, :3] -= np.float32(1)
            planes[:, 3] = np.einsum("c,ncij->nij", LUMA, planes[:, :3])
            tiles = planes.reshape(n, 4, grid, step, grid, step).sum(axis=5).sum(axis=3) / np.float32(step * step)
            cells = np.clip((planes + 1) * np.float32(bins / 2), 0, bins - 1).astype(np.int32)
            cells += (np.arange(4 * n, dtype=np.int32) * bins).reshape(n, 4, 1, 1)
            shares = np.bincount(cells.ravel(), minlength=4 * n * bins).reshape(n, 4, bins) / (size * size)
            return np.concatenate([tiles.reshape(n, 4, -1), shares], axis=2).reshape(n, -1).astype(np.float32)

        return featurise

    return factory


def onnx_features(spark: Any, model_path: str, size: int = INPUT_SIZE, channels_first: bool = False) -> Callable[[], Callable]:
    """Factory around a user-supplied ONNX network.

    Spark copies the file, from any file system it can read, to every executor once; a task opens its copy.
    """
    spark.sparkContext.addFile(model_path)
    name_of_file = model_path.rstrip("/").rsplit("/", 1)[-1]

    def factory() -> Callable[[list[np.ndarray]], np.ndarray]:
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1
        session = onnxruntime.InferenceSession(SparkFiles.get(name_of_file), options, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name

        def featurise(blocks: list[np.ndarray]) -> np.ndarray:
            x = np.stack([scaled(b, size) for b in blocks]).astype(np.float32)
            if not channels_first:
                x = np.ascontiguousarray(x.transpose(0, 2, 3, 1))
            out = session.run(None, {name: x})[0]
            return out.reshape(len(blocks), -1).astype(np.float32)

        return featurise

    return factory


def featurise(
    images: DataFrame,
    factory: Callable[[], Callable] | None = None,
    length: int = FEATURE_LENGTH,
    on_error: str = "null",
    image: str = "image",
    output: str = "features",
    batch: int = BATCH,
    reason: str | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Adds ``features array<float>``, ``status`` (ok/error) and ``error``; the image column is dropped.

    With a ``reason`` column of the validation, images whose reason is not OK are not looked at: status ``rejected``.

    The scan's own partitions feed the Python tasks, so no exchange moves pixels (for tables that hold many
    images in few splits, ``settle.spread`` the rows while they are narrow). A batch that fails is repeated image by image, so one bad image costs only itself. ``on_error``: ``null`` leaves the features
    null, ``zero`` gives a zero vector, ``drop`` removes the row, ``fail`` raises.
    """
    if on_error not in ("null", "zero", "drop", "fail"):
        raise ValueError("on_error must be 'null', 'zero', 'drop' or 'fail'")
    make = factory or colour_features()

    @F.pandas_udf("features array<float>, status string, error string")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()

        def one(row) -> tuple:
            try:
                return model([pixels(*row)])[0], "ok", None
            except Exception as error:
                if on_error == "fail":
                    raise
                return None, "error", f"{type(error).__name__}: {error}"

        def several(rows: list) -> list[tuple]:
            try:
                return [(v, "ok", None) for v in model([pixels(*r) for r in rows])]
            except Exception:
                return [one(r) for r in rows]

        for frame in batches:
            good = np.flatnonzero(frame["good"].to_numpy())
            used = frame.iloc[good]
            rows = list(zip(used["height"], used["width"], used["nChannels"], used["data"]))
            done = [(None, "rejected", None)] * len(frame)
            sizes = [len(data) if data is not None else 0 for *_, data in rows]
            for start, end in batch_borders(sizes, batch, batch_bytes):
                for at, result in zip(good[start:end], several(rows[start:end])):
                    done[at] = result
            yield pd.DataFrame(done, columns=["features", "status", "error"])

    good = F.lit(True) if reason is None else F.coalesce(F.col(reason) == "OK", F.lit(False))
    # a missing image is a corrupt one: a null here would turn the whole batch's numbers into floats
    sides = [F.coalesce(F.col(f"{image}.{c}"), F.lit(-1)).alias(c) for c in ("height", "width", "nChannels")]
    source = F.struct(*sides, F.col(f"{image}.data").alias("data"), good.alias("good"))
    kept = [c for c in images.columns if c != image]
    # Marked non-deterministic so that a later filter on the status is not pushed below as a second inference.
    result = images.withColumn("__r", run.asNondeterministic()(source)).select(*kept, "__r.*")
    if on_error == "zero":
        zeros = F.array_repeat(F.lit(0.0).cast("float"), length)
        result = result.withColumn("features", F.when(F.col("status") == "error", zeros).otherwise(F.col("features")))
    elif on_error == "drop":
        result = result.filter("status <> 'error'")
    return result.withColumnRenamed("features", output) if output != "features" else result


def batch_borders(sizes: list[int], batch: int, batch_bytes: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of consecutive batches: at most ``batch`` items, and ``batch_bytes`` unless one item has more."""
    begin = held = 0
    for at, size in enumerate(sizes):
        if at > begin and (at - begin == batch or held + size > batch_bytes):
            yield begin, at
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def featurise_checked(
    checked: DataFrame, factory: Callable[[], Callable] | None = None, length: int = FEATURE_LENGTH, on_error: str = "null",
    **batches,
) -> DataFrame:
    """Features of validated images, and a row without features for each rejected one: ``path, label, features, status, error, reason``."""
    done = featurise(checked.drop("valid"), factory, length, on_error, reason="reason", **batches)
    return done.select("path", "label", "features", "status", "error", "reason")


def factory_digest(factory: Callable[[], Callable] | None) -> str:
    """Tells two factories, and two settings of one, apart; a stage made with another factory is not reused."""
    return "default" if factory is None else hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def passthrough(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """A table that already holds vectors, brought to the same columns as ``featurise``."""
    ok = F.col(column).isNotNull()
    return df.withColumn(output, F.col(column).cast("array<float>")).withColumn(
        "status", F.when(ok, "ok").otherwise("error")
    ).withColumn("error", F.when(~ok, "null vector"))


def arrow_conf(batch_bytes: int = BATCH_BYTES) -> dict[str, str]:
    """Session setting that limits the Arrow batches of images by bytes, whatever the sizes of the images."""
    return {"spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)}
