"""File-metadata scans, the image index and image decoding."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import paths as P
from featureflow.operators.sampling import hash_sample
from featureflow.sources.settle import join_classes, settle_classes


#: Files that are named to the reader one by one.
FEW_FILES = 1000


def hadoop_path(spark: SparkSession, uri: str):
    """(FileSystem, Path) of a URI, so existence tests work for every scheme Spark can read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = hadoop_path(spark, uri)
    return fs.exists(path)


def require_path(spark: SparkSession, uri: str) -> None:
    if not exists(spark, uri):
        raise FileNotFoundError(f"no such directory: {uri}")


def qualified(spark: SparkSession, root: str) -> str:
    """Root URI in the spelling of the binaryFile ``path`` column."""
    fs, path = hadoop_path(spark, root)
    return fs.makeQualified(path).toString().rstrip("/")


def relative_path(spark: SparkSession, root: str, path: str = "path") -> Column:
    """Path below ``root``, without a leading slash."""
    return F.substring(path, len(qualified(spark, root)) + 2, 1 << 30)


def scan_binary(spark: SparkSession, root: str, glob: str | None = "*.jpg") -> DataFrame:
    """Recursive binaryFile scan, one row per file: path, modificationTime, length, content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader if glob is None else reader.option("pathGlobFilter", glob)).load(root)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """File metadata only. Without ``content`` in the projection no file is opened.

    As in every Spark file source, empty files and names starting with ``_`` or ``.`` do not appear.
    """
    require_path(spark, root)
    return scan_binary(spark, root, None).select("path", "modificationTime", "length")


def image_index(
    spark: SparkSession,
    root: str,
    sample_size: int | None = None,
    extensions: Sequence[str] = P.IMAGE_EXTENSIONS,
    seed: int = 42,
) -> DataFrame:
    """Index ``path, label`` of a class-per-directory image set.

    ``sample_size`` keeps that many files in seeded hash order over all classes, by a threshold on the hash that counts
    find: the sample is the same on every run, covers the classes in proportion, and no task or driver holds it.
    """
    require_path(spark, root)
    files = list_files(spark, root)
    index = files.filter(_one_below(spark, root)).filter(P.has_extension("path", extensions)).select("path", P.label_from_path("path").alias("label"))
    if sample_size is not None:
        index = hash_sample(index, "path", sample_size, seed)
    return index


def _one_below(spark: SparkSession, root: str) -> Column:
    """Whether ``path`` lies in a class directory directly below the root."""
    return F.size(F.split(relative_path(spark, root), "/")) == 2


def indexed_images(spark: SparkSession, root: str, index: DataFrame | None = None) -> DataFrame:
    """The decoded images of an index, or of all that ``image_index`` lists below the root.

    The rule of the index is a filter on the path. Another index is sent to the scan if it is small, as a sample is;
    only an index too large for that is joined by a shuffle. Of a listing (an index with ``length``, null for files
    that are not there) that names few files, only those are read.
    """
    if index is not None and "length" in index.columns:
        here = index.filter(F.col("length").isNotNull() & P.has_extension("path"))
        few = [r["path"] for r in here.select("path").limit(FEW_FILES + 1).collect()]
        if len(few) <= FEW_FILES and not any(c in path for path in few for c in "{}[]*?\\"):
            return scan_images(spark, root, only=few)
    images = scan_images(spark, root)
    if index is None:
        return images.filter(_one_below(spark, root))
    wanted = settle_classes(index.select(P.same_uri("path").alias("path")))
    return join_classes(images, wanted, "path", "left_semi")


def scan_images(
    spark: SparkSession, root: str, extensions: Sequence[str] = P.IMAGE_EXTENSIONS, drop_invalid: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Decoded images: ``path, label, image`` with ``image = struct(height, width, nChannels, mode, data)``.

    Decoding runs in the scan. A file that cannot be decoded has height -1 (or no row with ``drop_invalid``).
    Files are packed into scan tasks by size, so no exchange has to move pixels. ``only``: these files, not all below
    the root.
    """
    require_path(spark, root)
    glob = "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in e) for e in extensions) + "}"
    raw = (
        spark.read.format("image")
        .option("dropInvalid", drop_invalid)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(list(only) or root if only is not None else root)
    )
    if only is not None and not only:
        raw = raw.limit(0)
    path = P.file_uri("image.origin")
    return raw.select(path.alias("path"), P.label_from_path(path).alias("label"), "image").select(
        "path",
        "label",
        F.struct("image.height", "image.width", "image.nChannels", "image.mode", "image.data").alias("image"),
    )


def scan_conf(average_bytes: int, files_per_task: int = 2000) -> dict[str, str]:
    """Session settings that pack ``files_per_task`` small files into one scan task.

    The default open cost (4 MB per file) puts only about 32 small images into a task, which at a billion
    files means tens of millions of tasks.
    """
    open_cost = max(4096, min(4 << 20, average_bytes))
    return {
        "spark.sql.files.openCostInBytes": str(open_cost),
        "spark.sql.files.maxPartitionBytes": str((average_bytes + open_cost) * files_per_task),
    }


def readable(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet dataset, or None when its schema cannot be read."""
    try:
        return spark.read.parquet(path)
    except (PySparkException, Py4JJavaError):
        return None
