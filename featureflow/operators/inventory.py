"""Inventory and integrity of stored datasets, and listings of file trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import paths as P
from featureflow.operators.quality import summary
from featureflow.sources.files import list_files, qualified, relative_path
from featureflow.sources.walk import footers, footers_of_contents, opens_in_tasks, walk

#: A path component that Spark does not read: hidden by a dot, or by an underscore unless it is a partition.
_HIDDEN = r"(^|/)(\.[^/]*|_[^/=]*)(/|$)"
_PARTITION = r"(?:^|/)([^/=]+)=[^/]*(?=/)"


def _below(spark: SparkSession, root: str) -> DataFrame:
    """The entries of the tree with ``key``, the path below the root, and ``file``, the last part of it."""
    return walk(spark, root).withColumn("key", relative_path(spark, root)).withColumn("file", P.base_name("path"))


def _datasets(spark: SparkSession, root: str, entries: DataFrame) -> DataFrame:
    """``dataset, readable, rows, columns, size_bytes, part_files`` from entries with their ``dataset``.

    Executors read the footers of all files that Spark would read; the driver sees none of them. Rows are null, and the
    dataset is not readable, if any such file is bad or there is none; columns are those of the first good file, and
    of its partition folders.
    """
    inside = F.expr("substring(key, length(dataset) + 2)")
    data = (~F.col("directory")) & (F.col("length") > 0) & ~inside.rlike(_HIDDEN)
    wanted = entries.where(data).select("path").distinct()  # datasets may lie in each other
    found = footers(wanted) if opens_in_tasks(qualified(spark, root)) else contents_read(spark, root, wanted)
    files = entries.join(found, "path", "left").withColumn("data", data)
    good = F.col("data") & F.col("rows").isNotNull()
    names = F.concat("columns", F.array_except(F.regexp_extract_all(inside, F.lit(_PARTITION), 1), F.col("columns")))
    return files.groupBy("dataset").agg(
        (F.coalesce(F.bool_and(F.when(F.col("data"), F.col("rows").isNotNull())), F.lit(False))).alias("readable"),
        F.sum("rows").alias("counted"),
        F.min_by(F.when(good, names), F.when(good, F.col("path"))).alias("columns"),
        F.coalesce(F.sum(F.when(~F.col("directory"), F.col("length"))), F.lit(0)).alias("size_bytes"),
        F.count_if(~F.col("directory") & _is_part("file")).alias("part_files"),
    ).select("dataset", "readable", F.when(F.col("readable"), F.col("counted")).alias("rows"), "columns", "size_bytes", "part_files")


def contents_read(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """``footers`` of files that only Spark's readers can open: tasks get their contents, so this reads all of them."""
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return footers_of_contents(content.join(files.select("path"), "path", "left_semi").select("path", "content"))


def dataset_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``*.parquet`` dataset at any depth: readable, rows, column count and names, bytes, part files.

    A dataset is a file or a folder with a name ending in .parquet, the outermost one. Tasks list the tree and read the
    footers; what the driver does depends neither on the number of datasets nor of files, but for a call for each level.
    """
    name = F.regexp_extract("key", r"^(.*?\.parquet)(/.*)?$", 1)
    entries = _below(spark, root).withColumn("dataset", name).where("dataset != ''")
    return _datasets(spark, root, entries).select("dataset", "readable", "rows", F.size("columns").alias("n_columns"), "columns", "size_bytes", "part_files")


def _is_part(file: str):
    return F.col(file).startswith("part-") & F.col(file).endswith(".parquet")


def integrity_check(spark: SparkSession, root: str, expected: Sequence[str]) -> DataFrame:
    """``path, exists, valid, rows`` for every expected dataset; valid means readable with at least one row.

    Any file or folder below the root may be expected, whatever its name.
    """
    wanted = spark.createDataFrame([(p,) for p in expected], "dataset string")
    parts = F.split("key", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    entries = _below(spark, root).withColumn("dataset", F.explode(prefixes)).join(F.broadcast(wanted), "dataset")
    found = _datasets(spark, root, entries).select("dataset", F.lit(True).alias("exists"), "rows")
    rows = F.coalesce("rows", F.lit(0))
    return wanted.join(found, "dataset", "left").select(
        F.col("dataset").alias("path"), F.coalesce("exists", F.lit(False)).alias("exists"), (rows > 0).alias("valid"), rows.alias("rows")
    )


def expected_against(inventory: DataFrame, expected: DataFrame) -> DataFrame:
    """The same check as a join, for an inventory that exists already (``dataset, rows``)."""
    found = inventory.select(F.col("dataset").alias("path"), "rows", F.lit(True).alias("exists"))
    joined = expected.join(found, "path", "left")
    return joined.select(
        "path",
        F.coalesce("exists", F.lit(False)).alias("exists"),
        (F.coalesce("rows", F.lit(0)) > 0).alias("valid"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def integrity_status(checked: DataFrame) -> DataFrame:
    """One row: expected, valid, OK or INCOMPLETE."""
    return checked.agg(F.count(F.lit(1)).alias("expected"), F.count_if("valid").alias("valid")).select(
        "expected", "valid", F.when(F.col("expected") == F.col("valid"), "OK").otherwise("INCOMPLETE").alias("status")
    )


def directory_size(spark: SparkSession, root: str) -> DataFrame:
    """One row: files, directories below the root, bytes; hidden and empty ones count."""
    return walk(spark, root).agg(
        F.count_if(~F.col("directory")).alias("files"),
        F.count_if("directory").alias("directories"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def part_files(spark: SparkSession, root: str) -> DataFrame:
    """Part files and checksum files per directory that holds files."""
    files = walk(spark, root).where("not directory").select(P.directory("path").alias("directory"), P.base_name("path").alias("file"))
    return files.groupBy("directory").agg(
        F.count_if(_is_part("file")).alias("part_files"), F.count_if(F.col("file").endswith(".crc")).alias("crc_files")
    )


def input_files(spark: SparkSession, root: str) -> DataFrame:
    """One row: number of files below the root."""
    return list_files(spark, root).agg(F.count(F.lit(1)).alias("files"))


def chart_files(spark: SparkSession, root: str, extensions: Sequence[str] = P.CHART_EXTENSIONS) -> DataFrame:
    """Image and document files with their size."""
    return list_files(spark, root).filter(P.has_extension("path", extensions)).select("path", "length")


def object_listing(spark: SparkSession, root: str) -> DataFrame:
    """``key, size`` with keys relative to the root."""
    return list_files(spark, root).select(relative_path(spark, root).alias("key"), F.col("length").alias("size"))


def classify_objects(listing: DataFrame, diagnostic: bool = False) -> DataFrame:
    """The listing with ``type``."""
    return listing.withColumn("type", P.diagnostic_type("key") if diagnostic else P.object_type("key"))


def listing_by_size(classified: DataFrame) -> DataFrame:
    """Largest objects first within their type."""
    return classified.orderBy("type", F.col("size").desc(), "key")


def object_types(classified: DataFrame) -> DataFrame:
    """Objects and bytes per type."""
    return classified.groupBy("type").agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes"))


def expected_results(listing: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Whether any key contains each expected text: one pass, one flag per expected text."""
    wide = listing.agg(*[F.coalesce(F.bool_or(F.col("key").contains(e)), F.lit(False)).alias(f"e{i}") for i, e in enumerate(expected)])
    cells = [F.struct(F.lit(e).alias("expected"), F.col(f"e{i}").alias("found")) for i, e in enumerate(expected)]
    return wide.select(F.inline(F.array(*cells)))


def inspect(spark: SparkSession, path: str, sample_size: int = 5) -> tuple[DataFrame, DataFrame]:
    """(column profile, sample) of one Parquet dataset."""
    return summary(spark.read.parquet(path), sample_size)
