"""Labels and classes read off paths, URLs and object keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Image extensions, the label pattern, the class names by id, and the two object-type rule lists.
IMAGE_EXTENSIONS = ("png", "jpg", "jpeg")
CHART_EXTENSIONS = ("png", "jpg", "svg", "pdf")
LABEL_PATTERN = r"Test/([^/]+)/"
CLASS_NAMES = ("Apple_Red", "Banana", "Orange", "Strawberry", "Grape_White")
LISTING_TYPES = (("results", "results/"), ("cache", "cache/"), ("plots", "plots/"))
DIAGNOSTIC_TYPES = (("results", "results/"), ("cache", "cache/"), ("plots", "plots/"), ("test", "test/"))
RESULT_MARKER = "final_results"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_from_path(path: str | Column) -> Column:
    """Parent directory name: the second-to-last ``/`` segment, null when the path has fewer than two."""
    return F.try_element_at(F.split(_col(path), "/"), F.lit(-2))


def label_from_pattern(path: str | Column, pattern: str = LABEL_PATTERN) -> Column:
    """Group 1 of ``pattern``; empty string when it does not match."""
    return F.regexp_extract(_col(path), pattern, 1)


def labelled_by_pattern(df: DataFrame, path: str, label: str, pattern: str = LABEL_PATTERN) -> DataFrame:
    """Keep the rows whose path matches ``pattern`` and add the captured label."""
    return df.withColumn(label, label_from_pattern(path, pattern)).filter(F.col(label) != "")


def has_extension(path: str | Column, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> Column:
    """Case-insensitive file extension test."""
    return _col(path).rlike(r"(?i)\.(" + "|".join(extensions) + r")$")


def class_name(class_id: str | Column, names: Sequence[str] = CLASS_NAMES) -> Column:
    """CASE from class id to name; the last name is the otherwise branch."""
    class_id = _col(class_id)
    case = F
    for i, name in enumerate(names[:-1]):
        case = case.when(class_id == i, name)
    return case.otherwise(names[-1])


def object_type(
    key: str | Column,
    prefixes: Sequence[tuple[str, str]] = LISTING_TYPES,
    other: str = "test",
    marker: tuple[str, str] | None = None,
) -> Column:
    """Type of an object key by its first matching prefix.

    ``marker=(type, text)`` also gives ``type`` to every key containing ``text``; it wins over the prefixes.
    The defaults are the listing variant; ``diagnostic_type`` is the other one.
    """
    key = _col(key)
    case = F
    if marker is not None:
        case = case.when(key.contains(marker[1]), marker[0])
    for name, prefix in prefixes:
        case = case.when(key.startswith(prefix), name)
    return case.otherwise(other)


def diagnostic_type(key: str | Column) -> Column:
    return object_type(key, DIAGNOSTIC_TYPES, other="other", marker=("results", RESULT_MARKER))


def file_uri(origin: str | Column) -> Column:
    """Image-source ``origin`` (URL-encoded, ``file:///``) in the spelling of the binaryFile ``path``."""
    decoded = F.url_decode(F.regexp_replace(_col(origin), r"\+", "%2B"))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def same_uri(path: str | Column) -> Column:
    """A local path in the spelling of the binaryFile ``path``, so that paths from elsewhere compare."""
    return F.regexp_replace(_col(path), "^file:/+|^/+", "file:/")


def directory(path: str | Column) -> Column:
    return F.regexp_replace(_col(path), "/[^/]*$", "")


def base_name(path: str | Column) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)
