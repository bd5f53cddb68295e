"""Stages that follow their source files: only what is new or changed is computed, what is gone goes.

A stage is a folder of batches, ``batch=<id>``, each a Parquet dataset that is written once, with a manifest of the
source files (path, length, modification time) it came from. A commit file names the live batches; it is written
last and never changed, so a run that fails leaves the stage as it was, and of two writers at a time the second fails.
An update compares the listing with the manifests, computes the files that differ, and copies the rows of batches
that lost a file, or are too many, into the new batch; no other batch is touched, and reading needs no join.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import paths as P
from featureflow.sources.files import hadoop_path
from featureflow.sources.store import fingerprint, read_text, write_text

#: Live batches of a stage; beyond that the smallest are merged into the next one.
MOST_BATCHES = 16

_SAME = ["file", "length", "mtime"]


def _commits(spark: SparkSession, path: str) -> list[str]:
    """Names of the commit files, the last first."""
    fs, folder = hadoop_path(spark, f"{path}/_commits")
    names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((n for n in names if re.fullmatch(r"\d{8}\.json", n)), reverse=True)


def current(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The last complete commit of a stage: version, fingerprint, schema, batches; None without any."""
    for name in _commits(spark, path):
        try:
            return json.loads(read_text(spark, f"{path}/_commits/{name}")) | {"version": int(name[:8])}
        except ValueError:  # a writer died inside it
            continue
    return None


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a stage; a plain Parquet dataset is read as it is."""
    entry = current(spark, path)
    return spark.read.parquet(path) if entry is None else _rows(spark, path, entry, entry["batches"])


def _rows(spark: SparkSession, path: str, entry: dict[str, Any], batches: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/batch={b}" for b in batches])


def _manifest(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    schema = "file string, length long, mtime long, batch string"
    return spark.read.schema(schema).parquet(*[f"{path}/_manifest/{b}" for b in batches]) if batches else spark.createDataFrame([], schema)


def _state(facts: DataFrame, manifest: DataFrame) -> tuple[int, dict[str, tuple[int, int]]]:
    """(files that no batch has as they are, batch -> (its files, those of them that are still the same))."""
    same = F.when(F.col("f.length").eqNullSafe(F.col("m.length")) & F.col("f.mtime").eqNullSafe(F.col("m.mtime")) & F.col("f.file").isNotNull(), 1).otherwise(0)
    both = facts.alias("f").join(manifest.alias("m"), F.col("f.file") == F.col("m.file"), "full_outer")
    rows = both.select("batch", same.alias("same"), F.col("f.file").isNotNull().cast("int").alias("here"))
    found = {r["batch"]: r for r in rows.groupBy("batch").agg(F.count("*").alias("n"), F.sum("same").alias("same"), F.sum("here").alias("here")).collect()}
    todo = sum(r["here"] - r["same"] for r in found.values())
    return todo, {b: (r["n"], r["same"]) for b, r in found.items() if b is not None}


def follow(
    spark: SparkSession,
    path: str,
    listing: DataFrame,
    compute: Callable[[DataFrame | None], DataFrame],
    params: dict[str, Any] | None = None,
    refresh: bool = False,
    most: int = MOST_BATCHES,
) -> DataFrame:
    """The stage at ``path`` for the files of ``listing`` (path, length, modificationTime and others), brought up to date.

    ``compute`` gets the rows of the listing that have to be computed, or None for all, and returns rows with a ``path``;
    rows of a file that is gone or changed are found by it. Other parameters, or ``refresh``, compute everything again.
    A path should be listed once. Null lengths and times (files that are not there) compare as equal.
    """
    wanted = fingerprint(params or {})
    version = int(next(iter(_commits(spark, path)), "0")[:8]) + 1
    last = current(spark, path)
    old = None if refresh or last is None or last["fingerprint"] != wanted else last
    facts = listing.select(P.same_uri("path").alias("file"), F.col("length").cast("long").alias("length"), F.unix_micros("modificationTime").alias("mtime"))
    if old is None:
        fresh, kept, batches = compute(None), [], {}
        fields, live = facts, None
    else:
        manifest = _manifest(spark, path, old["batches"])
        todo, batches = _state(facts, manifest)
        touched = {b for b, (n, same) in batches.items() if same < n}
        if not todo and not touched:
            return _rows(spark, path, old, old["batches"])
        whole = sorted((b for b in batches if b not in touched), key=lambda b: (batches[b][0], b))
        touched |= set(whole[: max(0, len(whole) + 1 - most)])
        kept = [b for b in old["batches"] if b not in touched]
        done = manifest.select(*(F.col(c).alias(f"__{c}") for c in _SAME))
        differs = [F.col(f"__{c}").eqNullSafe(F.col(c)) for c in ("length", "mtime")]
        changed = facts.join(done, (F.col("__file") == F.col("file")) & differs[0] & differs[1], "left_anti")
        live = facts.join(manifest.where(F.col("batch").isin(sorted(touched))), _on(facts, manifest), "left_semi")
        rest = _rows(spark, path, old, sorted(touched))
        rest = rest.join(live.select(F.col("file").alias("__file")), P.same_uri("path") == F.col("__file"), "left_semi")
        if todo:
            part = listing.join(changed.select(F.col("file").alias("__file")), P.same_uri("path") == F.col("__file"), "left_semi")
            fresh = compute(part).unionByName(rest)
        else:
            fresh = rest
        fields = changed.unionByName(live)
    new = uuid.uuid4().hex
    fresh.write.parquet(f"{path}/batch={new}")
    fields.select(*_SAME, F.lit(new).alias("batch")).write.parquet(f"{path}/_manifest/{new}")
    entry = {"fingerprint": wanted, "schema": fresh.schema.jsonValue(), "batches": [*kept, new]}
    write_text(spark, f"{path}/_commits/{version:08d}.json", json.dumps(entry), overwrite=False)
    _clean(spark, path, entry["batches"])
    return _rows(spark, path, entry, entry["batches"])


def _on(facts: DataFrame, manifest: DataFrame):
    return (facts["file"] == manifest["file"]) & facts["length"].eqNullSafe(manifest["length"]) & facts["mtime"].eqNullSafe(manifest["mtime"])


def _clean(spark: SparkSession, path: str, live: list[str]) -> None:
    """Deletes what the last commit does not name, and all commits but the last two."""
    fs, root = hadoop_path(spark, path)
    wanted = {f"batch={b}" for b in live}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith("_") and name not in wanted:
            fs.delete(status.getPath(), True)
    for folder, keep in (("_manifest", set(live)), ("_commits", None)):
        _, place = hadoop_path(spark, f"{path}/{folder}")
        inside = sorted((status.getPath() for status in fs.listStatus(place)), key=lambda p: p.getName())
        for file in inside[:-2] if keep is None else [p for p in inside if p.getName() not in keep]:
            fs.delete(file, True)
