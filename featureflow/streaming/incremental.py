"""The per-row steps of the featurise flow on a file stream.

Labelling, validation, featurisation and projection keep no state, so the batch functions apply unchanged.
New files are picked up once each (the checkpoint lists what was processed) and appended to Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from featureflow.functions import paths as P
from featureflow.sources.files import require_path


def stream_index(spark: SparkSession, root: str, extensions: Sequence[str] = P.IMAGE_EXTENSIONS) -> DataFrame:
    """Streaming image index ``path, label, modificationTime, length``; file contents are not read."""
    require_path(spark, root)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(root)
    return stream.filter(P.has_extension("path", extensions)).select(
        "path", P.label_from_path("path").alias("label"), "modificationTime", "length"
    )


def append_new(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append it, stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output)
    )
