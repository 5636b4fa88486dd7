"""New clips as a stream: each file is read once, however often the query is started again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardloom.sources.files import append_cache


def new_clips(spark: SparkSession, folder: str) -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.[dD][aA][tT]").load(folder)


def keep_fingerprints(clips: DataFrame, make: Callable[[DataFrame], DataFrame], cache: str, checkpoint: str):
    """Run make over every batch of new clips and append what it gives to the cache."""
    return clips.writeStream.foreachBatch(lambda batch, _: append_cache(make(batch), cache)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
