"""Folders of clips as tables, and the cache of fingerprints that makes runs resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions import binary as B
from shardloom.functions import text as T

#: Suffixes of video files.
VIDEO_SUFFIXES = ["mp4", "avi", "mov", "mkv", "wmv", "flv", "mpeg", "mpg", "dat"]


def _with_empty(read: DataFrame, kept: str = "true") -> DataFrame:
    """read (path, modificationTime, length, content), with the empty files of its folder that kept holds for: Spark's
    reader of whole files passes them over. Their modificationTime is null."""
    spark = read.sparkSession
    names = spark.createDataFrame([(name,) for name in read.inputFiles()], "value string")  # Spark's own listing, which the driver has anyway
    plain = F.regexp_replace(F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    listed = names.select(plain.alias("path")).filter(F.expr(kept))
    empty = listed.join(read.select("path"), "path", "left_anti")
    return read.unionByName(empty.select("path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))


def dat_files(spark: SparkSession, folder: str, recursive: bool = False, any_case: bool = True) -> DataFrame:
    """path, modificationTime, length, content of .dat files, empty ones included; content is read only where it is used."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[dD][aA][tT]" if any_case else "*.dat")
    read = reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return _with_empty(read, "lower(path) like '%.dat'" if any_case else "path like '%.dat'")


def video_files(spark: SparkSession, folder: str, suffixes: list[str] = VIDEO_SUFFIXES) -> DataFrame:
    """Video files by suffix in any case, empty ones included, with seq from 1 in order of path."""
    from shardloom.operators.order import with_place

    found = _with_empty(spark.read.format("binaryFile").load(folder)).filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(suffixes))
    places = with_place(found.select("path"), ["path"], "seq")
    return found.join(places, "path")


def existing_files(spark: SparkSession, folder: str) -> DataFrame:
    """path of every file below a folder, as folder/...; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return spark.createDataFrame([], "path string")
    plain = F.regexp_replace("path", "^file:/+", "/") if folder.startswith("/") else F.col("path")
    return _with_empty(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)).select(plain.alias("path"))


def clip_times(files: DataFrame, window: B.Window = B.NARROW) -> DataFrame:
    """path, name, first_us, last_us (least and largest time in the file), ts_method, ts_ok, duration_s."""
    found = B.records(F.col("content"), window)
    rows = files.select("path", T.name_of(F.col("path")).alias("name"), found.alias("r"))
    rows = rows.select("path", "name", B.least_time(F.col("r")).alias("first_us"), B.most_time(F.col("r")).alias("last_us"))
    ok = F.col("first_us").isNotNull() & F.col("last_us").isNotNull()
    return rows.withColumns({"ts_method": F.when(ok, "known_markers").otherwise("none"), "ts_ok": ok, "duration_s": F.when(ok, (F.col("last_us") - F.col("first_us")) / 1e6).otherwise(0.0)})


def cache_key(path):
    return F.sha1(path.cast("binary"))


def read_cache(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)
    return spark.read.schema(schema).parquet(folder) if there else spark.createDataFrame([], schema)


def not_cached(clips: DataFrame, cache: DataFrame) -> DataFrame:
    """Clips whose key the cache doesn't have."""
    return clips.withColumn("key", cache_key(F.col("path"))).join(cache.select("key"), "key", "left_anti")


def append_cache(prints: DataFrame, folder: str) -> None:
    """Add fingerprints to the cache; those without a vector aren't kept, so that they are tried again."""
    prints.filter("vec is not null").withColumn("key", cache_key(F.col("path"))).write.mode("append").parquet(folder)


def with_cached(clips: DataFrame, cache: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new fingerprints of the clips at hand; cached clips that aren't in the input stay out."""
    old = cache.join(clips.select(cache_key(F.col("path")).alias("key")), "key", "left_semi").drop("key")
    return old.unionByName(new.select(*old.columns))
