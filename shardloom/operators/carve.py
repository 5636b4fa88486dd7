"""Carving of raw disk images: fragments between long runs of zero bytes, their records, category and codec.

Two passes. The first looks for zero runs in byte ranges that any task can read alone; only runs that touch a range's
edge are stitched by a window. Fragments follow from the runs by arithmetic, range by range. The second pass reads the fragments, in blocks,
and brings back markers and times, never bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions import binary as B
from shardloom.functions import text as T
from shardloom.session import ship

#: Fixed values of the disk format.
HEADER_AT, HEADER_SIZE, ENTRIES_AT, ENTRY_SIZE, VIDEO_AT = 0x5000, 0x4000, 0x40, 16, 0x80005000
CATEGORIES = ["old", "new", "unknown", "unclassified"]


@dataclass(frozen=True)
class CarveConfig:
    zero_run: int = 20
    min_bytes: int = 512
    oversize_bytes: int = 2500 * 1024
    split_seconds: float = 2.0
    unknown_apart: bool = True
    region_start: int = VIDEO_AT
    range_bytes: int = 64 << 20

    def __post_init__(self):
        if self.zero_run < 1:
            raise ValueError("a separator needs at least one zero byte")


def _open(path: str):
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store, at


def read_header(spark: SparkSession, image: str) -> DataFrame:
    """index, abs_offset, start_time, group_num of the header's block groups; no rows if the image is too short.

    The header is sixteen kilobytes; its bytes become a one-row table and are decoded by expressions.
    """
    store, at = _open(image)
    header = b""
    if store.get_file_info(at).size >= HEADER_AT + HEADER_SIZE:
        with store.open_input_file(at) as source:
            source.seek(HEADER_AT)
            header = source.read(HEADER_SIZE)
    return block_groups(spark.createDataFrame([(bytearray(header),)], "header binary"), "header")


def block_groups(headers: DataFrame, column: str) -> DataFrame:
    """Block groups of header bytes: entries of sixteen bytes that aren't all zero and whose time is plausible."""
    content = F.col(column)
    n = F.greatest(F.floor((F.length(content) - ENTRIES_AT) / ENTRY_SIZE).cast("int"), F.lit(0))
    entries = headers.select(content.alias("_h"), F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("index"))
    at = F.col("index") * ENTRY_SIZE + ENTRIES_AT
    raw = F.substr(F.col("_h"), at + 1, F.lit(ENTRY_SIZE))
    return entries.filter(raw != F.lit(b"\0" * ENTRY_SIZE)).select("index", (at + HEADER_AT).cast("long").alias("abs_offset"), B.u32_le(F.col("_h"), at + 4).alias("start_time"), B.u16_le(F.col("_h"), at + 12).alias("group_num")).filter(B.plausible_seconds(F.col("start_time")))


def header_offsets(headers: DataFrame, column: str) -> DataFrame:
    """The header's four places and sizes, which count units of 4 KiB."""
    names = ["video_data_off", "next_video_off", "available_mem", "total_mem"]
    return headers.select(*[F.shiftleft(B.u32_le(F.col(column), F.lit(8 * i)), 12).alias(name) for i, name in enumerate(names)])


def boundary_of(groups: DataFrame) -> DataFrame:
    """One row: the earliest start of a block group, in microseconds, or null."""
    return groups.agg((F.min("start_time") * 1_000_000).alias("boundary_us"))


def image_ranges(spark: SparkSession, images: list[str], config: CarveConfig) -> DataFrame:
    """path, size, start, stop of the byte ranges of each image's video region."""
    rows = []
    for image in images:
        store, at = _open(image)
        rows.append((image, store.get_file_info(at).size))
    files = spark.createDataFrame(rows, "path string, size long").filter(F.col("size") > config.region_start)
    last = F.floor((F.col("size") - 1 - config.region_start) / config.range_bytes).cast("long")
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_i"))
    start = F.col("_i") * config.range_bytes + config.region_start
    return ranges.select("path", "size", start.alias("start"), F.least(start + config.range_bytes, F.col("size")).alias("stop")).repartition("path", "start")


def zero_runs(ranges: DataFrame, zero_run: int) -> DataFrame:
    """path, size, start, length of maximal zero runs of at least zero_run bytes, over all ranges of an image.

    At most two runs of a range touch its edges; these alone are gathered by image, the others are whole as they are.
    """
    ship(ranges.sparkSession)
    out = pa.schema([("path", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("edge", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, at = _open(path)
                with store.open_input_file(at) as source:
                    source.seek(start)
                    data = np.frombuffer(source.read(stop - start), np.uint8)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], data == 0, [False]]).astype(np.int8)))
                begin, end = edges[::2], edges[1::2]
                edge = (begin == 0) | (end == len(data))
                keep = (end - begin >= zero_run) | edge
                begin, end, edge = begin[keep], end[keep], edge[keep]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(begin)), pa.array(np.full(len(begin), size)), pa.array(begin + start), pa.array(end - begin), pa.array(edge)], schema=out)

    parts = ranges.select("path", "size", "start", "stop").mapInArrow(run, "path string, size long, start long, length long, edge boolean")
    by = Window.partitionBy("path").orderBy("start")
    edges = parts.filter("edge").withColumn("_new", (F.coalesce(F.lag(F.col("start") + F.col("length")).over(by), F.lit(-1)) != F.col("start")).cast("int")).withColumn("_island", F.sum("_new").over(by))
    stitched = edges.groupBy("path", "_island").agg(F.max("size").alias("size"), F.min("start").alias("start"), F.sum("length").alias("length")).filter(F.col("length") >= zero_run).drop("_island")
    return parts.filter("not edge").select("path", "size", "start", "length").unionByName(stitched)


def fragments(ranges: DataFrame, config: CarveConfig) -> DataFrame:
    """path, start, stop of the stretches between separators, as splitting at every zero_run zero bytes would give.

    A run of L zeros holds L div zero_run separators from its start; what is left over begins the next fragment.
    """
    runs = zero_runs(ranges, config.zero_run)
    after = runs.select("path", "size", (F.col("start") + F.col("length") - F.pmod(F.col("length"), F.lit(config.zero_run))).alias("start"))
    ends = runs.select("path", F.col("start").alias("stop"))
    starts = ranges.groupBy("path").agg(F.max("size").alias("size")).select("path", "size", F.lit(config.region_start).cast("long").alias("start")).unionByName(after)
    marks = starts.select("path", "size", F.col("start").alias("_at"), F.lit(0).alias("_kind")).unionByName(ends.select("path", F.lit(None).cast("long").alias("size"), F.col("stop").alias("_at"), F.lit(1).alias("_kind")))
    # starts and stops alternate, so a start's stop is the next mark; beyond its stretch of the image, the first of a later one
    marks = marks.withColumn("_part", F.floor(F.col("_at") / config.range_bytes))
    following = F.lead("_at").over(Window.partitionBy("path", "_part").orderBy("_at", "_kind"))
    firsts = marks.groupBy("path", "_part").agg(F.min("_at").alias("_first"))
    later = firsts.select("path", "_part", F.lead("_first").over(Window.partitionBy("path").orderBy("_part")).alias("_later"))
    found = marks.withColumn("_next", following).filter("_kind = 0").join(later, ["path", "_part"])
    return found.select("path", F.col("_at").alias("start"), F.coalesce("_next", "_later", "size").alias("stop")).filter(F.col("stop") - F.col("start") >= config.min_bytes)


_MARKS = "array<struct<pos:bigint,codec:int,ts_us:bigint>>"


def scan_markers(found: DataFrame, config: CarveConfig, window: B.Window = B.WIDE) -> DataFrame:
    """path, start, stop, marks: every marker of each fragment (pos from the fragment's start, 264 or 265, its time or
    null). Long fragments are read in blocks by several tasks."""
    ship(found.sparkSession)
    block = config.range_bytes
    blocks = found.select("path", "start", "stop", F.explode(F.sequence(F.col("start"), F.col("stop") - 1, F.lit(block).cast("long"))).alias("at")).repartition("path", "at")
    out = pa.schema([("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("pos", pa.int64()), ("codec", pa.int32()), ("ts_us", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = _open(path)
                with store.open_input_file(name) as source:
                    source.seek(at)
                    raw = source.read(min(block + B.RECORD_SIZE, stop - at))
                data = np.frombuffer(raw, np.uint8)
                if len(data) < 3:
                    continue
                hits = np.flatnonzero(((data[:-2] == 0x80) | (data[:-2] == 0x81)) & (data[1:-1] == 1) & (data[2:] == 0))
                hits = hits[hits < block]
                whole = hits + B.RECORD_SIZE <= len(data)
                us = np.zeros(len(hits), np.uint64)
                for i in range(8):
                    us[whole] |= data[hits[whole] + B.TIME_AT + i].astype(np.uint64) << np.uint64(8 * i)
                good = whole & (us >= window.least) & (us <= window.most)
                n = len(hits)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(np.full(n, start)), pa.array(np.full(n, stop)), pa.array(hits + (at - start)), pa.array(np.where(data[hits] == 0x80, 264, 265).astype(np.int32)), pa.array(np.where(good, us, 0).astype(np.int64), mask=~good)], schema=out)

    marks = blocks.mapInArrow(run, "path string, start long, stop long, pos long, codec int, ts_us long")
    gathered = marks.groupBy("path", "start", "stop").agg(F.array_sort(F.collect_list(F.struct("pos", "codec", "ts_us"))).alias("marks"))
    return found.join(gathered, ["path", "start", "stop"], "left").withColumn("marks", F.coalesce("marks", F.array().cast(_MARKS)))


def split_places(size: int, pos: list[int], ts_us: list[int | None], oversize: int, seconds: float) -> list[tuple[int, int]]:
    """Parts (from, to) of a fragment: while a part is oversize, it is cut at the marker after its largest step in time.

    A record whose time reaches beyond its part's end isn't one of the part's. Steps are in seconds as floating-point
    numbers; the first of equal ones counts; fewer than four records, or no step of so many seconds, keep a part whole.
    """
    timed = np.array([t is not None and t >= 0 for t in ts_us], bool)
    at, times = np.asarray(pos, np.int64)[timed], np.array([t for t, good in zip(ts_us, timed, strict=True) if good], np.int64) / 1e6
    steps = np.abs(np.diff(times))
    parts, todo = [], [(0, size)]
    while todo:
        lo, hi = todo.pop()
        place = None
        if hi - lo > oversize:
            a, b = np.searchsorted(at, [lo, hi - B.RECORD_SIZE + 1])
            if b - a >= 4:
                step = int(steps[a : b - 1].argmax())
                if steps[a + step] >= seconds and steps[a + step] > 0:
                    place = int(at[a + step + 1])
        if place is not None and lo < place < hi:
            todo += [(place, hi), (lo, place)]
        else:
            parts.append((lo, hi))
    return parts


def split_oversized(found: DataFrame, config: CarveConfig) -> DataFrame:
    """found with oversize fragments cut at their largest steps in time, and parts below the least size dropped."""
    ship(found.sparkSession)
    rest = [f for f in found.columns if f not in ("start", "stop", "marks")]
    oversize, seconds = config.oversize_bytes, config.split_seconds

    @F.pandas_udf("array<struct<lo:bigint,hi:bigint>>")
    def places(sizes: pd.Series, pos: pd.Series, ts_us: pd.Series) -> pd.Series:
        return pd.Series([[{"lo": lo, "hi": hi} for lo, hi in split_places(*x, oversize, seconds)] for x in zip(sizes.tolist(), pos, ts_us, strict=True)], dtype=object)

    each = lambda f: F.transform("marks", f)
    size = F.col("stop") - F.col("start")
    small = found.filter(size <= oversize)
    large = found.filter(size > oversize).withColumn("_p", F.explode(places(size, each(lambda m: m["pos"]), each(lambda m: F.coalesce(m["ts_us"], F.lit(-1).cast("long"))))))
    inside = F.transform(F.filter("marks", lambda m: (m["pos"] >= F.col("_p.lo")) & (m["pos"] + 3 <= F.col("_p.hi"))), lambda m: F.struct((m["pos"] - F.col("_p.lo")).alias("pos"), m["codec"].alias("codec"), F.when(m["pos"] + B.RECORD_SIZE <= F.col("_p.hi"), m["ts_us"]).alias("ts_us")))
    parts = large.select(*rest, (F.col("start") + F.col("_p.lo")).alias("start"), (F.col("start") + F.col("_p.hi")).alias("stop"), inside.alias("marks"))
    return small.select(*rest, "start", "stop", "marks").unionByName(parts).filter(F.col("stop") - F.col("start") >= config.min_bytes)


def classified(times: Column, boundary: Column, unknown_apart: bool = True) -> Column:
    """struct<category, reason, ts_count, ts_in_new, ts_ratio, first_us, median_us> of times in order of offset.

    The median is the middle one by place, not by value.
    """
    n = F.size(times)
    in_new = F.size(F.filter(times, lambda t: t >= boundary))
    middle = F.get(times, F.floor(n / 2).cast("int"))
    told = boundary.isNotNull() & (n > 0)
    none = F.lit("unknown" if unknown_apart else "old")
    category = F.when(boundary.isNull(), "unclassified").when(n == 0, none).when(middle >= boundary, "new").otherwise("old")
    reason = (
        F.when(boundary.isNull(), "no valid header boundary; old/new separation disabled")
        .when(n == 0, "no timestamps")
        .when(middle >= boundary, F.concat(F.lit("median "), T.iso_time(middle), F.lit(" >= header boundary "), T.iso_time(boundary), F.lit(" ("), in_new.cast("string"), F.lit("/"), n.cast("string"), F.lit(" in new session)")))
        .otherwise(F.concat(F.lit("median "), T.iso_time(middle), F.lit(" < header boundary "), T.iso_time(boundary)))
    )
    return F.struct(
        category.alias("category"), reason.alias("reason"), n.cast("long").alias("ts_count"), F.when(told, in_new).otherwise(0).cast("long").alias("ts_in_new"),
        F.when(told, in_new / n).otherwise(0.0).alias("ts_ratio"), F.get(times, F.lit(0)).alias("first_us"), middle.alias("median_us"),
    )


def described(found: DataFrame, boundary: Column, config: CarveConfig) -> DataFrame:
    """The manifest's columns for fragments with marks: category, reason, counts, times, codec, number and file name."""
    times = F.transform(F.filter("marks", lambda m: m["ts_us"].isNotNull()), lambda m: m["ts_us"])
    counts = [F.size(F.filter(F.transform("marks", lambda m: m["codec"]), lambda x: x == F.lit(kind))).cast("long") for kind in (264, 265)]
    rows = found.select("path", F.col("start").alias("abs_start"), F.col("stop").alias("abs_end"), classified(times, boundary, config.unknown_apart).alias("c"), counts[0].alias("h264_count"), counts[1].alias("h265_count"))
    rows = rows.select("path", "abs_start", "abs_end", "c.*", B.codec_of(F.col("h264_count"), F.col("h265_count")).alias("codec"), "h264_count", "h265_count")
    number = F.row_number().over(Window.partitionBy("path", "category").orderBy("abs_start"))
    return rows.withColumn("number", number).withColumn("filename", F.concat("category", F.lit("_"), "codec", F.lit("_chunk_"), F.when(F.col("number") > 9999, F.col("number").cast("string")).otherwise(F.lpad(F.col("number").cast("string"), 4, "0")), F.lit(".dat")))


def carve(spark: SparkSession, image: str, config: CarveConfig = CarveConfig()) -> DataFrame:  # noqa: B008
    """One image's fragments, described; bytes stay in the image."""
    boundary = boundary_of(read_header(spark, image)).first()[0]
    ranges = image_ranges(spark, [image], config)
    found = split_oversized(scan_markers(fragments(ranges, config), config), config)
    return described(found, F.lit(boundary).cast("long"), config)


def manifest(described_: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The thirteen columns of the manifest as text and numbers, behind others that are kept."""
    return described_.select(
        *keep,
        "category", "filename", B.hex_offset(F.col("abs_start")).alias("abs_start_hex"), B.hex_offset(F.col("abs_end")).alias("abs_end_hex"), (F.col("abs_end") - F.col("abs_start")).alias("size_bytes"), "reason",
        F.col("ts_count").alias("timestamp_count"), F.col("ts_in_new").alias("timestamps_in_new_session"), T.iso_time(F.col("first_us")).alias("first_timestamp_utc"), T.iso_time(F.col("median_us")).alias("median_timestamp_utc"),
        "codec", F.col("h264_count").alias("h264_marker_count"), F.col("h265_count").alias("h265_marker_count"),
    )


def category_totals(described_: DataFrame) -> DataFrame:
    """Fragments and bytes of every category, those without any included."""
    spark = described_.sparkSession
    every = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    sums = described_.groupBy("category").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.col("abs_end") - F.col("abs_start")).alias("bytes"))
    return every.join(F.broadcast(sums), "category", "left").select("category", F.coalesce("chunks", F.lit(0)).alias("chunks"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def write_chunks(described_: DataFrame, folder: str) -> None:
    """Write every fragment's bytes to folder/category/codec/filename, from the tasks that hold its row."""
    ship(described_.sparkSession)

    def put(rows) -> None:
        target, root = _open(folder)
        for row in rows:
            source, at = _open(row["path"])
            where = f"{root}/{row['category']}_video/{row['codec']}"
            target.create_dir(where, recursive=True)
            with source.open_input_file(at) as data, target.open_output_stream(f"{where}/{row['filename']}") as sink:
                data.seek(row["abs_start"])
                left = row["abs_end"] - row["abs_start"]
                while left:
                    part = data.read(min(left, 8 << 20))
                    sink.write(part)
                    left -= len(part)

    described_.select("path", "category", "codec", "filename", "abs_start", "abs_end").foreachPartition(put)
