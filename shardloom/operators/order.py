"""Order, names and copies: plans (src, dst) first, then the copying."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions import text as T
from shardloom.session import materialize, ship


def with_place(rows: DataFrame, order: list, name: str = "place") -> DataFrame:
    """rows with their place, from 1, in a total order, without gathering them in one task: they are sorted by ranges,
    and a row's place is the rows in the ranges before plus its place in its own. Counts of ranges are broadcast."""
    mark = F.monotonically_increasing_id()
    held = materialize(rows.orderBy(*order).withColumn("_m", mark), "sorted").withColumn("_p", F.shiftright("_m", 33))
    counts = held.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    place = F.col("_b") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return held.join(F.broadcast(before), "_p").withColumn(name, place.cast("long")).drop("_m", "_p", "_b")


def natural_order(rows: DataFrame, name: str, by: list[str] = ()) -> DataFrame:
    """rows with their place in natural order: digits as numbers, letters without case; equal keys by name."""
    keys = [T.natural_key(F.col(name)), F.col(name)]
    if not by:
        return with_place(rows, keys)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*keys)).cast("long"))


def unique_targets(plan: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A plan in which every dst occurs once: the second of equal ones, by src, gets _2 before its suffix, and so on.
    Names that existing (path) holds already are passed over, as if rows before had taken them."""
    n = F.row_number().over(Window.partitionBy("dst").orderBy("src"))
    folder = F.regexp_extract("dst", r"^(.*/)?[^/]*$", 1)
    renamed = F.concat(folder, T.stem_of(F.col("dst")), F.lit("_"), F.col("_n").cast("string"), T.suffix_of(F.col("dst")))
    placed = plan.withColumn("_n", n)
    if existing is not None:
        there, stem = existing.select("path").distinct(), T.stem_of(F.col("path"))
        number = F.nullif(F.regexp_extract(stem, r"_([1-9][0-9]{0,8})$", 1), F.lit("")).cast("int")
        bare = F.concat(F.regexp_extract("path", r"^(.*/)?[^/]*$", 1), F.regexp_replace(stem, "_[0-9]+$", ""), T.suffix_of(F.col("path")))
        held = there.select(F.col("path").alias("dst"), F.lit(1).alias("t")).unionByName(there.filter(number >= 2).select(bare.alias("dst"), number.alias("t")))
        taken = held.join(plan.select("dst").distinct(), "dst", "left_semi").groupBy("dst").agg(F.array_sort(F.collect_list("t")).alias("_t"))
        placed = placed.join(taken, "dst", "left").withColumn("_n", F.aggregate(F.coalesce("_t", F.array().cast("array<int>")), F.col("_n"), lambda m, t: F.when(t <= m, m + 1).otherwise(m))).drop("_t")
    return placed.withColumn("dst", F.when(F.col("_n") == 1, F.col("dst")).otherwise(renamed)).drop("_n")


def merged_plan(sequence: DataFrame, folder: str) -> DataFrame:
    """src, dst of a merged sequence (number, key as a path, source): number_stem_source.suffix."""
    return sequence.select(F.col("key").alias("src"), F.concat(F.lit(f"{folder}/"), "number", F.lit("_"), T.stem_of(F.col("key")), F.lit("_"), "source", T.suffix_of(F.col("key"))).alias("dst"))


def cluster_plan(ordered: DataFrame, folder: str) -> DataFrame:
    """src, dst of clustered clips (path, cluster, place): source_K/place_name, K from 1."""
    return ordered.select(F.col("path").alias("src"), F.concat(F.lit(f"{folder}/source_"), (F.col("cluster") + 1).cast("string"), F.lit("/"), F.lpad(F.col("place").cast("string"), 6, "0"), F.lit("_"), T.name_of(F.col("path"))).alias("dst"))


def carry_out(plan: DataFrame, move: bool = False, overwrite: bool = False) -> None:
    """Copy (or move) src to dst in the tasks that hold the rows; a dst that exists is left alone unless overwrite, so
    that a task can run again. unique_targets() with the files that exist gives each clip a name that is free."""
    ship(plan.sparkSession)

    def put(rows) -> None:
        from pyarrow import fs

        def of(path):
            return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

        for row in rows:
            (source, a), (target, b) = of(row["src"]), of(row["dst"])
            if not overwrite and target.get_file_info(b).type != fs.FileType.NotFound:
                continue
            target.create_dir(b.rpartition("/")[0], recursive=True)
            partial = f"{b}.partial"
            with source.open_input_stream(a) as data, target.open_output_stream(partial) as sink:
                while part := data.read(8 << 20):
                    sink.write(part)
            target.move(partial, b)
            if move:
                source.delete_file(a)

    plan.select("src", "dst").foreachPartition(put)


def concatenate(files: DataFrame, target: str) -> int:
    """Append files (path) to one in natural order of their names, and return its size. One file is one stream: the
    driver copies it in parts, and holds only paths."""
    from pyarrow import fs

    def of(path):
        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")

    named = files.select("path", T.natural_key(T.name_of(F.col("path"))).alias("_k")).orderBy("_k", "path")
    store, at = of(target)
    size = 0
    with store.open_output_stream(at) as sink:
        for row in named.select("path").toLocalIterator():
            source, where = of(row["path"].replace("file:/", "file:///", 1) if row["path"].startswith("file:/") and not row["path"].startswith("file://") else row["path"])
            with source.open_input_stream(where) as data:
                while part := data.read(8 << 20):
                    sink.write(part)
                    size += len(part)
    return size


def encode_command(source: str, target: str, program: str = "ffmpeg", codec: str = "libx265", crf: int = 23, preset: str = "medium", audio: str = "aac") -> list[str]:
    """The command line of an outside encoder; running it is the caller's."""
    return [program, "-y", "-i", source, "-c:v", codec, "-crf", str(crf), "-preset", preset, "-c:a", audio, target]
