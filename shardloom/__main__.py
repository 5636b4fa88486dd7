"""Runs from the command line: carving of an image, gaps of a folder of clips and their fillers, clusters of fingerprints."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import carve, gaps, order, report, similarity
from shardloom.sources import files


def whole_number(text: str) -> int:
    """A whole number in any of Python's notations: 20480, 0x5000, 0o17, 0b101."""
    return int(text, 0)


def run_carve(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Writes fragments and their manifest; returns their totals by category."""
    config = carve.CarveConfig(zero_run=args.threshold, min_bytes=args.min_size, oversize_bytes=int(args.oversize_kb * 1024), split_seconds=args.split_gap, unknown_apart=args.unknown_dir, region_start=args.region_start)
    found = carve.carve(spark, args.input, config)
    if not args.dry_run:
        carve.write_chunks(found, args.output)
        report.write_csv(carve.manifest(found), f"{args.output}/manifest")
    return carve.category_totals(found)


def run_gaps(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Writes the gap report and copies the merged sequence; returns the summary."""
    config = gaps.GapConfig(args.threshold, args.tolerance, args.min_coverage)
    read = lambda folder: files.clip_times(files.dat_files(spark, folder)).withColumn("pool", F.lit(0)).withColumnRenamed("path", "key")
    base = order.natural_order(read(args.baseline), "name").drop("_k")
    found = gaps.detect_gaps(base, ["pool"], ["place", "key"], "first_us", "last_us", round(args.threshold * gaps.US))
    found = found.select("pool", F.col("after_key.place").alias("gap_id"), F.col("after_key.key").alias("after"), "open_us", "close_us", "gap_us")
    spare = read(args.fill)
    matched = gaps.match_fillers(found, spare.filter("ts_ok"), ["pool"], config)
    merged = gaps.merged_sequence(base, matched, ["pool"], "place", "key")
    if not args.dry_run:
        report.write_workbook(report.gap_workbook(base, spare, matched, merged, ["pool"]), f"{args.output}/report")
        order.carry_out(order.merged_plan(merged, f"{args.output}/merged"))
    return gaps.gap_summary(matched, ["pool"]).drop("pool")


def run_cluster(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Writes the clusters of fingerprints (id, vec, confidence); returns their sizes."""
    labels = similarity.cluster(spark.read.parquet(args.prints), args.k)
    if not args.dry_run:
        labels.write.mode("overwrite").parquet(f"{args.output}/clusters")
    return labels.groupBy("cluster").count().orderBy("cluster")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shardloom", description=__doc__)
    runs = top.add_subparsers(dest="run", required=True)
    one = runs.add_parser("carve", help="fragments of a raw image")
    one.add_argument("--input", required=True)
    one.add_argument("--region-start", type=whole_number, default=carve.VIDEO_AT)
    one.add_argument("--threshold", type=whole_number, default=20)
    one.add_argument("--min-size", type=whole_number, default=512)
    one.add_argument("--oversize-kb", type=float, default=2500.0)
    one.add_argument("--split-gap", type=float, default=2.0)
    one.add_argument("--unknown-dir", action="store_true")
    one.set_defaults(do=run_carve)
    two = runs.add_parser("gaps", help="gaps of a recording and the spare fragments that fill them")
    two.add_argument("--baseline", required=True)
    two.add_argument("--fill", required=True)
    two.add_argument("--threshold", type=float, default=5.0)
    two.add_argument("--tolerance", type=float, default=3.0)
    two.add_argument("--min-coverage", type=float, default=0.70)
    two.set_defaults(do=run_gaps)
    three = runs.add_parser("cluster", help="clips by the sensor that made them")
    three.add_argument("--prints", required=True)
    three.add_argument("--k", type=whole_number, default=0)
    three.set_defaults(do=run_cluster)
    for each in (one, two, three):
        each.add_argument("--output", required=True)
        each.add_argument("--dry-run", action="store_true")
    return top


def main(words: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(words)
    args.do(spark or SparkSession.builder.appName("shardloom").getOrCreate(), args).show(100, truncate=False)


if __name__ == "__main__":
    main()
