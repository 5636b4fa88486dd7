"""Report tables and their text and CSV forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions import text as T


def gap_report(matched: DataFrame) -> DataFrame:
    """matched gaps with their status and times as texts, largest first."""
    first, last = F.array_min(F.transform("fillers", lambda f: f["first_us"])), F.array_max(F.transform("fillers", lambda f: f["last_us"]))
    status = T.gap_status(F.size("fillers"), F.col("partial"), F.col("coverage"), (first - F.col("open_us")) / 1e6, (F.col("close_us") - last) / 1e6)
    return matched.withColumns({"status": status, "gap": T.report_duration(F.col("gap_us") / 1e6), "from": T.report_time(F.timestamp_micros("open_us")), "to": T.report_time(F.timestamp_micros("close_us"))}).orderBy(F.desc("gap_us"), "gap_id")


def confidence_lines(clips: DataFrame, low: float = 0.35) -> DataFrame:
    """value: one fixed-width line a clip, with flags for low confidence and a fingerprint without variance."""
    flags = F.concat_ws(" ", F.when(F.col("confidence") < low, "LOW_CONF"), F.when(~F.col("quality_ok"), "ZERO_VAR"))
    return clips.orderBy("path").select(F.rtrim(F.format_string("%-60s  %6.4f  %4d  %4d  %s", T.name_of(F.col("path")), "confidence", "n_valid_frames", "n_rejected_frames", flags)).alias("value"))


def codec_breakdown(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("codec").agg(F.count(F.lit(1)).alias("chunks"))


def ocr_report(rows: DataFrame, plan: DataFrame | None = None, images: DataFrame | None = None) -> DataFrame:
    """The eleven columns of the attribution report, by number. plan (src, dst) names the file that a clip became, images
    (path, roi_path) the picture of its corner; both are empty without them."""
    spark = rows.sparkSession
    plan = plan if plan is not None else spark.createDataFrame([], "src string, dst string")
    images = images if images is not None else spark.createDataFrame([], "path string, roi_path string")
    stamp = lambda ts: F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit(""))
    told = rows.join(plan.select(F.col("src").alias("path"), "dst"), "path", "left").join(images, "path", "left")
    columns = {  # fixed values: the report's headings
        "No.": F.col("seq"),
        "Filename": T.name_of(F.col("path")),
        "Frame OK": F.when(F.col("frame_ok"), "Yes").otherwise("No"),
        "OCR Channel": F.when(F.col("ocr_detected"), F.col("channel")).otherwise(""),
        "OCR Datetime": stamp(F.col("ocr_timestamp")),
        "DAT Reference UTC": stamp(F.timestamp_micros("dat_us")),
        "DAT vs OCR Diff Sec": F.round("timestamp_diff_seconds", 3),
        "Timestamp Check": F.col("timestamp_check"),
        "Output File": F.coalesce("dst", F.lit("")),
        "ROI Image Path": F.coalesce("roi_path", F.lit("")),
        "Error": F.coalesce("error_msg", F.lit("")),
    }
    return told.orderBy("seq", "path").select(*[c.alias(f"{name}") for name, c in columns.items()])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def memory_need(clips: int, dimension: int = 518_400, block: int = 5_000) -> dict[str, int]:
    """Bytes of a dense similarity matrix, of two blocks of fingerprints, and of one fingerprint."""
    return {"matrix": 4 * clips * clips, "blocks": 2 * 4 * min(block, max(clips, 1)) * dimension, "fingerprint": 4 * dimension}


def gap_workbook(baseline: DataFrame, fills: DataFrame, matched: DataFrame, merged: DataFrame, by: list[str]) -> dict[str, DataFrame]:
    """The five tables of the gap report: summary, gaps, baseline, fill (with whether it was used) and merged."""
    from shardloom.operators.gaps import gap_summary

    used = matched.select(*by, F.explode("fillers").alias("f")).select(*by, F.col("f.key").alias("key"), F.lit(True).alias("used"))
    return {"summary": gap_summary(matched, by), "gaps": gap_report(matched), "baseline": baseline, "fill": fills.join(used, [*by, "key"], "left").withColumn("used", F.coalesce("used", F.lit(False))), "merged": merged}


def write_workbook(tables: dict[str, DataFrame], folder: str) -> None:
    """A folder of CSV files for each table; nested columns as JSON."""
    for name, df in tables.items():
        flat = [F.to_json(f"`{c}`").alias(c) if kind.startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c, kind in df.dtypes]
        write_csv(df.select(*flat), f"{folder}/{name}")
