"""Attribution of clips by overlay texts: one row a candidate image in, one attributed row a clip out.

The recognition model is outside: its results come as JSON texts (path, candidate, result).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions import text as T


def candidate_readings(results: DataFrame) -> DataFrame:
    """path, candidate, texts, label, overlay_ts of each recognition result; a result that isn't JSON is an error."""
    texts = results.select("path", "candidate", "result", T.overlay_texts(F.col("result")).alias("texts"))
    texts = texts.select("path", "candidate", "texts", (F.col("texts").isNull() & F.col("result").isNotNull()).alias("broken"))
    return texts.select("path", "candidate", "texts", "broken", T.channel_label(F.col("texts")).alias("label"), T.overlay_time(F.col("texts")).alias("overlay_ts"))


def attribute(clips: DataFrame, readings: DataFrame) -> DataFrame:
    """clips (path, seq, dat_us, error) with channel, overlay time, texts, flags and how the two times agree.

    Label and time are the first ones in candidate order. Candidates count until both are found, so texts come from
    those alone, distinct and in order. A clip without both goes to unknown_channel; the flags stay as they were.
    """
    rows = readings.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("candidate", "texts", "label", "overlay_ts"))).alias("r"), F.max("broken").alias("broken"))
    first = lambda name: F.get(F.filter("r", lambda x: x[name].isNotNull()), F.lit(0))
    rows = rows.withColumns({"_l": first("label"), "_t": first("overlay_ts")})
    until = F.greatest(F.col("_l.candidate"), F.col("_t.candidate"))
    used = F.when(F.col("_l").isNotNull() & F.col("_t").isNotNull(), F.filter("r", lambda x: x["candidate"] <= until)).otherwise(F.col("r"))
    found = rows.select("path", "broken", F.array_distinct(F.flatten(F.transform(used, lambda x: F.coalesce(x["texts"], F.array().cast("array<string>"))))).alias("ocr_texts"), F.col("_l.label").alias("label"), F.col("_t.overlay_ts").alias("ocr_timestamp"))
    joined = clips.join(found, "path", "left")
    detected, dated = F.col("label").isNotNull(), F.col("ocr_timestamp").isNotNull()
    overlay_us = F.unix_micros("ocr_timestamp")
    return joined.select(
        "path", "seq", F.when(detected & dated, F.col("label")).otherwise("unknown_channel").alias("channel"), "ocr_timestamp", "dat_us", F.coalesce("ocr_texts", F.array().cast("array<string>")).alias("ocr_texts"),
        detected.alias("ocr_detected"), dated.alias("datetime_detected"), (F.abs(F.col("dat_us") - overlay_us) / 1e6).alias("timestamp_diff_seconds"), T.time_check(F.col("dat_us"), overlay_us).alias("timestamp_check"),
        (F.col("frame_ok") if "frame_ok" in clips.columns else F.col("error").isNull()).alias("frame_ok"), F.coalesce("error", F.when(F.col("broken"), "the recognition result isn't JSON")).alias("error_msg"),
    ).withColumn("row_state", row_state())


def row_state():
    """ERR for an error, YES if label and time were read, PARTIAL for one of them, else ALT."""
    return F.when(F.col("error_msg").isNotNull(), "ERR").when(F.col("ocr_detected") & F.col("datetime_detected"), "YES").when(F.col("ocr_detected") | F.col("datetime_detected"), "PARTIAL").otherwise("ALT")


def channel_order(rows: DataFrame) -> DataFrame:
    """rows with their place within their channel: by overlay time, clips without one last, then by seq; in
    unknown_channel by the number at the end of the name, those without one last."""
    unknown = F.col("channel") == "unknown_channel"
    number = T.trailing_number(F.col("path"))
    window = Window.partitionBy("channel").orderBy(F.when(unknown, number).asc_nulls_last(), F.when(~unknown, F.unix_micros("ocr_timestamp")).asc_nulls_last(), "seq")
    return rows.withColumn("order", F.row_number().over(window).cast("long"))


def order_plan(rows: DataFrame, folder: str) -> DataFrame:
    """src, dst: where each clip goes, folder/channel/order_name, with the channel as a safe name."""
    placed = channel_order(rows)
    number = F.when(F.col("order") > 9999, F.col("order").cast("string")).otherwise(F.lpad(F.col("order").cast("string"), 4, "0"))
    return placed.select(F.col("path").alias("src"), F.concat(F.lit(f"{folder}/"), T.safe_name(F.col("channel")), F.lit("/"), number, F.lit("_"), T.name_of(F.col("path"))).alias("dst"))


def channel_summary(rows: DataFrame) -> DataFrame:
    """channel, clips, share in per cent, and a TOTAL row."""
    counts = rows.rollup("channel").agg(F.count(F.lit(1)).alias("clips"), F.grouping("channel").alias("all"))
    total = F.max(F.when(F.col("all") == 1, F.col("clips"))).over(Window.partitionBy(F.lit(1)))
    return counts.select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("channel")).alias("channel"), "clips", F.round(100 * F.col("clips") / total, 6).alias("share"))


def run_metrics(rows: DataFrame) -> DataFrame:
    """One row: totals, errors, detections and the detection rate (detected of all)."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("error_msg").isNull()).alias("ok"), F.count_if(F.col("error_msg").isNotNull()).alias("failed"), F.count_if("ocr_detected").alias("labels"), F.count_if("datetime_detected").alias("times"),
        F.count_if(F.col("channel") == "unknown_channel").alias("unknown"), F.coalesce(F.count_if("ocr_detected") / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0)).alias("detection_rate"),
    )


#: Metrics of a run's summary, with the column of run_metrics() or the difference of two that each shows.
METRICS = [
    ("Total files processed", "total"),
    ("Frames extracted OK", "frames"),
    ("Frame extraction failed", "total - frames"),
    ("OCR label detected", "labels"),
    ("OCR label NOT detected", "total - labels"),
    ("Detection rate", "detection_rate"),
    ("OCR datetimes found", "times"),
    ("OCR datetime missing", "total - times"),
]


def metric_rows(rows: DataFrame) -> DataFrame:
    """place, metric, value of the eight metrics of a run, as its summary lists them."""
    one = run_metrics(rows).join(rows.agg(F.count_if("frame_ok").alias("frames")))  # one row each
    listed = F.array(*[F.struct(F.lit(name).alias("metric"), F.expr(value).cast("double").alias("value")) for name, value in METRICS])
    return one.select(F.posexplode(listed).alias("place", "m")).select((F.col("place") + 1).alias("place"), "m.metric", "m.value")


def read_with(frames: DataFrame, recognise: Callable, columns: list[str]) -> DataFrame:
    """Run an outside recognition function over batches of candidate images: recognise(pandas frame) -> JSON texts."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema.fields if f.name in columns)

    def run(batches):
        for batch in batches:
            out = batch[columns].copy()
            out["result"] = recognise(batch)
            yield out

    return frames.mapInPandas(run, f"{schema}, result string")
