import struct

from pyspark.sql import functions as F

from shardloom.operators import noise, order, overlay, report
from shardloom.sources import files
from shardloom.streaming import discover

T0 = 1_704_067_250_000_000


def rec(us):
    return b"\x80\x01\x00" + b"\x11" * 8 + struct.pack("<Q", us)


def test_scan_of_clips(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes(rec(T0 + 5_000_000) + rec(T0))
    (tmp_path / "B.DAT").write_bytes(b"nothing")
    (tmp_path / "c.txt").write_bytes(rec(T0))
    rows = {r["name"]: r for r in files.clip_times(files.dat_files(spark, str(tmp_path))).collect()}
    assert set(rows) == {"a.dat", "B.DAT"}
    assert (rows["a.dat"]["first_us"], rows["a.dat"]["duration_s"], rows["a.dat"]["ts_ok"]) == (T0, 5.0, True)
    assert (rows["B.DAT"]["ts_ok"], rows["B.DAT"]["duration_s"]) == (False, 0.0)
    assert [r["seq"] for r in files.video_files(spark, str(tmp_path)).orderBy("seq").collect()] == [1, 2]


def test_all_suffixes_of_video_files(spark, tmp_path):
    names = ["a.mp4", "b.avi", "c.MOV", "d.mkv", "e.wmv", "f.flv", "g.mpeg", "h.MPG", "i.dat"]
    for name in [*names, "a.h264", "b.h265", "c.hevc", "d.ts", "e.txt", "mp4", "f.mp4.part"]:
        (tmp_path / name).write_bytes(b"x")
    rows = files.video_files(spark, str(tmp_path)).select("seq", "path").orderBy("seq").collect()
    assert [(r["seq"], r["path"].rsplit("/", 1)[1]) for r in rows] == list(enumerate(names, 1))


def test_cache_resumes(spark, tmp_path):
    schema = "key string, path string, vec array<float>"
    cache = str(tmp_path / "cache")
    clips = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    assert files.not_cached(clips, files.read_cache(spark, cache, schema)).count() == 3
    files.append_cache(spark.createDataFrame([("a", [1.0]), ("b", None), ("z", [2.0])], "path string, vec array<float>").select("path", "vec"), cache)
    left = files.not_cached(clips, files.read_cache(spark, cache, schema))
    assert sorted(r["path"] for r in left.collect()) == ["b", "c"]
    new = spark.createDataFrame([("b", [3.0])], "path string, vec array<float>").withColumn("key", files.cache_key(F.col("path")))
    both = files.with_cached(clips, files.read_cache(spark, cache, schema), new)
    assert sorted(r["path"] for r in both.collect()) == ["a", "b"]


def test_stream_reads_each_clip_once(spark, tmp_path):
    source = tmp_path / "clips"
    source.mkdir()
    (source / "a.dat").write_bytes(b"1")
    make = lambda batch: batch.select("path", F.array(F.lit(1.0)).alias("vec"))
    for name in ("b.dat", "c.dat"):
        discover.keep_fingerprints(discover.new_clips(spark, str(source)), make, str(tmp_path / "cache"), str(tmp_path / "check")).awaitTermination()
        (source / name).write_bytes(b"2")
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 2


def test_overlay_attribution(spark):
    readings = overlay.candidate_readings(
        spark.createDataFrame([("p", 0, '"CAM01"'), ("p", 1, '"2024/01/01 00:00:55"'), ("p", 2, '"late"'), ("q", 0, '"CAM02"'), ("r", 0, "{")], "path string, candidate int, result string")
    )
    clips = spark.createDataFrame([("p", 1, T0, None), ("q", 2, None, None), ("r", 3, T0, None), ("s", 4, T0, "no frame")], "path string, seq long, dat_us long, error string")
    rows = {r["path"]: r for r in overlay.attribute(clips, readings).collect()}
    assert (rows["p"]["channel"], rows["p"]["ocr_texts"], rows["p"]["timestamp_diff_seconds"], rows["p"]["row_state"]) == ("CAM01", ["CAM01", "2024/01/01 00:00:55"], 5.0, "YES")
    assert (rows["q"]["channel"], rows["q"]["ocr_detected"], rows["q"]["row_state"]) == ("unknown_channel", True, "PARTIAL")
    assert rows["r"]["row_state"] == "ERR" and rows["s"]["error_msg"] == "no frame"


def test_unknown_channel_goes_by_number(spark):
    rows = spark.createDataFrame([("/x/b_10.dat", 1), ("/x/a_9.dat", 2), ("/x/c.dat", 3)], "path string, seq long").withColumns({"channel": F.lit("unknown_channel"), "ocr_timestamp": F.lit(None).cast("timestamp")})
    plan = overlay.order_plan(rows, "/o").orderBy("dst").collect()
    assert [r["dst"] for r in plan] == ["/o/unknown_channel/0001_a_9.dat", "/o/unknown_channel/0002_b_10.dat", "/o/unknown_channel/0003_c.dat"]


def test_reports(spark, tmp_path):
    clips = spark.createDataFrame([("/c/a.dat", 0.2, 3, 1, False), ("/c/b.dat", 0.9, 9, 0, True)], "path string, confidence double, n_valid_frames long, n_rejected_frames long, quality_ok boolean")
    lines = [r["value"] for r in report.confidence_lines(clips).collect()]
    assert lines[0].endswith("LOW_CONF ZERO_VAR") and not lines[1].endswith("CONF")
    report.write_text(report.confidence_lines(clips), str(tmp_path / "t"))
    assert [r["dst"] for r in noise.quarantine(clips, "/q").collect()] == ["/q/00000000_a.dat"]
    assert order.encode_command("a", "b")[:4] == ["ffmpeg", "-y", "-i", "a"]
    assert report.memory_need(10_000)["matrix"] == 400_000_000


def test_seek_plan(spark):
    rows = spark.createDataFrame([("hevc", 100.0), ("hevc", None), ("h264", 100.0), ("h264", None)], "c string, d double").select(noise.seek_plan(F.col("c"), F.col("d"), 3).alias("p")).collect()
    assert [r["p"] for r in rows] == [[2.0, 48.5, 95.0], [2.0, 3.0, 5.0], [0.0, 47.5, 95.0], []]


def test_empty_files_count(spark, tmp_path):
    for name, content in (("a b+%.dat", b""), ("c.DAT", b"x"), ("d.txt", b""), ("e.mp4", b"")):
        (tmp_path / name).write_bytes(content)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.dat").write_bytes(b"")
    named = lambda df: {r["path"].rpartition("/")[2]: r["length"] for r in df.select("path", "length").collect()}
    assert named(files.dat_files(spark, str(tmp_path))) == {"a b+%.dat": 0, "c.DAT": 1}
    assert named(files.dat_files(spark, str(tmp_path), recursive=True, any_case=False)) == {"a b+%.dat": 0, "f.dat": 0}
    assert named(files.video_files(spark, str(tmp_path))) == {"a b+%.dat": 0, "c.DAT": 1, "e.mp4": 0}
    times = {r["name"]: (r["ts_ok"], r["ts_method"], r["duration_s"]) for r in files.clip_times(files.dat_files(spark, str(tmp_path))).collect()}
    assert times == {"a b+%.dat": (False, "none", 0.0), "c.DAT": (False, "none", 0.0)}
