import struct

import pytest
from pyspark.sql import functions as F

from shardloom.functions import binary as B
from shardloom.functions import text as T

T0 = 1_704_067_250_000_000


def rec(kind: int, us: int) -> bytes:
    return bytes([kind, 1, 0]) + b"\x11" * 8 + struct.pack("<Q", us)


#: markers at 7, 28, 47, 66 (out of range) and 85 (cut short)
SAMPLE = b"\x33" * 7 + rec(0x80, T0) + b"\x22" * 2 + rec(0x81, T0 - 40_000_000) + rec(0x80, T0 - 20_000_000) + rec(0x80, 5) + b"\x81\x01\x00ab"


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


def test_markers_and_times(spark):
    assert one(spark, bytearray(SAMPLE), "binary", B.marker_positions) == [7, 28, 47, 66, 85]
    found = one(spark, bytearray(SAMPLE), "binary", B.records)
    assert [r["pos"] for r in found] == [7, 28, 47]
    times = {n: one(spark, bytearray(SAMPLE), "binary", lambda v, f=f: f(B.records(v))) for n, f in [("first", B.first_time), ("last", B.last_time), ("middle", B.middle_time), ("least", B.least_time), ("most", B.most_time)]}
    assert times == {"first": T0, "last": T0 - 20_000_000, "middle": T0 - 40_000_000, "least": T0 - 40_000_000, "most": T0}


@pytest.mark.parametrize("content", [None, b"", b"\x80", b"\x80\x01", b"\x80\x01\x00", rec(0x80, 2**64 - 1)])
def test_short_and_overflowing_content(spark, content):
    found = one(spark, None if content is None else bytearray(content), "binary", B.records)
    assert found == (None if content is None else [])


def test_codec(spark):
    rows = spark.createDataFrame([(0, 0), (3, 2), (2, 2), (1, 2)], "a int, b int").select(B.codec_of(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == ["unknown", "h264", "h264", "h265"]


@pytest.mark.parametrize("text, label", [("CAM01", "CAM01"), ("camO7", "CAM07"), ("CAM012", "CAM12"), ("x CAM03 y", "CAM03"), ("CAM10", None), ("cam o7", None), ("CAM0", None), ("CAM01X", None), ("CAM|1", None), ("CAMO", None), ("", None)])
def test_labels(spark, text, label):
    assert one(spark, [text], "array<string>", T.channel_label) == label


def test_relaxed_label(spark):
    assert one(spark, ["CAM10"], "array<string>", lambda v: T.channel_label(v, relaxed=True)) == "CAM10"


@pytest.mark.parametrize("text, seconds", [("2024/02/30 01:02:03", None), ("2024-2-29 1:02:03", 1709168523), ("no date", None)])
def test_overlay_time(spark, text, seconds):
    assert one(spark, [text], "array<string>", lambda v: F.unix_seconds(T.overlay_time(v))) == seconds


@pytest.mark.parametrize("off, word", [(10_000_000, "PASS"), (10_001_000, "CHECK"), (60_000_000, "CHECK"), (60_001_000, "REVIEW")])
def test_time_check(spark, off, word):
    assert one(spark, off, "long", lambda v: T.time_check(v, F.lit(0))).startswith(word)


@pytest.mark.parametrize(
    "result, texts",
    [
        ('{"res": {"parsing_res_list": [{"block_content": " a "}, {"block_content": 3}], "text": "b"}}', ["a", "b"]),
        ('{"rec_text": "x", "markdown": "x", "content": "y"}', ["x", "y"]),
        ('["p", {"text": "q"}, ["r"]]', ["p", "q", "r"]),
        ('"s"', ["s"]),
        ('[[[[["deep", {"res": {"text": "deeper"}}]]]], " a\\t"]', ["deep", "deeper", "a"]),
        ('{"res": ["x"]}', None),
        ("7", []),
        ("{", None),
        (None, None),
    ],
)
def test_overlay_texts(spark, result, texts):
    assert one(spark, result, "string", T.overlay_texts) == texts


@pytest.mark.parametrize("value, text", [("\ta b ", "a_b"), (' a/b:c*d ', "a_b_c_d"), ("", "unknown"), (None, "unknown"), ("a  b", "a_b")])
def test_safe_name(spark, value, text):
    assert one(spark, value, "string", T.safe_name) == text


def test_times_as_text(spark):
    assert one(spark, None, "long", T.iso_time) == "-"
    assert one(spark, T0, "long", T.iso_time) == "2024-01-01T00:00:50+00:00"
    assert one(spark, T0 + 5, "long", T.iso_time) == "2024-01-01T00:00:50.000005+00:00"
    assert [one(spark, x, "double", T.report_duration) for x in (3661.25, -61.0, 0.5)] == ["1h 1m 1.3s", "1m 1.0s", "0.500s"]
    assert one(spark, 255, "long", lambda v: B.hex_offset(v, 12)) == "0x0000000000FF"


@pytest.mark.parametrize("path, number", [("/a/9_Chunk_12_5.dat", 12), ("/a/x7y8.dat", 8), ("/a/none.dat", 0)])
def test_chunk_number(spark, path, number):
    assert one(spark, path, "string", T.chunk_number) == number


def test_file_seconds(spark):
    f = lambda p: one(spark, p, "string", lambda v: T.file_seconds(v, F.lit(None).cast("long"), F.timestamp_seconds(F.lit(9))))
    assert f("/a/1704067250123.dat") == 1704067250.123
    assert f("/a/1704067250.dat") == 1704067250.0
    assert f("/a/x_2024-01-01_00-01.dat") == 1704067260.0
    assert f("/a/chunk_4_2.dat") == 4.0
    assert f("/a/part 3 of 8.dat") == 8.0
    assert f("/a/none.dat") == 9.0


def test_overlay_time_is_looked_for_in_what_was_read(spark):
    assert one(spark, ["CAM01|2024/01/02 03:04:05"], "array<string>", lambda v: F.unix_seconds(T.overlay_time(v))) == 1704164645
    assert one(spark, ["", "\t2024-01-02 ", "03:04:05"], "array<string>", lambda v: F.unix_seconds(T.overlay_time(v))) == 1704164645
