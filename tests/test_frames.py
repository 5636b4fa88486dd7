import numpy as np
from pyspark.sql import functions as F

from shardloom.operators import frames, gaps, report

rng = np.random.default_rng(6)


def test_enlarging_keeps_constants_and_ramps():
    assert (frames.enlarge(np.full((6, 9), 77, np.uint8), 2.5) == 77).all()
    ramp = np.tile(np.arange(0, 200, 10, dtype=np.uint8), (8, 1))
    assert frames.enlarge(ramp, 2).shape == (16, 40) and (np.abs(np.diff(frames.enlarge(ramp, 2)[4].astype(int))[4:-4] - 5) <= 1).all()


def test_equalisation_widens_contrast():
    image = rng.integers(100, 130, (64, 64)).astype(np.uint8)
    out = frames.clahe(image, 40.0)
    assert out.shape == image.shape and out.std() > image.std()
    assert frames.clahe(np.full((50, 30), 9, np.uint8)).std() == 0


def test_threshold_marks_dark_strokes():
    image = np.full((60, 60), 200, np.uint8)
    image[28:31, 10:50] = 20
    out = frames.adaptive_threshold(image)
    assert out[29, 30] == 0 and out[5, 5] == 255 and set(np.unique(out)) == {0, 255}


def test_five_candidates(spark, tmp_path):
    rows = [("/c/a.dat", 120, 300, bytearray(rng.integers(0, 255, (120, 300, 3), dtype=np.uint8).tobytes()))]
    found = frames.candidate_images(spark.createDataFrame(rows, "path string, height int, width int, data binary"))
    got = {r["candidate"]: (r["height"], r["width"], r["channels"]) for r in found.collect()}
    assert got == {0: (52, 262, 3), 1: (52, 262, 1), 2: (52, 262, 1), 3: (240, 356, 1), 4: (240, 356, 1)}
    frames.write_images(found, str(tmp_path))
    assert len(list(tmp_path.glob("a.dat_*"))) == 5


def test_first_frame_with_text_wins(spark):
    flat, busy = np.full((40, 60, 3), 90, np.uint8), rng.integers(0, 255, (40, 60, 3), dtype=np.uint8)
    rows = [("p", i, 40, 60, bytearray(x.tobytes())) for i, x in enumerate([flat, busy, busy])] + [("q", i, 40, 60, bytearray(flat.tobytes())) for i in (3, 2)]
    got = {r["path"]: (r["attempt"], r["frame_ok"]) for r in frames.best_frame(spark.createDataFrame(rows, "path string, attempt int, height int, width int, data binary")).collect()}
    assert got == {"p": (1, True), "q": (2, False)}


def test_workbook(spark, tmp_path):
    s = 1_000_000
    base = spark.createDataFrame([(1, "a", 0, s), (1, "b", 50 * s, 51 * s)], "cam int, key string, first_us long, last_us long")
    fills = spark.createDataFrame([(1, "f", s, 50 * s), (1, "g", 90 * s, 91 * s)], "cam int, key string, first_us long, last_us long")
    found = gaps.detect_gaps(base, ["cam"], ["key"], "first_us", "last_us", 5 * s).select("cam", F.lit(1).alias("gap_id"), F.col("after_key.key").alias("after"), "open_us", "close_us", "gap_us")
    matched = gaps.match_fillers(found, fills, ["cam"])
    tables = report.gap_workbook(base, fills, matched, gaps.merged_sequence(base, matched, ["cam"], "key", "key"), ["cam"])
    assert {r["key"]: r["used"] for r in tables["fill"].collect()} == {"f": True, "g": False}
    assert tables["gaps"].first()["status"] == "FILLED" and tables["merged"].count() == 3
    report.write_workbook(tables, str(tmp_path))
    assert spark.read.option("header", True).csv(f"{tmp_path}/summary").first()["status"] == "COMPLETE"


def test_middle_seeks(spark):
    rows = spark.createDataFrame([("hevc", 20.0), ("hevc", None), ("hevc", 0.0), ("h264", 20.0), ("h264", None), (None, None)], "codec string, duration double")
    got = [r["s"] for r in rows.select(frames.middle_seeks(F.col("codec"), F.col("duration")).alias("s")).collect()]
    late = [2.0, 3.0, 5.0, 8.0, 10.0, 15.0]
    assert got == [[10.0, *late], late, late, [10.0, None, 1.0, 2.0], [None, 1.0, 2.0, 3.0], [None, 1.0, 2.0, 3.0]]
