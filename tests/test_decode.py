import numpy as np
from pyspark.sql import functions as F

from shardloom.operators import noise, order
from shardloom.sources import decode, files


def test_probe(spark):
    answers = {"/a": ("HEVC\n", "12.5 s\n"), "/b": ("avc1", "N/A"), "/c": ("mjpeg", "0"), "/d": (None, None)}

    def probe(path):
        return answers[path]  # /e fails

    clips = spark.createDataFrame([(p, 1) for p in [*answers, "/e"]], "path string, seq int")
    got = {r["path"]: (r["codec"], r["duration"]) for r in decode.probe_with(clips, probe).collect()}
    assert got == {"/a": ("hevc", 12.5), "/b": ("h264", None), "/c": ("unknown", None), "/d": ("unknown", None), "/e": ("unknown", None)}


def test_frames_follow_the_plan(spark):
    picture = lambda value: np.full((4, 6, 3), value, np.uint8)

    def one(path, at):
        if path == "/broken" and at is not None and at > 5:
            raise OSError("damaged")
        if path == "/late":
            return (20_000, picture(9)) if at is None else (10_000, picture(1))
        return 20_000, picture(0 if at is None else round(at))

    def every(path, step, n):
        return [picture(step + i) for i in range(n + 3)]

    rows = [("/hevc", "hevc", 20.0), ("/late", "hevc", None), ("/h264", "h264", 20.0), ("/no", "unknown", None), ("/broken", "hevc", None)]
    got = {}
    for r in decode.frames_with(spark.createDataFrame(rows, "path string, codec string, duration double"), one, every, 4).collect():
        got.setdefault(r["path"], {})[r["frame_idx"]] = r["data"][0]
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == {"/hevc": [2, 8, 13, 19], "/late": [9], "/h264": [0, 6, 13, 19], "/no": [30, 31, 32, 33], "/broken": [2, 3, 5]}


def test_middle_frame(spark):
    picture = lambda value: np.full((4, 6, 3), value, np.uint8)
    busy = np.random.default_rng(1).integers(0, 255, (40, 60, 3), dtype=np.uint8)

    def one(path, at):
        if path == "/none":
            return None
        return 20_000, busy if path == "/text" and at == 3 else picture(0 if at is None else int(at))

    rows = [("/text", "hevc", 20.0), ("/flat", "h264", None), ("/none", "h264", 5.0)]
    got = {r["path"]: r for r in decode.middle_frames_with(spark.createDataFrame(rows, "path string, codec string, duration double"), one).collect()}
    assert bytes(got["/text"]["data"]) == busy.tobytes() and got["/flat"]["data"][0] == 0 and got["/flat"]["error"] is None
    assert got["/none"]["data"] is None and got["/none"]["error"] == "no frame could be read"


def test_names_that_exist_are_passed_over(spark, tmp_path):
    for name in ("a.dat", "a_2.dat", "a_4.dat", "a_x.dat", "b_2.dat"):
        (tmp_path / name).write_bytes(b"")
    there = files.existing_files(spark, str(tmp_path))
    assert files.existing_files(spark, str(tmp_path / "none")).count() == 0
    plan = spark.createDataFrame([(f"/s/{i}", f"{tmp_path}/{n}.dat") for i, n in enumerate("aaabbc")], "src string, dst string")
    got = {r["src"]: r["dst"].rpartition("/")[2] for r in order.unique_targets(plan, there).collect()}
    assert got == {"/s/0": "a_3.dat", "/s/1": "a_5.dat", "/s/2": "a_6.dat", "/s/3": "b.dat", "/s/4": "b_3.dat", "/s/5": "c.dat"}
    again = {r["src"]: r["dst"].rpartition("/")[2] for r in order.unique_targets(plan).collect()}
    assert again["/s/1"] == "a_2.dat" and again["/s/4"] == "b_2.dat"


def test_frame_totals(spark):
    rows = spark.createDataFrame([("a", 5, 1, 2, 2, 10.0), ("b", 0, 0, 0, 0, None), ("c", 3, 0, 0, 3, 30.0)], "path string, n_frames long, n_brightness_failed long, n_laplacian_failed long, n_valid_frames long, mean_laplacian double")
    assert tuple(noise.frame_totals(rows).first()) == (8, 1, 2, 5, 20.0)
    assert tuple(noise.frame_totals(rows.filter(F.lit(False))).first()) == (0, 0, 0, 0, None)
