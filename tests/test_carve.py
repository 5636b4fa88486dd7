import random
import struct

import pytest
from pyspark.sql import functions as F

from shardloom.operators import carve
from shardloom.operators.carve import CarveConfig

T0 = 1_704_067_250_000_000


def rec(kind, us):
    return bytes([kind, 1, 0]) + b"\x11" * 8 + struct.pack("<Q", us)


def stretches(data: bytes, t: int, least: int) -> list[tuple[int, int]]:
    out, at = [], 0
    for part in data.split(b"\0" * t):
        if part and len(part) >= least:
            out.append((at, at + len(part)))
        at += len(part) + t
    return out


def carved(spark, tmp_path, data, **settings):
    image = tmp_path / "disk.img"
    image.write_bytes(data)
    config = CarveConfig(region_start=0, **settings)
    rows = carve.fragments(carve.image_ranges(spark, [str(image)], config), config).collect()
    return sorted((r["start"], r["stop"]) for r in rows)


@pytest.mark.parametrize("size", [7, 20, 64])
def test_residue_of_a_run_begins_the_next_fragment(spark, tmp_path, size):
    assert carved(spark, tmp_path, b"A" * 3 + b"\0" * 47 + b"BB", zero_run=20, min_bytes=1, range_bytes=size) == [(0, 3), (43, 52)]


def test_any_range_size_gives_what_splitting_gives(spark, tmp_path):
    rng = random.Random(3)
    for size in (5, 17, 1000):
        data = b"".join(rng.choice([b"\0" * rng.randint(1, 30), bytes([rng.randint(1, 255)]) * rng.randint(1, 9)]) for _ in range(60))
        assert carved(spark, tmp_path, data, zero_run=6, min_bytes=2, range_bytes=size) == stretches(data, 6, 2)


def test_zero_run_of_nothing_is_an_error():
    with pytest.raises(ValueError):
        CarveConfig(zero_run=0)


def image_with(groups, body):
    header = bytearray(carve.HEADER_SIZE)
    for i, (ts, group) in enumerate(groups):
        struct.pack_into("<IIIHH", header, carve.ENTRIES_AT + 16 * i, 1, ts, 0, group, 0)
    return b"\0" * carve.HEADER_AT + bytes(header) + b"\0" * 0x1000 + body


def test_carve_classifies_numbers_and_writes(spark, tmp_path):
    old, new = rec(0x80, T0) * 40, rec(0x81, T0 + 10**9) * 40
    gap = b"\0" * 64
    data = image_with([(T0 // 10**6 + 500, 3), (5, 1)], old + gap + new + gap + b"x" * 600 + gap + b"y" * 10)
    image = tmp_path / "disk.img"
    image.write_bytes(data)
    config = CarveConfig(zero_run=32, region_start=carve.HEADER_AT + carve.HEADER_SIZE + 0x1000, range_bytes=500)
    groups = carve.read_header(spark, str(image))
    assert [tuple(r) for r in groups.collect()] == [(0, carve.HEADER_AT + carve.ENTRIES_AT, T0 // 10**6 + 500, 3)]
    rows = carve.carve(spark, str(image), config).orderBy("abs_start").collect()
    assert [(r["category"], r["codec"], r["ts_count"], r["filename"]) for r in rows] == [("old", "h264", 39, "old_h264_chunk_0001.dat"), ("new", "h265", 39, "new_h265_chunk_0001.dat"), ("unknown", "unknown", 0, "unknown_unknown_chunk_0001.dat")]
    assert carve.manifest(carve.carve(spark, str(image), config)).count() == 3
    totals = {r["category"]: (r["chunks"], r["bytes"]) for r in carve.category_totals(carve.carve(spark, str(image), config)).collect()}
    assert totals["unclassified"] == (0, 0) and totals["old"][0] == 1
    carve.write_chunks(carve.carve(spark, str(image), config), str(tmp_path / "out"))
    assert (tmp_path / "out/old_video/h264/old_h264_chunk_0001.dat").read_bytes() == old.rstrip(b"\0")  # the zeros that end its last time belong to the run


def test_short_image_has_no_boundary(spark, tmp_path):
    image = tmp_path / "small.img"
    image.write_bytes(rec(0x80, T0) * 40)
    rows = carve.carve(spark, str(image), CarveConfig(region_start=0)).collect()
    assert [r["category"] for r in rows] == ["unclassified"]


def test_split_places():
    pos = [0, 100, 200, 300]
    assert carve.split_places(400, pos, [0, 10**6, 9 * 10**6, 10**7], 350, 2.0) == [(0, 200), (200, 400)]
    assert carve.split_places(400, pos, [0, 10**6, 2 * 10**6, 3 * 10**6], 350, 2.0) == [(0, 400)]
    assert carve.split_places(400, pos[:3], [0, 10**6, 9 * 10**6], 350, 2.0) == [(0, 400)]


def test_oversize_fragments_are_split(spark, tmp_path):
    body = b"".join(rec(0x80, T0 + (i + (1000 if i >= 30 else 0)) * 10**6) + b"z" * 31 for i in range(60))
    image = tmp_path / "big.img"
    image.write_bytes(body)
    rows = carve.carve(spark, str(image), CarveConfig(region_start=0, oversize_bytes=2000, range_bytes=777)).orderBy("abs_start").collect()
    assert [(r["abs_start"], r["abs_end"], r["ts_count"], r["h264_count"]) for r in rows] == [(0, 1500, 30, 30), (1500, 3000, 30, 30)]


def test_classify(spark):
    rows = spark.createDataFrame([([1, 5], None), ([1, 9], 5), ([9, 1], 5), ([], 5)], "t array<long>, b long").select(carve.classified(F.col("t"), F.col("b")).alias("c")).collect()
    assert [r["c"]["category"] for r in rows] == ["unclassified", "new", "old", "unknown"]
    assert spark.createDataFrame([([], 5)], "t array<long>, b long").select(carve.classified(F.col("t"), F.col("b"), False).alias("c")).first()["c"]["category"] == "old"


def test_many_runs_in_one_image(spark, tmp_path):
    data = (b"A" * 3 + b"\0" * 5) * 100_000
    rows = carved(spark, tmp_path, data, zero_run=5, min_bytes=1, range_bytes=100_003)
    assert rows == [(8 * i, 8 * i + 3) for i in range(100_000)]


def test_parts_of_parts_are_split_as_a_loop_would():
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randint(3, 60)
        pos = sorted(rng.sample(range(0, 5000, 20), n))
        ts = [rng.choice([None, rng.randrange(10**8)]) for _ in pos]

        def loop(lo, hi, pos=pos, ts=ts):
            inside = [(p, t / 1e6) for p, t in zip(pos, ts, strict=True) if t is not None and p >= lo and p + carve.B.RECORD_SIZE <= hi]
            best = max(((abs(b[1] - a[1]), -i) for i, (a, b) in enumerate(zip(inside, inside[1:], strict=False))), default=(0, 0))
            if hi - lo <= 700 or len(inside) < 4 or best[0] < 2:
                return [(lo, hi)]
            place = inside[1 - best[1]][0]
            return [*loop(lo, place), *loop(place, hi)] if lo < place < hi else [(lo, hi)]

        assert carve.split_places(5100, pos, ts, 700, 2.0) == loop(0, 5100)
