import struct

import pytest

from shardloom.__main__ import main, parser, whole_number

T0 = 1_704_067_250_000_000
S = 1_000_000


def test_whole_numbers():
    assert [whole_number(x) for x in ("20480", "0x5000", "0o17", "0b101")] == [20480, 20480, 15, 5]
    with pytest.raises(ValueError):
        whole_number("5k")
    assert parser().parse_args(["carve", "--input", "a", "--output", "b", "--region-start", "0x200"]).region_start == 512


def test_gaps_from_folders(spark, tmp_path):
    def clip(folder, name, *seconds):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"".join(b"\x80\x01\x00" + b"\x33" * 8 + struct.pack("<Q", T0 + s * S) for s in seconds))

    clip("base", "c2.dat", 100, 110)
    clip("base", "c10.dat", 150, 160)
    clip("fill", "x.dat", 110, 150)
    clip("fill", "none.dat")
    words = ["gaps", "--baseline", str(tmp_path / "base"), "--fill", str(tmp_path / "fill"), "--output", str(tmp_path / "out")]
    main([*words, "--dry-run"], spark)
    assert not (tmp_path / "out").exists()
    main(words, spark)
    assert sorted(p.name for p in (tmp_path / "out" / "merged").iterdir() if p.suffix == ".dat") == ["1_c2_baseline.dat", "2_x_fill.dat", "3_c10_baseline.dat"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/report/summary").first()["status"] == "COMPLETE"


def test_carving_of_an_image(spark, tmp_path):
    (tmp_path / "disk").write_bytes(b"A" * 40 + b"\0" * 30 + b"B" * 50)
    main(["carve", "--input", str(tmp_path / "disk"), "--output", str(tmp_path / "out"), "--region-start", "0", "--min-size", "16"], spark)
    assert sorted(p.read_bytes() for p in (tmp_path / "out").rglob("*.dat")) == [b"\0" * 10 + b"B" * 50, b"A" * 40]
