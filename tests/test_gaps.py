import random

import pytest
from pyspark.sql import functions as F

from shardloom.operators import gaps, order
from shardloom.operators.gaps import GapConfig, find_chain

S = 1_000_000


def clips(spark, rows):
    return spark.createDataFrame([(1, *r) for r in rows], "cam int, key string, first_us long, last_us long")


def detect(spark, rows, threshold=5 * S):
    return gaps.detect_gaps(clips(spark, rows), ["cam"], ["key"], "first_us", "last_us", threshold).collect()


def test_threshold_is_exclusive(spark):
    assert detect(spark, [("a", 0, 10 * S), ("b", 15 * S, 20 * S)]) == []
    assert [r["gap_us"] for r in detect(spark, [("a", 0, 10 * S), ("b", 15 * S + 1000, 20 * S)])] == [5 * S + 1000]


def test_clip_without_times_ends_no_gap(spark):
    assert detect(spark, [("a", 0, S), ("b", None, None), ("c", 100 * S, 101 * S)]) == []


def test_chain_of_two():
    config = GapConfig(tolerance_s=3)
    a, b = ("a", 9 * S, 15 * S), ("b", int(15.5 * S), 21 * S)
    assert find_chain([a], 10 * S, 20 * S, config) is None
    chain, partial, coverage = find_chain([a, b], 10 * S, 20 * S, config)
    assert [c[0] for c in chain] == ["a", "b"] and not partial and coverage == 1.0


def listed_chain(fills, open_, close, config):
    """The best of all chains, listed one by one."""
    tol = round(config.tolerance_s * S)
    near = sorted((f for f in fills if f[2] > open_ - tol and f[1] < close + tol and f[2] > f[1]), key=lambda f: (f[1], f[2], f[0]))
    ranked = []

    def go(chain):
        first, last = chain[0][1], chain[-1][2]
        before, after, ahead, behind = max(0, first - open_), max(0, close - last), max(0, open_ - first), max(0, last - close)
        cover = max(0.0, (min(last, close) - max(first, open_)) / (close - open_)) if close > open_ else 1.0
        full = cover >= 0.95 and max(before, after, ahead, behind) <= tol
        steps = [b[1] - a[2] for a, b in zip(chain, chain[1:], strict=False)]
        if full or cover >= config.least_coverage:
            rank = (not full, round((ahead + behind) / S, 3), round((before + after) / S, 3), round(max([0, *steps]) / S, 3), round((abs(first - open_) + abs(last - close)) / S, 3), len(chain), round(sum(-x for x in steps if x < 0) / S, 3), -round(cover, 6), first, chain[0][0])
            ranked.append((rank, len(ranked), chain, not full, cover))
        if last < close - tol:
            for f in near:
                if f[1] > chain[-1][1] and abs(f[1] - last) <= tol and f[2] > last:
                    go([*chain, f])

    for f in near:
        go([f])
    return min(ranked)[2:] if ranked else None


def test_chains_equal_the_best_of_all_that_are_listed():
    rng = random.Random(8)
    several = 0
    for unit in (S, 400):  # whole seconds bring ties, parts of a millisecond bring ties by rounding
        for _ in range(300):
            fills = [(f"f{i}", a := rng.randint(0, 24) * unit, a + rng.randint(0, 6) * unit) for i in range(rng.randint(0, 18))]
            open_ = rng.randint(0, 12) * unit
            config = GapConfig(tolerance_s=2 * unit / S, least_coverage=rng.choice([0.2, 0.7]))
            close = open_ + rng.randint(0, 16) * unit
            found, want = find_chain(fills, open_, close, config), listed_chain(fills, open_, close, config)
            assert found == want
            several += bool(found) and len(found[0]) > 2
    assert several > 50


def test_dense_pools_have_an_answer():
    many = [(f"f{i:03}", i * S, (i + 1) * S) for i in range(400)]
    chain, partial, coverage = find_chain(many, 0, 400 * S, GapConfig(tolerance_s=3))
    assert not partial and coverage == 1.0
    # f396 is within the tolerance of the gap's end, so f399 comes behind f395, and that hole of 3 s allows as many before
    assert chain[0][0] == "f000" and [c[0] for c in chain[-2:]] == ["f395", "f399"] and len(chain) == 101


def test_larger_gap_takes_a_shared_filler(spark):
    rows = spark.createDataFrame([(1, 1, 0, 10 * S, 10 * S), (1, 2, 0, 11 * S, 11 * S)], "cam int, gap_id int, open_us long, close_us long, gap_us long")
    found = {r["gap_id"]: r for r in gaps.match_fillers(rows, clips(spark, [("f", 0, 10 * S)]), ["cam"]).collect()}
    assert len(found[2]["fillers"]) == 1 and found[1]["fillers"] == []
    summary = gaps.gap_summary(gaps.match_fillers(rows, clips(spark, [("f", 0, 10 * S)]), ["cam"]), ["cam"]).first()
    assert (summary["gaps"], summary["unfilled"], summary["status"]) == (2, 1, "INCOMPLETE")


def test_interval_join_and_edges_equal_brute_force(spark):
    rng = random.Random(5)
    fills = [(f"f{i}", a := rng.randint(0, 500) * S, a + rng.randint(0, 40) * S) for i in range(80)]
    holes = [(1, i, a := rng.randint(0, 500) * S, a + rng.randint(0, 60) * S) for i in range(30)]
    g = spark.createDataFrame(holes, "cam int, gap_id int, open_us long, close_us long")
    got = {(r["gap_id"], r["key"]) for r in gaps.interval_candidates(g, clips(spark, fills), ["cam"], 3 * S, 7 * S).collect()}
    want = {(i, k) for _, i, o, c in holes for k, a, b in fills if b > o - 3 * S and a < c + 3 * S and b > a}
    assert got == want
    got = {(r["prev"], r["next"]) for r in gaps.chain_edges(clips(spark, fills), ["cam"], "key", 3 * S).collect()}
    want = {(p[0], n[0]) for p in fills for n in fills if n[1] > p[1] and abs(n[1] - p[2]) <= 3 * S and n[2] > p[2] and p[2] > p[1] and n[2] > n[1]}
    assert got == want


def test_stats_of_a_chain(spark):
    row = spark.createDataFrame([([(0, 4 * S), (6 * S, 9 * S), (8 * S, 12 * S)], S, 10 * S)], "c array<struct<first_us:long,last_us:long>>, o long, e long")
    s = row.select(gaps.chain_stats(F.col("c"), F.col("o"), F.col("e"), 3 * S).alias("s")).first()["s"]
    assert (s["coverage"], s["full"], s["overhang_before"], s["overhang_after"], s["internal_gap_s"], s["overlap_s"], s["n_chunks"]) == (1.0, True, 1.0, 2.0, 2.0, 1.0, 3)


def test_merged_sequence_and_names(spark):
    base = clips(spark, [("/b/a.dat", 0, S), ("/b/b.dat", 50 * S, 51 * S)])
    matched = spark.createDataFrame([(1, "/b/a.dat", [("/f/y.dat", 30 * S, 40 * S), ("/f/x.dat", 10 * S, 20 * S)])], "cam int, after string, fillers array<struct<key:string,first_us:long,last_us:long>>")
    seq = gaps.merged_sequence(base, matched, ["cam"], "key", "key")
    assert [r["dst"] for r in order.merged_plan(seq.orderBy("seq"), "/o").collect()] == ["/o/1_a_baseline.dat", "/o/2_x_fill.dat", "/o/3_y_fill.dat", "/o/4_b_baseline.dat"]


def test_natural_order(spark):
    rows = order.natural_order(spark.createDataFrame([(x,) for x in ("c10.dat", "C2.dat", "c1.dat", "c2b.dat")], "name string"), "name").orderBy("place").collect()
    assert [r["name"] for r in rows] == ["c1.dat", "C2.dat", "c2b.dat", "c10.dat"]


def test_unique_targets(spark):
    plan = spark.createDataFrame([("s1", "/d/a.dat"), ("s2", "/d/a.dat"), ("s3", "/d/a.dat"), ("s4", "/d/b")], "src string, dst string")
    assert {r["dst"] for r in order.unique_targets(plan).collect()} == {"/d/a.dat", "/d/a_2.dat", "/d/a_3.dat", "/d/b"}


def test_copy_and_concatenate(spark, tmp_path):
    for name, data in (("c10.dat", b"3"), ("C2.dat", b"2"), ("c1.dat", b"1")):
        (tmp_path / name).write_bytes(data)
    plan = spark.createDataFrame([(str(tmp_path / "c1.dat"), str(tmp_path / "o/x.dat"))], "src string, dst string")
    order.carry_out(plan)
    assert (tmp_path / "o/x.dat").read_bytes() == b"1"
    files = spark.createDataFrame([(str(p),) for p in tmp_path.glob("*.dat")], "path string")
    assert order.concatenate(files, str(tmp_path / "all.bin")) == 3
    assert (tmp_path / "all.bin").read_bytes() == b"123"
