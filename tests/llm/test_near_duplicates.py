import random
from collections import defaultdict

import numpy as np
import pytest

from shardloom.llm import common, minhash
from shardloom.llm.common import connected_components, hot_join


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute_force(docs, width, percent):
    sets = {i: shingle_set(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, families=6, copies=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.choice([6, 12, 80, 200]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 14))):
                text[rng.randrange(len(text))] = rng.choice(words)
            docs.append(" ".join(text))
        docs += [" ".join(base).upper()] * 10
    shared = [rng.choice(words) for _ in range(60)]
    docs += [" ".join(shared + [rng.choice(words) for _ in range(rng.randint(5, 60))]) for _ in range(40)]
    docs += ["", " \t", "one", "ONE", "one two", "one  two", "two one", None]
    rng.shuffle(docs)
    return [(7 * i + 3, t) for i, t in enumerate(docs)]


def test_components_equal_brute_force(spark):
    for width, percent in ((2, 80), (5, 80)):
        docs = corpus(width)
        frame = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n long, key string").repartition(6)
        rows = minhash.near_duplicates(frame, width, percent).collect()
        want = brute_force(docs, width, percent)
        assert len(rows) == len(docs)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_empty_null_and_repeated_rows(spark):
    kind = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    rows = minhash.near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, "")], kind)).collect()
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in rows)
    assert got == [(-1, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True)]


def test_very_long_text(spark):
    text = " ".join(f"x{i % 50000}" for i in range(120000))
    rows = minhash.near_duplicates(spark.createDataFrame([(1, text), (2, text + " tail")], "doc_id long, text string")).collect()
    assert {r["component_id"] for r in rows} == {1}


def test_estimate_follows_likeness():
    rng = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.8, 0.95):
        got = []
        for _ in range(40):
            both = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
            n = round(4000 * share)
            rest = (4000 - n) // 2
            a, b = np.unique(both[: n + rest]), np.unique(np.concatenate([both[:n], both[n + rest :]]))
            got.append(minhash.estimate(minhash.registers(a)[None], minhash.registers(b)[None], np.array([len(a)]), np.array([len(b)]))[0])
        assert abs(np.mean(got) - share) < 0.03


def test_unrelated_small_sets_rarely_agree():
    rng = np.random.default_rng(3)
    a, b = (np.unique(rng.integers(0, 1 << 63, 5, dtype=np.uint64) * np.uint64(2)) for _ in range(2))
    assert minhash.estimate(minhash.registers(a)[None], minhash.registers(b)[None], np.array([5]), np.array([5]))[0] < 0.1


def test_neighbours_over_any_partitions(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, 5, 6]), i, 9) for i in range(500)] + [(100 + i, i, 9) for i in range(50)]
    found = minhash._neighbours(spark.createDataFrame(rows, "key long, id long, n long")).collect()
    members = defaultdict(list)
    for key, i, _ in sorted(rows):
        members[key].append(i)
    pairs = {(k, b, a) for k, ids in members.items() for a, b in zip(ids, ids[1:], strict=False)}
    got = {(r["key"], r["id"], r["prev"]) for r in found if r["prev"] is not None}
    assert got <= pairs
    missing = pairs - got
    edges = {(r["key"], r["id"]) for r in found if r["edge"] % 2 == 1}
    assert {(k, b) for k, b, _ in missing} <= edges
    assert {(r["key"], r["id"]) for r in found} >= {(k, i) for k, ids in members.items() if len(ids) > 1 for i in ids}


@pytest.mark.parametrize("share", [None, 500_000, 20])
def test_components_of_chains_and_stars(spark, share, monkeypatch):
    monkeypatch.setattr(common, "TASK_LINKS", share)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, x) for x in range(1001, 1400)] + [(5, 5), (None, 3)] + [(2000, 2001)] * 3
    rows = connected_components(spark.createDataFrame(edges, "a long, b long"), contract=share is not None).collect()
    got = {r["id"]: r["component"] for r in rows}
    assert len(rows) == len(got)
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(1000, 1400)} == {1000} and got[2001] == 2000
    assert connected_components(spark.createDataFrame([], "a long, b long"), contract=share is not None).count() == 0


def test_hot_join_loses_nothing(spark):
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 7)], "k long, v long")
    values = spark.createDataFrame([(1, "one"), (3, "three")], "k long, w string")
    for how in ("inner", "left"):
        a = sorted(map(tuple, hot_join(rows, values, "k", how, threshold=50).collect()), key=repr)
        b = sorted(map(tuple, rows.join(values, "k", how).collect()), key=repr)
        assert a == b


def test_hot_join_on_binary_keys(spark):
    rows = spark.createDataFrame([(bytearray(b"k" if i % 3 else bytes([i])), i) for i in range(90)], "k binary, v long")
    values = spark.createDataFrame([(bytearray(b"k"), "one"), (bytearray(b"\x03"), "three")], "k binary, w string")
    got = hot_join(rows, values, "k", "left", threshold=20).collect()
    assert len(got) == 90 and sum(r["w"] == "one" for r in got) == 60 and sum(r["w"] == "three" for r in got) == 1


def test_sparse_and_dense_sets_borrow_alike(monkeypatch):
    rng = np.random.default_rng(5)
    for n in (1, 5, 24, 40, 300, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        got = minhash.registers(a)
        filled = {int(h >> np.uint64(55)): h for h in a[::-1]}
        for bucket in range(0, minhash.BUCKETS, 37):
            seen = next(x for x in [bucket, *minhash._PROBE[bucket].tolist()] if x in filled)
            rest = (int(filled[seen]) & ((1 << 55) - 1)) >> 2
            assert got[bucket] >> minhash.MANTISSA == 53 - rest.bit_length()


def test_repeated_ids_share_a_class(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(5, a), (5, b), (7, b + " end"), (2, a + " end"), (9, c)]
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(2, 2), (5, 2), (5, 2), (7, 2), (9, 9)]


def test_boilerplate_is_compared_by_bucket_only(spark, monkeypatch):
    """Documents that share over half of their shingles but aren't linked: few share a bucket, and of those the registers
    sort out nearly all before a full set is read."""
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(90)]
    docs = [(i, " ".join(shared + [f"w{rng.randrange(10**6)}" for _ in range(70)])) for i in range(2000)]
    docs += [(5000 + i, docs[i][1] + " tail") for i in range(5)]
    seen = {}
    real_candidates, real_checked = minhash._candidates, minhash._checked
    monkeypatch.setattr(minhash, "_candidates", lambda rows, percent: real_candidates(seen.setdefault("rows", rows.cache()), percent))
    monkeypatch.setattr(minhash, "_checked", lambda found, sets, percent: real_checked(seen.setdefault("found", found.cache()), sets, percent))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in docs}
    keys = dict(zip((i for i, _ in docs), minhash.band_keys(minhash.registers_of([minhash.shingles(t, 5) for _, t in docs])).tolist(), strict=True))
    rows = seen["rows"].select("key", "x", "y", "id").collect()
    assert all(r["key"] in keys[r["id"]] for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["key"], r["x"], r["y"]] += 1
    assert max(sizes.values()) <= 3 * minhash.BLOCK
    assert sum(n * n for n in sizes.values()) < len(docs) ** 2 / 4
    assert seen["found"].count() < 50


@pytest.mark.parametrize("block", [4, 128])
def test_large_buckets_in_blocks_of_any_size(spark, monkeypatch, block):
    """A star: copies that are alike with the middle only, so that few are neighbours in a bucket."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "FIRST", 1)
    if block == 4:  # all is left to the blocks
        monkeypatch.setattr(minhash, "_to_main", lambda members: members.select("id", "id").toDF("a", "b").limit(0))
    rng = random.Random(12)
    base = [f"b{i}" for i in range(100)]
    docs = [(50, " ".join(base))]
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(100), 4):
            text[at] = f"x{i}.{at}"
        docs.append((100 + i, " ".join(text)))
    docs += [(300 + i, " ".join(f"o{i}.{k}" for k in range(40))) for i in range(10)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2, 80).collect()}
    assert got == brute_force(docs, 2, 80)
