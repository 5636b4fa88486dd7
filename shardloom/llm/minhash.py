"""Near-duplicate documents by HyperMinHash registers, banding, corrected estimates and exact verification.

A register holds the count of leading zeros and ten mantissa bits of the least hash in its bucket: sixteen bits for a
minimum of 64. Registers of buckets that a short document leaves empty are borrowed from others, by an order of each
bucket's own, so that two documents' registers agree as often as their sets do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import connected_components, discard, hot_join, materialize, ship

BUCKETS, MANTISSA = 512, 10
#: 48 bands of 7 registers find a pair with a likeness of 0.8 with all but 13 in a million chances, and let 8 in 100 pairs
#: with a likeness of 0.4 share a bucket, 1 in 100 with one of 0.3.
ROWS, BANDS = 7, 48
#: Members of a bucket that one group of a comparison holds on either side; registers of two such blocks take 256 KB.
BLOCK = 128
#: Neighbours in its buckets that each class is compared with first.
FIRST = 2

_rng = np.random.default_rng(20240229)
_COEFFICIENT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PROBE = _rng.random((BUCKETS, BUCKETS)).argsort(1).astype(np.uint16)  # where an empty bucket looks, in this order
_RANK = _PROBE.argsort(1).astype(np.uint16)
_BAND = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_UNDO = pow(_BASE, -1, 1 << 64)
_SHIFT = np.uint64(64 - (BUCKETS - 1).bit_length())
_STARTS = np.arange(BUCKETS, dtype=np.uint64) << _SHIFT


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _UNDO)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def shingles(text: str | None, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of width words; of fewer words, the whole sequence as one."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)  # of bytes, lower() is A-Z alone
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[::2], change[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    forward, back = _powers_to(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_COEFFICIENT[data] * forward[: len(data)], dtype=np.uint64)])
    words = _mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(_BASE) + words[i : i + n])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """BUCKETS registers of a set that isn't empty: leading zeros, then MANTISSA bits."""
    return registers_of([hashes])[0]


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each of the sets, none of which is empty."""
    rest = np.zeros((len(sets), BUCKETS), np.uint64)
    filled = np.zeros((len(sets), BUCKETS), bool)
    for row, hashes in enumerate(sets):
        at = np.searchsorted(hashes, _STARTS)
        filled[row] = np.append(at[1:], len(hashes)) > at
        rest[row] = hashes[np.minimum(at, len(hashes) - 1)]
    rest = (rest & ((np.uint64(1) << _SHIFT) - np.uint64(1))) >> (_SHIFT - np.uint64(53))
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    shift = bits - 1 - MANTISSA
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out = ((53 - bits) << MANTISSA | mantissa.astype(np.int64)).astype(np.uint16)
    # an empty bucket borrows from the first filled one in its order: sparse rows by least rank, the others by looking
    sparse = filled.sum(1) <= 24
    for row in np.flatnonzero(sparse):
        full, empty = np.flatnonzero(filled[row]), np.flatnonzero(~filled[row])
        out[row, empty] = out[row, full[_RANK[np.ix_(empty, full)].argmin(1)]]
    row, bucket = np.nonzero(~filled & ~sparse[:, None])
    step = 0
    while row.size:
        seen = _PROBE[bucket, step]
        hit = filled[row, seen]
        out[row[hit], bucket[hit]] = out[row[hit], seen[hit]]
        row, bucket = row[~hit], bucket[~hit]
        step += 1
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """The BANDS buckets of every row of registers."""
    parts = found[..., : BANDS * ROWS].reshape(*found.shape[:-1], BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return _mix((parts * _BAND).sum(-1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def zeros_of(n: np.ndarray) -> np.ndarray:
    """For sets of n hashes, how likely a bucket's minimum has 0, 1, 2, ... leading zeros."""
    stays = np.power(1 - 2.0 ** -np.arange(1, 40), np.maximum(1, n / BUCKETS)[:, None])
    return np.diff(stays, axis=1, prepend=0)


def corrected(a: np.ndarray, b: np.ndarray, zeros_a: np.ndarray, zeros_b: np.ndarray) -> np.ndarray:
    """Likeness of pairs from rows of registers, less the agreement by chance: two unrelated minima with as many leading
    zeros agree in their mantissa once in 2 ** MANTISSA times."""
    agree = (a == b).mean(1)
    chance = (zeros_a * zeros_b).sum(1) / (1 << MANTISSA)
    return (agree - chance) / (1 - chance)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return corrected(a, b, zeros_of(n_a), zeros_of(n_b))


def worth(guess: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Is the estimate high enough for an exact check? It may be 4.5 standard errors low (3 in a million are), and lower by what shingles of
    small sets that fall into one bucket can hide. Sizes alone rule out others."""
    wanted = percent / 100
    few, many = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (guess >= wanted - 4.5 * np.sqrt(wanted * (1 - wanted) / BUCKETS) - 2 / few) & (few >= wanted * many)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact check, on sorted distinct hashes."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, set_key, bands of every row."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [shingles(text.as_py(), width) for text in batch.column(1)]
                keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in found]
                bands: list = [[]] * len(found)
                full = [i for i, x in enumerate(found) if len(x)]
                if full:
                    for i, row in zip(full, band_keys(registers_of([found[i] for i in full])), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, set_key binary, bands array<long>")


def _neighbours(rows: DataFrame) -> DataFrame:
    """key, id, n, prev, edge: the rows of buckets with company, each with the row before it in its bucket.

    Rows are sorted by bucket and id over all partitions, so a bucket of any size is spread over as many partitions as
    it takes. edge is over 0 for the first (1) and the last (2) row of a partition, whose bucket may go on beyond.
    """
    parts = max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("prev", pa.int64()), ("edge", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, first = None, None, 1  # the row held back; the one before it; 1 until a row has been given out

        def given(key, id_, n, upto, over):
            nonlocal before, first
            same = np.zeros(len(key), bool)
            same[1:] = key[1:] == key[:-1]
            prev = np.zeros(len(key), np.int64)
            prev[1:] = id_[:-1]
            if before is not None:
                same[0], prev[0] = before[0] == key[0], before[1]
            follows = np.zeros(len(key), bool)
            follows[:-1] = same[1:]
            edge = np.zeros(len(key), np.int32)
            edge[0] += first
            if over:
                edge[-1] += 2
            take = np.flatnonzero((same | follows | (edge > 0))[:upto])
            before, first = (key[upto - 1], id_[upto - 1]), 0
            pairs = same[take] & (prev[take] != id_[take])
            return pa.RecordBatch.from_arrays([pa.array(key[take]), pa.array(id_[take]), pa.array(n[take]), pa.array(prev[take], mask=~pairs), pa.array(edge[take])], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, id_, n = (batch.column(i).to_numpy() for i in range(3))
            if held is not None:
                key, id_, n = (np.concatenate([h, x]) for h, x in zip(held, (key, id_, n), strict=True))
            held = (key[-1:], id_[-1:], n[-1:])
            if len(key) > 1:
                yield given(key, id_, n, len(key) - 1, False)
        if held is not None:
            yield given(*held, 1, True)

    return rows.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id").mapInArrow(run, "key long, id long, n long, prev long, edge int")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, n, registers, hashes of the documents with these ids."""
    out = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("registers", pa.binary()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [(i, x) for i, t in enumerate(batch.column(1)) if len(x := shingles(t.as_py(), width))]
                if found:
                    keep = pa.array([i for i, _ in found])
                    signs = [x.tobytes() for x in registers_of([x for _, x in found])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()).take(keep), pa.array([len(x) for _, x in found], pa.int64()), pa.array(signs, pa.binary()), pa.array([x.tobytes() for _, x in found], pa.binary())], schema=out)

    # rows that share an id are one document here, the one whose set is compared under it
    return docs.select("doc_id", "text").join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").mapInArrow(run, "id long, n long, registers binary, hashes binary")


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _kept_pairs(pairs: DataFrame, sets: DataFrame, columns: list[str], test: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The pairs (a, b) that pass the test, which sees these columns of a's set, then of b's."""
    side = lambda s: sets.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keep = pa.array(np.flatnonzero(test(batch)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], schema=_PAIRS)

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", *[f"{c}_{s}" for s in "ab" for c in columns])
    return joined.mapInArrow(run, "a long, b long")


def _rows_of(column: pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), kind) for v in column]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are alike. Registers come first: full sets are read only for pairs that
    the corrected estimate lets through."""

    def likely(batch: pa.RecordBatch) -> np.ndarray:
        n = [batch.column(i).to_numpy().astype(float) for i in (2, 4)]
        signs = [np.stack(_rows_of(batch.column(i), np.uint16)) for i in (3, 5)]
        return worth(estimate(*signs, *n), *n, percent)

    def exact(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([alike(a, b, percent) for a, b in zip(_rows_of(batch.column(2), np.uint64), _rows_of(batch.column(3), np.uint64), strict=True)], bool)

    return _kept_pairs(_kept_pairs(pairs, sets, ["n", "registers"], likely), sets, ["hashes"], exact)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Whole groups, several at a time, of rows that are sorted by the first columns; no group is larger than two blocks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        ends = [batch.column(i).to_numpy() for i in range(keys)]
        changes = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ends], axis=0))
        opened = int(changes[-1]) + 1 if changes.size else 0
        if not opened and len(held) > 1 and any(x[0].as_py() != y[0].as_py() for x, y in zip(held[-2].slice(held[-2].num_rows - 1).columns[:keys], batch.columns[:keys], strict=True)):
            yield _joined(held[:-1])
            held = held[-1:]
        elif opened:
            yield _joined([*held[:-1], batch.slice(0, opened)])
            held = [batch.slice(opened)]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    columns = [batch.column(i).to_numpy() for i in range(keys)]
    return np.concatenate([[0], np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1, [batch.num_rows]])


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """key, x, y, id, component, mates: the members of groups (key, x, y) that the estimate takes for alike with members of
    other components, and which these are, at most a block. A pair that shares several buckets shows up in its first.

    rows: key, x, y, side, id, component, n, registers. side has 1 if a row is to be compared, 2 if others are compared
    with it, and 4 if it is to be compared here or elsewhere, so that a pair of such is left to the one with the least id.
    """
    schema = "key long, x int, y int, id long, component long, mates array<long>"
    out = pa.schema([("key", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("id", pa.int64()), ("component", pa.int64()), ("mates", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, 3):
            key, side, id_, own, n = (batch.column(i).to_numpy() for i in (0, 3, 4, 5, 6))
            n = n.astype(float)
            starts, pairs = _starts(batch, 3), []
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                left, right = lo + np.flatnonzero(side[lo:hi] & 1), lo + np.flatnonzero(side[lo:hi] & 2)
                i, j = np.nonzero(own[left][:, None] != own[right][None])
                pairs.append((left[i], right[j]))
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            once = ((side[j] & 4 == 0) | (id_[i] < id_[j])) & worth(np.ones(len(i)), n[i], n[j], percent)
            i, j = i[once], j[once]
            mates: dict[int, list[int]] = {}
            if i.size:
                signs = np.stack(_rows_of(batch.column(7), np.uint16))
                bands, zeros = band_keys(signs), zeros_of(n)
            for at in range(0, len(i), 4096):
                a, b = i[at : at + 4096], j[at : at + 4096]
                good = worth(corrected(signs[a], signs[b], zeros[a], zeros[b]), n[a], n[b], percent)
                a, b = a[good], b[good]
                first = bands[a, (bands[a] == bands[b]).argmax(1)] == key[a]
                for one, other in zip(a[first].tolist(), b[first].tolist(), strict=True):
                    mates.setdefault(one, []).append(id_[other])
                    mates.setdefault(other, [])
            keep = sorted(mates)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in (0, 1, 2, 4, 5)), pa.array([mates[r] for r in keep], pa.list_(pa.int64()))], schema=out)

    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.select("key", "x", "y", "side", "id", "component", "n", "registers").mapInArrow(run, schema)


def _checked(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among candidates: of each block, as many as it takes to join what is alike, by exact checks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, 3):
            id_, own = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            mates, hashes = batch.column(5).to_pylist(), _rows_of(batch.column(6), np.uint64)
            starts = _starts(batch, 3)
            links: list[tuple[int, int]] = []
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                place: dict[int, list[int]] = {}
                for i in range(lo, hi):
                    place.setdefault(int(id_[i]), []).append(i)
                root = {int(own[i]): int(own[i]) for i in range(lo, hi)}

                def find(c: int, root: dict[int, int] = root) -> int:
                    while root[c] != c:
                        root[c] = c = root[root[c]]
                    return c

                for i in range(lo, hi):
                    for mate in mates[i]:
                        a, b = find(int(own[i])), find(int(own[place[mate][0]]))
                        if a != b and any(alike(hashes[i], hashes[j], percent) for j in place[mate]):
                            root[max(a, b)] = min(a, b)
                            links.append((int(id_[i]), mate))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=_PAIRS)

    full = found.join(sets.select("id", "hashes"), "id").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return full.select("key", "x", "y", "id", "component", "mates", "hashes").mapInArrow(run, "a long, b long")


def _mixed(found: DataFrame, components: DataFrame) -> DataFrame:
    """key, id, component, main, q, t: members of buckets that hold several components, with their bucket's commonest one,
    and how many members are outside it (q) and in all (t). found: key, id of buckets' members."""
    named = found.select("key", "id").join(components, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    named = materialize(named, "named")
    sizes = named.groupBy("key", "component").count()
    mixed = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("_c"), F.sum("count").alias("_t"), F.max(F.struct("count", "component")).alias("_m")).filter("_c > 1")
    mixed = materialize(mixed.select("key", F.col("_m.component").alias("main"), (F.col("_t") - F.col("_m.count")).alias("q"), F.col("_t").alias("t")), "mixed")
    members = materialize(hot_join(named, mixed, "key"), "members")
    discard(named)
    discard(mixed)
    return members


def _to_main(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member outside its bucket's commonest component with two members of that, drawn by a hash."""
    place = F.xxhash64("key", "id")
    drawn = members.filter("component = main").groupBy("key").agg(F.array_distinct(F.array(F.min_by("id", place), F.max_by("id", place))).alias("drawn"))
    outside = materialize(members.filter("component <> main").select("key", "id"), "outside")
    pairs = hot_join(outside, drawn, "key").select(F.col("id").alias("a"), F.explode("drawn").alias("b")).distinct()
    return pairs


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components, enough to join all that are linked.

    In each bucket the members outside its commonest component are compared with all members. A bucket of up to BLOCK
    members is one group; larger ones are dealt into blocks of about that size, and each pair of blocks is a group. Of a
    group, registers are compared first; full sets are fetched for members of pairs that the estimate lets through, and
    only links come out, fewer than the group has members.
    """
    whole, ours = F.col("t") <= BLOCK, F.col("component") != F.col("main")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    place = lambda c: F.pmod(F.xxhash64("id"), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    one = members.filter(whole).select("key", F.lit(0).alias("x"), F.lit(0).alias("y"), F.when(ours, 7).otherwise(2).alias("side"), "id", "component")
    left = members.filter(~whole & ours).select("key", place("q").alias("x"), every("t").alias("y"), F.lit(5).alias("side"), "id", "component")
    right = members.filter(~whole).select("key", every("q").alias("x"), place("t").alias("y"), F.when(ours, 6).otherwise(2).alias("side"), "id", "component")
    rows = materialize(one.unionByName(left).unionByName(right), "blocks")
    signed = hot_join(rows, sets.select("id", "n", "registers"), "id")
    candidates = materialize(_candidates(signed, percent), "candidates")
    links = materialize(_checked(candidates, sets, percent), "links-across")
    discard(rows)
    discard(candidates)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    Words are lower-cased (A-Z) and parted by ASCII white space; a set has the distinct runs of width words. Documents
    with 100 * intersection >= percent * union are linked, and component_id is the least doc_id that links reach.
    Documents without words are linked with nothing. A null doc_id has no component and is kept; rows with one doc_id
    count as one document. An empty table gives an empty result. Long texts are read whole; other columns are not read.

    Equal sets are one class, which its least id stands for. Classes that share a band's bucket are candidates. Each
    class is first compared with the neighbours that precede it in most of its buckets; then those outside the commonest
    component of a bucket with two members of that; then, bucket by bucket, all members that are still in different
    components, in blocks of bounded size. Registers decide which pairs are
    worth an exact check, so full sets are read for few; of each block only as many links come out as it takes to join
    it. No candidate link is lost, no pair is compared that shares no bucket, and nothing is gathered on the driver.
    """
    ship(docs.sparkSession)
    signed = materialize(_signed(docs, width), "signed")
    linked = signed.filter("n > 0 and doc_id is not null")
    classes = linked.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "bands")).alias("c"))
    banded = classes.select(F.explode("c.bands").alias("key"), F.col("c.doc_id").alias("id"), F.col("c.n").alias("n"))
    found = materialize(_neighbours(banded), "buckets")
    edges = found.filter("edge > 0").withColumn("_was", F.lag(F.struct("key", "id")).over(Window.orderBy("key", "id", "edge")))
    stitched = edges.filter((F.col("edge") % 2 == 1) & (F.col("_was.key") == F.col("key")) & (F.col("_was.id") != F.col("id"))).select("id", F.col("_was.id").alias("prev"))
    neighbours = found.filter("prev is not null").select("id", "prev").unionByName(stitched)
    ranked = neighbours.groupBy("id", "prev").count().groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "prev")), False), 1, FIRST).alias("m"))  # at most BANDS in a list
    pairs = ranked.select(F.col("id").alias("a"), F.explode("m.prev").alias("b"))
    sets = materialize(_sets(docs, found.select("id").distinct(), width), "sets")
    first = materialize(_verified(pairs, sets, percent), "links-first")
    stars = connected_components(first, contract=True)
    members = _mixed(found, stars)
    second = materialize(_verified(_to_main(members), sets, percent), "links-second")
    joined = connected_components(stars.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second), contract=True)
    discard(members)
    members = _mixed(found, joined)
    last = _across(members, sets, percent)
    components = connected_components(joined.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(last), contract=True)

    of_class = classes.select("set_key", F.col("c.doc_id").alias("id")).join(components, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    of_class = materialize(of_class, "classes")
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    rows = materialize(rows, "rows")
    for old in (signed, found, sets, first, stars, second, joined, members, last, components):
        discard(old)
    joined = hot_join(rows, of_class, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
