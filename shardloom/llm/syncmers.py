"""Document fingerprints of closed syncmers: stretches of k characters whose least inner stretch lies at an edge.

Whether a stretch is one depends on its own characters alone, so an edit changes only the anchors that it touches.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import ship

K, S = 12, 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _stretches(x: np.ndarray, width: int) -> np.ndarray:
    """A hash of every stretch of so many characters."""
    n = len(x) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out *= np.uint64(0x100000001B3)
        out += x[i : i + n]
    return _mix(out)


def _syncmers(x: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes of all closed syncmers of a sequence of code points."""
    if len(x) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    inner = _stretches(x, s)
    width = k - s + 1
    n = len(x) - k + 1
    least, have = inner, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    closed = np.flatnonzero((inner[:n] == least) | (inner[width - 1 : width - 1 + n] == least))
    # a hash of k characters from those of its two ends and middle, which cover it
    parts = inner[closed] ^ inner[closed + k - s] * np.uint64(3) * _ODD + inner[closed + (k - s + 1) // 2] * np.uint64(5) * _ODD
    return closed, (_mix(parts) >> np.uint64(32)).astype(np.uint32)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


@dataclass
class Anchors:
    """All anchors of a text, in order of place, repeats included."""

    places: np.ndarray
    hashes: np.ndarray

    def keys(self) -> np.ndarray:
        """Hash and how often it has occurred before, which names every anchor once."""
        order = np.argsort(self.hashes, kind="stable")
        ordered = self.hashes[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        nth = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
        out = np.empty(len(order), np.uint64)
        out[order] = ordered.astype(np.uint64) << np.uint64(32) | nth.astype(np.uint64)
        return out


def _or_whole(text: str, places: np.ndarray, hashes: np.ndarray) -> Anchors:
    if text and not len(places):
        return Anchors(np.zeros(1, np.int64), np.frombuffer(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "<u4"))
    return Anchors(places, hashes)


def anchors(text: str | None, k: int = K, s: int = S) -> Anchors:
    """The closed syncmers of the whole text: place and hash of each.

    A text of fewer than k characters is one anchor of its own; an empty text has none.
    """
    return _or_whole(text or "", *_syncmers(_points(text or ""), k, s))


def edited_anchors(own: Anchors, text: str, kept: int, k: int = K, s: int = S) -> Anchors:
    """anchors(text), where own are those of a text that has its first characters, kept of them, in common with it.

    Being free of context, anchors within the kept characters stay; only those that reach beyond are found anew.
    """
    if kept < k:
        return anchors(text, k, s)
    stay = np.searchsorted(own.places, kept - k, "right")
    begin = kept - k + 1
    places, hashes = _syncmers(_points(text[begin:]), k, s)
    return _or_whole(text, np.concatenate([own.places[:stay], places + begin]), np.concatenate([own.hashes[:stay], hashes]))


def fingerprint(found: Anchors) -> str:
    """All anchors as text: base64 of each one's distance from the one before (as a run of sevens of bits, the lowest
    first, the high bit set where more follow) and of its hash (four bytes, the lowest first)."""
    steps = np.diff(found.places, prepend=0)
    if (steps < 128).all():
        out = np.empty((len(steps), 5), np.uint8)
        out[:, 0] = steps
        out[:, 1:] = np.ascontiguousarray(found.hashes, "<u4").view(np.uint8).reshape(-1, 4)
        return base64.b64encode(out.tobytes()).decode()
    data = bytearray()
    for step, value in zip(steps.tolist(), found.hashes.tolist(), strict=True):
        while step >= 128:
            data.append(step & 127 | 128)
            step >>= 7
        data.append(step)
        data += value.to_bytes(4, "little")
    return base64.b64encode(data).decode()


def parse(text: str) -> Anchors:
    """The anchors of a fingerprint."""
    data, places, hashes, at, place = base64.b64decode(text), [], [], 0, 0
    while at < len(data):
        step = shift = 0
        while True:
            step |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                break
        place += step
        places.append(place)
        hashes.append(int.from_bytes(data[at : at + 4], "little"))
        at += 4
    return Anchors(np.array(places, np.int64), np.array(hashes, np.uint32))


def likeness(a: Anchors, b: Anchors) -> float:
    """0 to 1: of all anchors of both together, the share that both have in the same order of places.

    The nth occurrence of a hash in one text is matched with the nth in the other.
    """
    if not len(a.places) or not len(b.places):
        return float(len(a.places) == len(b.places))
    _, in_a, in_b = np.intersect1d(a.keys(), b.keys(), assume_unique=True, return_indices=True)
    there = in_b[np.argsort(in_a)]
    ordered = len(there) if (there[1:] > there[:-1]).all() else _longest_rising(there.tolist())
    return ordered / (len(a.places) + len(b.places) - len(there))


def _longest_rising(values: list[int]) -> int:
    chain: list[int] = []
    for value in values:
        if not chain or value > chain[-1]:
            chain.append(value)
        else:
            chain[bisect_left(chain, value)] = value
    return len(chain)


def likeness_of(a: str, b: str) -> float:
    """likeness() of two fingerprints as text."""
    return likeness(parse(a), parse(b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every document.

    The next document is the one with the next doc_id in ascending order (null first; equal ids by their text), and
    the first one after the last; a table of one document has itself next. Null texts count as empty. An empty table
    gives an empty result.

    Fingerprints hold all anchors of the whole texts, and likeness is that of all anchors. Long texts take memory in
    proportion to the longest one; repeated rows (an id and a text) each have the row after them next, like equal ids;
    other columns are not read.

    Ids are cut at quantiles into ranges, which are dealt out whole and sorted; a copy of the document after its last
    one goes along with each range. So a text is moved once, and no range is held in memory.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("k"))
    ranges = min(4096, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("k"))
    cuts = np.unique(np.array(ids.select(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or [], np.int64))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(np.int64), "right").astype(np.int32))

    firsts = sorted((r[1], r[0]) for r in ids.groupBy(range_of("k").alias("range")).agg(F.min("k").alias("k")).collect())
    # what the first document of a range is next to: the range before, and the last range for the first of all
    before = {k: firsts[i - 1][1] for i, (k, _) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def ranges_of(k: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, k.to_numpy(np.int64), "right")
        return pd.Series([[int(r), before[x]] if x in before else [int(r)] for r, x in zip(own, k.tolist(), strict=True)])

    dealt = rows.select("doc_id", "text", "k", F.posexplode(ranges_of("k")).alias("ahead", "range"))
    dealt = dealt.repartition(ranges, "range").sortWithinPartitions("range", "ahead", "k", "text").select("range", "ahead", "doc_id", "text")
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, found = whole.slice(at, 256), []
                for now, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if ahead and (last is None or last[0] != now or last[1]):
                        continue  # only the first of equal ids is next to anything
                    text = text or ""
                    mine = (now, ahead, doc_id, text, anchors(text))
                    if last is not None and last[0] == now and not last[1]:
                        _, _, its_id, its_text, its = last
                        n = len(its_text)
                        q = n // 4
                        edited = its_text[: n - q] + text[:q]
                        changed = edited_anchors(its, edited, n - q)
                        found.append((its_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(its), fingerprint(changed), likeness(its, changed), likeness(its, mine[4])))
                    last = mine
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), out, strict=True)], schema=out)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
