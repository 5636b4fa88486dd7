"""Best-fit packing planned on counts of lengths; pieces then take planned slots by their rank within a length."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.bpe import text_encoder
from shardloom.llm.common import materialize, ship
from shardloom.llm.pretokens import slices


def _ranks(capacity: int, where: int):
    """A function that adds to batches the task and each row's place among the task's rows of its length."""
    seen = np.zeros(capacity + 1, np.int64)
    task = TaskContext.get().partitionId()

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = batch.column(where).to_numpy(zero_copy_only=False).astype(np.int64)
        if lengths.size and not 0 < lengths.min() <= lengths.max() <= capacity:
            raise ValueError(f"lengths must be 1 to {capacity}")
        order = np.argsort(lengths, kind="stable")
        counts = np.bincount(lengths, minlength=capacity + 1)
        ranks = np.empty(lengths.size, np.int64)
        ranks[order] = np.arange(lengths.size) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
        np.add(seen, counts, out=seen)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(lengths.size, task, np.int32)), pa.array(ranks)], names=[*batch.schema.names, "_task", "_local"])

    return add


def piece_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit; if wanted), ids_crc32, and for pack() the task
    and the place within it (_task, _local), so that one Python worker does both. Each document's ids end with end_id.

    Documents of more than capacity ids are cut so that only the first piece may be shorter. A null or empty text has
    one piece, of end_id alone; a null doc_id stays null, repeated rows are documents of their own, long texts are
    encoded whole, other columns aren't read, and an empty table gives an empty result. Texts stay where they are; only
    these rows go on.
    """
    ship(docs.sparkSession)
    with_ids = ids
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        tail = end_id.to_bytes(4, "little")
        add = _ranks(capacity, 3)
        for whole in batches:
            for batch in slices(whole, 1):
                rows = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1)), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    ends = range(n - (n - 1) // capacity * capacity, n + 1, capacity)
                    for piece, end in enumerate(ends):
                        start = max(0, end - capacity) if piece else 0
                        part = ids[4 * start : 4 * end]
                        rows.append((doc_id, piece, start, end - start, part, zlib.crc32(part)))
                made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
                yield add(made if with_ids else made.drop_columns(["ids"]))

    kinds = "ids binary, " if ids else ""
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, piece int, start long, length long, {kinds}ids_crc32 long, _task int, _local long")


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, first sequence, slots a sequence, first offset) rows.

    All sequences with the same contents are one group, so the work depends on the lengths, not on how many pieces
    have them. Pieces of a length go to the fullest groups with room, as many a sequence as fit, and open new sequences
    only when no group has room.
    """
    open_groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []
    closed: list[tuple[list[tuple[int, int]], int]] = []

    def keep(room: int, contents: list[tuple[int, int]], count: int) -> None:
        if not count:
            return
        if not room:
            closed.append((contents, count))
            return
        if room not in open_groups:
            open_groups[room] = []
            bisect.insort(rooms, room)
        open_groups[room].append((contents, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        after: list[tuple[int, list[tuple[int, int]], int]] = []

        def fill(room: int, contents: list[tuple[int, int]], count: int) -> int:
            """Put what is left of this length into count equal sequences; how many of them weren't needed."""
            nonlocal left
            each = room // length
            full = min(count, left // each)
            if full:
                after.append((room - each * length, [*contents, (length, each)], full))
                left -= full * each
            if left and full < count:
                after.append((room - left * length, [*contents, (length, left)], 1))
                left, full = 0, full + 1
            return count - full

        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fill(capacity, [], -(-left // (capacity // length)))
                break
            room = rooms.pop(at)
            groups = open_groups.pop(room)
            while groups and left:
                contents, count = groups.pop()
                if rest := fill(room, contents, count):
                    groups.append((contents, rest))
            for contents, count in groups:
                keep(room, contents, count)
        for item in after:
            keep(*item)
    rows, sequence, ranks = [], 0, dict.fromkeys(histogram, 0)
    for contents, count in [*closed, *(g for room in rooms for g in open_groups[room])]:
        offset = 0
        for length, each in contents:
            rows.append((length, ranks[length], sequence, each, offset))
            ranks[length] += each * count
            offset += length * each
        sequence += count
    return sorted(rows)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """All columns of pieces, with sequence_id and offset. pieces needs a long column length of 1 to capacity.

    Counts of lengths (at most capacity numbers) reach the driver, and the plan, whose rows depend on the lengths alone,
    goes back to the tasks. A piece's rank within its length is its place in its task plus the counts of the tasks
    before; so no length, however common, is gathered in one place. Repeated rows are packed as often as they occur.
    Columns named sequence_id or offset are replaced; _task and _local must be those of piece_documents(), or are
    dropped if only one is there. An empty table gives an empty result.
    """
    ship(pieces.sparkSession)
    ready = {"_task", "_local"} <= set(pieces.columns)
    pieces = pieces.drop("sequence_id", "offset") if ready else pieces.drop("sequence_id", "offset", "_task", "_local")
    names = [c for c in pieces.columns if c not in ("_task", "_local")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in names)
    where = names.index("length")

    def local_rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(_ranks(capacity, where), batches)

    if not ready:
        pieces = pieces.select(*names).mapInArrow(local_rank, f"{schema}, `_task` int, `_local` long")
    ranked = materialize(pieces.select(*names, "_task", "_local"), "pieces")
    counts = ranked.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    histogram = {r[0]: r[1] for r in ranked.groupBy("length").count().collect()}
    table = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    bounds = np.searchsorted(table[:, 0], np.arange(capacity + 2))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(where).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            row = np.empty(lengths.size, np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                row[mine] = bounds[length] + np.searchsorted(table[bounds[length] : bounds[length + 1], 1], ranks[mine], "right") - 1
            slot = ranks - table[row, 1]
            sequence = table[row, 2] + slot // table[row, 3]
            offset = table[row, 4] + slot % table[row, 3] * lengths
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    joined = ranked.join(before, ["length", "_task"]).select(*names, (F.col("_local") + F.col("_before")).alias("_rank"))
    return joined.mapInArrow(take, f"{schema}, sequence_id long, offset long")
