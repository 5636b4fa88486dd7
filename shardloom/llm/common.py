"""What several operators share: text passes through Python, joins that stand hot keys, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.session import discard, materialize, scratch_path, scratch_root, ship, table

__all__ = ["connected_components", "crc_fold", "discard", "hot_join", "map_rows", "materialize", "scratch_path", "scratch_root", "ship", "table", "unused"]

#: A join key is hot beyond this many rows; and at most HOT_KEYS keys are hot, so their list can be broadcast.
HOT_ROWS, HOT_KEYS = 1_000, 500


def map_rows(df: DataFrame, columns: list[str], make: Callable[[], Callable], schema: str) -> DataFrame:
    """Run make()(*column lists) -> lists of the result's columns over every batch; make() runs once a task."""
    ship(df.sparkSession)
    from pyspark.sql.types import _parse_datatype_string

    arrow = _arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = fn(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def _arrow_schema(struct) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to clash with no column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds).cast("long"))


def hot_join(rows: DataFrame, values: DataFrame, key: str, how: str = "inner", threshold: int = HOT_ROWS) -> DataFrame:
    """Join rows (many a key) with values (one row a key). Keys with many rows are joined by broadcast, which leaves
    their rows where they are; the others by a shuffle. rows should be a table, as it is read three times.

    At most HOT_KEYS keys count as hot (those with over 1/HOT_KEYS of all rows, and over the threshold), so the
    broadcast side has at most HOT_KEYS rows whatever the size of the input.
    """
    total = rows.count()
    limit = max(threshold, total // HOT_KEYS)
    hot = [r[0] for r in rows.groupBy(key).count().filter(F.col("count") > limit).select(key).collect() if r[0] is not None]
    if not hot:
        return rows.join(values, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return rows.filter(is_hot).join(F.broadcast(values.filter(is_hot)), key, how).unionByName(rows.filter(~is_hot).join(values.filter(~is_hot), key, how))


def _pointing(stars: DataFrame) -> DataFrame:
    """Every node of finished stars with its root."""
    return stars.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


#: Links that one task contracts at most, and tasks that contract at least.
TASK_LINKS, LEAST_TASKS = 500_000, 8


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """Each task's share of the links, as stars: every node it has with the least one that its own links reach."""
    ship(links.sparkSession)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.setdefault(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root[x]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        nodes = [x for x in root if find(x) != x]
        for at in range(0, len(nodes), 10_000):
            part = nodes[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], schema=out)

    return links.repartition(tasks).select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame, max_rounds: int = 60, contract: bool = False) -> DataFrame:
    """(a, b) links -> (id, component): the smallest id that each linked id reaches.

    Alternates the two star operations (every node links its larger neighbours, then its smaller ones, to the smallest
    neighbour) until the links no longer change; then each node points at its root. Minima are pre-aggregated before
    they are shuffled, the joins with them are ones that Spark splits where a node is hot, every round is written to the
    shared folder, and only counts reach the driver. Null ends and self-links are ignored; no links give no rows. The result is a written table.

    contract (for long ids, in Python): links are first dealt over LEAST_TASKS tasks or more, of at most TASK_LINKS
    each, which turn theirs into stars, from which the rounds go on.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    links = materialize(links, "links")
    if contract:
        whole = links
        links = materialize(_contracted(whole, max(LEAST_TASKS, -(-whole.count() // TASK_LINKS))).distinct(), "links")
        discard(whole)
    signature = None
    for _ in range(max_rounds):
        stamp = tuple(links.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if stamp == signature or not stamp[0]:
            pointing = materialize(_pointing(links), "components")
            discard(links)
            return pointing
        signature = stamp
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = materialize(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        following = materialize(small, "links")
        for old in (links, large):
            discard(old)
        links = following
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
