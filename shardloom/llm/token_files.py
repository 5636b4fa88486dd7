"""Flat token files: one run of fixed-width ids, documents ended by a separator id, no index. Writing and counting."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.bpe import text_encoder
from shardloom.llm.common import materialize, ship
from shardloom.llm.pretokens import END_OF_TEXT_ID, slices


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, separator: int = END_OF_TEXT_ID, width: int = 2) -> DataFrame:
    """Write one flat file a task under path (a folder that all executors share) and return what went where: file,
    document (place in the file, from 0), doc_id.

    The separator's own text inside a document is encoded as ordinary text, so separators only end documents. A null
    text is an empty document, a null doc_id stays null, repeated rows are documents of their own, and other columns
    aren't read. An id that doesn't fit into width bytes is an error. A task that is run again writes the same file anew, under a name of its own until it is
    whole. A task without rows writes no file.
    """
    ship(docs.sparkSession)
    kind = {2: "<u2", 4: "<u4"}[width]
    if separator >= 1 << 8 * width:
        raise ValueError(f"the separator doesn't fit into {width} bytes")
    out = pa.schema([("file", pa.string()), ("document", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary_path, special=False)
        context = TaskContext.get()
        store, folder = _store(path)
        store.create_dir(folder, recursive=True)
        name = f"tokens-{context.partitionId():06d}.bin"
        partial = f"{folder}/.{name}.{context.taskAttemptId()}"
        end = np.array([separator], kind).tobytes()
        written = 0
        sink = None
        for whole in batches:
            for batch in slices(whole, 1):
                sink = sink or store.open_output_stream(partial)
                for ids in encoder.ids(batch.column(1)):
                    values = np.frombuffer(ids, "<u4")
                    if values.size and values.max() >= 1 << 8 * width:
                        raise ValueError(f"id {values.max()} doesn't fit into {width} bytes")
                    sink.write(values.astype(kind).tobytes() + end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(written, written + n), pa.int64()), batch.column(0).cast(pa.int64())], schema=out)
                written += n
        if sink is not None:
            sink.close()
            store.move(partial, f"{folder}/{name}")

    return materialize(docs.select("doc_id", "text").mapInArrow(run, "file string, document long, doc_id long"), "token-manifest")


def token_counts(spark: SparkSession, path: str, separator: int = END_OF_TEXT_ID, width: int = 2, block_tokens: int = 4 << 20) -> DataFrame:
    """file, document (place in the file), start, n_tokens (without the separator), ended, for flat files under path.

    Files are cut into blocks that any task can read alone; a vectorised search finds the separators of a block. A
    document that begins in an earlier block is stitched by a prefix scan over the blocks of its file: the separators
    before a block, and the last one's place. Tokens after the last separator are a document that hasn't ended. Files
    that are empty or missing give no rows; a size that isn't whole tokens is an error. The scan is done when this
    returns; its separators are kept in the shared folder, and the files aren't read again.
    """
    ship(spark)
    kind = {2: "<u2", 4: "<u4"}[width]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", (F.col("length") / width).cast("long").alias("tokens"), (F.col("length") % width).alias("rest"))
    blocks = files.filter("tokens > 0 or rest > 0").select("path", "tokens", "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block_tokens).cast("long"))).alias("block"))
    out = pa.schema([("file", pa.string()), ("block", pa.int64()), ("tokens", pa.int64()), ("nth", pa.int64()), ("place", pa.int64()), ("before", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, tuple] = {}
        for batch in batches:
            for uri, tokens, rest, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rest:
                    raise ValueError(f"{uri} isn't whole tokens")
                folder, _, name = uri.rpartition("/")
                if folder not in stores:
                    stores[folder] = _store(folder)
                store, at = stores[folder]
                with store.open_input_file(f"{at}/{name}") as source:
                    source.seek(block * block_tokens * width)
                    ids = np.frombuffer(source.read(block_tokens * width), kind)
                places = np.flatnonzero(ids == separator) + block * block_tokens
                # a row for the block itself too (nth -1), so that blocks and files without separators count
                n = places.size + 1
                nth = np.arange(-1, places.size)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.full(n, block)), pa.array(np.full(n, tokens)), pa.array(nth), pa.array(np.concatenate([[-1], places])), pa.array(np.concatenate([[-1, -1], places[:-1]])[:n])], schema=out)

    found = materialize(blocks.repartition(F.col("path"), F.col("block")).mapInArrow(scan, "file string, block long, tokens long, nth long, place long, before long"), "separators")
    summary = found.groupBy("file", "block", "tokens").agg(F.max("nth").alias("last_nth"), F.max("place").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = summary.select("file", "block", "tokens", F.coalesce(F.sum(F.col("last_nth") + 1).over(earlier), F.lit(0)).alias("documents_before"), F.coalesce(F.max("last").over(earlier), F.lit(-1).cast("long")).alias("last_before"))
    ends = found.filter("nth >= 0").drop("tokens").join(stitched, ["file", "block"])
    begin = F.when(F.col("nth") == 0, F.col("last_before")).otherwise(F.col("before")) + 1
    whole = ends.select("file", (F.col("documents_before") + F.col("nth")).alias("document"), begin.alias("start"), (F.col("place") - begin).alias("n_tokens"), F.lit(True).alias("ended"))
    totals = summary.groupBy("file").agg(F.max("tokens").alias("tokens"), F.sum(F.col("last_nth") + 1).alias("document"), F.max("last").alias("last"))
    open_end = totals.filter("last < tokens - 1").select("file", "document", (F.col("last") + 1).alias("start"), (F.col("tokens") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return whole.unionByName(open_end)
