"""The corpus pipeline: each stage takes the documents that the stage before has kept, written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import langid, minhash, packing, quality, secrets
from shardloom.llm.common import materialize, scratch_root, table, unused
from shardloom.llm.pretokens import vocabulary
from shardloom.operators.order import with_place

#: Documents whose language is told with less confidence than this are rejected, as are those that are und.
LEAST_CONFIDENCE = 0.3
#: Documents scored below this are rejected.
LEAST_QUALITY = 0.3
#: The ledger of secret scans in the shared folder, which all runs add to.
LEDGER = secrets.LEDGER


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null or have no letter, and those whose language can't be told. Rows stay where they are.

    Repeated rows are told alike, a null doc_id is kept like any other, columns may have any names, and an empty table
    gives an empty one.
    """
    told = unused(docs, "told")
    rows = docs.withColumn(told, langid.predicted(docs, langid.fit(docs)))
    return rows.filter((F.col(f"{told}.lang") != "und") & (F.col(f"{told}.score") >= LEAST_CONFIDENCE)).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores low.

    Null and empty texts are scored as empty ones; long texts are scored whole; repeated rows are scored alike; rows
    with a null doc_id are scored but not learned from; columns may have any names, and an empty table gives an empty
    one.
    """
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return docs.withColumn(score, quality.scored(docs, net)).filter(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near-duplicates (five words, 0.8), and one row of those
    that repeat both doc_id and text. Different texts under one doc_id are documents of their own, in order of their
    SHA-256. Rows with a null doc_id stay."""
    named = docs.filter("doc_id is not null")
    if named.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _least_of_each(named, "doc_id").unionByName(docs.filter("doc_id is null"))
    address, place = unused(docs, "address"), unused(docs, "place")
    rows = named.withColumn(address, F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))).dropDuplicates(["doc_id", address])
    places = with_place(rows.select("doc_id", address), ["doc_id", address], place)
    rows = materialize(rows.join(places, ["doc_id", address]), "versions")
    return _least_of_each(rows, place).select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def _least_of_each(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key, of which each has its own, is the least of its group of near-duplicates."""
    groups = minhash.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), width=5, percent=80)
    return rows.join(groups.filter("kept").select(F.col("doc_id").alias(key)), key, "left_semi").select(*rows.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in every text; documents stay. Texts that the ledger has from earlier runs aren't scanned again.

    Null and empty texts stay as they are; a text is scanned once however many rows repeat it, and masked in all of
    them; n_chars follows the text; columns may have any names, and an empty table gives an empty one.
    """
    return secrets.redact(docs, ledger_path=f"{scratch_root(spark)}/{LEDGER}")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences of 1024 tokens.

    A null or empty text is one piece, the end id; long texts are cut into whole sequences; repeated rows and null ids
    are packed like any other; other columns are dropped, and an empty table gives an empty one.
    """
    return packing.pack(packing.piece_documents(docs, vocabulary("byte_bpe_50k.json"), ids=False))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Languages, quality and packing come from learned models and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
