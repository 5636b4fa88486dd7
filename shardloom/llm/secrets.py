"""Secret scans over content-addressed blobs, with a ledger of what has been scanned by which rules. Native only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import discard, hot_join, materialize, unused

RULES_VERSION = "3"
#: The ledger in the folder that driver and executors share, which all runs with that folder add to.
LEDGER = "shardloom/secrets-ledger"

#: Kind -> (pattern, group whose length counts, least length). The first three are the base.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
MORE = {
    "private_key": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    "forge_token": (r"gh[pousr]_[A-Za-z0-9]{30,}", 0, 0),
    "chat_token": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "web_token": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
}
KINDS = [*BASE, *MORE]
_EOL = r"(?:\r\n|\r|\n|\\r\\n|\\r|\\n)"
#: What of a kind is found in place of its pattern above, which says where one begins. A private key goes
#: on to the END line of its label, if that comes before another BEGIN; else over its headers and the lines of base64
#: that follow (line ends may be written as escapes, and long runs may have blank lines or spaces between them).
WHOLE = {
    "private_key": (
        r"-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----"
        rf"|(?:{_EOL}[ \t]*(?:Proc-Type|DEK-Info):[^\r\n\\]*)*+(?:{_EOL}[ \t]*(?={_EOL}))?+"
        rf"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/]{{24,}}+={{0,2}}|{_EOL}[ \t]*[A-Za-z0-9+/]++={{0,2}}(?=[ \t]*(?:[\r\n\\\"'<]|\z)))*+)"
    ),
}
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def spans_of(text: Column, kind: str) -> Column:
    """All places of a kind, in code points: the texts between matches and the matches' own lengths, added up."""
    pattern, group, least = (BASE | MORE)[kind]
    pattern = WHOLE.get(kind, pattern)
    lit = F.lit(pattern)
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.arrays_zip(F.transform(F.regexp_extract_all(text, lit, F.lit(0)), lambda x: F.length(x)).alias("whole"), F.transform(F.regexp_extract_all(text, lit, F.lit(group)), lambda x: F.length(x)).alias("part"), between.alias("before"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["before"]
        end = start + x["whole"]
        span = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
        # the last text between matches has no match behind it
        return F.when(x["whole"].isNull(), state).otherwise(F.struct(end.alias("at"), F.when(x["part"] >= least, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans")))

    return F.when(F.regexp_like(text, lit), F.aggregate(found, zero, add, lambda s: s["spans"])).otherwise(F.array().cast(_SPANS))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def blobs(docs: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Every version of every document under its content's address; a null text is the empty blob."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *extra, F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("_text"))


def open_ledger(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The ledger (blob, rules, spans), a Parquet folder that every scan appends to; None if there is none yet."""
    if path is None:
        return None
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return None
    return spark.read.schema(f"blob binary, rules string, spans {_SPANS}").parquet(path)


def scan(docs: DataFrame, ledger_path: str | None = None, rules: str = RULES_VERSION) -> tuple[DataFrame, DataFrame]:
    """(paths: doc_id, blob; findings: blob, spans) over every row of docs, whatever its other columns are.

    Each blob that the ledger doesn't have under these rules is scanned once, from one of its documents; one document
    of each is found by ids and addresses alone, so a text is moved at most once. What is new goes to the ledger, if
    there is one, and findings are those of old and new blobs together. Only blobs with findings have a row there, but
    the ledger also remembers the clean ones.
    """
    spark = docs.sparkSession
    paths = materialize(blobs(docs).select("doc_id", "blob"), "paths")
    holders = paths.groupBy("blob").agg(F.max(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))).alias("_holder"))
    ledger = open_ledger(spark, ledger_path)
    if ledger is not None:
        ledger = ledger.filter(F.col("rules") == rules)
        holders = holders.join(ledger.select("blob"), "blob", "left_anti")
    texts = blobs(docs).withColumn("_holder", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))).drop("doc_id")
    unseen = texts.join(holders, ["_holder", "blob"], "left_semi")
    spans = F.array_sort(F.concat(*[spans_of(F.col("_text"), k) for k in KINDS]))
    fresh = unseen.select("blob", F.lit(rules).alias("rules"), spans.alias("spans"))
    # rows that are repeated with id and text are scanned from each copy and counted once
    fresh = materialize(fresh.dropDuplicates(["blob"]) if ledger_path is not None else fresh.filter(F.size("spans") > 0).dropDuplicates(["blob"]), "scanned")
    found = fresh if ledger is None else fresh.unionByName(ledger)
    if ledger_path is not None:
        found = materialize(found.filter(F.size("spans") > 0).dropDuplicates(["blob"]), "found")
        fresh.write.mode("append").parquet(ledger_path)
        discard(fresh)
    return paths, found.filter(F.size("spans") > 0).select("blob", "spans")


def secrets(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of docs.

    Null and empty texts have no findings. Every path to a blob has its findings; a blob that a third of all documents
    share is joined by broadcast of its one row. An empty table gives an empty result.
    """
    paths, found = scan(docs, ledger_path)
    rows = hot_join(paths, found, "blob", "left").select("doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("s"))
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("s", lambda x: x["kind"] < len(BASE))
    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]", ledger_path: str | None = None) -> DataFrame:
    """docs with every finding in text replaced by the mask (overlapping ones by one), and n_chars set anew if there."""
    _, found = scan(docs, ledger_path)
    names = docs.columns
    blob, spans = unused(docs, "blob"), unused(docs, "spans")
    rows = docs.withColumn(blob, F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)))
    joined = hot_join(rows, found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), blob, "left")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(s: Column, x: Column) -> Column:
        fresh = F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))), F.when(x["start"] >= s["at"], F.lit(mask)).otherwise(""))
        return F.when(x["end"] <= s["at"], s).otherwise(F.struct(x["end"].alias("at"), fresh.alias("out")))

    clean = F.aggregate(spans, state, put, lambda s: F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1, F.length("text"))))
    out = joined.withColumn("text", F.when(F.col(spans).isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*names)
