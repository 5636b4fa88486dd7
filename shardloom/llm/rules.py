"""Quality rules whose thresholds come from mergeable quantile sketches of each language and source. Native only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import materialize

#: White space between words, and symbols.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Metric -> its value, in ten-thousandths or hundredths.
METRICS = {
    "symbols": "cast(10000 * n_symbols / greatest(word_chars, 1) as long)",
    "dup_lines": "cast(10000 * n_dup_lines / greatest(n_lines, 1) as long)",
    "repeats": "cast(10000 * n_repeat_words / greatest(n_words, 1) as long)",
    "word_length": "cast(100 * word_chars / greatest(n_words, 1) as long)",
}
#: The metrics that together reject a document which is outside the inner fences of both.
TOGETHER = ("symbols", "word_length")
#: So many values of the wider group weigh as much as a group's own, whatever its size.
PRIOR = 20
#: Limits of a metric: the outer fence, beyond which it decides alone, as a sketch's bucket; the inner fences as values.
LIMITS = ("outer_most", "inner_least", "inner_most")


def text_metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of whole texts.

    Windows of five words are compared by 64-bit hashes within a document. Only documents in which a window repeats
    pay for finding the words that such windows cover: the places of repeated windows in order, each of which adds the
    words up to the next one's start, five at most.
    """
    names = [k for k in keep if k != "text"]
    base = docs.select(*names, F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    split = base.withColumns(
        {
            "_words": F.expr(r"filter(split(_t, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"),
            "_lines": F.expr(r"filter(split(_t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
            "word_chars": F.length(F.regexp_replace("_t", GAP, "")).cast("long"),
            "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"),
        }
    ).drop("_t")
    counted = split.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    windows = counted.withColumn("_windows", F.expr("if(n_words >= 5, transform(sequence(0, cast(n_words as int) - 5), i -> xxhash64(_h[i], _h[i + 1], _h[i + 2], _h[i + 3], _h[i + 4])), array())")).drop("_h")
    sorted_ = windows.withColumn("_s", F.expr("if(size(array_distinct(_windows)) < size(_windows), array_sort(transform(_windows, (h, i) -> struct(h, i))), null)")).drop("_windows")
    places = sorted_.withColumn("_p", F.expr("array_sort(filter(transform(_s, (x, i) -> if((i > 0 and _s[greatest(i - 1, 0)].h = x.h) or (i < size(_s) - 1 and _s[least(i + 1, size(_s) - 1)].h = x.h), x.i, null)), p -> p is not null))")).drop("_s")
    return places.withColumn("n_repeat_words", F.expr("if(_p is null, 0L, aggregate(transform(_p, (p, i) -> if(i + 1 < size(_p), least(5, _p[least(i + 1, size(_p) - 1)] - p), 5)), 0L, (a, x) -> a + x))")).drop("_p")


def sketch_bucket(value: Column) -> Column:
    """The bucket of a count: itself below 32, then sixteen buckets for every doubling. Sketches merge by addition."""
    shift = F.length(F.bin(value)).cast("long") - 5
    return F.when(value < 32, value).otherwise(16 * shift + F.floor(value / F.pow(F.lit(2.0), shift)).cast("long"))


def bucket_top(bucket: Column) -> Column:
    """The largest value of a bucket."""
    shift = F.floor(bucket / 16) - 1
    return F.when(bucket < 32, bucket.cast("double")).otherwise((bucket % 16 + 17) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def thresholds(metrics: DataFrame, prior: int = PRIOR) -> DataFrame:
    """lang, source, and for each metric the columns of LIMITS; a row for every language and source.

    Fences stand off from the quartiles by multiples of their distance. Outer fences are three distances above the third
    quartile of the values that aren't zero, counted in the sketch's buckets, so by ratio, as such shares are skewed;
    inner fences one and a half beyond either quartile of all values. A group's
    limit is drawn towards that of its language, and a language's towards that of the whole table, as if the wider one
    had been seen prior times: (n * own + prior * wider) / (n + prior), rounded down. So no size switches anything, and
    a group of one document has nearly its language's limits.
    """
    values = F.array(*[F.struct(F.lit(name).alias("metric"), F.expr(expression).alias("value")) for name, expression in METRICS.items()])
    long = metrics.select("_lang", "_source", F.explode(values).alias("m")).select("_lang", "_source", "m.metric", sketch_bucket(F.col("m.value")).alias("bucket"))
    base = materialize(long.groupBy("_lang", "_source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")), "sketches")

    def fences(keys: list[str], tag: str) -> DataFrame:
        merged = base.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n")).withColumn("some", F.when(F.col("bucket") > 0, F.col("n")).otherwise(0))
        by = Window.partitionBy(*keys, "metric")
        ranked = merged.withColumns({f"{what}_{c}": F.sum(c).over(w) for c in ("n", "some") for what, w in (("upto", by.orderBy("bucket")), ("total", by))})
        at = lambda c, q: F.min(F.when((F.col(f"upto_{c}") * 4 >= F.col(f"total_{c}") * q) & ((F.lit(c) == "n") | (F.col("bucket") > 0)), F.col("bucket")))
        low, high, low_some, high_some = bucket_top(at("n", 1)), bucket_top(at("n", 3)), at("some", 1), at("some", 3)
        half = lambda x: F.floor(x / 2)
        limits = [F.coalesce(high_some + 3 * (high_some - low_some), F.lit(0)), low - half(3 * (high - low)), high + half(3 * (high - low))]
        sizes = [F.max("total_some"), F.max("total_n"), F.max("total_n")]
        return ranked.groupBy(*keys, "metric").agg(F.array(*[x.cast("long") for x in limits]).alias(tag), F.array(*sizes).alias(f"n_{tag}"))

    def drawn(own: str, wider: Column) -> Column:
        return F.transform(F.arrays_zip(F.col(own).alias("own"), F.col(f"n_{own}").alias("n"), wider.alias("wider")), lambda x: F.floor((x["n"] * x["own"] + prior * x["wider"]) / (x["n"] + prior)))

    wide = fences(["_lang"], "wide").join(F.broadcast(fences([], "all")), "metric").select("_lang", "metric", drawn("wide", F.col("all")).alias("wide"))
    best = fences(["_lang", "_source"], "own").join(wide, ["_lang", "metric"]).select("_lang", "_source", "metric", drawn("own", F.col("wide")).alias("limits"))
    pick = lambda name, i: F.max(F.when(F.col("metric") == name, F.col("limits")[i])).alias(f"{name}_{LIMITS[i]}")
    return best.groupBy("_lang", "_source").agg(*[pick(name, i) for name in METRICS for i in range(len(LIMITS))])


def accepted() -> Column:
    """The adaptive verdict over metrics joined with their group's limits."""
    value = {name: F.expr(expression) for name, expression in METRICS.items()}
    alone = [sketch_bucket(value[name]) <= F.col(f"{name}_outer_most") for name in METRICS]
    inside = [value[name].between(F.col(f"{name}_inner_least"), F.col(f"{name}_inner_most")) for name in TOGETHER]
    out = inside[0] | inside[1]
    for fits in alone:
        out = out & fits
    return out


def apply_rules(docs: DataFrame, most_broadcast: int = 20_000, salts: int = 64) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null texts have no words; null languages or sources are groups of their own; a null doc_id stays one. Repeated rows
    count as often as they occur. kept is false for base_failed documents, else the verdict of the adaptive thresholds:
    a document goes if any metric is beyond its outer fence, or symbols and word length are both outside their inner
    ones. Other columns are not read, long texts are counted whole, and an empty table gives an empty result. The
    thresholds' table is broadcast if it has at most most_broadcast rows; beyond that every key is dealt over salts, so
    that a hot source is spread.
    """
    # a null is told from the texts '-' and so on by a leading mark
    named = docs.select("doc_id", "text", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("_lang"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("_source"))
    metrics = materialize(text_metrics(named, ["doc_id", "_lang", "_source"]), "metrics")
    limits = materialize(thresholds(metrics), "thresholds")
    if limits.count() <= most_broadcast:
        joined = metrics.join(F.broadcast(limits), ["_lang", "_source"])
    else:
        salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = metrics.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts)).cast("int")).join(salted, ["_lang", "_source", "_salt"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & accepted()).alias("kept"))
