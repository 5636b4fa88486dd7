"""One query an operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm import bpe, langid, minhash, packing, quality, rules, secrets, syncmers, token_files, urls
from shardloom.llm.common import scratch_path, scratch_root, table
from shardloom.llm.pretokens import vocabulary
from shardloom.session import discard_path


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates by words of two and a likeness of 0.8. Cases: minhash.near_duplicates()."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of the 50k byte-level vocabulary, as digests. Cases: bpe.encode_documents()."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), digest=True)


def op3_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts, of their edits and of the next ones. Cases: syncmers.fingerprints()."""
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores, learned from labels. Cases: quality.classify()."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by thresholds of each language and source. Cases: rules.apply_rules()."""
    return rules.apply_rules(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on pages by rules and aliases. Cases: urls.judge()."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens. Cases: packing.piece_documents() and pack()."""
    return packing.pack(packing.piece_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), ids=False))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files. Cases: token_files.write_token_files() and token_counts()."""
    path = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    counts = token_files.token_counts(spark, path)
    discard_path(spark, path)  # the separators have been written; the files are not read again
    return manifest.join(counts, ["file", "document"]).select("doc_id", "n_tokens", "ended")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text; texts that the ledger in the shared folder has aren't scanned again. Cases: secrets.secrets()."""
    return secrets.secrets(table(spark, sf_dir, "documents"), f"{scratch_root(spark)}/{secrets.LEDGER}")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts, learned from lang. Cases: langid.identify()."""
    return langid.identify(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_bpe_automaton": op2_bpe_automaton,
        "op3_closed_syncmers": op3_closed_syncmers,
        "op4_quality_network": op4_quality_network,
        "op5_quality_rules": op5_quality_rules,
        "op6_url_filters": op6_url_filters,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_token_counts": op8_token_counts,
        "op9_secret_scans": op9_secret_scans,
        "op10_language": op10_language,
    }


_WORD = r"[^\x20\x09-\x0D]+"



def _fences_sql(name: str, keys: str) -> str:
    """Outer fence over values that aren't zero (o, a bucket, of k values), inner fences over all (a, z, of n values)."""
    low, high, low_some, high_some = (f"quantile_disc({x}" for x in ("top, 0.25)", "top, 0.75)", "bk, 0.25) FILTER (bk > 0)", "bk, 0.75) FILTER (bk > 0)"))
    return f"""{name} AS (SELECT {keys}, count(*) AS n, count(*) FILTER (bk > 0) AS k, coalesce({high_some} + 3 * ({high_some} - {low_some}), 0) AS o,
  {low} - 3 * ({high} - {low}) // 2 AS a, {high} + 3 * ({high} - {low}) // 2 AS z FROM u GROUP BY {keys})"""


def _drawn_sql(own: str, wider: str) -> str:
    """Limits drawn towards the wider group's, rounded down (a may be below zero)."""
    drawn = lambda x, n: f"CAST(floor(({own}.{n} * {own}.{x} + {rules.PRIOR} * {wider}.{x}) / ({own}.{n} + {rules.PRIOR})) AS BIGINT) AS {x}"
    return ", ".join([drawn("o", "k"), drawn("a", "n"), drawn("z", "n")])


OP5_SQL = rf"""WITH b AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS l, coalesce('=' || source, '-') AS s, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
 win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM b)),
 rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
 cov AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, range(0, 5) x(o) GROUP BY r),
 ln AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS g FROM b),
 m AS (SELECT b.r, doc_id, l, s, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  len(g)::BIGINT AS n_lines, (len(g) - len(list_distinct(g)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM b JOIN ln USING (r) LEFT JOIN cov ON cov.r = b.r),
 v AS (SELECT r, l, s, unnest([{{'m': 'a', 'v': 10000 * n_symbols // greatest(word_chars, 1)}}, {{'m': 'b', 'v': 10000 * n_dup_lines // greatest(n_lines, 1)}}, {{'m': 'c', 'v': 10000 * n_repeat_words // greatest(n_words, 1)}}, {{'m': 'd', 'v': 100 * word_chars // greatest(n_words, 1)}}], recursive := true) FROM m),
 k AS (SELECT *, CASE WHEN v < 32 THEN v ELSE 16 * (length(bin(v)) - 5) + v // (1::BIGINT << (length(bin(v)) - 5)::BIGINT) END AS bk FROM v),
 u AS (SELECT *, CASE WHEN bk < 32 THEN bk ELSE (bk % 16 + 17) * (1::BIGINT << (bk // 16 - 1)::BIGINT) - 1 END AS top FROM k),
 {_fences_sql("q1", "l, s, m")}, {_fences_sql("q2", "l, m")}, {_fences_sql("q3", "m")},
 w AS (SELECT l, m, {_drawn_sql("q2", "q3")} FROM q2 JOIN q3 USING (m)),
 lim AS (SELECT l, s, m, {_drawn_sql("q1", "w")} FROM q1 JOIN w USING (l, m)),
 ok AS (SELECT r, bool_and(bk <= o) AND NOT bool_and(v < a OR v > z) FILTER (m IN ('a', 'd')) AS ok FROM k JOIN lim USING (l, s, m) GROUP BY r)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ok) AS kept FROM m JOIN ok USING (r)"""

#: The tables' pages have no redirects or canonical links, so every page is its own alias here; links are tested against
#: a brute-force version.
_FITS = " ".join(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{host}{path}'" for _, host, path in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])))
_ALLOWS = ", ".join(f"'{host}{path}'" for verdict, host, path in urls.RULES if verdict == "allow")
OP6_SQL = rf"""WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages),
 h AS (SELECT page_id, regexp_extract(x, '^[^/?#]*') AS h, x FROM r),
 p AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(x, length(h) + 1), '^[^?#]*') AS path FROM h),
 f AS (SELECT *, CASE {_FITS} END AS rule FROM p)
 SELECT page_id, host, path, rule, CASE WHEN rule IS NULL OR rule IN ({_ALLOWS}) THEN 'allow' ELSE 'block' END AS verdict FROM f"""


def _spans_sql(kind: str) -> str:
    pattern, group, least = (secrets.BASE | secrets.MORE)[kind]
    quoted = pattern.replace("'", "''")
    found = f"SELECT r, string_split_regex(t, '{quoted}') AS a, regexp_extract_all(t, '{quoted}', 0) AS w, regexp_extract_all(t, '{quoted}', {group}) AS g FROM b WHERE regexp_matches(t, '{quoted}')"
    at = "list_sum(list_transform(a[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0)"
    return f"SELECT r, {secrets.KINDS.index(kind)} AS k, '{kind}' AS kind, CAST({at} AS BIGINT) AS a, CAST({at} + length(w[i]) AS BIGINT) AS e FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM ({found})) WHERE length(g[i]) >= {least}"


OP9_SQL = f"""WITH b AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), sp AS ({" UNION ALL ".join(_spans_sql(k) for k in secrets.KINDS)}),
 js AS (SELECT r, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, coalesce(string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, k) FILTER (k < 3), '') AS base, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, k) AS spans FROM sp GROUP BY r)
 SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM b LEFT JOIN js USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": OP5_SQL, "op6_url_filters": OP6_SQL, "op9_secret_scans": OP9_SQL}
