"""Overlay texts, names and reports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shardloom.session import ship


def iso_time(us: Column) -> Column:
    """ISO 8601 in UTC from microseconds, with a fraction only if there is one; '-' for null."""
    ts = F.timestamp_micros(us)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(us.isNull(), "-").when(F.pmod(us, F.lit(1_000_000)) == 0, F.concat(whole, F.lit("+00:00"))).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def report_time(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy/MM/dd HH:mm:ss 'UTC'"), F.lit("N/A"))


def report_duration(seconds: Column) -> Column:
    """Hours, minutes and tenths; minutes and tenths; or seconds to the thousandth. The sign is dropped."""
    s = F.abs(seconds)
    h, m = F.floor(s / 3600).cast("long"), F.floor(F.pmod(s, F.lit(3600.0)) / 60).cast("long")
    rest = F.pmod(s, F.lit(60.0))
    return F.when(h > 0, F.format_string("%dh %dm %.1fs", h, m, rest)).when(m > 0, F.format_string("%dm %.1fs", m, rest)).otherwise(F.format_string("%.3fs", s))


#: Characters that file names may not have.
REFUSED = r'[<>:"/\\|?*]+'


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def safe_name(text: Column) -> Column:
    """A folder name: runs of characters that file systems refuse, and of white space, become '_'; empty is 'unknown'."""
    clean = F.regexp_replace(F.regexp_replace(stripped(text), REFUSED, "_"), r"\s+", "_")
    return F.when(F.coalesce(clean, F.lit("")) == "", "unknown").otherwise(clean)


def normal_overlay(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.upper(text), F.lit("|"), F.lit("I")), r"\s+", " "))


def channel_label(texts: Column, relaxed: bool = False) -> Column:
    """CAM and two digits from an array of overlay texts, or null. Unless relaxed, the digits start with 0 or O."""
    joined = normal_overlay(F.array_join(texts, " "))
    digits = F.regexp_extract(joined, r"\bCAM([O0-9]{1,3})\b" if relaxed else r"\bCAM([O0]\d{1,2})\b", 1)
    number = F.replace(digits, F.lit("O"), F.lit("0")).try_cast("int")
    return F.when(digits != "", F.format_string("CAM%02d", number))


#: Fixed value: a date and time in an overlay.
_DATE = r"\b(20\d{2})[/-](\d{1,2})[/-](\d{1,2})\s+(\d{1,2}):(\d{2}):(\d{2})\b"


def overlay_time(texts: Column) -> Column:
    """The first date and time in an array of overlay texts, in UTC; null if there is none or it isn't on the calendar.

    Texts are searched as they were read, only stripped: unlike labels, they aren't mended first.
    """
    joined = F.array_join(F.filter(F.transform(texts, stripped), lambda t: t != ""), " ")
    part = [F.regexp_extract(joined, _DATE, i).try_cast("int") for i in range(1, 7)]
    return F.when(part[0].isNotNull(), F.try_make_timestamp(*part[:5], part[5].cast("decimal(8,6)"), F.lit("UTC")))


#: How a record's time and the overlay's agree.
CHECKS = {
    "neither": "no datetime found",
    "overlay": "OCR only - no DAT reference",
    "record": "DAT only - OCR datetime missing",
    "pass": "PASS - DAT and OCR agree",
    "check": "CHECK - DAT and OCR close",
    "review": "REVIEW - DAT/OCR mismatch",
}


def time_check(record_us: Column, overlay_us: Column) -> Column:
    """How two times agree: within 10 s, within 60 s, or not; or which of them is missing."""
    off = F.abs(record_us - overlay_us)
    return (
        F.when(record_us.isNull() & overlay_us.isNull(), CHECKS["neither"])
        .when(record_us.isNull(), CHECKS["overlay"])
        .when(overlay_us.isNull(), CHECKS["record"])
        .when(off <= 10_000_000, CHECKS["pass"])
        .when(off <= 60_000_000, CHECKS["check"])
        .otherwise(CHECKS["review"])
    )


#: The keys of a recognition result under which texts are, in order.
TEXT_KEYS = ["text", "rec_text", "content", "text_content", "markdown"]


def useful_texts(result: str | None) -> list[str] | None:
    """The distinct texts in a recognition result as JSON: a string; those of a list's items, at any depth; or an object
    (or its res) with parsing_res_list[*].block_content and then the text keys. None for what isn't JSON, and for a res
    that isn't an object."""
    try:
        todo = [json.loads(result)]
    except (TypeError, ValueError, RecursionError):
        return None
    found: dict[str, None] = {}
    while todo:
        value = todo.pop()
        if isinstance(value, list):
            todo += reversed(value)
        elif isinstance(value, dict):
            inner = value.get("res", value)
            if not isinstance(inner, dict):
                return None
            blocks = inner.get("parsing_res_list")
            texts = [b.get("block_content") for b in blocks if isinstance(b, dict)] if isinstance(blocks, list) else []
            for text in [*texts, *(inner.get(k) for k in TEXT_KEYS)]:
                if isinstance(text, str):
                    found[text.strip()] = None
        elif isinstance(value, str):
            found[value.strip()] = None
    found.pop("", None)
    return list(found)


def overlay_texts(result: Column) -> Column:
    """array<string> by useful_texts(), in one pass over batches."""
    ship(SparkSession.active())

    @F.pandas_udf("array<string>")
    def texts(results: pd.Series) -> pd.Series:
        return results.map(useful_texts, na_action="ignore").where(results.notna(), None)

    return texts(result)


def chunk_number(path: Column) -> Column:
    """The number after 'chunk' in a file name, else its last number, else 0."""
    name = stem_of(path)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(?i)chunk[_-]?(\d+)", 1), F.lit("")).try_cast("long"), F.nullif(F.regexp_extract(name, r"(\d+)\D*$", 1), F.lit("")).try_cast("long"), F.lit(0).cast("long"))


def name_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem_of(path: Column) -> Column:
    """The file name without its last suffix; a leading dot isn't a suffix."""
    return F.regexp_replace(name_of(path), r"(?<=.)\.[^.]+$", "")


def suffix_of(path: Column) -> Column:
    return F.regexp_extract(name_of(path), r".(\.[^.]+)$", 1)


def trailing_number(path: Column) -> Column:
    return F.nullif(F.regexp_extract(stem_of(path), r"(\d+)$", 1), F.lit("")).try_cast("long")


def natural_key(name: Column) -> Column:
    """A sort key in which digit runs compare as numbers and the rest in lower case."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), F.lit(1))
    # text before the first number may be empty, so that places alternate between texts and numbers
    lead = F.when(F.regexp_like(name, F.lit(r"^\d")), F.concat(F.array(F.lit("")), parts)).otherwise(parts)
    return F.transform(lead, lambda x: F.struct(F.when(F.regexp_like(x, F.lit(r"^\d+$")), F.lit("")).otherwise(x).alias("text"), F.when(F.regexp_like(x, F.lit(r"^\d+$")), x.cast("decimal(38,0)")).alias("number")))


def file_seconds(path: Column, record_us: Column, modified: Column) -> Column:
    """A clip's time in seconds: its records', else a long number (over 1e12 in milliseconds), a date to the minute (in
    UTC), a chunk number or the last number in its name, else the time of its last change."""
    name = stem_of(path)
    digits = F.nullif(F.regexp_extract(name, r"(\d{10,13})", 1), F.lit("")).try_cast("double")
    date = F.regexp_extract(name, r"(\d{4}[-_]\d{2}[-_]\d{2}[-_T]\d{2}[-_:]\d{2})", 1)
    dates = [F.unix_micros(F.try_to_timestamp(F.nullif(date, F.lit("")), F.lit(form))) / 1e6 for form in ("yyyy-MM-dd_HH-mm", "yyyy-MM-dd'T'HH:mm", "yyyy_MM_dd_HH_mm")]
    chunk = F.nullif(F.regexp_extract(name, r"(?i)chunk[_-]?(\d+)", 1), F.lit("")).try_cast("double")
    last = F.nullif(F.regexp_extract(name, r"(\d+)\D*$", 1), F.lit("")).try_cast("double")
    return F.coalesce(record_us / 1e6, F.when(digits > 1e12, digits / 1000).otherwise(digits), *dates, chunk, last, F.unix_micros(modified) / 1e6)


def gap_status(fillers: Column, partial: Column, coverage: Column, missing_before: Column, missing_after: Column) -> Column:
    """FILLED, UNFILLED, or PARTIAL with the share that is covered and edges of more than a second that aren't."""
    parts = F.array_compact(F.array(F.when(missing_before > 1, F.concat(report_duration(missing_before), F.lit(" before"))), F.when(missing_after > 1, F.concat(report_duration(missing_after), F.lit(" after")))))
    still = F.when(F.size(parts) > 0, F.concat(F.lit("; still missing: "), F.array_join(parts, ", "))).otherwise("")
    return F.when(fillers == 0, "UNFILLED").when(partial, F.concat(F.format_string("PARTIAL (%.0f%% covered", 100 * coverage), still, F.lit(")"))).otherwise("FILLED")


def overall_status(unfilled: Column, partial: Column) -> Column:
    """Without gaps a recording is complete."""
    return F.when(unfilled > 0, "INCOMPLETE").when(partial > 0, "PARTIAL").otherwise("COMPLETE")
