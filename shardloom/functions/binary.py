"""Frame records inside binary columns: a three-byte marker, eight opaque bytes, and a little-endian time.

Small values are read with built-in expressions; scans of raw images use the same rules in Arrow batches
(shardloom.operators.carve).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the format: markers, the time's distance from them, and the record's least size.
MARKER_A, MARKER_B = b"\x80\x01\x00", b"\x81\x01\x00"
TIME_AT, RECORD_SIZE = 11, 19
YEAR_2000, YEAR_2020, YEAR_2040, YEAR_2100 = 946_684_800, 1_577_836_800, 2_208_988_800, 4_102_444_800

RECORDS = "array<struct<pos:bigint,ts_us:bigint>>"


@dataclass(frozen=True)
class Window:
    """Accepted times, both ends included, in microseconds."""

    least: int
    most: int


#: Carving and noise attribution accept a century; gap filling and overlay reading accept twenty years.
WIDE = Window(YEAR_2000 * 1_000_000, YEAR_2100 * 1_000_000)
NARROW = Window(YEAR_2020 * 1_000_000, YEAR_2040 * 1_000_000)


def _at(content: Column, pos: Column, size: int) -> Column:
    return F.substr(content, (pos + 1).cast("int"), F.lit(size))


def marker_positions(content: Column, markers: tuple[bytes, ...] = (MARKER_A, MARKER_B)) -> Column:
    """Offsets of all markers, in order. Null content has null; short content none."""
    hits = F.filter(F.sequence(F.lit(0), F.length(content) - 3), lambda i: _at(content, i, 3).isin(*[F.lit(m) for m in markers]))
    return F.when(F.length(content) >= 3, F.transform(hits, lambda i: i.cast("long"))).when(content.isNotNull(), F.array().cast("array<bigint>"))


def u32_le(content: Column, pos: Column) -> Column:
    parts = [F.conv(F.hex(_at(content, pos + i, 1)), 16, 10).cast("long") * (1 << (8 * i)) for i in range(4)]
    return F.when(pos + 4 <= F.length(content), sum(parts[1:], parts[0]))


def u16_le(content: Column, pos: Column) -> Column:
    return F.when(pos + 2 <= F.length(content), F.conv(F.hex(_at(content, pos, 1)), 16, 10).cast("long") + 256 * F.conv(F.hex(_at(content, pos + 1, 1)), 16, 10).cast("long"))


def u64_le(content: Column, pos: Column) -> Column:
    """As decimal(20,0), for any eight bytes; null when they reach beyond the content."""
    turned = F.concat(*[F.hex(_at(content, pos + i, 1)) for i in range(7, -1, -1)])
    return F.when(pos + 8 <= F.length(content), F.conv(turned, 16, 10).cast("decimal(20,0)"))


def time_at(content: Column, pos: Column, window: Window) -> Column:
    """The record's microseconds since 1970 if they are within the window, else null."""
    value = u64_le(content, pos + TIME_AT)
    return F.when(value.between(F.lit(window.least).cast("decimal(20,0)"), F.lit(window.most).cast("decimal(20,0)")), value.cast("long"))


def records(content: Column, window: Window = WIDE) -> Column:
    """array<struct<pos, ts_us>> of the records with an accepted time, in order of offset."""
    found = F.transform(marker_positions(content), lambda p: F.struct(p.alias("pos"), time_at(content, p, window).alias("ts_us")))
    return F.filter(found, lambda r: r["ts_us"].isNotNull())


def first_time(found: Column) -> Column:
    return F.get(found, F.lit(0))["ts_us"]


def last_time(found: Column) -> Column:
    return F.get(found, F.size(found) - 1)["ts_us"]


def least_time(found: Column) -> Column:
    return F.array_min(F.transform(found, lambda r: r["ts_us"]))


def most_time(found: Column) -> Column:
    return F.array_max(F.transform(found, lambda r: r["ts_us"]))


def middle_time(found: Column) -> Column:
    """The record in the middle by offset, not by value."""
    return F.get(found, F.floor(F.size(found) / 2).cast("int"))["ts_us"]


def codec_of(h264: Column, h265: Column) -> Column:
    """By counts of the two markers; a tie is h264, none is unknown."""
    return F.when((h264 == 0) & (h265 == 0), "unknown").when(h264 >= h265, "h264").otherwise("h265")


def plausible_seconds(value: Column) -> Column:
    return value.between(YEAR_2000, YEAR_2100)


def to_timestamp(us: Column) -> Column:
    return F.timestamp_micros(us)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone."""
    return F.unix_micros(ts.cast("timestamp"))


def hex_offset(value: Column, digits: int = 0) -> Column:
    """0x and upper-case hexadecimal digits, filled up with zeros to so many."""
    text = F.hex(value)
    return F.concat(F.lit("0x"), F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0")) if digits else text)
