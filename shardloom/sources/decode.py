"""Probing and decoding of clips by outside programs, which are passed in as functions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.frames import middle_seeks
from shardloom.operators.noise import roi_has_text, seek_plan
from shardloom.session import ship

#: Fixed value: encoded pictures of at most so many bytes aren't real frames.
LEAST_BYTES = 10_000
_FRAMES = "path string, frame_idx int, height int, width int, data binary"


def codec_name(raw: Column) -> Column:
    """hevc, h264 or unknown, of what a prober calls a stream's codec."""
    text = F.lower(F.coalesce(raw, F.lit("")))
    return F.when(text.rlike("hevc|h265"), "hevc").when(text.rlike("h264|avc"), "h264").otherwise("unknown")


def duration_of(raw: Column) -> Column:
    """Seconds, from the first word of what a prober answers; null if it is no number or not above zero."""
    value = F.nullif(F.regexp_extract(F.coalesce(raw, F.lit("")), r"^\s*(\S+)", 1), F.lit("")).try_cast("double")
    return F.when((value > 0) & ~F.isnan(value), value)


def probe_with(clips: DataFrame, probe: Callable[[str], tuple[str | None, str | None]]) -> DataFrame:
    """clips with codec and duration. probe(path) answers with both as texts; where it fails, they are unknown and null."""
    ship(clips.sparkSession)

    def ask(path):
        try:
            return probe(path)
        except Exception:  # noqa: BLE001 - an outside program's failure is an answer too
            return None, None

    def run(batches):
        for batch in batches:
            answers = [ask(path) for path in batch["path"]]
            yield pd.DataFrame({"path": batch["path"], "c": [a[0] for a in answers], "d": [a[1] for a in answers]})

    asked = clips.select("path").distinct().mapInPandas(run, "path string, c string, d string")
    return clips.join(asked.select("path", codec_name(F.col("c")).alias("codec"), duration_of(F.col("d")).alias("duration")), "path")


def _frame(decode: Callable, path: str, at: float | None):
    """decode()'s picture, if its encoded form is large enough."""
    found = decode(path, at)
    return found[1] if found is not None and found[0] > LEAST_BYTES else None


def _taken(decode: Callable, every: Callable, path: str, codec: str, duration: float | None, seeks: list[float], n: int):
    """A clip's frames, up to n. A failure ends the clip with the frames before it."""
    count = 0
    try:
        if codec != "hevc" and not duration:
            for frame in every(path, 30, n)[:n]:
                count += 1
                yield frame
            return
        for i, at in enumerate(seeks):
            if count < n and (frame := _frame(decode, path, None if codec != "hevc" and i == 0 else at)) is not None:
                count += 1
                yield frame
        if codec == "hevc" and not count and (frame := _frame(decode, path, None)) is not None:
            yield frame
    except Exception:  # noqa: BLE001 - what the outside program gave before stays
        return


def frames_with(clips: DataFrame, decode: Callable, every: Callable, n: int = 30) -> DataFrame:
    """path, frame_idx, height, width, data (rows of blue, green, red) of up to n frames of clips (path, codec,
    duration), at the places of seek_plan().

    decode(path, at) gives the encoded size and the picture (uint8, height x width x 3) at a second, at the clip's start
    for None, or None; every(path, step, n) gives the pictures of every step-th frame, which serve clips of the older
    codec without a duration. Streams of the newer codec without any frame are tried from the start. A clip whose
    frames can't be read gives what came before, maybe nothing.
    """
    ship(clips.sparkSession)
    planned = clips.select("path", "codec", "duration", seek_plan(F.col("codec"), F.col("duration"), n).alias("seeks"))

    def run(batches):
        for batch in batches:
            for r in batch.itertuples():
                for i, frame in enumerate(_taken(decode, every, r.path, r.codec, r.duration if pd.notna(r.duration) else None, list(r.seeks), n)):
                    yield pd.DataFrame({"path": [r.path], "frame_idx": [i], "height": [frame.shape[0]], "width": [frame.shape[1]], "data": [frame.tobytes()]})

    return planned.mapInPandas(run, _FRAMES)


def middle_frames_with(clips: DataFrame, decode: Callable) -> DataFrame:
    """path, height, width, data, error: a clip's middle frame, looked for at the places of middle_seeks(): the first
    one whose corner seems to hold text, else the first there is. Without any, or after a failure, error says so."""
    ship(clips.sparkSession)
    planned = clips.select("path", middle_seeks(F.col("codec"), F.col("duration")).alias("seeks"))

    def look(path, seeks):
        best = None
        for at in seeks:
            frame = _frame(decode, path, None if pd.isna(at) else float(at))
            if frame is not None:
                if roi_has_text(frame):
                    return frame
                best = frame if best is None else best
        if best is None:
            raise RuntimeError("no frame could be read")
        return best

    def run(batches):
        for batch in batches:
            for r in batch.itertuples():
                try:
                    frame = look(r.path, r.seeks)
                    yield pd.DataFrame({"path": [r.path], "height": [frame.shape[0]], "width": [frame.shape[1]], "data": [frame.tobytes()], "error": [None]})
                except Exception as failure:  # noqa: BLE001
                    yield pd.DataFrame({"path": [r.path], "height": [None], "width": [None], "data": [None], "error": [str(failure)]})

    return planned.mapInPandas(run, "path string, height int, width int, data binary, error string")
