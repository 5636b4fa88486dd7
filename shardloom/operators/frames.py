"""Frames for text recognition: which frame of a clip, which corner of it, and the five images that are tried in turn."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.noise import gray, roi
from shardloom.session import ship


@dataclass(frozen=True)
class CandidateConfig:
    scale: float = 2.5
    clip_limit: float = 2.0
    tiles: int = 8
    window: int = 31
    offset: float = 7.0
    label_rows: tuple[float, float] = (0.40, 0.90)
    label_columns: tuple[float, float] = (0.0, 0.38)
    pad: int = 25
    pad_value: int = 128
    label_scale: float = 4.0


def _weights(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of size places, the four neighbours of a cubic interpolation (a = -0.75) and their weights."""
    x = (np.arange(size) + 0.5) * n / size - 0.5
    base = np.floor(x).astype(int)
    at = base[:, None] + np.arange(-1, 3)
    d = np.abs(x[:, None] - at)
    a = -0.75
    w = np.where(d <= 1, (a + 2) * d**3 - (a + 3) * d**2 + 1, np.where(d < 2, a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a, 0))
    return np.clip(at, 0, n - 1), w


def enlarge(image: np.ndarray, scale: float) -> np.ndarray:
    """Cubic interpolation to the rounded size, borders repeated."""
    h, w = image.shape[:2]
    data = image.astype(np.float64).reshape(h, w, -1)
    at, weight = _weights(h, round(h * scale))
    data = np.einsum("iqwc,iq->iwc", data[at], weight)
    at, weight = _weights(w, round(w * scale))
    data = np.einsum("hjqc,jq->hjc", data[:, at], weight)
    return np.clip(np.rint(data), 0, 255).astype(np.uint8).reshape(data.shape[:2] + image.shape[2:])


def clahe(image: np.ndarray, clip_limit: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Equalisation by tiles with clipped histograms, tables interpolated between the tiles' centres."""
    h, w = image.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    p = np.pad(image, ((0, th * tiles - h), (0, tw * tiles - w)), mode="reflect" if min(h, w) > max(th * tiles - h, tw * tiles - w) else "edge")
    blocks = p.reshape(tiles, th, tiles, tw).swapaxes(1, 2).reshape(tiles * tiles, -1)
    hist = np.stack([np.bincount(b, minlength=256) for b in blocks]).astype(np.int64)
    limit = max(1, int(clip_limit * th * tw / 256))
    over = np.maximum(hist - limit, 0).sum(1)
    hist = np.minimum(hist, limit) + over[:, None] // 256
    rest = over % 256
    for i, r in enumerate(rest):
        if r:
            hist[i, :: max(256 // r, 1)][:r] += 1
    table = np.rint(np.clip(hist.cumsum(1) * 255.0 / (th * tw), 0, 255)).reshape(tiles, tiles, 256)
    y, x = np.arange(h) / th - 0.5, np.arange(w) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    ya, yb, xa, xb = (np.clip(v, 0, tiles - 1) for v in (y0, y0 + 1, x0, x0 + 1))
    of = lambda r, c: table[r[:, None], c[None], image]
    return np.rint((of(ya, xa) * (1 - fx) + of(ya, xb) * fx) * (1 - fy) + (of(yb, xa) * (1 - fx) + of(yb, xb) * fx) * fy).astype(np.uint8)


def _blur(image: np.ndarray, kernel: np.ndarray, mode: str) -> np.ndarray:
    r = len(kernel) // 2
    p = np.pad(image.astype(np.float64), r, mode=mode)
    rows = sum(k * p[i : i + image.shape[0]] for i, k in enumerate(kernel))
    return sum(k * rows[:, i : i + image.shape[1]] for i, k in enumerate(kernel))


def adaptive_threshold(image: np.ndarray, window: int = 31, offset: float = 7.0) -> np.ndarray:
    """255 where a pixel is above its Gaussian neighbourhood's mean less the offset, else 0."""
    sigma = 0.3 * ((window - 1) * 0.5 - 1) + 0.8
    kernel = np.exp(-((np.arange(window) - window // 2) ** 2) / (2 * sigma**2))
    mean = np.rint(_blur(image, kernel / kernel.sum(), "edge"))
    return np.where(image > mean - offset, 255, 0).astype(np.uint8)


def candidates(frame: np.ndarray, config: CandidateConfig = CandidateConfig()) -> list[np.ndarray]:  # noqa: B008
    """Five images of the frame's corner: enlarged; equalised; blurred and thresholded; the label's part, padded and
    enlarged more; and that equalised."""
    corner = roi(frame)
    large = enlarge(corner, config.scale)
    even = clahe(gray(large).astype(np.uint8), config.clip_limit, config.tiles)
    soft = np.rint(_blur(even, np.array([0.25, 0.5, 0.25]), "reflect")).astype(np.uint8)
    h, w = corner.shape[:2]
    label = gray(corner).astype(np.uint8)[int(h * config.label_rows[0]) : int(h * config.label_rows[1]), int(w * config.label_columns[0]) : int(w * config.label_columns[1])]
    label = enlarge(np.pad(label, config.pad, constant_values=config.pad_value), config.label_scale)
    return [large, even, adaptive_threshold(soft, config.window, config.offset), label, clahe(label, config.clip_limit, config.tiles)]


def candidate_images(frames: DataFrame, config: CandidateConfig = CandidateConfig()) -> DataFrame:  # noqa: B008
    """path, candidate, height, width, channels, data of the five images of each frame (path, height, width, data)."""
    ship(frames.sparkSession)

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                for i, image in enumerate(candidates(np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3), config)):
                    rows.append((r.path, i, image.shape[0], image.shape[1], 1 if image.ndim == 2 else image.shape[2], image.tobytes()))
            yield pd.DataFrame(rows, columns=["path", "candidate", "height", "width", "channels", "data"])

    return frames.select("path", "height", "width", "data").mapInPandas(run, "path string, candidate int, height int, width int, channels int, data binary")


#: Seconds at which a clip's middle frame is looked for, where its codec's first frames are damaged; and
#: where they are sound, with a known duration or without one (none: the clip's start, without seeking).
LATE_SEEKS, EARLY_SEEKS, BLIND_SEEKS = [2.0, 3.0, 5.0, 8.0, 10.0, 15.0], [None, 1.0, 2.0], [None, 1.0, 2.0, 3.0]


def middle_seeks(codec: Column, duration: Column) -> Column:
    """array<double>: where a clip's middle frame is looked for, in turn: first at half its duration, if that is known
    and not zero; a null is its start."""
    seconds = lambda values: F.array(*[F.lit(x).cast("double") for x in values])
    known = F.coalesce(duration != 0, F.lit(False))
    half = F.when(known, F.array(duration / 2)).otherwise(F.array().cast("array<double>"))
    sound = F.when(known, F.concat(half, seconds(EARLY_SEEKS))).otherwise(seconds(BLIND_SEEKS))
    return F.when(codec == "hevc", F.concat(half, seconds(LATE_SEEKS))).otherwise(sound)


def best_frame(frames: DataFrame, least: float = 20.0) -> DataFrame:
    """One frame a path (path, attempt, height, width, data): the first whose corner seems to hold text, else the first."""
    ship(frames.sparkSession)

    @F.pandas_udf("double")
    def spread(height: pd.Series, width: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([float(gray(roi(np.frombuffer(d, np.uint8).reshape(h, w, 3))).std()) for h, w, d in zip(height, width, data, strict=True)], dtype="float64")

    rated = frames.withColumn("_plain", ~(spread("height", "width", "data") > least))
    return rated.groupBy("path").agg(F.min_by(F.struct("attempt", "height", "width", "data", (~F.col("_plain")).alias("frame_ok")), F.struct("_plain", "attempt")).alias("f")).select("path", "f.*")


def write_images(images: DataFrame, folder: str) -> None:
    """Each candidate image as a portable graymap or pixmap, folder/name_candidate, from the tasks that hold it."""
    ship(images.sparkSession)

    def put(rows) -> None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        for r in rows:
            data = np.frombuffer(bytes(r["data"]), np.uint8).reshape(r["height"], r["width"], -1)
            kind, pixels = ("P5", data) if data.shape[2] == 1 else ("P6", data[..., ::-1])
            with store.open_output_stream(f"{root}/{r['path'].rsplit('/', 1)[-1]}_{r['candidate']}.p{'g' if kind == 'P5' else 'p'}m") as sink:
                sink.write(f"{kind}\n{r['width']} {r['height']}\n255\n".encode() + np.ascontiguousarray(pixels).tobytes())

    images.foreachPartition(put)
