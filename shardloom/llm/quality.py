"""A byte-level convolutional network, in numpy, that scores the quality of whole documents."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import crc_fold, map_rows, ship

CHUNK, STEP = 512, 448  # bytes; neighbours overlap by 64
SPAN, STRIDE, CHANNELS, FILTERS = 8, 2, 8, 24
BLOCK = 384  # chunks that are learned from at once


def chunks_of(text: str | None) -> np.ndarray:
    """All overlapping chunks of the whole text's bytes, a row each, the last one filled up with zero bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-(len(data) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


@dataclass
class Network:
    """Embedding of bytes, filters over SPAN bytes, the maximum over each chunk, then over chunks: mean and maximum."""

    embedding: np.ndarray  # 256 x CHANNELS; row 0 stays zero
    filters: np.ndarray  # SPAN * CHANNELS x FILTERS
    lift: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS
    bias: float

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        embedded = self.embedding[chunks].reshape(len(chunks), CHUNK * CHANNELS)
        return np.lib.stride_tricks.sliding_window_view(embedded, SPAN * CHANNELS, axis=1)[:, :: STRIDE * CHANNELS]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each chunk's maxima, and where they are."""
        w = self.windows(chunks)
        found = (np.ascontiguousarray(w).reshape(-1, SPAN * CHANNELS) @ self.filters).reshape(len(chunks), w.shape[1], FILTERS)
        at = found.argmax(1)
        return np.maximum(np.take_along_axis(found, at[:, None], 1)[:, 0] + self.lift, 0), at

    def score(self, texts: list[str | None]) -> np.ndarray:
        """A probability for each text; long texts go through in blocks of chunks."""
        scores = np.empty(len(texts))
        blocks: list[tuple[int, np.ndarray]] = [(i, c[at : at + 128]) for i, t in enumerate(texts) for c in [chunks_of(t)] for at in range(0, len(c), 128)]
        top, total, count = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS)), np.zeros(len(texts))
        at = 0
        while at < len(blocks):
            till, size = at, 0
            while till < len(blocks) and size < 256:
                size += len(blocks[till][1])
                till += 1
            found, _ = self.pooled(np.concatenate([c for _, c in blocks[at:till]]))
            ends = np.cumsum([len(c) for _, c in blocks[at:till]])[:-1]
            for (i, _), part in zip(blocks[at:till], np.split(found, ends), strict=True):
                top[i] = np.maximum(top[i], part.max(0))
                total[i] += part.sum(0, dtype=np.float64)
                count[i] += len(part)
            at = till
        for i in range(len(texts)):
            scores[i] = np.concatenate([top[i], total[i] / count[i]]) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(scores, -30, 30)))


def train(documents: list[np.ndarray], labels: np.ndarray, prior: float, rounds: int = 14, seed: int = 7) -> Network:
    """Adam on the logistic loss, both classes weighing the same; the prior's odds are added to the bias at the end."""
    rng = np.random.default_rng(seed)
    net = Network((rng.normal(size=(256, CHANNELS)) * 0.5).astype(np.float32), (rng.normal(size=(SPAN * CHANNELS, FILTERS)) / math.sqrt(SPAN * CHANNELS)).astype(np.float32), np.zeros(FILTERS, np.float32), (rng.normal(size=2 * FILTERS) * 0.1).astype(np.float32), 0.0)
    net.embedding[0] = 0
    values = {"embedding": net.embedding, "filters": net.filters, "lift": net.lift, "out": net.out, "bias": np.zeros(1, np.float32)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in values.items()}
    weight = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    time = 0
    for _ in range(rounds):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            chunks = np.concatenate([documents[i] for i in batch])
            of = np.repeat(np.arange(len(batch)), [len(documents[i]) for i in batch])
            count = np.bincount(of, minlength=len(batch)).astype(np.float32)
            parts = [slice(i, i + BLOCK) for i in range(0, len(chunks), BLOCK)]
            found, where = (np.concatenate(x) for x in zip(*(net.pooled(chunks[p]) for p in parts), strict=True))
            starts = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(int)
            top = np.maximum.reduceat(found, starts, 0)
            mean = np.add.reduceat(found, starts, 0) / count[:, None]
            both = np.hstack([top, mean])
            p = 1 / (1 + np.exp(-np.clip(both @ values["out"] + values["bias"][0], -30, 30)))
            delta = ((p - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            grads = {"out": both.T @ delta + 1e-4 * values["out"], "bias": np.array([delta.sum()], np.float32)}
            d_both = delta[:, None] * values["out"]
            is_top = (found == top[of]).astype(np.float32)
            is_top /= np.maximum(np.add.reduceat(is_top, starts, 0), 1)[of]
            d = (d_both[of, :FILTERS] * is_top + d_both[of, FILTERS:] / count[of, None]) * (found > 0)
            grads["lift"] = d.sum(0)
            grads["filters"], grads["embedding"] = np.zeros_like(net.filters), np.zeros_like(net.embedding)
            for p in parts:
                # only the windows that hold a maximum have a gradient
                span = where[p][:, :, None] * STRIDE + np.arange(SPAN)
                bytes_at = chunks[p][np.arange(len(span))[:, None, None], span]
                grads["filters"] += np.einsum("cf,cfk->kf", d[p], net.embedding[bytes_at].reshape(len(span), FILTERS, -1), optimize=True)
                back = d[p][:, :, None] * net.filters.T[None]
                grads["embedding"] += np.stack([np.bincount(bytes_at.ravel(), back.reshape(-1, CHANNELS)[:, c], minlength=256) for c in range(CHANNELS)], 1).astype(np.float32)
            grads["embedding"][0] = 0
            time += 1
            for k, g in grads.items():
                a, b = moments[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                values[k] -= (0.01 * (a / (1 - 0.9**time)) / (np.sqrt(b / (1 - 0.999**time)) + 1e-8)).astype(np.float32)
    net.bias = float(values["bias"][0]) + math.log(prior / (1 - prior))
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 700, most_chunks: int = 40_000, folds: int = 5, held_out: int = 0) -> Network:
    """Learn labels.quality from labelled rows outside the held-out fold of crc32(doc_id).

    The sample is bounded: about per_class documents of each label, chosen by a hash of their id (never more than four
    times that in all), and of these, in order of the hash, those whose chunks fit into most_chunks together. Each is
    learned over all its chunks, as it is scored. Without rows of both labels every score is the prior (or 0.5).
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held_out))
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000).cast("long"))
    share = F.lit(False)
    for label, n in counts.items():
        share = share | ((F.col("quality") == label) & (place < int(1_000_000 * min(1.0, per_class / n)) + 1))
    chosen = {r[0]: r[1] for r in known.filter(share).orderBy(F.xxhash64("doc_id"), "quality").limit(4 * per_class).collect()}

    def make():
        return lambda ids, texts: (ids, [np.ascontiguousarray(chunks_of(text)).tobytes() for text in texts])

    def of_ids(ids: list[int]) -> DataFrame:
        """The documents with these ids, at most four times per_class of them."""
        wanted = docs.sparkSession.createDataFrame([(i,) for i in sorted(ids)], "doc_id long")
        return docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id", "left_semi")

    n_chunks = F.greatest(F.lit(1), F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)) - (CHUNK - STEP)) / STEP))
    sizes = {r[0]: r[1] for r in of_ids(chosen).groupBy("doc_id").agg(F.sum(n_chunks)).collect()} if chosen else {}
    fitting, room = [], most_chunks
    for doc_id in chosen:
        if sizes.get(doc_id, room + 1) <= room:
            fitting.append(doc_id)
            room -= sizes[doc_id]
    rows = map_rows(of_ids(fitting), ["doc_id", "text"], make, "doc_id long, chunks binary").collect() if fitting else []
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["chunks"])))
    y = np.array([chosen[r["doc_id"]] for r in rows], np.float32)
    if not len(set(y.tolist())) == 2:
        prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
        return Network(np.zeros((256, CHANNELS), np.float32), np.zeros((SPAN * CHANNELS, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), math.log(min(max(prior, 1e-6), 1 - 1e-6) / (1 - min(max(prior, 1e-6), 1 - 1e-6))))
    return train([np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in rows], y, counts[1] / (counts[0] + counts[1]))


def scored(docs: DataFrame, net: Network, text: str = "text") -> Column:
    """A column of probabilities for any table with a text column."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        return pd.Series(np.concatenate([net.score(values[at : at + 256]) for at in range(0, len(values), 256)]) if values else [], dtype="float64")

    return score(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents.

    A null text is scored as an empty one. Only doc_id and text are inputs; labels are read for learning, outside the
    held-out fold, so other columns may have any names. A null doc_id counts as the empty text in the fold. Repeated
    rows are scored each, and alike; of a long text every chunk is scored, some at a time. An empty table gives an empty
    result.
    """
    net = fit(docs, labels, folds=folds, held_out=held_out)
    return docs.select("doc_id", (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out"), scored(docs, net).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
