"""Language identification in two steps: the family first, then linear support vector machines, one for every pair of
languages within a family."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import crc_fold, map_rows, ship

#: Families of common languages. A language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "mk"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
WIDTH = 1 << 13
STRETCH = 1 << 18
#: A family's confidence is told among so many of the likeliest, so that it doesn't fall as more languages are learned.
LIKELIEST = 40
#: Documents are sampled by a hash modulo this.
PLACES = 1 << 40
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, (m[0] for m in _LETTER.finditer(text))))


def features(texts: list[str]) -> np.ndarray:
    """Hashed counts of byte pairs and triples of the lower-cased whole text, as square roots with unit norm.

    Texts are gone through in stretches of STRETCH bytes, so a long one takes no more memory than that.
    """
    out = np.zeros((len(texts), WIDTH), np.float32)
    for row, text in enumerate(texts):
        data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
        counts = np.zeros(WIDTH, np.int64)
        for at in range(0, len(data) - 1, STRETCH):
            x = _BLANK[data[at : at + STRETCH + 2]]
            two = x[:-1] << np.uint32(8) | x[1:]
            three = two[:-1] << np.uint32(8) | x[2:]
            counts += np.bincount((two[:STRETCH] * np.uint32(2654435761)) >> np.uint32(19), minlength=WIDTH)
            counts += np.bincount((three * np.uint32(2246822519)) >> np.uint32(19), minlength=WIDTH)
        out[row] = counts
    np.sqrt(out, out=out)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights and bias that minimise the mean squared hinge loss (classes weigh the same) by accelerated descent.

    y has a column for each machine, or is the one column; machines that learn from the same rows go together.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / np.maximum(1, (y > 0).sum(0)), 0.5 / np.maximum(1, (y < 0).sum(0))).astype(np.float32)
    w = v = np.zeros((x.shape[1], *y.shape[1:]), np.float32)
    step = 0.25
    for i in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = penalty * v - 2 * x.T @ (weight * y * slack)
        following = v - step * grad
        v = following + i / (i + 3) * (following - w)
        w = following
    return w


@dataclass
class LanguageModel:
    families: list[str]
    family_weights: np.ndarray  # a column for each family
    members: dict[str, list[str]]
    pairs: dict[tuple[str, str], np.ndarray]  # above 0: the first

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and confidence (0 to 1); und, 0 for texts that are null or have no letter, or with nothing learned."""
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if has_letter(t)] if self.families else []
        for at in range(0, len(told), 256):
            rows = told[at : at + 256]
            x = features([texts[i] for i in rows])
            family = x @ self.family_weights[:-1] + self.family_weights[-1]
            if len(self.families) > LIKELIEST:
                np.put_along_axis(family, np.argpartition(family, -LIKELIEST, 1)[:, :-LIKELIEST], -np.inf, 1)
            family = _softmax(family)
            best = family.argmax(1)
            for f in np.unique(best):
                mine = np.flatnonzero(best == f)
                names = self.members[self.families[f]]
                margins = np.zeros((len(mine), len(names)), np.float32)
                for (a, b), w in self.pairs.items():
                    if a in names and b in names:
                        m = np.clip(x[mine] @ w[:-1] + w[-1], -2, 2)
                        margins[:, names.index(a)] += m
                        margins[:, names.index(b)] -= m
                lang = _softmax(margins)
                for k, i in enumerate(mine):
                    j = int(lang[k].argmax())
                    langs[rows[i]], scores[rows[i]] = names[j], float(family[i, f] * lang[k, j])
        return langs, scores


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(2 * (x - x.max(1, keepdims=True)))
    return (e / e.sum(1, keepdims=True)).astype(np.float64)


def train(x: np.ndarray, langs: list[str]) -> LanguageModel:
    y = np.array(langs)
    names = sorted(set(langs))
    members: dict[str, list[str]] = {}
    for name in names:
        members.setdefault(_FAMILY.get(name, f"only {name}"), []).append(name)
    families = sorted(members)
    of = np.array([_FAMILY.get(name, f"only {name}") for name in langs])
    columns = linear_svm(x, np.where(of[:, None] == np.array(families), 1, -1).astype(np.float32)) if len(families) > 1 else np.zeros((WIDTH + 1, len(families)), np.float32)
    pairs = {}
    for inside in members.values():
        for i, a in enumerate(inside):
            for b in inside[i + 1 :]:
                rows = (y == a) | (y == b)
                pairs[a, b] = linear_svm(x[rows], np.where(y[rows] == a, 1, -1).astype(np.float32))
    return LanguageModel(families, columns, members, pairs)


def fit(docs: DataFrame, per_language: int = 300, folds: int = 4, held_out: int = 2, full_languages: int = 40, least: int = 20) -> LanguageModel:
    """Learn from text and lang of documents outside the held-out fold of crc32(doc_id), over whole texts.

    Every lang value is learned; what is bounded is the rows of each: about per_language documents, those with the least
    hashes of their id. With more than full_languages languages each has fewer, so that the total stays the same, but no fewer
    than least; never more than twice that in all. Features are made on the executors, so what reaches the driver
    doesn't depend on how long texts are.
    """
    known = docs.select("doc_id", "text", "lang").filter((crc_fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    most = min(per_language, max(least, per_language * full_languages // max(1, len(counts))))
    # ids that are null say nothing of a row, so its text does
    place = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(PLACES).cast("long"))
    bounds = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(PLACES * min(1.0, most / n)) + 1)]) if counts else None
    share = place < bounds[F.col("lang")] if counts else F.lit(False)

    def make():
        def vectors(langs, texts, places):
            keep = [i for i, t in enumerate(texts) if has_letter(t)]
            x = features([texts[i] for i in keep])
            out_lang, out_at, out_value, out_place = [], [], [], []
            for row, i in enumerate(keep):
                at = np.flatnonzero(x[row])
                out_lang.append(langs[i])
                out_at.append(at.astype(np.uint16).tobytes())
                out_value.append(x[row, at].tobytes())
                out_place.append(places[i])
            return out_lang, out_at, out_value, out_place

        return vectors

    made = map_rows(known.filter(share).withColumn("_place", place), ["lang", "text", "_place"], make, "lang string, at binary, value binary, place long")
    rows = made.orderBy("place", "lang", "at", "value").limit(2 * most * max(1, len(counts))).collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))  # one order, whatever the partitions
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, row in enumerate(rows):
        x[i, np.frombuffer(row["at"], np.uint16)] = np.frombuffer(row["value"], np.float32)
    return train(x, [r["lang"] for r in rows])


def predicted(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A column struct<lang, score> for any table with a text column."""
    ship(docs.sparkSession)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = model.predict(texts.tolist())
        return pd.DataFrame({"lang": langs, "score": scores})

    return predict(F.col(text))


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of documents.

    Null texts and texts without a letter are und, 0. Only doc_id, text and lang are read, lang for learning alone, so
    other columns may have any names. A null doc_id counts as the empty text in the fold. Repeated rows are told each,
    and alike; long texts are read whole, in stretches. An empty table gives an empty result.
    """
    model = fit(docs, folds=folds, held_out=held_out)
    return docs.select("doc_id", (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out"), predicted(docs, model).alias("p")).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
