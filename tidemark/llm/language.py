"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed letter n-grams, scaled to length 1. The vectors of each language's sample are
clustered; a text takes the language of the centroid with the largest cosine. A text that is farther from that
centroid than almost all of the sample was is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .letters import code_points, letters
from .shared import staged, steps

#: Hash buckets of n-grams.
BUCKETS = 1 << 13
#: Labelled texts of each language that a model is fitted on, about; the only bound on what is read to fit.
SAMPLE_TEXTS = 300
#: Centroids of each language.
CENTROIDS = 3
#: Share of a language's sample that lies beyond its distance for rejection.
REJECT_SHARE = 0.005
UNKNOWN = "und"


def counts(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket's n-grams (1 to 3 letters, words padded by one blank) occur in each row; letters by row."""
    points, bounds = code_points(column)
    n = len(column)
    small = letters(points)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    blank = small == 0
    keep = ~blank | np.concatenate(([True], ~blank[:-1] | (rows[1:] != rows[:-1])))[: len(blank)]
    code = small[keep].astype(np.uint64)
    rows = rows[keep]
    out = np.zeros(n * buckets, np.int64)
    value = np.zeros(len(code), np.uint64)
    for size in (1, 2, 3):
        length = len(code) - size + 1
        if length <= 0:
            break
        value = value[:length] * np.uint64(0x100000001B3) + code[size - 1 :] + np.uint64(1)
        same = rows[:length] == rows[size - 1 :]
        solid = same & (code[:length] + code[size - 1 :] > 0) if size > 1 else code > 0
        hashed = ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets
        out += np.bincount((rows[:length] * buckets + hashed)[solid], minlength=n * buckets)
    return out.reshape(n, buckets), np.bincount(rows[code > 0], minlength=n)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(size > 0, size, 1)


@dataclass
class Model:
    names: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray  # cosine below which a centroid's texts are rejected

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of every row."""
        found, has = counts(column, len(self.weights))
        if not self.names:
            return [UNKNOWN] * len(found), np.zeros(len(found)), np.ones(len(found), bool)
        cosine = _unit(np.log1p(found) * self.weights) @ self.centroids.T
        best = cosine.argmax(1)
        score = np.where(has > 0, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
        names = [self.names[self.owner[b]] if h else UNKNOWN for b, h in zip(best, has)]
        return names, score, (score < self.least[best]) | (has == 0)


def _clusters(own: np.ndarray, centroids: int = CENTROIDS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Centroids of unit vectors by spherical k-means, and the cosine that all but REJECT_SHARE of them reach."""
    now = own[np.random.default_rng(seed).permutation(len(own))[: min(centroids, len(own))]]
    for _ in range(12):
        home = (own @ now.T).argmax(1)
        now = _unit(np.stack([own[home == c].sum(0) if (home == c).any() else now[c] for c in range(len(now))]))
    return now, float(np.quantile((own @ now.T).max(1), REJECT_SHARE))


def _idf(texts: int, holding: np.ndarray) -> np.ndarray:
    return np.log((1 + texts) / (1 + holding)) + 0.1


def _model(weights: np.ndarray, found: list[tuple[str, np.ndarray, float]]) -> Model:
    """A model of each language's centroids."""
    if not found:
        return Model([], np.zeros(BUCKETS), np.zeros((0, BUCKETS)), np.zeros(0, int), np.zeros(0))
    found = sorted(found, key=lambda x: x[0])
    size = [len(c) for _, c, _ in found]
    return Model([n for n, _, _ in found], weights, np.concatenate([c for _, c, _ in found]), np.repeat(np.arange(len(found)), size), np.repeat([x for _, _, x in found], size))


def fit(vectors: np.ndarray, labels: list[str], centroids: int = CENTROIDS) -> Model:
    """A model of counted vectors in memory."""
    weights = _idf(len(vectors), (vectors > 0).sum(0)) if len(vectors) else np.zeros(BUCKETS)
    unit, labels_ = _unit(np.log1p(vectors) * weights), np.array(labels)
    return _model(weights, [(name, *_clusters(unit[labels_ == name], centroids)) for name in sorted(set(labels))])


def fold_of(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; null keys are in fold 0, which is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(0))


def sampled(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """About ``most`` rows of each label, chosen by a hash of the key: all of a label with fewer."""
    found = rows.groupBy(label).count().where(F.col(label).isNotNull()).collect()  # a row for each label
    share = F.lit(False)
    for r in found:
        part = F.lit(True) if r["count"] <= most else F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int((1 << 20) * most / r["count"]) + 1
        share = F.when(F.col(label) == r[label], part).otherwise(share)
    return rows.where(share)


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", most: int = SAMPLE_TEXTS) -> Model:
    """A model of the labels in ``docs`` outside fold 0, from about ``most`` whole texts of each.

    Each language is clustered by a task of its own; the driver holds centroids only. Repeated rows count as they stand.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (fold_of(F.col(key)) != 0)).select(key, text, label)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text, 1 << 20):
            found, has = counts(batch.column(text))
            for row in np.flatnonzero(has):
                at = np.flatnonzero(found[row])
                yield pa.RecordBatch.from_arrays([batch.column(label).slice(row, 1), pa.array([at], pa.list_(pa.int32())), pa.array([found[row][at]], pa.list_(pa.int32()))], names=["label", "at", "n"])

    got = staged(sampled(rows, label, key, most).mapInArrow(vectors, "label string, at array<int>, n array<int>"), "vectors")
    holding = np.zeros(BUCKETS, np.int64)
    for r in got.select(F.explode("at").alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect():  # a row for each bucket
        holding[r["b"]] = r["n"]
    weights = _idf(got.count(), holding)

    def cluster(own: pd.DataFrame) -> pd.DataFrame:
        """One language's sample: its centroids end to end."""
        order = sorted(range(len(own)), key=lambda k: (own["at"].iloc[k].tolist(), own["n"].iloc[k].tolist()))
        dense = np.zeros((len(own), BUCKETS))
        for row, k in enumerate(order):
            dense[row, own["at"].iloc[k]] = own["n"].iloc[k]
        found, least = _clusters(_unit(np.log1p(dense) * weights))
        return pd.DataFrame({"label": [own["label"].iloc[0]], "centroids": [found.ravel()], "least": [least]})

    found = got.groupBy("label").applyInPandas(cluster, "label string, centroids array<double>, least double").collect()
    return _model(weights, [(r["label"], np.array(r["centroids"]).reshape(-1, BUCKETS), r["least"]) for r in found])


def identify(docs: DataFrame, model: Model, text: str = "text", refuse: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; with ``refuse`` every rejected text
    is ``und``. A model fitted on no texts answers ``und`` throughout. Repeated rows are answered alike. Result columns replace columns of these names.
    """
    rest = docs.drop("lang_pred", "score", "rejected")
    plain, broadcast = rest.columns, docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text, 1 << 20):
            for at in range(0, batch.num_rows, 128):
                own = batch.slice(at, 128)
                names, score, far = broadcast.value.predict(own.column(text))
                if refuse:
                    names = [UNKNOWN if x else name for name, x in zip(names, far)]
                yield pa.RecordBatch.from_arrays([own.column(c) for c in plain] + [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(far)], names=[*plain, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(predict, schema + ", lang_pred string, score double, rejected boolean")
