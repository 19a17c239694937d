"""Quality classifier by compression.

zstandard dictionaries of several sizes are built from good labelled texts and from bad ones. A text is
compressed with both of a size; the difference of the compressed sizes, divided by their sum, says which kind
it resembles. A logistic calibration turns these differences, and nothing else of the text, into the
probability that the label is 1. Each half of the labelled texts builds dictionaries, and the other half
calibrates them; a text's score is the mean of both halves' log odds.

Defined results. Null or empty text: the share of label 1 among the labels learnt from. No labels of
one class: the same share for all. Equal texts get equal scores. Columns other than id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import crc_fold, text_of
from gridflux.llm.samples import labelled_sample

LEVEL = 3


@lru_cache(maxsize=8)
def _compressors(dictionaries: tuple[bytes, ...]) -> list:
    import zstandard

    return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False) for d in dictionaries]


def size_differences(texts: list[str], good: tuple[bytes, ...], bad: tuple[bytes, ...]) -> np.ndarray:
    """For each text and pair of dictionaries: how many bytes more the bad one needs than the good one, by the sum of both."""
    out = np.empty((len(texts), len(good)))
    tools = list(zip(_compressors(good), _compressors(bad)))
    for k, text in enumerate(texts):
        raw = text.encode()
        for i, (g, b) in enumerate(tools):
            x, y = len(g.compress(raw)), len(b.compress(raw))
            out[k, i] = (y - x) / (x + y)
    return out


def _terms(d: np.ndarray) -> np.ndarray:
    """The differences, their products by twos, and their cubes."""
    k = range(d.shape[1])
    return np.stack([np.ones(len(d)), *d.T, *[d[:, i] * d[:, j] for i in k for j in k if i <= j], *(d**3).T], 1)


@dataclass
class CompressionModel:
    halves: list[tuple[tuple[bytes, ...], tuple[bytes, ...]]]  # dictionaries of good and of bad texts
    range: np.ndarray  # least and most of each difference in the calibration, but for 1 % of texts
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    def odds(self, differences: np.ndarray) -> np.ndarray:
        return (_terms(np.clip(differences, *self.range)) - self.mean) / self.scale @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.halves:
            return np.full(len(texts), self.share)
        odds = np.mean([self.odds(size_differences(texts, good, bad)) for good, bad in self.halves], 0)
        return np.where([len(t) > 0 for t in texts], 1 / (1 + np.exp(-np.clip(odds, -50, 50))), self.share)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        w -= np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    return w


def _dictionary(texts: list[str], size: int) -> bytes:
    """Trained on the texts; of too few for that, an equal part of each."""
    import zstandard

    raw = [t.encode() for t in texts]
    try:
        return zstandard.train_dictionary(size, raw).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(r[: max(1, size // len(raw))] for r in raw)


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 2000, max_chars: int = 50_000, dictionary_bytes: tuple[int, ...] = (4096, 16_384, 65_536)) -> CompressionModel:
    """Learn from at most ``rows_per_class`` labelled texts of each class."""
    texts, y, share = labelled_sample(docs, labels, "quality", rows_per_class, max_chars)
    groups = [[t for t, k in zip(texts, y, strict=True) if k == c] for c in (1, 0)]
    if min(map(len, groups)) < 4:
        none = np.empty(0)
        return CompressionModel([], none, none, none, none, share)
    halves, differences, y = [], [], []
    for half in (0, 1):
        good, bad = (tuple(_dictionary(g[half::2], size) for size in dictionary_bytes) for g in groups)
        rest = [g[1 - half :: 2] for g in groups]
        halves.append((good, bad))
        differences.append(size_differences(rest[0] + rest[1], good, bad))
        y.append(np.repeat([1.0, 0.0], [len(r) for r in rest]))
    d, y = np.concatenate(differences), np.concatenate(y)
    limits = np.quantile(d, [0.005, 0.995], axis=0)
    x = _terms(np.clip(d, *limits))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return CompressionModel(halves, limits, mean, scale, _logistic((x - mean) / scale, y, weight), share)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; rows whose crc32(doc_id) mod 4 is 2
    are held out from learning."""
    model = fit(docs, labels.where(crc_fold("doc_id", 4) != 2))
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded: a few dictionaries and weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = held.value.score(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(p, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(score, "doc_id long, score double")
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
