"""Bounded samples of labelled texts for fitting a model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int, max_chars: int) -> tuple[list[str], np.ndarray, float]:
    """Different whole texts of each class, their labels, and the share of label 1 among all labels.

    At most ``rows_per_class`` ids of each class are taken, in the order of a hash of the id, and of
    their texts those of at most ``max_chars`` characters, two for each id on average at most: that bounds
    what the driver gets to ``2 * rows_per_class * max_chars`` characters, whatever the input's size. Texts
    that stand under both labels keep the more frequent one.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for k in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).dropDuplicates(["doc_id"])
    texts = docs.select("doc_id", "text").where((F.length("text") > 0) & (F.length("text") <= max_chars))
    found = texts.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * rows_per_class).select("text", "label").toArrow().to_pandas()
    found = found.groupby("text", sort=True)["label"].mean().round().astype(int).reset_index()
    found = found.sample(frac=1.0, random_state=7)
    return found["text"].tolist(), found["label"].to_numpy(), share
