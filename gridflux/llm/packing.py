"""Best-fit packing of token sequences by hierarchical residual packing.

Defined results. Null or empty text: its document is the end id alone. Documents with equal or null
ids are packed as separate documents. An empty table gives an empty result. Columns of the input
other than the id and the text are not read, so their names can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import stage, text_of
from gridflux.llm.tokens import byte_encoder, vocabulary_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row for each piece of at most ``capacity`` ids of each document, ``end_id`` included.

    Only a longer document is cut; its first piece takes what doesn't fill a whole piece.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = byte_encoder(path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(pieces, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit in descending order: bin and offset of each item, and the room left in each bin.

    ``room`` has a bit for each amount of room that some open bin has left, so the tightest fit is
    its lowest bit from the item's size on.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    left: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = room >> size
        if fits:
            before = size + (fits & -fits).bit_length() - 1
            b = open_bins[before].pop()
            if not open_bins[before]:
                room &= ~(1 << before)
        else:
            before, b = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - before
        left[b] = after = before - size
        if after:
            open_bins[after].append(b)
            room |= 1 << after
    return bins, offsets, np.asarray(left, np.int64)


def pack(items: DataFrame, capacity: int, length: str = "length", slack: int = 4, group_items: int = 20_000, fan_in: int = 8) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; no sequence is longer than ``capacity``.

    Items are dealt at random into groups of about ``group_items``. Each group is packed best-fit;
    bins with at most ``slack`` places left are emitted, all others go on to the next round, where up to
    ``fan_in`` groups meet as one. A bin at most half full goes on whole, as one item; no two fuller bins
    can ever meet, so such a bin is opened again and its items go on. How many groups meet follows from
    the units that go on: as many as hold ``group_items`` together, two at least. The round of one group is the
    last; so is one whose groups have each grown to eight times ``group_items``, since then next to nothing
    that goes on fits together. A task's rows follow ``group_items``, and nothing is dropped.

    Items as long as ``capacity`` are sequences of their own. Longer, empty and null lengths are
    errors of the caller and raise.
    """
    columns = items.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    items = stage(items.withColumn("_item", F.monotonically_increasing_id()), "items")
    first = items.agg(F.count("*"), F.count_if(F.coalesce(~F.col(length).between(1, capacity), F.lit(True)))).first()
    if first[1]:
        raise ValueError(f"{first[1]} items have no length from 1 to {capacity}")
    whole = items.where(F.col(length) == capacity).select(*columns, F.col("_item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    groups = max(1, -(-first[0] // group_items))
    out = f"{schema}, _item long, _group long, _unit long, _at long, _done boolean"

    def round_of(last: bool):
        def packed(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["_unit", "_at", "_item"], kind="stable").reset_index(drop=True)
            units, of = np.unique(rows["_unit"].to_numpy(), return_inverse=True)
            sizes = np.bincount(of, weights=rows[length]).astype(np.int64)
            bins, offsets, left = best_fit(sizes, capacity)
            goes, half = (left > slack) & (not last), 2 * left >= capacity
            row_bin = bins[of]
            lead = np.full(len(left), np.iinfo(np.int64).max)
            np.minimum.at(lead, row_bin, rows["_item"].to_numpy())
            opened = goes[row_bin] & ~half[row_bin]
            rows["_at"] = np.where(opened, 0, rows["_at"].to_numpy() + offsets[of])
            rows["_unit"] = np.where(opened, rows["_item"].to_numpy(), lead[row_bin])
            rows["_done"] = ~goes[row_bin]
            return rows

        return packed

    rest = items.where(F.col(length) < capacity).select(
        *columns, "_item", F.pmod(F.xxhash64("_item"), F.lit(groups)).alias("_group"), F.col("_item").alias("_unit"), F.lit(0).cast("long").alias("_at"), F.lit(False).alias("_done")
    )
    done, units = [whole], first[0]
    while True:
        last = groups == 1 or units > 8 * group_items * groups
        rest = stage(rest.groupBy("_group").applyInPandas(round_of(last), out), "round")
        done.append(rest.where("_done").select(*columns, F.col("_unit").alias("sequence_id"), F.col("_at").alias("offset")))
        if last:
            break
        rest = rest.where("not _done")
        units = rest.agg(F.count_distinct("_unit")).first()[0]
        meet = max(2, min(fan_in, groups * group_items // max(1, units)))
        rest, groups = rest.withColumn("_group", F.floor(F.col("_group") / meet).cast("long")), -(-groups // meet)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pack the documents' ids into sequences: one row for each piece with its sequence and offset."""
    return pack(token_pieces(docs, path or vocabulary_path("byte_bpe_50k.json"), end_id, capacity), capacity)
