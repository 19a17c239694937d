"""Content-addressed store of token ids.

Rolling hashes cut each document's ids into chunks. A chunk's address is the SHA-256 of its bytes
and each different chunk is stored once. A document is a recipe, its list of addresses. Merkle trees
stand over a document's addresses, over a run's documents (each leaf holds id, start, number of ids and the
document's root) and over the runs; a reader rebuilds all three and raises at the first difference, so a lost,
changed, repeated or reordered chunk, document or run can't pass.

Files, all Parquet so that any store Spark reaches can hold them:
``chunks`` (address, ids: little-endian unsigned integers of ``width`` bytes),
``recipes`` (in ascending doc_id order: doc_id, document, run, start, n_tokens, addresses, root),
``manifest`` (run, start, documents, n_tokens, root; and the root of all runs as run -1).

Defined results. Null or empty text: the end id alone. Null ids come first; documents with equal or
null ids stay separate documents, in a fixed order. An empty table gives empty files. Columns other
than the id and the text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import shared_dir, stage, text_of
from gridflux.llm.tokens import byte_encoder, vocabulary_path

WINDOW, MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 16, 64, 8, 1024


@lru_cache(maxsize=2)
def _gear(size: int) -> np.ndarray:
    """A random 64-bit number for each id."""
    return np.random.default_rng(20).integers(0, 2**63, size, dtype=np.uint64)


def rolling_cuts(ids: np.ndarray, starts: np.ndarray, vocab_size: int) -> list[list[int]]:
    """Chunk ends of each document; ``starts``: where each document begins in ``ids``, and the end.

    The hash of a place sums the last ``WINDOW`` ids' random numbers, each shifted by its distance;
    a chunk ends after a place whose hash has ``MEAN_BITS`` zero bits on top. A place counts only
    ``MIN_CHUNK`` ids from the last cut on, so the window never reaches into another document.
    """
    h = _gear(vocab_size)[ids]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint64(step))
        step *= 2
    places = np.flatnonzero(((h << np.uint64(1)) >> np.uint64(64 - MEAN_BITS)) == 0) + 1
    at = np.searchsorted(places, starts).tolist()
    out = []
    for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        cuts, last = [], a
        for p in [*places[at[k] : at[k + 1]].tolist(), b]:
            while p - last > MAX_CHUNK:
                last += MAX_CHUNK
                cuts.append(last)
            if p - last >= MIN_CHUNK or p == b and p > last:
                cuts.append(p)
                last = p
        out.append(cuts)
    return out


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of the binary tree over the leaves; an odd one goes up as it is."""
    while len(leaves) > 1:
        leaves = [sha256(b"".join(leaves[i : i + 2])).digest() if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0] if leaves else sha256(b"").digest()


def run_roots(recipes: DataFrame) -> DataFrame:
    """run, start, documents, n_tokens and root of each run, rebuilt from the recipes; whole: each
    document begins where the one before it ends. A run's rows are bounded by ``run_documents``."""

    def root(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["start", "document"])
        start, n = rows["start"].to_numpy(), rows["n_tokens"].to_numpy()
        ids = rows["doc_id"].astype("Int64")
        leaves = [sha256(f"{'-' if i is pd.NA else i} {a} {k} ".encode() + r).digest() for i, a, k, r in zip(ids, start.tolist(), n.tolist(), rows["root"], strict=True)]
        whole = bool((start[1:] == start[:-1] + n[:-1]).all())
        return pd.DataFrame([(int(rows["run"].iat[0]), int(start[0]), len(rows), int(n.sum()), merkle_root(leaves), whole)], columns=["run", "start", "documents", "n_tokens", "root", "whole"])

    return recipes.select("run", "doc_id", "document", "start", "n_tokens", "root").groupBy("run").applyInPandas(root, "run int, start long, documents long, n_tokens long, root binary, whole boolean")


def verify_manifest(spark: SparkSession, store: str) -> None:
    """Raise where the recipes don't give the manifest: by count, start, ids and root of each run and of
    the whole. One row for each run comes to the driver."""
    names = ["run", "start", "documents", "n_tokens", "root"]
    kept = {r["run"]: r for r in spark.read.parquet(f"{store}/manifest").select(*names).collect()}
    found = sorted(run_roots(spark.read.parquet(f"{store}/recipes")).collect(), key=lambda r: r["run"])
    whole = kept.pop(-1, None)
    if whole is None:
        raise ValueError("the manifest has no root")
    for r in found:
        if not r["whole"] or r["run"] not in kept or any(r[c] != kept[r["run"]][c] for c in names):
            raise ValueError(f"run {r['run']} isn't the manifest's")
    if {r["run"] for r in found} != set(kept):
        raise ValueError("runs are missing")
    if _whole(found) != tuple(whole[c] for c in names):
        raise ValueError("the runs don't give the manifest's root")


def _whole(runs: list) -> tuple[int, int, int, int, bytes]:
    """The manifest's last row, from all runs in order."""
    return -1, 0, sum(r["documents"] for r in runs), sum(r["n_tokens"] for r in runs), merkle_root([bytes(r["root"]) for r in runs])


def _encoded(docs: DataFrame, path: str, end_id: int, width: int) -> DataFrame:
    kind = f"<u{width}"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        size, end = max(encoder.vocab_size, end_id + 1), int(end_id).to_bytes(4, "little")
        if size > 2 ** (8 * width):
            raise ValueError(f"ids of this vocabulary need more than {width} bytes")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                raw = [encoder.encode(t.as_py()) + end for t in part["text"]]
                ids = np.frombuffer(b"".join(raw), "<u4")
                starts = np.cumsum([0, *(len(r) // 4 for r in raw)])
                data = ids.astype(kind).tobytes()
                chunks, last = [], 0
                for cuts in rolling_cuts(ids, starts, size):
                    edges = [last, *cuts]
                    chunks.append([data[width * a : width * b] for a, b in zip(edges, edges[1:])])
                    last = edges[-1]
                addresses = [[sha256(c).digest() for c in d] for d in chunks]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(np.diff(starts)), pa.array(addresses, pa.list_(pa.binary())), pa.array(chunks, pa.list_(pa.binary())), pa.array(map(merkle_root, addresses), pa.binary())],
                    ["doc_id", "n_tokens", "addresses", "chunks", "root"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, addresses array<binary>, chunks array<binary>, root binary")


def write_store(docs: DataFrame, to: str | None = None, path: str | None = None, end_id: int = 0, width: int = 2, run_documents: int = 50_000) -> str:
    """Encode the documents, append ``end_id`` to each, store them; returns the store's folder."""
    spark = docs.sparkSession
    to = to or f"{shared_dir(spark)}/gridflux/{uuid.uuid4().hex}/token_store"
    encoded = stage(_encoded(docs, path or vocabulary_path("byte_bpe_50k.json"), end_id, width).withColumn("document", F.monotonically_increasing_id()), "encoded")

    pairs = encoded.select(F.explode(F.arrays_zip("addresses", "chunks")).alias("c")).select(F.col("c.addresses").alias("address"), F.col("c.chunks").alias("ids"))
    pairs.groupBy("address").agg(F.first("ids").alias("ids")).write.option("compression", "zstd").parquet(f"{to}/chunks")

    runs = max(1, -(-encoded.count() // run_documents))
    recipes = encoded.drop("chunks").repartitionByRange(runs, "doc_id", "document").sortWithinPartitions("doc_id", "document")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            n = np.asarray(batch["n_tokens"])
            ends = done + np.cumsum(n)
            yield batch.append_column("in_run", pa.array(ends - n))
            done = int(ends[-1]) if len(ends) else done

    names = "doc_id long, n_tokens long, addresses array<binary>, root binary, document long"
    recipes = recipes.mapInArrow(placed, f"{names}, in_run long").withColumn("run", F.spark_partition_id())
    recipes = stage(recipes, "in_order")
    sizes = recipes.groupBy("run").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("documents")).orderBy("run").collect()  # one row for each run
    before = np.concatenate([[0], np.cumsum([r["n"] for r in sizes])]).tolist()
    starts = spark.createDataFrame([(r["run"], b) for r, b in zip(sizes, before)], "run int, before long")
    in_place = recipes.join(F.broadcast(starts), "run").withColumn("start", F.col("before") + F.col("in_run")).drop("before", "in_run")
    in_place.repartitionByRange(runs, "start").sortWithinPartitions("start").write.parquet(f"{to}/recipes")
    roots = sorted(run_roots(spark.read.parquet(f"{to}/recipes")).collect(), key=lambda r: r["run"])
    if [r["documents"] for r in roots] != [r["documents"] for r in sizes] or not all(r["whole"] for r in roots):
        raise ValueError("the recipes were not written whole")
    rows = [(r["run"], r["start"], r["documents"], r["n_tokens"], bytes(r["root"])) for r in roots]
    spark.createDataFrame([*rows, _whole(roots)], "run int, start long, documents long, n_tokens long, root binary").coalesce(1).write.parquet(f"{to}/manifest")
    return to


#: CRC-32 as zlib computes it: the reversed polynomial (fixed value).
CRC_POLYNOMIAL = 0xEDB88320


def _times(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Product over GF(2) of matrices (…, 32) of columns and vectors (…)."""
    out = np.zeros_like(v)
    for bit in range(32):
        out ^= np.where((v >> np.uint32(bit)) & np.uint32(1), m[..., bit], np.uint32(0))
    return out


@lru_cache(maxsize=1)
def _shift_tables() -> np.ndarray:
    """Matrix that moves a CRC past 4·n zero bytes, for n from 0 to ``MAX_CHUNK``."""
    bit = np.array([CRC_POLYNOMIAL, *(1 << k for k in range(31))], np.uint32)
    for _ in range(5):  # 2, 4, 8, 16, 32 zero bits
        bit = _times(bit[None, :], bit)
    tables = [np.array([1 << k for k in range(32)], np.uint32)]
    for _ in range(MAX_CHUNK):
        tables.append(_times(bit[None, :], tables[-1]))
    return np.stack(tables)


def joined_crc(crcs: np.ndarray, lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of each document from its chunks' CRCs and numbers of 4-byte ids, in order."""
    tables, count = _shift_tables(), np.diff(offsets)
    out = np.zeros(len(count), np.uint32)
    for k in range(int(count.max(initial=0))):
        rows = np.flatnonzero(count > k)
        at = offsets[rows] + k
        out[rows] = _times(tables[lengths[at]], out[rows]) ^ crcs[at]
    return out


def _verified_chunks(spark: SparkSession, store: str, width: int) -> DataFrame:
    """Address, number of ids and CRC-32 of the 4-byte ids of each chunk; a wrong byte raises."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, crc = [], []
            for address, ids in zip(batch["address"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if sha256(ids).digest() != address:
                    raise ValueError(f"chunk {address.hex()} is damaged")
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                n.append(len(wide))
                crc.append(zlib.crc32(wide))
            yield pa.RecordBatch.from_arrays([batch["address"], pa.array(n, pa.int32()), pa.array(crc, pa.int64())], ["address", "n", "crc"])

    return spark.read.parquet(f"{store}/chunks").mapInArrow(verify, "address binary, n int, crc long")


def read_checksums(spark: SparkSession, store: str, width: int = 2) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read from the files and verified.

    Each chunk's bytes are checked against its address and each recipe against its root and its
    number of ids, all recipes against the manifest; a document's checksum follows from its chunks' checksums, so chunks need not be
    sent to every document that holds them.
    """
    verify_manifest(spark, store)
    recipes = spark.read.parquet(f"{store}/recipes")
    parts = recipes.select("document", F.posexplode("addresses").alias("place", "address")).join(_verified_chunks(spark, store, width), "address")
    parts = parts.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("place", "n", "crc"))).alias("parts"))
    joined = recipes.join(parts, "document", "left")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch["parts"]
            flat, offsets = parts.flatten(), np.concatenate([[0], np.cumsum(np.asarray(parts.value_lengths().fill_null(0)))])
            n, crc = np.asarray(flat.field("n")), np.asarray(flat.field("crc")).astype(np.uint32)
            sizes = np.concatenate([[0], np.cumsum(n)])
            if (sizes[offsets[1:]] - sizes[offsets[:-1]] != np.asarray(batch["n_tokens"])).any():
                raise ValueError("chunks of a document are missing")
            for addresses, root in zip(batch["addresses"].to_pylist(), batch["root"].to_pylist(), strict=True):
                if merkle_root(addresses) != root:
                    raise ValueError("a recipe doesn't give its root")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(joined_crc(crc, n, offsets).astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return joined.select("doc_id", "start", "n_tokens", "addresses", "root", "parts").mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def restore(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start and ids (the stored bytes) of each document, verified as ``read_checksums`` does."""
    verify_manifest(spark, store)
    recipes = spark.read.parquet(f"{store}/recipes")
    parts = recipes.select("document", F.posexplode("addresses").alias("place", "address")).join(spark.read.parquet(f"{store}/chunks"), "address", "left")
    whole = parts.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("place", "address", "ids"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for root, parts in zip(batch["root"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                if merkle_root([p["address"] for p in parts]) != root or any(p["ids"] is None or sha256(p["ids"]).digest() != p["address"] for p in parts):
                    raise ValueError("a document's chunks are missing or damaged")
                out.append(b"".join(p["ids"] for p in parts))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["start"], pa.array(out, pa.binary())], ["doc_id", "start", "ids"])

    return recipes.join(whole, "document").select("doc_id", "start", "root", "parts").mapInArrow(join, "doc_id long, start long, ids binary")
