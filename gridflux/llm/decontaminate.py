"""Benchmark decontamination: an FM-index for each shard of documents, searched for benchmark windows.

A shard is about ``SHARD_BYTES`` of whole texts, equal ones indexed once. Its index (``fm_index``) is
written as one row, next to its documents' ids and numbers of words. Windows of the benchmark, each
different one once, are the phrases of a backward search; occurrences are located by sampled places
and merged into spans of words. Windows are dealt in blocks of ``BLOCK`` so that a task holds one block
whatever the benchmark's size; the stored index serves all blocks, and other benchmarks.

Words are compared by 64-bit hashes of their bytes.

Defined results. A-Z is lower-cased, a word is a run of 0-9, a-z and characters from U+0080 on. Null
and empty texts have no words and are never hit; so are items without words. A document's rows stay
apart whatever their ids, null ids included. Items of one id are one item, those of null id another one
named ``null``. Without hits the digest is that of the empty string. Empty tables give no rows, or
rows without hits. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import release, small, stage
from gridflux.llm.fm_index import Index, depth, occurrences
from gridflux.llm.words import _BYTES, _C, _powers, mix, slices

WINDOW, SHARD_BYTES, BLOCK = 10, 4 << 20, 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.arange(256) >= 128
_WORD[48:58] = _WORD[97:123] = True

ARRAYS = {"hashes": "<u8", "symbols": "<i4", "less": "<i4", "levels": "<u8", "sampled": "<u8", "places": "<i4", "starts": "<i4"}
SPANS = "array<struct<first:int,past:int>>"


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, first and past byte within the text of every word."""
    edge = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64))])
    data = np.frombuffer(b"".join(t.as_buffer() for t in texts if t.is_valid), np.uint8)
    none = np.zeros(0, np.int64)
    if not len(data):
        return none.astype(np.uint64), none, none, none
    data = _FOLD[data]
    word = _WORD[data]
    first, last = word.copy(), word.copy()
    inner = np.zeros(len(word) + 1, bool)
    inner[1:-1] = True
    inner[edge] = False  # a text's edge ends a word
    first[1:] &= ~(word[:-1] & inner[1:-1])
    last[:-1] &= ~(word[1:] & inner[1:-1])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES.take(data) * powers[: len(data)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _C)
    text = np.searchsorted(edge[1:], start, "right")
    return h, text, start - edge[text], end - edge[text]


def build_index(docs: DataFrame, key: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored index: a row for each shard, with key, text number and number of words of its documents."""
    document = pa.list_(pa.struct([("key", pa.int64()), ("text", pa.int32()), ("n_words", pa.int64())]))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, part in enumerate(slices(batches, most=shard_bytes)):
            coded = part["text"].fill_null("").dictionary_encode()
            texts = len(coded.dictionary)
            h, text, _, _ = split(coded.dictionary)
            built = Index.build(h, text, texts)
            number = np.asarray(coded.indices)
            words = np.bincount(text, minlength=texts)[number]
            rows = pa.StructArray.from_arrays([part["key"], pa.array(number, pa.int32()), pa.array(words, pa.int64())], ["key", "text", "n_words"])
            shard = (TaskContext.get().partitionId() << 33) + k
            columns = [pa.array([shard]), pa.array([built.n], pa.int64()), *(pa.array([np.ascontiguousarray(getattr(built, c)).astype(t).tobytes()], pa.binary()) for c, t in ARRAYS.items())]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays([0, len(rows)], rows).cast(document)], ["shard", "n", *ARRAYS, "documents"])
        release()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"{c} binary" for c in ARRAYS)
    return stage(rows.mapInArrow(index, f"shard long, n long, {schema}, documents array<struct<key:long,text:int,n_words:long>>"), "fm_index")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Windows (their hashes one after another, the number of the set of items that have it), and those
    sets (number, items: ids as strings, sorted)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            h, text, _, _ = split(part["text"])
            edge = np.searchsorted(text, np.arange(part.num_rows + 1))
            which, found = [], []
            for k, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
                if b > a:
                    own = {h[i : min(i + window, b)].tobytes() for i in range(a, max(a + 1, b - window + 1))}
                    which += [k] * len(own)
                    found += own
            yield pa.RecordBatch.from_arrays([part["item"].take(pa.array(which, pa.int64())), pa.array(found, pa.binary())], ["item", "window"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text"))
    owned = stage(rows.mapInArrow(cut, "item string, window binary").groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")), "windows")
    sets = stage(owned.select("items").distinct().withColumn("set", F.monotonically_increasing_id()), "item_sets")
    return stage(owned.join(sets, "items").select("window", "set"), "numbered_windows"), sets


def search(index: DataFrame, windows: DataFrame, block: int = BLOCK) -> DataFrame:
    """shard, text, spans (words hit, from first to before past, apart and in order) and sets of every text hit."""
    blocks = max(1, -(-windows.count() // block))
    found = None
    for b in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b).toArrow()
        hits = stage(_searched(index, rows["window"].to_pylist(), np.asarray(rows["set"]).astype(np.int64)), f"hits_{b}")
        found = hits if found is None else found.unionByName(hits)
    merged = found.groupBy("shard", "text").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("sets"))).alias("sets"))
    joined = F.aggregate("spans", F.array().cast(SPANS), _extend)
    return merged.withColumn("spans", joined)


def _extend(done, span):
    """A span joined to the last one where they touch."""
    last = F.element_at(done, -1)
    wider = F.struct(last["first"].alias("first"), F.greatest(last["past"], span["past"]).alias("past"))
    touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["past"] >= span["first"])
    return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(done, F.array(span)))


def _searched(index: DataFrame, windows: list[bytes], sets: np.ndarray) -> DataFrame:
    lengths = np.array([len(w) // 8 for w in windows], np.int64)
    width = int(lengths.max(initial=1))
    phrases = np.frombuffer(b"".join(w.rjust(8 * width, b"\0") for w in windows), "<u8").reshape(-1, width)
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parts = {c: np.frombuffer(batch[c][k].as_buffer(), t) for c, t in ARRAYS.items()}
                parts["levels"] = parts["levels"].reshape(depth(len(parts["less"]) - 1), -1)
                shard = Index(n=batch["n"][k].as_py(), **parts)
                edge, owned = np.zeros(shard.n + 1, np.int32), []
                for number, text, word in occurrences(shard, phrases, lengths):
                    at = shard.starts[text] + word
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + lengths[number], -1)
                    owned.append(np.unique(np.stack([text, sets[number]], 1), axis=0))
                if not owned:
                    continue
                hit = np.cumsum(edge) > 0
                step = np.diff(hit.astype(np.int8), prepend=0)  # a separator is never hit, so no span leaves its text
                first, past = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                text = np.searchsorted(shard.starts, first, "right") - 1
                texts, at = np.unique(text, return_index=True)
                spans = pa.StructArray.from_arrays([pa.array(first - shard.starts[text], pa.int32()), pa.array(past - shard.starts[text], pa.int32())], ["first", "past"])
                owned = np.unique(np.concatenate(owned), axis=0)
                own = np.searchsorted(owned[:, 0], texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(texts), batch["shard"][k].as_py(), np.int64)),
                        pa.array(texts, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.append(at, len(spans)), pa.int32()), spans).cast(spans_type),
                        pa.ListArray.from_arrays(pa.array(np.append(own, len(owned)), pa.int32()), pa.array(owned[:, 1])),
                    ],
                    ["shard", "text", "spans", "sets"],
                )
        release()

    return index.select("shard", "n", *ARRAYS).mapInArrow(run, f"shard long, text int, spans {SPANS}, sets array<long>")


def documents_hit(index: DataFrame, windows: DataFrame, sets: DataFrame) -> DataFrame:
    """key, n_words, spans and items (ids as strings, sorted) of every document; null where nothing is hit."""
    hits = stage(search(index, windows), "hits")
    items = hits.select("shard", "text", F.explode("sets").alias("set")).join(small(sets), "set")
    items = items.groupBy("shard", "text").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = stage(hits.drop("sets").join(items, ["shard", "text"], "left"), "hits_with_items")
    rows = index.select("shard", F.explode("documents").alias("d")).select("shard", "d.*")
    return rows.join(small(hits), ["shard", "text"], "left").select("key", "n_words", "spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    rows = documents_hit(build_index(docs), *benchmark_windows(benchmark, window))
    n_hit = F.aggregate(F.coalesce("spans", F.array().cast(SPANS)), F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("key").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, every word that a benchmark window hits cut out of the text, from the first byte of
    a span's first word to the last of its last one. Same columns and rows."""
    names, row = docs.columns, next(c for k in range(len(docs.columns) + 1) if (c := f"row_{k}") not in docs.columns)
    kept = stage(docs.withColumn(row, F.monotonically_increasing_id()), "documents_with_rows")
    found = documents_hit(build_index(kept, row), *benchmark_windows(benchmark, window)).where("spans IS NOT NULL")
    joined = kept.join(found.select(F.col("key").alias(row), F.col("spans").alias(f"{row}_spans")), row, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for k, spans in enumerate(batch[f"{row}_spans"].to_pylist()):
                if spans:
                    _, _, start, end = split(batch["text"].slice(k, 1))
                    raw, at, left = texts[k].encode(), 0, []
                    for s in spans:
                        left.append(raw[at : start[s["first"]]])
                        at = end[s["past"] - 1]
                    texts[k] = b"".join([*left, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch[c] for c in names], names)

    return joined.mapInArrow(cut, docs.schema)


CONTAMINATION_SQL = f"""
WITH words AS (SELECT 'd' AS side, row_number() OVER () AS id, doc_id::VARCHAR AS name,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), coalesce(item_id::VARCHAR, 'null'),
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), {WINDOW}) AS m FROM words WHERE side = 'b' AND len(w) > 0),
items AS MATERIALIZED (SELECT DISTINCT name AS item, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT name, w, least(len(w), {WINDOW}) AS m, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM words WHERE side = 'b' AND len(w) > 0)),
places AS (SELECT id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, lengths WHERE side = 'd' AND len(w) >= m)),
found AS MATERIALIZED (SELECT id, m, i, win FROM places WHERE (m, win) IN (SELECT m, win FROM items)),
hit AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + m)) AS p FROM found) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT id, item FROM found JOIN items USING (m, win)) GROUP BY id)
SELECT name::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hit USING (id) LEFT JOIN named USING (id) WHERE side = 'd'
"""
