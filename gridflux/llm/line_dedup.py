"""Line deduplication by an exact set-similarity join.

A line's tokens are its different words; every line with a word takes part. Lines with equal sets meet
in one group. For the groups' sets, tokens are ordered by rarity over all documents; two sets of Jaccard
similarity 0.8 or more share a token within their prefixes. Tokens go to buckets by their hash, many packed
in one row; there the sets that share one are scanned in blocks, by length, position and a parity sketch of
128 bits, which can only be too lenient. A line needs a single earlier match to go, so a block sends on each
set's likeliest earlier candidate alone; only sets that it doesn't settle get all their others. Candidates
are verified on the lines' words, beside each other.
A line is removed if an equal or similar line stands before it, kept or not.

Rarity is counted in a table of fixed size, indexed by the word's hash. Any order gives the same
result; a table too small for the vocabulary costs time only. Words are compared by 64-bit hashes, and
sets are equal if a 128-bit sum of their words' hashes is.

Defined results. Lines stand in the order of doc_id (null ids last), then place in the text, then a hash
of the text, for different texts under one id. Null text: no lines, it stays null. Lines without a word
stay. Rows with equal id and text count as one document. An empty table gives an empty result.
``remove_repeats`` keeps the input's columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import keep_freed, release, small, stage
from gridflux.llm.words import mix, slices, split_words

COUNTERS, PART = 1 << 21, 1 << 13
BLOCK = 2048  # sets of one block; a token's sets beyond meet block by block
SCAN_ROWS = 200_000
PACK_ROWS = 1 << 19  # posts that one task holds before it packs them
MANY, LIGHT, HEAVY = 1 << 14, 1 << 15, 1 << 18  # buckets hold LIGHT posts each, or up to HEAVY where there are MANY

#: A token in a set's prefix, as tasks exchange it. ``flags`` has 1 or 2 in the lower or higher of two blocks, 4 without an id, 8 for an open set.
POST = np.dtype([("meet", "<u4"), ("flags", "u1"), ("sid", "<i8"), ("size", "<i8"), ("bits", "<u8"), ("more_bits", "<u8"), ("doc_id", "<i8"), ("line", "<i4")])


def word_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of words by hash, over all texts; ``COUNTERS`` numbers whatever the input's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        found = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            np.add.at(found, (split_words(batch["text"]).hash & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        yield from _parts(found)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                counts = np.frombuffer(pa.decompress(data, 8 * PART, "zstd"), np.int64)
                found[part] = found[part] + counts if part in found else counts
        for part, counts in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_packed(counts)], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    parts = texts.select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).toArrow()
    counts = np.zeros(COUNTERS, np.uint32)
    for part, data in zip(parts["part"].to_pylist(), parts["counts"].to_pylist(), strict=True):
        counts[part * PART : (part + 1) * PART] = np.minimum(np.frombuffer(pa.decompress(data, 8 * PART, "zstd"), np.int64), 2**32 - 1)
    return counts


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), "zstd", asbytes=True)


def _parts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The table in compressed parts, those with a number in them."""
    for part, numbers in enumerate(counts.reshape(-1, PART)):
        if numbers.any():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_packed(numbers)], pa.binary())], ["part", "counts"])


def _line_order(h: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order by line, rarity up to 2^20 - 1, then hash, in every slice: by one packed key, and by all
    three in lines where the key ties. ``place``: line and rarity, 32 bits each."""
    line, rare = place >> np.uint64(32), np.minimum(place & np.uint64(0xFFFFFFFF), np.uint64(0xFFFFF))
    if len(line) and int(line.max()) >> 20:
        return np.lexsort((h, rare, line))
    key = line << np.uint64(44) | rare << np.uint64(24) | h >> np.uint64(40)
    order = np.argsort(key)
    tied = (key[order[1:]] == key[order[:-1]]) & (h[order[1:]] != h[order[:-1]])
    again = np.flatnonzero(np.isin(line[order], line[order[1:][tied]])) if tied.any() else np.empty(0, np.int64)
    there = order[again]
    order[again] = there[np.lexsort((h[there], rare[there], line[there]))]
    return order


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.BinaryArray:
    """Runs of the values as binary, cut at the edges."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))])


def _runs(binary: pa.BinaryArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of all the runs, and how many each has; none of them is null."""
    edge = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1]
    return np.frombuffer(binary.buffers()[2], np.uint8)[edge[0] : edge[-1]].view(kind), np.diff(edge) // np.dtype(kind).itemsize


def line_sets(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """One row for each line with a word: doc_id, hash, line, its set's 128-bit key, number of tokens,
    parity sketch, the rarest tokens, as many as any similar set must share one of, and those of them
    that may stand in more than ``BLOCK`` prefixes.

    ``prefix`` is packed, four bytes a token: a token that occurs once in all documents can't be shared and is 0.
    """
    held = texts.sparkSession.sparkContext.broadcast(counts)  # a table of fixed size

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in slices(batches):
            words = split_words(batch["text"])
            h = words.hash
            if not h.size:
                continue
            new = np.ones(len(h), bool)
            new[1:] = (words.text[1:] != words.text[:-1]) | (words.line[1:] != words.line[:-1])
            doc, number = words.text[new], words.line[new]
            rare = held.value[(h & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64)
            place = (np.cumsum(new) - 1).astype(np.uint64) << np.uint64(32) | rare
            order = _line_order(h, place)
            h, place = h[order], place[order]
            new[1:] = (h[1:] != h[:-1]) | (place[1:] != place[:-1])
            h, place = h[new], place[new]
            line = (place >> np.uint64(32)).astype(np.int64)
            n = np.bincount(line, minlength=len(doc))
            start = np.cumsum(n) - n
            k1, k2 = (np.add.reduceat(mix(h ^ np.uint64(c)), start) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
            at, half = np.uint64(1) << (h >> np.uint64(58)), h & np.uint64(1)
            bits, more_bits = (np.bitwise_xor.reduceat(np.where(half == k, at, np.uint64(0)), start).view(np.int64) for k in (0, 1))
            prefix = np.where(n < 4, 0, n - -(-4 * n // 5) + 1)  # fewer than four have equal sets alone
            within = np.arange(len(h)) - start[line] < prefix[line]
            seen = place[within] & np.uint64(0xFFFFFFFF)
            token = h[within].astype(np.uint32)
            tokens = np.where(seen <= 1, np.uint32(0), np.maximum(token, 1))
            often = seen > BLOCK
            some = np.concatenate([[0], np.cumsum(np.bincount(line[within][often], minlength=len(doc)))]).astype(np.int32)
            of = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(of), batch["hash"].take(of), pa.array(number, pa.int32()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(bits), pa.array(more_bits), _binary(tokens, np.concatenate([[0], np.cumsum(prefix)])), pa.ListArray.from_arrays(some, pa.array(tokens[often].view(np.int32)))],
                ["doc_id", "hash", "line", "k1", "k2", "n", "bits", "more_bits", "prefix", "often"],
            )

    return texts.select("doc_id", "hash", "text").mapInArrow(sets, "doc_id long, hash long, line int, k1 long, k2 long, n int, bits long, more_bits long, prefix binary, often array<int>")


def _place() -> Column:
    """Order of lines: null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "hash")


def _with_hot(sets: DataFrame) -> tuple[DataFrame, int]:
    """The sets with ``hot``, their tokens in more than ``BLOCK`` prefixes and the blocks of each as text, and
    how many posts they make. Blocks of such a token meet two by two."""
    often = sets.select("sid", F.explode("often").alias("token"))
    many = often.groupBy("token").count().where(F.col("count") > BLOCK)
    many = stage(many.select("token", "count", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot_tokens")
    more = many.agg(F.sum(F.col("count") * (F.col("blocks") - 1))).first()[0]
    posts = (sets.agg(F.sum(F.floor(F.col("n") / 5) + 1)).first()[0] or 0) + (more or 0)
    if more is None:
        return sets.withColumn("hot", F.lit(None).cast("string")), posts
    hot = often.join(small(many), "token").groupBy("sid").agg(F.array_join(F.collect_list(F.concat_ws(" ", "token", "blocks")), " ").alias("hot"))
    return sets.join(small(stage(hot, "hot_sets")), "sid", "left"), posts


def _posts_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The posts of a batch of sets, about ``PACK_ROWS`` at a time."""
    column = {c: batch[c].fill_null(0).to_numpy(zero_copy_only=False) for c in ("sid", "n", "flags", "bits", "more_bits", "doc_id", "line")}
    token, n = _runs(batch["prefix"], np.uint32)
    of, at = np.repeat(np.arange(len(n)), n), np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
    known = token != 0
    of, at, token = of[known], at[known], token[known]
    blocks = np.zeros(len(of), np.int64)
    if batch["hot"].null_count < len(n):
        hot = [(k, np.array(text.split(), np.int64).reshape(-1, 2)) for k, text in enumerate(batch["hot"].to_pylist()) if text]
        key = np.concatenate([k << 32 | pairs[:, 0] & 0xFFFFFFFF for k, pairs in hot])
        order, own = np.argsort(key), of << 32 | token
        there = np.minimum(np.searchsorted(key, own, sorter=order), len(key) - 1)
        blocks = np.where(key[order][there] == own, np.concatenate([pairs[:, 1] for _, pairs in hot])[order][there], 0)
    copies = np.maximum(blocks, 1)
    end, done = np.cumsum(copies), 0
    while done < len(of):
        before = end[done] - copies[done]
        to = max(done + 1, int(np.searchsorted(end, before + PACK_ROWS, "right")))
        post = np.repeat(np.arange(done, to), copies[done:to])
        other = np.arange(len(post)) - (end - copies)[post] + before
        own, done = of[post], to
        rows = np.empty(len(post), POST)
        for c in ("sid", "flags", "bits", "more_bits", "doc_id", "line"):
            rows[c] = column[c][own]
        rows["size"] = column["n"][own].astype(np.int64) << 32 | at[post]
        rows["meet"] = token[post]
        cut = np.flatnonzero(blocks[post])
        if cut.size:
            other, own = other[cut], (mix(rows["sid"][cut].astype(np.uint64)) % blocks[post[cut]].astype(np.uint64)).astype(np.int64)
            pair = (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64)
            rows["meet"][cut] = mix(mix(pair) ^ rows["meet"][cut]) >> np.uint64(32)
            rows["flags"][cut] |= np.where(own < other, 1, np.where(own > other, 2, 0)).astype(np.uint8)
        yield rows


def _bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (rows["meet"].astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)


def _packed_posts(groups: DataFrame) -> tuple[DataFrame, int]:
    """The posts of all sets, packed by bucket, and the number of buckets. Tokens that meet share a bucket;
    buckets grow in number with the posts, so each is small beside a task's memory."""
    sets, posts = _with_hot(groups.where("n >= 4"))
    buckets = max(1, -(-posts // HEAVY), min(MANY, -(-posts // LIGHT)))
    flags = (4 * F.col("first.none").cast("int") + 8 * F.col("open").cast("int")).alias("flags")
    of = sets.select("sid", "n", "bits", "more_bits", "first.doc_id", "first.line", flags, "prefix", "hot")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        parts, held = [], 0
        for batch in batches:
            for rows in _posts_of(batch):
                parts.append(rows)
                held += len(rows)
                if held >= PACK_ROWS:
                    yield runs(np.concatenate(parts))
                    parts, held = [], 0
        if held:
            yield runs(np.concatenate(parts))
        release()

    def runs(rows: np.ndarray) -> pa.RecordBatch:
        bucket = _bucket(rows, buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        rows, bucket = rows.view(f"V{POST.itemsize}")[order].view(POST), bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int64)), _binary(rows, np.append(first, len(rows)))], ["bucket", "posts"])

    return of.mapInArrow(pack, "bucket long, posts binary"), buckets


def _before(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether y stands before x, or under the same id in a line of the same number."""
    none, doc, line = rows["flags"] & 4, rows["doc_id"], rows["line"]
    same = (none[x] == none[y]) & (doc[x] == doc[y])
    return (none[y] < none[x]) | (none[x] == none[y]) & (doc[y] < doc[x]) | same & (line[y] <= line[x])


def scan(rows: dict[str, np.ndarray], every: bool) -> tuple[np.ndarray, ...]:
    """Candidates among rows in the order of ``meet``. With ``every`` all pairs (late, early) whose late
    set is open; else each set that is in a pair, its likeliest earlier one (or -1), in how many bits they
    differ, and whether it has more."""
    order = np.lexsort((rows["size"], rows["meet"]))
    rows = {c: v[order] for c, v in rows.items()}
    n, at, bits, more_bits, flags = rows["size"] >> 32, rows["size"] & 0xFFFFFFFF, rows["bits"], rows["more_bits"], rows["flags"]
    size = len(n)
    first = np.flatnonzero(np.concatenate([[True], rows["meet"][1:] != rows["meet"][:-1]]))
    last = np.repeat(np.append(first[1:], size), np.diff(np.append(first, size)))
    least, likeliest, more, paired, found = np.full(size, 999), np.full(size, -1), np.zeros(size, bool), np.zeros(size, bool), []
    i, k = np.arange(size), 0
    while i.size:
        k += 1
        i = i[i + k < last[i]]
        i = i[4 * n[i + k] <= 5 * n[i]]
        j = i + k
        total = n[i] + n[j]
        need = -(-4 * total // 9)
        ok = np.minimum(n[i] - at[i], n[j] - at[j]) >= need
        a, b, most = i[ok], j[ok], (total - 2 * need)[ok]
        d = np.bitwise_count(bits[a] ^ bits[b]).astype(np.int64) + np.bitwise_count(more_bits[a] ^ more_bits[b])
        ok = d <= most
        a, b, d = a[ok], b[ok], d[ok]
        sides = flags[a] & 3, flags[b] & 3
        other = (sides[0] != sides[1]) | (sides[0] == 0) & (rows["sid"][a] != rows["sid"][b])
        a, b, d = a[other], b[other], d[other]
        paired[a] = paired[b] = True
        for late, early in ((a, b), (b, a)):  # both ways where only the hash of the text decides
            after = _before(rows, late, early)
            x, y, z = late[after], early[after], d[after]
            if every:
                wanted = flags[x] & 8 > 0
                found.append((x[wanted], y[wanted], z[wanted]))
            else:
                more[x] |= likeliest[x] >= 0
                better = z < least[x]
                least[x[better]], likeliest[x[better]] = z[better], y[better]
    sid = rows["sid"]
    if every:
        x, y, z = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        return sid[x], sid[y], z, np.zeros(len(x), bool)
    x = np.flatnonzero(paired)
    return sid[x], np.where(likeliest[x] >= 0, sid[likeliest[x]], -1), least[x], more[x]


def candidates(groups: DataFrame, every: bool = False) -> DataFrame:
    """late, early, apart and more, as ``scan`` gives them, of sets that share a token in their prefixes
    and pass all filters; early is -1 for a set that only has later partners."""
    posts, buckets = _packed_posts(groups)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(rows: np.ndarray) -> pa.RecordBatch:
            late, early, apart, more = scan({c: rows[c] for c in POST.names}, every)
            return pa.RecordBatch.from_arrays([pa.array(late), pa.array(early), pa.array(apart.astype(np.int32)), pa.array(more.astype(bool))], ["late", "early", "apart", "more"])

        keep_freed()
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            read, _ = _runs(batch["posts"], POST)
            for a in range(0, len(read), SCAN_ROWS):
                parts.append(read[a : a + SCAN_ROWS])
                held += len(parts[-1])
                if held >= SCAN_ROWS:
                    rows = np.concatenate(parts)
                    bucket = _bucket(rows, buckets)
                    cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                    if cut:
                        yield of(rows[:cut])
                    parts, held = [rows[cut:].copy()], held - cut
        if held:
            yield of(np.concatenate(parts))
        release()

    return posts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(scanned, "late long, early long, apart int, more boolean")


def _verified(pairs: DataFrame, groups: DataFrame, texts: DataFrame, most: int = 5000) -> DataFrame:
    """late of the pairs (late, early) that are similar and in this order.

    A set early in many pairs is a family's head. Its words and the others' are cut out where the text
    is and meet in the family's task; a family of more than ``most`` is split and its head repeated.
    """
    heads = pairs.groupBy("early").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    lates = pairs.join(heads, "early").select(F.col("early").alias("family"), F.pmod(F.xxhash64("late"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("member"), F.col("late").alias("sid"))
    heads = heads.select(F.col("early").alias("family"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("member"), F.col("early").alias("sid"))
    members = small(stage(heads.unionByName(lates), "members")).join(groups.select("sid", "first"), "sid")
    fields = F.concat_ws(" ", F.coalesce(F.col("first.doc_id").cast("string"), F.lit("-")), "first.line", "family", "block", "member", "sid")
    owners = members.groupBy(F.col("first.hash").alias("owner")).agg(F.array_join(F.collect_list(fields), ",").alias("wanted"))  # Arrow takes a text faster than a list
    there = texts.join(small(stage(owners, "owners")), texts["hash"] == F.col("owner")).select("doc_id", "hash", "text", "wanted")
    schema = "family long, block int, member int, sid long, none boolean, doc_id long, line int, hash long, tokens binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in slices(batches):
            lines, out = [], []
            for doc_id, text_hash, text, wanted in zip(*(batch[c].to_pylist() for c in ("doc_id", "hash", "text", "wanted")), strict=True):
                cut_up = text.split("\n")
                own = "-" if doc_id is None else str(doc_id)
                for of, *numbers in (w.split(" ") for w in wanted.split(",")):
                    if of == own:
                        line, family, block, member, sid = map(int, numbers)
                        lines.append(cut_up[line])
                        out.append((family, block, member, sid, doc_id is None, doc_id, line, text_hash))
            if out:
                words = split_words(pa.array(lines, pa.string()))
                edges = np.searchsorted(words.text, np.arange(len(lines) + 1)).tolist()
                tokens = pa.array([np.unique(words.hash[a:b]).tobytes() for a, b in zip(edges, edges[1:])], pa.binary())
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*out), kinds)), tokens], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, x, at = None, np.empty(0, np.uint64), None
        for batch in batches:
            late = []
            for r in batch.to_pylist():
                y, place = np.frombuffer(r["tokens"], np.uint64), (r["none"], r["doc_id"] or 0, r["line"], r["hash"])
                if not r["member"]:
                    head, x, at = (r["family"], r["block"]), y, place
                elif head != (r["family"], r["block"]):
                    raise RuntimeError("a set's text has changed while it was compared")
                elif at < place and 9 * np.intersect1d(x, y, assume_unique=True).size >= 4 * (x.size + y.size):
                    late.append(r["sid"])
            yield pa.RecordBatch.from_arrays([pa.array(late, pa.int64())], ["late"])

    cuts = there.mapInArrow(cut, schema).repartition("family", "block").sortWithinPartitions("family", "block", "member")
    return cuts.mapInArrow(compare, "late long")


def _later(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """sid of the sets that have a similar one before them."""
    known = F.when(F.col("early") >= 0, F.col("early"))
    found = candidates(groups).withColumn("early", known).groupBy("late").agg(F.min_by("early", F.when(known.isNotNull(), F.struct("apart", "early"))).alias("early"), (F.max("more") | (F.min("early") < F.max("early"))).alias("more"))
    found = stage(found, "paired")
    best = found.where("early IS NOT NULL")
    later = stage(_verified(best, groups, texts).distinct(), "later")
    open_ = stage(best.where("more").join(later, "late", "left_anti").select(F.col("late").alias("sid"), F.lit(True).alias("open")), "open")
    if not open_.isEmpty():
        met = groups.drop("open").join(small(found.select(F.col("late").alias("sid"))), "sid")
        met = stage(met.join(small(open_), "sid", "left").withColumn("open", F.coalesce("open", F.lit(False))), "met")
        rest = candidates(met, True).select("late", "early").distinct().join(best, ["late", "early"], "left_anti")
        later = later.unionByName(stage(_verified(stage(rest, "others"), groups, texts).distinct(), "later_still"))
    return later.select(F.col("late").alias("sid"))


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, and the sorted numbers (from 0) of the lines to remove, of each
    document that has some."""
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    lines = stage(line_sets(texts, word_counts(texts)), "lines")
    groups = lines.groupBy("k1", "k2").agg(F.min(_place()).alias("first"), F.first(F.struct("n", "bits", "more_bits", "prefix", "often")).alias("s"), F.count("*").alias("lines"))
    groups = stage(groups.select("k1", "k2", "first", "lines", "s.*").withColumn("sid", F.monotonically_increasing_id()).withColumn("open", F.lit(False)), "groups")
    later = small(stage(_later(groups, texts), "all_later"))
    again = groups.select("sid", "k1", "k2", "first", "lines").join(later.withColumn("late", F.lit(True)), "sid", "left").where("late OR lines > 1").select("k1", "k2", F.when(F.col("late"), None).otherwise(F.col("first")).alias("stays"))
    gone = lines.select("doc_id", "hash", "line", "k1", "k2").join(small(stage(again, "again")), ["k1", "k2"]).where(F.col("stays").isNull() | (_place() != F.col("stays")))
    return gone.groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _marked(docs: DataFrame) -> DataFrame:
    """row (all columns as a struct) and the lines to remove."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("text_hash"))
    found = small(stage(repeats(docs), "repeats"))
    return rows.join(found, F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("hash")), "left").select("row", "key", "removed")


def _without(text: str, removed: str) -> Column:
    left = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains(F.col(removed), s["i"]))
    return F.when(F.col(removed).isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda s: s["x"]), "\n"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the lines that repeat an earlier one, with the columns they came with;
    n_chars, where there is one, is the new text's."""
    kept = _marked(docs).select("row", _without("row.text", "removed").alias("kept"))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, number of lines, removed line numbers and the remaining text of each document."""
    n = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n")))
    none = F.array().cast("array<int>")
    return _marked(docs.select("doc_id", "text")).select(F.col("key").alias("doc_id"), n.alias("n_lines"), F.coalesce("removed", none).alias("removed"), _without("row.text", "removed").alias("text"))
