"""Merkle manifest of a data set: every row a leaf, a tree for each language, one root over all.

A node is H of up to ``FAN`` consecutive nodes below it, H the lowercase hex SHA-256 of its inputs'
concatenation. Checkpoint and recompute: only every ``EVERY``-th level is written (leaves, level 3,
level 6, ...), each row of a table holding one aligned subtree's ``FAN ** EVERY`` nodes at most.
Proofs go top down: a task takes one aligned subtree's stored nodes and the path above it, makes the
levels between anew, emits each node's siblings up to the root and throws the levels away. So memory
and rows follow one subtree, and a proof's upper part is stored once for a whole subtree.

Tables in the manifest's folder, all Parquet: ``leaves`` (tree, block, members: doc_id, leaf and the
tampered leaf where it differs), ``level_3``, ``level_6``, ... (tree, block, members: digest), and
``roots`` (tree, subroot, root, path: the siblings from the subroot to the root).

Defined results. A null column is hashed as ``-``. Leaves of a language ascend by doc_id, null ids
first; equal ids by leaf digest, so repeated rows have the same tree in any order of reading. A null
language is a tree of its own, before all others; an empty string is another. Null ids aren't tampered
with. An empty table gives empty tables. Columns other than the five are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridflux.llm.common import shared_dir, small, stage

FAN, EVERY = 8, 3
SUBTREE = FAN**EVERY
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Levels from a node up, each as its place in the run and the run's other digests.
Path = list[tuple[int, list[str]]]


def digest(inputs: list[str]) -> str:
    return sha256("".join(inputs).encode()).hexdigest()


def field(column: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else UTF-8 byte count, colon, value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def tree_of(lang: str) -> Column:
    """A tree's name: no null, and in the order of trees (null first, then UTF-8 bytewise)."""
    return F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("-"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and tampered: the leaf of the tampered row where it has one."""
    rows = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    folded = F.translate("text", UPPER, LOWER)
    changed = F.when(touched & (folded != F.col("text")), leaf_of(*rows, folded))
    return docs.select(tree_of("lang").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(*rows, F.col("text")).alias("leaf"), changed.alias("tampered"))


def numbered(leaves: DataFrame, *order: str) -> DataFrame:
    """The rows with ``idx``, each one's place in its tree from 0 on, by the ``order`` columns.

    Rows are dealt by ranges of tree and order (equal rows by where they were read), so one large tree
    spreads over many partitions; a place is the row's number in its sorted partition plus what the
    tree has in the partitions before.
    """
    keys = ["tree", *order]
    rows = stage(leaves.withColumn("read_at", F.monotonically_increasing_id()), "unordered")
    rows = rows.repartitionByRange(*keys, "read_at").sortWithinPartitions(*keys, "read_at").drop("read_at")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("at", 33))
    parts = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = stage(parts.select("tree", "part", (before - F.col("first")).alias("shift")), "shift")
    return rows.join(small(shift), ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocks(nodes: DataFrame, *columns: str) -> DataFrame:
    """tree, block, members: the aligned subtrees, their nodes in order; at most ``SUBTREE`` in each."""
    rows = nodes.withColumn("block", F.floor(F.col("idx") / F.lit(SUBTREE)).cast("long"))
    members = F.array_sort(F.collect_list(F.struct("idx", *columns)))
    return rows.groupBy("tree", "block").agg(members.alias("members")).withColumn("members", F.transform("members", lambda m: F.struct(*(m[c].alias(c) for c in columns))))


def levels_of(nodes: list[str], alone: bool) -> list[list[str]]:
    """The levels of an aligned subtree from ``nodes`` up: to the next stored level, or where it is its
    tree's only one (``alone``) until one node remains."""
    out = [nodes]
    while len(out) <= EVERY and (len(out[-1]) > 1 or not alone):
        below = out[-1]
        out.append([digest(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return out


def siblings(levels: list[list[str]], place: int) -> Path:
    """At each level below the top one: the node's place in its run and the run's other nodes."""
    out = []
    for level in levels[:-1]:
        run = place - place % FAN
        out.append((place % FAN, level[run:place] + level[place + 1 : run + FAN]))
        place //= FAN
    return out


def fold(leaf: str, path: Path) -> str:
    """The root that a leaf and its siblings give."""
    for at, others in path:
        leaf = digest([*others[:at], leaf, *others[at:]])
    return leaf


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {name: batch[name][k].as_py() for name in batch.schema.names}


def write_path(path: Path) -> str:
    """A path as text: levels split by slashes, each the place (one digit) and the digests."""
    return "/".join(f"{at}{''.join(others)}" for at, others in path)


def read_path(text: str) -> Path:
    return [(int(x[0]), [x[i : i + 64] for i in range(1, len(x), 64)]) for x in text.split("/") if x]


def _tops(table: DataFrame, column: str) -> DataFrame:
    """tree, block, digest, alone: the top node of each aligned subtree of a stored level."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [levels_of(r["nodes"], r["alone"])[-1][0] for r in _rows(batch.select(["nodes", "alone"]))]
            yield pa.RecordBatch.from_arrays([batch["tree"], batch["block"], pa.array(tops, pa.string()), batch["alone"]], ["tree", "block", "digest", "alone"])

    rows = _marked(table.select("tree", "block", F.transform("members", lambda m: m[column]).alias("nodes")))
    return rows.mapInArrow(climb, "tree string, block long, digest string, alone boolean")


def _marked(table: DataFrame) -> DataFrame:
    """Whether a subtree is its tree's only one: a full first subtree may have a second."""
    alone = (F.col("block") == 0) & F.col("second").isNull()
    seconds = table.where("block = 1").select("tree", F.lit(True).alias("second"))
    return table.join(small(seconds), "tree", "left").withColumn("alone", alone).drop("second")


def _grow(table: DataFrame, column: str, to: str) -> tuple[DataFrame, int]:
    """Write the stored levels above ``table``; returns tree and digest of every tree's root, and how many there are."""
    spark, level, roots = table.sparkSession, 0, None
    while True:
        tops = stage(_tops(table, column), "tops")
        done = tops.where("alone").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        rest = tops.where("not alone").select("tree", F.col("block").alias("idx"), "digest")
        if rest.isEmpty():
            return roots, level
        level += EVERY
        blocks(rest, "digest").write.option("compression", "zstd").parquet(f"{to}/level_{level}")
        table, column = spark.read.parquet(f"{to}/level_{level}"), "digest"


def _paths(spark: SparkSession, to: str, top: int, above: DataFrame) -> DataFrame:
    """tree, block, path: the way from each subtree of leaves to the root, made level by level from the
    stored levels; ``above`` has each tree's path from its own root on."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                levels, upper = levels_of(r["nodes"], r["alone"]), read_path(r["path"])
                paths = [write_path(siblings(levels, k) + upper) for k in range(len(r["nodes"]))]
                places = range(r["block"] * SUBTREE, r["block"] * SUBTREE + len(paths))
                yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * len(paths)), pa.array(places, pa.int64()), pa.array(paths)], ["tree", "block", "path"])

    paths = above.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for level in range(top, 0, -EVERY):
        table = _marked(spark.read.parquet(f"{to}/level_{level}").select("tree", "block", F.transform("members", lambda m: m["digest"]).alias("nodes")))
        lower = stage(table.join(small(paths), ["tree", "block"]).mapInArrow(descend, f"tree string, block long, path string"), f"paths_{level}")
        # trees whose root lies at or below this level wait for their own
        grown = spark.read.parquet(f"{to}/level_{level}").where("block = 0").select("tree")
        paths = lower.unionByName(paths.where("block = 0").join(small(grown), "tree", "left_anti"))
    return paths


def _alone(paths: DataFrame, table: DataFrame) -> DataFrame:
    """A stored level's subtrees with the path above each."""
    return _marked(table).join(small(paths), ["tree", "block"])


def build(leaves: DataFrame, to: str | None = None) -> str:
    """Write the manifest of ``leaves`` (tree, doc_id, leaf, tampered); returns its folder."""
    spark = leaves.sparkSession
    to = to or f"{shared_dir(spark)}/gridflux/{uuid.uuid4().hex}/merkle"
    blocks(numbered(leaves, "doc_id", "leaf"), "doc_id", "leaf", "tampered").write.option("compression", "zstd").parquet(f"{to}/leaves")
    subroots, _ = _grow(spark.read.parquet(f"{to}/leaves"), "leaf", to)
    subroots = subroots.withColumnRenamed("tree", "name")

    # the trees' roots are the leaves of one more tree, in the order of the trees
    forest = f"{to}/forest"
    order = numbered(subroots.withColumn("tree", F.lit("")), "name")
    blocks(order, "name", "digest").write.parquet(f"{forest}/leaves")
    base = spark.read.parquet(f"{forest}/leaves")
    root, top = _grow(base, "digest", forest)
    above = _paths(spark, forest, top, root.select("tree", F.lit("").alias("path")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                digests = [m["digest"] for m in r["members"]]
                levels = levels_of(digests, r["alone"])
                paths = [siblings(levels, k) + read_path(r["path"]) for k in range(len(digests))]
                columns = [[m["name"] for m in r["members"]], digests, [fold(digests[0], paths[0])] * len(digests), [write_path(p) for p in paths]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["tree", "subroot", "root", "path"])

    _alone(above, base).mapInArrow(place, f"tree string, subroot string, root string, path string").write.parquet(f"{to}/roots")
    return to


def _top(spark: SparkSession, to: str) -> int:
    """The highest stored level over the leaves: the least whose nodes are at most one subtree in every tree."""
    top, most = 0, spark.read.parquet(f"{to}/leaves").agg(F.max("block")).first()[0] or 0
    while most > 0:
        top, most = top + EVERY, most // SUBTREE
    return top


def _proved(spark: SparkSession, to: str) -> DataFrame:
    """The leaves' subtrees with the path above each, the subroot and the root."""
    roots = spark.read.parquet(f"{to}/roots")
    paths = _paths(spark, to, _top(spark, to), roots)
    return _alone(paths, spark.read.parquet(f"{to}/leaves")).join(small(roots.select("tree", "subroot", "root")), "tree")


def proofs(spark: SparkSession, to: str) -> DataFrame:
    """doc_id, leaf, root and path of every leaf: the proof, as ``read_path`` takes it apart."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                leaves = [m["leaf"] for m in r["members"]]
                levels, upper = levels_of(leaves, r["alone"]), read_path(r["path"])
                paths = [write_path(siblings(levels, k) + upper) for k in range(len(leaves))]
                columns = [pa.array([m["doc_id"] for m in r["members"]], pa.int64()), pa.array(leaves), pa.array([r["root"]] * len(leaves)), pa.array(paths)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "root", "path"])

    return _proved(spark, to).mapInArrow(emit, "doc_id long, leaf string, root string, path string")


def verify(spark: SparkSession, to: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf: its proof, and the
    root that the tampered leaf (else the leaf) gives with the original siblings."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                members, upper = r["members"], read_path(r["path"])
                levels = levels_of([m["leaf"] for m in members], r["alone"])
                shared = "".join(x for _, others in upper for x in others)
                found = []
                for k, m in enumerate(members):
                    own = siblings(levels, k)
                    folded = fold(m["tampered"] or m["leaf"], own + upper)
                    proof = digest([x for _, others in own for x in others] + [shared])
                    found.append((m["doc_id"], m["leaf"], r["subroot"], r["root"], proof, folded, folded == r["root"]))
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    return _proved(spark, to).mapInArrow(check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def verify_documents(docs: DataFrame) -> DataFrame:
    return verify(docs.sparkSession, build(document_leaves(docs)))


def _sql() -> str:
    """DuckDB SQL for ``verify_documents``: eight levels in each language, four over the languages."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join([part('doc_id'), part('source'), part('lang'), part('n_chars'), part(text)])})"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')], lambda a, b: {byte}), 4294967295)"
    parts = [
        f"WITH base AS MATERIALIZED (SELECT doc_id, lang, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf, "
        f"CASE WHEN ({crc}) % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents), "
        "f0 AS MATERIALIZED (SELECT *, leaf AS node, coalesce(tampered, leaf) AS folded, '' AS proof, "
        "row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM base)"
    ]

    def climb(k: int, before: str, after: str, tree: str) -> None:
        # a node's run; nothing changes once one node remains
        parts.append(
            f"n{k} AS MATERIALIZED (SELECT DISTINCT {tree} AS t, idx, node FROM {before}), "
            f"r{k} AS MATERIALIZED (SELECT *, sum(len(l)) OVER (PARTITION BY t) AS many FROM (SELECT t, idx // {FAN} AS run, list(node ORDER BY idx) AS l FROM n{k} GROUP BY t, idx // {FAN})), "
            f"{after} AS MATERIALIZED (SELECT f.* REPLACE (CASE WHEN many > 1 THEN sha256(array_to_string(l, '')) ELSE node END AS node, "
            f"CASE WHEN many > 1 THEN sha256(array_to_string(l[:idx % {FAN}] || [folded] || l[idx % {FAN} + 2:], '')) ELSE folded END AS folded, "
            f"CASE WHEN many > 1 THEN proof || array_to_string(l[:idx % {FAN}] || l[idx % {FAN} + 2:], '') ELSE proof END AS proof, "
            f"idx // {FAN} AS idx) FROM {before} f JOIN r{k} ON t = {tree} AND run = idx // {FAN})"
        )

    for k in range(8):
        climb(k, f"f{k}", f"f{k + 1}", "tree")
    parts.append("g0 AS MATERIALIZED (SELECT * REPLACE (dense_rank() OVER (ORDER BY tree) - 1 AS idx), node AS subroot FROM f8)")
    for k in range(4):
        climb(10 + k, f"g{k}", f"g{k + 1}", "''")
    return ", ".join(parts) + " SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM g4"


VERIFY_SQL = _sql()
