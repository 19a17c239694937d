"""Whitening, decontamination and the Merkle manifest: against SQL, brute force and on odd tables."""

from __future__ import annotations

import re
import zlib
from hashlib import sha256

import numpy as np
import oracle
import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_odd_tables import LONG, odd

from gridflux.llm import decontaminate, fm_index, merkle_manifest, queries, whitening


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", ["op12_fm_index_decontamination", "op13_merkle_manifest"])
def test_against_sql(spark, con, name):
    assert oracle.difference(con, queries.ORACLE_SQL[name], queries.QUERIES[name](spark, SF)) == ""


# ------------------------------------------------------------------ whitening


def check_whitened(got: pd.DataFrame, x: np.ndarray, ids: list, components: int) -> None:
    """``x`` holds a row for each id, in the order of ``ids``, which differ."""
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(0)
    values, axes = np.linalg.eigh(np.cov(distinct.T.astype(float), bias=True))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = (x - s / n) @ axes / np.sqrt(values)
    got = got.sort_values(["vec_id", "component"])
    order = np.argsort(ids)
    assert got["vec_id"].tolist() == np.repeat(np.array(ids)[order], components).tolist()
    assert got["component"].tolist() == list(range(1, components + 1)) * len(ids)
    found = got["whitened"].to_numpy().reshape(-1, components)
    assert np.abs(found * np.sign((found * want[order]).sum(0)) - want[order]).max() < 1e-8
    assert got["deviation"].to_numpy().reshape(-1, components)[:, 0].tolist() == ((n * x.astype(object) - s) ** 2).sum(1)[order].tolist()
    assert (got["n"] == n).all() and (got["identity_error"] < 1e-9).all()
    share = values / np.var(distinct, axis=0).sum()
    assert np.allclose(got["explained"].to_numpy().reshape(-1, components), share, rtol=1e-9)


def test_whitening(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.floor(64 * np.stack(rows["embedding"].to_numpy()).astype(float)).astype(np.int64) + 1_000_000
    check_whitened(queries.QUERIES["op11_jacobi_davidson_whitening"](spark, SF).toPandas(), x, rows["vec_id"].tolist(), 16)


def test_vectors_that_do_not_count(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((60, 3))
    rows = [(k, v.tolist(), "x", k) for k, v in enumerate(good)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, -inf, 1.0], [1e300, 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    rows += [(100 + k, v, "x", 1) for k, v in enumerate(bad)] + [(200, good[5].tolist(), None, None), (None, good[6].tolist(), "y", 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, d int")
    got = whitening.whitened_components(df).toPandas()
    assert got["vec_id"].isna().sum() == 3
    a, b = (got[got["vec_id"] == k].sort_values("component")["whitened"].tolist() for k in (5, 200))
    assert a == b
    x = np.floor(64 * good).astype(np.int64) + 1_000_000
    check_whitened(got[got["vec_id"] < 100].astype({"vec_id": "int64"}), x, list(range(60)), 3)


def test_vectors_without_spread(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whitened_components(df([])).count() == 0
    assert whitening.whitened_components(df([(1, None), (2, [])])).count() == 0
    assert whitening.whitened_components(df([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whitening.whitened_components(df([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [3.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got) == [(k, 1, 2, 128**2, 1.0, 1.0) for k in (1, 2, 3)]


def test_deviations_beyond_64_bits():
    x = np.array([[1_000_000, 5], [1_000_000 + 2**40, 5]], np.int64)
    assert whitening.deviations(x, 2, x.sum(0)) == [None, None]
    assert whitening.deviations(x[:, 1:], 2, x.sum(0)[1:]) == [0, 0]


@pytest.mark.parametrize("spectrum", [np.linspace(1, 0.01, 150), 1 / np.arange(1, 151) ** 2, np.r_[np.ones(4), np.linspace(0.5, 0.4, 146)], np.r_[1.0, 0.5, np.zeros(148)]])
def test_eigensolver(spectrum):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((150, 150)))
    a = (q * spectrum) @ q.T
    widest = [0]

    def product(b):
        widest[0] = max(widest[0], b.shape[1])
        return a @ b

    values, axes = whitening.jacobi_davidson(product, 150, 16)
    assert np.abs(values - spectrum[:16]).max() < 1e-13
    assert np.linalg.norm(a @ axes - axes * values, axis=0).max() < 1e-13 and np.abs(axes.T @ axes - np.eye(16)).max() < 1e-13
    assert widest[0] <= 20  # never the whole matrix


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 4))
    b[:, 3] = 0
    x = whitening.minres(lambda v: a @ v, b, 90, 1e-13)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 3].any()


# ------------------------------------------------------------------ decontamination


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(0)
    for trial in range(60):
        texts = [rng.integers(0, rng.integers(1, 5), rng.integers(0, 40)).astype(np.uint64) for _ in range(rng.integers(0, 6))]
        texts += texts[:1] * (trial % 3)
        number = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(int)
        index = fm_index.Index.build(np.concatenate([*texts, np.zeros(0, np.uint64)]), number, len(texts))
        wanted = [rng.integers(0, 5, rng.integers(1, 6)).astype(np.uint64) for _ in range(20)]
        phrases = np.stack([np.concatenate([np.zeros(5 - len(p), np.uint64), p]) for p in wanted])
        got = sorted(tuple(map(int, r)) for part in fm_index.occurrences(index, phrases, np.array([len(p) for p in wanted]), 9) for r in zip(*part))
        assert got == [(i, k, s) for i, p in enumerate(wanted) for k, t in enumerate(texts) for s in range(len(t) - len(p) + 1) if (t[s : s + len(p)] == p).all()]


def test_suffix_array():
    rng = np.random.default_rng(4)
    for n, v in ((1, 1), (300, 2), (300, 50), (2000, 1)):
        x = np.append(rng.integers(1, v + 1, n), 0)
        assert fm_index.suffix_array(x).tolist() == sorted(range(n + 1), key=lambda i: x[i:].tolist())


WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def expected_hits(rows, items, window=10):
    """(doc_id, n_words, n_hit, n_items, digest) of each row, by looking at every window."""
    cut = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = cut(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[k : k + m]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, own = cut(t), set(), set()
        for m in {len(k) for k in wins}:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k : k + m])) in wins:
                    hit |= set(range(k, k + m))
                    own |= wins[x]
        out.append((i, len(w), len(hit), len(own), sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "one line OF SOME plain words here another"), (2, "Another line of"), (2, "stop now"), (None, "words"), (10, "word1and1 word2and2 " * 6), (4, None), (5, "--- "), (6, "été"), (7, "ÉTÉ")]


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
@pytest.mark.parametrize("items", [ITEMS, []])
def test_hits_on_odd_tables(spark, kind, items, monkeypatch):
    docs = odd(spark, kind).withColumns({"spans": F.lit(1), "shard": F.lit(2)})
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns({"window": F.lit(1), "item": F.lit(2)})
    key = lambda r: tuple(map(str, r))
    want = sorted(expected_hits([(r.doc_id, r.text) for r in docs.collect()], items), key=key)
    assert sorted((tuple(r) for r in decontaminate.contamination(docs, benchmark).collect()), key=key) == want
    windows, sets = decontaminate.benchmark_windows(benchmark)
    index = decontaminate.build_index(docs, shard_bytes=100_000)
    one, many = (sorted(map(str, decontaminate.search(index, windows, b).select("shard", "text", "spans", F.array_sort("sets")).collect())) for b in (100, 2))
    assert one == many


def test_passages_are_cut_out(spark):
    passage = " ".join(f"q{k}" for k in range(15))
    rows = [(1, f"Before, {passage.upper()}; after."), (2, None), (3, f"{passage} {passage}"), (1, "nothing here"), (None, f"x {LONG[:3000]} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_0", F.lit("kept"))
    out = decontaminate.without_passages(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert out.columns == docs.columns
    want = [(1, "Before, ; after."), (2, None), (3, ""), (1, "nothing here"), (None, f"x {LONG[:3000]} ")]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


# ------------------------------------------------------------------ manifest


def expected_proofs(leaves, changed):
    """proof digest, folded root and root by plain trees; ``leaves``: (lang, doc_id, leaf) in the order of leaves."""
    h = merkle_manifest.digest

    def tree(nodes):
        """The root, and the siblings of every node, with each level's place."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, place in enumerate(at):
                run = place - place % 8
                paths[k].append((place % 8, nodes[run:place] + nodes[place + 1 : run + 8]))
                at[k] = place // 8
            nodes = [h(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0], paths

    langs = sorted({r[0] for r in leaves}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in leaves if r[0] == x]) for x in langs}
    root, upper = tree([trees[x][0] for x in langs])
    out, seen = [], dict.fromkeys(langs, 0)
    for lang, i, leaf in leaves:
        path = trees[lang][1][seen[lang]] + upper[langs.index(lang)]
        seen[lang] += 1
        folded = changed.get(leaf, leaf)
        for at, others in path:
            folded = h(others[:at] + [folded] + others[at:])
        out.append((i, leaf, trees[lang][0], root, h([x for _, o in path for x in o]), folded, folded == root))
    return out


@pytest.mark.parametrize("sizes", [[], [1], [8], [9], [512], [513, 1, 2], [4097, 3], [1] * 70])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(f"={k:03d}", i, merkle_manifest.digest([f"{k} {i}"]), merkle_manifest.digest(["!"]) if i % 5 == 0 else None) for k, n in enumerate(sizes) for i in range(n)]
    to = merkle_manifest.build(spark.createDataFrame(rows, "tree string, doc_id long, leaf string, tampered string"))
    want = expected_proofs([r[:3] for r in rows], {r[2]: r[3] for r in rows if r[3]}) if rows else []
    assert sorted(tuple(r) for r in merkle_manifest.verify(spark, to).collect()) == sorted(want)
    proofs = merkle_manifest.proofs(spark, to).collect()
    assert len(proofs) == len(rows)
    assert all(merkle_manifest.fold(r.leaf, merkle_manifest.read_path(r.path)) == r.root for r in proofs)


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
def test_manifest_of_odd_tables(spark, kind):
    docs = odd(spark, kind).withColumns({"tree": F.lit("x"), "leaf": F.lit("y"), "idx": F.lit(1)})
    if kind == "plain":
        docs = docs.withColumn("lang", F.when(F.col("doc_id") > 3, F.col("lang")).when(F.col("doc_id") == 3, ""))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, s, n: sha256("".join(map(part, (i, s, lang, n, t))).encode()).hexdigest()
    changed = {k: v for r in rows if r[0] is not None and r[1] and zlib.crc32(str(r[0]).encode()) % 3 == 0 for k, v in [(leaf(*r), leaf(r[0], re.sub("[A-Z]", lambda m: m[0].lower(), r[1]), *r[2:]))]}
    leaves = sorted(((r[2], r[0], leaf(*r)) for r in rows), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
    got = sorted((tuple(r) for r in merkle_manifest.verify_documents(docs).collect()), key=str)
    assert got == (sorted(expected_proofs(leaves, changed), key=str) if rows else [])
