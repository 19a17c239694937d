"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for all operators."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from gridflux.llm import bpe, fingerprint, line_dedup, minhash, packing, quality_classifier, quality_rules, token_store, toxicity, url_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "n_tokens", "words", "row", "hash", "removed", "fingerprint", "exact", "bands", "class_id", "length", "lines", "kept", "number", "key")
LONG = " ".join(f"word{k % 977} and{k % 31}." for k in range(60_000))
ROWS = [
    (1, "One line of some plain words here.\nAnother line of some plain words there.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t \n", "en", "a", 5),
    (5, LONG, "en", "a", len(LONG)),
    (6, "One line of some plain words here.\nAnother line of some plain words there.", "en", "a", 1),
    (7, "ÉTÉ <|endoftext|> don't  stop\x00now \U0001f600", "fr", "b", 9),
    (7, "ÉTÉ <|endoftext|> don't  stop\x00now \U0001f600", "fr", "b", 9),
    (7, "another text under the same id with some words", "fr", "b", 9),
    (None, "a text without an id", "en", "a", 3),
    (None, None, "en", "a", None),
    (8, "x" + " " * 1_100_000 + "\n" * 1_100_000, "en", "a", 2_200_001),
    (9, "word" * 100_000, "en", "a", 400_000),
]
LABELS = [(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (7, 1, 0), (7, 0, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def odd(spark, kind):
    docs = spark.createDataFrame([] if kind == "empty" else ROWS, SCHEMA)
    return docs.withColumns({c: F.lit("x") for c in CLASHES}) if kind == "clash" else docs


OPERATORS = {
    "op1": lambda d, n: quality_classifier.score_documents(d, n),
    "op2": lambda d, n: bpe.encode_digests(d),
    "op4": lambda d, n: fingerprint.compare_edited(d),
    "op4_plain": lambda d, n: fingerprint.fingerprints(d),
    "op6": lambda d, n: token_store.read_checksums(d.sparkSession, token_store.write_store(d)),
    "op7": lambda d, n: toxicity.score_documents(d, n),
    "op8": lambda d, n: quality_rules.judge_documents(d),
    "op9": lambda d, n: line_dedup.removed_lines(d),
    "op10": lambda d, n: minhash.classes(d),
}


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(spark, labels, name, kind):
    docs = odd(spark, kind)
    got = OPERATORS[name](docs, labels)
    assert sorted((r[0] is None, r[0]) for r in got.select("doc_id").collect()) == sorted((r[0] is None, r[0]) for r in docs.select("doc_id").collect())


def got(spark, name, labels):
    return OPERATORS[name](odd(spark, "plain"), labels).collect()


@pytest.mark.parametrize("name, limit", [("op1", 0.7), ("op7", 0.5)])
def test_scores_of_odd_texts(spark, labels, name, limit):
    rows = got(spark, name, labels)
    by_id = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 6)}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= limit) for r in rows)
    assert by_id[1].score == by_id[6].score and by_id[2].score == by_id[3].score
    assert all(r.held_out is None or isinstance(r.held_out, bool) for r in rows)


def test_encodings_of_odd_texts(spark, labels):
    rows = got(spark, "op2", labels)
    by_id = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 5, 6)}
    none = hashlib.sha256(b"").hexdigest()
    assert {(by_id[k].n_tokens, by_id[k].ids_sha256, by_id[k].decoded_sha256) for k in (2, 3)} == {(0, none, none)}
    assert by_id[1][1:] == by_id[6][1:] and by_id[5].n_tokens > 60_000
    stored = {r.doc_id: r.n_tokens for r in got(spark, "op6", labels) if r.doc_id in (1, 2, 3, 6)}
    assert stored[2] == stored[3] == 1 and stored[1] == stored[6] > 10


def test_fingerprints_of_odd_texts(spark):
    rows = fingerprint.compare_edited(odd(spark, "plain")).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 5, 6)}
    assert by_id[2].fingerprint == by_id[3].fingerprint != by_id[1].fingerprint == by_id[6].fingerprint
    assert {by_id[k].n_chars for k in (2, 3)} == {0} and by_id[5].n_chars == len(LONG)
    assert all(r.near_edited in (0.0, 1.0) and r.near_next in (0.0, 1.0) for r in rows)


def test_rules_on_odd_texts(spark, labels):
    rows = got(spark, "op8", labels)
    by_id = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 4, 5, 8, 9)}
    assert {tuple(by_id[k])[1:] for k in (2, 3, 4)} == {(0, 0, 0, 0, 0, True, False)}
    assert (by_id[1].n_words, by_id[5].n_words, by_id[8].n_words, by_id[9].n_words) == (14, 120_000, 1, 1)
    assert by_id[9].word_chars == 400_000 and by_id[8].word_chars == 1 and not by_id[9].kept
    assert sum(r.doc_id == 7 for r in rows) == 3


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
def test_pipeline(spark, tmp_path, kind):
    syllables = "ba de fi go lu ma ne pi ro su ta ve".split()
    word = lambda k: syllables[k % 12] + syllables[k // 12 % 12] + syllables[k // 144 % 12]
    plain = {i: " ".join(word(i * 71 + 5 * j * j + 3 * j) for j in range(80)) for i in range(20, 41)}
    docs = odd(spark, kind)
    if kind != "empty":
        extra = [(i, t, "en", "a", len(t)) for i, t in plain.items()] + [(41, plain[40], "en", None, None), (None, plain[40] + " end", None, "b", None)]
        docs = docs.unionByName(spark.createDataFrame(extra, SCHEMA), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    known = [] if kind == "empty" else LABELS + [(i, 1, 0) for i in plain]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pieces = [(r.doc_id, r.piece, r.start) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    texts = {p[0] for p in pieces}
    if kind == "empty":
        assert pieces == []
    else:  # short, blank and junk texts go; copies of a line leave their document an empty text at most
        assert set(plain) <= texts and not texts & {1, 2, 3, 4, 6, 8, 9}
        assert len(set(pieces)) == len(pieces)


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
def test_packing(spark, kind):
    got = packing.pack_documents(odd(spark, kind))
    assert got.where("piece = 0").count() == (0 if kind == "empty" else len(ROWS))
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


@pytest.mark.parametrize("kind", ["plain", "empty", "clash"])
def test_filters_keep_columns(spark, labels, kind):
    docs = odd(spark, kind)
    machine = toxicity.fit(docs, labels)
    for f in (lambda d: toxicity.keep_clean(d, machine), quality_rules.filter_documents, line_dedup.remove_repeats, minhash.keep_first):
        out = f(docs)
        assert out.columns == docs.columns and out.count() <= docs.count()


def test_repeats_are_found(spark):
    docs = odd(spark, "plain")
    cls = {(r.doc_id, r.class_id) for r in minhash.classes(docs).collect()}
    assert {(1, 1), (6, 1), (3, 3), (4, 4)} <= cls
    kept = [r.doc_id for r in minhash.keep_first(docs).collect()]
    assert kept.count(7) == 2 and 6 not in kept and kept.count(None) == 2  # two texts stand under id 7
    lines = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs).collect() if r.doc_id in (1, 6)}
    assert lines == {1: [], 6: [0, 1]}


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (2, "http://a.net/x"), (None, "nonsense"), (3, "x://H.net/?" + "a" * 100_000)], "page_id long, url string").withColumns({"host": F.lit(1), "tokens": F.lit(2)})
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = url_rules.judge_pages(pages, none).collect()
    assert len(got) == 5 and {r.verdict for r in got if r.rule is None} == {"allow"} and all(r.verdict == "block" for r in got if r.rule == "net/")
    assert url_rules.judge_pages(pages.limit(0), none).count() == 0


def test_pipeline_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "near-dedup", "packing"]
