"""Each operator's query on the small tables against a plain version of what it must return."""

from __future__ import annotations

import hashlib
import itertools
import re
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridflux.llm import bpe, line_dedup, minhash, packing, quality_classifier, queries, quality_rules, token_store, tokens, toxicity, url_rules, words


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")


def run(spark, name):
    return queries.QUERIES[name](spark, SF).toPandas()


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_quality_scores_on_held_out_rows(spark):
    got = queries.QUERIES["op1_compression_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got["doc_id"], got["held_out"]))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() > 0.93


def test_the_dictionaries_carry_the_quality_score(spark):
    """Dictionaries of mixed texts, with a calibration of their own, tell far less."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet").select("doc_id", c) for t, c in (("documents", "text"), ("labels", "quality")))
    known = docs.join(labels, "doc_id").where("length(text) > 0").toPandas()
    held = known["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2).to_numpy()
    y = known["quality"].to_numpy()[held]

    def area(shuffled):
        frame = known[~held].copy()
        if shuffled:
            frame["quality"] = np.random.default_rng(1).permutation(frame["quality"])
        model = quality_classifier.fit(docs, spark.createDataFrame(frame[["doc_id", "quality"]]))
        rank = np.argsort(np.argsort(model.score(known["text"][held].tolist())))
        return abs((rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum())) - 0.5) + 0.5

    assert area(False) > 0.95 > 0.85 > area(True)


def test_toxicity_on_held_out_rows(spark):
    got = queries.QUERIES["op7_factorization_machine"](spark, "/root/testdata/sf0.01").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got["doc_id"], got["held_out"]))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["toxic"]).mean() > 0.93


def test_machine_learns_a_pair_that_no_single_term_shows():
    rng = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(2000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted(({0} if a else set()) | ({1} if b else set()) | {int(x) for x in rng.integers(2, 20, 3)})))
        y.append(float(a and b))
    y = np.array(y)
    bias, w, v = toxicity.train_machine(rows, y, 20)
    m = toxicity.FactorizationMachine({}, bias, w, v)
    assert ((m.score(rows) >= 0.5) == (y == 1)).mean() > 0.97


def test_terms_that_are_toxic_only_together(spark):
    rng, rows = np.random.default_rng(5), []
    for i in range(1600):
        a, b = i % 2 == 1, i // 2 % 2 == 1  # each stands as often in both classes
        words = [f"word{int(k)}" for k in rng.integers(0, 300, 25)] + ["alpha"] * a + ["bravo"] * b
        rows.append((i, " ".join(words), 1, int(a == b)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = toxicity.score_documents(frame.select("doc_id", "text"), frame.select("doc_id", "quality", "toxic")).where("held_out").toPandas()
    assert np.mean([rows[i][3] == p for i, p in zip(got["doc_id"], got["predicted"])]) > 0.95


def test_pair_index_bpe(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = run(spark, "op2_pair_index_bpe").set_index("doc_id")
    for i, text in zip(docs["doc_id"], docs["text"]):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(got.loc[i, ["n_tokens", "ids_sha256", "decoded_sha256"]]) == want


@pytest.mark.parametrize("seed", range(3))
def test_encoders_on_random_texts(seed):
    rng = np.random.default_rng(seed)
    texts = ["".join(rng.choice(list(" \n'stréAΣ1!|\x1c\u3000"), rng.integers(1, 50))) for _ in range(1500)] + ["aaaa aaa", "x<|endoftext|> y", "it's 'll", "  a   b \n c"]
    word = bpe.PairIndexBPE(public_tokenizers.path("word_bpe_49k.json"))
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert list(word.encode_many(texts)) == [u32(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    byte = tokens.byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [byte.encode(t) for t in texts] == [u32(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [r for r in url_rules.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.pattern), default=None)


def test_url_rules(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").toPandas()
    got = run(spark, "op3_association_url_rules").set_index("page_id")
    for i, url in zip(pages["page_id"], pages["url"]):
        host, path, rule = judged(url)
        assert (got.loc[i, "host"], got.loc[i, "path"]) == (host, path)
        assert (got.loc[i, "rule"], got.loc[i, "verdict"]) == (rule.pattern, rule.action) if rule else got.loc[i, "verdict"] in ("allow", "block")


def test_mined_rules_match_by_all_their_tokens(spark):
    rows = [(["host:spam", "path:en"], True)] * 30 + [(["host:spam", "path:fr"], False)] * 30 + [(["host:good", "path:en"], False)] * 40
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    rules = url_rules.mine_rules(labelled)
    assert [sorted(r.antecedent) for r in rules.collect()] == [[["host:spam"], ["path:en"]]]
    urls = spark.createDataFrame([(1, ["host:spam", "path:en", "x"]), (2, ["host:spam"]), (3, ["path:en"])], "row long, tokens array<string>")
    assert [r.row for r in url_rules.match_rules(urls, rules).collect()] == [1]


def mined(baskets, least_rows, least_confidence):
    """Rules by trying all token combinations, level by level; without those that a shorter one makes needless."""
    level, rules = {frozenset([t]) for b, _ in baskets for t in b}, {}
    while level:
        often = {}
        for c in level:
            bad = [k for b, k in baskets if c <= b]
            if sum(bad) >= least_rows:
                often[c] = sum(bad) / len(bad)
        rules |= {c: p for c, p in often.items() if p >= least_confidence}
        level = {a | b for a in often for b in often if len(a | b) == len(a) + 1}
    return {c: p for c, p in rules.items() if not any(rules.get(c - {t}, -1) >= p for t in c)}


def test_mined_rules_and_verdicts_on_the_pages(spark):
    """Labels that depend on the URL: the test tables' own don't."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = pages.toPandas()
    bad = rows["url"].str.contains("utm_source") & rows["url"].str.contains("/(?:en|fr)/") | rows["url"].str.contains("//m[.].*[.]com/")
    bad ^= rows["page_id"] % 17 == 0
    labels = spark.createDataFrame([(int(i), int(not b), 0) for i, b in zip(rows["page_id"], bad)], "doc_id long, quality int, toxic int")
    url = F.col("url")
    tokens_of = pages.select("page_id", url_rules.url_tokens(url, url_rules.host_of(url), url_rules.path_of(url)).alias("t")).toPandas().set_index("page_id")["t"]
    baskets = [(frozenset(tokens_of[i]), bool(b)) for i, b in zip(rows["page_id"], bad)]
    want = mined(baskets, 20, 0.7)
    found = url_rules.mine_rules(spark.createDataFrame([(sorted(t), b) for t, b in baskets], "tokens array<string>, bad boolean")).collect()
    assert spelt_out(found) == {c: round(p, 9) for c, p in want.items()} and len(want) >= 2
    got = url_rules.judge_pages(pages, labels).toPandas().set_index("page_id")
    blocked = 0
    for i, u in zip(rows["page_id"], rows["url"]):
        rule = judged(u)[2]
        verdict = rule.action if rule else "block" if any(c <= set(tokens_of[i]) for c in want) else "allow"
        blocked += rule is None and verdict == "block"
        assert got.loc[i, "verdict"] == verdict
    assert blocked >= 10


def canonical(text):
    nfkc = lambda s: unicodedata.normalize("NFKC", s)
    return re.sub(r"[\s\x85]+", " ", nfkc(nfkc(text).casefold())).strip(" ")


def spelt_out(found):
    """Mined rules as sets of tokens: one of each class, in all ways."""
    return {frozenset(t): round(r.confidence, 9) for r in found for t in itertools.product(*r.antecedent)}


def test_no_mined_rule_is_lost_to_redundant_ones(spark):
    long = [f"t{k}" for k in range(14)]  # 2^14 - 1 combinations of confidence 1
    rows = [(long, True)] * 30 + [(["weak"], True)] * 30 + [(["weak"], False)] * 10 + [(["fine"], False)] * 30
    found = url_rules.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert spelt_out(found) == {frozenset(["weak"]): 0.75} | {frozenset([t]): 1.0 for t in long}


def test_templates_of_many_tokens_are_mined_in_seconds(spark):
    """40 tokens of one template that good rows partly share: what rows can't tell apart is one item."""
    long, began = [f"t{k:02d}" for k in range(40)], time.perf_counter()
    rows = [(long, True)] * 30 + [(long[:20], False)] * 40 + [(long[20:] + ["x"], True)] * 5 + [(["fine"], False)] * 30
    found = url_rules.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    want = {frozenset([t]): 1.0 for t in long[20:]}  # with one of the first 20 it would match less at the same confidence
    assert spelt_out(found.collect()) == want and found.count() == 1 and time.perf_counter() - began < 60
    urls = spark.createDataFrame([(1, long[:20]), (2, ["t33"]), (3, ["y"]), (4, long)], "row long, tokens array<string>")
    assert sorted(r.row for r in url_rules.match_rules(urls, found).collect()) == [2, 4]


def test_mining_small_baskets_against_all_combinations(spark):
    rng = np.random.default_rng(6)
    for trial in range(3):
        baskets = [(frozenset(f"t{k}" for k in range(7) if rng.random() < (0.7 if k < 4 else 0.3)) | ({"a", "b"} if rng.random() < 0.5 else set()), False) for _ in range(150)]
        baskets = [(b, bool(("t1" in b and "t4" in b) ^ (rng.random() < 0.1))) for b, _ in baskets]
        found = url_rules.mine_rules(spark.createDataFrame([(sorted(b), k) for b, k in baskets], "tokens array<string>, bad boolean"), min_rows=8, min_confidence=0.5)
        assert spelt_out(found.collect()) == {c: round(p, 9) for c, p in mined(baskets, 8, 0.5).items()}


def test_fingerprints(spark, docs):
    got = run(spark, "op4_fingerprints").set_index("doc_id")
    down = docs[::-1]
    ids, texts = down["doc_id"].tolist(), down["text"].fillna("").tolist()
    seen: dict[str, str] = {}
    for k, i in enumerate(ids):
        text, follow = texts[k], texts[(k + 1) % len(texts)]
        n = len(text) // 3
        edited = text[: len(text) - n] + follow[:n]
        row = got.loc[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row["near_edited"], row["near_next"]) == (float(canonical(text) == canonical(edited)), float(canonical(text) == canonical(follow)))
        for t, f in ((text, row["fingerprint"]), (edited, row["edited_fingerprint"])):
            assert seen.setdefault(canonical(t), f) == f
    assert len(set(seen.values())) == len(seen)


def test_packing(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = run(spark, "op5_best_fit_packing")
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in zip(docs["doc_id"], docs["text"])}
    assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got.itertuples())
    for i, pieces in got.sort_values("piece").groupby("doc_id"):
        assert pieces["length"].tolist()[1:] == [1024] * (len(pieces) - 1) and pieces["start"].tolist() == [0, *np.cumsum(pieces["length"])[:-1].tolist()]
        assert pieces["length"].sum() == len(ids[i])
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1].tolist()] and s["length"].sum() <= 1024
    assert got["sequence_id"].nunique() <= 1.02 * -(-got["length"].sum() // 1024) + 1


@pytest.mark.parametrize("low,high", [(51, 60), (1, 3), (95, 97)])
def test_packing_ends_where_nothing_fits_together(spark, low, high):
    sizes = np.random.default_rng(3).integers(low, high, 3000)
    items = spark.createDataFrame([(k, int(s)) for k, s in enumerate(sizes)], "id long, length long")
    got = packing.pack(items, 100, group_items=100).toPandas()
    assert sorted(got["id"]) == list(range(3000)) and got.groupby("sequence_id")["length"].sum().max() <= 100
    assert got["sequence_id"].nunique() <= (3000 if low > 50 else 1.01 * sizes.sum() / 100 + 1)


def test_packing_rounds_lose_nothing(spark):
    sizes = np.random.default_rng(2).integers(1, 101, 3000)
    items = spark.createDataFrame([(k, int(s)) for k, s in enumerate(sizes)], "id long, length long")
    got = packing.pack(items, 100, group_items=200, fan_in=3).toPandas()
    assert sorted(got["id"]) == list(range(3000))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1].tolist()] and s["length"].sum() <= 100
    assert got["sequence_id"].nunique() < 1.04 * sizes.sum() / 100
    with pytest.raises(ValueError, match="no length"):
        packing.pack(items.withColumn("length", F.lit(101)), 100)


def test_best_fit_takes_the_tightest():
    bins, offsets, left = packing.best_fit(np.array([60, 50, 40, 50]), 100)
    assert left.tolist() == [0, 0] and bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 60, 50]


def test_token_store(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    store = token_store.write_store(table, run_documents=50)
    got = token_store.read_checksums(spark, store).toPandas().sort_values("doc_id")
    whole = token_store.restore(spark, store).toPandas().set_index("doc_id")
    start = 0
    for r, text in zip(got.itertuples(), docs["text"]):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        assert np.frombuffer(whole.loc[r.doc_id, "ids"], "<u2").tolist() == ids.tolist()
        start += len(ids)
    addresses = [r[0] for r in spark.read.parquet(f"{store}/chunks").select(F.hex("address")).collect()]
    assert len(addresses) == len(set(addresses))
    broken = spark.read.parquet(f"{store}/chunks").withColumn("ids", F.concat("ids", F.lit(b"\x01\x00")))
    other = f"{store}_broken"
    broken.write.parquet(f"{other}/chunks")
    for part in ("recipes", "manifest"):
        spark.read.parquet(f"{store}/{part}").write.parquet(f"{other}/{part}")
    with pytest.raises(Exception, match="damaged"):
        token_store.restore(spark, other).collect()
    with pytest.raises(Exception, match="damaged"):
        token_store.read_checksums(spark, other).collect()


def test_token_store_manifest(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    store = token_store.write_store(table, run_documents=20)
    recipes, manifest = (spark.read.parquet(f"{store}/{p}") for p in ("recipes", "manifest"))
    token_store.verify_manifest(spark, store)
    one, two = [r.document for r in recipes.where("run = 1").orderBy("start").limit(2).collect()]
    starts = F.when(F.col("document") == one, F.lead("start").over(W.orderBy("start"))).when(F.col("document") == two, F.lag("start").over(W.orderBy("start"))).otherwise(F.col("start"))
    broken = {
        "a lost recipe": (recipes.where(F.col("document") != one), manifest),
        "a repeated recipe": (recipes.union(recipes.where(F.col("document") == one)), manifest),
        "swapped starts": (recipes.withColumn("start", starts), manifest),
        "another id": (recipes.withColumn("doc_id", F.when(F.col("document") == one, 10**9).otherwise(F.col("doc_id"))), manifest),
        "a lost run": (recipes.where("run <> 1"), manifest),
        "a lost run on both sides": (recipes.where("run <> 1"), manifest.where("run <> 1")),
        "a changed root": (recipes, manifest.withColumn("root", F.when(F.col("run") == 1, F.lit(b"x" * 32)).otherwise(F.col("root")))),
        "no root": (recipes, manifest.where("run >= 0")),
    }
    for k, (r, m) in enumerate(broken.values()):
        r.write.parquet(f"{tmp_path}/{k}/recipes")
        m.write.parquet(f"{tmp_path}/{k}/manifest")
        with pytest.raises(ValueError):
            token_store.verify_manifest(spark, f"{tmp_path}/{k}")


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", " \t" * 5000 + "word" + "\u3000" * 9000 + "\x1c" * 9000 + " .", "\n" * 4096 + "x<|endoftext|>" + " " * 4100 + "<|endoftext|>"])
def test_long_runs_of_white_space(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert tokens.byte_encoder(path).encode(text) == u32(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_quality_rules(spark):
    con = oracle.connect(SF)
    assert oracle.difference(con, quality_rules.JUDGE_SQL, queries.QUERIES["op8_quality_rules"](spark, SF)) == ""


def test_rule_order_never_changes_the_verdict(spark):
    base = quality_rules.base_statistics(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    names = list(quality_rules.rules())
    verdicts = [sorted(map(tuple, base.select("doc_id", quality_rules.cascade(o).alias("k")).collect())) for o in (names, names[::-1])]
    assert verdicts[0] == verdicts[1]


def removed(docs):
    lines = [(i, k, frozenset(x.split())) for i, t in docs if t is not None for k, x in enumerate(t.split("\n")) if x.split()]
    first, gone = {}, set()
    for i, k, s in lines:
        if s in first:
            gone.add((i, k))
        first.setdefault(s, (i, k))
    sets, holders = list(first), defaultdict(list)
    for n, s in enumerate(sets):
        near = {m for w in s for m in holders[w] if 5 * len(s & sets[m]) >= 4 * len(s | sets[m])}
        if near:
            gone |= {(i, k) for i, k, x in lines if x == s}
        for w in s:
            holders[w].append(n)
    return gone


def test_line_dedup(spark, docs):
    got = run(spark, "op9_line_dedup")
    want = removed(list(zip(docs["doc_id"], docs["text"])))
    assert {(i, int(k)) for i, x in zip(got["doc_id"], got["removed"]) for k in x} == want
    texts = dict(zip(docs["doc_id"], docs["text"]))
    assert all("\n".join(x for k, x in enumerate(texts[i].split("\n")) if (i, k) not in want) == t for i, t in zip(got["doc_id"], got["text"]))


def test_line_dedup_on_many_near_lines(spark):
    rng = np.random.default_rng(4)
    base = [[f"w{int(x)}" for x in rng.integers(0, 60, rng.integers(5, 25))] for _ in range(30)]
    rows = []
    for i in range(150):
        words = list(base[i % 30])
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(0, len(words))] = f"w{int(rng.integers(0, 60))}"
        rows.append((i, " ".join(words) + "\nx y"))
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows)


def test_line_order_is_the_same_in_every_slice():
    h = np.array([5 << 40, 7 << 40, 9 << 40], np.uint64)
    counts = np.array([3 << 20, 2 << 20, 7], np.uint64)
    alone = line_dedup._line_order(h, counts)
    tie = np.array([1 << 50, (1 << 50) + 1], np.uint64)  # ties in the packed key
    both = line_dedup._line_order(np.append(h, tie), np.append(counts, np.uint64(1 << 32) | np.array([4, 4], np.uint64)))
    assert alone.tolist() == [2, 0, 1] and both.tolist() == [2, 0, 1, 3, 4]


def test_line_dedup_of_short_lines(spark):
    rows = [(1, "Read more\n\n\na b c d"), (2, "more Read\nRead less\n \na b c d e"), (3, "a b c\nRead more\nb a d c")]
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows) == {(2, 0), (2, 3), (3, 1), (3, 2)}


def test_line_dedup_in_a_large_group_of_near_lines(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 100)
    rng = np.random.default_rng(6)
    base, rows = [f"b{k}" for k in range(24)], []
    for i in range(700):  # near the group's first line, near another one alone, or just beyond
        words = list(base)
        for k in rng.permutation(24)[: rng.integers(0, 6)]:
            words[k] = f"v{int(rng.integers(0, 40))}"
        rows.append((int(i * 7919 % 701), " ".join(words)))
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(sorted(rows))


@pytest.mark.parametrize("block", [2048, 50])
def test_line_dedup_exchanges_few_rows(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = np.random.default_rng(9)
    lines = sorted({" ".join(f"w{int(x)}" for x in sorted(set(rng.integers(0, 90, 30)))) for _ in range(400)})
    texts = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").withColumn("hash", F.xxhash64("text")).repartition(4)
    sets = line_dedup.line_sets(texts, line_dedup.word_counts(texts)).withColumn("first", line_dedup._place())
    sets = line_dedup.stage(sets.withColumn("sid", F.col("doc_id")).withColumn("open", F.lit(False)), "sets")
    packed, buckets = line_dedup._packed_posts(sets)
    rows = packed.collect()
    posts = np.concatenate([np.frombuffer(r.posts, line_dedup.POST) for r in rows])
    prefixes = {r.sid: np.frombuffer(r.prefix, np.uint32) for r in sets.collect()}
    assert {i: len(x) for i, x in prefixes.items()} == {i: len(set(x.split())) // 5 + 1 for i, x in enumerate(lines)}
    holders = Counter(int(t) for x in prefixes.values() for t in x)
    blocks = {t: -(-n // block) if n > block else 1 for t, n in holders.items()}
    assert (max(blocks.values()) > 1) == (block == 50)
    assert Counter(posts["sid"].tolist()) == {i: sum(blocks[int(t)] for t in x) for i, x in prefixes.items()}
    assert all((line_dedup._bucket(np.frombuffer(r.posts, line_dedup.POST), buckets) == r.bucket).all() for r in rows)
    assert len(rows) < len(posts) / 100
    met = {m: set(posts["sid"][posts["meet"] == m].tolist()) for m in set(posts["meet"].tolist())}
    together = {(a, b) for x in met.values() for a in x for b in x}
    assert all((a, b) in together for a, x in prefixes.items() for b, y in prefixes.items() if np.intersect1d(x, y).size)


@pytest.mark.parametrize("space", ["\u00a0", "\u3000", "\u2009", "\x85", "\x1c"])
def test_line_dedup_has_one_white_space(spark, space):
    rows = [(1, space.join("one two three four five six seven eight nine".split())), (2, " ".join("one two three four five six seven eight ten".split())), (3, "one two three four" + space + "other words of their own")]
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, k) for r in got for k in r.removed} == removed(rows) == {(2, 0)}


def shingles(text):
    w = text.split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def components(docs):
    sets = {i: shingles(t or "") for i, t in docs}
    holders, root = defaultdict(list), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j in {j for x in s for j in holders[x]}:
            low = sum((s & sets[j]).values())
            if low >= 0.8 * (s.total() + sets[j].total() - low):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {i: find(i) for i in sets}


def test_near_duplicate_classes(spark, docs):
    got = run(spark, "op10_bagminhash_classes")
    assert dict(zip(got["doc_id"], got["class_id"])) == components(list(zip(docs["doc_id"], docs["text"])))


def test_near_duplicates_around_a_hub(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = np.random.default_rng(9)
    base = [f"w{int(x)}" for x in rng.integers(0, 5000, 200)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.integers(1, 7)):
            words[rng.integers(0, 200)] = f"v{int(rng.integers(0, 10**6))}"
        rows.append((i, " ".join(words)))
    rows += [(60, " ".join(base)), (61, " ".join(base)), (62, " ".join(base * 2)), (63, "short"), (64, "short ")]
    got = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == components(rows)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    base = [f"w{k}" for k in range(100)]
    near = [" ".join(base[:-1] + [x]) for x in ("x", "y", "z")]
    rows = [(5, near[0]), (7, near[1]), (None, near[2]), (3, "one of a kind"), (7, "another of a kind"), (3, "one of a kind")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in minhash.classes(frame).collect()) == Counter([(5, 5), (7, 5), (None, 5), (3, 3), (7, 7), (3, 3)])
    want = [(5, near[0]), (None, near[2]), (3, "one of a kind"), (7, "another of a kind")]
    assert Counter(tuple(r) for r in minhash.keep_first(frame).collect()) == Counter(want)


def test_every_class_keeps_a_row_whatever_its_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a, "p"), (7, a, "q"), (7, b, "r"), (7, b, "s"), (9, b + " more", "t"), (7, c, "u"), (2, "", "v"), (2, None, "w")]
    got = minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r.source for r in got) in (["p", "r", "u", "v"], ["p", "r", "u", "w"])


def test_signatures_are_unbiased():
    rng = np.random.default_rng(0)
    weights = [rng.integers(0, 6, 300) for _ in range(4)] + [rng.integers(0, 2, 300) * rng.integers(1, 40, 300)]
    h = np.concatenate([np.repeat(words.mix(np.arange(300, dtype=np.uint64)), w) for w in weights])
    sig = minhash.signatures(h, np.repeat(np.arange(5), [w.sum() for w in weights]), 5, 2048)
    for i, j in itertools.combinations(range(5), 2):
        exact = np.minimum(weights[i], weights[j]).sum() / np.maximum(weights[i], weights[j]).sum()
        assert abs((sig[i] == sig[j]).mean() - exact) < 0.05


def test_pipeline_stages(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    frame, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = frame
        step(spark, frame, SF).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert frame.columns == before.columns
        kept[name] = {r[0] for r in frame.select("doc_id").collect()}
        if name == "quality rules":
            con = oracle.connect(SF)
            con.execute(f"CREATE OR REPLACE VIEW documents AS FROM read_parquet('{tmp_path}/0/*.parquet')")
            assert kept[name] == {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality_rules.JUDGE_SQL}) WHERE kept").fetchall()}
        if name == "line dedup":
            rows = sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect())
            want = removed(rows)
            text = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want) for i, t in rows}
            assert {r.doc_id: r.text for r in frame.collect()} == text and all(r.n_chars == len(r.text) for r in frame.collect())
        if name == "near-dedup":
            cls = components(sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect()))
            assert kept[name] == {i for i, c in cls.items() if i == c}
        if name == "packing":
            assert kept[name] == {r[0] for r in before.select("doc_id").collect()}
    seen = [i for i in kept["toxicity"] if i in labels.index]
    assert labels.loc[seen, "toxic"].mean() < 0.5 * labels["toxic"].mean()  # a tiny table to learn from


def test_terms_of_plain_and_odd_pieces():
    """The short way for plain words gives the terms of the long one."""
    import zlib

    from gridflux.llm import toxicity

    for piece in ["Plain", "word,", "(Word)", "ab", "four.", "seven7letters", "na\u00efvet\u00e9", "STRASSE\u00df", "\u0130stanbul", "x\u00b2y", "a_b", "don't", "...", "", "\u05e9\u05dc\u05d5\u05dd!"]:
        words = [w for w in toxicity._WORD.findall(piece.lower())]
        want = {zlib.crc32(w.encode()) for w in words} | {zlib.crc32(w[:n].encode()) | n << 32 for w in words for n in (4, 5, 6) if len(w) >= n}
        assert toxicity.terms_of(piece) == want
    terms = {t: k for k, t in enumerate(sorted(toxicity.terms_of("abcdefg") | toxicity.terms_of("other")))}
    machine = toxicity.FactorizationMachine(terms, 0.0, np.zeros(len(terms)), np.zeros((len(terms), 1)))
    seen = {}
    assert machine.places(seen, "abcdefg, abcdef other Abcdefg").tolist() == list(range(len(terms)))
    assert machine.places(seen, "").tolist() == machine.places(seen, "zzz").tolist() == []
