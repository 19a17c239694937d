"""URL filters: a curated list of host and path rules, and mined association rules for the rest.

A curated rule fits its host and all subdomains where the path starts with the rule's; the longest
wins. URLs that none fits are judged by rules that FP-growth mines from labelled URLs: combinations
of URL tokens that lead to a bad label with enough support and confidence. They are matched through
an inverted index from token to rules.

No table labels URLs; a page takes the label of the document with its id. Where those don't depend on the
URL, as in the test tables, no combination reaches the confidence, no rule is mined and the list alone decides.

Defined results. Null URL or one without ``://``: host and path empty, no rule. No labels, or no
rule with enough confidence: such URLs are allowed. Repeated rows are judged each; an empty table
gives an empty result. Columns other than the id and the URL are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import small, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    pattern: str  # host, then the path's start from its first slash on

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


#: The list of the query (fixed values).
RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def curated(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits as struct(size, pattern, action), or null. The list is a short parameter."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(len(r.pattern)).alias("size"), F.lit(r.pattern).alias("pattern"), F.lit(r.action).alias("action")))
        for r in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,pattern:string,action:string>")


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Different tokens: labels of the host, words of the path with digits folded, names of the query."""
    plain = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(plain, r"(?s)\?([^#]*)", 1)

    def some(words: Column, kind: str) -> Column:
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(kind), w))

    steps = F.split(F.regexp_replace(path, r"[0-9]+", "0"), r"[/.]")
    names = F.transform(F.split(query, "&"), lambda w: F.regexp_extract(w, r"^[^=]*", 0))
    scheme = F.array(F.concat(F.lit("scheme:"), F.regexp_extract(plain, r"(?s)^(.*?)://", 1)))
    return F.array_distinct(F.concat(scheme, some(F.split(host, r"\."), "host:"), some(steps, "path:"), some(names, "query:")))


def token_classes(tokens: DataFrame, least: int) -> DataFrame:
    """token, class: tokens of ``least`` bad rows or more; those that stand in the very same labelled rows share a
    class, named after its first token. Row sets are compared by their sizes and 128 bits of hashes.

    ``tokens``: row, token, bad, each token of a row once.
    """
    row = F.struct("row", F.lit("second"))
    sets = tokens.groupBy("token").agg(F.count_if("bad").alias("n_bad"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64(row)).alias("b"))
    same = sets.where(F.col("n_bad") >= least).groupBy("n_bad", "n", "a", "b").agg(F.collect_list("token").alias("tokens"))
    return same.select(F.array_min("tokens").alias("class"), F.explode("tokens").alias("token"))


def mine_rules(labelled: DataFrame, min_support: float = 0.005, min_rows: int = 20, min_confidence: float = 0.7) -> DataFrame:
    """Token combinations that lead to a bad label: antecedent, confidence, support. An antecedent is an array
    of classes, each an array of tokens of which a page needs one: tokens that the labelled rows can't
    tell apart give rules of the same confidence, so they are mined as one item.

    ``labelled``: tokens array<string>, bad boolean. A combination needs ``min_support`` of the rows and
    ``min_rows`` of them, all bad. FP-growth runs over the bad rows alone; the good rows that hold a
    combination are counted afterwards, through its class that the fewest of them hold. A rule goes if it
    has at most the confidence of one that lacks one of its classes: what it matches that one matches too,
    or a shorter one that made that go. All others stay.
    """
    spark = labelled.sparkSession
    rows = stage(labelled.select(F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad")), "labelled")
    n, n_bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    least = max(math.ceil(min_support * n), min_rows, 1)
    if n_bad < least:
        return spark.createDataFrame([], "antecedent array<array<string>>, confidence double, support double")
    tokens = rows.select("row", "bad", F.explode("tokens").alias("token"))
    classes = stage(token_classes(tokens, least), "token_classes")
    held = tokens.join(small(classes), "token").select("row", "bad", "class").distinct()
    baskets = stage(held.groupBy("row", "bad").agg(F.collect_set("class").alias("items")), "baskets")
    frequent = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n_bad)).fit(baskets.where("bad").select("items")).freqItemsets
    common = baskets.where("not bad").select(F.explode("items").alias("rarest")).groupBy("rarest").agg(F.count("*").alias("n_good"))
    frequent = stage(frequent.select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_bad")), "frequent")
    first = frequent.select("antecedent", F.explode("antecedent").alias("rarest")).join(small(common), "rarest", "left")
    first = first.groupBy("antecedent").agg(F.min(F.struct(F.coalesce("n_good", F.lit(0)).alias("n"), "rarest")).alias("r")).select("antecedent", "r.rarest")
    good = baskets.where("not bad").select("items", F.explode("items").alias("rarest")).join(small(first), "rarest")
    good = good.where(F.size(F.array_except("antecedent", "items")) == 0).groupBy("antecedent").agg(F.count("*").alias("n_good"))
    confidence = F.col("n_bad") / (F.col("n_bad") + F.coalesce("n_good", F.lit(0)))
    rules = frequent.join(good, "antecedent", "left").select("antecedent", confidence.alias("confidence"), (F.col("n_bad") / n).alias("support"))
    rules = stage(rules.where(F.col("confidence") >= min_confidence), "all_rules")
    shorter = rules.where(F.size("antecedent") > 1).select("antecedent", "confidence", F.explode(F.transform("antecedent", lambda t: F.array_remove("antecedent", t))).alias("part"))
    parts = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("known"))
    needless = shorter.join(parts, "part").where("known >= confidence").select("antecedent").distinct()
    members = classes.groupBy("class").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    kept = rules.join(needless, "antecedent", "left_anti").withColumn("class", F.explode("antecedent")).join(small(members), "class")
    kept = kept.groupBy("antecedent", "confidence", "support").agg(F.array_sort(F.collect_list("tokens")).alias("alternatives"))
    return kept.select(F.col("alternatives").alias("antecedent"), "confidence", "support")


def match_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (row, tokens) that hold a token of each class of a rule: row, confidence of the best rule."""
    index = stage(rules.withColumn("rule", F.monotonically_increasing_id()), "rules")
    postings = index.select("rule", "confidence", F.size("antecedent").alias("needs"), F.posexplode("antecedent").alias("place", "any"))
    postings = postings.select("rule", "confidence", "needs", "place", F.explode("any").alias("token"))
    hits = rows.select("row", F.explode("tokens").alias("token")).join(small(postings), "token")
    whole = hits.groupBy("row", "rule").agg(F.count_distinct("place").alias("n"), F.first("needs").alias("needs"), F.first("confidence").alias("confidence")).where("n = needs")
    return whole.groupBy("row").agg(F.max("confidence").alias("confidence"))


def judge_pages(pages: DataFrame, labels: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each page; labels are those of the document with the
    page's id, bad where its quality is 0 or it is toxic."""
    url = F.col("url")
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    fit = curated(F.col("host"), F.col("path"), rules)
    rows = stage(rows.select("row", "page_id", "host", "path", fit["pattern"].alias("rule"), fit["action"].alias("action"), url_tokens(url, F.col("host"), F.col("path")).alias("tokens")), "urls")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False))) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    # both sides grow with the input, and the planner takes a staged table's compressed size for its size
    found = stage(mine_rules(rows.join(known.hint("merge"), "page_id").select("tokens", "bad")), "mined")
    if found.isEmpty():
        verdict = rows.withColumn("verdict", F.coalesce("action", F.lit("allow")))
    else:
        matched = match_rules(rows.where("action IS NULL"), found)
        verdict = rows.join(matched.hint("merge"), "row", "left").withColumn("verdict", F.coalesce("action", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")))
    return verdict.select("page_id", "host", "path", "rule", "verdict")
