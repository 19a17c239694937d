"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A sample of the rows gives each rule's cost (seconds) and selectivity (share of rows it rejects).
The rules then stand in the order of rejection per cost in one CASE expression, so a row that an
early rule rejects costs no later rule. The order changes the time, never the verdict.

Defined results. Null or empty text: no words, so the base rules reject it. Equal rows get equal
results; an empty table gives an empty result. Columns of the input are kept by ``filter_documents``
and their names never clash with the statistics, which stand in a struct of their own.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import stage, text_of

#: Characters that end a word (fixed values: blank and U+0009 to U+000D).
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _between(array: str, first: int, less: int) -> Column:
    """The array's items from ``first`` (1-based) on, without ``less`` items in all."""
    return F.slice(array, first, F.greatest(F.size(array) - less, F.lit(0)))


def base_statistics(texts: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to a table with the string
    column ``text``, besides ``words`` and ``n_lines``.

    Words in a repeated window are found by sorting the windows' 64-bit hashes with their places; a
    row without two equal hashes skips the sort.
    """
    blank = F.lit(BLANKS)
    bare = F.btrim("text", blank)
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, blank) != "")
    df = texts.withColumn("words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")))
    df = df.withColumn("lines", lines).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    pair = F.zip_with(_between("hashes", 1, 2), _between("hashes", 2, 2), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("windows", F.zip_with(pair, _between("hashes", 3, 2), lambda a, b: F.xxhash64(a, b)))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(none))
    met = F.zip_with(_between("sorted", 1, 1), _between("sorted", 2, 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("places", F.sort_array(F.array_distinct(F.flatten(met))))
    steps = F.zip_with(_between("places", 1, 1), _between("places", 2, 1), lambda a, b: F.least(b - a, F.lit(3)))
    repeated = F.when(F.size("places") == 0, 0).otherwise(F.aggregate(steps, F.lit(3), lambda s, x: s + x))
    return df.select(
        *texts.columns,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _count(pattern: str) -> Column:
    """Characters of the text that the (negated) class lets stand."""
    return F.length(F.regexp_replace("text", pattern, ""))


def rules() -> dict[str, Column]:
    """Name and condition under which a rule rejects a row of ``base_statistics``."""
    n = F.col("n_words")
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "duplicate_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 25 * n),
        "shouting": _count(r"[^!?]+") * 10 > 3 * n,
        "capitals": _count(r"[^\p{Lu}]+") > _count(r"[^\p{Ll}]+"),
        "digits": 4 * _count(r"[^0-9]+") > F.col("word_chars"),
        "few_words": 20 * F.size(F.array_distinct("words")) < n,
    }


def order_rules(texts: DataFrame, sample_rows: int = 1000) -> list[tuple[str, float, float]]:
    """Rules by rejection per cost, measured on about ``sample_rows`` rows: name, share rejected, seconds.

    One job counts the rejections of all rules. A rule's cost is the time of a job that tries it on each
    row less that of a job without a rule over the same columns, each the lesser of two tries, so what a
    job costs in itself stands in neither; less than a millisecond counts as one. The sample is spread
    evenly by a hash of the text; it sets the order only.
    """
    keep = max(1, texts.count() // sample_rows)
    sample = stage(base_statistics(texts.where(F.pmod(F.xxhash64("text"), F.lit(keep)) == 0)), "sample").where(~base_failed())
    tried = rules()
    n, *hits = sample.agg(F.count("*"), *[F.count_if(c) for c in tried.values()]).first()
    whole = [F.octet_length("text"), F.size("words"), *map(F.col, ("word_chars", "n_symbols", "n_lines", "n_dup_lines"))]

    def seconds(rejects: Column) -> float:
        def once() -> float:
            began = time.perf_counter()
            sample.agg(F.count_if(rejects), *map(F.max, whole)).first()
            return time.perf_counter() - began

        return min(once(), once())

    idle = seconds(F.lit(False))
    measured = [(name, hit / n if n else 0.0, max(seconds(c) - idle, 1e-3)) for (name, c), hit in zip(tried.items(), hits)]
    return sorted(measured, key=lambda m: -m[1] / m[2])


def cascade(order: list[str]) -> Column:
    """True where no rule rejects; rules are tried in the given order until one does."""
    by_name = rules()
    rejected = F.when(by_name[order[0]], F.lit(order[0]))
    for name in order[1:]:
        rejected = rejected.when(by_name[name], F.lit(name))
    return rejected.isNull()


def judge_documents(docs: DataFrame, sample_rows: int = 1000) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept of each document."""
    texts = docs.select("doc_id", text_of("text").alias("text"))
    order = [name for name, _, _ in order_rules(texts, sample_rows)]
    df = base_statistics(texts).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(order))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def filter_documents(docs: DataFrame, sample_rows: int = 1000) -> DataFrame:
    """The documents that pass, with the columns they came with.

    A row number stands in the filter so that the optimizer doesn't copy the statistics into it.
    """
    row = docs.select(F.struct("*").alias("row"), text_of("text").alias("text"))
    order = [name for name, _, _ in order_rules(row.select("text"), sample_rows)]
    verdict = F.when(base_failed(), False).otherwise(cascade(order))
    judged = base_statistics(row).select("row", verdict.alias("kept"), F.monotonically_increasing_id().alias("number"))
    return judged.where(F.col("kept") & (F.col("number") >= 0)).select("row.*")


#: DuckDB SQL for ``judge_documents``.
JUDGE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
      FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT k, i, count(*) OVER (PARTITION BY k, t) AS n FROM g),
c AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM r WHERE n > 1) GROUP BY k),
s AS (SELECT doc_id, text, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines, len(list_distinct(ws)) AS n_distinct
      FROM w LEFT JOIN c USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR length(regexp_replace(text, '[^!?]+', '', 'g')) * 10 > 3 * n_words
            OR length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > length(regexp_replace(text, '[^\p{Ll}]+', '', 'g'))
            OR 4 * length(regexp_replace(text, '[^0-9]+', '', 'g')) > word_chars
            OR 20 * n_distinct < n_words) AS kept
FROM b
"""
