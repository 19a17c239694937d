"""Canonical exact fingerprints, in DataFrame and SQL functions only.

Canonical form: NFKC, full case folding, NFKC again, each run of white space one blank, none at the
ends. Its fingerprint is two 64-bit xxhashes with different seeds. Texts that share one are compared
byte by byte; should two canonical forms differ, their fingerprints get the SHA-512 as well, so
fingerprints are equal exactly where canonical forms are. Likeness is 1 for equal forms, else 0.

Defined results. Null counts as the empty text, whose form is empty. Documents with equal ids are
separate rows, ordered by their text; null ids come after all others. An empty table gives an empty
result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridflux.llm.common import stage, text_of

MAX_BROADCAST_ROWS = 200_000
LOWEST = -(2**63)


def canonical(text: Column) -> Column:
    def compose(c: Column) -> Column:
        return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))

    folded = F.java_method(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(text), F.lit(True))
    return F.btrim(F.regexp_replace(compose(folded), r"[\s\p{Z}\x85]+", " "))


def wide_hash(form: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(form)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), form)), 16, "0")))


def differing_hashes(texts: DataFrame, hashes: DataFrame) -> list[str]:
    """Wide hashes that stand for more than one canonical form among ``texts`` (text).

    ``hashes`` has the column ``fingerprint``, a row for each text. Only texts whose hash occurs
    again are compared, and of equal ones each task sends on one. The answer is empty unless 128
    bits collide.
    """
    again = stage(hashes.groupBy("fingerprint").count().where("count > 1").select("fingerprint"), "again")
    side = F.broadcast(again) if again.count() <= MAX_BROADCAST_ROWS else again
    forms = texts.select(canonical(F.col("text")).alias("form")).withColumn("fingerprint", wide_hash(F.col("form")))
    spread = forms.join(side, "fingerprint", "left_semi").groupBy("fingerprint").agg(F.min("form").alias("low"), F.max("form").alias("high"))
    return sorted(r[0] for r in spread.where("low <> high").select("fingerprint").collect())


def _fingerprint(form: Column, differing: list[str]) -> Column:
    wide = wide_hash(form)
    return F.when(wide.isin(differing), F.concat(wide, F.lit("-"), F.sha2(form, 512))).otherwise(wide) if differing else wide


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each document."""
    texts = docs.select("doc_id", text_of("text").alias("text"))
    hashes = stage(texts.select("doc_id", canonical(F.col("text")).alias("form")).select("doc_id", wide_hash(F.col("form")).alias("fingerprint")), "hashes")
    differing = differing_hashes(texts, hashes)
    if not differing:
        return hashes
    return texts.select("doc_id", canonical(F.col("text")).alias("form")).select("doc_id", _fingerprint(F.col("form"), differing).alias("fingerprint"))


def with_next(docs: DataFrame, differing: list[str], bucket_rows: int = 1500) -> DataFrame:
    """doc_id, text, fingerprint, and the text and fingerprint of the next document in descending
    doc_id order (after the last: the first).

    Ids are cut into ranges of about equally many rows, each range evenly into buckets. A bucket
    also gets the head of the bucket below it, so one exchange brings each text to its neighbour.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("at"), text_of("text").alias("text"))
    n = rows.count()
    buckets = max(1, n // bucket_rows)
    ranges = min(buckets, 200)
    ends = rows.agg(F.percentile_approx("at", [k / ranges for k in range(ranges + 1)], 10_000)).first()[0] or [0]
    ends = sorted(set(ends))
    deep = max(1, buckets // ranges)
    at = F.col("at")
    place = F.greatest(F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= at)), F.lit(1))
    low = F.element_at(F.array(*map(F.lit, ends)), place).cast("double")
    high = F.element_at(F.array(*map(F.lit, [*ends[1:], ends[-1] + 1 if ends[-1] < 2**63 - 1 else ends[-1]])), place).cast("double")
    inner = F.least(F.greatest(F.floor((at.cast("double") - low) * deep / F.greatest(high - low, F.lit(1.0))), F.lit(0)), F.lit(deep - 1))
    bucket = ((place - 1) * deep + inner).cast("long") if deep > 1 else place.cast("long")
    rows = rows.withColumn("bucket", bucket)

    heads = rows.groupBy("bucket").agg(F.max("at").alias("head"))
    order = Window.orderBy("bucket")
    last = F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = stage(heads.select(F.col("head").alias("at"), F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(order)).alias("also"), last.alias("last")).drop("last"), "heads")
    rows = rows.join(F.broadcast(heads) if heads.count() <= MAX_BROADCAST_ROWS else heads, "at", "left")
    rows = rows.select("doc_id", "at", "text", canonical(F.col("text")).alias("form"), "bucket", "also")
    rows = rows.select("doc_id", "at", "text", _fingerprint(F.col("form"), differing).alias("fingerprint"), "bucket", "also")
    copies = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copy")), F.struct(F.col("also").alias("bucket"), F.lit(1).alias("copy")))
    rows = rows.select("doc_id", "at", "text", "fingerprint", F.explode(F.filter(copies, lambda c: c["bucket"].isNotNull())).alias("c")).select("*", "c.*").drop("c")
    down = Window.partitionBy("bucket").orderBy("copy", F.desc("at"), "fingerprint", "text")
    rows = rows.withColumns({"next_text": F.lead("text").over(down), "next_fingerprint": F.lead("fingerprint").over(down)})
    return rows.where("copy = 0").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    Edited text: the last floor(n_chars / 3) code points give way to as many of the next document's
    first (or all).
    """
    texts = docs.select(text_of("text").alias("text"))

    def rows(differing: list[str]) -> DataFrame:
        n = F.length("text")
        third = F.floor(n / 3).cast("int")
        df = with_next(docs, differing).select("*", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"))
        df = df.withColumn("edited_form", canonical(F.col("edited")))
        df = df.withColumn("edited_fingerprint", _fingerprint(F.col("edited_form"), differing))
        form = canonical(F.col("text"))
        return df.select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "fingerprint",
            "edited_fingerprint",
            F.when(F.col("fingerprint") == F.col("edited_fingerprint"), (form == F.col("edited_form")).cast("double")).otherwise(0.0).alias("near_edited"),
            F.when(F.col("fingerprint") == F.col("next_fingerprint"), (form == canonical(F.col("next_text"))).cast("double")).otherwise(0.0).alias("near_next"),
        )

    result = stage(rows([]), "fingerprints")
    differing = differing_hashes(texts, result.select("fingerprint"))
    return rows(differing) if differing else result
