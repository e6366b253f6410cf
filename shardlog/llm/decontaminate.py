"""Benchmark decontamination with DataFrame functions only.

A window is ``n`` consecutive words of a benchmark item (the whole item if it is shorter). Every window is keyed by one of its words,
the longest (ties: the greatest), which is rarely a common one; the keyed windows are the hash set. It is counted first, and broadcast
in blocks of about ``most`` windows (default 1,000,000; benchmarks are rarely more than one block). For each block, one scan of the
documents explodes each text's words, looks them up, and verifies each hit by comparing the document's words around it with the
window's, word by word. Only verified hits, and one marker row per document that carries its word count, are shuffled; texts never are.

Words are found in Spark's lower-cased text (with one form of sigma, since lower-casing picks it by the letters around), and a hit is
verified with A-Z lower-cased only, so other capitals stay distinct.

Edge cases: null or empty texts have no words; an item without words has no windows; a null item id counts as an item but is left out
of ids; rows that share an id and a text get the same result each, rows that share an id only are judged each on its own text; other
columns are neither read nor kept (``clean`` keeps them). Empty tables give empty or uncontaminated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch

#: Fixed value: what separates words.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts whose A-Z are not yet lower-cased.
NOT_WORD_AS_IS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BIG, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: No word is empty, so the empty string marks the row that every document has.
_MARK = ""


def words(text: Column, between: str = NOT_WORD) -> Column:
    return F.array_remove(F.split(text, between), "")  # no lambda, so that the join above it is compiled


def _low(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("\u03c2"), F.lit("\u03c3"))


def windows(items: DataFrame, n: int) -> DataFrame:
    """item_id, gram: every window of every item, distinct; words with A-Z lower-cased."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.translate("text", _BIG, _SMALL)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    return w.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at") + 1, n).alias("gram")).distinct()


def keyed(grams: DataFrame) -> DataFrame:
    """key, back (words before the key), gram, items: one row per distinct window."""
    lower = F.transform("gram", _low)
    longest = F.array_max(F.transform(lower, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    one = grams.groupBy("gram").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max(F.col("item_id").isNull()).alias("unnamed"))
    return one.select(longest.alias("key"), (F.array_position(lower, longest) - 1).cast("int").alias("back"), "gram", lower.alias("low"), "items", "unnamed")


def _verified(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, fp, n_words, hit, items, unnamed, mark: the marks, and the words whose surroundings equal a window."""
    met = rows.join(grams, rows["word"] == grams["key"])
    start = F.col("at") - 1 - F.col("back")  # the mark is at 0, words are from 1
    size = F.size("low")
    inside = F.col("low").isNotNull() & (start >= 0) & (start + size <= F.col("n_words"))
    alike = F.when(inside, F.slice("w", F.when(inside, start + 1).otherwise(1), size) == F.col("low")).otherwise(False)
    exact = F.translate(F.array_join(F.slice(words(F.col("text"), NOT_WORD_AS_IS), start + 1, size), " "), _BIG, _SMALL) == F.array_join("gram", " ")
    real = F.when(alike, exact).otherwise(False)  # the cheap comparison first; few rows get to the other
    return met.where((F.col("key") == _MARK) | real).select("doc_id", "fp", "n_words", F.when(F.col("low").isNotNull(), F.sequence(start, start + size - 1)).alias("hit"), "items", "unnamed", (F.col("key") == _MARK).cast("long").alias("mark"))


def hits(docs: DataFrame, items: DataFrame, n: int = 10, most: int = 1_000_000) -> DataFrame:
    """doc_id, fp (hash of the text), copies, n_words, n_hit, hit (word positions), items: one row per distinct (doc_id, text)."""
    spark = docs.sparkSession
    grams = keyed(windows(items, n))
    mark = spark.range(1).select(F.lit(_MARK).alias("key"), F.lit(0).alias("back"), F.lit(None).cast("array<string>").alias("gram"), F.lit(None).cast("array<string>").alias("low"), F.lit(None).cast("array<string>").alias("items"), F.lit(False).alias("unnamed"))
    blocks = max(1, -(-grams.count() // most))
    d = docs.select("doc_id", F.xxhash64("text").alias("fp"), "text", words(_low(F.col("text"))).alias("w")).select("doc_id", "fp", "text", F.coalesce("w", F.array().cast("array<string>")).alias("w"))
    rows = d.select("doc_id", "fp", "text", "w", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(_MARK)), "w")).alias("at", "word"))
    met = None
    for i in range(blocks):
        some = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == i)
        found = _verified(rows, F.broadcast(some if i else some.unionByName(mark)))
        met = found if met is None else met.unionByName(found)
    done = met.groupBy("doc_id", "fp", "n_words").agg(F.sum("mark").alias("copies"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("hit")))).alias("hit"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.max("unnamed").alias("unnamed"))
    return done.withColumn("n_hit", F.size("hit"))


def report(docs: DataFrame, items: DataFrame, n: int = 10, most: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of docs."""
    h = hits(docs, items, n, most)
    each = h.select("*", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return each.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, n: int = 10, most: int = 1_000_000) -> DataFrame:
    """The rows of docs, all columns as they are, in whose text no window occurs.

    What is hit is written first; up to ``most`` (id, text hash) pairs are broadcast, more are joined by shuffle.
    """
    h = Scratch(docs.sparkSession, "decontaminate").save(hits(docs, items, n, most).where("n_hit > 0").select(F.col("doc_id").alias("_hit_id"), F.col("fp").alias("_hit_fp")), "hits")
    if h.count() <= most:
        h = F.broadcast(h)
    return docs.join(h, F.col("doc_id").eqNullSafe(h["_hit_id"]) & (F.xxhash64("text") == h["_hit_fp"]), "left_anti")
