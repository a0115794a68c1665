"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Only DataFrame functions.  A test item is short and a document may be very long, so a sketch of the document would miss the item.  So the item is sketched:
its smallest shingle hashes, which is the MinHash order.  A document that contains ``percent`` of an item misses at most the
rest, so among (rest + 1) sketched shingles it has one.  Items are partitioned by size and each partition takes the sketch length that its largest
size needs: no pair is missed, and short items need few hashes.  Documents meet sketches by hash, and the pairs found are
counted on the real shingles.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.llm.common import BREAKS, store


def once(value) -> F.Column:
    """A generator of the one ``value``: what is built on it reads a column instead of working ``value`` out for every element."""
    return F.explode(F.array(value))


def lower_words(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; none for a null."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.filter(F.split(lowered, BREAKS), lambda w: w != ""), F.array().cast("array<string>"))


def _positions(words, size: int) -> F.Column:
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(1)))).otherwise(
        F.array().cast("array<int>"))


def shingle_hashes(words, size: int) -> F.Column:
    return F.transform(_positions(words, size), lambda i: F.xxhash64(F.slice(words, i, size)))


def shingles(words, size: int) -> F.Column:
    """Distinct word runs as text; fewer words than ``size`` make one run, none make none."""
    return F.array_distinct(F.transform(_positions(words, size), lambda i: F.array_join(F.slice(words, i, size), " ")))


def sketch_length(largest, percent: int) -> F.Column:
    """Hashes of which a document that contains ``percent`` of ``largest`` shingles has at least one."""
    return (largest - F.ceil(largest * percent / 100) + 1).cast("int")


def sketches(items: DataFrame, size: int, percent: int) -> DataFrame:
    """(item_id, words, partition, sketch): the smallest hashes of every item, as many as its size partition needs."""
    worded = items.select("item_id", once(lower_words(F.col("text"))).alias("words"))
    hashed = worded.select(
        "*", once(F.array_sort(F.array_distinct(shingle_hashes(F.col("words"), size)))).alias("hashes")).where(F.size("hashes") > 0)
    partition = F.floor(F.log2(F.size("hashes"))).cast("int")
    largest = F.pow(F.lit(2), F.col("partition") + 1) - 1
    return hashed.withColumn("partition", partition).select(
        "item_id", "words", "partition", F.slice("hashes", F.lit(1), sketch_length(largest, percent)).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): pairs with 100 * shared shingles >= percent * the item's shingles.

    Null or wordless texts and items are in no pair.  Rows without an id are left out.  A repeated doc_id or item_id stands for its text that
    shares most.  Empty tables give no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id IS NOT NULL")
    sketched = store(sketches(items, size, percent), "sketches")
    probes = sketched.select("item_id", F.explode("sketch").alias("hash"))
    hashes = docs.select("doc_id", once(lower_words(F.col("text"))).alias("words")).select(
        "doc_id", F.explode(shingle_hashes(F.col("words"), size)).alias("hash"))
    found = store(hashes.join(probes, "hash").select("doc_id", "item_id").distinct(), "found")

    wanted = store(found.select("doc_id").distinct(), "wanted")
    texts = (docs.join(wanted, "doc_id", "left_semi").select("doc_id", once(lower_words(F.col("text"))).alias("words"))
             .select("doc_id", once(shingles(F.col("words"), size)).alias("has")))
    asked = sketched.select("item_id", once(shingles(F.col("words"), size)).alias("asks"))
    shared = F.size(F.array_intersect("asks", "has"))
    return (found.join(texts, "doc_id").join(asked, "item_id")
            .select("doc_id", "item_id", F.size("asks").cast("long").alias("n_item"), once(shared.cast("long")).alias("n_shared"))
            .where(100 * F.col("n_shared") >= percent * F.col("n_item"))
            .groupBy("doc_id", "item_id")
            .agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("best"))
            .select("doc_id", "item_id", F.col("best.n_item").alias("n_item"), F.col("best.n_shared").alias("n_shared"),
                    (F.col("best.n_shared") / F.col("best.n_item")).alias("containment")))
