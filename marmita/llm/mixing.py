"""Mixing sources to target weights by entropy balancing.

Among all rates that give every source its target of words, take the one of least relative entropy to the corpus as it
is, each word weighing the same.  The dual of that problem is convex with one multiplier per source; its solution tilts the corpus exponentially:
a document's rate is exp(multiplier of its source).  Newton steps run on a table of sources, each an
aggregation.  Rates become whole copies by passing the rounding error from large documents on to small ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marmita.llm.common import n_words, runs, store

CAP = 3
ROUNDED_TOGETHER = 20_000
STEPS, TOLERANCE = 40, 1e-9


def targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs, target): shares of all words by weights 1, 2, 3, 1, ... over the sources in code-point
    order, null last; no target above ``cap`` times the source's words, the excess shared again by weight."""
    # One row per source from here on.
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    everything = Window.partitionBy(F.lit(0))
    weighed = (per_source
               .withColumn("position", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
               .withColumn("weight", 1 + (F.col("position") - 1) % 3)
               .withColumn("limit", cap * F.col("source_size"))
               .withColumn("ratio", F.col("limit") / F.col("weight")))
    # Capped sources are those of the smallest ratio: the level of the others rises as each is taken out.
    upto = everything.orderBy("ratio", "position").rowsBetween(Window.unboundedPreceding, -1)
    levelled = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(upto), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
    first_free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "position", "level"))).over(everything)
    level = first_free["level"]
    return levelled.select(
        "source", "source_size", "n_docs",
        F.least(F.col("limit").cast("double"), F.coalesce(level * F.col("weight"), F.col("limit").cast("double")))
        .alias("target"))


def balance(sources: DataFrame) -> DataFrame:
    """``sources`` with the rate of their documents: Newton's method on the dual, every multiplier in each step.

    The gradient for a source is its target less the words that its multiplier now yields, the Hessian those words; a step is
    kept within 1 so that a far start cannot overshoot.  Sources without words or target have rate 0.
    """
    now = sources.withColumn("multiplier", F.lit(0.0))
    for _ in range(STEPS):
        yields = F.col("source_size") * F.exp("multiplier")
        live = (F.col("source_size") > 0) & (F.col("target") > 0)
        step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("target") - yields) / yields))
        now = store(now.withColumn("step", F.when(live, step).otherwise(0.0))
                    .withColumn("multiplier", F.col("multiplier") + F.col("step")), "multipliers")
        if (now.agg(F.max(F.abs("step"))).first()[0] or 0) < TOLERANCE:
            break
    rate = F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.exp("multiplier")).otherwise(0.0)
    return now.select("source", "source_size", "n_docs", "target", rate.alias("rate"))


def _copies(cap: int):
    def run(batches):
        for group in runs(batches, ["source_key", "part"]):
            size, rate = group["size"].to_numpy(), group["rate"].to_numpy()[0]
            low, high = int(np.floor(rate + 1e-9)), min(cap, int(np.ceil(rate - 1e-9)))
            copies, error = np.zeros(len(size), np.int64), 0.0
            for i, n in enumerate(size.tolist()):
                if not n:
                    copies[i] = min(1, high)
                    continue
                want = rate * n + error
                copies[i] = min(high, max(low, round(want / n)))
                error = want - copies[i] * n
            kept = group.select(["doc_id", "source", "size", "source_size", "target", "rate"])
            yield from kept.append_column("copies", pa.array(copies)).to_batches()
    return run


def mix(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) for every row of ``docs`` (doc_id, text, source).

    Null texts have size 0; a document without words is taken once if its source is taken at all, and takes no words.
    Null is a source of its own, the last.  Repeated rows are rounded as separate documents.  Without any words all targets are 0.
    No rows give no rows; other columns are ignored.  The same rows always give the same copies.
    """
    sizes = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              n_words(F.col("text")).alias("size")), "sizes")
    rates = balance(targets(sizes, cap))
    # A source is rounded in as many parts as its rows need, so a hot one is spread over tasks.
    parts = F.ceil(F.col("n_docs") / ROUNDED_TOGETHER)
    named = sizes.withColumn("same", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    known = rates.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("same"),
                         "source_size", "target", "rate", parts.alias("parts"))
    dealt = (named.join(known, "same")
             .withColumn("source_key", F.xxhash64("same"))
             .withColumn("draw", F.xxhash64("doc_id", "size"))
             .withColumn("part", F.pmod("draw", "parts"))
             .repartition("source_key", "part")
             .sortWithinPartitions("source_key", "part", F.desc("size"), "draw", "doc_id"))
    return dealt.select("source_key", "part", "doc_id", "source", "size", "source_size", "target", "rate").mapInArrow(
        _copies(cap), "doc_id long, source string, size long, source_size long, target double, rate double, copies long")
