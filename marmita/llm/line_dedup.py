"""Cross-site boilerplate lines: HyperLogLog sketches of the sites per line, exact counts near the threshold.

Only DataFrame functions.  A line is what stands between newlines, without spaces at its ends; blank lines don't count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.llm.common import store

LG_K = 12
#: Half-width of the band in which exact counts decide: over five standard errors of a sketch of this size, and one site at least.
BAND = 0.1


def lines_of(text) -> F.Column:
    return F.transform(F.split(text, "\n"), lambda line: F.trim(line))


def _key(line) -> F.Column:
    return F.xxhash64(line)


def spread_lines(docs: DataFrame, min_sites: int, site: str = "source") -> DataFrame:
    """(line_key) of the lines that ``min_sites`` or more distinct sites have.  A null site is no site."""
    keys = F.array_distinct(F.transform(F.filter(lines_of(F.col("text")), lambda x: x != ""), _key))
    rows = docs.where(F.col(site).isNotNull()).select(F.col(site).cast("string").alias("site"), F.explode(keys).alias("line_key"))
    sketched = (rows.groupBy("line_key").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
                .select("line_key", F.hll_sketch_estimate("sketch").alias("sites")))
    low, high = min(min_sites - 1, min_sites * (1 - BAND)), max(min_sites + 1, min_sites * (1 + BAND))
    wide = store(sketched.where(F.col("sites") >= low), "spread")
    near = wide.where(F.col("sites") < high).select("line_key")
    exact = (rows.join(near, "line_key", "left_semi").groupBy("line_key").agg(F.count_distinct("site").alias("sites"))
             .where(F.col("sites") >= min_sites))
    return wide.where(F.col("sites") >= high).select("line_key").unionByName(exact.select("line_key"))


def remove_boilerplate(docs: DataFrame, min_sites: int = 6, site: str = "source") -> DataFrame:
    """``docs`` with its text rid of every line that ``min_sites`` sites share, plus n_lines and n_removed.

    Null texts stay null with 0 lines.  All occurrences of a line go, the other lines keep their order and form.  Rows that repeat a
    doc_id or have none are handled by their own text.  All columns of ``docs`` stay; n_lines and n_removed replace columns
    of these names.  No rows give no rows; a text of any length is one row, and its lines are found in place.
    """
    spread = store(spread_lines(docs, min_sites, site), "boilerplate")
    # Under names of their own, so that no column of the caller can clash.
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    own = docs.select(*(F.col(f"`{name}`").alias(f"own_{i}") for i, name in enumerate(names)))
    doc_id, text = (F.col(f"own_{names.index(name)}") for name in ("doc_id", "text"))
    keys = F.array_distinct(F.transform(F.filter(lines_of(F.col("text")), lambda x: x != ""), _key))
    hit = (docs.select(F.col("doc_id").alias("hit_id"), F.explode(keys).alias("line_key"))
           .join(spread, "line_key").groupBy("hit_id").agg(F.collect_set("line_key").alias("hit_keys")))
    joined = own.join(hit, doc_id.eqNullSafe(F.col("hit_id")), "left")
    lines = F.split(text, "\n")
    bad = F.coalesce("hit_keys", F.array().cast("array<bigint>"))
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(bad, _key(F.trim(x))))
    real = F.coalesce(F.size(F.filter(lines, lambda x: F.trim(x) != "")), F.lit(0))
    removed = F.coalesce(F.size(lines) - F.size(kept), F.lit(0))
    cleaned = F.when(F.col("hit_keys").isNull(), text).otherwise(F.array_join(kept, "\n"))
    counted = joined.select(*own.columns, cleaned.alias("own_cleaned"), real.cast("long").alias("own_lines"), removed.cast("long").alias("own_removed"))
    return counted.select(*(F.col("own_cleaned" if name == "text" else f"own_{i}").alias(name) for i, name in enumerate(names)),
                          F.col("own_lines").alias("n_lines"), F.col("own_removed").alias("n_removed"))
