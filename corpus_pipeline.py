"""A training corpus from raw documents in five stages, each written as Parquet and read again by the next.

Every stage but the last takes and returns the columns of ``documents``, and any others whatever their names, and judges each row by its own text: rows
that share a doc_id or have none are told apart by a 64-bit hash of all that they are judged by, so no stage copies the texts.  Null texts fail the quality
rules; very long texts are judged whole; no rows stay no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marmita.llm.common import store
from marmita.llm.decontaminate import contained_items
from marmita.llm.mixing import mix
from marmita.llm.near_dups import near_duplicates
from marmita.llm.quality_rules import quality
from marmita.llm.queries import tokenizer_json
from marmita.llm.token_output import documents_of, read_blocks, write_tokens
from marmita.session import shared_folder, use_utc
from marmita.sources.tables import read_table

#: No SQL states the perplexity bands, the links or the ids of the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def _free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer while a column has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _hashed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of each row's doc_id, text and lang, which rows that are judged alike share, and the name of that column."""
    row = _free_name(docs, "row")
    judged_by = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    # A null counts as nothing in a hash.
    return docs.withColumn(row, F.xxhash64(*(x for c in judged_by for x in (F.col(c).isNull(), F.col(c))))), row


def _judged(hashed: DataFrame, row: str) -> DataFrame:
    """The rows as operators see them: the hash in place of the doc_id."""
    others = [c for c in ("text", "lang", "source") if c in hashed.columns]
    return hashed.select(F.col(row).alias("doc_id"), *others)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the counted rules and their language's perplexity bands."""
    hashed, row = _hashed(docs)
    failed = quality(_judged(hashed, row)).where("NOT kept").select(F.col("doc_id").alias(row)).distinct()
    return hashed.join(failed, row, "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, one with the smallest doc_id (null last); rows without words are in no group."""
    hashed, row = _hashed(docs)
    n, nth = _free_name(docs, "n_shingles"), _free_name(docs, "nth")
    groups = near_duplicates(_judged(hashed, row)).select(F.col("doc_id").alias(row), F.col("n_shingles").alias(n), "component_id").distinct()
    known = hashed.select(row, F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("first")).distinct()
    chosen = (groups.join(known, row).groupBy("component_id").agg(F.min(F.struct("first", n)).alias("of"))
              .select(F.col("of.first").getField(row).alias(row), F.col("of").getField(n).alias(n)))
    # Only rows that agree in all that they are judged by share a hash: the first of them stands for all.
    numbered = hashed.join(chosen, row).withColumn(nth, F.row_number().over(Window.partitionBy(row).orderBy(row)))
    return numbered.where((F.col(nth) == 1) | (F.col(n) == 0)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    hashed, row = _hashed(docs)
    found = contained_items(_judged(hashed, row), read_table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(row)).distinct()
    return hashed.join(found, row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the target shares of the sources ask for; none drops it.

    Rows that repeat a doc_id get the copies of the one that is taken most.
    """
    taken, copies = _free_name(docs, "taken"), _free_name(docs, "copies")
    number = mix(docs).groupBy(F.col("doc_id").alias(taken)).agg(F.max("copies").cast("int").alias(copies)).where(F.col(copies) > 0)
    chosen = docs.join(number, docs["doc_id"].eqNullSafe(number[taken]))
    return chosen.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(taken)).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document copy, read back from the token files that this stage writes."""
    path = f"{shared_folder(spark)}/corpus-tokens"
    write_tokens(docs, path, tokenizer_json())
    return documents_of(read_blocks(spark, path))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
