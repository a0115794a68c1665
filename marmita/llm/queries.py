"""Registered queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marmita.llm import chat
from marmita.llm.common import store
from marmita.llm.decontaminate import contained_items
from marmita.llm.line_dedup import remove_boilerplate
from marmita.llm.mixing import mix
from marmita.llm.near_dups import near_duplicates
from marmita.llm.packing import pack, token_pieces
from marmita.llm.prefix_trie import numbered, prefix_trie, with_shared_openings
from marmita.llm.quality_classifier import quality_scores
from marmita.llm.quality_rules import quality
from marmita.llm.suffix_dedup import remove_repeats
from marmita.llm.token_output import documents_of, read_blocks, write_tokens
from marmita.llm.toxicity import toxicity
from marmita.llm.vector_codes import codebooks_sha256, vector_codes, with_label_errors
from marmita.session import shared_folder, use_utc
from marmita.sources.tables import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Said by both turns of the extra conversation -1: control strings of the template inside a text.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def tokenizer_json() -> str:
    """File of the tokenizer; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SQL_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def register(name: str, sql: str | None = None):
    def add(build):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return build(lambda table: read_table(spark, sf_dir, table))
        REGISTRY[name] = query
        if sql:
            ORACLE[name] = sql
        return build
    return add


@register("op1_toxicity")
def _(table):
    return toxicity(table("documents"), table("labels"))


@register("op2_near_dups")
def _(table):
    return near_duplicates(table("documents"), shingle=2)


@register("op3_suffix_dedup")
def _(table):
    return remove_repeats(table("documents")).drop("removed_from", "removed_to")


@register("op4_decontaminate", f"""
WITH d AS (SELECT doc_id, {SQL_WORDS.format(SQL_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
     i AS (SELECT item_id, {SQL_WORDS.format(SQL_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
     ds AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
     s AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS s
            FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM i WHERE len(w) > 0)),
     n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
""")
def _(table):
    return contained_items(table("documents"), table("benchmark"))


@register("op5_quality_rules")
def _(table):
    return quality(table("documents"))


@register("op6_token_output")
def _(table):
    docs = table("documents")
    path = f"{shared_folder(docs.sparkSession)}/tokens"
    write_tokens(docs, path, tokenizer_json())
    return documents_of(read_blocks(docs.sparkSession, path))


@register("op7_quality_classifier")
def _(table):
    return quality_scores(table("documents"), table("labels"))


@register("op8_chat")
def _(table):
    rows = table("conversations").select("conv_id", "turn", "role", "text")
    extra = rows.sparkSession.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], chat.ROWS)
    formatted = store(chat.format_conversations(rows.unionByName(extra), tokenizer_json()), "formatted")
    return chat.digests(formatted)


@register("op9_mix")
def _(table):
    mixed = mix(table("documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "source", "copies")


@register("op10_line_dedup", """
WITH l AS (SELECT doc_id, source, p, trim(line) AS line, line AS raw FROM (
             SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents WHERE text IS NOT NULL)),
     b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 6),
     k AS (SELECT doc_id, count(*) FILTER (l.line <> '') AS n_lines, count(b.line) AS n_removed,
                  coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (b.line IS NULL), '') AS kept
           FROM l LEFT JOIN b ON l.line = b.line GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       length(kept) AS n_chars, md5(kept) AS kept_md5
FROM documents d LEFT JOIN k USING (doc_id)
""")
def _(table):
    kept = remove_boilerplate(table("documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"),
                       F.md5(F.col("text").cast("binary")).alias("kept_md5"))


#: Unsigned CRC-32 of the decimal conv_id, bit by bit.
SQL_CRC = """list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                              lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END),
                CAST(4294967295 AS BIGINT))"""


@register("op11_prefix_trie", f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     c AS (SELECT conv_id, xor({SQL_CRC}, 4294967295) % 6 AS h,
                  list({{'key': sha256(concat(length(role), ':', role, text)), 'n': length(text)}} ORDER BY pos) AS turns
           FROM t GROUP BY conv_id),
     r AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
           FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
     s AS (SELECT conv_id, unnest(generate_series(0, len(turns))) AS depth, turns FROM r),
     k AS (SELECT conv_id, depth, depth = len(turns) AS last, sha256(array_to_string(list_transform(turns[1:depth], lambda x: x.key), ',')) AS key,
                  sha256(array_to_string(list_transform(turns[1:depth - 1], lambda x: x.key), ',')) AS above,
                  CASE WHEN depth > 0 THEN turns[depth].n ELSE 0 END AS n FROM s),
     n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(above) AS above, min(n) AS n,
                  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
           FROM k GROUP BY key, depth),
     m AS (SELECT n.*, p.conv_id AS parent_conv_id,
                  (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.above = n.key) AS n_children
           FROM n LEFT JOIN n p ON n.depth > 0 AND p.key = n.above AND p.depth = n.depth - 1),
     u AS (SELECT k.key, k.depth, count(*) FILTER (m.n_children = 0) AS n_leaves,
                  CAST(sum((m.n_convs - 1) * m.n) AS BIGINT) AS saved_tokens
           FROM m JOIN k ON k.conv_id = m.conv_id AND k.depth <= m.depth GROUP BY k.key, k.depth)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM m JOIN u USING (key, depth)
""")
def _(table):
    return prefix_trie(*with_shared_openings(*numbered(table("conversations"))))


@register("op12_packing")
def _(table):
    pieces = token_pieces(table("documents"), tokenizer_json())
    packed = pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return packed.withColumn("length", F.col("length").cast("long"))


def _codebook_sql(rounds: int) -> str:
    """Common table expressions c0 (part, pos, entry, x) to c<rounds>, over the parts p (vec_id, part, pos, x) of all kept vectors."""
    steps = ["""c0 AS (SELECT part, pos, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x FROM p
             WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64))"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (SELECT vec_id, part, entry, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{i} c USING (part, pos)
             GROUP BY vec_id, part, entry),
     a{i} AS (SELECT vec_id, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d FROM d{i} GROUP BY vec_id, part)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT part, pos, entry, floor(sum(x) / count(*)) AS x FROM p JOIN a{i} USING (vec_id, part)
             GROUP BY part, pos, entry),
     c{i + 1} AS (SELECT part, pos, entry, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (part, pos, entry))""")
    return ",\n     ".join(steps)


@register("op13_vector_codes", f"""
WITH v AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
     p AS (SELECT vec_id, (i - 1) // (n // 16) AS part, (i - 1) % (n // 16) AS pos, floor(256 * CAST(e AS DOUBLE)) AS x
           FROM (SELECT vec_id, len(embedding) AS n, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM v)),
     {_codebook_sql(2)},
     r AS (SELECT vec_id, string_agg(format('{{:02x}}', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
                  CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c2) AS codebooks_sha256
FROM r JOIN v USING (vec_id)
""")
def _(table):
    codes = vector_codes(table("embeddings"))
    rows = with_label_errors(codes.rows)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(codes.codebooks)).alias("codebooks_sha256"))
