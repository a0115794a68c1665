from __future__ import annotations

import random
import re
import uuid

import numpy as np
import public_tokenizers
import zlib
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from marmita.llm import common

DDL = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def tables(spark, folder):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so", "ti") for b in ("ber", "dan", "fel", "gor", "hin", "jas", "kul")]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(n))
    rows = [(i, text(rng.randrange(80, 300)), "en", f"s{i % 3}", 0) for i in range(90)]
    item = text(30)
    rows += [(100, "too short", "en", "s0", 0), (101, "word " * 200, "en", "s1", 0), (102, None, "en", "s1", 0),
             (103, rows[4][1], "en", "s2", 0), (104, rows[5][1] + " one more", None, "s2", 0), (105, text(60) + " " + item + " " + text(60), "en", "s0", 0),
             (None, text(120), "en", "s0", 0)]
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id LONG, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = tables(spark, tmp_path)
    ids = lambda df: sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in df.collect())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = ids(docs)
    clean = [-1, *range(90)]
    assert kept["quality rules"] == sorted([*clean, 103, 104, 105])
    assert kept["near-duplicates"] == sorted([*clean, 105])
    assert kept["decontamination"] == clean
    assert set(kept["mixing"]) <= set(clean) and max(kept["mixing"].count(i) for i in clean) <= 3
    words = {-1 if r[0] is None else r[0]: len(re.findall(r"\S+", r[1] or "")) for r in rows}
    source = {-1 if r[0] is None else r[0]: r[3] for r in rows}
    taken = [sum(words[i] for i in kept["mixing"] if source[i] == f"s{k}") for k in range(3)]
    total = sum(words[i] for i in clean)
    assert all(abs(t - total * (k + 1) / 6) < 0.05 * total for k, t in enumerate(taken))

    plain, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    text = {-1 if r[0] is None else r[0]: r[1] for r in rows}
    got = sorted(pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == kept["mixing"]
    for r in got:
        tokens = plain.encode(text[-1 if r.doc_id is None else r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        at += len(tokens)
    whole = pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, got), key=str)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_are_judged_one_by_one(spark, tmp_path):
    """Repeated and missing doc_ids, and columns named as stages name theirs: no good row goes with a bad one, and bad ones go."""
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    extra = "row LONG, copies STRING, mixed INT, copy INT, taken INT, kept STRING, failed INT, first INT"
    good = [r.text for r in docs.where("doc_id < 6").orderBy("doc_id").collect()]
    leak = spark.read.parquet(f"{tmp_path}/benchmark.parquet").first().text
    some = [(None, "too short"), (None, good[0] + " end"), (7, "few words"), (7, good[1] + " end"), (8, good[2] + " " + leak), (8, good[3] + " end"),
            (None, good[4] + " " + leak), (None, good[5]), (9, good[5])]
    rows = [(i, t, "en", "s0", 0, 1, "c", 2, 3, 4, "k", 5, 6) for i, t in some]
    more = spark.createDataFrame(rows, f"{DDL}, {extra}")
    own = more.unionByName(docs.where("doc_id >= 20 AND doc_id < 90"), allowMissingColumns=True)
    left = own
    for name, stage in pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == own.columns
        left.write.parquet(f"{tmp_path}/judged {name}")
        left = spark.read.parquet(f"{tmp_path}/judged {name}")
        if name == "decontamination":
            kept = {(r.doc_id, r.text) for r in left.collect()}
    assert {x for x in kept if x[0] is None or x[0] < 20} == {(None, good[0] + " end"), (7, good[1] + " end"), (8, good[3] + " end"), (9, good[5])}
    mixed = left.where("doc_id = 9").first()
    assert mixed is None or tuple(mixed)[5:] == (1, "c", 2, 3, 4, "k", 5, 6)


def test_stages_store_no_copy_of_the_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda _: f"{tmp_path}/stored/{uuid.uuid4()}")
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).count()
    stored = [spark.read.parquet(str(p)).columns for p in (tmp_path / "stored").glob("*/*")]
    assert len(stored) > 8 and not [c for c in stored if "text" in c]


def test_repeated_rows(spark, tmp_path):
    """Equal rows are judged alike; one is left of those with words, all of those without."""
    tables(spark, tmp_path)
    texts = [r.text for r in spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 3").orderBy("doc_id").collect()]
    leak = spark.read.parquet(f"{tmp_path}/benchmark.parquet").first().text
    rows = [(1, texts[0], "a"), (1, texts[0], "b"), (None, texts[1], "c"), (None, texts[1], "c"), (5, None, "d"), (5, None, "d"), (None, "", "e"), (None, "", "e"),
            (None, None, "e"), (4, texts[2] + " " + leak, "f"), (4, texts[2] + " " + leak, "f")]
    docs = spark.createDataFrame([(i, t, "en", "s0", 0, {k: 1}) for i, t, k in rows], f"{DDL}, extra MAP<STRING, INT>")
    judged = lambda name: sorted([(r.doc_id, r.text) for r in dict(pipeline.STAGES)[name](spark, docs, str(tmp_path)).collect()], key=str)
    pairs = [(i, t) for i, t, _ in rows]
    assert judged("quality rules") == sorted([x for x in pairs if x[1]], key=str)
    assert judged("near-duplicates") == sorted([pairs[0], pairs[2], *pairs[4:10]], key=str)
    assert judged("decontamination") == sorted(pairs[:9], key=str)


def test_quality_stage_reads_letters_of_every_script(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choices("абвгдежзиклмнопрст", k=rng.randrange(2, 8))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(100)]
    # Letters that agree with those of a text in their code point modulo 26, in no order.
    other = [[chr(c) for c in range(0x4E00, 0x9000) if c % 26 == k] for k in range(26)]
    texts.append("".join(rng.choice(other[ord(c) % 26]) if c != " " else c for c in texts[0]))
    docs = spark.createDataFrame([(i, t, "ru", "s", 0) for i, t in enumerate(texts)], DDL)
    assert sorted(r.doc_id for r in pipeline.quality_rules(spark, docs, str(tmp_path)).collect()) == list(range(100))
