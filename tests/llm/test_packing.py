"""Packing: every piece once, no gaps, whole documents, and as few sequences as plain best fit or fewer."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest

from marmita.llm import packing
from marmita.llm.packing import best_fit, crossover, evolve, fitness, first_solution, load, mutate, pack, sequences, token_pieces
from marmita.llm.queries import tokenizer_json


def plain_best_fit(lengths, size):
    """Number of bins, a piece at a time."""
    free = []
    bins = 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(free, length)
        left = free.pop(i) if i < len(free) else size
        bins += left == size
        insort(free, left - length)
    return bins


def used(solution):
    total = Counter()
    for pattern, times in solution.items():
        for length, number in pattern:
            total[length] += number * times
    return total


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_in_bulk_equals_one_by_one(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 100), 7, 31]) for _ in range(500)]
    counts = Counter(lengths)
    solution = best_fit({}, sorted(counts.items(), reverse=True), 100)
    assert used(solution) == counts and all(load(p) <= 100 for p in solution)
    assert sum(solution.values()) == plain_best_fit(lengths, 100)


def test_offspring_keep_every_piece_and_get_no_worse():
    rng = random.Random(2)
    counts = dict(Counter(rng.randrange(20, 70) for _ in range(2000)))
    start = [first_solution(counts, 100, rng, m) for m in range(8)]
    children = [crossover(*rng.sample(start, 2), counts, 100, rng) for _ in range(20)] + [mutate(s, 100, rng) for s in start]
    for solution in start + children:
        assert used(solution) == counts and all(load(p) <= 100 for p in solution)
    evolved = evolve(start, counts, 100, "1")
    assert fitness(evolved[0], 100) >= max(fitness(s, 100) for s in start)
    assert evolved == evolve(start, counts, 100, "1")


def test_the_search_beats_best_fit():
    counts = {51: 400, 27: 400, 26: 1400, 23: 1000, 24: 600, 41: 300, 35: 300}
    plain = best_fit({}, sorted(counts.items(), reverse=True), 101)
    rng = random.Random(0)
    population = [first_solution(counts, 101, rng, m) for m in range(8)]
    for epoch in range(3):
        population = evolve(population, counts, 101, str(epoch))
    assert sum(population[0].values()) < sum(plain.values())


def check_places(rows, size):
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(inside)


DOCS = "doc_id long, text string, length string, sequence_id string, tie int, item int, row string, ids int"


def test_documents_end_to_end(spark):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    words = ["alpha", "beta,", "Gamma.", "Größe", "中文字", "x1", "\n", "  ", "<|im_end|>"]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 5, 40, 300]))) for _ in range(120)]
    texts += [" ".join(rng.choices(words, k=40_000)), "", None, texts[0], texts[0], "a b " * 4000]
    rows = [(None if i == 7 else i - (i == 9), t, "l", "s", 1, 2, "r", 3) for i, t in enumerate(texts)]
    pieces = token_pieces(spark.createDataFrame(rows, DOCS), tokenizer_json(), size=512)
    placed = pack(pieces.drop("ids"), 512).collect()
    tokenizer = Tokenizer.from_file(tokenizer_json())
    expected = Counter()
    lengths = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 512 or 512, len(ids), 512), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[doc_id, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
            lengths.append(b - a)
    raw = {r.row: bytes(r.ids) for r in pieces.collect()}
    assert Counter((r.doc_id, r.piece, r.start, r.length, raw[r.row]) for r in placed) == expected
    n = check_places(placed, 512)
    assert -(-sum(lengths) // 512) <= n <= plain_best_fit(lengths, 512)
    whole = sequences(pieces, pack(pieces.drop("ids"), 512)).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(lengths) and len(whole) == n
    for r in whole:
        assert b"".join(raw[x] for x in r.rows) == bytes(r.ids)


def test_many_of_one_length_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr("marmita.llm.prefix_trie.PARTITION_ROWS", 50)
    rows = [(i, 30 if i % 3 else 1 + i % 99, i, "x") for i in range(900)]
    items = spark.createDataFrame(rows, "name long, length int, at long, part string").repartition(7)
    placed = pack(items, 100).collect()
    assert sorted((r.name, r.length, r["at"], r.part) for r in placed) == sorted(rows)
    assert check_places(placed, 100) <= plain_best_fit([r[1] for r in rows], 100)


def test_empty_tables_and_bad_lengths(spark):
    none = spark.createDataFrame([], DOCS)
    pieces = token_pieces(none, tokenizer_json())
    assert pack(pieces).count() == 0 and sequences(pieces, pack(pieces)).count() == 0
    full = spark.createDataFrame([(1, 10), (2, 10)], "name long, length int")
    assert check_places(pack(full, 10).collect(), 10) == 2
    for bad in (0, 11, None):
        with pytest.raises(ValueError, match="lengths"):
            pack(spark.createDataFrame([(1, bad)], "name long, length int"), 10)


def test_query_covers_whole_documents(spark):
    import __spark_entry__ as driver

    rows = driver.queries()["op12_packing"](spark, "/root/testdata/sf0.001").collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert set(by_doc) == set(docs)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_json())
    for doc_id, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(docs[doc_id], add_special_tokens=False).ids, 0], "<u4")
        for piece, start, length, crc in parts:
            assert zlib.crc32(ids[start:start + length].tobytes()) == crc
        assert sum(p[2] for p in parts) == len(ids) and all(p[2] == 2048 for p in parts if p[0])
    assert check_places(rows, 2048) <= plain_best_fit([r.length for r in rows], 2048)
    assert packing.ISLANDS > 1
