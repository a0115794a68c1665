from __future__ import annotations

import random
import re

from marmita.llm.mixing import mix

DDL = "doc_id LONG, text STRING, source STRING, size STRING, rate INT"


def expected_targets(rows, cap=3):
    size = {}
    for _, text, source, *_ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(cap * size[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > cap * size[s]}
        if not over:
            return {s: cap * size[s] if s in capped else level * weight[s] for s in names}, size
        capped |= over


def test_targets_and_copies(spark):
    rng = random.Random(1)
    rows = []
    for i in range(4000):
        source = rng.choices(["a", "b", "ä", "Z", None, "tiny", ""], [60, 5, 5, 5, 10, 1, 3])[0]
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), source, "x", 1))
    rows += [(5000, None, "a", "x", 1), (5001, "  ", "nothing", "x", 1), (None, "a b c", "a", "x", 1), (7, "a b", "a", "x", 1)]
    want, size = expected_targets(rows)
    got = mix(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.size * r.copies <= 3 * r.size
        assert r.source_size == size[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
    for source, words in taken.items():
        assert abs(words - want[source]) <= 0.02 * want[source] + 5, (source, words, want[source])
    again = mix(spark.createDataFrame(rows, DDL).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty(spark):
    assert mix(spark.createDataFrame([], DDL)).collect() == []
    rows = [(1, None, None, "x", 1), (2, "", "a", "x", 1)]
    assert {(r.doc_id, r.size, r.target, r.copies) for r in mix(spark.createDataFrame(rows, DDL)).collect()} == {
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)}
