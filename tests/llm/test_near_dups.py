from __future__ import annotations

import random
import re

import pytest

from marmita.llm import near_dups
from marmita.llm.near_dups import near_duplicates

DDL = "doc_id LONG, text STRING, n LONG, key STRING"


def brute(rows, size, percent=80):
    sets = {}
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size_here = min(size, len(words))
        sets[doc_id] = {tuple(words[i:i + size_here]) for i in range(len(words) - size_here + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def answer(spark, rows, size):
    frame = spark.createDataFrame(rows, DDL)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame, size).collect()}


def family(rng, base, n, damage):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(damage)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    rng = random.Random(size)
    texts = []
    for length, n, damage in ((120, 60, 14), (40, 30, 5), (400, 20, 60), (9, 10, 2)):
        texts += family(rng, [f"w{rng.randrange(3000)}" for _ in range(length)], n, damage)
    texts += ["one", "one", "one two", "ONE two", "a b c d", "a b c d e", "a b c d e f", "É b", "é b"]
    texts += texts[:15] + [texts[3]] * 40
    rng.shuffle(texts)
    rows = [(i * 3, t, None, "k") for i, t in enumerate(texts)]
    assert answer(spark, rows, size) == brute(rows, size)


def test_empty_null_and_odd_rows(spark):
    rows = [(5, None, 1, "a"), (2, "", 1, "a"), (9, " \t\n", None, None), (4, "same text here", 1, "a"),
            (3, "same text here", 1, "a"), (3, "same text here", 1, "a")]
    assert answer(spark, rows, 2) == {5: (0, 5, True), 2: (0, 2, True), 9: (0, 9, True), 4: (2, 3, False), 3: (2, 3, True)}
    frame = spark.createDataFrame([(None, "same text here", 1, "a"), (3, "same text here", 1, "a")], DDL)
    assert {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame, 2).collect()} == {
        (None, None, True), (3, 3, True)}
    assert near_duplicates(spark.createDataFrame([], DDL), 2).collect() == []


def test_very_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    other = words[:54_000] + [f"z{i}" for i in range(6_000)]
    rows = [(1, " ".join(words), 0, ""), (2, " ".join(other), 0, ""), (3, " ".join(words[:20_000]), 0, "")]
    assert answer(spark, rows, 2) == brute(rows, 2)


def test_one_id_with_two_texts_in_a_hot_key(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    # Copies of one text with few or many changes: they share keys, and their stars leave several components.
    texts = family(rng, base, 40, 12) + [" ".join(base[:30] + [f"v{k}_{i}" for i in range(30)]) for k in range(10)]
    other = " ".join(f"z{i}" for i in range(80))
    rows = [(i + 1, x, 1, "k") for i, x in enumerate(texts)]
    twice = [(i, f"{other} {i} end", 1, "k") for i in range(1, 31)]
    got = near_duplicates(spark.createDataFrame(rows + twice, DDL), 2).collect()
    # The same texts under ids of their own, which come after all others, then equal ids linked.
    own = [(1000 + i, x, 1, "k") for i, x, *_ in twice]
    want = brute(rows + own, 2)
    root = {i: c for i, (_, c, _) in want.items()}
    links = {}

    def find(c):
        while c in links:
            c = links[c]
        return c

    for i in range(1, 31):
        a, b = sorted((find(root[i]), find(root[1000 + i])))
        if a != b:
            links[b] = a
    expected = sorted((i % 1000, want[i][0], find(root[i])) for i in want)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_set_is_stored_once_however_often_its_row_repeats(spark, monkeypatch):
    stored, store = {}, near_dups.store
    monkeypatch.setattr(near_dups, "store", lambda df, name: stored.setdefault(name, store(df, name)))
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words)] * 20 + [(2, words + " more")] * 30
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert len(got) == 50 and {r.component_id for r in got} == {1}
    assert stored["sets"].count() == 2
