from __future__ import annotations

import random
import re

from marmita.llm.decontaminate import contained_items

DOCS = "doc_id LONG, text STRING, hash STRING, item_id LONG"
ITEMS = "item_id LONG, text STRING, doc_id LONG"


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(size, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"W{rng.randrange(60)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 60))), 1) for i in range(60)]
    items += [(100, None, 1), (101, "", 1), (None, "a b c d e f", 1), (102, "a b", 1), (3, "a repeated id with other words", 1)]
    docs = []
    for i in range(150):
        words = [word() for _ in range(rng.randrange(0, 400))]
        for _ in range(rng.randrange(3)):
            item = (items[rng.randrange(60)][1]).lower().split()
            cut = rng.randrange(max(1, len(item) // 3))
            at, split = rng.randrange(len(words) + 1), rng.randrange(len(item) + 1)
            words[at:at] = item[:split] + (["noise"] if rng.random() < 0.4 else []) + item[split:len(item) - cut]
        docs.append((i, "\t".join(words), "x", 7))
    docs += [(900, None, "x", 7), (901, " ", "x", 7), (902, "A B", "x", 7), (None, items[0][1], "x", 7),
             (903, "w " * 30_000 + items[5][1], "x", 7), (3, items[9][1], "x", 7)]
    want = {}
    for doc_id, text, *_ in docs:
        for item_id, item, _ in items:
            a, b = shingles(item), shingles(text)
            if doc_id is not None and item_id is not None and a and 100 * len(a & b) >= 80 * len(a):
                now = (len(a & b) / len(a), len(a & b), len(a))
                want[doc_id, item_id] = max(want.get((doc_id, item_id), now), now)
    got = contained_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id): (r.containment, r.n_shared, r.n_item) for r in got} == want
    assert len(got) == len(want) > 20


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c d e f", "x", 7)], DOCS)
    assert contained_items(docs, items).collect() == contained_items(some, items).collect() == []
