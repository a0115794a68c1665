"""The trie of shared openings against one built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from marmita.llm import prefix_trie as module
from marmita.llm.prefix_trie import numbered, prefix_trie, with_shared_openings

DDL = "conv_id long, turn long, role string, text string, at long, k1 string, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, rebuild=True):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(turns)] for c, turns in convs.items()}
    built = convs
    if rebuild:
        built = {}
        for c, turns in convs.items():
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (c % 100 if c >= 0 else -(-c % 100))
            built[c] = convs.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, inside in members.items():
        below = [k for k in members if k[:len(key)] == key]
        children = lambda n: sum(1 for k in members if len(k) == len(n) + 1 and k[:len(n)] == n)
        ends = ",".join(map(str, sorted(c for c in inside if len(built[c]) == len(key))))
        out.append((min(inside), len(key), min(members[key[:-1]]) if key else None, len(inside), children(key),
                    sum(1 for k in below if not children(k)), sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def compare(spark, rows, rebuild=True):
    df = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], DDL)
    turns, convs = numbered(df)
    if rebuild:
        turns, convs = with_shared_openings(turns, convs)
    found = prefix_trie(turns, convs).select(*COLUMNS)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, rebuild)


@pytest.fixture
def small(monkeypatch):
    """Chunks and blocks of a few rows, so that conversations and siblings cross them."""
    monkeypatch.setattr(module, "CHUNK", 3)
    monkeypatch.setattr(module, "PARTITION_ROWS", 7)
    monkeypatch.setattr(module, "HOT_SHARE", 10)


def test_equals_plain_trie(spark):
    rng = random.Random(3)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "bé", "", "ccc"]))
            for c in range(90, 260, 3) for t in range(rng.randrange(1, 8))]
    compare(spark, rows)


def test_small_blocks_and_a_long_conversation(spark, small):
    rng = random.Random(4)
    rows = [(7, t, "user", f"long {t % 5}") for t in range(40)] + [(100, t, "user", f"long {t % 5}") for t in range(30)]
    rows += [(c, t, "user", rng.choice(["x", "yy"])) for c in range(100, 125) for t in range(rng.randrange(1, 5))]
    compare(spark, rows)
    compare(spark, rows, rebuild=False)


def test_nulls_ties_copies_and_empty_texts(spark, small):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (1, 0, "assistant", "b"), (1, 0, "assistant", "a"),
            (None, 0, "user", "lost"), (-5, 0, "user", "x"), (-105, 3, "user", "x"), (0, 0, "u", "base"), (0, 1, "u", "base 2"),
            (200, 0, "user", "𝄞é"), (201, 0, "user", "x" * 30_000), (203, 0, "user", "x" * 30_000)]
    rows += [(c, 0, "user", "same") for c in range(300, 340)]  # a node in which a large share ends
    compare(spark, rows)


def test_turn_and_role_borders_are_kept(spark):
    compare(spark, [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc"), (4, 0, "abc", "")], rebuild=False)


def test_empty_table(spark):
    compare(spark, [])
    compare(spark, [(None, 1, "user", "no conversation")])
