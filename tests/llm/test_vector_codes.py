"""Product codes against plain Lloyd rounds in Python numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from marmita.llm import vector_codes as module
from marmita.llm.vector_codes import assign, codebooks_sha256, cover_forest, vector_codes, with_label_errors

DDL = "vec_id long, embedding array<float>, label int, entry string, code string, error long"


def plain(rows, parts, entries, rounds, scale=256):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    most = math.isqrt((1 << 61) // (parts * width))
    clip = lambda x: max(-most, min(most, math.floor(scale * float(np.float32(x)))))
    vectors = []
    for vec_id, x, label in kept:
        whole = [clip(v) for v in x] + [0] * (parts * width - len(x))
        vectors.append((vec_id, [tuple(whole[p * width:(p + 1) * width]) for p in range(parts)], label))
    vectors.sort(key=lambda v: (v[0] is None, v[0] or 0, v[1]))
    books = [[v[1][p] for v in vectors[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, x, _ in vectors:
                groups.setdefault(nearest(p, x[p]), []).append(x[p])
            books[p] = [tuple(sum(c) // len(c) for c in zip(*groups[e], strict=True)) if e in groups else old
                        for e, old in enumerate(books[p])]
    out = []
    for vec_id, x, label in vectors:
        code = [nearest(p, x[p]) for p in range(parts)]
        out.append((vec_id, label, "".join(f"{e:02x}" for e in code), sum(far(x[p], books[p][e]) for p, e in enumerate(code))))
    return out, books


def compare(spark, rows, parts=2, entries=4, rounds=2):
    df = spark.createDataFrame([(*r, "e", "c", 1) for r in rows], DDL)
    codes = vector_codes(df, parts, entries, rounds)
    expected, books = plain(rows, parts, entries, rounds)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, codes.rows.collect()), key=key) == sorted(expected, key=key)
    assert [[tuple(e) for e in p] for p in codes.codebooks] == books
    return codes


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [round(float(x), 3) for x in rng.normal(0, 0.2, 8)], int(i) % 3) for i in rng.permutation(300)]
    rows += [(1000 + i, rows[i % 7][1], None) for i in range(60)]  # copies
    compare(spark, rows, 4, 16)


def test_bad_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0, 0.5, 0.25], 0), (2, None, 0), (3, [nan, 1.0, 1.0, 1.0], 1), (4, [inf, 1.0, 1.0, 1.0], 1),
            (5, [None, 1.0, 1.0, 1.0], 1), (6, [-0.001, 1e30, -1e30, 1.0], None), (7, [], None), (8, [1.0], 2),
            (None, [0.5, 0.5, 0.5, 0.5], 2), (1, [0.0, 1.0, 0.5, 0.25], 0), (1, [1.0, 0.0, 0.0, 0.0], 0),
            (9, [0.5, 0.5, 0.25, 0.25], None)]
    compare(spark, rows)
    compare(spark, [(1, [], 0), (2, [], 1)])


def test_empty_table(spark):
    codes = vector_codes(spark.createDataFrame([], DDL))
    assert codes.rows.count() == 0
    assert codebooks_sha256(codes.codebooks) == codebooks_sha256([])


@pytest.mark.parametrize("sent", [0, 10_000])
def test_label_errors(spark, sent, monkeypatch):
    monkeypatch.setattr(module, "SENT_LABELS", sent)
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2, f"{i:02x}", i) for i in range(50)],
                                 "vec_id long, label int, code string, error long")
    found = {(r.vec_id, r.label_error) for r in with_label_errors(rows).collect()}
    of = lambda i: None if i % 5 == 0 else i % 2
    assert found == {(i, sum(j for j in range(50) if of(j) == of(i))) for i in range(50)}


@pytest.mark.parametrize("width", [1, 4, 12])
def test_trees_cover_and_agree_with_all_comparisons(width):
    rng = np.random.default_rng(width)
    points = rng.integers(-60, 60, (3, 700, width))
    points[:, 100:300] = points[:, :1]  # many copies of a point
    forest = cover_forest(points)
    for node in range(len(forest.start)):
        within = forest.points[forest.start[node]:forest.end[node]]
        assert np.square(within - within[0]).sum(1).max() == forest.radius2[node]
        below = slice(forest.child[node], forest.child[node] + forest.children[node])
        if forest.children[node]:
            assert forest.start[below][0] == forest.start[node] and forest.end[below][-1] == forest.end[node]
            assert (4 * forest.radius2[below] <= forest.radius2[node]).all()
    books = np.r_[points[:, :20], points[:, :20]].reshape(3, 40, width)  # entries in pairs: ties
    chosen, sums, counts = assign(forest, books)
    tree = forest.order // 700
    distance = np.square(forest.points[:, None] - books[tree]).sum(-1)
    assert (chosen == distance.argmin(1)).all()
    for t in range(3):
        for e in range(40):
            mine = forest.points[(tree == t) & (chosen == e)]
            assert counts[t, e] == len(mine) and (sums[t, e] == mine.sum(0)).all()


def test_far_clusters_are_taken_whole(monkeypatch):
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    points = (np.repeat(centres, 500, 0) + rng.integers(-20, 20, (2000, 2)))[None]
    compared = []
    plain_squared = module.squared
    monkeypatch.setattr(module, "squared", lambda a, b: compared.append(len(a)) or plain_squared(a, b))
    forest = cover_forest(points)
    compared.clear()
    chosen, _, counts = assign(forest, centres[None])
    assert counts.tolist() == [[500] * 4]
    assert sum(compared) < 40  # nodes met, of 2,000 points
