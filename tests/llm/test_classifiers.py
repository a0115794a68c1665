from __future__ import annotations

import random
import zlib

import numpy as np

from marmita.llm import quality_classifier as qc
from marmita.llm import toxicity as tox
from marmita.llm.linear import Sparse, fit

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, score INT, label STRING, host INT"
LABELS = "doc_id LONG, quality INT, toxic INT, text STRING"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def dense(x):
    n, m = x.shape
    return Sparse(np.repeat(np.arange(n), m), np.tile(np.arange(m), n), x.ravel(), (n, m))


def test_fit_reaches_the_least_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.normal(size=300) > 0.3).astype(float)
    weight = np.where(y > 0, 2.0, 1.0)
    pairs = rng.normal(size=(20, 4))
    w, b = fit(dense(x), y, 0.01, dense(pairs), 0.5, weight)

    def loss(v):
        z = x @ v[:4] + v[4]
        return weight @ (np.logaddexp(0, z) - y * z) / weight.sum() + 0.005 * v[:4] @ v[:4] + 0.5 * np.mean(np.square(pairs @ v[:4]))

    best = loss(np.r_[w, b])
    assert all(loss(np.r_[w, b] + d) > best - 1e-12 for d in rng.normal(size=(500, 5)) * 0.01)


def sentences(rng, n, identity_toxic):
    """Toxic texts carry insults, and in ``identity_toxic`` of them a group name that neutral texts rarely have."""
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(plain) for _ in range(30)]
        if toxic:
            text[5:5] = rng.sample(["vile", "scummy", "rotten"], 1)
            if rng.random() < identity_toxic:
                text[9:9] = ["muslims"]
        elif rng.random() < 0.02:
            text[9:9] = ["muslims"]
        rows.append((i, " ".join(text) + ".", "en", "s", 1, "x", 1))
        labels.append((i, 1, int(toxic), "x"))
    return rows, labels


def test_toxicity(spark):
    rng = random.Random(5)
    rows, labels = sentences(rng, 800, 0.5)
    rows += [(5000, None, "en", "s", 1, "x", 1), (5001, "", "en", "s", 1, "x", 1), (None, rows[1][1], "en", "s", 1, "x", 1), (1, rows[1][1], "en", "s", 1, "x", 1),
             (5002, ("calm word1 " * 50_000) + " vile vile", "en", "s", 1, "x", 1),
             (5003, "we met muslims word7 word9 word30", "en", "s", 1, "x", 1)]
    labels += [(None, 1, 1, "x"), (6000, None, None, "x"), (3, 1, 0, "x"), (9999, 0, 1, "x")]
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = tox.toxicity(docs, known).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (True if r.doc_id is None else is_held_out(r.doc_id)) for r in got)
    assert by_id[5000].score == by_id[5001].score and by_id[5002].predicted == 1
    truth = {i: t for i, _, t, _ in labels[:800]}
    insulted = {r[0] for r in rows[:800] if any(w in r[1] for w in ("vile", "scummy", "rotten"))}
    assert all(by_id[i].predicted == 1 for i in insulted if is_held_out(i))
    clean = [i for i in range(800) if not truth[i]]
    assert sum(by_id[i].predicted for i in clean) <= 0.01 * len(clean)
    # The name of a group alone does not make a text toxic, though labelled texts use it mostly so; without the penalty it does.
    assert by_id[5003].predicted == 0


def test_penalty_takes_weight_from_group_names(spark, monkeypatch):
    rows, labels = sentences(random.Random(6), 800, 0.9)
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    sample = docs.join(known.select("doc_id", known["toxic"].alias("label2")), "doc_id").selectExpr("doc_id", "text", "label2 AS label")
    weight = {}
    for penalty in (0.0, 1.0):
        monkeypatch.setattr(tox, "PAIR_PENALTY", penalty)
        features, w, _ = tox.train(sample, 200)
        weight[penalty] = sum(w[features.index(f)] for f in tox.features_of("muslims"))
    assert weight[0.0] > 0.5 and abs(weight[1.0]) < 0.3 * weight[0.0]


def test_swaps():
    found = tox.swaps("The Muslim said")
    assert ({"the", "muslim", "said"}, {"the", "jewish", "said"}) in found and ({"the", "muslim", "said"}, {"the", "said"}) in found
    assert tox.swaps("nobody was named") == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 1, "x", 1)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.predicted for r in tox.toxicity(docs, none).collect()] == [0]
    assert tox.toxicity(spark.createDataFrame([], DOCS), none).collect() == []


def test_quality(spark):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "eron", "ist", "uling")]
    rows, labels = [], []
    for i in range(1000):
        good = i % 5 > 0
        text = " ".join(rng.choice(words) + ("" if good else "###") for _ in range(rng.randrange(60, 200)))
        rows.append((i, text, rng.choice(["en", None]), "bad" if not good and i % 10 else f"s{i % 30}", 1, "x", 1))
        labels.append((i, int(good), 0, "x"))
    rows += [(5000, None, None, None, 1, "x", 1), (5001, "", "en", "new", 1, "x", 1), (None, rows[1][1], "en", "s1", 1, "x", 1),
             (1, rows[1][1], "en", "s1", 1, "x", 1), (5002, "word " * 300_000, "en", "s1", 1, "x", 1)]
    labels += [(None, 1, 1, "x"), (6000, None, None, "x"), (3, 1, 0, "x")]
    got = qc.quality_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    held = [i for i in range(1000) if is_held_out(i)]
    assert all(by_id[i].held_out for i in held)
    assert sum(by_id[i].predicted == int(i % 5 > 0) for i in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.kept == (r.predicted == 1) for r in got)
    assert {by_id[i].share for i in range(1000) if rows[i][3] == "bad"} < {r.share for r in got}
    bad = max(by_id[i].share for i in range(1000) if rows[i][3] == "bad")
    assert bad < min(by_id[i].share for i in range(1000) if rows[i][3] == "s1")
    none = spark.createDataFrame([], LABELS)
    assert qc.quality_scores(spark.createDataFrame([], DOCS), none).collect() == []
    assert len(qc.quality_scores(spark.createDataFrame(rows[:3], DOCS), none).collect()) == 3


def test_posteriors_shrink_sparse_sites(spark):
    sites = spark.createDataFrame(
        [("big", "a", 1000, 900.0), ("big", "b", 1, 0.0), ("poor", "a", 800, 80.0), ("poor", None, 2, 2.0), ("rare", "a", 1, 0.0), (None, "a", 400, 200.0)],
        "host STRING, path STRING, n LONG, good DOUBLE")
    got = {(r.host, r.path): r for r in qc.posteriors(sites).collect()}
    assert len(got) == 6
    for r in got.values():
        assert 0 < r.share < 1
    assert abs(got["big", "a"].share - 0.9) < 0.02 and abs(got["poor", "a"].share - 0.1) < 0.02
    assert got["big", "b"].share > 0.4 and got["poor", None].share < 0.7
    # One document says little: the site stays nearer to the global share than to its own.
    assert abs(got["rare", "a"].share - got["rare", "a"].global_share) < 0.35
