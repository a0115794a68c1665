"""Toxicity: a logistic classifier of words and word beginnings, regularised by counterfactuals.

Labelled sentences that name a group are copied with the name swapped for others of its kind, and with none.  The
score change between a sentence and its copies is penalised while the classifier is fitted, so that naming a group does not by
itself make a text toxic, however often the labelled texts use the name so.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.llm.common import MEMO_WORDS, held_out, store
from marmita.llm.linear import Sparse, fit, sigmoid

#: Labelled documents that the classifier is fitted on at most, by hash order of their ids.
TRAINED_ON = 20_000
FEATURES = 4096
SENTENCES = 20_000
PREFIXES = (3, 4, 5, 6)
RIDGE, PAIR_PENALTY = 1e-4, 1.0
#: Toxic texts are the rare class: each counts as so many others.
TOXIC_WEIGHT = 3.0

# Names of groups by kind and language.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "african", "latino", "arab", "european", "american"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "athées"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "atheisten"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "ateos"),
)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


def words_in(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """A word as a whole and by its beginnings."""
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)]


def swaps(sentence: str, identities=IDENTITIES) -> list[tuple[set[str], set[str]]]:
    """(words, words after one swap) for every way to swap one group name of the sentence for another of its kind, and for none.

    Copies without a name hold the scores of all names to that of a neutral mention; swaps alone would let them rise together.
    """
    words = words_in(sentence)
    return [(words, (words - {name}) | other)
            for kind in identities for name in kind if name in words
            for other in [set(), *({x} for x in kind if x != name)]]


def _count(batches):
    total, toxic = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found = {f for w in words_in(text or "") for f in features_of(w)}
            total.update(found)
            if label:
                toxic.update(found)
            if len(total) > 2_000_000:
                yield from _counted(total, toxic)
                total, toxic = Counter(), Counter()
    yield from _counted(total, toxic)


def _counted(total, toxic):
    names = list(total)
    for start in range(0, len(names), 50_000):
        part = names[start:start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([total[f] for f in part], pa.int64()),
             pa.array([toxic[f] for f in part], pa.int64())], ["feature", "n", "n_toxic"])


def _index(features):
    """Rows for the fit: feature numbers of each text, and both sides of each swapped sentence."""
    def run(batches):
        number = {f: i for i, f in enumerate(features)}

        def numbers(words):
            return sorted({number[f] for w in words for f in features_of(w) if f in number})

        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                rows.append((int(label), numbers(words_in(text or "")), None))
                for sentence in SENTENCE.findall(text or ""):
                    rows += [(None, numbers(a), numbers(b)) for a, b in swaps(sentence)]
            label, left, right = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(left, pa.list_(pa.int32())), pa.array(right, pa.list_(pa.int32()))],
                ["label", "a", "b"])
    return run


def _sparse(rows: list[list[int]], n_features: int, signs: list[float] | None = None, at: list[int] | None = None, n: int | None = None):
    row = np.repeat(np.asarray(at if at is not None else range(len(rows)), np.int64), [len(r) for r in rows])
    column = np.fromiter((c for r in rows for c in r), np.int64, len(row))
    value = np.repeat(np.asarray(signs if signs is not None else [1.0] * len(rows)), [len(r) for r in rows])
    return Sparse(row, column, value, (n if n is not None else len(rows), n_features))


def identity_features(identities=IDENTITIES) -> list[str]:
    return sorted({f for kind in identities for name in kind for f in features_of(name)})


def train(sample: DataFrame, n_features: int = FEATURES) -> tuple[list[str], np.ndarray, float]:
    """Features, weights and intercept from a bounded ``sample`` (doc_id, text, label)."""
    total = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, n_toxic = total[0], total[1] or 0
    if not 0 < n_toxic < n:
        return [], np.zeros(0), 40.0 if n and n_toxic else -40.0
    counts = sample.select("text", "label").mapInArrow(_count, "feature string, n long, n_toxic long")
    summed = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("t")).where(F.col("n") >= 4)

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    share = n_toxic / n
    clean, absent_toxic = F.col("n") - F.col("t"), F.lit(n_toxic) - F.col("t")
    absent_clean = F.lit(n - n_toxic) - clean
    absent = F.lit(n) - F.col("n")
    surprise = (part(F.col("t"), F.col("n") * share) + part(clean, F.col("n") * (1 - share))
                + part(absent_toxic, absent * share) + part(absent_clean, absent * (1 - share)))
    best = summed.orderBy(F.desc(surprise), "feature").limit(n_features).collect()
    features = sorted({r["feature"] for r in best} | set(identity_features()))

    narrow = sample.select("text", "label").mapInArrow(_index(features), "label int, a array<int>, b array<int>")
    rows = store(narrow.withColumn("order", F.xxhash64("a", "b")), "training")
    texts = rows.where("label IS NOT NULL").collect()
    swapped = rows.where("label IS NULL").orderBy("order", "a", "b").limit(SENTENCES).collect()
    texts.sort(key=lambda r: (r["order"], r["label"]))
    x = _sparse([r["a"] for r in texts], len(features))
    pairs = None
    if swapped:
        k = len(swapped)
        pairs = _sparse([r["a"] for r in swapped] + [r["b"] for r in swapped], len(features),
                        [1.0] * k + [-1.0] * k, [*range(k), *range(k)], k)
    y = np.array([r["label"] for r in texts], float)
    w, b = fit(x, y, RIDGE, pairs, PAIR_PENALTY, np.where(y > 0, TOXIC_WEIGHT, 1.0))
    return features, w, float(b)


def _score(weights, intercept):
    def run(batches):
        known = weights.value
        memo: dict[str, tuple] = {}
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                hit: set[str] = set()
                for word in words_in(text or ""):
                    found = memo.get(word)
                    if found is None:
                        found = memo[word] = tuple(f for f in features_of(word) if f in known)
                    if found:
                        hit.update(found)
                scores.append(float(sigmoid(intercept + math.fsum(known[f] for f in hit))))
            if len(memo) > MEMO_WORDS:
                memo.clear()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, trained_on: int = TRAINED_ON) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text), fitted on ``labels`` (doc_id, toxic).

    Only the text is scored.  At most ``trained_on`` labelled documents that are not held out are fitted on; a repeated label counts as toxic if one
    of them is, null labels are ignored.  Empty and null texts get the score of a text without known words.
    Without labels of both kinds every score is 0, or 1 if all are toxic.  Rows without doc_id are scored and held out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
             .where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(trained_on))
    sample = store(docs.join(F.broadcast(store(known, "labelled")), "doc_id"), "sample")  # at most trained_on rows
    features, w, b = train(sample)
    weights = spark.sparkContext.broadcast(dict(zip(features, w.tolist(), strict=True)))
    scored = docs.mapInArrow(_score(weights, b), "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
