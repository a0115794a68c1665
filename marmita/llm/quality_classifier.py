"""Quality by hierarchical empirical Bayes: what a document shows, and what its path and host have shown.

A logistic classifier on counted properties of a text gives the document's evidence.  Good shares are then estimated for each host and each path
below it: grouped sums, shrunk towards the level above by as many pseudo-documents as the spread between sites
suggests (moments of a beta distribution).  A site with few documents stays near the global share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.llm.common import held_out, store
from marmita.llm.linear import Sparse, fit

#: Labelled documents that the classifier is fitted on at most, by hash order of their ids.
TRAINED_ON = 20_000
RIDGE = 1e-4
#: Pseudo-documents of a prior: at least, and at most.
LEAST, MOST = 2.0, 1000.0
#: A path moves a document's log-odds by this at most: a site can tip a doubtful text, not overrule a clear one.
TIP = 1.0

PROPERTIES = ("length", "word_length", "symbols", "stops", "digits", "capitals", "exclaims", "repeated_lines",
              "different_words", "common_word", "joined_symbols")


def properties(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    seen = set(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    letters = max(1, size - text.count(" "))
    return [
        np.log1p(len(words)) / 10, letters / n / 10,
        min(1.0, 10 * symbols / size), sum(text.count(c) for c in ".,;:?") / size * 10,
        sum(text.count(c) for c in "0123456789") / size * 5, sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / letters * 5,
        min(1.0, text.count("!") / n * 5), 1 - len(set(lines)) / max(1, len(lines)), len(seen) / n,
        1.0 if len(words) > 20 and len(seen) / n < 0.4 else 0.0, 1.0 if symbols > 0.02 * size else 0.0,
    ]


def _evidence(batches):
    for batch in batches:
        rows = [properties(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(rows, pa.list_(pa.float64()))],
            [*(c for c in batch.schema.names if c != "text"), "x"])


def _strength(sites: DataFrame, centre) -> float:
    """Pseudo-documents of a prior around ``centre``, by moments: little spread between sites (n, good) means a strong prior."""
    weight, noise = F.sum("n"), F.sum(centre * (1 - centre))
    spread = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - centre, 2))
    mean = F.sum(F.col("n") * centre * (1 - centre)) / weight
    excess = F.greatest((spread - noise) / weight, F.lit(1e-9))
    found = sites.agg((mean / excess - 1).alias("k")).first()["k"]
    return min(MOST, max(LEAST, found if found is not None else MOST))


def posteriors(sites: DataFrame) -> DataFrame:
    """(host, path, n, global_share, host_share, share) from ``sites`` (host, path, n, good), one row per path.

    Numbers and single rows only reach the driver.  A null host or path is a site of its own.
    """
    total = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    centre = F.lit(((total["good"] or 0.0) + 1) / ((total["n"] or 0) + 2))
    hosts = sites.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k_host = _strength(hosts, centre)
    host = hosts.select(F.col("host").alias("above"),
                        ((F.col("good") + k_host * centre) / (F.col("n") + k_host)).alias("host_share"))
    below = sites.join(host, F.col("host").eqNullSafe(F.col("above"))).drop("above")
    k_path = _strength(below, F.col("host_share"))
    return below.select(
        "host", "path", "n", centre.alias("global_share"), "host_share",
        ((F.col("good") + k_path * F.col("host_share")) / (F.col("n") + k_path)).alias("share"))


def _fitted(sample: DataFrame) -> tuple[np.ndarray, float]:
    rows = sorted((tuple(r["x"]), r["label"]) for r in sample.select("x", "label").collect())  # at most TRAINED_ON
    y = np.array([label for _, label in rows], float)
    if not len(y) or y.min() == y.max():
        return np.zeros(len(PROPERTIES)), 0.0 if not len(y) else (20.0 if y[0] else -20.0)
    values = np.array([x for x, _ in rows])
    n, m = values.shape
    dense = Sparse(np.repeat(np.arange(n), m), np.tile(np.arange(m), n), values.ravel(), (n, m))
    return fit(dense, y, RIDGE)


def quality_scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
                   trained_on: int = TRAINED_ON) -> DataFrame:
    """(doc_id, held_out, evidence, share, score, predicted, kept) for every row of ``docs`` (doc_id, text, ``host``, ``path``).

    evidence is the classifier's probability from the text alone, share the posterior of the document's path, score both together: the
    log-odds of the evidence, moved by how far the path's log-odds are from the global ones.  labels (doc_id, quality): 1 is
    good; held-out labels are not used, a repeated label counts as good only if all are, null labels are ignored.
    Null texts are scored as empty.  Null hosts and paths are sites.  Repeated rows are scored alike.  Without
    labels of both kinds the evidence is the same for all.  No rows give no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"))
    shown = store(docs.mapInArrow(_evidence, "doc_id long, host string, path string, x array<double>"), "evidence")
    known = store(
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
        .where(~held_out("doc_id")), "labelled")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trained_on)
    w, b = _fitted(shown.join(sample, "doc_id"))
    logit = F.lit(float(b))
    for i, value in enumerate(w.tolist()):
        logit = logit + F.col("x")[i] * F.lit(value)
    evidence = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), logit))))
    judged = shown.select("doc_id", "host", "path", evidence.alias("evidence"))

    # A site is judged by all of its documents: by the label where one was learned from, else by the evidence.
    weighed = judged.join(known, "doc_id", "left")
    sites = store(weighed.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("label").cast("double"), F.col("evidence"))).alias("good")), "sites")
    shares = posteriors(sites).select(F.col("host").alias("h"), F.col("path").alias("p"), "global_share", "share")
    both = judged.join(shares, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))

    def odds(p):
        inside = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), p))
        return F.log(inside / (1 - inside))

    tip = F.greatest(F.lit(-TIP), F.least(F.lit(TIP), odds(F.col("share")) - odds(F.col("global_share"))))
    score = 1 / (1 + F.exp(-(odds(F.col("evidence")) + tip)))
    return both.select("doc_id", held_out("doc_id").alias("held_out"), "evidence", "share", score.alias("score")).select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"))
