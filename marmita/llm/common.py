"""What several operators share: written tables, words, hashed word sequences, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marmita.session import shared_folder

BREAKS = r"[\x20\x09-\x0D]+"
MEMO_WORDS = 400_000


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back: lineage ends at files every executor sees."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased on request.

    Bytes split at just these six characters, and only A-Z have another case.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def n_words(text) -> F.Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for a null."""
    return F.coalesce(F.size(F.filter(F.split(text, BREAKS), lambda w: w != "")), F.lit(0)).cast("long")


def held_out(doc_id) -> F.Column:
    """The fifth of all ids that no label is learned from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


class Memo(dict):
    """word -> 64-bit hash, filled as words are met; ``trim`` between batches bounds its size."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def trim(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; fewer words make one run of their own length, none makes none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = mixed(total ^ hashes[i:i + n]) + np.uint64(i + 1)
    return total


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Index of the first row of every run of equal rows, plus the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for column in columns:
        change |= column[1:] != column[:-1]
    return np.r_[0, np.flatnonzero(change) + 1, n]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that arrive sorted by ``keys``, one table per key; only the open key is kept in memory."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        bounds = run_starts(*columns)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[start] for c in columns)
            if key != last and pending:
                yield pa.Table.from_batches(pending)
                pending = []
            last = key
            pending.append(batch.slice(start, end - start))
    if pending:
        yield pa.Table.from_batches(pending)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): root is the smallest node that it reaches.

    Large-star and small-star rounds: each moves neighbours to the smallest one known, by aggregation and joins only,
    so no group of nodes meets in one task.  Every round is a written table.  No edges give no rows.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    now = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        now = store(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
