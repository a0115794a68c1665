"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures, confirmed on full sets.

A signature is ``CHUNKS * WIDTH`` symbols of 8 bits, one per MinHash.  Two documents whose signatures differ in at most
``CHUNKS * (ERRORS + 1) - 1`` symbols have, by the pigeonhole principle, a chunk with at most ``ERRORS`` differences.  So each chunk is indexed once for every
choice of ``ERRORS`` symbols left out, and equal keys bring together every pair under that distance (and most pairs above it: for two
sets at similarity 0.8 the chance that no chunk qualifies is 3e-5, at 0.85 below 1e-6).

Work within a key: every member is confirmed against the smallest one (a star, linear in the members), components are formed, and only
members that are still in different components are compared with each other, block by block: on longer signatures, on shortened
sets, and what passes on full sets.  Equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marmita.llm.common import Memo, components, mixed, run_starts, runs, sequences, store, words_of

CHUNKS, WIDTH, ERRORS = 10, 6, 1
LONG = 256
BLOCK = 1024
ROWS = 4096


def multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHashes, 8 bits of each."""
    factors = multipliers(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), ROWS):
        part = shingles[start:start + ROWS, None]
        for k in range(0, n, 32):
            np.minimum(least[k:k + 32], (part * factors[None, k:k + 32]).min(0), out=least[k:k + 32])
    return mixed(least).astype(np.uint8)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each row, one per chunk and choice of left-out symbols; the two are part of the key."""
    chunks = signatures.reshape(len(signatures), CHUNKS, WIDTH).astype(np.uint64)
    keys = []
    for c in range(CHUNKS):
        for left_out in combinations(range(WIDTH), ERRORS):
            packed = np.full(len(signatures), len(keys) + 1, np.uint64)
            for i in range(WIDTH):
                if i not in left_out:
                    packed = (packed << np.uint64(8)) | chunks[:, c, i]
            keys.append(mixed(packed))
    return np.stack(keys, 1)


def shingle_sets(texts: list[str | None], size: int, memo: Memo) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles."""
    for text in texts:
        yield np.unique(sequences(memo.hashes(words_of(text, lower=True)), size))
    memo.trim()


def _sketches(size: int):
    def run(batches):
        memo = Memo()
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column("text").to_pylist(), size, memo):
                h = mixed(s + np.uint64(7)), mixed(s ^ np.uint64(0x5851F42D4C957F2D))
                rows.append((len(s), *(int(x.sum(dtype=np.uint64).astype(np.int64)) for x in h),
                             signature(s, CHUNKS * WIDTH).tobytes() if len(s) else b""))
            n, h1, h2, sig = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                pa.array(h2, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "text_hash", "n", "h1", "h2", "sig"])
    return run


def _explode(batches):
    for batch in batches:
        sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, CHUNKS * WIDTH)
        for start in range(0, batch.num_rows, ROWS):
            keys = index_keys(sigs[start:start + ROWS])
            nodes = batch.column("node").to_numpy()[start:start + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(nodes, keys.shape[1]))], ["key", "node"])


def _sets(size: int):
    def run(batches):
        memo = Memo()
        for batch in batches:
            sets = list(shingle_sets(batch.column("text").to_pylist(), size, memo))
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                pa.array([signature(s, LONG).tobytes() for s in sets], pa.binary()),
                pa.array([np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets], pa.binary())],
                ["node", "members", "sig", "short"])
    return run


def first_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For pairs of signatures: number of the first key that they share, -1 for none."""
    choices = list(combinations(range(WIDTH), ERRORS))
    differs = (left != right).reshape(len(left), CHUNKS, WIDTH)
    found = np.full(len(left), -1, np.int16)
    for c in reversed(range(CHUNKS)):
        for k, left_out in reversed(list(enumerate(choices))):
            rest = [i for i in range(WIDTH) if i not in left_out]
            found[~differs[:, c, rest].any(1)] = c * len(choices) + k
    return found


def nearly_shared(ask: np.ndarray, asked: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of one sorted set with each of some others."""
    flat = np.concatenate(asked)
    at = np.minimum(np.searchsorted(ask, flat), len(ask) - 1)
    return np.add.reduceat(ask[at] == flat, np.r_[0, np.cumsum([len(x) for x in asked])[:-1]], dtype=np.int64)


def _compare(need: int, percent: int):
    """Links of a block between different components: by signature, then by sets of 32-bit hashes.

    Each pair is compared at its first common key only.  Where a row is surely linked with a component one link says so; pairs so close to the threshold
    that shortened hashes could be wrong about them are all passed on.
    """
    def run(batches):
        for block in runs(batches, ["key", "qb", "tb"]):
            node, root, n = (block[c].to_numpy() for c in ("node", "root", "n"))
            query = block["query"].to_numpy(zero_copy_only=False).astype(bool)
            alone = block["alone"].to_numpy(zero_copy_only=False).astype(bool)
            sig = np.frombuffer(b"".join(block["sig"].to_pylist()), np.uint8).reshape(-1, LONG)
            short = [np.frombuffer(x, np.uint32) for x in block["short"].to_pylist()]
            ids = index_keys(sig[:, :CHUNKS * WIDTH])
            number = int(np.flatnonzero((ids == ids[:1]).all(0) & (ids[0] == np.uint64(block["key"][0].as_py() % 2**64)))[0])
            q, t = np.flatnonzero(query), np.flatnonzero(~query)
            left, right = [], []
            for start in range(0, len(q), 64):
                part = q[start:start + 64]
                # A pair of two rows that are both queries is met in both orders: the smaller node asks.
                ok = (root[part, None] != root[None, t]) & (~alone[None, t] | (node[part, None] < node[None, t]))
                small, large = np.minimum(n[part, None], n[None, t]), np.maximum(n[part, None], n[None, t])
                ok &= 100 * small >= percent * large
                if not ok.any():
                    continue
                same = np.zeros(ok.shape, np.int16)
                for k in range(0, LONG, 32):
                    same += (sig[part, None, k:k + 32] == sig[None, t, k:k + 32]).sum(2, dtype=np.int16)
                ok &= same >= need
                a, b = np.nonzero(ok)
                ok[a, b] = first_common(sig[part[a], :CHUNKS * WIDTH], sig[t[b], :CHUNKS * WIDTH]) == number
                for i in np.flatnonzero(ok.any(1)):
                    asks, others = part[i], t[ok[i]]
                    shared = nearly_shared(short[asks], [short[j] for j in others])
                    least = -(-percent * (n[asks] + n[others]) // (100 + percent))
                    slack = 1 + n[asks] * n[others] // 2**30
                    close = (shared >= least - slack) & (shared < least + slack)
                    sure = np.flatnonzero(shared >= least + slack)
                    sure = sure[np.unique(root[others[sure]], return_index=True)[1]]
                    found = others[np.r_[np.flatnonzero(close), sure]]
                    left += [node[asks]] * len(found)
                    right += node[found].tolist()
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    small = F.least(F.size("left"), F.size("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(right, "b").join(left, "a")
            .where(100 * small >= percent * F.greatest(F.size("left"), F.size("right")))
            .where(100 * shared >= percent * (F.size("left") + F.size("right") - shared))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Null or wordless texts have no shingles and are linked with nothing.  Rows that repeat a doc_id are judged by their own
    text and share one component.  A row without doc_id is linked with nothing, has no component and is kept.
    No rows give no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sketches = store(docs.mapInArrow(
        _sketches(shingle), "doc_id long, text_hash long, n long, h1 long, h2 long, sig binary"), "sketches")
    real = sketches.where("n > 0 AND doc_id IS NOT NULL")
    # A node is a set, not a doc_id, which can have several: numbered here and read by its smallest doc_id with one of its texts.
    groups = store(real.groupBy("n", "h1", "h2").agg(F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("sig").alias("sig"))
                   .select(F.monotonically_increasing_id().alias("node"), "n", "h1", "h2", "of.doc_id", "of.text_hash", "sig"), "groups")

    # Two different sets can only be similar enough from this size on.
    least = next(n for n in range(1, 1000) if 100 * n >= percent * (n + 1))
    keys = groups.where(F.col("n") >= least).select("node", "sig").mapInArrow(_explode, "key long, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("p"), F.count(F.lit(1)).alias("n_key")).where("n_key > 1")
    members = store(keys.join(shared, "key"), "members")

    wanted = members.select("node").distinct()
    read = groups.join(wanted, "node", "left_semi").select("node", "doc_id", "text_hash")
    # One text a node, also if rows repeat both its doc_id and its text.
    texts = docs.join(read, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("node", "text")
    sets = store(texts.mapInArrow(_sets(shingle), "node long, members array<long>, sig binary, short binary"), "sets")

    star = members.where("node != p").select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    links = store(_confirmed(star, sets, percent), "star")
    roots = store(components(links), "roots")

    more = store(_confirmed(_undecided(members, roots, sets, percent), sets, percent), "more")
    named = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    by_id = store(sketches.drop("sig", "text_hash").join(groups.select("n", "h1", "h2", "node"), ["n", "h1", "h2"], "left"), "by-id")
    same_id = by_id.where("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "node").distinct()
    several = same_id.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    linked = same_id.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a != b")
    final = store(components(named.unionByName(more).unionByName(linked)), "final")

    rooted = groups.select("node", "doc_id").join(final, "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root"))
    least_id = rooted.groupBy("root").agg(F.min("doc_id").alias("component"))
    by_id = by_id.join(rooted.select("node", "root").join(least_id, "root").select("node", "component"), "node", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return by_id.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _undecided(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a key and are still in different components.

    In each key, the rows outside its largest component ask all rows of the key.  Both sides are dealt into blocks of about ``BLOCK`` rows,
    so a key of any size is spread over tasks and no task holds more than one pair of blocks.
    """
    known = members.where("n_key > 2").join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"))
    per_root = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n_root"))
    per_key = (per_root.groupBy("key")
               .agg(F.max(F.struct("n_root", "root")).alias("main"), F.sum("n_root").alias("n_key"), F.count(F.lit(1)).alias("n_roots"))
               .where("n_roots > 1")
               .select("key", F.col("main.root").alias("main"),
                       F.ceil((F.col("n_key") - F.col("main.n_root")) / BLOCK).alias("qbs"),
                       F.ceil(F.col("n_key") / BLOCK).alias("tbs")))
    rows = known.join(per_key, "key").withColumn("alone", F.col("root") != F.col("main"))
    spread = F.xxhash64("node")
    asks = rows.where("alone").select(
        "key", "node", "root", "alone", F.pmod(spread, F.col("qbs")).alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("tbs") - 1)).alias("tb"), F.lit(True).alias("query"))
    asked = rows.select(
        "key", "node", "root", "alone", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)).alias("qb"),
        F.pmod(spread, F.col("tbs")).alias("tb"), F.lit(False).alias("query"))
    long = sets.select("node", "sig", "short", F.size("members").cast("long").alias("n"))
    blocks = asks.unionByName(asked).join(long, "node")
    need = int(LONG * percent / 100 - 4.5 * (LONG * percent / 100 * (1 - percent / 100)) ** 0.5)
    return (blocks.repartition("key", "qb", "tb").sortWithinPartitions("key", "qb", "tb")
            .mapInArrow(_compare(need, percent), "a long, b long").distinct())
