"""Product codes of vectors: per part position a codebook by Lloyd rounds over cover trees.

Vectors are met in blocks of a few thousand, each wherever it lies: no key decides, so no group can grow.  A block gets one cover tree per part
position, once, and is written with it.  A node of a tree is a point and the points around it: a contiguous range of the block in tree order, whose
sum is a difference of cumulative sums, and the distance of its farthest point.  In each round a node goes down only while the triangle inequality
leaves two entries open for it; a range with one possible entry is taken whole, and only the points of undecided leaves are compared one by one.
All arithmetic that decides is on integers, so neither blocks nor their order change a result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marmita.llm.common import store

#: Vectors of a block: what a task holds at a time.
BLOCK = 4096
#: A node of so few points is not divided further.
LEAF = 8
#: Points compared with all entries at a time.
COMPARED = 8192
#: Labels whose sums are sent to every task; with more of them the sums are joined by shuffle, each on SALTS keys.
SENT_LABELS = 10_000
SALTS = 32

Forest = NamedTuple("Forest", [("order", np.ndarray), ("points", np.ndarray), ("tree", np.ndarray), ("start", np.ndarray),
                               ("end", np.ndarray), ("child", np.ndarray), ("children", np.ndarray), ("radius2", np.ndarray)])
Codes = NamedTuple("Codes", [("rows", DataFrame), ("codebooks", list)])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.square(a - b).sum(-1)


def cover_forest(points: np.ndarray) -> Forest:
    """One cover tree for each of the ``points[tree]`` (trees, points, width), all grown together, a level at a time.

    The children of a node are a net of its points: its own point first, then each first point that is farther than half the node's radius from all
    before it.  A point belongs to the first child that covers it.
    """
    trees, n, width = points.shape
    flat = points.reshape(-1, width)
    order = np.arange(trees * n)
    tree = np.arange(trees)
    start, end = tree * n, (tree + 1) * n
    radius2 = np.zeros(trees, np.int64)
    if n:
        radius2 = squared(flat, np.repeat(flat[start], n, 0)).reshape(trees, n).max(1)
    levels = []
    while True:
        split = (end - start > LEAF) & (radius2 > 0)
        levels.append([tree, start, end, split, radius2])
        if not split.any():
            break
        parents = np.flatnonzero(split)
        sizes = end[parents] - start[parents]
        where = np.repeat(start[parents] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        items, owner = order[where], np.repeat(np.arange(len(parents)), sizes)
        limit = radius2[parents]
        net = np.zeros(len(items), np.int64)
        reach = np.zeros(len(items), np.int64)
        left, turn = np.arange(len(items)), 0
        while len(left):
            first = np.r_[True, owner[left][1:] != owner[left][:-1]]
            centre = items[left[first]][np.cumsum(first) - 1]
            d2 = squared(flat[items[left]], flat[centre])
            near = 4 * d2 <= limit[owner[left]]
            net[left[near]], reach[left[near]] = turn, d2[near]
            left, turn = left[~near], turn + 1
        by = np.lexsort((net, owner))
        order[where] = items[by]
        owner, net, reach = owner[by], net[by], reach[by]
        first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (net[1:] != net[:-1])])
        tree, start = tree[parents][owner[first]], where[first]
        end = start + np.diff(np.r_[first, len(owner)])
        radius2 = np.maximum.reduceat(reach, first)
        levels[-1].append(np.bincount(owner[first], minlength=len(parents)))
    child, children, below = [], [], 0
    for level in levels:
        below += len(level[0])
        counts = np.zeros(len(level[0]), np.int64)
        if len(level) > 5:
            counts[level[3]] = level[5]
        children.append(counts)
        child.append(below + np.cumsum(counts) - counts)
    tree, start, end, _, radius2 = (np.concatenate([level[i] for level in levels]) for i in range(5))
    return Forest(order, flat[order], tree, start, end, np.concatenate(child), np.concatenate(children), radius2)


def assign(forest: Forest, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of every point in tree order, sums (trees, entries, width), counts (trees, entries)) for ``codebooks`` (trees, entries, width)."""
    trees, entries, width = codebooks.shape
    total = np.r_[np.zeros((1, width), np.int64), np.cumsum(forest.points, 0)]
    sums, counts = np.zeros((trees * entries, width), np.int64), np.zeros(trees * entries, np.int64)
    chosen = np.zeros(len(forest.points), np.int64)
    nodes = np.arange(trees)
    single: list[np.ndarray] = []

    def take(start, end, tree, entry):
        slot = tree * entries + entry
        np.add.at(sums, slot, total[end] - total[start])
        np.add.at(counts, slot, end - start)

    while len(nodes):
        below = []
        for at in range(0, len(nodes), COMPARED):
            part = nodes[at:at + COMPARED]
            tree, start, end = forest.tree[part], forest.start[part], forest.end[part]
            d2 = squared(forest.points[start][:, None], codebooks[tree])
            best = d2.argmin(1)
            far, radius = np.sqrt(d2), np.sqrt(forest.radius2[part])
            nearest = far[np.arange(len(part)), best]
            # Rounding of the roots is far below this margin, which can only leave more entries open.
            open_entries = (far - radius[:, None] <= (nearest + radius)[:, None] * (1 + 1e-9) + 1e-6).sum(1)
            settled = (forest.radius2[part] == 0) | (open_entries == 1)
            take(start[settled], end[settled], tree[settled], best[settled])
            length = (end - start)[settled]
            chosen[spread(start[settled], length)] = np.repeat(best[settled], length)
            rest = part[~settled]
            inner = forest.children[rest] > 0
            below.append(spread(forest.child[rest[inner]], forest.children[rest[inner]]))
            leaves = rest[~inner]
            single.append(np.c_[spread(forest.start[leaves], size := forest.end[leaves] - forest.start[leaves]),
                                np.repeat(forest.tree[leaves], size)])
        nodes = np.concatenate(below)
    for one in single:
        for at in range(0, len(one), COMPARED):
            where, tree = one[at:at + COMPARED].T
            best = squared(forest.points[where][:, None], codebooks[tree]).argmin(1)
            chosen[where] = best
            take(where, where + 1, tree, best)
    return chosen, sums.reshape(codebooks.shape), counts.reshape(trees, entries)


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())


def whole_numbers(column: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, as (parts, vectors, width); missing components at the end are 0, huge ones are held to what fits."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), parts * width), np.int64)
    most = math.isqrt((1 << 61) // (parts * width))
    values = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale), -most, most)
    out[np.repeat(np.arange(len(column)), lengths), spread(np.zeros_like(lengths), lengths)] = values
    return out.reshape(len(column), parts, width).transpose(1, 0, 2)


PACKED = {"order": np.int32, "points": np.int32, "tree": np.int16, "start": np.int32, "end": np.int32, "child": np.int32,
          "children": np.int32, "radius2": np.int64}


def forest_of(row: dict, width: int) -> Forest:
    arrays = {k: np.frombuffer(row[k], t).astype(np.int64) for k, t in PACKED.items()}
    arrays["points"] = arrays["points"].reshape(-1, width)
    return Forest(**arrays)


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codes:
    """Codes of the ``vectors`` (vec_id, embedding, label), other columns unused: ``rows`` (vec_id, label, code, error) and ``codebooks``
    [part][entry][component].

    Rows whose vector is null or has a null or non-finite component are dropped.  A component x counts as floor(scale * x), vectors are
    cut into ``parts`` equal parts, and the first codebooks are the parts of the ``entries`` smallest vec_ids (fewer rows: fewer entries).
    Each round assigns all parts to their nearest entry, ties to the lower index, and moves each used entry to floor(sum / count).

    The longest vector, rounded up to a multiple of ``parts``, sets the length: shorter and empty ones count as ending in zeros.  Components beyond
    sqrt(2^61 / length) in size after scaling are held to it, so that distances fit 64 bits; very long vectors only make blocks larger.  Rows with a null or
    repeated vec_id are rows of their own (null ids come last, equal ids in the order of their vectors).  An empty table has no codes and no codebooks.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    clean = vectors.select("vec_id", "embedding", "label").where(x.isNotNull() & finite)
    longest = clean.agg(F.max(F.size(x))).first()[0]
    width = max(1, -(-(longest or 0) // parts))
    first = clean.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select(x.cast("array<double>").alias("embedding"))
    codebooks = whole_numbers(first.toArrow().column("embedding").combine_chunks(), parts, width, scale)

    fields = {f.name: f.dataType for f in clean.schema.fields}
    packed = T.StructType([T.StructField("vec_ids", T.ArrayType(fields["vec_id"])), T.StructField("labels", T.ArrayType(fields["label"]))]
                          + [T.StructField(k, T.BinaryType()) for k in PACKED])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            forest = cover_forest(whole_numbers(table.column("embedding").combine_chunks(), parts, width, scale))
            lists = [pa.ListArray.from_arrays([0, len(table)], table.column(k).combine_chunks()) for k in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays(
                lists + [pa.array([getattr(forest, k).astype(t).tobytes()], pa.binary()) for k, t in PACKED.items()],
                ["vec_ids", "labels", *PACKED])

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                waiting.append(batch.slice(at, BLOCK))
                if sum(b.num_rows for b in waiting) >= BLOCK:
                    yield block(pa.Table.from_batches(waiting))
                    waiting = []
        if waiting:
            yield block(pa.Table.from_batches(waiting))

    blocks = store(clean.mapInArrow(build, packed), "cover-trees")

    def totals(codebooks: np.ndarray) -> DataFrame:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    _, s, n = assign(forest_of(batch.slice(i, 1).to_pylist()[0], width), codebooks)
                    sums, counts = sums + s, counts + n
            part, entry, at = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
                 pa.array(sums[part, entry, at]), pa.array(counts[part, entry])], ["part", "entry", "at", "total", "n"])

        sent = blocks.select(*PACKED).mapInArrow(add, "part int, entry int, at int, total long, n long")
        return sent.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))

    for _ in range(rounds):
        moved = codebooks.copy()
        for row in totals(codebooks).collect():  # a row per component of the codebooks at most
            moved[row.part, row.entry, row.at] = int(row.total) // row.n
        codebooks = moved

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                forest = forest_of(one.select(list(PACKED)).to_pylist()[0], width)
                chosen, _, _ = assign(forest, codebooks)
                ids, labels = (one.column(k).flatten() for k in ("vec_ids", "labels"))
                tree, vector = np.divmod(forest.order, len(ids))
                code = np.zeros((len(ids), parts), np.int64)
                code[vector, tree] = chosen
                error = np.zeros(len(ids), np.int64)
                np.add.at(error, vector, squared(forest.points, codebooks[tree, chosen]))
                digits = np.array([f"{e:02x}" for e in range(codebooks.shape[1])])
                text = ["".join(c) for c in digits[code].tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)],
                                                 ["vec_id", "label", "code", "error"])

    schema = T.StructType([T.StructField("vec_id", fields["vec_id"]), T.StructField("label", fields["label"]),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return Codes(blocks.mapInArrow(encode, schema), codebooks.tolist())


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` and ``label_error``, the sum of error over the rows of equal label, nulls together.

    The sums are added up before they are shuffled and written; a few are sent to all tasks, more are joined with the rows of a label dealt
    over ``SALTS`` keys, so that no label gathers in a task.
    """
    sums = store(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    if sums.count() <= SENT_LABELS:
        return rows.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salted = sums.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    return dealt.join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("to"))).drop("of", "to", "salt")


def codebooks_sha256(codebooks: list) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(x) for part in codebooks for entry in part for x in entry).encode()).hexdigest()
