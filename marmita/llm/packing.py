"""Packing of token pieces into sequences of a fixed size by a grouping genetic algorithm on islands.

Pieces of one length can stand for each other, so a solution is a set of bin patterns (how many pieces of which length a bin holds) with the number of
bins of each: at most one entry per length goes into the search, whatever the number of pieces.  An individual is such a solution.  Its offspring inherits whole
well-filled bins of one parent; bins of the other that would use a piece twice are removed, and the pieces they leave are placed best-fit, the longest first.
Every island is a Spark task with a population of its own; after each epoch its best solution moves to the next island.  Pieces are then ranked within
their length by a range sort, and each finds its bin and place among the runs of the best solution.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marmita.llm.common import store
from marmita.llm.prefix_trie import block, in_order
from marmita.llm.token_output import ENCODED_TOGETHER, worker_encoder

ISLANDS = 6
POPULATION = 8
OFFSPRING = 20
EPOCHS = 3
#: An offspring of more patterns is not taken up; the best-fit solutions of the first population have a few for each length.
PATTERNS = 16_384

PIECES = "row long, doc_id long, piece int, start long, length int, ids binary"

#: (length, pieces of it) pairs, longest first; a solution maps patterns to how many bins have them.
Pattern = tuple[tuple[int, int], ...]
Solution = dict[Pattern, int]


def token_pieces(docs: DataFrame, tokenizer_json: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces (row, doc_id, piece, start, length, ids) of the texts of ``docs`` (doc_id, text), written and read back.

    A document is its ids and ``end_id``.  One of more than ``size`` tokens is cut into pieces of ``size``, of which the first may be shorter; ``start``
    counts the document's ids before a piece, ``ids`` are little-endian uint32 and ``row`` is unique.  A null or empty text is the end id alone, repeated rows and
    null doc_ids are documents of their own, a very long text is encoded alone, no rows make no pieces; other columns are ignored.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(tokenizer_json)
        end, row = np.array([end_id], "<u4"), TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= ENCODED_TOGETHER):
                    chars += len(texts[stop])
                    stop += 1
                columns: list[list] = [[], [], [], [], []]
                for doc_id, encoded in zip(doc_ids[at:stop], encoder.encode(texts[at:stop]), strict=True):
                    raw, n = encoded.astype("<u4", copy=False).tobytes() + end.tobytes(), len(encoded) + 1
                    starts = [0, *range(n % size or size, n, size)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        for column, value in zip(columns, (doc_id, piece, a, b - a, raw[4 * a:4 * b]), strict=True):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                made = len(columns[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + made)), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                                                 ["row", "doc_id", "piece", "start", "length", "ids"])
                row, at = row + made, stop

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return store(texts.mapInArrow(cut, PIECES), "pieces")


def load(pattern: Pattern) -> int:
    return sum(length * number for length, number in pattern)


def best_fit(bins: Solution, items: list[tuple[int, int]], size: int) -> Solution:
    """``bins`` and as many further ones as ``items`` (length, number) need: each piece goes into the fullest bin that has room for it.

    A bin stays the fullest as long as it takes another piece of the same length, so equal bins are filled together.
    """
    room: dict[int, list[tuple[Pattern, int]]] = {}
    free: list[int] = []

    def put(left: int, pattern: Pattern, times: int) -> None:
        if times:
            if not room.setdefault(left, []):
                insort(free, left)
            room[left].append((pattern, times))

    for pattern, times in bins.items():
        put(size - load(pattern), pattern, times)
    for length, number in items:
        while number:
            i = bisect_left(free, length)
            if i == len(free):
                most = size // length
                full, rest = divmod(number, most)
                put(size - most * length, ((length, most),), full)
                if rest:
                    put(size - rest * length, ((length, rest),), 1)
                break
            left = free[i]
            pattern, times = room[left].pop()
            if not room[left]:
                del free[i]
            most = left // length
            filled = min(times, number // most)
            put(left - most * length, (*pattern, (length, most)), filled)
            number, times = number - filled * most, times - filled
            if times and number:
                put(left - number * length, (*pattern, (length, number)), 1)
                number, times = 0, times - 1
            put(left, pattern, times)
    solution: Solution = {}
    for groups in room.values():
        for pattern, times in groups:
            merged: dict[int, int] = {}
            for length, number in pattern:
                merged[length] = merged.get(length, 0) + number
            key = tuple(sorted(merged.items(), reverse=True))
            solution[key] = solution.get(key, 0) + times
    return solution


def fill_exactly(loose: dict[int, int], size: int, rng: random.Random) -> Solution:
    """Bins of two or three of the ``loose`` pieces (length -> number, taken from) that are exactly full, the longest pieces first."""
    have = np.zeros(size + 1, np.int64)
    have[list(loose)] = list(loose.values())
    bins: Solution = {}
    for length in sorted(loose, reverse=True):
        rest = size - length
        while have[length] and rest:
            have[length] -= 1  # the piece itself cannot complete its bin
            short = np.flatnonzero(have[:rest // 2 + 1])
            pairs = short[(have[rest - short] > 0) & ((rest != 2 * short) | (have[short] > 1))]
            have[length] += 1
            if have[rest] - (rest == length) > 0 and rest <= length:
                others = [rest]
            elif len(pairs):
                others = [int(x := pairs[rng.randrange(len(pairs))]), rest - int(x)]
            else:
                break
            pattern = tuple(sorted(Counter([length, *others]).items(), reverse=True))
            times = int(min(have[x] // n for x, n in pattern))
            bins[pattern] = bins.get(pattern, 0) + times
            for x, n in pattern:
                have[x] -= n * times
    for length in loose:
        loose[length] = int(have[length])
    return bins


def fitness(solution: Solution, size: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, those with the fuller bins, by the mean square of their fill."""
    bins = sum(solution.values())
    return -bins, sum(times * (load(p) / size) ** 2 for p, times in solution.items()) / max(1, bins)


def crossover(left: Solution, right: Solution, counts: dict[int, int], size: int, rng: random.Random) -> Solution:
    """``left`` with some well-filled bins of ``right``: its own bins give way, the emptiest first, where a piece would be used twice, and what they
    leave is placed best-fit."""
    unused = dict(counts)
    child: Solution = {}
    share = rng.uniform(0.2, 0.8)
    least = load(sorted(right, key=load)[len(right) // 2]) if right else 0

    def take(pattern: Pattern, times: int) -> None:
        for length, number in pattern:
            times = min(times, unused[length] // number)
        if times:
            child[pattern] = child.get(pattern, 0) + times
            for length, number in pattern:
                unused[length] -= times * number

    for pattern, times in right.items():
        if load(pattern) >= least and rng.random() < share:
            take(pattern, times if rng.random() < 0.7 else rng.randint(1, times))
    for pattern, times in sorted(left.items(), key=lambda p: (-load(p[0]), rng.random())):
        take(pattern, times)
    return placed(child, unused, size, rng, 0.0)


def mutate(solution: Solution, size: int, rng: random.Random) -> Solution:
    """``solution`` with its unfilled bins, and some others, emptied and their pieces placed best-fit in a slightly different order."""
    kept: Solution = {}
    loose: dict[int, int] = {}
    for pattern, times in solution.items():
        gone = rng.random() < (0.7 if load(pattern) < size else 0.05)
        if not gone:
            kept[pattern] = times
            continue
        for length, number in pattern:
            loose[length] = loose.get(length, 0) + times * number
    return placed(kept, loose, size, rng, 0.1)


def placed(bins: Solution, loose: dict[int, int], size: int, rng: random.Random, disturbed: float) -> Solution:
    """``bins`` and the ``loose`` pieces: sometimes those first that fill bins exactly, the others best-fit, the longest first or nearly so."""
    if rng.random() < 0.5:
        bins = dict(bins)
        for pattern, times in fill_exactly(loose, size, rng).items():
            bins[pattern] = bins.get(pattern, 0) + times
    return best_fit(bins, sorted(((x, n) for x, n in loose.items() if n), key=lambda p: -p[0] * rng.uniform(1 - disturbed, 1 + disturbed)), size)


def first_solution(counts: dict[int, int], size: int, rng: random.Random, member: int) -> Solution:
    """Best fit, the longest first; for other members in a disturbed order, some after exactly full bins are made."""
    if not member:
        return best_fit({}, sorted(counts.items(), reverse=True), size)
    return placed({}, dict(counts), size, rng, 0.02 * member)


def evolve(population: list[Solution], counts: dict[int, int], size: int, seed: str) -> list[Solution]:
    """An epoch of an island: offspring of parents that won against another take the place of the worst if they are better.  Best first."""
    rng = random.Random(seed)
    needed = -(-sum(x * n for x, n in counts.items()) // size)
    scored = sorted(((fitness(s, size), i, s) for i, s in enumerate(population)), key=lambda x: x[:2], reverse=True)
    scored = scored[:POPULATION]
    for born in range(OFFSPRING):
        if -scored[0][0][0] <= needed:
            break
        one, two = (min(rng.sample(range(len(scored)), min(2, len(scored)))) for _ in range(2))
        child = crossover(scored[one][2], scored[two][2], counts, size, rng) if one != two else mutate(scored[one][2], size, rng)
        score = fitness(child, size)
        if len(child) <= PATTERNS and all(score != s[0] for s in scored) and (len(scored) < POPULATION or score > scored[-1][0]):
            scored = sorted([*scored, (score, len(population) + born, child)], key=lambda x: x[:2], reverse=True)[:POPULATION]
    return [s for _, _, s in scored]


def packed(solution: Solution) -> bytes:
    flat = [x for pattern, times in solution.items() for x in (times, len(pattern), *(y for pair in pattern for y in pair))]
    return np.array(flat, "<i8").tobytes()


def unpacked(data: bytes) -> Solution:
    flat, at, solution = np.frombuffer(data, "<i8").tolist(), 0, {}
    while at < len(flat):
        times, n = flat[at:at + 2]
        solution[tuple((flat[i], flat[i + 1]) for i in range(at + 2, at + 2 + 2 * n, 2))] = times
        at += 2 + 2 * n
    return solution


def search(spark, counts: dict[int, int], size: int) -> Solution:
    """The best solution after all epochs; reruns agree.  Stops early where no solution could have fewer bins."""
    needed = -(-sum(x * n for x, n in counts.items()) // size)
    schema = "island int, member int, bins long, fill double, solution binary"

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            islands: dict[int, list[tuple[int, bytes]]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    islands.setdefault(row["island"], []).append((row["member"], row["solution"]))
            for island, members in sorted(islands.items()):
                rng = random.Random(f"first {island}")
                start = [unpacked(s) if s is not None else first_solution(counts, size, rng, m + 2 * (island > 0))
                         for m, s in sorted(members, key=lambda x: (x[0], x[1] or b""))]
                for member, solution in enumerate(evolve(start, counts, size, f"{number} {island}")):
                    score = fitness(solution, size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([island], pa.int32()), pa.array([member], pa.int32()), pa.array([-score[0]], pa.int64()), pa.array([score[1]]),
                         pa.array([packed(solution)], pa.binary())], ["island", "member", "bins", "fill", "solution"])
        return run

    now = spark.range(ISLANDS * POPULATION).select(
        (F.col("id") % ISLANDS).cast("int").alias("island"), F.floor(F.col("id") / ISLANDS).cast("int").alias("member"), F.lit(None).cast("binary").alias("solution"))
    for number in range(EPOCHS):
        now = store(now.repartitionByRange(ISLANDS, "island").mapInArrow(epoch(number), schema), "islands")
        best = now.orderBy("bins", F.col("fill").desc(), "island", "member").first()
        if best.bins <= needed or not counts:
            break
        elite = now.where("member = 0").withColumns({"island": ((F.col("island") + 1) % ISLANDS).cast("int"), "member": F.lit(POPULATION)})
        now = now.unionByName(elite).select("island", "member", "solution")
    return unpacked(best.solution)


def runs_of(solution: Solution) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> (first rank, pieces a bin, first bin, offset) of its runs, by rank: piece number r of a length, counted from the run's first rank, is in
    bin first + r // pieces, at offset + (r % pieces) * length."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    bins = 0
    for pattern, times in sorted(solution.items(), reverse=True):
        offset = 0
        for length, number in pattern:
            runs.setdefault(length, []).append((used.get(length, 0), number, bins, offset))
            used[length] = used.get(length, 0) + times * number
            offset += length * number
        bins += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in runs.items()}


def pack(items: DataFrame, size: int = 2048) -> DataFrame:
    """``items`` with sequence_id and offset: in as few sequences of at most ``size`` tokens as the search finds, without gaps from offset 0.

    ``items`` has a column ``length`` of 1 to ``size``, and any others (earlier columns sequence_id and offset are replaced).  Only the number of items per length, at
    most ``size`` rows, and the best solution pass through the driver.  Which of several items of equal length gets which place is arbitrary; no items
    make no sequences.
    """
    spark = items.sparkSession
    items = items.drop("sequence_id", "offset")
    whole = items.select(F.struct("*").alias("item"), F.col("length").cast("long").alias("length")).withColumn("tie", F.monotonically_increasing_id())
    counts = {row.length: row.n for row in whole.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(x is None or not 1 <= x <= size for x in counts):
        raise ValueError(f"lengths must be from 1 to {size}")
    full = counts.pop(size, 0)
    runs = runs_of(search(spark, counts, size))

    ordered = in_order(whole.where(F.col("length") < size), ["length", "tie"], sum(counts.values()), "pieces-by-length").withColumn("part", block("at"))
    parts = ordered.groupBy("length", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("length", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    ranks = ordered.join(begins, ["length", "part"]).select("item", "length", (F.col("at") + F.col("shift")).alias("rank"))
    schema = T.StructType([ranks.schema["item"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                first, number, bins, begin = runs[int(one)]
                run = np.searchsorted(first, rank[mine], "right") - 1
                turn, place = np.divmod(rank[mine] - first[run], number[run])
                sequence[mine], offset[mine] = bins[run] + turn, begin[run] + place * one
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(sequence), pa.array(offset)], schema.names)

    alone = F.lit(2 * sum(counts.values())) + F.monotonically_increasing_id()  # behind all shared sequences
    placed = ranks.mapInArrow(place, schema)
    if full:
        placed = placed.unionByName(whole.where(F.col("length") == size).select("item", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return placed.select("item.*", "sequence_id", "offset")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, rows, offsets): the packed sequences themselves, ids as little-endian uint32, from ``pieces`` (row, ids) and their places
    (row, sequence_id, offset)."""
    meet = pieces.select("row", "ids").join(placed.select("row", "sequence_id", "offset"), "row")
    inside = F.sort_array(F.collect_list(F.struct("offset", "row", "ids")))
    return meet.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id", F.aggregate("inside.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("inside.row").alias("rows"), F.col("inside.offset").alias("offsets"))
