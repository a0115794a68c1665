"""Which openings conversations share: the trie of their turns, with figures per subtree.

A node is a distinct sequence of first turns.  Its key adds up hashes of (turn, place), so the keys of a conversation of any length are running sums,
taken in chunks.  Figures of subtrees come from an Euler tour: an arc enters and one leaves every node, each arc knows the next, and sums of
weights from an arc to the end of that list (its weighted rank) give a subtree as the difference between its two arcs.  The list is ranked in two steps:
blocks of neighbouring nodes first replace every stretch that stays in the block by its first arc, then the remaining arcs double their reach, round by round.

Groups that may hold a large share of all rows (a conversation, a node's children, the conversations that end in a node) are never met whole:
rows are numbered by range sorts, and windows run within a partition of such a sort or within a chunk of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marmita.llm.common import run_starts, runs, store

#: Turns of a conversation that one window, or one task of a join, meets.
CHUNK = 4096
#: Rows of a partition of a range sort, hence nodes of a block.
PARTITION_ROWS = 250_000
#: Parents with more than one child in so many nodes are sent to all tasks; there are fewer of them than this.
HOT_SHARE = 1000
KEY = ["k1", "k2", "k3", "k4", "depth"]
LOW = (1 << 32) - 1


def in_order(df: DataFrame, keys: list, rows: int, name: str) -> DataFrame:
    """``df`` written with ``at``, a number that grows in the order of ``keys``: partition of the sort * 2^33 + place in it."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))
    return store(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), name)


def block(at) -> F.Column:
    return F.shiftright(at, 33)


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` (conv_id, pos from 0, n of its conversation, content, n_chars) and ``convs`` (conv_id, n).

    Turns follow ``turn``, nulls first, equal ones role and text; null role or text is empty.  ``content`` is the SHA-256 of role and text, ``n_chars`` the
    code points of the text.  Rows without conv_id belong to no conversation and are left out.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where(
        "conv_id IS NOT NULL")
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    ordered = in_order(keyed, ["conv_id", "turn", "role", "text", "tie"], conversations.count(), "turns-in-order").select(
        "conv_id", "at", content.alias("content"), F.length("text").cast("long").alias("n_chars"))
    parts = store(ordered.groupBy("conv_id", block("at").alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")), "turn-parts")
    earlier = Window.partitionBy("conv_id").orderBy("part")
    places = (parts.withColumn("before", F.coalesce(F.sum("rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("n", F.sum("rows").over(Window.partitionBy("conv_id"))))
    turns = ordered.withColumn("part", block("at")).join(places, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n", "content", "n_chars")
    return store(turns, "turns"), parts.groupBy("conv_id").agg(F.sum("rows").alias("n"))


def with_shared_openings(turns: DataFrame, convs: DataFrame, most: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Each conversation c rebuilt: the first h turns of c - c % ``family`` (all if it has fewer, none if it doesn't exist), then its own after its
    first h; h = crc32(decimal c) % ``most``.  The remainder has the sign of c."""
    base = F.col("conv_id") - F.col("conv_id") % family
    own = convs.select("conv_id", F.col("n").alias("own"), base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    given = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    plan = own.join(given, "base", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0)))).withColumn(
        "n", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    plan = store(plan.select("conv_id", "base", "own", "h", "k", "n"), "rebuilding")
    spans = plan.select("conv_id", "h", "k", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("own") - 1) / CHUNK))).alias("chunk"))
    kept = (turns.drop("n").withColumn("chunk", F.floor(F.col("pos") / CHUNK)).join(spans, ["conv_id", "chunk"]).where("pos >= h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "n", "content", "n_chars"))
    openings = turns.where((F.col("pos") < most - 1) & (base == F.col("conv_id"))).select(F.col("conv_id").alias("base"), "pos", "content", "n_chars")
    shared = plan.where("k > 0").join(openings, "base").where("pos < k").select("conv_id", "pos", "n", "content", "n_chars")
    return store(kept.unionByName(shared), "rebuilt"), plan.select("conv_id", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """A row per turn: the key of the sequence that ends there (k1..k4, depth), the turn's own part of it (l1..l4), whether it is the last."""
    place = F.col("pos").cast("long")
    one, two = F.xxhash64("content", place), F.xxhash64(place, "content")
    lanes = turns.select("conv_id", place.alias("pos"), "n_chars", (place + 1 == F.col("n")).alias("last"), F.floor(place / CHUNK).alias("chunk"),
                         one.bitwiseAND(F.lit(LOW)).alias("l1"), F.shiftrightunsigned(one, 32).alias("l2"),
                         two.bitwiseAND(F.lit(LOW)).alias("l3"), F.shiftrightunsigned(two, 32).alias("l4"))
    up_to = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lanes.groupBy("conv_id", "chunk").agg(*(F.sum(f"l{i}").alias(f"o{i}") for i in range(1, 5)))
    offsets = offsets.select("conv_id", "chunk", *(F.sum(f"o{i}").over(earlier).alias(f"o{i}") for i in range(1, 5))).where("chunk > 0")
    sums = lanes.select("*", *(F.sum(f"l{i}").over(up_to).alias(f"s{i}") for i in range(1, 5)))
    return sums.join(offsets, ["conv_id", "chunk"], "left").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "n_chars", "last", "l1", "l2", "l3", "l4",
        *((F.col(f"s{i}") + F.coalesce(f"o{i}", F.lit(0))).alias(f"k{i}") for i in range(1, 5)))


def members_digest(ends: DataFrame, rows: int) -> DataFrame:
    """(key, ends_sha256) from ``ends`` (conv_id, key): SHA-256 of the ascending decimal conv_ids, joined by commas.

    A digest reads its ids in order, so it is one stream; the ids reach it as texts of up to a batch each, made where the range sort left them.
    """
    n = max(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))
    fields = ", ".join(f"{k} long" for k in KEY)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds = run_starts(*(batch.column(k).to_numpy() for k in KEY))
            ids = batch.column("conv_id").to_pylist()
            heads = batch.take(pa.array(bounds[:-1]))
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(heads.column(k) for k in KEY), heads.column("conv_id"), pa.array(texts, pa.string())],
                                             [*KEY, "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *new, piece in zip(*(batch.column(k).to_pylist() for k in KEY), batch.column("piece").to_pylist(), strict=True):
                if new == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = new, hashlib.sha256()
                state.update(piece.encode())
            yield as_batch(done)
        if key:
            yield as_batch([(*key, state.hexdigest())])

    def as_batch(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())], [*KEY, "ends_sha256"])

    order = [*KEY, "conv_id"]
    texts = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(pieces, f"{fields}, first long, piece string")
    return texts.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, f"{fields}, ends_sha256 string")


def contract(nodes: pa.Table) -> tuple[np.ndarray, ...]:
    """Stretches of the tour within a block of nodes (at, first_child, sibling, parent, leaf, saved), all of a range of ``at``.

    Arc 2 * at enters a node and 2 * at + 1 leaves it.  Returns per arc the first arc of its stretch and the weights (2 columns) of the stretch before it,
    and per stretch its first arc, the arc after it (-1: none) and its weights.
    """
    at, leaf, saved = (nodes.column(k).to_numpy() for k in ("at", "leaf", "saved"))
    child, sibling, parent = (nodes.column(k).fill_null(-1).to_numpy() for k in ("first_child", "sibling", "parent"))
    base, size = 2 * at[0], 2 * len(at)
    following = np.empty(size, np.int64)
    following[0::2] = np.where(child >= 0, 2 * child, 2 * at + 1)
    following[1::2] = np.where(sibling >= 0, 2 * sibling, np.where(parent >= 0, 2 * parent + 1, -1))
    weight = np.zeros((size, 2), np.int64)
    weight[0::2, 0], weight[0::2, 1] = leaf, saved
    inside = (following >= base) & (following < base + size)
    arcs = np.arange(size)
    jump = arcs.copy()
    jump[following[inside] - base] = arcs[inside]
    before = np.where((jump != arcs)[:, None], weight[jump], 0)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        before = before + before[jump]
        jump = further
    tails = arcs[~inside]
    return base + jump, before, base + jump[tails], following[tails], before[tails] + weight[tails]


def ranked(heads: DataFrame) -> DataFrame:
    """(arc, leaves, saved): weights from each arc of a list (arc, next, leaves, saved) to its end.

    Every round, an arc that has not reached the end adds what its next arc has reached; ``next`` is unique, so no row of a join meets many.
    """
    now = heads
    for _ in range(max(0, heads.count() - 1).bit_length()):
        reach = now.select(F.col("arc").alias("next"), F.col("next").alias("further"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        longer = now.where("next IS NOT NULL").join(reach, "next").select(
            "arc", F.col("further").alias("next"), (F.col("leaves") + F.col("more_leaves")).alias("leaves"),
            (F.col("saved") + F.col("more_saved")).alias("saved"))
        now = store(longer.unionByName(now.where("next IS NULL")), "tour-reach")
    return now.select("arc", "leaves", "saved")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per distinct sequence of first turns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` and ``convs`` as ``numbered`` returns them; conversations without turns are members of the root.  The last turn of the node is turn
    ``depth`` of its conv_id.  ``n_leaves`` counts childless nodes of the subtree, ``saved_tokens`` adds (n_convs - 1) * code points of the last turn over
    it, ``ends_sha256`` digests the members that end in the node.  Repeated conversations are members of the same nodes; texts of any length weigh one hash
    each; no conversations make no nodes.
    """
    steps = store(prefixes(turns), "prefixes")
    n_steps = steps.count()
    grouped = steps.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
                                      *(F.max(f"l{i}").alias(f"l{i}") for i in range(1, 5)))
    zeros = [F.lit(0).cast("long").alias(f"{p}{i}") for p in "kl" for i in range(1, 5)]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        "*", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_chars"), *zeros)
    above = [(F.col(f"k{i}") - F.col(f"l{i}")).alias(f"p{i}") for i in range(1, 5)]
    nodes = in_order(grouped.unionByName(root).select("*", *above, (F.col("depth") - 1).alias("p_depth")).drop("l1", "l2", "l3", "l4"),
                     ["conv_id", "depth"], n_steps, "trie-nodes")
    n_nodes = nodes.count()

    parent_key = ["p1", "p2", "p3", "p4", "p_depth"]
    kids = nodes.where("depth > 0").groupBy(*(F.col(p).alias(k) for p, k in zip(parent_key, KEY, strict=True))).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("at").alias("first_child"))
    tree = store(nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-tree")
    to_parent = [*(F.col(k).alias(p) for p, k in zip(parent_key, KEY, strict=True)), F.col("at").alias("parent"), F.col("conv_id").alias("parent_conv_id")]
    hot = tree.where(F.col("n_children") * HOT_SHARE > n_nodes).select(*to_parent)
    met = tree.where("depth > 0").join(F.broadcast(hot), parent_key, "left")
    others = met.where("parent IS NULL").drop("parent", "parent_conv_id").join(
        tree.where(F.col("n_children").between(1, n_nodes // HOT_SHARE)).select(*to_parent), parent_key)
    linked = met.where("parent IS NOT NULL").unionByName(others).unionByName(
        tree.where("depth = 0").withColumns({"parent": F.lit(None).cast("long"), "parent_conv_id": F.lit(None).cast("long")}))
    linked = store(linked.drop(*parent_key).withColumn("block", block("at")), "trie-links")

    following = F.lead("at").over(Window.partitionBy("parent", "block").orderBy("at"))
    firsts = linked.where("parent IS NOT NULL").groupBy("parent", "block").agg(F.min("at").alias("first"))
    later = firsts.select("parent", "block", F.lead("first").over(Window.partitionBy("parent").orderBy("block")).alias("later")).where("later IS NOT NULL")
    tour = linked.where("parent IS NOT NULL").withColumn("sibling", following).join(later, ["parent", "block"], "left").withColumn(
        "sibling", F.coalesce("sibling", "later")).drop("later").unionByName(
        linked.where("parent IS NULL").withColumn("sibling", F.lit(None).cast("long")))
    tour = tour.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_chars")})

    carried = [*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children"]
    added = ["enter", "leave", "leaves", "saved"]
    schema = T.StructType([T.StructField(k, T.LongType()) for k in [*carried, *added]] + [T.StructField("arc", T.LongType()), T.StructField("next", T.LongType())])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["block"]):
            table = table.combine_chunks()
            head, before, first, following, total = contract(table)
            n, m = len(table), len(first)
            change = before[1::2] - before[0::2]
            yield pa.RecordBatch.from_arrays(
                [table.column(k).combine_chunks() for k in carried]
                + [pa.array(x) for x in (head[0::2], head[1::2], change[:, 0], change[:, 1])] + [pa.nulls(n, pa.int64())] * 2, schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64())] * (len(carried) + 2)
                + [pa.array(total[:, 0]), pa.array(total[:, 1]), pa.array(first), pa.array(following, mask=following < 0)], schema.names)

    dealt = tour.select("at", "block", "first_child", "sibling", "parent", "leaf", "saved", *carried).repartition("block").sortWithinPartitions("at")
    walked = store(dealt.mapInArrow(stretches, schema), "tour-stretches")
    reach = ranked(walked.where("arc IS NOT NULL").select("arc", "next", "leaves", "saved"))
    inside = walked.where("arc IS NULL AND enter = leave")
    across = walked.where("arc IS NULL AND enter <> leave").select(*carried, *added)
    for side, sign in (("enter", 1), ("leave", -1)):
        across = across.join(reach.select(F.col("arc").alias(side), F.col("leaves").alias("all_leaves"), F.col("saved").alias("all_saved")), side).select(
            *carried, *(["leave"] if side == "enter" else []), (F.col("leaves") + sign * F.col("all_leaves")).alias("leaves"),
            (F.col("saved") + sign * F.col("all_saved")).alias("saved"))
    whole = inside.select(*carried, "leaves", "saved").unionByName(across)

    turnless = convs.where("n = 0").select("conv_id", *(F.lit(0).cast("long").alias(k) for k in KEY))
    ends = members_digest(steps.where("last").select("conv_id", *KEY).unionByName(turnless), n_steps)
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
