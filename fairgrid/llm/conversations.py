"""Prefix trie of conversations by fixed-length block digests, refined by turn only where siblings diverge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, key_groups

#: Turns of a block.
BLOCK = 8
#: Blocks over which digests are added up in one window; longer conversations add up the windows' totals.
BLOCKS_TOGETHER = 1024
#: Ids of 4,096 neighbouring numbers are one string before a node's ids are hashed.
_ID_BITS = 12
FAMILY = 5
HEADS = 9


def _in_order(df: DataFrame, *order) -> DataFrame:
    """``df`` written in a global order over range partitions, with ``g`` rising along it and ``part``, the partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns({"g": F.monotonically_increasing_id(), "part": F.spark_partition_id()})


def _before(totals: DataFrame, *sums: str) -> DataFrame:
    """``totals`` (part, sums): each sum over the lesser partitions. A row a partition, so one window and a broadcast."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select("part", *(F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums)))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, d1, d2, bytes) of ``rows`` (conv_id, turn, role, text): places from 1 by turn (null first), then role, then text.

    ``d1`` and ``d2`` are a 128-bit digest of role and text. Range partitions cut long conversations; the counts of a conversation's
    partitions give each part its first place.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit(7), text, role).alias("d2"), F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("at"),
    )
    turns = cut(_in_order(turns, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("at")).select("conv_id", "d1", "d2", "bytes", "g", "part"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("g").alias("g0")).withColumn("n_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = turns.join(parts.drop("n"), ["conv_id", "part"])
    return placed.select("conv_id", (F.col("n_before") + F.col("g") - F.col("g0") + 1).alias("pos"), "d1", "d2", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the heads of their families: (conv_id, length) and (conv_id, pos, d1, d2, bytes).

    The head of conversation c is the first h turns of c - c % 5 (all if fewer), h = crc32(c) % 9; c's own turns after its first h follow.
    """
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % HEADS
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    one = F.struct("pos", "d1", "d2", "bytes")
    heads = turns.where(F.col("conv_id") % FAMILY == 0).where(F.col("pos") < HEADS).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(one)).alias("head"))
    convs = lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left").withColumn("h", h)
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")))
    convs = cut(convs.select("conv_id", "head", "h", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")))
    first = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.d1", "t.d2", "t.bytes")
    own = turns.where(F.col("pos") > h).join(convs.select("conv_id", "h", F.size("head").alias("kept")), "conv_id")
    return convs.select("conv_id", "length"), first.union(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("kept")).alias("pos"), "d1", "d2", "bytes"))


def digest_blocks(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, t, p1, p2, e1, e2): each conversation's turns in blocks, with the digests of all turns before and up to its end.

    A turn's digest covers its place, so the exclusive or over places tells prefixes apart, and blocks are added up in any
    order. A conversation that ends with a full block (or is empty) has an empty block more: it is where it ends.
    """
    i = ((F.col("pos") - 1) % block + 1).cast("int").alias("i")
    turn = F.struct(i, F.xxhash64("pos", "d1", "d2").alias("e1"), F.xxhash64(F.lit(11), "d2", "d1", "pos").alias("e2"), "bytes")
    full = turns.select("conv_id", ((F.col("pos") - 1) / block).cast("long").alias("block"), turn.alias("turn")).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("turn")).alias("t"))
    end = convs.where(F.col("length") % block == 0).select("conv_id", (F.col("length") / block).cast("long").alias("block"), F.array().cast(full.schema["t"].dataType).alias("t"))
    x = lambda e: F.aggregate("t", F.lit(0).cast("long"), lambda s, y: s.bitwiseXOR(y[e]))
    blocks = full.union(end).withColumns({"x1": x("e1"), "x2": x("e2"), "stretch": (F.col("block") / BLOCKS_TOGETHER).cast("long")})
    blocks = cut(blocks)
    earlier = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, w: F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long"))
    stretches = blocks.groupBy("conv_id", "stretch").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    long_ones = stretches.select("conv_id", "stretch", *(xor(c, earlier(["conv_id"], "stretch")).alias(s) for c, s in (("x1", "s1"), ("x2", "s2")))).where("stretch > 0")
    within = earlier(["conv_id", "stretch"], "block")
    inside = blocks.withColumns({"p1": xor("x1", within), "p2": xor("x2", within)}).join(long_ones, ["conv_id", "stretch"], "left")
    p = [F.col(a).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long"))).alias(a) for a, b in (("p1", "s1"), ("p2", "s2"))]
    return inside.select("conv_id", "block", "t", *p, "x1", "x2").select("conv_id", "block", "t", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("e1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("e2"))


def _by_turn(blocks: DataFrame, block: int, *keep: str) -> DataFrame:
    """A row for each turn of ``blocks``: depth, i, digests of the prefix (h1, h2) and of that without the turn (q1, q2), bytes."""
    upto = lambda n, p, e: F.aggregate(F.slice("t", F.lit(1), n), F.col(p), lambda s, y: s.bitwiseXOR(y[e]))
    each = F.transform("t", lambda y: F.struct(y["i"].alias("i"), y["bytes"].alias("bytes"), upto(y["i"], "p1", "e1").alias("h1"), upto(y["i"], "p2", "e2").alias("h2"), upto(y["i"] - 1, "p1", "e1").alias("q1"), upto(y["i"] - 1, "p2", "e2").alias("q2")))
    return blocks.select(*keep, "block", F.explode(each).alias("y")).select(*keep, (F.col("block") * block + F.col("y.i")).alias("depth"), "y.i", "y.h1", "y.h2", "y.q1", "y.q2", "y.bytes")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each node over its ids' strings, which come in order; a string at a time is in memory."""
    last, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(("depth", "h1", "h2"), last, strict=True)) | {"ends_sha256": digest.hexdigest()}])

    for t in key_groups(batches, 4):  # one row each: node and stretch of ids
        for depth, h1, h2, _, ids in zip(*(c.to_pylist() for c in t.columns), strict=True):
            if (depth, h1, h2) != last:
                if last:
                    yield row()
                last, digest = (depth, h1, h2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if last:
        yield row()


def prefix_trie(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The prefix trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text), one row a node.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over the subtree), ends_sha256.

    Conversations are grouped by the digest of all turns before each block. Where all members of a group go on with one and the same
    block, its turns are nodes at once; only where they diverge are its turns grouped one by one. Every node is known by its
    smallest member. Conversations are then put in an order in which the members of a node are neighbours, its
    smallest member first (branches off a longer shared part come earlier, then smaller ids); nodes in that order, by depth,
    have their subtrees as one stretch behind them, so sums over subtrees are differences of global running sums. No step
    goes level by level, and no conversation, node or family is gathered: groups are combined before the shuffle, running
    sums take totals of range partitions.

    Turns with equal turn numbers go by role, then text; null role and text are empty; rows with a null conv_id are left out;
    repeated rows are turns of their own. Conversations that lose all turns are members of the root. Very long
    texts are only hashed, very long conversations are cut into parts. Digests have 128 bits. Further columns are left
    out. An empty table gives an empty result.
    """
    turns = cut(ordered_turns(rows))
    convs, rebuilt = rebuilt_turns(turns)
    blocks = cut(digest_blocks(convs, rebuilt, block))
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("e1", "e2")]
    groups = cut(blocks.groupBy("block", "p1", "p2").agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.first("t").alias("t"), (same[0] & same[1]).alias("shared")))

    apart = groups.where("not shared").select("block", "p1", "p2", F.col("rep").alias("group_rep"))
    members = cut(_by_turn(blocks.join(apart, ["block", "p1", "p2"]).select("conv_id", "group_rep", "block", "t", "p1", "p2"), block, "conv_id", "group_rep"))
    split = members.groupBy("depth", "h1", "h2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("i", "q1", "q2", "bytes", "group_rep")))
    split = cut(split)
    above = split.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("rep").alias("above"))
    split_nodes = split.join(above, ["depth", "q1", "q2"], "left").withColumn("parent", F.when(F.col("i") == 1, F.col("group_rep")).otherwise(F.col("above")))
    shared_nodes = _by_turn(groups.where("shared"), block, "rep", "n").withColumn("parent", F.col("rep"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")).where("n > 0").select("rep", zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "n", zero.alias("bytes"), F.lit(None).cast("long").alias("parent"))
    columns = ("rep", "depth", "h1", "h2", "n", "bytes", "parent")
    nodes = cut(root.union(shared_nodes.select(*columns)).union(split_nodes.select(*columns)))

    # The order of conversations: along a conversation, where its nodes' smallest member changes.
    first_rep = convs.agg(F.min("conv_id").alias("first_rep"))  # one row
    turnings = members.join(split.select("depth", "h1", "h2", "rep"), ["depth", "h1", "h2"]).groupBy("conv_id", "rep").agg(F.min("depth").alias("depth"))
    turnings = turnings.join(F.broadcast(first_rep)).where("rep <> first_rep")
    paths = turnings.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "rep"))).alias("path"), F.max(F.struct("depth", "rep"))["rep"].alias("last"))
    ended = convs.join(paths, "conv_id", "left").join(F.broadcast(first_rep)).withColumn("last", F.coalesce("last", "first_rep"))
    path = F.coalesce("path", F.array().cast("array<struct<depth:bigint,rep:bigint>>"))
    tail = F.when(F.col("last") == F.col("conv_id"), F.array().cast("array<struct<depth:bigint,rep:bigint>>")).otherwise(F.array(F.struct((F.col("length") + 1).alias("depth"), F.col("conv_id").alias("rep"))))
    key = F.transform(F.concat(path, tail), lambda y: F.struct((-y["depth"]).alias("up"), y["rep"].alias("rep")))
    order = cut(_in_order(ended.select("conv_id", key.alias("key")), F.col("key"), F.col("conv_id")).select("conv_id", "g", "part"))
    starts = order.groupBy("part").agg(F.count("*").alias("n"), F.min("g").alias("g0"))
    ranks = order.join(_before(starts, "n"), "part").join(F.broadcast(starts.select("part", "g0")), "part").select("conv_id", (F.col("n_before") + F.col("g") - F.col("g0")).alias("rank"))
    ranks = cut(ranks)

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    ends = blocks.where(F.size("t") < block).select((F.col("block") * block + F.size("t")).alias("depth"), F.col("e1").alias("h1"), F.col("e2").alias("h2"), F.shiftright("conv_id", _ID_BITS).alias("ids_at"), "conv_id")
    ends = ends.groupBy("depth", "h1", "h2", "ids_at").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ends = ends.repartition("depth", "h1", "h2").sortWithinPartitions("depth", "h1", "h2", "ids_at").mapInArrow(_hash_ids, "depth long, h1 long, h2 long, ends_sha256 string")
    told = nodes.join(children, ["rep", "depth"], "left").join(ends, ["depth", "h1", "h2"], "left").join(ranks.withColumnRenamed("conv_id", "rep"), "rep")
    told = told.select(
        "rep", "depth", "parent", "n", "rank", F.coalesce("n_children", zero).alias("n_children"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
    )

    # Running sums over nodes in order, with a mark behind each conversation's nodes.
    mark = ranks.select(F.lit(None).cast("long").alias("rep"), F.lit((1 << 63) - 1).alias("depth"), F.lit(None).cast("long").alias("parent"), zero.alias("n"), "rank", zero.alias("n_children"), F.lit("").alias("ends_sha256"), zero.alias("leaf"), zero.alias("saved"))
    line = cut(_in_order(told.union(mark), F.col("rank"), F.col("depth")))
    inside = Window.partitionBy("part").orderBy("g").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumns({c: F.sum(c).over(inside) - F.col(c) for c in ("leaf", "saved")}).join(_before(line.groupBy("part").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")), "leaf", "saved"), "part")
    line = cut(line.withColumns({"leaf": F.col("leaf") + F.col("leaf_before"), "saved": F.col("saved") + F.col("saved_before")}))
    behind = line.where("rep is null").select(F.col("rank").alias("last"), F.col("leaf").alias("leaf_to"), F.col("saved").alias("saved_to"))
    whole = line.where("rep is not null").withColumn("last", F.col("rank") + F.col("n") - 1).join(behind, "last")
    return whole.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", (F.col("leaf_to") - F.col("leaf")).alias("n_leaves"), (F.col("saved_to") - F.col("saved")).alias("saved_tokens"), "ends_sha256",
    )
