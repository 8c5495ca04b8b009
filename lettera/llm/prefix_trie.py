"""Prefix trie of conversations by ROLLUP over columns of turns.

A conversation is laid out in blocks of `BLOCK` columns, one for each turn. ROLLUP over these columns groups
by every prefix of a block at once, and grouping_id tells its length. Longer conversations go on in further
rows, which are keyed by the node that their previous block ends in. Sums over subtrees are a second ROLLUP, over
nodes; what lies in later blocks is passed up between blocks first, by doubling distances.

A turn is known by 128 bits of hashes of its SHA-256 and its place; a node by the exclusive or of its turns.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .turns import numbered, signature

#: Turns of a block, that is, columns of the ROLLUP.
BLOCK = 8
#: About so many ids are joined before they go to the task that hashes a node's list.
CHUNK_IDS = 1024
_TURNS = [f"t{j}" for j in range(1, BLOCK + 1)]
_NODE = ["depth", "x1", "x2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, sig, size): the turns of each conversation, counted from 1 in the order of `turn`, null first.

    `sig` is the SHA-256 of role and text, `size` the bytes of the text; null role and text are empty. Rows with equal
    turns are ordered by `sig`. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return numbered(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), signature(role, text).alias("sig"),
        F.octet_length(text).cast("long").alias("size"))).select("conv_id", "place", "sig", "size")


def with_shared_starts(placed: DataFrame, stride: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that start as a neighbour does: their turns (conv_id, place, sig, size), and their ids.

    Conversation c takes the first h turns of conversation c - c % stride, and goes on with its own after its first h; h is
    crc32 of the decimal id modulo `most` + 1. A neighbour that isn't there gives none.
    """
    counts = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = lambda c: c - c % stride
    convs = counts.select("conv_id", "n", base(F.col("conv_id")).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h"))
    convs = stored(convs.join(counts.toDF("base", "given"), "base", "left")
                   .withColumn("taken", F.least("h", F.coalesce("given", F.lit(0)))), "conversations")
    own = placed.join(convs, "conv_id").filter((F.col("base") == F.col("conv_id")) | (F.col("place") > F.col("h")))
    own = own.select("conv_id", F.when(F.col("base") == F.col("conv_id"), F.col("place"))
                     .otherwise(F.col("place") - F.col("h") + F.col("taken")).alias("place"), "sig", "size")
    # a neighbour's first turns go to the few ids that may ask for them
    near = F.explode(F.array(*[F.try_add(F.col("conv_id"), F.lit(k).cast("long")) for k in range(1 - stride, stride) if k]))
    lent = placed.filter((F.col("conv_id") % stride == 0) & (F.col("place") <= most)).select(
        F.col("conv_id").alias("lender"), "place", "sig", "size", near.alias("conv_id"))
    lent = lent.join(convs.select("conv_id", "base", "h"), "conv_id").filter(
        (F.col("base") == F.col("lender")) & (F.col("place") <= F.col("h")))
    return own.unionByName(lent.select(*own.columns)), convs.select("conv_id")


def _xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def blocks(placed: DataFrame, ids: DataFrame) -> tuple[DataFrame, int]:
    """One row per conversation and block, and the number of the last block.

    p1, p2: the node that the blocks before end in; t1 ... : turns (x1, x2, size) or null; z1, z2: what the block adds to
    the node; filled, n_turns: turns of the block and of the conversation; u<j>, v<j>: p1 and p2 of 2**j blocks before.
    Conversations of `ids` without turns have one empty block.
    """
    place = F.col("place") - 1
    d = placed.select("conv_id", F.floor(place / BLOCK).alias("block"), (place % BLOCK).alias("slot"),
                      F.xxhash64("sig", "place").alias("x1"), F.xxhash64("place", F.lit("second"), "sig").alias("x2"), "size")
    pick = lambda c, j: F.max(F.when(F.col("slot") == j, F.col(c)))
    d = d.groupBy("conv_id", "block").agg(
        F.bit_xor("x1").alias("z1"), F.bit_xor("x2").alias("z2"), F.count("*").alias("filled"),
        *[pick(c, j).alias(f"{c}_{j}") for j in range(BLOCK) for c in ("x1", "x2", "size")])
    d = d.select("conv_id", "block", "z1", "z2", "filled", *[F.when(F.col(f"size_{j}").isNotNull(), F.struct(
        *[F.col(f"{c}_{j}").alias(c) for c in ("x1", "x2", "size")])).alias(t) for j, t in enumerate(_TURNS)])
    silent = ids.join(d.select("conv_id").distinct(), "conv_id", "left_anti")
    d = d.unionByName(silent.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("block", "z1", "z2", "filled")]), allowMissingColumns=True)
    d = stored(d, "blocks")
    last = d.agg(F.max("block")).first()[0] or 0
    by = Window.partitionBy("conv_id").orderBy("block")
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    prior = [F.coalesce(F.bit_xor(z).over(earlier), F.lit(0).cast("long")).alias(p) for z, p in (("z1", "p1"), ("z2", "p2"))]
    d = d.select("*", *prior, F.sum("filled").over(Window.partitionBy("conv_id")).alias("n_turns"))
    jumps = [F.lag(p, 2 ** j).over(by).alias(f"{name}{j}") for j in range(last.bit_length()) for p, name in (("p1", "u"), ("p2", "v"))]
    return stored(d.select("*", *jumps), "prior-blocks"), last


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """`sums` for all prefixes of all blocks, with level, depth, x1, x2: the nodes, the root among them.

    A prefix that ends in an empty column is none. The empty prefix of a later block is the node that the block
    before ends in, and is counted there.
    """
    cols = ", ".join(_TURNS)
    d = rows.sparkSession.sql(f"select block, p1, p2, {cols}, {BLOCK} - bit_count(grouping_id()) as level, {sums} "
                              f"from {{rows}} group by block, p1, p2, rollup ({cols})", rows=rows)
    ends = F.element_at(F.array(*_TURNS), F.greatest("level", F.lit(1)))
    d = d.filter(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(ends.isNotNull()))
    at = lambda x, p: _xor([F.col(p), *[F.coalesce(F.col(f"{t}.{x}"), F.lit(0).cast("long")) for t in _TURNS]])
    return d.select("*", (F.col("block") * BLOCK + F.col("level")).alias("depth"), at("x1", "p1").alias("x1"), at("x2", "p2").alias("x2"),
                    F.when(F.col("level") > 0, ends).alias("last"))


def _below(nodes: DataFrame, rows: DataFrame, last: int) -> DataFrame:
    """(block, p1, p2, saved, leaves, children): sums over all that lies below the node that block `block` is keyed by.

    A block's sums are those of its own nodes at first. Each round adds what blocks twice as far below as in the
    round before have summed so far, so the rounds are the logarithm of the longest conversation's blocks.
    """
    key = ["block", "p1", "p2"]
    own = nodes.filter("block > 0").groupBy(*key).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"),
                                                      F.sum(F.when(F.col("level") == 1, 1).otherwise(0)).alias("children"))
    jumps = [f"{c}{j}" for j in range(last.bit_length()) for c in "uv"]
    above = rows.filter("block > 0").groupBy(*key).agg(*[F.min(c).alias(c) for c in jumps])
    d = stored(own.join(above, key), "below")
    for j in range(last.bit_length()):
        more = (d.filter(F.col("block") > 2 ** j).groupBy((F.col("block") - 2 ** j).alias("block"), F.col(f"u{j}").alias("p1"), F.col(f"v{j}").alias("p2"))
                .agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves")))
        d = stored(d.join(more, key, "left").select(*key, *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")],
                                                    "children", *jumps), "below")
    return d.select(*key, "saved", "leaves", "children")


def end_digests(rows: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): of the ascending, comma-joined ids of the conversations that end in a node.

    A digest reads its list from one end to the other, so a node's list goes to one task: in sorted chunks that are
    joined before, and read as a stream.
    """
    at_end = rows.filter(F.col("block") * BLOCK + F.col("filled") == F.col("n_turns")).select(
        F.col("n_turns").alias("depth"), F.col("p1").bitwiseXOR(F.col("z1")).alias("x1"), F.col("p2").bitwiseXOR(F.col("z2")).alias("x2"), "conv_id")
    low, high, n = at_end.agg(F.min("conv_id"), F.max("conv_id"), F.count("*")).first()
    width = max(1, (high - low + 1) * CHUNK_IDS // n) if n else 1
    chunk = F.call_function("div", F.col("conv_id"), F.lit(min(width, 2 ** 62)).cast("long")).alias("chunk")
    joined = at_end.groupBy(*_NODE, chunk).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest, out = None, None, []
        for batch in batches:
            for *here, ids in zip(*[batch[c] for c in (*_NODE, "ids")]):
                if here != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = here, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pd.DataFrame(out, columns=[*_NODE, "ends_sha256"])
            out = []
        if node is not None:
            yield pd.DataFrame([(*node, digest.hexdigest())], columns=[*_NODE, "ends_sha256"])

    return (joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids")
            .mapInPandas(hashed, "depth long, x1 long, x2 long, ends_sha256 string"))


def trie(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations `ids` with the turns `placed` (conv_id, place, sig, size).

    conv_id (the smallest member), depth, parent_conv_id (that of the parent, null at the root), n_convs (members),
    n_children, n_leaves and saved_tokens (over the subtree: childless nodes; members but one times the bytes of the node's
    last text), all long, and ends_sha256 (of the members that end in the node).

    Places are 1, 2, ... in every conversation. A conversation without turns is a member of the root. Equal
    conversations end in the same node. No conversation gives no node, not even the root. A prefix that a third of the
    conversations share is a sum with partials; a node with very many children is met once, in the last join, whose larger
    side the adaptive skew join splits.
    """
    rows, last = blocks(placed, ids)
    nodes = _rolled(rows, "min(conv_id) as conv_id, count(*) as n_convs, max(n_turns) as longest")
    nodes = stored(nodes.withColumn("leaf", F.when(F.col("longest") == F.col("depth"), 1).otherwise(0))
                   .withColumn("saved", F.coalesce((F.col("n_convs") - 1) * F.col("last.size"), F.lit(0).cast("long"))), "nodes")
    own = nodes.withColumn("leaves", F.col("leaf")).withColumn("children", F.lit(0).cast("long"))
    if last:
        full = own.filter(F.col("level") == BLOCK).drop("children")
        below = _below(nodes, rows, last).select(F.col("block").alias("next"), F.col("p1").alias("x1"), F.col("p2").alias("x2"),
                                                 F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"), "children")
        full = (full.withColumn("next", F.col("block") + 1).join(below, ["next", "x1", "x2"], "left")
                .withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
                .withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0)))
                .withColumn("children", F.coalesce("children", F.lit(0).cast("long"))))
        own = own.filter(F.col("level") < BLOCK).unionByName(full.select(*own.columns))
    own = own.withColumnRenamed("level", "rank")
    counts = ", ".join(f"sum(if(rank = {j}, 1, 0)) as c{j}" for j in range(1, BLOCK + 1))
    # members of nodes below are members here too, so the least id and the largest count of a subtree are the node's own
    d = _rolled(own, "min(conv_id) as conv_id, max(n_convs) as n_convs, sum(saved) as saved_tokens, sum(leaves) as n_leaves, "
                     f"sum(children) as beyond, {counts}")
    children = F.when(F.col("level") == BLOCK, F.col("beyond")).otherwise(F.get(F.array(*[f"c{j}" for j in range(1, BLOCK + 1)]), F.col("level")))
    d = stored(d.select(*_NODE, "conv_id", "n_convs", children.alias("n_children"), "n_leaves", "saved_tokens",
                        F.col("last.x1").bitwiseXOR(F.col("x1")).alias("up1"), F.col("last.x2").bitwiseXOR(F.col("x2")).alias("up2")), "trie")
    parents = d.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("up1"), F.col("x2").alias("up2"),
                                                F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (d.join(end_digests(rows), _NODE, "left").join(parents, ["depth", "up1", "up2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
