"""The trie of conversation prefixes, by hashes of blocks of turns.

Conversations are grouped by the digests of their first block of turns, of their first two, and so on.
A group whose conversations all go on with the same block needs no look inside that block; only where
they part, or one ends, are the prefixes of single turns inside the block compared.

A digest is the exclusive or of hashes of (turn, its place), so digests of prefixes are running
values, which long conversations get piece by piece in many tasks. A node is named by its smallest
member and its depth, which no other node shares. Sums over subtrees need no walk over the tree:
each node is charged to its smallest member, what is charged to a conversation lies at the end of its
path, and the sum of a subtree is that of the conversations that pass through its top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import looked_up, running_totals, stored

BLOCK = 4
LENT_TURNS = 6
FAMILY = 100
# Turns, blocks or ids that one window or list holds at most.
PIECE = 4096
IDS = 65_536


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv, number, digest, chars): the turns of each conversation counted from 1, by turn (null
    first), role and text. Turns are sorted over all tasks, a long conversation lies in several."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"),
        F.rand(7).alias("tie"),
    )
    order = ["conv", "turn", "role", "text", "tie"]
    told = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    placed = stored(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv",
            F.monotonically_increasing_id().alias("place"),
            F.unhex(F.md5(told)).alias("digest"),
            F.char_length("text").cast("long").alias("chars"),
        ),
        "turns",
    )
    # The high bits of a place number its sorted file; there a conversation's places follow closely.
    piece = F.shiftright("place", 33).alias("piece")
    pieces = placed.groupBy("conv", piece).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col("conv").alias("c"), F.col("piece").alias("p"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"),
    )
    rows = placed.select("*", piece)
    return rows.join(pieces, (F.col("conv") == F.col("c")) & (F.col("piece") == F.col("p"))).select(
        "conv", (F.col("place") + F.col("shift")).alias("number"), "digest", "chars"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs: conv, length; turns: conv, depth, digest, chars): each conversation begins with the
    first turns of its family's first, in place of as many of its own."""
    lent_turns = F.crc32(F.col("conv").cast("string")) % LENT_TURNS
    sizes = turns.groupBy("conv").agg(F.max("number").alias("size"))
    sizes = stored(
        sizes.select(
            "conv", "size", lent_turns.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("family")
        ),
        "conversations",
    )
    heads = sizes.select(F.col("conv").alias("f"), F.col("size").alias("available"))
    lent = F.least(F.col("h"), F.coalesce("available", F.lit(0)))
    convs = sizes.join(heads, F.col("family") == F.col("f"), "left").select(
        "conv", "family", "size", "h", lent.alias("lent"),
        (lent + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length"),
    )
    convs = stored(convs, "rebuilt-conversations")
    own = looked_up(turns, convs.select("conv", "h", "lent", F.col("size").alias("n")), ["conv"])
    own = own.filter("number > h").select(
        "conv", (F.col("number") - F.col("h") + F.col("lent")).alias("depth"), "digest", "chars"
    )
    # At most LENT_TURNS turns of a head meet the conversations of one family.
    first = turns.filter(F.col("number") < LENT_TURNS).withColumnRenamed("conv", "head")
    borrowed = first.join(
        convs.select("conv", "family", "h"), (F.col("head") == F.col("family")) & (F.col("number") <= F.col("h"))
    ).select("conv", F.col("number").alias("depth"), "digest", "chars")
    return convs.select("conv", "length"), stored(own.unionAll(borrowed), "rebuilt-turns")


def running_xor(rows: DataFrame, values: list[str]) -> DataFrame:
    """(conv, block) rows with the exclusive or of each value over all blocks before (s_) and up to
    and with this one (e_), in pieces of PIECE blocks."""
    pieced = rows.withColumn("piece", F.floor(F.col("block") / PIECE))
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieced.groupBy("conv", "piece").agg(*[F.bit_xor(v).alias(v) for v in values])
    starts = sums.select(
        F.col("conv").alias("c"), F.col("piece").alias("p"),
        *[F.coalesce(F.bit_xor(v).over(before), F.lit(0)).alias(f"start_{v}") for v in values],
    )
    inside = Window.partitionBy("conv", "piece").orderBy("block").rowsBetween(
        Window.unboundedPreceding, 0
    )
    joined = pieced.join(starts, (F.col("conv") == F.col("c")) & (F.col("piece") == F.col("p")))
    ends = [F.bit_xor(v).over(inside).bitwiseXOR(F.col(f"start_{v}")) for v in values]
    return joined.select(
        *rows.columns,
        *[e.bitwiseXOR(F.col(v)).alias(f"s_{v}") for e, v in zip(ends, values)],
        *[e.alias(f"e_{v}") for e, v in zip(ends, values)],
    )


def groups_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """How many rows hold a key (`n`, and again as `members`) and their smallest conversation."""
    found = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"))
    return found.withColumn("members", F.col("n"))


def placed_turns(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, depth, chars, members, first): for every conversation the nodes on its path, the root
    with depth 0 among them."""
    root = convs.agg(F.count(F.lit(1)), F.min("conv")).first()
    hashed = turns.select(
        "conv", "depth", "chars", F.expr(f"(depth - 1) DIV {block}").alias("block"),
        F.xxhash64("digest", "depth", F.lit(1)).alias("d1"), F.xxhash64("digest", "depth", F.lit(2)).alias("d2"),
    )
    blocks = hashed.groupBy("conv", "block").agg(
        F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.count(F.lit(1)).alias("turns")
    )
    blocks = stored(running_xor(stored(blocks, "turn-blocks"), ["d1", "d2"]), "block-prefixes")
    key = ["block", "e_d1", "e_d2"]
    full = blocks.filter(F.col("turns") == block).select("conv", *key)
    groups = stored(groups_of(full, key), "block-groups")
    ends = stored(
        looked_up(full, groups, key).select(
            F.col("conv").alias("c"), F.col("block").alias("b"), "members", "first"
        ),
        "block-members",
    )
    begins = ends.select(
        F.col("c").alias("c0"), (F.col("b") + 1).alias("b0"),
        F.col("members").alias("members0"), F.col("first").alias("first0"),
    )
    known = (
        blocks.join(ends, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b")), "left")
        .join(begins, (F.col("conv") == F.col("c0")) & (F.col("block") == F.col("b0")), "left")
        .select(
            F.col("conv").alias("c"), F.col("block").alias("b"), "s_d1", "s_d2",
            F.coalesce("members", F.lit(0)).alias("after"),
            F.coalesce("members0", F.lit(root[0])).alias("members"),
            F.coalesce("first0", F.lit(root[1])).alias("first"),
        )
    )
    together = (F.col("after") == F.col("members")) | (F.col("members") == 1)
    rows = stored(
        hashed.join(known, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b")))
        .withColumn("together", together)
        .drop("c", "b", "after"),
        "turns-in-blocks",
    )
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    prefix = lambda i: F.bit_xor(f"d{i}").over(inside).bitwiseXOR(F.col(f"s_d{i}")).alias(f"k{i}")
    parted = stored(
        rows.filter("NOT together").select("conv", "depth", "chars", prefix(1), prefix(2)), "parted-turns"
    )
    key = ["depth", "k1", "k2"]
    refined = looked_up(parted, stored(groups_of(parted, key), "turn-groups"), key)
    shown = ["conv", "depth", "chars", "members", "first"]
    top = convs.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"),
        F.lit(root[0]).cast("long").alias("members"), F.lit(root[1]).cast("long").alias("first"),
    )
    paths = rows.filter("together").select(*shown).unionAll(refined.select(*shown)).unionAll(top)
    return stored(paths, "paths")


def joined_ids(ends: DataFrame) -> DataFrame:
    """(first, depth, sha): hash of the ascending, comma-joined ids of the conversations that end in
    a node. Ids of one range make a piece, pieces stream through the node's task in order."""
    pieces = (
        ends.withColumn("range", F.floor(F.col("conv") / IDS))
        .groupBy("first", "depth", "range")
        .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))]
            return pa.record_batch(columns, names=["first", "depth", "sha"])

        for batch in batches:
            done = []
            for first, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("first", "depth", "ids")]):
                if node == (first, depth):
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, sha.hexdigest()))
                node, sha = (first, depth), hashlib.sha256(ids.encode())
            if done:
                yield batch_of(done)
        if node is not None:
            yield batch_of([(*node, sha.hexdigest())])

    order = ["first", "depth", "range"]
    sorted_pieces = pieces.repartition("first", "depth").sortWithinPartitions(*order)
    return sorted_pieces.select("first", "depth", "ids").mapInArrow(
        hashed, "first long, depth long, sha string"
    )


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; rows without a conv_id belong to no conversation. Turns are in
    the order of turn (null first), role, text; repeated rows are turns each. An empty table gives an
    empty one, without a root. Texts are hashed once, whatever their length, and a conversation of
    any length is worked on in pieces; other columns are not read.
    """
    convs, turns = rebuilt(stored(numbered(conversations), "numbered-turns"))
    convs = stored(convs, "lengths")
    paths = placed_turns(convs, turns, block)
    value = (F.col("members") - 1) * F.col("chars")
    own = stored(
        paths.filter("conv = first").select("conv", "depth", "members", value.alias("value")), "nodes"
    )
    upper = paths.select(
        F.col("conv").alias("c"), (F.col("depth") + 1).alias("d"), F.col("first").alias("parent")
    )
    parents = stored(
        own.join(upper, (F.col("conv") == F.col("c")) & (F.col("depth") == F.col("d"))).select(
            F.col("conv").alias("pc"), F.col("depth").alias("pd"), "parent"
        ),
        "parents",
    )
    children = parents.groupBy(F.col("parent").alias("cc"), (F.col("pd") - 1).alias("cd")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = own.join(parents, (F.col("conv") == F.col("pc")) & (F.col("depth") == F.col("pd")), "left")
    nodes = nodes.join(children, (F.col("conv") == F.col("cc")) & (F.col("depth") == F.col("cd")), "left")
    nodes = stored(
        nodes.select("conv", "depth", "parent", "members", "value", F.coalesce("n_children", F.lit(0)).alias("n_children")),
        "nodes-linked",
    )
    charged = nodes.groupBy("conv").agg(
        F.sum("value").alias("total"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    charged = stored(
        convs.join(charged.withColumnRenamed("conv", "c"), F.col("conv") == F.col("c")).select(
            "conv", "total", "leaf", (F.col("length") + 1).alias("n")
        ),
        "charged",
    )
    # Conversations to which nothing is charged add nothing to any node.
    sums = looked_up(paths, charged, ["conv"]).groupBy(
        F.col("first").alias("sf"), F.col("depth").alias("sd")
    )
    sums = sums.agg(F.sum("total").alias("total"), F.sum("leaf").alias("n_leaves"))
    upto = running_totals(
        nodes, ["conv"], F.floor(F.col("depth") / PIECE), [F.col("depth")], {"upto": F.col("value")}
    )
    lengths = convs.select(F.col("conv").alias("c"), "length", (F.col("length") + 1).alias("n"))
    ends = looked_up(paths, lengths.withColumnRenamed("c", "conv"), ["conv"])
    ends = joined_ids(ends.filter("depth = length").select("conv", "first", "depth"))
    ends = ends.select(F.col("first").alias("ef"), F.col("depth").alias("ed"), "sha")
    return (
        upto.join(sums, (F.col("conv") == F.col("sf")) & (F.col("depth") == F.col("sd")))
        .join(ends, (F.col("conv") == F.col("ef")) & (F.col("depth") == F.col("ed")), "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            F.col("members").alias("n_convs"),
            "n_children",
            "n_leaves",
            (F.col("total") - F.col("upto") + F.col("value")).alias("saved_tokens"),
            F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
