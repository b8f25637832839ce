r"""Exact duplicates by deterministic block naming; DataFrame functions only.

The normalised text of a document is cut into blocks of a fixed number of bytes. All different blocks
are sorted and get their places as integer names; then adjacent names of a document make pairs, all
different pairs are sorted and named in turn, until each document has one name. Names are equal only
where blocks, or pairs, are equal, so documents of one name have equal texts.

Blocks are sorted by a hash of 128 bits. Every block is compared with those of its hash: if two that
differ share one, the hash is of no use for these data and the next seed is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import looked_up, ranked, stored

SPACE = r"[\x20\x09-\x0D]+"
BLOCK = 4096
MISSING = -1


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def blocks(text: Column, size: int) -> Column:
    """The UTF-8 bytes of a text in blocks; the empty text has one, which is empty."""
    data = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(data) / F.lit(size)) - 1, F.lit(0)).cast("int")
    cut = lambda bytes_: F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(bytes_, i * size + 1, F.lit(size))
    )
    return F.transform(F.array(data), cut)[0]


def block_hash(block: Column, seed: int) -> Column:
    """128 bits of a block, as two whole numbers."""
    return F.struct(
        F.xxhash64(block, F.lit(2 * seed)).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2")
    )


def hashed_blocks(docs: DataFrame, size: int, hashing=block_hash) -> tuple[DataFrame, DataFrame]:
    """(rows: row, doc_id, text_sha256, hashes; kinds: h1, h2, n) with a hash that tells all
    different blocks apart. `row` numbers the rows of `docs`; only blocks themselves are shuffled."""
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    seed = 0
    while True:
        single = texts.select(F.explode(blocks(F.col("text"), size)).alias("block"))
        single = single.select(hashing(F.col("block"), seed).alias("h"), "block").select("h.*", "block")
        different = single.groupBy("h1", "h2", "block").agg(F.count(F.lit(1)).alias("n"))
        kinds = stored(
            different.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks")),
            "block-kinds",
        )
        if kinds.filter("blocks > 1").isEmpty():
            break
        seed += 1
    rows = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        F.transform(blocks(F.col("text"), size), lambda b: hashing(b, seed)).alias("hashes"),
    )
    return stored(rows, "block-hashes"), kinds.drop("blocks")


def identities(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """(row, level, name): the one name of each row, and after how many rounds of pairs it came.
    Equal (level, name) means equal texts."""
    names = stored(ranked(kinds, ["h1", "h2"]), "block-names")
    single = rows.select("row", F.size("hashes").alias("size"), F.posexplode("hashes").alias("pos", "h"))
    named = looked_up(single.select("row", "size", "pos", "h.*"), names, ["h1", "h2"])
    named = stored(named.select("row", "size", "pos", "name"), "names-0")
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 0
    done, level = [named.filter("size = 1")], 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        odd = F.col("pos") % 2 == 1
        pairs = (
            named.filter("size > 1")
            .groupBy(
                "row",
                F.expr("CAST(pos DIV 2 AS INT)").alias("pos"),
                F.expr("CAST((size + 1) DIV 2 AS INT)").alias("size"),
            )
            .agg(
                F.max(F.when(~odd, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(MISSING)).alias("b"),
            )
        )
        pairs = stored(pairs, f"pairs-{level}")
        kinds = stored(
            pairs.groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("h", F.xxhash64("a", "b")),
            f"pair-kinds-{level}",
        )
        names = stored(ranked(kinds, ["h", "a", "b"]).drop("h"), f"pair-names-{level}")
        named = looked_up(pairs, names, ["a", "b"]).select("row", "size", "pos", "name")
        named = stored(named, f"names-{level}")
        done.append(named.filter("size = 1"))
    out = done[0].select("row", F.lit(0).alias("level"), "name")
    for i, part in enumerate(done[1:], 1):
        out = out.unionAll(part.select("row", F.lit(i).alias("level"), "name"))
    return out


def exact_duplicates(docs: DataFrame, block: int = BLOCK, hashing=block_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per row of `docs`.

    Texts are equal when they are after each run of white space is one space; a null text counts as
    empty, and all empty texts are equal. Of equal texts the row of least doc_id is kept; rows
    without an id come last, of rows with equal ids any one is kept, so exactly one row of a group
    is. keep_id is null where a group has no id. A text of any length is cut into blocks, a group of
    any size is only counted. An empty table gives an empty one; other columns are not read.
    """
    rows, kinds = hashed_blocks(docs, block, hashing)
    known = rows.select(F.col("row").alias("r"), "doc_id", "text_sha256")
    found = identities(rows, kinds)
    found = stored(
        found.join(known, F.col("row") == F.col("r")).drop("r"), "identities"
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = found.groupBy("level", "name").agg(
        least.alias("least"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stored(
        groups.select(
            "level", "name", F.col("least.doc_id").alias("keep_id"),
            F.col("least.row").alias("keep_row"), "group_size", F.col("group_size").alias("n"),
        ),
        "groups",
    )
    return looked_up(found, groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
