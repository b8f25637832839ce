"""Shards of near equal bytes by sampled splitters; DataFrame functions only.

Records are ordered by a hash of their text, so that copies are neighbours. A sample of keys, drawn
in proportion to size, gives quantile boundaries of many ranges; every record finds its range by
binary search; ranges are measured, and overfull ones are divided: first by text, then, where one
text alone overfills, by document. Whole pieces, in order, fill the shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import stored

SHARDS = 16
RANGES = 1024
SAMPLE = 16_384
PIECE_ROWS = 65_536


def uniform(*columns) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def boundaries(thin: DataFrame, total: int, ranges: int, sample: int) -> list[int]:
    """Keys that split the sizes into `ranges` about equal parts, from about `sample` keys.

    Equal records are drawn together, once, with a chance in proportion to their bytes; those larger
    than a sample's share are always drawn and count for their bytes. So about `sample` keys are
    drawn whatever repeats, and the draw depends on the records alone.
    """
    share = F.col("size") * F.col("n") * F.lit(sample / max(total, 1))
    equal = thin.groupBy("doc_id", "key", "size").agg(F.count(F.lit(1)).alias("n"))
    drawn = (
        equal.filter(uniform("doc_id", "key", "size", F.lit("draw")) < share)
        .select("key", F.greatest(share, F.lit(1.0)).alias("weight"))
        .collect()
    )
    drawn.sort()
    step = sum(w for _, w in drawn) / ranges
    found, seen = [], 0.0
    for key, weight in drawn:
        while seen >= step * (len(found) + 1) and len(found) < ranges - 1:
            found.append(key)
        seen += weight
    return found


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many boundaries are not above the key, by binary search."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    table = F.lit(bounds) if len(bounds) > 1 else F.array(F.lit(bounds[0]).cast("long"))
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(
            (at + s <= len(bounds)) & (F.try_element_at(table, at + s) <= key), at + s
        ).otherwise(at),
    )


def divided(
    thin: DataFrame, by: list[str], name: str, hashed: Column, most_bytes: float, most_rows: int
) -> DataFrame:
    """Adds the number of a record's part within its piece; pieces not overfull have one part."""
    sums = thin.groupBy(*by).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.greatest(F.col("b") / F.lit(most_bytes), F.col("n") / F.lit(most_rows)))
    over = sums.select(*[F.col(c).alias(f"o_{c}") for c in by], parts.alias("parts")).filter(
        "parts > 1"
    )
    same = F.lit(True)
    for c in by:
        same &= F.col(c) == F.col(f"o_{c}")
    part = F.coalesce(F.pmod(hashed, F.col("parts")), F.lit(0))
    return thin.join(over, same, "left").select(*thin.columns, part.alias(name))


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    ranges: int = RANGES,
    sample: int = SAMPLE,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: shards follow from sizes).

    A null text is a record of size 1 and crc 0 as an empty one is. Rows with equal ids are records
    of their own; equal rows are interchangeable. An empty table gives an empty one. Only doc_id
    and text are read, so other columns never clash. The sample is a few keys per range, whatever
    the input; a piece holds at most about 1.25 ranges of bytes or `piece_rows` rows, so no task
    sorts more, however many rows are equal or long. Equal texts stay in one shard unless they alone overfill a range.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-sizes",
    )
    total = thin.agg(F.sum("size")).first()[0] or 0
    bounds = boundaries(thin, total, ranges, sample)
    limit = max(1.25 * total / ranges, 1.0)
    ranged = thin.withColumn("r", range_of(F.col("key"), bounds))
    by_text = divided(ranged, ["r"], "t", F.xxhash64("key", F.lit("part")), limit, piece_rows)
    by_row = divided(
        by_text, ["r", "t"], "d", F.xxhash64("doc_id", F.lit("row")), limit, piece_rows
    )
    # Where equal rows alone overfill a piece, they are dealt out; they stand for each other.
    # There are no more such rows than ranges and pieces of rows.
    equal = thin.groupBy("doc_id", "key", "size").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.greatest(F.col("n") * F.col("size") / F.lit(limit), F.col("n") / F.lit(piece_rows)))
    many = equal.select(
        F.col("doc_id").alias("ed"), F.col("key").alias("ek"), F.col("size").alias("es"), parts.alias("parts")
    ).filter("parts > 1")
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("doc_id", "ed"), ("key", "ek"), ("size", "es"))]
    copy = F.pmod(F.xxhash64("row", F.lit("copy")), F.col("parts"))
    by_copy = by_row.join(F.broadcast(many), same, "left").withColumn("e", F.coalesce(copy, F.lit(0)))
    by_copy = by_copy.drop("ed", "ek", "es", "parts")
    pieces = stored(
        by_copy.groupBy("r", "t", "d", "e").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")),
        "shard-pieces",
    )
    order = Window.orderBy("r", "t", "d", "e").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("b").over(order), F.lit(0)) + F.col("b") / 2
    placed = pieces.withColumn(
        "shard", F.least(F.floor(middle * shards / max(total, 1)), F.lit(shards - 1)).cast("int")
    )
    inside = Window.partitionBy("shard").orderBy("r", "t", "d", "e").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = placed.select(
        F.col("r").alias("pr"), F.col("t").alias("pt"), F.col("d").alias("pd"), F.col("e").alias("pe"), "shard",
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("start"),
    )
    row = Window.partitionBy("r", "t", "d", "e").orderBy("key", "doc_id", "size", "text_crc32")
    same = [F.col(a) == F.col(b) for a, b in zip("rtde", ("pr", "pt", "pd", "pe"))]
    return by_copy.join(starts, same).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.row_number().over(row) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
