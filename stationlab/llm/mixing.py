"""Mixing sources to target weights by weighted fair queueing.

Each document of a source, in shuffled order, finishes at a virtual time: the tokens of its source
up to and with it, divided by the source's target. Documents of all sources are put in the order of
their finish times and taken until the budget is spent. A source whose target is above its size is
queued again, in the same order, up to `max_repeats` times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import n_words, running_totals, sized_buckets, stored

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BUCKET_ROWS = 16_384


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(rank, source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn. They share the sum of all sizes;
    a target stops at `max_repeats` times its source's size and what is left over goes to the others
    by weight. Solved in one pass over sources ordered by how soon they are full: a source is full
    if its share of what the fuller ones left is not below its limit.
    """
    one = Window.orderBy(F.col("source").isNull(), "source")
    number = F.row_number().over(one)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number - 1) % len(weights) + 1)
    rows = sizes.select(
        "source",
        "source_size",
        number.alias("rank"),
        weight.cast("long").alias("weight"),
        (F.col("source_size") * max_repeats).alias("most"),
    )
    by = Window.orderBy(F.col("most").cast("double") / F.col("weight"), "rank")
    upto = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(upto), F.lit(0))
    level = left.cast("double") / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    )
    rows = rows.withColumn("level", level)
    full = F.col("most") <= F.col("level") * F.col("weight")
    rows = rows.withColumn("open_level", F.max(F.when(~full, F.col("level"))).over(whole))
    target = F.when(full, F.col("most").cast("double")).otherwise(
        F.col("open_level") * F.col("weight")
    )
    return rows.select("rank", "source", "source_size", target.alias("target"))


def queued(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix"):
    """Every queue place of every row: rank, row (number in its source's shuffled order), doc_id,
    source, size, source_size, target, repeat, finish, running (words up to and with it), taken.

    Rows with equal ids are documents of their own. Null texts have size 0, a null source is a
    source, an empty table gives an empty one. Ties are broken by shuffle hash, id and size.
    """
    thin = stored(
        docs.select(
            F.col("doc_id").alias("doc_id"),
            "source",
            n_words(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
            .alias("hash"),
        ),
        "mix-sizes",
    )
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, max_repeats), "mix-targets")
    rows = thin.count()
    buckets = sized_buckets(rows, BUCKET_ROWS)
    known = thin.join(
        targets.select(F.col("source").alias("s"), "rank", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("s")),
    ).drop("s")
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    shuffled = running_totals(
        known,
        ["rank"],
        F.floor(place * buckets / F.lit(1 << 32)),
        [F.col("hash"), F.col("doc_id"), F.col("size")],
        {"served": F.col("size"), "row": F.lit(1).cast("long")},
    )
    repeats = shuffled.withColumn(
        "repeat", F.explode(F.array(*[F.lit(i) for i in range(max_repeats)]))
    )
    finish = F.when(
        F.col("target") > 0,
        (F.col("repeat") * F.col("source_size") + F.col("served")) / F.col("target"),
    ).otherwise(F.lit(0.0))
    timed = repeats.withColumn("finish", finish).withColumn("everything", F.lit(0))
    ordered = running_totals(
        timed,
        ["everything"],
        F.floor(F.col("finish") * buckets),
        [F.col(c) for c in ("finish", "rank", "repeat", "row")],
        {"running": F.col("size")},
    )
    budget = sizes.agg(F.sum("source_size")).first()[0] or 0
    return ordered.withColumn("taken", F.col("running") <= F.lit(budget)).select(
        "rank", "row", "doc_id", "source", "size", "source_size", "target", "repeat", "finish",
        "running", "taken", "hash",
    )


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    return (
        queued(docs, **options)
        .groupBy("rank", "row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("size").alias("size"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken"),
        )
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes, all columns kept, repeated as often as taken.

    Rows alike in id, source and size stand for each other, so they share what they are given.
    """
    key = ["doc_id", "source", "size"]
    times = (
        queued(docs, **options).filter("taken").groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").alias("k0"),
        F.col("source").alias("k1"),
        n_words(F.col("text")).alias("k2"),
    )
    alike = packed.groupBy("k0", "k1", "k2").agg(F.count(F.lit(1)).alias("rows"))
    times = times.join(
        alike.filter("rows > 1"),
        F.col("doc_id").eqNullSafe(F.col("k0"))
        & F.col("source").eqNullSafe(F.col("k1"))
        & (F.col("size") == F.col("k2")),
        "left",
    ).select(*key, "times", F.coalesce("rows", F.lit(1)).alias("rows"))
    joined = packed.join(
        times,
        F.col("doc_id").eqNullSafe(F.col("k0"))
        & F.col("source").eqNullSafe(F.col("k1"))
        & (F.col("size") == F.col("k2")),
    )
    order = Window.partitionBy("k0", "k1", "k2").orderBy(F.hash("doc"))
    share = F.floor(F.col("times") / F.col("rows")) + F.when(
        F.row_number().over(order) <= F.col("times") % F.col("rows"), 1
    ).otherwise(0)
    copies = joined.withColumn("copies", share).withColumn(
        "copy", F.explode(F.expr("if(copies > 0, sequence(1, copies), array())"))
    )
    return copies.select("doc.*")
