"""What several operators share: tables, words, stored intermediate results, running totals."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce, wraps
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlab.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
# Rows of texts that go to Python at a time; larger batches would only wait, in Spark's and in Python's memory.
TEXTS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# What forgets the objects that an operator keeps in a Python process from task to task.
KEPT: dict[str, Callable[[], None]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, whatever is lost later."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns freed memory to the system, which the allocators of this Python process hold otherwise."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(owner: str) -> Callable[[Callable], Callable]:
    """For the Python work of an operator's tasks. Spark keeps a Python process for tasks of later stages,
    so a task forgets what other operators keep there, and leaves no freed memory behind."""

    def of(work: Callable) -> Callable:
        @wraps(work)
        def run(batches: Iterator) -> Iterator:
            for name, forget in KEPT.items():
                if name != owner:
                    forget()
            give_back()
            try:
                yield from work(batches)
            finally:
                give_back()

        return run

    return of


def n_words(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_buckets(rows: int, per_bucket: int) -> int:
    """How many buckets keep each near `per_bucket` rows."""
    return max(16, -(-rows // per_bucket))


def running_totals(
    df: DataFrame, group: list[str], bucket: Column, order: list[Column], totals: dict[str, Column]
) -> DataFrame:
    """Adds, per group, running sums (rows themselves included) in the given order.

    `bucket` is a whole number that never falls along the order. Buckets are summed first, summed
    up over the few bucket rows, and only rows of one bucket are sorted together, so no task holds
    a group.
    """
    temp = {name: f"__{name}" for name in totals}
    rows = df.withColumn("__bucket", bucket)
    sums = rows.groupBy(*group, "__bucket").agg(
        *[F.sum(value).alias(temp[name]) for name, value in totals.items()]
    )
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
        F.col("__bucket").alias("__b"),
        *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(t) for t in temp.values()],
    )
    same = F.col("__bucket") == F.col("__b")
    for i, c in enumerate(group):
        same &= F.col(c) == F.col(f"__g{i}")
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    joined = rows.join(starts, same)
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            (F.sum(value).over(inside) + F.col(temp[name])).alias(name)
            for name, value in totals.items()
        ],
    )

HEAVY = 1000


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], weight: str = "n") -> DataFrame:
    """`rows` (stored) with the other columns of `table`, which has one row per key and in `weight`
    how many rows hold the key, but for `weight` itself; rows without a key in it are dropped.

    A key that holds a thousandth of the rows is one of at most HEAVY such keys, so these are
    broadcast and their rows stay where they are; all other keys are joined by a shuffle, in which
    no key has more than its thousandth.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    keys = [f"__k{i}" for i in range(len(on))]
    named = table.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        *[c for c in table.columns if c not in (*on, weight)],
        (F.col(weight) * HEAVY >= F.lit(total)).alias("__heavy"),
    )
    heavy, light = named.filter("__heavy").drop("__heavy"), named.filter("NOT __heavy").drop("__heavy")
    same = reduce(and_, [F.col(c) == F.col(k) for c, k in zip(on, keys)])
    near = rows.join(F.broadcast(heavy), same).drop(*keys)
    far = rows.join(F.broadcast(heavy.select(*keys)), same, "left_anti").join(light, same).drop(*keys)
    return near.unionAll(far)


def ranked(df: DataFrame, order: list[str], name: str = "name") -> DataFrame:
    """`df` (stored, its rows distinct in `order`) with their places in that order, from 0. The first
    column of the order is a 64-bit hash, so equal ranges of it hold about equally many rows."""
    buckets = sized_buckets(df.count(), 65_536)
    bucket = F.floor((F.col(order[0]) / F.lit(2.0**64) + F.lit(0.5)) * buckets)
    placed = running_totals(df, [], bucket, [F.col(c) for c in order], {name: F.lit(1).cast("long")})
    return placed.withColumn(name, F.col(name) - 1)


# Schemes that Spark and pyarrow name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def opened(uri: str):
    """(pyarrow file system, path) of a place in the shared folder, usable inside tasks. Places have a
    scheme (`session.qualified`); one without could mean another file system to Spark."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or not rest.startswith("/"):
        raise ValueError(f"a place without a scheme: {uri}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


class Published:
    """A file that appears under its name only when it is whole.

    Each attempt of a task writes to a name of its own; the names in the table that Spark commits
    are those of finished attempts, so a lost executor or a second attempt leaves nothing wrong.
    """

    def __init__(self, folder: str, name: str):
        self.name = f"{name}-{uuid.uuid4().hex}"
        self.fs, base = opened(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{self.name}"
        self.hidden = f"{base}/.{self.name}.part"
        self.stream = self.fs.open_output_stream(self.hidden)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.hidden, self.path)

    def drop(self) -> None:
        with suppress(OSError):
            self.stream.close()
            self.fs.delete_file(self.hidden)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected graph of edges (a, b); root is the least node of its part.

    Rounds of large-star and small-star; each round is stored, and each node's links shrink toward
    its least neighbour, so the rounds grow with the logarithm of the longest chain.
    """
    links = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (
            both.join(least, both.a == least.n).filter("b > a").select(F.col("b").alias("a"), "m")
        )
        large = large.withColumnRenamed("m", "b").filter("a <> b").distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        floor = floor.select(F.col("a").alias("n"), "m")
        small = (
            large.join(floor, large.a == floor.n)
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        after = stored(small, "links")
        same = after.count() == links.count() and after.exceptAll(links).isEmpty()
        links = after
        if same:
            break
    nodes = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    roots = nodes.select(F.col("root").alias("node"), "root").distinct()
    return nodes.union(roots)
