"""Near-duplicates by Order MinHash.

A text is the sequence of its 5-word shingles, each labelled with how often it occurred before. Each
entry of a sketch takes the few labelled shingles of least hash and keeps them in text order, so
that texts share an entry only if these shingles and their order agree. Texts that share an entry
are compared by banded alignment of the shingle sequences; similar ones are linked, and linked texts
form classes.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import BATCH_ROWS, TEXTS, components, lean, looked_up, stored
from stationlab.session import setting

SHINGLE = 5
ENTRIES = 16
MINIMA = 4
SIMILARITY = 0.8
SLICE = 256
# Of the classes of a rare shingle: rounds of comparing with typical texts, these for each shingle, and
# comparisons for each text in a round, later for each two classes.
ROUNDS = 3
TYPICAL = 4
FIRST = 16

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers whose bits all depend on all bits of the given ones."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class Powers:
    """Powers of an odd base and of its inverse, grown as texts need them."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            self.up = np.cumprod(np.r_[_U(1), np.full(n - 1, _BASE, _U)])
            self.down = np.cumprod(np.r_[_U(1), np.full(n - 1, inverse, _U)])


POWERS = Powers()
_TURN = mixed(np.arange(1, SHINGLE + 1, dtype=_U) * _U(_BASE)) | _U(1)
_PLACE = mixed(np.arange(101, 101 + MINIMA, dtype=_U) * _U(_BASE)) | _U(1)
_SEEDS = mixed(np.arange(201, 201 + ENTRIES, dtype=_U) * _U(_BASE))


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, from sums of powers over the bytes of the text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    POWERS.reach(len(data) + 1)
    sums = np.r_[_U(0), np.cumsum((data.astype(_U) + _U(1)) * POWERS.up[: len(data)])]
    return mixed((sums[ends] - sums[begins]) * POWERS.down[begins])


def labelled_shingles(text: str | None) -> np.ndarray:
    """Hashes of the shingles of a text in order, equal ones told apart by their occurrence. A text
    of fewer words than a shingle is one shingle; one without words has none."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE + 1)
    shingles = np.full(n, len(words) if len(words) < SHINGLE else 0, _U)
    for i in range(min(SHINGLE, len(words))):
        shingles += words[i : i + n] * _TURN[i]
    shingles = mixed(shingles)
    order = np.argsort(shingles, kind="stable")
    same = np.r_[False, shingles[order][1:] == shingles[order][:-1]]
    run = np.arange(n) - np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    times = np.empty(n, _U)
    times[order] = run
    return mixed(shingles + times * _U(_BASE))


def sketch(text: str | None) -> list[int]:
    """One key for each entry; none for a text without words."""
    shingles = labelled_shingles(text)
    n = len(shingles)
    if not n:
        return []
    keys = np.empty(ENTRIES, _U)
    together = max(1, 65_536 // n)
    for low in range(0, ENTRIES, together):
        seeds = _SEEDS[low : low + together, None]
        values = mixed(shingles[None, :] ^ seeds)
        least = np.argpartition(values, MINIMA - 1, axis=1)[:, :MINIMA] if n > MINIMA else (
            np.tile(np.arange(n), (len(seeds), 1))
        )
        chosen = shingles[np.sort(least, axis=1)]
        keys[low : low + together] = mixed(
            (chosen * _PLACE[: chosen.shape[1]]).sum(axis=1, dtype=_U) ^ seeds[:, 0]
        )
    return keys.view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Shingles aligned in order over shingles in either text; 0 where it cannot reach `least`.

    An alignment that reaches it leaves so few shingles out that it stays within a band of the
    diagonal. Labelled shingles differ within a text, so the longest alignment is the longest rising
    run of places.
    """
    n, m = len(a), len(b)
    need = math.ceil(least * (n + m) / (1 + least) - 1e-9)
    if not n or not m or min(n, m) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = (i - j <= n - need) & (j - i <= m - need)
    i, j = i[near], j[near]
    if len(i) < need:
        return 0.0
    places = j[np.argsort(i)]
    aligned = len(places)
    if not (np.diff(places) > 0).all():
        ends: list[int] = []
        for place in places.tolist():
            at = bisect_left(ends, place)
            ends[at : at + 1] = [place]
        aligned = len(ends)
    found = aligned / (n + m - aligned)
    return found if aligned >= need else 0.0


def sketches(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    @lean("near_duplicates")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sketch(text) for text in batch])

    return udf(text)


def similarities(left: Column, right: Column) -> Column:
    @F.pandas_udf("double")
    @lean("near_duplicates")
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for some, others in batches:
            held: dict[str, np.ndarray] = {}

            def shingles(text: str) -> np.ndarray:
                if text not in held:
                    if len(held) > 64:
                        held.clear()
                    held[text] = labelled_shingles(text)
                return held[text]

            yield pd.Series([similarity(shingles(a), shingles(b)) for a, b in zip(some, others)])

    return udf(left, right)


def node_of(text: Column) -> Column:
    """The node of all equal texts; null for a null text."""
    return F.unhex(F.md5(text))


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(similarities(F.col("ta"), F.col("tb")) >= SIMILARITY).select("a", "b")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def with_shingles(texts: DataFrame) -> DataFrame:
    """(node, s): the labelled shingles of texts (node, text), a few texts at a time."""

    @lean("near_duplicates")
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                some = batch.slice(low, SLICE)
                found = [labelled_shingles(text).view(np.int64) for text in some.column("text").to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))
                yield pa.record_batch([some.column("node"), lists], names=["node", "s"])

    return texts.select("node", "text").mapInArrow(work, "node binary, s array<long>")


def rarest(texts: DataFrame) -> DataFrame:
    """(token, node, size, rank, near): of each of the (stored) texts the shared shingles among its
    rarest, by which every similar pair can be found.

    Shingles are put in the order of how many of these texts hold them. Similar texts share enough
    of them that one lies among the first of both, far beyond what all texts of a template share.
    `near` marks those that the smaller text of a pair needs, the larger one needs them all."""
    # Three steps read these rows; stored as rows, each shingle is made one once.
    single = with_shingles(texts).select("node", F.size("s").alias("size"), F.explode("s").alias("token"))
    single = stored(single, "shingles")
    often = single.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = stored(often.withColumn("times", F.col("n")), "shingle-counts")
    ordered = looked_up(single, often, ["token"]).groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("times", "token"))).alias("s")
    )
    size, rank = F.col("size"), F.col("rank")
    ranked = ordered.select("node", "size", F.size("s").alias("m"), F.posexplode("s").alias("at", "e"))
    ranked = ranked.select("node", "size", (size - F.col("m") + F.col("at")).alias("rank"), "e.token")
    first = lambda share: rank < size - F.ceil(size * share - 1e-9) + 1
    return ranked.filter(first(SIMILARITY)).withColumn("near", first(2 * SIMILARITY / (1 + SIMILARITY)))


def rooted(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) of different classes so far, with the roots of these in order."""
    for side in "ab":
        known = parts.select(F.col("node").alias("p"), F.col("root").alias(f"r{side}"))
        pairs = pairs.join(known, F.col(side) == F.col("p"), "left").drop("p")
        pairs = pairs.withColumn(f"r{side}", F.coalesce(f"r{side}", side))
    pairs = pairs.filter("ra <> rb")
    low, high = F.least("ra", "rb"), F.greatest("ra", "rb")
    return pairs.withColumns({"ra": low, "rb": high})


def mixed_shingles(buckets: DataFrame, texts: DataFrame, parts: DataFrame) -> DataFrame:
    """The rarest shingles of the texts in buckets whose texts are of several classes."""
    placed = buckets.filter("n > 3").join(
        parts.select(F.col("node").alias("p"), "root"), F.col("node") == F.col("p"), "left"
    ).select("entry", "key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("entry", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.filter("low <> high").select(F.col("entry").alias("e"), F.col("key").alias("k"))
    inside = placed.join(mixed, (F.col("entry") == F.col("e")) & (F.col("key") == F.col("k")), "left_semi")
    inside = stored(inside.select(F.col("node").alias("i")).distinct(), "mixed-nodes")
    mixed_texts = stored(texts.join(inside, F.col("node") == F.col("i"), "left_semi"), "mixed-texts")
    return stored(rarest(mixed_texts), "rare-shingles")


def by_class(tokens: DataFrame, parts: DataFrame) -> DataFrame:
    """The rare shingles that texts of several classes hold, with the root of the text's class and
    whether that is the shingle's largest class."""
    known = parts.select(F.col("node").alias("p"), "root")
    tokens = tokens.join(known, F.col("node") == F.col("p"), "left").drop("p")
    tokens = tokens.withColumn("root", F.coalesce("root", "node"))
    classes_of = tokens.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("classes")
    )
    classes_of = classes_of.filter("classes > 1").select(F.col("token").alias("t"), "main")
    tokens = tokens.join(classes_of, F.col("token") == F.col("t")).drop("t")
    return stored(tokens.withColumn("main", F.col("root") == F.col("main")), "rare-shingles")


def beside(tokens: DataFrame) -> DataFrame:
    return tokens.select(*[F.col(c).alias(f"{c}_s") for c in ("token", "node", "size", "rank", "root", "main")])


def may_reach() -> Column:
    """Whether two texts of different classes that hold a shingle can be similar."""
    rest = F.least(F.col("size") - F.col("rank"), F.col("size_s") - F.col("rank_s"))
    need = F.ceil((F.col("size") + F.col("size_s")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    return (
        (F.col("token") == F.col("token_s"))
        & (F.col("root") != F.col("root_s"))
        & (F.col("size_s") >= F.col("size") * SIMILARITY - 1e-9)
        & (F.col("size") >= F.col("size_s") * SIMILARITY - 1e-9)
        # What is left of both after their first shared shingle must suffice.
        & (rest >= need)
    )


def typical_pairs(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): each text outside a shingle's largest class with some typical texts of that class, in which
    few rarer shingles come before it. A text gets at most FIRST of them, those that share most with it;
    the rows grow with the shingles and not with the size of a class."""
    slot = F.pmod(F.xxhash64("node", "token"), F.lit(TYPICAL))
    held = tokens.filter("main").groupBy("token", slot.alias("slot"))
    held = held.agg(F.min(F.struct(F.col("rank") / F.col("size"), "node", "size", "rank", "root")).alias("e"))
    typical = held.select("token", "e.node", "e.size", "e.rank", "e.root", F.lit(True).alias("main"))
    pairs = tokens.filter("NOT main").join(beside(typical), may_reach())
    pairs = pairs.groupBy("node", "node_s").agg(F.count(F.lit(1)).alias("shared"))
    turn = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("shared"), "node_s"))
    pairs = pairs.withColumn("turn", turn).filter(F.col("turn") <= FIRST)
    return pairs.select(*ordered(F.col("node"), F.col("node_s"))).distinct().join(known, ["a", "b"], "left_anti")


def missing_pairs(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, shared): pairs of texts that may be similar and were not compared; `shared` counts the
    rare shingles that both hold.

    Only pairs of two classes matter. A shingle's largest class, which may be a group of any size, is
    never joined with itself, and shingles of one class are left out."""
    smaller, smaller_first = beside(tokens.filter("near")), F.col("size_s") <= F.col("size")
    pairs = tokens.filter("NOT main").join(smaller, may_reach() & smaller_first)
    pairs = pairs.select("node", "node_s").unionAll(
        tokens.filter("main").join(smaller.filter("NOT main_s"), may_reach() & smaller_first).select("node", "node_s")
    )
    pairs = pairs.groupBy(*ordered(F.col("node"), F.col("node_s"))).agg(F.count(F.lit(1)).alias("shared"))
    return pairs.join(known, ["a", "b"], "left_anti")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, node; nodes: node, first, class_node, class_id), the latter one per text.

    Within a bucket (texts that share an entry) each text is compared with two centres, others in
    each entry's buckets, which joins most of them. Where a bucket then still holds texts of several
    classes, these are first held against typical texts of the classes that hold their rarest shingles;
    then every pair of different classes that can be similar is found by these shingles. Such pairs are
    compared a few at a time for each two classes, those that share most first, until all are or their
    classes are one. So a bucket of copies costs a few comparisons per text, and no two similar
    texts of a bucket stay apart.
    """
    with setting(docs.sparkSession, BATCH_ROWS, str(TEXTS)):
        return _classes(docs)


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    sketched = stored(
        docs.select("doc_id", node_of(F.col("text")).alias("node"), sketches(F.col("text")).alias("sketch")),
        "sketches",
    )
    rows = sketched.select("doc_id", "node")
    nodes = stored(
        sketched.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    entries = nodes.select("node", F.posexplode("sketch").alias("entry", "key"))
    turn = F.struct(F.xxhash64("node", "entry"), "node")
    centres = (
        entries.groupBy("entry", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("c1"), F.max(turn).alias("c2"))
        .filter("n > 1")
        .select(F.col("entry").alias("e"), F.col("key").alias("k"), "n", "c1.node", "c2")
        .select("e", "k", "n", F.col("node").alias("c1"), F.col("c2.node").alias("c2"))
    )
    buckets = stored(
        entries.join(centres, (F.col("entry") == F.col("e")) & (F.col("key") == F.col("k")))
        .select("entry", "key", "n", "node", "c1", "c2"),
        "buckets",
    )
    candidates = buckets.select(F.col("node").alias("c")).distinct()
    wanted = nodes.join(candidates, F.col("node") == F.col("c")).select(
        F.col("node").alias("w"), "first"
    )
    texts = stored(
        docs.select(F.col("doc_id"), node_of(F.col("text")).alias("node"), "text")
        .join(wanted, (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("node", "doc_id")
        .agg(F.first("text").alias("text"))
        .select("node", "text"),
        "candidate-texts",
    )
    pairs = (
        buckets.select("node", F.explode(F.array("c1", "c2")).alias("c"))
        .filter("node <> c")
        .select(*ordered(F.col("node"), F.col("c")))
        .distinct()
    )
    pairs = stored(pairs, "pairs")
    links = stored(compared(pairs, texts), "links")
    parts = stored(components(links), "parts")
    tokens = mixed_shingles(buckets, texts, parts)
    # Most texts beside a large class are similar to a typical text of it; these join it first, so that
    # few are left to be held against all of it.
    for _ in range(ROUNDS):
        some = stored(typical_pairs(by_class(tokens, parts), pairs), "pairs")
        more = stored(compared(some, texts), "links")
        if more.isEmpty():
            break
        pairs, links = pairs.union(some), links.union(more)
        parts = stored(components(links), "parts")
    left = stored(missing_pairs(by_class(tokens, parts), pairs), "candidates")
    together = FIRST
    while not left.isEmpty():
        left = rooted(left, parts)
        turn = F.row_number().over(Window.partitionBy("ra", "rb").orderBy(F.desc("shared"), "a", "b"))
        left = stored(left.select("a", "b", "shared", (turn <= together).alias("now")), "candidates")
        more = stored(compared(left.filter("now").select("a", "b"), texts), "links")
        if not more.isEmpty():
            links = links.union(more)
            parts = stored(components(links), "parts")
        left, together = left.filter("NOT now").drop("now"), together * 64
    grouped = nodes.select("node", "first").join(
        parts.select(F.col("node").alias("p"), "root"), F.col("node") == F.col("p"), "left"
    ).select("node", "first", F.coalesce("root", "node").alias("root"))
    # Of a class, the node with the least id stands for it; nodes without an id come last.
    least = grouped.groupBy(F.col("root").alias("r")).agg(
        F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("least")
    )
    found = grouped.join(least, F.col("root") == F.col("r")).select(
        "node", "first", F.col("least.node").alias("class_node"), F.col("least.first").alias("class_id")
    )
    return rows, stored(found, "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the least doc_id of its class; one row per row of `docs`.

    Equal texts are one class, empty ones too. A null text is a class of its own. Texts of fewer
    than five words are similar only if their words are the same. Long texts are sketched and aligned
    whole. Repeated rows share their class; a class without ids has a null one. An empty table gives
    an empty one; other columns are not read.
    """
    rows, nodes = classes(docs)
    known = nodes.select(F.col("node").alias("n"), "class_id")
    joined = rows.join(known, F.col("node") == F.col("n"), "left")
    return joined.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns: the one of least doc_id. Rows with null texts stay."""
    _, nodes = classes(docs)
    kept = nodes.filter("node = class_node").select(F.col("node").alias("k"), F.col("first").alias("f"))
    packed = docs.filter("text IS NOT NULL").select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        node_of(F.col("text")).alias("node"),
        F.col("doc_id").alias("id"),
    )
    alone = Window.partitionBy("node", "id").orderBy(F.xxhash64("doc"))
    chosen = (
        packed.join(kept, (F.col("node") == F.col("k")) & F.col("id").eqNullSafe(F.col("f")))
        .withColumn("r", F.row_number().over(alone))
        .filter("r = 1")
        .select("doc.*")
    )
    return chosen.unionByName(docs.filter("text IS NULL"))
