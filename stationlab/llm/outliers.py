"""Quality by robust multivariate outliers, per language and source; DataFrame functions only.

Statistics of each text are transformed to four numbers. For each language and source, minimum-
covariance-determinant steps from several starts find location and covariance of the inner half, and
texts whose Mahalanobis distance from them is too large are rejected. Estimates are over distinct
vectors with their counts. All sums are over whole numbers, so results do not depend on their order.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import looked_up, stored

SPACE = r"[\x20\x09-\x0D]"
UNIT = 1024
FEATURES = ("x0", "x1", "x2", "x3")
# Least standard deviations, for statistics which most texts lack: small enough that each of them can
# reject a text alone (5 % symbols, or a fifth of the lines or words repeated where others have none).
LEAST_SPREAD = (0.05, 0.05, 0.10, 0.10)
INNER = 0.5
# Steps end where no determinant falls any more (about ten steps); this bound is not reached.
STEPS = 100
# A start counts as better than the first if its log-determinant is lower by this, and a step as
# better than the one before if its log-determinant is lower by that.
BETTER, FALL = 0.01, 1e-6
# A group below this size shares the estimate of its language's small groups, and these that of all
# languages' small ones; only where those are fewer together, they are not judged.
LEAST_ROWS = 40
EVERYWHERE = "everywhere"
# Quantiles of chi-squared with four degrees of freedom: median, and 0.999.
MEDIAN, LIMIT = 3.3567, 18.467
FINEST = 256


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more.

    Windows are sorted by a 64-bit hash, so that equal ones are neighbours; neighbours of one hash
    are compared word by word."""

    def covered(w: Column) -> Column:
        keys = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

        def repeated(s: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                words_agree = [F.get(w, a["i"] + k) == F.get(w, b["i"] + k) for k in range(3)]
                equal = F.when(a["h"] == b["h"], reduce(and_, words_agree))
                return F.coalesce(equal, F.lit(False))

            found = F.filter(s, lambda x, j: same(F.get(s, j - 1), x) | same(F.get(s, j + 1), x))
            return F.transform(found, lambda x: x["i"])

        at = let(F.sort_array(keys), repeated)
        around = F.transform(at, lambda i: F.array(i, i + 1, i + 2))
        return F.size(F.array_distinct(F.flatten(around))).cast("long")

    return let(words, covered)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of
    every whole text; a null text has none of all."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "doc_id",
        "lang",
        "source",
        let(words, lambda w: F.struct(F.size(w).cast("long"), repeated_words(w))).alias("w"),
        (F.char_length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(
            lines,
            lambda x: F.struct(F.size(x).cast("long"), F.size(F.array_distinct(x)).cast("long")),
        ).alias("l"),
    )
    return counted.select(
        "doc_id", "lang", "source", F.col("w.col1").alias("n_words"), "word_chars", "n_symbols",
        (F.col("l.col1") - F.col("l.col2")).alias("n_dup_lines"),
        F.col("w.col2").alias("n_repeat_words"), F.col("l.col1").alias("n_lines"),
    )


def with_features(rows: DataFrame) -> DataFrame:
    """Adds base_failed and four whole numbers in units of 1/1024: the logarithm of the mean word
    length, and square roots of the shares of symbols, repeated lines and repeated words."""
    share = lambda a, b: F.sqrt(F.least(F.coalesce(F.try_divide(a, b), F.lit(0.0)), F.lit(1.0)))
    c = F.col
    values = (
        F.log(F.greatest(F.coalesce(F.try_divide(c("word_chars"), c("n_words")), F.lit(1.0)), F.lit(1.0))),
        share(c("n_symbols"), c("word_chars")),
        share(c("n_dup_lines"), c("n_lines")),
        share(c("n_repeat_words"), c("n_words")),
    )
    failed = (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))
    return rows.select(
        "*",
        failed.alias("base_failed"),
        *[F.floor(v * UNIT + 0.5).cast("long").alias(x) for x, v in zip(FEATURES, values)],
    )


def group_quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of a whole number per group, from counts (column n) of its values."""
    counts = rows.groupBy(*by, value).agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    counts = counts.withColumn("upto", F.sum("n").over(group.orderBy(value))).withColumn(
        "all", F.sum("n").over(group)
    )
    return counts.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("upto") >= F.col("all") * share, F.col(value))).alias(name)
            for name, share in shares.items()
        ]
    )


def joined(rows: DataFrame, table: DataFrame) -> DataFrame:
    """`rows` with the columns of a table of one row per group."""
    table = table.withColumnRenamed("group", "g")
    return rows.join(table, F.col("group") == F.col("g")).drop("g")


def squared_distance() -> Column:
    """Mahalanobis distance, squared, from columns m (location) and w (rows of the whitening)."""
    total = []
    for j in range(len(FEATURES)):
        y = reduce(
            add, [F.col(f"w{j}{k}") * (F.col(FEATURES[k]) - F.col(f"m{k}")) for k in range(j + 1)]
        )
        total.append(y * y)
    return reduce(add, total)


def with_distance(rows: DataFrame) -> DataFrame:
    """Distances as whole numbers, capped far beyond every limit."""
    d = F.least(squared_distance() * FINEST, F.lit(1e7))
    return rows.withColumn("d", F.floor(d).cast("long"))


P = len(FEATURES)
PLACE = [f"m{j}" for j in range(P)]
WHITE = [f"w{j}{k}" for j in range(P) for k in range(j + 1)]


def starts(vectors: DataFrame) -> DataFrame:
    """(group, start, det, m, w): first locations and spreads. Medians with half the distance of the
    outer sixths; medians with the least spreads; lower quartiles with the least spreads, for groups
    of which more than the upper sixth is unlike the rest."""
    long = vectors.select(
        "group",
        "n",
        F.explode(
            F.array(*[F.struct(F.lit(j).alias("j"), F.col(x).alias("v")) for j, x in enumerate(FEATURES)])
        ).alias("f"),
    ).select("group", "n", "f.j", "f.v")
    q = group_quantiles(long, ["group", "j"], "v", {"low": 0.16, "quarter": 0.25, "mid": 0.5, "high": 0.84})
    at = lambda j, c: F.max(F.when(F.col("j") == j, c))
    spread = (F.col("high") - F.col("low")) / 2.0
    q = q.groupBy("group").agg(
        *[at(j, F.col(c).cast("double")).alias(f"{c}{j}") for j in range(P) for c in ("quarter", "mid")],
        *[at(j, F.greatest(spread, F.lit(least * UNIT))).alias(f"spread{j}") for j, least in enumerate(LEAST_SPREAD)],
    )
    least = [F.lit(x * UNIT) for x in LEAST_SPREAD]
    kinds = [("mid", [F.col(f"spread{j}") for j in range(P)]), ("mid", least), ("quarter", least)]
    made = []
    for i, (place, spreads) in enumerate(kinds):
        white = [1 / spreads[j] if j == k else F.lit(0.0) for j in range(P) for k in range(j + 1)]
        made.append(
            F.struct(
                F.lit(i).alias("start"),
                F.lit(float("inf")).alias("det"),
                *[F.col(f"{place}{j}").alias(f"m{j}") for j in range(P)],
                *[w.alias(name) for w, name in zip(white, WHITE)],
            )
        )
    return q.select("group", F.explode(F.array(*made)).alias("e")).select("group", "e.*")


def stepped(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """(group, start, det, m, w, fell) one step on: location and whitening (inverse Cholesky factor of
    the covariance) of the inner rows of each estimate, the logarithm of the determinant, and whether
    it fell. Of the rows at the very limit of the inner half, each has the same part in the sums."""
    pairs = [(j, k) for j in range(P) for k in range(j + 1)]
    moments = [f"s{j}" for j in range(P)] + [f"s{j}{k}" for j, k in pairs]
    c, n = [F.col(x) for x in FEATURES], F.col("n")
    near = with_distance(joined(vectors, estimate))
    levels = near.groupBy("group", "start", "det", "d").agg(
        F.sum(n).alias("n"),
        *[F.sum(n * c[j]).alias(f"s{j}") for j in range(P)],
        *[F.sum(n * c[j] * c[k]).alias(f"s{j}{k}") for j, k in pairs],
    )
    group = Window.partitionBy("group", "start", "det")
    levels = levels.withColumn("upto", F.sum("n").over(group.orderBy("d"))).withColumn(
        "half", F.ceil(F.sum("n").over(group) * INNER)
    )
    whole, before = F.col("upto") <= F.col("half"), F.col("upto") - n
    part = (F.col("half") - before) / n
    inner = lambda x: (
        F.coalesce(F.sum(F.when(whole, F.col(x))), F.lit(0)) + F.coalesce(F.max(F.when(~whole, part * F.col(x))), F.lit(0.0))
    )
    out = (
        levels.filter(before < F.col("half"))
        .groupBy("group", "start", "det")
        .agg(F.max("half").alias("n"), *[inner(x).alias(x) for x in moments])
    )
    out = out.select("*", *[(F.col(f"s{j}") / n).alias(f"m{j}") for j in range(P)])
    for j, k in pairs:
        value = F.col(f"s{j}{k}") / n - F.col(f"m{j}") * F.col(f"m{k}")
        if j == k:
            value = F.greatest(value, F.lit(0.0)) + F.lit((LEAST_SPREAD[j] * UNIT) ** 2)
        value = reduce(
            lambda a, b: a - b, [F.col(f"l{j}{i}") * F.col(f"l{k}{i}") for i in range(k)], value
        )
        value = F.sqrt(F.greatest(value, F.lit(1.0))) if j == k else value / F.col(f"l{k}{k}")
        out = out.withColumn(f"l{j}{k}", value)
    for k in range(P):
        out = out.withColumn(f"w{k}{k}", 1 / F.col(f"l{k}{k}"))
        for j in range(k + 1, P):
            value = reduce(add, [F.col(f"l{j}{i}") * F.col(f"w{i}{k}") for i in range(k, j)])
            out = out.withColumn(f"w{j}{k}", -value / F.col(f"l{j}{j}"))
    det = reduce(add, [2 * F.log(f"l{j}{j}") for j in range(P)])
    return out.select("group", "start", det.alias("det"), *PLACE, *WHITE, (det < F.col("det") - FALL).alias("fell"))


def estimates(vectors: DataFrame) -> DataFrame:
    """(group, m, w) of least determinant over all starts, stepped until none falls."""
    last, found = stored(starts(vectors), "location"), None
    for _ in range(STEPS):
        last = stored(stepped(vectors, last), "location").filter("fell").drop("fell")
        if last.isEmpty():
            break
        found = last if found is None else found.union(last)
    if found is None:
        return last.select("group", *PLACE, *WHITE)
    rank = F.when(F.col("start") == 0, F.col("det") - BETTER).otherwise(F.col("det"))
    best = found.groupBy("group").agg(F.min(F.struct(rank.alias("rank"), "start", *PLACE, *WHITE)).alias("e"))
    return best.select("group", *[F.col(f"e.{x}") for x in PLACE + WHITE])


def with_groups(rows: DataFrame) -> DataFrame:
    """Adds the group of each of the (stored) rows: language and source (null is a value), or the small
    groups of the language together, or those of all; null where even these are too few."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    named = rows.withColumn("language", name(F.col("lang"))).withColumn(
        "own", F.concat(F.col("language"), F.lit("\n"), name(F.col("source")))
    )
    sizes = named.groupBy("own", "language").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("group", F.when(F.col("n") >= LEAST_ROWS, F.col("own")))
    for wider in (F.col("language"), F.lit(EVERYWHERE)):
        small = F.sum(F.when(F.col("group").isNull(), F.col("n"))).over(Window.partitionBy(wider))
        group = F.coalesce("group", F.when(small >= LEAST_ROWS, wider))
        sizes = sizes.withColumn("group", group)
    sizes = stored(sizes.select("own", "group", "n"), "group-sizes")
    return looked_up(named, sizes, ["own"]).drop("own", "language")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    distance (null where it was not measured), one row per row of `docs`.

    Texts that fail the base rules take no part in the estimates. Null languages and sources are
    groups of their own; groups below LEAST_ROWS are judged together, by language or all, and kept
    where even all of these are fewer. Repeated rows count each and share their verdict; texts are
    counted whole, however long. An empty table gives an empty one; other columns are not read.
    """
    every = stored(with_features(statistics(docs)), "statistics")
    grouped = stored(with_groups(every.filter("NOT base_failed")), "grouped")
    vectors = stored(
        grouped.filter("group IS NOT NULL")
        .groupBy("group", *FEATURES)
        .agg(F.count(F.lit(1)).alias("n")),
        "vectors",
    )
    estimate = stored(estimates(vectors), "estimates")
    middle = group_quantiles(with_distance(joined(vectors, estimate)), ["group"], "d", {"mid": 0.5})
    # The inner rows spread too little; their median distance says by how much.
    scale = F.greatest(F.col("mid") / F.lit(FINEST * MEDIAN), F.lit(1.0)).alias("scale")
    final = stored(joined(estimate, middle).select(*estimate.columns, scale), "estimates")
    sizes = vectors.groupBy(F.col("group").alias("sg")).agg(F.sum("n").alias("n"))
    table = final.join(sizes, F.col("group") == F.col("sg")).drop("sg")
    unjudged = grouped.filter("group IS NULL")
    judged = looked_up(grouped.filter("group IS NOT NULL"), table, ["group"])
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    distance = F.sqrt(squared_distance() / F.col("scale"))
    good = judged.select(
        *shown,
        F.coalesce(squared_distance() <= F.col("scale") * LIMIT, F.lit(True)).alias("kept"),
        distance.alias("distance"),
    )
    alone = unjudged.select(*shown, F.lit(True).alias("kept"), F.lit(None).cast("double").alias("distance"))
    failed = every.filter("base_failed").select(
        *shown, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")
    )
    return good.unionAll(alone).unionAll(failed)
