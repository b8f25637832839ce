"""Language identification by interpolated Kneser-Ney models of characters.

Grams of up to four letters are counted over all training texts; counts, continuation counts,
discounts and interpolated probabilities are tables that Spark computes. The model of a language is
sorted arrays of 64-bit gram keys with log-probabilities and back-off weights, in files of the
shared folder, which tasks load. A text gets the language of the lowest cross-entropy per letter,
and is accepted if that is not above what texts of that language and length reach which the models
have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlab.llm.common import opened, stored
from stationlab.session import scratch_path

ORDER = 4
CHUNK = 1 << 20
HELD = 1 << 20
SLICE = 256
ACCEPTED = 0.999
CALIBRATED = 5
LEAN = 5
UNDETERMINED = "und"
UNKNOWN = float(np.log(1e-6))

_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])
# Codes of the first plane that are never letters, surrogates and private use, stand for the letters of
# all other planes: each of these keeps a code of its own block of SPARE.
SPARE_FROM, SPARE = 0xD800, 0x2100


def coded(text: str | None) -> np.ndarray:
    """Lower-case letters as 16-bit codes, words divided by one space, with spaces before and after;
    empty for a text without letters."""
    whole = (text or "").lower()
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = _LETTER[codes & 0xFFFF] & (codes < 1 << 16)
    beyond = np.flatnonzero(codes >= 1 << 16)
    letters[beyond] = [chr(c).isalpha() for c in codes[beyond]]
    if not letters.any():
        return np.zeros(0, np.uint64)
    codes = np.where(codes < 1 << 16, codes, SPARE_FROM + codes % SPARE)
    codes = np.where(letters, codes, 32)
    codes = codes[letters | np.r_[False, letters[:-1]]]
    pad = [32] * (ORDER - 1)
    return np.concatenate([pad, codes, [32] if codes[-1] != 32 else []]).astype(np.uint64)


def keys_of(codes: np.ndarray) -> np.ndarray:
    """Keys of the grams that end at each place after the padding: four codes in 64 bits."""
    n = len(codes) - ORDER + 1
    keys = np.zeros(n, np.uint64)
    for i in range(ORDER):
        keys = keys << np.uint64(16) | codes[i : i + n]
    return keys


def mask(order: int) -> int:
    return (1 << 16 * order) - 1


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of (lang, text): each task counts and merges, Spark adds up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows(lang: str) -> pa.RecordBatch:
            keys, n = held.pop(lang)
            langs = pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int32)))
            columns = [langs, pa.array(keys.view(np.int64)), pa.array(n)]
            return pa.record_batch(columns, names=["lang", "gram", "n"])

        def merge(lang: str) -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            if lang in held:
                keys, at = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                n = np.bincount(at, np.concatenate([held[lang][1], n]), len(keys))
            held[lang] = (keys, n.astype(np.int64))
            if len(keys) > HELD:
                yield rows(lang)

        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                some = batch.slice(low, SLICE)
                for lang, text in zip(*[some.column(c).to_pylist() for c in ("lang", "text")]):
                    codes = coded(text)
                    for at in range(0, max(0, len(codes) - ORDER + 1), CHUNK):
                        keys = keys_of(codes[at : at + CHUNK + ORDER - 1])
                        waiting.setdefault(lang, []).append(keys)
                        if sum(map(len, waiting[lang])) >= CHUNK:
                            yield from merge(lang)
        for lang in list(waiting):
            yield from merge(lang)
        for lang in list(held):
            yield rows(lang)

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(order, lang, gram, logp, gamma): gamma is the back-off weight of the gram as a context.

    The highest order uses counts, each lower one the number of different letters before a gram.
    """
    tables = {ORDER: stored(counts, "grams")}
    for order in range(ORDER - 1, 0, -1):
        above = tables[order + 1]
        shorter = F.col("gram").bitwiseAND(F.lit(mask(order)))
        tables[order] = above.groupBy("lang", shorter.alias("gram")).agg(
            F.count(F.lit(1)).alias("n")
        )
    letters = stored(tables[1].select("gram").distinct().agg(F.count(F.lit(1)).alias("v")), "letters")
    size = (letters.first()[0] or 0) + 1
    lower, out = None, []
    for order in range(1, ORDER + 1):
        grams = tables[order].withColumn("context", F.shiftrightunsigned("gram", 16))
        d = grams.groupBy("lang").agg(
            F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("n1"),
            F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("n2"),
        )
        d = d.select(
            F.col("lang").alias("dl"),
            F.greatest(
                F.lit(0.1),
                F.least(F.lit(0.95), F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))),
            ).alias("d"),
        )
        contexts = grams.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")
        )
        contexts = contexts.join(d, F.col("lang") == F.col("dl")).select(
            F.col("lang").alias("cl"), F.col("context").alias("c"), "total", "d",
            (F.col("d") * F.col("types") / F.col("total")).alias("weight"),
        )
        rows = grams.join(contexts, (F.col("lang") == F.col("cl")) & (F.col("context") == F.col("c")))
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        if lower is None:
            rows = rows.withColumn("p", own + F.col("weight") / F.lit(float(size)))
        else:
            below = lower.select(
                F.col("lang").alias("bl"), F.col("gram").alias("b"), F.col("p").alias("bp")
            )
            shorter = F.col("gram").bitwiseAND(F.lit(mask(order - 1)))
            rows = rows.join(below, (F.col("lang") == F.col("bl")) & (shorter == F.col("b")))
            rows = rows.withColumn("p", own + F.col("weight") * F.col("bp"))
        lower = stored(rows.select("lang", "gram", "n", "p"), f"kneser-ney-{order}")
        out.append(lower.select(F.lit(order).alias("order"), "lang", "gram", F.log("p").alias("logp")))
        if order > 1:
            gamma = contexts.select(
                F.lit(-order).alias("order"), F.col("cl").alias("lang"), F.col("c").alias("gram"),
                F.log("weight").alias("logp"),
            )
            out.append(gamma)
        else:
            floor = contexts.select(
                F.lit(-1).alias("order"), F.col("cl").alias("lang"), F.lit(0).cast("long").alias("gram"),
                F.log(F.col("weight") / F.lit(float(size))).alias("logp"),
            )
            out.append(floor)
    model = out[0]
    for part in out[1:]:
        model = model.union(part)
    return model


class Models:
    """The models of all languages side by side: for each order the sorted keys of the grams that
    any language knows, with one column of log-probabilities for each language."""

    def __init__(self, rows: pd.DataFrame):
        self.langs = sorted(rows["lang"].unique())
        self.grams: dict[int, np.ndarray] = {}
        self.values: dict[int, np.ndarray] = {}
        self.contexts: dict[int, np.ndarray] = {}
        self.gammas: dict[int, np.ndarray] = {}
        code = {lang: i for i, lang in enumerate(self.langs)}
        column = rows["lang"].map(code).to_numpy()
        keys, order = rows["gram"].to_numpy().view(np.uint64), rows["order"].to_numpy()
        logp = rows["logp"].to_numpy()
        self.floor = np.full(len(self.langs), UNKNOWN)
        first = order == -1
        self.floor[column[first]] = logp[first]
        for k in range(2, ORDER + 1):
            at = order == -k
            self.contexts[k] = np.unique(keys[at])
            self.gammas[k] = np.zeros((len(self.contexts[k]), len(self.langs)), np.float32)
            self.gammas[k][np.searchsorted(self.contexts[k], keys[at]), column[at]] = logp[at]
        for k in range(1, ORDER + 1):
            at = order == k
            self.grams[k] = np.unique(keys[at])
            values = self.backed_off(self.grams[k], k)
            values[np.searchsorted(self.grams[k], keys[at]), column[at]] = logp[at]
            self.values[k] = values.astype(np.float32)

    def backed_off(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Log-probabilities of grams as no language knows them at order k."""
        if k == 1:
            return np.tile(self.floor, (len(keys), 1))
        out = self.lookup(keys & np.uint64(mask(k - 1)), k - 1)
        contexts = keys >> np.uint64(16)
        if len(self.contexts[k]):
            at = np.minimum(np.searchsorted(self.contexts[k], contexts), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == contexts
            out[known] += self.gammas[k][at[known]]
        return out

    def lookup(self, keys: np.ndarray, k: int = ORDER) -> np.ndarray:
        """Log-probability of the last letter of each gram, one column for each language."""
        if not len(self.grams[k]):
            return self.backed_off(keys, k)
        at = np.minimum(np.searchsorted(self.grams[k], keys), len(self.grams[k]) - 1)
        out = self.values[k][at].astype(np.float64)
        missed = self.grams[k][at] != keys
        if missed.any():
            out[missed] = self.backed_off(keys[missed], k)
        return out

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(nats per letter, a row per text and a column per language; letters per text)."""
        sums, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        keys, owners, held = [], [], 0

        def flush() -> None:
            nonlocal keys, owners, held
            if keys:
                values = self.lookup(np.concatenate(keys))
                starts = np.cumsum([0, *map(len, keys)])[:-1]
                np.add.at(sums, owners, np.add.reduceat(values, starts))
            keys, owners, held = [], [], 0

        for i, text in enumerate(texts):
            codes = coded(text)
            sizes[i] = max(0, len(codes) - ORDER + 1)
            for low in range(0, int(sizes[i]), CHUNK // 4):
                keys.append(keys_of(codes[low : low + CHUNK // 4 + ORDER - 1]))
                owners.append(i)
                held += len(keys[-1])
                if held >= CHUNK // 4:
                    flush()
        flush()
        return -sums / np.maximum(sizes, 1)[:, None], sizes


@lru_cache(maxsize=1)
def load_models(folder: str) -> Models | None:
    """The models in a folder, read once in each Python process."""
    import pyarrow.parquet as pq

    fs, path = opened(folder)
    rows = pq.read_table(path, filesystem=fs).to_pandas()
    return Models(rows) if len(rows) else None


def scored(rows: DataFrame, folder: str) -> DataFrame:
    """The columns of `rows` but the text, with lang, entropy, letters and score of each whole text;
    the language is null without letters. Texts are taken from Arrow a few at a time."""
    kept = [c for c in rows.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = load_models(folder)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                some = batch.slice(low, SLICE)
                n = some.num_rows
                found = [pa.nulls(n, pa.string()), np.zeros(n), np.zeros(n, np.int64), np.zeros(n)]
                if models is not None:
                    entropy, letters = models.entropies(some.column("text").to_pylist())
                    best = entropy.argmin(1)
                    lowest = entropy[np.arange(n), best]
                    gap = np.minimum((entropy - lowest[:, None]) * letters[:, None], 50)
                    values = np.where(letters > 0, 1 / np.exp(-gap).sum(1), 0.0)
                    langs = [models.langs[i] if m else None for i, m in zip(best, letters)]
                    found = [pa.array(langs, pa.string()), lowest, letters, values]
                columns = [some.column(c) for c in kept] + [pa.array(x) for x in found]
                yield pa.record_batch(columns, names=[*kept, "lang", "entropy", "letters", "score"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(
        score, f"{types}, lang string, entropy double, letters long, score double"
    )


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3


def unseen(text: Column) -> Column:
    """One text in CALIBRATED of those that may be learnt from: the counts leave it out, so that it
    can tell how unseen texts score. Copies of a text are on one side."""
    return F.pmod(F.xxhash64(F.lit("unseen"), text), F.lit(CALIBRATED)) == 0


def limits(found: DataFrame) -> DataFrame:
    """(l, g, limit): the highest accepted entropy per language and length (a power of two of letters).

    From unseen texts (lang, length, entropy) told right: their distances from the mean of their
    language and length, in standard deviations, are pooled, and the limit is their quantile at
    ACCEPTED, corrected for their number; without enough of them everything is accepted. Groups of
    few texts lean on the spread of their language, and a length without texts has no limit.
    """
    steps = (
        found.groupBy("lang", "length", F.round(F.col("entropy") * 1000).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    x, n = F.col("step") / 1000, F.col("n")
    sums = [F.sum(n).alias("n"), F.sum(n * x).alias("x"), F.sum(n * x * x).alias("xx")]
    groups = stored(steps.groupBy("lang", "length").agg(*sums), "language-groups")
    spread = (F.col("xx") - F.col("x") * F.col("x") / n).alias("ss")
    whole = groups.select("lang", "n", spread).groupBy("lang").agg(
        (F.sum("ss") / F.sum("n")).alias("pooled")
    )
    # The variance of a group, with its language's counting for LEAN texts more.
    groups = groups.select("lang", "length", "n", (F.col("x") / n).alias("mean"), spread)
    groups = groups.join(F.broadcast(whole.withColumnRenamed("lang", "wl")), F.col("lang") == F.col("wl"))
    variance = (F.col("ss") + LEAN * F.col("pooled")) / (F.col("n") + LEAN)
    groups = groups.select(
        F.col("lang").alias("l"), F.col("length").alias("g"), F.col("n").alias("texts"), "mean",
        F.greatest(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.001)).alias("sd"),
    )
    # The mean of few texts is uncertain itself.
    wide = F.col("sd") * F.sqrt(1 + 1 / F.col("texts"))
    steps = steps.join(F.broadcast(groups), (F.col("lang") == F.col("l")) & (F.col("length") == F.col("g")))
    scores = steps.groupBy(F.round((x - F.col("mean")) / wide, 2).alias("z")).agg(F.sum(n).alias("n"))
    upto = F.sum("n").over(Window.orderBy("z"))
    total = F.sum("n").over(Window.partitionBy())
    limit = scores.select("z", upto.alias("upto"), total.alias("total"))
    reached = limit.filter(F.col("upto") >= F.ceil((F.col("total") + 1) * ACCEPTED))
    quantile = F.lit(reached.agg(F.min("z")).first()[0]).cast("double")
    return groups.select("l", "g", (F.col("mean") + quantile * wide).alias("limit"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, accepted, one row per row of `docs`.

    Learns from rows with a text, a language and an id whose remainder is not 1; only the text is
    scored, whole, however long. `und` with score 0 is given where a text is null or has no letter,
    and where nothing was learnt. Equal entropies give the first language by code point; equal texts
    get equal results. A text is accepted if its entropy is at most the limit of its language and
    length, learnt from a fifth of the texts to learn from that the models have not seen. An empty
    table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    learnt = docs.filter(
        (remainder(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    folder = scratch_path(spark, "language-models")
    model = kneser_ney(gram_counts(learnt.filter(~unseen(F.col("text")))))
    model.repartitionByRange("lang", "order", "gram").sortWithinPartitions(
        "lang", "order", "gram"
    ).write.parquet(folder)
    rows = docs.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.when((remainder(F.col("doc_id")) != 1) & unseen(F.col("text")), F.col("lang")).alias("told"),
        "text",
    )
    found = stored(scored(rows, folder), "languages")
    found = found.withColumn("length", F.floor(F.log2(F.greatest("letters", F.lit(1)))))
    # One row per language and power of two.
    most = F.broadcast(limits(found.filter("told = lang")))
    judged = found.join(most, (F.col("lang") == F.col("l")) & (F.col("length") == F.col("g")), "left")
    return judged.select(
        "doc_id",
        "held_out",
        F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang_pred"),
        "score",
        "entropy",
        (F.col("lang").isNotNull() & (F.col("entropy") <= F.coalesce("limit", "entropy"))).alias(
            "accepted"
        ),
    )
