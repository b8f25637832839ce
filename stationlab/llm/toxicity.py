"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on windows of toxic text
whose compressed lengths tell the two kinds apart. A window of a text is compressed with the ordinary
dictionary alone and with the toxic one stacked on it; the bytes saved are its gain. The gains of all
windows of a text give a score by a logistic curve fitted on labelled texts that the dictionaries have
not seen.

Toxic text is mostly like ordinary text, so a dictionary of all of it says little. Windows are chosen
by compressed lengths alone. First those that a dictionary of the other half's toxic windows shortens
most against one of as many ordinary windows. Each of these is then tried as a dictionary by itself:
it stays if it shortens toxic texts more than ordinary ones beyond chance, and is halved as long as a
half has nearly the effect of the whole.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import lean, stored

WINDOW = 12
# The sample of labelled texts: distinct whole texts, about so many bytes of each label, each text
# counted with TEXT_BYTES more; a task learns from at most a tenth more than that.
TOXIC_BYTES = 4_000_000
ORDINARY_BYTES = 6_000_000
TEXT_BYTES = 64
ORDINARY_DICTIONARY = 65_536
TOXIC_DICTIONARY = 4_096
# Windows of the ordinary dictionary.
ORDINARY_WINDOWS = 60_000
# Words of the windows that are chosen from, and the shares that each round of choice keeps.
SHORT = 4
KEPT = (0.3, 0.1)
CANDIDATES = 600
# Windows of each kind on which a candidate is tried, and the end of the ordinary dictionary it is
# stacked on there.
TRIED, BASE = 2500, 16_384
# A candidate's effect is the difference of the mean bytes saved in toxic and in ordinary texts, in
# standard errors. It must reach EFFECT, and a half must reach so much of its window's.
EFFECT, HALF = 3.0, 0.7
LEVELS = (1, 2, 3, 4, 6)
MODEL = "ordinary binary, toxic binary, weights array<double>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Runs of `size` words with spaces around, no word in two runs."""
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters.from_level(
        3,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = _parameters()
    content = zstandard.ZstdCompressionDict(dictionary, zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)


@dataclass
class Model:
    """Everything a task needs; its size is bounded by the dictionaries."""

    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def scores(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.weights, self.toxic = np.array(model.weights), model.toxic
        self.plain = compressor(model.ordinary) if model.toxic else None
        self.stacked = compressor(model.ordinary + model.toxic) if model.toxic else None

    def features(self, text: str | None) -> np.ndarray:
        """Of the gains: largest, mean of the three largest, mean, shares above five levels; and
        the logarithm of the number of windows. A text without words has none of all."""
        found = windows(words_of(text)) if self.plain else []
        if not found:
            return np.zeros(9)
        plain, stacked = self.plain.compress, self.stacked.compress
        gains = np.array([len(plain(w)) - len(stacked(w)) for w in found], float)
        n = len(gains)
        top = np.sort(gains)[-3:]
        shares = [(gains >= level).sum() / n for level in LEVELS]
        return np.array([gains.max(), top.mean(), gains.mean(), *shares, math.log(n)])

    def score(self, text: str | None) -> float:
        x = self.weights[0] + self.features(text) @ self.weights[1:]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def trained(size: int, samples: list[bytes], **options) -> bytes:
    """A dictionary's bytes; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (constant first) by Newton's method on scaled columns, with a small penalty."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    b = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [0.1] * x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge
        b += np.linalg.solve(h, z.T @ (y - p) - ridge @ b)
    w = b[1:] / spread
    return np.r_[b[0] - w @ mean, w]


def distinct(texts: list[list[bytes]], size: int) -> list[bytes]:
    return list(dict.fromkeys(w for words in texts for w in windows(words, size)))


def shortest(pools: list[list[list[bytes]]], base: bytes, rng: random.Random) -> list[bytes]:
    """Of toxic windows, those that toxic windows shorten most against ordinary ones.

    `pools` holds two halves of the windows of either label. A half is measured with dictionaries of
    the other one; as many ordinary windows are chosen by the same measure, so that what looks toxic
    by chance weighs on both sides."""
    n = min(len(half) for pool in pools for half in pool)
    chosen = [[rng.sample(half, n) for half in pool] for pool in pools]
    for share in KEPT:
        packers = [[compressor(base + b"".join(half)).compress for half in pool] for pool in chosen]
        chosen = [[[], []], [[], []]]
        for label, pool in enumerate(pools):
            for i, half in enumerate(pool):
                plain, toxic = packers[0][1 - i], packers[1][1 - i]
                gains = np.array([len(plain(w)) - len(toxic(w)) for w in half])
                best = np.argsort(-gains, kind="stable")[: max(60, int(n * share))]
                chosen[label][i] = [half[k] for k in best]
    return [w for pair in zip(*chosen[1]) for w in pair][:CANDIDATES]


class Trial:
    """Tries windows as dictionaries on some windows of toxic and of ordinary texts."""

    def __init__(self, toxic: list, ordinary: list, base: bytes, rng: random.Random):
        self.base, self.known = base, {}
        plain = compressor(base).compress
        self.kinds = []
        for texts in (toxic, ordinary):
            texts = [t for t in (distinct([words], WINDOW) for words in texts) if t]
            texts = rng.sample(texts, min(len(texts), TRIED // 2))
            each = max(2, TRIED // max(1, len(texts)))
            drawn: dict[bytes, int] = {}
            for owner, found in enumerate(texts):
                for w in rng.sample(found, min(each, len(found))):
                    drawn.setdefault(w, owner)
            owners = np.unique(list(drawn.values()), return_inverse=True)[1]
            self.kinds.append((list(drawn), owners, np.array([len(plain(w)) for w in drawn])))

    def effect(self, window: bytes) -> float:
        """The toxic text that saves most, which may be the window's own, is left out."""
        if window not in self.known:
            packed = compressor(self.base + window).compress
            means = []
            for found, owners, lengths in self.kinds:
                saved = lengths - np.array([len(packed(w)) for w in found])
                means.append(np.bincount(owners, saved) / np.bincount(owners))
            toxic, ordinary = np.sort(means[0])[:-1], means[1]
            error = math.sqrt(toxic.var() / len(toxic) + ordinary.var() / len(ordinary) + 1e-9)
            self.known[window] = float((toxic.mean() - ordinary.mean()) / error)
        return self.known[window]

    def halved(self, window: bytes, size: int) -> list[bytes]:
        """The window, or its parts of `size` words that have nearly its effect."""
        need = max(EFFECT, HALF * self.effect(window))
        parts = [p for p in windows(window.split(), size) if p != window]
        return [p for p in parts if self.effect(p) >= need] or [window]


def telling_windows(toxic: list, ordinary: list, base: bytes) -> list[bytes]:
    """Windows of toxic text (each text is a list of words), those of most effect last. Where none
    has an effect beyond chance, those that the first choice puts first."""
    rng = random.Random(1)
    halves = [distinct(toxic[i::2], SHORT) for i in range(2)]
    others = distinct(ordinary, SHORT)
    rng.shuffle(others)
    pools = [[others[0::2], others[1::2]], halves]
    if not all(half for pool in pools for half in pool):
        return distinct(toxic, SHORT)
    candidates = shortest(pools, base, rng)
    trial = Trial(toxic, ordinary, base[-BASE:], rng)
    if min(len(set(owners)) for _, owners, _ in trial.kinds) < 3:
        return candidates[::-1]
    found = [w for w in candidates if trial.effect(w) >= EFFECT]
    for size in (SHORT // 2, 1):
        found = [part for w in found for part in trial.halved(w, size)]
    return sorted(dict.fromkeys(found), key=trial.effect) or candidates[:20][::-1]


def fit(rows: list[tuple[str, int]]) -> Model:
    """A model from labelled distinct texts in a fixed order: two thirds for the dictionaries, one for
    the curve. Without both labels in either it gives every text the share of toxic."""
    labels = [label for _, label in rows]
    share = (sum(labels) + 0.5) / (len(rows) + 1) if rows else 0.0
    prior = math.log(share / (1 - share)) if rows else -30.0
    nothing = Model(b"", b"", [min(prior, -0.1), *[0.0] * 9])
    learnt, unseen = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    toxic, ordinary = [[words_of(t) for t, label in learnt if label == kind] for kind in (1, 0)]
    if not any(toxic) or not any(ordinary) or len({label for _, label in unseen}) < 2:
        return nothing
    plain = trained(ORDINARY_DICTIONARY, distinct(ordinary, WINDOW)[:ORDINARY_WINDOWS])
    telling = telling_windows(toxic, ordinary, plain)
    scorer = Scorer(Model(plain, b"".join(telling)[-TOXIC_DICTIONARY:], [0.0] * 10))
    x = np.array([scorer.features(text) for text, _ in unseen])
    y = np.array([label for _, label in unseen])
    return Model(plain, scorer.toxic, logistic(x, y).tolist())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(digest, text, label): labelled distinct texts outside the held-out fifth, drawn by a hash of
    the text so that about the bytes above are expected of each label; where there are fewer, all.

    A text with several labels counts as toxic if one of them says so. Labels without a text, or of
    neither kind, are left aside.
    """
    known = (
        labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .filter(~held_out(F.col("doc_id")))
    )
    texts = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select(
        "doc_id", F.md5("text").alias("digest"), F.octet_length("text").alias("size")
    )
    rows = (
        texts.groupBy("doc_id", "digest")
        .agg(F.max("size").alias("size"))
        .join(known, "doc_id")
        .groupBy("digest")
        .agg(
            F.max("label").alias("label"),
            F.max(F.col("size") + TEXT_BYTES).alias("bytes"),
            F.min("doc_id").alias("doc_id"),
        )
    )
    rows = stored(rows, "labelled")
    totals = rows.groupBy("label").agg(F.sum("bytes").alias("bytes")).collect()
    share = {0: 1.0, 1: 1.0}
    for label, size in totals:
        share[label] = min(1.0, (ORDINARY_BYTES, TOXIC_BYTES)[label] / max(size, 1))
    draw = F.shiftrightunsigned(F.xxhash64("digest"), 11) / F.lit(float(1 << 53))
    drawn = rows.filter(
        draw <= F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    ).select(F.col("doc_id").alias("d"), F.col("digest").alias("h"), "label")
    # The drawn rows are as few as the bytes above divided by TEXT_BYTES; texts are read again.
    taken = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("d"))
    taken = taken.filter(F.md5("text") == F.col("h"))
    return taken.groupBy(F.col("h").alias("digest")).agg(
        F.first("text").alias("text"), F.first("label").alias("label")
    )


def learnt(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, fitted by one task from the bounded sample; the driver gets its few kilobytes."""

    @lean("toxicity")
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, left = [], [ORDINARY_BYTES * 1.1, TOXIC_BYTES * 1.1]
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                left[label] -= len(text.encode()) + TEXT_BYTES
                if left[label] >= 0:
                    rows.append((text, label))
        model = fit(rows)
        columns = [pa.array([x], t) for x, t in zip(
            (model.ordinary, model.toxic, model.weights), (pa.binary(), pa.binary(), pa.list_(pa.float64()))
        )]
        yield pa.record_batch(columns, names=["ordinary", "toxic", "weights"])

    ordered = sample(docs, labels).repartition(1).sortWithinPartitions("digest")
    found = ordered.mapInArrow(learn, MODEL).first()
    return Model(bytes(found.ordinary), bytes(found.toxic), list(found.weights)) if found else fit([])


def scored(text: Column, model: Model) -> Column:
    """The score of each text, whole; null and empty texts are scored as texts without words."""

    @F.pandas_udf("double")
    @lean("toxicity")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scores()
        for batch in batches:
            yield pd.Series([scorer.score(t) for t in batch], dtype="float64")

    return udf(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of `docs` (repeated rows too).

    Only doc_id and text are read, and only the text is scored, whole, however long. A null id is
    never held out. Equal texts get equal scores, null and empty ones those of a text without words.
    Without labels of both kinds nothing is predicted toxic. Empty tables give empty ones.
    """
    model = learnt(docs, labels)
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(F.col("text"), model).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows not predicted toxic, with their columns, repeated rows each. Null, empty and long texts
    are scored as in `toxicity`; without labels of both kinds all stay; an empty table stays empty."""
    model = learnt(docs, labels)
    return docs.filter(scored(F.col("text"), model) < 0.5)
