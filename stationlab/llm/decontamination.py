"""Benchmark decontamination with edits, by pigeonhole.

A test item that occurs in a text with at most k edits leaves one of k + 1 pieces of it unchanged.
All pieces of all items are looked up at once (Aho-Corasick); around each hit, Myers' bit-parallel
distance decides. Items and texts are compared as lower-case letters and digits with single spaces.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import KEPT, lean, opened, stored
from stationlab.session import path_exists, scratch_path

RATE = 0.06
# Shorter items have no budget and must begin and end with words; those below SHORT characters are found
# only where they are the whole text, as they occur in ordinary text by chance.
MIN_CHARS, SHORT = 24, 12
# From here on, scripts do not put spaces between words.
UNSPACED = 0x2E80
BLOCK_BYTES = 16_000_000
SLICE = 256

HITS = "array<struct<item_id: long, distance: int, begin: int, end: int>>"
HIT_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])
)

_WORDLIKE = np.array([chr(c).isalnum() for c in range(1 << 16)])


def normalised(text: str | None) -> str:
    """Lower-case letters and digits; everything else is a single space, none at the ends."""
    lower = unicodedata.normalize("NFC", text or "").lower()
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return ""
    kept = np.where(codes < 1 << 16, _WORDLIKE[codes & 0xFFFF], True)
    codes = np.where(kept, codes, 32).astype("<u4")
    repeated = ~kept & np.r_[True, ~kept[:-1]]
    return codes[~repeated].tobytes().decode("utf-32-le").rstrip(" ")


def budget(n: int, rate: float) -> int:
    """Edits allowed in an item of n characters."""
    return int(n * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of about equal length, each with its place."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str) -> tuple[int, int]:
    """(least number of edits between the item and a part of the text, first end of such a part)."""
    n = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end = full, 0, n, n, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        equal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(equal | plus)
        down = plus & equal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1, down << 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full
        if score < best:
            best, end = score, at
    return best, end


def at_words(text: str, begin: int, end: int) -> bool:
    """Whether a part of a normalised text begins and ends with a word."""

    def limit(outer: int, inner: int) -> bool:
        if not 0 <= outer < len(text) or " " in (text[outer], text[inner]):
            return True
        return min(ord(text[outer]), ord(text[inner])) >= UNSPACED

    return limit(begin - 1, begin) and limit(end, end - 1)


class Matcher:
    """Finds which of some items occur in a text with at most their budget of edits."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.items = [(i, text, budget(len(text), rate)) for i, text in items if text]
        self.whole: dict[str, list[int]] = {}
        self.pieces = ahocorasick.Automaton()
        for number, (_, text, k) in enumerate(self.items):
            if len(text) < SHORT:
                self.whole.setdefault(text, []).append(number)
                continue
            for place, piece in pieces(text, k if len(text) >= MIN_CHARS else 0):
                known = self.pieces.get(piece, None)
                if known is None:
                    self.pieces.add_word(piece, known := [])
                known.append((number, place + len(piece)))
        self.searchable = len(self.pieces) > 0
        if self.searchable:
            self.pieces.make_automaton()

    def find(self, text: str | None) -> list[tuple]:
        """(item_id, distance, begin, end), the best place of each item; places are of the
        normalised text."""
        plain = normalised(text)
        best = {n: (0, 0, len(plain)) for n in self.whole.get(plain, ())}
        seen: dict[int, list[int]] = {}
        for last, owners in self.pieces.iter(plain) if self.searchable else ():
            for number, upto in owners:
                _, item, k = self.items[number]
                begin = last + 1 - upto
                if len(item) < MIN_CHARS:
                    if number not in best and at_words(plain, begin, begin + len(item)):
                        best[number] = (0, begin, begin + len(item))
                    continue
                # The stretch looked at around a begin holds every match that begins k nearer.
                if any(abs(begin - b) <= k for b in seen.get(number, ())):
                    continue
                seen.setdefault(number, []).append(begin)
                low = max(0, begin - 2 * k)
                part = plain[low : begin + len(item) + 2 * k]
                distance, end = myers(item, part)
                if distance <= k and (number not in best or distance < best[number][0]):
                    back, size = myers(item[::-1], part[:end][::-1])
                    best[number] = (distance, low + end - size, low + end)
        return [(self.items[n][0], *found) for n, found in sorted(best.items())]


def stored_blocks(items: DataFrame, block_bytes: int) -> list[str]:
    """Folders of the items as (item_id, text), each of about `block_bytes` at most. Tasks read them
    there, so that neither the driver nor a task holds more items than a block."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    folder = scratch_path(items.sparkSession, "benchmark-items")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    if blocks:
        rows.withColumn("block", block).write.partitionBy("block").parquet(folder)
    found = [f"{folder}/block={i}" for i in range(blocks)]
    return [f for f in found if path_exists(items.sparkSession, f)]


@lru_cache(maxsize=1)
def matcher_of(folder: str, rate: float) -> Matcher:
    """The matcher of a block, one at a time in each Python process."""
    import pyarrow.parquet as pq

    fs, path = opened(folder)
    rows = pq.read_table(path, filesystem=fs, columns=["item_id", "text"], partitioning=None).to_pydict()
    known = ((i, normalised(text)) for i, text in zip(rows["item_id"], rows["text"]))
    return Matcher(sorted(known, key=lambda x: (x[0] is None, x)), rate)


KEPT["decontamination"] = matcher_of.cache_clear


def hits_of(rows: DataFrame, folder: str, rate: float) -> DataFrame:
    """The columns of `rows` but the text, with the hits of a block, where there are any."""
    kept = [f for f in rows.schema.fields if f.name != "text"]

    @lean("decontamination")
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(folder, rate)
        names = ("item_id", "distance", "begin", "end")
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                some = batch.slice(low, SLICE)
                found = [matcher.find(text) for text in some.column("text").to_pylist()]
                at = pa.array([i for i, hits in enumerate(found) if hits], pa.int64())
                hits = pa.array([[dict(zip(names, x)) for x in h] for h in found if h], HIT_TYPE)
                columns = [some.column(f.name).take(at) for f in kept] + [hits]
                yield pa.record_batch(columns, names=[*[f.name for f in kept], "hits"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(search, f"{types}, hits {HITS}")


def contamination(
    docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document and item in it: doc_id, item_id, distance, begin, end.

    Null and empty texts hold nothing; items without letters or digits are found nowhere. Items under
    MIN_CHARS normalised characters are found without edits, at word limits; those under SHORT only
    where they are the whole text. Repeated rows and repeated items are reported each. Texts are
    searched whole, once for each block of items. Other columns are not read; empty tables give an
    empty one.
    """
    rows = docs.select("doc_id", "text")
    found = None
    for folder in stored_blocks(items, block_bytes):
        part = hits_of(rows, folder, rate)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = docs.filter("1 = 0").select("doc_id", F.array().cast(HITS).alias("hits"))
    return found.select("doc_id", F.inline("hits"))


def decontaminated(
    docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows in which no item is found, with their columns; repeated rows, and null and empty texts,
    stay each. As in `contamination`; without items, or in an empty table, nothing is dropped.

    What one block of items leaves is stored before the next one is searched."""
    folders = stored_blocks(items, block_bytes)
    for i, folder in enumerate(folders):
        docs = clean_of(docs, folder, rate)
        if i + 1 < len(folders):
            docs = stored(docs, "clean-of-a-block")
    return docs


def clean_of(docs: DataFrame, folder: str, rate: float) -> DataFrame:
    """The rows in which no item of a block is found."""

    @F.pandas_udf("boolean")
    @lean("decontamination")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = matcher_of(folder, rate)
        for batch in batches:
            yield pd.Series([not matcher.find(text) for text in batch], dtype="bool")

    return docs.filter(clean(F.col("text")))
