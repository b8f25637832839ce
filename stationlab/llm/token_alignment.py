"""Alignment of two tokenizers over the same texts, as Arrow columns.

Tokens of a batch of texts are flat columns: list flatten and parent indices give each token its text,
cumulative sums of token lengths, restarted for each text, its end. A hash join on (text, end) finds
where tokens of both kinds end together; between such ends lie the groups. Pairs of ids are counted
per group and text by grouped sums. Documents that hold a pair are counted by each task and merged by
Spark; ids of a pair go into one whole number, the first id in its high half.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import stored

# Characters of text that are aligned at once, and that a process remembers the tokens of.
TOGETHER = 1 << 18
REMEMBERED = 1 << 22
# Parts that a tokenizer gets as one text.
ASKED = 64
# Distinct pairs that a task counts before it hands them on.
HELD = 1 << 20
# Pairs held by at least one in so many of all (document, pair) incidences go to every task: there
# can be no more than that. All other pairs are joined.
FREQUENT = 1 << 18

COLUMNS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<long>"
)
FOUND = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " best long, total long, pairs array<long>, times array<long>"
)


CUT = re.compile(r"(?<=\S) (?=\S)")
# Texts with a space at their begin, their end or beside other white space, which Arrow cannot cut alike.
_WHITE = r"[ \t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN = rf"\A | \z| {_WHITE}|{_WHITE} "


class ByteLevel:
    """Byte-level BPE: encodes texts with a space before them."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Printable bytes stand for themselves, all others for characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = sorted((i, token) for token, i in self.tokenizer.get_vocab().items())
        entries: list[bytes | None] = [b""] * (vocabulary[-1][0] + 1)
        for i, token in vocabulary:
            if all(c in back for c in token):
                entries[i] = bytes(back[c] for c in token)
        self.bytes = pa.array(entries, pa.large_binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch(spaced, add_special_tokens=False)]


class Pieces:
    """Sentence-piece model, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                entries.append(bytes([int(piece[3:5], 16)]))
            else:
                entries.append(piece.replace("▁", " ").encode())
        self.bytes = pa.array(entries, pa.large_binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Kind:
    """The tokens of remembered parts by one tokenizer."""

    def __init__(self, tokenizer):
        self.tokenizer, self.bytes = tokenizer, tokenizer.bytes
        self.lengths = np.asarray(pc.binary_length(tokenizer.bytes), np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def learn(self, parts: list[str]) -> None:
        """Parts go to the tokenizer as texts of ASKED of them; a token belongs to the part in whose
        bytes it ends. Where the tokens have other bytes than the text, each part is asked alone."""
        groups = [parts[i : i + ASKED] for i in range(0, len(parts), ASKED)]
        ids, sizes = [self.ids], [self.sizes]
        for low in range(0, len(groups), ASKED):
            some = groups[low : low + ASKED]
            for group, found in zip(some, self.tokenizer.encode([" ".join(g) for g in some])):
                found = np.array(found, np.int32)
                ends = np.cumsum([len(p.encode()) + 1 for p in group])
                places = np.cumsum(self.lengths[found])
                last = np.searchsorted(places, ends)
                if last[-1] < len(places) and (places[last] == ends).all() and places[-1] == ends[-1]:
                    ids.append(found)
                    sizes.append(np.bincount(np.searchsorted(ends, places), minlength=len(group)))
                else:
                    alone = self.tokenizer.encode(group)
                    ids += [np.array(x, np.int32) for x in alone]
                    sizes.append(np.fromiter(map(len, alone), np.int64, len(alone)))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def lists(self, numbers: np.ndarray, per_text: np.ndarray) -> pa.LargeListArray:
        """The ids of each text, given the numbers of all parts and how many of them a text has."""
        taken = listed(offsets_of(self.sizes), pa.array(self.ids)).take(pa.array(numbers))
        ends = offsets_of(self.sizes[numbers])
        return listed(ends[offsets_of(per_text)], taken.flatten())


def cut(texts: list[str]) -> pa.LargeListArray:
    """The parts of each text; Arrow cuts all but the UNEVEN ones, which CUT does."""
    given = pa.array(texts, pa.large_string())
    uneven = pc.match_substring_regex(given, UNEVEN)
    if not pc.any(uneven).as_py():
        return pc.split_pattern(given, " ").cast(pa.large_list(pa.large_string()))
    even = pc.split_pattern(given.filter(pc.invert(uneven)), " ").cast(pa.large_list(pa.large_string()))
    odd = pa.array([CUT.split(t) for t in given.filter(uneven).to_pylist()], even.type)
    uneven = np.asarray(uneven.to_numpy(zero_copy_only=False), bool)
    place = np.where(uneven, len(even) + np.cumsum(uneven) - 1, np.cumsum(~uneven) - 1)
    return pa.concat_arrays([even, odd]).take(pa.array(place))


class Encoder:
    """Encodes texts by their parts between single spaces that stand between other characters.

    No token of either kind crosses such a place: byte-level BPE divides texts there before it merges,
    and no sentence piece has a space after another character. So a part has the same tokens in
    every text, and each process asks for those of a part once; beyond REMEMBERED characters of
    parts it starts anew."""

    def __init__(self, first: str, second: str):
        self.kinds = [Kind(ByteLevel(first)), Kind(Pieces(second))]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        for kind in self.kinds:
            kind.forget()

    def lists(self, texts: list[str]) -> list[pa.LargeListArray]:
        """The ids of each text, of both kinds."""
        parts = cut(texts)
        flat = parts.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        if self.chars > REMEMBERED:
            self.forget()
        new = [p for p in distinct if p not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.chars += sum(map(len, new))
            for kind in self.kinds:
                kind.learn(new)
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        numbers = numbers[np.asarray(flat.indices)]
        per_text = np.asarray(pc.list_value_length(parts), np.int64)
        return [kind.lists(numbers, per_text) for kind in self.kinds]


@cache
def encoder_of(first: str, second: str) -> Encoder:
    """The encoder of this Python process: what one task has learnt serves the next."""
    return Encoder(first, second)


def offsets_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def listed(offsets: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(offsets.astype(np.int64)), values)


def lossless(ids: pa.LargeListArray, entries: pa.Array, texts: pa.Array) -> pa.Array:
    """Whether the tokens' bytes, joined, are those of the text."""
    tokens = entries.take(pc.list_flatten(ids))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, tokens), pa.scalar(b"", pa.large_binary()))
    return pc.fill_null(pc.equal(joined, texts.cast(pa.large_binary())), False)


def token_ends(ids: pa.LargeListArray, entries: pa.Array) -> pa.Table:
    """(text, end, id, at) of all tokens: the byte after each within its text, from cumulative sums
    that start anew with each text."""
    flat, text = pc.list_flatten(ids), pc.list_parent_indices(ids)
    sums = pc.cumulative_sum(pc.binary_length(entries.take(flat)).cast(pa.int64()))
    starts = np.concatenate([[0], np.asarray(sums)])[np.asarray(ids.offsets)[:-1]]
    ends = pc.subtract(sums, pa.array(starts).take(text))
    at = pa.array(np.arange(len(flat)))
    return pa.table({"text": text, "end": ends, "id": flat, "at": at})


def grouped(tokens: pa.Table, common: pa.ChunkedArray) -> np.ndarray:
    """The number of each token's group; a group ends with a token that ends in a common place."""
    last = np.zeros(len(tokens), np.int64)
    last[np.asarray(common)] = 1
    return np.cumsum(last) - last


def as_text(ids: pa.ChunkedArray, sizes: np.ndarray) -> pa.Array:
    """The ids of each group, joined by commas."""
    strings = pa.array(ids.combine_chunks()).cast(pa.large_string())
    return pc.binary_join(listed(offsets_of(sizes), strings), pa.scalar(",", pa.large_string()))


def paired(first: pa.Array, second: pa.Array) -> pa.Array:
    """Two ids as one whole number."""
    high = pc.shift_left(first.cast(pa.int64()), pa.scalar(32, pa.int64()))
    return pc.bit_wise_or(high, second.cast(pa.int64()))


def group_pairs(a: pa.Table, b: pa.Table, alone: np.ndarray) -> pa.Table:
    """(text, pair, times): how often the ids of a pair share a group of a text.

    Groups of one token on either side, most of them, are pairs as they are. In all others equal ids
    are counted first, so a group costs its different pairs of ids, not its pairs of tokens."""
    single = [t.filter(pa.array(alone[np.asarray(t["group"])])) for t in (a, b)]
    pairs = paired(single[0]["id"], single[1]["id"])
    ones = pa.table({"text": single[0]["text"], "pair": pairs, "times": pa.array(np.ones(len(pairs), np.int64))})
    a, b = [t.filter(pa.array(~alone[np.asarray(t["group"])])) for t in (a, b)]
    left = a.group_by(["text", "group", "id"], use_threads=False).aggregate([("id", "count")])
    right = b.group_by(["group", "id"], use_threads=False).aggregate([("id", "count")])
    right = right.rename_columns({"id": "other", "id_count": "other_count"})
    both = left.join(right, "group", join_type="inner", use_threads=False)
    times = pc.multiply(both["id_count"], both["other_count"])
    more = pa.table({"text": both["text"], "pair": paired(both["id"], both["other"]), "times": times})
    counted = pa.concat_tables([ones, more.cast(ones.schema)])
    counted = counted.group_by(["text", "pair"], use_threads=False).aggregate([("times", "sum")])
    return counted.sort_by([("text", "ascending"), ("pair", "ascending")])


def align(texts: list[str | None], encoder: Encoder) -> dict[str, pa.Array]:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of each text."""
    n = len(texts)
    known = np.array([bool(t) for t in texts], bool)
    lists = encoder.lists([t for t in texts if t])
    whole = pa.array([" " + t for t in texts if t], pa.large_string())
    right = pc.and_(*[lossless(x, t.bytes, whole) for x, t in zip(lists, encoder.kinds)])
    known[known] = np.asarray(right.to_numpy(zero_copy_only=False), bool)
    m = int(known.sum())
    out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = [""] * n
    sizes, pairs, times = np.zeros(n, np.int64), pa.array([], pa.int64()), pa.array([], pa.int64())
    if m:
        a, b = [token_ends(x.filter(right), t.bytes) for x, t in zip(lists, encoder.kinds)]
        places = a.select(["text", "end", "at"]).join(
            b.select(["text", "end", "at"]).rename_columns(["text", "end", "other"]),
            ["text", "end"], join_type="inner", use_threads=False,
        )
        groups = [grouped(a, places["at"]), grouped(b, places["other"])]
        text_of = np.asarray(places["text"])
        per_text = np.bincount(text_of, minlength=m)
        n_a, n_b = [np.bincount(g, minlength=len(places)) for g in groups]
        owner = np.repeat(np.arange(m), per_text)
        links = np.zeros(m, np.int64)
        np.add.at(links, owner, n_a * n_b)
        out["n_a"][known] = np.bincount(np.asarray(a["text"]), minlength=m)
        out["n_b"][known] = np.bincount(np.asarray(b["text"]), minlength=m)
        out["n_groups"][known], out["n_links"][known] = per_text, links
        shown = pc.binary_join_element_wise(as_text(a["id"], n_a), as_text(b["id"], n_b), pa.scalar("|", pa.large_string()))
        joined = pc.binary_join(listed(offsets_of(per_text), shown), pa.scalar(";", pa.large_string())).to_pylist()
        for i, line in zip(np.flatnonzero(known), joined):
            digests[i] = hashlib.sha256(line.encode()).hexdigest()
        found = group_pairs(
            a.append_column("group", pa.array(groups[0])),
            b.append_column("group", pa.array(groups[1])),
            (n_a == 1) & (n_b == 1),
        )
        sizes[known] = np.bincount(np.asarray(found["text"]), minlength=m)
        pairs, times = found["pair"].combine_chunks(), found["times_sum"].combine_chunks()
    arrays = {c: pa.array(v) for c, v in out.items()}
    arrays["groups_sha256"] = pa.array(digests, pa.string())
    ends = pa.array(offsets_of(sizes).astype(np.int32))
    arrays["pairs"] = pa.ListArray.from_arrays(ends, pa.array(pairs))
    arrays["times"] = pa.ListArray.from_arrays(ends, pa.array(times))
    return arrays


def runs(texts: list[str | None], most: int = TOGETHER) -> Iterator[slice]:
    """Slices of about `most` characters."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            yield slice(begin, i + 1)
            begin, held = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """COLUMNS of each row of `docs`; `row` numbers the rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(first, second)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in runs(texts):
                some = batch.slice(part.start, part.stop - part.start)
                columns = {c: some.column(c) for c in ("row", "doc_id")}
                columns |= align(texts[part], encoder)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return rows.mapInArrow(work, COLUMNS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each pair; tasks count, Spark merges."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            some = pa.table({"pair": pc.list_flatten(batch.column("pairs"))})
            some = some.group_by("pair", use_threads=False).aggregate([("pair", "count")])
            some = some.rename_columns({"pair_count": "n"})
            if held is not None:
                some = pa.concat_tables([held, some.select(held.column_names)])
                some = some.group_by("pair", use_threads=False).aggregate([("n", "sum")])
                some = some.rename_columns({"n_sum": "n"})
            held = some.select(["pair", "n"])
            if len(held) > HELD:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return rows.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_frequent(rows: DataFrame, frequent: pa.Table) -> DataFrame:
    """FOUND: `best` and `total` over the links of frequent pairs; `pairs` keeps the others."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast([np.asarray(frequent[c]) for c in ("pair", "n", "best")])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, bests = shared.value
        for batch in batches:
            held, times = batch.column("pairs"), np.asarray(pc.list_flatten(batch.column("times")))
            keys = np.asarray(pc.list_flatten(held))
            at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
            known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
            value = np.zeros((2, len(keys)), np.int64)
            value[0, known] = times[known] * bests[at[known]]
            value[1, known] = times[known] * counts[at[known]]
            sizes = np.asarray(pc.list_value_length(held), np.int64)
            ends = offsets_of(sizes)
            best, total = [np.diff(offsets_of(v)[ends]) for v in value]
            left = pa.array(offsets_of(~known)[ends].astype(np.int32))
            columns = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            columns += [pa.array(best), pa.array(total)]
            columns += [pa.ListArray.from_arrays(left, pa.array(v[~known])) for v in (keys, times)]
            yield pa.record_batch(columns, names=[x.split()[0] for x in FOUND.split(", ")])

    return rows.mapInArrow(look, FOUND)


def alignment(docs: DataFrame, first: str, second: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row per row of `docs`.

    Null and empty texts, and those that either tokenizer changes, have zeros and an empty digest.
    Every row is a document, repeated rows too. Long texts are encoded in pieces and aligned whole.
    A pair of ids is best if no pair of the same first id is in more documents; of equal ones all
    are. An empty table gives an empty one; other columns are not read.
    """
    rows = stored(aligned(docs, first, second), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    left_id = F.shiftright("pair", 32)
    # One row for each id of the first vocabulary at most.
    highest = counts.groupBy(left_id.alias("id")).agg(F.max("n").alias("most"))
    judged = counts.join(F.broadcast(highest), left_id == F.col("id")).select(
        "pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")
    )
    incidences = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * frequent >= F.lit(incidences)
    top = judged.filter(often).orderBy("pair").toArrow()
    found = stored(with_frequent(rows, top), "aligned-frequent")
    rare = found.filter(F.size("pairs") > 0).select(
        F.col("row").alias("r"), F.explode(F.arrays_zip("pairs", "times")).alias("e")
    )
    rare = rare.select("r", F.col("e.pairs").alias("p"), F.col("e.times").alias("times"))
    rare = rare.join(judged.filter(~often), F.col("p") == F.col("pair")).groupBy("r").agg(
        F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more")
    )
    return found.join(rare, F.col("row") == F.col("r"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
