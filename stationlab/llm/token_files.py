"""Token ids and masks of equal length in Arrow stream files.

A file holds record batches of two fixed-size-list columns, `input_ids` and `mask`, each list
`seq_len` long and each batch but the last `BATCH` lists long. Batches of one shape take the same
number of bytes, so the place of a sequence follows from its number, and a memory-mapped file gives
it without copying. Documents follow one another without gaps inside a file, each closed by the end
id; the last sequence of a file is filled up with zeros whose mask is false. A Parquet table beside
the files says which file and place holds which document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlab.llm.common import BATCH_ROWS, KEPT, TEXTS, Published, lean, opened
from stationlab.session import qualified, setting

SEQ_LEN = 2048
BATCH = 64
END_ID = 1
KNOWN_WORDS = 300_000
# First characters by which documents of one id are ordered.
TOLD_APART = 64
# Texts, and parts of them that have the same ids together if runs can be encoded one by one.
PROBES = [
    ("one two", ("one", "two")),
    ("  one\t\n two ", ("one", "two")),
    ("Word", ("word",)),
    ("word.", ("word", ".")),
    ("WORD,word.,", ("word,word", ".,")),
    ("x9. it's", ("x9", ".", "it's")),
]
TOGETHER = 64
INDEX = "doc_id long, part int, file string, place long, n_tokens long"


def file_schema(seq_len: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("input_ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))]
    )


def parted(runs: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs as two pieces each with the same ids: full stops and commas after a letter or digit are
    always tokens of their own, and case never matters outside special tokens."""
    core = pc.utf8_rtrim(runs, ".,")
    ends = pc.match_substring_regex(core, r"[\p{L}0-9]\z")
    core = pc.if_else(ends, core, runs)
    tail = pc.if_else(ends, pc.replace_substring_regex(runs, r"(?s)^.*[^.,]", ""), "")
    plain = pc.and_not(pc.string_is_ascii(core), pc.match_substring(core, "<"))
    return pc.if_else(plain, pc.ascii_lower(core), core), tail


class Encoder:
    """Encodes texts, asking the tokenizer once for each distinct run between ASCII white space.

    This holds for tokenizers that, as the given one, drop white space, ignore case and split letters
    from punctuation: the ids of a text are then those of its runs, one after another. Others, told
    by what they make of PROBES, get whole texts. At most KNOWN_WORDS pieces are remembered; beyond
    that those stay which the texts at hand hold.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()
        self.by_runs = all(self._ids(text) == self._ids(*parts) for text, parts in PROBES)

    def _ids(self, *texts: str) -> list[int]:
        found = self.tokenizer.encode_batch(list(texts), add_special_tokens=False)
        return [i for coded in found for i in coded.ids]

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._ids(text) for text in pc.fill_null(texts, "").to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for some in ids for i in some), self.type, int(sizes.sum())), sizes

    def forget(self, kept: list[str] | None = None) -> None:
        """Forgets all pieces but the known ones among `kept`."""
        kept = ["", *(x for x in kept if x and x in self.known)] if kept else [""]
        if len(kept) == 1:
            self.flat, self.lengths = np.zeros(0, self.type), np.zeros(1, np.int64)
        else:
            number = np.fromiter(map(self.known.__getitem__, kept), np.int64, len(kept))
            self.flat, self.lengths = self.ids_of(number), self.lengths[number]
        self.known: dict[str, int] = dict(zip(kept, range(len(kept))))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def ids_of(self, number: np.ndarray) -> np.ndarray:
        """The ids of known pieces, one piece after another."""
        sizes = self.lengths[number]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[number] - (ends - sizes), sizes) + np.arange(ends[-1])]

    def learn(self, runs: pa.Array | list[str]) -> np.ndarray:
        """Two numbers of known pieces for each run."""
        pieces = pa.concat_arrays(parted(pa.array(runs, pa.large_string()))).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        new = [x for x in distinct if x not in self.known]
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.forget(distinct)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            ids, sizes = self.ask(new)
            self.flat = np.concatenate([self.flat, ids])
            self.lengths = np.concatenate([self.lengths, sizes])
            self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return number[np.asarray(pieces.indices)].reshape(2, -1).T.ravel()

    def ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word) from the tokenizer, which gets a few words at a time as one text;
        a token belongs to the word in which it begins."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        ids, sizes = [], []
        for low in range(0, len(groups), TOGETHER):
            some = groups[low : low + TOGETHER]
            found = self.tokenizer.encode_batch([" ".join(g) for g in some], add_special_tokens=False)
            for group, coded in zip(some, found):
                ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1)
                begins = np.array([begin for begin, _ in coded.offsets], np.int64)
                owner = np.searchsorted(ends, begins, side="right")
                sizes.append(np.bincount(owner, minlength=len(group)))
                ids.append(np.array(coded.ids, self.type))
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text), without end ids; a null text counts as empty."""
        if not self.by_runs:
            return self.whole(texts)
        runs = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = pc.dictionary_encode(runs.flatten())
        offsets = np.asarray(runs.offsets, dtype=np.int64) - int(runs.offsets[0].as_py())
        if not len(coded):
            return np.zeros(0, self.type), np.zeros(len(texts), np.int64)
        pairs = self.learn(coded.dictionary).reshape(-1, 2)
        number = pairs[np.asarray(coded.indices)].ravel()
        ends = np.cumsum(self.lengths[number])
        per_text = np.diff(np.concatenate([[0], ends])[2 * offsets])
        return self.ids_of(number), per_text


@cache
def encoder_of(path: str) -> Encoder:
    """The encoder of this Python process: what one task has learnt serves the next."""
    return Encoder(path)


KEPT["token_files"] = encoder_of.cache_clear


def _close_documents(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(sizes), end_id)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    seq_len: int = SEQ_LEN,
    end_id: int = END_ID,
) -> None:
    """Writes the documents in ascending order of doc_id (null first; equal ids by the first characters
    of the text, then by its digest).

    Every row is a document of its own, rows with equal ids too; null texts are empty ones, which
    hold the end id alone. An empty table gives an index without rows and no file. Only doc_id and
    text are read. Spark range-partitions the rows, each task writes one file; beside the ids of a
    thousand texts it holds one batch, however long the documents.
    """

    folder = qualified(docs.sparkSession, folder)

    @lean("token_files")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        schema = file_schema(seq_len, pa.from_numpy_dtype(encoder.type))
        part = TaskContext.get().partitionId()
        out = sink = None
        rest, place = np.zeros(0, encoder.type), 0
        step = seq_len * BATCH

        def put(ids: np.ndarray, used: int) -> None:
            mask = np.arange(len(ids)) < used
            sink.write_batch(
                pa.record_batch(
                    [
                        pa.FixedSizeListArray.from_arrays(pa.array(ids), type=schema.field(0).type),
                        pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field(1).type),
                    ],
                    schema=schema,
                )
            )

        try:
            for batch in batches:
                for low in range(0, batch.num_rows, TEXTS):
                    texts = batch.column("text").slice(low, TEXTS)
                    if out is None:
                        out = Published(folder, f"tokens-{part:05d}.arrow")
                        sink = pa.ipc.new_stream(out.stream, schema)
                    ids, sizes = encoder.encode(texts)
                    rest = np.concatenate([rest, _close_documents(ids, sizes, end_id)])
                    sizes = sizes + 1
                    ends = place + np.cumsum(sizes)
                    n = len(sizes)
                    yield pa.record_batch(
                        [
                            batch.column("doc_id").slice(low, TEXTS),
                            pa.array(np.full(n, part, np.int32)),
                            pa.array([out.name] * n),
                            pa.array(ends - sizes),
                            pa.array(sizes),
                        ],
                        names=["doc_id", "part", "file", "place", "n_tokens"],
                    )
                    place = int(ends[-1])
                    whole = len(rest) // step * step
                    for i in range(0, whole, step):
                        put(rest[i : i + step], step)
                    rest = rest[whole:]
            if out is not None:
                if len(rest):
                    used = len(rest)
                    put(np.pad(rest, (0, -used % seq_len)), used)
                sink.close()
                out.close()
        except BaseException:
            if out is not None:
                out.drop()
            raise

    # Ranges end within an id, and even within equal rows, where one id has many.
    order = ["doc_id", "begin", "digest", "tie"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.substring("text", 1, TOLD_APART).alias("begin"),
        F.md5("text").alias("digest"),
        F.rand(11).alias("tie"),
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    with setting(docs.sparkSession, BATCH_ROWS, str(TEXTS)):
        ordered.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")


class TokenFile:
    """Random access to the sequences and the running ids of one file."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        local = fs.type_name == "local"
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        reader = pa.ipc.open_stream(self.source)
        self.schema = reader.schema
        self.seq_len = self.schema.field(0).type.list_size
        self.first = self.source.tell()
        pa.ipc.read_message(self.source)
        self.stride = self.source.tell() - self.first

    def batch(self, number: int) -> pa.RecordBatch:
        """Batch `number`, read from its computed place."""
        self.source.seek(self.first + number * self.stride)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file where it is memory-mapped) and mask of one sequence."""
        batch = self.batch(number // BATCH)
        at = number % BATCH * self.seq_len
        ids = batch.column(0).values.to_numpy(zero_copy_only=True)[at : at + self.seq_len]
        return ids, np.asarray(batch.column(1).values.slice(at, self.seq_len))

    def tokens(self, place: int, n: int) -> Iterator[np.ndarray]:
        """The running ids [place, place + n) in pieces, one for each batch they lie in."""
        step = self.seq_len * BATCH
        while n > 0:
            ids = self.batch(place // step).column(0).values.to_numpy(zero_copy_only=True)
            piece = ids[place % step : place % step + n]
            yield piece
            place, n = place + len(piece), n - len(piece)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document as read back from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 over little-endian 32-bit ids, file and place."""
    folder = qualified(spark, folder)
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )

    @lean("token_files")
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened_file = None, None
        for batch in batches:
            sums = np.empty(batch.num_rows, np.int64)
            columns = [batch.column(c).to_pylist() for c in ("file", "place", "n_tokens")]
            for i, (file, place, n) in enumerate(zip(*columns)):
                if file != name:
                    name, opened_file = file, TokenFile(f"{folder}/{file}")
                crc = 0
                for piece in opened_file.tokens(place, n):
                    crc = zlib.crc32(piece.astype("<u4"), crc)
                sums[i] = crc
            starts = pc.add(batch.column("base"), batch.column("place"))
            columns = [batch.column(c) for c in ("doc_id", "n_tokens", "file", "place")]
            yield pa.record_batch(
                [columns[0], starts, columns[1], pa.array(sums), *columns[2:]],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "place"],
            )

    placed = index.join(base, F.col("part") == F.col("p")).select(
        "doc_id", "part", "file", "place", "n_tokens", "base"
    )
    return (
        placed.repartition("part")
        .sortWithinPartitions("part", "place")
        .mapInArrow(
            read,
            "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long",
        )
    )
