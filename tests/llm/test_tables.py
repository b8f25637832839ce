"""Chats, archives, shards, mixes, the pipeline, and the queries that have SQL."""

import hashlib
import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stationlab.llm import chat, decontamination, mixing, near_duplicates, sharding, toxicity, warc
from stationlab.llm.common import components
from stationlab.llm.queries import QUERIES, SQL
from stationlab.session import scratch_path
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), name) is None


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 201), (5, 5)]
    rng.shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


# Chats

PIECES = [*"\\#<>/:abei \n0", "###", "</turn>", "<image:0>", "### "]
PLAIN = st.lists(st.sampled_from(PIECES), max_size=20).map("".join)


@given(PLAIN, PLAIN)
def test_turns_are_reversible(role, text):
    formatted = f"### {chat.escape_role(role)}: {chat.escape(text)} </turn>\n"
    read_role, content = chat.parse_turn(formatted)
    assert (read_role, chat.plain_text(content)) == (role, text)


def test_parts_become_ordered_placeholders(spark):
    parts = [
        ("text", "look </turn> ", None, None, None, None, None),
        ("image", None, "s3://x/1.png", 28, 15, None, None),
        ("other", "<audio:7> ", None, None, None, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None),
    ]
    rows = [
        (1, 2, "assistant", [("document", None, "d.pdf", None, None, None, 3)]),
        (1, 1, "user", parts),
        (1, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    turns = chat.format_chats(df).orderBy("seq").collect()
    assert turns[0].formatted == "### :  </turn>\n"
    assert turns[1].formatted == (
        "### user: look \\</turn> <image:0>\\<audio:7> <audio:1> </turn>\n"
    )
    got = [(a.number, a.type, a.ref, a.tokens) for t in turns for a in t.attachments]
    assert got == [(0, "image", "s3://x/1.png", 4), (1, "audio", "a.wav", 38), (2, "document", "d.pdf", 768)]
    whole = "".join(t.formatted for t in turns)
    for t in turns:
        for a in t.attachments:
            assert whole[a.place :].startswith(f"<{a.type}:{a.number}>")
    assert whole[turns[2].loss_begin : turns[2].loss_end] == "<document:2>"
    assert turns[1].loss_begin is None


def test_odd_chats(spark):
    rows = [
        (None, 1, "user", "x"), (None, None, None, None), (2, 1, "assistant", "b"),
        (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, 0, "ro:le\n", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("parts", chat.text_parts(F.col("text")))
    df = df.select("*", *[F.lit("x").alias(c) for c in ("seq", "place", "formatted", "tokens")])
    found = {r.conv_id: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert set(found) == {None, 2} and found[2].n_turns == 4 and found[None].n_turns == 2
    assert found[2].loss_sha256 == hashlib.sha256(b"aab").hexdigest() and found[2].loss_chars == 3
    said = "ro:le\n\n\nassistant\na\nassistant\na\nassistant\nb\n"
    assert found[2].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.read_chats(chat.format_chats(df.filter("1 = 0"))).count() == 0


def test_ids_beyond_doubles_stay_whole_beside_null(spark):
    ids = [None, 2**53, 2**53 + 1, 2**53 + 2, -(2**53) - 1]
    df = spark.createDataFrame([(i, 0, "user", f"text {i}") for i in ids], "conv_id long, turn long, role string, text string")
    df = df.coalesce(1).withColumn("parts", chat.text_parts(F.col("text")))
    found = {r.conv_id: r.n_turns for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert found == dict.fromkeys(ids, 1)


def test_very_long_chats_and_pages(spark):
    text = "### Assistant: </turn> \\ é" * 40_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = chat.read_chats(chat.format_chats(df.withColumn("parts", chat.text_parts(F.col("text"))))).first()
    assert (row.n_turns, row.loss_chars) == (1, len(text))
    folder = scratch_path(spark, "test-archives")
    pages = spark.createDataFrame([(1, "u", text), (2, "u", text)], "page_id long, url string, html string")
    found = warc.page_records(warc.read_archives(spark, folder, warc.write_archives(pages, folder))).collect()
    assert {(r.page_id, r.record_type, r.payload_bytes) for r in found} == {
        (1, "revisit", len(text.encode())), (2, "response", len(text.encode()))
    }


def test_places_have_schemes(spark, tmp_path):
    from stationlab.llm.common import opened
    from stationlab.session import qualified

    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert scratch_path(spark, "x").startswith("file:/")
    fs, path = opened(f"file:{tmp_path}")
    assert path == str(tmp_path) and fs.type_name == "local" and opened(f"file://{tmp_path}")[1] == path
    with pytest.raises(ValueError, match="without a scheme"):
        opened("/ck/somewhere")


# Archives


def archive(n=6, size=4000):
    members = []
    for i in range(n):
        payload = random.Random(i).randbytes(size) + b"\r\n\r\nWARC/1.1\r\nno record\r\n\r\n"
        members.append(warc.gzip_member(warc.record(i, f"http://x/{i}", payload, None, False)))
    return members


def salvaged(data, step=None):
    source = pa.PythonFile(io.BytesIO(data), "r")
    step = step or len(data) + 1
    out = [x for low in range(0, max(1, len(data)), step) for x in warc.salvage_members(source, low, low + step)]
    ids = [x.headers["warc-record-id"] for x in out if x.reason is None]
    return [int(i[12:-1]) for i in ids], [(x.offset, x.length) for x in out if x.reason]


@pytest.mark.parametrize("step", [None, 1000, 4097, 9000])
def test_damaged_members_are_gaps_and_later_ones_are_read(step):
    members = archive()
    starts = [sum(map(len, members[:i])) for i in range(7)]
    whole = b"".join(members)
    assert salvaged(whole, step) == ([0, 1, 2, 3, 4, 5], [])
    broken = bytearray(whole)
    broken[starts[2] + 700] ^= 0xFF
    assert salvaged(bytes(broken), step) == ([0, 1, 3, 4, 5], [(starts[2], len(members[2]))])
    lost = whole[: starts[1] + 500] + whole[starts[3] + 40 :]
    ids, gaps = salvaged(lost, step)
    assert ids == [0, 4, 5] and sum(n for _, n in gaps) == 500 + len(members[3]) - 40
    junk = b"\x1f\x8b\x08 junk " * 30
    ids, gaps = salvaged(junk + whole + whole[:100], step)
    assert ids == [0, 1, 2, 3, 4, 5] and gaps[-1] == (len(junk + whole), 100)
    assert salvaged(b"", step) == ([], [])


def test_plain_archives_are_salvaged_at_version_lines():
    records = [warc.record(i, None, bytes(str(i), "ascii") * 70_000, None, False) for i in range(5)]
    starts = [sum(map(len, records[:i])) for i in range(6)]

    def read(data):
        out = list(warc.salvage_plain(pa.PythonFile(io.BytesIO(data), "r")))
        ids = [int(x.headers["warc-record-id"][12:-1]) for x in out if x.reason is None]
        return ids, [(x.offset, x.length) for x in out if x.reason]

    whole = b"".join(records)
    assert read(whole) == ([0, 1, 2, 3, 4], [])
    broken = bytearray(whole)
    broken[starts[1] + 5000] ^= 1
    assert read(bytes(broken)) == ([0, 2, 3, 4], [(starts[1], len(records[1]))])
    assert read(b"junk\r\n" + whole) == ([0, 1, 2, 3, 4], [(0, 6)])
    assert read(whole[:-9])[0] == [0, 1, 2, 3]
    assert read(b"") == ([], [])


def test_gaps_are_reported_by_spark(spark, tmp_path):
    members = archive(4)
    members[1] = members[1][:-30]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    files = spark.createDataFrame([("a.warc.gz", sum(map(len, members)))], "file string, bytes long")
    rows = warc.read_archives(spark, str(tmp_path), files, split_bytes=3000).collect()
    gap = [r for r in rows if r.reason]
    assert len(rows) == 4 and [(r.offset, r.length) for r in gap] == [(len(members[0]), len(members[1]))]


def test_headers_of_any_length(spark):
    record = warc.record(1, "http://x/" + "a" * 2_000_000, b"payload", None, False)
    plain = list(warc.salvage_plain(pa.PythonFile(io.BytesIO(b"WARC/1.1\r\nno header here\r\n" + record * 2), "r")))
    assert [x.reason for x in plain] == ["malformed header", None, None]
    packed = pa.PythonFile(io.BytesIO(warc.gzip_member(record)), "r")
    assert [x.reason for x in warc.salvage_members(packed, 0, 100)] == [None]


def test_each_range_is_a_task(spark):
    folder = scratch_path(spark, "test-archives")
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    files = warc.write_archives(pages.repartition(3), folder)
    ranges = sum(-(-r.bytes // 8192) for r in files.collect())
    rows = warc.read_archives(spark, folder, files, split_bytes=8192)
    tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert rows.count() == 300 and rows.rdd.getNumPartitions() == ranges and tasks > 0.8 * ranges


def test_odd_pages(spark):
    same = "<p>" + "é" * 800
    rows = [
        (1, "http://a b/ü\r\nX: y", same), (5, None, same), (3, "u", same), (3, "u", same), (5, "u", same),
        (None, "u", same), (4, "u", "short"), (9, "u", "short"), (7, None, None), (None, None, None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.select("*", F.lit("x").alias("digest"), F.lit("y").alias("n"), F.lit(1).alias("largest"))
    folder = scratch_path(spark, "test-archives")
    files = warc.write_archives(pages, folder)
    found = warc.page_records(warc.read_archives(spark, folder, files)).collect()
    assert len(found) == len(rows)
    digest = hashlib.sha1(same.encode()).hexdigest()
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found if r.payload_digest == digest)
    assert got == [
        ("1", "revisit", 5), ("3", "revisit", 5), ("3", "revisit", 5), ("5", "response", None),
        ("5", "response", None), ("None", "revisit", 5),
    ]
    assert all(r.record_type == "response" for r in found if r.payload_bytes < 1000)
    empty = scratch_path(spark, "test-archives")
    none = warc.write_archives(pages.filter("1 = 0"), empty)
    assert warc.read_archives(spark, empty, none).count() == 0


# Shards


def check_shards(rows, docs):
    assert len(rows) == len(docs)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(16)) and {r.law for r in rows} <= {"bytes"}
    return {s: sum(r.size for r in rows if r.shard == s) for s in slots}


def test_shards_hold_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    hot = spark.range(2000).select((F.col("id") + 10_000).alias("doc_id"), F.lit("one hot text " * 30).alias("text"))
    both = docs.union(hot)
    rows = sharding.shard(both).collect()
    sizes = check_shards(rows, [tuple(r) for r in both.collect()])
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) < 0.1 * mean
    again = sharding.shard(both.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_equal_texts_stay_together_unless_they_overfill_a_range(spark):
    docs = spark.range(3000).select("id", (F.col("id") % 1500).cast("string").alias("t"))
    docs = docs.select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "t").alias("text"))
    shards = {}
    for r in sharding.shard(docs, ranges=64).collect():
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_equal_rows_are_split_and_drawn_together(spark):
    """A third of all rows is one row: its copies lie in several shards, the sample stays small."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one row of a third " * 9).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
    )
    found = sharding.shard(rows, ranges=64, sample=512).collect()
    check_shards(found, [tuple(r) for r in rows.collect()])
    sizes = [sum(r.size for r in found if r.shard == s) for s in range(16)]
    assert max(sizes) < 1.5 * sum(sizes) / 16
    assert len({r.shard for r in found if r.doc_id == 7}) > 5


def test_splitters_and_search_agree(spark):
    bounds = [-5, 0, 7, 7, 40]
    keys = spark.createDataFrame([(k,) for k in range(-10, 50)], "k long")
    rows = keys.select("k", sharding.range_of(F.col("k"), bounds).alias("r")).collect()
    assert all(r.r == sum(b <= r.k for b in bounds) for r in rows)


def test_shards_of_odd_rows(odd_docs, no_docs):
    check_shards(sharding.shard(odd_docs).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert sharding.shard(no_docs).count() == 0


# Mixes


def test_mixes_follow_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mixed_sizes(docs).collect()
    assert len(rows) == docs.count()
    total = sum(r.size for r in rows)
    taken, target = {}, {}
    for r in rows:
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-6
        key = (r.source_size, r.target)
        taken[key], target[key] = taken.get(key, 0) + r.taken, r.target
    assert sum(target.values()) == pytest.approx(total) and sum(taken.values()) <= total
    assert all(abs(taken[k] - target[k]) < 0.05 * target[k] for k in taken)


def test_small_sources_stop_at_their_limit(spark):
    rows = [("a", 1000), ("b", 10), ("c", 10), (None, 100), ("zero", 0)]
    sizes = spark.createDataFrame(rows, "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert found["b"] == 30 and found["c"] == 30 and found["zero"] == 0
    # What is left, 1060, goes to a (weight 1) and null (weight 2), which stops at 300.
    assert found[None] == 300 and found["a"] == pytest.approx(760)


def test_mix_repeats_whole_rows(spark):
    rows = [(i, "w " * 10, "small" if i < 5 else "large") for i in range(100)]
    docs = spark.createDataFrame(rows + [rows[0]], "doc_id long, text string, source string")
    sizes = {r.doc_id: 0 for r in docs.collect()}
    for r in mixing.mixed_sizes(docs).collect():
        sizes[r.doc_id] += r.taken // 10
    got = {i: 0 for i in sizes}
    for r in mixing.mix(docs).collect():
        got[r.doc_id] += 1
    assert got == sizes and max(got.values()) > 3


def test_mixes_of_odd_rows(odd_docs, no_docs):
    assert mixing.mixed_sizes(odd_docs).count() == odd_docs.count()
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() > 0
    assert mixing.mixed_sizes(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    distinct = docs.select("doc_id").distinct().count()
    assert 0.5 * before < distinct < before
    result = corpus_pipeline.run(spark, SF).collect()
    assert len({r.doc_id for r in result}) == distinct
    assert json.dumps(sorted(r.start for r in result)[:1]) == "[0]"


def small_corpus():
    """Copies, near copies, toxic texts, passages of a benchmark item, null and empty texts."""
    rng = random.Random(21)
    known = ["".join(rng.choice("etaoinshrdlucm") for _ in range(rng.randint(2, 8))) for _ in range(700)]
    say = lambda n: " ".join(rng.choices(known, k=n))
    items = [(i, say(25)) for i in range(4)]
    rows = []
    for i in range(260):
        text = say(rng.randint(30, 90))
        if i % 4 == 0:
            words = text.split()
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(["vilewort", "zznasty", "kwinsult"]))
            text = " ".join(words)
        elif i % 13 == 1:
            text = f"{text}; {items[i % 4][1].title()} {say(9)}"
        elif i % 17 == 2 and rows:
            text = rows[-1][1] + " and one word"
        elif i % 19 == 3 and rows:
            text = rows[-1][1]
        rows.append((i, text, "en", f"s{i % 5}" if i % 11 else None, len(text)))
    rows += [(900, None, "en", "s1", 0), (901, "", "en", "s1", 0), (902, "", None, "s2", 0)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(260)]
    return rows, labels, items


def plain_pipeline(rows, labels, items):
    """The five stages on lists, by their definitions."""
    by_id = {r[0]: r for r in rows}
    told = {}
    for i, _, toxic in labels:
        if zlib.crc32(str(i).encode()) % 5 and by_id[i][1] is not None:
            text = by_id[i][1]
            told[text] = max(toxic, told.get(text, 0))
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    scorer = toxicity.fit(sorted(told.items(), key=lambda r: digest(r[0]))).scores()
    rows = [r for r in rows if scorer.score(r[1]) < 0.5]
    clean = len(rows)
    kept, seen = [], []
    for r in sorted(rows):
        if r[1] is None:
            kept.append(r)
            continue
        shingles = near_duplicates.labelled_shingles(r[1])
        alike = [c for c, text, s in seen if text == r[1] or near_duplicates.similarity(s, shingles)]
        seen.append((min(alike, default=r[0]), r[1], shingles))
        if not alike:
            kept.append(r)
    rows = []
    for r in kept:
        text = decontamination.normalised(r[1])
        best = [(decontamination.normalised(t), decontamination.myers(decontamination.normalised(t), text)[0]) for _, t in items]
        if all(d > decontamination.budget(len(t), decontamination.RATE) for t, d in best):
            rows.append(r)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:
        left = sum(total.values()) - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * total[s] <= level * weight[s]]
        if not full:
            break
        target |= {s: 3.0 * total[s] for s in full}
        open_ -= set(full)
    target |= {s: level * weight[s] for s in open_}
    queue = []
    for n, s in enumerate(sources):
        done = 0
        mine = sorted((hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r) for r in rows if r[3] == s)
        for place, (_, r) in enumerate(mine):
            done += size[r[0]]
            queue += [((k * total[s] + done) / target[s], n, k, place, r) for k in range(3)]
    taken, spent = [], 0
    for *_, r in sorted(queue, key=lambda x: x[:4]):
        spent += size[r[0]]
        if spent > sum(total.values()):
            break
        taken.append(r)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for r in sorted(taken):
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((r[0], start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return clean, out


def test_pipeline_equals_its_plain_version(spark, tmp_path):
    rows, labels, items = small_corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    clean, want = plain_pipeline(rows, labels, items)
    assert found == sorted(want) and 120 < len(found) and 150 < clean < 240


def test_pipeline_stages_of_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, odd_docs, SF)
        assert rows.count() > 0, name
        assert stage(spark, no_docs, SF).count() == 0, name
