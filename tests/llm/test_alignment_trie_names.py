"""Token alignment, the prefix trie and block names against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_tables import LONG, with_clashing
from pyspark.sql import functions as F

from stationlab.llm import block_names, prefix_trie, token_alignment
from stationlab.llm.common import looked_up, ranked, stored

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# Helpers


def test_looked_up_keys_of_any_weight(spark):
    rows = [(i, 0 if i % 3 == 0 else i, i % 2) for i in range(6000)] + [(9999, 77_777, 0)]
    rows = stored(spark.createDataFrame(rows, "id long, a long, b long"), "t")
    table = rows.filter("a < 70000").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    table = table.withColumn("name", F.col("a") * 10 + F.col("b"))
    got = looked_up(rows, stored(table, "t"), ["a", "b"]).collect()
    assert len(got) == 6000 and all(r.name == r.a * 10 + r.b for r in got)


def test_ranked_is_the_place_in_order(spark):
    rng = random.Random(5)
    values = sorted({(rng.randrange(-(2**63), 2**63), i % 3) for i in range(500)} | {(-(2**63), 0), (2**63 - 1, 1), (5, 1), (5, 2)})
    df = stored(spark.createDataFrame(rng.sample(values, len(values)), "h long, x long"), "t")
    assert {(r.h, r.x): r.name for r in ranked(df, ["h", "x"]).collect()} == {v: i for i, v in enumerate(values)}


# Exact duplicates


def plain_duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        ranked_ids = known + [None] * (len(ids) - len(known))
        out += [(i, known[0] if known else None, len(ids), n == 0, digest) for n, i in enumerate(ranked_ids)]
    return sorted(out, key=repr)


def named(df, **options):
    return sorted(map(tuple, block_names.exact_duplicates(df, **options).collect()), key=repr)


def test_block_names_equal_plain_groups(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab é\t\n") for _ in range(rng.randrange(0, 90))) for _ in range(60)]
    texts = [rng.choice(base) + rng.choice(["", " ", "x"]) for _ in range(400)] + ["z" * 200, "z" * 201, "z" * 199]
    rows = [(rng.choice([i, i // 2, None]), rng.choice([t, t, t.replace(" ", "\t ")])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1, 7, 64):
        assert named(df, block=block) == plain_duplicates(rows)


def test_block_names_with_a_hash_that_collides(spark):
    rows = [(i, f"text {i % 30} {'y' * (i % 5)}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def weak(block, seed):
        if seed < 2:
            return F.struct((F.xxhash64(block) % 3).alias("h1"), F.lit(0).cast("long").alias("h2"))
        return block_names.block_hash(block, seed)

    assert named(df, block=8, hashing=weak) == plain_duplicates(rows)


def test_block_names_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert named(odd_docs) == plain_duplicates(rows)
    assert named(no_docs) == []
    plan = block_names.exact_duplicates(no_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_block_names_of_one_large_group(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "copy " * 2000).otherwise(F.concat(F.lit("own "), F.col("id"))).alias("text"),
    )
    got = block_names.exact_duplicates(rows, block=512).filter("group_size > 1").agg(
        F.count(F.lit(1)), F.min("group_size"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))
    )
    assert tuple(got.first()) == (1334, 1334, 0, 1)


# Prefix trie


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c > 0 else -1)
        paths[c] = own.get(family, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out, inner = [], {n[:-1] for n in members if n}
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        leaves = [n for n in below if n not in inner]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        out.append(
            (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children),
             len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def trie(df, **options):
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **options).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [1, 3, 4])
def test_trie_equals_plain_trie(spark, block):
    rng = random.Random(block)
    rows = []
    for c in [*range(0, 60), *range(97, 140), 250, 300, -3, -130]:
        for i in range(rng.randrange(1, 11)):
            rows.append((c, rng.choice([i, i, 2, None]), rng.choice(["user", "user", None]), rng.choice(["a", "a", "é" * 7])))
    rows += [(400, i, "user", "same") for i in range(25)] + [(401, i, "user", "same") for i in range(26)]
    assert trie(spark.createDataFrame(rows, SCHEMA), block=block) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (7, None, None, None), (7, 0, "user", LONG), (7, 0, "user", LONG), (8, 1, "", ""), (None, 1, "user", "x"),
        (100, 1, "a", "b\u0000c"), (100, 1, "ab", "\u0000c"), (101, 1, "a", "b"), (2**53 + 1, 1, "a", "b"), (2**53, 1, "a", "b"),
    ]
    df = with_clashing(spark.createDataFrame(rows, SCHEMA))
    for c in ("conv", "first", "depth", "members", "block", "number", "parent"):
        df = df.withColumn(c, F.lit("own"))
    assert trie(df) == plain_trie(rows)
    assert trie(df.filter("1 = 0")) == []
    assert trie(df.filter("conv_id IS NULL")) == []


def test_trie_with_a_conversation_of_a_third_of_all_rows(spark):
    """Windows hold pieces of it, and its turns are counted right over several sorted files."""
    rows = spark.range(9000).select(
        F.when(F.col("id") < 3000, 500).otherwise(1000 + F.floor(F.col("id") / 4)).alias("conv_id"),
        F.when(F.col("id") < 3000, F.col("id")).otherwise(F.col("id") % 4).alias("turn"),
        F.lit("user").alias("role"),
        F.concat(F.lit("t"), F.col("id") % 7).alias("text"),
    )
    got = prefix_trie.prefix_trie(rows).filter("conv_id = 500").agg(F.max("depth"), F.count(F.lit(1)), F.max("n_convs"))
    assert tuple(got.first()) == (3000, 3001, 1501)


# Token alignment


def plain_alignment(rows):
    first, second = token_alignment.ByteLevel(A), token_alignment.Pieces(B)
    found = []
    for doc_id, text in rows:
        kinds = []
        for t in (first, second):
            ids = t.encode([text or ""])[0] if text else []
            entries = [t.bytes[i].as_py() for i in ids]
            kinds.append((ids, entries))
        if not text or any(b"".join(e) != (" " + text).encode() for _, e in kinds):
            found.append((doc_id, [], [], []))
            continue
        ends = []
        for ids, entries in kinds:
            at, places = 0, []
            for e in entries:
                at += len(e)
                places.append(at)
            ends.append(places)
        both = set(ends[0]) & set(ends[1])
        groups = [[[], []] for _ in both]
        for k, (ids, _) in enumerate(kinds):
            number = 0
            for i, end in zip(ids, ends[k]):
                groups[number][k].append(i)
                number += end in both
        found.append((doc_id, kinds[0][0], kinds[1][0], groups))
    counts = Counter()
    for _, _, _, groups in found:
        counts.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, a_ids, b_ids, groups in found:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        line = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out.append(
            (doc_id, len(a_ids), len(b_ids), len(groups), len(links),
             sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(line.encode()).hexdigest() if a_ids else "")
        )
    return sorted(out, key=repr)


def aligned(df, **options):
    return sorted(map(tuple, token_alignment.alignment(df, A, B, **options).collect()), key=repr)


TEXTS = [
    "Hello world, the tokenizers part ways: antidisestablishmentarianism!",
    "naïve café — 東京は日本の首都です。 ภาษา",
    "  two  spaces\tand\nlines   end ",
    "<|endoftext|> </s> <s> <0x41> <unk> are plain text",
    "holds ▁ a mark of the second kind",
    "a" * 300 + " " + "ab" * 200,
    "\U0001f600\U0001f3fd‍\U0001f4bb emoji ́ combining",
    " ", "\n", "x", "Don't we'll I'M 1234567 3.14",
]


def test_alignment_equals_plain_alignment(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[0]), (None, TEXTS[1]), (50, None), (51, ""), (52, TEXTS[0] + TEXTS[0])]
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    want = plain_alignment(rows)
    assert aligned(df) == want
    # Few frequent pairs, so that most come by the join.
    assert aligned(df, frequent=5) == want


def test_alignment_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert aligned(odd_docs) == plain_alignment(rows)
    assert aligned(no_docs) == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab 1'.,\t\n 　▁é́東京s​\x1c<|>")), max_size=40))
def test_parts_have_the_tokens_of_the_whole(text):
    for kind in token_alignment.encoder_of(A, B).kinds:
        parts = token_alignment.CUT.split(text)
        whole = kind.tokenizer.encode([text])[0]
        if "▁" not in text:
            assert [i for p in kind.tokenizer.encode(parts) for i in p] == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab.▁é東\n")), min_size=1, max_size=6), min_size=1, max_size=200))
def test_parts_asked_together_have_their_own_tokens(parts):
    for kind in token_alignment.encoder_of(A, B).kinds:
        kind.forget()
        kind.learn(parts)
        ends = np.cumsum(kind.sizes)[:-1]
        found = [x.tolist() for x in np.split(kind.ids, ends)]
        assert found == [list(x) for x in kind.tokenizer.encode(parts)]
    token_alignment.encoder_of(A, B).forget()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000é")), max_size=9), max_size=6))
def test_arrow_cuts_texts_as_the_pattern_does(texts):
    assert token_alignment.cut(texts).to_pylist() == [token_alignment.CUT.split(t) for t in texts]


def test_even_texts_are_cut_by_arrow_alone(monkeypatch):
    encoder = token_alignment.Encoder(A, B)
    want = [x.to_pylist() for x in encoder.lists(["one two.\nthree", "four"])]
    monkeypatch.setattr(token_alignment, "CUT", None)
    assert [x.to_pylist() for x in encoder.lists(["one two.\nthree", "four"])] == want


def test_process_forgets_beyond_its_bound(monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED", 50)
    encoder = token_alignment.Encoder(A, B)
    small = [token_alignment.align([t, None], encoder) for t in TEXTS * 2]
    whole = token_alignment.align(TEXTS, token_alignment.encoder_of(A, B))
    assert [x["groups_sha256"][0].as_py() for x in small] == whole["groups_sha256"].to_pylist() * 2
