"""Near-duplicates, token files, outliers, toxicity, languages, decontamination."""

import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationlab.llm import decontamination as dc
from stationlab.llm import language, near_duplicates, outliers, token_files, toxicity
from stationlab.llm.common import BATCH_ROWS, TEXTS, give_back, lean, stored
from stationlab.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]


# Near-duplicates


def plain_alignment(a, b):
    """Shingles aligned in order over all, by the textbook table over labelled shingles."""

    def labelled(text):
        w, seen, out = text.split(), {}, []
        for x in [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []:
            out.append((x, seen.get(x, 0)))
            seen[x] = seen.get(x, 0) + 1
        return out

    x, y = labelled(a), labelled(b)
    row = [0] * (len(y) + 1)
    for p in x:
        new = [0]
        for j, q in enumerate(y):
            new.append(row[j] + 1 if p == q else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1]) if x and y else 0.0


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        i = rng.randrange(len(w))
        how = rng.randrange(3)
        w[i : i + 1] = [] if how == 0 else words(rng, how)
    return " ".join(w)


def test_similarity_equals_the_textbook_alignment():
    rng = random.Random(3)
    base = " ".join(words(rng, 150) + ["again and again"] * 9 + words(rng, 60))
    seen = 0
    for edits in (0, 1, 2, 3, 4, 5, 6, 9, 30):
        for _ in range(4):
            other = edited(rng, base, edits)
            plain = plain_alignment(base, other)
            shingles = [near_duplicates.labelled_shingles(t) for t in (base, other)]
            found = near_duplicates.similarity(*shingles)
            assert found == (pytest.approx(plain) if plain >= 0.8 else 0.0)
            seen += plain >= 0.8
    assert 8 < seen < 36
    half = base.split()
    moved = " ".join(half[100:] + half[:100])
    assert near_duplicates.similarity(*map(near_duplicates.labelled_shingles, (base, moved))) == 0.0


def test_classes_equal_those_of_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = " ".join(words(rng, rng.randint(30, 200)))
        texts += [base] * rng.randint(1, 3) + [edited(rng, base, rng.randint(1, 3)) for _ in range(3)]
    # A base whose copies are alike to it but not to each other.
    base = " ".join(words(rng, 120))
    texts += [base] + [edited(rng, base, 2) for _ in range(12)]
    texts += ["", "", " ", "one two", "one two", "one  two", "two one"]
    rng.shuffle(texts)
    root = list(range(len(texts)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or plain_alignment(texts[i], texts[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    rows = near_duplicates.near_duplicates(docs_of(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: find(i) for i in range(len(texts))}


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    found = near_duplicates.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[1] == classes[2] == 1 and classes[3] == 3 and classes[6] == 6
    kept = near_duplicates.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(7) == 2 and ids.count(None) == 2
    assert near_duplicates.near_duplicates(no_docs).count() == 0
    assert near_duplicates.without_near_duplicates(no_docs).count() == 0


def test_no_link_is_lost_inside_templates(spark):
    """Texts of one template, less alike than the limit, share large buckets; some are near copies."""
    rng = random.Random(2)
    texts = []
    for f in range(3):
        template = [f"t{f}w{i}" for i in range(200)]

        def changed(text, at):
            return text[:at] + [f"o{rng.randrange(10**7)}" for _ in range(8)] + text[at + 8 :]

        places = [rng.randrange(85) for _ in range(70)]
        made = [changed(template, at) for at in places]
        texts += made + [changed(made[i], places[i] + 100) for i in range(30)]
    texts = [" ".join(t) for t in texts]
    shingles = [near_duplicates.labelled_shingles(t) for t in texts]
    root = list(range(300))
    for a in range(300):
        for b in range(a):
            if a // 100 == b // 100 and root[a] != root[b] and near_duplicates.similarity(shingles[a], shingles[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(docs_of(spark, texts)).collect()}
    want = {}
    for i, r in enumerate(root):
        want[i] = min(j for j in range(300) if root[j] == r)
    assert found == want


def test_candidates_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Texts at the edge of a large group of near copies join it by a few of its texts."""
    rng = random.Random(5)
    base = " ".join(words(rng, 60))
    texts = [edited(rng, base, rng.choice([0, 1, 1, 2, 2, 3])) for _ in range(600)]
    held, kept = [], near_duplicates.stored

    def stored(df, name):
        out = kept(df, name)
        held.extend([out.count()] if name == "candidates" else [])
        return out

    monkeypatch.setattr(near_duplicates, "stored", stored)
    found = near_duplicates.near_duplicates(docs_of(spark, texts))
    assert len({r.class_id for r in found.collect()}) < 300
    assert held[0] < 2 * len(texts)


# Token files


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.sampled_from(
    ["It's 3.,5 A.B, x!. <|endoftext|>. <|STARTOFTEXT|> \u00c4\u0301., \u03a3\u03a3. ,. e \u0301 \x85 \x1c don't.", "A. a, A,."]
)), max_size=4))
def test_encoder_gives_the_ids_of_whole_texts(texts):
    encoder = token_files.encoder_of(TOKENIZER)
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    whole = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, whole))
    assert ids.tolist() == [i for x in whole for i in x]


def test_known_pieces_do_not_make_an_encoder_forget(monkeypatch):
    encoder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 50)
    runs = [f"w{i}" for i in range(30)]
    encoder.learn(runs)
    known = encoder.known
    encoder.learn(runs)
    assert encoder.known is known


def test_full_encoders_keep_the_pieces_at_hand(monkeypatch):
    encoder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 50)
    asked, ask = [], encoder.ask
    monkeypatch.setattr(encoder, "ask", lambda words: asked.append(len(words)) or ask(words))
    runs = [f"Word{i}." for i in range(40)]
    encoder.learn(runs)
    more = [f"more{i}," for i in range(25)]
    numbers = encoder.learn(runs[20:] + more)
    assert asked == [41, 26]
    want = [encoder.tokenizer.encode(run, add_special_tokens=False).ids for run in runs[20:] + more]
    assert encoder.ids_of(numbers).tolist() == [i for ids in want for i in ids]


def test_shingles_become_rows_once(spark):
    texts = [" ".join(f"w{(i * 7 + j) % 90}" for j in range(30)) for i in range(40)]
    df = stored(spark.createDataFrame([(str(i).encode(), t) for i, t in enumerate(texts)], "node binary, text string"), "t")
    found = near_duplicates.rarest(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() and not re.findall(r"(?<!pos)explode\(", plan)


def test_tasks_forget_what_other_operators_keep():
    def work(batches):
        token_files.encoder_of(TOKENIZER)
        yield from batches

    token_files.encoder_of.cache_clear()
    assert list(lean("token_files")(work)(iter([1, 2]))) == [1, 2]
    assert list(lean("token_files")(lambda batches: iter(batches))(iter([]))) == []
    assert token_files.encoder_of.cache_info().currsize == 1
    assert list(lean("near_duplicates")(lambda batches: iter(batches))(iter([3]))) == [3]
    assert token_files.encoder_of.cache_info().currsize == 0


def test_freed_memory_is_given_back():
    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    strings = [b"%d" % i * 1000 for i in range(30_000)]
    pinned = strings[::100]
    most = held()
    del strings
    give_back()
    assert pinned and held() < most - 50


def test_near_duplicates_send_few_texts_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "_classes", lambda docs: docs.sparkSession.conf.get(BATCH_ROWS))
    before = spark.conf.get(BATCH_ROWS)
    assert near_duplicates.classes(docs_of(spark, ["a"])) == str(TEXTS)
    assert spark.conf.get(BATCH_ROWS) == before


def test_tokenizers_that_keep_white_space_get_whole_texts():
    texts = ["Two  words.", "a\n\tb", None, "", "x " * 50 + "END.,"]
    for name, by_runs in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        encoder = token_files.Encoder(public_tokenizers.path(name))
        assert encoder.by_runs == by_runs
        ids, sizes = encoder.encode(pa.array(texts))
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_documents_of_one_id_lie_in_several_files(spark):
    """A third of all rows has one id: ranges end within it."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same text again").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
    )
    folder = scratch_path(spark, "test-tokens")
    # Such small ranges would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(rows, folder, TOKENIZER, seq_len=32)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = token_files.read_token_files(spark, folder)
    assert found.count() == 6000
    assert found.filter("doc_id = 5").select("file").distinct().count() > 1
    order = [r.doc_id for r in found.orderBy("start").collect()]
    assert order == sorted(order)


def check_token_files(spark, docs, seq_len):
    folder = scratch_path(spark, "test-tokens")
    token_files.write_token_files(docs, folder, TOKENIZER, seq_len=seq_len)
    found = [tuple(r)[:4] for r in token_files.read_token_files(spark, folder).collect()]
    rows = sorted(
        ((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()),
        key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()),
    )
    tokenizer = Tokenizer.from_file(TOKENIZER)
    start, expected = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert sorted(found, key=lambda x: x[1]) == expected
    return folder


def test_token_files_round_trip(spark, odd_docs, no_docs):
    folder = check_token_files(spark, odd_docs, 32)
    check_token_files(spark, spark.read.parquet(f"{SF}/documents.parquet"), 512)
    check_token_files(spark, no_docs, 32)
    name = spark.read.parquet(f"{folder}/index").agg(F.max("file")).first()[0]
    file = token_files.TokenFile(f"{folder}/{name}")
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 32 and not ids.flags.owndata
    total = spark.read.parquet(f"{folder}/index").filter(F.col("file") == name).agg(F.sum("n_tokens")).first()[0]
    ids, mask = file.sequence((total - 1) // 32)
    assert mask.sum() == (total - 1) % 32 + 1 and not ids[int(mask.sum()) :].any()


# Outliers


def plain_statistics(text):
    import re
    from collections import Counter

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(w, w[1:], w[2:]))
    count = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_base_statistics_equal_plain_ones(spark, odd_docs):
    for docs in (odd_docs, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = outliers.statistics(docs).collect()
        found = sorted((str(r.doc_id), *tuple(r)[3:8]) for r in rows)
        expected = sorted(
            (str(r.doc_id), *plain_statistics(r.text)) for r in docs.select("doc_id", "text").collect()
        )
        assert found == expected


def test_distances_equal_those_of_plain_steps(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        n, junk = rng.randint(60, 200), rng.random() < 0.05
        text = " ".join(words(rng, n)) + ("\n#$*|<>%&" * n if junk else " & " * rng.randint(0, 2))
        rows.append((i, text, "en", "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in outliers.judge(docs).collect()}
    feats = outliers.with_features(outliers.statistics(docs)).toPandas().set_index("doc_id")
    good = feats[~feats.base_failed]
    x = good[list(outliers.FEATURES)].to_numpy(float)

    def quantile(values, share):
        return np.sort(values)[int(np.ceil(share * len(values) - 1e-12)) - 1]

    least = np.array(outliers.LEAST_SPREAD) * outliers.UNIT
    low, mid, high = (np.array([quantile(c, s) for c in x.T]) for s in (0.16, 0.5, 0.84))
    mean, inverse = mid, np.diag(1 / np.maximum((high - low) / 2, least) ** 2)
    for step in range(outliers.STEPS + 1):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        if step < outliers.STEPS:
            whole = np.floor(d * outliers.FINEST)
            inner = x[whole <= quantile(whole, outliers.INNER)]
            mean = inner.mean(0)
            inverse = np.linalg.inv(np.cov(inner.T, bias=True) + np.diag(least**2))
    scale = max(1.0, quantile(np.floor(d * outliers.FINEST), 0.5) / outliers.FINEST / outliers.MEDIAN)
    got = np.array([found[i].distance for i in good.index])
    assert np.allclose(got, np.sqrt(d / scale), rtol=1e-6)
    kept = np.array([found[i].kept for i in good.index])
    assert (kept == (d <= scale * outliers.LIMIT)).all() and 0 < (~kept).sum() < 30


def ordinary_text(rng):
    """140 words in ten lines, no words of which repeat."""
    return "\n".join(" ".join(words(rng, 14)) for _ in range(10))


def test_each_statistic_rejects_alone(spark):
    rng = random.Random(4)
    texts = [ordinary_text(rng) for _ in range(200)]
    lines = ordinary_text(rng).split("\n")
    texts.append(" | ".join(words(rng, 140)))  # words divided by bars, about a fifth symbols
    texts.append("\n".join(f"{x}\nsame" for x in lines))  # half of the lines repeat
    texts.append("\n".join([*lines, " ".join(words(rng, 14) * 6)]))  # more than a third of the words repeat
    texts.append("\n".join(" ".join("".join(rng.choices("abcdefgh", k=14)) for _ in range(14)) for _ in lines))  # long words
    docs = docs_of(spark, texts).selectExpr("*", "'en' lang", "'s' source")
    rows = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert not any(rows[i].base_failed or rows[i].kept for i in range(200, 204))
    assert sum(not rows[i].kept for i in range(200)) <= 4


@pytest.mark.parametrize("share", [0.3, 0.4])
def test_copies_do_not_hide_themselves(spark, share):
    """A text with 35 % symbols whose copies are a large part of a language and source."""
    rng = random.Random(5)
    texts = [ordinary_text(rng) for _ in range(300)]
    copy = " ".join(words(rng, 140))
    copy += " " + "#" * (len(copy) // 2)
    n = int(share * len(texts))
    docs = docs_of(spark, [copy] * n + texts[n:]).selectExpr("*", "'en' lang", "'s' source")
    rows = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert not any(rows[i].kept for i in range(n))
    assert sum(not rows[i].kept for i in range(n, 300)) <= 6


def test_outliers_of_labelled_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = outliers.judge(docs).filter("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.s for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.95 and share[0] < 0.1


def test_outliers_of_odd_rows(odd_docs, no_docs):
    rows = outliers.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed == (not r.kept) for r in rows)
    assert outliers.judge(no_docs).count() == 0


# Toxicity


def toxic_corpus(spark, n=900):
    rng = random.Random(2)
    common, rows, labels = words(rng, 400), [], []
    for i in range(n):
        text = rng.choices(common, k=rng.randint(30, 120)) + words(rng, 30)
        toxic = i % 3 == 0
        for _ in range(4 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["zzinsult", "vilewort", "kwhatever", "nastyone"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_labels(spark):
    docs, labels = toxic_corpus(spark)
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 900
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.without_toxic(docs, labels).count() == sum(not r.predicted for r in rows)


def test_toxicity_does_not_depend_on_labels_of_held_out_rows(spark):
    docs, labels = toxic_corpus(spark, 400)
    turned = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    first, second = (
        {r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, turned)
    )
    assert first == second


def test_toxicity_of_odd_rows(odd_docs, no_docs, odd_labels):
    rows = toxicity.toxicity(odd_docs, odd_labels).collect()
    assert len(rows) == odd_docs.count() and all(r.predicted == 0 for r in rows)
    kept = toxicity.without_toxic(odd_docs, odd_labels)
    assert kept.columns == odd_docs.columns and kept.count() == len(rows)
    assert toxicity.toxicity(no_docs, odd_labels.filter("1 = 0")).count() == 0


def test_trained_scorer_meets_odd_rows(spark, odd_docs):
    docs, labels = toxic_corpus(spark, 400)
    odd = odd_docs.select(F.lit(5_000_000).cast("long").alias("doc_id"), "text", *[c for c in odd_docs.columns if c not in ("doc_id", "text")])
    both = docs.unionByName(odd, allowMissingColumns=True)
    rows = toxicity.toxicity(both, labels).filter("doc_id = 5000000").collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len(set(toxicity.toxicity(both, labels).select("score").distinct().collect())) > 50
    kept = toxicity.without_toxic(both, labels)
    assert kept.columns == both.columns and kept.filter("text IS NULL").count() == 2


@pytest.mark.parametrize("mark", [["qzwvx"], ["brkkr", "vloms", "gurpt"], [" ".join(["some", "words", "known", "here", "often"])]])
def test_short_marks_and_phrases_are_learnt(mark):
    """Marks of five letters, and a phrase of ordinary words, in otherwise ordinary text."""
    rng = random.Random(9)
    letters = "etaoinshrdlucm"
    known = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(1500)] + "some words known here often".split()

    def text(toxic):
        some = rng.choices(known, k=rng.randint(60, 200))
        for _ in range(4 * toxic):
            some.insert(rng.randrange(len(some)), rng.choice(mark))
        return " ".join(some)

    learnt, unseen = ([(text(i % 4 == 0), int(i % 4 == 0)) for i in range(n)] for n in (800, 200))
    scorer = toxicity.fit(learnt).scores()
    right = [(scorer.score(t) >= 0.5) == y for t, y in unseen]
    assert sum(right) >= 0.9 * len(right)
    assert sum(r for r, (_, y) in zip(right, unseen) if y) >= 0.75 * 50


# Languages


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert sum(r.accepted for r in rows) >= 0.85 * len(rows)


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([("x", "abab abba baab cabbage"), ("y", "dd")], "lang string, text string")
    rows = language.kneser_ney(language.gram_counts(docs)).toPandas()
    models = language.Models(rows)
    letters = sorted({int(k) for k in models.grams[1]})
    context = [32, ord("a"), ord("b")]
    keys = np.array([sum(c << 16 * (3 - i) for i, c in enumerate([*context, x])) for x in letters], np.uint64)
    sums = np.exp(models.lookup(keys)).sum(0)
    # One share of the uniform part is kept for letters never seen.
    assert (sums < 1).all() and (sums > 0.7).all()
    plain = [np.exp(models.lookup(keys[i : i + 1]))[0] for i in range(len(keys))]
    assert np.allclose(np.array(plain), np.exp(models.lookup(keys)))


def test_model_equals_plain_kneser_ney(spark):
    """Interpolated Kneser-Ney by the textbook, over dictionaries."""
    texts = ["abab abba baab cabbage", "a cab \U00010400\U00010401 bag"]
    docs = spark.createDataFrame([("x", t) for t in texts], "lang string, text string")
    models = language.Models(language.kneser_ney(language.gram_counts(docs)).toPandas())
    counts = [None] + [{} for _ in range(4)]
    for t in texts:
        codes = tuple(int(c) for c in language.coded(t))
        for i in range(len(codes) - 3):
            counts[4][codes[i : i + 4]] = counts[4].get(codes[i : i + 4], 0) + 1
    for k in (3, 2, 1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] = counts[k].get(gram[1:], 0) + 1
    size = len(counts[1]) + 1

    def discount(k):
        ones, twos = (sum(n == m for n in counts[k].values()) for m in (1, 2))
        return max(0.1, min(0.95, ones / (ones + 2 * twos) if ones + 2 * twos else 0.5))

    def probability(gram):
        k = len(gram)
        if not k:
            return 1 / size
        after = [n for g, n in counts[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return probability(gram[1:])
        d = discount(k)
        own = max(counts[k].get(gram, 0) - d, 0) / sum(after)
        return own + d * len(after) / sum(after) * probability(gram[1:])

    letters = sorted({g[-1] for g in counts[1]} | {ord("z")})
    grams = [(32, ord("a"), ord("b"), c) for c in letters] + [(ord("q"), ord("z"), ord("a"), c) for c in letters]
    keys = np.array([sum(c << 16 * (3 - i) for i, c in enumerate(g)) for g in grams], np.uint64)
    assert np.allclose(np.exp(models.lookup(keys)[:, 0]), [probability(g) for g in grams], rtol=1e-4)


def test_languages_of_other_planes_are_told_apart(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        base = 0x10480 if i % 2 else 0x10330
        rows.append((i, "xa" if i % 2 else "xb", " ".join("".join(chr(base + rng.randrange(26)) for _ in range(6)) for _ in range(30))))
    found = language.identify(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()
    assert all(r.lang_pred == ("xa" if r.doc_id % 2 else "xb") for r in found)


def test_unseen_texts_are_accepted_at_the_nominal_rate(spark):
    """Texts of one kind: those held out are accepted as often as those learnt from."""
    rng = random.Random(12)
    known = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    rows = [(i, "en", " ".join(rng.choices(known, k=rng.randint(20, 60)))) for i in range(9000)]
    strange = [(10_000 + i, None, " ".join("".join(rng.choice("qxzjkvw") for _ in range(5)) for _ in range(40))) for i in range(50)]
    docs = spark.createDataFrame(rows + strange, "doc_id long, lang string, text string")
    found = language.identify(docs).collect()
    held = [r.accepted for r in found if r.held_out and r.doc_id < 10_000]
    assert len(held) > 2500 and abs(sum(held) / len(held) - language.ACCEPTED) < 0.01
    assert not any(r.accepted for r in found if r.doc_id >= 10_000)


def test_languages_of_odd_rows(odd_docs, no_docs):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert {r.lang_pred for r in rows} <= {"en", "de", "xx", "und"}
    assert language.identify(no_docs).count() == 0
    unknown = odd_docs.drop("lang").withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unknown).collect()} == {"und"}


def test_models_keep_every_gram(spark):
    """More four-grams than 2**18 in one language."""
    rng = random.Random(6)
    text = "".join(chr(rng.randrange(0x4E00, 0x4E00 + 3000)) for _ in range(300_000))
    docs = spark.createDataFrame([("zh", text), ("en", "a plain text of few grams")], "lang string, text string")
    model = language.kneser_ney(language.gram_counts(docs)).filter("lang = 'zh'").toPandas()
    keys = language.keys_of(language.coded(text))
    for order in range(1, language.ORDER + 1):
        grams = np.unique(keys & np.uint64(language.mask(order)))
        assert (model.order == order).sum() == len(grams)
    assert len(grams) > 1 << 18


# Decontamination


def plain_distance(item, text):
    """Least edits between an item and a part of a text, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", min_size=1, max_size=70), st.text("ab ", max_size=90))
def test_myers_equals_the_textbook_table(item, text):
    found, end = dc.myers(item, text)
    assert found == plain_distance(item, text)
    assert end == 0 or plain_distance(item, text[:end]) == found


def test_found_items_equal_a_full_search(spark):
    rng = random.Random(4)
    items = [" ".join(words(rng, rng.randint(8, 40))) for _ in range(12)]
    texts = []
    for n in range(60):
        item = list(dc.normalised(items[n % 12]))
        for _ in range(rng.randint(0, int(len(item) * 0.09))):
            i = rng.randrange(len(item))
            item[i : i + 1] = rng.choice(["", "q", "zq"])
        texts.append(" ".join(words(rng, 40)) + "; " + "".join(item).title() + "\n" + " ".join(words(rng, 20)))
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in dc.contamination(docs, bench).collect()}
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            plain = dc.normalised(item)
            distance = plain_distance(plain, dc.normalised(text))
            if distance <= dc.budget(len(plain), dc.RATE):
                expected[d, i] = distance
    assert {k: r.distance for k, r in found.items()} == expected and 20 < len(expected) < 60
    for (d, i), r in found.items():
        part = dc.normalised(texts[d])[r.begin : r.end]
        assert plain_distance(dc.normalised(items[i]), part) == r.distance
    clean = {r.doc_id for r in dc.decontaminated(docs, bench).collect()}
    assert clean == set(range(60)) - {d for d, _ in expected}


def test_blocks_of_items_find_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    once = sorted(map(tuple, dc.contamination(docs, items).collect()))
    assert once and sorted(map(tuple, dc.contamination(docs, items, block_bytes=2000).collect())) == once
    clean, again = (dc.decontaminated(docs, items, block_bytes=b) for b in (2000, 10**9))
    assert clean.exceptAll(again).isEmpty() and again.exceptAll(clean).isEmpty()


def test_short_items_are_found_at_word_limits(spark):
    items = [(1, "What is a quark?"), (2, "東京は日本の首都ですよね本当"), (3, "one dog"), (4, "a quark is what")]
    texts = ["so: what is a QUARK, then", "what is a quarkk", "hm, awhat is a quark", "これは東京は日本の首都ですよね本当と思う",
             "there is one dog here", "One dog!"]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.begin, r.end) for r in dc.contamination(docs, bench).collect()}
    assert found == {(0, 1): (3, 18), (3, 2): (3, 17), (5, 3): (0, 7)}
    assert {r.doc_id for r in dc.decontaminated(docs, bench).collect()} == {1, 2, 4}


def test_decontamination_of_odd_rows(odd_docs, no_docs, odd_items):
    found = {(r.doc_id, r.item_id) for r in dc.contamination(odd_docs, odd_items).collect()}
    assert found == {(1, None), (2, None)}
    kept = dc.decontaminated(odd_docs, odd_items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert dc.decontaminated(odd_docs, odd_items.filter("1 = 0")).count() == odd_docs.count()
    assert dc.contamination(no_docs, odd_items).count() == 0
