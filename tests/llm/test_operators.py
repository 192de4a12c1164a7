"""Each operator on its corner cases, and against a brute-force version."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termweave.llm import (
    bpe,
    buckets,
    crf,
    dac,
    hash_tree,
    multi_index,
    pivots,
    probminhash,
    templates,
    toxicity,
    vectors,
)
from termweave.llm.queries import tokenizer_json

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Null and empty values, ties, repeated rows, controls, special tokens, a long text.
TEXTS = [
    None,
    "",
    "   \n\t ",
    "Hello  hello WORLD's it's we'll 123 ½ ok!!",
    "a<|endoftext|>b <|startoftext|>",
    "ΑΣΣ Σ İstanbul é é ß ﬁ",
    "tab\x1csep\x1dx \x85 y z　w ​",
    "日本語 emoji 😀😀 \x00 nul",
    "the same text of five words and more " * 3,
    "the same text of five words and more " * 3,
    "word " * 30_000 + "end",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(at, text, "en", "s", None) for at, text in enumerate(TEXTS)]
    rows += [rows[3], (None, "null id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def _key(row):
    return (row.doc_id is not None, row.doc_id or 0)


# Token ids


def test_segment_gives_any_id():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1 << 31, 5_000).astype(np.uint32)
    ids[::2] %= 300
    segment = dac.Segment(dac.encode(ids))
    where = rng.permutation(len(ids))
    assert (segment.access(where) == ids[where]).all()
    assert segment[17] == ids[17] and len(segment) == len(ids)
    assert len(dac.Segment(dac.encode(ids[:0]))) == 0
    with pytest.raises(IndexError):
        segment[len(ids)]


def test_ids_are_written_in_order(spark, docs, tokenizer, tmp_path):
    path = str(tmp_path / "ids")
    dac.write_ids(docs, tokenizer_json(), path, segment_ids=10)
    segments = spark.read.schema(dac.SEGMENTS).parquet(path)
    assert segments.count() > 3
    got = sorted(dac.read_ids(segments).collect(), key=lambda r: r.start)
    assert len(got) == docs.count() and [_key(r) for r in got] == sorted(_key(r) for r in got)
    start = 0
    texts = {}
    for row in docs.collect():
        texts.setdefault(row.doc_id, set()).add(row.text)
    for row in got:
        assert row.start == start
        start += row.n_tokens
        expected = [_ids(tokenizer, text) + [1] for text in texts[row.doc_id]]
        assert (row.n_tokens, row.ids_crc32) in [
            (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for ids in expected
        ]


def test_no_ids(no_docs):
    assert dac.encode_documents(no_docs, tokenizer_json()).count() == 0


# BPE


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(tokenizer_json())


def test_bpe_equals_the_library(codec, tokenizer):
    rng = random.Random(1)
    letters = "abcdeéÉßΣσςİıÀ́ \t\n 'stremld0123½٣一二ñÑ😀<|endoftext|>!?.,-_\x00\x1c﻿ǅﬁÅ"
    texts = [t for t in TEXTS if t and len(t) < 1_000]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    texts += ["".join(rng.choice("thearingoustlnd") for _ in range(rng.randint(1, 40))) for _ in range(3_000)]
    encoder = dac.Encoder(tokenizer_json())
    for text, piece in zip(texts, encoder(texts), strict=True):
        ids = _ids(tokenizer, text)
        found = np.frombuffer(codec.encode(text), "<u4")
        assert found.tolist() == ids == np.frombuffer(piece, "<u4").tolist(), text
        decoded = b"".join(codec.decode(found)).decode()
        assert decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(docs, no_docs, tokenizer):
    got = bpe.round_trip(docs, tokenizer_json()).collect()
    expected = []
    for row in docs.collect():
        ids = _ids(tokenizer, row.text)
        text = tokenizer.decode(ids, skip_special_tokens=False)
        data = struct.pack(f"<{len(ids)}I", *ids)
        expected.append(
            (
                row.doc_id,
                len(ids),
                hashlib.sha256(data).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))
    assert bpe.round_trip(no_docs, tokenizer_json()).count() == 0


# Language


def test_marginals_equal_enumeration():
    rng, k = np.random.default_rng(0), 3
    for n, begins in ((1, [0]), (5, [0]), (7, [0, 3]), (8, [0, 1, 5])):
        e, t, s = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
        first = np.isin(np.arange(n), begins)
        expected = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=n):
            weight = sum(e[i, path[i]] for i in range(n))
            weight += sum(s[path[i]] if first[i] else t[path[i - 1], path[i]] for i in range(n))
            expected[np.arange(n), path] += math.exp(weight)
        expected /= expected.sum(axis=1, keepdims=True)
        assert np.allclose(crf.marginals(e, first, t, s), expected)


def _language(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_language_of_documents_and_words(spark):
    rng = random.Random(2)
    alphabets = {"aa": "abcdef", "bb": "defghi", "cc": "xyzuvw"}
    rows = [
        (at, _language(rng, alphabets[lang], 40), lang, "s", None)
        for at, lang in enumerate(rng.choice(list(alphabets)) for _ in range(300))
    ]
    odd = [(900, None, "aa", "s", 1), (901, "", "aa", "s", 1), (902, "12 !!", None, "s", 1)]
    docs = spark.createDataFrame(rows + odd + rows[:1], DOCS)
    got = crf.detect_documents(docs).collect()
    assert len(got) == 304
    truth = {row[0]: row[2] for row in rows}
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        if row.doc_id >= 900:
            assert (row.lang_pred, row.score) == ("und", 0.0)
    held = [row for row in got if row.held_out and row.doc_id < 900]
    assert len(held) > 40 and all(row.lang_pred == truth[row.doc_id] for row in held)
    labeller = crf.Labeller(crf.train(docs))
    (found,) = labeller.label(["abca fedab bacd ... uvwx zyxw wuvx xyzz"])
    assert [labeller.model.languages[at] for at in found.argmax(axis=1)] == ["aa"] * 3 + ["cc"] * 4
    kept = crf.keep_determined(docs)
    assert kept.columns == docs.columns and kept.where("doc_id >= 900").count() == 0
    assert kept.count() == 301


def test_no_language_to_learn(docs, no_docs):
    unlabelled = docs.drop("lang").selectExpr("*", "CAST(null AS string) AS lang")
    assert {r.lang_pred for r in crf.detect_documents(unlabelled).collect()} == {"und"}
    assert crf.detect_documents(no_docs).count() == 0


def test_mixed_languages_and_unlabelled_texts_stay(spark, docs):
    rng = random.Random(3)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy"}
    rows = [
        (at, _language(rng, letters, 40), lang, "s", None)
        for at in range(200)
        for lang, letters in [list(alphabets.items())[at % 5]]
    ]
    for at, n in ((500, 4), (501, 5)):
        parts = [_language(rng, letters, 30) for letters in list(alphabets.values())[:n]]
        rows.append((at, " ".join(parts), None, "s", None))
    rows.append((900, "12 !!", None, "s", None))
    # No learned language: another script, and letters that no learned word has side by side.
    rows.append((901, "Все люди рождаются свободными и равными в своём достоинстве", None, "s", None))
    rows.append((902, _language(rng, "afkpu", 40), "zz", "s", None))
    rows.append((903, _language(rng, "abcde", 40), None, "s", None))
    mixed = spark.createDataFrame([(*row, "x") for row in rows], f"{DOCS}, _found string")
    # Rows of one text are no language of their own.
    got = crf.keep_determined(mixed.where("doc_id <> 902").unionByName(mixed.where("doc_id = 902").withColumn("lang", F.lit(None).cast("string"))))
    assert got.columns == mixed.columns
    kept = {r.doc_id: r.lang for r in got.collect()}
    assert sorted(kept) == [*range(200), 500, 501, 903]
    assert kept[903] == "aa" and kept[1] == "bb"
    unlabelled = docs.drop("lang").selectExpr("*", "CAST(null AS string) AS lang")
    kept = crf.keep_determined(unlabelled).collect()
    expected = [r for r in unlabelled.collect() if any(map(str.isalpha, r.text or ""))]
    assert sorted(map(str, kept)) == sorted(map(str, expected)) and len(kept) > 8


# Toxicity


def test_toxicity_from_positives_and_unlabelled(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for at in range(1_200):
        words = [_language(rng, "abcdefgh", 1) for _ in range(rng.randint(3, 60))]
        toxic = at % 8 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vileness", "scumbag", "vilest"]))
        rows.append((at, " ".join(words), "en", "s", None))
        if at % 2 == 0:
            labels.append((at, 1, int(toxic)))
    odd = [(5_000, None, None, None, None), (5_001, "", None, None, None), rows[0]]
    docs = spark.createDataFrame(rows + odd, DOCS)
    marks = spark.createDataFrame(labels + [(16, 0, 0), (7, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, marks).collect()
    assert len(got) == len(rows) + 3
    held = [row for row in got if row.held_out and row.doc_id < 5_000]
    assert len(held) > 150
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    assert sum(row.predicted == int(row.doc_id % 8 == 0) for row in held) >= 0.97 * len(held)
    kept = toxicity.keep_clean(docs, marks)
    assert kept.columns == docs.columns
    assert {5_000, 5_001} <= {row.doc_id for row in kept.collect()}


def test_toxicity_without_examples(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, none).collect()} == {0}
    some = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, toxic int")
    assert toxicity.score_documents(no_docs, some).count() == 0


# Packing


def _least_padding(lengths, counts, k):
    best = math.inf
    for ends in itertools.combinations(range(len(lengths) - 1), min(k, len(lengths)) - 1):
        ends, cost, at = [*ends, len(lengths) - 1], 0, 0
        for end in ends:
            cost += sum((lengths[end] - lengths[i]) * counts[i] for i in range(at, end + 1))
            at = end + 1
        best = min(best, cost)
    return best


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(300):
        m = rng.randint(1, 9)
        lengths = sorted(rng.sample(range(60), m))
        counts = [rng.choice([1, 2, 50]) for _ in range(m)]
        for k in (1, 2, 3, 20):
            ends = buckets.best_boundaries(lengths, counts, k)
            assert ends == sorted(ends) and ends[-1] == lengths[-1] and len(ends) <= k
            cost = sum(
                (next(e for e in ends if e >= size) - size) * n
                for size, n in zip(lengths, counts, strict=True)
            )
            assert cost == _least_padding(lengths, counts, k)
    assert buckets.best_boundaries([], [], 4) == []


def test_packing(docs, no_docs):
    lengths = docs.select("doc_id", buckets.word_count(docs["text"]).alias("n_tokens"))
    got = buckets.pack(lengths, buckets=3, budget=40, longest=1_000).collect()
    words = re.compile(r"[^ \t\n\x0b\f\r]+")
    expected = sorted(len(words.findall(row.text or "")) for row in docs.collect())
    assert sorted(r.n_tokens for r in got) == expected
    batches = {}
    for row in got:
        assert row.padding == row.pad_to - row.n_tokens >= 0
        batches.setdefault((row.bucket, row.batch), []).append(row)
    for (bucket, _), rows in batches.items():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len({r.pad_to for r in rows}) == 1
        assert len(rows) == 1 or sum(r.pad_to for r in rows) <= 40
    assert {len(rows) for rows in batches.values() if rows[0].n_tokens > 1_000} == {1}
    assert buckets.pack_documents(no_docs).count() == 0
    assert buckets.pack_documents(docs).count() == docs.count()


def test_batches_are_full(spark):
    rows = spark.range(1_000).selectExpr("id AS doc_id", "10L AS n_tokens", "1 AS `rank_`")
    got = buckets.pack(rows, buckets=4, budget=70).collect()
    sizes = {}
    for row in got:
        sizes[row.batch] = sizes.get(row.batch, 0) + 1
    assert sorted(sizes.values()) == [6] + [7] * 142


# Sharding


def _place(key, tree):
    def draw(path, weight):
        h = 42 if key is None else xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        for part in (101, *path):
            h = xxhash.xxh64(struct.pack("<i", part), seed=h).intdigest()
        return -math.log(((h >> 11) + 0.5) / 2**53) / weight if weight > 0 else math.inf

    draws = [draw((r, j, i), tree.weights[r][j][i]) for r, j, i in tree.paths]
    return draws.index(min(draws))


def test_shards(spark, docs, no_docs):
    many = docs.unionByName(
        spark.range(100, 5_000).selectExpr("id AS doc_id", "repeat('é', id % 7) AS text", "null AS lang", "null AS source", "id AS n_chars")
    )
    small, grown = hash_tree.tree(40), hash_tree.tree(41)
    assert small.shards == 40 and grown.shards == 41
    got = hash_tree.shard_documents(many, small, grown).collect()
    assert len(got) == many.count()
    slots = {}
    for row in got:
        assert row.shard == _place(row.doc_id, small)
        assert row.grown_shard == _place(row.doc_id, grown) and row.grown_shard in (row.shard, 40)
        slots.setdefault(row.shard, []).append(row.slot)
    assert any(row.grown_shard == 40 for row in got)
    assert len(slots) == 40 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {row.doc_id: row for row in got}
    assert (by_id[0].size, by_id[0].text_crc32) == (16, 0)
    text = TEXTS[7].encode()
    assert (by_id[7].size, by_id[7].text_crc32) == (len(text) + 16, zlib.crc32(text))
    assert hash_tree.shard_documents(no_docs, small, grown).count() == 0


def test_weights_move_rows_within_their_subtree(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    before = hash_tree.Tree((((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (2.0,))))
    after = hash_tree.Tree((((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0,))))
    placed = hash_tree.place(hash_tree.place(rows, "k", before), "k", after, "later").collect()
    counts = np.bincount([r.shard for r in placed], minlength=7) / len(placed) * 8
    assert np.allclose(counts, [1, 1, 1, 1, 1, 1, 2], atol=0.1)
    # The shard that got lighter loses rows; nothing else moves.
    assert all(r.shard == 6 for r in placed if r.later != r.shard)


@pytest.mark.parametrize(
    ("before", "after", "new"),
    [
        (hash_tree.tree(41), hash_tree.tree(42), (2, 0, 1)),
        (hash_tree.tree(45), hash_tree.tree(46), (2, 1, 0)),
        # A wider rack, a wider region, and one more region, none of them the last.
        (hash_tree.Tree((((1.0, 1.0),), ((1.0, 1.0),))), hash_tree.Tree((((1.0, 1.0, 1.0),), ((1.0, 1.0),))), (0, 0, 2)),
        (hash_tree.Tree((((1.0, 3.0),), ((1.0,), (2.0,)))), hash_tree.Tree((((1.0, 3.0), (1.0,)), ((1.0,), (2.0,)))), (0, 1, 0)),
        (hash_tree.Tree((((1.0, 1.0), (1.0,)),)), hash_tree.Tree((((1.0, 1.0), (1.0,)), ((2.0,),))), (1, 0, 0)),
    ],
)
def test_one_more_shard_takes_rows_only_into_itself(spark, before, after, new):
    rows = spark.range(6_000).withColumnRenamed("id", "k")
    placed = hash_tree.place(hash_tree.place(rows, "k", before), "k", after, "later").collect()
    moved = [r for r in placed if before.paths[r.shard] != after.paths[r.later]]
    assert moved and all(after.paths[r.later] == new for r in moved)
    share = after.weights[new[0]][new[1]][new[2]] / sum(w for region in after.weights for rack in region for w in rack)
    assert abs(len(moved) / len(placed) - share) < 0.03


# Near duplicates


def _classes(texts):
    sets = []
    for text in texts:
        words = text.lower().split()
        width = min(5, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1) if words})
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if texts[i] == texts[j] or a and b and len(a & b) >= 0.8 * len(a | b):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def _copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = " ".join(f"v{rng.randrange(500)}" for _ in range(rng.randint(60, 200)))
        texts += [base] * rng.randint(1, 3)
        texts += _copies(rng, base, rng.randint(0, 4), rng.randint(1, 3))
        texts += _copies(rng, base, 2, 15)
    base = " ".join(f"u{rng.randrange(500)}" for _ in range(120))
    texts += _copies(rng, base, 40, 2) + [base]
    texts += ["one two", "one two", "ONE two", "", "", "  ", "a b c d e f"]
    rng.shuffle(texts)
    rows = [(at, text, "en", "s", None) for at, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in probminhash.near_duplicates(docs).collect()}
    assert [got[at].class_id for at in range(len(texts))] == _classes(texts)
    assert all(got[at].copy_of == texts.index(text) for at, text in enumerate(texts))
    kept = probminhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(_classes(texts)))


def _unlike(rng, n):
    return " ".join(f"x{rng.randrange(10**9)}" for _ in range(n))


def test_close_pairs_in_a_family_below_the_threshold(spark):
    rng = random.Random(17)
    passage = _unlike(rng, 300)
    # All have a similarity of 0.75 by the passage; 60 pairs have 0.81 by the start of their ends.
    texts = [f"{passage} {_unlike(rng, 50)}" for _ in range(40)]
    for _ in range(60):
        start = f"{passage} {_unlike(rng, 14)}"
        texts += [f"{start} {_unlike(rng, 36)}" for _ in range(2)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(at, t, None, None, None) for at, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    expected = _classes(texts)
    assert len(set(expected)) == 100
    assert [got[at] for at in range(len(texts))] == expected


def test_prefix_filter_finds_all_pairs_of_different_classes(spark):
    rng = random.Random(23)
    texts = []
    for _ in range(12):
        base = " ".join(f"v{rng.randrange(300)}" for _ in range(rng.randint(40, 120)))
        texts += [base, *_copies(rng, base, 4, 1), *_copies(rng, base, 2, 3)]
    texts += ["one two", "two three"]
    reps = [bytes([at // 256, at % 256]) for at in range(len(texts))]
    classes = [rng.choice(reps[:20]) for _ in texts]
    found = probminhash._unmet(
        spark.createDataFrame(list(zip(reps, classes, strict=True)), "rep binary, class binary"),
        spark.createDataFrame(list(zip(reps, texts, strict=True)), "rep binary, text string"),
    )
    found = {(bytes(r.a), bytes(r.b)) for r in found.collect()}
    words = probminhash.Words()
    sets = [np.unique(probminhash.shingles(text, words)) for text in texts]
    close = {
        (reps[i], reps[j])
        for i, j in itertools.combinations(range(len(texts)), 2)
        if classes[i] != classes[j] and probminhash.jaccard(sets[i], sets[j]) >= 0.8
    }
    assert close and close <= found


def test_repeated_lines_do_not_hide_copies(spark):
    rng = random.Random(29)
    texts = []
    for times in (1, 50, 1_000, 1_000, 1_000):
        common = _unlike(rng, 404)
        # 400 common shingles and 20 own ones a text: a plain similarity of 0.9 at any count.
        texts += [f"{common} " + f"{_unlike(rng, 20)} " * times for _ in range(2)]
    docs = spark.createDataFrame([(at, t, None, None, None) for at, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    assert [got[at] for at in range(len(texts))] == _classes(texts) == [0, 0, 2, 2, 4, 4, 6, 6, 8, 8]


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(11)
    name = {at: rng.getrandbits(40) for at in range(400)}
    links = [(at, at + 1) for at in range(60)]
    links += [(100, at) for at in range(101, 160)] + [(at, 199) for at in range(170, 199)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    links += links[:20] + [(b, a) for a, b in links[30:50]]
    links = [(name[a], name[b]) for a, b in links if a != b]
    expected = {x: x for link in links for x in link}
    for _ in expected:
        before = dict(expected)
        for a, b in links:
            expected[a] = expected[b] = min(expected[a], expected[b])
        if expected == before:
            break
    tables = spark.createDataFrame(links, "a long, b long")
    got = probminhash.components(tables).collect()
    assert len(got) == len(expected)
    assert {r.rep: r["class"] for r in got} == expected
    # The same, with half of the links coming later.
    first = probminhash.components(tables.where("a % 2 = 0"))
    later = probminhash._joined(first, tables.where("a % 2 = 1"))
    assert sorted((r.rep, r["class"]) for r in later.collect()) == sorted(expected.items())
    assert probminhash.components(tables.where("false")).count() == 0


def test_near_duplicate_corner_cases(docs, no_docs, spark):
    got = probminhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    class_of = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert class_of[8] == class_of[9] == 8 and class_of[0] == 0 and class_of[3] == 3
    kept = probminhash.keep_first(docs.withColumnRenamed("source", "rep").withColumnRenamed("lang", "class"))
    assert kept.columns == ["doc_id", "text", "class", "rep", "n_chars"]
    # One row each: row 3 stands twice, 9 copies 8, and one of two null texts has an id.
    assert kept.count() == docs.count() - 3
    assert probminhash.near_duplicates(no_docs).count() == 0
    assert probminhash.keep_first(no_docs).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 1 << 62, 100).astype(np.uint64)])
    one, two, empty = probminhash.signatures([a, b, a[:0]], registers=4_096)
    assert abs((one == two).mean() - 200 / 400) < 0.04
    assert (empty == empty[0]).all()


# Vector searches


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [
        (100, None, 0), (101, [nan] * 8, 0), (102, [inf] + [0.0] * 7, 0), (103, [], 0),
        (104, [None] + [1.0] * 7, 0), (105, [1.0, 2.0], 0), (None, [1.0] * 8, 0), (1_000, [0.0] * 8, 1),
    ]


@pytest.fixture(scope="module")
def some_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(at, rng.normal(size=8).round(2).tolist(), 0) for at in range(90)]
    rows += [(at, rows[at % 5][1], 0) for at in range(200, 260)]  # ties
    return rows, _vectors(spark, rows + _odd_vectors() + rows[:2])


def test_top_k_equals_brute_force(spark, some_vectors, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 2), ("SLICE", 4), ("SAMPLE", 32)):
        monkeypatch.setattr(pivots, name, value)
    rows, table = some_vectors
    # Rows that repeat an id, equal or not, are candidates of their own.
    more = [(at, [0.5 * at] * 8, 0) for at in (20, 33, 60)]
    whole = [
        (at, np.floor(64 * np.array(np.array(v, dtype=np.float32), dtype=float)).astype(int))
        for at, v, _ in [*rows, (1_000, [0.0] * 8, 1), *rows[:2], *more]
    ]
    expected = []
    for place, (q, vector) in enumerate(whole):
        if q % 20 == 0:
            found = sorted((-int(vector @ v), c) for i, (c, v) in enumerate(whole) if i != place)[:7]
            expected += [(q, at + 1, c, -s) for at, (s, c) in enumerate(found)]
    got = pivots.top_k(table.unionByName(_vectors(table.sparkSession, more)), k=7)
    got = got.select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_few_and_no_vectors(spark):
    two = _vectors(spark, [(0, [0.5, -0.25], 0), (7, [1.0, 1.0], 0)])
    assert [tuple(r) for r in pivots.top_k(two).collect()] == [(0, 1, 7, 64 * 32 - 64 * 16)]
    assert [tuple(r)[:3] for r in multi_index.search(two).collect()] == [(0, 1, 7)]
    one = _vectors(spark, [(0, [0.5, -0.25], 0)])
    assert pivots.top_k(one).count() == multi_index.search(one).count() == 0
    none = _vectors(spark, _odd_vectors()[:4])
    assert pivots.top_k(none).count() == multi_index.search(none).count() == 0


def test_large_scores_are_exact():
    big = np.array([[3.0e8, 1.0], [3.0e8, 0.0]])
    assert pivots.scores(big, big)[0].tolist() == [90_000_000_000_000_001, 90_000_000_000_000_000]


def test_multi_index_on_few_rows_is_exact(spark, some_vectors):
    rows, table = some_vectors
    raw = [(at, np.array(np.array(v, dtype=np.float32), dtype=float)) for at, v, _ in [*rows, *rows[:2]]]
    by_id = dict(raw)
    got = multi_index.search(table, every=50, k=5, recall=1.0).collect()
    for row in got:
        a, b = by_id[row.query_id], by_id[row.vec_id]
        assert math.isclose(row.score, a @ b / math.sqrt((a @ a) * (b @ b)), rel_tol=1e-12)
    expected = []
    for place, (q, v) in enumerate(raw):
        if q % 50 == 0:
            near = [
                (-round(v @ c / math.sqrt((v @ v) * (c @ c)), 12), at) for i, (at, c) in enumerate(raw) if i != place
            ]
            expected += [(q, rank, at) for rank, (_, at) in enumerate(sorted(near)[:5], 1)]
    # Row 0 is there twice: both are queries, and near each other.
    assert (0, 1, 0) in expected
    found = [(r.query_id, r.rank, r.vec_id) for r in got]
    assert sorted((q, rank) for q, rank, _ in found) == sorted((q, rank) for q, rank, _ in expected)
    assert len(set(found) & set(expected)) >= 0.9 * len(set(expected))


def test_multi_index_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = table.collect()
    raw = np.array([r.embedding for r in rows], dtype=float)
    ids = np.array([r.vec_id for r in rows])
    raw /= np.linalg.norm(raw, axis=1, keepdims=True)
    got = multi_index.search(table).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        near = raw @ raw[q]
        near[q] = -2
        best = set(ids[np.argsort(-near)[:5]].tolist())
        hits += len(best & {r.vec_id for r in got if r.query_id == ids[q]})
        total += 5
    assert hits >= 0.9 * total


def test_walk_is_in_order_of_summed_distance():
    rng = np.random.default_rng(8)
    sample = rng.normal(size=(200, 6))
    index = multi_index.Index(sample, 5)
    counts = np.ones(25, dtype=int)
    walked = index.traverse(sample[3], counts, 25)
    a, b = (
        multi_index._distances(part, book)[0]
        for part, book in zip(index.halves(sample[3:4]), index.books, strict=True)
    )
    sums = [a[c // 5] + b[c % 5] for c in walked]
    assert sorted(walked) == list(range(25)) and sums == sorted(sums)


def test_packed_vectors():
    ids, rows = vectors.unpacked(**vectors.packed(np.array([3, 4]), np.arange(6.0).reshape(2, 3)))
    assert ids.tolist() == [3, 4] and rows.tolist() == [[0, 1, 2], [3, 4, 5]]


# Pages


def _page(at, body, host="h.example"):
    variant = at % 3
    return (
        at,
        f"https://{host}/p/{at}",
        f"<html><head><title>t</title><style>x</style></head><body><div class=top><b>Site {variant}</b>"
        f"</div>{body}<div class='x'>Rights reserved, variant {variant}</div></body></html>",
    )


@pytest.mark.parametrize("few", [1_000, 0])
def test_templates_are_removed(spark, few):
    words = [f"Unique words {at} &amp; more" for at in range(40)]
    rows = [_page(at, f"<div class=t><p>{words[at]}<p>tail {at * 7}</div>") for at in range(40)]
    # A passage that many pages share stands where others stand, and stays.
    rows += [_page(at, "<div class=t><p>shared passage<p>of many</div>") for at in range(40, 55)]
    rows += [_page(at, f"<div class=t><p>seldom {at}</div>", "small.example") for at in range(60, 63)]
    rows += [(90, None, None), (91, "x", ""), (None, None, "<p>no id"), rows[0], rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = templates.extract_pages(pages, few=few).collect()
    assert len(got) == len(rows)
    texts = {row.page_id: row.text for row in got}
    for at in range(40):
        assert texts[at] == f"Unique words {at} & more\n\ntail {at * 7}"
    assert all(texts[at] == "shared passage\n\nof many" for at in range(40, 55))
    assert texts[60] == "Site 0\n\nseldom 60\n\nRights reserved, variant 0"
    assert texts[90] == texts[91] == "" and texts[None] == "no id"
    assert sum(row.page_id == 0 for row in got) == 3
    assert all(row.n_chars == len(row.text) for row in got)
    assert templates.extract_pages(pages.limit(0), few=few).count() == 0


def _plain_extraction(rows, least, share):
    """Templates by whole serialised subtrees in dictionaries, one page after the other."""

    def walk(node, chain):
        text = node.tag + "|" + "|".join(
            f"<{walk_text(c)}>" if isinstance(c, templates.Node) else " ".join(c.split()) for c in node.children
            if isinstance(c, templates.Node) or c.strip()
        )
        if node.tag:
            yield chain + node.place, text, node
        for child in node.children:
            if isinstance(child, templates.Node) and child.tag != "head":
                yield from walk(child, chain)

    def walk_text(node):
        return node.tag + "|" + "|".join(
            f"<{walk_text(c)}>" if isinstance(c, templates.Node) else " ".join(c.split()) for c in node.children
            if isinstance(c, templates.Node) or c.strip()
        )

    def host(url):
        return re.match("[a-z]+://([^/]+)", url)[1] + " "

    counts: dict[tuple, int] = {}
    for url, page in {(host(url), page) for _, url, page in rows}:
        for key in {(place, text) for place, text, _ in walk(templates.parse(page), url)}:
            counts[key] = counts.get(key, 0) + 1
    places: dict[str, list[int]] = {}
    for (place, _), n in counts.items():
        both = places.setdefault(place, [0, 0])
        both[0] += n
        both[1] += n if n >= least else 0
    gone = {
        key for key, n in counts.items() if n >= least and places[key[0]][1] >= share * places[key[0]][0]
    }

    def prune(node, chain):
        node.children = [
            c for c in node.children
            if not isinstance(c, templates.Node) or (chain + c.place, walk_text(c)) not in gone
        ]
        for child in node.children:
            if isinstance(child, templates.Node):
                prune(child, chain)

    texts = []
    for page_id, url, page in rows:
        root, whole = templates.parse(page), templates.parse(page)
        # Subtrees are compared as they were, so outer ones are looked at before inner ones are cut.
        prune(root, host(url))
        text = templates.main_text(root)
        if not text:
            text = "\n\n".join(templates._parts(whole, "article", frozenset()))
        texts.append((page_id, text))
    return texts


def test_templates_equal_a_plain_count(spark):
    """Several hosts, templates inside articles, variants, copies of whole pages and pages of templates only."""
    pick = random.Random(11)
    rows = []
    for at in range(160):
        name = pick.choice(("a.example", "b.example", "c.example"))
        notice = f"<div class=n>Notice {pick.randrange(2)} of {name}</div>" if pick.random() < 0.9 else ""
        inner = f"<section class=k><p>Read on {name} {pick.randrange(2)}</p></section>"
        own = "".join(f"<p>{name} own {pick.randrange(10**6)}</p>" for _ in range(pick.randint(0, 3)))
        article = pick.choice(("<article>{}{}</article>", "<div class=t>{}{}</div>")).format(own, inner)
        rows.append((at, f"http://{name}/{at}", f"<html><body>{notice}{article}<b>tail {pick.randrange(3)}</b></body></html>"))
    rows += [(200 + at, f"http://a.example/{at}", rows[0][2]) for at in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in templates.extract_pages(pages).collect())
    assert got == sorted(_plain_extraction(rows, templates.LEAST_PAGES, templates.PLACE_SHARE))
    without = [templates.main_text(templates.parse(page)) for _, _, page in rows]
    assert sum(a != b for (_, a), b in zip(got, without, strict=True)) > len(rows) / 2


@pytest.mark.parametrize("few", [1_000, 0])
def test_templates_stay_outside_their_place(spark, few):
    menu = "<div class=m><ul><li><a href='/news'>News</a><li>Offer of the day</ul></div>"
    body = "<div class=t><p>Text {0} has <a href='/x'>News</a> in it<ul><li>Offer of the day<li>own {0}</ul></div>"
    rows = [(at, f"https://h.example/{at}", menu + body.format(at)) for at in range(30)]
    # Few articles hold the link, so it is a template at the menu's place only.
    rows += [(at, f"https://h.example/{at}", f"{menu}<div class=t><p>plain {at}</div>") for at in range(30, 60)]
    rows = rows[:9] + rows[30:]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in templates.extract_pages(pages, few=few).collect()}
    for at in range(9):
        assert texts[at] == f"Text {at} has News in it\n\nOffer of the day\n\nown {at}"
    assert all(texts[at] == f"plain {at}" for at in range(30, 60))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a<b>b</b>c &nbsp; d<p>e<ul><li>f<li>g</ul><pre>x\n y</pre>", "abc d\n\ne\n\nf\n\ng\n\nx y"),
        ("<table><tr><td>1<td>2<tr><td>3</table>tail<br>end", "1\n\n2\n\n3\n\ntail end"),
        ("<body>out<article><header><h1>T</h1><p>by x</header>in</article></body>", "T\n\nin"),
        ("<article><p>x<div class='reader comments'>no</div><aside>no</aside></article>", "x"),
        ("<nav>n</nav><main><p>a</p><form>f</form></main><footer>f</footer>", "a"),
        ("<script>var t='</p>';</script><p>ok<!-- <p>no --></p><p>cut &am", "ok\n\ncut &am"),
        ("<p title='a>b'>q</p></div></p><p>r <a href=", "q\n\nr"),
        ("<article>short</article><article>the longer one</article>", "short\n\nthe longer one"),
        ("<article>teaser</article><div>the long text of the page</div>", "teaser\n\nthe long text of the page"),
        ("<article><h2 class='section-header'>h</h2><p>x</article>", "h\n\nx"),
        ("<article><div class='article-header'><h1>T</h1></div>x</article>", "T\n\nx"),
        ("<body><p class='share-price'>9.50<p class='review-widget-free search-result'>r", "9.50\n\nr"),
        ("<p title='a hidden gem'>g</p><p data-id='menu-7'>m</p><p id=menu-7>n</p>", "g\n\nm\n\nn"),
        ("<p data-x=\"class='ad'\" class='lead'>l<div class='site-footer'>no</div><div id='cookie-notice'>no</div>", "l"),
        ("<article><div class='header'><h1>T</h1></div><div class='share-buttons ad'>no</div>x</article>", "T\n\nx"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>1 < 2 &lt; 3", "1 < 2 < 3"),
        ("<article>" + "<div>" * 3_000 + "deep", "deep"),
    ],
)
def test_markup(html, text):
    assert templates.main_text(templates.parse(html)) == text
