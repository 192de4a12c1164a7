"""The whole pipeline on a small corpus on disk, against planted texts and plain Python."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from termweave.llm import buckets

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst"}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, letters, n):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n)]


def _corpus():
    """Clean texts in four languages and mixed, toxic ones, near copies around the threshold, and texts to reject."""
    rng = random.Random(12)
    rows, labels, toxic, foreign = [], [], set(), set()
    for at in range(400):
        lang = list(LETTERS)[at % 4]
        words = _words(rng, LETTERS[lang], rng.randint(8, 80))
        if at % 7 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["vileness", "scumbag", "vilest"]))
            toxic.add(at)
        labels.append((at, 1, int(at in toxic)))
        rows.append([at, " ".join(words), lang])
    clean = [row for row in rows if row[0] not in toxic]
    at = 1_000
    for row in rng.sample(clean, 60):  # copies, some exact, others with one to four words changed
        words = row[1].split()
        for place in rng.sample(range(len(words)), rng.randint(0, 4)):
            words[place] = words[place][::-1] + words[place][:2]
        rows.append([at, " ".join(words), row[2]])
        at += 1
    base = _words(rng, LETTERS["aa"], 60)
    for _ in range(40):  # a family just around the threshold
        words = list(base)
        start = rng.randrange(len(words) - 6)
        words[start : start + rng.randint(1, 4)] = _words(rng, LETTERS["aa"], rng.randint(1, 5))
        rows.append([at, " ".join(words), "aa"])
        at += 1
    mixed = [word for letters in LETTERS.values() for word in _words(rng, letters, 10)]
    rows += [[2_000, " ".join(mixed), None], [2_001, " ".join(_words(rng, LETTERS["bb"], 30)), None]]
    for text in ("Все люди рождаются свободными и равными в достоинстве", "12 345 !!", "", None):
        foreign.add(3_000 + len(foreign))
        rows.append([2_999 + len(foreign), text, None])
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in rows], labels, toxic, foreign


def _first_of_classes(rows):
    """Ids that stay if all pairs of texts are compared by their sets of runs of five words."""
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        width = min(5, len(words))
        sets[i] = {tuple(words[at : at + width]) for at in range(len(words) - width + 1)}
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                one, two = sorted((find(a), find(b)))
                head[two] = one
    return {i for i in ids if find(i) == i}


def _least_padding(lengths, k):
    """By trying, for each bucket's end, all starts."""
    sizes = sorted(set(lengths))
    count = {s: lengths.count(s) for s in sizes}
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(min(k, len(sizes))):
        best = [0] + [
            min(best[i] + sum((sizes[j] - s) * count[s] for s in sizes[i : j + 1]) for i in range(j + 1))
            for j in range(len(sizes))
        ]
    return best[-1]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows, labels, toxic, foreign = _corpus()
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    kinds = "doc_id long, quality int, toxic int"
    spark.createDataFrame(labels, kinds).write.parquet(f"{folder}/labels.parquet")
    return str(folder), {row[0]: row for row in rows}, toxic, foreign


def test_run_equals_plain_python(spark, corpus):
    folder, rows, toxic, foreign = corpus
    survivors = [(i, row[1]) for i, row in rows.items() if i not in toxic | foreign]
    expected = _first_of_classes(survivors)
    assert 300 < len(expected) < len(survivors) - 15
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in packed) == sorted(expected)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(tokenizer.encode(rows[i][1], add_special_tokens=False).ids) for i in expected}
    batches: dict[tuple[int, int], list] = {}
    for row in packed:
        assert row.n_tokens == lengths[row.doc_id] and row.padding == row.pad_to - row.n_tokens >= 0
        batches.setdefault((row.bucket, row.batch), []).append(row)
    assert sum(r.padding for r in packed) == _least_padding(list(lengths.values()), buckets.BUCKETS)
    for members in batches.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) * members[0].pad_to <= buckets.BUDGET


def test_stages_keep_the_columns_and_fill_languages(spark, corpus):
    folder, rows, toxic, foreign = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        docs = kept
    got = {r.doc_id: r for r in docs.collect()}
    assert sorted(got) == sorted(set(rows) - toxic - foreign)
    assert got[2_001].lang == "bb" and got[2_000].lang in LETTERS
    assert all(tuple(r) == rows[i] for i, r in got.items() if i not in (2_000, 2_001))
