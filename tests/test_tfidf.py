import math

from conftest import rows
from pyspark.sql import functions as F

from termweave.functions import document_tokens
from termweave.operators import tfidf
from termweave.sources import postings_lines

DOCUMENTS = [
    (0, "Construct Inverted Index"),
    (1, "using MapReduce"),
    (2, "inverted index code"),
    (3, "index index file"),
]


def docs(spark, data):
    table = spark.createDataFrame(data, "doc_id long, text string")
    return table.select("doc_id", document_tokens(F.col("text")).alias("tokens"))


def test_weights_of_the_small_corpus(spark):
    found = {(t, d): w for t, d, w in rows(tfidf.tfidf_index(docs(spark, DOCUMENTS)))}
    once, twice, three = 0.6020599913279624, 0.3010299956639812, 0.12493873660829992
    assert found == {
        ("code", 2): once,
        ("construct", 0): once,
        ("file", 3): once,
        ("index", 0): three,
        ("index", 2): three,
        ("index", 3): 2 * three,
        ("inverted", 0): twice,
        ("inverted", 2): twice,
        ("mapreduce", 1): once,
        ("using", 1): once,
    }


def test_a_term_of_every_document_keeps_a_zero_weight(spark):
    found = rows(tfidf.tfidf_index(docs(spark, [(1, "a b"), (2, "a c")])))
    assert {(t, d) for t, d, w in found if w == 0.0} == {("a", 1), ("a", 2)}
    assert all((w == 0.0) == (t == "a") for t, _, w in found)


def test_documents_without_words_count(spark):
    data = docs(spark, [(1, "word"), (2, " -- "), (3, "")])
    assert rows(tfidf.corpus_size(data)) == [(3,)]
    assert rows(tfidf.tfidf_index(data)) == [("word", 1, math.log10(3))]


def test_repeated_ids_merge_their_counts(spark):
    data = docs(spark, [(1, "x x y"), (1, "X"), (2, "z")])
    assert ("x", 1, 3) in rows(tfidf.term_frequency(data))
    assert ("x", 1) in rows(tfidf.document_frequency(tfidf.term_frequency(data)))
    weights = {(t, d): w for t, d, w in rows(tfidf.tfidf_index(data))}
    assert math.isclose(weights["x", 1], 3 * math.log10(3 / 1))


def test_postings_text(spark):
    data = docs(spark, [(10, "b a"), (2, "b c"), (3, "d")])
    text = [v for (v,) in rows(postings_lines(tfidf.tfidf_index(data), files=1))]
    assert [line.split(",")[0] for line in text] == ["a\t10", "b\t2", "b\t10", "c\t2", "d\t3"]
    assert text[1] == f"b\t2,{math.log10(3 / 2)}"
