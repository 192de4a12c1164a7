import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from termweave.functions import document_tokens, letter_runs, line_tokens, space_tokens
from termweave.sources import (
    parse_documents,
    parse_edges,
    parse_token_sets,
    read_documents,
    read_edges,
    read_saved,
    read_token_sets,
    write_postings,
    write_relative_frequencies,
    write_similarities,
)


def apply(spark, function, text):
    table = spark.createDataFrame([(text,)], "text string")
    return table.select(function(F.col("text"))).first()[0]


def test_document_tokenizer(spark):
    every = "a b$c&d#e/f\tg\nh\fi\"j'k\\l,m.n:o;p?q!r[s]t(u)v{w}x<y>z~A-B_C*D"
    assert "".join(apply(spark, document_tokens, every)) == "abcdefghijklmnopqrstuvwxyzABCD"
    assert apply(spark, document_tokens, "1st a\rb x@y 5%+=|") == ["1st", "a\rb", "x@y", "5%+=|"]
    assert apply(spark, document_tokens, " -- ") == []


def test_line_tokenizer(spark):
    assert apply(spark, line_tokens, r"One\two 3rd Été x\y, \z") == [r"one\two", r"x\y"]
    assert apply(spark, line_tokens, "a\x0bb\rc  'd'") == ["a", "b", "c", "d"]
    assert apply(spark, line_tokens, "") == []


def test_set_tokenizers(spark):
    assert apply(spark, space_tokens, "7  a a\tb ") == ["7", "a", "a\tb"]
    assert apply(spark, letter_runs, "Ab-ab c3d éx") == ["ab", "c", "d", "x"]


def saved(tmp_path, text):
    (tmp_path / "input").write_bytes(text.encode())
    return str(tmp_path / "input")


def test_documents_of_lines(spark, tmp_path):
    path = saved(tmp_path, "2 Two words\r\n\r\n10\n x\n'7' seven\n")
    assert sorted(rows(read_documents(spark, path, rejects="drop"))) == [
        (2, ["Two", "words"]),
        (7, ["seven"]),
        (10, []),
    ]
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    assert parse_documents(lines).where("doc_id IS NULL").count() == 1


def test_edges_of_lines(spark, tmp_path):
    path = saved(tmp_path, "0 0 1\r\n1 0 2\r\n\r\nx 1 y\r\n3 5\r\n")
    assert sorted(rows(read_edges(spark, path, rejects="drop"))) == [(0, 0, 1), (1, 0, 2)]
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    assert parse_edges(lines).where("src IS NULL OR dst IS NULL").count() == 2


def test_token_sets_of_lines(spark, tmp_path):
    path = saved(tmp_path, "4 b  a b\n5\n\nid a\n")
    assert sorted(rows(read_token_sets(spark, path, rejects="drop"))) == [(4, ["b", "a"]), (5, [])]
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    assert parse_token_sets(lines).where("id IS NULL").count() == 1


@pytest.mark.parametrize(
    ("reader", "text"),
    [
        (read_edges, "0 0 1\n1\t1\t2\n"),
        (read_edges, "0 0 1\n1  1 2\n"),
        (read_documents, "1 a\nx b\n"),
        (read_token_sets, "1 a\nx b\n"),
    ],
)
def test_rejected_lines_are_seen(spark, tmp_path, reader, text):
    path = saved(tmp_path, text)
    with pytest.raises(Exception, match="not a line of"):
        reader(spark, path).collect()
    assert reader(spark, path, rejects="drop").count() == 1
    with pytest.raises(ValueError, match="rejects"):
        reader(spark, path, rejects="other")


def parts(folder):
    return [part.read_text() for part in sorted(folder.glob("part-*"))]


def test_written_text(spark, tmp_path):
    index = spark.createDataFrame(
        [("b", 2, 0.5), ("a", 10, 0.0), ("a", 9, 1.6e-5)], "term string, doc_id long, tfidf double"
    )
    write_postings(index, str(tmp_path / "postings"), files=1)
    assert parts(tmp_path / "postings") == ["a\t9,1.6E-5\na\t10,0.0\nb\t2,0.5\n"]
    write_postings(index, str(tmp_path / "many"), files=3)
    assert "".join(parts(tmp_path / "many")) == "a\t9,1.6E-5\na\t10,0.0\nb\t2,0.5\n"
    frequencies = spark.createDataFrame([("a", "b", 1.0)], "t1 string, t2 string, freq double")
    write_relative_frequencies(frequencies, str(tmp_path / "frequencies"))
    assert "".join(parts(tmp_path / "frequencies")) == "a b 1.0\n"
    pairs = spark.createDataFrame([(1, 2, 0.9)], "rid long, sid long, sim double")
    write_similarities(pairs, str(tmp_path / "pairs"))
    assert "".join(parts(tmp_path / "pairs")) == "(1,2)\t0.9\n"


def test_rejected_lines_are_counted(spark, tmp_path):
    cases = (
        (read_documents, "1 a b\nx c\n\n2\nseven d\n", 4, 2),
        (read_edges, "0 1 2\n1 a 2\n2 3\n \n3 4 5\n", 4, 2),
        (read_token_sets, "1 a\n1.5 b\n", 2, 1),
    )
    for at, (reader, text, read, rejected) in enumerate(cases):
        path = tmp_path / f"lines{at}"
        path.write_text(text)
        seen = Observation(f"lines{at}")
        assert reader(spark, str(path), rejects=seen).count() == read - rejected
        assert seen.get == {"read": read, "rejected": rejected}


def test_saved_lines_come_back_in_order(spark, tmp_path, request):
    name = "spark.sql.files.maxPartitionBytes"
    request.addfinalizer(lambda before=spark.conf.get(name): spark.conf.set(name, before))
    values = [f"line {at:05d}" for at in range(3_000)]
    table = spark.createDataFrame(list(enumerate(values)), "at long, value string")
    path = str(tmp_path / "saved")
    table.repartitionByRange(5, "at").sortWithinPartitions("at").select("value").write.text(path)
    spark.conf.set(name, "3000")  # several parts a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.files.openCostInBytes"))
    got = sorted((r.line_no, r.value) for r in read_saved(spark, path).collect())
    assert got == [(at + 1, value) for at, value in enumerate(values)]
