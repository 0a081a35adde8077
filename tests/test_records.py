"""Quoted text with line breaks: splits anywhere give the rows of a whole-file read."""

import random

import pytest
from pyspark.sql import functions as F

from matchwright.sources import readers as SR


def plain(spark, path, columns, sep=",", charset="UTF-8"):
    """The library's own reader, which takes such files whole."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return reader.option("sep", sep).option("encoding", charset).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def quoted_text(seed, n):
    rng = random.Random(seed)
    words = ["plain", "with, comma", 'a "word" in', "two\nlines", "\n\n\n", '""', 'ends with "', '" begins', 'é\n"x",\n"y"', "x" * 150, "", "1"]
    field = lambda: '"' + rng.choice(words).replace('"', '""') + '"' if rng.random() < 0.7 else rng.choice(['5" pipe', "bare", "", 'it"s, '[:4]])
    return "id,note,more\n" + "".join(f'{i},{field()},{field()}\n' for i in range(n))


@pytest.mark.parametrize("size, n", [(13, 12), (150, 80), (100_000, 300)])
def test_any_split_gives_the_same_rows(spark, tmp_path, small_splits, size, n):
    text = quoted_text(size, n)
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text(quoted_text(1, 8))
    small_splits(size)
    got = SR.read_delimited_strings(spark, str(tmp_path), ",", "UTF-8", multi_line=True)
    assert got.columns == ["id", "note", "more"]
    found = SR.records(spark, str(tmp_path), ",")
    tasks = found.rdd.getNumPartitions() if size < 100_000 else 0
    assert rows(got) == rows(plain(spark, str(tmp_path), ["id", "note", "more"]))
    assert size == 100_000 or tasks > len(text) // size // 2  # one file, many tasks


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('a,b\n1,"' + "line, with commas\n" * 100 + '"\n2,x\n')
    small_splits(50)
    got = rows(SR.read_delimited_strings(spark, str(tmp_path), multi_line=True))
    assert got == [("1", "line, with commas\n" * 100), ("2", "x")]


def test_carriage_returns_charset_and_no_last_line_end(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes('a;b\r\n1;"Bogotá\r\n"\r\n2;"ñ"'.encode("latin-1"))
    small_splits(6)
    got = rows(SR.read_delimited_strings(spark, str(tmp_path), multi_line=True))
    assert got == [("1", "Bogotá\r\n"), ("2", "ñ")]


def test_inference_sees_records(spark, tmp_path):
    """Commas of a long quoted text, which stand outside quotes on their own lines, do not count."""
    (tmp_path / "a.txt").write_text('a;b,c\n' + '1;"x\nmany, many, many, commas, here\nand, here"\n' * 5)
    assert SR.infer_text_format(spark, str(tmp_path), multi_line=True).first()["delimiter"] == "semicolon"
    assert SR.infer_text_format(spark, str(tmp_path)).first()["delimiter"] == "comma"


def test_empty_and_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert SR.read_delimited_strings(spark, str(tmp_path), ",", "UTF-8", columns=["a"], multi_line=True).count() == 0
    (tmp_path / "b.csv").write_text('"a",b\n')
    out = SR.read_delimited_strings(spark, str(tmp_path), multi_line=True)
    assert out.columns == ["a", "b"] and out.count() == 0
    assert out.where(F.col("a").isNotNull()).count() == 0
