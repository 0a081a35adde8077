"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import functions as F

WORDS = "the rain fell on old harbour walls while boats stayed in and nobody sold any fish at market that day".split()


def sentence(n, shift=0):
    return " ".join(WORDS[(i * 7 + shift * 3 + i // 5) % len(WORDS)] for i in range(n))


LONG = " ".join(f"w{i * i % 9973}" for i in range(60000))

ROWS = [
    (0, sentence(80)),
    (1, sentence(80)),
    (2, sentence(80, 1) + "\n" + sentence(20, 2) + "\n" + sentence(20, 2)),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "Éa Zürich 中文 «x». don't 12.5% H̱ <|endoftext|>, a b Σας"),
    (7, "mail a.b@c.example or +1 (415) 555-2671, card 4111 1111 1111 1111, host 10.0.0.1 and 10.0.0.999"),
    (None, sentence(10)),
    (None, sentence(10)),
    (8, sentence(300, 5)),
    (8, sentence(300, 5)),
    (9, "a"),
    (10, "a b"),
    (11, LONG),
    (12, "Licensed under the Apache License, Version 2.0. Released under the MIT License. GNU General Public License mit-license"),
]


def documents(spark, rows=ROWS):
    """doc_id, text, and further columns, some named like the operators' own."""
    base = spark.createDataFrame(list(rows), "doc_id long, text string")
    return base.select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("int").alias("n_chars"),
        F.lit(1).alias("n_words"), F.lit("x").alias("fp"), F.lit(2).alias("number"), F.lit(3).alias("block"), F.lit("y").alias("hits"),
        F.lit(4).alias("kept"), F.lit(None).cast("int").alias("spans"), F.lit(5).alias("row"),
    )


def key(row):
    return tuple((v is not None, v) for v in row)
