"""Table profiles: nulls, numeric ranges, categories, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.functions.cleaning import lenient
from matchwright.operators.aggregates import count_where


def profile_nulls(df: DataFrame) -> DataFrame:
    """Columns that have nulls, with their number; one pass over the table."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "columna", "nulos").where(F.col("nulos") > 0)


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, zeros, negatives and nulls of text columns read as numbers."""
    parsed = df.select(
        *[lenient(F.regexp_replace(F.col(c).cast("string"), "^([^,]*),", "$1."), "double").alias(c) for c in columns]
    )
    long = parsed.unpivot([], list(columns), "columna", "v")
    return long.groupBy("columna").agg(
        F.min("v").alias("minimo"),
        F.max("v").alias("maximo"),
        count_where(F.col("v") == 0).alias("ceros"),
        count_where(F.col("v") < 0).alias("negativos"),
        count_where(F.col("v").isNull()).alias("nulos"),
    )


def profile_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """columna, valor, n for every value of every listed column, null included."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "columna", "valor"
    )
    return long.groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))


def profile_text(df: DataFrame, column: str) -> DataFrame:
    """nulls, empty strings and distinct values (null is a value) of a text column."""
    c = F.col(column)
    return df.agg(
        count_where(c.isNull()).alias("nulos"),
        count_where(c == "").alias("vacios"),
        (F.count_distinct(c) + F.max(c.isNull().cast("int"))).alias("distintos"),
    )


def profile_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row, and rows that are fully repeated."""
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    full = whole.agg(F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("exactas"))
    by_key = whole.groupBy(*key).agg(F.sum("__n").alias("__k"))
    keyed = by_key.agg(F.coalesce(F.sum(F.when(F.col("__k") > 1, F.col("__k"))), F.lit(0)).alias("por_llave"))
    return keyed.withColumn("exactas", full.scalar())
