"""Cleaning steps for loosely typed tables. Every function maps a DataFrame to a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchwright.functions.expr import as_col, lookup

# Every character Unicode counts as white space (SQL trim() removes only blanks).
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def require(df: DataFrame, columns: Iterable[str]) -> None:
    """An error that names the listed columns the table lacks."""
    absent = [c for c in columns if c not in set(df.columns)]
    if absent:
        raise ValueError(f"the table lacks {absent}; it has {df.columns}")


def _replace(df: DataFrame, columns: Sequence[str], make) -> DataFrame:
    """Rewrite the listed columns in a single projection; a column the table lacks is an error."""
    require(df, columns)
    return df.withColumns({c: make(F.col(c)) for c in columns})


def clean_strings(df: DataFrame) -> DataFrame:
    return _replace(df, string_columns(df), lambda c: F.nullif(F.btrim(c, F.lit(WHITESPACE)), F.lit("")))


def sentinel_to_null(df: DataFrame, sentinel: str = "?") -> DataFrame:
    return _replace(df, string_columns(df), lambda c: F.nullif(c, F.lit(sentinel)))


def drop_malformed(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def date_from(c: Column | str, pattern: str) -> Column:
    """Date under a pattern, null when the text does not fit it."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("date")


def parse_dates(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """`formats` maps column to 'iso' (leading ten characters count) or a datetime pattern."""

    def one(name: str, fmt: str) -> Column:
        if fmt == "iso":
            return date_from(F.substring(F.col(name), 1, 10), "yyyy-MM-dd")
        return date_from(name, fmt)

    require(df, formats)
    return df.withColumns({n: one(n, f) for n, f in formats.items()})


def lenient(c: Column | str, kind: str) -> Column:
    """Cast that gives null for unreadable text, also for the '1d' / '1f' forms Java reads."""
    v = as_col(c)
    return F.when(~F.lower(F.right(v, F.lit(1))).isin("d", "f"), v.try_cast(kind))


def lenient_numeric_cast(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    return _replace(df, columns, lambda c: lenient(c, kind))


def decimal_comma_to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the first comma is a decimal mark; text with a second one is unreadable."""
    return _replace(df, columns, lambda c: lenient(F.regexp_replace(c, "^([^,]*),", "$1."), "double"))


def flag_to_boolean(df: DataFrame, truths: Mapping[str, str]) -> DataFrame:
    """`truths` maps a column to the text that means true; null stays null."""
    require(df, truths)
    return df.withColumns({n: F.col(n) == F.lit(v) for n, v in truths.items()})


def recode_values(df: DataFrame, column: str, table: Mapping[str, str]) -> DataFrame:
    """Dictionary replacement; values outside the dictionary are kept."""
    return df.withColumn(column, F.coalesce(lookup(column, table, "string"), F.col(column)))


def fold_values(df: DataFrame, column: str, values: Sequence[str], into: str) -> DataFrame:
    return recode_values(df, column, dict.fromkeys(values, into))


def collapse_newlines(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.btrim(F.translate(F.col(column), "\n", " "), F.lit(WHITESPACE)))


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def quality_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(flags))


def strip_prefix(df: DataFrame, source: str, target: str, prefix: str) -> DataFrame:
    return df.withColumn(target, F.replace(F.col(source), F.lit(prefix), F.lit("")))


def project_columns(
    df: DataFrame,
    order: Sequence[str],
    rename: Mapping[str, str] | None = None,
    tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Contract projection: pick, rename and tag in one select."""
    rename = rename or {}
    picked = [F.col(c).alias(rename.get(c, c)) for c in order]
    return df.select(*picked, *[F.lit(v).alias(k) for k, v in (tags or {}).items()])


def fill_null_nan(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    fill = F.lit(value)
    return _replace(df, columns, lambda c: F.coalesce(F.nanvl(c.cast("double"), fill), fill))


def log1p_columns(df: DataFrame, columns: Sequence[str], clip_at_zero: bool = False) -> DataFrame:
    def one(c: Column) -> Column:
        v = F.when(c.isNotNull(), F.greatest(c, F.lit(0.0))) if clip_at_zero else c
        return F.log1p(v)

    return _replace(df, columns, one)


# Letters that lose their accent in column names.
ACCENTED, PLAIN = "ÁÉÍÓÚÜÑáéíóúüñ", "AEIOUUNaeiouun"


def sanitize_column_names(df: DataFrame) -> DataFrame:
    """ASCII column names; anything outside letters, digits and '_' becomes '_'."""
    table = str.maketrans(ACCENTED, PLAIN)
    names = []
    for name in df.columns:
        plain = name.translate(table)
        names.append("".join(ch if ch.isascii() and (ch.isalnum() or ch == "_") else "_" for ch in plain))
    return df.toDF(*names)
