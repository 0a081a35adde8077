"""Text sources: format inference, all-string reads, tagged unions and encoding repair."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.functions.cleaning import string_columns

# Delimiters that are considered, in order of preference on equal evidence.
DELIMITERS = ("\t", "|", "~", ";", ",")
_NAMES = {"\t": "tab", "|": "pipe", "~": "tilde", ";": "semicolon", ",": "comma"}


def _unquoted(text: Column) -> Column:
    """The line without what stands in double quotes; a quote left open hides the rest of the line."""
    return F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), '"[^"]*$', "")


def _count(text: Column, delimiter: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(delimiter), F.lit("")))).cast("double")


def text_evidence(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Per file below the path: its first line, lines, validity as UTF-8, and sums of every delimiter's counts per line.

    One pass over the text. The first line is the least row of the file's first block. With
    multi_line, records take the place of lines: what stands in quotes may hold line breaks.
    """
    if multi_line:
        found = records(spark, path, "".join(DELIMITERS))
        lines = found.select(F.col("record").cast("string").alias("value"), "file", F.when(F.col("first"), F.lit(0)).alias("head"))
    else:
        lines = spark.read.text(path).select(
            "value", F.col("_metadata.file_path").alias("file"),
            F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("head"),
        )
    plain = _unquoted(F.col("value"))
    counted = lines.select("*", *[_count(plain, d).alias(_NAMES[d]) for d in DELIMITERS])
    filled = F.length(F.btrim("value")) > 0
    sums = []
    for name in _NAMES.values():
        sums += [F.sum(F.when(filled, F.col(name))).alias(f"{name}_sum"), F.sum(F.when(filled, F.col(name) * F.col(name))).alias(f"{name}_sq")]
    return counted.groupBy("file").agg(
        F.min_by("value", "head").alias("header"), F.count_if(filled).alias("lines"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"), *sums
    )


def delimiter_evidence(files: DataFrame) -> DataFrame:
    """delimiter, mean and variance of its count per non-blank line, whether every file's first line has it, all text valid UTF-8."""
    headed = {n: F.bool_and(_count(_unquoted(F.col("header")), d) > 0).alias(f"{n}_head") for d, n in _NAMES.items()}
    stats = files.agg(
        F.sum("lines").alias("n"), F.bool_and("utf8").alias("utf8"), *headed.values(),
        *[F.sum(f"{n}_{k}").alias(f"{n}_{k}") for n in _NAMES.values() for k in ("sum", "sq")],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("delimiter"),
                (F.col(f"{n}_sum") / F.col("n")).alias("mean_count"),
                (F.col(f"{n}_sq") / F.col("n") - F.pow(F.col(f"{n}_sum") / F.col("n"), 2)).alias("variance"),
                F.coalesce(F.col(f"{n}_head"), F.lit(False)).alias("in_header"),
                F.col("utf8").alias("utf8"),
                F.lit(i).alias("preference"),
            )
            for i, n in enumerate(_NAMES.values())
        ]
    )
    return stats.where(F.col("n") > 0).select(F.explode(rows).alias("r")).select("r.*")


def _best_format(files: DataFrame) -> DataFrame:
    best = delimiter_evidence(files).where("in_header").orderBy(F.desc("mean_count"), "variance", "preference").limit(1)
    charset = F.when(F.col("utf8"), F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1"))
    return best.select("delimiter", charset.alias("charset"))


def infer_text_format(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row: delimiter and charset of the text files below a path (no row if no delimiter fits).

    Only delimiters that occur in every file's first line count, outside quotes; of those the
    highest mean count per line wins, then the lowest variance. Text that is not valid UTF-8
    is taken as ISO-8859-1. With multi_line, counts are per record.
    """
    return _best_format(text_evidence(spark, path, multi_line))


def read_delimited_strings(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    charset: str | None = None,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header; every column a string, damaged rows kept with nulls.

    Fields may be quoted, with doubled quotes inside. With multi_line, quoted fields may hold
    line breaks; such files are split like any other (`records`).
    `columns` are the expected names in order; without them the files must agree on their
    first line. A file with another header is an error, as columns would be mixed up.
    """
    files = text_evidence(spark, path, multi_line)
    if delimiter is None or charset is None:
        found = _best_format(files).first()
        names = {v: k for k, v in _NAMES.items()}
        delimiter = delimiter or (names[found["delimiter"]] if found else ",")
        charset = charset or (found["charset"] if found else "UTF-8")
    head = F.translate(F.regexp_replace("header", "^\ufeff", ""), '"\r', "")
    heads = files.where(F.col("header").isNotNull()).groupBy(F.encode(head, "UTF-8").alias("h")).agg(F.min(head).alias("head"), F.min("file").alias("file"))
    if columns is not None:
        wrong = heads.where(F.col("head") != F.lit(delimiter.join(columns))).limit(1).collect()
        if wrong:
            raise ValueError(f"{wrong[0]['file']} has the columns {wrong[0]['head'].split(delimiter)}, expected {list(columns)}")
    else:
        two = heads.orderBy("file").limit(2).collect()
        if len(two) > 1:
            raise ValueError(f"files differ in their columns: {two[0]['file']} has {two[0]['head']!r}, {two[1]['file']} has {two[1]['head']!r}")
    if multi_line:
        if columns is None:
            row = heads.limit(1).collect()
            columns = row[0]["head"].split(delimiter) if row else []
        return _parse_records(records(spark, path, delimiter), columns, delimiter, charset)
    reader = spark.read.option("sep", delimiter).option("encoding", charset).option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("quote", '"').option("escape", '"').option("inferSchema", False)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def _parse_records(found: DataFrame, columns: Sequence[str], delimiter: str, charset: str) -> DataFrame:
    """Records to string columns; the first record of each file is its header."""
    if not columns:
        return found.select().limit(0)
    names = [f"c{i}" for i in range(len(columns))]
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    body = found.where(~F.col("first") & (F.octet_length("record") > 0))
    parsed = F.from_csv(F.decode("record", charset), ", ".join(f"{n} string" for n in names), options)
    return body.select(parsed.alias("r")).select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns)])


# ---- records that go over line breaks -----------------------------------------------------------


def _ends_inside(line: bytes, inside: bool, opening: re.Pattern[bytes]) -> bool:
    """Whether the end of a line lies in a quoted field, given whether its start does.

    A quote opens a field only where a field begins; inside, two quotes stand for one.
    """
    at = 0
    if not inside:
        if not line.startswith(b'"'):
            found = opening.search(line)
            if found is None:
                return False
            at = found.end()
        else:
            at = 1
    while True:
        quote = line.find(b'"', at)
        if quote < 0:
            return True
        if line[quote + 1 : quote + 2] == b'"':
            at = quote + 2
            continue
        found = opening.search(line, quote + 1)
        if found is None:
            return False
        at = found.end()


def records(spark: SparkSession, path: str, separators: str) -> DataFrame:
    """file, first (of its file) and record (bytes, without the line end) of the delimited text below a path.

    Files are split as usual, also inside quoted fields. A first pass works out for each
    split how it ends if it begins inside a quoted field and if it does not; only lines with
    quotes are looked at. Chaining these per file tells how each split does begin, and a
    second pass cuts every split into records from there. Only the pieces of records that go
    over a split's end are then put together, two a split.

    `separators` are the characters after which a quoted field may begin.
    """
    opening = re.compile(b"[" + re.escape(separators.encode()) + b']"')
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line")
    )

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[bool, bool]] = {}
        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                out, within = found.get((file, start), (False, True))
                found[file, start] = _ends_inside(line, out, opening), _ends_inside(line, within, opening)
        rows = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()], [v[1] for v in found.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], ["file", "start", "out", "within"])

    quoted = lines.where(F.contains(F.col("line"), F.lit(b'"')))
    splits = quoted.mapInArrow(ends, "file string, start long, out boolean, within boolean")
    # two flags a split come to the driver; each split begins as the one before it ends
    ended: dict[str, list[tuple[int, bool]]] = {}
    for file, start, out, within in splits.orderBy("file", "start").collect():
        before = ended.setdefault(file, [(-1, False)])
        before.append((start, within if before[-1][1] else out))
    known = spark.sparkContext.broadcast(ended)

    def begins_inside(file: str, start: int) -> bool:
        """The state at the end of the last split with quotes before this one."""
        before = known.value.get(file, [(-1, False)])
        return before[bisect_left(before, (start,)) - 1][1] if start > 0 else False

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        out: list[tuple] = []
        held: list[bytes] = []
        inside = first = began = False

        def piece(whole: bool) -> tuple:
            text = b"\n".join(held)
            return (*here, first and began, whole and began, began, text[:-1] if whole and text.endswith(b"\r") else text)

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
            columns = list(zip(*out)) or [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "first", "whole", "began", "record"])

        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != here:
                    if held:
                        out.append(piece(False))
                    inside = begins_inside(file, start)
                    here, held, first, began = (file, start), [], start == 0, not inside
                held.append(line)
                inside = _ends_inside(line, inside, opening) if b'"' in line else inside
                if not inside:
                    out.append(piece(True))
                    held, first, began = [], first and not began, True
            if out:
                yield batch_of()
                out = []
        if held:
            out.append(piece(False))
            yield batch_of()

    cuts = lines.mapInArrow(cut, "file string, start long, first boolean, whole boolean, began boolean, record binary")
    whole = cuts.where("whole").select("file", "first", "record")
    # what is left: beginnings of records, and later pieces of them, in order of their splits
    pieces = cuts.where("not whole").withColumn("n", F.expr("sum(int(began)) over (partition by file order by start, began)"))
    joined = pieces.groupBy("file", "n").agg(F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "record"))).alias("p"))
    text = F.aggregate("p", F.lit(None).cast("binary"), lambda a, x: F.when(a.isNull(), x.record).otherwise(F.concat(a, F.lit(b"\n"), x.record)))
    ended = F.when(F.endswith(text, F.lit(b"\r")), F.substring(text, F.lit(1), F.octet_length(text) - 1)).otherwise(text)
    return whole.unionByName(joined.select("file", "first", ended.alias("record")))


def parse_text_table(raw: DataFrame, columns: Sequence[str], delimiter: str = "\t") -> DataFrame:
    """Single `value` column to named columns; header lines go, parsed frames pass through."""
    if "value" not in raw.columns:
        return raw
    literal = F.lit("\\Q" + delimiter + "\\E")
    parts = F.split(F.col("value"), literal, -1)
    body = raw.where(~F.startswith(F.col("value"), F.lit(columns[0])))
    return body.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def repair_encoding(df: DataFrame, charset: str = "ISO-8859-1") -> DataFrame:
    """Read the bytes of every string column again under a single-byte charset."""
    return df.withColumns({c: F.decode(F.col(c).cast("binary"), charset) for c in string_columns(df)})


def union_tagged_sources(parts: Mapping[str, DataFrame], tag: str = "_RED_ORIGEN") -> DataFrame:
    """Stack parts with differing columns; the tag says which part a row came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def sql_over_file(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """SQL straight over a parquet path; a column list reaches the scan."""
    picked = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    return spark.sql(f"SELECT {picked} FROM parquet.`{path}`")


def point_lookup(df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    """Rows of one key; filter and projection reach a parquet scan."""
    return df.where(F.col(key) == F.lit(value)).select(*columns)


def sample_rows(df: DataFrame, key: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Repeatable sample: rows whose keyed hash falls below the share.

    The hash is the first eight hex digits of md5 over seed and key, so that other engines
    draw the same rows.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(drawn < F.lit(int(share * (1 << 32))))
