"""Aggregations with the null, tie and emptiness rules of the source data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright.functions.expr import as_col
from matchwright.operators.ranks import exact_percentiles


def where_(c: Column | str, p: Column | None) -> Column:
    return as_col(c) if p is None else F.when(p, as_col(c))


def with_scalars(df: DataFrame, one_row: DataFrame, make: Callable[[Column], Mapping[str, Column]]) -> DataFrame:
    """Columns computed with the values of a one-row table.

    The row is one scalar subquery that is named once, however many columns use it.
    """
    packed = one_row.select(F.struct("*").alias("s")).scalar()
    named = df.withColumn("__row", packed)
    return named.withColumns(dict(make(F.col("__row")))).drop("__row")


def count_where(p: Column) -> Column:
    """Rows for which the predicate is true; null predicates do not count."""
    return F.count(F.when(p, F.lit(1)))


def sum0(c: Column | str) -> Column:
    """Sum that is 0 over nothing."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def distinct_with_null(c: Column | str, p: Column | None = None) -> Column:
    """Number of distinct values where null is a value of its own."""
    v = as_col(c)
    missing = v.isNull() if p is None else (p & v.isNull())
    return F.count_distinct(where_(v, p)) + F.coalesce(F.max(missing.cast("int")), F.lit(0))


def distinct_counts(df: DataFrame, groups: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Number of distinct values per group, null a value of its own: output name -> column (text, whole number, date or flag).

    Every (group, value) of a column is one narrow row. Counted beside other aggregates, each of
    these rows would carry the buffers of all of them; made distinct for all columns at once,
    the values of a task would not fit in its memory.
    """
    g, places = list(groups), {name: i for i, name in enumerate(columns)}
    each = [df.select(*g, F.col(c).alias("__val")).distinct().select(*g, F.lit(places[name]).alias("__col")) for name, c in columns.items()]
    long = reduce(DataFrame.unionByName, each)
    return long.groupBy(*g).agg(*[count_where(F.col("__col") == at).alias(name) for name, at in places.items()])


def with_counts(df: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Adds the counts of the same key, a null key included; 0 where there are none."""
    names = [c for c in counts.columns if c != key]
    other = counts.withColumnRenamed(key, "__key")
    joined = df.join(other, df[key].eqNullSafe(F.col("__key")), "left").drop("__key")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in names})


def any_true(c: Column) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def share_true(c: Column, weight: Column | str | None = None) -> Column:
    """Mean of a flag; null flags are left out."""
    if weight is None:
        return F.avg(c.cast("double"))
    w = as_col(weight)
    return F.sum(F.when(c, w).when(~c, w * 0)) / F.sum(F.when(c.isNotNull(), w))


def _first_of(groups: Sequence[str], order: Sequence[Column], df: DataFrame) -> DataFrame:
    """One row per group. The rank filter is pushed below the shuffle as a group limit."""
    ranked = df.withColumn("__rn", F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def mode_of(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    name: str,
    keep_null: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """Most frequent value per group; ties go to the smallest value, null last."""
    g = list(groups)
    src = df if keep_null else df.where(F.col(value).isNotNull())
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = src.groupBy(*g, value).agg(n.alias("__n"))
    best = _first_of(g, [F.desc("__n"), F.asc_nulls_last(value)], counts)
    return best.select(*g, F.col(value).alias(name))


def modes_of(df: DataFrame, groups: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Modes of several string columns in one pass: column -> output name."""
    g = list(groups)
    long = df.select(*g, *columns).unpivot(g, list(columns), "__col", "__val")
    counts = long.groupBy(*g, "__col", "__val").agg(F.count(F.lit(1)).alias("__n"))
    best = _first_of([*g, "__col"], [F.desc("__n"), F.asc_nulls_last("__val")], counts)
    picks = [F.max(F.when(F.col("__col") == c, F.col("__val"))).alias(name) for c, name in columns.items()]
    return best.groupBy(*g).agg(*picks)


def representative_row(df: DataFrame, groups: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One real attribute combination per group: the smallest, nulls last.

    Attributes repeat on most rows of a group, so distinct combinations are formed first.
    """
    combos = df.select(*groups, *attributes).distinct()
    return _first_of(groups, [F.asc_nulls_last(a) for a in attributes], combos)


def top_group_with_ratio(
    df: DataFrame, key: str, group: Sequence[str], item: str, total: Column | None = None
) -> DataFrame:
    """Largest sub-group per key by distinct items, with its share of all distinct items."""
    per_group = df.groupBy(key, *group).agg(distinct_with_null(item).alias("n_items"))
    best = _first_of([key], [F.desc("n_items"), *[F.asc_nulls_last(g) for g in group]], per_group)
    overall = df.groupBy(key).agg(distinct_with_null(item).alias("n_total"))
    share = F.when(F.col("n_total") > 0, F.col("n_items") / F.col("n_total"))
    return best.join(overall, key, "left").withColumn("ratio", share)


def median_of(df: DataFrame, groups: Sequence[str], value: str, name: str) -> DataFrame:
    return exact_percentiles(df, groups, value, {name: 0.5})


def quantiles_of(df: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    return exact_percentiles(df, groups, value, probs)


def describe_values(df: DataFrame, value: str, over: Sequence[float] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max and how many lie above each threshold."""
    v = F.col(value).cast("double")
    basic = df.agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        *[count_where(v > t).alias(f"n_over_{i}") for i, t in enumerate(over)],
    )
    quarts = exact_percentiles(df, [], value, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return with_scalars(basic, quarts, lambda q: {p: q[p] for p in ("p25", "p50", "p75")})


def fixed_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the last bin is closed."""
    v = F.col(value).cast("double")
    known = df.where(v.isNotNull()).select(v.alias("v"))
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s"))
    bounded = known.withColumn("s", span.scalar())
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    raw = F.when(width > 0, F.floor((F.col("v") - F.col("s.lo")) / width)).otherwise(F.lit(0))
    return (
        bounded.withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("long"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    )


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """value, n, share of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_k_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(k)


def _fold(counts: DataFrame, column: str, keep: Column, others: str) -> DataFrame:
    folded = F.when(keep, F.col(column)).otherwise(F.lit(others))
    return counts.groupBy(folded.alias(column)).agg(F.sum("n").alias("n"))


def top_n_with_others(df: DataFrame, column: str, n: int, others: str = "Otros") -> DataFrame:
    """The n largest categories; all the rest as one. A null category is a category."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(n)
    rest = counts.agg(F.sum("n")).scalar() - top.agg(F.sum("n")).scalar()
    tail = top.limit(1).select(F.lit(others).alias(column), rest.alias("n")).where(F.col("n") > 0)
    return top.unionByName(tail)


def fold_below_share(df: DataFrame, column: str, share: float, others: str = "Otros") -> DataFrame:
    """Categories below a share of all rows become one; a null category is a category."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return _fold(counts, column, F.col("n") / total >= share, others)


def cumulative_share(df: DataFrame, column: str, k: int) -> DataFrame:
    """Top k groups with their percentage of all rows and the running percentage."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    top = counts.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(k)
    order = W.partitionBy(F.lit(1)).orderBy(F.desc("n"), F.asc_nulls_last(column))
    pct = top.select(
        F.row_number().over(order).alias("position"), column, "n", F.round(F.col("n") / total * 100, 2).alias("pct")
    )
    run = W.partitionBy(F.lit(1)).orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    return pct.withColumn("pct_running", F.round(F.sum("pct").over(run), 2))


def confusion_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Contingency table with one column per label of `columns`; missing pairs are 0."""
    return df.groupBy(rows).pivot(columns).agg(F.count(F.lit(1))).fillna(0)


def distinct_key_count(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Distinct composite keys; a null member is part of the key."""
    return df.select(*key).distinct().agg(F.count(F.lit(1)).alias(name))


# ---- column-wise imputation and encoding ---------------------------------------------------


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0.0, subset=list(columns))


def _fill_from(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls from a one-row table, read once as a scalar subquery."""
    return with_scalars(df, stats, lambda s: {c: F.coalesce(F.col(c), s[c]) for c in columns})


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    from matchwright.operators.ranks import column_percentiles

    long = column_percentiles(df, [], columns, {"m": 0.5})
    wide = long.agg(*[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(c) for c in columns])
    return _fill_from(df, wide, columns)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _fill_from(df, df.agg(*[F.avg(c).alias(c) for c in columns]), columns)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = df.select(*columns).unpivot([], list(columns), "__col", "__val").where(F.col("__val").isNotNull())
    counts = long.groupBy("__col", "__val").agg(F.count(F.lit(1)).alias("__n"))
    best = _first_of(["__col"], [F.desc("__n"), F.asc("__val")], counts)
    wide = best.agg(*[F.max(F.when(F.col("__col") == c, F.col("__val"))).alias(c) for c in columns])
    return _fill_from(df, wide, columns)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with the sample deviation; missing values take the mean, constants give 0."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in columns})
    filled = impute_mean(typed, columns)
    # filling with the mean leaves the mean as it is
    stats = filled.agg(
        *[F.avg(c).alias(f"{c}__m") for c in columns], *[F.stddev_samp(c).alias(f"{c}__s") for c in columns]
    )

    def scores(s):
        known = {c: s[f"{c}__s"] for c in columns}
        return {
            c: F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise((F.col(c) - s[f"{c}__m"]) / sd)
            for c, sd in known.items()
        }

    return with_scalars(filled, stats, scores)


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    """Columns whose share of nulls is above the threshold (one pass, one row to the driver)."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.1) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def one_hot(df: DataFrame, levels: Mapping[str, Sequence]) -> DataFrame:
    """A 0/1 column per level the caller names, none dropped; null and other values set no level."""
    out = df
    for c, values in levels.items():
        out = out.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in values})
    return out.drop(*levels)


def one_hot_vector(df: DataFrame, columns: Sequence[str], output: str = "encoded") -> DataFrame:
    """All levels of the columns as one sparse 0/1 vector, none dropped, however many there are; null sets no level."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    index, hot = [f"{c}__index" for c in columns], [f"{c}__hot" for c in columns]
    steps = [
        # nulls get the index after the last level, which the encoder's last slot takes and the slice leaves out
        StringIndexer(inputCols=list(columns), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=hot, outputCol=output),
    ]
    return Pipeline(stages=steps).fit(df).transform(df).drop(*index, *hot)
