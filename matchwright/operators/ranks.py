"""Exact order statistics that never sort a whole population in one task.

Every operator here works on a histogram (one row per distinct value), splits it into value
bands with a monotone function of the value and crowded bands again at their quantiles, and
carries totals from band to band. Only the band totals meet in one window, and their number
has a fixed bound (`BAND_LIMIT` times the parts of a crowded band, per group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# ln|v| of a double lies within (-746, 710); 256 bands per unit keep each band 0.4 % wide.
_BANDS_PER_UNIT = 256
_BAND_SHIFT = 200_000
BAND_LIMIT = 2 * (_BAND_SHIFT + 711 * _BANDS_PER_UNIT) + 1


def value_band(v: Column) -> Column:
    """Order-preserving integer band of a double: v <= w implies band(v) <= band(w)."""
    end = _BAND_SHIFT + 711 * _BANDS_PER_UNIT  # the infinities have bands of their own
    size = F.when(F.abs(v) == float("inf"), F.lit(end)).otherwise(F.floor(F.ln(F.abs(v)) * _BANDS_PER_UNIT) + _BAND_SHIFT)
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, size).otherwise(-size).cast("long")


def histogram(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """groups..., v (double, not null, not NaN), c (rows). Partial counts cross the shuffle."""
    v = F.col(value).cast("double")
    return (
        df.select(*groups, v.alias("v"))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
        # -0.0 and 0.0 are one value
        .withColumn("v", F.when(F.col("v") == 0, F.lit(0.0)).otherwise(F.col("v")))
        .groupBy(*groups, "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null, keeping the left copy of the keys."""
    r = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(r, cond, how).drop(*[f"__{k}" for k in keys])


def _between(lo: Column, hi: Column, part: Column) -> Column:
    """Linear interpolation that stays defined at the infinities."""
    return F.when((part == 0) | (lo == hi), lo).otherwise(lo + (hi - lo) * part)


def banded(hist: DataFrame, groups: Sequence[str], most: int = 200_000, parts: int = 256) -> DataFrame:
    """The histogram with `band` and `sub`, which together order like the value.

    Values that crowd into one band (time stamps, ids, scores close to 1) would meet in one
    task there. A band of more than `most` distinct values is cut again at its own
    approximate quantiles into `parts` pieces of about equal size.
    """
    g = list(groups)
    base = hist.withColumn("band", value_band(F.col("v")))
    crowded = base.groupBy(*g, "band").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).drop("__n")
    probs = [i / parts for i in range(1, parts)]
    inner = _null_safe(base, crowded, [*g, "band"], "left_semi")
    cuts = inner.groupBy(*g, "band").agg(F.percentile_approx("v", probs, 16 * parts).alias("__cuts"))
    # one entry per `most` distinct values at most, mostly none: looked up without joining the histogram
    where = F.struct(*g, "band")
    known = cuts.agg(F.map_from_entries(F.collect_list(F.struct(where.alias("k"), F.col("__cuts").alias("c"))))).scalar()
    below = F.size(F.filter("__cuts", lambda c: c < F.col("v")))
    placed = base.withColumn("__cuts", F.try_element_at(known, where))
    return placed.withColumn("sub", F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(below)).drop("__cuts")


def running_totals(hist: DataFrame, groups: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Per measure m: `m`, `m_before` (sum over smaller values), `m_all` (sum over the group)."""
    g = list(groups)
    base = banded(hist, g).withColumns(dict(measures))
    bands = base.groupBy(*g, "band", "sub").agg(*[F.sum(m).alias(m) for m in measures])
    by_band = W.partitionBy(*g).orderBy("band", "sub")
    earlier = by_band.rowsBetween(W.unboundedPreceding, -1)
    offsets = bands.select(
        *g,
        "band",
        "sub",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_offset") for m in measures],
        *[F.sum(m).over(W.partitionBy(*g)).alias(f"{m}_all") for m in measures],
    )
    inside = W.partitionBy(*g, "band", "sub").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    joined = _null_safe(base, offsets, [*g, "band", "sub"], "inner")
    before = {
        f"{m}_before": F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"{m}_offset") for m in measures
    }
    return joined.withColumns(before).drop("band", "sub", *[f"{m}_offset" for m in measures])


def exact_percentiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolated percentiles per group; nulls and NaN are left out.

    Only the bands that hold a wanted rank are sorted; all others are just counted.
    """
    g = list(groups)
    hist = banded(histogram(df, g, value), g)
    bands = hist.groupBy(*g, "band", "sub").agg(F.sum("c").alias("c"))
    order = W.partitionBy(*g).orderBy("band", "sub").rowsBetween(W.unboundedPreceding, -1)
    located = bands.select(
        *g,
        "band",
        "sub",
        F.col("c").alias("band_rows"),
        F.coalesce(F.sum("c").over(order), F.lit(0)).alias("offset"),
        F.sum("c").over(W.partitionBy(*g)).alias("n"),
    )

    def ranks(p: float) -> tuple[Column, Column, Column]:
        pos = F.lit(float(p)) * (F.col("n") - 1)
        return F.floor(pos), F.ceil(pos), pos - F.floor(pos)

    def holds(rank: Column, start: str, size: str) -> Column:
        return (rank >= F.col(start)) & (rank < F.col(start) + F.col(size))

    wanted = F.lit(False)
    for p in probs.values():
        lo, hi, _ = ranks(p)
        wanted = wanted | holds(lo, "offset", "band_rows") | holds(hi, "offset", "band_rows")
    needed = located.where(wanted).drop("band_rows")
    inside = W.partitionBy(*g, "band", "sub").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    ranked = _null_safe(hist, needed, [*g, "band", "sub"], "inner").withColumn(
        "start", F.coalesce(F.sum("c").over(inside), F.lit(0)) + F.col("offset")
    )
    picks = []
    for name, p in probs.items():
        lo, hi, part = ranks(p)
        picks += [
            F.max(F.when(holds(lo, "start", "c"), F.col("v"))).alias(f"{name}__lo"),
            F.max(F.when(holds(hi, "start", "c"), F.col("v"))).alias(f"{name}__hi"),
            F.max(part).alias(f"{name}__part"),
        ]
    ends = ranked.groupBy(*g).agg(*picks)
    return ends.select(
        *g,
        *[
            _between(F.col(f"{n}__lo"), F.col(f"{n}__hi"), F.col(f"{n}__part")).alias(n)
            for n in probs
        ],
    )


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name="feature", value="value") -> DataFrame:
    """Wide to long as doubles."""
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return cast.unpivot(list(ids), list(columns), name, value)


def column_percentiles(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """groups..., feature, one column per probability."""
    return exact_percentiles(melt(df, groups, columns), [*groups, "feature"], "value", probs)


def gini(df: DataFrame, value: str, groups: Sequence[str] = (), name: str = "gini") -> DataFrame:
    """Gini coefficient of non-negative loads; negatives count as 0, no rows give NaN.

    With ties the rank sum of c equal values after P smaller ones is c*P + c*(c+1)/2, so the
    histogram is enough.
    """
    g = list(groups)
    v = F.greatest(F.col(value).cast("double"), F.lit(0.0))
    hist = histogram(df.withColumn("__load", F.when(F.col(value).isNotNull(), v)), g, "__load")
    run = running_totals(hist, g, {"c": F.col("c")})
    rank_sum = F.col("c") * F.col("c_before") + F.col("c") * (F.col("c") + 1) / 2
    sums = run.groupBy(*g).agg(
        F.sum(F.col("v") * rank_sum).alias("r"),
        F.sum(F.col("v") * F.col("c")).alias("s"),
        F.max("c_all").cast("double").alias("n"),
    )
    value_of = (
        F.when(F.col("n").isNull(), F.lit(float("nan")))
        .when(F.col("s") == 0, F.lit(0.0))
        .otherwise(2 * F.col("r") / (F.col("n") * F.col("s")) - (F.col("n") + 1) / F.col("n"))
    )
    return sums.select(*g, value_of.alias(name))


def lorenz_curve(df: DataFrame, value: str) -> DataFrame:
    """Break points of the Lorenz curve, one per distinct load (straight in between)."""
    hist = histogram(df, [], value)
    run = running_totals(hist, [], {"c": F.col("c"), "load": F.col("v") * F.col("c")})
    return run.select(
        F.col("v").alias("load_value"),
        F.col("c").alias("n_members"),
        ((F.col("c_before") + F.col("c")) / F.col("c_all")).alias("pop_share"),
        ((F.col("load_before") + F.col("load")) / F.col("load_all")).alias("cum_share"),
        F.col("c_before").alias("members_before"),
        F.col("load_before"),
        F.col("c_all").alias("members_all"),
        F.col("load_all"),
    )


def lorenz_summary(df: DataFrame, value: str, top: float = 0.10) -> DataFrame:
    """Trapezoid Gini over the member points 1..n and the load share above the top cut.

    A run of c equal loads is a straight piece of the curve, so its trapezoids add up to its
    width times the mean of its ends; the piece that leads into a run starts where the last
    one stopped. The first piece starts at the first member, not at the origin.
    """
    points = lorenz_curve(df, value)
    start_pop = F.when(F.col("members_before") == 0, F.lit(1) / F.col("members_all")).otherwise(
        F.col("members_before") / F.col("members_all")
    )
    start_load = F.when(F.col("members_before") == 0, F.col("load_value") / F.col("load_all")).otherwise(
        F.col("load_before") / F.col("load_all")
    )
    area = (F.col("pop_share") - start_pop) * (F.col("cum_share") + start_load) / 2
    cut = F.floor(F.lit(1.0 - top) * F.col("members_all"))  # zero-based member index
    inside = (cut >= F.col("members_before")) & (cut < F.col("members_before") + F.col("n_members"))
    at_cut = (F.col("load_before") + F.col("load_value") * (cut + 1 - F.col("members_before"))) / F.col("load_all")
    return points.agg(
        F.max("members_all").alias("n_members"),
        F.max("load_all").alias("total_load"),
        (1 - 2 * F.sum(area)).alias("gini"),
        (1 - F.max(F.when(inside, at_cut))).alias("top_share"),
    )


def spread_row_number(
    df: DataFrame, groups: Sequence[str], unique_key: Sequence[str], name: str, buckets: int = 1024
) -> DataFrame:
    """Dense numbering 0..n-1 inside each group, in an arbitrary but repeatable order.

    Rows are numbered inside hash buckets of their key and shifted by the sizes of the
    buckets before, so that a group holding most of the table is still spread over tasks.
    """
    g = list(groups)
    cut = df.withColumn("__b", F.pmod(F.xxhash64(*unique_key), F.lit(buckets)).cast("int"))
    sizes = cut.groupBy(*g, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*g).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*g, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = W.partitionBy(*g, "__b").orderBy(*unique_key)
    return (
        _null_safe(cut, offsets, [*g, "__b"], "inner")
        .withColumn(name, (F.row_number().over(inside) - 1 + F.col("__o")).cast("long"))
        .drop("__b", "__o")
    )
