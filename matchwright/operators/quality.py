"""How good a grouping is, and how far two groupings agree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright.session import stage


def as_array(df: DataFrame, features: str | Sequence[str]) -> DataFrame:
    """df with the point as array<double> `x`, from a vector, an array or a list of columns."""
    if not isinstance(features, str):
        return df.withColumn("x", F.array(*[F.col(c).cast("double") for c in features]))
    if df.schema[features].dataType.typeName() == "array":
        return df.withColumn("x", F.col(features).cast("array<double>"))
    return df.withColumn("x", vector_to_array(features))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    diff = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + v)


def group_means(points: DataFrame, label: str) -> DataFrame:
    """label, n, centre (array) and within (sum of squared deviations): partial sums per task."""
    v = array_to_vector(F.col("x"))
    stats = points.groupBy(label).agg(Summarizer.metrics("mean", "variance", "count").summary(v).alias("s"))
    variance = vector_to_array(F.col("s.variance"))
    return stats.select(
        label,
        F.col("s.count").alias("n"),
        vector_to_array(F.col("s.mean")).alias("centre"),
        (F.aggregate(variance, F.lit(0.0), lambda acc, v: acc + v) * (F.col("s.count") - 1)).alias("within"),
    )


def calinski_harabasz(df: DataFrame, features: str | Sequence[str], label: str) -> DataFrame:
    """Between over within dispersion, each per degree of freedom."""
    groups = group_means(as_array(df, features), label)
    dims = groups.select("n", F.posexplode("centre").alias("d", "m"))
    mean = F.sum(F.col("n") * F.col("m")).over(W.partitionBy("d")) / F.sum("n").over(W.partitionBy("d"))
    between = dims.select((F.col("n") * F.pow(F.col("m") - mean, 2)).alias("b")).agg(F.sum("b")).scalar()
    return groups.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("within").alias("w")
    ).select(
        # null where it is not defined: one group, or as many groups as points
        F.try_divide(F.try_divide(between, F.col("k") - 1), F.try_divide(F.col("w"), F.col("n") - F.col("k"))).alias("calinski_harabasz")
    )


def per_label(groups: DataFrame, label: str, *columns: str) -> Column:
    """The k rows of a table of groups as one scalar map label -> struct, to be read without a join.

    As many entries as there are groups, whatever the number of points.
    """
    entry = F.struct(F.col(label), F.struct(*columns))
    return groups.where(F.col(label).isNotNull()).agg(F.map_from_entries(F.collect_list(entry))).scalar()


def davies_bouldin(df: DataFrame, features: str | Sequence[str], label: str) -> DataFrame:
    """Mean over groups of the worst (spread_i + spread_j) / distance_ij."""
    points = as_array(df, features)
    centres = group_means(points, label).select(label, "centre")
    own = F.try_element_at(per_label(centres, label, "centre"), F.col(label))["centre"]
    placed = points.where(F.col(label).isNotNull()).select(label, "x", own.alias("centre"))
    spread = placed.groupBy(label).agg(
        F.avg(F.sqrt(squared_distance("x", "centre"))).alias("s"), F.first("centre").alias("centre")
    )
    spread = stage(spread, "group-spreads")
    pairs = spread.withColumn("o", F.explode(F.map_entries(per_label(spread, label, "s", "centre"))))
    pairs = pairs.where(F.col("o.key") != F.col(label))
    ratio = F.try_divide(F.col("s") + F.col("o.value.s"), F.sqrt(squared_distance("centre", "o.value.centre")))
    return pairs.groupBy(label).agg(F.max(ratio).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def squared_silhouette_points(df: DataFrame, features: str | Sequence[str], label: str, key: str) -> DataFrame:
    """key, label, s: silhouette of every point under squared Euclidean distance, in time linear in the points.

    The mean squared distance from x to a group of n points with sum S and sum of squares Q is
    (n |x|^2 - 2 x.S + Q) / n, so one aggregate per group is all a point needs to see.
    """
    points = as_array(df, features).select(key, label, "x").where(F.col(label).isNotNull())
    v = array_to_vector(F.col("x"))
    norm = F.aggregate("x", F.lit(0.0), lambda a, y: a + y * y)
    sums = points.groupBy(label).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        vector_to_array(Summarizer.sum(v)).alias("total"),
        F.sum(norm).alias("squares"),
    )

    def summed(g: Column) -> Column:
        dot = F.aggregate(F.zip_with("x", g["total"], lambda a, b: a * b), F.lit(0.0), lambda a, y: a + y)
        return F.greatest(g["n"] * norm - 2 * dot + g["squares"], F.lit(0.0))

    points = points.withColumn("groups", F.map_entries(per_label(sums, label, "n", "total", "squares")))
    seen = points.withColumn(
        "d", F.transform("groups", lambda e: F.struct(e["key"].alias("l"), e["value"]["n"].alias("n"), summed(e["value"]).alias("t")))
    )
    own = F.filter("d", lambda e: e["l"] == F.col(label))[0]
    near = F.array_min(F.transform(F.filter("d", lambda e: e["l"] != F.col(label)), lambda e: e["t"] / e["n"]))
    return _from_distances(seen.select(key, label, own["n"].alias("n"), own["t"].alias("t"), near.alias("b")), key, label)


def _from_distances(df: DataFrame, key: str, label: str) -> DataFrame:
    """Silhouettes from the own group's size n and summed distance t and the nearest other group's mean b."""
    a = F.col("t") / (F.col("n") - 1)
    top = F.greatest(a, F.col("b"))
    s = F.when((F.col("n") < 2) | F.col("b").isNull() | (top == 0), F.lit(0.0)).otherwise((F.col("b") - a) / top)
    return df.select(key, label, s.alias("s"))


def squared_silhouette(df: DataFrame, features: str | Sequence[str], label: str, key: str) -> DataFrame:
    return squared_silhouette_points(df, features, label, key).agg(F.avg("s").alias("silhouette"))


def _point_blocks(points: DataFrame, rows: int) -> DataFrame:
    """Points packed within their partition: keys, labels and one flat matrix per block."""
    types = {f.name: f.dataType.simpleString() for f in points.schema}

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), rows):
                part = pdf.iloc[lo : lo + rows]
                flat = np.concatenate(part["x"].to_numpy()) if len(part) else np.zeros(0)
                yield pd.DataFrame({"keys": [part["k"].to_numpy()], "labels": [part["l"].to_numpy()], "flat": [flat]})

    return points.mapInPandas(pack, f"keys array<{types['k']}>, labels array<{types['l']}>, flat array<double>")


def _grid(tasks: int) -> tuple[int, int]:
    """Lanes and rows of a grid of at least so many tasks. A partial sum leaves every lane, so lanes are the fewer."""
    across = max(1, int(np.sqrt(tasks) / 2))
    return across, -(-tasks // across)


def silhouette_points(
    df: DataFrame, features: str | Sequence[str], label: str, key: str, block: int = 2048, lanes: int | None = None
) -> DataFrame:
    """key, label, s: Euclidean silhouette of every point, over all points.

    The work is quadratic: every point needs its distance to every other. Blocks of points
    meet lane by lane, one product of two blocks at a time; what leaves a pair of blocks is
    one partial sum per point and group, so no pair of points is ever written. The tasks form a
    grid, rows of point blocks by lanes of other blocks: a block is sent to one row or one lane
    of it (about twice the root of their number), not to every task. For large
    tables `squared_silhouette_points` gives the squared-distance figure in linear time.
    """
    points = as_array(df, features).select(F.col(key).alias("k"), F.col(label).alias("l"), "x").where(F.col("l").isNotNull())
    spark = df.sparkSession
    lanes = lanes or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    across, down = _grid(lanes)
    blocks = stage(_point_blocks(points, block), "silhouette-blocks")
    place = F.xxhash64("flat")
    shards = blocks.withColumns({"lane": F.pmod(place, F.lit(across)).cast("int"), "row": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    shards = shards.select("row", "lane", F.col("labels").alias("other_labels"), F.col("flat").alias("other"))
    tiles = blocks.withColumns({"row": F.pmod(place, F.lit(down)).cast("int"), "lane": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    types = {f.name: f.dataType.simpleString() for f in points.schema}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x, y = (np.asarray(f).reshape(len(n), -1) for f, n in ((r.flat, r.labels), (r.other, r.other_labels)))
                names, codes = np.unique(np.asarray(r.other_labels), return_inverse=True)
                member = np.zeros((len(y), len(names)))
                member[np.arange(len(y)), codes] = 1.0
                total = np.empty((len(x), len(names)))
                for lo in range(0, len(x), 256):
                    p = x[lo : lo + 256]
                    square = (p * p).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * p @ y.T
                    total[lo : lo + 256] = np.sqrt(np.maximum(square, 0.0)) @ member
                yield pd.DataFrame(
                    {
                        "k": np.repeat(np.asarray(r.keys), len(names)), "l": np.repeat(np.asarray(r.labels), len(names)),
                        "other": np.tile(names, len(x)), "t": total.ravel(),
                    }
                )

    pairs = tiles.join(shards, ["row", "lane"]).select("keys", "labels", "flat", "other_labels", "other")
    partial = pairs.mapInPandas(measure, f"k {types['k']}, l {types['l']}, other {types['l']}, t double")
    sums = partial.groupBy("k", "l", "other").agg(F.sum("t").alias("t"))
    sizes = per_label(points.groupBy("l").agg(F.count(F.lit(1)).cast("double").alias("n")), "l", "n")
    sized = sums.withColumn("n", F.try_element_at(sizes, F.col("other"))["n"])
    own = F.col("other") == F.col("l")
    row = sized.groupBy("k", "l").agg(
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.col("t"))).alias("t"), F.min(F.when(~own, F.col("t") / F.col("n"))).alias("b")
    )
    return _from_distances(row, "k", "l").withColumnsRenamed({"k": key, "l": label})


def silhouette(df: DataFrame, features: str | Sequence[str], label: str, key: str) -> DataFrame:
    """Mean Euclidean silhouette over all points; quadratic, see `silhouette_points`."""
    return silhouette_points(df, features, label, key).agg(F.avg("s").alias("silhouette"))


# ---- agreement of two labelings -----------------------------------------------------------------


def _contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return cells.select(
        "n",
        F.sum("n").over(W.partitionBy("a")).alias("na"),
        F.sum("n").over(W.partitionBy("b")).alias("nb"),
        F.row_number().over(W.partitionBy("a").orderBy("b")).alias("first_a"),
        F.row_number().over(W.partitionBy("b").orderBy("a")).alias("first_b"),
    )


def nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information over the mean of the two entropies; 1 when both are constant."""
    cells = _contingency(df, a, b)
    total = cells.agg(F.sum("n")).scalar()

    def entropy(size: str, first: str) -> Column:
        p = F.col(size) / F.col("t")
        return -F.sum(F.when(F.col(first) == 1, p * F.ln(p)))

    sums = cells.withColumn("t", total).agg(
        F.sum(F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))).alias("mi"),
        entropy("na", "first_a").alias("ha"),
        entropy("nb", "first_b").alias("hb"),
    )
    mean = (F.col("ha") + F.col("hb")) / 2
    return sums.select(F.when(mean == 0, F.lit(1.0)).otherwise(F.col("mi") / mean).alias("nmi"))


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from the contingency table."""

    def pairs(c: str) -> Column:
        return F.col(c) * (F.col(c) - 1) / 2

    sums = _contingency(df, a, b).agg(
        F.sum(pairs("n")).alias("ij"),
        F.sum(F.when(F.col("first_a") == 1, pairs("na"))).alias("pa"),
        F.sum(F.when(F.col("first_b") == 1, pairs("nb"))).alias("pb"),
        F.sum("n").alias("t"),
    )
    expected = F.col("pa") * F.col("pb") / pairs("t")
    best = (F.col("pa") + F.col("pb")) / 2
    value = F.when(best == expected, F.lit(1.0)).otherwise((F.col("ij") - expected) / (best - expected))
    return sums.select(value.alias("ari"))


def labeling(df: DataFrame, who: str = "DNI_PRESTADOR", label: str = "cluster_id", name: str = "cluster") -> DataFrame:
    missing = [c for c in (who, label) if c not in df.columns]
    if missing:
        raise ValueError(f"labeling lacks {missing}; it has {df.columns}")
    return df.select(who, F.col(label).alias(name))


def compare_labelings(ours: DataFrame, other: DataFrame, who: str = "DNI_PRESTADOR") -> dict[str, DataFrame]:
    """Distributions of both, size of the intersection, agreement and confusion counts."""
    from matchwright.operators.aggregates import confusion_counts, value_distribution

    a, b = labeling(ours, who, name="cluster_ours"), labeling(other, who, name="cluster_alt")
    both = a.join(b, who, "inner")
    if both.isEmpty():
        raise ValueError(f"the two labelings have no {who} in common; are the keys written alike?")
    agreement = (
        both.agg(F.count(F.lit(1)).alias("n_common"))
        .withColumn("nmi", nmi(both, "cluster_ours", "cluster_alt").scalar())
        .withColumn("ari", ari(both, "cluster_ours", "cluster_alt").scalar())
    )
    return {
        "distribution_ours": value_distribution(a, "cluster_ours"),
        "distribution_alt": value_distribution(b, "cluster_alt"),
        "agreement": agreement,
        "confusion": confusion_counts(both, "cluster_ours", "cluster_alt"),
    }
