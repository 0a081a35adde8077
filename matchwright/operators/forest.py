"""Outlier quarantine by an isolation forest (Liu, Ting and Zhou, 2008).

Trees are grown side by side, one task group per tree, each from at most `PSI` sampled rows.
The grown forest has at most trees x 2 x PSI nodes, so it fits in every executor; the table
is then scored in one pass over its partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.operators.ranks import exact_percentiles

TREES, PSI = 100, 256
NODE_SCHEMA = "tree int, node int, feature int, cut double, low int, high int, depth double"


def mean_path(n: float) -> float:
    """Average depth of an unsuccessful search in a binary tree of n keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Node rows of one tree; a leaf has feature -1 and the path length it stands for."""
    nodes: list[list] = [[0, -1, 0.0, -1, -1, 0.0]]
    todo = [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        spans = np.ptp(rows, axis=0) if len(rows) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spans > 0)
        if depth >= max_depth or len(rows) <= 1 or not len(usable):
            nodes[at][5] = depth + mean_path(len(rows))
            continue
        feature = int(rng.choice(usable))
        values = rows[:, feature]
        cut = float(rng.uniform(values.min(), values.max()))
        below = values <= cut
        low, high = len(nodes), len(nodes) + 1
        nodes += [[low, -1, 0.0, -1, -1, 0.0], [high, -1, 0.0, -1, -1, 0.0]]
        nodes[at][1:5] = [feature, cut, low, high]
        todo += [(low, rows[below], depth + 1), (high, rows[~below], depth + 1)]
    return [tuple(n) for n in nodes]


def _packed(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features]).alias("x")


def _mixed(hashes: np.ndarray, tree: int) -> np.ndarray:
    """A hash of its own for every tree, from the row's hash (the finaliser of splitmix64)."""
    z = hashes + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fit_forest(
    df: DataFrame, key: str, features: Sequence[str], trees: int = TREES, psi: int = PSI, seed: int = K.SEED
) -> DataFrame:
    """Forest nodes. Every tree samples `psi` rows from the whole table.

    A tree's sample are the rows with the `psi` smallest hashes under that tree, so a re-run
    tree sees the same rows. Each task keeps its `psi` smallest per tree, so trees x psi rows
    of each partition are shuffled at most, however large the table is.
    """
    width = len(features)
    rows = df.select(F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("h"), F.col(key).cast("string").alias("__key"), _packed(features))

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = {t: (np.zeros(0, np.uint64), np.zeros(0, object), np.zeros((0, width))) for t in range(trees)}
        with np.errstate(over="ignore"):
            for pdf in batches:
                if not len(pdf):
                    continue
                h = pdf["h"].to_numpy(np.int64).view(np.uint64)
                keys, x = pdf["__key"].to_numpy(object), np.vstack(pdf["x"].to_numpy())
                for t, (rank, names, points) in kept.items():
                    own = _mixed(h, t)
                    near = np.flatnonzero(own <= rank.max()) if len(rank) == psi else np.arange(len(own))
                    rank = np.concatenate((rank, own[near]))
                    names, points = np.concatenate((names, keys[near])), np.concatenate((points, x[near]))
                    best = np.argsort(rank, kind="stable")[:psi]
                    kept[t] = rank[best], names[best], points[best]
        if not len(kept[0][0]):
            return  # a task without rows: pandas cannot tell Arrow that an empty `x` holds arrays
        for t, (rank, names, points) in kept.items():
            yield pd.DataFrame({"tree": t, "rank": (rank >> np.uint64(1)).astype(np.int64), "__key": names, "x": list(points)})

    drawn = rows.mapInPandas(smallest, "tree int, rank long, __key string, x array<double>")
    order = W.partitionBy("tree").orderBy("rank", "__key")
    sample = drawn.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= psi)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        ordered = np.vstack(pdf.sort_values("__key")["x"].to_numpy())
        depth = int(np.ceil(np.log2(max(len(ordered), 2))))
        rows = _grow(ordered, np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "cut", "low", "high", "depth"])
        out.insert(0, "tree", tree)
        return out

    return sample.select("tree", "__key", "x").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score_outliers(
    df: DataFrame, forest: DataFrame, features: Sequence[str], sample_size: int, name: str = "outlier_score"
) -> DataFrame:
    """Adds the score of every row; lower means easier to isolate."""
    nodes = forest.toPandas().sort_values(["tree", "node"])
    trees = [
        tuple(t[c].to_numpy() for c in ("feature", "cut", "low", "high", "depth")) for _, t in nodes.groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(trees)
    scale = mean_path(sample_size) or 1.0

    @F.pandas_udf("double")
    def score(points: pd.Series) -> pd.Series:
        x = np.vstack(points.to_numpy()) if len(points) else np.zeros((0, 1))
        rows = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, cut, low, high, depth in shared.value:
            at = np.zeros(len(x), dtype=int)
            while (inner := feature[at] >= 0).any():
                goes_low = x[rows, np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(goes_low, low[at], high[at]), at)
            total += depth[at]
        return pd.Series(-np.exp2(-(total / max(len(shared.value), 1)) / scale))

    return df.withColumn(name, score(_packed(features)))


def outlier_cut(scored: DataFrame, contamination: float, name: str = "outlier_score") -> float | None:
    row = exact_percentiles(scored, [], name, {"cut": contamination}).first()
    return None if row is None else row["cut"]


def outlier_quarantine(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    contamination: float = K.CONTAMINATION,
    trees: int = TREES,
    psi: int = PSI,
    seed: int = K.SEED,
) -> DataFrame:
    """df with `outlier_score` and `is_inlier`; the lowest scores are the outliers."""
    forest = fit_forest(df, key, features, trees, psi, seed)
    scored = score_outliers(df, forest, features, min(psi, max(df.count(), 1)))
    cut = exact_percentiles(scored, [], "outlier_score", {"cut": contamination}).scalar()
    return scored.withColumn("is_inlier", F.col("outlier_score") >= cut)
