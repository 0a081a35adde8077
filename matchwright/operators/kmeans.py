"""K-means for many (k, restart) models at once.

All centre sets move together: one pass over the points gives the sums of every centre of
every model that still moves, so a grid of 160 models costs as many passes as its slowest
model has rounds. Points are compared with all centres in one matrix product per batch.
Start centres are drawn (k-means++) from a bounded sample of the points; the rounds and all
reported figures are over all points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.operators.quality import as_array
from matchwright.session import discard, stage

#: Points from which start centres are drawn, and points compared with the centres in one product.
SAMPLE, CHUNK = 4096, 4096


@dataclass(frozen=True)
class KMeansFit:
    """Centres (k x dimensions), the cost over the training points and the sizes of the groups."""

    centres: np.ndarray
    cost: float
    sizes: tuple[int, ...]

    @property
    def k(self) -> int:
        return len(self.centres)

    def table(self, spark: SparkSession) -> DataFrame:
        """label, centre (array), size: one row per group."""
        rows = [(i, [float(v) for v in c], int(n)) for i, (c, n) in enumerate(zip(self.centres, self.sizes))]
        return spark.createDataFrame(rows, "label int, centre array<double>, size long")

    def transform(self, df: DataFrame, features: str | Sequence[str]) -> DataFrame:
        """df with `label`, the nearest centre; ties go to the lower label."""
        return df.transform(as_array, features).withColumn("label", nearest(self.centres, F.col("x"))).drop("x")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).withColumn("cost", F.lit(self.cost)).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KMeansFit:
        rows = spark.read.parquet(path).orderBy("label").collect()  # k rows
        return KMeansFit(np.array([r["centre"] for r in rows]), rows[0]["cost"], tuple(r["size"] for r in rows))


def nearest(centres: np.ndarray, x: Column) -> Column:
    """Label of the nearest centre as an expression: |c|^2 - 2 x.c has its least value there."""

    def score(c: np.ndarray) -> Column:
        weights = F.array(*(F.lit(-2.0 * float(v)) for v in c))
        return F.aggregate(F.zip_with(x, weights, lambda p, w: p * w), F.lit(float(c @ c)), lambda acc, v: acc + v)

    scores = F.array(*(score(c) for c in centres))
    return (F.array_position(scores, F.array_min(scores)) - 1).cast("int")


def _points(column: pa.ListArray) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    if len(set(sizes.tolist())) > 1:
        raise ValueError("points differ in their number of dimensions")
    return column.flatten().to_numpy().reshape(len(sizes), -1)


def _start(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on the sample: each next centre is drawn with the squared distance to those chosen."""
    chosen = [int(rng.integers(len(sample)))]
    far = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        total = far.sum()
        pick = int(rng.choice(len(sample), p=far / total)) if total > 0 else chosen[0]
        chosen.append(pick)
        far = np.minimum(far, ((sample - sample[pick]) ** 2).sum(axis=1))
    return sample[chosen].astype(np.float64)


def _pass(points: DataFrame, models: list[np.ndarray], width: int, measure, extra=None) -> list[np.ndarray]:
    """Sums over all points of `measure(x, label, scores, extra_of_model)`, a (k, width) array per model and batch."""
    bounds = np.cumsum([0, *(len(m) for m in models)])
    given = points.sparkSession.sparkContext.broadcast((np.concatenate(models), bounds, extra))  # models x k x dimensions, as asked for

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, at, more = given.value
        out = np.zeros((len(centres), width))
        for batch in batches:
            whole = _points(batch.column(0)) if batch.num_rows else np.zeros((0, centres.shape[1]))
            for s in range(0, len(whole), CHUNK):
                x = whole[s : s + CHUNK]
                scores = (centres * centres).sum(axis=1) - 2 * (x @ centres.T)
                for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
                    label = scores[:, a:b].argmin(axis=1)
                    one = (label[:, None] == np.arange(b - a)).astype(np.float64)
                    out[a:b] += one.T @ measure(x, label, None if more is None else more[i])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], ["place", "v"])

    total = np.zeros(bounds[-1] * width)
    for place, v in points.select("x").mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect():
        total[place] = v
    total = total.reshape(-1, width)
    return [total[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _costs_of(x: np.ndarray, label: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per point: 1, squared distance to its centre, and x."""
    return np.column_stack((np.ones(len(x)), ((x - centres[label]) ** 2).sum(axis=1), x))


def _sums(points: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model: counts and coordinate sums of the points nearest to each centre, and the cost."""
    width = models[0].shape[1] + 2
    return [(s[:, 0], s[:, 2:], float(s[:, 1].sum())) for s in _pass(points, models, width, _costs_of, models)]


def fit_many(
    df: DataFrame,
    features: str | Sequence[str],
    ks: Sequence[int],
    restarts: int = 1,
    seed: int = 0,
    max_rounds: int = 100,
    tolerance: float = 1e-4,
) -> dict[int, KMeansFit]:
    """The model of lowest cost over the restarts, for every k; ties go to the earlier restart.

    A model stands still once none of its centres moves by more than `tolerance`; then it
    drops out of the passes. A centre without points stays where it is. No points are an error.
    """
    points = stage(df.transform(as_array, features).select("x"), "kmeans-points")
    # SAMPLE points: those with the least hash, distinct ones only
    drawn = points.select("x", F.xxhash64("x").alias("h")).distinct().orderBy("h").limit(SAMPLE).select("x").collect()
    if not drawn:
        raise ValueError("no points to group")
    sample = np.array(sorted(r["x"] for r in drawn))
    names = [(k, r) for k in ks for r in range(restarts)]
    centres = {n: _start(sample, n[0], np.random.default_rng([seed, *n])) for n in names}
    moving = list(names)
    for _ in range(max_rounds):
        still = []
        for name, (count, sums, _) in zip(moving, _sums(points, [centres[n] for n in moving])):
            old = centres[name]
            new = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], old)
            centres[name] = new
            if np.sqrt(((new - old) ** 2).sum(axis=1)).max() > tolerance:
                still.append(name)
        moving = still
        if not moving:
            break
    best: dict[int, KMeansFit] = {}
    for name, (count, _, cost) in zip(names, _sums(points, [centres[n] for n in names])):
        if name[0] not in best or cost < best[name[0]].cost:
            best[name[0]] = KMeansFit(centres[name], cost, tuple(int(c) for c in count))
    discard(points)
    return best


@dataclass(frozen=True)
class Figures:
    """How good one model's grouping is, over all points; None where a figure is not defined."""

    silhouette: float | None
    calinski_harabasz: float | None
    davies_bouldin: float | None


def _groups_of(x: np.ndarray, label: np.ndarray, _) -> np.ndarray:
    """Per point: 1, |x|^2 and x."""
    return np.column_stack((np.ones(len(x)), (x * x).sum(axis=1), x))


def _spreads_of(x: np.ndarray, label: np.ndarray, stats: tuple) -> np.ndarray:
    """Per point: squared distance to its group's mean, distance, and silhouette under squared distance.

    The mean squared distance to a group of n points with mean m and mean square q is
    |x|^2 - 2 x.m + q, so the groups' sums are all a point needs to see.
    """
    n, mean, square = stats
    row = np.arange(len(x))
    own = ((x - mean[label]) ** 2).sum(axis=1)
    to_group = np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ mean.T) + square, 0)
    to_group[:, n == 0] = np.inf
    size = n[label]
    a = to_group[row, label] * size / np.maximum(size - 1, 1)
    to_group[row, label] = np.inf
    b = to_group.min(axis=1)
    top = np.maximum(a, b)
    fine = (size > 1) & np.isfinite(b) & (top > 0)
    s = np.where(fine, (np.where(fine, b, 0) - a) / np.where(fine, top, 1), 0.0)
    return np.column_stack((own, np.sqrt(own), s))


def figures(points: DataFrame, models: dict[int, KMeansFit]) -> dict[int, Figures]:
    """Silhouette (squared distance), Calinski-Harabasz and Davies-Bouldin of all models in two passes over `x`.

    The same figures as `operators.quality` gives for each labelling by itself.
    """
    centres = [m.centres for m in models.values()]
    dims = centres[0].shape[1]
    stats = []
    for sums in _pass(points, centres, dims + 2, _groups_of):
        n = sums[:, 0]
        stats.append((n, sums[:, 2:] / np.maximum(n, 1)[:, None], sums[:, 1] / np.maximum(n, 1)))
    out = {}
    for k, (n, mean, _), sums in zip(models, stats, _pass(points, centres, 3, _spreads_of, stats)):
        used = n > 0
        n, mean, (within, spread, silhouettes) = n[used], mean[used], sums[used].T
        total, groups = n.sum(), len(n)
        between = (n * ((mean - (n[:, None] * mean).sum(axis=0) / total) ** 2).sum(axis=1)).sum()
        fine = 1 < groups < total and within.sum() > 0
        gaps = np.sqrt(((mean[:, None] - mean[None]) ** 2).sum(axis=2))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(gaps > 0, ((spread / n)[:, None] + (spread / n)[None]) / gaps, -np.inf).max(axis=1)
        out[k] = Figures(
            float(silhouettes.sum() / total),
            float(between / (groups - 1) / (within.sum() / (total - groups))) if fine else None,
            float(ratio[np.isfinite(ratio)].mean()) if np.isfinite(ratio).any() else None,
        )
    return out
