"""Provider groups: quarantine, scaling, PCA, k-means grid, selection, profiles, prediction."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, VectorAssembler, VectorSlicer
from pyspark.ml.feature import RobustScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions import cleaning as C
from matchwright.functions.expr import archetype
from matchwright.operators import aggregates as A
from matchwright.operators import forest as OF
from matchwright.operators import quality as Q
from matchwright.operators.kmeans import KMeansFit, figures, fit_many
from matchwright.operators.ranks import column_percentiles, melt
from matchwright.session import discard, stage

WHO = "DNI_PRESTADOR"
FEATURES = list(K.FEATURES)


def model_matrix(matrix: DataFrame, features: Sequence[str] = FEATURES, heavy: Sequence[str] = K.HEAVY_TAILED):
    """No nulls or NaN, log1p on the heavy-tailed columns."""
    return matrix.transform(C.fill_null_nan, features).transform(C.log1p_columns, [c for c in heavy if c in features])


# ---- scaling and projection ---------------------------------------------------------------------


def robust_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - median) / (p75 - p25), exact; constant columns are only centred."""
    stats = robust_stats(df if fit_on is None else fit_on, columns)
    return apply_robust(df, columns, stats)


def robust_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with <column>__m and <column>__s."""
    long = column_percentiles(df, [], columns, {"lo": 0.25, "mid": 0.5, "hi": 0.75})
    span = F.col("hi") - F.col("lo")
    long = long.select("feature", F.col("mid"), F.when(span == 0, F.lit(1.0)).otherwise(span).alias("span"))
    picks = []
    for c in columns:
        here = F.col("feature") == c
        picks += [F.max(F.when(here, F.col("mid"))).alias(f"{c}__m"), F.max(F.when(here, F.col("span"))).alias(f"{c}__s")]
    return long.agg(*picks)


def apply_robust(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    return A.with_scalars(df, stats, lambda s: {c: (F.col(c) - s[f"{c}__m"]) / s[f"{c}__s"] for c in columns})


def robust_scaler(columns: Sequence[str], error: float = 0.001) -> Pipeline:
    """The sketch-based scaler of Spark ML for tables too wide for exact quantiles."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="assembled"),
            RobustScaler(
                inputCol="assembled", outputCol="scaled", withCentering=True, withScaling=True, relativeError=error
            ),
        ]
    )


def components_for(variance: Sequence[float], target: float, least: int = 2) -> int:
    total = 0.0
    for i, v in enumerate(variance, start=1):
        total += v
        if total >= target:
            return max(i, min(least, len(variance)))
    return len(variance)


def pca_by_variance(df: DataFrame, columns: Sequence[str], target: float = K.PCA_VARIANCE):
    """(fitted pipeline, number of components, variance kept). Output column: `projected`."""
    assemble = VectorAssembler(inputCols=list(columns), outputCol="scaled")
    full = PCA(k=len(columns), inputCol="scaled", outputCol="rotated").fit(assemble.transform(df))
    variance = [float(v) for v in full.explainedVariance]
    n = components_for(variance, target)
    cut = VectorSlicer(inputCol="rotated", outputCol="projected", indices=list(range(n)))
    return PipelineModel(stages=[assemble, full, cut]), n, sum(variance[:n])


# ---- k-means --------------------------------------------------------------------------------------


@dataclass
class GridEntry:
    k: int
    silhouette: float
    calinski_harabasz: float
    davies_bouldin: float
    inertia: float
    cluster_sizes: list[int]


# Columns of the grid table.
GRID_SCHEMA = (
    "k int, silhouette double, calinski_harabasz double, davies_bouldin double, inertia double, "
    "cluster_sizes array<bigint>"
)


def kmeans_grid(
    points: DataFrame,
    features: str = "projected",
    key: str = WHO,
    k_range: Sequence[int] = K.K_RANGE,
    restarts: int = K.KMEANS_RESTARTS,
    seed: int = K.SEED,
) -> tuple[DataFrame, dict[int, KMeansFit]]:
    """One row per k with quality figures, and the fitted models. All models are fitted together."""
    held = stage(points.select(key, features).transform(Q.as_array, features).select(key, "x"), "grid-points")
    models = fit_many(held, "x", k_range, restarts, seed)
    seen = figures(held, models)
    entries = [GridEntry(k=int(k), inertia=m.cost, cluster_sizes=list(m.sizes), **vars(seen[k])) for k, m in models.items()]
    discard(held)
    rows = [tuple(vars(e)[c.split()[0]] for c in GRID_SCHEMA.split(", ")) for e in entries]
    return points.sparkSession.createDataFrame(rows, GRID_SCHEMA), models


def select_k(grid: DataFrame, min_size: int = K.MIN_CLUSTER_SIZE, min_kept: int = K.MIN_KEPT_CLUSTERS) -> DataFrame:
    """The row with the best silhouette among those with enough large groups (empty if none)."""
    large = F.size(F.filter("cluster_sizes", lambda s: s >= min_size))
    return grid.where(large >= min_kept).orderBy(F.desc("silhouette"), "k").limit(1)


def require_k(grid: DataFrame, min_size: int = K.MIN_CLUSTER_SIZE, min_kept: int = K.MIN_KEPT_CLUSTERS):
    chosen = select_k(grid, min_size, min_kept).first()
    if chosen is None:
        tried = [(r["k"], round(r["silhouette"], 3), list(r["cluster_sizes"])) for r in grid.orderBy("k").collect()]
        raise RuntimeError(f"no k gives {min_kept} groups of {min_size} or more; (k, silhouette, sizes): {tried}")
    return chosen


def centroid_distance(labelled: DataFrame, centroids: DataFrame, features="x", label="label", noise=K.NOISE_CLUSTER):
    """Distance of a point to the centre of its own group; 0 for noise.

    `centroids` has the label and `centre` (array), as many rows as there are groups.
    """
    own = F.try_element_at(Q.per_label(centroids, label, "centre"), F.col(label))["centre"]
    distance = F.coalesce(F.sqrt(Q.squared_distance("x", "centre")), F.lit(0.0))
    placed = Q.as_array(labelled, features).withColumn("centre", own)
    return placed.withColumn(
        "distance_to_centroid", F.when(F.col(label) == noise, F.lit(0.0)).otherwise(distance)
    ).drop("centre")


def size_remap(labelled: DataFrame, label: str = "label", min_size: int = K.MIN_CLUSTER_SIZE) -> DataFrame:
    """label -> cluster_id: large groups are renumbered 0.. in label order, small ones are -1."""
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    kept = sizes.where((F.col("n") >= min_size) & (F.col(label) != K.NOISE_CLUSTER))
    numbered = kept.select(label, (F.row_number().over(W.orderBy(label)) - 1).cast("int").alias("new"))
    return sizes.join(numbered, label, "left").select(
        label, F.coalesce("new", F.lit(K.NOISE_CLUSTER)).cast("int").alias("cluster_id")
    )


def suppress_small_clusters(labelled: DataFrame, label: str = "label", min_size: int = K.MIN_CLUSTER_SIZE):
    return remapped(labelled, size_remap(labelled, label, min_size), label)


def remapped(labelled: DataFrame, remap: DataFrame, label: str = "label") -> DataFrame:
    """Adds cluster_id from the k-row table label -> cluster_id, without a join."""
    return labelled.withColumn("cluster_id", F.try_element_at(Q.per_label(remap, label, "cluster_id"), F.col(label))["cluster_id"])


def cluster_table(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per provider: quarantined providers and small groups share cluster -1."""
    return matrix.select(WHO, *K.CLUSTER_CONTEXT).join(
        labels.select(WHO, "cluster_id", "distance_to_centroid"), WHO, "left"
    ).withColumns(
        {
            "cluster_id": F.coalesce("cluster_id", F.lit(K.NOISE_CLUSTER)).cast("int"),
            "distance_to_centroid": F.when(
                F.coalesce("cluster_id", F.lit(K.NOISE_CLUSTER)) == K.NOISE_CLUSTER, F.lit(0.0)
            ).otherwise(F.col("distance_to_centroid")),
        }
    )


# ---- the fitted model -------------------------------------------------------------------------------


@dataclass
class GroupingModel:
    """Everything needed to place a new provider: forest, scaling, projection, centres, remap."""

    features: list[str]
    forest: DataFrame
    sample_size: int
    cut: float
    scaling: DataFrame
    projection: PipelineModel
    kmeans: KMeansFit
    remap: DataFrame
    metadata: dict[str, Any]

    def _scored(self, matrix: DataFrame) -> DataFrame:
        return OF.score_outliers(matrix, self.forest, self.features, self.sample_size)

    def project(self, inliers: DataFrame) -> DataFrame:
        return self.projection.transform(apply_robust(inliers, self.features, self.scaling))

    def predict(self, matrix: DataFrame) -> DataFrame:
        """provider, cluster_id: outliers and members of small groups get -1."""
        prepared = model_matrix(matrix, self.features).select(WHO, *self.features)
        inliers = self._scored(prepared).where(F.col("outlier_score") >= self.cut).drop("outlier_score")
        # stored, so that the model below does not carry the whole chain of expressions
        projected = stage(self.project(inliers).select(WHO, "projected"), "grouping-predicted")
        raw = self.kmeans.transform(projected, "projected").select(WHO, "label")
        placed = remapped(raw, self.remap).select(WHO, "cluster_id")
        return matrix.select(WHO).join(placed, WHO, "left").fillna(K.NOISE_CLUSTER, subset=["cluster_id"])

    def save(self, path: str) -> None:
        self.forest.write.mode("overwrite").parquet(f"{path}/forest")
        self.scaling.write.mode("overwrite").parquet(f"{path}/scaling")
        self.remap.write.mode("overwrite").parquet(f"{path}/remap")
        self.projection.write().overwrite().save(f"{path}/projection")
        self.kmeans.save(self.forest.sparkSession, f"{path}/kmeans")
        facts = {"features": self.features, "sample_size": self.sample_size, "cut": self.cut, **self.metadata}
        spark = self.forest.sparkSession
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata"
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> GroupingModel:
        facts = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        features, size, cut = facts.pop("features"), facts.pop("sample_size"), facts.pop("cut")
        return GroupingModel(
            features,
            spark.read.parquet(f"{path}/forest"),
            size,
            cut,
            spark.read.parquet(f"{path}/scaling"),
            PipelineModel.load(f"{path}/projection"),
            KMeansFit.load(spark, f"{path}/kmeans"),
            spark.read.parquet(f"{path}/remap"),
            facts,
        )


def fit_grouping(
    matrix: DataFrame,
    features: Sequence[str] = FEATURES,
    k_range: Sequence[int] = K.K_RANGE,
    restarts: int = K.KMEANS_RESTARTS,
    contamination: float = K.CONTAMINATION,
    min_size: int = K.MIN_CLUSTER_SIZE,
    min_kept: int = K.MIN_KEPT_CLUSTERS,
    seed: int = K.SEED,
    trees: int = OF.TREES,
) -> tuple[GroupingModel, DataFrame]:
    """(model, labels of the training providers). Axes are fitted on inliers only."""
    features = list(features)
    prepared = stage(model_matrix(matrix, features).select(WHO, *features), "grouping-input")
    n_rows = prepared.count()
    sample_size = min(OF.PSI, max(n_rows, 1))
    forest = stage(OF.fit_forest(prepared, WHO, features, trees=trees, seed=seed), "grouping-forest")
    scored = stage(OF.score_outliers(prepared, forest, features, sample_size), "grouping-scored")
    cut = OF.outlier_cut(scored, contamination)
    inliers = scored.where(F.col("outlier_score") >= cut).drop("outlier_score")
    scaling = stage(robust_stats(inliers, features), "grouping-scaling")
    scaled = apply_robust(inliers, features, scaling)
    projection, n_axes, kept = pca_by_variance(scaled, features)
    projected = stage(projection.transform(scaled).select(WHO, "projected"), "grouping-projected")
    grid, models = kmeans_grid(projected, key=WHO, k_range=k_range, restarts=restarts, seed=seed)
    chosen = require_k(grid, min_size, min_kept)
    best = models[chosen["k"]]
    labelled = best.transform(projected, "projected")
    remap = stage(size_remap(labelled, "label", min_size), "grouping-remap")
    spark = matrix.sparkSession
    centres = best.table(spark).select("label", "centre")
    placed = stage(
        remapped(centroid_distance(labelled, centres, "projected"), remap).drop("x"), "grouping-labels"
    )
    kept_rows = placed.where(F.col("cluster_id") != K.NOISE_CLUSTER)
    sizes = [r[1] for r in kept_rows.groupBy("cluster_id").count().orderBy("cluster_id").collect()]
    n_in = sum(chosen["cluster_sizes"])
    # The names of the facts stored with a model.
    metadata = {
        "n_rows": n_rows,
        "n_inliers": n_in,
        "n_outliers_iforest": n_rows - n_in,
        "n_relabeled_as_noise": n_in - sum(sizes),
        "n_total_noise": n_rows - sum(sizes),
        "iforest_contamination": contamination,
        "log_features": sorted(c for c in K.HEAVY_TAILED if c in features),
        "pca_components": n_axes,
        "pca_variance_explained": kept,
        "selected": chosen.asDict(),
        "kmeans_grid": [r.asDict() for r in grid.orderBy("k").collect()],
        "n_kept_clusters": len(sizes),
        "kept_cluster_sizes": sizes,
        "silhouette_kept": (
            Q.squared_silhouette(kept_rows, "projected", "cluster_id", WHO).first()[0] if len(sizes) >= 2 else None
        ),
        "random_state": seed,
        "min_kept_cluster_size": min_size,
        "min_n_kept_clusters": min_kept,
    }
    model = GroupingModel(features, forest, sample_size, cut, scaling, projection, best, remap, metadata)
    return model, placed.select(WHO, "cluster_id", "distance_to_centroid")


# ---- describing groups ------------------------------------------------------------------------------


def cluster_profile(
    clusters: DataFrame,
    matrix: DataFrame,
    providers: DataFrame,
    features: Sequence[str] = FEATURES,
    names: Mapping[int, str] = K.ARCHETYPES,
) -> DataFrame:
    """One row per group: size, shares, most frequent attributes and feature medians."""
    flags = providers.select(
        WHO, F.col("es_red_estrategica").alias("estrategica"), "FLAG_SOLO_VIRTUAL_2025", "sin_capacidad"
    )
    base = (
        clusters.join(matrix.select(WHO, *features), WHO, "left").join(flags, WHO, "left")
    )
    by = ["cluster_id"]
    sizes = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_providers"),
        A.share_true(F.col("estrategica")).alias("pct_red_estrategica"),
        A.share_true(F.col("FLAG_SOLO_VIRTUAL_2025")).alias("pct_solo_virtual"),
        A.share_true(F.col("sin_capacidad")).alias("pct_sin_capacidad"),
    )
    total = sizes.agg(F.sum("n_providers")).scalar()
    tops = {
        "bloque_principal": "top_bloque",
        "tipo_perfil": "top_tipo_perfil",
        "etapa_predominante": "top_etapa",
        "tipo_red": "top_tipo_red",
    }
    modes = A.modes_of(clusters, by, tops)
    long = column_percentiles(base, by, features, {"m": 0.5})
    medians = long.groupBy(*by).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(f"median_{c}") for c in features]
    )
    return (
        sizes.join(modes, "cluster_id", "left")
        .join(medians, "cluster_id", "left")
        .select(
            "cluster_id",
            F.coalesce(archetype("cluster_id", names), F.lit(K.UNNAMED)).alias("archetype_name"),
            "n_providers",
            (F.col("n_providers") / total).alias("share_of_total"),
            "pct_red_estrategica",
            "pct_solo_virtual",
            "pct_sin_capacidad",
            *tops.values(),
            *[f"median_{c}" for c in features],
        )
    )


def discriminating_features(
    clusters: DataFrame, matrix: DataFrame, features: Sequence[str] = FEATURES, top_n: int = 5
) -> DataFrame:
    """Per group the features whose median lies furthest from the overall median."""
    base = clusters.select(WHO, "cluster_id").join(matrix.select(WHO, *features), WHO, "inner")
    local = column_percentiles(base, ["cluster_id"], features, {"cluster_median": 0.5})
    whole = column_percentiles(base, [], features, {"global_median": 0.5})
    spread = melt(base, [], features).groupBy("feature").agg(F.stddev_pop("value").alias("sd"))
    z = (F.col("cluster_median") - F.col("global_median")) / (F.col("sd") + F.lit(1e-9))
    scored = local.join(whole, "feature").join(spread, "feature").withColumn("z_score", z)
    order = W.partitionBy("cluster_id").orderBy(F.desc(F.round(F.abs("z_score"), 9)), "feature")
    return (
        scored.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top_n)
        .select(
            "cluster_id",
            "position",
            "feature",
            "cluster_median",
            "global_median",
            "z_score",
            F.when(F.col("z_score") > 0, "HIGH").otherwise("LOW").alias("direction"),
        )
    )


def archetype_guardrail(profile: DataFrame, remote: int = K.REMOTE_CLUSTER, largest: int = 0) -> DataFrame:
    """Do the fixed names still fit? One row per rule with the group that should carry the name."""
    found = profile.agg(
        F.max_by("cluster_id", F.struct("pct_solo_virtual", -F.col("cluster_id"))).alias("v"),
        F.max_by("cluster_id", F.struct("n_providers", -F.col("cluster_id"))).alias("n"),
        F.bool_or(F.col("cluster_id") == remote).alias("has_remote"),
        F.bool_or(F.col("cluster_id") == largest).alias("has_largest"),
    )
    rules = F.array(
        F.struct(
            F.lit("max_pct_solo_virtual").alias("rule"),
            F.lit(remote).alias("expected"),
            F.col("v").alias("observed"),
            F.col("has_remote").alias("applies"),
        ),
        F.struct(
            F.lit("max_n_providers").alias("rule"),
            F.lit(largest).alias("expected"),
            F.col("n").alias("observed"),
            F.col("has_largest").alias("applies"),
        ),
    )
    return found.select(F.explode(rules).alias("r")).select(
        "r.*", (~F.col("r.applies") | (F.col("r.expected") == F.col("r.observed"))).alias("ok")
    )
