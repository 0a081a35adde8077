"""Grouping by invariants: sizes, agreement up to relabeling, stored model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.operators import forest as OF
from matchwright.operators import kmeans as KM
from matchwright.operators import quality as Q
from matchwright.plans import grouping as G


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0, 0], [8, 0, 8], [0, 9, 9]])
    rows = [(f"P{i:03d}", i % 3, *map(float, centres[i % 3] + rng.normal(0, 0.5, 3))) for i in range(150)]
    rows += [(f"Q{i}", -1, 80.0 + i, -70.0, 90.0) for i in range(4)]
    return spark.createDataFrame(rows, "DNI_PRESTADOR string, truth int, a double, b double, c double")


def test_far_points_are_quarantined(blobs):
    out = OF.outlier_quarantine(blobs, "DNI_PRESTADOR", ["a", "b", "c"], contamination=4 / 154, trees=40)
    gone = {r[0] for r in out.where(~F.col("is_inlier")).select("DNI_PRESTADOR").collect()}
    assert gone == {"Q0", "Q1", "Q2", "Q3"}
    again = OF.outlier_quarantine(blobs, "DNI_PRESTADOR", ["a", "b", "c"], contamination=4 / 154, trees=40)
    assert sorted(map(tuple, again.select("DNI_PRESTADOR", "outlier_score").collect())) == sorted(
        map(tuple, out.select("DNI_PRESTADOR", "outlier_score").collect())
    )


def test_forest_over_tasks_without_rows(spark, blobs):
    few = spark.createDataFrame(blobs.limit(3).collect(), blobs.schema).repartition(1).repartition(6, "DNI_PRESTADOR")
    assert few.rdd.glom().map(len).filter(lambda n: n == 0).count() > 0
    out = OF.outlier_quarantine(few, "DNI_PRESTADOR", ["a", "b", "c"], trees=5).collect()
    assert len(out) == 3 and all(-1 <= r["outlier_score"] <= 0 for r in out)
    assert OF.outlier_quarantine(few.where("a > 1e9"), "DNI_PRESTADOR", ["a", "b", "c"], trees=5).collect() == []


def test_fit_save_load_predict(spark, blobs, tmp_path):
    model, labels = G.fit_grouping(blobs, ["a", "b", "c"], k_range=(3, 4), restarts=2, contamination=4 / 154, min_size=20, min_kept=3, trees=40)
    assert model.metadata["n_kept_clusters"] == 3 and model.metadata["kept_cluster_sizes"] == [50, 50, 50]
    both = labels.join(blobs.select("DNI_PRESTADOR", "truth"), "DNI_PRESTADOR")
    assert Q.ari(both, "cluster_id", "truth").first()[0] == pytest.approx(1.0)
    model.save(str(tmp_path / "model"))
    again = G.GroupingModel.load(spark, str(tmp_path / "model"))
    placed = dict(again.predict(blobs).collect())
    assert {p: c for p, c in placed.items() if p.startswith("Q")} == {f"Q{i}": -1 for i in range(4)}
    assert {p: c for p, c in placed.items() if p.startswith("P")} == {r[0]: r[1] for r in labels.select("DNI_PRESTADOR", "cluster_id").collect()}


def test_quality_formulas(blobs):
    pdf = blobs.where("truth >= 0").toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["truth"].to_numpy()
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    s = []
    for i in range(len(x)):
        same = (y == y[i]) & (np.arange(len(x)) != i)
        a, b = d[i, same].mean(), min(d[i, y == k].mean() for k in set(y) - {y[i]})
        s.append((b - a) / max(a, b))
    df = blobs.where("truth >= 0")
    cols = ["a", "b", "c"]
    assert Q.silhouette(df, cols, "truth", "DNI_PRESTADOR").first()[0] == pytest.approx(np.mean(s), abs=1e-7)
    means = np.array([x[y == k].mean(axis=0) for k in range(3)])
    n = np.bincount(y)
    between = (n[:, None] * (means - x.mean(axis=0)) ** 2).sum()
    within = ((x - means[y]) ** 2).sum()
    assert Q.calinski_harabasz(df, cols, "truth").first()[0] == pytest.approx((between / 2) / (within / (len(x) - 3)))
    spread = [np.linalg.norm(x[y == k] - means[k], axis=1).mean() for k in range(3)]
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(means[i] - means[j]) for j in range(3) if j != i) for i in range(3)]
    assert Q.davies_bouldin(df, cols, "truth").first()[0] == pytest.approx(np.mean(worst))


def test_agreement_extremes(spark):
    same = spark.createDataFrame([(i % 3, "abc"[i % 3]) for i in range(30)], "x int, y string")
    assert Q.nmi(same, "x", "y").first()[0] == pytest.approx(1.0)
    assert Q.ari(same, "x", "y").first()[0] == pytest.approx(1.0)
    flat = same.withColumn("y", F.lit("k")).withColumn("x", F.lit(1))
    assert Q.nmi(flat, "x", "y").first()[0] == 1.0 and Q.ari(flat, "x", "y").first()[0] == 1.0
    with pytest.raises(ValueError):
        Q.compare_labelings(same, same)


def test_many_kmeans_models_in_one_pass(spark):
    """Each model against plain Lloyd rounds from the same start; several files, so that sums meet."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (400, 3)) + rng.integers(0, 3, (400, 1)) * 6, 6)
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id int, v array<double>").repartition(5)
    found = KM.fit_many(df, "v", (2, 3, 5), restarts=4, seed=9)
    sample = np.array(sorted(map(tuple, x)))
    for k in (2, 3, 5):
        costs = []
        for r in range(4):
            c = KM._start(sample, k, np.random.default_rng([9, k, r]))
            for _ in range(100):
                label = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
                new = np.array([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(k)])
                moved, c = np.sqrt(((new - c) ** 2).sum(axis=1)).max(), new
                if moved <= 1e-4:
                    break
            costs.append(((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum())
        model = found[k]
        assert model.cost == pytest.approx(min(costs)) and sum(model.sizes) == 400 and model.k == k
        own = {r["id"]: r["label"] for r in model.transform(df, "v").collect()}
        d = ((x[:, None] - model.centres) ** 2).sum(axis=2)
        assert all(d[i, j] <= d[i].min() + 1e-9 for i, j in own.items())


def test_figures_of_all_models_against_each_labelling(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(0, 1, (300, 2)) + rng.integers(0, 4, (300, 1)) * 3, 5)
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id int, x array<double>").repartition(3)
    models = KM.fit_many(df, "x", (2, 4, 7), restarts=2)
    for k, f in KM.figures(df, models).items():
        placed = models[k].transform(df.withColumnRenamed("x", "v"), "v")
        assert f.silhouette == pytest.approx(Q.squared_silhouette(placed, "v", "label", "id").first()[0], abs=1e-9)
        assert f.calinski_harabasz == pytest.approx(Q.calinski_harabasz(placed, "v", "label").first()[0])
        assert f.davies_bouldin == pytest.approx(Q.davies_bouldin(placed, "v", "label").first()[0])


def test_kmeans_is_no_worse_than_the_library(spark, blobs):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    points = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(blobs)
    found = KM.fit_many(points, "v", (3, 4, 6), restarts=10)
    for k, model in found.items():
        theirs = min(KMeans(k=k, featuresCol="v", seed=s).fit(points).summary.trainingCost for s in range(3))
        assert model.cost <= theirs * (1 + 1e-6)


def test_kmeans_of_few_and_equal_points(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0],)] * 6 + [([5.0, 5.0],)], "v array<double>")
    model = KM.fit_many(df, "v", [4], restarts=2)[4]
    assert model.cost == 0 and sorted(model.sizes) == [0, 0, 1, 6]
    model.save(spark, str(tmp_path / "m"))
    again = KM.KMeansFit.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.centres, model.centres) and again.sizes == model.sizes
    with pytest.raises(ValueError):
        KM.fit_many(df.limit(0), "v", [2])


def test_components(spark):
    assert G.components_for([0.95, 0.03, 0.02], 0.9) == 2
    assert G.components_for([0.5, 0.3, 0.15, 0.05], 0.9) == 3


def test_all_groups_small(spark):
    df = spark.createDataFrame([(i % 4,) for i in range(8)], "label int")
    assert {r[0] for r in G.suppress_small_clusters(df, min_size=3).select("cluster_id").collect()} == {-1}


def test_silhouette_sends_a_block_to_few_tasks(blobs):
    for tasks in (1, 2, 16, 200):
        across, down = Q._grid(tasks)
        assert across * down >= tasks and (tasks < 16 or across + down < tasks)
    one = Q.silhouette_points(blobs, ["a", "b", "c"], "truth", "DNI_PRESTADOR", block=1000, lanes=1).collect()
    many = Q.silhouette_points(blobs, ["a", "b", "c"], "truth", "DNI_PRESTADOR", block=7, lanes=40).collect()
    want = {r[0]: r["s"] for r in one}
    assert len(many) == len(one) == 154 and {r[0]: r["s"] for r in many} == pytest.approx(want, abs=1e-9)
