"""Guards stop bad tables, and the stored serving index gives what the catalog gives."""

import pytest
from pyspark.sql import functions as F

from matchwright.operators import quality as Q
from matchwright.plans import kpis as P
from matchwright.plans import recommend as R
from matchwright.sources import store as ST

INDEX = "scenario string, capacidad_estimada double, isc double"
DIFF = "n_orders_compared long, gini_load_rule_based double, gini_load_lp_optimized double"


@pytest.mark.parametrize("row, rule", [(("a", 0.0, 1.0), "capacity_positive"), (("a", 5.0, None), "index_known"), (("a", 5.0, float("nan")), "index_known"), (("a", None, 1.0), "capacity_positive")])
def test_bad_saturation_table_is_not_shown(spark, tmp_path, row, rule):
    path = str(tmp_path / "t")
    ST.write_replace(spark.createDataFrame([("a", 5.0, 0.5)], INDEX), path, P.saturation_rules())
    with pytest.raises(ValueError, match=rule):
        ST.write_replace(spark.createDataFrame([("a", 5.0, 0.7), row], INDEX), path, P.saturation_rules())
    assert [r["isc"] for r in ST.read_stored(spark, path).collect()] == [0.5]


@pytest.mark.parametrize("row, rule", [((0, 0.5, 0.5), "common_orders"), ((3, 1.5, 0.5), "gini_rule_based_in_range"), ((3, 0.5, float("nan")), "gini_lp_optimized_in_range"), ((3, 0.5, None), "gini_lp_optimized_in_range")])
def test_bad_comparison_fails_its_check(spark, row, rule):
    index = spark.createDataFrame([("a", 5.0, 0.5)], INDEX)
    good = P.published_checks(index, spark.createDataFrame([(3, 0.2, 0.9)], DIFF), "a")
    assert P.enforce(good).count() == 4
    with pytest.raises(ValueError, match=rule):
        P.enforce(P.published_checks(index, spark.createDataFrame([row], DIFF), "a"))


def test_null_index_fails_its_check(spark):
    index = spark.createDataFrame([("a", 5.0, None), ("b", 5.0, 1.0)], INDEX)
    difference = spark.createDataFrame([(3, 0.2, 0.9)], DIFF)
    with pytest.raises(ValueError, match="index_known"):
        P.enforce(P.published_checks(index, difference, "a"))
    assert P.enforce(P.published_checks(index, difference, "b")).count() == 4


def test_rows_and_capacity_checks(spark):
    assigned = spark.createDataFrame([(0,), (-1,), (None,)], "cluster_id int")
    capacity = spark.createDataFrame([(0, 3.0)], "cluster_id int, capacidad_estimada double")
    assert P.enforce(P.conservation_checks(assigned, capacity, "a")).count() == 3
    with pytest.raises(ValueError, match="capacity_positive"):
        P.enforce(P.conservation_checks(assigned, capacity.withColumn("capacidad_estimada", F.lit(None).cast("double")), "a"))
    with pytest.raises(ValueError, match="not_empty"):
        P.enforce(P.conservation_checks(assigned.limit(0), capacity, "a"))


def test_labelings_without_common_keys(spark):
    a = spark.createDataFrame([("x", 1)], "DNI_PRESTADOR string, cluster_id int")
    with pytest.raises(ValueError, match="in common"):
        Q.compare_labelings(a, a.withColumn("DNI_PRESTADOR", F.lit("y")))


def test_serving_index_equals_the_catalog(spark, small, tmp_path):
    from workload.registry import matrix, providers
    from workload.views import Tables

    t = Tables(spark, small)
    eligible = R.eligible_providers(providers(t), matrix(t), t.clusters).cache()
    index = R.store_serving_index(R.serving_index(t.catalog, eligible), str(tmp_path / "index"))
    tasks = [r[0] for r in t.catalog.select("CDTAREA").distinct().orderBy("CDTAREA").limit(3).collect()]
    calls = [{"town": "1111.0", "segment": "GRAN EMPRESA"}, {"route": "LIVIANA"}, {"town": "22"}, {"segment": "Micro Empresa", "town": "1111"}, {}]
    for task in [*tasks, "no such task"]:
        for how in calls:
            assert index.score(task, **how).collect() == R.score_one_order(t.catalog, eligible, task, **how).collect(), (task, how)
    plan = index.score(tasks[0], "1111")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    eligible.unpersist()
