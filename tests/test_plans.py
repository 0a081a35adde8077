"""The physical plans that scale depends on."""

from pyspark.sql import functions as F

from matchwright.plans import recommend as R
from matchwright.sources import readers as SR
from workload.registry import matrix, providers
from workload.views import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_lookup_is_pushed_down(spark, small):
    text = plan(SR.point_lookup(Tables(spark, small).table("customer"), "c_custkey", 7, ["c_custkey", "c_name"]))
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,7)]" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_ranking_limits_before_the_shuffle(spark, small):
    t = Tables(spark, small)
    text = plan(R.recommend(t.orders, t.catalog, providers(t), matrix(t), t.clusters))
    assert "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_silver_stays_in_the_jvm(spark, small):
    from matchwright.plans import silver as S

    text = plan(S.clean_orders(Tables(spark, small).view("fx_full_ordenado")))
    assert "EvalPython" not in text and "InPandas" not in text


def test_scalars_are_read_once(spark):
    from matchwright.operators.aggregates import impute_mean

    df = spark.range(10).select(*[F.col("id").cast("double").alias(f"c{i}") for i in range(6)])
    assert plan(impute_mean(df, df.columns)).count("Subquery:") <= 2
