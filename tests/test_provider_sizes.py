"""What the provider tables send over the network and keep in memory."""

import pytest
from pyspark.sql import functions as F

from matchwright.operators import aggregates as A
from matchwright.plans import provider_features as PF
from matchwright.plans import recommend as R
from test_plans import plan
from workload import registry as WR
from workload.views import VIEWS, Tables


def test_distinct_values_travel_alone(spark, small):
    """Counted with the other figures, each distinct value carried the buffers of all of them, which spilled."""
    t = Tables(spark, small)
    for table in (PF.visit_kpis(t.visits), PF.order_kpis(t.orders), PF.profile_base(t.catalog), PF.main_theme(t.catalog)):
        text = plan(table)
        assert "gid#" not in text and "distinct " not in text


def test_distinct_counts_with_nulls(spark):
    rows = [("a", "x", 1), ("a", "x", None), ("a", None, None), (None, "y", 2), (None, None, 2), ("b", "z", 3)]
    df = spark.createDataFrame(rows, "k string, v string, w int")
    counts = A.distinct_counts(df.where("k is null or k <> 'b'"), ["k"], {"n_v": "v", "n_w": "w"})
    out = A.with_counts(df.groupBy("k").agg(F.count("*").alias("n")), "k", counts)
    assert {tuple(r) for r in out.collect()} == {("a", 3, 2, 2), (None, 2, 2, 1), ("b", 1, 0, 0)}


def test_columns_are_made_distinct_one_by_one(spark, small):
    """A task held the distinct values of all columns at once, which spilled."""
    visits = Tables(spark, small).table("lineitem").withColumnRenamed("l_suppkey", "k")
    text = plan(A.distinct_counts(visits, ["k"], {"a": "l_orderkey", "b": "l_partkey"}))
    assert "Expand" not in text and "Union" in text


@pytest.mark.parametrize("name", ["fx_citas", "fx_ordenado"])
def test_views_over_joined_lines(spark, small, name):
    t = Tables(spark, small)
    a, b = t.view(name), t.over_lines(name, WR.lines(t))
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and "Join" not in plan(b)
    with pytest.raises(ValueError):
        t.over_lines("fx_catalogo", WR.lines(t))
    assert "{lines}" not in VIEWS[name]


def test_towns_need_no_pool(spark, small):
    t = Tables(spark, small)
    args = (WR.providers(t), WR.matrix(t), t.clusters)
    a = R.town_lookup(WR.catalog(t), R.candidate_pool(WR.catalog(t), *args))
    b = R.town_lookup(WR.catalog(t), R.eligible_providers(*args))
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_task_themes_are_counted_once(spark):
    """A task under two themes is one task of the provider, and one of each theme."""
    rows = [("p", "t", "b1", "x"), ("p", "t", "b2", "y"), ("p", "u", "b2", "y"), ("p", None, None, None)]
    catalog = spark.createDataFrame(rows, "DNI_PRESTADOR string, CDTAREA string, CDBLOQUE string, DSBLOQUE string")
    master = spark.createDataFrame([("t", True, True, "TRA")], "cdtarea string, snnuevo_modelo boolean, FLAG_TAREA_ACTIVA boolean, cdetapa_gestion string")
    tasks = PF.provider_tasks(catalog, master)
    assert tasks.where("first").count() == 3
    assert PF.main_theme(catalog, tasks).collect() == PF.main_theme(catalog).collect() == [("p", "b2", "y", 2)]
    assert PF.master_enrichment(catalog, master, tasks).first()["pct_tareas_nuevo_modelo"] == pytest.approx(1 / 3)


def test_losses_are_not_sent(spark, small):
    """Six whole numbers per (task, provider, town) that the scores tell were shuffled with them."""
    t = Tables(spark, small)
    pairs = R.scored_pairs(WR.catalog(t), R.eligible_providers(WR.providers(t), WR.matrix(t), t.clusters))
    assert "losses" not in pairs.columns
    assert "losses" in R.packed_providers(pairs, 2).schema["offers"].dataType.elementType["o"].dataType.names
