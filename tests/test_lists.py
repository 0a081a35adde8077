"""Ranked candidates in one row per order: the same rows, neither stored nor shuffled one by one."""

import pytest
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.operators import cutoffs
from matchwright.operators import matching as M
from matchwright.plans import recommend as R
from test_plans import plan
from workload import registry as WR
from workload.catalog import QUERIES
from workload.views import Tables


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    a, b = a.persist(), b.select(*a.columns).persist()
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("limits", [(10**6, 10**6), (5, 10**6), (0, 0)])
def test_lists_are_the_ranked_rows(spark, small, limits):
    t = Tables(spark, small)
    lists = R.recommend_lists(WR.orders(t), WR.catalog(t), WR.eligible(t), K.TOP_N, *limits)
    assert lists.count() == lists.select(*K.ORDER_KEY).distinct().count()
    same(WR.recommended(t), R.listed(lists.select(*K.ORDER_KEY, F.explode("best").alias("b")), WR.eligible(t)))


def test_choices_are_the_ranked_rows(spark, small):
    t = Tables(spark, small)
    same(WR.first_choice(t), WR.recommended(t).where("rank = 1"))
    assert WR.lists(t).where(F.size("best") == 0).isEmpty()


@pytest.mark.parametrize("most", [cutoffs.MAX_BARS, 0])
def test_lists_are_assigned_like_ranked_rows(spark, small, monkeypatch, most):
    monkeypatch.setattr(cutoffs, "MAX_BARS", most)
    t = Tables(spark, small)
    done = WR.capped_rows(t, WR.settled(t))
    wanted = M.assign_capacitated(WR.recommended(t).persist())
    assert done.columns == wanted.columns
    same(done, wanted)


def test_no_cap_is_all_overflow(spark, small):
    done = M.assign_lists(WR.signed_lists(Tables(spark, small)), K.ORDER_KEY, cap=0)
    assert done.where(~F.col("overflow")).isEmpty() and done.where(F.col("dni_prestador") != F.col("cands")[0]["provider"]).isEmpty()


def test_orders_keep_their_place(spark, small):
    """Orders whose provider the bars tell are not shuffled; before, all ranks were, by key, twice."""
    t = Tables(spark, small)
    text = plan(cutoffs.places(WR.signed_lists(t), cutoffs.Bars.none(), M.SLOTS))
    assert "Exchange" not in text and "Join" not in text


def test_ranked_rows_are_not_stored(spark, small, tmp_path):
    root = tmp_path / "tables"
    root.symlink_to(small)

    def kept_after(*names):
        for name in names:
            QUERIES[name](spark, str(root)).collect()
        return {table for _, where, table in WR._STORED if where == str(root)}

    assert not {"top10", "top2", "lists"} & kept_after("consumer_recommendations", "consumer_assignment")
    assert not {"top10", "top2"} & kept_after("capacity_cap", "assign_capacitated_stability", "scenario_diff_capacitated")


def test_place_is_worked_out_once(spark, small):
    """Filters on the place do not call for it again; before, each did."""
    placed = cutoffs.places(WR.signed_lists(Tables(spark, small)), cutoffs.Bars.none(), M.SLOTS)
    rows = placed.where(F.col("place") != cutoffs.SHARED).withColumn("at", F.coalesce("place", F.lit(0)))
    assert plan(rows.select("at", F.get("cands", "at")["provider"])).count("ArrowEvalPython ") == 1


def test_groups_carry_numbers_and_no_names(spark):
    rows = [("E1", "T", "M", r, p, s) for r, p, s in ((1, "P1", 0.9), (1, "P1", 0.9), (2, "P2", 0.5))] + [("E2", "T", "M", 1, "P1", 0.9), ("E2", "T", "M", 2, "P2", 0.5)]
    ranked = spark.createDataFrame(rows, "dni_empresa string, codigo_tarea string, cd_municipio_destino string, rank int, dni_prestador string, score_total double")
    orders = M.fold_orders(ranked, K.ORDER_KEY)
    assert {len(r["cands"]) for r in orders.collect()} == {2}  # a candidate given twice stands once
    group = cutoffs.folded(orders, M.SLOTS).first()
    assert group["qty"] == 2 and len(group["providers"]) == 2 and group["losses"] == [-0.9, -0.5] and group["slot"] == group["sig_a"] % M.SLOTS


def test_tasks_of_every_query_find_the_package(spark, small, monkeypatch):
    """Queries with Python in tasks failed where the driver was started in another folder."""
    import __spark_entry__ as entry

    env = dict(spark.sparkContext.environment)
    env.pop("PYTHONPATH", None)
    monkeypatch.setattr(spark.sparkContext, "environment", env)
    entry.queries()["eda_coverage_gap"](spark, small)
    assert entry.HERE in env["PYTHONPATH"]
