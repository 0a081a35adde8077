"""KPIs folded by side before providers are described."""

import math

import pytest
from pyspark.sql import functions as F

from matchwright.plans import kpis
from test_plans import plan
from workload import registry as WR
from workload.q_assignment import replay
from workload.views import Tables


def values(df):
    return {r["name"]: [r[c] for c in ("baseline", "model", "n_orders")] for r in df.collect()}


def test_kpis_of_described_and_undescribed_rows_agree(spark, small):
    rows = replay(Tables(spark, small))
    folded, described = values(kpis.kpi_table(rows)), values(kpis.kpi_table(rows.select("*")))
    assert hasattr(rows, "undescribed") and folded.keys() == described.keys() and len(folded) == 4
    for name, row in folded.items():
        assert row == pytest.approx(described[name])


def test_kpis_by_hand(spark):
    """Unknown rates and providers, a town that only one side matches."""
    keys = "dni_empresa string, codigo_tarea string, cd_municipio_destino string"
    lines = [("E1", "T", "11", "P1", "P2"), ("E1", "T", "11", "P1", "P2"), ("E2", "T", "22", "P3", "P2"), ("E3", "T", "22", "P9", "P1")]
    lines = spark.createDataFrame(lines, f"{keys}, dni_prestador_hist string, dni_prestador_model string")
    about = [("P1", "11.0", 0.5, 10.0, 1.0), ("P2", "22", 0.25, None, 1.0), ("P3", None, None, 40.0, 1.0)]
    providers = spark.createDataFrame(about, "DNI_PRESTADOR string, cdmunicipio_base string, tasa_cancela_real_prestador double, costo_logistico_prom double, duracion_promedio_ejecutada double")
    sides = kpis._folded_sides(lines, providers).withColumn("scenario", F.lit("s"))
    got = {r["name"]: (r["baseline"], r["model"], r["n_orders"]) for r in kpis._kpi_values(sides, ["s"]).collect()}
    k1, _, k3, k4 = kpis.K.KPI_GOALS
    assert got[k1] == (0.5, pytest.approx((3 * 0.25 + 0.5) / 4), 4)
    assert got[k3] == (pytest.approx(60 / 3), 10.0, 4)
    assert got[k4] == (0.5, 0.25, 4)
    assert not any(math.isnan(x) for row in got.values() for x in row)


def test_rows_are_not_sent_with_rates_and_costs(spark, small):
    """Rates and costs of both providers were part of every row that was shuffled by pair."""
    t = Tables(spark, small)
    lines, providers = replay(t).undescribed
    tree = plan(kpis._folded_sides(lines, providers))
    sent = [x for x in tree.split("\n\n") if "Exchange\n" in x and "hashpartitioning(side" in x and "cd_municipio_destino" in x]
    assert sent and not any("tasa_cancela" in x or "costo_log" in x for x in sent)


def test_enablings_are_placed_once_for_distinct_and_join(spark, small):
    """They were shuffled to be made distinct and again to meet their provider."""
    from matchwright.plans import recommend as R

    t = Tables(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(R.scored_pairs(WR.catalog(t), WR.eligible(t)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(DNI_PRESTADOR" in text and text.count("hashpartitioning(CDTAREA") == 0


def test_open_order_keys_are_placed_once(spark, small):
    """Order lines were joined again, and keys shuffled for each of two distinct steps."""
    from matchwright import constants as K
    from matchwright.operators import matching as M
    from matchwright.plans import recommend as R

    t = Tables(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(M.set_difference_keys(R.orders_to_score(WR.orders(t)), WR.assigned(t), K.ORDER_KEY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 2 and tree.count("Join") == 1
