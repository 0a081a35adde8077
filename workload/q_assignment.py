"""Candidate pool, scoring, assignment and the reports on it."""

from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions import expr as X
from matchwright.operators import matching as M
from matchwright.plans import eda
from matchwright.plans import kpis as P
from matchwright.plans import recommend as R
from matchwright.operators import profiling as PR
from matchwright.session import scratch_path, stage
from matchwright.sources import store as ST
from workload.registry import (
    assigned,
    capped,
    capped_rows,
    catalog,
    first_choice,
    matrix,
    orders,
    providers,
    query,
    recommended,
    second_choice,
    settled,
    signed_lists,
)
from workload.sqlparts import ARCHETYPE, LOST, TOTAL, gini
from workload.views import Tables

SCORES = ["score_total", "score_specialization", "score_capacity", "score_geo", "score_performance", "utilizacion_capacidad"]
POOL = [
    "utilizacion_capacidad",
    "tasa_ejecucion",
    "tasa_cancela_real_prestador",
    "capacidad",
    "tipo_perfil_ord",
    "score_performance",
    "score_capacity",
    "capacidad_catalog",
]


def pool(t: Tables):
    return R.candidate_pool(catalog(t), providers(t), matrix(t), t.clusters)


@query("candidate_pool", "SELECT * FROM o_pool", rounds=POOL)
def candidate_pool(t: Tables):
    return pool(t)


@query("town_lookup", "SELECT * FROM o_towns")
def town_lookup(t: Tables):
    return R.town_lookup(catalog(t), R.eligible_providers(providers(t), matrix(t), t.clusters))


@query("orders_to_score", "SELECT * FROM o_toscore")
def orders_to_score(t: Tables):
    return R.orders_to_score(t.orders)


@query(
    "score_components",
    "SELECT dni_empresa, codigo_tarea, cd_municipio_destino, rank, score_specialization, score_capacity, score_geo, score_performance FROM o_top10",
    rounds=SCORES[1:5],
)
def score_components(t: Tables):
    return recommended(t, columns=[*K.ORDER_KEY, "rank", *SCORES[1:5]])


@query(
    "score_total",
    f"SELECT dni_empresa, codigo_tarea, cd_municipio_destino, rank, {TOTAL} AS score_total FROM o_top10",
    rounds=["score_total"],
)
def score_total(t: Tables):
    scores = recommended(t, columns=[*K.ORDER_KEY, "rank", *SCORES[1:5]])
    return scores.select(*K.ORDER_KEY, "rank", X.total_score().alias("score_total"))


@query("recommend_top10", "SELECT * FROM o_top10", rounds=SCORES)
def recommend_top10(t: Tables):
    return recommended(t)


@query("assignments_rule_based", "SELECT * FROM o_assign", rounds=SCORES)
def assignments_rule_based(t: Tables):
    return R.require_rows(assigned(t), "assignments")


def shown(c: str) -> str:
    """A figure as the reason in words shows it: rounded half up in decimals."""
    return f"cast(cast(round(cast(coalesce({c}, 0) AS decimal(28,12)), 2) AS double) AS string)"


REASON = (
    f"coalesce({ARCHETYPE}, '(sin nombre)') || ' · perfil=' || coalesce(tipo_perfil, '?') || ' · util=' || {shown('utilizacion_capacidad')} "
    f"|| ' · exec=' || {shown('tasa_ejecucion')} || ' · cancel=' || {shown('tasa_cancela_real_prestador')}"
)

ONE = (
    "SELECT DNI_PRESTADOR, score_total, score_specialization, score_capacity, score_geo, score_performance, cluster_id, {a} AS archetype_name, tipo_perfil, "
    "capacidad, utilizacion_capacidad, dni_distribuidor, nombre_distribuidor, {r} AS rationale FROM (SELECT y.*, {t} AS score_total FROM ("
    "SELECT p.*, 0.6::double + CASE WHEN coalesce(tipo_perfil_ord, 3.0) >= {need} THEN 0.4::double ELSE 0.0::double END AS score_specialization, "
    "CASE WHEN EXISTS (SELECT 1 FROM o_towns t WHERE t.CDTAREA = p.CDTAREA AND t.DNI_PRESTADOR = p.DNI_PRESTADOR AND t.CDMUNICIPIO = '1111') THEN 1.0::double "
    "WHEN EXISTS (SELECT 1 FROM o_depts t WHERE t.CDTAREA = p.CDTAREA AND t.DNI_PRESTADOR = p.DNI_PRESTADOR AND t.dept = '11') THEN 0.4::double ELSE 0.0::double END AS score_geo "
    "FROM o_pool p WHERE CDTAREA = 'T11' {gate}) y) ORDER BY score_total DESC, DNI_PRESTADOR LIMIT 10"
)


def one(t: Tables, **how):
    eligible = R.eligible_providers(providers(t), matrix(t), t.clusters)
    return R.score_one_order(catalog(t), eligible, "T11", "1111.0", **how)


@query("score_one_order", ONE.format(a=ARCHETYPE, t=TOTAL, r=REASON, need="5.0", gate=""), rounds=[*SCORES, "capacidad"])
def score_one_order(t: Tables):
    return one(t, segment="GRAN EMPRESA")


@query(
    "score_one_order_light_route",
    ONE.format(a=ARCHETYPE, t=TOTAL, r=REASON, need="3.0", gate="AND cluster_id = 3"),
    rounds=[*SCORES, "capacidad"],
)
def score_one_order_light_route(t: Tables):
    return one(t, route="LIVIANA")


@query(
    "score_one_order_company",
    ONE.format(
        a=ARCHETYPE,
        t=TOTAL,
        r=REASON,
        need="(SELECT CASE WHEN Segmentacion_Arl_Desc IN ('Gran Empresa','Mediana Empresa') THEN 5.0 ELSE 3.0 END FROM fx_empresa WHERE Empresa_Id = 'E8')",
        gate="AND (cluster_id = 3 OR (SELECT coalesce(Ruta_Atencion, '') <> 'LIVIANA' FROM fx_empresa WHERE Empresa_Id = 'E8'))",
    ),
    rounds=[*SCORES, "capacidad"],
)
def score_one_order_company(t: Tables):
    return one(t, company="E8", companies=t.companies)


@query("serve_one_order", ONE.format(a=ARCHETYPE, t=TOTAL, r=REASON, need="5.0", gate=""), rounds=[*SCORES, "capacidad"])
def serve_one_order(t: Tables):
    """The same call from the stored index: one bucket is read, nothing is joined."""
    eligible = R.eligible_providers(providers(t), matrix(t), t.clusters)
    index = R.store_serving_index(R.serving_index(catalog(t), eligible), scratch_path(t.spark, "serving"))
    return index.score("T11", "1111.0", segment="GRAN EMPRESA")


@query(
    "capacity_cap",
    "SELECT n_orders, n_providers, cast(ceil(1.5 * n_orders / greatest(n_providers, 1)) AS bigint) AS cap FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT dni_empresa, codigo_tarea, cd_municipio_destino FROM o_top10)) AS n_orders, "
    "(SELECT count(DISTINCT dni_prestador) FROM o_top10) AS n_providers)",
)
def capacity_cap(t: Tables):
    return M.capacity_cap_of_lists(signed_lists(t))


@query("assign_capacitated")
def assign_capacitated(t: Tables):
    return capped_rows(t, settled(t).where(~F.col("overflow"))).drop("overflow")


@query("assign_overflow_fallback")
def assign_overflow_fallback(t: Tables):
    return capped(t).where(F.col("overflow"))


@query(
    "assign_capacitated_stability",
    "SELECT (SELECT count(*) FROM (SELECT DISTINCT dni_empresa, codigo_tarea, cd_municipio_destino FROM o_top10)) AS n_orders, "
    "0::bigint AS n_above_cap, 0::bigint AS n_blocking",
)
def assign_capacitated_stability(t: Tables):
    """Under one strict order the stable matching is unique: every order once, nobody above the
    cap, and no order and listed provider that both prefer each other to what they have."""
    key = list(K.ORDER_KEY)
    # the result next to the candidates that an order would rather have: all ahead of its own, or all if it has none
    mine = F.struct(*[F.get("cands", "at")[c].alias(c) for c in ("loss", "provider")])
    have = F.when(~F.col("overflow"), mine)
    wanted = F.filter("cands", lambda c: have.isNull() | (F.struct(c["loss"].alias("loss"), c["provider"].alias("provider")) < have))
    slot = F.pmod("sig_a", F.lit(M.SLOTS)).alias("slot")
    done = stage(settled(t).select(*key, "sig_a", "sig_b", slot, have.alias("have"), wanted.alias("wanted")), "stability")
    cap = M.capacity_cap_of_lists(signed_lists(t)).select("cap").scalar()
    standing = [F.col(c) for c in ("slot", "sig_a", "sig_b")]
    held = done.where(F.col("have").isNotNull())
    loads = held.groupBy(F.col("have.provider").alias("provider")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(F.col("have.loss").alias("loss"), *standing)).alias("worst")
    )
    pairs = done.select(*standing, F.explode("wanted").alias("c")).select("c.provider", F.struct(F.col("c.loss").alias("loss"), *standing).alias("standing"))
    met = pairs.join(loads, "provider", "left")
    takes = F.col("n").isNull() | (F.col("n") < cap) | (F.col("standing") < F.col("worst"))
    keys = done.select(*key).distinct().agg(F.count(F.lit(1))).scalar()
    above = loads.where(F.col("n") > cap).agg(F.count(F.lit(1))).scalar()
    return met.agg(keys.alias("n_orders"), above.alias("n_above_cap"), F.count_if(takes).alias("n_blocking"))


@query(
    "assign_capacitated_totals",
    "SELECT 'lp_optimized' AS scenario, (SELECT count(*) FROM o_assign) AS n_orders, true AS within_cap",
)
def assign_capacitated_totals(t: Tables):
    """Every order once; no provider above the cap except by overflow."""
    done = capped(t)
    loads = done.where(~F.col("overflow")).groupBy("dni_prestador").agg(F.count(F.lit(1)).alias("n"))
    peak = loads.agg(F.max("n")).scalar()
    cap = M.capacity_cap_of_lists(signed_lists(t)).select("cap").scalar()
    keys = done.select(*K.ORDER_KEY).distinct().agg(F.count(F.lit(1))).scalar()
    rows = done.groupBy("scenario").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("scenario", keys.alias("n_orders"), ((peak <= cap) & (F.col("rows") == keys)).alias("within_cap"))


@query(
    "contribution_shares",
    """SELECT dni_empresa, codigo_tarea, cd_municipio_destino, rank,
    CASE WHEN a >= b AND a >= c AND a >= d THEN 'Especialización' WHEN b >= c AND b >= d THEN 'Capacidad' WHEN c >= d THEN 'Geográfico' ELSE 'Desempeño' END AS top_contributor,
    CASE WHEN score_total > 0 THEN least(greatest(a / score_total, 0), 1) END AS spec_share, CASE WHEN score_total > 0 THEN least(greatest(b / score_total, 0), 1) END AS cap_share,
    CASE WHEN score_total > 0 THEN least(greatest(c / score_total, 0), 1) END AS geo_share, CASE WHEN score_total > 0 THEN least(greatest(d / score_total, 0), 1) END AS perf_share
    FROM (SELECT *, 0.45::double * score_specialization AS a, 0.30::double * score_capacity AS b, 0.15::double * score_geo AS c, 0.10::double * score_performance AS d FROM o_top10)""",
    rounds=["spec_share", "cap_share", "geo_share", "perf_share"],
)
def contribution_shares(t: Tables):
    return R.enrich(recommended(t)).select(*K.ORDER_KEY, "rank", "top_contributor", "spec_share", "cap_share", "geo_share", "perf_share")


# ---- KPIs and monitoring -----------------------------------------------------------------------

REPLAY_D = [
    "Valor_Costo_Transporte",
    "Valor_Costo_Viaticos",
    "Numero_Cantidad_Pedida",
    "util_model",
    "tasa_cancela_hist",
    "tasa_cancela_model",
    "costo_log_hist",
    "costo_log_model",
    "duracion_hist",
    "duracion_model",
]
KPI_D = ["baseline", "model", "delta_abs", "delta_rel", "target"]


def replay(t: Tables):
    return P.replay_table(orders(t), assigned(t), providers(t))


@query("replay_table", "SELECT * FROM o_replay", rounds=REPLAY_D)
def replay_table(t: Tables):
    return replay(t)


def _one_kpi(name: str, key: str):
    @query(name, f"SELECT * FROM o_kpis WHERE name = '{key}'", rounds=KPI_D)
    def kpi(t: Tables):
        return P.kpi_table(replay(t)).where(F.col("name") == key)


_one_kpi("kpi_cancellation", "K1_tasa_cancelacion_esperada")
_one_kpi("kpi_gini", "K2_gini_carga")
_one_kpi("kpi_logistic_cost", "K3_costo_logistico_esperado")
_one_kpi("kpi_geo_match", "K4_match_geografico")


@query("kpis_summary", "SELECT * FROM o_kpis", rounds=KPI_D)
def kpis_summary(t: Tables):
    return P.kpis_summary(orders(t), {"rule_based": assigned(t)}, providers(t))


@query("kpis_summary_two_scenarios")
def kpis_summary_two_scenarios(t: Tables):
    return P.kpis_summary(orders(t), {"rule_based": first_choice(t), "lp_optimized": capped(t)}, providers(t))


LIGHT = "CASE WHEN isc <= 0.85 THEN 'Normal (Verde)' WHEN isc <= 1.0 THEN 'Alerta (Amarillo)' ELSE 'Crítico (Rojo)' END"
SATURATION = f"""SELECT cluster_id, coalesce({ARCHETYPE}, 'Sin nombre') AS archetype_name, scenario, n_providers, median_capacidad, capacidad_estimada, tareas_asignadas, isc,
    {LIGHT} AS estado_saturacion, cast(CASE WHEN isc > 1.0 THEN ceil(tareas_asignadas / median_capacidad) - n_providers ELSE 0 END AS bigint) AS prestadores_necesarios
    FROM (SELECT l.cluster_id, l.scenario, l.tareas_asignadas, c.n_providers, c.median_capacidad, c.capacidad_estimada, l.tareas_asignadas / c.capacidad_estimada AS isc FROM (
      SELECT cluster_id, 'rule_based' AS scenario, count(*) AS tareas_asignadas FROM o_assign GROUP BY 1 UNION ALL SELECT cluster_id, 'second' AS scenario, count(*) FROM o_second GROUP BY 1) l
    LEFT JOIN o_cap c ON l.cluster_id = c.cluster_id)"""


@query("saturation_index", SATURATION, rounds=["median_capacidad", "capacidad_estimada", "isc"])
def saturation_index(t: Tables):
    scenarios = {"rule_based": assigned(t), "second": second_choice(t)}
    return P.saturation_index(scenarios, t.clusters, providers(t)).drop("computed_at")


_CHECKS = f"""SELECT 'rule_based' AS scenario, 'rows_conserved' AS check,
    (SELECT count(*) FILTER (WHERE cluster_id IS NOT NULL AND cluster_id <> -1) + count(*) FILTER (WHERE cluster_id = -1) + count(*) FILTER (WHERE cluster_id IS NULL) FROM o_assign) AS observed,
    (SELECT count(*) FROM o_assign) AS expected
    UNION ALL SELECT 'rule_based', 'capacity_positive', (SELECT count(*) FILTER (WHERE coalesce(capacidad_estimada, 0) <= 0) FROM o_cap), 0
    UNION ALL SELECT 'rule_based', 'not_empty', (SELECT cast(count(*) > 0 AS bigint) FROM o_assign), 1
    UNION ALL SELECT 'rule_based', 'index_known', (SELECT count(*) FILTER (WHERE isc IS NULL) FROM ({SATURATION}) WHERE scenario = 'rule_based'), 0
    UNION ALL SELECT 'rule_based', 'common_orders', (SELECT cast(count(*) = 0 AS bigint) FROM o_scen), 0
    UNION ALL SELECT 'rule_based', 'gini_rule_based_in_range', (SELECT cast({gini('(SELECT count(*) AS n FROM o_scen GROUP BY p_rb)', 'n')} NOT BETWEEN 0 AND 1 AS bigint)), 0
    UNION ALL SELECT 'rule_based', 'gini_lp_optimized_in_range', (SELECT cast({gini('(SELECT count(*) AS n FROM o_scen GROUP BY p_lp)', 'n')} NOT BETWEEN 0 AND 1 AS bigint)), 0"""


@query("conservation_checks", f"SELECT *, observed = expected AS ok FROM ({_CHECKS})")
def conservation_checks(t: Tables):
    scenarios = {"rule_based": assigned(t), "second": second_choice(t)}
    index = P.saturation_index(scenarios, t.clusters, providers(t))
    difference = P.scenario_diff(assigned(t), second_choice(t), providers(t))
    checks = P.conservation_checks(assigned(t), P.cluster_capacity(t.clusters, providers(t)), "rule_based")
    return P.enforce(checks.unionByName(P.published_checks(index, difference, "rule_based")))


@query("publish_saturation", SATURATION, rounds=["median_capacidad", "capacidad_estimada", "isc"])
def publish_saturation(t: Tables):
    """The saturation table through the store: its rules are counted while it is written, the version is shown only if they hold."""
    scenarios = {"rule_based": assigned(t), "second": second_choice(t)}
    path = scratch_path(t.spark, "published")
    ST.write_replace(P.saturation_index(scenarios, t.clusters, providers(t)), path, P.saturation_rules())
    return ST.read_stored(t.spark, path).drop("computed_at")


@query(
    "scenario_diff",
    f"""SELECT n AS n_orders_compared, n_rb - n AS n_orders_only_in_rule_based, nr AS n_reassigned, nr / cast(n AS double) AS pct_reassigned, g1 AS gini_load_rule_based, g2 AS gini_load_lp_optimized,
    g2 - g1 AS gini_delta_abs, CASE WHEN g1 > 1e-9 THEN (g2 - g1) / g1 END AS gini_delta_rel, s1 AS score_total_mean_rule_based, s2 AS score_total_mean_lp_optimized, sd AS score_delta_mean,
    p25 AS score_delta_p25, p50 AS score_delta_p50, p75 AS score_delta_p75, k1 AS costo_log_mean_rule_based, k2 AS costo_log_mean_lp_optimized, k2 - k1 AS costo_log_delta_abs,
    (k2 - k1) * n AS cost_savings_annual_cop, z1 AS n_costo_log_null_rb, z2 AS n_costo_log_null_lp FROM (
    SELECT count(*) AS n, (SELECT count(*) FROM o_assign) AS n_rb, count(*) FILTER (WHERE p_rb <> p_lp) AS nr,
    {gini('(SELECT count(*) AS n FROM o_scen GROUP BY p_rb)', 'n')} AS g1, {gini('(SELECT count(*) AS n FROM o_scen GROUP BY p_lp)', 'n')} AS g2,
    avg(s_rb) AS s1, avg(s_lp) AS s2, avg(sd) AS sd, quantile_cont(sd, 0.25) AS p25, quantile_cont(sd, 0.5) AS p50, quantile_cont(sd, 0.75) AS p75,
    coalesce(avg(k_rb), 0) AS k1, coalesce(avg(k_lp), 0) AS k2, count(*) FILTER (WHERE k_rb IS NULL) AS z1, count(*) FILTER (WHERE k_lp IS NULL) AS z2 FROM o_scen)""",
    rounds=[
        c
        for c in K.SCENARIO_COLUMNS
        if c not in ("n_orders_compared", "n_orders_only_in_rule_based", "n_reassigned", "n_costo_log_null_rb", "n_costo_log_null_lp", "computed_at")
    ],
    digits=5,
)
def scenario_diff(t: Tables):
    return P.scenario_diff(assigned(t), second_choice(t), providers(t)).drop("computed_at")


@query("scenario_diff_capacitated")
def scenario_diff_capacitated(t: Tables):
    return P.scenario_diff(first_choice(t), capped(t), providers(t)).drop("computed_at")


BY_CLUSTER = f"""SELECT cluster_id, {ARCHETYPE} AS archetype_name, n_orders, x AS n_reassigned_to_other_cluster, x / cast(n_orders AS double) AS pct_reassigned_to_other_cluster,
    w AS n_reassigned_to_same_cluster_diff_provider, mean_score_delta, mean_cost_delta FROM (SELECT c_rb AS cluster_id, count(*) AS n_orders, count(*) FILTER (WHERE c_rb <> c_lp) AS x,
    count(*) FILTER (WHERE p_rb <> p_lp AND c_rb = c_lp) AS w, avg(sd) AS mean_score_delta, avg(kd) AS mean_cost_delta FROM o_scen GROUP BY 1)"""


@query("scenario_diff_by_cluster", BY_CLUSTER, rounds=["pct_reassigned_to_other_cluster", "mean_score_delta", "mean_cost_delta"])
def scenario_diff_by_cluster(t: Tables):
    return P.scenario_diff_by_cluster(assigned(t), second_choice(t), providers(t)).drop("computed_at")


@query(
    "topk_hit_rate",
    """SELECT count(*) AS n_pairs, count(h.dni_prestador) AS n_hits, count(h.dni_prestador) / cast(count(*) AS double) AS hit_rate FROM (
    SELECT DISTINCT Dni_Empresa AS e, Codigo_Tarea AS k, regexp_replace(Municipio_Entrega_Id, '\\.0$', '') AS m, Dni_Prestador AS p FROM fx_ordenado) a
    JOIN o_assign s ON a.e = s.dni_empresa AND a.k = s.codigo_tarea AND a.m = s.cd_municipio_destino
    LEFT JOIN (SELECT * FROM o_top10 WHERE rank <= 5) h ON a.e = h.dni_empresa AND a.k = h.codigo_tarea AND a.m = h.cd_municipio_destino AND a.p = h.dni_prestador""",
    rounds=["hit_rate"],
)
def topk_hit_rate(t: Tables):
    return R.hit_rate(orders(t), recommended(t, 5), 5)


# ---- profiles and exploratory reports --------------------------------------------------------------

# The columns of the visit view.
VISIT_COLUMNS = (
    "NMCONSECUTIVO_ORDEN",
    "DNI_PRESTADOR",
    "DNI_EMPRESA",
    "CDTAREA",
    "DS_MUNICIPIO_DESTINO",
    "CLASIFICACION",
    "TIPO_DE_ASESOR",
    "TIPO_PROGRAMACION",
    "DSESTADO_PROGRAMACION",
    "SNCANCELA_EMPRESA",
    "MOTIVO_CANCELACION",
    "DURACION",
    "FEPROGRAMACION",
    "FEENVIO_INFORME",
    "FEAPROBACION_INFORME",
    "DSESTADO_INFORME",
    "SNAPROBADO_AUTOMATICO",
)


@query(
    "profile_nulls",
    " UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) AS nulos FROM fx_citas WHERE {c} IS NULL HAVING count(*) > 0" for c in VISIT_COLUMNS),
)
def profile_nulls(t: Tables):
    return PR.profile_nulls(t.visits)


@query(
    "profile_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS columna, min(v) AS minimo, max(v) AS maximo, count(*) FILTER (WHERE v = 0) AS ceros, count(*) FILTER (WHERE v < 0) AS negativos, count(*) FILTER (WHERE v IS NULL) AS nulos "
        f"FROM (SELECT try_cast(regexp_replace({c}, ',', '.') AS double) AS v FROM {src})"
        for c, src in (("DURACION", "fx_raw_citas"), ("NMCANTIDAD_EJECUTADA", "fx_raw_citas"))
    ),
    rounds=["minimo", "maximo"],
)
def profile_numeric(t: Tables):
    return PR.profile_numeric(t.view("fx_raw_citas"), ["DURACION", "NMCANTIDAD_EJECUTADA"])


CATS = ["DSESTADO_PROGRAMACION", "DSESTADO_INFORME", "TIPO_PROGRAMACION"]


@query("profile_categorical", " UNION ALL ".join(f"SELECT '{c}' AS columna, {c} AS valor, count(*) AS n FROM fx_citas GROUP BY 2" for c in CATS))
def profile_categorical(t: Tables):
    return PR.profile_categorical(t.visits, CATS)


@query(
    "profile_text",
    "SELECT count(*) FILTER (WHERE MOTIVO_CANCELACION IS NULL) AS nulos, count(*) FILTER (WHERE MOTIVO_CANCELACION = '') AS vacios, count(DISTINCT MOTIVO_CANCELACION) + 1 AS distintos FROM fx_citas",
)
def profile_text(t: Tables):
    return PR.profile_text(t.visits, "MOTIVO_CANCELACION")


@query(
    "profile_duplicates",
    "SELECT (SELECT cast(coalesce(sum(n), 0) AS bigint) FROM (SELECT count(*) AS n FROM fx_citas GROUP BY NMCONSECUTIVO_ORDEN, DNI_PRESTADOR HAVING count(*) > 1)) AS por_llave, "
    f"(SELECT cast(coalesce(sum(n), 0) AS bigint) FROM (SELECT count(*) AS n FROM fx_citas GROUP BY {', '.join(VISIT_COLUMNS)} HAVING count(*) > 1)) AS exactas",
)
def profile_duplicates(t: Tables):
    return PR.profile_duplicates(t.visits, ["NMCONSECUTIVO_ORDEN", "DNI_PRESTADOR"])


@query(
    "eda_cancel_rate_by_provider",
    f"SELECT DNI_PRESTADOR, count(*) AS total, count(*) FILTER (WHERE {LOST}) AS canceladas, count(*) FILTER (WHERE {LOST}) / cast(count(*) AS double) AS tasa_cancel FROM fx_citas GROUP BY 1 HAVING count(*) >= 10",
    rounds=["tasa_cancel"],
)
def eda_cancel_rate_by_provider(t: Tables):
    return eda.cancel_rate_by_provider(t.visits)


@query(
    "eda_coverage_gap",
    "SELECT s AS municipios_base, d AS municipios_entrega, d - s AS brecha FROM (SELECT (SELECT count(DISTINCT CDMUNICIPIO) FROM fx_catalogo) AS s, (SELECT count(DISTINCT Municipio_Entrega_Id) FROM fx_ordenado) AS d)",
)
def eda_coverage_gap(t: Tables):
    return eda.coverage_gap(t.catalog, t.orders)


@query(
    "eda_cancel_overview",
    f"SELECT count(*) AS total, count(*) FILTER (WHERE {LOST}) AS canceladas, count(*) FILTER (WHERE {LOST} AND SNCANCELA_EMPRESA) AS por_empresa, count(*) FILTER (WHERE {LOST} AND NOT SNCANCELA_EMPRESA) AS internas, "
    f"count(*) FILTER (WHERE {LOST}) / cast(count(*) AS double) AS tasa FROM fx_citas",
    rounds=["tasa"],
)
def eda_cancel_overview(t: Tables):
    return eda.cancel_overview(t.visits)


@query(
    "eda_report_rejection",
    "SELECT count(*) AS informes, count(*) FILTER (WHERE DSESTADO_INFORME IN ('RECHAZADO','RE')) AS rechazados, count(*) FILTER (WHERE DSESTADO_INFORME IN ('RECHAZADO','RE')) / cast(count(*) AS double) AS tasa_rechazo FROM fx_citas WHERE DSESTADO_INFORME IS NOT NULL",
    rounds=["tasa_rechazo"],
)
def eda_report_rejection(t: Tables):
    return eda.report_rejection(t.visits)


@query(
    "eda_capacity_by_provider",
    "SELECT DNI_PRESTADOR, min(CAPACIDAD) AS capacidad, count(*) AS habilitaciones FROM fx_catalogo GROUP BY 1",
    rounds=["capacidad"],
)
def eda_capacity_by_provider(t: Tables):
    return eda.capacity_by_provider(t.catalog)


@query(
    "eda_problem_summary",
    f"""SELECT '#1' AS problema, 'max' AS medida, cast(max(n) AS double) AS valor FROM (SELECT count(*) AS n FROM fx_ordenado GROUP BY Dni_Prestador)
    UNION ALL SELECT '#1', 'mediana', median(n) FROM (SELECT count(*) AS n FROM fx_ordenado GROUP BY Dni_Prestador)
    UNION ALL SELECT '#1', 'gini', 1 - 2 * area FROM (SELECT sum(CASE WHEN i > 1 THEN (c + pc) / 2 / n END) AS area FROM (SELECT i, n, c, lag(c) OVER (ORDER BY i) AS pc FROM (SELECT row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n,
      sum(v) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(v) OVER () AS c FROM (SELECT cast(count(*) AS double) AS v FROM fx_ordenado GROUP BY Dni_Prestador))))
    UNION ALL SELECT '#1', 'top_share', 1 - max(CASE WHEN i = floor(0.9 * n) + 1 THEN c END) FROM (SELECT row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n,
      sum(v) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(v) OVER () AS c FROM (SELECT cast(count(*) AS double) AS v FROM fx_ordenado GROUP BY Dni_Prestador))
    UNION ALL SELECT '#2', 'canceladas', count(*) FILTER (WHERE {LOST}) FROM fx_citas UNION ALL SELECT '#2', 'total', count(*) FROM fx_citas
    UNION ALL SELECT '#2', 'tasa', count(*) FILTER (WHERE {LOST}) / cast(count(*) AS double) FROM fx_citas
    UNION ALL SELECT '#3', 'internas', count(*) FILTER (WHERE {LOST} AND NOT SNCANCELA_EMPRESA) FROM fx_citas UNION ALL SELECT '#3', 'por_empresa', count(*) FILTER (WHERE {LOST} AND SNCANCELA_EMPRESA) FROM fx_citas
    UNION ALL SELECT '#4', 'municipios_base', count(DISTINCT CDMUNICIPIO) FROM fx_catalogo UNION ALL SELECT '#4', 'municipios_entrega', count(DISTINCT Municipio_Entrega_Id) FROM fx_ordenado
    UNION ALL SELECT '#4', 'brecha', (SELECT count(DISTINCT Municipio_Entrega_Id) FROM fx_ordenado) - (SELECT count(DISTINCT CDMUNICIPIO) FROM fx_catalogo)
    UNION ALL SELECT '#5', 'sin_ruta', count(*) FILTER (WHERE Ruta_Atencion = 'SIN RUTA') FROM fx_empresa UNION ALL SELECT '#5', 'empresas', count(*) FROM fx_empresa
    UNION ALL SELECT '#6', 'campo', count(*) FILTER (WHERE TIPO_PROGRAMACION = 'CAMPO') FROM fx_citas UNION ALL SELECT '#6', 'total', count(*) FROM fx_citas""",
    rounds=["valor"],
)
def eda_problem_summary(t: Tables):
    return eda.problem_summary(t.catalog, t.orders, t.visits, t.companies)


# ---- the documented dashboard queries ---------------------------------------------------------------


def _sql(t: Tables, text: str, **frames):
    return t.spark.sql(text, **frames)


@query(
    "consumer_recommendations",
    """SELECT dni_empresa, rank, dni_prestador, score_total, score_specialization, score_capacity, score_geo, score_performance, archetype_name, tipo_perfil, utilizacion_capacidad
    FROM o_top10 WHERE codigo_tarea = 'T11' AND cd_municipio_destino = '1111' ORDER BY dni_empresa, rank""",
    rounds=SCORES,
)
def consumer_recommendations(t: Tables):
    return _sql(
        t,
        "SELECT dni_empresa, rank, dni_prestador, score_total, score_specialization, score_capacity, score_geo, score_performance, archetype_name, tipo_perfil, utilizacion_capacidad FROM {recs} "
        "WHERE codigo_tarea = 'T11' AND cd_municipio_destino = '1111' ORDER BY dni_empresa, rank",
        recs=recommended(t),
    )


@query(
    "consumer_kpis",
    "SELECT name, scenario, status, round(baseline, 4) AS baseline, round(model, 4) AS model, round(delta_rel, 3) AS delta_rel FROM o_kpis ORDER BY name, scenario",
    rounds=["baseline", "model", "delta_rel"],
)
def consumer_kpis(t: Tables):
    return _sql(
        t,
        "SELECT name, scenario, status, round(baseline, 4) AS baseline, round(model, 4) AS model, round(delta_rel, 3) AS delta_rel FROM {kpis} ORDER BY name, scenario",
        kpis=P.kpi_table(replay(t)),
    )


@query(
    "consumer_saturation",
    f"SELECT cluster_id, archetype_name, scenario, round(isc, 3) AS isc, estado_saturacion, tareas_asignadas, round(capacidad_estimada, 0) AS capacidad_estimada FROM ({SATURATION}) ORDER BY scenario, cluster_id",
    rounds=["isc", "capacidad_estimada"],
)
def consumer_saturation(t: Tables):
    table = P.saturation_index({"rule_based": assigned(t), "second": second_choice(t)}, t.clusters, providers(t))
    return _sql(
        t,
        "SELECT cluster_id, archetype_name, scenario, round(isc, 3) AS isc, estado_saturacion, tareas_asignadas, round(capacidad_estimada, 0) AS capacidad_estimada FROM {sat} ORDER BY scenario, cluster_id",
        sat=table,
    )


@query(
    "consumer_assignment",
    "SELECT dni_empresa, dni_prestador, score_total, score_specialization, score_capacity, score_geo, score_performance, archetype_name, cd_municipio_destino, tipo_perfil, nombre_distribuidor FROM o_assign WHERE codigo_tarea = 'T11'",
    rounds=SCORES[:5],
)
def consumer_assignment(t: Tables):
    return _sql(
        t,
        "SELECT dni_empresa, dni_prestador, score_total, score_specialization, score_capacity, score_geo, score_performance, archetype_name, cd_municipio_destino, tipo_perfil, nombre_distribuidor FROM {a} WHERE codigo_tarea = 'T11'",
        a=R.assignments(recommended(t, 1)),  # one task is asked for: nothing is stored for all of them
    )


@query(
    "consumer_enriched",
    """SELECT dni_empresa, cd_municipio_destino, rank, dni_prestador, score_total, CASE WHEN a >= b AND a >= c AND a >= d THEN 'Especialización' WHEN b >= c AND b >= d THEN 'Capacidad'
    WHEN c >= d THEN 'Geográfico' ELSE 'Desempeño' END AS top_contributor, round(least(a / score_total, 1), 2) AS pct_especializacion, round(least(b / score_total, 1), 2) AS pct_capacidad,
    round(least(c / score_total, 1), 2) AS pct_geografico, round(least(d / score_total, 1), 2) AS pct_desempeno, archetype_name, tipo_perfil
    FROM (SELECT *, 0.45::double * score_specialization AS a, 0.30::double * score_capacity AS b, 0.15::double * score_geo AS c, 0.10::double * score_performance AS d FROM o_top10) WHERE codigo_tarea = 'T11' ORDER BY rank""",
    rounds=["score_total", "pct_especializacion", "pct_capacidad", "pct_geografico", "pct_desempeno"],
)
def consumer_enriched(t: Tables):
    return _sql(
        t,
        "SELECT r.dni_empresa, r.cd_municipio_destino, r.rank, r.dni_prestador, r.score_total, r.top_contributor, round(r.spec_share, 2) AS pct_especializacion, round(r.cap_share, 2) AS pct_capacidad, "
        "round(r.geo_share, 2) AS pct_geografico, round(r.perf_share, 2) AS pct_desempeno, r.archetype_name, r.tipo_perfil FROM {e} r WHERE r.codigo_tarea = 'T11' ORDER BY rank",
        e=R.enrich(recommended(t)),
    )


@query(
    "consumer_by_cluster",
    f"""SELECT cluster_id, archetype_name, n_orders, round(pct_reassigned_to_other_cluster, 4) AS pct_cross_cluster, n_reassigned_to_same_cluster_diff_provider AS within_cluster_swaps,
    round(mean_score_delta, 4) AS delta_score, round(mean_cost_delta, 0) AS delta_cost_cop FROM ({BY_CLUSTER}) ORDER BY cluster_id""",
    rounds=["pct_cross_cluster", "delta_score", "delta_cost_cop"],
    digits=3,
)
def consumer_by_cluster(t: Tables):
    """Which groups gain from the second scenario."""
    return _sql(
        t,
        "SELECT cluster_id, archetype_name, n_orders, round(pct_reassigned_to_other_cluster, 4) AS pct_cross_cluster, n_reassigned_to_same_cluster_diff_provider AS within_cluster_swaps, "
        "round(mean_score_delta, 4) AS delta_score, round(mean_cost_delta, 0) AS delta_cost_cop FROM {d} ORDER BY cluster_id",
        d=P.scenario_diff_by_cluster(assigned(t), second_choice(t), providers(t)),
    )
