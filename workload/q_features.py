"""Composed feature tables."""

from matchwright.plans import company_features as CF
from matchwright.plans import provider_features as PF
from workload.registry import orders, providers, query, visits
from workload.views import Tables

VISIT_D = ["duracion_promedio_ejecutada", "duracion_total_ejecutada", "dias_ciclo_informe_prom", "pct_programaciones_campo"]
ORDER_D = ["costo_logistico_prom", "costo_total_tarea_prom"]
ORDER_T = ["fecha_primera_oc", "fecha_ultima_oc"]
DEMAND_D = ["pct_empresa_compleja"]
RATE_D = [
    "tasa_ejecucion",
    "tasa_cancelacion",
    "tasa_cancela_empresa",
    "tasa_aprobacion_informe",
    "tasa_aprobacion_auto",
    "tasa_cancela_prestador",
    "tasa_cancela_real_prestador",
]
PERF_D = VISIT_D + ORDER_D + DEMAND_D + RATE_D
PROFILE_D = ["capacidad", "pct_tareas_nuevo_modelo", "pct_tareas_tratamiento", "indice_especializacion"]


@query("feat_visit_kpis", "SELECT * FROM o_visit", rounds=VISIT_D)
def feat_visit_kpis(t: Tables):
    return PF.visit_kpis(visits(t))


@query("feat_order_kpis", "SELECT * FROM o_orders", rounds=ORDER_D, dates=ORDER_T)
def feat_order_kpis(t: Tables):
    return PF.order_kpis(orders(t))


@query("feat_served_demand", "SELECT * FROM o_demand", rounds=DEMAND_D)
def feat_served_demand(t: Tables):
    return PF.served_demand(visits(t), t.companies)


@query("feat_performance", "SELECT * FROM o_perf", rounds=PERF_D, dates=ORDER_T)
def feat_performance(t: Tables):
    return PF.performance(visits(t), orders(t), t.companies)


@query("feat_profile_base", "SELECT * FROM o_base", rounds=["capacidad"], dates=["fealta_prestador"])
def feat_profile_base(t: Tables):
    return PF.profile_base(t.catalog)


@query("feat_master_enrichment", "SELECT * FROM o_master", rounds=["pct_tareas_nuevo_modelo", "pct_tareas_tratamiento"])
def feat_master_enrichment(t: Tables):
    return PF.master_enrichment(t.catalog, t.master)


@query("feat_stage_mode", "SELECT * FROM o_stage")
def feat_stage_mode(t: Tables):
    return PF.stage_mode(t.catalog, t.master)


@query("feat_profile", "SELECT * FROM o_profile", rounds=PROFILE_D, dates=["fealta_prestador"])
def feat_profile(t: Tables):
    return PF.profile(t.catalog, t.master)


@query(
    "feat_provider",
    "SELECT * FROM o_provider",
    rounds=PERF_D + PROFILE_D + ["utilizacion_capacidad", "ratio_cobertura_real"],
    dates=["fealta_prestador", *ORDER_T],
)
def feat_provider(t: Tables):
    return PF.provider_table(t.catalog, t.master, visits(t), orders(t), t.companies)


COMPANY_D = ["costo_total_acumulado", "costo_total_prom_oc", "costo_logistico_acumulado"]


@query("feat_company_orders", "SELECT * FROM o_corders", rounds=COMPANY_D, dates=ORDER_T, digits=4)
def feat_company_orders(t: Tables):
    return CF.company_orders(orders(t))


@query("feat_company_visits", "SELECT * FROM o_cvisits", rounds=["horas_servicio_recibidas_2025"])
def feat_company_visits(t: Tables):
    return CF.company_visits(visits(t))


@query(
    "feat_company",
    "SELECT * FROM o_company",
    rounds=COMPANY_D + ["horas_servicio_recibidas_2025", "tasa_ejecucion_recibida_2025", "tasa_cancela_como_cliente"],
    dates=["Fecha_Inicio_Cobertura", "Fecha_Fin_Cobertura", *ORDER_T],
    digits=4,
)
def feat_company(t: Tables):
    return CF.company_table(t.companies, orders(t), visits(t))


@query("clustering_input", "SELECT * FROM o_matrix", rounds=list(PF.K.FEATURES))
def clustering_input(t: Tables):
    return PF.grouping_matrix(providers(t))
