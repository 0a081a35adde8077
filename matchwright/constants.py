"""Fixed values. Results depend on them, so they are stated plainly and in one place."""

# Visit vocabulary.
VISIT_FIELD = "CAMPO"
VISIT_CANCELLED = "CITA CANCELADA"
VISIT_EXECUTED = ("CITA EJECUTADA", "PARCIALMENTE EJECUTADO", "PARCIALMENTE COMPLETADO")
REPORT_APPROVED = "APROBADO"
REPORT_RECODES = {"AP": "APROBADO", "PA": "PRE-APROBADO", "RE": "RECHAZADO"}
REPORT_REJECTED = ("RECHAZADO", "RE")

# Demand vocabulary.
COMPLEX_SEGMENTS = ("Gran Empresa", "Mediana Empresa")
ROUTES_SPECIALISED = ("AVANZADA", "ESPECIALIZADA")
ROUTES_STANDARD = ("ESTÁNDAR", "INTERVENCIÓN")
ROUTE_NONE = "SIN RUTA"
ROUTE_LIGHT = "LIVIANA"
COMPANY_WITHDRAWN = "RETIRADO"
STAGE_TREATMENT = "TRA"
STRATEGIC_NETWORK = "ESTRATEGICA"
TENURE_CUTOFF = "2026-04-08"

# Seniority scale.
SENIORITY = {
    "BASICO": 1,
    "TECNOLOGO": 2,
    "INTERMEDIO": 3,
    "PROFESIONAL": 4,
    "AVANZADO": 5,
    "EXPERTO": 6,
    "ESPECIALISTA": 7,
}

# Segment tokens that mark an order as complex or as served remotely.
COMPLEX_TOKENS = ("GRAN", "MEDIANA", "CORPORATIVO")
REMOTE_TOKENS = ("INDEPENDIENTE", "MICRO", "EMPRESA NUEVA")

# Scoring.
WEIGHT_SPECIALISATION = 0.45
WEIGHT_CAPACITY = 0.30
WEIGHT_GEOGRAPHY = 0.15
WEIGHT_PERFORMANCE = 0.10
SENIORITY_COMPLEX = 5.0
SENIORITY_DEFAULT = 3.0
REMOTE_CLUSTER = 3
MAX_UTILISATION = 1.5
TOP_N = 10
CAPACITY_HEADROOM = 1.5

# Group names.
NOISE_CLUSTER = -1
ARCHETYPES = {
    -1: "Excepciones / Routing Manual",
    0: "Generalistas Estratégicos de Alto Volumen",
    1: "Especialistas Regionales Multi-Municipio",
    2: "Locales Sub-Utilizados Solo-Campo",
    3: "Virtuales Especializados (Canal LIVIANA)",
}
UNNAMED = "Sin nombre"

# KPI goals, (kind, goal); "lower" goals compare delta_rel, "higher" delta_abs.
KPI_GOALS = {
    "K1_tasa_cancelacion_esperada": ("lower", "relative", -0.15),
    "K2_gini_carga": ("lower", "relative", -0.10),
    "K3_costo_logistico_esperado": ("lower", "relative", -0.05),
    "K4_match_geografico": ("higher", "absolute", 0.10),
}

# Saturation lights.
SATURATION_GREEN = 0.85
SATURATION_YELLOW = 1.0
LIGHT_GREEN = "Normal (Verde)"
LIGHT_YELLOW = "Alerta (Amarillo)"
LIGHT_RED = "Crítico (Rojo)"

# The numeric features of a provider that enter the grouping model.
FEATURES = (
    "n_tareas_distintas",
    "n_bloques_distintos",
    "indice_especializacion",
    "tipo_perfil_ord",
    "pct_tareas_nuevo_modelo",
    "pct_tareas_tratamiento",
    "n_municipios_destino",
    "tasa_ejecucion",
    "tasa_cancela_real_prestador",
    "tasa_aprobacion_informe",
    "dias_ciclo_informe_prom",
    "duracion_promedio_ejecutada",
    "n_citas_total",
    "n_empresas_atendidas",
    "utilizacion_capacidad",
    "pct_programaciones_campo",
    "costo_logistico_prom",
    "es_red_estrategica",
    "antiguedad_dias",
)
HEAVY_TAILED = (
    "n_citas_total",
    "n_empresas_atendidas",
    "costo_logistico_prom",
    "antiguedad_dias",
    "dias_ciclo_informe_prom",
    "duracion_promedio_ejecutada",
    "n_municipios_destino",
    "utilizacion_capacidad",
)
ZERO_WHEN_MISSING = (
    "tasa_cancela_real_prestador",
    "tasa_aprobacion_informe",
    "duracion_promedio_ejecutada",
    "utilizacion_capacidad",
    "pct_programaciones_campo",
    "costo_logistico_prom",
    "n_municipios_destino",
    "es_red_estrategica",
    "pct_tareas_nuevo_modelo",
    "pct_tareas_tratamiento",
)
MEDIAN_WHEN_MISSING = ("dias_ciclo_informe_prom", "tipo_perfil_ord", "antiguedad_dias")

# Model settings.
PCA_VARIANCE = 0.90
K_RANGE = tuple(range(3, 11))
KMEANS_RESTARTS = 20
SEED = 42
CONTAMINATION = 0.03
MIN_CLUSTER_SIZE = 100
MIN_KEPT_CLUSTERS = 3

# Order key of every assignment table.
ORDER_KEY = ("dni_empresa", "codigo_tarea", "cd_municipio_destino")

# Column order of the published provider table.
PROVIDER_COLUMNS = (
    "DNI_PRESTADOR",
    "nombre_prestador",
    "dni_distribuidor",
    "nombre_distribuidor",
    "tipo_perfil",
    "perfil_tarifa",
    "funcion_prestador",
    "clasificacion_predominante",
    "n_habilitaciones",
    "n_tareas_distintas",
    "n_bloques_distintos",
    "n_productos_distintos",
    "bloque_principal",
    "cdbloque_principal",
    "n_tareas_bloque_principal",
    "indice_especializacion",
    "pct_tareas_nuevo_modelo",
    "pct_tareas_tratamiento",
    "n_tareas_con_maestro",
    "etapa_predominante",
    "tipo_red",
    "es_red_estrategica",
    "cdoficina",
    "dsoficina",
    "n_redes",
    "cdmunicipio_base",
    "municipio_base",
    "n_municipios_cobertura",
    "capacidad",
    "sin_capacidad",
    "antiguedad_dias",
    "fealta_prestador",
    "n_programaciones_total",
    "n_citas_total",
    "pct_programaciones_campo",
    "n_citas_ejecutadas",
    "n_citas_canceladas",
    "n_cancela_empresa",
    "n_cancela_prestador",
    "n_cancela_sin_motivo",
    "n_cancela_real_prestador",
    "tasa_ejecucion",
    "tasa_cancelacion",
    "tasa_cancela_empresa",
    "tasa_cancela_prestador",
    "tasa_cancela_real_prestador",
    "duracion_promedio_ejecutada",
    "duracion_total_ejecutada",
    "n_duracion_nula_ejecutadas",
    "n_empresas_atendidas",
    "n_tareas_distintas_ejecutadas",
    "n_municipios_destino",
    "sector_principal_atendido",
    "segmento_principal_atendido",
    "pct_empresa_compleja",
    "n_informes_enviados",
    "n_informes_aprobados",
    "n_aprobados_auto",
    "tasa_aprobacion_informe",
    "tasa_aprobacion_auto",
    "dias_ciclo_informe_prom",
    "n_lineas_oc",
    "n_oc_historicas",
    "n_ordenes_distintas_prog",
    "costo_logistico_prom",
    "costo_total_tarea_prom",
    "fecha_primera_oc",
    "fecha_ultima_oc",
    "utilizacion_capacidad",
    "ratio_cobertura_real",
    "FLAG_SIN_ACTIVIDAD_2025",
    "FLAG_SOLO_VIRTUAL_2025",
)

# Descriptive columns carried next to the features.
CONTEXT = (
    "bloque_principal",
    "clasificacion_predominante",
    "tipo_perfil",
    "tipo_red",
    "municipio_base",
    "dsoficina",
    "nombre_distribuidor",
    "sector_principal_atendido",
    "segmento_principal_atendido",
    "etapa_predominante",
    "n_tareas_con_maestro",
)

# Column order of the published company table.
COMPANY_COLUMNS = (
    "Empresa_Id",
    "ESTADO_EMPRESA_CALCULADO",
    "ESTADO_EMPRESA",
    "Fecha_Inicio_Cobertura",
    "Fecha_Fin_Cobertura",
    "Segmentacion_Arl_Desc",
    "Sector_Economico_Desc",
    "Actividad_Economica_Desc",
    "Ind_Afiliada",
    "Afiliados",
    "Numero_Afiliados",
    "Ind_Multiregional",
    "Ruta_Atencion",
    "nivel_complejidad_calculado",
    "GRUPO_ECONOMICO_ARL_ID",
    "UEN_PPAL_ARL_ID",
    "ID_PROFESIONAL_PPAL",
    "FLAG_SIN_PROFESIONAL",
    "n_oc_historicas",
    "n_tareas_distintas_demandadas",
    "n_prestadores_distintos",
    "n_municipios_servicio",
    "clasificacion_predominante_demanda",
    "costo_total_acumulado",
    "costo_total_prom_oc",
    "costo_logistico_acumulado",
    "fecha_primera_oc",
    "fecha_ultima_oc",
    "n_citas_recibidas_2025",
    "n_citas_ejecutadas_2025",
    "n_citas_canceladas_2025",
    "n_cancela_como_cliente",
    "n_prestadores_2025",
    "n_tareas_distintas_2025",
    "horas_servicio_recibidas_2025",
    "tasa_ejecucion_recibida_2025",
    "tasa_cancela_como_cliente",
    "FLAG_SIN_DEMANDA_HISTORICA",
    "FLAG_EMPRESA_ACTIVA",
)

# Column order of the published scenario comparison.
SCENARIO_COLUMNS = (
    "n_orders_compared",
    "n_orders_only_in_rule_based",
    "n_reassigned",
    "pct_reassigned",
    "gini_load_rule_based",
    "gini_load_lp_optimized",
    "gini_delta_abs",
    "gini_delta_rel",
    "score_total_mean_rule_based",
    "score_total_mean_lp_optimized",
    "score_delta_mean",
    "score_delta_p25",
    "score_delta_p50",
    "score_delta_p75",
    "costo_log_mean_rule_based",
    "costo_log_mean_lp_optimized",
    "costo_log_delta_abs",
    "cost_savings_annual_cop",
    "n_costo_log_null_rb",
    "n_costo_log_null_lp",
    "computed_at",
)

# Descriptive columns of the published group table.
CLUSTER_CONTEXT = (
    "bloque_principal",
    "tipo_perfil",
    "tipo_red",
    "municipio_base",
    "sector_principal_atendido",
    "segmento_principal_atendido",
    "etapa_predominante",
)
