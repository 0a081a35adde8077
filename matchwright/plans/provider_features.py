"""Provider tables: declared profile, observed performance, and the grouping matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions.expr import ratio, seniority
from matchwright.operators import aggregates as A
from matchwright.session import stage

PROVIDER = "DNI_PRESTADOR"


def _is_field() -> Column:
    return F.col("TIPO_PROGRAMACION") == K.VISIT_FIELD


def _is_executed() -> Column:
    return F.col("DSESTADO_PROGRAMACION").isin(*K.VISIT_EXECUTED)


def _is_cancelled() -> Column:
    return F.col("DSESTADO_PROGRAMACION") == K.VISIT_CANCELLED


# ---- observed performance -------------------------------------------------------------------


# distinct values over field visits: figure -> column
VISITED = {
    "n_ordenes_distintas_prog": "NMCONSECUTIVO_ORDEN",
    "n_empresas_atendidas": "DNI_EMPRESA",
    "n_tareas_distintas_ejecutadas": "CDTAREA",
    "n_municipios_destino": "DS_MUNICIPIO_DESTINO",
}


def visit_kpis(visits: DataFrame) -> DataFrame:
    """Counts, hours and report figures per provider; rates are over field visits only.

    The visits are read twice, so they should be a stored table.
    """
    field, done = _is_field(), _is_field() & _is_executed()
    lost = _is_field() & _is_cancelled()
    by_company = F.coalesce(F.col("SNCANCELA_EMPRESA"), F.lit(False))
    cycle = F.date_diff("FEAPROBACION_INFORME", "FEENVIO_INFORME")
    out = visits.groupBy(PROVIDER).agg(
        F.count(F.lit(1)).alias("n_programaciones_total"),
        A.count_where(field).alias("n_citas_total"),
        A.count_where(done).alias("n_citas_ejecutadas"),
        A.count_where(lost).alias("n_citas_canceladas"),
        A.count_where(lost & by_company).alias("n_cancela_empresa"),
        A.count_where(lost & ~by_company & F.col("MOTIVO_CANCELACION").isNull()).alias("n_cancela_sin_motivo"),
        F.avg(F.when(done, F.col("DURACION"))).alias("duracion_promedio_ejecutada"),
        A.sum0(F.when(done, F.col("DURACION"))).alias("duracion_total_ejecutada"),
        A.count_where(done & F.col("DURACION").isNull()).alias("n_duracion_nula_ejecutadas"),
        F.count("FEENVIO_INFORME").alias("n_informes_enviados"),
        A.count_where(F.col("DSESTADO_INFORME") == K.REPORT_APPROVED).alias("n_informes_aprobados"),
        A.count_where(F.col("SNAPROBADO_AUTOMATICO")).alias("n_aprobados_auto"),
        F.avg(F.when(cycle >= 0, cycle)).alias("dias_ciclo_informe_prom"),
    )
    out = A.with_counts(out, PROVIDER, A.distinct_counts(visits.where(field), [PROVIDER], VISITED))
    first = [PROVIDER, "n_programaciones_total", "n_citas_total", *VISITED]
    out = out.select(*first, *[c for c in out.columns if c not in first])
    return out.withColumn("pct_programaciones_campo", ratio("n_citas_total", "n_programaciones_total"))


def logistic_cost() -> Column:
    zero = F.lit(0.0)
    return F.coalesce(F.col("Valor_Costo_Transporte"), zero) + F.coalesce(F.col("Valor_Costo_Viaticos"), zero)


def order_kpis(orders: DataFrame) -> DataFrame:
    """Lines, orders, mean costs and span of days per provider; the orders are read twice, like the visits above."""
    named = orders.withColumnRenamed("Dni_Prestador", PROVIDER)
    out = named.groupBy(PROVIDER).agg(
        F.count("Ord_Plan_Vers_Act_Id").alias("n_lineas_oc"),
        F.avg(logistic_cost()).alias("costo_logistico_prom"),
        F.avg("Valor_Costo_Total_Tarea").alias("costo_total_tarea_prom"),
        F.min("Fecha_Creacion_Orden").alias("fecha_primera_oc"),
        F.max("Fecha_Creacion_Orden").alias("fecha_ultima_oc"),
    )
    out = A.with_counts(out, PROVIDER, A.distinct_counts(named, [PROVIDER], {"n_oc_historicas": "Numero_Consecutivo_Orden"}))
    return out.select(PROVIDER, "n_lineas_oc", "n_oc_historicas", *[c for c in out.columns if c not in (PROVIDER, "n_lineas_oc", "n_oc_historicas")])


def served_demand(visits: DataFrame, companies: DataFrame) -> DataFrame:
    """Who a provider really serves. Visits are counted per client before the join, so a
    client with very many visits is one row per provider by then."""
    per_client = (
        visits.where(_is_field() & _is_executed())
        .groupBy(PROVIDER, F.col("DNI_EMPRESA").alias("Empresa_Id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    served = per_client.join(
        companies.select("Empresa_Id", "Sector_Economico_Desc", "Segmentacion_Arl_Desc"), "Empresa_Id", "left"
    )
    served = stage(served, "served-demand")  # both modes and the share read it
    sector = A.mode_of(served, [PROVIDER], "Sector_Economico_Desc", "sector_principal_atendido", weight="n")
    segment = A.mode_of(served, [PROVIDER], "Segmentacion_Arl_Desc", "segmento_principal_atendido", weight="n")
    complex_ = F.col("Segmentacion_Arl_Desc").isin(*K.COMPLEX_SEGMENTS)
    share = served.groupBy(PROVIDER).agg(A.share_true(complex_, "n").alias("pct_empresa_compleja"))
    return sector.join(segment, PROVIDER, "left").join(share, PROVIDER, "left")


def performance(visits: DataFrame, orders: DataFrame, companies: DataFrame) -> DataFrame:
    joined = (
        visit_kpis(visits)
        .join(order_kpis(orders), PROVIDER, "left")
        .join(served_demand(visits, companies), PROVIDER, "left")
    )
    visits_total = F.col("n_citas_total")
    by_provider = F.col("n_citas_canceladas") - F.col("n_cancela_empresa")
    documented = F.greatest(by_provider - F.col("n_cancela_sin_motivo"), F.lit(0).cast("bigint"))
    return joined.withColumns(
        {
            "tasa_ejecucion": ratio("n_citas_ejecutadas", visits_total),
            "tasa_cancelacion": ratio("n_citas_canceladas", visits_total),
            "tasa_cancela_empresa": ratio("n_cancela_empresa", visits_total),
            "tasa_aprobacion_informe": ratio("n_informes_aprobados", "n_informes_enviados"),
            "tasa_aprobacion_auto": ratio("n_aprobados_auto", "n_informes_aprobados"),
            "n_cancela_prestador": by_provider,
            "tasa_cancela_prestador": ratio(by_provider, visits_total),
            "n_cancela_real_prestador": documented,
            "tasa_cancela_real_prestador": ratio(documented, visits_total),
        }
    )


# ---- declared profile -------------------------------------------------------------------------

# attribute in the catalog -> name in the profile
ATTRIBUTES = {
    "NOMBRE_PRESTADOR": "nombre_prestador",
    "DNI_DISTRIBUIDOR": "dni_distribuidor",
    "NOMBRE_DISTRIBUIDOR": "nombre_distribuidor",
    "DSTIPO_PERFIL": "tipo_perfil",
    "PERFIL_TARIFA": "perfil_tarifa",
    "FUNCION_PRESTADOR": "funcion_prestador",
    "TIPO_DE_RED": "tipo_red",
    "CDOFICINA": "cdoficina",
    "DSOFICINA": "dsoficina",
    "CAPACIDAD": "capacidad",
    "FLAG_CAPACIDAD_CERO": "sin_capacidad",
    "CDMUNICIPIO": "cdmunicipio_base",
    "DSMUNICIPIO": "municipio_base",
}


# distinct values over the catalog: figure -> column
OFFERED = {
    "n_tareas_distintas": "CDTAREA",
    "n_bloques_distintos": "CDBLOQUE",
    "n_productos_distintos": "CDPRODUCTO",
    "n_redes": "_RED_ORIGEN",
    "n_municipios_cobertura": "CDMUNICIPIO",
}


def profile_base(catalog: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Breadth, network, capacity and tenure of a provider from all of its catalog rows.

    Attributes come from one real row per provider, chosen repeatably. `tasks` (see
    `provider_tasks`) saves a shuffle of the (provider, task) pairs.
    """
    numbers = catalog.groupBy(PROVIDER).agg(
        F.count(F.lit(1)).alias("n_habilitaciones"),
        A.any_true(F.col("TIPO_DE_RED") == K.STRATEGIC_NETWORK).alias("es_red_estrategica"),
        F.min("FEALTA_PRESTADOR").alias("fealta_prestador"),
    )
    left = {name: c for name, c in OFFERED.items() if tasks is None or c != "CDTAREA"}
    numbers = A.with_counts(numbers, PROVIDER, A.distinct_counts(catalog, [PROVIDER], left))
    if tasks is not None:
        numbers = A.with_counts(numbers, PROVIDER, tasks.groupBy(PROVIDER).agg(A.count_where(F.col("first")).alias("n_tareas_distintas")))
    numbers = numbers.select(PROVIDER, "n_habilitaciones", *OFFERED, "es_red_estrategica", "fealta_prestador")
    named = A.representative_row(catalog, [PROVIDER], list(ATTRIBUTES)).withColumnsRenamed(ATTRIBUTES)
    return numbers.join(named, PROVIDER, "left")


def main_theme(catalog: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    themes = catalog.select(PROVIDER, "CDTAREA", "CDBLOQUE", "DSBLOQUE").distinct() if tasks is None else tasks
    per_theme = themes.groupBy(PROVIDER, "CDBLOQUE", "DSBLOQUE").agg(F.count(F.lit(1)).alias("n"))
    best = A._first_of(
        [PROVIDER], [F.desc("n"), F.asc_nulls_last("CDBLOQUE"), F.asc_nulls_last("DSBLOQUE")], per_theme
    )
    return best.select(
        PROVIDER,
        F.col("CDBLOQUE").alias("cdbloque_principal"),
        F.col("DSBLOQUE").alias("bloque_principal"),
        F.col("n").alias("n_tareas_bloque_principal"),
    )


def provider_tasks(catalog: DataFrame, master: DataFrame) -> DataFrame:
    """Distinct (provider, task, theme) with what the task master says: nuevo, activa, tratamiento, etapa and whether it is known.

    `first` marks one row per (provider, task). Stored, as the counts, the shares, the main
    theme and the most frequent stage all read it; placed by task once, all steps stay in place.
    """
    per_task = master.groupBy(F.col("cdtarea").alias("CDTAREA")).agg(
        A.any_true(F.col("snnuevo_modelo")).alias("nuevo"),
        A.any_true(F.col("FLAG_TAREA_ACTIVA")).alias("activa"),
        A.any_true(F.col("cdetapa_gestion") == K.STAGE_TREATMENT).alias("tratamiento"),
        F.min("cdetapa_gestion").alias("etapa"),
        F.lit(True).alias("known"),
    )
    themes = catalog.select(PROVIDER, "CDTAREA", "CDBLOQUE", "DSBLOQUE").repartition("CDTAREA").distinct()
    place = F.row_number().over(W.partitionBy("CDTAREA", PROVIDER).orderBy("CDBLOQUE", "DSBLOQUE"))
    return stage(themes.withColumn("first", place == 1).join(per_task, "CDTAREA", "left"), "provider-tasks")


def master_enrichment(catalog: DataFrame, master: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Share of new-model and treatment tasks, and active tasks, each task counted once."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    tasks = provider_tasks(catalog, master) if tasks is None else tasks
    return tasks.where("first").groupBy(PROVIDER).agg(
        A.share_true(known("nuevo")).alias("pct_tareas_nuevo_modelo"),
        A.share_true(known("tratamiento")).alias("pct_tareas_tratamiento"),
        A.count_where(F.col("activa")).cast("int").alias("n_tareas_con_maestro"),
    )


def stage_mode(catalog: DataFrame, master: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Most frequent management stage over a provider's distinct tasks; unknown stages do not vote."""
    tasks = provider_tasks(catalog, master) if tasks is None else tasks
    return A.mode_of(tasks.where(F.col("first") & F.col("known")), [PROVIDER], "etapa", "etapa_predominante", keep_null=False)


def profile(catalog: DataFrame, master: DataFrame, cutoff: str = K.TENURE_CUTOFF) -> DataFrame:
    tasks = provider_tasks(catalog, master)
    blocks = [
        A.mode_of(catalog, [PROVIDER], "DSCLASIFICACION", "clasificacion_predominante"),
        main_theme(catalog, tasks),
        master_enrichment(catalog, master, tasks),
        stage_mode(catalog, master, tasks),
    ]
    out = profile_base(catalog, tasks)
    for block in blocks:
        out = out.join(block, PROVIDER, "left")
    return out.withColumns(
        {
            "indice_especializacion": ratio("n_tareas_bloque_principal", "n_tareas_distintas"),
            "antiguedad_dias": F.date_diff(F.lit(cutoff).cast("date"), F.col("fealta_prestador")),
        }
    )


# ---- master supply table ------------------------------------------------------------------------

def join_profile_performance(profile_table: DataFrame, performance_table: DataFrame) -> DataFrame:
    out = profile_table.join(performance_table, PROVIDER, "left")
    return out.select(
        "*",
        ratio("n_municipios_destino", "n_municipios_cobertura").alias("ratio_cobertura_real"),
        ratio("duracion_total_ejecutada", "capacidad").alias("utilizacion_capacidad"),
        F.col("n_citas_total").isNull().alias("FLAG_SIN_ACTIVIDAD_2025"),
        (F.col("n_citas_total") == 0).alias("FLAG_SOLO_VIRTUAL_2025"),
    ).select(*K.PROVIDER_COLUMNS)


def provider_table(catalog, master, visits, orders, companies, cutoff: str = K.TENURE_CUTOFF) -> DataFrame:
    return join_profile_performance(profile(catalog, master, cutoff), performance(visits, orders, companies))


def grouping_matrix(providers: DataFrame) -> DataFrame:
    """Active providers with complete numeric features and their context."""
    active = providers.where(~F.col("FLAG_SIN_ACTIVIDAD_2025"))
    coded = active.withColumns(
        {
            "tipo_perfil_ord": seniority("tipo_perfil"),
            "es_red_estrategica": F.col("es_red_estrategica").cast("double"),
        }
    )
    typed = coded.select(PROVIDER, *[F.col(c).cast("double").alias(c) for c in K.FEATURES], *K.CONTEXT)
    return typed.transform(A.impute_zero, K.ZERO_WHEN_MISSING).transform(A.impute_median, K.MEDIAN_WHEN_MISSING)
