"""Company table: master data, order history and visits received."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions.expr import complexity_level, ratio
from matchwright.operators import aggregates as A
from matchwright.plans.provider_features import _is_cancelled, _is_executed, logistic_cost

COMPANY = "Empresa_Id"


def company_orders(orders: DataFrame) -> DataFrame:
    keyed = orders.withColumnRenamed("Dni_Empresa", COMPANY)
    history = keyed.groupBy(COMPANY).agg(
        A.distinct_with_null("Numero_Consecutivo_Orden").alias("n_oc_historicas"),
        A.distinct_with_null("Codigo_Tarea").alias("n_tareas_distintas_demandadas"),
        A.distinct_with_null("Dni_Prestador").alias("n_prestadores_distintos"),
        A.distinct_with_null("Municipio_Entrega_Desc").alias("n_municipios_servicio"),
        A.sum0("Valor_Costo_Total_Tarea").alias("costo_total_acumulado"),
        F.avg("Valor_Costo_Total_Tarea").alias("costo_total_prom_oc"),
        F.sum(logistic_cost()).alias("costo_logistico_acumulado"),
        F.min("Fecha_Creacion_Orden").alias("fecha_primera_oc"),
        F.max("Fecha_Creacion_Orden").alias("fecha_ultima_oc"),
    )
    usual = A.mode_of(keyed, [COMPANY], "Clasificacion_Desc", "clasificacion_predominante_demanda")
    return history.join(usual, COMPANY, "left")


def company_visits(visits: DataFrame) -> DataFrame:
    done, lost = _is_executed(), _is_cancelled()
    return (
        visits.groupBy(F.col("DNI_EMPRESA").alias(COMPANY))
        .agg(
            F.count(F.lit(1)).alias("n_citas_recibidas_2025"),
            A.count_where(done).alias("n_citas_ejecutadas_2025"),
            A.count_where(lost).alias("n_citas_canceladas_2025"),
            A.count_where(lost & F.col("SNCANCELA_EMPRESA")).alias("n_cancela_como_cliente"),
            A.distinct_with_null("DNI_PRESTADOR").alias("n_prestadores_2025"),
            A.distinct_with_null("CDTAREA").alias("n_tareas_distintas_2025"),
            A.sum0(F.when(done, F.col("DURACION"))).alias("horas_servicio_recibidas_2025"),
        )
    )


def company_table(companies: DataFrame, orders: DataFrame, visits: DataFrame) -> DataFrame:
    joined = companies.join(company_orders(orders), COMPANY, "left").join(company_visits(visits), COMPANY, "left")
    return joined.select(
        "*",
        complexity_level("Ruta_Atencion").alias("nivel_complejidad_calculado"),
        ratio("n_citas_ejecutadas_2025", "n_citas_recibidas_2025").alias("tasa_ejecucion_recibida_2025"),
        ratio("n_cancela_como_cliente", "n_citas_canceladas_2025").alias("tasa_cancela_como_cliente"),
        F.col("n_oc_historicas").isNull().alias("FLAG_SIN_DEMANDA_HISTORICA"),
        (F.col("ESTADO_EMPRESA") != K.COMPANY_WITHDRAWN).alias("FLAG_EMPRESA_ACTIVA"),
    ).select(*K.COMPANY_COLUMNS)
