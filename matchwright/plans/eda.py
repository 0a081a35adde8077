"""Exploratory reports over the source tables (the data behind charts, not the charts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions.cleaning import lenient
from matchwright.operators import aggregates as A
from matchwright.operators.ranks import exact_percentiles, lorenz_summary


def indicators(tables: dict[str, tuple[DataFrame, dict[str, object]]]) -> DataFrame:
    """indicador, valor. Each table is read once however many indicators it feeds."""
    parts = []
    for df, wanted in tables.values():
        row = df.agg(*[c.cast("bigint").alias(n) for n, c in wanted.items()])
        parts.append(row.unpivot([], list(wanted), "indicador", "valor"))
    return reduce(DataFrame.unionByName, parts)


def operation_size(catalog: DataFrame, companies: DataFrame, orders: DataFrame, visits: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return indicators(
        {
            "catalog": (
                catalog,
                {
                    "prestadores": A.distinct_with_null("DNI_PRESTADOR"),
                    "distribuidores": A.distinct_with_null("DNI_DISTRIBUIDOR"),
                    "oficinas": A.distinct_with_null("DSOFICINA"),
                    "tareas": A.distinct_with_null("CDTAREA"),
                    "productos": A.distinct_with_null("CDPRODUCTO"),
                    "bloques": A.distinct_with_null("CDBLOQUE"),
                },
            ),
            "companies": (
                companies,
                {
                    "empresas": A.distinct_with_null("Empresa_Id"),
                    "empresas_activas": A.count_where(F.col("ESTADO_EMPRESA_CALCULADO")),
                },
            ),
            "orders": (orders, {"ordenes": rows}),
            "visits": (visits, {"programaciones": rows}),
        }
    )


def coverage_gap(catalog: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct towns with supply, distinct towns of delivery and the difference."""
    supply = catalog.agg(A.distinct_with_null("CDMUNICIPIO").alias("s")).scalar()
    return orders.agg(A.distinct_with_null("Municipio_Entrega_Id").alias("municipios_entrega")).select(
        supply.cast("bigint").alias("municipios_base"),
        F.col("municipios_entrega").cast("bigint").alias("municipios_entrega"),
        (F.col("municipios_entrega") - supply).cast("bigint").alias("brecha"),
    )


def cancel_overview(visits: DataFrame) -> DataFrame:
    """Cancelled share of all visits and who cancelled."""
    lost = F.col("DSESTADO_PROGRAMACION") == K.VISIT_CANCELLED
    return visits.agg(
        F.count(F.lit(1)).alias("total"),
        A.count_where(lost).alias("canceladas"),
        A.count_where(lost & F.col("SNCANCELA_EMPRESA")).alias("por_empresa"),
        A.count_where(lost & ~F.col("SNCANCELA_EMPRESA")).alias("internas"),
    ).withColumn("tasa", F.try_divide("canceladas", "total"))


def cancel_rate_by_provider(visits: DataFrame, at_least: int = 10) -> DataFrame:
    """Providers with enough visits. One conditional count replaces the join of two counts."""
    counted = visits.groupBy("DNI_PRESTADOR").agg(
        F.count(F.lit(1)).alias("total"),
        A.count_where(F.col("DSESTADO_PROGRAMACION") == K.VISIT_CANCELLED).alias("canceladas"),
    )
    # a null provider never meets its own cancellations in an equi-join
    lost = F.when(F.col("DNI_PRESTADOR").isNull(), F.lit(0)).otherwise(F.col("canceladas"))
    return (
        counted.where(F.col("total") >= at_least)
        .withColumn("canceladas", lost.cast("bigint"))
        .withColumn("tasa_cancel", F.col("canceladas") / F.col("total"))
    )


def report_rejection(visits: DataFrame) -> DataFrame:
    known = visits.where(F.col("DSESTADO_INFORME").isNotNull())
    return known.agg(
        F.count(F.lit(1)).alias("informes"),
        A.count_where(F.col("DSESTADO_INFORME").isin(*K.REPORT_REJECTED)).alias("rechazados"),
    ).withColumn("tasa_rechazo", F.try_divide("rechazados", "informes"))


def capacity_by_provider(catalog: DataFrame) -> DataFrame:
    """Capacity of one real row and the number of enablements per provider."""
    rows = catalog.groupBy("DNI_PRESTADOR").agg(F.count(F.lit(1)).alias("habilitaciones"))
    return rows.join(A.representative_row(catalog, ["DNI_PRESTADOR"], ["CAPACIDAD"]), "DNI_PRESTADOR", "left").select(
        "DNI_PRESTADOR", F.col("CAPACIDAD").alias("capacidad"), "habilitaciones"
    )


def plausible_durations(visits: DataFrame, low: float = 0.0, high: float = 24.0) -> DataFrame:
    """Durations above `low` and at most `high` after a lenient cast."""
    hours = lenient(F.col("DURACION").cast("string"), "double")
    return visits.select(hours.alias("dur")).where((F.col("dur") > low) & (F.col("dur") <= high))


def loads_by_provider(orders: DataFrame) -> DataFrame:
    return orders.groupBy("Dni_Prestador").agg(F.count(F.lit(1)).alias("n_ordenes"))


def problem_summary(catalog: DataFrame, orders: DataFrame, visits: DataFrame, companies: DataFrame) -> DataFrame:
    """problema, medida, valor: the figures behind the six problem statements."""
    loads = loads_by_provider(orders)

    def block(problem: str, row: DataFrame, names: list[str]) -> DataFrame:
        cast = row.select(*[F.col(n).cast("double").alias(n) for n in names])
        return cast.unpivot([], names, "medida", "valor").select(F.lit(problem).alias("problema"), "medida", "valor")

    spread = loads.agg(F.max("n_ordenes").alias("max")).withColumn(
        "mediana", exact_percentiles(loads, [], "n_ordenes", {"m": 0.5}).scalar()
    )
    routes = companies.agg(
        A.count_where(F.col("Ruta_Atencion") == K.ROUTE_NONE).alias("sin_ruta"), F.count(F.lit(1)).alias("empresas")
    )
    mode = visits.agg(
        A.count_where(F.col("TIPO_PROGRAMACION") == K.VISIT_FIELD).alias("campo"), F.count(F.lit(1)).alias("total")
    )
    overview = cancel_overview(visits)
    parts = [
        block("#1", lorenz_summary(loads, "n_ordenes"), ["gini", "top_share"]),
        block("#1", spread, ["max", "mediana"]),
        block("#2", overview, ["canceladas", "total", "tasa"]),
        block("#3", overview, ["internas", "por_empresa"]),
        block("#4", coverage_gap(catalog, orders), ["municipios_base", "municipios_entrega", "brecha"]),
        block("#5", routes, ["sin_ruta", "empresas"]),
        block("#6", mode, ["campo", "total"]),
    ]
    return reduce(DataFrame.unionByName, parts)
