"""Cleaned (typed) versions of the five business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions import cleaning as C

DAY, DAY_TIME = "d/M/yyyy", "d/M/yyyy HH:mm:ss"
SQL_DAY, SQL_DAY_TIME = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"

# Column groups of the source tables.
ORDER_DATES = {
    "Fecha_Creacion_Orden": DAY,
    "Fecha_Entrega_Servicio": DAY_TIME,
    "Fecha_Entrega_Servicio_Fin": DAY_TIME,
    "Fecha_Aprobacion_Tarea": DAY_TIME,
}
ORDER_AMOUNTS = (
    "Valor_Costo_Unitario",
    "Valor_Costo_Total_Tarea_Cal",
    "Valor_Costo_Total_Tarea",
    "Valor_Costo_Transporte",
    "Valor_Costo_Viaticos",
    "Numero_Cantidad_Cronograma",
    "Numero_Cantidad_Pedida",
    "Numero_Saldo_Ejecutado",
    "Numero_Saldo_Tarea",
    "Numero_Cantidad_Cancelada",
    "Pct_Cu_Cronograma",
)
ORDER_FLAGS = (
    "Ind_Requiere_Informe",
    "Ind_Informe_Obligatorio",
    "Ind_Liquidar_Transporte",
    "Ind_Reactivacion",
    "Ind_Transporte_Ida",
    "Ind_Compensacion",
)
VISIT_DATES = {
    "FEENTREGA_SERVICIO_INI": "iso",
    "FEENTREGA_SERVICIO_FIN": "iso",
    "FEPROGRAMACION": "iso",
    "FEINGRESO_CUMPLIMIENTO": "iso",
    "FECANCELACION": "iso",
    "FEENVIO_INFORME": "iso",
    "FEAPROBACION_INFORME": "iso",
    "FERECHAZO_INFORME": "iso",
    "FECREACION_OC": SQL_DAY,
    "FECHA_CARGA": SQL_DAY,
}
VISIT_NUMBERS = (
    "NMCANTIDAD_PEDIDA",
    "NMCANTIDAD_PROGRAMADA",
    "DURACION",
    "CANTIDAD_PROGRAMADA_CITA",
    "NMCANTIDAD_EJECUTADA",
    "NMASISTENTES",
)
VISIT_FLAGS = ("SNREQUIERE_INFORME", "SNCANCELA_EMPRESA", "SNAPROBADO_AUTOMATICO", "SNPARCIAL")
CATALOG_DATES = {
    "FEALTA_PRESTADOR": SQL_DAY_TIME,
    "FEC_FIN_COS_TAR": SQL_DAY_TIME,
    "FEALTA_TAREA_PRESTADOR": SQL_DAY_TIME,
    "FEALTA_DIST": SQL_DAY_TIME,
    "FEVALIDACION": SQL_DAY_TIME,
    "FECHA_CARGA": SQL_DAY_TIME,
    "FEC_INI_COS_TAR": "iso",
}
CATALOG_NUMBERS = ("CAPACIDAD", "PTCALIFICACION", "PTVALOR_TAREA")
CATALOG_FLAGS = ("SNCONTROLAR_HORAS_MES", "SNVALIDADO")
COMPANY_DATES = {"Fecha_Inicio_Cobertura": SQL_DAY, "Fecha_Fin_Cobertura": SQL_DAY}
COMPANY_TRUTHS = {"ESTADO_EMPRESA_CALCULADO": "Activa", "Ind_Multiregional": "S", "Afiliados": "Con Afiliados"}
MASTER_DATES = {"fealta": "iso", "febaja": "iso"}
MASTER_FLAGS = ("snrequiereinforme", "sninforme_obligatorio", "snnuevo_modelo")


def _yes(columns) -> dict[str, str]:
    return dict.fromkeys(columns, "S")


def clean_orders(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(C.clean_strings)
        .transform(C.sentinel_to_null)
        .transform(C.drop_malformed, ["Ord_Plan_Vers_Act_Id", "Codigo_Estado_Orden"])
        .transform(C.parse_dates, ORDER_DATES)
        .transform(C.decimal_comma_to_double, ORDER_AMOUNTS)
        .transform(C.flag_to_boolean, _yes(ORDER_FLAGS))
        .transform(C.dedup_exact)
        .transform(C.quality_flags, {"FLAG_PERFIL_DESCONOCIDO": F.col("Perfil_Prestador").isNull()})
    )


def clean_companies(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(C.clean_strings)
        .transform(C.parse_dates, COMPANY_DATES)
        .transform(C.lenient_numeric_cast, ("ID_PROFESIONAL_PPAL", "Numero_Afiliados"), "bigint")
        .transform(C.flag_to_boolean, COMPANY_TRUTHS)
        .transform(C.quality_flags, {"FLAG_SIN_PROFESIONAL": F.col("ID_PROFESIONAL_PPAL") == -1})
    )


def clean_visits(raw: DataFrame) -> DataFrame:
    """No row is dropped: repeated keys are separate visits."""
    negative = F.coalesce(F.col("NMCANTIDAD_EJECUTADA") < 0, F.lit(False))
    return (
        raw.transform(C.clean_strings)
        .transform(C.collapse_newlines, "MOTIVO_CANCELACION")
        .transform(C.recode_values, "DSESTADO_INFORME", K.REPORT_RECODES)
        .transform(C.parse_dates, VISIT_DATES)
        .transform(C.lenient_numeric_cast, VISIT_NUMBERS)
        .transform(C.flag_to_boolean, _yes(VISIT_FLAGS))
        .transform(C.quality_flags, {"FLAG_CANTIDAD_EJECUTADA_NEGATIVA": negative})
    )


def clean_catalog(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(C.clean_strings)
        .transform(C.drop_malformed, ["CDMUNICIPIO"])
        .transform(C.parse_dates, CATALOG_DATES)
        .transform(C.lenient_numeric_cast, CATALOG_NUMBERS)
        .transform(C.flag_to_boolean, _yes(CATALOG_FLAGS))
        .transform(C.dedup_exact)
        .transform(C.quality_flags, {"FLAG_CAPACIDAD_CERO": F.col("CAPACIDAD") == 0})
    )


def clean_master(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(C.clean_strings)
        .transform(C.parse_dates, MASTER_DATES)
        .transform(C.flag_to_boolean, _yes(MASTER_FLAGS))
        .transform(C.quality_flags, {"FLAG_TAREA_ACTIVA": F.col("febaja").isNull()})
    )
