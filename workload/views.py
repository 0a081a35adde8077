"""Business tables derived from the driver's tables, as SQL that Spark and DuckDB both read.

`{name}` stands for a driver table. Spark gets a parquet path in its place, DuckDB the name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VISITS = """
SELECT cast(l.l_orderkey AS string) AS NMCONSECUTIVO_ORDEN,
       'P' || cast(l.l_suppkey AS string) AS DNI_PRESTADOR,
       'E' || cast(o.o_custkey AS string) AS DNI_EMPRESA,
       'T' || cast(l.l_partkey AS string) AS CDTAREA,
       'M' || cast(c.c_nationkey AS string) AS DS_MUNICIPIO_DESTINO,
       CASE l.l_partkey % 4 WHEN 0 THEN ' economy' WHEN 1 THEN 'Large ' WHEN 2 THEN 'PROMO' ELSE 'Small' END AS CLASIFICACION,
       CASE l.l_partkey % 6 WHEN 0 THEN 'Asesor prevencion' WHEN 1 THEN 'Prevención y riesgos' WHEN 2 THEN 'Linea de atencion'
            WHEN 3 THEN 'Proyectos' WHEN 4 THEN 'Asesor integral' ELSE NULL END AS TIPO_DE_ASESOR,
       CASE WHEN l.l_suppkey % 10 = 7 OR l.l_linenumber > 5 THEN 'INFORME' ELSE 'CAMPO' END AS TIPO_PROGRAMACION,
       CASE WHEN l.l_returnflag = 'R' THEN 'CITA CANCELADA'
            WHEN l.l_returnflag = 'A' THEN 'CITA EJECUTADA'
            WHEN l.l_linestatus = 'F' THEN 'PARCIALMENTE EJECUTADO'
            ELSE 'CITA PROGRAMADA' END AS DSESTADO_PROGRAMACION,
       CASE WHEN l.l_returnflag = 'R' THEN l.l_linestatus = 'F' ELSE NULL END AS SNCANCELA_EMPRESA,
       CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber % 2 = 0
            THEN 'motivo ' || cast(l.l_linenumber AS string) ELSE NULL END AS MOTIVO_CANCELACION,
       CASE WHEN l.l_linenumber = 3 THEN NULL ELSE l.l_quantity END AS DURACION,
       cast(l.l_shipdate AS date) AS FEPROGRAMACION,
       CASE WHEN l.l_linestatus = 'F' THEN cast(l.l_shipdate AS date) ELSE NULL END AS FEENVIO_INFORME,
       CASE WHEN l.l_linestatus = 'F' AND o.o_orderpriority <> '5-LOW'
            THEN cast(l.l_shipdate AS date) + (l.l_linenumber - 2) ELSE NULL END AS FEAPROBACION_INFORME,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'APROBADO' WHEN '2-HIGH' THEN 'PRE-APROBADO'
            WHEN '3-MEDIUM' THEN 'APROBADO' WHEN '4-NOT SPECIFIED' THEN 'RECHAZADO' ELSE NULL END AS DSESTADO_INFORME,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE l.l_tax < 0.04 END AS SNAPROBADO_AUTOMATICO
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
WHERE l.l_suppkey % 25 <> 9
"""

ORDERS = """
SELECT cast(l.l_orderkey AS string) || '-' || cast(l.l_linenumber AS string) || '-' || cast(l.l_partkey AS string) AS Ord_Plan_Vers_Act_Id,
       cast(l.l_orderkey AS string) AS Numero_Consecutivo_Orden,
       'E' || cast(o.o_custkey AS string) AS Dni_Empresa,
       'P' || cast(l.l_suppkey AS string) AS Dni_Prestador,
       'T' || cast(l.l_partkey AS string) AS Codigo_Tarea,
       cast(1000 + c.c_nationkey * 37 AS string) || '.0' AS Municipio_Entrega_Id,
       'M' || cast(c.c_nationkey AS string) AS Municipio_Entrega_Desc,
       CASE WHEN l.l_linenumber = 4 THEN 'Micro Empresa'
            WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'GRAN EMPRESA' WHEN c.c_mktsegment = 'BUILDING' THEN 'Mediana Empresa'
            WHEN c.c_mktsegment = 'FURNITURE' THEN NULL WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Independiente'
            ELSE 'CORPORATIVO' END AS Macrosegmentacion_Desc,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_returnflag || l.l_linestatus END AS Clasificacion_Desc,
       CASE WHEN l.l_quantity < 2 THEN 'ESPECIAL' WHEN l.l_quantity < 20 THEN 'APOYO' WHEN l.l_quantity < 48 THEN 'ESTRATEGICA'
            ELSE NULL END AS Tipo_Red_Desc,
       'R' || cast(c.c_nationkey % 7 AS string) AS Nombre_Regional,
       o.o_orderstatus AS Estado_Orden_Desc,
       cast(o.o_orderdate AS date) AS Fecha_Creacion_Orden,
       l.l_extendedprice AS Valor_Costo_Total_Tarea,
       CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_discount * 1000 END AS Valor_Costo_Transporte,
       CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_tax * 1000 END AS Valor_Costo_Viaticos,
       l.l_quantity AS Numero_Cantidad_Pedida
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

CATALOG = """
SELECT DISTINCT 'P' || cast(l.l_suppkey AS string) AS DNI_PRESTADOR,
       s.s_name AS NOMBRE_PRESTADOR,
       'D' || cast(l.l_suppkey % 7 AS string) AS DNI_DISTRIBUIDOR,
       CASE WHEN l.l_suppkey % 7 = 3 THEN NULL ELSE 'Firma ' || cast(l.l_suppkey % 7 AS string) END AS NOMBRE_DISTRIBUIDOR,
       'T' || cast(l.l_partkey AS string) AS CDTAREA,
       'B' || cast(p.p_size % 9 AS string) AS CDBLOQUE,
       CASE p.p_size % 9 WHEN 0 THEN 'Herramientas' WHEN 1 THEN 'Lectura del entorno' WHEN 2 THEN 'Educación'
            WHEN 3 THEN 'Informacion y datos' WHEN 4 THEN 'Evento' WHEN 5 THEN 'Cultura' WHEN 6 THEN 'Gestion estrategica'
            WHEN 7 THEN NULL ELSE 'Varios' END AS DSBLOQUE,
       p.p_brand AS CDPRODUCTO,
       CASE WHEN p.p_type = 'PROMO' THEN NULL ELSE p.p_type END AS DSCLASIFICACION,
       CASE l.l_suppkey % 8 WHEN 0 THEN 'BASICO' WHEN 1 THEN 'TECNOLOGO' WHEN 2 THEN 'INTERMEDIO'
            WHEN 3 THEN 'PROFESIONAL' WHEN 4 THEN 'AVANZADO' WHEN 5 THEN 'EXPERTO'
            WHEN 6 THEN 'ESPECIALISTA' ELSE 'OTROS' END AS DSTIPO_PERFIL,
       CASE l.l_suppkey % 5 WHEN 0 THEN 'Prevencion' WHEN 1 THEN 'Riesgos y proyectos' WHEN 2 THEN 'Línea de atención'
            WHEN 3 THEN '' ELSE NULL END AS FUNCION_PRESTADOR,
       CASE l.l_suppkey % 6 WHEN 0 THEN 'O' WHEN 1 THEN 'P' WHEN 2 THEN 'A' WHEN 3 THEN 'T' WHEN 4 THEN 'B' ELSE NULL END AS PERFIL_TARIFA,
       CASE l.l_suppkey % 3 WHEN 0 THEN 'ESTRATEGICA' WHEN 1 THEN 'APOYO' ELSE NULL END AS TIPO_DE_RED,
       'O' || cast(s.s_nationkey % 6 AS string) AS CDOFICINA,
       'OFICINA ' || r.r_name AS DSOFICINA,
       cast(1000 + ((s.s_nationkey + l.l_partkey % 3) % 25) * 37 AS string) AS CDMUNICIPIO,
       'M' || cast((s.s_nationkey + l.l_partkey % 3) % 25 AS string) AS DSMUNICIPIO,
       CASE WHEN s.s_acctbal < 500 THEN 0.0 ELSE s.s_acctbal * 2 END AS CAPACIDAD,
       coalesce(s.s_acctbal < 500, false) AS FLAG_CAPACIDAD_CERO,
       p.p_retailprice AS PTVALOR_TAREA,
       r.r_name AS _RED_ORIGEN,
       CASE WHEN l.l_suppkey % 11 = 5 THEN NULL ELSE cast('2015-01-01' AS date) + cast(l.l_suppkey % 3000 AS int) END AS FEALTA_PRESTADOR
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

MASTER = """
SELECT 'T' || cast(p_partkey AS string) AS cdtarea, p_brand AS cdproducto,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 2 = 0 END AS snnuevo_modelo,
       CASE WHEN p_size > 40 THEN cast('2024-01-01' AS date) + p_size ELSE NULL END AS febaja,
       p_size <= 40 AS FLAG_TAREA_ACTIVA,
       CASE p_type WHEN 'ECONOMY' THEN 'TRA' WHEN 'LARGE' THEN 'IDE' WHEN 'MEDIUM' THEN 'MON'
            WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 'TRA' ELSE 'EVA' END AS cdetapa_gestion
FROM {part} WHERE p_partkey % 10 <> 3
"""

COMPANIES = """
SELECT 'E' || cast(c_custkey AS string) AS Empresa_Id,
       c_acctbal >= 0 AS ESTADO_EMPRESA_CALCULADO,
       CASE c_custkey % 4 WHEN 0 THEN 'EN COBERTURA' WHEN 1 THEN 'EN MORA' WHEN 2 THEN 'RETIRADO' ELSE NULL END AS ESTADO_EMPRESA,
       cast('2010-01-01' AS date) + cast(c_custkey % 2000 AS int) AS Fecha_Inicio_Cobertura,
       cast('3000-12-31' AS date) AS Fecha_Fin_Cobertura,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Gran Empresa' WHEN 'BUILDING' THEN 'Mediana Empresa'
            WHEN 'FURNITURE' THEN NULL WHEN 'HOUSEHOLD' THEN 'Independiente' ELSE 'Micro Empresa' END AS Segmentacion_Arl_Desc,
       'S' || cast(c_custkey % 6 AS string) AS Sector_Economico_Desc,
       'A' || cast(c_custkey % 40 AS string) AS Actividad_Economica_Desc,
       CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE 'N' END AS Ind_Afiliada,
       c_custkey % 500 > 0 AS Afiliados,
       c_custkey % 500 AS Numero_Afiliados,
       c_custkey % 9 = 0 AS Ind_Multiregional,
       CASE c_custkey % 7 WHEN 0 THEN 'SIN RUTA' WHEN 1 THEN 'LIVIANA' WHEN 2 THEN 'ESTÁNDAR' WHEN 3 THEN 'INTERVENCIÓN'
            WHEN 4 THEN 'AVANZADA' WHEN 5 THEN 'ESPECIALIZADA' ELSE NULL END AS Ruta_Atencion,
       'G' || cast(c_custkey % 50 AS string) AS GRUPO_ECONOMICO_ARL_ID,
       'U' || cast(c_custkey % 5 AS string) AS UEN_PPAL_ARL_ID,
       CASE WHEN c_custkey % 6 = 0 THEN -1 ELSE c_custkey END AS ID_PROFESIONAL_PPAL,
       c_custkey % 6 = 0 AS FLAG_SIN_PROFESIONAL
FROM {customer}
"""

CLUSTERS = """
SELECT 'P' || cast(s_suppkey AS string) AS DNI_PRESTADOR,
       cast(CASE WHEN s_suppkey % 13 = 4 THEN -1 ELSE s_suppkey % 4 END AS int) AS cluster_id,
       'A' || cast(s_suppkey % 3 AS string) AS alt_cluster
FROM {supplier}
"""

RAW_ORDERS = """
SELECT CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN '  ' ELSE ' ' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) END AS Ord_Plan_Vers_Act_Id,
       '  ' || cast(l_orderkey AS string) || ' ' AS Numero_Consecutivo_Orden,
       CASE WHEN l_linenumber = 6 AND l_quantity < 10 THEN '?' ELSE l_linestatus || ' ' END AS Codigo_Estado_Orden,
       CASE WHEN l_linenumber = 1 THEN ' ?' WHEN l_linenumber = 2 THEN '   ' ELSE ' ' || l_returnflag END AS Perfil_Prestador,
       cast(day(l_shipdate) AS string) || '/' || lpad(cast(month(l_shipdate) AS string), 2, '0') || '/' || cast(year(l_shipdate) AS string) AS Fecha_Creacion_Orden,
       CASE WHEN l_linenumber = 2 THEN '31/02/2025 10:00:00' ELSE
       cast(day(l_shipdate) AS string) || '/' || lpad(cast(month(l_shipdate) AS string), 2, '0') || '/' || cast(year(l_shipdate) AS string) || ' 08:30:00' END AS Fecha_Entrega_Servicio,
       CASE WHEN l_linenumber = 6 THEN 'n/a' WHEN l_linenumber = 5 THEN '1,234,5' ELSE replace(cast(cast(l_extendedprice AS decimal(14,2)) AS string), '.', ',') END AS Valor_Costo_Total_Tarea,
       cast(cast(l_quantity AS int) AS string) AS Numero_Cantidad_Pedida,
       CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linestatus = 'F' THEN 'S' ELSE 'N' END AS Ind_Compensacion
FROM {lineitem}
UNION ALL
SELECT cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string),
       cast(l_orderkey AS string), l_linestatus, l_returnflag,
       cast(day(l_shipdate) AS string) || '/' || lpad(cast(month(l_shipdate) AS string), 2, '0') || '/' || cast(year(l_shipdate) AS string),
       cast(day(l_shipdate) AS string) || '/' || lpad(cast(month(l_shipdate) AS string), 2, '0') || '/' || cast(year(l_shipdate) AS string) || ' 08:30:00',
       replace(cast(cast(l_extendedprice AS decimal(14,2)) AS string), '.', ','),
       cast(cast(l_quantity AS int) AS string), CASE WHEN l_linestatus = 'F' THEN 'S' ELSE 'N' END
FROM {lineitem} WHERE l_linenumber = 3
"""

RAW_VISITS = """
SELECT cast(l_orderkey AS string) || ' ' AS NMCONSECUTIVO_ORDEN,
       ' P' || cast(l_suppkey AS string) AS DNI_PRESTADOR,
       CASE WHEN l_linenumber = 4 THEN chr(10) || 'motivo' || chr(10) || l_returnflag || chr(10) ELSE ' ' END AS MOTIVO_CANCELACION,
       CASE l_linenumber WHEN 1 THEN 'AP' WHEN 2 THEN 'PA' WHEN 3 THEN ' RE' WHEN 4 THEN 'APROBADO' WHEN 5 THEN 'OTRO' ELSE NULL END AS DSESTADO_INFORME,
       CASE WHEN l_linenumber = 2 THEN 'nunca' ELSE cast(cast(l_shipdate AS date) AS string) || 'T00:00:00.000Z' END AS FEPROGRAMACION,
       CASE WHEN l_linenumber = 3 THEN '2025-02-31' ELSE cast(cast(l_shipdate AS date) AS string) END AS FECREACION_OC,
       CASE WHEN l_linenumber = 3 THEN 'x' ELSE cast(cast(l_quantity AS int) AS string) END AS DURACION,
       CASE WHEN l_linenumber = 5 THEN '-2' WHEN l_linenumber = 6 THEN NULL ELSE '4' END AS NMCANTIDAD_EJECUTADA,
       CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linestatus = 'F' THEN 'S ' ELSE 'N' END AS SNPARCIAL
FROM {lineitem}
"""

RAW_CATALOG = """
SELECT ' P' || cast(l_suppkey AS string) AS DNI_PRESTADOR,
       'T' || cast(l_partkey AS string) || ' ' AS CDTAREA,
       CASE WHEN l_linenumber = 7 THEN ' ' ELSE cast(1000 + l_partkey % 25 AS string) END AS CDMUNICIPIO,
       CASE WHEN l_suppkey % 4 = 0 THEN '0' WHEN l_suppkey % 4 = 1 THEN '160' WHEN l_suppkey % 4 = 2 THEN 'sin dato' ELSE NULL END AS CAPACIDAD,
       CASE WHEN l_suppkey % 3 = 0 THEN '3000-12-30 00:00:00' ELSE '2020-05-0' || cast(1 + l_suppkey % 9 AS string) || ' 10:11:12' END AS FEC_FIN_COS_TAR,
       CASE WHEN l_suppkey % 5 = 0 THEN '2022-08-02T00:00:00.000Z' ELSE NULL END AS FEC_INI_COS_TAR,
       CASE l_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE '' END AS SNVALIDADO
FROM {lineitem}
"""

RAW_COMPANIES = """
SELECT ' E' || cast(c_custkey AS string) AS Empresa_Id,
       CASE WHEN c_acctbal >= 0 THEN 'Activa' ELSE 'Inactiva' END AS ESTADO_EMPRESA_CALCULADO,
       CASE WHEN c_custkey % 6 = 0 THEN '-1' WHEN c_custkey % 6 = 1 THEN '12.5' ELSE cast(c_custkey AS string) END AS ID_PROFESIONAL_PPAL,
       CASE WHEN c_custkey % 3 = 0 THEN '3000-12-31' WHEN c_custkey % 3 = 1 THEN '2019-13-01' ELSE '2019-03-01' END AS Fecha_Fin_Cobertura,
       CASE WHEN c_custkey % 9 = 0 THEN 'S' WHEN c_custkey % 9 = 1 THEN NULL ELSE 'N' END AS Ind_Multiregional,
       CASE WHEN c_custkey % 5 = 0 THEN 'Sin Afiliados' ELSE ' Con Afiliados' END AS Afiliados,
       cast(c_custkey % 500 AS string) AS Numero_Afiliados
FROM {customer}
"""

RAW_MASTER = """
SELECT 'T' || cast(p_partkey AS string) || ' ' AS cdtarea,
       CASE WHEN p_size > 40 THEN '2024-01-1' || cast(p_size % 10 AS string) || ' 00:00:00' ELSE '' END AS febaja,
       CASE p_size % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE NULL END AS snnuevo_modelo
FROM {part}
"""

# The raw tables with all their columns: the further ones repeat the given forms, each with its own blanks, gaps and
# unreadable values, so every declared date, amount and flag is read from text that needs it.

FULL_ORDERS = """
SELECT r.*,
       CASE WHEN trim(Codigo_Estado_Orden) = 'F' THEN ' ' || Fecha_Entrega_Servicio ELSE Fecha_Creacion_Orden END AS Fecha_Entrega_Servicio_Fin,
       CASE WHEN Ind_Compensacion = 'S' THEN Fecha_Entrega_Servicio || '  ' ELSE '?' END AS Fecha_Aprobacion_Tarea,
       Valor_Costo_Total_Tarea || ' ' AS Valor_Costo_Unitario,
       '-' || Valor_Costo_Total_Tarea AS Valor_Costo_Total_Tarea_Cal,
       CASE WHEN Numero_Cantidad_Pedida = '7' THEN '?' ELSE Numero_Cantidad_Pedida || ',5' END AS Valor_Costo_Transporte,
       CASE WHEN Numero_Cantidad_Pedida = '8' THEN ' ' ELSE ' ' || Numero_Cantidad_Pedida || ',25 ' END AS Valor_Costo_Viaticos,
       CASE WHEN Numero_Cantidad_Pedida = '9' THEN 'nueve' ELSE Numero_Cantidad_Pedida || '.75' END AS Numero_Cantidad_Cronograma,
       '-' || Numero_Cantidad_Pedida AS Numero_Saldo_Ejecutado,
       '0,' || Numero_Cantidad_Pedida AS Numero_Saldo_Tarea,
       CASE WHEN Ind_Compensacion = 'S' THEN '0' ELSE NULL END AS Numero_Cantidad_Cancelada,
       Numero_Cantidad_Pedida || ',5,0' AS Pct_Cu_Cronograma,
       CASE WHEN Ind_Compensacion = 'S' THEN 'N ' ELSE ' S' END AS Ind_Requiere_Informe,
       CASE WHEN Numero_Cantidad_Pedida = '7' THEN '?' ELSE Ind_Compensacion END AS Ind_Informe_Obligatorio,
       CASE WHEN Numero_Cantidad_Pedida = '8' THEN ' ' ELSE 'S' END AS Ind_Liquidar_Transporte,
       CASE WHEN Numero_Cantidad_Pedida = '9' THEN 's' ELSE 'N' END AS Ind_Reactivacion,
       Ind_Compensacion || ' ' AS Ind_Transporte_Ida
FROM ({RAW_ORDERS}) r
"""

FULL_VISITS = """
SELECT r.*,
       FEPROGRAMACION || ' ' AS FEENTREGA_SERVICIO_INI,
       CASE WHEN SNPARCIAL = 'N' THEN FEPROGRAMACION ELSE ' ' END AS FEENTREGA_SERVICIO_FIN,
       ' ' || FECREACION_OC AS FEINGRESO_CUMPLIMIENTO,
       CASE WHEN trim(MOTIVO_CANCELACION) <> '' THEN FEPROGRAMACION ELSE NULL END AS FECANCELACION,
       CASE WHEN trim(DSESTADO_INFORME) = 'RE' THEN '20251301' ELSE FEPROGRAMACION END AS FEENVIO_INFORME,
       CASE WHEN trim(DSESTADO_INFORME) = 'AP' THEN FECREACION_OC || ' 10:00' ELSE NULL END AS FEAPROBACION_INFORME,
       CASE WHEN trim(DSESTADO_INFORME) = 'RE' THEN FEPROGRAMACION ELSE '' END AS FERECHAZO_INFORME,
       CASE WHEN SNPARCIAL = 'N' THEN 'ayer' ELSE FECREACION_OC END AS FECHA_CARGA,
       ' ' || DURACION AS NMCANTIDAD_PEDIDA,
       CASE WHEN DURACION = '7' THEN 'siete' ELSE DURACION || '.5' END AS NMCANTIDAD_PROGRAMADA,
       '-' || DURACION AS CANTIDAD_PROGRAMADA_CITA,
       CASE WHEN DURACION = '8' THEN '' ELSE DURACION || '0' END AS NMASISTENTES,
       CASE WHEN DURACION = '9' THEN ' ' ELSE SNPARCIAL END AS SNREQUIERE_INFORME,
       CASE WHEN trim(MOTIVO_CANCELACION) <> '' THEN ' S' ELSE NULL END AS SNCANCELA_EMPRESA,
       CASE WHEN DURACION = '7' THEN 'SI' ELSE 'S' END AS SNAPROBADO_AUTOMATICO
FROM ({RAW_VISITS}) r
"""

FULL_CATALOG = """
SELECT r.*,
       FEC_FIN_COS_TAR || ' ' AS FEALTA_PRESTADOR,
       CASE WHEN SNVALIDADO = 'S' THEN '2019-02-29 00:00:00' ELSE FEC_FIN_COS_TAR END AS FEALTA_TAREA_PRESTADOR,
       CASE WHEN SNVALIDADO = 'N' THEN '2021-07-15' ELSE FEC_FIN_COS_TAR END AS FEALTA_DIST,
       CASE WHEN SNVALIDADO = 'S' THEN '2021-07-15 23:59:59' ELSE ' ' END AS FEVALIDACION,
       CASE WHEN SNVALIDADO = '' THEN NULL ELSE FEC_FIN_COS_TAR END AS FECHA_CARGA,
       CASE WHEN SNVALIDADO = 'N' THEN 'buena' ELSE ' 4.5' END AS PTCALIFICACION,
       CASE WHEN SNVALIDADO = 'S' THEN '-' || CAPACIDAD ELSE trim(CDMUNICIPIO) || '.25' END AS PTVALOR_TAREA,
       CASE WHEN CAPACIDAD = '160' THEN 'S ' WHEN CAPACIDAD = '0' THEN 'N' ELSE NULL END AS SNCONTROLAR_HORAS_MES
FROM ({RAW_CATALOG}) r
"""

FULL_COMPANIES = """
SELECT r.*,
       CASE WHEN Numero_Afiliados = '7' THEN 'sin fecha' WHEN Ind_Multiregional = 'S' THEN ' 2010-05-06 ' ELSE Fecha_Fin_Cobertura END AS Fecha_Inicio_Cobertura
FROM ({RAW_COMPANIES}) r
"""

FULL_MASTER = """
SELECT r.*,
       CASE WHEN snnuevo_modelo = 'S' THEN '2023-04-31 00:00:00' WHEN snnuevo_modelo = 'N' THEN ' 2023-04-30T05:06:07 ' ELSE febaja END AS fealta,
       CASE WHEN snnuevo_modelo = 'S' THEN 'N' ELSE 'S ' END AS snrequiereinforme,
       CASE WHEN febaja = '' THEN ' ' ELSE snnuevo_modelo END AS sninforme_obligatorio
FROM ({RAW_MASTER}) r
"""

FULL = {
    "fx_full_ordenado": FULL_ORDERS.replace("{RAW_ORDERS}", RAW_ORDERS),
    "fx_full_citas": FULL_VISITS.replace("{RAW_VISITS}", RAW_VISITS),
    "fx_full_catalogo": FULL_CATALOG.replace("{RAW_CATALOG}", RAW_CATALOG),
    "fx_full_empresa": FULL_COMPANIES.replace("{RAW_COMPANIES}", RAW_COMPANIES),
    "fx_full_maestro": FULL_MASTER.replace("{RAW_MASTER}", RAW_MASTER),
}

VIEWS = {
    "fx_citas": VISITS,
    "fx_ordenado": ORDERS,
    "fx_catalogo": CATALOG,
    "fx_maestro": MASTER,
    "fx_empresa": COMPANIES,
    "fx_clusters": CLUSTERS,
    "fx_raw_ordenado": RAW_ORDERS,
    "fx_raw_citas": RAW_VISITS,
    "fx_raw_catalogo": RAW_CATALOG,
    "fx_raw_empresa": RAW_COMPANIES,
    "fx_raw_maestro": RAW_MASTER,
    **FULL,
}


# the join that visits and orders have in common
LINES = "FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey\nJOIN {customer} c ON o.o_custkey = c.c_custkey"


class Tables:
    """Driver tables and the views above as DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def view(self, name: str) -> DataFrame:
        return self._run(VIEWS[name])

    def _run(self, text: str) -> DataFrame:
        return self.spark.sql(re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{self.path(m[1])}`", text))

    @property
    def visits(self) -> DataFrame:
        return self.view("fx_citas")

    @property
    def orders(self) -> DataFrame:
        return self.view("fx_ordenado")

    @property
    def catalog(self) -> DataFrame:
        return self.view("fx_catalogo")

    def narrow_catalog(self) -> DataFrame:
        """The same rows as `catalog`, made distinct before the wide columns are formed.

        The keys of a row tell all its other columns if every dimension has one row per key.
        If one has not, the text runs as it is.
        """
        keys = {"supplier": "s_suppkey", "part": "p_partkey", "nation": "n_nationkey", "region": "r_regionkey"}
        for name, key in keys.items():
            if not self.table(name).groupBy(key).count().where("count > 1").isEmpty():
                return self.catalog
        # placed by part: the distinct pairs and the join with the parts stay in place
        placed = f"SELECT l_suppkey, l_partkey FROM parquet.`{self.path('lineitem')}` DISTRIBUTE BY l_partkey"
        pairs = f"(SELECT DISTINCT l_suppkey, l_partkey FROM ({placed}))"
        text = VIEWS["fx_catalogo"].replace("{lineitem}", pairs).replace("SELECT DISTINCT 'P'", "SELECT 'P'", 1)
        return self._run(text)

    def lines(self) -> DataFrame:
        """The order lines with their order and customer, as the texts of visits and orders join them.

        Orders meet their customers first, so that lines cross the network once.
        """
        names = sorted(set(re.findall(r"\b[loc]\.(\w+)", VIEWS["fx_citas"] + VIEWS["fx_ordenado"])) - {"o_orderkey", "c_custkey"})
        headed = "(SELECT * FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)"
        return self._run(f"SELECT {', '.join(names)} FROM {{lineitem}} l JOIN {headed} h ON l.l_orderkey = h.o_orderkey")

    def over_lines(self, name: str, lines: DataFrame) -> DataFrame:
        """The view of visits or orders, its join replaced by the stored result of `lines`."""
        columns, found, rest = VIEWS[name].partition(LINES)
        if not found:
            raise ValueError(f"{name} does not read the order lines")
        text = columns + "FROM {lines} l" + rest
        return self.spark.sql(re.sub(r"\b[oc]\.(?=\w)", "l.", text), lines=lines)

    @property
    def master(self) -> DataFrame:
        return self.view("fx_maestro")

    @property
    def companies(self) -> DataFrame:
        return self.view("fx_empresa")

    @property
    def clusters(self) -> DataFrame:
        return self.view("fx_clusters")


# ---- SQL side --------------------------------------------------------------------------------

CTES: dict[str, str] = {name: re.sub(r"\{(\w+)\}", r"\1", text) for name, text in VIEWS.items()}


def cte(name: str, text: str) -> None:
    CTES[name] = text


def duck(text: str) -> str:
    """A query with every named table expression it needs in front of it."""
    needed: list[str] = []

    def visit(fragment: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b\w+\b", fragment)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(text)
    if not needed:
        return text
    # each is read by several others; compute it once
    heads = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in needed)
    body = text.strip()
    return f"WITH {heads}\n{body}" if not body.upper().startswith("WITH ") else f"WITH {heads},\n{body[5:]}"
