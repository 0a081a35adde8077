"""Sources, sinks, projections, casts and cleaning."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions import cleaning as C
from matchwright.functions import expr as X
from matchwright.operators import aggregates as A
from matchwright.plans import grouping as G
from matchwright.plans import provider_features as PF
from matchwright.plans import silver as S
from matchwright.session import scratch_path
from matchwright.sources import readers as SR
from matchwright.sources import store as ST
from workload.registry import catalog, company_features, matrix, orders, providers, query, visits
from workload.views import Tables

LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(
    "scan_parquet_full",
    f"SELECT {LINE} FROM lineitem",
    rounds=["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    dates=["l_shipdate"],
)
def scan_parquet_full(t: Tables):
    return t.table("lineitem")


@query("scan_parquet_pruned", "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def scan_parquet_pruned(t: Tables):
    return t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


@query("sql_over_file", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders", rounds=["o_totalprice"])
def sql_over_file(t: Tables):
    return SR.sql_over_file(
        t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    )


@query("sql_over_file_full", "SELECT * FROM supplier", rounds=["s_acctbal"])
def sql_over_file_full(t: Tables):
    return SR.sql_over_file(t.spark, t.path("supplier"))


@query(
    "scan_point_lookup",
    "SELECT Empresa_Id, Segmentacion_Arl_Desc, Ruta_Atencion FROM fx_empresa WHERE Empresa_Id = 'E7'",
)
def scan_point_lookup(t: Tables):
    return SR.point_lookup(
        company_features(t), "Empresa_Id", "E7", ["Empresa_Id", "Segmentacion_Arl_Desc", "Ruta_Atencion"]
    )


TEXT_COLUMNS = ["okey", "pkey", "flag", "town"]
TEXT_SQL = "SELECT cast(l_orderkey AS string) AS okey, cast(l_partkey AS string) AS pkey, l_returnflag AS flag, 'Bogotá ' || cast(l_suppkey AS string) AS town FROM lineitem"


def text_rows(t: Tables):
    return t.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("okey"),
        F.col("l_partkey").cast("string").alias("pkey"),
        F.col("l_returnflag").alias("flag"),
        F.concat(F.lit("Bogotá "), F.col("l_suppkey").cast("string")).alias("town"),
    )


def text_files(t: Tables, charset: str = "UTF-8") -> str:
    path = scratch_path(t.spark, "text")
    text_rows(t).write.csv(path, sep="~", header=True, encoding=charset)
    return path


@query("read_delimited_strings", TEXT_SQL)
def read_delimited_strings(t: Tables):
    return SR.read_delimited_strings(t.spark, text_files(t))


@query("infer_text_format", "SELECT 'tilde' AS delimiter, 'ISO-8859-1' AS charset")
def infer_text_format(t: Tables):
    return SR.infer_text_format(t.spark, text_files(t, "ISO-8859-1"))


@query(
    "delimiter_evidence",
    """SELECT delimiter, mean_count, variance, in_header, true AS utf8, preference FROM (
    SELECT 'tab' AS delimiter, avg(length(p_name) - length(replace(p_name, chr(9), ''))) AS mean_count, 0.0 AS variance, false AS in_header, 0 AS preference FROM part
    UNION ALL SELECT 'pipe', avg(length(v) - length(replace(v, '|', ''))), var_pop(length(v) - length(replace(v, '|', ''))), true, 1 FROM (SELECT p_name || '|' || p_brand || '|' || p_type AS v FROM part)
    UNION ALL SELECT 'tilde', 0.0, 0.0, false, 2 UNION ALL SELECT 'semicolon', 0.0, 0.0, false, 3 UNION ALL SELECT 'comma', 0.0, 0.0, false, 4)""",
    rounds=["mean_count", "variance"],
)
def delimiter_evidence(t: Tables):
    path = scratch_path(t.spark, "text")
    t.table("part").select(F.concat_ws("|", "p_name", "p_brand", "p_type")).write.text(path)
    return SR.delimiter_evidence(SR.text_evidence(t.spark, path))


@query("read_quoted_text", "SELECT cast(doc_id AS string) AS doc_id, text, lang FROM documents")
def read_quoted_text(t: Tables):
    """Whole texts with line breaks, commas and quotes, as quoted fields of several files."""
    path = scratch_path(t.spark, "quoted")
    rows = t.table("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang").repartition(4)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.csv(path, header=True, quote='"', escape='"', quoteAll=True, **keep)
    return SR.read_delimited_strings(t.spark, path, ",", "UTF-8", columns=["doc_id", "text", "lang"], multi_line=True)


@query(
    "read_pipe_with_commas",
    "SELECT cast(o_orderkey AS string) AS okey, 'a, b, c, ' || o_orderstatus || ', d' AS note, cast(o_custkey AS string) AS ckey FROM orders",
)
def read_pipe_with_commas(t: Tables):
    """More commas than pipes in every line: only the header tells which one separates."""
    path = scratch_path(t.spark, "piped")
    rows = t.table("orders").select(
        F.col("o_orderkey").cast("string").alias("okey"),
        F.concat(F.lit("a, b, c, "), "o_orderstatus", F.lit(", d")).alias("note"),
        F.col("o_custkey").cast("string").alias("ckey"),
    )
    rows.write.csv(path, sep="|", header=True)
    return SR.read_delimited_strings(t.spark, path)


@query("parse_text_table", TEXT_SQL)
def parse_text_table(t: Tables):
    lines = text_rows(t).select(F.concat_ws("|", *TEXT_COLUMNS).alias("value"))
    header = lines.limit(1).select(F.lit("|".join(TEXT_COLUMNS)).alias("value"))
    return SR.parse_text_table(lines.unionByName(header), TEXT_COLUMNS, "|")


@query("repair_encoding", "SELECT s_suppkey, 'Medellín ' || s_name AS s_name FROM supplier")
def repair_encoding(t: Tables):
    source = t.table("supplier").select("s_suppkey", F.concat(F.lit("Medellín "), F.col("s_name")).alias("s_name"))
    raw = source.withColumn("s_name", F.encode("s_name", "ISO-8859-1").cast("string"))
    return SR.repair_encoding(raw)


@query(
    "union_tagged_sources",
    "SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal, NULL AS seg, 'red_a' AS _RED_ORIGEN FROM supplier UNION ALL "
    "SELECT c_custkey, c_name, NULL, c_mktsegment, 'red_b' FROM customer",
    rounds=["bal"],
)
def union_tagged_sources(t: Tables):
    a = t.table("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    b = t.table("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return SR.union_tagged_sources({"red_a": a, "red_b": b})


@query("convert_if_absent", TEXT_SQL)
def convert_if_absent(t: Tables):
    source, root = text_files(t), scratch_path(t.spark, "parquet")

    def read():
        return SR.read_delimited_strings(t.spark, source)

    ST.convert_if_absent(t.spark, {"lines": read}, root)
    return ST.convert_if_absent(t.spark, {"lines": read}, root)["lines"]


@query("materialize", "SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1")
def materialize(t: Tables):
    path = scratch_path(t.spark, "flags")
    build = lambda: t.table("lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"))
    ST.materialize(t.spark, path, build)
    return ST.materialize(t.spark, path, build)


# text columns of each baked table, by which its rows are compared
BAKED = {
    "feat_prestador": ("o_provider", ["DNI_PRESTADOR", "bloque_principal", "tipo_perfil", "etapa_predominante", "tipo_red"]),
    "clustering_input": ("o_matrix", ["DNI_PRESTADOR"]),
    "feat_empresa": ("o_company", ["Empresa_Id", "Segmentacion_Arl_Desc", "Ruta_Atencion"]),
}


def _row_text(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} AS string), '~')" for c in columns) + ")"


@query(
    "bake_targets",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, md5({_row_text(columns)}) AS row_hash, count(*) AS n FROM {view} GROUP BY ALL" for name, (view, columns) in BAKED.items()
    ),
)
def bake_targets(t: Tables):
    """Every row of the baked tables by a hash of its text columns; the matrix is built from the stored provider table."""
    from matchwright.plans.company_features import company_table

    registry = {
        "clustering_input": ST.Target(lambda done: PF.grouping_matrix(done["feat_prestador"]), ("feat_prestador",), {"known": F.col("DNI_PRESTADOR").isNotNull()}),
        "feat_prestador": ST.Target(lambda done: PF.provider_table(catalog(t), t.master, visits(t), orders(t), t.companies)),
        "feat_empresa": ST.Target(lambda done: company_table(t.companies, orders(t), visits(t))),
    }
    baked = ST.bake_targets(t.spark, registry, scratch_path(t.spark, "gold"))
    out = None
    for name, (_, columns) in BAKED.items():
        rows = baked[name].select(F.lit(name).alias("name"), F.expr(f"md5({_row_text(columns)})").alias("row_hash")).groupBy("name", "row_hash").agg(F.count(F.lit(1)).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("write_replace", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def write_replace(t: Tables):
    path = scratch_path(t.spark, "replace")
    df = t.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
    ST.write_replace(df.limit(1), path)
    return ST.write_replace(df, path)


# ---- cleaning ------------------------------------------------------------------------------

RAW = "fx_raw_ordenado"
# The columns of the raw order view, all text.
RAW_COLUMNS = (
    "Ord_Plan_Vers_Act_Id",
    "Numero_Consecutivo_Orden",
    "Codigo_Estado_Orden",
    "Perfil_Prestador",
    "Fecha_Creacion_Orden",
    "Fecha_Entrega_Servicio",
    "Valor_Costo_Total_Tarea",
    "Numero_Cantidad_Pedida",
    "Ind_Compensacion",
)
TRIMMED = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in RAW_COLUMNS)


@query("clean_strings", f"SELECT {TRIMMED} FROM {RAW}")
def clean_strings(t: Tables):
    return t.view(RAW).transform(C.clean_strings)


@query("sentinel_to_null", f"SELECT {', '.join(f'nullif({c}, $$?$$) AS {c}' for c in RAW_COLUMNS)} FROM (SELECT {TRIMMED} FROM {RAW})".replace("$$", "'"))
def sentinel_to_null(t: Tables):
    return t.view(RAW).transform(C.clean_strings).transform(C.sentinel_to_null)


@query(
    "drop_malformed",
    f"SELECT * FROM (SELECT nullif(trim(Ord_Plan_Vers_Act_Id), '') AS Ord_Plan_Vers_Act_Id, nullif(trim(Codigo_Estado_Orden), '?') AS Codigo_Estado_Orden FROM {RAW}) "
    "WHERE Ord_Plan_Vers_Act_Id IS NOT NULL AND Codigo_Estado_Orden IS NOT NULL",
)
def drop_malformed(t: Tables):
    df = t.view(RAW).select("Ord_Plan_Vers_Act_Id", "Codigo_Estado_Orden").transform(C.clean_strings)
    return df.transform(C.sentinel_to_null).transform(C.drop_malformed, ["Ord_Plan_Vers_Act_Id", "Codigo_Estado_Orden"])


@query(
    "parse_dates",
    "SELECT cast(try_strptime(Fecha_Creacion_Orden, '%d/%m/%Y') AS date) AS dia, cast(try_strptime(Fecha_Entrega_Servicio, '%d/%m/%Y %H:%M:%S') AS date) AS hora, "
    f"Ord_Plan_Vers_Act_Id AS id FROM {RAW}",
    dates=["dia", "hora"],
)
def parse_dates(t: Tables):
    df = t.view(RAW).select(
        F.col("Fecha_Creacion_Orden").alias("dia"), F.col("Fecha_Entrega_Servicio").alias("hora"), F.col("Ord_Plan_Vers_Act_Id").alias("id")
    )
    return df.transform(C.parse_dates, {"dia": S.DAY, "hora": S.DAY_TIME})


@query(
    "parse_dates_iso",
    "SELECT try_cast(substr(FEPROGRAMACION, 1, 10) AS date) AS iso, try_cast(FECREACION_OC AS date) AS simple FROM fx_raw_citas",
    dates=["iso", "simple"],
)
def parse_dates_iso(t: Tables):
    df = t.view("fx_raw_citas").select(F.col("FEPROGRAMACION").alias("iso"), F.col("FECREACION_OC").alias("simple"))
    return df.transform(C.parse_dates, {"iso": "iso", "simple": S.SQL_DAY})


MONEY = "try_cast(regexp_replace(Valor_Costo_Total_Tarea, ',', '.') AS double)"


@query("decimal_comma_to_double", f"SELECT {MONEY} AS valor FROM {RAW}", rounds=["valor"])
def decimal_comma_to_double(t: Tables):
    return t.view(RAW).select(F.col("Valor_Costo_Total_Tarea").alias("valor")).transform(C.decimal_comma_to_double, ["valor"])


@query(
    "lenient_numeric_cast",
    "SELECT try_cast(DURACION AS double) AS d, try_cast(NMCANTIDAD_EJECUTADA AS bigint) AS n FROM fx_raw_citas",
    rounds=["d"],
)
def lenient_numeric_cast(t: Tables):
    df = t.view("fx_raw_citas").select(F.col("DURACION").alias("d"), F.col("NMCANTIDAD_EJECUTADA").alias("n"))
    return df.transform(C.lenient_numeric_cast, ["d"]).transform(C.lenient_numeric_cast, ["n"], "bigint")


@query("flag_to_boolean", f"SELECT Ind_Compensacion = 'S' AS f, Codigo_Estado_Orden AS s FROM {RAW}")
def flag_to_boolean(t: Tables):
    df = t.view(RAW).select(F.col("Ind_Compensacion").alias("f"), F.col("Codigo_Estado_Orden").alias("s"))
    return df.transform(C.flag_to_boolean, {"f": "S"})


@query(
    "recode_values",
    "SELECT CASE trim(DSESTADO_INFORME) WHEN 'AP' THEN 'APROBADO' WHEN 'PA' THEN 'PRE-APROBADO' WHEN 'RE' THEN 'RECHAZADO' ELSE trim(DSESTADO_INFORME) END AS e FROM fx_raw_citas",
)
def recode_values(t: Tables):
    df = t.view("fx_raw_citas").select(F.col("DSESTADO_INFORME").alias("e")).transform(C.clean_strings)
    return df.transform(C.recode_values, "e", K.REPORT_RECODES)


@query(
    "fold_values",
    "SELECT CASE WHEN PERFIL_TARIFA IN ('O','P','E','T') THEN 'OPET' ELSE PERFIL_TARIFA END AS p, "
    "CASE WHEN TIPO_DE_RED IN ('MERCADEO','PROMOTORA','APOYO','OPERACIONES') THEN 'OTROS' ELSE TIPO_DE_RED END AS r FROM fx_catalogo",
)
def fold_values(t: Tables):
    df = t.catalog.select(F.col("PERFIL_TARIFA").alias("p"), F.col("TIPO_DE_RED").alias("r"))
    df = df.transform(C.fold_values, "p", ["O", "P", "E", "T"], "OPET")
    return df.transform(C.fold_values, "r", ["MERCADEO", "PROMOTORA", "APOYO", "OPERACIONES"], "OTROS")


@query("collapse_newlines", "SELECT trim(replace(MOTIVO_CANCELACION, chr(10), ' ')) AS m FROM fx_raw_citas")
def collapse_newlines(t: Tables):
    return t.view("fx_raw_citas").select(F.col("MOTIVO_CANCELACION").alias("m")).transform(C.collapse_newlines, "m")


@query("dedup_exact", f"SELECT DISTINCT {TRIMMED} FROM {RAW}")
def dedup_exact(t: Tables):
    return t.view(RAW).transform(C.clean_strings).transform(C.dedup_exact)


@query(
    "quality_flags",
    "SELECT c.PERFIL_TARIFA IS NULL AS desconocido, c.CAPACIDAD = 0 AS cero, coalesce(c.PTVALOR_TAREA < 0, false) AS negativo FROM fx_catalogo c",
)
def quality_flags(t: Tables):
    flags = {
        "desconocido": F.col("PERFIL_TARIFA").isNull(),
        "cero": F.col("CAPACIDAD") == 0,
        "negativo": F.coalesce(F.col("PTVALOR_TAREA") < 0, F.lit(False)),
    }
    return t.catalog.transform(C.quality_flags, flags).select(*flags)


def text(c: str) -> str:
    """A cleaned text: blanks and line breaks around it go, nothing left is null."""
    return f"nullif(trim({c}, ' ' || chr(10)), '')"


def known(c: str) -> str:
    return f"nullif({text(c)}, '?')"


def amount(c: str) -> str:
    return f"try_cast(regexp_replace({known(c)}, ',', '.') AS double) AS {c}"


def number(c: str) -> str:
    return f"try_cast({text(c)} AS double) AS {c}"


def stamp(c: str, pattern: str, clean=text) -> str:
    return f"cast(try_strptime({clean(c)}, '{pattern}') AS date) AS {c}"


def lead(c: str) -> str:
    """The date in the first ten characters."""
    return f"cast(try_strptime(substr({text(c)}, 1, 10), '%Y-%m-%d') AS date) AS {c}"


def truth(c: str, yes: str = "S", clean=text) -> str:
    return f"{clean(c)} = '{yes}' AS {c}"


# Columns as the oracles read them, written out apart from the library's own lists.
SEEN_AMOUNTS = (
    "Valor_Costo_Unitario", "Valor_Costo_Total_Tarea_Cal", "Valor_Costo_Total_Tarea", "Valor_Costo_Transporte",
    "Valor_Costo_Viaticos", "Numero_Cantidad_Cronograma", "Numero_Cantidad_Pedida", "Numero_Saldo_Ejecutado",
    "Numero_Saldo_Tarea", "Numero_Cantidad_Cancelada", "Pct_Cu_Cronograma",
)
SEEN_ORDER_FLAGS = (
    "Ind_Requiere_Informe", "Ind_Informe_Obligatorio", "Ind_Liquidar_Transporte", "Ind_Reactivacion", "Ind_Transporte_Ida",
    "Ind_Compensacion",
)
SEEN_ORDER_TIMES = ("Fecha_Entrega_Servicio", "Fecha_Entrega_Servicio_Fin", "Fecha_Aprobacion_Tarea")
SEEN_VISIT_DATES = (
    "FEENTREGA_SERVICIO_INI", "FEENTREGA_SERVICIO_FIN", "FEPROGRAMACION", "FEINGRESO_CUMPLIMIENTO", "FECANCELACION",
    "FEENVIO_INFORME", "FEAPROBACION_INFORME", "FERECHAZO_INFORME",
)
SEEN_VISIT_DAYS = ("FECREACION_OC", "FECHA_CARGA")
SEEN_VISIT_NUMBERS = (
    "NMCANTIDAD_PEDIDA", "NMCANTIDAD_PROGRAMADA", "DURACION", "CANTIDAD_PROGRAMADA_CITA", "NMCANTIDAD_EJECUTADA", "NMASISTENTES",
)
SEEN_VISIT_FLAGS = ("SNREQUIERE_INFORME", "SNCANCELA_EMPRESA", "SNAPROBADO_AUTOMATICO", "SNPARCIAL")
SEEN_CATALOG_TIMES = ("FEALTA_PRESTADOR", "FEC_FIN_COS_TAR", "FEALTA_TAREA_PRESTADOR", "FEALTA_DIST", "FEVALIDACION", "FECHA_CARGA")
SEEN_CATALOG_NUMBERS = ("CAPACIDAD", "PTCALIFICACION", "PTVALOR_TAREA")


@query(
    "silver_ordenado",
    f"""SELECT DISTINCT {", ".join(f"{known(c)} AS {c}" for c in ("Ord_Plan_Vers_Act_Id", "Numero_Consecutivo_Orden", "Codigo_Estado_Orden", "Perfil_Prestador"))},
    {stamp("Fecha_Creacion_Orden", "%d/%m/%Y", known)}, {", ".join(stamp(c, "%d/%m/%Y %H:%M:%S", known) for c in SEEN_ORDER_TIMES)},
    {", ".join(map(amount, SEEN_AMOUNTS))}, {", ".join(truth(c, clean=known) for c in SEEN_ORDER_FLAGS)},
    {known("Perfil_Prestador")} IS NULL AS FLAG_PERFIL_DESCONOCIDO
    FROM fx_full_ordenado r WHERE {known("r.Ord_Plan_Vers_Act_Id")} IS NOT NULL AND {known("r.Codigo_Estado_Orden")} IS NOT NULL""",
    rounds=SEEN_AMOUNTS,
    dates=["Fecha_Creacion_Orden", *SEEN_ORDER_TIMES],
)
def silver_ordenado(t: Tables):
    return S.clean_orders(t.view("fx_full_ordenado"))


PROFESSIONAL = "try_cast(CASE WHEN ID_PROFESIONAL_PPAL NOT LIKE '%.%' THEN ID_PROFESIONAL_PPAL END AS bigint)"


@query(
    "silver_empresas",
    f"""SELECT {text("Empresa_Id")} AS Empresa_Id, {truth("ESTADO_EMPRESA_CALCULADO", "Activa")}, {PROFESSIONAL} AS ID_PROFESIONAL_PPAL,
    {stamp("Fecha_Inicio_Cobertura", "%Y-%m-%d")}, {stamp("Fecha_Fin_Cobertura", "%Y-%m-%d")}, {truth("Ind_Multiregional")},
    {truth("Afiliados", "Con Afiliados")}, try_cast(Numero_Afiliados AS bigint) AS Numero_Afiliados, {PROFESSIONAL} = -1 AS FLAG_SIN_PROFESIONAL
    FROM fx_full_empresa""",
    dates=["Fecha_Inicio_Cobertura", "Fecha_Fin_Cobertura"],
)
def silver_empresas(t: Tables):
    return S.clean_companies(t.view("fx_full_empresa"))


@query(
    "silver_tareas_programadas",
    f"""SELECT {text("NMCONSECUTIVO_ORDEN")} AS NMCONSECUTIVO_ORDEN, {text("DNI_PRESTADOR")} AS DNI_PRESTADOR,
    replace({text("MOTIVO_CANCELACION")}, chr(10), ' ') AS MOTIVO_CANCELACION,
    CASE {text("DSESTADO_INFORME")} WHEN 'AP' THEN 'APROBADO' WHEN 'PA' THEN 'PRE-APROBADO' WHEN 'RE' THEN 'RECHAZADO' ELSE {text("DSESTADO_INFORME")} END AS DSESTADO_INFORME,
    {", ".join(map(lead, SEEN_VISIT_DATES))}, {", ".join(stamp(c, "%Y-%m-%d") for c in SEEN_VISIT_DAYS)},
    {", ".join(map(number, SEEN_VISIT_NUMBERS))}, {", ".join(map(truth, SEEN_VISIT_FLAGS))},
    coalesce(try_cast(NMCANTIDAD_EJECUTADA AS double) < 0, false) AS FLAG_CANTIDAD_EJECUTADA_NEGATIVA FROM fx_full_citas""",
    rounds=SEEN_VISIT_NUMBERS,
    dates=[*SEEN_VISIT_DATES, *SEEN_VISIT_DAYS],
)
def silver_tareas_programadas(t: Tables):
    return S.clean_visits(t.view("fx_full_citas"))


@query(
    "silver_tareas_prestador",
    f"""SELECT DISTINCT {", ".join(f"{text(c)} AS {c}" for c in ("DNI_PRESTADOR", "CDTAREA", "CDMUNICIPIO"))},
    {", ".join(map(number, SEEN_CATALOG_NUMBERS))}, {", ".join(stamp(c, "%Y-%m-%d %H:%M:%S") for c in SEEN_CATALOG_TIMES)},
    {lead("FEC_INI_COS_TAR")}, {truth("SNVALIDADO")}, {truth("SNCONTROLAR_HORAS_MES")},
    try_cast(CAPACIDAD AS double) = 0 AS FLAG_CAPACIDAD_CERO FROM fx_full_catalogo r WHERE {text("r.CDMUNICIPIO")} IS NOT NULL""",
    rounds=SEEN_CATALOG_NUMBERS,
    dates=[*SEEN_CATALOG_TIMES, "FEC_INI_COS_TAR"],
)
def silver_tareas_prestador(t: Tables):
    return S.clean_catalog(t.view("fx_full_catalogo"))


@query(
    "silver_maestro",
    f"""SELECT {text("cdtarea")} AS cdtarea, {lead("fealta")}, {lead("febaja")}, {truth("snrequiereinforme")}, {truth("sninforme_obligatorio")},
    {truth("snnuevo_modelo")}, try_strptime(substr({text("febaja")}, 1, 10), '%Y-%m-%d') IS NULL AS FLAG_TAREA_ACTIVA FROM fx_full_maestro""",
    dates=["fealta", "febaja"],
)
def silver_maestro(t: Tables):
    return S.clean_master(t.view("fx_full_maestro"))


@query("strip_float_suffix", "SELECT regexp_replace(Municipio_Entrega_Id, '\\.0$', '') AS m FROM fx_ordenado")
def strip_float_suffix(t: Tables):
    return t.orders.select(X.strip_float_suffix("Municipio_Entrega_Id").alias("m"))


@query("ordinal_encode", "SELECT DNI_PRESTADOR, tipo_perfil_ord FROM o_coded", rounds=["tipo_perfil_ord"])
def ordinal_encode(t: Tables):
    active = providers(t).where(~F.col("FLAG_SIN_ACTIVIDAD_2025"))
    return active.select("DNI_PRESTADOR", X.seniority("tipo_perfil").alias("tipo_perfil_ord"))


@query(
    "impute_zero",
    "SELECT DNI_PRESTADOR, coalesce(utilizacion_capacidad, 0) AS utilizacion_capacidad, coalesce(tasa_ejecucion, 0) AS tasa_ejecucion FROM o_provider",
    rounds=["utilizacion_capacidad", "tasa_ejecucion"],
)
def impute_zero(t: Tables):
    cols = ["utilizacion_capacidad", "tasa_ejecucion"]
    return providers(t).select("DNI_PRESTADOR", *cols).transform(A.impute_zero, cols)


@query(
    "impute_median",
    "SELECT DNI_PRESTADOR, coalesce(antiguedad_dias, (SELECT median(antiguedad_dias) FROM o_provider)) AS antiguedad_dias, "
    "coalesce(dias_ciclo_informe_prom, (SELECT median(dias_ciclo_informe_prom) FROM o_provider)) AS dias_ciclo_informe_prom FROM o_provider",
    rounds=["antiguedad_dias", "dias_ciclo_informe_prom"],
)
def impute_median(t: Tables):
    df = providers(t).select("DNI_PRESTADOR", F.col("antiguedad_dias").cast("double"), "dias_ciclo_informe_prom")
    return df.transform(A.impute_median, ["antiguedad_dias", "dias_ciclo_informe_prom"])


HEAVY = list(K.HEAVY_TAILED)


@query(
    "log1p_columns",
    f"SELECT DNI_PRESTADOR, {', '.join(f'ln(1 + {c}) AS {c}' for c in HEAVY)} FROM o_matrix",
    rounds=HEAVY,
)
def log1p_columns(t: Tables):
    return matrix(t).select("DNI_PRESTADOR", *HEAVY).transform(C.log1p_columns, HEAVY, True)


DENSE = (
    "NMCONSECUTIVO_ORDEN",
    "DNI_PRESTADOR",
    "DNI_EMPRESA",
    "CDTAREA",
    "DS_MUNICIPIO_DESTINO",
    "CLASIFICACION",
    "TIPO_PROGRAMACION",
    "DSESTADO_PROGRAMACION",
    "FEPROGRAMACION",
)


@query("drop_sparse_columns", f"SELECT {', '.join(DENSE)} FROM fx_citas", dates=["FEPROGRAMACION"])
def drop_sparse_columns(t: Tables):
    return A.drop_sparse_columns(t.visits, 0.1)


CATEGORIES = ("DSCLASIFICACION", "DSTIPO_PERFIL", "FUNCION_PRESTADOR", "PERFIL_TARIFA", "TIPO_DE_RED", "CDOFICINA")


@query(
    "impute_mode",
    "SELECT DNI_PRESTADOR, "
    + ", ".join(f"coalesce({c}, (SELECT {c} FROM fx_catalogo WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}" for c in CATEGORIES)
    + " FROM fx_catalogo",
)
def impute_mode(t: Tables):
    return t.catalog.select("DNI_PRESTADOR", *CATEGORIES).transform(A.impute_mode, CATEGORIES)


@query(
    "impute_mean",
    "SELECT DNI_PRESTADOR, CDTAREA, coalesce(DURACION, (SELECT avg(DURACION) FROM fx_citas)) AS DURACION FROM fx_citas",
    rounds=["DURACION"],
)
def impute_mean(t: Tables):
    return t.visits.select("DNI_PRESTADOR", "CDTAREA", "DURACION").transform(A.impute_mean, ["DURACION"])


@query(
    "standardize",
    "SELECT DNI_PRESTADOR, (coalesce(DURACION, m) - m) / s AS DURACION FROM fx_citas, (SELECT m, (SELECT stddev_samp(coalesce(DURACION, m)) FROM fx_citas) AS s "
    "FROM (SELECT avg(DURACION) AS m FROM fx_citas)) k",
    rounds=["DURACION"],
)
def standardize(t: Tables):
    return t.visits.select("DNI_PRESTADOR", "DURACION").transform(A.standardize, ["DURACION"])


@query(
    "one_hot",
    "SELECT DNI_PRESTADOR, CDTAREA, level, cast(coalesce(TIPO_DE_RED = level, false) AS int) AS hot FROM fx_catalogo, (SELECT DISTINCT TIPO_DE_RED AS level FROM fx_catalogo WHERE TIPO_DE_RED IS NOT NULL)",
)
def one_hot(t: Tables):
    """All levels of the column, read from the data, in long form."""
    df = t.catalog.select("DNI_PRESTADOR", "CDTAREA", "TIPO_DE_RED")
    levels = [r[0] for r in df.select("TIPO_DE_RED").dropna().distinct().orderBy("TIPO_DE_RED").collect()]  # a handful of kinds of network
    wide = A.one_hot(df, {"TIPO_DE_RED": levels})
    return wide.unpivot(["DNI_PRESTADOR", "CDTAREA"], [f"TIPO_DE_RED_{v}" for v in levels], "level", "hot").withColumn("level", F.regexp_replace("level", "^TIPO_DE_RED_", ""))


@query(
    "one_hot_vector",
    """WITH v AS (SELECT DNI_PRESTADOR, CDTAREA, TIPO_DE_RED AS a, CDMUNICIPIO AS b FROM fx_catalogo),
    l AS (SELECT 0 AS col, level, row_number() OVER (ORDER BY level) - 1 AS place FROM (SELECT DISTINCT a AS level FROM v WHERE a IS NOT NULL)
    UNION ALL SELECT 1, level, row_number() OVER (ORDER BY level) - 1 + (SELECT count(DISTINCT a) FROM v) FROM (SELECT DISTINCT b AS level FROM v WHERE b IS NOT NULL))
    SELECT DNI_PRESTADOR, CDTAREA, cast(place AS int) AS place FROM v JOIN l ON (col = 0 AND a = level) OR (col = 1 AND b = level)""",
)
def one_hot_vector(t: Tables):
    """The set places of every row's vector over all kinds of network and all towns."""
    df = t.catalog.select("DNI_PRESTADOR", "CDTAREA", "TIPO_DE_RED", "CDMUNICIPIO")
    coded = A.one_hot_vector(df, ["TIPO_DE_RED", "CDMUNICIPIO"]).select("DNI_PRESTADOR", "CDTAREA", F.posexplode(vector_to_array("encoded")).alias("place", "v"))
    return coded.where("v = 1").drop("v")


@query("sanitize_column_names", "SELECT s_suppkey AS clave_n, s_name AS Direccion_y_Ano, s_nationkey AS Pais_ FROM supplier")
def sanitize_column_names(t: Tables):
    df = t.table("supplier").select("s_suppkey", "s_name", "s_nationkey").toDF("clave ñ", "Dirección y Año", "País?")
    return C.sanitize_column_names(df)


@query("strip_prefix", "SELECT DSOFICINA, replace(DSOFICINA, 'OFICINA ', '') AS CIUDAD FROM fx_catalogo")
def strip_prefix(t: Tables):
    return t.catalog.select("DSOFICINA").transform(C.strip_prefix, "DSOFICINA", "CIUDAD", "OFICINA ")


@query("project_columns", "SELECT DNI_PRESTADOR AS dni, CDTAREA AS tarea, CDMUNICIPIO, 'rule_based' AS scenario FROM fx_catalogo")
def project_columns(t: Tables):
    return C.project_columns(
        t.catalog, ["DNI_PRESTADOR", "CDTAREA", "CDMUNICIPIO"], {"DNI_PRESTADOR": "dni", "CDTAREA": "tarea"}, {"scenario": "rule_based"}
    )


@query(
    "fill_null_nan",
    "SELECT DNI_PRESTADOR, coalesce(CASE WHEN CAPACIDAD > 0 THEN PTVALOR_TAREA / CAPACIDAD END, 0) AS v FROM fx_catalogo",
    rounds=["v"],
)
def fill_null_nan(t: Tables):
    v = F.when(F.col("CAPACIDAD") > 0, F.col("PTVALOR_TAREA") / F.col("CAPACIDAD")).when(F.col("CDBLOQUE") > "B4", float("nan"))
    return t.catalog.select("DNI_PRESTADOR", v.alias("v")).transform(C.fill_null_nan, ["v"])


# ---- filters -----------------------------------------------------------------------------------


@query(
    "filter_membership",
    "SELECT NMCONSECUTIVO_ORDEN, CDTAREA FROM fx_citas WHERE DSESTADO_PROGRAMACION IN ('CITA EJECUTADA','PARCIALMENTE EJECUTADO','PARCIALMENTE COMPLETADO')",
)
def filter_membership(t: Tables):
    return t.visits.where(F.col("DSESTADO_PROGRAMACION").isin(*K.VISIT_EXECUTED)).select("NMCONSECUTIVO_ORDEN", "CDTAREA")


@query("filter_null_safe_hard", "SELECT DNI_PRESTADOR, cluster_id FROM o_eligible")
def filter_null_safe_hard(t: Tables):
    from matchwright.plans.recommend import passes_hard_filters

    joined = providers(t).join(t.clusters.select("DNI_PRESTADOR", "cluster_id"), "DNI_PRESTADOR", "left")
    return joined.where(passes_hard_filters()).select("DNI_PRESTADOR", "cluster_id")


@query(
    "filter_conditional_gate",
    "SELECT c.CDTAREA, c.DNI_PRESTADOR, e.cluster_id, e.rm FROM fx_catalogo c JOIN (SELECT DNI_PRESTADOR AS d, cluster_id, alt_cluster = 'A1' AS rm FROM fx_clusters) e "
    "ON c.DNI_PRESTADOR = e.d WHERE NOT e.rm OR e.cluster_id = 3",
)
def filter_conditional_gate(t: Tables):
    from matchwright.plans.recommend import gate

    tagged = t.clusters.select("DNI_PRESTADOR", "cluster_id", (F.col("alt_cluster") == "A1").alias("rm"))
    joined = t.catalog.select("CDTAREA", "DNI_PRESTADOR").join(tagged, "DNI_PRESTADOR")
    return joined.where(gate(F.col("rm"), F.col("cluster_id"))).select("CDTAREA", "DNI_PRESTADOR", "cluster_id", "rm")


@query("drop_null_keys", "SELECT Dni_Empresa, Codigo_Tarea, Clasificacion_Desc FROM fx_ordenado WHERE Clasificacion_Desc IS NOT NULL AND Dni_Empresa IS NOT NULL")
def drop_null_keys(t: Tables):
    return t.orders.select("Dni_Empresa", "Codigo_Tarea", "Clasificacion_Desc").dropna(subset=["Clasificacion_Desc", "Dni_Empresa"])


@query("filter_numeric_range", "SELECT DURACION AS dur FROM fx_citas WHERE DURACION > 0 AND DURACION <= 24", rounds=["dur"])
def filter_numeric_range(t: Tables):
    from matchwright.plans.eda import plausible_durations

    return plausible_durations(t.visits)


@query(
    "token_classify",
    "SELECT Macrosegmentacion_Desc AS s, (coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%GRAN%' OR coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%MEDIANA%' OR coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%CORPORATIVO%') AS is_complex, "
    "(coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%INDEPENDIENTE%' OR coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%MICRO%' OR coalesce(upper(Macrosegmentacion_Desc),'') LIKE '%EMPRESA NUEVA%') AS is_virtual_seg FROM fx_ordenado",
)
def token_classify(t: Tables):
    return t.orders.select(
        F.col("Macrosegmentacion_Desc").alias("s"),
        X.is_complex_segment("Macrosegmentacion_Desc").alias("is_complex"),
        X.is_remote_segment("Macrosegmentacion_Desc").alias("is_virtual_seg"),
    )
