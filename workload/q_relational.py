"""Joins, aggregations, windows, sorts, set operations and scalar expressions."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.functions import expr as X
from matchwright.operators import aggregates as A
from matchwright.operators import joins as J
from matchwright.operators import matching as M
from matchwright.operators import ranks as N
from matchwright.plans import eda
from matchwright.plans import provider_features as PF
from matchwright.plans import recommend as R
from matchwright.sources import readers as SR
from workload.registry import assigned, catalog, company_features, matrix, orders, providers, query, recommended, second_choice
from workload.sqlparts import ARCHETYPE, CAP, DONE, FIELD, LEVEL, LOST, gini, mode, nuniq
from workload.views import Tables

# ---- joins ---------------------------------------------------------------------------------


@query(
    "left_join_enrich",
    "SELECT b.DNI_PRESTADOR, b.n_habilitaciones, c.clasificacion_predominante, t.bloque_principal, m.n_tareas_con_maestro, s.etapa_predominante FROM o_base b "
    "LEFT JOIN o_class c ON b.DNI_PRESTADOR = c.DNI_PRESTADOR LEFT JOIN o_theme t ON b.DNI_PRESTADOR = t.DNI_PRESTADOR "
    "LEFT JOIN o_master m ON b.DNI_PRESTADOR = m.DNI_PRESTADOR LEFT JOIN o_stage s ON b.DNI_PRESTADOR = s.DNI_PRESTADOR",
)
def left_join_enrich(t: Tables):
    return J.left_join_enrich(
        PF.profile_base(t.catalog).select("DNI_PRESTADOR", "n_habilitaciones"),
        A.mode_of(t.catalog, ["DNI_PRESTADOR"], "DSCLASIFICACION", "clasificacion_predominante"),
        PF.main_theme(t.catalog).select("DNI_PRESTADOR", "bloque_principal"),
        PF.master_enrichment(t.catalog, t.master).select("DNI_PRESTADOR", "n_tareas_con_maestro"),
        PF.stage_mode(t.catalog, t.master),
        on="DNI_PRESTADOR",
    )


@query(
    "left_join_renamed_keys",
    "SELECT v.NMCONSECUTIVO_ORDEN, v.DNI_EMPRESA, e.Sector_Economico_Desc FROM fx_citas v LEFT JOIN fx_empresa e ON v.DNI_EMPRESA = e.Empresa_Id",
)
def left_join_renamed_keys(t: Tables):
    return J.left_join_renamed(
        t.visits.select("NMCONSECUTIVO_ORDEN", "DNI_EMPRESA"),
        t.companies.select("Empresa_Id", "Sector_Economico_Desc"),
        {"DNI_EMPRESA": "Empresa_Id"},
    )


@query(
    "inner_join_fanout",
    "SELECT o.codigo_tarea, count(*) AS n_pairs, count(DISTINCT p.DNI_PRESTADOR) AS n_providers FROM o_toscore o JOIN o_pool p ON o.codigo_tarea = p.CDTAREA GROUP BY 1",
)
def inner_join_fanout(t: Tables):
    """Pairs per task of the order x candidate join, from the two key counts: no pair is formed."""
    orders = R.orders_to_score(t.orders).groupBy("codigo_tarea").agg(F.count(F.lit(1)).alias("n_orders"))
    pool = R.candidate_pool(catalog(t), providers(t), matrix(t), t.clusters)
    sizes = pool.groupBy(F.col("CDTAREA").alias("codigo_tarea")).agg(F.count(F.lit(1)).alias("n_providers"))
    joined = orders.join(sizes, "codigo_tarea", "inner")
    return joined.select("codigo_tarea", (F.col("n_orders") * F.col("n_providers")).alias("n_pairs"), "n_providers")


@query("inner_join_restrict", "SELECT CDTAREA, DNI_PRESTADOR, CDMUNICIPIO FROM o_towns")
def inner_join_restrict(t: Tables):
    pool = R.candidate_pool(catalog(t), providers(t), matrix(t), t.clusters)
    pairs = catalog(t).select("CDTAREA", "DNI_PRESTADOR", "CDMUNICIPIO").distinct()
    return J.restrict_to(pairs, pool, ["CDTAREA", "DNI_PRESTADOR"])


@query(
    "semi_join_flag",
    "SELECT o.codigo_tarea, o.cd_municipio_destino, o.dni_empresa, o.Macrosegmentacion_Desc, "
    "EXISTS (SELECT 1 FROM o_towns t WHERE t.CDTAREA = o.codigo_tarea AND t.CDMUNICIPIO = o.cd_municipio_destino) AS has_muni_match, "
    "EXISTS (SELECT 1 FROM o_depts t WHERE t.CDTAREA = o.codigo_tarea AND t.dept = substr(o.cd_municipio_destino, 1, 2)) AS has_depto_match FROM o_toscore o",
)
def semi_join_flag(t: Tables):
    eligible = R.eligible_providers(providers(t), matrix(t), t.clusters)
    towns = R.town_lookup(catalog(t), eligible).withColumnsRenamed({"CDTAREA": "codigo_tarea", "CDMUNICIPIO": "cd_municipio_destino"})
    orders = R.orders_to_score(t.orders).withColumn("dept", X.department("cd_municipio_destino"))
    out = J.flag_members(orders, towns, ["codigo_tarea", "cd_municipio_destino"], "has_muni_match")
    depts = towns.select("codigo_tarea", X.department("cd_municipio_destino").alias("dept"))
    return J.flag_members(out, depts, ["codigo_tarea", "dept"], "has_depto_match").drop("dept")


@query(
    "self_attribute_double_join",
    "SELECT r.dni_empresa, r.codigo_tarea, r.cd_municipio_destino, r.dni_prestador_hist, r.dni_prestador_model, r.muni_base_hist, r.muni_base_model FROM o_replay r",
)
def self_attribute_double_join(t: Tables):
    from matchwright.plans.kpis import replay_table

    return replay_table(orders(t), assigned(t), providers(t)).select(
        *K.ORDER_KEY, "dni_prestador_hist", "dni_prestador_model", "muni_base_hist", "muni_base_model"
    )


@query(
    "scenario_inner_join",
    "SELECT count(*) AS n_both, (SELECT count(*) FROM o_assign) - count(*) AS n_only_first FROM o_scen",
)
def scenario_inner_join(t: Tables):
    from matchwright.plans.kpis import scenario_pairs

    both = scenario_pairs(assigned(t), second_choice(t)).agg(F.count(F.lit(1)).alias("n_both"))
    total = assigned(t).agg(F.count(F.lit(1))).scalar()
    return both.withColumn("n_only_first", total - F.col("n_both"))


@query("label_lookup_join", f"SELECT DNI_PRESTADOR, cluster_id, {ARCHETYPE} AS archetype_name FROM fx_clusters")
def label_lookup_join(t: Tables):
    return J.attach_label(t.clusters.select("DNI_PRESTADOR", "cluster_id"), "cluster_id", K.ARCHETYPES, "archetype_name")


@query(
    "merge_composite_key",
    """SELECT v.NMCONSECUTIVO_ORDEN, v.DNI_PRESTADOR, upper(trim(v.CLASIFICACION)) AS CLASIFICACION, b.PTVALOR_TAREA, b.CDBLOQUE FROM fx_citas v LEFT JOIN (
    SELECT DNI_PRESTADOR AS d, DSCLASIFICACION AS k, PTVALOR_TAREA, CDBLOQUE, row_number() OVER (PARTITION BY DNI_PRESTADOR, DSCLASIFICACION ORDER BY PTVALOR_TAREA DESC NULLS LAST, CDBLOQUE) AS rn
    FROM fx_catalogo) b ON b.rn = 1 AND v.DNI_PRESTADOR = b.d AND upper(trim(v.CLASIFICACION)) = upper(trim(b.k))""",
    rounds=["PTVALOR_TAREA"],
)
def merge_composite_key(t: Tables):
    tasks = t.visits.select("NMCONSECUTIVO_ORDEN", "DNI_PRESTADOR", "CLASIFICACION")
    offers = t.catalog.select("DNI_PRESTADOR", "DSCLASIFICACION", "PTVALOR_TAREA", "CDBLOQUE")
    return J.merge_composite_key(tasks, offers)


# ---- aggregations ----------------------------------------------------------------------------


@query(
    "agg_group_counts",
    f"SELECT DNI_PRESTADOR, count(*) AS n, count(FEENVIO_INFORME) AS n_env, count(*) FILTER (WHERE {LOST}) AS n_cancel FROM fx_citas GROUP BY 1",
)
def agg_group_counts(t: Tables):
    return t.visits.groupBy("DNI_PRESTADOR").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("FEENVIO_INFORME").alias("n_env"),
        A.count_where(F.col("DSESTADO_PROGRAMACION") == K.VISIT_CANCELLED).alias("n_cancel"),
    )


@query(
    "agg_filtered",
    f"SELECT DNI_PRESTADOR, avg(DURACION) FILTER (WHERE {DONE}) AS media, coalesce(sum(DURACION) FILTER (WHERE {DONE}), 0) AS total, "
    f"count(DISTINCT CASE WHEN {FIELD} THEN CDTAREA END) AS tareas FROM fx_citas GROUP BY 1",
    rounds=["media", "total"],
)
def agg_filtered(t: Tables):
    done = F.col("DSESTADO_PROGRAMACION").isin(*K.VISIT_EXECUTED)
    return t.visits.groupBy("DNI_PRESTADOR").agg(
        F.avg(F.when(done, F.col("DURACION"))).alias("media"),
        A.sum0(F.when(done, F.col("DURACION"))).alias("total"),
        F.count_distinct(F.when(F.col("TIPO_PROGRAMACION") == K.VISIT_FIELD, F.col("CDTAREA"))).alias("tareas"),
    )


@query("agg_distinct", f"SELECT Dni_Empresa, {nuniq('Clasificacion_Desc')} AS n_clas, {nuniq('Codigo_Tarea')} AS n_tar FROM fx_ordenado GROUP BY 1")
def agg_distinct(t: Tables):
    return t.orders.groupBy("Dni_Empresa").agg(
        A.distinct_with_null("Clasificacion_Desc").alias("n_clas"), A.distinct_with_null("Codigo_Tarea").alias("n_tar")
    )


@query("agg_any", "SELECT DNI_PRESTADOR, coalesce(bool_or(TIPO_DE_RED = 'ESTRATEGICA'), false) AS f, coalesce(bool_or(CAPACIDAD = 0), false) AS g FROM fx_catalogo GROUP BY 1")
def agg_any(t: Tables):
    return t.catalog.groupBy("DNI_PRESTADOR").agg(
        A.any_true(F.col("TIPO_DE_RED") == K.STRATEGIC_NETWORK).alias("f"), A.any_true(F.col("CAPACIDAD") == 0).alias("g")
    )


@query("agg_first", "SELECT * FROM o_attr", rounds=["capacidad"])
def agg_first(t: Tables):
    named = A.representative_row(t.catalog, ["DNI_PRESTADOR"], list(PF.ATTRIBUTES))
    return named.withColumnsRenamed(PF.ATTRIBUTES)


@query(
    "agg_min_max_dates",
    "SELECT Dni_Prestador, min(Fecha_Creacion_Orden) AS primera, max(Fecha_Creacion_Orden) AS ultima FROM fx_ordenado GROUP BY 1",
    dates=["primera", "ultima"],
)
def agg_min_max_dates(t: Tables):
    return t.orders.groupBy("Dni_Prestador").agg(
        F.min("Fecha_Creacion_Orden").alias("primera"), F.max("Fecha_Creacion_Orden").alias("ultima")
    )


@query("agg_mode", mode("fx_ordenado", "Dni_Empresa", "Clasificacion_Desc", "moda"))
def agg_mode(t: Tables):
    return A.mode_of(t.orders, ["Dni_Empresa"], "Clasificacion_Desc", "moda")


@query(
    "agg_top_group_with_ratio",
    "SELECT t.DNI_PRESTADOR, t.cdbloque_principal AS CDBLOQUE, t.n_tareas_bloque_principal AS n_items, b.n_tareas_distintas AS n_total, "
    "cast(t.n_tareas_bloque_principal AS double) / b.n_tareas_distintas AS ratio FROM o_theme t JOIN o_base b ON t.DNI_PRESTADOR = b.DNI_PRESTADOR",
    rounds=["ratio"],
)
def agg_top_group_with_ratio(t: Tables):
    return A.top_group_with_ratio(t.catalog, "DNI_PRESTADOR", ["CDBLOQUE"], "CDTAREA")


@query(
    "agg_boolean_mean",
    "SELECT Ruta_Atencion, avg(CASE WHEN coalesce(ESTADO_EMPRESA = 'RETIRADO', false) THEN 1.0 ELSE 0.0 END) AS a, "
    "avg(CASE WHEN Segmentacion_Arl_Desc IS NULL THEN NULL WHEN Segmentacion_Arl_Desc IN ('Gran Empresa','Mediana Empresa') THEN 1.0 ELSE 0.0 END) AS b FROM fx_empresa GROUP BY 1",
    rounds=["a", "b"],
)
def agg_boolean_mean(t: Tables):
    retired = F.coalesce(F.col("ESTADO_EMPRESA") == K.COMPANY_WITHDRAWN, F.lit(False))
    return t.companies.groupBy("Ruta_Atencion").agg(
        A.share_true(retired).alias("a"), A.share_true(F.col("Segmentacion_Arl_Desc").isin(*K.COMPLEX_SEGMENTS)).alias("b")
    )


@query(
    "agg_median",
    "SELECT DNI_PRESTADOR, median(DURACION) AS mediana FROM fx_citas WHERE DURACION IS NOT NULL GROUP BY 1",
    rounds=["mediana"],
)
def agg_median(t: Tables):
    return A.median_of(t.visits, ["DNI_PRESTADOR"], "DURACION", "mediana")


@query(
    "agg_quantiles",
    "SELECT quantile_cont(l_extendedprice, 0.25) AS p25, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.75) AS p75, quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem",
    rounds=["p25", "p50", "p75", "p95"],
)
def agg_quantiles(t: Tables):
    return A.quantiles_of(t.table("lineitem"), [], "l_extendedprice", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})


@query(
    "agg_describe",
    """SELECT count(n) AS count, avg(n) AS mean, stddev_samp(n) AS std, cast(min(n) AS double) AS min, cast(max(n) AS double) AS max, count(*) FILTER (WHERE n > 500) AS n_over_0,
    count(*) FILTER (WHERE n > 1000) AS n_over_1, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75
    FROM (SELECT cast(count(*) AS double) AS n FROM fx_ordenado GROUP BY Dni_Prestador)""",
    rounds=["mean", "std", "min", "max", "p25", "p50", "p75"],
)
def agg_describe(t: Tables):
    return A.describe_values(eda.loads_by_provider(t.orders), "n_ordenes", over=(500, 1000))


@query(
    "agg_histogram",
    """SELECT cast(least(floor((v - lo) / ((hi - lo) / 48)), 47) AS bigint) AS bin, count(*) AS n, min(v) AS min_value, max(v) AS max_value
    FROM (SELECT l_extendedprice AS v, min(l_extendedprice) OVER () AS lo, max(l_extendedprice) OVER () AS hi FROM lineitem) GROUP BY 1""",
    rounds=["min_value", "max_value"],
)
def agg_histogram(t: Tables):
    return A.fixed_histogram(t.table("lineitem"), "l_extendedprice", 48)


@query(
    "agg_global_distinct",
    """SELECT 'prestadores' AS indicador, count(DISTINCT DNI_PRESTADOR) AS valor FROM fx_catalogo UNION ALL SELECT 'distribuidores', count(DISTINCT DNI_DISTRIBUIDOR) FROM fx_catalogo
    UNION ALL SELECT 'oficinas', count(DISTINCT DSOFICINA) FROM fx_catalogo UNION ALL SELECT 'tareas', count(DISTINCT CDTAREA) FROM fx_catalogo
    UNION ALL SELECT 'productos', count(DISTINCT CDPRODUCTO) FROM fx_catalogo UNION ALL SELECT 'bloques', count(DISTINCT CDBLOQUE) FROM fx_catalogo
    UNION ALL SELECT 'empresas', count(DISTINCT Empresa_Id) FROM fx_empresa UNION ALL SELECT 'empresas_activas', count(*) FROM fx_empresa WHERE ESTADO_EMPRESA_CALCULADO
    UNION ALL SELECT 'ordenes', count(*) FROM fx_ordenado UNION ALL SELECT 'programaciones', count(*) FROM fx_citas""",
)
def agg_global_distinct(t: Tables):
    return eda.operation_size(t.catalog, t.companies, t.orders, t.visits)


@query("agg_struct_distinct", "SELECT count(*) AS n_orders FROM (SELECT DISTINCT Dni_Empresa, Codigo_Tarea, Municipio_Entrega_Id FROM fx_ordenado)")
def agg_struct_distinct(t: Tables):
    return A.distinct_key_count(t.orders, ["Dni_Empresa", "Codigo_Tarea", "Municipio_Entrega_Id"], "n_orders")


@query(
    "agg_gini",
    f"SELECT {gini('(SELECT count(*) AS n FROM fx_ordenado GROUP BY Dni_Prestador)', 'n')} AS gini",
    rounds=["gini"],
)
def agg_gini(t: Tables):
    return N.gini(eda.loads_by_provider(t.orders), "n_ordenes")


@query(
    "agg_gini_amounts",
    "SELECT o_orderstatus, 2.0 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*) AS gini FROM (SELECT o_orderstatus, o_totalprice AS v, "
    "row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS i FROM orders) GROUP BY 1",
    rounds=["gini"],
)
def agg_gini_amounts(t: Tables):
    return N.gini(t.table("orders"), "o_totalprice", ["o_orderstatus"])


@query(
    "agg_lorenz_curve",
    """SELECT v AS load_value, c AS n_members, pc / n AS pop_share, lc / s AS cum_share FROM (
    SELECT v, c, sum(c) OVER (ORDER BY v) AS pc, sum(c * v) OVER (ORDER BY v) AS lc, sum(c) OVER () AS n, sum(c * v) OVER () AS s FROM (
    SELECT cast(n AS double) AS v, count(*) AS c FROM (SELECT count(*) AS n FROM fx_ordenado GROUP BY Dni_Prestador) GROUP BY 1))""",
    rounds=["load_value", "pop_share", "cum_share"],
)
def agg_lorenz_curve(t: Tables):
    return N.lorenz_curve(eda.loads_by_provider(t.orders), "n_ordenes").select("load_value", "n_members", "pop_share", "cum_share")


@query(
    "agg_lorenz_summary",
    """SELECT n AS n_members, s AS total_load, 1 - 2 * area AS gini, 1 - cut AS top_share FROM (
    SELECT max(n) AS n, max(s) AS s, sum(CASE WHEN i > 1 THEN (c + pc) / 2 / n END) AS area, max(CASE WHEN i = floor(0.9 * n) + 1 THEN c END) AS cut FROM (
    SELECT i, n, s, c, lag(c) OVER (ORDER BY i) AS pc FROM (
    SELECT row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n, sum(v) OVER () AS s, sum(v) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(v) OVER () AS c
    FROM (SELECT cast(count(*) AS double) AS v FROM fx_ordenado GROUP BY Dni_Prestador))))""",
    rounds=["total_load", "gini", "top_share"],
)
def agg_lorenz_summary(t: Tables):
    return N.lorenz_summary(eda.loads_by_provider(t.orders), "n_ordenes")


@query(
    "agg_pivot_confusion",
    "SELECT cluster_id, count(*) FILTER (WHERE alt_cluster = 'A0') AS A0, count(*) FILTER (WHERE alt_cluster = 'A1') AS A1, count(*) FILTER (WHERE alt_cluster = 'A2') AS A2 FROM fx_clusters GROUP BY 1",
)
def agg_pivot_confusion(t: Tables):
    return A.confusion_counts(t.clusters, "cluster_id", "alt_cluster")


@query(
    "agg_value_distribution",
    "SELECT Estado_Orden_Desc AS value, count(*) AS n, cast(count(*) AS double) / (SELECT count(*) FROM fx_ordenado) AS share FROM fx_ordenado GROUP BY 1",
    rounds=["share"],
)
def agg_value_distribution(t: Tables):
    return A.value_distribution(t.orders, "Estado_Orden_Desc")


@query(
    "agg_top_n_others",
    """WITH k AS (SELECT Clasificacion_Desc, count(*) AS n FROM fx_ordenado GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, Clasificacion_Desc NULLS LAST) AS rn FROM k)
    SELECT Clasificacion_Desc, n FROM r WHERE rn <= 5 UNION ALL SELECT 'Otros', cast(sum(n) AS bigint) FROM r WHERE rn > 5 HAVING sum(n) > 0""",
)
def agg_top_n_others(t: Tables):
    return A.top_n_with_others(t.orders, "Clasificacion_Desc", 5)


@query(
    "agg_threshold_others",
    """SELECT CASE WHEN cast(n AS double) / tot >= 0.05 THEN Tipo_Red_Desc ELSE 'Otros' END AS Tipo_Red_Desc, cast(sum(n) AS bigint) AS n FROM (
    SELECT Tipo_Red_Desc, count(*) AS n, sum(count(*)) OVER () AS tot FROM fx_ordenado GROUP BY 1) GROUP BY 1""",
)
def agg_threshold_others(t: Tables):
    return A.fold_below_share(t.orders, "Tipo_Red_Desc", 0.05)


@query(
    "agg_top_k_groups",
    "SELECT Nombre_Regional, count(*) AS n FROM fx_ordenado GROUP BY 1 ORDER BY n DESC, Nombre_Regional NULLS LAST LIMIT 5",
)
def agg_top_k_groups(t: Tables):
    return A.top_k_groups(t.orders, "Nombre_Regional", 5)


# ---- windows -----------------------------------------------------------------------------------

RANKED = (
    "SELECT DSOFICINA, DNI_PRESTADOR, CDTAREA, PTVALOR_TAREA, rank FROM (SELECT *, row_number() OVER (PARTITION BY CDTAREA ORDER BY PTVALOR_TAREA DESC, DNI_PRESTADOR, CDMUNICIPIO) AS rank FROM fx_catalogo) "
)


@query("rank_ordinal_over", RANKED + "WHERE rank <= 10", rounds=["PTVALOR_TAREA"])
def rank_ordinal_over(t: Tables):
    order = [F.desc("PTVALOR_TAREA"), F.asc("DNI_PRESTADOR"), F.asc("CDMUNICIPIO")]
    return J.rank_within(t.catalog, ["CDTAREA"], order, 10).select("DSOFICINA", "DNI_PRESTADOR", "CDTAREA", "PTVALOR_TAREA", "rank")


@query("top1_of_ranked", RANKED + "WHERE rank = 1", rounds=["PTVALOR_TAREA"])
def top1_of_ranked(t: Tables):
    order = [F.desc("PTVALOR_TAREA"), F.asc("DNI_PRESTADOR"), F.asc("CDMUNICIPIO")]
    return J.rank_within(t.catalog, ["CDTAREA"], order, 1).select("DSOFICINA", "DNI_PRESTADOR", "CDTAREA", "PTVALOR_TAREA", "rank")


@query(
    "keep_first_sorted",
    "SELECT DNI_PRESTADOR, DSCLASIFICACION, PTVALOR_TAREA, CDTAREA FROM (SELECT *, row_number() OVER (PARTITION BY DNI_PRESTADOR, DSCLASIFICACION ORDER BY PTVALOR_TAREA DESC, CDTAREA) AS rn FROM fx_catalogo) WHERE rn = 1",
    rounds=["PTVALOR_TAREA"],
)
def keep_first_sorted(t: Tables):
    df = t.catalog.select("DNI_PRESTADOR", "DSCLASIFICACION", "PTVALOR_TAREA", "CDTAREA")
    return J.keep_first(df, ["DNI_PRESTADOR", "DSCLASIFICACION"], [F.desc("PTVALOR_TAREA"), F.asc("CDTAREA")])


@query(
    "cumulative_share",
    """SELECT position, Dni_Prestador, n, pct, round(sum(pct) OVER (ORDER BY position ROWS UNBOUNDED PRECEDING), 2) AS pct_running FROM (
    SELECT row_number() OVER (ORDER BY n DESC, Dni_Prestador) AS position, Dni_Prestador, n, round(n * 100.0::double / tot, 2) AS pct FROM (
    SELECT Dni_Prestador, count(*) AS n, sum(count(*)) OVER () AS tot FROM fx_ordenado GROUP BY 1)) WHERE position <= 20""",
    rounds=["pct", "pct_running"],
)
def cumulative_share(t: Tables):
    return A.cumulative_share(t.orders, "Dni_Prestador", 20)


# ---- sort, limit, sets -----------------------------------------------------------------------------


@query("sort_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", rounds=["o_totalprice"])
def sort_head(t: Tables):
    return t.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("sort_multi", "SELECT DNI_PRESTADOR, alt_cluster, cluster_id FROM fx_clusters ORDER BY alt_cluster, cluster_id, DNI_PRESTADOR")
def sort_multi(t: Tables):
    return t.clusters.select("DNI_PRESTADOR", "alt_cluster", "cluster_id").orderBy("alt_cluster", "cluster_id", "DNI_PRESTADOR")


@query(
    "sample_rows",
    "SELECT Ord_Plan_Vers_Act_Id, Codigo_Tarea FROM fx_ordenado WHERE cast('0x' || substr(md5('42|' || coalesce(cast(Ord_Plan_Vers_Act_Id AS string), '')), 1, 8) AS bigint) < 429496729",
)
def sample_rows(t: Tables):
    return SR.sample_rows(t.orders.select("Ord_Plan_Vers_Act_Id", "Codigo_Tarea"), ["Ord_Plan_Vers_Act_Id"], 0.1)


@query(
    "union_all_scenarios",
    "SELECT dni_prestador, cluster_id, score_total, 'first' AS scenario FROM o_assign UNION ALL SELECT dni_prestador, cluster_id, score_total, 'second' FROM o_second",
    rounds=["score_total"],
)
def union_all_scenarios(t: Tables):
    def part(df, name):
        return df.select("dni_prestador", "cluster_id", "score_total", F.lit(name).alias("scenario"))

    return part(assigned(t), "first").unionByName(part(second_choice(t), "second"))


@query("distinct_projection", "SELECT DISTINCT DNI_PRESTADOR, CDTAREA FROM fx_catalogo")
def distinct_projection(t: Tables):
    return t.catalog.select("DNI_PRESTADOR", "CDTAREA").distinct()


@query(
    "set_difference_keys",
    "SELECT DISTINCT dni_empresa, codigo_tarea, cd_municipio_destino FROM o_toscore EXCEPT SELECT dni_empresa, codigo_tarea, cd_municipio_destino FROM o_assign",
)
def set_difference_keys(t: Tables):
    return M.set_difference_keys(R.orders_to_score(orders(t)), assigned(t))


# ---- scalar expressions --------------------------------------------------------------------------


@query("safe_ratio", "SELECT DNI_PRESTADOR, CDTAREA, CASE WHEN CAPACIDAD > 0 THEN PTVALOR_TAREA / CAPACIDAD END AS r FROM fx_catalogo", rounds=["r"])
def safe_ratio(t: Tables):
    return t.catalog.select("DNI_PRESTADOR", "CDTAREA", X.ratio("PTVALOR_TAREA", "CAPACIDAD").alias("r"))


@query("case_ladder", f"SELECT Empresa_Id, {LEVEL} AS nivel FROM fx_empresa")
def case_ladder(t: Tables):
    return t.companies.select("Empresa_Id", X.complexity_level("Ruta_Atencion").alias("nivel"))


@query(
    "regex_category_ladder",
    """SELECT DSBLOQUE, CASE WHEN u LIKE '%HERRAMIENTA%' THEN 'DESEMPEÑO HUMANO' WHEN u LIKE '%LECTURA DEL ENTORNO%' THEN 'LECTURA DEL ENTORNO' WHEN u LIKE '%EDUCACI%' THEN 'EDUCACION'
    WHEN u LIKE '%INFORMACI%' THEN 'INFORMACION SG-SST' WHEN u LIKE '%EVENTO%' THEN 'EVENTOS' WHEN u LIKE '%EMERGENCIA%' THEN 'EMERGENCIAS' WHEN u LIKE '%ECONOMIA%' THEN 'PREVENCION'
    WHEN u LIKE '%ESPECIALIZADO%' THEN 'ESPECIALIZADOS' WHEN regexp_matches(u, 'CAMBIO|ESTRATEGICA|CULTURA|ENTORNO SEGURO') THEN 'ESTRATEGIA Y CAMBIO' ELSE 'GENERAL Y OTROS' END AS familia
    FROM (SELECT DSBLOQUE, upper(coalesce(DSBLOQUE, '')) AS u FROM fx_catalogo)""",
)
def regex_category_ladder(t: Tables):
    return t.catalog.select("DSBLOQUE", X.theme_family("DSBLOQUE").alias("familia"))


@query("tent_function", f"SELECT DNI_PRESTADOR, {CAP} AS s FROM o_provider", rounds=["s"])
def tent_function(t: Tables):
    return providers(t).select("DNI_PRESTADOR", X.capacity_score("utilizacion_capacidad").alias("s"))


@query(
    "clip",
    "SELECT c_custkey, greatest(c_acctbal, 0) AS low, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE least(greatest(c_acctbal / 5000, 0), 1) END AS unit FROM customer",
    rounds=["low", "unit"],
)
def clip(t: Tables):
    unit = F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") / 5000)
    return t.table("customer").select("c_custkey", X.clamp(F.col("c_acctbal"), 0.0).alias("low"), X.clamp(unit, 0.0, 1.0).alias("unit"))


CONTRIB = (
    "CASE WHEN a >= b AND a >= c AND a >= d THEN 'Especialización' WHEN b >= c AND b >= d THEN 'Capacidad' WHEN c >= d THEN 'Geográfico' ELSE 'Desempeño' END AS top_contributor"
)
PARTS = (
    "(SELECT *, 0.45::double * score_specialization AS a, 0.30::double * score_capacity AS b, 0.15::double * score_geo AS c, 0.10::double * score_performance AS d FROM o_top10)"
)


@query("argmax_label", f"SELECT dni_empresa, codigo_tarea, cd_municipio_destino, rank, {CONTRIB} FROM {PARTS}")
def argmax_label(t: Tables):
    parts = ["score_specialization", "score_capacity", "score_geo", "score_performance"]
    ranked = recommended(t, columns=[*K.ORDER_KEY, "rank", *parts])
    return ranked.select(*K.ORDER_KEY, "rank", X.top_contributor().alias("top_contributor"))


def _figure(c: str) -> str:
    """A figure as the reason in words shows it: rounded half up in decimals."""
    return f"cast(cast(round(cast(coalesce({c}, 0) AS decimal(28,12)), 2) AS double) AS string)"


@query(
    "format_rationale",
    f"""SELECT p.DNI_PRESTADOR, coalesce({ARCHETYPE}, '(sin nombre)') || ' · perfil=' || coalesce(tipo_perfil, '?') || ' · util=' || {_figure("utilizacion_capacidad")}
    || ' · exec=' || {_figure("tasa_ejecucion")} || ' · cancel=' || {_figure("tasa_cancela_real_prestador")} AS rationale
    FROM o_provider p JOIN (SELECT DNI_PRESTADOR AS d, cluster_id FROM fx_clusters) c ON p.DNI_PRESTADOR = c.d""",
)
def format_rationale(t: Tables):
    joined = providers(t).join(t.clusters.select("DNI_PRESTADOR", "cluster_id"), "DNI_PRESTADOR").withColumn("archetype_name", X.archetype("cluster_id"))
    return joined.select("DNI_PRESTADOR", X.rationale().alias("rationale"))


@query("string_prefix_match", "SELECT DNI_PRESTADOR, CDMUNICIPIO, substr(CDMUNICIPIO, 1, 2) AS depto FROM fx_catalogo")
def string_prefix_match(t: Tables):
    return t.catalog.select("DNI_PRESTADOR", "CDMUNICIPIO", X.department("CDMUNICIPIO").alias("depto"))


@query(
    "array_contains_match",
    "SELECT DNI_PRESTADOR, count(DISTINCT CDMUNICIPIO) AS n_towns, bool_or(CDMUNICIPIO = '1111') AS hit FROM fx_catalogo GROUP BY 1",
)
def array_contains_match(t: Tables):
    """Towns per provider as a set: distinct pairs first, so the set is as long as the town list."""
    towns = t.catalog.select("DNI_PRESTADOR", "CDMUNICIPIO").distinct().groupBy("DNI_PRESTADOR").agg(F.collect_set("CDMUNICIPIO").alias("munis"))
    return towns.select("DNI_PRESTADOR", F.size("munis").cast("bigint").alias("n_towns"), F.array_contains("munis", "1111").alias("hit"))


@query(
    "date_diff_days",
    "SELECT NMCONSECUTIVO_ORDEN, CDTAREA, date_diff('day', FEENVIO_INFORME, FEAPROBACION_INFORME) AS ciclo, date_diff('day', FEPROGRAMACION, DATE '2026-04-08') AS edad FROM fx_citas",
)
def date_diff_days(t: Tables):
    return t.visits.select(
        "NMCONSECUTIVO_ORDEN",
        "CDTAREA",
        F.date_diff("FEAPROBACION_INFORME", "FEENVIO_INFORME").alias("ciclo"),
        F.date_diff(F.lit(K.TENURE_CUTOFF).cast("date"), "FEPROGRAMACION").alias("edad"),
    )


@query(
    "classify_role",
    """SELECT TIPO_DE_ASESOR, CASE WHEN u LIKE '%OPERACIONES%' OR u LIKE '%LINEA DE ATENCION%' THEN 'Soporte y Operaciones'
    WHEN u LIKE '%ASIGNADO%' OR u LIKE '%OTRO ASESOR%' OR u LIKE '%INTEGRAL%' OR u LIKE '%HIGIENE%' THEN 'Otros / Especiales'
    WHEN (CASE WHEN u LIKE '%PREVENCION%' OR u LIKE '%PREVENCIÓN%' THEN 1 ELSE 0 END) + (CASE WHEN u LIKE '%RIESGOS%' THEN 1 ELSE 0 END) + (CASE WHEN u LIKE '%PROYECTOS%' THEN 1 ELSE 0 END) >= 2 THEN 'Mixto (Core)'
    WHEN u LIKE '%PREVENCION%' OR u LIKE '%PREVENCIÓN%' THEN 'Prevención' WHEN u LIKE '%RIESGOS%' THEN 'Riesgos' WHEN u LIKE '%PROYECTOS%' THEN 'Proyectos' ELSE 'Otros / Especiales' END AS ROL_ASESOR
    FROM (SELECT TIPO_DE_ASESOR, upper(coalesce(TIPO_DE_ASESOR, '')) AS u FROM fx_citas)""",
)
def classify_role(t: Tables):
    return t.visits.select("TIPO_DE_ASESOR", X.advisor_role("TIPO_DE_ASESOR").alias("ROL_ASESOR"))


@query(
    "classify_function",
    """SELECT FUNCION_PRESTADOR, CASE WHEN p + r + y + i + l + a >= 2 THEN 'MIXTO' WHEN p = 1 THEN 'PREVENCION' WHEN r = 1 THEN 'RIESGOS' WHEN y = 1 THEN 'PROYECTOS' WHEN i = 1 THEN 'INTEGRAL'
    WHEN l = 1 THEN 'LINEA DE ATENCION' WHEN a = 1 THEN 'ASIGNADO' ELSE 'OTROS' END AS MACRO_FUNCION FROM (
    SELECT FUNCION_PRESTADOR, CASE WHEN u LIKE '%PREVENCION%' OR u LIKE '%PREVENCIÓN%' THEN 1 ELSE 0 END AS p, CASE WHEN u LIKE '%RIESGOS%' THEN 1 ELSE 0 END AS r, CASE WHEN u LIKE '%PROYECTOS%' THEN 1 ELSE 0 END AS y,
    CASE WHEN u LIKE '%INTEGRAL%' THEN 1 ELSE 0 END AS i, CASE WHEN u LIKE '%LINEA DE ATENCION%' OR u LIKE '%LÍNEA DE ATENCIÓN%' THEN 1 ELSE 0 END AS l, CASE WHEN u LIKE '%ASIGNADO%' THEN 1 ELSE 0 END AS a
    FROM (SELECT FUNCION_PRESTADOR, upper(coalesce(FUNCION_PRESTADOR, '')) AS u FROM fx_catalogo))""",
)
def classify_function(t: Tables):
    return t.catalog.select("FUNCION_PRESTADOR", X.provider_function("FUNCION_PRESTADOR").alias("MACRO_FUNCION"))
