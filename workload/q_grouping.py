"""Outlier quarantine, scaling, PCA, k-means, quality figures and group descriptions."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from matchwright import constants as K
from matchwright.operators import aggregates as A
from matchwright.operators import forest as OF
from matchwright.operators import quality as Q
from matchwright.operators.kmeans import fit_many
from matchwright.plans import grouping as G
from matchwright.session import scratch_path, stage
from workload.registry import matrix, providers, query
from workload.sqlparts import ARCHETYPE
from workload.views import Tables, cte

FEATURES = list(K.FEATURES)
DIMS = 64
AXES = [f"e{i}" for i in range(DIMS)]


def points(t: Tables):
    """embeddings as vec_id, label, x: numeric input whose size grows with the data."""
    return t.table("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def wide(t: Tables):
    return t.table("embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(a) for i, a in enumerate(AXES)])


cte("o_points", "SELECT vec_id, label, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) AS d FROM embeddings")
cte("o_centres", "SELECT label, d, avg(v) AS m, count(*) AS n FROM o_points GROUP BY label, d")
cte(
    "o_pairs",
    "SELECT p.vec_id, p.label, q.label AS other, p.vec_id <> q.vec_id AS apart, sqrt(list_sum(list_transform(list_zip(p.embedding, q.embedding), lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double)))) AS dist "
    "FROM embeddings p, embeddings q",
)
cte(
    "o_sil",
    """SELECT i.vec_id, i.label, CASE WHEN i.n = 0 THEN 0.0 ELSE (o.b - i.a) / greatest(i.a, o.b) END AS s FROM (
    SELECT vec_id, label, count(*) FILTER (WHERE apart) AS n, coalesce(avg(dist) FILTER (WHERE apart), 0) AS a FROM o_pairs WHERE label = other GROUP BY 1, 2) i JOIN (
    SELECT vec_id, min(m) AS b FROM (SELECT vec_id, other, avg(dist) AS m FROM o_pairs WHERE label <> other GROUP BY 1, 2) GROUP BY 1) o ON i.vec_id = o.vec_id""",
)


@query("outlier_quarantine")
def outlier_quarantine(t: Tables):
    return OF.outlier_quarantine(wide(t), "vec_id", AXES).select("vec_id", "outlier_score", "is_inlier")


@query("outlier_quarantine_providers")
def outlier_quarantine_providers(t: Tables):
    prepared = G.model_matrix(matrix(t)).select(G.WHO, *FEATURES)
    return OF.outlier_quarantine(prepared, G.WHO, FEATURES).select(G.WHO, "outlier_score", "is_inlier")


SCALED = FEATURES


@query(
    "robust_scale",
    "SELECT DNI_PRESTADOR, "
    + ", ".join(
        f"(m.{c} - (SELECT median({c}) FROM o_matrix)) / (SELECT CASE WHEN w = 0 THEN 1 ELSE w END FROM (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS w FROM o_matrix)) AS {c}"
        for c in SCALED
    )
    + " FROM o_matrix m",
    rounds=SCALED,
)
def robust_scale(t: Tables):
    return G.robust_scale(matrix(t).select(G.WHO, *SCALED), SCALED)


@query("robust_scale_sketch")
def robust_scale_sketch(t: Tables):
    df = wide(t)
    fitted = G.robust_scaler(AXES).fit(df)
    return fitted.transform(df).select("vec_id", vector_to_array("scaled").alias("scaled")).select("vec_id", *[F.get("scaled", F.lit(i)).alias(a) for i, a in enumerate(AXES)])


@query("pca_by_variance")
def pca_by_variance(t: Tables):
    """All kept axes of every point, in long form."""
    df = wide(t)
    model, n, kept = G.pca_by_variance(df, AXES)
    out = model.transform(df).select("vec_id", vector_to_array("projected").alias("p"))
    return out.select("vec_id", F.lit(n).alias("n_components"), F.lit(kept).alias("variance"), F.posexplode("p").alias("axis", "value"))


@query(
    "pca_identities",
    "SELECT (SELECT sum(v) FROM (SELECT var_samp(v) AS v FROM o_points GROUP BY d)) AS total_variance, 0.0 AS largest_covariance",
    rounds=["total_variance", "largest_covariance"],
)
def pca_identities(t: Tables):
    """The axes keep the whole variance and do not vary together: one pass over all pairs of axes."""
    df = wide(t)
    model, _, _ = G.pca_by_variance(df, AXES)
    rotated = model.transform(df).select("vec_id", F.posexplode(vector_to_array("rotated")).alias("axis", "v"))
    other = rotated.select("vec_id", F.col("axis").alias("axis2"), F.col("v").alias("v2"))
    cov = rotated.join(other, "vec_id").where("axis <= axis2").groupBy("axis", "axis2").agg(F.covar_samp("v", "v2").alias("c"))
    same = F.col("axis") == F.col("axis2")
    return cov.agg(F.sum(F.when(same, F.col("c"))).alias("total_variance"), F.max(F.when(~same, F.abs("c"))).alias("largest_covariance"))


def projected(t: Tables):
    df = wide(t)
    model, _, _ = G.pca_by_variance(df, AXES)
    return model.transform(df).select("vec_id", "projected")


@query("kmeans_grid")
def kmeans_grid(t: Tables):
    grid, _ = G.kmeans_grid(projected(t), key="vec_id")
    return grid


@query(
    "silhouette_points",
    "SELECT * FROM o_sil",
    rounds=["s"],
    digits=5,
)
def silhouette_points(t: Tables):
    return Q.silhouette_points(points(t), "x", "label", "vec_id")


@query(
    "squared_silhouette_points",
    """SELECT i.vec_id, i.label, CASE WHEN i.n = 0 OR greatest(i.a, o.b) = 0 THEN 0.0 ELSE (o.b - i.a) / greatest(i.a, o.b) END AS s FROM (
    SELECT vec_id, label, count(*) FILTER (WHERE apart) AS n, coalesce(avg(dist * dist) FILTER (WHERE apart), 0) AS a FROM o_pairs WHERE label = other GROUP BY 1, 2) i JOIN (
    SELECT vec_id, min(m) AS b FROM (SELECT vec_id, other, avg(dist * dist) AS m FROM o_pairs WHERE label <> other GROUP BY 1, 2) GROUP BY 1) o ON i.vec_id = o.vec_id""",
    rounds=["s"],
    digits=5,
)
def squared_silhouette_points(t: Tables):
    return Q.squared_silhouette_points(points(t), "x", "label", "vec_id")


@query("silhouette", "SELECT avg(s) AS silhouette FROM o_sil", rounds=["silhouette"])
def silhouette(t: Tables):
    return Q.silhouette(points(t), "x", "label", "vec_id")


@query(
    "calinski_harabasz",
    """SELECT (b / (k - 1)) / (w / (n - k)) AS calinski_harabasz FROM (SELECT
    (SELECT sum(c.n * (c.m - g.m) * (c.m - g.m)) FROM o_centres c JOIN (SELECT d, avg(v) AS m FROM o_points GROUP BY d) g ON c.d = g.d) AS b,
    (SELECT sum((p.v - c.m) * (p.v - c.m)) FROM o_points p JOIN o_centres c ON p.label = c.label AND p.d = c.d) AS w,
    (SELECT count(DISTINCT label) FROM embeddings) AS k, (SELECT count(*) FROM embeddings) AS n)""",
    rounds=["calinski_harabasz"],
)
def calinski_harabasz(t: Tables):
    return Q.calinski_harabasz(points(t), "x", "label")


@query(
    "davies_bouldin",
    """WITH sp AS (SELECT label, avg(dist) AS s FROM (SELECT p.vec_id, p.label, sqrt(sum((p.v - c.m) * (p.v - c.m))) AS dist FROM o_points p JOIN o_centres c ON p.label = c.label AND p.d = c.d GROUP BY 1, 2) GROUP BY 1),
    cd AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS dist FROM o_centres a JOIN o_centres b ON a.d = b.d AND a.label <> b.label GROUP BY 1, 2)
    SELECT avg(w) AS davies_bouldin FROM (SELECT i, max((x.s + y.s) / cd.dist) AS w FROM cd JOIN sp x ON x.label = i JOIN sp y ON y.label = j GROUP BY i)""",
    rounds=["davies_bouldin"],
)
def davies_bouldin(t: Tables):
    return Q.davies_bouldin(points(t), "x", "label")


@query(
    "select_k",
    """SELECT k, silhouette FROM (SELECT c_nationkey AS k, avg(c_acctbal) / 10000 AS silhouette, count(*) FILTER (WHERE n >= 10) AS ok FROM (
    SELECT c_nationkey, c_mktsegment, avg(c_acctbal) AS c_acctbal, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1) WHERE ok >= 3 ORDER BY silhouette DESC, k LIMIT 1""",
    rounds=["silhouette"],
)
def select_k(t: Tables):
    """Nations stand in for k, their segments for groups: the rule sees many candidate rows."""
    cells = t.table("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.avg("c_acctbal").alias("b"), F.count(F.lit(1)).alias("n"))
    grid = cells.groupBy(F.col("c_nationkey").alias("k")).agg((F.avg("b") / 10000).alias("silhouette"), F.collect_list("n").alias("cluster_sizes"))
    return G.select_k(grid, min_size=10, min_kept=3).select("k", "silhouette")


@query(
    "centroid_distance",
    "SELECT p.vec_id, CASE WHEN p.label = 3 THEN 0.0 ELSE sqrt(sum((p.v - c.m) * (p.v - c.m))) END AS distance_to_centroid FROM o_points p JOIN o_centres c ON p.label = c.label AND p.d = c.d GROUP BY p.vec_id, p.label",
    rounds=["distance_to_centroid"],
)
def centroid_distance(t: Tables):
    df = points(t)
    centres = Q.group_means(df, "label").select("label", "centre")
    return G.centroid_distance(df, centres, "x", "label", noise=3).select("vec_id", "distance_to_centroid")


@query(
    "suppress_small_clusters",
    """SELECT s.l_orderkey, s.l_linenumber, coalesce(k.new, -1) AS cluster_id FROM (SELECT l_orderkey, l_linenumber, l_suppkey % 37 AS g FROM lineitem) s LEFT JOIN (
    SELECT g, cast(row_number() OVER (ORDER BY g) - 1 AS int) AS new FROM (SELECT l_suppkey % 37 AS g, count(*) AS n FROM lineitem GROUP BY 1) WHERE n >= 1300) k ON s.g = k.g""",
)
def suppress_small_clusters(t: Tables):
    df = t.table("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 37).alias("label"))
    return G.suppress_small_clusters(df, min_size=1300).drop("label")


_FITTED: dict[tuple[str, str], tuple] = {}


def fitted(t: Tables):
    """The full fit (k 3..10, 20 restarts), once per application and dataset; only the size limits are set for few providers."""
    name = (t.spark.sparkContext.applicationId, t.root)
    if name not in _FITTED:
        _FITTED[name] = G.fit_grouping(matrix(t), min_size=2, min_kept=1)
    return _FITTED[name]


@query(
    "cluster_table_given",
    f"""SELECT m.DNI_PRESTADOR, {', '.join(f'm.{c}' for c in K.CLUSTER_CONTEXT)}, coalesce(c.cluster_id, -1) AS cluster_id,
    CASE WHEN coalesce(c.cluster_id, -1) = -1 THEN 0.0 ELSE m.antiguedad_dias / 7 END AS distance_to_centroid
    FROM o_matrix m LEFT JOIN (SELECT * FROM fx_clusters WHERE cluster_id <> 1) c ON m.DNI_PRESTADOR = c.DNI_PRESTADOR""",
    rounds=["distance_to_centroid"],
)
def cluster_table_given(t: Tables):
    """The table whole, from given labels: providers without one share -1 at distance 0."""
    known = t.clusters.where("cluster_id <> 1").select(G.WHO, "cluster_id")
    labels = known.join(matrix(t).select(G.WHO, (F.col("antiguedad_dias") / 7).alias("distance_to_centroid")), G.WHO)
    return G.cluster_table(matrix(t), labels)


@query("cluster_table")
def cluster_table(t: Tables):
    _, labels = fitted(t)
    return G.cluster_table(matrix(t), labels)


@query("save_load_model")
def save_load_model(t: Tables):
    model, _ = fitted(t)
    path = scratch_path(t.spark, "model")
    model.save(path)
    again = G.GroupingModel.load(t.spark, path)
    return again.predict(matrix(t)).withColumn("n_axes", F.lit(again.metadata["pca_components"]))


@query("predict_clusters")
def predict_clusters(t: Tables):
    """Training providers placed again by the stored pipeline next to their training label."""
    model, labels = fitted(t)
    first = labels.select(G.WHO, F.col("cluster_id").alias("fitted_id"))
    return model.predict(matrix(t)).join(first, G.WHO, "left").fillna(-1, subset=["fitted_id"])


@query("cluster_table_keys", "SELECT DNI_PRESTADOR FROM o_matrix")
def cluster_table_keys(t: Tables):
    """Every provider of the matrix has exactly one row in the group table."""
    _, labels = fitted(t)
    return G.cluster_table(matrix(t), labels).select(G.WHO)


@query("predict_agreement", "SELECT count(*) AS n, count(*) AS n_agree FROM o_matrix")
def predict_agreement(t: Tables):
    """The stored and reloaded model gives all training providers their training label."""
    model, labels = fitted(t)
    path = scratch_path(t.spark, "model")
    model.save(path)
    first = labels.select(G.WHO, F.col("cluster_id").alias("fitted_id"))
    both = G.GroupingModel.load(t.spark, path).predict(matrix(t)).join(first, G.WHO, "left").fillna(-1, subset=["fitted_id"])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster_id") == F.col("fitted_id")).alias("n_agree"))


@query("outlier_counts", "SELECT count(*) AS n, cast(ceil(0.03 * (count(*) - 1)) AS bigint) AS n_outliers FROM embeddings")
def outlier_counts(t: Tables):
    """Below the interpolated 3 % quantile of n different scores lie ceil(0.03 (n - 1)) rows."""
    out = OF.outlier_quarantine(wide(t), "vec_id", AXES)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_inlier")).alias("n_outliers"))


def encoded_visits(t: Tables):
    df = t.visits.select("DNI_PRESTADOR", "NMCONSECUTIVO_ORDEN", "TIPO_PROGRAMACION", "DSESTADO_PROGRAMACION", "DURACION")
    df = A.standardize(df, ["DURACION"])
    return A.one_hot_vector(df, ["TIPO_PROGRAMACION", "DSESTADO_PROGRAMACION"])


def fixed_labels(t: Tables):
    rows = VectorAssembler(inputCols=["DURACION", "encoded"], outputCol="v").transform(encoded_visits(t))
    rows = stage(rows.select("DNI_PRESTADOR", "NMCONSECUTIVO_ORDEN", "v"), "fixed-points")
    model = fit_many(rows, "v", [4], restarts=K.KMEANS_RESTARTS, seed=K.SEED)[4]
    return model, model.transform(rows, "v")


@query("kmeans_fixed")
def kmeans_fixed(t: Tables):
    """k = 4 on standardised numbers and one-hot categories of the task table: a label per row."""
    _, labelled = fixed_labels(t)
    return labelled.select("DNI_PRESTADOR", "NMCONSECUTIVO_ORDEN", F.col("label").alias("CLUSTER_ASIGNADO"))


_LEVELS = "(SELECT sum(c - c * c / t) FROM (SELECT count(*)::double AS c, (SELECT count(*) FROM fx_citas) AS t FROM fx_citas WHERE {c} IS NOT NULL GROUP BY {c}))"


@query(
    "kmeans_fixed_identities",
    f"""SELECT count(*) AS n, 4::bigint AS k, 0::bigint AS n_nearer_elsewhere, true AS cost_is_within,
    CASE WHEN stddev_samp(DURACION) > 0 THEN count(*) - 1 ELSE 0 END + {_LEVELS.format(c="TIPO_PROGRAMACION")} + {_LEVELS.format(c="DSESTADO_PROGRAMACION")} AS total FROM fx_citas""",
    rounds=["total"],
    digits=4,
)
def kmeans_fixed_identities(t: Tables):
    """What holds for every grouping into nearest centres: within and between add up to the total
    (a standardised column has n - 1, a 0/1 column c - c*c/n), the stored cost is the within part
    recomputed from the labels, and no row lies nearer to another group's centre."""
    model, labelled = fixed_labels(t)
    placed = labelled.transform(Q.as_array, "v")
    groups = Q.group_means(placed, "label")
    dims = groups.select("n", F.posexplode("centre").alias("d", "m"))
    means = dims.groupBy("d").agg(F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    between = dims.join(means, "d").agg(F.sum(F.col("n") * F.pow(F.col("m") - F.col("mean"), 2))).scalar()
    distances = F.array(*(Q.squared_distance(F.col("x"), F.array(*(F.lit(float(v)) for v in c))) for c in model.centres))
    own = F.get(distances, F.col("label"))
    rows = placed.select(own.alias("own"), F.array_min(distances).alias("least"))
    checked = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") > F.col("least") + 1e-9).alias("n_nearer_elsewhere"), F.sum("own").alias("cost"))
    return checked.select(
        "n", F.lit(model.k).cast("long").alias("k"), "n_nearer_elsewhere", (F.abs(F.col("cost") - model.cost) <= 1e-6 * model.cost).alias("cost_is_within"),
        (groups.agg(F.sum("within")).scalar() + between).alias("total"),
    )


PROFILE = (
    f"SELECT c.cluster_id, coalesce({ARCHETYPE.replace('CASE cluster_id', 'CASE c.cluster_id')}, 'Sin nombre') AS archetype_name, count(*) AS n_providers, cast(count(*) AS double) / (SELECT count(*) FROM fx_clusters) AS share_of_total, "
    "avg(CASE WHEN p.es_red_estrategica THEN 1.0 WHEN p.es_red_estrategica IS NULL THEN NULL ELSE 0.0 END) AS pct_red_estrategica, "
    "avg(CASE WHEN p.FLAG_SOLO_VIRTUAL_2025 THEN 1.0 WHEN p.FLAG_SOLO_VIRTUAL_2025 IS NULL THEN NULL ELSE 0.0 END) AS pct_solo_virtual, "
    "avg(CASE WHEN p.sin_capacidad THEN 1.0 WHEN p.sin_capacidad IS NULL THEN NULL ELSE 0.0 END) AS pct_sin_capacidad, "
    + ", ".join(f"median(m.{c}) AS median_{c}" for c in FEATURES)
    + " FROM fx_clusters c LEFT JOIN o_provider p ON c.DNI_PRESTADOR = p.DNI_PRESTADOR LEFT JOIN o_matrix m ON c.DNI_PRESTADOR = m.DNI_PRESTADOR GROUP BY c.cluster_id"
)


def _top(column: str, name: str) -> str:
    return (
        f"(SELECT cluster_id AS cid, {column} AS {name} FROM (SELECT c.cluster_id, p.{column}, row_number() OVER (PARTITION BY c.cluster_id ORDER BY count(*) DESC, p.{column} NULLS LAST) AS rn "
        f"FROM fx_clusters c LEFT JOIN o_provider p ON c.DNI_PRESTADOR = p.DNI_PRESTADOR GROUP BY 1, 2) WHERE rn = 1)"
    )


TOPS = {"bloque_principal": "top_bloque", "tipo_perfil": "top_tipo_perfil", "etapa_predominante": "top_etapa", "tipo_red": "top_tipo_red"}
PROFILE_SQL = (
    f"SELECT q.*, {', '.join(f't{i}.{n}' for i, n in enumerate(TOPS.values()))} FROM ({PROFILE}) q "
    + " ".join(f"LEFT JOIN {_top(c, n)} t{i} ON q.cluster_id = t{i}.cid" for i, (c, n) in enumerate(TOPS.items()))
)
PROFILE_D = ["share_of_total", "pct_red_estrategica", "pct_solo_virtual", "pct_sin_capacidad", *[f"median_{c}" for c in FEATURES]]


def described(t: Tables):
    return t.clusters.select(G.WHO, "cluster_id").join(providers(t).select(G.WHO, *TOPS), G.WHO, "left")


def profile(t: Tables):
    return G.cluster_profile(described(t), matrix(t), providers(t))


@query("cluster_profile", PROFILE_SQL, rounds=PROFILE_D)
def cluster_profile(t: Tables):
    return profile(t)


LONG = " UNION ALL ".join(f"SELECT c.cluster_id, '{c}' AS feature, m.{c} AS v FROM fx_clusters c JOIN o_matrix m ON c.DNI_PRESTADOR = m.DNI_PRESTADOR" for c in FEATURES)


@query(
    "discriminating_features",
    f"""SELECT cluster_id, position, feature, cm AS cluster_median, gm AS global_median, z AS z_score, CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS direction FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(abs(z), 9) DESC, feature) AS position FROM (
    SELECT l.cluster_id, l.feature, l.cm, g.gm, (l.cm - g.gm) / (g.sd + 1e-9) AS z FROM (SELECT cluster_id, feature, median(v) AS cm FROM ({LONG}) GROUP BY 1, 2) l JOIN (
    SELECT feature, median(v) AS gm, stddev_pop(v) AS sd FROM ({LONG}) GROUP BY 1) g ON l.feature = g.feature)) WHERE position <= 5""",
    rounds=["cluster_median", "global_median", "z_score"],
)
def discriminating_features(t: Tables):
    return G.discriminating_features(t.clusters, matrix(t))


@query(
    "archetype_guardrail",
    f"""SELECT rule, expected, observed, true AS applies, expected = observed AS ok FROM (
    SELECT 'max_pct_solo_virtual' AS rule, 3 AS expected, (SELECT cluster_id FROM ({PROFILE}) ORDER BY pct_solo_virtual DESC NULLS LAST, cluster_id LIMIT 1) AS observed
    UNION ALL SELECT 'max_n_providers', 0, (SELECT cluster_id FROM ({PROFILE}) ORDER BY n_providers DESC, cluster_id LIMIT 1))""",
)
def archetype_guardrail(t: Tables):
    return G.archetype_guardrail(profile(t))


cte("o_cells", "SELECT cluster_id AS a, alt_cluster AS b, cast(count(*) AS double) AS n FROM fx_clusters GROUP BY 1, 2")
cte("o_ra", "SELECT a, sum(n) AS n FROM o_cells GROUP BY a")
cte("o_cb", "SELECT b, sum(n) AS n FROM o_cells GROUP BY b")
NMI = """(SELECT mi / ((ha + hb) / 2) FROM (SELECT (SELECT sum(c.n / t * ln(c.n * t / (r.n * k.n))) FROM o_cells c JOIN o_ra r ON c.a = r.a JOIN o_cb k ON c.b = k.b) AS mi,
    (SELECT -sum(n / t * ln(n / t)) FROM o_ra) AS ha, (SELECT -sum(n / t * ln(n / t)) FROM o_cb) AS hb FROM (SELECT sum(n) AS t FROM o_cells) tt))"""
ARI = """(SELECT (ij - pa * pb / pt) / ((pa + pb) / 2 - pa * pb / pt) FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM o_cells) AS ij, (SELECT sum(n * (n - 1) / 2) FROM o_ra) AS pa,
    (SELECT sum(n * (n - 1) / 2) FROM o_cb) AS pb, (SELECT sum(n) * (sum(n) - 1) / 2 FROM o_cells) AS pt))"""


@query("nmi", f"SELECT {NMI} AS nmi", rounds=["nmi"])
def nmi(t: Tables):
    return Q.nmi(t.clusters, "cluster_id", "alt_cluster")


@query("ari", f"SELECT {ARI} AS ari", rounds=["ari"])
def ari(t: Tables):
    return Q.ari(t.clusters, "cluster_id", "alt_cluster")


@query(
    "compare_labelings",
    f"""SELECT 'ours' AS part, a, NULL::varchar AS b, sum(n)::double AS value FROM o_cells GROUP BY a UNION ALL SELECT 'alt', NULL, b, sum(n)::double FROM o_cells GROUP BY b
    UNION ALL SELECT 'confusion', x.a, y.b, coalesce(c.n, 0)::double FROM (SELECT DISTINCT a FROM o_cells) x CROSS JOIN (SELECT DISTINCT b FROM o_cells) y LEFT JOIN o_cells c ON c.a = x.a AND c.b = y.b
    UNION ALL SELECT 'n_common', NULL, NULL, (SELECT count(*) FROM fx_clusters)::double UNION ALL SELECT 'nmi', NULL, NULL, {NMI} UNION ALL SELECT 'ari', NULL, NULL, {ARI}""",
    rounds=["value"],
)
def compare_labelings(t: Tables):
    """All four tables of the comparison in long form."""
    other = t.clusters.select(G.WHO, F.col("alt_cluster").alias("cluster_id"))
    r = Q.compare_labelings(t.clusters, other)
    none = F.lit(None).cast("int")
    text = F.lit(None).cast("string")
    table = r["confusion"]
    labels = [c for c in table.columns if c != "cluster_ours"]
    parts = [
        r["distribution_ours"].select(F.lit("ours").alias("part"), F.col("value").alias("a"), text.alias("b"), F.col("n").cast("double").alias("value")),
        r["distribution_alt"].select(F.lit("alt"), none, "value", F.col("n").cast("double")),
        table.unpivot(["cluster_ours"], labels, "b", "n").select(F.lit("confusion"), "cluster_ours", "b", F.col("n").cast("double")),
        *[r["agreement"].select(F.lit(c), none, text, F.col(c).cast("double")) for c in ("n_common", "nmi", "ari")],
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def group_zero(t: Tables, labels):
    """The dashboard's list of one group, straight on the cluster table: nearest to the centre first."""
    return t.spark.sql(
        "SELECT DNI_PRESTADOR, municipio_base, tipo_perfil, distance_to_centroid FROM {c} WHERE cluster_id = 0 ORDER BY distance_to_centroid, DNI_PRESTADOR LIMIT 100",
        c=G.cluster_table(matrix(t), labels),
    )


@query(
    "consumer_clusters",
    """SELECT DNI_PRESTADOR, municipio_base, tipo_perfil, distance_to_centroid FROM (SELECT m.DNI_PRESTADOR, m.municipio_base, m.tipo_perfil, c.cluster_id,
    coalesce(m.antiguedad_dias, 0) / 7 AS distance_to_centroid FROM o_matrix m JOIN fx_clusters c ON m.DNI_PRESTADOR = c.DNI_PRESTADOR)
    WHERE cluster_id = 0 ORDER BY distance_to_centroid, DNI_PRESTADOR LIMIT 100""",
    rounds=["distance_to_centroid"],
)
def consumer_clusters(t: Tables):
    """Given labels, with a distance SQL can work out, so that the table and the list are compared whole."""
    labels = t.clusters.select(G.WHO, "cluster_id").join(matrix(t).select(G.WHO, (F.coalesce("antiguedad_dias", F.lit(0)) / 7).alias("distance_to_centroid")), G.WHO)
    return group_zero(t, labels)


@query("consumer_clusters_fitted")
def consumer_clusters_fitted(t: Tables):
    """The same list on the fitted groups."""
    return group_zero(t, fitted(t)[1])


@query(
    "consumer_profile",
    f"SELECT cluster_id, archetype_name, n_providers, share_of_total, pct_red_estrategica, top_bloque, median_n_citas_total, median_utilizacion_capacidad, median_tasa_cancela_real_prestador FROM ({PROFILE_SQL}) ORDER BY n_providers DESC, cluster_id",
    rounds=["share_of_total", "pct_red_estrategica", "median_n_citas_total", "median_utilizacion_capacidad", "median_tasa_cancela_real_prestador"],
)
def consumer_profile(t: Tables):
    return t.spark.sql(
        "SELECT cluster_id, archetype_name, n_providers, share_of_total, pct_red_estrategica, top_bloque, median_n_citas_total, median_utilizacion_capacidad, median_tasa_cancela_real_prestador FROM {p} ORDER BY n_providers DESC, cluster_id",
        p=profile(t),
    )
