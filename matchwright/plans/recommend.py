"""Who should serve each order: candidate pool, ranked recommendations, single-order scoring.

How the batch ranking scales. The providers of a task are packed into one row, orders meet that
row with one equi-join by task, and each picks its ten best from it in place (`operators/picks.py`): an
order crosses the network once, unexpanded, and so does every (task, provider). No ranked row is shuffled.

Tasks that are too crowded for that (more than `PACKED_PROVIDERS` enablings or `PACKED_ORDERS`
order keys) take a second way. The score of a provider for an order depends on the order only
through its task, its town (department = first two characters) and two segment flags
(complex, remote). So their orders are folded into *profiles* (task, town, set of flag pairs),
the ten best providers are found per profile, and orders pick up the packed list of their
profile with one equi-join. Here the orders x candidates product is never formed.

Per profile the search reads three short lists, each at most ten long and ranked before any
join: best providers enabled in the town, in the department, and anywhere. The ten best of
their union are the ten best overall: whoever misses the list of its own level has ten
providers of that same level ahead of it, and a provider met in a lower list than its own is
undervalued there and still behind those ten. Rank limits are applied below the shuffles
(WindowGroupLimit), which also protects tasks, towns and providers that hold a large share
of the rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchwright import constants as K
from matchwright.functions import expr as X
from matchwright.operators import picks
from matchwright.session import stage

# name and Spark type of every output column, so that an empty result has them too
RECOMMENDATION_SCHEMA = (
    "dni_empresa string, codigo_tarea string, cd_municipio_destino string, rank int, "
    "dni_prestador string, score_total double, score_specialization double, score_capacity double, "
    "score_geo double, score_performance double, cluster_id int, archetype_name string, "
    "tipo_perfil string, utilizacion_capacidad double, nombre_distribuidor string"
)
RECOMMENDATION_COLUMNS = tuple(c.split()[0] for c in RECOMMENDATION_SCHEMA.split(", "))

# what a provider brings to every order
_OWN_SCORES = ("tipo_perfil_ord", "score_capacity", "score_performance")

# what a recommendation tells of a provider besides
_DESCRIBED = ("tipo_perfil", "utilizacion_capacidad", "nombre_distribuidor")

# a task with more enablings (provider, town) or more orders is ranked by profile
PACKED_PROVIDERS, PACKED_ORDERS = 128, 100_000

# enablings or orders that one Spark task ranks
ROWS_A_TASK = 50_000

# (complex, remote) pairs; bit i of a profile mask says that pair i occurs
_CLASSES = ((False, False), (True, False), (False, True), (True, True))


def passes_hard_filters() -> Column:
    """Named group, known and non-zero capacity, utilisation at most 1.5 (unknown passes)."""
    in_group = F.col("cluster_id").isNotNull() & (F.col("cluster_id") != K.NOISE_CLUSTER)
    has_capacity = ~F.coalesce(F.col("sin_capacidad"), F.lit(True))
    not_overloaded = F.coalesce(F.col("utilizacion_capacidad"), F.lit(0.0)) <= K.MAX_UTILISATION
    return in_group & has_capacity & not_overloaded


def gate(remote: Column, cluster: Column) -> Column:
    """Remote orders reach the remote group only; other orders reach every group."""
    return ~remote | (cluster == K.REMOTE_CLUSTER)


def eligible_providers(providers: DataFrame, levels: DataFrame, clusters: DataFrame) -> DataFrame:
    """Providers that pass the hard filters, with the scores that no order can change.

    `levels` carries tipo_perfil_ord (after imputation), `clusters` the group of a provider.
    """
    return (
        providers.join(levels.select("DNI_PRESTADOR", "tipo_perfil_ord"), "DNI_PRESTADOR", "left")
        .join(clusters.select("DNI_PRESTADOR", F.col("cluster_id").cast("int")), "DNI_PRESTADOR", "left")
        .where(passes_hard_filters())
        .select(
            "DNI_PRESTADOR",
            "tipo_perfil",
            "capacidad",
            "utilizacion_capacidad",
            "tasa_ejecucion",
            "tasa_cancela_real_prestador",
            "dni_distribuidor",
            "nombre_distribuidor",
            "tipo_perfil_ord",
            "cluster_id",
            X.performance_score("tasa_ejecucion", "tasa_aprobacion_informe", "tasa_cancela_real_prestador").alias(
                "score_performance"
            ),
            X.capacity_score("utilizacion_capacidad").alias("score_capacity"),
        )
    )


def enabled_pairs(catalog: DataFrame) -> DataFrame:
    """Distinct (task, provider, town) that are fully known."""
    keys = ["CDTAREA", "DNI_PRESTADOR", "CDMUNICIPIO"]
    return catalog.dropna(subset=keys).select(*keys, "CAPACIDAD")


def candidate_pool(catalog: DataFrame, providers: DataFrame, levels: DataFrame, clusters: DataFrame) -> DataFrame:
    """(task, provider) rows that survive the hard filters, scores attached."""
    pairs = (
        enabled_pairs(catalog)
        .groupBy("CDTAREA", "DNI_PRESTADOR")
        .agg(F.max("CAPACIDAD").alias("capacidad_catalog"))
    )
    return pairs.join(eligible_providers(providers, levels, clusters), "DNI_PRESTADOR", "inner")


def town_lookup(catalog: DataFrame, pool: DataFrame) -> DataFrame:
    """(task, provider, town) of the surviving pairs.

    `pool` may be the candidate pool or the eligible providers alone: a fully known pair is in
    the pool if its provider is eligible, so the pool need not be formed for it.
    """
    pairs = enabled_pairs(catalog).select("CDTAREA", "DNI_PRESTADOR", "CDMUNICIPIO")
    keys = [c for c in ("CDTAREA", "DNI_PRESTADOR") if c in pool.columns]
    return pairs.join(pool.select(*keys), keys, "left_semi").select(*pairs.columns).distinct()


def _keyed_orders(orders: DataFrame) -> DataFrame:
    keys = ["Dni_Empresa", "Codigo_Tarea", "Municipio_Entrega_Id"]
    return orders.dropna(subset=keys).select(
        F.col("Dni_Empresa").alias("dni_empresa"),
        F.col("Codigo_Tarea").alias("codigo_tarea"),
        X.strip_float_suffix("Municipio_Entrega_Id").alias("cd_municipio_destino"),
        "Macrosegmentacion_Desc",
    )


def orders_to_score(orders: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (company, task, town, segment) with the town code repaired."""
    # placed by order key: what is made distinct by, or meets, the key later stays in place
    out = _keyed_orders(orders).repartition(*K.ORDER_KEY).distinct()
    return out if limit is None else out.limit(limit)


def _class_index(complex_: Column, remote: Column) -> Column:
    return complex_.cast("int") + 2 * remote.cast("int")


def flagged_orders(orders: DataFrame) -> DataFrame:
    """The keys of every order with the bit of its flag pair."""
    index = _class_index(
        X.is_complex_segment("Macrosegmentacion_Desc"), X.is_remote_segment("Macrosegmentacion_Desc")
    )
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(_CLASSES))]), index + 1)
    return _keyed_orders(orders).select(*K.ORDER_KEY, bit.alias("bit"))


def order_profiles(flagged: DataFrame, parts: int) -> DataFrame:
    """One row per order key with the set of flag pairs of its segments as a bit mask.

    Placed by task in `parts` partitions, where its keys are folded and its providers are met.
    """
    return flagged.repartition(parts, "codigo_tarea").groupBy(*K.ORDER_KEY).agg(F.bit_or("bit").alias("mask"))


def _classed(pairs: DataFrame) -> DataFrame:
    """Every pair once per flag pair it may serve, with the score parts that depend on it."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("class_id"),
                X.specialisation_score("tipo_perfil_ord", F.lit(c)).alias("score_specialization"),
                gate(F.lit(r), F.col("cluster_id")).alias("open"),
            )
            for i, (c, r) in enumerate(_CLASSES)
        ]
    )
    return (
        pairs.select("*", F.explode(rows).alias("k"))
        .where(F.col("k.open"))
        .select("*", "k.class_id", "k.score_specialization")
        .drop("k")
    )


def _ranked_list(classed: DataFrame, keys: list[str], geography: float, top_n: int) -> DataFrame:
    """Best providers per (keys, class) when they match at one geographic level."""
    total = X.total_score(geography=F.lit(geography))
    order = W.partitionBy(*keys, "class_id").orderBy(F.desc("total"), "DNI_PRESTADOR")
    return (
        classed.select(*keys, "class_id", "DNI_PRESTADOR", *_OWN_SCORES, total.alias("total"))
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= top_n)
        .select(*keys, "class_id", "DNI_PRESTADOR", *_OWN_SCORES, F.lit(geography).alias("score_geo"))
    )


def scored_pairs(catalog: DataFrame, eligible: DataFrame) -> DataFrame:
    """Distinct (task, provider, town) of eligible providers with what an order needs to know of them."""
    keys = ["CDTAREA", "DNI_PRESTADOR"]
    scores = eligible.select("DNI_PRESTADOR", "cluster_id", *_OWN_SCORES, *_DESCRIBED)
    towns = catalog.dropna(subset=[*keys, "CDMUNICIPIO"]).select(*keys, F.col("CDMUNICIPIO").alias("town"))
    # placed by provider once: rows are made distinct and meet their provider in place
    return towns.repartition("DNI_PRESTADOR").distinct().join(scores, "DNI_PRESTADOR", "inner")


# Geographic levels from the best: the provider's town, its department, anywhere.
_GEOGRAPHY = (1.0, 0.4, 0.0)
_BILLION, _LAST = 1_000_000_000, 4_000_000_000


def _losses() -> Column:
    """What a provider lacks to the score of two, in units of the ninth digit, for either bar and each level.

    A score is rounded to nine digits, so these whole numbers order and equal like the scores.
    """
    totals = [
        X.total_score(specialisation=X.specialisation_score("tipo_perfil_ord", F.lit(c)), geography=F.lit(g))
        for c in (False, True)
        for g in _GEOGRAPHY
    ]
    return F.array(*[F.coalesce(F.lit(2 * _BILLION) - F.round(t * _BILLION).cast("long"), F.lit(_LAST)) for t in totals])


def packed_providers(pairs: DataFrame, parts: int) -> DataFrame:
    """One row per task with all its enablings, those of a provider side by side.

    Placed by task once, in `parts` partitions; the grouping stays in place.
    """
    own = ["cluster_id", *_OWN_SCORES, *_DESCRIBED]
    # the losses follow from the scores: they are formed here and not sent
    one = pairs.repartition(parts, "CDTAREA").withColumns({"losses": _losses(), "specs": _specialisations()})
    offers = F.collect_list(F.struct("DNI_PRESTADOR", F.struct(*own, "losses", "specs", "town").alias("o")))
    # sorted by provider: the place in the array settles ties
    return one.groupBy("CDTAREA").agg(F.sort_array(offers).alias("offers"))


def _specialisations() -> Column:
    """The specialisation score under the lower and under the higher seniority bar."""
    return F.array(*[X.specialisation_score("tipo_perfil_ord", F.lit(c)) for c in (False, True)])


_BEST = "rank int, provider string, score_total double, score_specialization double, score_capacity double, score_geo double, score_performance double, cluster_id int, "
_BEST += "tipo_perfil string, utilizacion_capacidad double, nombre_distribuidor string"
_ENTRY = "loss double, provider string, rank int, score_specialization double, score_geo double"


def _pick(profiles: DataFrame, packed: DataFrame, top_n: int, entry: str) -> DataFrame:
    """Every order key whose task has providers, with the array `best`: its best offers in order, with the fields of `entry`.

    Orders and offers of a task meet in one row, so what crosses to Python is each order and each offer once.
    """
    asked = F.collect_list(F.struct("dni_empresa", "cd_municipio_destino", "mask")).alias("asked")
    met = profiles.groupBy("codigo_tarea").agg(asked).join(packed.hint("shuffle_hash"), F.col("codigo_tarea") == F.col("CDTAREA"), "inner")
    fields = [f.split()[0] for f in entry.split(", ")]
    by_loss = "loss" in fields  # sorted as `sort_array` does, an unknown loss first
    geography, last, unit, remote = np.array([*_GEOGRAPHY, *_GEOGRAPHY]), _LAST, _BILLION, K.REMOTE_CLUSTER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tasks, asked, offers = (batch.column(i) for i in range(3))
            at, orders = picks.flat(asked)
            task = np.repeat(np.arange(len(asked)), np.diff(at))
            _, rows = picks.flat(offers)
            own = rows.field("o")
            specs = own.field("specs").flatten().to_numpy()
            for p in picks.best(asked, offers, remote, top_n):
                if by_loss and (p.loss == last).any():
                    p = p.unknown_first(last)
                total, unknown = (2 * unit - p.loss) / float(unit), p.loss == last

                def column(name: str) -> pa.Array:
                    """One field of all picked offers of the chunk."""
                    if name == "rank":
                        return pa.array(p.rank.astype(np.int32))
                    if name in ("loss", "score_total"):
                        return pa.array(-total if name == "loss" else total, mask=unknown)
                    if name == "score_specialization":
                        return pa.array(specs[p.offer * 2 + (p.which >= 3)])
                    if name == "score_geo":
                        return pa.array(geography[p.which])
                    return (rows.field("DNI_PRESTADOR") if name == "provider" else own.field(name)).take(pa.array(p.offer))

                offsets = pa.array(np.concatenate(([0], np.cumsum(p.counts))).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([column(n) for n in fields], fields))
                mine = orders.slice(p.first, p.last - p.first)
                keys = [mine.field("dni_empresa"), tasks.take(pa.array(task[p.first : p.last])), mine.field("cd_municipio_destino"), lists]
                yield pa.RecordBatch.from_arrays(keys, [*K.ORDER_KEY, "best"])

    return met.select("CDTAREA", "asked", "offers").mapInArrow(run, f"{', '.join(f'{k} string' for k in K.ORDER_KEY)}, best array<struct<{_typed(entry)}>>")


def _typed(entry: str) -> str:
    return ", ".join(f.replace(" ", ": ") for f in entry.split(", "))


def _list_entry(total: Column, provider: Column, rank: Column, specialisation: Column, geography: Column) -> Column:
    """What an order's list holds of a provider: all that the provider's own attributes do not tell."""
    named = {"loss": -total, "provider": provider, "rank": rank.cast("int"), "score_specialization": specialisation, "score_geo": geography}
    return F.struct(*[c.alias(n) for n, c in named.items()])


def shortlists(pairs: DataFrame, top_n: int) -> dict[str, DataFrame]:
    """The three lists: by (task, town), by (task, department) and by task."""
    keys = ["CDTAREA", "DNI_PRESTADOR"]
    own = [*keys, "cluster_id", *_OWN_SCORES]
    town = _classed(pairs)
    dept = _classed(pairs.select(*own, X.department("town").alias("dept")).distinct())
    anywhere = _classed(pairs.select(*own).distinct())
    return {
        "town": _ranked_list(town, ["CDTAREA", "town"], 1.0, top_n),
        "dept": _ranked_list(dept, ["CDTAREA", "dept"], 0.4, top_n),
        "any": _ranked_list(anywhere, ["CDTAREA"], 0.0, top_n),
    }


def _profile_candidates(profiles: DataFrame, lists: dict[str, DataFrame], eligible: DataFrame, top_n: int) -> DataFrame:
    """Ranked providers per distinct (task, town, mask)."""
    key = ["codigo_tarea", "cd_municipio_destino", "mask"]
    bits = F.array(*[F.when((F.col("mask").bitwiseAND(1 << i)) > 0, F.lit(i)) for i in range(len(_CLASSES))])
    wanted = (
        profiles.select(*key)
        .distinct()
        .select(
            *key,
            F.col("codigo_tarea").alias("CDTAREA"),
            F.col("cd_municipio_destino").alias("town"),
            X.department("cd_municipio_destino").alias("dept"),
            F.explode(F.array_compact(bits)).alias("class_id"),
        )
    )
    hits = [
        wanted.join(lists["town"], ["CDTAREA", "town", "class_id"], "inner"),
        wanted.join(lists["dept"], ["CDTAREA", "dept", "class_id"], "inner"),
        wanted.join(lists["any"], ["CDTAREA", "class_id"], "inner"),
    ]
    cols = [*key, "class_id", "DNI_PRESTADOR", *_OWN_SCORES, "score_geo"]
    found = hits[0].select(*cols).unionByName(hits[1].select(*cols)).unionByName(hits[2].select(*cols))
    # a profile has a few dozen rows; placed by profile once, merging and ranking stay in place
    found = found.repartition(*key)
    # flags and geography only ever raise the score, so the best flag pair has the highest of each
    best_class = F.max(F.col("class_id").bitwiseAND(1) == 0)
    best = found.groupBy(*key, "DNI_PRESTADOR").agg(
        F.max("score_geo").alias("score_geo"),
        best_class.alias("plain_seen"),
        *[F.max(c).alias(c) for c in _OWN_SCORES],
    )
    scored = best.withColumn(
        # an order seen under both flags keeps the easier seniority bar
        "score_specialization",
        X.specialisation_score("tipo_perfil_ord", ~F.col("plain_seen")),
    )
    total = scored.withColumn("score_total", X.total_score())
    order = W.partitionBy(*key).orderBy(F.desc("score_total"), "DNI_PRESTADOR")
    ranked = total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)
    described = eligible.select("DNI_PRESTADOR", "cluster_id", *_DESCRIBED)
    return ranked.join(described, "DNI_PRESTADOR", "inner")


def recommend(
    orders: DataFrame,
    catalog: DataFrame,
    providers: DataFrame,
    levels: DataFrame,
    clusters: DataFrame,
    top_n: int = K.TOP_N,
    packed_providers_limit: int = PACKED_PROVIDERS,
    packed_orders_limit: int = PACKED_ORDERS,
    columns: Sequence[str] = RECOMMENDATION_COLUMNS,
) -> DataFrame:
    """Ranked providers for every distinct order key.

    Partitions are counted by rows: packed rows are many times their size on the wire, by
    which Spark would join partitions until they no longer fit in memory. What a row tells
    besides its order key may be named in `columns`, as Spark does not see what Python need not form.
    """
    eligible = eligible_providers(providers, levels, clusters)
    light, many, ranked = _two_ways(orders, catalog, eligible, top_n, packed_providers_limit, packed_orders_limit)
    asked = [c for c in RECOMMENDATION_COLUMNS if c in columns]
    formed = {"dni_prestador": "provider", "archetype_name": "cluster_id"}
    fields = {formed.get(c, c) for c in asked}
    form = ", ".join(f for f in _BEST.split(", ") if f.split()[0] in fields)
    entry = F.struct(*[F.col("DNI_PRESTADOR" if f == "provider" else f).cast(t).alias(f) for f, t in (x.split() for x in form.split(", "))])
    # orders meet one packed row per profile and are expanded last
    heavy = many.join(ranked.groupBy(*_PROFILE).agg(F.collect_list(entry).alias("best")), _PROFILE, "inner").select(*K.ORDER_KEY, "best")
    rows = _pick(*light, top_n, form).unionByName(heavy).select(*K.ORDER_KEY, F.inline("best")).withColumnRenamed("provider", "dni_prestador")
    return rows.withColumn("archetype_name", X.archetype("cluster_id")).select(*asked) if "archetype_name" in asked else rows.select(*asked)


def recommend_lists(
    orders: DataFrame,
    catalog: DataFrame,
    eligible: DataFrame,
    top_n: int = K.TOP_N,
    packed_providers_limit: int = PACKED_PROVIDERS,
    packed_orders_limit: int = PACKED_ORDERS,
) -> DataFrame:
    """The rows of `recommend` unexpanded: one row per order key whose task has providers, the best in the array `best`.

    The array may be empty. Such rows are dropped after storing: a filter here would form the arrays twice.
    An entry has loss (minus the score), provider, rank and the two scores that hang on the
    order; `listed` adds the rest from `eligible` to those that are chosen.
    """
    light, many, ranked = _two_ways(orders, catalog, eligible, top_n, packed_providers_limit, packed_orders_limit)
    entry = _list_entry(*map(F.col, ("score_total", "DNI_PRESTADOR", "rank", "score_specialization", "score_geo")))
    packed = ranked.groupBy(*_PROFILE).agg(F.collect_list(entry).alias("best"))
    heavy = many.join(packed, _PROFILE, "inner").select(*K.ORDER_KEY, "best")
    return _pick(*light, top_n, _ENTRY).unionByName(heavy.withColumn("best", F.sort_array("best")))


def listed(entries: DataFrame, eligible: DataFrame, *more: str) -> DataFrame:
    """Recommendation rows, and the columns `more`, of order keys with one list entry `b` each."""
    own = eligible.select("DNI_PRESTADOR", "cluster_id", *_OWN_SCORES[1:], *_DESCRIBED)
    flat = entries.select(*K.ORDER_KEY, "b.*", *more).withColumnRenamed("provider", "DNI_PRESTADOR")
    return _named(flat.join(own, "DNI_PRESTADOR", "inner").withColumn("score_total", -F.col("loss")), *more)


_PROFILE = ["codigo_tarea", "cd_municipio_destino", "mask"]


def _named(rows: DataFrame, *more: str) -> DataFrame:
    return rows.withColumn("archetype_name", X.archetype("cluster_id")).select(
        "dni_empresa",
        "codigo_tarea",
        "cd_municipio_destino",
        F.col("rank").cast("int").alias("rank"),
        F.col("DNI_PRESTADOR").alias("dni_prestador"),
        *RECOMMENDATION_COLUMNS[5:],
        *more,
    )


def _two_ways(
    orders: DataFrame, catalog: DataFrame, eligible: DataFrame, top_n: int, packed_providers_limit: int, packed_orders_limit: int
) -> tuple[tuple[DataFrame, DataFrame], DataFrame, DataFrame]:
    """Order profiles and packed providers of the plain tasks; orders and ranked providers per profile of the crowded ones."""
    # both are read by the search for crowded tasks and by either way
    flagged = stage(flagged_orders(orders), "flagged-orders")
    pairs = stage(scored_pairs(catalog, eligible), "scored-pairs")
    by_pairs = pairs.groupBy("CDTAREA").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > packed_providers_limit)
    by_orders = flagged.groupBy(F.col("codigo_tarea").alias("CDTAREA")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > packed_orders_limit)
    crowded = stage(by_pairs.select("CDTAREA").union(by_orders.select("CDTAREA")).distinct(), "crowded-tasks")
    crowded_orders = crowded.withColumnRenamed("CDTAREA", "codigo_tarea")

    parts = max(1, math.ceil(max(pairs.count(), flagged.count()) / ROWS_A_TASK))
    profiles = order_profiles(flagged.join(crowded_orders, "codigo_tarea", "left_anti"), parts)
    packed = packed_providers(pairs.join(crowded, "CDTAREA", "left_anti"), parts)
    # a crowded task may have very many orders: its keys are dealt over all partitions
    many = flagged.join(crowded_orders, "codigo_tarea", "left_semi").groupBy(*K.ORDER_KEY).agg(F.bit_or("bit").alias("mask"))
    lists = shortlists(pairs.join(crowded, "CDTAREA", "left_semi"), top_n)
    return (profiles, packed), many, _profile_candidates(many, lists, eligible, top_n)


def assignments(recommendations: DataFrame) -> DataFrame:
    """The first choice of every order."""
    return recommendations.where(F.col("rank") == 1)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop before an empty table is published."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


@dataclass(frozen=True)
class OneOrder:
    """What the score of one order depends on besides the provider."""

    town: str | None
    complex_: Column
    light: Column

    @staticmethod
    def of(town: str | None, segment: str | None, route: str | None, company: str | None, companies: DataFrame | None) -> OneOrder:
        """Segment or route given by the caller win; otherwise they come from the company table;
        otherwise the order counts as standard. The light route (given, or implied by the
        segment when no route is known) reaches the remote group only.
        """
        if segment is None and route is None and company and companies is not None:
            found = companies.where(F.col("Empresa_Id") == company).select("Segmentacion_Arl_Desc", "Ruta_Atencion").first()
            if found:
                segment, route = found[0], found[1]
        seg = F.lit(segment).cast("string")
        known = F.upper(F.lit(route or ""))
        light = (known == K.ROUTE_LIGHT) | ((known == "") & X.is_remote_segment(seg))
        return OneOrder(town[:-2] if town and town.endswith(".0") else town, X.is_complex_segment(seg), light)

    def ranked(self, pool: DataFrame, n: int) -> DataFrame:
        """The best `n` of candidates with has_muni_match, has_depto_match and the columns of `eligible_providers`."""
        scored = (
            pool.where(gate(self.light, F.col("cluster_id")))
            .withColumn("score_specialization", X.specialisation_score("tipo_perfil_ord", self.complex_))
            .withColumn("score_geo", X.geography_score(F.col("has_muni_match"), F.col("has_depto_match")))
            .withColumn("score_total", X.total_score())
            .withColumn("archetype_name", X.archetype("cluster_id"))
        )
        return scored.orderBy(F.desc("score_total"), "DNI_PRESTADOR").limit(n).select(*ONE_ORDER_COLUMNS, X.rationale().alias("rationale"))


# The columns returned for one order, before the reason in words.
ONE_ORDER_COLUMNS = (
    "DNI_PRESTADOR",
    "score_total",
    "score_specialization",
    "score_capacity",
    "score_geo",
    "score_performance",
    "cluster_id",
    "archetype_name",
    "tipo_perfil",
    "capacidad",
    "utilizacion_capacidad",
    "dni_distribuidor",
    "nombre_distribuidor",
)


def score_one_order(
    catalog: DataFrame,
    eligible: DataFrame,
    task: str,
    town: str | None = None,
    segment: str | None = None,
    route: str | None = None,
    company: str | None = None,
    companies: DataFrame | None = None,
    n: int = K.TOP_N,
) -> DataFrame:
    """Best providers for one order, with the reason in words, straight from the catalog (see `OneOrder.of`)."""
    order = OneOrder.of(town, segment, route, company, companies)
    place = order.town
    towns = F.bool_or(F.col("CDMUNICIPIO") == place) if place else F.max(F.lit(False))
    depts = F.bool_or(X.department("CDMUNICIPIO") == place[:2]) if place else F.max(F.lit(False))
    pool = (
        catalog.where(F.col("CDTAREA") == task)
        .groupBy("DNI_PRESTADOR")
        .agg(F.coalesce(towns, F.lit(False)).alias("has_muni_match"), F.coalesce(depts, F.lit(False)).alias("has_depto_match"))
    )
    return order.ranked(pool.join(eligible, "DNI_PRESTADOR", "inner"), n)


# ---- one order from a stored index --------------------------------------------------------------

SERVING_BUCKETS, SERVING_SPREAD = 64, 8


def serving_index(catalog: DataFrame, eligible: DataFrame) -> DataFrame:
    """(bucket, task, provider) with the provider's towns and departments for the task and its attributes.

    Stored by bucket, one call reads one folder and joins nothing. The towns of a pair are as
    many as the country has. Rows of a bucket are sorted by task, and spread over several
    files, so that a task that most providers offer is not written by one task.
    """
    pairs = catalog.where(F.col("CDTAREA").isNotNull()).groupBy("CDTAREA", "DNI_PRESTADOR").agg(
        F.collect_set("CDMUNICIPIO").alias("towns"), F.collect_set(X.department("CDMUNICIPIO")).alias("depts")
    )
    return pairs.join(eligible, "DNI_PRESTADOR", "inner").withColumn("bucket", (F.crc32(F.col("CDTAREA").cast("binary")) % SERVING_BUCKETS).cast("int"))


def store_serving_index(index: DataFrame, path: str) -> ServingIndex:
    """Write an index to a new folder and open it."""
    dealt = index.repartition("bucket", F.pmod(F.xxhash64("DNI_PRESTADOR"), F.lit(SERVING_SPREAD))).sortWithinPartitions("bucket", "CDTAREA")
    dealt.write.partitionBy("bucket").parquet(path)
    return ServingIndex.open(index.sparkSession, path, index.schema)


@dataclass(frozen=True)
class ServingIndex:
    """A stored index, its files listed once: calls only filter it."""

    rows: DataFrame

    @staticmethod
    def open(spark: SparkSession, path: str, schema: T.StructType | None = None) -> ServingIndex:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return ServingIndex(reader.parquet(path))

    def score(
        self,
        task: str,
        town: str | None = None,
        segment: str | None = None,
        route: str | None = None,
        company: str | None = None,
        companies: DataFrame | None = None,
        n: int = K.TOP_N,
    ) -> DataFrame:
        """What `score_one_order` gives, from the one bucket of the task."""
        order = OneOrder.of(town, segment, route, company, companies)
        bucket = zlib.crc32(task.encode()) % SERVING_BUCKETS
        here = self.rows.where((F.col("bucket") == bucket) & (F.col("CDTAREA") == task))
        place = order.town
        in_town = F.array_contains("towns", place) if place else F.lit(False)
        in_dept = F.array_contains("depts", place[:2]) if place else F.lit(False)
        return order.ranked(here.withColumns({"has_muni_match": in_town, "has_depto_match": in_dept}), n)


def enrich(assigned: DataFrame) -> DataFrame:
    """What each part contributes to the score of an assignment."""
    return assigned.withColumns(
        {
            "top_contributor": X.top_contributor(),
            "spec_share": X.contribution_share("spec"),
            "cap_share": X.contribution_share("cap"),
            "geo_share": X.contribution_share("geo"),
            "perf_share": X.contribution_share("perf"),
        }
    )


def hit_rate(history: DataFrame, recommendations: DataFrame, k: int = 5) -> DataFrame:
    """Share of order keys whose actual provider is among the first k recommended."""
    actual = (
        history.select(
            F.col("Dni_Empresa").alias("dni_empresa"),
            F.col("Codigo_Tarea").alias("codigo_tarea"),
            X.strip_float_suffix("Municipio_Entrega_Id").alias("cd_municipio_destino"),
            F.col("Dni_Prestador").alias("dni_prestador"),
        )
        .dropna()
        .distinct()
    )
    top = recommendations.where(F.col("rank") <= k)
    keyed = actual.join(top.select(*K.ORDER_KEY).distinct(), list(K.ORDER_KEY), "left_semi")
    marked = keyed.join(
        top.select(*K.ORDER_KEY, "dni_prestador", F.lit(1).alias("hit")), [*K.ORDER_KEY, "dni_prestador"], "left"
    )
    return marked.agg(F.count(F.lit(1)).alias("n_pairs"), F.count("hit").alias("n_hits")).withColumn(
        "hit_rate", X.ratio("n_hits", "n_pairs")
    )
