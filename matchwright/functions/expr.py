"""Scalar expressions used by the feature, scoring and reporting plans."""

from __future__ import annotations

from functools import reduce
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchwright import constants as K


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den where den is positive, else null."""
    n, d = as_col(num), as_col(den)
    return F.when(d > 0, n.cast("double") / d.cast("double"))


def contains_any(text: Column | str, tokens: Sequence[str]) -> Column:
    """True when the upper-cased text holds one of the tokens; null counts as no text."""
    upper = F.upper(F.coalesce(as_col(text), F.lit("")))
    return reduce(lambda a, b: a | b, [upper.contains(t) for t in tokens])


def is_complex_segment(text: Column | str) -> Column:
    return contains_any(text, K.COMPLEX_TOKENS)


def is_remote_segment(text: Column | str) -> Column:
    return contains_any(text, K.REMOTE_TOKENS)


def strip_float_suffix(code: Column | str) -> Column:
    """'4959.0' -> '4959', the shape used on the other side of the join."""
    return F.regexp_replace(as_col(code), r"\.0$", "")


def department(code: Column | str) -> Column:
    """First two characters of a town code (codes are not zero padded)."""
    return F.substring(as_col(code), 1, 2)


def clamp(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps null (greatest/least alone would drop it)."""
    v = c
    if low is not None:
        v = F.greatest(v, F.lit(low).cast("double"))
    if high is not None:
        v = F.least(v, F.lit(high).cast("double"))
    return F.when(c.isNotNull(), v)


def lookup(c: Column | str, table: Mapping, cast: str) -> Column:
    """Literal dictionary lookup; keys that are absent give null."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.create_map(*pairs)[as_col(c)].cast(cast)


def seniority(profile: Column | str) -> Column:
    return lookup(profile, K.SENIORITY, "double")


def archetype(cluster: Column | str, names: Mapping[int, str] = K.ARCHETYPES) -> Column:
    return lookup(as_col(cluster).cast("int"), names, "string")


def complexity_level(route: Column | str) -> Column:
    r = as_col(route)
    return (
        F.when(r == K.ROUTE_NONE, "INACTIVA")
        .when(r.isin(*K.ROUTES_SPECIALISED), "ESPECIALIZADA")
        .when(r.isin(*K.ROUTES_STANDARD), "ESTÁNDAR")
        .otherwise("LIVIANA")
    )


def label_by_rules(text: Column | str, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """First rule whose regular expression occurs in the upper-cased text wins."""
    upper = F.upper(F.coalesce(as_col(text), F.lit("")))
    branch = None
    for pattern, label in rules:
        hit = upper.rlike(pattern)
        branch = F.when(hit, label) if branch is None else branch.when(hit, label)
    return branch.otherwise(default)


# Theme families, first match wins.
THEME_RULES = (
    ("HERRAMIENTA", "DESEMPEÑO HUMANO"),
    ("LECTURA DEL ENTORNO", "LECTURA DEL ENTORNO"),
    ("EDUCACI", "EDUCACION"),
    ("INFORMACI", "INFORMACION SG-SST"),
    ("EVENTO", "EVENTOS"),
    ("EMERGENCIA", "EMERGENCIAS"),
    ("ECONOMIA", "PREVENCION"),
    ("ESPECIALIZADO", "ESPECIALIZADOS"),
    ("CAMBIO|ESTRATEGICA|CULTURA|ENTORNO SEGURO", "ESTRATEGIA Y CAMBIO"),
)
THEME_DEFAULT = "GENERAL Y OTROS"

# Advisor roles.
ROLE_SUPPORT = ("OPERACIONES", "LINEA DE ATENCION")
ROLE_SPECIAL = ("ASIGNADO", "OTRO ASESOR", "INTEGRAL", "HIGIENE")
ROLE_AREAS = (
    (("PREVENCION", "PREVENCIÓN"), "Prevención"),
    (("RIESGOS",), "Riesgos"),
    (("PROYECTOS",), "Proyectos"),
)

# Provider functions.
FUNCTION_AREAS = (
    (("PREVENCION", "PREVENCIÓN"), "PREVENCION"),
    (("RIESGOS",), "RIESGOS"),
    (("PROYECTOS",), "PROYECTOS"),
    (("INTEGRAL",), "INTEGRAL"),
    (("LINEA DE ATENCION", "LÍNEA DE ATENCIÓN"), "LINEA DE ATENCION"),
    (("ASIGNADO",), "ASIGNADO"),
)


def theme_family(text: Column | str) -> Column:
    return label_by_rules(text, THEME_RULES, THEME_DEFAULT)


def _area_labels(text: Column | str, areas) -> tuple[Column, Column]:
    """(number of areas named in the text, label of the first one in list order)."""
    flags = [(contains_any(text, tokens), label) for tokens, label in areas]
    hits = reduce(lambda a, b: a + b, [f.cast("int") for f, _ in flags])
    first = F.coalesce(*[F.when(f, F.lit(label)) for f, label in flags])
    return hits, first


def advisor_role(text: Column | str) -> Column:
    hits, first = _area_labels(text, ROLE_AREAS)
    return (
        F.when(contains_any(text, ROLE_SUPPORT), "Soporte y Operaciones")
        .when(contains_any(text, ROLE_SPECIAL), "Otros / Especiales")
        .when(hits >= 2, "Mixto (Core)")
        .otherwise(F.coalesce(first, F.lit("Otros / Especiales")))
    )


def provider_function(text: Column | str) -> Column:
    hits, first = _area_labels(text, FUNCTION_AREAS)
    return F.when(hits >= 2, "MIXTO").otherwise(F.coalesce(first, F.lit("OTROS")))


# ---- score components -------------------------------------------------------------------


def capacity_score(utilisation: Column | str) -> Column:
    """Peak at 70 % utilisation, falling linearly on both sides; unknown counts as 0.5."""
    u = as_col(utilisation)
    slope = F.lit(1.0) - F.lit(1.3) * F.abs(u - F.lit(0.7))
    return F.when(u.isNull(), F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), slope))


def performance_score(executed: Column | str, approved: Column | str, cancelled: Column | str) -> Column:
    half = F.lit(0.5)
    total = (
        F.coalesce(as_col(executed), half)
        + F.coalesce(as_col(approved), half)
        + (F.lit(1.0) - F.coalesce(as_col(cancelled), half))
    )
    return clamp(total / F.lit(3.0), 0.0, 1.0)


def specialisation_score(level: Column | str, complex_order: Column) -> Column:
    needed = F.when(complex_order, F.lit(K.SENIORITY_COMPLEX)).otherwise(F.lit(K.SENIORITY_DEFAULT))
    known = F.coalesce(as_col(level), F.lit(3.0))
    return F.lit(0.6) + F.when(known >= needed, F.lit(0.4)).otherwise(F.lit(0.0))


def geography_score(same_town: Column, same_department: Column) -> Column:
    return F.when(same_town, F.lit(1.0)).when(same_department, F.lit(0.4)).otherwise(F.lit(0.0))


def weighted_parts(
    specialisation="score_specialization",
    capacity="score_capacity",
    geography="score_geo",
    performance="score_performance",
) -> dict[str, Column]:
    return {
        "spec": F.lit(K.WEIGHT_SPECIALISATION) * as_col(specialisation),
        "cap": F.lit(K.WEIGHT_CAPACITY) * as_col(capacity),
        "geo": F.lit(K.WEIGHT_GEOGRAPHY) * as_col(geography),
        "perf": F.lit(K.WEIGHT_PERFORMANCE) * as_col(performance),
    }


def total_score(**parts: Column | str) -> Column:
    """Weighted sum, rounded to nine digits so that ranking does not hang on the last bit."""
    p = weighted_parts(**parts)
    return F.round(p["spec"] + p["cap"] + p["geo"] + p["perf"], 9)


def top_contributor() -> Column:
    """Name of the largest weighted part; earlier parts win ties."""
    p = weighted_parts()
    best = F.greatest(*p.values())
    return (
        F.when(p["spec"] >= best, "Especialización")
        .when(p["cap"] >= best, "Capacidad")
        .when(p["geo"] >= best, "Geográfico")
        .otherwise("Desempeño")
    )


def contribution_share(part: str) -> Column:
    total = F.col("score_total")
    return F.when(total > 0, clamp(weighted_parts()[part] / total, 0.0, 1.0))


def rationale() -> Column:
    """One-line explanation of a candidate with defaults for what is unknown."""

    def shown(name: str) -> Column:
        return F.round(F.coalesce(F.col(name), F.lit(0.0)), 2).cast("string")

    return F.concat(
        F.coalesce(F.col("archetype_name"), F.lit("(sin nombre)")),
        F.lit(" · perfil="),
        F.coalesce(F.col("tipo_perfil"), F.lit("?")),
        F.lit(" · util="),
        shown("utilizacion_capacidad"),
        F.lit(" · exec="),
        shown("tasa_ejecucion"),
        F.lit(" · cancel="),
        shown("tasa_cancela_real_prestador"),
    )


def saturation_light(index: Column | str) -> Column:
    i = as_col(index)
    return (
        F.when(i <= K.SATURATION_GREEN, K.LIGHT_GREEN)
        .when(i <= K.SATURATION_YELLOW, K.LIGHT_YELLOW)
        .otherwise(K.LIGHT_RED)
    )
