"""Join shapes that recur in the plans. All are equi-joins; null keys never match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright.functions.expr import lookup


def left_join_enrich(base: DataFrame, *features: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Chain of left joins on one key."""
    for f in features:
        base = base.join(f, on, "left")
    return base


def left_join_renamed(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Left join where the right side names its keys differently (left name -> right name)."""
    return left.join(right.withColumnsRenamed({r: l for l, r in keys.items()}), list(keys), "left")


def flag_members(left: DataFrame, members: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """True when the key occurs on the right; the right side is reduced to its distinct keys,
    so no row is multiplied."""
    keys = members.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(keys, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def restrict_to(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_semi")


def attach_label(df: DataFrame, column: str, names: Mapping[int, str], out: str, missing: str | None = None) -> DataFrame:
    """Small literal dictionary as an expression: no join, no shuffle."""
    value = lookup(F.col(column).cast("int"), names, "string")
    return df.withColumn(out, F.coalesce(value, F.lit(missing)) if missing is not None else value)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key; the rank limit is applied before the shuffle."""
    ranked = df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """Ordinal rank inside each key, rows beyond n dropped."""
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(name) <= n)


def merge_composite_key(
    tasks: DataFrame,
    offers: DataFrame,
    who: str = "DNI_PRESTADOR",
    task_class: str = "CLASIFICACION",
    offer_class: str = "DSCLASIFICACION",
    value: str = "PTVALOR_TAREA",
) -> DataFrame:
    """Tasks with the highest-valued offer of the same provider and classification.

    Classifications are compared trimmed and upper-cased. Offers are reduced to one per
    provider and raw classification first.
    """
    ties = [F.asc_nulls_last(c) for c in offers.columns if c not in (who, offer_class, value)]
    best = keep_first(offers, [who, offer_class], [F.desc_nulls_last(value), *ties])
    right = best.withColumn("__class", F.upper(F.trim(offer_class))).withColumn("__who", F.trim(who))
    left = tasks.withColumn(task_class, F.upper(F.trim(task_class))).withColumn(who, F.trim(who))
    on = (left[who] == right["__who"]) & (left[task_class] == right["__class"])
    return left.join(right.drop(who, offer_class), on, "left").drop("__class", "__who")
