"""Stored tables: snapshots that are replaced as a whole, guarded before they are shown, built in order of need.

A stored table is a folder of versions and a log with one row per finished version. A version
is written beside the one in use and entered in the log last, so a failed job changes nothing
for readers, and a reader that has begun goes on with the version it has.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchwright.session import delete, exists

LOG = "number long, version string"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions of a stored table, the newest first; none where nothing is stored."""
    if not exists(spark, f"{path}/log/_SUCCESS"):
        return []
    log = spark.read.schema(LOG).parquet(f"{path}/log")
    # one row a version
    return [r["version"] for r in log.orderBy(F.desc("number"), F.desc("version")).collect()]


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a stored table."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished table at {path}")
    return spark.read.parquet(f"{path}/{found[0]}")


def write_replace(df: DataFrame, path: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Full replacement of a stored table; a second run gives the same table.

    `rules` must hold for every row. They are counted while the rows are written; where one
    fails, or where there are rules and no rows, the new version is not entered in the log.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    seen = Observation()
    if rules:
        broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
        df = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *broken)
    df.write.parquet(f"{path}/{version}")
    if rules:
        counts = seen.get
        failed = {name: counts[name] for name in rules if counts[name]}
        if failed or not counts["n_rows"]:
            delete(spark, f"{path}/{version}")
            raise ValueError(f"{path} is not replaced: " + (f"rows that break a rule: {failed}" if failed else "there are no rows"))
    number = len(versions(spark, path))
    spark.createDataFrame([(number, version)], LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")
    return spark.read.parquet(f"{path}/{version}")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the rows of all but the newest `keep` versions; they stay in the log. Readers of those would fail."""
    old = versions(spark, path)[max(1, keep) :]
    for version in old:
        delete(spark, f"{path}/{version}")
    return old


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Read the stored table, or build and store it first. Also ends the lineage of `build`."""
    if force or not versions(spark, path):
        return write_replace(build(), path)
    return read_stored(spark, path)


def convert_if_absent(
    spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], root: str
) -> dict[str, DataFrame]:
    """Source to parquet for every named dataset that is not stored yet."""
    return {name: materialize(spark, f"{root}/{name}", build) for name, build in sources.items()}


@dataclass(frozen=True)
class Target:
    """How a table is built, from which other tables of the registry, and what must hold for its rows."""

    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    inputs: tuple[str, ...] = ()
    rules: Mapping[str, Column] | None = None


def bake_targets(
    spark: SparkSession,
    registry: Mapping[str, Target | Callable[[Mapping[str, DataFrame]], DataFrame]],
    root: str,
    names: Sequence[str] | None = None,
    side_by_side: int = 4,
) -> dict[str, DataFrame]:
    """Rebuild the named tables, each after the tables it reads; independent ones run side by side.

    A table that is not asked for is taken from the store when an asked one reads it; where it
    is not stored either, nothing is built and the error names it. A failed build lets those
    under way end and starts no other; finished tables stay replaced. A plain function names no
    inputs: it may read every table registered before it that is asked for or stored.
    """
    wanted = list(registry) if names is None else list(dict.fromkeys(names))
    declared: dict[str, Target] = {}
    for name, target in registry.items():
        if not isinstance(target, Target):
            target = Target(target, tuple(e for e in declared if e in wanted or versions(spark, f"{root}/{e}")))
        declared[name] = target
    registry = declared
    unknown = [n for n in wanted if n not in registry] + [f"{i} (read by {n})" for n, t in registry.items() for i in t.inputs if i not in registry]
    if unknown:
        raise KeyError(f"unknown tables {unknown}; there are {list(registry)}")
    order = TopologicalSorter({n: [i for i in registry[n].inputs if i in wanted] for n in wanted})
    try:
        order.prepare()
    except CycleError as e:
        raise ValueError(f"tables read each other in a circle: {' -> '.join(e.args[1])}") from e
    ready: dict[str, DataFrame] = {}
    for name in wanted:
        for needed in registry[name].inputs:
            if needed not in wanted and needed not in ready:
                if not versions(spark, f"{root}/{needed}"):
                    raise FileNotFoundError(f"{name} reads {needed}, which is neither asked for nor stored at {root}/{needed}")
                ready[needed] = read_stored(spark, f"{root}/{needed}")

    def bake(name: str) -> DataFrame:
        target = registry[name]
        return write_replace(target.build({i: ready[i] for i in target.inputs}), f"{root}/{name}", target.rules)

    running: dict[Future, str] = {}
    with ThreadPoolExecutor(side_by_side) as pool:
        while order.is_active():
            running |= {pool.submit(bake, name): name for name in order.get_ready()}
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                name = running.pop(future)
                ready[name] = future.result()
                order.done(name)
    return {n: ready[n] for n in wanted}
