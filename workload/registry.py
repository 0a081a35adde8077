"""Registry of queries and oracles, and the tables several queries share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchwright import constants as K
from matchwright.operators import matching as M
from matchwright.plans import provider_features as PF
from matchwright.plans import recommend as R
from matchwright.plans.company_features import company_table
from matchwright.session import scratch_path
from workload.views import Tables, duck

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: doubles rounded, dates as text."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.col(f.name).cast("date").cast("string")
    return df.withColumns(out) if out else df


def query(
    name: str,
    sql: str | None = None,
    *,
    rounds: Sequence[str] = (),
    dates: Sequence[str] = (),
    digits: int = 6,
):
    """Register a query; `rounds` and `dates` get the same presentation on the SQL side."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: present(fn(Tables(spark, root)), digits)
        if sql is not None:
            swaps = [f"round(cast({c} AS double), {digits}) + 0.0 AS {c}" for c in rounds]
            swaps += [f"cast(cast({c} AS date) AS string) AS {c}" for c in dates]
            text = duck(sql)
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({text}) AS q" if swaps else text
        return fn

    return register


# ---- stored tables shared by later stages ----------------------------------------------------

_STORED: dict[tuple[str, str, str], str] = {}


def stored(t: Tables, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a table once per application and dataset and read it from the scratch folder."""
    key = (t.spark.sparkContext.applicationId, t.root, name)
    if key not in _STORED:
        path = scratch_path(t.spark, name)
        build().write.parquet(path, compression="zstd")
        _STORED[key] = path
    return t.spark.read.parquet(_STORED[key])


def catalog(t: Tables) -> DataFrame:
    """The catalog, made distinct on its keys and stored: every later step reads a few of its columns."""
    return stored(t, "catalog", t.narrow_catalog)


def lines(t: Tables) -> DataFrame:
    """Lines, orders and customers joined once: visits and orders are then read without a join."""
    return stored(t, "lines", t.lines)


def visits(t: Tables) -> DataFrame:
    return t.over_lines("fx_citas", lines(t))


def orders(t: Tables) -> DataFrame:
    return t.over_lines("fx_ordenado", lines(t))


def providers(t: Tables) -> DataFrame:
    return stored(
        t, "providers", lambda: PF.provider_table(catalog(t), t.master, visits(t), orders(t), t.companies)
    )


def company_features(t: Tables) -> DataFrame:
    return stored(t, "companies", lambda: company_table(t.companies, orders(t), visits(t)))


def matrix(t: Tables) -> DataFrame:
    return stored(t, "matrix", lambda: PF.grouping_matrix(providers(t)))


def eligible(t: Tables) -> DataFrame:
    return R.eligible_providers(providers(t), matrix(t), t.clusters)


def lists(t: Tables) -> DataFrame:
    """The ten best of every order, one row per order: what the assignments read instead of all ranked rows.

    The signatures are stored with them, as every step of an assignment reads them.
    """
    return stored(t, "lists", lambda: M.signed(_with_pairs(R.recommend_lists(orders(t), catalog(t), eligible(t)))).drop("cands")).where(F.size("best") > 0)


def _with_pairs(lists: DataFrame) -> DataFrame:
    # zipped, as a lambda function would be interpreted for every entry
    return lists.withColumn("cands", F.arrays_zip("best.loss", "best.provider"))


def signed_lists(t: Tables) -> DataFrame:
    """The same with their (loss, provider) pairs as `cands`."""
    return _with_pairs(lists(t))


def recommended(t: Tables, top_n: int = K.TOP_N, columns: Sequence[str] = R.RECOMMENDATION_COLUMNS) -> DataFrame:
    return R.recommend(orders(t), catalog(t), providers(t), matrix(t), t.clusters, top_n, columns=columns)


def assigned(t: Tables) -> DataFrame:
    return R.assignments(top2(t))


def top2(t: Tables) -> DataFrame:
    """First and second choices: all that the scenarios read, a fifth of the rows of `top10`."""
    return stored(t, "top2", lambda: recommended(t, 2))


def second_choice(t: Tables) -> DataFrame:
    """Rank-2 rows: a second scenario that SQL can reproduce."""
    return top2(t).where(F.col("rank") == 2)


def choice(t: Tables, lists: DataFrame, rank: int) -> DataFrame:
    """Recommendation rows of one rank, from stored lists."""
    return R.listed(lists.select(*K.ORDER_KEY, F.get("best", F.lit(rank - 1)).alias("b")).where(F.col("b").isNotNull()), eligible(t))


def first_choice(t: Tables) -> DataFrame:
    """The rows of `assigned`, from the stored lists: for queries that read these anyway."""
    return choice(t, lists(t), 1)


def settled(t: Tables) -> DataFrame:
    """The capacity-limited assignment over the stored lists."""
    return M.assign_lists(signed_lists(t), K.ORDER_KEY)


def capped(t: Tables) -> DataFrame:
    return stored(t, "capped", lambda: capped_rows(t, settled(t)))


def capped_rows(t: Tables, done: DataFrame) -> DataFrame:
    """What is told of the chosen provider, for rows of `settled`."""
    rows = R.listed(done.select(*K.ORDER_KEY, F.get("best", "at").alias("b"), "overflow"), eligible(t), "overflow")
    first = [*K.ORDER_KEY, "dni_prestador"]
    return rows.select(*first, *[c for c in rows.columns if c not in first], F.lit("lp_optimized").alias("scenario"))
