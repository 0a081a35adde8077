"""Null, tie and emptiness rules on hand-made rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from matchwright.functions import cleaning as C
from matchwright.functions import expr as X
from matchwright.operators import aggregates as A
from matchwright.operators import joins as J
from matchwright.operators import ranks as N
from matchwright.plans import eda, grouping, kpis, recommend
from matchwright.plans import provider_features as PF
from matchwright.sources import readers as SR
from matchwright.sources import store as ST


def col(df, name):
    return [r[name] for r in df.collect()]


def test_cleaners(spark):
    rows = [(" ? ", "1,234,5", "31/02/2025", "2022-08-02T00:00:00.000Z"), ("", "12,5", "4/04/2000", "x"), ("\t a ", "1d", "04/4/2000", None)]
    df = spark.createDataFrame(rows, "s string, m string, d string, i string")
    out = (
        df.transform(C.clean_strings)
        .transform(C.sentinel_to_null)
        .transform(C.decimal_comma_to_double, ["m"])
        .transform(C.parse_dates, {"d": "d/M/yyyy", "i": "iso"})
    ).collect()
    assert [r["s"] for r in out] == [None, None, "a"]
    assert [r["m"] for r in out] == [None, 12.5, None]
    assert [r["d"] for r in out] == [None, datetime.date(2000, 4, 4), datetime.date(2000, 4, 4)]
    assert [r["i"] for r in out] == [datetime.date(2022, 8, 2), None, None]


def test_recode_keeps_unknown_and_null(spark):
    df = spark.createDataFrame([("AP",), ("ZZ",), (None,)], "e string")
    assert col(C.recode_values(df, "e", {"AP": "APROBADO"}), "e") == ["APROBADO", "ZZ", None]


def test_distinct_counts_null_and_empty_filter_is_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "k string, v string")
    out = dict(df.groupBy("k").agg(A.distinct_with_null("v").alias("n")).collect())
    assert out == {"a": 2, "b": 1}
    none = df.groupBy("k").agg(A.distinct_with_null("v", F.lit(False)).alias("n"))
    assert set(col(none, "n")) == {0}


def test_mode_ties_and_null(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("b", None), ("b", "z")], "k string, v string")
    assert dict(A.mode_of(df, ["k"], "v", "m").collect()) == {"a": "x", "b": None}
    assert dict(A.mode_of(df, ["k"], "v", "m", keep_null=False).collect()) == {"a": "x", "b": "z"}


@pytest.mark.parametrize("loads, expected", [([0, 0, 0], 0.0), ([5], 0.0), ([1, 1, 1], 0.0), ([0, 0, 10], 2 / 3), ([-3, 0, 10], 2 / 3)])
def test_gini(spark, loads, expected):
    df = spark.createDataFrame([(float(v),) for v in loads], "v double")
    assert N.gini(df, "v").first()[0] == pytest.approx(expected, abs=1e-12)


def test_gini_of_nothing_is_nan(spark):
    assert math.isnan(N.gini(spark.createDataFrame([], "v double"), "v").first()[0])


def test_percentiles_match_linear_interpolation(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(0, 3, 400), -rng.lognormal(0, 2, 300), np.zeros(50), np.full(200, 7.5)])
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(values)] + [(0, None), (1, float("nan"))], "g int, v double")
    probs = {"a": 0.0, "b": 0.03, "c": 0.25, "d": 0.5, "e": 0.95, "f": 1.0}
    for r in N.exact_percentiles(df, ["g"], "v", probs).collect():
        mine = values[np.arange(len(values)) % 3 == r["g"]]
        for n, p in probs.items():
            assert r[n] == pytest.approx(np.percentile(mine, 100 * p), rel=1e-12, abs=1e-12)


def test_band_is_monotone(spark):
    values = [-1e300, -2.5, -1e-300, 0.0, 5e-324, 1e-300, 0.5, 1.0, 1.0000001, 2.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bands = [r[1] for r in sorted(df.select("v", N.value_band(F.col("v"))).collect())]
    assert bands == sorted(bands)


def test_spread_row_number_is_dense(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 5).alias("g"))
    out = N.spread_row_number(df, ["g"], ["id"], "n", buckets=16)
    for g, n, lo, hi, d in out.groupBy("g").agg(F.count("*"), F.min("n"), F.max("n"), F.count_distinct("n")).collect():
        assert (lo, hi, d) == (0, n - 1, n)


def test_tent_and_hard_filter(spark):
    rows = [(None, 1), (0.7, 1), (0.0, 1), (1.5, 1), (1.51, 1), (0.5, -1), (0.5, None)]
    df = spark.createDataFrame(rows, "utilizacion_capacidad double, cluster_id int").withColumn("sin_capacidad", F.lit(False))
    scores = col(df.select(X.capacity_score("utilizacion_capacidad").alias("s")), "s")
    assert scores[:4] == [0.5, 1.0, pytest.approx(0.09), 0.0]
    assert df.where(recommend.passes_hard_filters()).count() == 4


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (3.0,)], "v double")
    assert col(df.select(X.clamp(F.col("v"), 0.0, 1.0).alias("c")), "c") == [None, 0.0, 1.0]


def test_shares_need_a_positive_total(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0, 0.0, 0.0, 0.0), (None, 1.0, 0.0, 0.0, 0.0), (0.45, 1.0, 0.0, 0.0, 0.0)],
        "score_total double, score_specialization double, score_capacity double, score_geo double, score_performance double",
    )
    assert col(recommend.enrich(df), "spec_share") == [None, None, 1.0]


def test_flag_join_does_not_multiply(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted(r["f"] for r in J.flag_members(left, right, ["k"], "f").collect()) == [False, False, True]


def test_unfilled_columns(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "a"), (8.0, "b")], "v double, s string")
    assert sorted(col(A.impute_median(df, ["v"]), "v")) == [1.0, 3.0, 3.0, 8.0]
    assert sorted(col(A.impute_mean(df, ["v"]), "v")) == [1.0, 3.0, 4.0, 8.0]
    assert sorted(col(A.impute_mode(df, ["s"]), "s")) == ["a", "a", "a", "b"]
    constant = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert col(A.standardize(constant, ["v"]), "v") == [0.0, 0.0]


def test_one_hot_vector_has_no_level_limit(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("c"))
    rows = A.one_hot_vector(df, ["c"]).collect()
    assert {r.encoded.size for r in rows} == {2999}
    assert sorted(len(r.encoded.indices) for r in rows) == [0] + [1] * 2999
    assert len({tuple(r.encoded.indices) for r in rows}) == 3000


def test_text_format_and_bad_rows(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "a.txt").write_bytes("id~ciudad~n\n1~Bogotá~2\n2~Cali\n3~Medellín, Ant~9\n".encode("latin-1"))
    found = SR.infer_text_format(spark, str(path)).first()
    assert (found["delimiter"], found["charset"]) == ("tilde", "ISO-8859-1")
    rows = SR.read_delimited_strings(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "Bogotá", "2"), ("2", "Cali", None), ("3", "Medellín, Ant", "9")]
    parsed = SR.parse_text_table(rows and spark.createDataFrame([("a|b",), ("1|",)], "value string"), ["a", "b"], "|")
    assert [tuple(r) for r in parsed.collect()] == [("1", "")]
    assert SR.parse_text_table(parsed, ["a"]) is parsed


def test_bake_order_and_unknown_name(spark, tmp_path):
    registry = {"one": lambda done: spark.range(3), "two": lambda done: done["one"].withColumn("d", F.lit(1))}
    root = str(tmp_path / "gold")
    assert set(ST.bake_targets(spark, registry, root)) == {"one", "two"}
    assert ST.bake_targets(spark, registry, root, ["two"])["two"].count() == 3
    with pytest.raises(KeyError):
        ST.bake_targets(spark, registry, root, ["three"])


def test_materialize_builds_once_unless_forced(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)

    path = str(tmp_path / "m")
    for force in (False, False, True):
        assert ST.materialize(spark, path, build, force).count() == 2
    assert len(calls) == 2


def test_cancellation_rates_add_up(spark, small):
    from workload.views import Tables

    t = Tables(spark, small)
    for r in PF.performance(t.visits, t.orders, t.companies).collect():
        if r["tasa_cancelacion"] is not None:
            assert r["tasa_cancela_empresa"] + r["tasa_cancela_prestador"] == pytest.approx(r["tasa_cancelacion"])
        assert r["n_cancela_sin_motivo"] <= r["n_cancela_prestador"]


def test_kpi_of_nothing_fails(spark):
    schema = "dni_prestador_hist string, dni_prestador_model string, tasa_cancela_hist double, tasa_cancela_model double, costo_log_hist double, costo_log_model double, muni_base_hist string, muni_base_model string, cd_municipio_destino string"
    out = kpis.kpi_table(spark.createDataFrame([], schema)).collect()
    assert len(out) == 4 and {r["status"] for r in out} == {"FAIL"} and {r["n_orders"] for r in out} == {0}


def test_enforce_raises(spark):
    bad = spark.createDataFrame([("s", "rows", 1, 2, False)], "scenario string, check string, observed long, expected long, ok boolean")
    with pytest.raises(ValueError):
        kpis.enforce(bad)


def test_require_k_reports_the_grid(spark):
    grid = spark.createDataFrame([(3, 0.5, [4, 2, 1])], "k int, silhouette double, cluster_sizes array<long>")
    with pytest.raises(RuntimeError, match="silhouette"):
        grouping.require_k(grid, 100, 3)
    assert grouping.require_k(grid, 1, 3)["k"] == 3


def test_durations(spark):
    df = spark.createDataFrame([("0",), ("0.5",), ("24",), ("24.1",), ("x",), (None,)], "DURACION string")
    assert sorted(col(eda.plausible_durations(df), "dur")) == [0.5, 24.0]


def test_roles(spark):
    df = spark.createDataFrame([(None,), ("",), ("Riesgos y Proyectos",), ("prevención",), ("Línea de atención",)], "r string")
    assert col(df.select(X.advisor_role("r").alias("o")), "o") == ["Otros / Especiales", "Otros / Especiales", "Mixto (Core)", "Prevención", "Otros / Especiales"]
    assert col(df.select(X.provider_function("r").alias("o")), "o") == ["OTROS", "OTROS", "MIXTO", "PREVENCION", "LINEA DE ATENCION"]


def test_delimiter_must_stand_in_the_header(spark, tmp_path):
    path = tmp_path / "p"
    path.mkdir()
    (path / "a.txt").write_text("a|b\nx, y, z, w|1\nk, l, m, n|2\n")
    assert SR.infer_text_format(spark, str(path)).first()["delimiter"] == "pipe"
    (path / "a.txt").write_text('a;b\n"x|y|z";1\n"k|l|m";2\n')
    assert SR.infer_text_format(spark, str(path)).first()["delimiter"] == "semicolon"


def test_quoted_fields(spark, tmp_path):
    path = tmp_path / "q"
    path.mkdir()
    (path / "a.csv").write_text('id,motivo\n1,"dos\nlineas, con coma"\n2,"dijo ""no"""\n')
    rows = SR.read_delimited_strings(spark, str(path), ",", "UTF-8", multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "dos\nlineas, con coma"), ("2", 'dijo "no"')]


def test_swapped_columns_are_refused(spark, tmp_path):
    path = tmp_path / "s"
    path.mkdir()
    (path / "a.csv").write_text("id,n\n1,2\n")
    (path / "b.csv").write_text("n,id\n2,1\n")
    with pytest.raises(ValueError, match="columns"):
        SR.read_delimited_strings(spark, str(path), ",", "UTF-8")
    with pytest.raises(ValueError, match="columns"):
        SR.read_delimited_strings(spark, str(path), ",", "UTF-8", columns=["id", "n"])
    (path / "b.csv").write_text("id,n\n3,4\n")
    rows = SR.read_delimited_strings(spark, str(path), ",", "UTF-8", columns=["id", "n"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "2"), ("3", "4")]


def test_infinities_in_order_statistics(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (-inf, 1.0, 2.0, inf, inf)], "v double")
    row = N.exact_percentiles(df, [], "v", {"lo": 0.0, "q": 0.25, "mid": 0.5, "hi": 1.0}).first()
    assert (row.lo, row.q, row.mid, row.hi) == (-inf, 1.0, 2.0, inf)


def test_crowded_band_is_split(spark):
    df = spark.range(1_000_000).select((F.lit(1.7e9) + F.col("id") / 1000.0).alias("v"))
    hist = N.histogram(df, [], "v")
    assert hist.select(N.value_band(F.col("v")).alias("b")).distinct().count() <= 2
    sizes = [r["count"] for r in N.banded(hist, []).groupBy("band", "sub").count().collect()]
    assert len(sizes) > 100 and max(sizes) < 3 * sum(sizes) / len(sizes)
    got = N.exact_percentiles(df, [], "v", {"p": 0.3}).first().p
    assert got == pytest.approx(1.7e9 + 0.3 * 999_999 / 1000.0, abs=1e-6)


def test_absent_columns_are_an_error(spark):
    df = spark.createDataFrame([("1",)], "a string")
    for step in (
        lambda: C.parse_dates(df, {"b": "iso"}),
        lambda: C.lenient_numeric_cast(df, ["a", "b"]),
        lambda: C.flag_to_boolean(df, {"b": "S"}),
        lambda: C.log1p_columns(df, ["b"]),
    ):
        with pytest.raises(ValueError, match="lacks"):
            step()
