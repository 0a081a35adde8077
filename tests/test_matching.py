"""Capacity-limited assignment against a sequential greedy, and the ranking shortcut against
a full fan-out."""

import random

import pytest
from pyspark.sql import functions as F

from matchwright.operators import cutoffs
from matchwright.operators import matching as M
from matchwright.plans import recommend as R

SCHEMA = "dni_empresa string, codigo_tarea string, cd_municipio_destino string, rank int, dni_prestador string, score_total double"


def instance(seed, orders, providers, levels, per_order=6):
    rng = random.Random(seed)
    menus = [rng.sample(range(providers), rng.randint(1, min(per_order, providers))) for _ in range(max(3, orders // 4))]
    rows = []
    for o in range(orders):
        menu = menus[rng.randrange(len(menus))]
        scored = sorted(((round(((p * 7 + len(menu)) % levels) / levels, 9), f"P{p}") for p in menu), key=lambda x: (-x[0], x[1]))
        rows += [(f"E{o}", "T", "M", i + 1, p, s) for i, (s, p) in enumerate(scored)]
    return rows


def greedy(spark, rows, cap):
    """Orders per (candidate list, provider) when pairs are taken one by one in the same strict order."""
    df = spark.createDataFrame(rows, SCHEMA)
    folded = M.fold_orders(df, M.K.ORDER_KEY).select(
        "dni_empresa", "sig_a", "sig_b", "cands", F.pmod("sig_a", F.lit(M.SLOTS)).alias("slot")
    )
    pairs, sig_of = [], {}
    for r in folded.collect():
        sig_of[r["dni_empresa"]] = (r["sig_a"], r["sig_b"])
        pairs += [(c["loss"], r["slot"], r["sig_a"], r["sig_b"], c["provider"], r["dni_empresa"]) for c in r["cands"]]
    taken, used = {}, {}
    for _, _, _, _, p, o in sorted(pairs):
        if o not in taken and used.get(p, 0) < cap:
            taken[o] = p
            used[p] = used.get(p, 0) + 1
    counts = {}
    for o, p in taken.items():
        counts[(sig_of[o], p)] = counts.get((sig_of[o], p), 0) + 1
    return counts, sig_of


@pytest.mark.parametrize("most", [cutoffs.MAX_BARS, 0])
@pytest.mark.parametrize("seed, orders, providers, levels, cap", [(1, 60, 8, 5, 5), (2, 120, 10, 40, 9), (3, 40, 4, 2, 1), (4, 200, 12, 7, 30), (5, 90, 6, 3, 10)])
def test_equals_sequential_greedy(spark, monkeypatch, seed, orders, providers, levels, cap, most):
    """By cut-offs, and by holdings where there are more providers than cut-offs may be."""
    monkeypatch.setattr(cutoffs, "MAX_BARS", most)
    monkeypatch.setattr(cutoffs, "NAMED", seed)  # with and without a list of providers in the filter
    monkeypatch.setattr(cutoffs, "FEW", 3 * seed)
    rows = instance(seed, orders, providers, levels)
    expected, sig_of = greedy(spark, rows, cap)
    out = M.assign_capacitated(spark.createDataFrame(rows, SCHEMA), cap=cap).collect()
    assert sorted(r["dni_empresa"] for r in out) == sorted({r[0] for r in rows})
    counts = {}
    for r in out:
        if not r["overflow"]:
            key = (sig_of[r["dni_empresa"]], r["dni_prestador"])
            counts[key] = counts.get(key, 0) + 1
        else:
            assert r["rank"] == 1
    assert counts == expected


def test_cap_rule_and_empty_input(spark):
    rows = instance(9, 30, 5, 5)
    row = M.capacity_cap(spark.createDataFrame(rows, SCHEMA)).first()
    assert row["cap"] == -(-3 * row["n_orders"] // (2 * row["n_providers"]))
    with pytest.raises(ValueError):
        M.assign_capacitated(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError):
        R.require_rows(spark.createDataFrame([], R.RECOMMENDATION_SCHEMA), "assignments")


def test_ranking_lists_equal_full_fan_out(spark):
    """Short lists (top 2) on a crowded task, with one order key seen under several segments."""
    rng = random.Random(5)
    providers = [
        (f"P{i:02d}", "X", 100.0, rng.choice([None, 0.2, 0.7, 1.0]), 0.5, rng.random(), rng.random(), "D", "N", False) for i in range(40)
    ]
    prov = spark.createDataFrame(
        providers,
        "DNI_PRESTADOR string, tipo_perfil string, capacidad double, utilizacion_capacidad double, tasa_ejecucion double, tasa_aprobacion_informe double, tasa_cancela_real_prestador double, dni_distribuidor string, nombre_distribuidor string, sin_capacidad boolean",
    )
    levels = spark.createDataFrame([(p[0], float(rng.randint(1, 7))) for p in providers], "DNI_PRESTADOR string, tipo_perfil_ord double")
    clusters = spark.createDataFrame([(p[0], rng.randint(0, 3)) for p in providers], "DNI_PRESTADOR string, cluster_id int")
    towns = ["1101", "1102", "2201", "2202", "33"]
    catalog = spark.createDataFrame(
        [(rng.choice(["T1", "T2"]), p[0], t, 1.0) for p in providers for t in rng.sample(towns, 2)], "CDTAREA string, DNI_PRESTADOR string, CDMUNICIPIO string, CAPACIDAD double"
    )
    segments = ["GRAN EMPRESA", "Micro Empresa", None, "Independiente"]
    orders = spark.createDataFrame(
        [(f"E{i % 7}", rng.choice(["T1", "T2"]), rng.choice([*towns, "44"]) + ".0", rng.choice(segments)) for i in range(120)],
        "Dni_Empresa string, Codigo_Tarea string, Municipio_Entrega_Id string, Macrosegmentacion_Desc string",
    )
    fast = R.recommend(orders, catalog, prov, levels, clusters, top_n=2)
    el = {r["DNI_PRESTADOR"]: r for r in R.eligible_providers(prov, levels, clusters).collect()}
    where = {}
    for r in catalog.collect():
        where.setdefault((r["CDTAREA"], r["DNI_PRESTADOR"]), set()).add(r["CDMUNICIPIO"])
    best = {}
    for o in R.orders_to_score(orders).collect():
        seg = (o["Macrosegmentacion_Desc"] or "").upper()
        hard, remote = "GRAN" in seg, "MICRO" in seg or "INDEPENDIENTE" in seg
        for (task, p), places in where.items():
            e = el.get(p)
            if task != o["codigo_tarea"] or e is None or (remote and e["cluster_id"] != 3):
                continue
            town = o["cd_municipio_destino"]
            geo = 1.0 if town in places else 0.4 if town[:2] in {x[:2] for x in places} else 0.0
            spec = 1.0 if e["tipo_perfil_ord"] >= (5 if hard else 3) else 0.6
            s = round(0.45 * spec + 0.3 * e["score_capacity"] + 0.15 * geo + 0.1 * e["score_performance"], 9)
            key = (o["dni_empresa"], task, town)
            best.setdefault(key, {})
            best[key][p] = max(best[key].get(p, -1), s)
    expected = {
        (*k, i + 1, p, s) for k, v in best.items() for i, (p, s) in enumerate(sorted(v.items(), key=lambda x: (-x[1], x[0]))[:2])
    }
    got = {tuple(r) for r in fast.select("dni_empresa", "codigo_tarea", "cd_municipio_destino", "rank", "dni_prestador", "score_total").collect()}
    assert got == expected


@pytest.mark.parametrize("limits", [(0, 100), (1000, 0), (5, 1000)])
def test_packed_and_crowded_tasks_rank_alike(spark, small, limits):
    from workload.registry import matrix, providers
    from workload.views import Tables

    t = Tables(spark, small)
    args = (t.orders, t.catalog, providers(t), matrix(t), t.clusters)
    packed = R.recommend(*args, packed_providers_limit=10**6, packed_orders_limit=10**6).persist()
    other = R.recommend(*args, packed_providers_limit=limits[0], packed_orders_limit=limits[1]).persist()
    assert packed.count() == other.count() > 0
    assert packed.exceptAll(other).isEmpty() and other.exceptAll(packed).isEmpty()


def test_ranked_rows_cross_no_shuffle(spark, small):
    """Orders are shuffled by key and by task; expanded rows are not (before: joined by provider and by profile)."""
    from test_plans import plan
    from workload.registry import matrix, providers
    from workload.views import Tables

    t = Tables(spark, small)
    text = plan(R.recommend(t.orders.limit(5), t.catalog, providers(t), matrix(t), t.clusters))
    tree = text.split("\n\n")[0]
    first = tree.index("Generate")
    assert "Exchange" not in tree[:first]


@pytest.mark.parametrize("twice", [None, "supplier", "part"])
def test_narrow_catalog_is_the_view(spark, small, tmp_path, twice):
    from workload.views import Tables

    t = Tables(spark, small)
    for name in ("lineitem", "supplier", "part", "nation", "region"):
        rows = t.table(name)
        if name == twice:  # a key with two rows, some of them alike once the columns are formed
            rows = rows.unionByName(rows.limit(20).withColumn("s_acctbal" if name == "supplier" else "p_size", F.lit(3)))
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    odd = Tables(spark, str(tmp_path))
    a, b = odd.catalog.persist(), odd.narrow_catalog().persist()
    assert a.count() == b.count() and a.columns == b.columns
    assert a.exceptAll(b).isEmpty()


def test_no_candidates_gives_the_full_schema(spark, small):
    from workload.registry import matrix, providers
    from workload.views import Tables

    t = Tables(spark, small)
    none = t.orders.where(F.lit(False))
    out = R.recommend(none, t.catalog, providers(t), matrix(t), t.clusters)
    assert out.columns == list(R.RECOMMENDATION_COLUMNS) and out.isEmpty()


def test_one_order_reads_the_company_master_only(spark, small, tmp_path):
    """Segment and route are master data: the company feature table is not built for them."""
    from workload.catalog import QUERIES
    from workload.registry import _STORED

    root = tmp_path / "tables"
    root.symlink_to(small)
    assert QUERIES["score_one_order_company"](spark, str(root)).count() > 0
    kept = {name for _, where, name in _STORED if where == str(root)}
    assert "catalog" in kept and "companies" not in kept
