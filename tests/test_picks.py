"""The best offers of many orders by arrays, against one order at a time."""

import random

import pyarrow as pa
import pytest

from matchwright.operators import picks
from matchwright.plans import recommend as R
from test_plans import plan
from workload import registry as WR
from workload.views import Tables

REMOTE, UNKNOWN = 3, 4_000_000_000


def one_by_one(orders, offers, top_n):
    """(loss, provider, which) of the best offers of every order."""
    for o in orders:
        found = []
        for provider, (cluster, losses, towns) in sorted(offers.items()):
            far = cluster == REMOTE
            if not (o["mask"] & 3 or far):
                continue
            level = 0 if o["cd_municipio_destino"] in towns else 1 if o["cd_municipio_destino"][:2] in {t[:2] for t in towns} else 2
            which = level if o["mask"] & 1 or (o["mask"] & 4 and far) else level + 3
            found.append((losses[which], provider, which))
        yield sorted(found)[:top_n]


@pytest.mark.parametrize("seed, towns_each, at_once", [(1, 1, 1 << 20), (2, 3, 1 << 20), (3, 3, 7), (4, 1, 40)])
def test_offers_are_picked_like_one_by_one(monkeypatch, seed, towns_each, at_once):
    monkeypatch.setattr(picks, "PAIRS", at_once)
    rng = random.Random(seed)
    towns = ["1101", "1102", "22", "2201", "ñ1x", "ñ1y", "9"]
    asked, offers = [], []
    for _ in range(13):
        asked.append([{"dni_empresa": f"E{i}", "cd_municipio_destino": rng.choice(towns), "mask": rng.randint(1, 15)} for i in range(rng.randint(0, 9))])
        of = {}
        for i in range(rng.randint(1, 9)):
            near = sorted(rng.sample(range(6), 3))
            of[f"P{i}"] = (rng.randint(0, 3), [*near, *[x + 2 for x in near]] if rng.random() < 0.9 else [UNKNOWN] * 6, rng.sample(towns, rng.randint(1, towns_each)))
        offers.append(of)
    listed = [[{"DNI_PRESTADOR": p, "o": {"cluster_id": c, "losses": loss, "town": t}} for p, (c, loss, places) in of.items() for t in places] for of in offers]
    form = pa.list_(pa.struct([("DNI_PRESTADOR", pa.string()), ("o", pa.struct([("cluster_id", pa.int32()), ("losses", pa.list_(pa.int64())), ("town", pa.string())]))]))
    key = pa.list_(pa.struct([("dni_empresa", pa.string()), ("cd_municipio_destino", pa.string()), ("mask", pa.int32())]))
    # a slice of a longer column: lists need not begin at 0
    a, b = pa.array(asked, key).slice(1), pa.array(listed, form).slice(1)
    names, got = [x["DNI_PRESTADOR"] for rows in listed[1:] for x in rows], []
    for p in picks.best(a, b, REMOTE, 4):
        assert p.rank.tolist() == [r for n in p.counts for r in range(1, n + 1)]
        rows = iter(zip(p.loss.tolist(), (names[i] for i in p.offer), p.which.tolist(), strict=True))
        got += [[next(rows) for _ in range(n)] for n in p.counts]
        moved = p.unknown_first(UNKNOWN)
        assert sorted(zip(moved.offer, moved.loss, strict=True)) == sorted(zip(p.offer, p.loss, strict=True))
    assert got == [x for orders, of in zip(asked[1:], offers[1:], strict=True) for x in one_by_one(orders, of, 4)]


def test_no_expression_runs_per_order_and_offer(spark, small):
    """Every pair of an order and an offer went through interpreted lambda functions."""
    t = Tables(spark, small)
    args = (WR.orders(t), WR.catalog(t))
    for df in (R.recommend(*args, WR.providers(t), WR.matrix(t), t.clusters), R.recommend_lists(*args, WR.eligible(t))):
        assert "transform(offers" not in plan(df) and "MapInArrow" in plan(df)


def test_columns_may_be_named(spark, small):
    t = Tables(spark, small)
    names = ["dni_empresa", "codigo_tarea", "cd_municipio_destino", "rank", "score_geo", "archetype_name"]
    some, every = WR.recommended(t, columns=names), WR.recommended(t).select(*names)
    assert some.columns == names and some.exceptAll(every).isEmpty() and every.exceptAll(some).isEmpty()
