"""Lists walked place by place, and the blocks they are stored in."""

import numpy as np
import pyarrow as pa
import pytest

from matchwright.operators import cutoffs as C
from test_plans import plan
from workload import registry as WR
from workload.views import Tables


def lists(rng, n, providers, width):
    size = rng.integers(0, width + 1, n)
    at = np.concatenate(([0], np.cumsum(size)))
    cells = [rng.permutation(providers)[:k] for k in size]
    loss = [np.sort(rng.integers(0, 4, k)).astype(float) for k in size]
    plain = [rng.integers(0, 5, n), rng.integers(0, 9, n), np.arange(n), rng.integers(1, 6, n)]
    return C.Lists(at, np.concatenate([*cells, np.zeros(0, np.int64)]).astype(np.int32), np.concatenate([*loss, np.zeros(0)]), *plain)


def room(groups, bars, i, cell):
    """Units the provider of one cell would take."""
    for j, p in enumerate(bars.provider):
        if p == groups.provider[cell]:
            mine = (groups.loss[cell], groups.slot[i], groups.sig_a[i], groups.sig_b[i])
            bar = (bars.loss[j], bars.slot[j], bars.sig_a[j], bars.sig_b[j])
            return 10**9 if mine < bar else int(bars.units[j]) if mine == bar else 0
    return 10**9


@pytest.mark.parametrize("seed", range(4))
def test_steps_are_one_group_at_a_time(seed):
    rng = np.random.default_rng(seed)
    groups = lists(rng, 60, 8, 5)
    full = np.sort(rng.permutation(8)[: 2 * seed])
    pick = [rng.choice(np.flatnonzero(groups.provider == p)) for p in full]  # a bar stands in a pair
    row = groups.row_of_cells()[pick] if len(pick) else np.zeros(0, int)
    bars = C.Bars(full, groups.loss[pick] if len(pick) else np.zeros(0), groups.slot[row], groups.sig_a[row], groups.sig_b[row], np.ones(len(full), np.int64))
    for form in (bars, bars.by_place(8)):
        taken, place = groups.taken(form), groups.place(form)
        for i in range(60):
            left, want = int(groups.qty[i]), C.NOWHERE
            for cell in range(groups.at[i], groups.at[i + 1]):
                there = room(groups, bars, i, cell)
                assert taken[cell] == min(left, there)
                if there and want == C.NOWHERE:
                    want = int(cell - groups.at[i]) if there == 10**9 else C.SHARED
                left -= min(left, there)
            assert place[i] == want
    named = groups.naming(np.array([1, 2]))
    stays = [i for i in range(60) if set(groups.provider[groups.at[i] : groups.at[i + 1]]) & {1, 2}]
    assert named.sig_b.tolist() == stays and np.diff(named.at).tolist() == np.diff(groups.at)[stays].tolist()


def test_groups_are_stored_in_blocks(spark):
    """A scan of the search passed every group to Python as a row of its own; an unknown loss is the last to be taken."""
    rows = [(i, -i, i % 3, 1 + i % 2, [7, 9][: i % 3], [-0.5, None][: i % 3]) for i in range(25)]
    groups = spark.createDataFrame(rows, "sig_a long, sig_b long, slot int, qty long, providers array<long>, losses array<double>").coalesce(1)
    stored = C.stage_blocks(C.numbered(groups, np.array([7, 8, 9])))
    assert stored.count() == 1 and C.count_orders(stored) == sum(r[3] for r in rows)
    block = C.Lists.of(pa.Table.from_batches(stored.toArrow().to_batches()).combine_chunks().to_batches()[0], 0)
    assert block.sig_a.tolist() == list(range(25)) and block.qty.tolist() == [r[3] for r in rows]
    assert block.provider[block.at[2] : block.at[3]].tolist() == [0, 2] and block.loss[block.at[2] : block.at[3]].tolist() == [-0.5, np.inf]


def test_pairs_are_not_formed_by_lambda_functions(spark, small):
    """Every reader of the stored lists formed its (loss, provider) pairs by an interpreted function."""
    cands = WR.signed_lists(Tables(spark, small)).select("cands")
    assert "lambdafunction" not in plan(cands) and cands.schema["cands"].dataType.elementType.names == ["loss", "provider"]
