"""Capacity-limited matching as a search for one cut-off per provider.

Under one strict order of all (group, provider) pairs a settled matching is described by its
cut-offs alone: a full provider has a bar, the last pair it accepts and how many units of it,
and every group's units go down its list to the first providers whose bars they pass. So the
state of the search is one bar per full provider and not the holdings. A provider whose
accepted units exceed its room raises its bar to the pair that fills it; the units turned away
arrive further down their lists, and only the providers where they arrive are looked at next.
Bars only rise, and where no provider is above its room any more, the bars are those of the
one stable matching (deferred acceptance, in whatever order it is carried out).

A round reads the stored groups three times: first the units per provider are summed inside the
tasks, then the steps of providers above their room are sent on, then the pairs of one step each. Where it looks at few
providers, the lists that name none of them are passed over in the scan. Lists are walked
place by place, and only those with units left go on to the next place.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright.session import stage

log = logging.getLogger(__name__)

#: Most providers whose bars (48 bytes each) are sent to the tasks; more take the way by holdings.
MAX_BARS = 1 << 21
#: Providers named one by one in the filter of the scan; for more, all groups are worked out.
NAMED = 200
#: With more bars raised than this, the next round looks at all providers without asking which are reached.
FEW = 20
PAIR = ("loss", "slot", "sig_a", "sig_b")
#: Instead of a list place: no provider takes anything; a group may be split between providers.
NOWHERE, SHARED = -1, -2
_ANY = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Bars:
    """Bars of full providers, by provider number: the last accepted pair and its accepted units."""

    provider: np.ndarray
    loss: np.ndarray
    slot: np.ndarray
    sig_a: np.ndarray
    sig_b: np.ndarray
    units: np.ndarray

    @staticmethod
    def none() -> Bars:
        whole = np.zeros(0, np.int64)
        return Bars(whole, np.zeros(0), whole, whole, whole, whole)

    def raised(self, rows: list) -> Bars:
        """These bars with those of `rows` (provider, loss, slot, sig_a, sig_b, units) in their place."""
        stay = ~np.isin(self.provider, [r[0] for r in rows])
        columns = [np.concatenate((old[stay], np.array([r[i] for r in rows], old.dtype))) for i, old in enumerate(self.columns())]
        order = np.argsort(columns[0])
        return Bars(*(c[order] for c in columns))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.provider, self.loss, self.slot, self.sig_a, self.sig_b, self.units

    def found(self, provider: np.ndarray) -> np.ndarray:
        """Which of the bars is that of each provider, -1 for none."""
        at = np.minimum(np.searchsorted(self.provider, provider), len(self.provider) - 1)
        return np.where(self.provider[at] == provider, at, -1) if len(self.provider) else np.full(provider.shape, -1)

    def by_place(self, providers: int) -> PlacedBars:
        """The same, looked up without a search where providers are numbered from 0."""
        where = np.full(providers, -1, np.int32)
        where[self.provider] = np.arange(len(self.provider))
        return PlacedBars(*self.columns(), where)


@dataclass(frozen=True)
class PlacedBars(Bars):
    where: np.ndarray

    def found(self, provider: np.ndarray) -> np.ndarray:
        return self.where[provider]


@dataclass(frozen=True)
class Step:
    """What happens at one place of all lists that still have units to give: the rows, their cells, the room there and the units taken."""

    row: np.ndarray
    cell: np.ndarray
    room: np.ndarray
    units: np.ndarray


@dataclass(frozen=True)
class Lists:
    """Groups of one Arrow batch: the cells (provider, loss) of all lists one after the other, and where each list begins."""

    at: np.ndarray
    provider: np.ndarray
    loss: np.ndarray
    slot: np.ndarray
    sig_a: np.ndarray
    sig_b: np.ndarray
    qty: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, row: int) -> Lists:
        """Of one row of `numbered`."""
        kinds = zip(batch.schema.names, _BLOCK.values(), strict=True)
        return Lists(*(np.frombuffer(batch.column(i)[row].as_buffer(), kind) for i, (_, kind) in enumerate(kinds)))

    @staticmethod
    def of_columns(column: dict[str, pa.Array]) -> Lists:
        """Of the columns of `folded`; an unknown loss is the last to be taken."""
        at = column["providers"].offsets.to_numpy().astype(np.int64)
        loss = column["losses"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        plain = [column[n].to_numpy().astype(np.int64) for n in ("slot", "sig_a", "sig_b", "qty")]
        return Lists(at - at[0], column["providers"].flatten().to_numpy(), np.where(np.isnan(loss), np.inf, loss), *plain)

    def steps(self, bars: Bars) -> Iterator[Step]:
        """Every group gives its units to the first providers whose bars it passes, one place of the lists after the other."""
        row, left, size = np.arange(len(self.qty)), self.qty.copy(), np.diff(self.at)
        for place in range(size.max(initial=0)):
            row = row[size[row] > place]
            cell = self.at[row] + place
            room = self._room(bars, row, cell)
            units = np.minimum(left[row], room)
            yield Step(row, cell, room, units)
            left[row] -= units
            row = row[left[row] > 0]
            if not len(row):
                return

    def _room(self, bars: Bars, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Units the providers of some cells would take at most: any number, those of their bar, or none."""
        if not len(bars.provider):
            return np.full(len(cell), _ANY)
        at, loss = bars.found(self.provider[cell]), self.loss[cell]
        bar = bars.loss[at]
        room = np.where((at < 0) | (loss < bar), _ANY, 0)
        alike = np.flatnonzero((at >= 0) & (loss == bar))
        row, at = row[alike], at[alike]
        less, equal = np.zeros(len(at), bool), np.ones(len(at), bool)
        for mine, bar in ((self.slot, bars.slot), (self.sig_a, bars.sig_a), (self.sig_b, bars.sig_b)):
            less |= equal & (mine[row] < bar[at])
            equal &= mine[row] == bar[at]
        room[alike] = np.where(less, _ANY, np.where(equal, bars.units[at], 0))
        return room

    def place(self, bars: Bars) -> np.ndarray:
        """List place that takes all orders of a group, `NOWHERE`, or `SHARED` where a bar stands in the group itself."""
        out = np.full(len(self.qty), NOWHERE, np.int32)
        one_each = Lists(self.at, self.provider, self.loss, self.slot, self.sig_a, self.sig_b, np.ones(len(self.qty), np.int64))
        for n, step in enumerate(one_each.steps(bars)):
            takes = step.room > 0
            out[step.row[takes]] = np.where(step.room[takes] == _ANY, n, SHARED)
        return out

    def taken(self, bars: Bars) -> np.ndarray:
        """Units that the provider of each cell takes of its group."""
        out = np.zeros(len(self.provider), np.int64)
        for step in self.steps(bars):
            out[step.cell] = step.units
        return out

    def row_of_cells(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.qty)), np.diff(self.at))

    def naming(self, providers: np.ndarray | None) -> Lists:
        """The groups that list one of the providers (None: all)."""
        if providers is None:
            return self
        size, named = np.diff(self.at), np.isin(self.provider, providers)
        stays = np.zeros(len(size), bool)
        stays[self.row_of_cells()[named]] = True
        cells, at = np.repeat(stays, size), np.concatenate(([0], np.cumsum(size[stays])))
        return Lists(at, self.provider[cells], self.loss[cells], *(x[stays] for x in (self.slot, self.sig_a, self.sig_b, self.qty)))


#: A block of groups as it is stored: the arrays of `Lists` as bytes.
_BLOCK = {"at": np.int64, "provider": np.int32, "loss": np.float64, "slot": np.int64, "sig_a": np.int64, "sig_b": np.int64, "qty": np.int64}


def _blocks(batches: Iterator[pa.RecordBatch], named: np.ndarray | None = None) -> Iterator[Lists]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield Lists.of(batch, row).naming(named)


_GROUP = ["sig_a", "sig_b", "slot", "qty", "providers", "losses"]


def _numbers(slots: int) -> dict[str, Column]:
    """Slot, provider numbers (64-bit hashes of the keys) and losses of a row with sig_a and cands."""
    return {
        "slot": F.pmod(F.col("sig_a"), F.lit(slots)).cast("int"),
        "providers": F.transform("cands", lambda c: F.xxhash64(c["provider"])),
        "losses": F.col("cands.loss").cast("array<double>"),
    }


def folded(orders: DataFrame, slots: int) -> DataFrame:
    """Orders with equal lists as one group, its list as provider numbers and losses: a third of the bytes of `cands`."""
    numbers = _numbers(slots)
    listed = orders.select("sig_a", "sig_b", *[numbers[n].alias(n) for n in ("providers", "losses")])
    firsts = [F.first(n).alias(n) for n in ("providers", "losses")]
    return listed.groupBy("sig_a", "sig_b").agg(F.count(F.lit(1)).alias("qty"), *firsts).withColumn("slot", numbers["slot"])


def numbered(groups: DataFrame, providers: np.ndarray) -> DataFrame:
    """Groups of `folded` in blocks, their providers by place in the sorted `providers`, for `stage_blocks`.

    A row is the groups of one Arrow batch, its columns arrays as bytes: every scan of the search
    passes them to Python as they are, where single rows cost more than the work on them.
    """
    given = groups.sparkSession.sparkContext.broadcast(providers)  # MAX_BARS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = Lists.of_columns({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
            names, at = np.unique(lists.provider, return_inverse=True)
            block = replace(lists, provider=np.searchsorted(given.value, names)[at])
            columns = [pa.array([getattr(block, n).astype(kind).tobytes()], pa.binary()) for n, kind in _BLOCK.items()]
            yield pa.RecordBatch.from_arrays(columns, list(_BLOCK))

    return groups.select(*_GROUP).mapInArrow(run, ", ".join(f"{n} binary" for n in _BLOCK))


def stage_blocks(blocks: DataFrame) -> DataFrame:
    """Stored as they are: what a task reads at once, and so holds, is no more than a split of the files."""
    return stage(blocks, "capacity-blocks", compression="none")


def count_orders(groups: DataFrame) -> int:
    """How many orders are in the blocks of `numbered`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sum(int(lists.qty.sum()) for lists in _blocks(batches))])], ["n"])

    return groups.select(*_BLOCK).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def _named(providers: list[int] | None) -> np.ndarray | None:
    """Providers by which groups are passed over (None or too many to name: no group is)."""
    return None if providers is None or len(providers) > NAMED else np.sort(np.array(providers, np.int64))


def _above(groups: DataFrame, bars: Bars, cap: int, n_providers: int, looked_at: list[int] | None) -> list[int]:
    """Providers that take more than `cap` units. Units are summed inside a task: what is sent is a row per provider and task."""
    given = groups.sparkSession.sparkContext.broadcast((bars, _named(looked_at)))  # a row per full provider, MAX_BARS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars, named = given.value
        bars, much = bars.by_place(n_providers), np.zeros(n_providers, np.int64)
        for lists in _blocks(batches, named):
            for step in lists.steps(bars):
                np.add.at(much, lists.provider[step.cell], step.units)
        who = np.flatnonzero(much)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(much[who])], ["provider", "units"])

    totals = groups.mapInArrow(run, "provider long, units long").groupBy("provider").agg(F.sum("units").alias("units"))
    return [r[0] for r in totals.where(F.col("units") > cap).select("provider").collect()]  # a row per provider at most


def _asks(groups: DataFrame, bars: Bars, asked: list[int], n_providers: int) -> DataFrame:
    """provider, loss, slot and units of every group and provider among `asked` that takes something of it."""
    given = groups.sparkSession.sparkContext.broadcast((bars, np.array(asked, np.int64)))  # MAX_BARS rows at most each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars, asked = given.value
        bars, wanted = bars.by_place(n_providers), np.zeros(n_providers, bool)
        wanted[asked] = True
        for lists in _blocks(batches):
            for step in lists.steps(bars):
                takes = (step.units > 0) & wanted[lists.provider[step.cell]]
                row, cell = step.row[takes], step.cell[takes]
                columns = (lists.provider[cell].astype(np.int64), lists.loss[cell], lists.slot[row], step.units[takes])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*_STEP, "units"])

    return groups.mapInArrow(run, "provider long, loss double, slot long, units long")


_STEP = ["provider", "loss", "slot"]


def _filling(asks: DataFrame, cap: int) -> DataFrame:
    """The (loss, slot) step in which each provider that takes more than `cap` units becomes full, and its units before."""
    totals = asks.groupBy(*_STEP).agg(F.sum("units").alias("total"))
    by_provider = W.partitionBy("provider")
    earlier = by_provider.orderBy("loss", "slot").rowsBetween(W.unboundedPreceding, -1)
    marked = totals.select(*_STEP, "total", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"), F.sum("total").over(by_provider).alias("all"))
    return marked.where((F.col("all") > cap) & (F.col("before") < cap) & (F.col("before") + F.col("total") >= cap)).select(*_STEP, "before")


def _raises(groups: DataFrame, bars: Bars, asked: list[int], cap: int, n_providers: int) -> list:
    """The new bar of every provider that takes more than `cap` units: the pair that fills it.

    Units are counted per (loss, slot) step first; only the pairs of the step in which a
    provider becomes full are read off the lists by a second scan and put in order.
    """
    full = _filling(_asks(groups, bars, asked, n_providers), cap).collect()  # a row per provider at most
    columns = [np.array([r[i] for r in full], kind) for i, kind in enumerate((np.int64, np.float64, np.int64, np.int64))]
    given = groups.sparkSession.sparkContext.broadcast((bars, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars, (provider, loss, slot, before) = given.value
        bars, where = bars.by_place(n_providers), np.full(n_providers, -1)
        where[provider] = np.arange(len(provider))
        for lists in _blocks(batches):
            for step in lists.steps(bars):
                at = where[lists.provider[step.cell]]
                inside = (step.units > 0) & (at >= 0)
                row, cell, at, units = step.row[inside], step.cell[inside], at[inside], step.units[inside]
                inside = (lists.loss[cell] == loss[at]) & (lists.slot[row] == slot[at])
                row, at, units = row[inside], at[inside], units[inside]
                found = (provider[at], loss[at], slot[at], lists.sig_a[row], lists.sig_b[row], units, before[at])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["provider", *PAIR, "units", "before"])

    pairs = groups.mapInArrow(run, "provider long, loss double, slot long, sig_a long, sig_b long, units long, before long")
    ahead = W.partitionBy("provider").orderBy("sig_a", "sig_b").rowsBetween(W.unboundedPreceding, -1)
    room = F.lit(cap) - F.col("before") - F.coalesce(F.sum("units").over(ahead), F.lit(0))
    last = pairs.withColumn("room", room).where((F.col("room") > 0) & (F.col("room") <= F.col("units")))
    return last.select("provider", *PAIR, F.col("room").cast("long").alias("units")).collect()  # a row per provider at most


def _reached(groups: DataFrame, old: Bars, new: Bars, n_providers: int, raised: list[int]) -> list[int]:
    """Providers that take more under the new bars than under the old, in the lists that name one of those raised."""
    given = groups.sparkSession.sparkContext.broadcast((old, new, _named(raised)))  # as in _asks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new, named = given.value
        old, new = old.by_place(n_providers), new.by_place(n_providers)
        for lists in _blocks(batches, named):
            more = lists.taken(new) > lists.taken(old)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(lists.provider[more]).astype(np.int64))], ["provider"])

    # one row per provider
    return [r[0] for r in groups.mapInArrow(run, "provider long").distinct().collect()]


def listed_providers(lists: DataFrame) -> DataFrame:
    """The distinct providers `p` of the lists `cands`: made distinct inside a batch before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).flatten().unique()], ["p"])

    return lists.select(F.col("cands.provider").alias("p")).mapInArrow(run, "p string").distinct()


def count_providers(lists: DataFrame) -> tuple[int, np.ndarray | None]:
    """How many providers are listed, and their sorted numbers if bars for all of them may be used (few enough, numbers differ)."""
    numbers = stage(listed_providers(lists).select(F.xxhash64("p").alias("number")), "capacity-providers")
    row = numbers.agg(F.count("*").alias("n"), F.count_distinct("number").alias("numbers")).first()
    if row["n"] > MAX_BARS or row["n"] != row["numbers"]:
        return row["n"], None
    return row["n"], np.sort(numbers.toArrow().column(0).to_numpy())  # MAX_BARS whole numbers at most


def search(groups: DataFrame, cap: int, providers: np.ndarray, max_rounds: int = 10_000) -> Bars:
    """The bars of the one stable matching.

    Takes the blocks of `numbered`, lists in order of preference, read from a stored table;
    `count_providers` says whether this way is open. Providers prefer by loss, hash slot of the
    group and signature. Every round but the last raises a bar, and a bar is raised at most
    once per pair, so the loop ends; `max_rounds` turns a fault into an error.
    """
    bars, looked_at, n = Bars.none(), None, len(providers)
    for round_ in range(1, max_rounds + 1):
        start = time.perf_counter()
        above = _above(groups, bars, cap, n, looked_at)
        if looked_at is not None and len(looked_at) <= NAMED:  # of the others only some of their groups were read
            above = sorted(set(above) & set(looked_at))
        if not above:
            break
        raised = _raises(groups, bars, above, cap, n)
        old, bars = bars, bars.raised(raised)
        if len(raised) > FEW:
            looked_at = None
        elif not (looked_at := _reached(groups, old, bars, n, [r["provider"] for r in raised])):
            break
        log.info("cut-off round %d: %d bars raised, %s providers reached, %.2f s", round_, len(raised), "all" if looked_at is None else len(looked_at), time.perf_counter() - start)
    else:
        raise RuntimeError(f"no settlement after {max_rounds} rounds; {len(raised)} providers still above their room")
    return replace(bars, provider=providers[bars.provider])


def places(orders: DataFrame, bars: Bars, slots: int) -> DataFrame:
    """Adds `place` (see `Bars.place`) to rows with sig_a, sig_b and cands: read off the bars, without a join."""
    given = orders.sparkSession.sparkContext.broadcast(bars)  # as in _above

    def place(sig_a: pa.Array, sig_b: pa.Array, slot: pa.Array, providers: pa.Array, losses: pa.Array) -> pa.Array:
        columns = {"sig_a": sig_a, "sig_b": sig_b, "slot": slot, "providers": providers, "losses": losses, "qty": pa.array(np.zeros(len(slot), np.int64))}
        return pa.array(Lists.of_columns(columns).place(given.value))

    numbers = _numbers(slots)
    # told to be nondeterministic, a call is not repeated for every filter and column that reads its result
    once = F.arrow_udf(place, "int").asNondeterministic()
    return orders.withColumn("place", once("sig_a", "sig_b", numbers["slot"], numbers["providers"], numbers["losses"]))


def shared(groups: DataFrame, bars: Bars, providers: np.ndarray) -> DataFrame:
    """sig_a, sig_b, qty, pos, held: what the groups at `SHARED` places get from their listed providers; at most one group per bar."""
    n_providers = len(providers)
    given = groups.sparkSession.sparkContext.broadcast(replace(bars, provider=np.searchsorted(providers, bars.provider)))  # as in _above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars = given.value.by_place(n_providers)
        for lists in _blocks(batches):
            of_cell = lists.row_of_cells()
            held = np.where((lists.place(bars) == SHARED)[of_cell], lists.taken(bars), 0)
            cell = np.flatnonzero(held)
            row = of_cell[cell]
            pos = (cell - lists.at[row]).astype(np.int32)
            columns = (lists.sig_a[row], lists.sig_b[row], lists.qty[row], pos, held[cell])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["sig_a", "sig_b", "qty", "pos", "held"])

    return groups.mapInArrow(run, "sig_a long, sig_b long, qty long, pos int, held long")
