"""The best offers of many orders, by arrays instead of one expression per order and offer.

A batch has one row per task: the orders that ask for it and the offers for it. Orders and
enablings (an offer in one of its towns) of a task are paired off in chunks of bounded size; a
pair is one whole number that holds order, loss, place of the offer and which of its losses it
is, so one sort of numbers ranks all orders of a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs of an order and an enabling that are held at a time (a few dozen bytes each); one order's pairs always are.
PAIRS = 1 << 20
#: Bits of a loss, and of the number of the loss among the six of an offer.
LOSS_BITS, WHICH_BITS = 32, 3
_UNTIL = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Picked:
    """Orders `first` to `last` of a batch: how many offers each gets, and those in order (`offer`: a row of the offer in the batch)."""

    first: int
    last: int
    counts: np.ndarray
    offer: np.ndarray
    rank: np.ndarray
    loss: np.ndarray
    which: np.ndarray

    def unknown_first(self, unknown: int) -> Picked:
        """The same, the offers of an order whose loss is `unknown` ahead of its others."""
        turn = np.lexsort((self.rank, self.loss != unknown, np.repeat(np.arange(len(self.counts)), self.counts)))
        return replace(self, **{f: getattr(self, f)[turn] for f in ("offer", "rank", "loss", "which")})


def flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the lists of a column begin and end in their values, and those values."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.flatten()


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ... of every span of sizes[i], one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def town_codes(asked: pa.Array, enabled: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the towns asked for and enabled, and the department number of every town number."""
    towns = pa.chunked_array([asked, enabled]).combine_chunks().dictionary_encode()
    department = pc.utf8_slice_codeunits(towns.dictionary, 0, 2).dictionary_encode().indices.to_numpy()
    codes = towns.indices.to_numpy()
    return codes[: len(asked)], codes[len(asked) :], department


def best(asked: pa.Array, offers: pa.Array, remote_cluster: int, top_n: int) -> Iterator[Picked]:
    """The `top_n` offers with the least loss of every order, ties by place.

    `asked` lists cd_municipio_destino and mask per task, `offers` its enablings: DNI_PRESTADOR, in order, and
    `o` with cluster_id, losses and town. An enabling in a nearer town never has the greater loss.
    An order reaches the remote group only, unless bit 0 or 1 of its mask is set. It has the higher
    seniority bar (the last three losses) unless bit 0, or for the remote group bit 2, is set.
    """
    order_at, orders = flat(asked)
    offer_at, rows = flat(offers)
    own = rows.field("o")
    order_town, offer_town, department = town_codes(orders.field("cd_municipio_destino"), own.field("town"))
    losses = own.field("losses").flatten().to_numpy()
    remote = own.field("cluster_id").to_numpy(zero_copy_only=False) == remote_cluster
    mask = orders.field("mask").to_numpy()

    # an offer begins where the provider or the task changes; its place is counted within the task
    who = rows.field("DNI_PRESTADOR").dictionary_encode().indices.to_numpy()
    begins = np.concatenate((np.ones(min(1, len(who)), bool), who[1:] != who[:-1]))
    begins[offer_at[:-1][np.diff(offer_at) > 0]] = True
    offers_before = np.concatenate(([0], np.cumsum(begins)))[offer_at]
    place = np.cumsum(begins) - 1 - np.repeat(offers_before[:-1], np.diff(offer_at))
    offer_row = np.flatnonzero(begins)
    one_town = len(offer_row) == len(rows)
    task = np.repeat(np.arange(len(asked)), np.diff(order_at))
    begin, sizes = offer_at[:-1][task], np.diff(offer_at)[task]

    place_bits = int(place.max(initial=0)).bit_length()
    low = WHICH_BITS + place_bits
    at_once = 1 << (63 - LOSS_BITS - low)
    upto, first = np.cumsum(sizes), 0
    while first < len(orders):
        done = upto[first - 1] if first else 0
        last = min(max(first + 1, int(np.searchsorted(upto, done + PAIRS, "right"))), first + at_once, len(orders))
        order = np.repeat(np.arange(last - first), sizes[first:last])
        enabling = spans(begin[first:last], sizes[first:last])
        here, there = order_town[first:last][order], offer_town[enabling]
        level = np.where(here == there, 0, np.where(department[here] == department[there], 1, 2))
        far, seen = remote[enabling], mask[first:last]
        plain = ((seen & 1) != 0)[order] | (((seen & 4) != 0)[order] & far)
        which = np.where(plain, level, level + 3)
        number = (((order << LOSS_BITS) + losses[enabling * 6 + which] << place_bits) + place[enabling] << WHICH_BITS) + which
        number[~(((seen & 3) != 0)[order] | far)] = _UNTIL
        if not one_town and len(number):
            # towns of an offer stand side by side; the nearest has the least loss
            turn = np.flatnonzero(begins[enabling])
            number = np.minimum.reduceat(number, turn)
        number = np.sort(number[number != _UNTIL])
        order = number >> (LOSS_BITS + low)
        found = np.bincount(order, minlength=last - first)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(found) - found, found)
        number, order, rank = (x[rank < top_n] for x in (number, order, rank))
        loss = (number >> low) & ((1 << LOSS_BITS) - 1)
        at = (number >> WHICH_BITS) & ((1 << place_bits) - 1)
        row = offer_row[offers_before[task[first:last]][order] + at]
        yield Picked(first, last, np.minimum(found, top_n), row, rank + 1, loss, number & ((1 << WHICH_BITS) - 1))
        first = last
