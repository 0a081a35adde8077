"""Best-fit packing of tokenised documents after dominance reduction."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchwright.llm.wordtable import block_words, encoded, rows_of, unpack
from matchwright.session import stage

#: Items of a sequence as (length, how many) in placing order.
Pattern = tuple[tuple[int, int], ...]

PIECES = "block long, doc_id long, piece int, start long, length long, ids_crc32 long, place long"


def pieces(docs: DataFrame, tokenizer_json: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids and the end id, cut only where they exceed `capacity`.

    `place` counts the pieces of equal length within their block, from 0.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                words = block_words(row["found"])
                codes, at, out = unpack(row["codes"]), 0, []
                for doc, size in zip(row["docs"], row["sizes"]):
                    ids = memoryview(b"".join([words[c] for c in codes[at : at + size].tolist()]) + end)
                    at += size
                    for piece, s in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * s : 4 * (s + capacity)]
                        out.append((doc, piece, s, len(part) // 4, zlib.crc32(part), bytes(part) if keep_ids else None))
                cols = list(zip(*out))
                length = pd.Series(cols[3])
                arrays = [pa.array(np.full(len(out), row["block"], np.int64))]
                arrays += [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                arrays.append(pa.array(length.groupby(length).cumcount().to_numpy(np.int64)))
                names = ["block", "doc_id", "piece", "start", "length", "ids_crc32", "place"]
                if keep_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cols[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = PIECES + ", ids array<int>" * keep_ids
    # larger blocks than elsewhere: fewer words come twice, and time is the tighter limit here
    return encoded(docs, tokenizer_json, 12 << 20, 13 << 20).select("block", "docs", "sizes", "codes", "found").mapInArrow(run, schema)


# ---- the plan: counts of lengths to counts of filled sequences --------------------------------


def reduce_dominated(counts: Mapping[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], Counter]:
    """Fix sequences that dominate every other choice for their longest item; return them and what is left.

    For an item of length j with room r beside it, the longest fitting item k settles {j, k}
    when every set that fits into r sums to k at most, in one bin place: when nothing fits
    ({j} alone), when k fills r, when no two items fit together, or when no three do and the
    best two sum to k at most. Swapping such a set for k can only free room, so some best
    packing holds {j, k}. Taking items away keeps each condition true, so equal items are
    fixed together.
    """
    left = Counter({w: n for w, n in counts.items() if n > 0})
    fixed: list[tuple[Pattern, int]] = []
    lengths = sorted(left)

    def smallest(j: int, take: int) -> list[int]:
        """The `take` smallest items other than one of length j."""
        out: list[int] = []
        for w in lengths:
            out += [w] * min(take - len(out), left[w] - (w == j))
            if len(out) == take:
                break
        return out

    def best_pair(j: int, room: int) -> int:
        best = 0
        for w in lengths:
            if 2 * w > room:
                break
            i = bisect_right(lengths, room - w) - 1
            while i >= 0 and lengths[i] >= w:
                v = lengths[i]
                if left[v] - (v == j) >= 1 + (v == w):
                    best = max(best, w + v)
                    break
                i -= 1
        return best

    for j in sorted(left, reverse=True):
        while left[j]:
            lengths = [w for w in lengths if left[w]]
            room = capacity - j
            fits = [w for w in lengths[: bisect_right(lengths, room)] if left[w] - (w == j) > 0][-1:]
            if not fits:
                n = 1 if 2 * j <= capacity else left[j]
                fixed.append((((j, 1),), n))
                left[j] -= n
                continue
            k = fits[0]
            two, three = smallest(j, 2), smallest(j, 3)
            sure = (
                k == room
                or len(two) < 2
                or sum(two) > room
                or ((len(three) < 3 or sum(three) > room) and best_pair(j, room) <= k)
            )
            if not sure:
                break
            n = left[j] // 2 if k == j else min(left[j], left[k])
            fixed.append(((((j, 2),) if k == j else ((j, 1), (k, 1))), n))
            left[j] -= n
            left[k] -= n
    return fixed, +left


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: the longest items first, each into the fullest sequence that takes it."""
    open_: list[list[tuple[Pattern, int]]] = [[] for _ in range(capacity + 1)]
    for w in sorted((w for w, n in counts.items() if n > 0), reverse=True):
        n, room = counts[w], w
        while n:
            while room <= capacity and not open_[room]:
                room += 1
            if room > capacity:
                pattern, bins, space = (), n, capacity
            else:
                (pattern, bins), space = open_[room].pop(), room
            each = space // w  # a sequence stays the fullest that takes w until w no longer fits
            full = min(bins, n // each)
            if full:
                open_[space - each * w].append((pattern + ((w, each),), full))
                n, bins = n - full * each, bins - full
            if n and bins:  # fewer than `each` are left
                open_[space - n * w].append((pattern + ((w, n),), 1))
                n, bins = 0, bins - 1
            if bins and pattern:
                open_[space].append((pattern, bins))
    return [x for kept in open_ for x in kept]


def plan(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    fixed, left = reduce_dominated(counts, capacity)
    return fixed + best_fit(left, capacity)


def _runs(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """Length -> runs (first rank, items per sequence, first sequence, offset), ascending by first rank."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, bins in patterns:
        offset = 0
        for w, each in pattern:
            runs.setdefault(w, []).append((used[w], each, sequence, offset))
            used[w] += each * bins
            offset += each * w
        sequence += bins
    return {w: np.array(r, np.int64) for w, r in runs.items()}


def place(rows: DataFrame, capacity: int = 4096) -> DataFrame:
    """Pieces (see `pieces`, a stored table) with sequence_id and offset.

    Only lengths matter for the plan, so it is made from the counts per length: `capacity`
    rows at most reach the driver, whatever the input. Each piece then takes its slot by its
    rank among pieces of equal length: its place in its block after the pieces of the blocks
    before, so that a common length is no hot key.
    """
    spark = rows.sparkSession
    per_block = rows.groupBy("block", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    per_block = stage(per_block.withColumn("before", F.coalesce(before, F.lit(0))), "packing-lengths")
    counts = {r.length: r.n for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_runs(plan(counts, capacity)))
    ranked = rows.join(per_block.select("block", "length", "before"), ["block", "length"])
    ranked = ranked.select(*(c for c in rows.columns if c not in ("block", "place")), (F.col("before") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for w in np.unique(length):
                own = np.flatnonzero(length == w)
                table = runs.value[int(w)]
                first, each, base, shift = table[np.searchsorted(table[:, 0], rank[own], side="right") - 1].T
                sequence[own] = base + (rank[own] - first) // each
                offset[own] = shift + (rank[own] - first) % each * w
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"]
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank"]
    return ranked.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, tokenizer_json: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece (and its ids).

    Null and empty texts are the end id alone; a document is one piece unless it is longer
    than `capacity`. Repeated rows and ids are documents of their own; equal lengths are
    placed in stored order; other columns are not read; an empty table gives no rows.
    """
    rows = stage(pieces(docs, tokenizer_json, capacity, end_id, keep_ids), "packing-pieces")
    out = place(rows, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else []))
