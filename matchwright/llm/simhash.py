"""Near-duplicates by SimHash: 64-bit fingerprints, linked by tiled exact comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.components import components
from matchwright.llm.texts import LOWER, word_runs
from matchwright.session import stage

#: Population counts are taken per quarter of the fingerprint: 17 values each.
QUARTER_BITS, QUARTERS = 16, 4
BASE = QUARTER_BITS + 1


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set (bit 0 first)."""
    bits = np.unpackbits(np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text over word shingles, as an unsigned number."""
    if not text:
        return 0
    ones, total, tail = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_runs(text.encode("utf-8", "surrogatepass").translate(LOWER)):
        words = tail + words
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
            hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)
            ones += _bit_counts(hashes)
            total += len(hashes)
        tail = words[max(0, len(words) - width + 1) :]
    if total == 0:
        if not tail:
            return 0
        ones, total = _bit_counts(np.array([digest(b" ".join(tail), seed)], dtype=np.uint64)), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The long columns `keys` and fp (the 64 bits as a signed long) of every row; null and empty texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width, seed) for t in b.column(len(keys))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))], [*keys, "fp"])

    cut = docs.select(*(F.col(k).cast("long").alias(k) for k in keys), F.col("text").cast("string").alias("text"))
    return cut.mapInArrow(run, ", ".join(f"{k} long" for k in (*keys, "fp")))


# ---- linking ---------------------------------------------------------------------------------


def _cell(fp) -> F.Column:
    """The population counts of the four quarters as one number."""
    mask = F.lit((1 << QUARTER_BITS) - 1)
    cell = F.lit(0)
    for q in range(QUARTERS):
        cell = cell * BASE + F.bit_count(F.shiftrightunsigned(fp, q * QUARTER_BITS).bitwiseAND(mask))
    return cell.cast("int")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Count differences a linked pair can have, one of each mirrored two: their sizes sum to `radius` at most."""
    near = (d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius)
    return [d for d in near if d >= (0,) * QUARTERS]


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int, pairs: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within a tile (b None) or between two tiles.

    Every pair is compared, in blocks; of the links only a spanning set is kept, so a dense
    group gives no more rows than it has members.
    """
    both = a if b is None else np.concatenate((a, b))
    right = a if b is None else b
    shift = 0 if b is None else len(a)
    root = np.arange(len(both))
    step = max(1, pairs // max(1, len(right)))
    for s in range(0, len(a), step):
        rest = right[s:] if b is None else right
        i, j = np.nonzero(np.bitwise_count(a[s : s + step, None] ^ rest[None, :]) <= radius)
        i, j = i + s, j + (s if b is None else shift)
        while len(i):
            x, y = root[i], root[j]
            open_ = x != y
            if not open_.any():
                break
            i, j, low, high = i[open_], j[open_], np.minimum(x, y)[open_], np.maximum(x, y)[open_]
            np.minimum.at(root, high, low)
            while not np.array_equal(root, up := root[root]):
                root = up
    child = np.flatnonzero(root != np.arange(len(both)))
    return both[child], both[root[child]]


def links(fps: DataFrame, radius: int = 2, tile: int = 16384) -> DataFrame:
    """Edges (a, b) that connect all distinct `fp` values at `radius` or fewer differing bits.

    Tiles hold fingerprints of equal population counts per quarter. Two fingerprints that
    differ in r bits differ by at most r in the summed count differences, so tile pairs
    beyond the radius are never formed; every other pair of tiles is compared in full. A cell
    with more values than `tile` is cut by hash, each of its tiles meets every near tile.
    """
    distinct = fps.select("fp").dropna().distinct().withColumn("cell", _cell(F.col("fp")))
    # at most 17^4 rows, whatever the input: the sizes of the cells
    sizes = distinct.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
    tiles = (
        distinct.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int").alias("cut"))
        .agg(F.collect_list("fp").alias("fps"))  # `tile` values on average, by the cut above
    )
    tiles = stage(tiles, "simhash-tiles")
    weights = [BASE ** (QUARTERS - 1 - q) for q in range(QUARTERS)]
    steps = [(list(d), sum(x * w for x, w in zip(d, weights))) for d in _steps(radius)]
    # a step that leaves 0..16 in some quarter would wrap into another cell: those are left out
    quarter = [F.pmod(F.floor(F.col("cell") / w), F.lit(BASE)) for w in weights]
    other = F.array(
        *(
            F.when(
                F.forall(F.array(*(q + x for q, x in zip(quarter, d))), lambda v: v.between(0, QUARTER_BITS)),
                F.col("cell") + add,
            )
            for d, add in steps
        )
    )
    left = tiles.select(
        F.col("cell").alias("home"), F.col("cut").alias("home_cut"), F.col("fps").alias("left"), F.explode(other).alias("cell")
    ).dropna(subset=["cell"])
    pairs = left.join(tiles.withColumnRenamed("fps", "right"), "cell").where("home <> cell or cut >= home_cut")
    pairs = pairs.select("left", F.when(F.expr("home <> cell or cut <> home_cut"), F.col("right")).alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            out = []
            for i in range(batch.num_rows):
                a = left[i].values.to_numpy(zero_copy_only=False)
                b = right[i].values.to_numpy(zero_copy_only=False) if right[i].is_valid else None
                out.append(_forest(a.view(np.uint64), None if b is None else b.view(np.uint64), radius))
            if out:
                ends = [np.concatenate([x[k] for x in out]).view(np.int64) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _members(fps: DataFrame, radius: int, tile: int) -> DataFrame:
    """fp and root, the fingerprint that stands for its component, for every distinct fp."""
    values = fps.select("fp").distinct()
    roots = components(links(values, radius, tile))
    placed = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return stage(placed.select("fp", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42, tile: int = 16384) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id that links reach.

    Null and empty texts have fingerprint zero and are linked like any other. Every row gives
    one row, repeated rows as often as they come; a null doc_id keeps its row and never is a
    component_id unless the whole component has none. Other columns are not read.
    """
    fps = stage(fingerprints(docs, width, seed), "simhash-fps")
    placed = _members(fps, radius, tile)
    # copies meet by fingerprint before anything is joined
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    heads = first.join(placed, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    member = placed.join(heads, "root").select("fp", "component_id")
    return fps.join(member, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42, tile: int = 16384) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the least doc_id stays.

    Ties and missing ids go to the row that is stored first, so exactly one row of each
    component stays. `docs` must be a stored table, which gives its rows in the same order
    each time it is read; all its columns pass through, whatever their names.
    """
    numbered = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("number"))
    marked = numbered.select("number", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").alias("text"))
    fps = stage(fingerprints(marked, width, seed, ("number", "id")), "simhash-fps")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number"))
    first = fps.groupBy("fp").agg(best.alias("best"))
    heads = first.join(_members(fps, radius, tile), "fp").groupBy("root").agg(F.min("best").alias("best"))
    stay = heads.select(F.col("best.number").alias("number"))
    return numbered.join(stay, "number", "left_semi").select("row.*")
