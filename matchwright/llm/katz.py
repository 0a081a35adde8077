"""A Katz back-off language model: Good-Turing discounted counts, exactly normalised back-off weights.

Texts become blocks of word numbers. Each block sends its distinct words, and later its
distinct word pairs, to the partition that owns them; the partition counts them over all
blocks and sends counts or log probabilities back. So a word or pair that is everywhere is
one entry per block, and nothing of the vocabulary's size is held in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.texts import slices, tidy
from matchwright.session import stage

START, END, FIRST_WORD = 0, 1, 2
#: Counts up to this are discounted, as is usual.
K = 5


# ---- arrays as bytes -------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, each in its least width, byte plane by byte plane, compressed."""
    out = []
    for a in arrays:
        top = int(a.max(initial=0))
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        planes = np.ascontiguousarray(a.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
        out.append(np.array([width, len(a)], "<i8").tobytes() + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    while at < len(data):
        width, n = np.frombuffer(data, "<i8", 2, at).tolist()
        planes = np.frombuffer(data, np.uint8, width * n, at + 16).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))
        at += 16 + width * n
    return out


# ---- blocks and word counts ------------------------------------------------------------------

BLOCK = "docs array<long>, held array<boolean>, sizes array<int>, codes binary, words binary, counts binary, n_words long, n_tokens long, train_words long, train_docs long"


def token_blocks(docs: DataFrame, size: int, folds: int, held_out: int) -> DataFrame:
    """Documents in blocks of about `size` bytes: words per document, word numbers, word list with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", size):
                text = pc.ascii_trim_whitespace(pc.ascii_lower(part.column(2)))
                lists = pc.ascii_split_whitespace(text)
                sizes = np.where(pc.equal(text, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(lists).to_numpy())
                flat = lists.flatten()
                flat = flat.filter(pc.not_equal(flat, ""))  # an empty text splits into one empty word
                words = flat.dictionary_encode()
                codes, n = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
                held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                every = np.bincount(codes, minlength=n)
                train = np.bincount(codes[np.repeat(~held, sizes)], minlength=n)
                text_list = "\n".join(words.dictionary.to_pylist()).encode()
                row = {
                    "docs": part.column(0).to_pylist(), "held": held, "sizes": sizes.astype(np.int32), "codes": pack(codes),
                    "words": zstandard.ZstdCompressor(level=1).compress(text_list), "counts": pack(train, every), "n_words": n,
                    "n_tokens": len(codes), "train_words": int(train.sum()), "train_docs": int((~held).sum()),
                }
                del text, lists, flat, words, codes
                kinds = (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), *[pa.binary()] * 3, *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))
                tidy()

    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold, F.lit(False)).alias("held"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return cut.mapInArrow(run, BLOCK).withColumn("block", F.monotonically_increasing_id())


def _word_list(blob: bytes) -> list[str]:
    text = zstandard.ZstdDecompressor().decompress(blob).decode()
    return text.split("\n") if text else []


def word_table(blocks: DataFrame, parts: int, hot: int) -> DataFrame:
    """Ids and training counts of every block's words, counted over all blocks where the word lives.

    The first row of each of the `parts` partitions also has its number of distinct training
    words, its counts of counts 1..K+1, and the ids of words that occur `hot` times or more.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = np.array(_word_list(blob), dtype=object)
                if not len(words):
                    continue
                train, every = unpack(counts)
                home = (pd.util.hash_array(words, categorize=False) % parts).astype(np.int64)
                order = np.argsort(home, kind="stable")
                cuts = np.flatnonzero(np.diff(home[order])) + 1
                for own in np.split(order, cuts):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([home[own[0]]], pa.int32()), "block": pa.array([block], pa.int64()),
                            "codes": pa.array([pack(own, train[own], every[own])], pa.binary()),
                            "words": pa.array([zstandard.ZstdCompressor(level=1).compress("\n".join(words[own]).encode())], pa.binary()),
                        }
                    )

    def count(group: pa.Table) -> pa.Table:
        lists = [_word_list(w) for w in group.column("words").to_pylist()]
        codes = [unpack(c) for c in group.column("codes").to_pylist()]
        every = pa.array([w for words in lists for w in words], pa.string()).dictionary_encode()
        index, n = every.indices.to_numpy(), len(every.dictionary)
        train = np.bincount(index, np.concatenate([c[1] for c in codes]), n).astype(np.int64)
        total = np.bincount(index, np.concatenate([c[2] for c in codes]), n)
        ids = FIRST_WORD + group.column("part")[0].as_py() + parts * np.arange(n, dtype=np.int64)
        ends = np.cumsum([len(words) for words in lists])
        found = [pack(c[0], ids[i], train[i]) for c, i in zip(codes, np.split(index, ends[:-1]))]
        rest = [None] * (len(found) - 1)
        counts = np.bincount(train[(train > 0) & (train <= K + 1)], minlength=K + 2)[1:]
        return pa.table(
            {
                "block": group.column("block"), "found": pa.array(found, pa.binary()),
                "seen": pa.array([int((train > 0).sum()), *rest], pa.int64()),
                "counts": pa.array([counts, *rest], pa.list_(pa.int64())),
                "hot": pa.array([ids[total >= hot], *rest], pa.list_(pa.int64())),
            }
        )

    routed = blocks.select("block", "words", "counts").mapInArrow(route, "part int, block long, codes binary, words binary")
    return routed.groupBy("part").applyInArrow(count, "block long, found binary, seen long, counts array<long>, hot array<long>")


# ---- discounts -------------------------------------------------------------------------------


def good_turing(counts: list[int]) -> np.ndarray:
    """Discount factor of count c at index c, up to K (index 0 unused), from the counts of counts 1..K+1.

    Katz's form, which spreads the once-seen mass over the counts up to K. Where the counts of
    counts do not support it as they are (a factor outside (0, 1), as copied texts make), they
    are smoothed by a log-linear fit; where that falls no faster than 1 / count (few words in
    all), absolute discounting by n1 / (n1 + 2 n2) takes its place for all counts up to K.
    """
    n = [0.0, *map(float, counts)]
    out = np.ones(K + 1)
    for z in (n, smoothed(n)):
        if z is not None and all(z[1:]):
            common = (K + 1) * z[K + 1] / z[1]
            if common != 1.0:
                for c in range(1, K + 1):
                    out[c] = ((c + 1) * z[c + 1] / (c * z[c]) - common) / (1.0 - common)
                if ((out[1:] > 0) & (out[1:] < 1)).all():
                    return out
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    out[1:] = [(c - off) / c for c in range(1, K + 1)]
    return out


def smoothed(n: list[float]) -> list[float] | None:
    """Counts of counts on the line through (log r, log Z_r), as in simple Good-Turing; None without a slope below -1.

    Z_r spreads a count of counts over the empty counts around it. A line that falls faster
    than 1 / r gives discount factors in (0, 1).
    """
    held = [r for r in range(1, K + 2) if n[r]]
    if len(held) < 2:
        return None
    after = [*held[1:], 2 * held[-1] - held[-2]]
    z = [2 * n[r] / (t - q) for q, r, t in zip([0, *held], held, after)]
    slope, level = np.polyfit(np.log(held), np.log(z), 1)
    return [0.0, *(math.exp(level) * r**slope for r in range(1, K + 2))] if slope < -1 - 1e-9 else None


@dataclass
class Unigrams:
    """Discounted word probabilities; what the discounts free goes to one class of unknown words."""

    tokens: int
    distinct: int
    factors: np.ndarray
    unknown: float

    @classmethod
    def of(cls, tokens: int, distinct: int, counts: list[int]) -> Unigrams:
        factors = good_turing(counts)
        freed = sum(n * c * (1 - factors[c]) for c, n in enumerate(counts[:K], 1))
        if tokens and not freed:  # no count up to K: one more event, never seen, takes a share
            return cls(tokens + 1, distinct, factors, 1.0 / (tokens + 1))
        return cls(tokens, distinct, factors, freed / tokens if tokens else 1.0)

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.factors) / max(1, self.tokens), self.unknown)


def discounted(c: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return c * np.where(c <= K, factors[np.minimum(c, K)], 1.0)


# ---- pairs -----------------------------------------------------------------------------------


def _home(h: np.ndarray, w: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a pair: by history; pairs of a hot history are dealt by their second word."""
    spread = np.isin(h, hot)
    mixed = (h + np.where(spread, 1 + w, 0)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


@dataclass
class Pairs:
    """The distinct pairs of a block in order of (history, word), and the pair of every token."""

    h: np.ndarray
    w: np.ndarray
    history_count: np.ndarray
    word_count: np.ndarray
    train: np.ndarray
    of_token: np.ndarray
    doc_of_token: np.ndarray


def block_pairs(row: dict, train_docs: int) -> Pairs:
    """Pairs of one block; each text runs from START to END."""
    parts = [unpack(f) for f in row["found"] or ()]
    n = sum(len(p[0]) for p in parts)
    ids, counts = np.zeros(n + 2, np.int64), np.zeros(n + 2, np.int64)
    ids[:2], counts[:2] = (START, END), (train_docs, train_docs)
    for codes, own, c in parts:
        ids[codes + 2], counts[codes + 2] = own, c
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    ids, counts = ids[order], counts[order]
    sizes = np.array(row["sizes"], np.int64)
    last = np.cumsum(sizes + 1) - 1
    tokens = np.full(int(sizes.sum()) + len(sizes), END, np.int64)
    inner = np.ones(len(tokens), bool)
    inner[last] = False
    tokens[inner] = rank[unpack(row["codes"])[0] + 2]  # START and END keep ranks 0 and 1
    keys = np.full(len(tokens), START, np.int64)
    keys[1:] = tokens[:-1]
    keys[last - sizes] = START
    keys <<= 32
    keys |= tokens
    del tokens, inner
    keys, of_token = np.unique(keys, return_inverse=True)
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    trained = ~np.array(row["held"], bool)[doc]
    train = np.bincount(of_token[trained], minlength=len(keys))
    h, w = keys >> 32, keys & 0xFFFFFFFF
    return Pairs(ids[h], ids[w], counts[h], counts[w], train, of_token, doc)


TABLE = "part int, blocks array<long>, places array<binary>, pairs binary, histories binary, counts array<long>"


def pair_table(blocks: DataFrame, parts: int, hot: np.ndarray, train_docs: int) -> DataFrame:
    """The pair counts, one row per partition: its pairs with counts, its histories, and the places of each block's pairs."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tidy()
                row = batch.slice(i, 1).to_pylist()[0]
                p = block_pairs(row, train_docs)
                home = _home(p.h, p.w, hot, parts)
                order = np.argsort(home, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                    blob = pack(p.h[own], p.w[own], p.history_count[own], p.word_count[own], p.train[own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([home[own[0]]], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([blob], pa.binary())],
                        ["part", "block", "pairs"],
                    )

    def merge(group: pa.Table) -> pa.Table:
        own = [unpack(b.as_py()) for b in group.column("pairs")]
        h, w, hc, wc, train = (np.concatenate(x) for x in zip(*own))
        names, hi = np.unique(h, return_inverse=True)
        words, wi = np.unique(w, return_inverse=True)
        keys, first, place = np.unique((hi << 32) | wi, return_index=True, return_inverse=True)
        count = np.bincount(place, train, len(keys)).astype(np.int64)
        history = np.zeros(len(names), np.int64)
        history[hi] = hc
        ends = np.cumsum([len(x[0]) for x in own])
        counts = np.bincount(count[(count > 0) & (count <= K + 1)], minlength=K + 2)[1:]
        return pa.table(
            {
                "part": group.column("part").slice(0, 1),
                "blocks": pa.array([group.column("block").to_pylist()], pa.list_(pa.int64())),
                "places": pa.array([[pack(x) for x in np.split(place, ends[:-1])]], pa.list_(pa.binary())),
                "pairs": pa.array([pack(keys >> 32, wc[first], count)], pa.binary()),
                "histories": pa.array([pack(names, history)], pa.binary()),
                "counts": pa.array([counts], pa.list_(pa.int64())),
            }
        )

    routed = blocks.mapInArrow(route, "part int, block long, pairs binary")
    return routed.groupBy("part").applyInArrow(merge, TABLE)


@dataclass
class Model:
    """What every task needs besides the tables: a few numbers, and sums of the hot histories."""

    unigrams: Unigrams
    factors: np.ndarray
    hot: dict[int, tuple[float, float]]

    def sums(self, row: dict) -> tuple[np.ndarray, ...]:
        """Pairs and histories of a partition, with the discounted and the lower-order mass seen after each history."""
        hi, wc, count = unpack(row["pairs"])
        names, history = unpack(row["histories"])
        seen = np.where(count > 0, discounted(count, self.factors) / np.maximum(1, history[hi]), 0.0)
        low = np.where(count > 0, self.unigrams(wc), 0.0)
        return hi, wc, count, names, history, seen, np.bincount(hi, seen, len(names)), np.bincount(hi, low, len(names))

    def log_probabilities(self, row: dict) -> np.ndarray:
        """log10 p(word | history) of a partition's pairs.

        A pair seen in training has its discounted share; any other backs off to the word's
        probability times the weight that makes the history's probabilities sum to one; a
        history never seen in training is the word's probability alone. Where a history's
        discounts free nothing (all its pairs came more than K times), one more event, never
        seen, takes a share of 1 / (count + 1).
        """
        hi, wc, count, names, history, seen, given, low = self.sums(row)
        for name, (a, b) in self.hot.items():
            at = np.searchsorted(names, name)
            if at < len(names) and names[at] == name:
                given[at], low[at] = a, b
        free = 1.0 - given
        none = (free <= 1e-12) & (history > 0)
        scale = np.where(none, history / (history + 1.0), 1.0)
        free = np.where(none, 1.0 / (history + 1.0), free)
        weight = np.where(history > 0, free / (1.0 - low), 1.0)
        return np.log10(np.where(count > 0, seen * scale[hi], weight[hi] * self.unigrams(wc)))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(
    docs: DataFrame,
    folds: int = 5,
    held_out: int = 1,
    block_bytes: int = 8 << 20,
    part_words: int = 400_000,
    part_tokens: int = 1_500_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The bigram model is learnt from all rows whose crc32(doc_id as text) mod `folds` is not
    `held_out` (rows without a doc_id are training rows). A text is its lower-cased words and
    one end; null and empty texts are the end alone. Words never seen in training form one
    class with the mass that unigram discounts free. Partitions hold about `part_tokens`
    tokens; a history with more is dealt over all of them and its sums are put together, a
    number of histories below tokens / part_tokens. Repeated rows count as often as they
    come; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = stage(token_blocks(docs, block_bytes, folds, held_out), "katz-blocks")
    sums = ("n_words", "n_tokens", "train_words", "train_docs")
    n_words, n_tokens, train_words, train_docs = (x or 0 for x in blocks.agg(*(F.sum(c) for c in sums)).first())
    words = stage(word_table(blocks, max(1, math.ceil(n_words / part_words)), part_tokens), "katz-words")
    counts = [F.coalesce(F.sum(F.get("counts", F.lit(i))), F.lit(0)) for i in range(K + 1)]
    seen, *of_words = words.agg(F.coalesce(F.sum("seen"), F.lit(0)), *counts).first()
    if 0 < train_docs <= K + 1:
        of_words[train_docs - 1] += 1  # END is a token too
    tokens, distinct = train_words + train_docs, seen + (train_docs > 0)
    hot = [r.id for r in words.select(F.explode("hot").alias("id")).collect()]  # fewer than tokens / part_tokens
    if docs_many := blocks.agg(F.sum(F.size("docs"))).first()[0] or 0:
        hot += [START] * (docs_many >= part_tokens)
    hot = np.array(sorted(hot), np.int64)

    found = words.groupBy("block").agg(F.collect_list("found").alias("found"))  # at most the words of the block
    full = blocks.select("block", "docs", "held", "sizes", "codes").join(found, "block", "left")
    parts = max(1, math.ceil((n_tokens + docs_many) / part_tokens))
    pairs = stage(pair_table(full, parts, hot, train_docs), "katz-pairs")
    of_pairs = list(pairs.agg(*counts).first())
    model = Model(Unigrams.of(tokens, distinct, of_words), good_turing(of_pairs), {})

    def hot_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, _, names, _, _, given, low = model.sums(batch.slice(i, 1).to_pylist()[0])
                own = np.isin(names, hot)
                yield pa.RecordBatch.from_arrays([pa.array(x[own]) for x in (names, given, low)], ["id", "given", "low"])

    if len(hot):
        partial = pairs.select("pairs", "histories").mapInArrow(hot_sums, "id long, given double, low double")
        totals = partial.groupBy("id").agg(F.sum("given").alias("given"), F.sum("low").alias("low"))
        model.hot = {r.id: (r.given, r.low) for r in totals.collect()}

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                log_p = model.log_probabilities(row)
                for block, place in zip(row["blocks"], row["places"]):
                    data = zstandard.ZstdCompressor(level=1).compress(log_p[unpack(place)[0]].tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([row["part"]], pa.int32()), pa.array([data], pa.binary())],
                        ["block", "part", "scores"],
                    )

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tidy()
                row = batch.slice(i, 1).to_pylist()[0]
                p = block_pairs(row, train_docs)
                home = _home(p.h, p.w, hot, parts)
                order = np.argsort(home, kind="stable")
                starts = {int(home[own[0]]): own for own in np.split(order, np.flatnonzero(np.diff(home[order])) + 1)}
                log_p = np.zeros(len(p.h))
                for s in row["scores"]:
                    log_p[starts[s["part"]]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(s["scores"]), "<f8")
                base = np.log10((p.word_count + 0.5) / (tokens + 0.5 * (distinct + 1)))
                n = len(row["docs"])
                add = lambda x: np.bincount(p.doc_of_token, x[p.of_token], n)
                cols = (
                    pa.array(row["docs"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(np.array(row["sizes"], np.int64) + 1),
                    pa.array(add((p.word_count > 0).astype(float)).astype(np.int64)), pa.array(np.full(n, tokens, np.int64)),
                    pa.array(add(base)), pa.array(add(log_p)),
                )
                yield pa.RecordBatch.from_arrays(list(cols), [f.split()[0] for f in SCORES.split(", ")])

    scored = pairs.select("part", "blocks", "places", "pairs", "histories").mapInArrow(back, "block long, part int, scores binary")
    scored = scored.groupBy("block").agg(F.collect_list(F.struct("part", "scores")).alias("scores"))  # one per pair of the block at most
    return full.join(scored, "block").mapInArrow(per_document, SCORES)
