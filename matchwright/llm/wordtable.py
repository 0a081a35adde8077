"""Tokenizer ids of whole texts by way of a table of distinct words.

Texts are cut at ASCII white space, which no token of the tokenizers meant here crosses. Each
block of documents keeps its own word list and the numbers of its words in order; the word
lists of all blocks meet by word, each distinct word is encoded once, and the ids go back to
the blocks by word number.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchwright.llm.texts import slices, tidy
from matchwright.session import stage

BLOCKS = "docs array<long>, sizes array<int>, codes binary, words binary"
PARTS = "bucket int, block long, codes binary, words binary"
FOUND = "block long, codes binary, lengths binary, ids binary"
#: Trailing marks that a word ending in a letter or digit is encoded without; they never join the letters before them.
MARKS = ".,!?;:#$%&*|)"
#: Words that are encoded as they stand: special tokens, and combining marks, which upper and lower case letters may join differently.
AS_IS = "<\\||[\u0300-\u036f]"
PLAIN_END = "[a-z0-9ß-öø-ÿ]$"


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _binary(numbers: list[bytes]) -> pa.Array:
    return pa.array(numbers, pa.binary())


def blocks(docs: DataFrame, size: int = 6 << 20) -> DataFrame:
    """Documents in blocks of about `size` bytes of text: their ids, words per document, word numbers and word list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", size):
                text = pc.fill_null(part.column(1), "")
                lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text))
                words = lists.flatten().dictionary_encode()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([pc.list_value_length(lists).to_numpy(zero_copy_only=False)], pa.list_(pa.int32())),
                        _binary([pack(words.indices.to_numpy())]),
                        _binary([zstandard.ZstdCompressor(level=1).compress("\n".join(words.dictionary.to_pylist()).encode())]),
                    ],
                    ["docs", "sizes", "codes", "words"],
                )
                del text, lists, words
                tidy()

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut.mapInArrow(run, BLOCKS).withColumn("block", F.monotonically_increasing_id())


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number of each word, equal for equal words: its bytes as digits, mixed."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    sizes = np.diff(ends)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], sizes)
    powers = np.cumprod(np.full(sizes.max(initial=0) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * powers[place], dtype=np.uint64)])
    h = sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _route(parts: int):
    """Words of a block dealt to buckets by their lower-case body, so that all forms of a word meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = pa.array(zstandard.ZstdDecompressor().decompress(words.as_py()).decode().split("\n"), pa.string())
                body = pc.ascii_rtrim(pc.ascii_lower(words), characters=MARKS)
                bucket = (_hashes(body) % parts).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                ends = [0, *cuts.tolist(), len(order)]
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(order))), "\n")
                press = zstandard.ZstdCompressor(level=1)
                rows = []
                for a, b, text in zip(ends, ends[1:], joined):
                    rows.append((int(bucket[order[a]]), block, pack(order[a:b]), press.compress(text.as_buffer())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["bucket", "block", "codes", "words"],
                )
                del words, body, joined, rows
                tidy()

    return run


@lru_cache(maxsize=1)
def _tokenizer(text: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer: Tokenizer, words: list[str] | pa.Array) -> list[bytes]:
    """Ids of each word as little-endian 32-bit numbers; every distinct body and run of marks is encoded once."""
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.string())
    if not len(words):
        return []
    as_is = pc.match_substring_regex(words, AS_IS)
    lower = pc.ascii_lower(words)
    body = pc.ascii_rtrim(lower, characters=MARKS)
    marked = pc.and_not(pc.match_substring_regex(body, PLAIN_END), as_is)
    whole = pc.if_else(as_is, words, lower)
    size = pc.if_else(marked, pc.binary_length(body), pc.binary_length(whole)).to_numpy()
    # body and marks stand side by side in the bytes of the words: only the offsets are new
    starts = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole) + 1]
    cuts = np.append(np.column_stack([starts[:-1], starts[:-1] + size]).ravel(), starts[-1]).astype(np.int32)
    forms = pa.StringArray.from_buffers(2 * len(whole), pa.py_buffer(cuts), whole.buffers()[2]).dictionary_encode()
    ids: list[bytes] = []
    for f in range(0, len(forms.dictionary), 2048):
        part = forms.dictionary.slice(f, 2048).to_pylist()
        ids += [array("I", code.ids).tobytes() for code in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
    index = forms.indices.to_numpy()
    return [ids[b] + ids[m] for b, m in zip(index[0::2].tolist(), index[1::2].tolist())]


def encoded(
    docs: DataFrame, tokenizer_json: str, block_bytes: int = 6 << 20, bucket_bytes: int = 10 << 20, stored: bool = True
) -> DataFrame:
    """One row per block: block, docs, sizes, codes and `found`, the parts that give each word number its ids.

    The word lists of the blocks are dealt by word to as many buckets as the texts hold
    `bucket_bytes`. A word that every document has is one entry per block there, so no word
    is a hot key. `found` has at most the words of the block. The blocks are needed twice:
    they are stored, or, with stored=False, cut twice from the texts, which takes more time
    and less disk; `docs` must then be a stored table, read in the same order each time.
    """
    spark = docs.sparkSession
    rows = blocks(docs, block_bytes)
    if stored:
        rows = stage(rows, "word-blocks")
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / bucket_bytes))
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)  # the tokenizer file: its size does not depend on the data

    def encode(group: pa.Table) -> pa.Table:
        press, expand = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        lists = [expand.decompress(w).decode().split("\n") for w in group.column("words").to_pylist()]
        tidy()
        every = pa.array([w for words in lists for w in words], pa.string()).dictionary_encode()
        ids = encode_words(_tokenizer(vocabulary.value), every.dictionary.to_pylist())
        index, at, out = every.indices.to_numpy(), 0, ([], [])
        for words in lists:
            mine = [ids[i] for i in index[at : at + len(words)].tolist()]
            at += len(words)
            out[0].append(pack(np.fromiter(map(len, mine), np.int64, len(mine)) // 4))
            out[1].append(press.compress(b"".join(mine)))
        return pa.table([group.column("block"), group.column("codes"), _binary(out[0]), _binary(out[1])], ["block", "codes", "lengths", "ids"])

    words = rows.select("block", "words").mapInArrow(_route(parts), PARTS)
    found = words.groupBy("bucket").applyInArrow(encode, FOUND)
    found = found.groupBy("block").agg(F.collect_list(F.struct("codes", "lengths", "ids")).alias("found"))
    return rows.select("block", "docs", "sizes", "codes").join(found, "block", "left")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        tidy()
        yield batch.slice(i, 1).to_pylist()[0]


def block_words(found: list[dict] | None) -> list[bytes]:
    """Word number -> ids, as bytes, from the parts of a block."""
    parts = [(unpack(p["codes"]), unpack(p["lengths"]), zstandard.ZstdDecompressor().decompress(p["ids"])) for p in found or ()]
    words: list[bytes] = [b""] * (1 + max((int(c.max()) for c, _, _ in parts), default=-1))
    for codes, lengths, ids in parts:
        ends = np.cumsum(4 * lengths.astype(np.int64))
        for code, a, b in zip(codes.tolist(), (ends - 4 * lengths).tolist(), ends.tolist()):
            words[code] = ids[a:b]
    return words
