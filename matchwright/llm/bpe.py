"""BPE encoding and decoding of whole texts through the distinct-word table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.wordtable import block_words, encoded, rows_of, unpack


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(tokenizer_json: str) -> list[str]:
    """The id-to-piece table: piece of every id, added tokens included ('' for unused ids)."""
    model = json.loads(tokenizer_json)
    table = {i: p for p, i in model["model"]["vocab"].items()} | {t["id"]: t["content"] for t in model["added_tokens"]}
    return [table.get(i, "") for i in range(max(table) + 1)]


def _decoded(words: list[bytes], table: pa.Array) -> list[bytes]:
    """Pieces of each word joined by blanks: ids joined with the piece table, put together by position."""
    ids = np.frombuffer(b"".join(words), "<u4")
    ends = np.cumsum([0] + [len(w) // 4 for w in words])
    joined = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(ids)))
    return [x.encode() for x in pc.binary_join(joined, " ").to_pylist()]


def digests(docs: DataFrame, tokenizer_json: str, keep_ids: bool = False, stored: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every whole text.

    Ids are those of encoding the text without special tokens; the decoded text is what the
    tokenizer makes of them without a decoder step: pieces joined by blanks. Null and empty
    texts have no tokens; every row gives one row, repeated ids and texts included; other
    columns are not read. `stored` is that of `wordtable.encoded`.
    """
    # as many pieces as the vocabulary has, whatever the data
    table = docs.sparkSession.sparkContext.broadcast(pieces(tokenizer_json))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = pa.array(table.value, pa.string())
        for batch in batches:
            for row in rows_of(batch):
                words = block_words(row["found"])
                texts = _decoded(words, lookup)
                silent = any(not w for w in words)
                codes, at, out = unpack(row["codes"]), 0, []
                for doc, size in zip(row["docs"], row["sizes"]):
                    own = codes[at : at + size].tolist()
                    at += size
                    if silent:  # a word without tokens gives no blank either
                        own = [c for c in own if words[c]]
                    ids = b"".join([words[c] for c in own])
                    text = b" ".join([texts[c] for c in own])
                    out.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), ids if keep_ids else None))
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cols[4]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return encoded(docs, tokenizer_json, stored=stored).select("docs", "sizes", "codes", "found").mapInArrow(run, schema)


def decode(ids: DataFrame, tokenizer_json: str) -> DataFrame:
    """doc_id, ids -> doc_id, text: ids joined with the piece table, pieces joined by blanks in order.

    Null ids arrays and empty ones give an empty text; an id outside the vocabulary has no piece.
    """
    spark = ids.sparkSession
    table = spark.createDataFrame(list(enumerate(pieces(tokenizer_json))), "id int, piece string")
    key = ids.select("doc_id", "ids", F.monotonically_increasing_id().alias("row"))
    places = key.select("row", F.posexplode("ids").alias("place", "id")).join(F.broadcast(table), "id")
    text = places.groupBy("row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda x: x.piece), " ").alias("text")
    )
    return key.join(text, "row", "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
