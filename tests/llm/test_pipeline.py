import struct
import zlib
from collections import Counter

import pytest
from common import documents, sentence
from test_pii import brute as rules
from test_rules import brute as measures
from test_simhash import brute_print, brute_roots

import corpus_pipeline as pipeline
from matchwright.llm import pii
from matchwright.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

CLEAN = [(i, f"start{i} " + " ".join(f"w{(i * 31 + j * j) % 509}x{i}" for j in range(90))) for i in range(12)]
DOCS = [
    *CLEAN,
    (50, CLEAN[3][1]),  # a copy
    (51, CLEAN[3][1]),
    (60, "too few words here"),
    (61, sentence(25, 2) + " " + sentence(25, 2) + " " + sentence(25, 2)),
    (62, "x### y$$$ " * 60),
    (63, None),
    (70, CLEAN[5][1].replace("w", "v") + " mail a.b@c.example or call +1 (415) 555-2671"),
]


def test_run_against_brute_force(spark, tmp_path):
    """Every stage by plain means: rules, fingerprint components, patterns, the tokenizer library."""
    documents(spark, DOCS).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    rows = pipeline.run(spark, str(tmp_path)).collect()

    kept = {}
    for doc, text in DOCS:
        _, n, chars, symbols, dup, rep, lines = measures(doc, text)
        bad = n < 50 or 100 * rep > 50 * n or 10 * symbols > n or 100 * dup > 60 * lines or chars < 2 * n or chars > 20 * n
        if not bad:
            kept[doc] = text
    prints = {doc: brute_print(text) for doc, text in kept.items()}
    root = brute_roots(prints.values())
    first = {}
    for doc in sorted(kept):
        first.setdefault(root[prints[doc]], doc)
    assert {50, 51, 60, 61, 62, 63}.isdisjoint(first.values()) and set(dict(CLEAN)) <= set(first.values())

    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc in first.values():
        spans = [(a, b, k) for k, found in rules(kept[doc]).items() for a, b in found]
        ids = plain.encode(pii.redacted(kept[doc], spans), add_special_tokens=False).ids + [1]
        want[doc, 0, 0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    assert max(r.offset + r.length for r in rows) <= 4096


def test_stages_keep_the_columns(spark, tmp_path):
    documents(spark, DOCS).write.parquet(str(tmp_path / "a"))
    docs = spark.read.parquet(str(tmp_path / "a"))
    for name, step in pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    for name, step in pipeline.STAGES:
        step(spark, docs.limit(0), str(tmp_path)).collect()
