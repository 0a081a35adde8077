import numpy as np
import xxhash

from common import ROWS, documents
from matchwright.llm import components as C
from matchwright.llm import simhash as S

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute_print(text):
    words = [w for w in _split((text or "").translate(LOWER))]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _split(text):
    import re

    return re.findall("[^\x20\x09-\x0d]+", text)


def brute_roots(values, radius=2):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints_of_awkward_rows(spark):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.fingerprint) for r in S.near_duplicates(documents(spark)).collect())
    want = sorted((d is not None, d or 0, f"{brute_print(t):016x}") for d, t in ROWS if d != 11)
    assert [g for g in got if g[1] != 11] == want


def test_long_text_in_runs(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(3000))
    whole = S.fingerprint(text)
    runs = S.word_runs
    monkeypatch.setattr(S, "word_runs", lambda data: runs(data, 100))
    assert S.fingerprint(text) == whole == brute_print(text)


def test_links_and_components_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 40)
    values = set()
    for s in seeds.tolist():
        v = s
        for _ in range(30):  # chains of near values, many within radius of several others
            v ^= 1 << int(rng.integers(0, 64))
            values.add(v - 2**64 if v >= 2**63 else v)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    for tile in (16384, 3):  # small tiles: cells are cut, every pair of cuts must meet
        got = {v: v for v in values}
        got.update({r.node: r.root for r in C.components(S.links(fps, 2, tile)).collect()})
        assert got == brute_roots(values)


def test_components_empty_and_nulls(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
    rows = [(1, 2), (2, 1), (2, 3), (5, None), (7, 7), (9, 8)]
    got = {(r.node, r.root) for r in C.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}


def test_component_ids(spark):
    out = S.near_duplicates(documents(spark)).collect()
    by_id = {r.doc_id: r.component_id for r in out if r.doc_id is not None}
    assert by_id[0] == by_id[1] == 0 and by_id[3] == by_id[4] == by_id[5] == 3
    assert all(r.component_id is None for r in out if r.doc_id is None)
    assert len(out) == len(ROWS)
    assert S.near_duplicates(documents(spark).limit(0)).count() == 0


def test_keep_one_row_of_each_group(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    assert ids == sorted((d is not None, d or 0) for d in (0, 2, 3, 6, 7, None, 8, 9, 10, 11, 12))
