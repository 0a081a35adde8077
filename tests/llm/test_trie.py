import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from matchwright.llm import trie as T

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(table, rebuild=True):
    by = {}
    for conv, turn, role, text in table:
        if conv is not None:
            by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(rows, key=lambda x: x[:2])] for c, rows in by.items()}
    built = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + rows[h:]
    members = {}
    for c, rows in sorted(built.items()):
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(c)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((ids[0], len(node), parent, len(ids), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(n, seed, longest=7, words=4):
    rng = random.Random(seed)
    texts = ["", "a b", "one two  three", None, "É\tz", " \n"]
    rows = []
    for c in range(n):
        conv = c if rng.random() < 0.9 else 1000 + c * 7
        start = rng.choice([0, 0, 3])
        for t in range(rng.randrange(1, longest)):
            rows.append((conv, start + t, rng.choice(["user", "assistant", None, ""]), rng.choice(texts[:words])))
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_nodes_against_brute_force(spark, shards):
    rows = table(150, shards)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "h": F.lit(1), "base": F.lit(2), "turns": F.lit(3)})
    assert got(T.nodes(T.rebuilt(T.turns(df)), least_shards=shards)) == brute(rows)


def test_copies_spread_over_shards(spark):
    """One conversation holds more than half of all rows; its node's ids come from many shards, in order."""
    rows = [(c, t, "user", f"same {t}") for c in range(200) for t in range(3)] + table(60, 5)
    rows = [(c + 1000 * (i >= 600), *rest) for i, (c, *rest) in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.nodes(T.turns(df), least_shards=16)) == brute(rows, rebuild=False)


@pytest.mark.parametrize("shards", [1, 9])
def test_sequences_longer_than_a_matrix(spark, monkeypatch, shards):
    rng = random.Random(4)
    rows = []
    for c in range(40):
        cut, length = rng.choice([5, 31, 32, 33, 64, 70, 100]), rng.choice([3, 32, 33, 64, 65, 96, 130])
        rows += [(c, t, "user", "x" if t < cut else f"{rng.randrange(2)}") for t in range(length)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.nodes(T.turns(df), least_shards=shards)) == brute(rows, rebuild=False)


def test_ties_nulls_and_turnless(spark):
    rows = [(40, 0, "u", "a b"), (40, 1, "a", "c"), (41, 5, "u", "x"), (41, None, "u", "n"), (None, 0, "u", "a"), (57, 0, None, None), (7, 0, "u", "a b"), (-25, 2, "u", "a"), (-20, 1, "u", "q r")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(T.nodes(T.rebuilt(T.turns(df)))) == brute(rows)
    # role and text are kept apart, equal turns are taken in one order whatever the order of the rows
    pair = [(1, 0, "ab", "c"), (2, 0, "a", "bc")]
    assert len(got(T.nodes(T.turns(spark.createDataFrame(pair, SCHEMA))))) == 3
    tied = [(1, 0, "u", "x"), (1, 0, "u", "y"), (2, 0, "u", "y"), (2, 0, "u", "x")]
    assert len(got(T.nodes(T.turns(spark.createDataFrame(tied, SCHEMA))))) == 3
    assert T.nodes(T.rebuilt(T.turns(df.limit(0)))).count() == 0


def test_only_turnless(spark):
    """Own turns that are all replaced by those of an absent conversation leave none."""
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(conv, t, "u", "x") for t in range(3)]
    assert got(T.nodes(T.rebuilt(T.turns(spark.createDataFrame(rows, SCHEMA))))) == brute(rows)
    assert brute(rows)[0][:6] == (conv, 0, None, 1, 0, 1)
