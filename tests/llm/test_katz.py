import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from common import ROWS, documents

from matchwright.llm import katz as Z

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute(rows):
    texts = []
    for doc, text in rows:
        held = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1
        texts.append((doc, held, [*WORD.findall((text or "").translate(LOWER)), "\n"]))
    one, two, before = Counter(), Counter(), Counter()
    for _, held, words in texts:
        if not held:
            one.update(words)
            two.update(zip([" ", *words], words))
            before.update([" ", *words[:-1]])
    n, v = sum(one.values()), len(one)
    counts = lambda c: [sum(x == r for x in c.values()) for r in range(1, Z.K + 2)]
    unigrams, factors = Z.Unigrams.of(n, v, counts(one)), Z.good_turing(counts(two))
    low = {w: float(unigrams(np.array([c]))[0]) for w, c in one.items()}
    unknown = float(unigrams(np.array([0]))[0])
    assert abs(sum(low.values()) + unknown - 1) < 1e-9
    after = defaultdict(dict)
    for (h, w), c in two.items():
        after[h][w] = float(Z.discounted(np.array([c]), factors)[0]) / before[h]
    weight = {}
    for h, given in after.items():
        if 1 - sum(given.values()) <= 1e-12:
            given.update({w: p * before[h] / (before[h] + 1) for w, p in given.items()})
        weight[h] = (1 - sum(given.values())) / (1 - sum(low[w] for w in given))
        mass = sum(given.get(w, weight[h] * p) for w, p in low.items()) + weight[h] * unknown
        assert abs(mass - 1) < 1e-9
    out = []
    for doc, held, words in texts:
        score = sum(math.log10(after.get(h, {}).get(w) or weight.get(h, 1.0) * low.get(w, unknown)) for h, w in zip([" ", *words], words))
        base = sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((doc, held, len(words), sum(w in one for w in words), n, base, score))
    return out


def same(got, rows):
    order = lambda r: (r[0] is not None, r[0] or 0, round(r[6], 6))
    got, want = sorted(map(tuple, got), key=order), sorted(brute(rows), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_against_brute_force(spark):
    rows = [*ROWS, *((100 + i, "a b a b a c d\x0be É é") for i in range(30))]
    same(Z.score(documents(spark, rows)).collect(), rows)


def test_many_blocks_and_hot_histories(spark):
    rows = [(i, " ".join(f"w{(i * j) % 11}" if j % 3 else "the" for j in range(60))) for i in range(120)]
    docs = documents(spark, rows).repartition(3)
    same(Z.score(docs, block_bytes=2000, part_words=7, part_tokens=500).collect(), rows)


def test_tiny_tables(spark):
    assert Z.score(documents(spark).limit(0)).count() == 0
    for rows in ([(3, None)], [(8, "a a")], [(None, "")]):
        same(Z.score(documents(spark, rows)).collect(), rows)


def test_discounts_of_zipf_counts():
    counts = [1000, 400, 220, 140, 95, 70]
    factors = Z.good_turing(counts)
    assert ((factors[1:] > 0) & (factors[1:] < 1)).all()
    freed = sum(c * n * (1 - factors[c]) for c, n in enumerate(counts[: Z.K], 1))
    assert abs(freed - counts[0]) < 1e-6  # Katz's choice frees the once-seen mass


def test_discounts_of_tables_with_copies():
    """Pairs of the given 10,000 documents: the raw factor of count 4 is 1.11, the fit keeps Good-Turing."""
    counts = [1480242, 227968, 47069, 19756, 17459, 7018]
    factors = Z.good_turing(counts)
    assert ((factors[1:] > 0) & (factors[1:] < 1)).all() and (np.diff(factors[1:]) > 0).all()
    slope = np.polyfit(np.log(range(1, 7)), np.log(counts), 1)[0]
    common = 6 ** (1 + slope)
    assert np.allclose(factors[1:], [(((c + 1) / c) ** (1 + slope) - common) / (1 - common) for c in range(1, 6)])
    assert Z.smoothed([0.0, 5, 5, 5, 5, 5, 5]) is None  # no fall: absolute discounting
    assert ((f := Z.good_turing([90, 20, 0, 0, 3, 0]))[1:] > 0).all() and (f[1:] < 1).all()


def test_arrays_as_bytes():
    for a in ([], [0, 255], [256, 3], [70000], [2**40, 5]):
        assert Z.unpack(Z.pack(np.array(a, np.int64)))[0].tolist() == a
