import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from common import ROWS, documents, key

from matchwright.llm import bpe, packing, wordtable
from matchwright.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def model():
    return bpe.read_tokenizer(tokenizer_path())


@pytest.fixture(scope="module")
def plain(model):
    return tokenizers.Tokenizer.from_str(model)


def test_digests(spark, model, plain):
    def brute(doc, text):
        ids = plain.encode(text or "", add_special_tokens=False).ids
        out = plain.decode(ids, skip_special_tokens=False)
        return doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(out.encode()).hexdigest()

    want = sorted((brute(*r) for r in ROWS), key=key)
    for stored in (True, False):
        got = bpe.digests(documents(spark), model, stored=stored)
        assert sorted(map(tuple, got.collect()), key=key) == want
    assert bpe.digests(documents(spark).limit(0), model).count() == 0


def test_decode_joins_pieces(spark, model, plain):
    encoded = bpe.digests(documents(spark).where("doc_id < 8"), model, keep_ids=True)
    got = {r.doc_id: r.text for r in bpe.decode(encoded, model).collect()}
    assert got == {d: plain.decode(plain.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for d, t in ROWS if d is not None and d < 8}


def test_words_encode_as_the_library_does(plain):
    words = "The the, THE. don't DOGS' x), H̱ å Å <|endoftext|> <|ENDOFTEXT|>. 12.5% «q». Straße! ΣΑΣ ... a|b é| ́x".split(" ")
    got = [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in wordtable.encode_words(plain, words)]
    assert got == [plain.encode(w, add_special_tokens=False).ids for w in words]


def test_pack_and_blocks(spark, model, plain):
    want = []
    for doc, text in ROWS:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            want.append((doc, p, s, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    rows = packing.pack(documents(spark).repartition(3), model).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.pack(documents(spark).limit(0), model).count() == 0


def _least(items, capacity):
    """The fewest sequences, by trying all."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for b in {r: b for b, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, [r - items[i] * (x == b) for x, r in enumerate(rooms)])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_best_and_best_fit_is_best_fit():
    import random

    rnd = random.Random(3)
    for _ in range(400):
        capacity = rnd.choice([10, 20, 30])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9))]
        counts = Counter(items)
        fixed, left = packing.reduce_dominated(counts, capacity)
        assert sum(n for _, n in fixed) + _least(list(left.elements()), capacity) == _least(items, capacity)
        rooms = []
        for w in sorted(items, reverse=True):
            fits = [i for i, r in enumerate(rooms) if r >= w]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= w
            else:
                rooms.append(capacity - w)
        assert sum(n for _, n in packing.best_fit(counts, capacity)) == len(rooms)
        used = Counter()
        for pattern, n in packing.plan(counts, capacity):
            assert sum(w * m for w, m in pattern) <= capacity
            for w, m in pattern:
                used[w] += m * n
        assert used == counts


def test_words_are_dealt_and_cut_in_columns():
    """Forms of a word share a bucket number; cutting body and marks in columns gives what one word after the other gave."""
    words = ["The", "THE,", "the.", "", "École!!", "A<|b.", "é.", "...", "日本。", "9.5,", "x\u0000y|"]
    body = pc.ascii_rtrim(pc.ascii_lower(pa.array(words, pa.string())), characters=wordtable.MARKS)
    one_by_one = [int(wordtable._hashes(pa.array([w], pa.string()))[0]) for w in body.to_pylist()]
    assert wordtable._hashes(body).tolist() == one_by_one and len(set(one_by_one[:3])) == 1
    assert wordtable._hashes(body.slice(2, 5)).tolist() == one_by_one[2:7]
    many = wordtable._hashes(pa.array([f"word{i}" for i in range(10_000)], pa.string()))
    assert len(set(many.tolist())) == 10_000 and max(np.bincount((many % 7).astype(int))) < 1600

    class Letters:
        """A tokenizer whose ids are code points."""

        def encode_batch_fast(self, part, add_special_tokens):
            return [type("Code", (), {"ids": [ord(c) for c in w]}) for w in part]

    plain = [w if "<|" in w or "́" in w else "".join(c.lower() if c < "\x7f" else c for c in w) for w in words]
    got = wordtable.encode_words(Letters(), pa.array(["cut", *words], pa.string()).slice(1))
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [[ord(c) for c in w] for w in plain]
    assert wordtable.encode_words(Letters(), []) == []
