import hashlib
import itertools
import random
import re

import numpy as np
from common import ROWS, documents

from matchwright.llm import pii as P


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute(t):
    find = lambda p: list(re.finditer(p, t))
    return {
        "email": [m.span() for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")],
        "ip": [m.span() for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in find(r"[0-9]([\x20-]?[0-9])+") if 13 <= len(digits(m[0])) <= 19 and P.luhn(digits(m[0]))],
        "phone": [m.span() for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(m[0])) <= 15],
    }


def test_rules_are_the_patterns():
    rnd = random.Random(1)
    for _ in range(20000):
        t = "".join(rnd.choice("0123456789..@@++-- ()ab5é") for _ in range(rnd.randint(0, 40)))
        assert P.base_spans(t) == brute(t), t


def weights():
    return P.train(P.labelled_examples() * 4, rounds=25)


def test_decoding_is_the_best_of_all_segmentations():
    w = weights()
    rnd = random.Random(2)
    parts = ["4111", "1111", "+1", "(415)", "555-2671", "a@b.example", "10.0.0.1", "and", "4111111111111111", "77"]
    for _ in range(25):
        text = " ".join(rnd.choice(parts) for _ in range(6))
        words = [m.span() for m in re.finditer(r"\S+", text)]
        where, x = P.segments(text, words, 4)
        scores = np.einsum("sfk,fk->sk", x, w)
        best = 0.0
        for n in range(1, 7):
            for pick in itertools.combinations(range(len(where)), n):
                if all(where[a][1] <= where[b][0] or where[b][1] <= where[a][0] for a, b in itertools.combinations(pick, 2)):
                    best = max(best, sum(scores[s].max() for s in pick))
        index = {s: i for i, s in enumerate(where)}
        got = sum(scores[index[i, j], kind] for i, j, kind in P.decode(text, words, w, 4))
        assert abs(got - best) < 1e-9


def test_gradient_is_that_of_the_likelihood():
    """The expected counts are the probabilities over all segmentations."""
    text, w = "card 4111 1111 1111 1111 or 10.0.0.1", weights() / 3
    words = [m.span() for m in re.finditer(r"\S+", text)]
    where, x = P.segments(text, words, 4)
    scores = np.einsum("sfk,fk->sk", x, w)
    total, mass = 0.0, np.zeros_like(scores)

    def go(at, value, picked):
        nonlocal total
        if at == len(words):
            total += np.exp(value)
            for s, k in picked:
                mass[s, k] += np.exp(value)
            return
        go(at + 1, value, picked)
        for s, (i, j) in enumerate(where):
            if i == at:
                for k in range(len(P.KINDS)):
                    go(j, value + scores[s, k], [*picked, (s, k)])

    go(0, 0.0, [])
    assert np.allclose(P._expected(len(words), where, scores), mass / total)


def test_held_out_accuracy():
    w = weights()
    found = lambda t: [k for d in P.all_spans(t, w) for k in d for _ in d[k]]
    for text in ("see ivy [at] farm [dot] example", "then (646) 555-0123 rang", "5555555555554444 4012888888881881 both"):
        assert found(text), text
    for text in ("in 1999 and 2001", "part 4485275742308328 only", "version 300.1.2.3", "hash 9f86d081884c7d659a2feaa0c55ad015", "chapter 12, page 345"):
        assert not found(text), text


def test_neighbouring_cards_both_found():
    base, added = P.all_spans("x 5555555555554444 4012888888881881 y", weights())
    assert base["card"] == [] and sorted(added["card"]) == [(2, 18), (19, 35)]


def test_awkward_rows(spark):
    w = weights()
    rows = {r.doc_id: r for r in P.find(documents(spark), w).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[3].base_sha256 == rows[4].base_sha256 == empty and rows[3].spans == ""
    r = rows[7]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    text = dict(ROWS)[7]
    named = ",".join(f"{k}:{a}:{b}" for k in P.KINDS for a, b in brute(text)[k])
    assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest() and set(named.split(",")) <= set(r.spans.split(","))
    assert P.find(documents(spark)).count() == len(ROWS)
    assert P.find(documents(spark).limit(0)).count() == 0


def test_redaction(spark):
    docs = documents(spark)
    out = P.redact(docs, weights())
    assert out.schema == docs.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[7].text == "mail [EMAIL] or [PHONE], card [CARD], host [IP] and 10.0.0.999" and rows[7].n_chars == len(rows[7].text)
    assert rows[3].text is None and rows[3].n_chars is None and rows[0].text == dict(ROWS)[0]


def test_a_long_run_of_numbers():
    text = " ".join(str(i * 7919 % 100000) for i in range(20000))
    assert len(P.islands(text)) == 1
    P.all_spans(text, weights())
