import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from matchwright.llm import repair as R

FORM = re.compile("(s?(ua)+)?")
WORD = re.compile("[^\x20\x09-\x0d]")


def exhaustive(rows):
    """rows of (initial, bad, truncated): every edit sequence with at most two inserts in a gap."""
    best = (10**9, "")
    gaps = ["", "u", "a", "ua", "au"]
    for inserted in product(gaps, repeat=len(rows) + 1):
        for ops in product("DKua", repeat=len(rows)):
            if any(bad and op != "D" for (_, bad, _), op in zip(rows, ops)):
                continue
            roles, cost, audit = inserted[0], 2 * len(inserted[0]), "I" * len(inserted[0])
            for (initial, _, cut), op, more in zip(rows, ops, inserted[1:]):
                cost += 3 if op == "D" else cut + (0 if op == "K" else 2)
                roles += ("" if op == "D" else initial if op == "K" else op) + more
                if op == "K" and initial == "":
                    roles += "?"  # a row without initial fits no rule
                audit += ("R" if op in "ua" else op) + "I" * len(more)
                cost += 2 * len(more)
            if (cost, audit) < best and FORM.fullmatch(roles):
                best = cost, audit
    return best


STATES = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def by_states(rows):
    """The same by dynamic programming over the states of the role rule, audits as whole strings."""

    def opened(best):
        for _ in range(4):
            for q, (c, w, out) in list(best.items()):
                for role in ("user", "assistant"):
                    t = STATES.get((q, role[0]))
                    if t:
                        best[t] = min(best.get(t, (10**9, "", [])), (c + 2, w + "I", [*out, (role, "")]), key=lambda x: x[:2])
        return best

    best = opened({"0": (0, "", [])})
    for role, text, bad, cut in rows:
        new = {}

        def offer(t, x):
            new[t] = min(new.get(t, (10**9, "", [])), x, key=lambda x: x[:2])

        for q, (c, w, out) in best.items():
            offer(q, (c + 3, w + "D", out))
            if not bad:
                if t := STATES.get((q, role[:1])):
                    offer(t, (c + cut, w + "K", [*out, (role, text)]))
                for given in ("user", "assistant"):
                    if t := STATES.get((q, given[0])):
                        offer(t, (c + cut + 2, w + "R", [*out, (given, text)]))
        best = opened(new)
    return min((best[q] for q in "0A" if q in best), key=lambda x: x[:2])


def brute(table):
    """The contract by plain means: {conv_id: row}."""
    space = lambda v: " " if v is None else v
    by = {}
    for conv, turn, role, text in table:
        out = by.setdefault(conv, [])
        draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        if draw:
            out += [(turn is not None, turn or 0, role, text)] * (2 if draw == 3 else 1)
    result = {}
    for conv, rows in by.items():
        rows.sort()
        turns = [t for has, t, _, _ in rows if has]
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, _, role, text in rows:
            words = WORD.findall(text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marked.append((role, text, fault in (0, 1), fault == 2))
        initials = [m[0][:1] for m in marked]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        cost, audit, out = by_states(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in out)
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def test_parser_against_all_edit_sequences():
    automaton = R.Automaton()
    rng = random.Random(3)
    cases = [()] + [((c, False, False),) for c in "suax"] + [((a, False, False), (b, False, True)) for a in "sua" for b in "suax"]
    cases += [tuple((rng.choice(["s", "u", "a", "x", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(3)) for _ in range(12)]
    for rows in cases:
        parser = R.Parser(automaton)
        for i, (initial, bad, cut) in enumerate(rows):
            parser.read(i, initial, bad, cut and not bad)
        cost, trail = parser.end()
        assert (cost, "".join(t[2] for t in trail)) == exhaustive([(a, b, c and not b) for a, b, c in rows]), rows


def test_equal_stacks_share_nodes():
    automaton = R.Automaton()
    parser = R.Parser(automaton)
    for i in range(5000):
        parser.read(i, random.Random(i).choice("suax"), False, False)
    assert len(parser.tops) <= 10 and len(automaton.nodes) < 40


def table(n=120, seed=1):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "superuser"]
    texts = ["Fine.", "ok", "  \t", "", None, "Why?\n", "Go on! ", "é…", "No way."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(0, 12)):
            role = ("system" if turn == 0 and rng.random() < 0.3 else ["user", "assistant"][turn % 2]) if rng.random() < 0.8 else rng.choice(roles)
            rows.append((conv, turn if rng.random() < 0.95 else None, role, rng.choice(texts) if rng.random() < 0.3 else f"Text {conv} {turn}."))
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (500, 3, "user", "A."), (500, 3, "user", "A."), (500, 3, "assistant", "B"), (501, None, "user", "x")]
    return rows


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("settle_every", [256, 2])
def test_reports_against_brute_force(spark, settle_every):
    rows = table()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"copy": F.lit("x"), "gone": F.lit(1), "cost": F.lit(2), "draw": F.lit(3)}).repartition(5)
    assert got(R.reports(R.damaged(df), settle_every)) == brute(rows)


def test_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "tool"]), f"Line {rng.randrange(400)}{rng.choice('.,')}") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(R.reports(R.damaged(df))) == brute(rows)


def test_edits_are_the_audit_and_the_repair(spark):
    rows = table(40, 2)
    df = R.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = {}
    for r in sorted(R.edits(df).collect(), key=lambda r: r.place):
        by.setdefault(r.conv_id, []).append(r)
    want = brute(rows)
    for conv, row in want.items():
        mine = by.get(conv, [])
        assert "".join(r.edit for r in mine) == row[6]
        kept = [f"{r.role}:{r.text}" for r in mine if r.edit != "D"]
        assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == row[7]
        assert FORM.fullmatch("".join(r.role[0] for r in mine if r.edit != "D"))


def test_undamaged_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "A."), (1, 1, "assistant", "B.")], "conv_id long, turn long, role string, text string")
    assert got(R.reports(R.prepared(df))) == {1: (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:A.\nassistant:B.").hexdigest())}
    assert R.reports(R.damaged(df.limit(0))).count() == 0 and R.edits(R.damaged(df.limit(0))).count() == 0
