"""Least-cost repair of conversations by generalised LR parsing with edits.

The roles of a conversation have to follow a small grammar. Its LR(0) automaton is built here;
the parser keeps all ways to read the rows so far as one graph-structured stack, whose tops
share the nodes below them. A row may be kept (shifted as it is), given another role, deleted,
or new rows may be inserted before it, each at a price; equal tops merge into the one with the
least (cost, audit), where the audit is the string of the edits' initials.

Spark sorts the rows of each conversation into one task's stream. A row leaves as soon as all
tops agree on its fate, so a long conversation is never held as a whole (its audit is).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchwright.llm.texts import slices

#: Left side and right side of each rule; the first left side is the goal. Single letters are role initials.
GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("exchanges",)),
    ("conversation", ("s", "exchanges")),
    ("exchanges", ("exchange",)),
    ("exchanges", ("exchanges", "exchange")),
    ("exchange", ("u", "a")),
)
#: Roles that an edit may give, and the price of each edit; an undeleted truncated row adds its own.
GIVEN = ("user", "assistant")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\f\r"
END = "$"


# ---- the automaton ------------------------------------------------------------------------------


class Node:
    """A node of the stack graph: an LR state on top of another node."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


class Automaton:
    """LR(0) item sets of a grammar, and moves on nodes of the stack graph (each worked out once)."""

    def __init__(self, grammar=GRAMMAR):
        goal = grammar[0][0]
        self.rules = (("", (goal,)), *grammar)
        self.inner = {left for left, _ in grammar}
        self.follow = self._follow(goal)
        self.states, self.goto, self.nodes, self.known = [], {}, {}, {}
        start = self._closure({(0, 0)})
        self.states.append(start)
        for i, items in enumerate(self.states):  # grows while it is read
            after: dict[str, set] = {}
            for rule, dot in items:
                right = self.rules[rule][1]
                if dot < len(right):
                    after.setdefault(right[dot], set()).add((rule, dot + 1))
            for symbol, kernel in sorted(after.items()):
                target = self._closure(kernel)
                if target not in self.states:
                    self.states.append(target)
                self.goto[i, symbol] = self.states.index(target)
        self.start = self._node(0, None)

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            if dot < len(right) and right[dot] in self.inner:
                new = {(i, 0) for i, (left, _) in enumerate(self.rules) if left == right[dot]} - items
                items |= new
                todo += new
        return frozenset(items)

    def _follow(self, goal: str) -> dict[str, set[str]]:
        """Terminals that may come after each inner symbol."""
        empty, first = set(), {s: set() for s in self.inner}
        begins = lambda s: first[s] if s in self.inner else {s}
        follow = {s: set() for s in self.inner}
        follow[goal].add(END)
        size = -1
        while size != (size := len(empty) + sum(map(len, chain(first.values(), follow.values())))):
            for left, right in self.rules[1:]:
                if all(s in empty for s in right):
                    empty.add(left)
                for i, s in enumerate(right):
                    if all(x in empty for x in right[:i]):
                        first[left] |= begins(s)
                    if s in self.inner:
                        rest = right[i + 1 :]
                        for k, x in enumerate(rest):
                            follow[s] |= begins(x)
                            if x not in empty:
                                break
                        else:
                            follow[s] |= follow[left]
        return follow

    def _node(self, state: int, below: Node | None) -> Node:
        """The one node of this state on that node: equal stacks share it."""
        return self.nodes.setdefault((state, below), Node(state, below))

    def _reduced(self, node: Node, ahead: str) -> list[Node]:
        """The node and all that reductions before `ahead` make of it."""
        found, todo = [node], [node]
        while todo:
            top = todo.pop()
            for rule, dot in self.states[top.state]:
                left, right = self.rules[rule]
                if rule and dot == len(right) and ahead in self.follow[left]:
                    base = top
                    for _ in right:
                        base = base.below
                    if (target := self.goto.get((base.state, left))) is not None:
                        new = self._node(target, base)
                        if new not in found:
                            found.append(new)
                            todo.append(new)
        return found

    def moves(self, node: Node, initial: str) -> tuple[Node, ...]:
        """Tops after the terminal: all reductions before it, then the shift."""
        if (node, initial) not in self.known:
            ready = ((n, self.goto.get((n.state, initial))) for n in self._reduced(node, initial)) if initial not in self.inner else ()
            self.known[node, initial] = tuple(self._node(target, n) for n, target in ready if target is not None)
        return self.known[node, initial]

    def accepts(self, node: Node) -> bool:
        return any((0, 1) in self.states[n.state] and n.below is self.start for n in self._reduced(node, END))


# ---- one conversation ---------------------------------------------------------------------------

#: The edits of a top, newest first: (edits before, how many edits, initial, row number, role given).
Trail = tuple


def _since(a: Trail | None, b: Trail | None) -> tuple[list, list, Trail | None]:
    """The edits of two trails after the last one they share, oldest first, and that one."""
    xs, ys = [], []
    while a is not b:
        if b is None or a is not None and a[1] >= b[1]:
            xs.append(a)
            a = a[0]
        else:
            ys.append(b)
            b = b[0]
    return xs[::-1], ys[::-1], a


def _less(a: Trail | None, b: Trail | None) -> bool:
    """Whether the audit of `a` comes before that of `b`."""
    xs, ys, _ = _since(a, b)
    return [x[2] for x in xs] < [y[2] for y in ys]


class Parser:
    """The tops of the stack graph after the rows read so far, each with its least (cost, audit)."""

    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.tops: dict[Node, tuple[int, Trail | None]] = {}
        self._offer(self.tops, automaton.start, 0, None)
        self._insert(self.tops)

    @staticmethod
    def _offer(tops: dict, node: Node, cost: int, trail: Trail | None) -> bool:
        """Merge into an equal top: the lesser (cost, audit) stays.

        Trails of equal cost at the same row are never prefixes of one another, as inserts cost
        something, so the lesser one stays the lesser whatever follows.
        """
        held = tops.get(node)
        if held is not None and (held[0] < cost or held[0] == cost and not _less(trail, held[1])):
            return False
        tops[node] = cost, trail
        return True

    def _insert(self, tops: dict) -> None:
        """All that inserted rows make of the tops, cheapest ways only."""
        todo = list(tops)
        while todo:
            node = todo.pop()
            cost, trail = tops[node]
            for role in GIVEN:
                for new in self.a.moves(node, role[0]):
                    if self._offer(tops, new, cost + INSERT, (trail, trail[1] + 1 if trail else 1, "I", None, role)):
                        todo.append(new)

    def read(self, number: int, initial: str, bad: bool, truncated: bool) -> None:
        """Take in one row; a bad one can only be deleted."""
        tops: dict = {}
        for node, (cost, trail) in self.tops.items():
            size = trail[1] + 1 if trail else 1
            self._offer(tops, node, cost + DELETE, (trail, size, "D", number, None))
            if not bad:
                kept = cost + TRUNCATED * truncated
                for new in self.a.moves(node, initial):
                    self._offer(tops, new, kept, (trail, size, "K", number, None))
                for role in GIVEN:
                    for new in self.a.moves(node, role[0]):
                        self._offer(tops, new, kept + REROLE, (trail, size, "R", number, role))
        self._insert(tops)
        self.tops = tops

    def settled(self) -> list[Trail]:
        """The edits that all tops share, oldest first; the tops forget them."""
        trails = [t for _, t in self.tops.values()]
        common = trails[0]
        for t in trails[1:]:
            common = _since(common, t)[2]
        if common is None:
            return []
        done, _, _ = _since(common, None)
        for node, (cost, trail) in self.tops.items():
            link = None
            for edit in _since(trail, common)[0]:
                link = (link, link[1] + 1 if link else 1, *edit[2:])
            self.tops[node] = cost, link
        return done

    def end(self) -> tuple[int, list[Trail]]:
        """Cost and the edits not yet given of the best top that ends a conversation."""
        best: dict = {}
        for node, (cost, trail) in self.tops.items():
            if self.a.accepts(node):
                self._offer(best, self.a.start, cost, trail)
        cost, trail = best[self.a.start]
        return cost, _since(trail, None)[0]


# ---- streams of rows ----------------------------------------------------------------------------

COLUMNS = ("conv_id", "turn", "role", "text", "gone", "blank", "again", "truncated")
FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _events(rows: Iterable[tuple], settle_every: int) -> Iterator[tuple]:
    """("edit", conv_id, initial, turn, role, text) for every edit and ("end", conv_id, faults, cost) after each conversation.

    The rows come sorted by conversation and place.
    """
    automaton = Automaton()
    parser = conv = None
    held: dict[int, tuple] = {}

    def edits(trails: list[Trail]) -> Iterator[tuple]:
        for _, _, initial, number, given in trails:
            turn, role, text = held.pop(number) if number is not None else (None, None, "")
            yield "edit", conv, initial, turn, given or role, text

    def finish() -> Iterator[tuple]:
        cost, trails = parser.end()
        yield from edits(trails)
        turns = high - low + 1 - distinct if distinct else 0
        yield "end", conv, (turns, *counts), cost

    for new, turn, role, text, gone, blank, again, truncated in rows:
        if parser is None or new != conv:
            if parser:
                yield from finish()
            parser, conv, held, number = Parser(automaton), new, {}, 0
            counts, before = [0, 0, 0, 0], None  # blank, duplicate, truncated, illegal
            low = high = None
            distinct = 0
        if gone:
            continue
        if turn is not None and turn != high:
            low, high, distinct = turn if low is None else low, turn, distinct + 1
        fault = 0 if blank else 1 if again else 2 if truncated else None
        if fault is not None:
            counts[fault] += 1
        initial = role[:1]
        if before is not None and before + initial not in LEGAL:
            counts[3] += 1
        before = initial
        held[number] = turn, role, text
        parser.read(number, initial, fault in (0, 1), fault == 2)
        number += 1
        if number % settle_every == 0:
            yield from edits(parser.settled())
    if parser:
        yield from finish()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield from zip(*(c.to_pylist() for c in part.columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, text_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == size or weight > text_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _in_order(conversations: DataFrame) -> DataFrame:
    """Rows with their faults, a conversation whole and in order in one task's stream.

    A duplicate is found by (conversation, role, text), so no task holds all texts of a
    conversation for it.
    """
    last = F.rtrim(F.col("text"), F.lit(SPACES))
    same = W.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    faults = {
        "blank": F.coalesce(last == "", F.lit(False)),
        "again": F.row_number().over(same) > 1,
        "truncated": F.coalesce(~F.right(last, F.lit(1)).isin(".", "!", "?"), F.lit(False)),
    }
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    return conversations.withColumns(faults).repartition("conv_id").sortWithinPartitions(*order).select(*COLUMNS)


def prepared(conversations: DataFrame) -> DataFrame:
    """Conversation rows as `edits` and `reports` take them; null roles and texts become one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"),
        F.lit(False).alias("gone"), F.lit(0).alias("copy"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of `conv_id:turn` modulo 20, as `prepared`; a dropped row stays as one marked gone.

    0 drops the row, 1 empties its text, 2 takes its `.!?` away, 3 repeats it, 4 makes it the
    user's; a null id or turn counts as one space here.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = prepared(conversations).withColumn("draw", draw)
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gone = F.col("draw") == 0
    return rows.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").when(~gone, F.col("role")).alias("role"), F.when(~gone, text).alias("text"),
        gone.alias("gone"), F.explode(copies).alias("copy"),
    )


EDITS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
REPORTS = pa.schema([("conv_id", pa.int64()), *((f, pa.int64()) for f in FAULTS), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def edits(rows: DataFrame, settle_every: int = 256) -> DataFrame:
    """conv_id, place (of the edit, from 0), edit (K, R, D or I), turn, role and text of the cheapest repair.

    Takes what `prepared` or `damaged` give. The rows with another edit than D are the
    repaired conversation; an inserted row has no turn and an empty text. Rows of equal turn
    are taken by role and text; blank rows and those whose role and text came before are
    always deleted; an empty table gives none; a null conv_id is a conversation of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            place = 0
            for kind, conv, *rest in _events(_rows(batches), settle_every):
                if kind == "edit":
                    yield (conv, place, *rest)
                place = place + 1 if kind == "edit" else 0

        yield from _batches(out(), EDITS)

    return _in_order(rows).mapInArrow(run, _ddl(EDITS))


def reports(rows: DataFrame, settle_every: int = 256) -> DataFrame:
    """conv_id, faults (gaps, blank, duplicate, truncated, illegal), cost, audit and the hash of the repaired conversation.

    One row per conversation, also where no row is left (zeros, empty audit, hash of the empty
    string). The hash is over `role:text`, joined by newlines, and is taken as the edits come;
    what is held of a conversation is its audit and the rows not yet settled. The rules of
    `edits` hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            audit, digest, first = [], hashlib.sha256(), True
            for kind, conv, *rest in _events(_rows(batches), settle_every):
                if kind == "edit":
                    initial, _, role, text = rest
                    audit.append(initial)
                    if initial != "D":
                        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                        first = False
                else:
                    faults, cost = rest
                    yield (conv, *faults, cost, "".join(audit), digest.hexdigest())
                    audit, digest, first = [], hashlib.sha256(), True

        yield from _batches(out(), REPORTS)

    return _in_order(rows).mapInArrow(run, _ddl(REPORTS))
