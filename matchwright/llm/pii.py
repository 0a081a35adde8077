"""Personal data in whole texts: fixed rules, and a semi-Markov conditional random field that adds spans.

The field scores whole segments of words (what the span looks like as one string), so a
phone number of three words is one candidate with one score. Segments have a bounded number
of words; words outside any segment score zero. Hence a text falls into islands of words
around digits and at-signs: outside them no segment can score, and solving each island by
itself is solving the whole text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.texts import slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

DIGITS = re.compile("[0-9]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


# ---- fixed rules -----------------------------------------------------------------------------


def _emails(text: str) -> list[Span]:
    """Matches of the email pattern: the part before an at-sign can only be the run that ends there."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        low = domain.end() if domain else at + 1
        if domain:
            out.append((start, low))
        at = text.find("@", low)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _ips(text: str, runs: list[Span]) -> list[Span]:
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            if all(_small(text[a:b]) for a, b in four):
                out.append((four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    return out


def _cards(text: str, runs: list[Span]) -> list[Span]:
    out, i = [], 0
    while i < len(runs):
        j, n = i, runs[i][1] - runs[i][0]
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
            n += runs[j][1] - runs[j][0]
        if 13 <= n <= 19 and luhn("".join(text[a:b] for a, b in runs[i : j + 1])):
            out.append((runs[i][0], runs[j][1]))
        i = j + 1
    return out


def _phones(text: str) -> list[Span]:
    out, at = [], text.find("+")
    while at >= 0:
        m = PHONE.match(text, at)
        if m and 9 <= sum(map(str.isdecimal, m[0])) <= 15:
            out.append(m.span())
        at = text.find("+", m.end() if m else at + 1)
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """The fixed rules: leftmost matches per kind, checked, without retries. Linear in the text."""
    runs = [m.span() for m in DIGITS.finditer(text)]
    return {"email": _emails(text), "ip": _ips(text, runs), "card": _cards(text, runs), "phone": _phones(text)}


# ---- the field -------------------------------------------------------------------------------

SEED = re.compile(r"[0-9]+|@|[\[({]\s?at\s?[\])}]", re.IGNORECASE)
WORD = re.compile(r"\S+")
LEAD, TRAIL = "\"'<[{,;:!?|#*$%&", "\"'>]},;:!?.|#*$%&)"
NEAR = 2  # words of context on each side of a seed
CUES = {
    "email": frozenset("mail email e-mail contact write".split()),
    "ip": frozenset("ip address host server from".split()),
    "card": frozenset("card visa mastercard credit payment".split()),
    "phone": frozenset("phone tel call mobile fax telephone".split()),
}
MAIL_AT = re.compile(r"\s?(?:[\[({]\s?at\s?[\])}]|@)\s?", re.IGNORECASE)
MAIL_DOT = re.compile(r"\s?(?:[\[({]\s?dot\s?[\])}]|\.)\s?", re.IGNORECASE)
MAIL = re.compile(r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\Z")


def islands(text: str) -> list[list[Span]]:
    """Runs of words around every seed, each word as its place without surrounding marks."""
    out: list[list[Span]] = []
    done = 0
    for seed in SEED.finditer(text):
        if seed.start() < done:
            continue
        # NEAR words back from the seed's word, on from the last island
        low = seed.start()
        for _ in range(NEAR + 1):
            while low > done and text[low - 1].isspace():
                low -= 1
            while low > done and not text[low - 1].isspace():
                low -= 1
        words, quiet = [], 0
        for m in WORD.finditer(text, low):
            word = m[0]
            a = m.start() + len(word) - len(word.lstrip(LEAD))
            b = m.start() + len(word.rstrip(TRAIL))
            words.append((a, b) if a < b else m.span())
            seen = m.end() > seed.start()
            quiet = 0 if not seen or SEED.search(word) else quiet + 1
            if quiet > 2 * NEAR:
                break
        done = words[-1][1] if words else seed.end()
        out.append(words)
    return out


FEATURES = (
    "bias", "one word", "more words", "has at", "whole email", "email with spelt marks", "letters", "four small parts",
    "four parts", "luhn and 13-19 digits", "13-19 digits", "only digits and card gaps", "starts with plus", "9-15 digits",
    "only phone marks", "area code in brackets", "grouped 3-4", "under 7 digits", "over 19 digits", "cue before",
)
INDEX = {name: i for i, name in enumerate(FEATURES)}


def span_features(span: str, before: str) -> np.ndarray | None:
    """What a segment looks like as a whole, a column per kind; None if it cannot be an entity."""
    digits = re.sub("[^0-9]", "", span)
    mail = MAIL_AT.search(span)
    if not digits and not mail or span != span.strip() or len(span) > 120:
        return None
    spelt = MAIL_DOT.sub(".", MAIL_AT.sub("@", span)).lower() if mail else ""
    parts = span.split(".")
    four = len(parts) == 4 and all(p.isdecimal() and p.isascii() for p in parts)
    n, letters = len(digits), any(c.isalpha() for c in span)
    on = {
        "bias": True,
        "one word": " " not in span,
        "more words": " " in span,
        "has at": "@" in span,
        "whole email": bool(MAIL.match(span.lower())),
        "email with spelt marks": spelt != span.lower() and bool(MAIL.match(spelt)),
        "letters": letters,
        "four small parts": four and all(map(_small, parts)),
        "four parts": four,
        "luhn and 13-19 digits": 13 <= n <= 19 and luhn(digits),
        "13-19 digits": 13 <= n <= 19,
        "only digits and card gaps": not letters and re.fullmatch("[0-9](?:[ -]?[0-9])*", span) is not None,
        "starts with plus": span[0] == "+",
        "9-15 digits": 9 <= n <= 15,
        "only phone marks": re.fullmatch(r"[+(]?[0-9][ ().0-9-]*[0-9]", span) is not None,
        "area code in brackets": re.search(r"\([0-9]{2,4}\)", span) is not None,
        "grouped 3-4": re.search(r"(?:^|[^0-9])[0-9]{3}[ .-][0-9]{4}\Z", span) is not None,
        "under 7 digits": n < 7,
        "over 19 digits": n > 19,
    }
    out = np.zeros((len(FEATURES), len(KINDS)))
    for name, value in on.items():
        out[INDEX[name]] = value
    for k, kind in enumerate(KINDS):
        out[INDEX["cue before"], k] = before.lower().strip(".:,") in CUES[kind]
    return out


def segments(text: str, words: list[Span], longest: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Candidate segments (first word, past the last word) of an island and their features."""
    where, rows = [], []
    for i in range(len(words)):
        before = text[slice(*words[i - 1])] if i else ""
        for j in range(i + 1, min(len(words), i + longest) + 1):
            f = span_features(text[words[i][0] : words[j - 1][1]], before)
            if f is not None:
                where.append((i, j))
                rows.append(f)
    return where, np.array(rows).reshape(-1, len(FEATURES), len(KINDS))


def decode(text: str, words: list[Span], weights: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """The best-scoring set of disjoint typed segments of an island: (first word, past last, kind).

    best[j] is the score of the first j words; a segment that ends there has at most `longest`
    words, so each word looks back a bounded way and an island of any length takes linear time.
    """
    n = len(words)
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i in range(max(0, j - longest), j):
            f = span_features(text[words[i][0] : words[j - 1][1]], text[slice(*words[i - 1])] if i else "")
            if f is None:
                continue
            score = np.einsum("fk,fk->k", f, weights)
            kind = int(score.argmax())
            if best[i] + score[kind] > best[j]:
                best[j], back[j] = best[i] + score[kind], (i, j, kind)
    out, j = [], n
    while j > 0:
        if back[j]:
            out.append(back[j])
            j = back[j][0]
        else:
            j -= 1
    return out[::-1]


def _expected(n: int, where: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of each (segment, kind) under the field, by forward and backward sums."""
    total = np.logaddexp.reduce(scores, axis=1) if len(where) else np.zeros(0)
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    for j in range(1, n + 1):
        ends = [forward[j - 1]] + [forward[i] + total[s] for s, (i, e) in enumerate(where) if e == j]
        forward[j] = np.logaddexp.reduce(ends)
    for i in range(n - 1, -1, -1):
        starts = [backward[i + 1]] + [backward[j] + total[s] for s, (b, j) in enumerate(where) if b == i]
        backward[i] = np.logaddexp.reduce(starts)
    if not len(where):
        return scores
    edge = np.array([forward[i] + backward[j] for i, j in where]) - forward[n]
    return np.exp(np.minimum(0.0, edge[:, None] + scores))


def train(examples: list[tuple[str, list[tuple[int, int, str]]]], longest: int = 6, rounds: int = 40, rate: float = 0.5, decay: float = 0.002) -> np.ndarray:
    """Weights (feature x kind) by gradient ascent on the conditional likelihood of the labelled texts."""
    sets = []
    for text, labels in examples:
        gold = {(a, b): KINDS.index(kind) for a, b, kind in labels}
        for words in islands(text):
            where, x = segments(text, words, longest)
            if where:
                y = np.zeros((len(where), len(KINDS)))
                for s, (i, j) in enumerate(where):
                    kind = gold.get((words[i][0], words[j - 1][1]))
                    if kind is not None:
                        y[s, kind] = 1.0
                sets.append((len(words), where, x, y))
    weights, seen = np.zeros((len(FEATURES), len(KINDS))), np.full((len(FEATURES), len(KINDS)), 1e-8)
    for _ in range(rounds):
        for n, where, x, y in sets:
            p = _expected(n, where, np.einsum("sfk,fk->sk", x, weights))
            step = np.einsum("sfk,sk->fk", x, y - p) - decay * weights
            seen += step * step
            weights += rate * step / np.sqrt(seen)
    return weights


#: The labelled table: (text, kind of the part between the bars, or "" where that part is no personal data).
LABELLED = (
    ("write to |ann.lee@mail.example.com| today", "email"),
    ("mail |bob [at] example [dot] org| please", "email"),
    ("or |carol(at)example.net| instead", "email"),
    ("Contact: |d_ray+news@sub.example.co.uk|", "email"),
    ("the host |192.168.10.44| went down", "ip"),
    ("from |10.0.0.1| to the gate", "ip"),
    ("paid by card |4111 1111 1111 1111| in May", "card"),
    ("card |5500-0000-0000-0004| was used", "card"),
    ("number |340000000000009| on file", "card"),
    ("|4785380592391139| again", "card"),
    ("call |+1 (415) 555-2671| now", "phone"),
    ("ring |(415) 555-2671| after five", "phone"),
    ("tel |+44 20 7946 0958| or come", "phone"),
    ("phone |415-555-2671| if late", "phone"),
    ("order |4111 1111 1111 1112| was sent", ""),
    ("serial |4785380592391138| is on the lid", ""),
    ("release |10.300.2.1| is out", ""),
    ("build |1.2.3| is out", ""),
    ("in |1998| and |2004| again", ""),
    ("token = \"|24be64439e3e49cf46b2d7c90f3602a3d0b907ff|\" here", ""),
    ("it cost |12,500| in all", ""),
    ("follow |@someone| there", ""),
    ("section |4.1.2| and page |27|", ""),
    ("between |1200-1350| and |14:30|", ""),
    ("numbers |12345678901234567890123| and |555| too", ""),
    ("the |3| of |7| who came in |2011|", ""),
    ("id |987654321098| in the list", ""),
    ("about |555-1234| of them", ""),
    ("ask |eve [at] shop [dot] example| about it", "email"),
    ("and |f.moss {at} sub.site.example| as well", "email"),
    ("then |greg (at) river (dot) example| knows", "email"),
    ("so |hal@site.example| it is", "email"),
    ("there |5105105105105100| stood", "card"),
    ("twice |4012888888881881| |378282246310005| in a row", "card"),
    ("old |6011 1111 1111 1117| one", "card"),
    ("at |203.0.113.9| since noon", "ip"),
    ("was |+1 (212) 555-0187| or not", "phone"),
    ("there |(212) 555-0187| stood", "phone"),
    ("it is |212-555-0187| so far", "phone"),
    ("both |+1 (826) 555-4081| and |+49 30 5550 1234| work", "phone"),
    ("meet [at] the gate on day |12| of May", ""),
    ("he looked (at) page |345| again", ""),
    ("part |4012888888881882| only", ""),
    ("nine |6011 1111 1111 1118| there", ""),
    ("all |1234 5678| pieces and |2010-2015| too", ""),
    ("sum |1,234,567.89| and |0.5| more", ""),
    ("at |203.0.113.900| or |300.1.2.3| here", ""),
)


def labelled_examples(rows=LABELLED) -> list[tuple[str, list[tuple[int, int, str]]]]:
    out = []
    for text, kind in rows:
        plain, labels = "", []
        for i, part in enumerate(text.split("|")):
            if i % 2 and kind:
                labels.append((len(plain), len(plain) + len(part), kind))
            plain += part
        out.append((plain, labels))
    return out


def sample_examples(docs: DataFrame, rows: int = 200, longest: int = 400) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """At most `rows` islands of at most `longest` characters, the first by hash, labelled by the fixed rules.

    This is the bounded sample the weights are fitted on besides the labelled table; nothing
    else is estimated from it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                for words in islands(text):
                    part = text[words[0][0] : words[-1][1]]
                    if len(part) <= longest:
                        out.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["part"])

    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    parts = texts.mapInArrow(run, "part string").orderBy(F.xxhash64("part"), "part").limit(rows)
    found = ((r.part, base_spans(r.part)) for r in parts.collect())
    return [(part, [(a, b, kind) for kind, spans in base.items() for a, b in spans]) for part, base in found]


def fit(docs: DataFrame, rows: int = 200) -> np.ndarray:
    return train(labelled_examples() * 4 + sample_examples(docs, rows))


def all_spans(text: str, weights: np.ndarray, longest: int = 6) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and the field's spans that touch none of them."""
    base = base_spans(text)
    taken = [(spans, [a for a, _ in spans]) for spans in base.values()]
    added: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    for words in islands(text):
        for i, j, kind in decode(text, words, weights, longest):
            a, b = words[i][0], words[j - 1][1]
            # spans of one kind are disjoint and in order: the last that starts before `b` reaches furthest
            before = ((spans, bisect_left(starts, b) - 1) for spans, starts in taken)
            if not any(at >= 0 and spans[at][1] > a for spans, at in before):
                added[KINDS[kind]].append((a, b))
    return base, added


def _named(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every stretch of touching spans replaced by the first one's kind in brackets."""
    out, at, merged = [], 0, []
    for a, b, kind in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, weights: np.ndarray | None = None, count: str = "n_chars") -> DataFrame:
    """`docs` with every found span replaced by its kind, and the column `count`, if there is one, set to the new length.

    All other columns pass through, whatever their names; a null text stays null.
    """
    weights = fit(docs) if weights is None else weights
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = []
                for text in part.column(at).to_pylist():
                    if text:
                        found = all_spans(text, weights)
                        text = redacted(text, [(a, b, k) for spans in found for k in KINDS for a, b in spans[k]])
                    texts.append(text)
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                if count in part.schema.names:
                    i = part.schema.get_field_index(count)
                    columns[i] = pa.array([None if t is None else len(t) for t in texts]).cast(part.schema.field(i).type)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    The counts and base_sha256 are of the fixed rules; `spans` also has the field's. Null and
    empty texts have none. Repeated rows are rows like any other, other columns are not read,
    an empty table gives no rows. Nothing is shuffled but the bounded training sample.
    """
    weights = fit(docs) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    base, added = all_spans(text or "", weights)
                    every = {kind: base[kind] + added[kind] for kind in KINDS}
                    row = [doc, *(len(base[k]) for k in KINDS), hashlib.sha256(_named(base).encode()).hexdigest(), _named(every)]
                    out.append(row)
                kinds = (*[pa.int64()] * 5, pa.string(), pa.string())
                names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return cut.mapInArrow(run, schema)
