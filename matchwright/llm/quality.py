"""Quality rules as a ledger of failure bits, and the policies that read it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"

#: Rule name -> (bit, what makes a row of measurements fail). Bits are never reused, so stored ledgers stay readable.
RULES: dict[str, tuple[int, Callable[[Column], Column]]] = {
    "few_words": (0, lambda m: m.n_words < 50),
    "repeated_words": (1, lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
    "symbols": (2, lambda m: 10 * m.n_symbols > m.n_words),
    "repeated_lines": (3, lambda m: 100 * m.n_dup_lines > 60 * m.n_lines),
    "short_words": (4, lambda m: m.word_chars < 2 * m.n_words),
    "long_words": (5, lambda m: m.word_chars > 20 * m.n_words),
    "many_repeated_lines": (6, lambda m: 100 * m.n_dup_lines > 30 * m.n_lines),
    "some_repeated_words": (7, lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
}

#: Policy version -> the rules that reject a row. A new version is a new entry.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
    "v1_strict": tuple(RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[r][0] for r in rules)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once, however often `use` names it and wherever the optimizer moves it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _covered(windows: Column) -> Column:
    """How many words lie in 3-word windows that come twice or more."""

    def count(s: Column) -> Column:
        text = lambda i: F.get(s, i).getField("w")
        again = F.filter(s, lambda x, i: (x.w == F.when(i > 0, text(i - 1))) | (x.w == text(i + 1)))
        starts = F.sort_array(F.transform(again, lambda x: x.i))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts,
            zero,
            lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last")),
            lambda a: a.n,
        )

    ordered = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    # sorting only where a window does come again
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _bind(ordered, count)).otherwise(0)


def measures(text: Column) -> Column:
    """The measurements of a whole text (null: no words) and its failure bits, every rule evaluated once, as one struct."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    none = F.array().cast("array<string>")

    def of_words(w: Column) -> Column:
        windows = F.when(
            F.size(w) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
        ).otherwise(none)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _bind(windows, _covered).cast("long").alias("n_repeat_words"),
        )

    inner = F.trim(text, F.lit(SPACES))
    words = _bind(F.when(inner == "", none).otherwise(F.split(inner, WORD_GAP, -1)), of_words)
    lines = _bind(
        F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != ""),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
        ),
    )
    symbols = (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")

    def judged(m: Column) -> Column:
        bits = F.lit(0).cast("long")
        for bit, fails in RULES.values():
            bits = bits + F.when(fails(m), F.lit(1 << bit)).otherwise(0)
        return F.struct(*(m.getField(c).alias(c) for c in MEASURES), bits.alias("fail_bits"))

    flat = _bind(
        F.struct(words.alias("w"), lines.alias("l"), symbols.alias("n_symbols")),
        lambda x: F.struct(
            x.w.n_words.alias("n_words"), x.w.word_chars.alias("word_chars"), x.n_symbols.alias("n_symbols"),
            x.l.n_dup_lines.alias("n_dup_lines"), x.w.n_repeat_words.alias("n_repeat_words"), x.l.n_lines.alias("n_lines"),
        ),
    )
    return _bind(flat, judged)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def ledger(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`carry`, the measurements and `fail_bits`: every rule evaluated once per row.

    A null or empty text has no words and fails `few_words`; a rule over no words or lines
    does not fail. Repeated rows and equal texts are rows like any other; columns of `docs`
    outside `carry` are not read, so they may have any name.
    """
    rows = docs.select(*(F.col(f"`{c}`") for c in carry), measures(F.col("text")).alias("_measured"))
    return rows.select(*(F.col(f"`{c}`") for c in carry), "_measured.*")


def keep(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of `docs` that pass the policy, with the columns they came with, whatever their names."""
    bits = measures(F.col("text")).getField("fail_bits")
    return docs.where(bits.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def passes(policy: str, bits: str = "fail_bits") -> Column:
    """Whether a ledger row passes the policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """Per policy and rule: rows that fail the rule, rows that only this rule rejects, rows kept with and without it.

    The ledger is counted by bit pattern first (2^rules patterns at most), the rest is bit
    arithmetic on those counts.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    uses = [F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(rules)).alias("mask"), F.lit(mask((r,))).alias("bit"))
            for p, rules in POLICIES.items() for r in rules]
    x = patterns.select("fail_bits", "n", F.inline(F.array(*uses)))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return x.groupBy("policy", "rule").agg(
        total(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0)("failed"),
        total(hit == F.col("bit"))("failed_only_this"),
        total(hit == 0)("kept"),
        total((hit == 0) | (hit == F.col("bit")))("kept_without"),
    )


def verdicts(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with base_failed and kept (false where the base rules fail, else the policy's verdict)."""
    rows = ledger(docs)
    base = ~passes("base")
    return rows.select("*", base.alias("base_failed"), (~base & passes(policy)).alias("kept"))
