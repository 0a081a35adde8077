import re
from collections import Counter

from common import ROWS, documents, key
from pyspark.sql import functions as F

from matchwright.llm import licences, quality
from matchwright.llm.queries import ORACLES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(doc, text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (
        doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines),
    )


def test_measures(spark):
    rows = [*ROWS, (20, "a b c a b c d a b c"), (21, "x # * x\n\nx # * x\n \n\x0b\nx"), (22, "aa aa aa aa")]
    got = quality.ledger(documents(spark, rows)).drop("fail_bits").collect()
    assert sorted(map(tuple, got), key=key) == sorted((brute(*r) for r in rows), key=key)
    assert quality.ledger(documents(spark).limit(0)).count() == 0


def test_policies_and_keep(spark):
    docs = documents(spark)
    rows = quality.verdicts(docs).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.fail_bits & quality.mask(quality.POLICIES["v1"]) == 0)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)


def test_ablations(spark):
    rows = quality.ledger(documents(spark))
    bits = [r.fail_bits for r in rows.collect()]
    got = {(r.policy, r.rule): r for r in quality.ablations(rows).collect()}
    assert len(got) == sum(map(len, quality.POLICIES.values()))
    for (policy, rule), r in got.items():
        all_, one = quality.mask(quality.POLICIES[policy]), quality.mask((rule,))
        assert r.failed == sum(b & one != 0 for b in bits)
        assert r.failed_only_this == sum(b & all_ == one for b in bits)
        assert r.kept == sum(b & all_ == 0 for b in bits)
        assert r.kept_without == sum(b & (all_ & ~one) == 0 for b in bits)


def test_no_python_on_the_native_paths(spark):
    for df in (quality.verdicts(documents(spark)), licences.scan(documents(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


TEXTS = [
    (1, "Released under the MIT License."),
    (2, "mit-license MIT LICENSE\nmit  licenses"),
    (3, "This work is licensed under the GNU General Public License, version 3."),
    (4, "Licensed under the Apache Licence"),
    (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (6, "general public license " * 3),
    (7, "the of in to and general"),
    (8, "MIT License"),
    (8, "MIT License"),
    (9, None),
    (10, ""),
    (None, "éMIT License mit license"),
    (11, "filler " * 200 + "Licensed under the Apache License, Version 2.0"),
]


def test_scan_against_sql(spark, tmp_path):
    import duckdb

    docs = documents(spark, TEXTS)
    got = licences.scan(docs)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(ORACLES["op4_license_scans"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[2].n_base == 2 and by_id[2].first_word == 0 and by_id[2].last_word == 2
    assert by_id[6].n_base == 3 and by_id[6].base_labels == "gpl"
    assert by_id[9].labels == "" and by_id[9].score == 0.0 and by_id[9].first_word is None
    assert "apache-2.0" in by_id[11].labels and by_id[11].score == 1.0
    assert by_id[None].first_word == 2
    assert licences.scan(docs.limit(0)).count() == 0


def test_hot_word_in_a_long_text(spark):
    docs = spark.createDataFrame([(1, "license mit " * 20000)], "doc_id long, text string")
    row = licences.scan(docs).first()
    assert row.n_base == 19999 and row.n_words == 40000
    assert docs.select(F.length("text")).first()[0] == 240000


def test_no_notice_hides_another(spark):
    """Every ordered pair of templates, and all in one file after long prose with licence words, keep what each finds alone."""
    texts = {label: text for label, (text, _) in licences.TEMPLATES.items()}
    prose = "the license of this software may be used by any person under the terms and conditions of the copyright holder " * 300
    names = list(texts)
    rows = [*texts.values(), *(f"{texts[a]}.\n\n{texts[b]}" for a in names for b in names if a != b)]
    rows += [prose + ". ".join(texts.values()), prose + " ".join(reversed(texts.values()))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: set(r.labels.split(",")) for r in licences.scan(docs).collect()}
    alone = {label: found[i] for i, label in enumerate(names)}
    assert all(label in labels for label, labels in alone.items())
    pairs = [(a, b) for a in names for b in names if a != b]
    assert [(a, b) for i, (a, b) in enumerate(pairs, len(names)) if not alone[a] | alone[b] <= found[i]] == []
    assert all(set().union(*alone.values()) <= found[i] for i in (len(rows) - 2, len(rows) - 1))


def test_prose_of_licence_words_is_no_notice(spark):
    text = "a person may copy this software and the license permits it " * 40 + "permission is hereby granted to sit down"
    row = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == "" and row.score == 0.0
