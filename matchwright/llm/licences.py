"""Licence statements in files, found by a positional index of rare template words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.session import stage

# ---- fixed values: wording of public licence texts and notices --------------------------------

#: label -> (template words, key phrase that must stand at its place)
TEMPLATES: dict[str, tuple[str, str]] = {
    "mit-notice": ("released under the mit license", "mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction",
        "permission is hereby granted",
    ),
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license"),
    "apache-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        "you may not use this file except in compliance",
    ),
    "gpl-3-notice": ("this work is licensed under the gnu general public license version 3", "gnu general public license"),
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        "this program is free software",
    ),
    "lgpl-notice": ("licensed under the gnu lesser general public license", "lesser general public license"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission to use copy modify",
    ),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so subject to the following "
        "conditions the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software the software is provided as is without warranty of any kind express "
        "or implied including but not limited to the warranties of merchantability fitness for a particular purpose "
        "and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or in connection "
        "with the software or the use or other dealings in the software",
        "substantial portions of the software",
    ),
    "bsd-3-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission",
        "endorse or promote products derived from this software",
    ),
    "isc-text": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the "
        "software is provided as is and the author disclaims all warranties with regard to this software",
        "the author disclaims all warranties",
    ),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely "
        "subject to the following restrictions the origin of this software must not be misrepresented",
        "the origin of this software must not be misrepresented",
    ),
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means",
        "free and unencumbered software",
    ),
}

#: phrase -> label of the base scan
BASE: dict[str, str] = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Word rule after lower-casing A-Z; upper case letters count as word characters here.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vocabulary(templates: dict[str, tuple[str, str]] = TEMPLATES) -> list[str]:
    texts = [t for t, _ in templates.values()] + [k for _, k in templates.values()] + list(BASE)
    return sorted({w for t in texts for w in t.split()})


def hits(docs: DataFrame, words: list[str]) -> DataFrame:
    """uid, doc_id, n_words and `hits`: every place (w, i) of a licence word, in order, i from 0."""
    cut = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), GAP, -1)
    df = docs.select(F.col("doc_id").cast("long"), cut.alias("cut"))
    lead = (F.get("cut", F.lit(0)) == "").cast("int")
    trail = ((F.size("cut") > 1) & (F.element_at("cut", -1) == "")).cast("int")
    df = df.withColumns({"lead": lead, "n_words": (F.size("cut") - lead - trail).cast("long")})

    def licence(w: Column, i: Column) -> Column:
        low = F.lower(w)
        # only ASCII words are lower-cased; another letter must not turn into one
        return F.when(low.isin(words) & (F.length(w) == F.octet_length(w)), F.struct(low.alias("w"), (i - F.col("lead")).alias("i")))

    found = F.filter(F.transform("cut", licence), lambda x: x.isNotNull())
    return df.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "n_words", found.alias("hits"))


def places(phrase: str) -> Column:
    """Starts of a phrase of licence words: consecutive hits at consecutive word numbers."""
    first, *rest = phrase.split()
    h = F.col("hits")

    def stands(x: Column, j: Column) -> Column:
        ok = x.w == first
        for k, word in enumerate(rest, 1):
            y = F.get(h, j + k)
            ok = ok & (y.w == word) & (y.i == x.i + k)
        return F.coalesce(ok, F.lit(False))

    found = F.transform(F.filter(h, stands), lambda x: x.i)
    holds = F.array_contains("held", first)
    return F.when(holds, found).otherwise(F.array().cast("array<int>"))


def rare_words(df: DataFrame, templates: dict[str, tuple[str, str]], probes: int) -> dict[str, list[str]]:
    """Of each template the `probes` words of highest IDF over all rows (all, if it has fewer); ties by the word.

    One count per licence word comes to the driver: their number is that of the templates' words.
    """
    counted = {r.w: r.n for r in df.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    # the IDF falls as the number of rows that hold the word grows
    return {label: sorted(set(text.split()), key=lambda w: (counted.get(w, 0), w))[:probes] for label, (text, _) in templates.items()}


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, str]] = TEMPLATES,
    probes: int = 12,
    slack: int = 2,
    least: float = 0.6,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Base: all places of the `BASE` phrases. Templates: the index holds every place of a
    template's `probes` words of highest IDF (counted over all rows). In each file the words of
    every template whose key phrase stands are looked up; the difference of file place and
    template place must agree, so an alignment is a (file, template, difference) with its
    number of agreeing places. It holds when at least `least` of the template's indexed places
    agree and the key phrase stands within `slack` words of its place. No template stands
    back for another, however many notices a file has. score: the highest share of agreeing
    places, at least 0.5 where a base phrase stands, else 0.

    Null and empty texts have no words, empty label strings and score 0; ties and repeated
    rows each give their own row; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    words = vocabulary(templates)
    found = hits(docs, words)
    held = F.array_distinct(F.transform("hits", lambda x: x.w))
    rows = stage(found.withColumn("held", held), "licence-hits")
    rare = rare_words(rows, templates, probes)
    index = [(label, w, p) for label, (text, _) in templates.items() for p, w in enumerate(text.split()) if w in rare[label]]
    able = {label: sum(1 for x in index if x[0] == label) for label in templates}
    postings = spark.createDataFrame([(label, w, p, able[label]) for label, w, p in index], "label string, w string, p int, able int")
    keys = [(label, key, len(f" {text} ".split(f" {key} ")[0].split())) for label, (text, key) in templates.items()]

    marks = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(at).alias("at"), places(key).alias("starts")) for label, key, at in keys))
    files = rows.withColumn("keys", F.filter(marks, lambda m: F.size(m.starts) > 0)).where(F.size("keys") > 0)
    probed = sorted({w for ws in rare.values() for w in ws})
    standing = F.transform("keys", lambda k: k.label)
    look = files.select("uid", standing.alias("standing"), F.explode(F.filter("hits", lambda x: x.w.isin(probed))).alias("h"))
    # the postings are as many rows as the templates have words
    votes = look.join(F.broadcast(postings), F.col("h.w") == F.col("w")).where(F.array_contains("standing", F.col("label")))
    aligned = votes.groupBy("uid", "label", "able", (F.col("h.i") - F.col("p")).alias("shift")).agg(F.count("*").alias("agree"))
    key_rows = files.select("uid", F.explode("keys").alias("k")).select("uid", F.col("k.label").alias("label"), F.col("k.at").alias("at"), F.col("k.starts").alias("starts"))
    verified = (
        aligned.where(F.col("agree") >= least * F.col("able"))
        .join(key_rows, ["uid", "label"])
        .where(F.exists("starts", lambda s: F.abs(s - F.col("shift") - F.col("at")) <= slack))
        .groupBy("uid")
        .agg(F.collect_set("label").alias("found"), F.max(F.col("agree") / F.col("able")).alias("share"))  # a set of template labels
    )

    base = F.array(*(F.struct(F.lit(label).alias("label"), places(phrase).alias("starts")) for phrase, label in BASE.items()))
    rows = rows.withColumn("base", base).withColumn("starts", F.flatten(F.transform("base", lambda b: b.starts)))
    base_labels = F.transform(F.filter("base", lambda b: F.size(b.starts) > 0), lambda b: b.label)
    out = rows.withColumn("own", base_labels).drop("hits", "held", "base").join(verified, "uid", "left")
    every = F.array_union("own", F.coalesce("found", F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.sort_array("own"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size("own") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
