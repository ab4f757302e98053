"""License scan by a positional index of rare words.

Each template is a run of words. Its index holds its RARE words of highest IDF
(counted over all documents) with their positions. A template whose indexed words, as far
as a file holds them, could not give enough votes is out. For the others the
file's LOOKUPS words of highest IDF are looked up; a word at place p of the file
and at position a of the template proposes the alignment p - a.
The postings are intersected there: an indexed word votes with its IDF if it
stands at alignment + its own position. An alignment passes with enough votes
and if all of the template's mandatory key phrases stand in the aligned window.
Short phrases are templates like the others, which must match in all words.

Everything is one projection over the files: no file is shuffled, and only the
document counts of the templates' words (a number fixed by the templates) are
gathered. What an array holds is proportional to its own text.

Defined cases: null and empty texts have no words; every row, repeated ones and
those without an id included, is judged by its own text; template words that no
document has count as the rarest; equal IDFs go by the word; empty tables give
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.store import pick

RARE = 12          # words of a template that are indexed
LOOKUPS = 3        # of them, words that a file is looked up by
SHARE = 0.6        # least share of the index's IDF that must stand in place
SLACK = 8          # words by which a key phrase may lie outside the aligned window

# fixed values: phrases and their labels; all places are matches
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: opening words of public license notices; (label, words, mandatory key phrases)
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ["hereby granted free of charge", "sublicense and or sell"]),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
               "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
               "distributed under the license is distributed on an as is basis",
     ["www apache org licenses", "agreed to in writing"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
             "general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met redistributions of source code must retain the above copyright notice this "
            "list of conditions and the following disclaimer",
     ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee", "appear in all copies"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
            "not distributed with this file you can obtain one at http mozilla org mpl 2 0",
     ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify "
                  "publish use compile sell or distribute this software",
     ["free and unencumbered software", "public domain"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software permission is granted to anyone to use this "
             "software for any purpose including commercial applications",
     ["held liable for any damages", "permission is granted to anyone"]),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
              "and accompanying documentation covered by this license the software to use reproduce display distribute "
              "execute and transmit the software",
     ["person or organization obtaining a copy"]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ["eclipse public license"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this "
            "work", ["waived all copyright"]),
]

MATCH = "array<struct<label:string,phrase:boolean,start:long,share:double>>"


def templates(phrases: dict[str, str] = PHRASES, notices: list = NOTICES) -> list[tuple[str, list[str], list[str], bool]]:
    """(label, words, key phrases, whether it is a phrase)."""
    return [(label, p.split(), [p], True) for p, label in phrases.items()] \
        + [(label, words.split(), keys, False) for label, words, keys in notices]


def words_of(text: Column) -> Column:
    """The words of a text as an array, A-Z lower-cased (a Kelvin sign, whose lower case is k, is no k)."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    spaced = F.trim(F.regexp_replace(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.array_remove(F.split(spaced, " "), "")


def frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word of the vocabulary."""
    held = F.explode(F.array_append(F.array_intersect("words", F.lit(vocabulary)), F.lit("")))    # '' counts the documents
    counts = {r.word: r.n for r in words.select(held.alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def index_of(known: list[tuple], n: int, counts: dict[str, int]) -> list[dict]:
    """A template's label, words of highest IDF (in falling order), postings, and the votes it needs."""
    out = []
    for label, words, keys, phrase in known:
        idf = {w: math.log((n + 1) / (counts.get(w, 0) + 0.5)) for w in words}
        rare = sorted(idf, key=lambda w: (-idf[w], w))[:len(words) if phrase else RARE]
        postings = [(w, at, max(idf[w], 1e-3)) for at, w in enumerate(words) if w in rare]
        total = sum(v for _, _, v in postings)
        out.append({"label": label, "phrase": phrase, "size": len(words), "words": rare, "postings": postings,
                    "total": total, "need": total * (1 - 1e-9 if phrase else SHARE), "keys": [f" {k} " for k in keys]})
    return out


def index_column(index: list[dict]) -> Column:
    """The index as a constant array, a struct for each template."""
    row = lambda t: F.struct(
        F.lit(t["label"]).alias("label"), F.lit(t["phrase"]).alias("phrase"), F.lit(t["size"]).alias("size"),
        F.lit(t["words"]).alias("words"), F.lit(t["total"]).alias("total"), F.lit(t["need"]).alias("need"),
        F.lit(t["keys"]).alias("keys"), F.array(*[F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"), F.lit(v).alias("idf"))
                                                  for w, at, v in t["postings"]]).alias("postings"))
    return F.array(*[row(t) for t in index])


def votable(present: Column, index: Column) -> Column:
    """The templates whose words in ``present`` could give enough votes; no other can pass."""
    held = lambda t: F.aggregate(t["postings"], F.lit(0.0), lambda acc, x: acc + F.when(
        F.array_contains(present, x["word"]), x["idf"]).otherwise(0.0))
    return F.filter(index, lambda t: held(t) >= t["need"])


def matches(words: Column, possible: Column, places: Column) -> Column:
    """All passed alignments of the possible templates, as MATCH; ``places`` are those of the words that are looked up."""
    def votes(t: Column, at: Column) -> Column:
        return F.aggregate(t["postings"], F.lit(0.0), lambda acc, x: acc + F.when(
            F.get(words, at + x["at"]) == x["word"], x["idf"]).otherwise(0.0))

    def verified(t: Column, at: Column) -> Column:
        first = F.greatest(at - SLACK, F.lit(0))
        window = F.concat(F.lit(" "), F.array_join(F.slice(words, first + 1, at - first + t["size"] + SLACK), " "), F.lit(" "))
        return F.forall(t["keys"], lambda key: F.contains(window, key))

    def of_template(t: Column) -> Column:
        at = F.filter(places, lambda p: F.array_contains(t["lookups"], F.get(words, p)))
        proposed = F.flatten(F.transform(at, lambda p: F.transform(
            F.filter(t["postings"], lambda x: x["word"] == F.get(words, p)), lambda x: p - x["at"])))
        scored = F.transform(F.array_distinct(proposed), lambda o: F.struct(o.alias("at"), votes(t, o).alias("votes")))
        passed = F.filter(scored, lambda c: (c["at"] >= 0) & (c["votes"] >= t["need"]) & verified(t, c["at"]))
        return F.transform(passed, lambda c: F.struct(
            t["label"].alias("label"), t["phrase"].alias("phrase"), c["at"].cast("long").alias("start"),
            F.least(c["votes"] / t["total"], F.lit(1.0)).alias("share")))

    return F.flatten(F.transform(possible, of_template))


def license_matches(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: list = NOTICES) -> DataFrame:
    """doc_id, n_words, matches: every place where a phrase stands or a notice begins, with its share of votes."""
    known = templates(phrases, notices)
    vocabulary = sorted({w for _, words, _, _ in known for w in words})
    tokens = pick(docs, "doc_id", "text").select("doc_id", words_of(F.col("text")).alias("words"))
    index = index_of(known, *frequencies(tokens.select("words"), vocabulary))
    indexed = sorted({w for t in index for w in t["words"]})
    held = tokens.withColumn("present", F.array_intersect("words", F.lit(indexed)))
    looked_up = lambda t: F.slice(F.filter(t["words"], lambda w: F.array_contains("present", w)), 1, LOOKUPS)
    parts = ["label", "phrase", "size", "postings", "total", "need", "keys"]
    possible = F.transform(votable(F.col("present"), index_column(index)), lambda t: F.struct(
        looked_up(t).alias("lookups"), *[t[c].alias(c) for c in parts]))
    held = held.withColumn("possible", F.when(F.size("present") > 0, possible))
    held = held.withColumn("wanted", F.array_distinct(F.flatten(F.transform("possible", lambda t: t["lookups"]))))
    held = held.withColumn("places", F.when(F.size("wanted") > 0, F.filter(F.transform(
        "words", lambda w, i: F.when(F.array_contains("wanted", w), i)), lambda i: i.isNotNull())))
    found = F.when(F.size("wanted") > 0, matches(F.col("words"), F.col("possible"), F.col("places")))
    return held.select("doc_id", F.size("words").cast("long").alias("n_words"),
                       F.coalesce(found, F.array().cast(MATCH)).alias("matches"))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    score is the largest share of a template's votes at a passed alignment, 0 without one.
    """
    base = F.filter("matches", lambda m: m["phrase"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    starts = F.transform("base", lambda m: m["start"])
    return license_matches(docs).withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(F.col("base")).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"), "matches")
