"""Lexical search, license scan and hard negatives against brute force, and on awkward tables."""

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import kronecker, lemp, licenses
from rollcall.llm.kronecker import Packed, hard_negatives
from rollcall.llm.lemp import lexical_search
from rollcall.llm.licenses import NOTICES, PHRASES, license_matches, license_scan
from tests.llm.test_operators import ODD, none, odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=10):
    """Brute force: every item's k best documents."""
    found = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n, length = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 10 + (90 * c.total() * n) // length
            s = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, "clash", 7) for i, t in docs], "doc_id long, text string, terms string, item int")
    q = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, tf string")
    return sorted(map(tuple, lexical_search(d, q, k).collect()), key=str)


def prose(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(n))


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    if small:   # many cells, blocks and buckets
        for name, value in (("SHARD", 60), ("ITEM_TERMS", 40), ("BUCKET", 8), ("FOCUS", 2)):
            monkeypatch.setattr(lemp, name, value)
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice((3, 20, 90)))) for i in range(300)] + [(500 + i, "w3 W9 w350") for i in range(40)]
    docs += [(None, "w3 w9 w350"), (501, "w3 w9 w350"), (900, None), (901, ""), (902, "... !!"), (903, "Ünï w9 ünï")]
    items = [(i, prose(rng, 12)) for i in range(15)] + [(20, "w350 w9"), (21, "nowhere"), (22, None), (23, ""), (24, "w9 " * 50 + "Ünï")]
    assert searched(spark, docs, items) == ranked(docs, items)


def test_search_on_awkward_tables(spark):
    docs = [(i, t) for i, t, _ in ODD]
    items = [(1, "same words yes"), (2, "word7919 word9 x"), (None, "one 你好")]
    assert searched(spark, docs, items, 3) == ranked(docs, items, 3)
    item = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search(none(spark), item).count() == 0
    assert lexical_search(odd(spark), item.limit(0)).count() == 0


def test_bounds_prune_and_keep_the_best():
    """Buckets are pruned by length and documents by their coordinates, and what is left holds the best."""
    import pyarrow as pa
    rng = np.random.RandomState(1)
    n, terms = 4096, 200
    doc = np.repeat(np.arange(n), rng.randint(1, 60, n))
    pairs = np.unique(np.stack([doc, np.minimum(rng.geometric(0.02, len(doc)) - 1, terms - 1)]), axis=1)
    doc, term = pairs
    weight = np.maximum(1, np.floor(1000 * np.log((2 * n + 2) / (2 * np.bincount(term, minlength=terms) + 1)))).astype(np.int64)
    size = np.maximum(np.bincount(doc, minlength=n), 1)
    shard = lemp.Shard(pa.array(np.arange(n)), size, term, np.ones(len(doc), np.int64), doc, weight, n, int(size.sum()))
    gain = 10 ** 9 // (1000 + 8 * (10 + (90 * size * n) // int(size.sum())))
    seen = Counter()
    for i in range(20):
        # the terms of a document with a long vector, as an item that was copied into it, or terms drawn freely
        asked = np.unique(shard.row_term[shard.row[i]:shard.row[i + 1]] if i % 2 else rng.randint(0, terms, 8))
        asked = asked[np.argsort(-weight[asked], kind="stable")]
        k = 1 if i % 2 else 10
        exact = np.bincount(doc, np.isin(term, asked) * weight[term] * gain[doc], minlength=n).astype(np.int64)
        want = sorted(((-s, i) for i, s in enumerate(exact) if s > 0))[:k]
        places, scores = shard.top(asked, 0, k, seen)
        assert [(-s, i) for s, i in zip(scores, shard.id[places])] == want
        warm, again = shard.top(asked, int(scores[-1]), k, seen)      # a bar that is known from the start
        assert (warm == places).all() and (again == scores).all()
    assert seen["pruned"] > 0 and seen["filtered"] > 0.5 * (seen["scored"] + seen["filtered"])


def scanned(text):
    """Brute force of the phrases: (n_words, n_base, first, last, base_labels)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
          if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({label for _, label in at})))


def test_license_phrases_equal_brute_force(spark):
    rng = random.Random(2)
    pieces = ["mit", "MIT", "License", "license", "apache", "general", "public", "GNU", "K", "Kelvin", "ümlaut", "of", "9"]
    texts = [rng.choice((" ", "-", ", ")).join(rng.choice(pieces) for _ in range(rng.choice((3, 30, 200)))) for _ in range(60)]
    texts += [None, "", " . ", "mit license " * 5000, "license " * 5000, "mİt license", "mit_license apache\nlicense"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == scanned(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def by_definition(words, index):
    """Every alignment that the index and the key phrases pass, found by trying all of them."""
    out = set()
    for t in index:
        held = [w for w in t["words"] if w in words][:licenses.LOOKUPS]
        for at in range(len(words)):
            votes = [(w, v) for w, a, v in t["postings"] if at + a < len(words) and words[at + a] == w]
            window = f" {' '.join(words[max(0, at - licenses.SLACK):at + t['size'] + licenses.SLACK])} "
            if sum(v for _, v in votes) >= t["need"] and any(w in held for w, _ in votes) and all(k in window for k in t["keys"]):
                out.add((t["label"], t["phrase"], at))
    return out


def test_notices_are_found_where_they_stand(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choice(("of", "the", "we", "stone", "river", "copy", "use")) for _ in range(n))
    texts, want = [], []
    for label, notice, _ in NOTICES:
        n = rng.randint(0, 40)
        texts.append(f"{filler(n)} Copyright 2020 Someone. {notice.capitalize()}. {filler(30)}")
        want.append(label)
    edited = NOTICES[0][1].split()
    edited[12], edited[20] = "package", "items"                       # two words of another hand
    texts += [" ".join(edited), NOTICES[0][1].replace("hereby granted", "never granted"),      # a key phrase is gone
              " ".join(reversed(NOTICES[5][1].split())), filler(500)]
    want += ["mit", None, None, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    for i, label in enumerate(want):
        assert label in got[i].labels.split(",") if label else got[i].labels == "", (i, label, got[i].labels)
        assert (got[i].score > 0.6) == (label is not None)
    known = licenses.templates()
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER)) for t in texts]
    counts = Counter(w for ws in words for w in set(ws))
    index = licenses.index_of(known, len(texts), counts)
    for r in license_matches(docs).collect():
        assert {(m.label, m.phrase, m.start) for m in r.matches} == by_definition(words[r.doc_id], index)


def test_license_scan_on_awkward_tables(spark):
    assert sorted(str(r.doc_id) for r in license_scan(odd(spark)).collect()) == sorted(str(i) for i, _, _ in ODD)
    assert license_scan(none(spark)).count() == 0


def test_license_scan_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("low, high, size", [(-150, 150, 64), (-3, 2, 7), (5, 9, 3), (-2 ** 20, 2 ** 20, 64),
                                             (-2 ** 30, 2 ** 30, 5), (0, 1, 1)])
def test_packed_products_are_exact(low, high, size):
    rng = np.random.default_rng(8)
    a, c = rng.integers(low, high, (9, size)), rng.integers(low, high, (37, size))
    packed = Packed(c, int(a.min()), int(a.max()))
    assert packed.fields > 1
    assert (packed.scores(a) == (a.astype(object) @ c.T.astype(object)).astype(np.int64)).all()


def mined(rows, k=5):
    """Brute force: rows of (id, vector, label)."""
    live = [(i, [floor(256 * x) for x in v], (b + 1) % 10 if i % 7 == 0 else b) for i, v, b in rows
            if i is not None and v is not None and b is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    out = []
    for a, (i, v, b) in enumerate(live):
        if i % 100:
            continue
        scores = sorted((-dot(v, w), j, n) for n, (j, w, _) in enumerate(live) if n != a)
        for s, p, _ in [x for x in scores if live[x[2]][2] == b][:k]:
            hard = [x for x in scores if live[x[2]][2] != b and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, p, r, x[1], -s, -x[0]) for r, x in enumerate(hard, 1)]
    return sorted(out)


def negatives(spark, rows):
    df = spark.createDataFrame([(i, v, b, "clash", 1) for i, v, b in rows],
                               "vec_id long, embedding array<float>, label int, row string, shard int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 100 == 0, label).collect()))


@pytest.mark.parametrize("small", [False, True])
def test_negatives_equal_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("SHARD", 37), ("ANCHORS", 2), ("LINES", 3)):
            monkeypatch.setattr(kronecker, name, value)
    rng = np.random.RandomState(3)
    vectors = np.round(rng.normal(0, 0.2, (400, 6)) + 0.1, 3)
    rows = [(i, [float(x) for x in v], int(rng.choice((0, 0, 0, 1, 2)))) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[5][1], 0) for i in range(30)]                       # copies: ties
    rows += [(200, rows[9][1], 1), (None, rows[9][1], 1), (2000, None, 1), (2001, [0.1, None], 1), (2002, [float("nan")], 0),
             (2003, [float("inf")], 0), (2004, [0.5], 1), (2005, [], 1), (2100, rows[3][1], None), (2200, [0.4, 0.3], 9)]
    want = mined([(i, v and [float(np.float32(x)) if x is not None else None for x in v], b) for i, v, b in rows])
    assert negatives(spark, rows) == want and len(want) > 30


def test_negatives_of_empty_tables(spark):
    assert negatives(spark, [(1, [0.5], 1)]) == [] and negatives(spark, []) == []


def test_negatives_of_large_components(spark):
    rows = [(0, [900000.5, -3.0], 1), (1, [800000.0, 2.0], 1), (2, [799999.0, 5.0], 2), (3, [700000.0, 1.0], 3)]
    assert negatives(spark, rows) == mined(rows) != []
