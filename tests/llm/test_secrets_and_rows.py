"""Secrets that no fixed pattern shows, and near duplicates by row where ids are null or repeat."""

import random
import re
import string
import time

from rollcall.llm.near_dup import near_duplicates
from rollcall.llm.secret_scan import Judge, apart, base_spans, secret_scan

WORDS = "the of report internationalisation budget committee 2024-01-05 covid19 mail5.example.com index.html v2.10.3 " \
        "section12 understanding responsibility self-evident A4 HTTP/1.1 www.example.org/path/to-page 10000000 GmbH".split()
MADE = {
    "long": lambda rng: "sk_live_" + "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(24)),
    "short": lambda rng: "".join(rng.choice(string.ascii_uppercase) + rng.choice(string.digits) for _ in range(6)),
    "dotted": lambda rng: ".".join("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(12)) for _ in range(3)),
}


def test_credentials_of_assignments_are_found_bare(spark):
    rng = random.Random(11)
    rows, bare = [], {}
    for i in range(900):
        text = [rng.choice(WORDS) for _ in range(60)]
        kind = list(MADE)[i % 3]
        if i < 450:
            text[rng.randrange(60)] = f"password = {MADE[kind](rng)}"
        elif i < 510:
            at = rng.randrange(60)
            text[at] = bare[i] = MADE[kind](rng)
        rows.append((i, " ".join(text)))
    out = {r.doc_id: r for r in secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    hits = wrong = 0
    for i, r in out.items():
        added = [x.split(":") for x in r.spans.split(",") if x.startswith("format:")]
        assert len(added) == r.n_added
        base = [f"{k}:{s}:{e}" for s, _, k, e in sorted((s, ("assign", "access", "hex").index(k), k, e)
                                                        for k, s, e, _ in base_spans(texts[i]))]
        assert [x for x in r.spans.split(",") if x and not x.startswith("format:")] == base
        found = {texts[i][int(s):int(e)] for _, s, e in added}
        hits += found == {bare[i]} if i in bare else 0
        wrong += len(found - {bare.get(i)})
    assert hits >= 0.9 * len(bare), (hits, len(bare))          # recall
    assert wrong == 0, wrong                                   # precision


def test_judgement_is_of_the_whole_value():
    rng = random.Random(2)
    from rollcall.llm.secret_scan import PLAIN, Automaton

    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(200)]
    judge = Judge({"hex": (Automaton.infer(hexes).states, -1.5), PLAIN: (Automaton.infer(WORDS * 20).states, -9.0)}, 0.01)
    start = "".join(rng.choice("0123456789abcdef") for _ in range(200))
    assert judge(start[:64]) and not judge(start[:64] + "-not-a-credential-at-all" * 8)


def test_spans_apart_against_all_pairs():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(60))
        taken = [(s, s + rng.randint(1, 8)) for s in (rng.randrange(60) for _ in range(rng.randint(0, 6)))]
        want = [m.span() for m in re.finditer("a+", text) if not any(s < m.end() and m.start() < e for s, e in taken)]
        assert [m.span() for m in apart(re.finditer("a+", text), taken)] == want


def test_many_spans_in_one_text(spark):
    rng = random.Random(6)
    text = " ".join(f"token={rng.getrandbits(160):040x} {MADE['long'](rng)}" for _ in range(10000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    out = secret_scan(df).first()
    assert (out.n_assign, out.n_hex) == (10000, 10000)
    assert time.time() - start < 30


BASE = " ".join(f"w{i}" for i in range(200))


def test_near_duplicates_of_rows_without_or_with_repeated_ids(spark):
    near = BASE.replace("w77 ", "new ")
    other = " ".join(f"z{i}" for i in range(100))
    rows = [(5, BASE), (5, other), (3, near), (None, BASE), (None, near.replace("w150 ", "new ")), (None, "lonely words of a row"),
            (None, "lonely  words of a ROW"), (5, BASE), (8, other + " more"), (None, None), (9, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, 198, 3, False), (5, 98, 5, True), (3, 198, 3, True), (None, 198, 3, False), (None, 198, 3, False),
                          (None, 3, None, True), (None, 3, None, True), (5, 198, 3, False), (8, 99, 5, False),
                          (None, 0, None, True), (9, 0, 9, True)], key=str)


def test_rows_without_ids_join_two_components(spark):
    # each step differs a little; only the nameless row in the middle links the ends
    def step(k):
        w = [f"w{i}" for i in range(200)]
        for j in range(k):
            w[20 * j + 10] = "new"
        return " ".join(w)

    rows = [(7, step(0)), (None, step(3)), (2, step(6))]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(7, 2, False), (None, 2, False), (2, 2, True)}
