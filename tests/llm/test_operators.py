"""Every operator against brute force, exact round trips or held-out accuracy, and on awkward tables."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rollcall.llm import merkle, queries
from rollcall.llm.bpe import WordBPE, bpe_encode
from rollcall.llm.language_crf import identify_language
from rollcall.llm.mixing import label_domains, mix
from rollcall.llm.near_dup import components, near_duplicates
from rollcall.llm.pii import personal_data
from rollcall.llm.quality import quality_scores
from rollcall.llm.secret_scan import Automaton, base_spans, redacted, secret_scan
from rollcall.llm.store import shared_dir, table
from rollcall.llm.topk import maxscore_topk
from rollcall.llm.warc import EMPTY_FRAME, frames, read_archives, warc_round_trip, write_archives

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, row int, run string, words string"
LONG = " ".join(f"word{i * 7919 % 9973}" for i in range(30000))
ODD = [(1, None, None), (2, "", "en"), (None, "a row without an id, yes", "en"), (3, "x" * 70000, "en"), (4, LONG, "en"),
       (5, "same words here again and again", "en"), (5, "same words here again and again", "en"),
       (6, "same words here again and again", None), (7, "ümlaut — 你好 \U0001F600 ok", "de"), (8, " \n\t ", "fr"), (9, "one", "fr")]


def odd(spark):
    return spark.createDataFrame([(i, t, g, "s", None, "clash", 0, "clash", "clash") for i, t, g in ODD], DOC)


def none(spark):
    return odd(spark).limit(0)


def labels(spark, rows=((3, 1, 0), (4, 1, 0), (5, 0, 0), (6, None, None), (None, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "secrets": secret_scan,
    "quality": lambda d: quality_scores(d, labels(d.sparkSession)),
    "personal": personal_data,
    "bpe": lambda d: bpe_encode(d, queries.tokenizer_path()),
    "language": lambda d: identify_language(d, d.select("lang", "text")),
    "mix": lambda d: mix(d, label_domains(labels(d.sparkSession)), queries.TARGETS),
    "merkle": merkle.merkle_fingerprints,
    "near": near_duplicates,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_empty_tables(spark, name):
    ids = sorted(str(r.doc_id) for r in OPERATORS[name](odd(spark)).collect())
    assert ids == sorted(str(i) for i, _, _ in ODD)
    assert OPERATORS[name](none(spark)).count() == 0


def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def test_secret_base_spans(spark):
    t = "x token=token:abcdefgh Password: 'hunter22x' AKIA" + "A1" * 8 + " " + "0f" * 12 + " api_key = short"
    got = [(k, t[s:e]) for k, s, e, _ in base_spans(t)]
    assert got == [("assign", "Password: 'hunter22x"), ("access", "AKIA" + "A1" * 8), ("hex", "0f" * 12)]
    out = secret_scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).first()
    assert (out.n_assign, out.n_access, out.n_hex) == (1, 1, 1)
    spans = sorted((s, ("assign", "access", "hex").index(k), k, e) for k, s, e, _ in base_spans(t))
    assert out.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans))


def test_secret_formats_are_learnt(spark):
    rng = random.Random(3)
    key = lambda: "sk_" + "".join(rng.choice("ABCDEFGHJKLMNPQR23456789") for _ in range(28))
    known = spark.createDataFrame([("service", key()) for _ in range(200)], "kind string, value string")
    known = known.withColumn("kind", F.lit("assign"))
    docs = spark.createDataFrame([(1, f"plain words and {key()} there"), (2, "release-2024-01-02-final-build-report")]
                                 + [(10 + i, "internationalisation words only") for i in range(30)], "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in secret_scan(docs, known).collect()}
    assert got[1] == 1 and got[2] == 0


def test_automaton_merges_states():
    rng = random.Random(5)
    a = Automaton.infer(["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(300)])
    assert len(a.states) < 40 and a.score("0a" * 16) > a.score("hello-world-hello")


def test_redaction(spark):
    df = spark.createDataFrame([("ab token=secret99 cd", "assign:3:17,hex:9:15"), ("x", ""), (None, None)], "t string, s string")
    assert [r.o for r in df.select(redacted(F.col("t"), F.col("s")).alias("o")).collect()] == ["ab <secret> cd", "x", None]


def test_warc(spark):
    big, small = "<p>" + "é" * 600, "tiny"
    rows = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate([big, small, big, small, None, big + "x", "", big])]
    df = spark.createDataFrame(rows + [(None, None, big)], "page_id long, url string, html string")
    df = df.withColumn("digest", F.lit("clash"))
    got = {r.page_id: r for r in warc_round_trip(df).collect()}
    assert len(got) == 9
    for i, _, h in rows:
        raw = (h or "").encode("utf-8")
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {0: 7, 2: 7}
    assert got[None].record_type == "response" and warc_round_trip(df.limit(0)).count() == 0


def test_warc_layout(spark):
    path = shared_dir(spark) + "/warc-layout-" + str(random.random())
    pages = table(spark, SF, "pages")
    write_archives(pages, path)
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        if f.length:
            assert bytes(f.content[:4]) == (0x184D2A5D).to_bytes(4, "little") and EMPTY_FRAME in bytes(f.content)
            assert sum(1 for m, _ in frames(bytes(f.content)) if m == 0xFD2FB528) > 0
    want = {r.page_id: r.html for r in pages.collect()}
    back = {r.page_id: bytes(r.payload).decode() for r in read_archives(spark, path).collect() if r.payload is not None}
    assert back and all(want[i] == v for i, v in back.items())


def test_warc_small_partitions_share_an_archive(spark):
    path = shared_dir(spark) + "/warc-small-" + str(random.random())
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    df = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 150} " + "some words of a page " * 60) for i in range(200)],
                               "page_id long, url string, html string").repartition(40)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        write_archives(df, path)
        write_archives(df.withColumn("html", F.repeat("html", 60)), path + "-large")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([n for n in os.listdir(path) if n.startswith("part-")]) == 1
    assert 4 <= len([n for n in os.listdir(path + "-large") if n.startswith("part-")]) <= 5       # 15 MB of payload
    for p in (path, path + "-large"):
        got = {r.page_id: r.refers_to for r in read_archives(spark, p).collect()}
        assert got == {i: i + 150 if i < 50 else None for i in range(200)}


def test_quality_keeps_trusted_text(spark):
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = quality_scores(docs, marks).join(marks, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r.quality: r.k for r in got.collect()}
    assert share[1] > 0.97 and share[0] < 0.5


def test_quality_rejects_junk(spark):
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = quality_scores(docs, marks).join(marks, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r.quality: r.k for r in got.collect()}
    assert share[1] > 0.97 and share[0] < 0.05


def test_gram_types_of_many_letters():
    from rollcall.llm.quality import ORDER, START, gram_types
    rng = random.Random(8)
    some = ["".join(chr(rng.randrange(0x4E00, 0x1F000)) for _ in range(9000)), "", "abcabcabcab", "ab"]
    types, of, starts = gram_types(some)
    for t, at in zip(some, starts):
        padded = START * (ORDER - 1) + t
        assert [types[i] for i in of[at:at + len(t)]] == [padded[i:i + ORDER] for i in range(len(t))]
    assert len(set(types)) == len(types)


def test_kneser_ney_sums_to_one(spark):
    from rollcall.llm.quality import log_probabilities
    counts = {"abc": 3, "abd": 1, "bcd": 2, "cda": 1, "dab": 4, "bca": 1}
    chars = sorted({g[-1] for g in counts})
    wanted = spark.createDataFrame([("ab" + c,) for c in chars] + [("ab?",)], "gram string")
    logs = {r.gram: math.exp(r.log_p) for r in log_probabilities(wanted, spark.createDataFrame(list(counts.items()), "gram string, n long")).collect()}
    assert abs(sum(logs.values()) - 1) < 1e-9 and logs["abc"] > logs["abd"] > logs["aba"]


def luhn(n):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(n)))) % 10 == 0


def personal(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(v) < 256 for v in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        n = re.sub("[^0-9]", "", m[0])
        out += [("card", *m.span())] * (16 <= len(n) <= 19 and luhn(n))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(map(str.isdigit, m[0])) <= 15]


def test_personal_data_base_spans(spark):
    rng = random.Random(9)
    rows = list(texts(spark).items()) + [(10000 + i, "".join(rng.choice("ab1234.@+ -()%_5") for _ in range(120))) for i in range(300)]
    rows += [(20000, "a@b.c_d@e.f g@h..i 1.2.3.4.5 300.1.1.1 0001.002.3.255 4111 1111-1111 1111 +1 (23) 456-7890-"), (20001, "a" * 50000 + "@")]
    got = {r.doc_id: r for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        base = personal(t)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert got[i].base_sha256 == sha(text), t
        assert got[i].spans == text or got[i].spans.startswith(text)


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_topk_exact(spark, scale):
    rng = np.random.RandomState(4)
    x = np.round(rng.randn(300, 8) * scale, 1)
    x[50:90] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (420, [float("nan")] * 8), (440, [1.0, None] * 4), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("clash"))
    got = {}
    for r in maxscore_topk(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    w = np.floor(64 * x).astype(np.int64)
    assert sorted(got) == list(range(0, 300, 20))
    for q in got:
        s = w @ w[q]
        best = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        assert sorted(got[q]) == [(k + 1, i, s[i]) for k, i in enumerate(best)]
    assert maxscore_topk(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bpe_matches_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(1)
    rows = list(texts(spark).items()) + list(enumerate(
        ["<|endoftext|>a<|startoftext|> b", "ΣΑΣ ΟΔΟΣ", "a" * 500, "it's I'LL 12.5", None, ""]
        + ["".join(rng.choice("abé'0! ") for _ in range(30)) for _ in range(300)], 10000))
    for r in bpe_encode(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer_path(), keep_ids=True).collect():
        ids = lib.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == sha(lib.decode(ids, skip_special_tokens=False))


def test_bpe_pairs_are_exact():
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        b = WordBPE(f.read())
    rng = np.random.RandomState(2)
    x, y = rng.randint(0, 49000, 3000), rng.randint(0, 49000, 3000)
    plain = [i for i in range(3000) if not b.token[x[i]].endswith("</w>")]
    units = lambda t: [int(b.unit[c]) for c in map(b.byte.index, t.removesuffix("</w>"))][:-1] + [
        int(b.unit[256 * t.endswith("</w>") + b.byte.index(t.removesuffix("</w>")[-1])])]
    for i, good in zip(plain, b.compatible(x[plain], y[plain])):
        assert good == (b.merge(units(b.token[x[i]]) + units(b.token[y[i]])) == [x[i], y[i]])


def test_language_held_out(spark):
    got = queries.op7_language_crf(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    rows = got.select("doc_id", "held_out", "lang_pred", "lang", "score").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held) >= 0.98 * len(held)


def test_language_learns_from_copies(spark):
    from rollcall.llm.language_crf import training_rows
    rows = [(f"l{k}", f"word{'abcdefghij'[k % 10] * (k + 1)} text {'vwxyz'[i]}") for k in range(20) for i in range(5)]
    many = spark.createDataFrame(rows, "lang string, text string").crossJoin(spark.range(400)).select("lang", "text")
    digits = spark.range(3000).select(F.lit("l0").alias("lang"), F.col("id").cast("string").alias("text"))
    assert sorted(map(tuple, training_rows(many.unionByName(digits)).collect())) == sorted(rows)


def test_language_without_letters(spark):
    docs = spark.createDataFrame([(1, "123 !!"), (2, None)], "doc_id long, text string")
    learn = spark.createDataFrame([("en", "the of and with"), ("de", "der und mit von")] * 3, "lang string, text string")
    assert {(r.lang_pred, r.score) for r in identify_language(docs, learn).collect()} == {("und", 0.0)}


def test_mixture_meets_targets(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_mixing(spark, sf)
    tokens = got.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}")).alias(d) for d in queries.TARGETS]).first().asDict()
    for d, w in queries.TARGETS.items():
        assert abs(tokens[d] / sum(tokens.values()) - w) < 0.01
    assert got.filter("rate < 0 or copies < 0").count() == 0


def test_merkle_edit_of_the_next_document(spark):
    merkle_size, merkle.BUCKET_CHARS = merkle.BUCKET_CHARS, 20_000
    try:
        got = {r.doc_id: r for r in queries.op9_merkle(spark, SF).collect()}
    finally:
        merkle.BUCKET_CHARS = merkle_size
    t = texts(spark)
    order = sorted(t, reverse=True)
    for i, d in enumerate(order):
        cut = len(t[d]) // 3
        changed = t[d][:len(t[d]) - cut] + t[order[(i + 1) % len(order)]][:cut]
        assert got[d].edited_sha256 == sha(changed) and got[d].n_chars == len(t[d])
        assert (got[d].near_edited == 1) == (changed == t[d]) and 0 <= got[d].near_next <= 1
    assert len({r.fingerprint for r in got.values()}) == len(set(t.values()))


def test_merkle_locates_edits(spark):
    a = "\n".join(f"line {i} with some words" for i in range(200)) + "\n"
    b = a.replace("line 100 ", "line one hundred ")
    p, q = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    r = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.changed_sections(p, q).alias("c"), merkle.changed_sections(p, p).alias("same"), merkle.likeness(p, q).alias("l")).first()
    assert 1 <= len(r.c) <= 2 and r.same == [] and 0.95 < r.l < 1


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, width, percent):
    rng = random.Random(width)
    base = [rng.choice("abcdefghij") * 2 + str(rng.randint(0, 99)) for _ in range(120)]
    rows = list(texts(spark).items())
    for k in range(80):                                       # near copies of one text, some chained
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 9)}"
        rows.append((10000 + k, " ".join(w)))
    rows += [(20000, "two words"), (20001, "Two  WORDS"), (20002, ""), (20003, None)]
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).collect():
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == find(r.doc_id) and r.kept == (r.doc_id == r.component_id)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_components_of_stars_take_no_step(spark):
    folder = shared_dir(spark).removeprefix("file:")
    stars = spark.createDataFrame([(1, 5), (6, 1), (2, 3), (3, 2)], "a long, b long")
    before = set(os.listdir(folder))
    assert {tuple(r) for r in components(stars).collect()} == {(1, 1), (5, 1), (6, 1), (2, 2), (3, 2)}
    new = set(os.listdir(folder)) - before
    assert not any("star" in n for n in new) and not any("_SUCCESS" in os.listdir(f"{folder}/{n}") for n in new)
    # a node between two centres, a chain, a ring
    for edges in ([(1, 3), (2, 3)], [(1, 2), (2, 3), (3, 4)], [(2, 1), (3, 2), (1, 3), (1, 1)]):
        got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {(x, 1) for e in edges for x in e}
    assert components(stars.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "secret scan":
            assert all(not base_spans(r.text) for r in rows)
        docs = spark.createDataFrame(rows, out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() > 0
    assert "pipeline" in entry.queries()


def saved(df, tmp_dir, name):
    df.write.parquet(f"{tmp_dir}/{name}.parquet")
    return table(df.sparkSession, tmp_dir, name)


def test_mixing_stage_reaches_the_targets(spark, tmp_dir):
    import corpus_pipeline

    rng = random.Random(6)
    word = {d: [f"{d}{i}" for i in range(40)] for d in ("clean", "toxic", "junk")}
    kind = ["toxic"] * 20 + ["junk"] * 10 + ["clean"] * 1970                  # 1 % and 0.5 % against 5 % and 3 %
    docs = spark.createDataFrame([(i, " ".join(rng.choices(word[k], k=30)), "en", "s", 0) for i, k in enumerate(kind)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    saved(spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kind)],
                                "doc_id long, quality int, toxic int"), tmp_dir, "labels")
    n = {k: 0 for k in word}
    for r in corpus_pipeline.mixture(spark, docs, tmp_dir).collect():
        n[kind[r.doc_id]] += 1
    assert n["clean"] == 1970
    for d, w in queries.TARGETS.items():
        assert abs(n[d] / sum(n.values()) - w) < 0.01, n


def test_pipeline_decides_by_row(spark, tmp_dir):
    import corpus_pipeline

    a = " ".join(f"alpha{i}" for i in range(60))
    b = " ".join(f"beta{i}" for i in range(60))
    rows = [(1, a), (1, a), (2, a + " more"), (1, b), (None, b + " more"), (None, "key token=abcdefgh99 end"), (3, "other words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_dedup(spark, docs, tmp_dir)
    assert sorted(r.text for r in left.collect()) == sorted([a, b, "key token=abcdefgh99 end", "other words"])
    assert all("abcdefgh99" not in r.text for r in corpus_pipeline.secrets(spark, left, tmp_dir).collect())


def test_pipeline_rejects_junk_of_any_id(spark, tmp_dir):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    marks = saved(table(spark, sf, "labels"), tmp_dir, "labels")
    docs = table(spark, sf, "documents")
    junk = docs.join(marks.filter("quality = 0"), "doc_id", "left_semi")
    other = docs.join(marks, "doc_id", "left_anti").first().doc_id         # an unlabelled one
    more = docs.unionByName(junk.withColumn("doc_id", F.lit(None).cast("long"))).unionByName(junk.withColumn("doc_id", F.lit(other)))
    left = corpus_pipeline.quality(spark, more, tmp_dir)
    assert left.filter(F.col("doc_id").isNull()).count() <= 0.1 * junk.count()
    assert left.filter(F.col("doc_id") == other).count() <= 1 + 0.1 * junk.count()
