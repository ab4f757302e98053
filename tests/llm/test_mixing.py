"""Mixing: no domain is lost, shares hold by label, rare domains and absent documents in the labels."""

import random

from pyspark.sql import functions as F

from rollcall.llm import queries
from rollcall.llm.mixing import STEPS, chosen_ids, label_domains, mix, rates
from rollcall.llm.store import table

SF = "/root/testdata/sf0.01"


def test_anchored_mixture_keeps_every_domain(spark):
    domains = label_domains(table(spark, SF, "labels")).filter("domain IS NOT NULL")
    got = mix(table(spark, SF, "documents"), domains, queries.TARGETS, anchor="clean")
    got = got.join(domains.withColumnRenamed("domain", "label"), "doc_id").groupBy("label").agg(
        F.sum(F.col("n_tokens") * F.col("rate")).alias("tokens"), F.sum("copies").alias("copies"), F.count("*").alias("docs"),
        F.sum((F.col("copies") == 0).cast("int")).alias("gone")).collect()
    total = sum(r.tokens for r in got)
    for r in got:
        assert abs(r.tokens / total - queries.TARGETS[r.label]) < 0.03 and r.copies > 0, r
        assert r.label != "clean" or r.gone <= 0.02 * r.docs


def corpus(spark, n=900):
    rng = random.Random(2)
    kinds = ["toxic" if i % 150 == 0 else "junk" if i % 10 == 1 else "clean" for i in range(n)]
    docs = [(i, " ".join(rng.choices([f"{k}{j}" for j in range(30)] + ["the", "of", "and"] * 10, k=40))) for i, k in enumerate(kinds)]
    return kinds, spark.createDataFrame(docs, "doc_id long, text string")


def test_rare_domains_and_labels_of_absent_documents(spark):
    kinds, docs = corpus(spark)
    absent = [(10 ** 6 + i, "clean") for i in range(6000)]
    labelled = spark.createDataFrame(list(enumerate(kinds)) + absent + [(0, "junk"), (1, None), (None, "toxic")], "doc_id long, domain string")
    some = chosen_ids(docs, labelled, ["clean", "junk", "toxic"], 20).collect()
    by = {d: [r for r in some if r.domain == d] for d in ("clean", "junk", "toxic")}
    # doc 0 has two domains, doc 1 one that is null besides its own; six of each 900 are toxic
    assert [len(by[d]) for d in ("clean", "junk", "toxic")] == [20, 20, 5] and all(r.id < 10 ** 6 for r in some)
    assert abs(sum(r.weight for r in by["clean"]) - kinds.count("clean")) < 1e-6
    got = {r.doc_id: r for r in mix(docs, labelled, {"clean": 0.7, "junk": 0.2, "toxic": 0.1}).collect()}
    assert sum(got[i].domain == k for i, k in enumerate(kinds)) > 0.97 * len(kinds)
    assert all(abs(r.reached - {"clean": 0.7, "junk": 0.2, "toxic": 0.1}[r.domain]) < 0.005 for r in got.values())


def test_a_target_out_of_reach_is_told(spark):
    kinds, docs = corpus(spark)
    labelled = spark.createDataFrame([(i, k) for i, k in enumerate(kinds) if k != "toxic"], "doc_id long, domain string")
    got = mix(docs, labelled, {"clean": 0.5, "junk": 0.3, "toxic": 0.2}).select("domain", "reached").distinct().collect()
    reached = {r.domain: r.reached for r in got}
    # nothing is known of toxic, so it gets none; the others meet their targets all the same
    assert set(reached) == {"clean", "junk"} and abs(reached["clean"] - 0.5) < 0.005 and abs(reached["junk"] - 0.3) < 0.005


def test_steps_compile_no_code_of_their_own(spark):
    rows = [(10 + i % 7, [0.1 + 0.8 * (i % 5) / 4, 0.9 - 0.8 * (i % 5) / 4]) for i in range(200)]
    rated = spark.createDataFrame(rows, "n_tokens long, p array<double>")
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    before = compiled.getCount()
    # out of reach, as no rate is above 1: all steps are taken
    rate, reached = rates(rated, [0.05, 0.95], most=1.0)
    assert compiled.getCount() - before < STEPS / 2
    assert abs(reached[0] - 0.05) > 0.01 and all(0 <= r.r <= 1 for r in rated.select(rate.alias("r")).collect())
