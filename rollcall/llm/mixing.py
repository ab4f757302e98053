"""Soft-membership mixing: document rates under which expected domain tokens meet target weights.

A classifier fitted on a labelled table gives every document a posterior over
domains (sparse multinomial logistic regression on hashed words, JVM side). A second
one, on the first one's log-posteriors of labelled documents held out from it,
calibrates them: its intercepts make the expected number of documents of
each domain that of the documents so labelled. Rates r
then solve a nonnegative least squares problem by projected gradient steps:

    minimise  1/2 sum_d (sum_i n_i p_id r_i / T - w_d)^2 / s_d
            + mu/2 sum_i (n_i / T) (r_i - 1)^2      subject to r >= 0

with n_i tokens, posteriors p_id, targets w_d, present shares s_d. The steps
are scaled by n_i / T, so that one's rate depends on its posterior alone. A
step needs the residuals of the domains only: one grouped sum over the table of
posteriors, a handful of numbers to the driver. Nothing else is moved.

Everything is DataFrame, SQL and MLlib functions. Defined cases: a null or
empty text has no tokens, gets the posterior of no words and a rate like any
other; labels that are null or name no target domain, and labels of documents that
are not there, teach nothing; with fewer
than two labelled domains every posterior is even; where a domain has too few labelled
documents to hold some out, the same ones fit and calibrate; a domain without expected
tokens gets none; targets that can't be met (the anchor's own documents hold more of a domain
than its target) are come as near to as the rates allow, and ``reached`` says how near; a null id gets a rate too; rows with equal ids are rated one
by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import pick, written

BUCKETS = 1 << 14
SPARSE = 0.003            # weight of the penalty that leaves the classifier with the words that tell
SAMPLE = 2000             # labelled documents of each domain that the classifiers are fitted on, by hash
HELD_OUT = 4              # one of so many of them calibrates
MU = 1e-4
STEPS = 60                # of accelerated gradient steps; they end as soon as all shares are CLOSE
CLOSE = 2e-3              # largest share of its target that a domain may miss


def words(text: Column) -> Column:
    return F.split(F.btrim(F.coalesce(text, F.lit(""))), r"\s+")


def features(text: Column) -> Column:
    """What the classifier sees: words with all their marks, and runs of letters."""
    low = F.lower(F.btrim(F.coalesce(text, F.lit(""))))
    return F.concat(F.split(low, r"\s+"), F.split(low, r"[^\p{L}]+"))


def chosen_ids(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int) -> DataFrame:
    """(id, domain, weight): up to ``sample`` documents of each domain, of those that are there, by the smallest hashes.

    ``weight`` is how many labelled documents of the domain one stands for. A domain's
    hashes are thinned to about twice the sample before they are ranked.
    """
    # of every labelled id one domain; those with two teach nothing
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id") \
        .agg(F.min("domain").alias("domain"), F.max("domain").alias("other")).filter("domain = other")
    there = written(known.select(F.col("doc_id").alias("id"), "domain", F.xxhash64("doc_id").alias("h"))
                    .join(docs.select("doc_id"), F.col("id") == F.col("doc_id"), "left_semi"), "labelled-ids")
    size = there.groupBy("domain").agg(F.count("*").alias("n"))              # a row for each domain
    scale = 1 << 30
    thin = there.join(F.broadcast(size), "domain").filter(
        F.pmod("h", F.lit(scale)) * F.col("n") <= F.lit(2.0 * sample * scale))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy("h", "id"))
    some = thin.withColumn("r", rank).filter(F.col("r") <= sample)
    return some.withColumn("weight", F.col("n") / F.count("*").over(Window.partitionBy("domain"))).select("id", "domain", "weight")


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text_hash, n_tokens, p) of every row of ``docs`` (doc_id, text); ``labelled`` is (doc_id, domain)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import array_to_vector, vector_to_array

    tokens = F.when(F.btrim(F.coalesce("text", F.lit(""))) == "", F.lit(0)).otherwise(F.size(words(F.col("text")))).cast("long")
    split = docs.withColumn("words", words(F.col("text"))).withColumn("text_hash", F.xxhash64("text")).withColumn("n_tokens", tokens)
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=BUCKETS, binary=True)
    code = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    chosen = chosen_ids(docs, labelled, domains, sample)
    train = written(split.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))      # `sample` rows a domain at most
                    .select("words", code.cast("double").alias("label"), "weight",
                            (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(HELD_OUT)) == 0).alias("held")), "labelled")
    found = {(r.label, r.held) for r in train.select("label", "held").distinct().collect()}
    classes = {label for label, _ in found}
    if len(classes) < 2:
        return split.select("doc_id", "text_hash", "n_tokens", F.array(*[F.lit(1.0 / len(domains))] * len(domains)).alias("p"))

    def padded(model) -> Column:
        # a model knows classes up to the last one labelled
        return F.concat(vector_to_array("probability"),
                        F.array(*[F.lit(0.0)] * (len(domains) - model.numClasses)).cast("array<double>"))

    parted = len(found) == 2 * len(classes)
    model = LogisticRegression(maxIter=50, regParam=SPARSE, elasticNetParam=1.0, family="multinomial").fit(
        hashed.transform(train.filter("not held") if parted else train).select("features", "label"))
    odds = array_to_vector(F.transform(F.col("p"), lambda x: F.log(x + 1e-9)))

    def first(rows: DataFrame) -> DataFrame:
        return model.transform(hashed.transform(rows)).withColumn("p", padded(model)) \
            .drop("features", "rawPrediction", "probability", "prediction").withColumn("features", odds)

    second = LogisticRegression(maxIter=100, regParam=1e-4, family="multinomial", weightCol="weight").fit(
        first(train.filter("held") if parted else train).select("features", "label", "weight"))
    return second.transform(first(split)).select("doc_id", "text_hash", "n_tokens", padded(second).alias("p"))


def target_total(have: list[float], weights: list[float], anchor: int | None) -> float:
    """Tokens of the mixture: as many as present, or those with which the anchor domain stays whole."""
    return sum(have) if anchor is None or not weights[anchor] else have[anchor] / weights[anchor]


def rates(rated: DataFrame, weights: list[float], anchor: int | None = None, most: float = float("inf")) -> tuple[Column, list[float]]:
    """(rate as an expression over n_tokens and p, achieved shares), by projected gradient steps.

    Documents judged to be of the anchor domain keep rate 1 and count as that domain's; the
    mixture's size follows the anchor's tokens as the other rates change.
    """
    k = range(len(weights))
    held = F.lit(False) if anchor is None else F.array_position("p", F.array_max("p")) == anchor + 1
    free = rated.filter(~held)
    first = list(free.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[d]), F.lit(0.0)) for d in k]).first())
    kept = float(rated.filter(held).agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0])
    have = [f + (kept if d == anchor else 0.0) for d, f in enumerate(first)]
    total = target_total(have, weights, anchor)
    if not sum(have) or not total:
        return F.lit(1.0), [0.0] * len(weights)
    share = [max(h / total, 1e-12) for h in have]
    gram = free.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[a] * F.col("p")[b]), F.lit(0.0)) for a in k for b in k]).first()
    rows = [[gram[a * len(weights) + b] / total / (share[a] * share[b]) ** 0.5 for b in k] for a in k]
    step = 1 / (float(np.linalg.eigvalsh(np.array(rows)).max()) + MU)
    pulls: list[list[float]] = []              # of each step, a factor for each posterior, its momentum and the next one's

    def state() -> Column:
        # (rate, rate before, momentum) after the steps so far: one loop over them, so the expression doesn't grow.
        # What differs between steps is in the array alone: the code is compiled once, not again for each step
        begin = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("before"), F.lit(0.0).alias("ahead"))
        if not pulls:
            return begin
        return F.aggregate(F.array(*[F.array(*map(F.lit, c)) for c in pulls]), begin, lambda s, c: F.struct(
            F.least(F.lit(most), F.greatest(F.lit(0.0), F.lit(1 - step * MU) * (s["r"] + c[len(weights)] * (s["r"] - s["before"]))
                    + sum((c[d] * F.col("p")[d] for d in k), F.lit(step * MU)))).alias("r"), s["r"].alias("before"),
            c[len(weights) + 1].alias("ahead")))

    def shares(sums: list[float]) -> list[float]:
        got = [h - f + g for h, f, g in zip(have, first, sums)]
        whole = target_total(have if anchor is None else got, weights, anchor)
        return [g / whole for g in got]

    for t in range(STEPS + 1):
        # momentum, t / (t + 3): the gradient is taken where the last two steps point
        at = free.withColumn("s", state()).select("n_tokens", "p", F.col("s.r").alias("r"), (
            F.col("s.r") + F.col("s.ahead") * (F.col("s.r") - F.col("s.before"))).alias("y"))
        sums = at.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[d] * F.col(c)), F.lit(0.0)) for c in "ry" for d in k]).first()
        reached = shares(sums[:len(weights)])
        if t == STEPS or all(abs(g - w) <= CLOSE * w or h <= 0 for g, w, h in zip(reached, weights, have)):
            break
        pulls.append([-step * (g - w) / s if h > 0 else 0.0 for g, w, s, h in zip(
            shares(sums[len(weights):]), weights, share, have)] + [t / (t + 3), (t + 1) / (t + 4)])
    return F.when(held, 1.0).otherwise(state()["r"]), reached


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str | None = None,
        most: float = float("inf")) -> DataFrame:
    """doc_id, n_tokens, domain, p_<domain>..., rate, copies, reached, text_hash of every row.

    ``targets`` gives each domain's share of the mixture's tokens; ``anchor``
    names the domain whose documents all stay once and whose tokens fix the
    mixture's size. ``copies`` rounds the rate by a hash of id and text, so its
    mean is the rate. No rate is above ``most``, so that a domain of which little is left is not
    repeated without end. ``reached`` is the share of the mixture's expected tokens that the
    row's domain has under the rates.
    """
    domains = sorted(targets)
    weights = [targets[d] / sum(targets.values()) for d in domains]
    base = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated = written(posteriors(base, pick(labelled, "doc_id", "domain"), domains), "posteriors")
    r, shares = rates(rated, weights, domains.index(anchor) if anchor else None, most)
    out = rated.withColumn("rate", r)
    chance = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 20)) / float(1 << 20)
    at = F.array_position("p", F.array_max("p")).cast("int")
    best, reached = (F.element_at(F.array(*map(F.lit, x)), at) for x in (domains, shares))
    return out.select("doc_id", "n_tokens", best.alias("domain"), *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
                      "rate", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"),
                      reached.alias("reached"), "text_hash")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of quality and toxicity marks: junk, toxic or clean; null marks give none."""
    return pick(labels, "doc_id", "quality", "toxic").select(F.col("doc_id").cast("long"), F.when(F.col("quality") == 0, "junk").when(
        F.col("toxic") == 1, "toxic").when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))
