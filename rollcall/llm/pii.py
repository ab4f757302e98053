"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select.

Base spans (e-mail, IP address, payment card, phone number) follow fixed
patterns and are always kept. High-recall generators also propose looser,
overlapping spans: mail-like, number groups, dotted numbers, long digit runs.
Each proposal gets features of its format and of the text around it; gradient
boosted trees, fitted on a bounded sample of proposals that are labelled by
whether a base span confirms them, score it. A generator's threshold is the
lowest at which held-out proposals reach the asked precision. Proposals above
it that touch no base span are added as ``likely``.

All of it is DataFrame and SQL functions, the trees included: they are written
out as nested conditions, so scoring needs no join. Texts are read once; the
spans found go to a written table.

Patterns are anchored at the first character of a run and possessive, so that
a long run of letters or digits costs one look at each character.

Defined cases: a null text is empty; rows with equal ids are separate rows; an
empty table gives an empty result; without confirmed and unconfirmed proposals
there are no trees and nothing is added; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.store import pick, written

KINDS = ("email", "ip", "card", "phone")
ADDED = "likely"
# fixed patterns of the base spans, anchored where a run of their first characters begins
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "mail": r"(?<![^\s<>(){},;:\"'])[^\s<>(){},;:\"'@]++ ?(?:@|\(at\)|\[at\]) ?[^\s<>(){},;:\"'@]++",
    "groups": r"(?<![0-9])\+?\(?[0-9]++(?:[ ().\-/]{1,3}[0-9]++){2,}+",
    "dotted": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+",
    "digits": r"(?<![0-9])[0-9]{9,}+",
}
CUES = {"cue_phone": "(?i)tel|phone|call|fax|mobil", "cue_mail": "(?i)mail|contact|write", "cue_ip": r"(?i)\bip\b|host|server|addr",
        "cue_card": "(?i)card|visa|account|iban|pay"}
CONTEXT = 24
SAMPLE = 6000             # proposals that the trees are fitted on, by hash
TREES, DEPTH = 12, 3
PRECISION = 0.98
SUPPORT = 20              # held-out proposals that a threshold needs at least
HELD = 4                  # one proposal in so many calibrates


def empty(kind: str) -> Column:
    return F.array().cast(kind)


SPAN = "array<struct<s:int,e:int,v:string>>"


def located(text: Column, pattern: str, gate: Column) -> Column:
    """Leftmost non-overlapping matches as (s, e, v), where ``gate`` holds.

    Positions are running sums of the lengths of the matches and of the text between them.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    walk = F.aggregate(
        F.arrays_zip(between.alias("gap"), hits.alias("v")),
        F.struct(F.lit(0).alias("at"), empty(SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(F.length(x["v"]), F.lit(0))).alias("at"),
            F.concat(acc["out"], F.when(x["v"].isNotNull(), F.array(F.struct(
                (acc["at"] + x["gap"]).alias("s"), (acc["at"] + x["gap"] + F.length(x["v"])).alias("e"),
                x["v"].alias("v")))).otherwise(empty(SPAN))).alias("out")))
    return F.when(gate, walk["out"]).otherwise(empty(SPAN))


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a digit string holds."""
    def weight(acc: Column, i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), weight)
    return F.when(F.length(number) > 0, total % 10 == 0).otherwise(F.lit(False))


def valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        n = F.length(digits(v))
        return F.when((n >= 16) & (n <= 19), luhn(digits(v))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(v)).between(8, 15)
    return F.lit(True)


def features(text: Column, g: Column, s: Column, e: Column, v: Column) -> dict[str, Column]:
    """Format of a proposal and the text around it, as numbers."""
    before = F.substring(text, F.greatest(s - CONTEXT, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT)))
    after = F.substring(text, e + 1, F.lit(1))
    groups = F.filter(F.split(v, "[^0-9]+", -1), lambda x: x != "")
    sizes = F.transform(groups, lambda x: F.length(x))
    number = digits(v)
    out = {f"is_{name}": g == name for name in GENERATORS}
    out |= {
        "length": F.length(v), "n_digits": F.length(number), "n_groups": F.size(groups),
        "max_group": F.coalesce(F.array_max(sizes), F.lit(0)), "min_group": F.coalesce(F.array_min(sizes), F.lit(0)),
        "n_dots": F.length(v) - F.length(F.replace(v, F.lit("."), F.lit(""))),
        "n_blanks": F.length(v) - F.length(F.replace(v, F.lit(" "), F.lit(""))),
        "n_dashes": F.length(v) - F.length(F.replace(v, F.lit("-"), F.lit(""))),
        "has_plus": v.contains("+") | F.endswith(before, F.lit("+")), "has_paren": v.contains("("), "has_at": v.contains("@"),
        "dot_after_at": F.rlike(v, F.lit(r"@[^.]+\.")),
        "largest_is_byte": F.coalesce(F.forall(groups, lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False))), F.lit(False)),
        "luhn": F.when(F.length(number).between(12, 19), luhn(number)).otherwise(F.lit(False)),
        "word_before": F.rlike(before, F.lit("[A-Za-z0-9]$")), "word_after": F.rlike(after, F.lit("^[A-Za-z0-9]")),
    }
    out |= {name: F.rlike(before, F.lit(cue)) for name, cue in CUES.items()}
    return {k: c.cast("double") for k, c in out.items()}


NAMES = [f"is_{g}" for g in GENERATORS] + ["length", "n_digits", "n_groups", "max_group", "min_group", "n_dots", "n_blanks",
                                           "n_dashes", "has_plus", "has_paren", "has_at", "dot_after_at", "largest_is_byte",
                                           "luhn", "word_before", "word_after", *CUES]


def proposals(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): base spans by kind, and proposals with features and label."""
    text = F.col("text")
    has_digit, has_at = F.col("has_digit"), F.contains(text, F.lit("@"))
    gates = {"email": has_at, "ip": has_digit & F.contains(text, F.lit(".")), "card": has_digit, "phone": F.contains(text, F.lit("+")),
             "mail": has_at | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]")),
             "groups": has_digit, "dotted": has_digit & F.contains(text, F.lit(".")), "digits": has_digit}
    df = docs.withColumn("has_digit", F.rlike(text, F.lit("[0-9]")))

    def confirmed(kind: str) -> Column:
        return F.filter(located(text, PATTERNS[kind], gates[kind]), lambda x: valid(kind, x["v"]))

    def proposed(g: str) -> Column:
        return F.transform(located(text, GENERATORS[g], gates[g]), lambda x: F.struct(
            F.lit(g).alias("g"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")))

    df = df.withColumns({k: confirmed(k) for k in KINDS})
    df = df.withColumns({f"g_{g}": proposed(g) for g in GENERATORS})
    df = df.withColumn("base", F.concat(*[F.col(k) for k in KINDS]))

    def judged(x: Column) -> Column:
        f = features(text, x["g"], x["s"], x["e"], x["v"])
        touched = F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return F.struct(x["g"].alias("g"), x["s"].alias("s"), x["e"].alias("e"), touched.alias("touched"),
                        F.array(*[f[n] for n in NAMES]).alias("f"))

    bare = lambda k: F.transform(F.col(k), lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e")))
    return df.select("doc_id", *[bare(k).alias(k) for k in KINDS],
                     F.transform(F.concat(*[F.col(f"g_{g}") for g in GENERATORS]), judged).alias("proposed"))


def tree_column(text: str, f) -> Column:
    """One regression tree, as MLlib prints it, as nested conditions over ``f(index)``."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(i: int) -> tuple[Column, int]:
        if lines[i].startswith("Predict"):
            return F.lit(float(lines[i].split(":")[1])), i + 1
        m = re.match(r"If \(feature (\d+) (<=|in) (.*)\)", lines[i])
        cond = f(int(m[1])) <= float(m[3])
        yes, i = node(i + 1)
        no, i = node(i + 1)          # the Else line
        return F.when(cond, yes).otherwise(no), i

    return node(0)[0]


def boosted(labelled: DataFrame):
    """A function from a feature lookup to the trees' score, fitted on (f, label) rows; None without both labels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    seen = {r.label for r in labelled.select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, stepSize=0.3).fit(
        labelled.select(array_to_vector("f").alias("features"), "label"))
    trees = [t.toDebugString for t in model.trees]
    weights = list(model.treeWeights)

    def score(f) -> Column:
        total = F.lit(0.0)
        for w, t in zip(weights, trees):
            total = total + F.lit(float(w)) * tree_column(t, f)
        return total
    return score


def thresholds(held: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> dict[str, float]:
    """Per generator the lowest score from which held-out (g, score, label) rows are precise enough."""
    step = 0.05
    bins = held.groupBy("g", F.floor(F.col("score") / step).alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("hits")).collect()
    out = {}
    for g in {r.g for r in bins}:
        n = hits = 0
        for r in sorted((r for r in bins if r.g == g), key=lambda r: -r.bin):
            n, hits = n + r.n, hits + r.hits
            if n >= support and hits >= precision * n:
                out[g] = r.bin * step
    return out


def personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    base = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"),
                                               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = written(proposals(base), "personal-data")
    each = found.filter(F.size("proposed") > 0).select("doc_id", F.explode("proposed").alias("p")).select(
        "p.g", "p.f", F.col("p.touched").cast("double").alias("label"), F.xxhash64("p.f", "p.s", "doc_id").alias("h"))
    fold = F.pmod("h", F.lit(HELD)) == 0
    score = boosted(written(each.filter(~fold).orderBy("h").limit(sample), "sample"))
    least = {}
    if score is not None:
        least = thresholds(each.filter(fold).withColumn("score", score(lambda i: F.col("f")[i])))
    if least:
        def selected(p: Column) -> Column:
            bar = F.lit(float("inf"))
            for g, t in sorted(least.items()):
                bar = F.when(p["g"] == g, F.lit(t)).otherwise(bar)
            return ~p["touched"] & (score(lambda i: p["f"][i]) >= bar)
        added = F.array_sort(F.array_distinct(F.transform(F.filter("proposed", selected), lambda p: F.struct(
            p["s"].alias("s"), p["e"].alias("e")))))
    else:
        added = empty("array<struct<s:int,e:int>>")
    shown = lambda k, spans: F.transform(spans, lambda b: F.concat_ws(":", F.lit(k), b["s"], b["e"]))
    out = found.withColumn("added", added)
    kept = F.concat(*[shown(k, F.col(k)) for k in KINDS])
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.array_join(kept, ",").cast("binary"), 256).alias("base_sha256"),
                      F.array_join(F.concat(kept, shown(ADDED, F.col("added"))), ",").alias("spans"),
                      F.size("added").cast("long").alias("n_added"))
