"""Secret scan: probabilistic automata inferred from labelled credentials.

A first pass over the texts finds the base matches (fixed patterns) and one
ordinary token of each document. From a bounded sample of the labelled
credentials (the base matches, or a table the caller gives) a prefix tree per
kind is folded into a probabilistic automaton: states are merged while their
outgoing frequencies agree within a Hoeffding bound. The ordinary tokens give
one more automaton, for contrast. A second pass scores every other token of
each whole text that is at least as long as the shortest labelled credential,
by all of its symbols. It is added as a span if it is as likely as the held-out
credentials of a kind, and if the odds are for a credential: the ratio of the
two likelihoods against how rare credentials are among the tokens of all documents.

What an assignment shows to be a credential (the value, without the words
before it) is thus found where it stands bare. A token that a document repeats is a span
at each place.

Defined cases: a null text is empty and has no spans; rows with equal ids are
separate rows; an empty table gives an empty result; without any labelled
credential nothing is added; labels that are null or empty teach nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.store import pick, releasing, ship_code, written

BASE_KINDS = ("assign", "access", "hex")
ADDED = "format"
PLAIN = "plain"
# fixed patterns of the base spans
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
    r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# a token: no mark of punctuation that may end a sentence at its ends
TOKEN = re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_=-])?")

SHORTEST = 6          # symbols of a credential; labelled ones that are longer raise it
SAMPLE = 600          # labelled credentials per kind that an automaton is fitted on
CONTRAST = 6000       # ordinary tokens that the contrast automaton is fitted on
LEARNT = 1024         # labelled values with more symbols don't teach; candidates of any length are scored whole
ALPHA = 0.05
FLOOR = 1e-4
QUANTILE = 0.02       # share of held-out credentials that may fall below a threshold
ODDS = 99.0           # for a credential, that a span needs
KNOWN = 200_000       # decisions on tokens that a worker remembers

LABELS_DDL = "kind string, value string, n long, h long"
LABELS = pa.schema([("kind", pa.string()), ("value", pa.string()), ("n", pa.int64()), ("h", pa.int64())])


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the base patterns; code points, end exclusive."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]


def apart(spans: Iterator[re.Match], taken: list[tuple[int, int]]) -> Iterator[re.Match]:
    """Matches, in order, that touch no span of ``taken``; one walk along both."""
    taken = sorted(taken)
    i, reach = 0, 0                       # the furthest end of what begins before the match ends
    for m in spans:
        while i < len(taken) and taken[i][0] < m.end():
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= m.start():
            yield m


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Credentials of base matches; of each text one ordinary token and, beside it, how many there are."""
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text or "")
            rows += [(k, v, 1, 0) for k, _, _, v in spans]
            tokens = [m[0] for m in apart(TOKEN.finditer(text or ""), [s[1:3] for s in spans]) if m.end() - m.start() >= SHORTEST]
            if tokens:
                h = zlib.crc32(text.encode("utf-8", "replace"))
                rows.append((PLAIN, tokens[h % len(tokens)], len(tokens), h))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else ((),) * 4, LABELS)],
                                         schema=LABELS)


def symbols(value: str) -> str:
    """Character classes: hex and other letters apart, by case; digits; the rest as they are."""
    return "".join("9" if c.isdigit() else "f" if "a" <= c <= "f" else "z" if "g" <= c <= "z"
                   else "F" if "A" <= c <= "F" else "Z" if "G" <= c <= "Z" else c for c in value)


class Automaton:
    """States as (visits, ends, {symbol: [visits, next state]}), state 0 first."""

    def __init__(self, states: list):
        self.states = states

    @classmethod
    def infer(cls, values: list[str], alpha: float = ALPHA) -> "Automaton":
        """Prefix tree of the values, states merged in red-blue order."""
        nodes: list[list] = [[0, 0, {}]]
        for v in values:
            at = nodes[0]
            at[0] += 1
            for c in symbols(v):
                edge = at[2].get(c)
                if edge is None:
                    nodes.append([0, 0, {}])
                    edge = at[2][c] = [0, nodes[-1]]
                edge[0] += 1
                at = edge[1]
                at[0] += 1
            at[1] += 1
        root, spread = nodes[0], math.sqrt(0.5 * math.log(2 / alpha))

        def differ(a, na, b, nb):
            return na and nb and abs(a / na - b / nb) > spread * (na ** -0.5 + nb ** -0.5)

        def compatible(a, b):
            work = [(a, b)]
            while work:
                a, b = work.pop()
                if differ(a[1], a[0], b[1], b[0]):
                    return False
                for c in a[2].keys() | b[2].keys():
                    x, y = a[2].get(c), b[2].get(c)
                    if differ(x[0] if x else 0, a[0], y[0] if y else 0, b[0]):
                        return False
                    if x and y and x[1] is not y[1]:
                        work.append((x[1], y[1]))
            return True

        def fold(a, b):
            work = [(a, b)]
            while work:
                a, b = work.pop()
                a[0] += b[0]
                a[1] += b[1]
                for c, (n, nxt) in b[2].items():
                    if c in a[2]:
                        a[2][c][0] += n
                        if a[2][c][1] is not nxt:
                            work.append((a[2][c][1], nxt))
                    else:
                        a[2][c] = [n, nxt]

        red = [root]
        while True:
            known = {id(r) for r in red}
            blue = [(e[1][0], c, r, e) for r in red for c, e in r[2].items() if id(e[1]) not in known]
            if not blue:
                break
            _, _, _, edge = max(blue, key=lambda x: (x[0], x[1]))
            node = edge[1]
            for r in red:
                if compatible(r, node):
                    edge[1] = r
                    fold(r, node)
                    break
            else:
                red.append(node)
        index = {id(r): i for i, r in enumerate(red)}
        return cls([[r[0], r[1], {c: [n, index[id(t)]] for c, (n, t) in sorted(r[2].items())}] for r in red])

    def score(self, value: str) -> float:
        """Mean log-likelihood of a symbol, the end counted as one."""
        return self.total(value) / (len(value) + 1)

    def total(self, value: str) -> float:
        """Log-likelihood of the whole value."""
        at, total = 0, 0.0
        for c in symbols(value):
            if at is None:
                total += math.log(FLOOR)
                continue
            visits, _, edges = self.states[at]
            n, nxt = edges.get(c, (0, None))
            total += math.log(max(FLOOR, n / (visits + 1)))
            at = nxt
        end = FLOOR if at is None else max(FLOOR, self.states[at][1] / (self.states[at][0] + 1))
        return total + math.log(end)


def fit(labelled: DataFrame, sample: int = SAMPLE, contrast: int = CONTRAST) -> dict:
    """{kind: (automaton states, threshold)} from (kind, value) rows, those of ordinary tokens included.

    At most ``sample`` distinct values a kind take part, the ones with the smallest hash, and
    ``contrast`` ordinary tokens, as often as they occur: with ``LEARNT`` these bound what one
    task and the driver hold. Every fourth value calibrates, the others train.
    """
    short = labelled.filter((F.col("value") != "") & (F.length("value") <= LEARNT))
    few = short.filter(F.col("kind") == PLAIN).orderBy(F.xxhash64("value", "h"), "value").limit(contrast) \
        .select("kind", "value")
    for k in BASE_KINDS:
        few = few.unionByName(short.filter(F.col("kind") == k).select("kind", "value").distinct()
                              .orderBy(F.xxhash64("value"), "value").limit(sample))
    values: dict[str, list[str]] = {}
    for r in few.collect():
        values.setdefault(r.kind, []).append(r.value)
    out = {}
    for kind, vs in values.items():
        vs = sorted(vs, key=lambda v: hashlib.sha256(v.encode()).digest())
        held, train = vs[::4], [v for i, v in enumerate(vs) if i % 4] or vs
        a = Automaton.infer(train)
        scores = sorted(a.score(v) for v in held)
        out[kind] = (a.states, scores[int(QUANTILE * len(scores))])
    return out


class Judge:
    """Whether a token is a credential by the automata; decisions are remembered."""

    def __init__(self, model: dict, prior: float):
        autos = {k: (Automaton(s), t) for k, (s, t) in model.items()}
        self.plain = autos.pop(PLAIN, (None, 0.0))[0]
        self.autos = list(autos.values())
        self.bar = math.log(ODDS) - math.log(prior)
        self.known: dict[str, bool] = {}

    def __call__(self, value: str) -> bool:
        got = self.known.get(value)
        if got is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            got = self.decide(value)
            if len(value) <= 64:
                self.known[value] = got
        return got

    def decide(self, value: str) -> bool:
        usual = None
        for a, least in self.autos:
            t = a.total(value)
            if t >= least * (len(value) + 1):
                if usual is None:
                    usual = self.plain.total(value) if self.plain else (len(value) + 1) * math.log(FLOOR)
                if t - usual >= self.bar:
                    return True
        return False


def _decide(model: dict, shortest: int, prior: float):
    out_schema = pa.schema([("text_hash", pa.int64()), ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE_KINDS],
                            ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
    order = {k: i for i, k in enumerate((*BASE_KINDS, ADDED))}

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model, prior)
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = text or ""
                found = base_spans(text)
                # the tokens of a text are judged once each; only one that is added has its places looked up
                new = {v for v in set(TOKEN.findall(text)) if len(v) >= shortest and judge(v)} if judge.autos else ()
                if new:
                    found = found + [(ADDED, m.start(), m.end(), m[0])
                                     for m in apart(TOKEN.finditer(text), [s[1:3] for s in found]) if m[0] in new]
                spans = sorted((s, order[k], k, e) for k, s, e, _ in found)
                base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans if k != ADDED)
                every = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
                n = [sum(x[2] == k for x in spans) for k in (*BASE_KINDS, ADDED)]
                rows.append((row, doc_id, *n[:3], hashlib.sha256(base.encode()).hexdigest(), every, n[3]))
            cols = list(zip(*rows)) if rows else [[]] * len(out_schema)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, out_schema)],
                                             schema=out_schema)
    return decide


def secret_scan(docs: DataFrame, credentials: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """Every secret of every whole text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added, text_hash.

    ``credentials`` (kind, value) may label the credentials to learn from; else
    the base matches of ``docs`` do. The texts are read twice and not moved; what
    the first pass found is a written table, which is small beside them.
    """
    ship_code(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").select(F.xxhash64("text").alias("text_hash"), F.col("doc_id").cast("long"),
                                               F.col("text").cast("string"))
    labels = written(rows.select("text").mapInArrow(releasing(_label), LABELS_DDL), "secrets")
    if credentials is not None:
        given = pick(credentials, "kind", "value").filter(F.col("value") != "").withColumns({"n": F.lit(1).cast("long"), "h": F.lit(0).cast("long")})
        labels = labels.filter(F.col("kind") == PLAIN).unionByName(given)
    model = fit(labels, sample)
    plain = F.col("kind") == PLAIN
    tokens, known, least = labels.agg(F.sum(F.when(plain, F.col("n"))), F.count_if(~plain), F.min(F.when(~plain, F.length("value")))).first()
    # how many tokens there are for each credential that an assignment or a fixed form shows
    prior = min(0.5, (known or 1) / max(tokens or 0, known or 0, 1))
    return rows.mapInArrow(releasing(_decide(model, max(SHORTEST, least or 0), prior)),
                           "text_hash long, doc_id long, n_assign long, n_access long, n_hex long, "
                           "base_sha256 string, spans string, n_added long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span of a ``spans`` string replaced by ``<secret>``.

    Overlapping spans become one replacement. Null or empty ``spans`` leave
    the text as it is.
    """
    at = F.transform(F.filter(F.split(F.coalesce(spans, F.lit("")), ","), lambda s: s != ""),
                     lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("s"), F.split(s, ":")[2].cast("int").alias("e")))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))
    walked = F.aggregate(at, empty, lambda acc, x: F.when(x["s"] < acc["upto"], F.struct(
        acc["out"].alias("out"), F.greatest(acc["upto"], x["e"]).alias("upto"))).otherwise(F.struct(
            F.concat(acc["out"], F.substring(text, acc["upto"] + 1, x["s"] - acc["upto"]), F.lit("<secret>")).alias("out"),
            x["e"].alias("upto"))))
    return F.when(F.size(at) == 0, text).otherwise(
        F.concat(walked["out"], F.substring(text, walked["upto"] + 1, F.length(text))))
