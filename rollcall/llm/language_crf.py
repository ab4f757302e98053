"""Language identification of code-switched text by a linear-chain conditional random field.

Words (runs of letters, in lower case) are the positions of a chain, languages
the labels. Emissions come from affixes of one to four letters, the letter
trigrams of the word with its borders, and a lexicon of words seen in training;
transitions between languages are learned with them. Training text is
code-switched by splicing: stretches of documents in different languages make
up each training sequence. Forward-backward gives every word's label
posteriors; a document's language has the largest posterior sum, its score is
that sum's share.

The field is fitted on a bounded sample (``TRAIN_DOCS`` documents a language,
``TRAIN_WORDS`` words of each) in one task; prediction covers every word of
every text and needs the model alone, whose size the buckets and the number of
languages bound.

Defined cases: a text that is null or has no letter is `und` with score 0; a
null language teaches nothing; without any training document every prediction
is `und`; rows with equal ids are predicted one by one; an empty table gives an
empty result; extra columns are ignored. Texts are worked on in chains of
``CHAIN`` words, which hand their messages over: no transition is cut.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import pick, ship_code, written

BUCKETS = 1 << 17
CHAIN = 64
TRAIN_DOCS = 300
TRAIN_WORDS = 160
STRETCH = (4, 24)          # words of a spliced stretch, shortest and longest
ROUNDS = 40
RATE, DECAY = 0.4, 1e-6
LEXICON_LEAST = 3          # times a word occurs in the sample to be in the lexicon
SLICE_CHARS = 1_000_000
UNDETERMINED = "und"

_R = np.random.RandomState(77)
MIX = (_R.randint(0, 2 ** 31 - 1, 16).astype(np.uint32) << np.uint32(1)) | np.uint32(1)


class Letters:
    """Lower-case letter of each code point, 0 for what isn't a letter; made once per worker."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            t = np.zeros(0x110000, np.uint32)
            for c in range(0x110000):
                s = chr(c)
                if s.isalpha():
                    low = s.lower()
                    t[c] = ord(low) if len(low) == 1 else c
            cls.table = t
        return cls.table


def _bucket(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 17)).astype(np.int32)


class Words:
    """The words of some texts and the feature buckets of each."""

    def __init__(self, texts: list[str], lexicon: np.ndarray | None = None):
        joined = "\n".join(texts)
        size = np.array([len(t) + 1 for t in texts])
        c = np.frombuffer(("\n" + joined + "\n\n\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        m = Letters.get()[c]
        letter = m > 0
        edge = np.diff(letter.view(np.int8))
        self.start = np.flatnonzero(edge == 1) + 1
        self.end = np.flatnonzero(edge == -1) + 1
        self.first = np.searchsorted(self.start, np.cumsum(size) - size + 1)      # first word of each text
        at = np.flatnonzero(letter)
        self.tri = _bucket(m[at - 1] * MIX[0] ^ m[at] * MIX[1] ^ m[at + 1] * MIX[2] ^ MIX[3])
        self.tri_from = np.searchsorted(at, self.start)
        long = self.end - self.start
        self.affix = []
        head = np.zeros(len(long), np.uint32)
        tail = np.zeros(len(long), np.uint32)
        for k in range(4):
            has = long > k
            head = np.where(has, (head + m[np.minimum(self.start + k, len(m) - 1)]) * MIX[4 + k], head)
            tail = np.where(has, (tail + m[np.maximum(self.end - 1 - k, 0)]) * MIX[8 + k], tail)
            self.affix += [_bucket(head ^ MIX[12]), _bucket(tail ^ MIX[13])]
        letters = m[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = (at - np.repeat(self.start, long)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        x = (letters ^ (letters >> np.uint64(29))) * (place * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1))
        self.hash = (np.add.reduceat(x ^ (x >> np.uint64(32)), self.tri_from) if len(at) else np.empty(0, np.uint64))
        self.lex = None
        if lexicon is not None and len(lexicon):
            i = np.minimum(np.searchsorted(lexicon, self.hash), len(lexicon) - 1)
            self.lex = np.where(lexicon[i] == self.hash, i, -1)

    def __len__(self) -> int:
        return len(self.start)

    def emissions(self, model: "Model") -> np.ndarray:
        out = np.zeros((len(self), len(model.langs)), np.float32)
        if len(self):
            out += np.add.reduceat(model.tri[self.tri], self.tri_from, axis=0)
            for k, b in enumerate(self.affix):
                out += model.affix[k][b]
            if self.lex is not None:
                out += np.where((self.lex >= 0)[:, None], model.lex[self.lex], 0)
        return out


class Model:
    def __init__(self, langs: list[str], lexicon: np.ndarray):
        n = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.tri = np.zeros((BUCKETS, n), np.float32)
        self.affix = np.zeros((8, BUCKETS, n), np.float32)
        self.lex = np.zeros((max(1, len(lexicon)), n), np.float32)
        self.trans = np.zeros((n, n), np.float32)

    def dumped(self) -> bytes:
        sink = io.BytesIO()
        np.savez_compressed(sink, langs=np.array(self.langs, np.str_), lexicon=self.lexicon, tri=self.tri.astype(np.float16),
                            affix=self.affix.astype(np.float16), lex=self.lex.astype(np.float16), trans=self.trans)
        return sink.getvalue()

    @classmethod
    def read(cls, data: bytes) -> "Model":
        z = np.load(io.BytesIO(data))
        out = cls.__new__(cls)
        out.langs, out.lexicon = z["langs"].tolist(), z["lexicon"]
        out.tri, out.affix, out.lex, out.trans = (z[k].astype(np.float32) for k in ("tri", "affix", "lex", "trans"))
        return out


def words_in(text: str) -> list[str]:
    """The words of a text, as ``Words`` finds them."""
    return "".join(c if c.isalpha() else " " for c in text).split()


def forward_backward(em: np.ndarray, live: np.ndarray, trans: np.ndarray, enter: np.ndarray | None = None,
                     leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (chain, place, label) and summed pair posteriors (label, next label).

    ``em`` (chain, place, label) are emission scores, ``live`` the places that hold a word; ``enter`` and
    ``leave`` (chain, label) what the words before and after a chain say about its first and its last word.
    """
    phi = np.exp(em - em.max(2, keepdims=True))
    step = np.exp(trans)
    places = em.shape[1]
    alpha, beta = np.empty_like(phi), np.ones_like(phi)
    if leave is not None:
        beta[:] = leave[:, None]
    alpha[:, 0] = phi[:, 0] if enter is None else phi[:, 0] * enter
    alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
    for t in range(1, places):
        a = (alpha[:, t - 1] @ step) * phi[:, t]
        alpha[:, t] = a / a.sum(1, keepdims=True)
    pairs = np.zeros_like(step)
    for t in range(places - 2, -1, -1):
        ahead = phi[:, t + 1] * beta[:, t + 1]
        b = ahead @ step.T
        total = np.einsum("ij,ij->i", alpha[:, t], b)
        on = live[:, t + 1]
        pairs += step * (alpha[on, t] / total[on, None]).T.dot(ahead[on])
        beta[:, t] = np.where(on[:, None], b / b.sum(1, keepdims=True), beta[:, t])
    post = alpha * beta
    return post / post.sum(2, keepdims=True), pairs


def chains(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(chain, place) of each of ``n`` words: texts begin at ``first``, and every CHAIN words a chain does."""
    count = np.diff(np.append(first, n))
    per = -(-count // CHAIN)
    inside = np.arange(n) - np.repeat(first, count)
    return np.repeat(np.cumsum(per) - per, count) + inside // CHAIN, inside % CHAIN, int(per.sum())


def messages(em: np.ndarray, live: np.ndarray, trans: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(enter, leave) of each chain: what the chains of the same text before and after it hand over.

    ``inside`` is a chain's number in its text, chains of a text being neighbours. A
    chain's paths from its first to its last word sum up to a matrix; with these, a text
    is walked chain by chain, all texts at once, and no transition is cut.
    """
    n, places, labels = em.shape
    enter, leave = np.ones((n, labels), em.dtype), np.ones((n, labels), em.dtype)
    part = np.flatnonzero((inside > 0) | np.append(inside[1:] > 0, False))       # chains of texts that have several
    if not len(part):
        return enter, leave
    step = np.exp(trans).astype(em.dtype)
    phi = np.exp(em[part] - em[part].max(2, keepdims=True))
    paths = np.eye(labels, dtype=em.dtype) * phi[:, 0][:, None, :]
    for t in range(1, places):
        on = live[part, t][:, None, None]
        ahead = (paths @ step) * phi[:, t][:, None, :]
        paths = np.where(on, ahead / ahead.sum((1, 2), keepdims=True), paths)
    place = np.full(n, -1)
    place[part] = np.arange(len(part))
    order = np.argsort(inside[part], kind="stable")
    rounds = np.split(part[order], np.cumsum(np.bincount(inside[part]))[:-1])
    for later in rounds[1:]:
        out = np.einsum("ci,cij->cj", enter[later - 1], paths[place[later - 1]]) @ step
        enter[later] = out / out.sum(1, keepdims=True)
    for later in reversed(rounds[1:]):
        back = np.einsum("cij,cj->ci", paths[place[later]], leave[later]) @ step.T
        leave[later - 1] = back / back.sum(1, keepdims=True)
    return enter, leave


def posteriors(words: Words, model: Model) -> np.ndarray:
    """Label posteriors of each word, over its whole text."""
    em = words.emissions(model)
    chain, place, n = chains(words.first, len(words))
    if not n:
        return em
    grid = np.zeros((n, int(place.max()) + 1, em.shape[1]), np.float32)
    live = np.zeros(grid.shape[:2], bool)
    grid[chain, place], live[chain, place] = em, True
    per = -(-np.diff(np.append(words.first, len(words))) // CHAIN)
    inside = np.arange(n) - np.repeat(np.cumsum(per) - per, per)
    return forward_backward(grid, live, model.trans, *messages(grid, live, model.trans, inside))[0][chain, place]


def spliced(samples: list[tuple[str, str]], seed: int = 5) -> list[list[tuple[str, str]]]:
    """Training sequences of (language, word): stretches of random documents, one after the other."""
    rng = np.random.RandomState(seed)
    left = []
    for lang, text in samples:
        w = words_in(text)
        a = rng.randint(0, max(1, len(w) - TRAIN_WORDS + 1))
        if w:
            left.append((lang, w[a:a + TRAIN_WORDS]))
    out, row = [], []
    while left:
        k = rng.randint(len(left))
        lang, w = left[k]
        n = min(len(w), rng.randint(STRETCH[0], STRETCH[1] + 1), CHAIN - len(row))
        row += [(lang, x) for x in w[:n]]
        if len(w) > n:
            left[k] = lang, w[n:]
        else:
            left[k] = left[-1]
            left.pop()
        if len(row) == CHAIN:
            out.append(row)
            row = []
    return out + [row] * bool(row)


def fit(samples: list[tuple[str, str]]) -> Model:
    """Maximum likelihood with adaptive gradient steps over all sequences."""
    rows = spliced(samples)
    langs = sorted({lang for lang, _ in samples})
    code = {lang: i for i, lang in enumerate(langs)}
    texts = [" ".join(w for _, w in r) for r in rows]
    seen, n = np.unique(Words(texts).hash, return_counts=True)
    model = Model(langs, seen[n >= LEXICON_LEAST])
    words = Words(texts, model.lexicon)
    # one label a word: the splicer and the reader split words alike
    gold = np.array([code[lang] for r in rows for lang, _ in r])
    if len(gold) != len(words):
        raise ValueError("words of the training text are split in two ways")
    chain, place, count = chains(words.first, len(words))
    live = np.zeros((count, int(place.max(initial=0)) + 1), bool)
    live[chain, place] = True
    truth = np.eye(len(langs), dtype=np.float32)[gold]
    next_in = np.flatnonzero((chain[1:] == chain[:-1]))
    gold_pairs = np.zeros((len(langs),) * 2)
    np.add.at(gold_pairs, (gold[next_in], gold[next_in + 1]), 1)
    of_tri = np.repeat(np.arange(len(words)), np.diff(np.append(words.tri_from, len(words.tri))))
    sums = [np.full_like(x, 1e-3) for x in (model.tri, *model.affix, model.lex, model.trans)]

    def climb(k: int, weights: np.ndarray, gradient: np.ndarray) -> None:
        sums[k] += gradient ** 2
        weights += RATE * gradient / np.sqrt(sums[k]) - DECAY * weights

    def gathered(bucket: np.ndarray, diff: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(bucket, diff[:, i], n) for i in range(len(langs))], 1).astype(np.float32)

    for _ in range(ROUNDS):
        grid = np.zeros((*live.shape, len(langs)), np.float32)
        grid[chain, place] = words.emissions(model)
        post, pairs = forward_backward(grid, live, model.trans)
        diff = truth - post[chain, place]
        climb(0, model.tri, gathered(words.tri, diff[of_tri], BUCKETS))
        for k, b in enumerate(words.affix):
            climb(1 + k, model.affix[k], gathered(b, diff, BUCKETS))
        if words.lex is not None:
            known = words.lex >= 0
            climb(9, model.lex, gathered(words.lex[known], diff[known], len(model.lex)))
        climb(10, model.trans, (gold_pairs - pairs).astype(np.float32) / 10)
    return model


def training_rows(docs: DataFrame) -> DataFrame:
    """(lang, text) of at most TRAIN_DOCS distinct texts with a letter a language, the smallest hashes.

    Copies count once, so that every language with a text is learned. A language's
    hashes are thinned to about twice that number before they are ranked.
    """
    some = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h"))
    distinct = written(some.select("lang", "h").distinct(), "training-hashes")
    per = distinct.groupBy("lang").agg(F.count("*").alias("n"))
    scale = 1 << 30
    thin = distinct.join(F.broadcast(per), "lang").filter(
        F.pmod("h", F.lit(scale)) * F.col("n") <= F.lit(2.0 * TRAIN_DOCS * scale))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = thin.withColumn("r", rank).filter(F.col("r") <= TRAIN_DOCS).select("lang", "h")     # TRAIN_DOCS a language
    return some.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text")


def identify_language(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score, n_words of every row of ``docs``; ``learn_from`` (lang, text) teaches."""
    spark = docs.sparkSession
    ship_code(spark)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(r["lang"], r["text"]) for b in batches for r in b.to_pylist()})
        rows = [(lang, text) for lang, text in rows if any(c.isalpha() for c in text)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([fit(rows).dumped()], pa.binary())], names=["model"])

    got = training_rows(learn_from).coalesce(1).mapInArrow(train, "model binary").collect()
    data = spark.sparkContext.broadcast(bytes(got[0].model) if got else b"")
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.read(data.value) if data.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                to, chars = at + 1, len(texts[at])
                while to < len(texts) and chars + len(texts[to]) <= SLICE_CHARS:
                    chars += len(texts[to])
                    to += 1
                words = Words(texts[at:to], model.lexicon if model else None)
                count = np.diff(np.append(words.first, len(words)))
                pred, score = [UNDETERMINED] * (to - at), np.zeros(to - at)
                if model and len(words):
                    total = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(posteriors(words, model), axis=0, dtype=np.float64)])
                    share = (total[words.first + count] - total[words.first]) / np.maximum(count, 1)[:, None]
                    best = share.argmax(1)
                    pred = [model.langs[b] if c else UNDETERMINED for b, c in zip(best, count)]
                    score = np.where(count > 0, np.clip(share.max(1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at).cast(pa.int64()), pa.array(pred, pa.string()),
                                                  pa.array(score, pa.float64()), pa.array(count, pa.int64())], schema=schema)
                at = to

    return pick(docs, "doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double, n_words long")
