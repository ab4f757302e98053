"""Quality classifier: interpolated modified Kneser-Ney character model of trusted text.

The model is a set of tables, never held in one place. One pass packs the
documents into blocks of bounded size and lists every n-gram type of a block
with its count in trusted training text. Counts are summed over blocks;
Kneser-Ney's continuation counts, discounts and interpolation are grouped
counts and joins on n-grams. Every n-gram type that occurs gets its
log-probability there, and a sharded join hands each block the
log-probabilities of its own types: that is what a block needs to score its
documents. What is gathered grows with the input (types per block). The
texts are packed once, compressed, into a table bucketed by block, and so stay
where they are when the blocks' types come to them.

In a task n-grams are numbered by 64-bit keys of their characters in an open
hash table of arrays; two different ones of a block share a key with a chance of
about 1e-8 for a million types.

One model serves all languages, so that text which switches languages isn't
taken for junk; thresholds are by language. A document's perplexity is shrunk
towards the typical trusted one of its language by ``PRIOR`` characters, as a
few words say little. It is rejected above a quantile of the held-out trusted
documents of its language.

Defined cases: a null or empty text has no perplexity and is rejected; a null
language is a language of its own (''); a language without held-out trusted
documents has no threshold, and its documents are kept; without any trusted
training text there is no model, and all documents with text are kept; labels
that are null or contradict each other don't make a document trusted; rows with
equal ids are scored one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.store import fresh_path, pick, release, releasing, ship_code, written

ORDER = 5                 # spans words, so that repeated ordinary words don't look like text
BLOCK_CHARS = 40_000_000  # the larger the blocks, the fewer types they have together
SLICE_CHARS = 250_000
BATCH_CHARS = 4_000_000   # texts of a block that are compressed together, and unpacked together
START = "\x02"
LEVEL = 6                 # of the packed texts: they are written once and moved once
PRIOR = 120.0             # characters' worth of the language's typical log-probability
QUANTILE = 0.99
TRUSTED_BROADCAST = 4_000_000   # ids; beyond it the flag is joined by a shuffle

DOC = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string()), ("text_hash", pa.int64())])
BLOCK_DDL = "block string, docs binary, grams array<struct<gram:string,n:long>>"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


GOLD = np.uint64(0x9E3779B97F4A7C15)
_R = np.random.RandomState(31)
PLACE = _R.randint(0, 2 ** 63 - 1, ORDER).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def keys_of(points: np.ndarray) -> np.ndarray:
    """A 64-bit key of the n-gram at each place."""
    n = max(len(points) - ORDER + 1, 0)
    out = np.zeros(n, np.uint64)
    for i, m in enumerate(PLACE):
        out += points[i:i + n] * m
    return out


class Types:
    """Distinct n-grams, numbered as they come: their keys in an open hash table, at most a quarter full."""

    def __init__(self):
        self.keys, self.strings = np.empty(0, np.uint64), []
        self.bits, self.slots = 12, np.full(1 << 12, -1, np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * GOLD >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 of those not seen yet."""
        at = self.slot(keys)
        got = self.slots[at]
        if len(self.keys):
            wrong = np.flatnonzero((got >= 0) & (self.keys[got] != keys))
            while len(wrong):
                at[wrong] = at[wrong] + 1 & len(self.slots) - 1
                got[wrong] = self.slots[at[wrong]]
                wrong = wrong[(got[wrong] >= 0) & (self.keys[got[wrong]] != keys[wrong])]
        return got

    def add(self, keys: np.ndarray) -> None:
        """Number keys that are distinct and not seen yet."""
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 4 * len(self.keys) > len(self.slots):
            self.bits = int(8 * len(self.keys)).bit_length() - 1
            self.slots, first = np.full(1 << self.bits, -1, np.int32), 0
        left = np.arange(first, len(self.keys), dtype=np.int32)
        at = self.slot(self.keys[first:])
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], at[lost] + 1 & len(self.slots) - 1

    def read(self, texts: list[str], learn: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of the n-gram that ends at each character, where each text starts); new ones are added where ``learn``."""
        joined = "".join(START * (ORDER - 1) + t for t in texts)
        size = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(size) - size
        # a text's n-grams; those that end in a START are none
        at = np.repeat(np.arange(len(size)) * (ORDER - 1), size) + np.arange(int(size.sum()))
        keys = keys_of(code_points(joined).astype(np.uint64))[at]
        got = self.find(keys)
        if learn and len(new := np.flatnonzero(got < 0)):
            some, first = np.unique(keys[new], return_index=True)
            self.add(some)
            self.strings += [joined[i:i + ORDER] for i in at[new[first]].tolist()]
            got[new] = self.find(keys[new])
        return got, starts


def gram_types(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct n-grams of some texts, which of them ends at each character, and where each text starts.

    START stands before a text.
    """
    types = Types()
    of, starts = types.read(texts, True)
    return types.strings, of, starts


def text_slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > SLICE_CHARS:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


class Block:
    """Texts of a block, compressed batch by batch as they come, and its n-gram types with their counts."""

    def __init__(self):
        self.types, self.counts, self.rows, self.chars, self.held = Types(), np.zeros(0, np.int64), [], 0, 0
        self.sink = pa.BufferOutputStream()
        self.out = pa.ipc.new_stream(self.sink, DOC, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL)))

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        n = len(row[2] or "") + 1
        self.chars, self.held = self.chars + n, self.held + n
        if self.held >= BATCH_CHARS:
            self.flush()

    def flush(self) -> None:
        self.out.write_batch(pa.record_batch([pa.array([r[i] for r in self.rows], f.type) for i, f in enumerate(DOC)], schema=DOC))
        for flag in (False, True):
            some = [text for _, _, text, _, train in self.rows if text and train == flag]
            for a, b in text_slices(some):
                of, _ = self.types.read(some[a:b], True)
                self.counts = np.concatenate([self.counts, np.zeros(len(self.types.keys) - len(self.counts), np.int64)])
                if flag:
                    self.counts += np.bincount(of, minlength=len(self.counts))
        self.rows, self.held = [], 0

    def packed(self, name: str) -> pa.RecordBatch:
        if self.rows:
            self.flush()
        self.out.close()
        grams = pa.StructArray.from_arrays([pa.array(self.types.strings, pa.string()), pa.array(self.counts, pa.int64())],
                                           names=["gram", "n"])
        docs = pa.array([memoryview(self.sink.getvalue())], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([name]), docs, pa.ListArray.from_arrays([0, len(grams)], grams)],
                                          names=["block", "docs", "grams"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, block = TaskContext.get().partitionId(), 0, Block()
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            block.add(row)
            if block.chars >= BLOCK_CHARS:
                yield block.packed(f"{part}-{seq}")
                seq, block = seq + 1, Block()
                release()
    if block.chars:
        yield block.packed(f"{part}-{seq}")


SCORED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("log_p", pa.float64()),
                    ("text_hash", pa.int64())])


def _score(packed: pa.Table, answers: pa.Table) -> pa.Table:
    """Summed log-probability of each document of one block; null without a model."""
    types, logs = Types(), answers.column("log_p").to_numpy().astype(np.float64)
    if len(answers):
        grams = code_points("".join(answers.column("gram").to_pylist())).astype(np.uint64)
        types.add(keys_of(grams)[::ORDER])          # each has ORDER characters
    parts = []
    for docs in (batch for raw in packed.column("docs") for batch in pa.ipc.open_stream(raw.as_buffer())):
        texts = [t or "" for t in docs.column("text").to_pylist()]
        total = np.zeros(len(texts))
        for a, b in text_slices(texts):
            if not len(logs):
                break
            of, starts = types.read(texts[a:b], False)
            each = logs[of]
            p = np.concatenate([[0.0], np.cumsum(each)])
            total[a:b] = p[np.append(starts[1:], len(each))] - p[starts]
        parts.append(pa.table([docs.column("doc_id"), docs.column("lang"), pa.array([len(t) for t in texts], pa.int64()),
                               pa.array(total, pa.float64(), mask=np.full(len(texts), not len(logs))),
                               docs.column("text_hash")], schema=SCORED))
    del types, logs
    release()
    return pa.concat_tables(parts) if parts else SCORED.empty_table()


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts of one, two, and three or more."""
    n = [0.0, *counts.agg(*[F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]).first()]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.0
        out.append(d if 0 < d < k else k - 0.5)       # where counts of counts are missing, a middle value
    return tuple(out)


def level(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """(discounted count of each n-gram, total and backoff weight of each context) of one order."""
    d1, d2, d3 = discounts(counts)
    off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    c = counts.withColumn("off", off).withColumn("mass", F.col("n") - F.col("off"))
    ctx = c.groupBy(F.substring("gram", 1, order - 1).alias("ctx")).agg(F.sum("n").alias("total"), F.sum("off").alias("off"))
    return c.select("gram", "mass"), ctx.select("ctx", F.col("total").cast("double"), (F.col("off") / F.col("total")).alias("weight"))


def log_probabilities(wanted: DataFrame, counts: DataFrame, longest: int = 3) -> DataFrame:
    """(gram, log_p): of each wanted n-gram, its last character after the others.

    ``counts`` (gram, n) are the n-grams of ``longest`` characters of the training text. Lower orders
    count the distinct n-grams that a shorter one ends. Without counts there
    are no rows.
    """
    levels, own = [], counts
    for order in range(longest, 0, -1):
        levels.append((order, *level(own, order)))
        if order > 1:
            own = written(own.groupBy(F.substring("gram", 2, order - 1).alias("gram")).agg(F.count("*").alias("n")),
                          "continuations")
    letters = own.count()
    if not letters:
        return wanted.limit(0).select("gram", F.lit(0.0).alias("log_p"))
    out = wanted.withColumn("p", F.lit(1.0 / (letters + 1)))
    for order, mass, ctx in reversed(levels):
        out = out.withColumn("own", F.substring("gram", longest - order + 1, order)) \
            .withColumn("ctx", F.substring("gram", longest - order + 1, order - 1))
        # tables by single letters have a row for each letter, 1.1 million at most
        mass, ctx = (F.broadcast(mass) if order == 1 else mass), (F.broadcast(ctx) if order == 2 else ctx)
        out = out.join(mass.withColumnRenamed("gram", "own"), "own", "left")
        if order > 1:
            out = out.join(ctx, "ctx", "left")
        else:
            total, weight = ctx.select("total", "weight").first()          # of the empty context
            out = out.withColumn("total", F.lit(total)).withColumn("weight", F.lit(weight))
        out = out.withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(
            F.coalesce("mass", F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("p"))).select("gram", "p")
    return out.select("gram", F.log("p").alias("log_p"))


def by_block(packed: DataFrame) -> DataFrame:
    """``packed`` written into the shared folder, bucketed by block: grouping by block moves no block."""
    spark, path = packed.sparkSession, fresh_path(packed.sparkSession, "blocks")
    name = f"rollcall_{path.rsplit('/', 1)[1].replace('-', '_')}"
    packed.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def quality_scores(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold, kept, text_hash of every row.

    ``labels`` (doc_id, quality): documents of quality 1 are trusted. One in
    five of them, by hash of the id, is held out for the thresholds. Only
    figures by language are broadcast, and the trusted ids where they are few.
    """
    spark = docs.sparkSession
    ship_code(spark)
    trusted = written(pick(labels, "doc_id", "quality").filter("doc_id is not null").groupBy("doc_id")
                      .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
                      .filter("low = 1 and high = 1")
                      .select(F.col("doc_id").cast("long").alias("id"), (F.pmod(F.xxhash64("doc_id"), F.lit(5)) > 0).alias("train")),
                      "trusted")
    few = F.broadcast(trusted) if trusted.count() <= TRUSTED_BROADCAST else trusted
    base = pick(docs, "doc_id", "lang", "text").select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string"),
        F.xxhash64("text").alias("text_hash"))
    packed = by_block(base.join(few, F.col("doc_id") == F.col("id"), "left")
                      .select("doc_id", "lang", "text", "text_hash", F.coalesce("train", F.lit(False)).alias("train"))
                      .mapInArrow(releasing(_pack), BLOCK_DDL))
    grams = packed.select("block", F.explode("grams").alias("g")).select("block", "g.gram", "g.n")
    types = written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    logs = written(log_probabilities(types.select("gram"), types.filter("n > 0"), ORDER), "log-probabilities")
    answers = grams.select(F.col("block").alias("of_block"), "gram").join(logs.select("gram", F.col("log_p").cast("float")), "gram")
    scored = written(packed.select("block", "docs").groupBy("block").cogroup(answers.groupBy("of_block"))
                     .applyInArrow(_score, "doc_id long, lang string, n_chars long, log_p double, text_hash long"), "scores")
    held = scored.join(trusted.filter("not train"), F.col("doc_id") == F.col("id"), "left_semi").filter("n_chars > 0")
    typical = F.broadcast(held.groupBy("lang").agg((F.sum("log_p") / F.sum("n_chars")).alias("mean")))   # a row for each language

    def perplexity(df: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.col("log_p") / F.col("n_chars"))
        return df.join(typical, "lang", "left").withColumn("perplexity", F.when(
            F.col("n_chars") > 0, F.exp(-(F.col("log_p") + PRIOR * mean) / (F.col("n_chars") + PRIOR)))).drop("mean")

    thresholds = F.broadcast(perplexity(held).groupBy("lang").agg(
        F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("threshold")))
    return perplexity(scored).join(thresholds, "lang", "left").select(
        "doc_id", "lang", "n_chars", "perplexity", "threshold",
        ((F.col("n_chars") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"), "text_hash")
