"""Ranked lexical search by norm buckets of impact vectors (LEMP style).

A document is the vector of its impacts on the query terms, an item the vector
of its term weights. With r the root of a term's weight, the item has r and the
document r * impact in that coordinate, so their product is the score and
Cauchy-Schwarz is tight where an item's terms have even impacts. In a cell (a
shard of documents, a block of items) documents are ordered by length and cut
into buckets. For an item, buckets are taken from the longest on; as soon as
|item| * |longest of the bucket| is below the bar (the k-th best score so far),
this and all shorter buckets are pruned. Inside a bucket the item's heaviest
coordinates are added up for all documents, and what the other coordinates can
still add is bounded twice: by Cauchy-Schwarz on the lengths that are left, and
by the bucket's largest impact in each coordinate. Survivors are scored again
exactly, in 64-bit integers.

The bar doesn't start at zero: one aggregate over all postings counts impacts
by steps, so each term's k-th largest impact is known from below, and a
document that has it scores at least its weight times that.

Terms that no item has can't change a score. A bitmap of fixed size (CRC-32 of
the items' terms) lets the tasks that read texts drop most of them; exact joins
drop the rest. Nothing else is sent to all tasks.

Defined cases: null and empty texts have no terms; an item without terms, or
none of whose terms stands in a document, has no rows; a null doc_id is a
document like any other, after all ids among equal scores; repeated ids are
separate documents, and items; empty tables give an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import cogrouped, parts_for, pick, ship_code, written

SHARD = 8192            # documents of a cell
POSTINGS = 2_000_000    # postings of a cell
ITEM_TERMS = 200_000    # terms of the items of a cell
BUCKET = 1024           # documents of a norm bucket
FOCUS = 6               # an item's heaviest coordinates, added up before any bound
FILTER_BITS = 1 << 20   # bitmap of the items' terms
STEP = 1 << 14          # width of an impact step; impacts are below 1,000,000
SLACK = 1 + 1e-9        # granted to bounds, which are floating-point

# terms: runs of characters other than these, only A-Z lower-cased; in UTF-8 the same holds of bytes
_OTHER = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
PLAIN = bytes(0x20 if b in _OTHER else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

COUNTED = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.binary())), ("tf", pa.list_(pa.int64()))])
COUNTED_DDL = "key long, n long, terms array<binary>, tf array<long>"
OUT = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
OUT_DDL = "item long, doc_id long, score long"


def counted(rows: DataFrame, key: str, wanted: bytes | None = None) -> DataFrame:
    """key, n (terms with repeats), terms and tf of each whole text that has a term; of ``wanted`` terms only."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ns, terms, tfs = [], [], [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().translate(PLAIN).split() if text.is_valid else ()
                if not words:
                    continue
                tf = Counter(words)
                if wanted is not None:
                    hashes = ((t, zlib.crc32(t) % FILTER_BITS) for t in tf)
                    tf = {t: tf[t] for t, h in hashes if wanted[h >> 3] >> (h & 7) & 1}
                keys.append(k)
                ns.append(len(words))
                terms.append(list(tf))
                tfs.append(list(tf.values()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip((keys, ns, terms, tfs), COUNTED)], schema=COUNTED)

    return rows.select(F.col(key), F.col("text").cast("binary")).mapInArrow(count, COUNTED_DDL)


def term_filter(items: DataFrame) -> bytes:
    """A bitmap of FILTER_BITS bits: those of the items' terms are set."""
    at = (F.crc32("term") % FILTER_BITS) + 1
    bits = items.select(F.explode("terms").alias("term")).groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for part, bitmap in bits.collect():          # FILTER_BITS / 32768 rows at most
        out[(part - 1) * 4096:part * 4096] = bytes(bitmap)[:max(0, len(out) - (part - 1) * 4096)]
    return bytes(out)


def impact(tf: str, n: str, docs: int, length: int) -> str:
    """SQL of (10^9 tf) div (1000 tf + 8 m), m = 100 - 90 + ((90 n N) div L)."""
    return f"((1000000000L * {tf}) div (1000L * {tf} + 8L * (10L + ((90L * {n} * {docs}L) div {length}L))))"


class Shard:
    """Documents of a cell in falling order of length, with their postings by document and by term."""

    def __init__(self, ids: pa.Array, n: np.ndarray, term: np.ndarray, tf: np.ndarray, doc: np.ndarray,
                 weight: np.ndarray, docs: int, length: int):
        m = 10 + (90 * n * docs) // length
        gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        square = np.bincount(doc, weight[term] * gain.astype(np.float64) ** 2, minlength=len(n))
        order = np.argsort(-square, kind="stable")
        place = np.empty(len(n), np.int64)
        place[order] = np.arange(len(n))
        self.square, self.ids = square[order], ids.take(pa.array(order))
        self.id = pc.fill_null(self.ids, 0).to_numpy()
        self.no_id = self.ids.is_null().to_numpy(zero_copy_only=False)
        at = place[doc]
        by_doc = np.argsort(at, kind="stable")
        self.row = np.searchsorted(at[by_doc], np.arange(len(n) + 1))
        self.row_term, self.row_gain = term[by_doc], gain[by_doc]
        by_term = np.lexsort((at, term))
        self.col_at, self.col_gain = at[by_term], gain[by_term]
        self.col = np.searchsorted(term[by_term], np.arange(len(weight) + 1))
        self.peak = np.zeros((-(-len(n) // BUCKET), len(weight)), np.int64)     # largest impact by bucket and term
        np.maximum.at(self.peak, (at // BUCKET, term), gain)
        self.weight = weight

    def top(self, terms: np.ndarray, bar: int, k: int, seen: Counter) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best documents with ``bar`` or more; ``terms`` in falling order of weight."""
        w = self.weight[terms]
        size = float(np.sqrt(w.sum()))
        focus, rest = terms[:FOCUS], terms[FOCUS:]
        rest_size = float(np.sqrt(self.weight[rest].sum()))
        own = np.zeros(len(self.weight), np.int64)
        own[terms] = w
        best, score = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in range(len(self.peak)):
            lo, hi = b * BUCKET, min((b + 1) * BUCKET, len(self.square))
            if size * np.sqrt(self.square[lo]) * SLACK < bar:
                seen["pruned"] += len(self.square) - lo
                break
            acc, used = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
            for t in focus:
                a, z = self.col[t] + np.searchsorted(self.col_at[self.col[t]:self.col[t + 1]], (lo, hi))
                gain = self.col_gain[a:z]
                acc[self.col_at[a:z] - lo] += self.weight[t] * gain
                used[self.col_at[a:z] - lo] += self.weight[t] * gain.astype(np.float64) ** 2
            left = rest_size * np.sqrt(np.maximum(self.square[lo:hi] * SLACK - used, 0))
            most = acc + np.minimum(left, float((self.weight[rest] * self.peak[b, rest]).sum()))
            live = lo + np.flatnonzero((most * SLACK >= bar) & (most > 0))
            seen["filtered"] += hi - lo - len(live)
            seen["scored"] += len(live)
            if not len(live):
                continue
            first, size_of = self.row[live], self.row[live + 1] - self.row[live]
            start = np.concatenate([[0], np.cumsum(size_of)[:-1]])
            flat = np.repeat(first - start, size_of) + np.arange(size_of.sum())
            exact = np.add.reduceat(own[self.row_term[flat]] * self.row_gain[flat], start)
            good = (exact >= max(bar, 1))
            best, score = np.concatenate([best, live[good]]), np.concatenate([score, exact[good]])
            order = np.lexsort((self.id[best], self.no_id[best], -score))[:k]
            best, score = best[order], score[order]
            if len(best) == k:
                bar = max(bar, int(score[-1]))
        return best, score


def search_cell(vectors: pa.Table, items: pa.Table, k: int, docs: int, length: int, seen: Counter) -> pa.Table:
    """The k best documents of a shard for each item of a block."""
    out = ([], [], [])
    if len(vectors) and len(items):
        entries = items.column("terms").combine_chunks()
        flat = entries.flatten()
        words = pc.unique(flat.field("term"))
        code = pc.index_in(flat.field("term"), words).to_numpy()
        weight = np.zeros(len(words), np.int64)
        weight[code] = flat.field("w").to_numpy()
        lists = vectors.column("terms").combine_chunks()
        doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        found = pc.index_in(lists.flatten(), words)
        ours = found.is_valid().to_numpy(zero_copy_only=False)
        term = found.drop_null().to_numpy().astype(np.int64)
        tf = vectors.column("tf").combine_chunks().flatten().to_numpy()[ours]
        shard = Shard(vectors.column("doc_id").combine_chunks(), vectors.column("n").to_numpy(), term, tf, doc[ours],
                      weight, docs, length)
        ends = entries.offsets.to_numpy() - entries.offsets[0].as_py()
        for i, (item, bar) in enumerate(zip(items.column("item").to_pylist(), items.column("bar").to_pylist())):
            mine = code[ends[i]:ends[i + 1]]
            best, score = shard.top(mine[np.argsort(-weight[mine], kind="stable")], bar, k, seen)
            out[0].append(np.full(len(best), item))
            out[1].append(shard.ids.take(pa.array(best)))
            out[2].append(score)
    if not out[0]:
        return OUT.empty_table()
    return pa.table([pa.array(np.concatenate(out[0]), pa.int64()), pa.concat_arrays(out[1]).cast(pa.int64()),
                     pa.array(np.concatenate(out[2]), pa.int64())], schema=OUT)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    ship_code(docs.sparkSession)
    asked = written(pick(items, "item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    wanted = written(counted(asked, "item").withColumnRenamed("key", "item"), "item-terms")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors = written(counted(texts, "doc_id", term_filter(wanted)).withColumnRenamed("key", "doc_id"), "vectors")
    n, length, held, postings = vectors.agg(
        F.count("*"), F.sum("n"), F.count_if(F.size("terms") > 0), F.sum(F.size("terms"))).first()
    n, length = n or 0, length or 1

    # one aggregate of partial counts: how many documents hold a term, by steps of its impact
    pairs = wanted.select("item", F.explode("terms").alias("term"))
    steps = vectors.select("n", F.explode(F.arrays_zip("terms", "tf")).alias("p")).select(
        F.col("p.terms").alias("term"), F.expr(f"{impact('p.tf', 'n', n, length)} div {STEP}").alias("step")) \
        .groupBy("term", "step").agg(F.count("*").alias("rows"))
    down = Window.partitionBy("term").orderBy(F.desc("step"))
    known = steps.withColumn("above", F.sum("rows").over(down)).groupBy("term").agg(
        F.sum("rows").alias("df"), F.max(F.when(F.col("above") >= k, F.col("step") * STEP)).alias("least"))
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighed = pairs.join(known, "term").withColumn("w", weight).groupBy("item").agg(
        F.collect_list(F.struct("term", "w")).alias("terms"),
        F.coalesce(F.max(F.col("w") * F.col("least")), F.lit(0)).alias("bar"))
    weighed = written(weighed, "weighed-items")

    total = weighed.agg(F.sum(F.size("terms"))).first()[0]
    shards = max(parts_for(held, SHARD), parts_for(postings, POSTINGS))
    blocks = parts_for(total, ITEM_TERMS)
    cell = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    left = vectors.filter(F.size("terms") > 0).withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards))) \
        .withColumn("block", cell(blocks))
    right = weighed.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))).withColumn("shard", cell(shards))

    def search(vectors: pa.Table, items: pa.Table) -> pa.Table:
        return search_cell(vectors, items, k, n, length, Counter())

    found = cogrouped(left, right, "shard", "block").applyInArrow(search, OUT_DDL)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
