"""Hard negatives by Kronecker-packed products.

Components are whole numbers. In a cell the smallest component is taken off all
of them, on either side, so none is negative; several candidates' components of
one coordinate are then set side by side into fields of one wide integer. One
multiplication by an anchor's component multiplies all fields, and the sum over
the coordinates has each candidate's product in its own field: a field is as
wide as the largest sum needs, so none runs into the next. Unpacked, and with
the bias taken back (ac = (a - A)(c - B) + aB + Ac - AB, summed), the products
are exact. Words have 64 bits where two fields fit, else they are Python
integers of WIDE fields: components of any size give exact scores.

An anchor's positives are its best rows of its own label; with their scores
known, a second pass over all rows finds each (anchor, positive) the best rows
of other labels whose scores lie in the positive's range. Both passes deal
rows over a grid of (shard, block of anchors), the first by label too, each
label cut into shards of a bounded number of rows, so a label that holds most
rows is many cells. Every cell gives k rows an anchor or positive at most, and
the merges keep k in each task before they shuffle.

Defined cases: rows with a null id, label or vector, or a null, NaN or infinite
component take no part; vectors of other lengths are padded with zeros; an
anchor's other rows are all rows but itself, so repeated ids are separate rows
and anchors; equal scores go by id; an anchor without positives, and a positive
without negatives, has no rows; scores must fit 64 bits; empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import cogrouped, parts_for, pick, ship_code, written
from rollcall.llm.topk import matrix, quantised

SHARD = 2048            # rows of a cell
ANCHORS = 4096          # anchors of a cell
LINES = 256             # anchors multiplied at a time
WIDE = 16               # fields of a word of Python integers

POSITIVE = pa.schema([("anchor", pa.int64()), ("positive_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
POSITIVE_DDL = "anchor long, positive_id long, row long, score long"
NEGATIVE = pa.schema([("anchor", pa.int64()), ("place", pa.int64()), ("negative_id", pa.int64()), ("row", pa.int64()),
                      ("score", pa.int64())])
NEGATIVE_DDL = "anchor long, place long, negative_id long, row long, score long"


class Packed:
    """Candidates (rows of ``c``) packed for products with anchors whose components lie in low..high."""

    def __init__(self, c: np.ndarray, low: int, high: int):
        self.count, self.size = c.shape
        self.off, self.low = int(c.min(initial=0)), low         # both are taken off, so nothing is negative
        most = self.size * (int(c.max(initial=0)) - self.off) * (high - low)
        self.width = max(1, most.bit_length())
        self.kind = np.uint64 if self.width <= 32 else object
        self.fields = 64 // self.width if self.width <= 32 else WIDE
        self.sum = self.total(c)
        words = -(-self.count // self.fields)
        lifted = np.full((words * self.fields, self.size), 0, self.kind)
        lifted[:self.count] = self.lift(c, self.off)
        lifted = lifted.reshape(words, self.fields, self.size)
        self.words = np.zeros((self.size, words), self.kind)
        for f in range(self.fields):
            self.words += (lifted[:, f] * self.step(f)).T

    def lift(self, x: np.ndarray, off: int) -> np.ndarray:
        """x - off, which is not negative."""
        if self.kind is object:
            return x.astype(object) - off
        return x.astype(np.uint64) - np.uint64(off % 2 ** 64)     # wraps, and so is right for any sign

    def total(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(object) if self.kind is object else x).sum(1)

    def step(self, field: int):
        return 1 << field * self.width if self.kind is object else np.uint64(1 << field * self.width)

    def scores(self, a: np.ndarray) -> np.ndarray:
        """Exact inner products, a row for each anchor and a column for each candidate."""
        products = self.lift(a, self.low) @ self.words          # one product an anchor component and word
        fields = np.empty((len(a), products.shape[1], self.fields), self.kind)
        mask = self.step(1) - 1 if self.kind is object else np.uint64((1 << self.width) - 1)
        for f in range(self.fields):
            fields[:, :, f] = (products // self.step(f)) & mask if self.kind is object else \
                products >> np.uint64(f * self.width) & mask
        out = fields.reshape(len(a), -1)[:, :self.count]
        bias = self.off * self.total(a)[:, None] + self.low * self.sum[None, :] - self.size * self.off * self.low
        return ((out if self.kind is object else out.astype(np.int64)) + bias).astype(np.int64)


def components(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, of 64-bit integers."""
    return matrix(lists, width)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
        return near[np.lexsort((rows[near], ids[near], -scores[near]))[:k]]
    return np.lexsort((rows, ids, -scores))[:k]


def blocks_of(rows: pa.Table, anchors: pa.Table, width: int):
    """(first anchor, scores of LINES anchors against all rows of the cell)."""
    a = components(anchors.column("v"), width)
    packed = Packed(components(rows.column("v"), width), int(a.min(initial=0)), int(a.max(initial=0)))
    for at in range(0, len(a), LINES):
        yield at, packed.scores(a[at:at + LINES])


def joined(out: list[tuple], schema: pa.Schema) -> pa.Table:
    if not out:
        return schema.empty_table()
    return pa.table([pa.array(np.concatenate([np.atleast_1d(x) for x in c]), pa.int64()) for c in zip(*out)], schema=schema)


def positives_in(rows: pa.Table, anchors: pa.Table, width: int, k: int) -> pa.Table:
    """The k best rows of a cell, all of the anchors' label, for each anchor but itself."""
    out = []
    if len(rows) and len(anchors):
        ids, row = rows.column("id").to_numpy(), rows.column("row").to_numpy()
        own = anchors.column("row").to_numpy()
        for at, scores in blocks_of(rows, anchors, width):
            for i, s in enumerate(scores):
                others = np.flatnonzero(row != own[at + i])
                top = others[best(s[others], ids[others], row[others], k)]
                out.append((np.full(len(top), own[at + i]), ids[top], row[top], s[top]))
    return joined(out, POSITIVE)


def negatives_in(rows: pa.Table, anchors: pa.Table, width: int, k: int, least: int, most: int) -> pa.Table:
    """For each of the anchors' positives the k best rows of a cell that have another label and a score in range."""
    out = []
    if len(rows) and len(anchors):
        ids, row, label = (rows.column(c).to_numpy() for c in ("id", "row", "label"))
        own, own_label = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        wanted = anchors.column("positives").to_pylist()
        for at, scores in blocks_of(rows, anchors, width):
            for i, s in enumerate(scores):
                mine = wanted[at + i]
                # whole-number bounds of the scores in a positive's range: least * p <= 100 n <= most * p
                ranges = [(-(-least * p["score"] // 100), most * p["score"] // 100) for p in mine]
                low, high = min(r[0] for r in ranges), max(r[1] for r in ranges)
                near = np.flatnonzero((s >= low) & (s <= high) & (label != own_label[at + i]))
                near = near[np.lexsort((row[near], ids[near], -s[near]))]
                down = -s[near]
                for p, (lo, hi) in zip(mine, ranges):
                    a, z = np.searchsorted(down, -hi, "left"), np.searchsorted(down, -lo, "right")
                    top = near[a:min(z, a + k)] if lo <= hi else near[:0]
                    if len(top):
                        out.append((np.full(len(top), own[at + i]), np.full(len(top), p["place"]), ids[top], row[top], s[top]))
    return joined(out, NEGATIVE)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
                   scale: int = 256, least: int = 80, most: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` are expressions over vec_id and label; a
    negative's score is ``least`` to ``most`` hundredths of the positive's.
    """
    ship_code(vectors.sparkSession)
    rows = pick(vectors, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), is_anchor.alias("is_anchor"),
        quantised(F.col("embedding"), scale).alias("v")).filter("v IS NOT NULL AND id IS NOT NULL AND label IS NOT NULL")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    cell = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c) - 1))
    side = lambda df, *cols: df.select(*[F.col(c).alias(c) for c in cols])  # noqa: E731  columns of its own in a cogroup

    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("n_anchors"),
                                      F.max(F.size("v")).alias("width"))
    sizes = sizes.select("label", "n", "n_anchors", "width", F.ceil(F.col("n") / SHARD).alias("shards"),
                         F.ceil(F.greatest(F.col("n_anchors"), F.lit(1)) / ANCHORS).alias("blocks"))
    sizes = written(sizes, "label-sizes")
    n, n_anchors, width = sizes.agg(F.sum("n"), F.sum("n_anchors"), F.max("width")).first()
    n, n_anchors, width = n or 0, n_anchors or 0, width or 0
    key = F.xxhash64("row")

    sized = rows.join(sizes.select("label", "shards", "blocks"), "label")
    left = sized.withColumn("shard", F.pmod(key, "shards")).withColumn("block", cell(F.col("blocks")))
    left = side(left, "label", "shard", "block", "id", "row", "v")
    right = sized.filter("is_anchor").withColumn("block", F.pmod(key, "blocks")).withColumn("shard", cell(F.col("shards")))
    right = side(right, "label", "shard", "block", "row", "v")
    found = cogrouped(left, right, "label", "shard", "block").applyInArrow(
        lambda r, a: positives_in(r, a, width, positives), POSITIVE_DDL)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "row")
    found = found.withColumn("place", F.row_number().over(order).cast("long")).filter(F.col("place") <= positives)
    found = written(found.select("anchor", "place", "positive_id", "score"), "positives")

    known = found.groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("positives"))
    anchors = rows.filter("is_anchor").join(known, F.col("row") == F.col("anchor")).select("row", "label", "v", "positives")
    shards, blocks = parts_for(n, SHARD), parts_for(n_anchors, ANCHORS)
    left = rows.withColumn("shard", F.pmod(key, F.lit(shards))).withColumn("block", cell(blocks))
    left = side(left, "shard", "block", "id", "row", "label", "v")
    right = anchors.withColumn("block", F.pmod(key, F.lit(blocks))).withColumn("shard", cell(shards))
    right = side(right, "shard", "block", "row", "label", "v", "positives")
    hard = cogrouped(left, right, "shard", "block").applyInArrow(
        lambda r, a: negatives_in(r, a, width, negatives, least, most), NEGATIVE_DDL)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "negative_id", "row")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives) \
        .select("anchor", "place", "rank", "negative_id", F.col("score").alias("negative_score"))
    return hard.join(found.withColumnRenamed("score", "positive_score"), ["anchor", "place"]) \
        .join(rows.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                "negative_score")
