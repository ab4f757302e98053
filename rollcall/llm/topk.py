"""Exact top-k by inner product with MaxScore.

Terms are the dimensions, a query's weights its components; a candidate's
contribution to a term lies between the term's bounds in its shard. Per query
and shard the terms are split: the non-essential ones are the largest set
(smallest spans first) whose upper bounds, with every essential term at its
lower bound, still stay below the score of the k-th best so far; a candidate
that is in no essential posting (above the lower bound) cannot enter. The
essential postings are traversed, the other terms probed in falling order of
span only for candidates that are still competitive, and shards are merged.

Candidates and queries are dealt over a grid of (shard, block of queries):
every cell has a bounded number of both, whatever the table's size, and gives
k rows a query at most. The merge keeps k rows a query in each task before it
shuffles. Integer scores are exact; they must fit 64 bits. Where bounds could
exceed them, a cell is scored without any.

Defined cases: a vector that is null or holds null, NaN or infinite
components, or has no id, takes no part; vectors of other lengths are padded
with zeros; a query row meets all rows but itself, so repeated ids are separate
candidates and queries; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import cogrouped, parts_for, pick, ship_code, written

SHARD = 8192          # candidates of a cell
QUERIES = 1024        # queries of a cell
BLOCK = 2048          # candidates scored at a time; the bar rises from block to block
PROBES = 8            # terms probed between two looks at who is still competitive

OUT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
OUT_DDL = "query_row long, query_id long, vec_id long, score long"


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double; null where a component is null or not finite."""
    ok = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(ok, F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    out = np.zeros((len(lists), width), np.int64)
    col = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], lists.type)
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def top_of_shard(x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, own: int, k: int,
                 bounded: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best candidates of one query but row ``own``, ties to smaller ids.

    ``x`` has a row for each term and a column for each candidate, columns by
    id. Without ``bounded`` every candidate is scored in full.
    """
    ends = np.stack([q * x.min(1), q * x.max(1)])
    low, high = ends.min(0), ends.max(0)
    order = np.argsort(low - high, kind="stable")           # widest span first
    low, high, terms, w = low[order], high[order], order, q[order]
    rest = np.concatenate([np.cumsum(high[::-1])[::-1], [0]])   # most that terms from i on can add
    least = np.concatenate([[0], np.cumsum(low)])
    best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, x.shape[1], BLOCK):
        block = x[:, at:at + BLOCK]
        bar = best[-1] if bounded and len(best) == k else None
        # the first i terms are essential: i is the least for which all others can't lift a candidate to the bar
        i = len(terms) if bar is None else int(np.argmax(least + rest < bar)) if (least + rest < bar).any() else len(terms)
        i = max(i, 1)
        score = w[:i] @ block[terms[:i]]
        live = np.flatnonzero(rows[at:at + BLOCK] != own)
        if bar is not None:
            live = live[(score[live] > least[i]) & (score[live] + rest[i] >= bar)] if least[i] + rest[i] < bar \
                else live[score[live] + rest[i] >= bar]
        score = score[live]
        while i < len(terms) and len(live):
            j = min(i + PROBES, len(terms))
            score = score + w[i:j] @ block[np.ix_(terms[i:j], live)]
            i = j
            if bar is not None:
                keep = score + rest[i] >= bar
                live, score = live[keep], score[keep]
        if len(live):
            best_ids = np.concatenate([best_ids, ids[at + live]])
            best = np.concatenate([best, score])
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
    return best_ids, best


def maxscore_topk(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row."""
    ship_code(vectors.sparkSession)
    rows = written(pick(vectors, "vec_id", "embedding").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        quantised(F.col("embedding"), scale).alias("v")).filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()), "vectors")
    n, n_queries, width = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    shards, blocks, width = parts_for(n, SHARD), parts_for(n_queries, QUERIES), max(width or 0, 1)
    cell = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    candidates = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "row"), F.lit(shards))) \
        .withColumn("block", cell(blocks))
    queries = rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))) \
        .withColumn("shard", cell(shards))

    def score(cands: pa.Table, qs: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if len(cands) and len(qs):
            ids, rows_of = cands.column("vec_id").to_numpy(), cands.column("row").to_numpy()
            x = matrix(cands.column("v"), width)
            by_id = np.argsort(ids, kind="stable")
            ids, rows_of, x = ids[by_id], rows_of[by_id], x[by_id].T
            y = matrix(qs.column("v"), width)
            most = float(np.abs(x).max()) * float(np.abs(y).max()) * width
            if most < 2 ** 52:
                x, y = x.astype(np.float64), y.astype(np.float64)      # exact there, and far faster
            x = np.ascontiguousarray(x)
            for row, own, q in zip(qs.column("row").to_pylist(), qs.column("vec_id").to_pylist(), y):
                got, scores = top_of_shard(x, ids, rows_of, q, row, k, most < 2 ** 62)
                for o, v in zip(out, (np.full(len(got), row), np.full(len(got), own), got, scores)):
                    o.append(v)
        return pa.table([pa.array(np.concatenate(o).astype(np.int64) if o else [], pa.int64()) for o in out], schema=OUT)

    found = cogrouped(candidates, queries, "shard", "block").applyInArrow(score, OUT_DDL)
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
