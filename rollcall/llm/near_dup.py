"""Near-duplicate documents: MinHash bands propose, odd sketches screen, full sets decide.

1. One pass over the texts gives every row its number of shingles, a digest of
   its shingle set, the band keys of its MinHash samples and an odd sketch: a
   bitmap in which every sample flips one bit, so that the population count of
   two sketches' XOR estimates how many samples differ. A wider parity bitmap
   of the whole set does the same for the shingles themselves.
2. Rows with equal sets are one class, which gets a number of its own and is shown by the
   text of one row, that with its smallest doc_id; only classes go on, so copies are never compared.
3. Representatives that share a band key form a bucket. Buckets are cut into
   chunks of bounded size. A pair is close if its sizes allow a link, its sketches
   are near enough and then its sets' bitmaps are (five standard deviations of
   either granted; no more bits than shingles can differ). Close
   pairs are proposed in two rounds and confirmed on the full sets; what is
   connected by then is not proposed again. The first round proposes a forest of
   stars around each chunk's centre, the member that is closest to the others on
   average: near copies of one text mostly link to it. The second proposes every
   close pair that is left between different components, over the grid of a large
   bucket's chunks. So no link between components is left out, and a group of
   near copies costs about one test a member instead of one a pair.
4. Components come from alternating large-star and small-star steps on tables.

Bands are chosen so that a pair at the threshold shares none of them with a
probability below one in a million.

Defined cases: a null text, or one without words, has an empty set, is linked
with nothing and is kept. Every row is placed by its own text: rows that repeat a doc_id
with other texts may be in different components, and a row with a null doc_id links like any
other. A component is named by the smallest doc_id that is not null; one of null ids alone has a
null name, and its rows are kept, since there is no id to keep one by (give such rows keys, as the
pipeline does). Rows that repeat doc_id and text get the same answer. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.store import pick, releasing, ship_code, written

SAMPLES = 120
SKETCH_BITS = 512
SET_BITS = 2048           # parity bitmap of a whole set
MISS = 1e-6               # chance that a pair at the threshold shares no band
CHUNK = 1024              # members of a bucket that are compared in one place
SLICE_BYTES = 1_000_000   # text that is hashed at a time

_R = np.random.RandomState(20240611)
BYTE = _R.randint(1, 2 ** 63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 2 ** 64))
MULT = (_R.randint(0, 2 ** 31 - 1, SAMPLES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
ADD = _R.randint(0, 2 ** 31 - 1, SAMPLES).astype(np.uint32)
PLACE = _R.randint(0, 2 ** 31 - 1, 8).astype(np.uint64) * np.uint64(2 ** 33) + np.uint64(0x5851F42D4C957F2D)
LETTER_GAP = 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def band_rows(threshold: float, samples: int = SAMPLES) -> int:
    """Samples a band: the most for which a pair at the threshold is missed with a chance of MISS at most."""
    return max([r for r in range(1, samples + 1) if (1 - threshold ** r) ** (samples // r) <= MISS], default=1)


def sketch_limit(threshold: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Most differing bits of a pair that may still be linked, five standard deviations granted."""
    spread = math.sqrt(threshold * (1 - threshold) / samples + 0.016 ** 2)
    differ = 2 * samples * (1 - max(0.0, threshold - 5 * spread))
    return math.ceil(bits / 2 * (1 - (1 - 2 / bits) ** differ))


def set_limit(total: np.ndarray, percent: int, bits: int = SET_BITS) -> np.ndarray:
    """Most differing bits of two set bitmaps whose sets, ``total`` shingles together, may be linked.

    Linked sets differ in (1 - t) / (1 + t) of the total at most. Each such
    shingle flips one bit, so more bits can't differ; for large sets flips that
    cancel are allowed for.
    """
    t = percent / 100
    differ = np.floor(total * (1 - t) / (1 + t) + 1e-9)
    shown = bits / 2 * (1 - np.exp(-2 * differ / bits))
    spread = np.sqrt(bits / 4 * (1 - np.exp(-4 * differ / bits)))
    return np.minimum(differ, np.ceil(shown + 5 * spread))


def set_bitmaps(sets: list[np.ndarray], bits: int = SET_BITS) -> np.ndarray:
    """Parity bitmap of each (non-empty) set: every shingle flips one bit."""
    size = [len(s) for s in sets]
    bit = (np.concatenate(sets) >> np.uint64(7)) % np.uint64(bits)
    flips = np.bincount(np.repeat(np.arange(len(sets)), size) * bits + bit.astype(np.int64), minlength=len(sets) * bits)
    return np.packbits((flips & 1).astype(np.uint8).reshape(len(sets), bits), axis=1)


class Powers:
    """Powers of the hash base and of its inverse, as long as the longest slice so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            n = max(n, SLICE_BYTES + 1)
            up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INV, np.uint64)
            up[0] = down[0] = 1
            cls.up, cls.down = np.cumprod(up), np.cumprod(down)
        return cls.up, cls.down


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    Words are the runs without blank, tab and line characters, A-Z in lower
    case; a text of fewer words than ``width`` has its whole sequence as one.
    """
    size = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = data + upper * np.uint8(LETTER_GAP)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    up, down = Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:len(data)], out=total[1:])
    edge = np.diff(np.concatenate([[1], gap.view(np.int8)]))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(end) < len(start):
        end = np.append(end, len(data))
    word = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, np.cumsum(size) - size)          # first word of each text
    last = np.append(first[1:], len(start))
    n = len(word)
    run = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        run = run * np.uint64(0xD6E8FEB86659FD93) + word[i:i + len(run)]
    run = mixed(run)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= width:
            out.append(np.unique(run[a:b - width + 1]))
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    one = one * np.uint64(0xA0761D6478BD642F) + w
            out.append(mixed(np.array([one], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def samples_of(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, a row for each (non-empty) set."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SAMPLES), np.uint32)
    h = np.empty_like(flat)
    t = np.empty_like(flat)
    for j in range(SAMPLES):
        np.multiply(flat, MULT[j], out=h)
        h += ADD[j]
        np.right_shift(h, np.uint32(15), out=t)
        h ^= t
        h *= np.uint32(0x2C1B3C6D)
        np.minimum.reduceat(h, at, out=out[:, j])
    return out


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps: each (place, sample) flips one bit."""
    place = np.arange(samples.shape[1], dtype=np.uint64)
    bit = (mixed(samples.astype(np.uint64) * PLACE[0] + place * PLACE[1]) % np.uint64(bits)).astype(np.int64)
    flips = np.zeros((len(samples), bits), np.uint8)
    np.add.at(flips, (np.arange(len(samples))[:, None], bit), 1)
    return np.packbits(flips & 1, axis=1)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    bands = samples.shape[1] // rows
    key = np.zeros((len(samples), bands), np.uint64)
    for r in range(rows):
        key = key * PLACE[2] + samples[:, r:bands * rows:rows][:, :bands].astype(np.uint64)
    return mixed(key + np.arange(bands, dtype=np.uint64) * PLACE[3]).view(np.int64)


def byte_slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


SKETCHED_DDL = "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, sketch binary, parity binary"


def _sketcher(width: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()), ("parity", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for a, b in byte_slices(texts):
                sets = shingle_sets(texts[a:b], width)
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, bands, sketch, parity = ([None] * len(sets) for _ in range(4))
                if full:
                    sampled = samples_of([sets[i] for i in full])
                    maps = set_bitmaps([sets[i] for i in full])
                    for i, k, s, m in zip(full, band_keys(sampled, rows), odd_sketches(sampled), maps):
                        digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        bands[i], sketch[i], parity[i] = k, s.tobytes(), m.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a).cast(pa.int64()) for c in (0, 1)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
                     pa.array(parity, pa.binary())],
                    schema=schema)
    return run


SETS_DDL = "rep long, shingles binary"
SETS = pa.schema([("rep", pa.int64()), ("shingles", pa.binary())])


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for a, b in byte_slices(texts):
                raw = [s.tobytes() for s in shingle_sets(texts[a:b], width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int64()),
                                                  pa.array(raw, pa.binary())], schema=SETS)
    return run


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


STAR, ALL = "star", "all"


def close_pairs(group: np.ndarray, comp: np.ndarray, n: np.ndarray, sketch: np.ndarray, parity: np.ndarray,
                percent: int, limit: int, mode: str) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within groups (equal neighbours) that may be linked and are in different components.

    STAR gives the edges of a spanning forest, those of the most central members
    first; ALL gives every pair.
    """
    left, right, near = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    step = 1
    at = np.arange(len(group) - 1)
    while len(at):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        to = at + step
        ok = 100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to])
        if mode == ALL:
            ok &= comp[at] != comp[to]
        i, j = at[ok], to[ok]
        ok = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1) <= limit
        i, j = i[ok], j[ok]
        bits, most = np.bitwise_count(parity[i] ^ parity[j]).sum(1), set_limit(n[i] + n[j], percent)
        ok = bits <= most
        left.append(i[ok])
        right.append(j[ok])
        near.append((1 + most[ok] - bits[ok]) / (1 + most[ok]))
        step += 1
    i, j, close = map(np.concatenate, (left, right, near))
    if mode == ALL or not len(i):
        return i, j
    # a member's centrality: its summed closeness to the others
    central = np.bincount(i, close, len(group)) + np.bincount(j, close, len(group))
    order = np.lexsort((j, i, -close, -np.maximum(central[i], central[j])))
    order = order[comp[i[order]] != comp[j[order]]]
    root: dict[tuple[int, int], tuple[int, int]] = {}

    def find(x):
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    keep = []
    gl, cl = group.tolist(), comp.tolist()
    for e, x, y in zip(order.tolist(), i[order].tolist(), j[order].tolist()):
        x, y = find((gl[x], cl[x])), find((gl[y], cl[y]))
        if x != y:
            root[x] = y
            keep.append(e)
    return i[keep], j[keep]


def _proposer(percent: int, limit: int, mode: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def pairs(t: pa.Table) -> pa.RecordBatch:
            cols = {c: t.column(c).to_numpy() for c in ("cell", "rep", "comp", "n")}
            maps = [np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint64).reshape(len(t), -1) for c in ("sketch", "parity")]
            i, j = close_pairs(cols["cell"], cols["comp"], cols["n"], *maps, percent, limit, mode)
            x, y = cols["rep"][i], cols["rep"][j]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=PAIR)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            cells = t.column("cell").to_numpy()
            if not len(cells):
                continue
            # the last cell may go on in the next batch
            others = np.flatnonzero(cells != cells[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield pairs(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and len(held):
            yield pairs(held)
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def are_stars(e: DataFrame) -> bool:
    """Whether distinct edges (u, v), u > v, are stars around their smallest nodes: each u has one v, and no v is a u."""
    ends = e.groupBy("u").agg(F.count("*").alias("n"))
    return ends.filter("n > 1").select("u").unionByName(
        e.select(F.col("v").alias("u")).join(ends, "u", "left_semi")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps, each a grouped minimum and a
    join on written tables, until the edges are stars. Edges that are stars already
    take no step: looking costs the driver and the disk less than a round that changes nothing.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    while not are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hop = large.join(low, "u")
        e = written(hop.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                    .select("x.u", "x.v").filter("u != v").distinct(), "small-star")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Documents are linked where 100 * intersection >= ``percent`` * union of
    their sets of ``width``-word shingles.
    """
    ship_code(docs.sparkSession)
    rows, limit = band_rows(percent / 100), sketch_limit(percent / 100)
    base = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                                               F.col("text").cast("string"))
    every = written(base.mapInArrow(releasing(_sketcher(width, rows)), SKETCHED_DDL), "sketched")
    shown = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    # the numbers hold because the table is written: what reads it never counts again
    classes = written(every.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        shown.alias("shown"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"), F.first("parity").alias("parity"))
        .select("digest", F.monotonically_increasing_id().alias("rep"), "shown.doc_id", "shown.text_hash",
                "n", "bands", "sketch", "parity"), "classes")
    member = classes.select("rep", F.posexplode("bands").alias("band", "key")) \
        .select("rep", F.xxhash64("band", "key").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    buckets = written(member.join(shared, "bucket").join(classes.select("rep", "n", "sketch", "parity"), "rep"), "buckets")
    chunks = F.ceil(F.col("m") / CHUNK).cast("int")
    chunk = F.pmod(F.xxhash64("rep"), chunks).cast("int")

    def proposed(members: DataFrame, mode: str) -> DataFrame:
        # a large bucket is a grid of chunk pairs; the forests take its diagonal
        other = F.explode(F.sequence(F.lit(0), chunks - 1)) if mode == ALL else chunk
        cells = members.withColumn("x", chunk).withColumn("y", other).withColumn(
            "cell", F.xxhash64("bucket", F.least("x", "y"), F.greatest("x", "y")))
        return cells.select("cell", "rep", "comp", "n", "sketch", "parity").repartition("cell").sortWithinPartitions("cell") \
            .mapInArrow(releasing(_proposer(percent, limit, mode)), "a long, b long").distinct()

    first = written(proposed(buckets.withColumn("comp", F.col("rep")), STAR), "pairs")
    ends = first.select(F.explode(F.array("a", "b")).alias("rep")) \
        .unionByName(buckets.filter(F.col("m") > CHUNK).select("rep")).distinct()
    wanted = classes.select("rep", F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).join(ends, "rep")
    sets = written(base.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h")))
                   .select("rep", "text").mapInArrow(releasing(_full_sets(width)), SETS_DDL).dropDuplicates(["rep"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a") \
            .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b") \
            .select("a", "b", "sa", "sb")
        return both.mapInArrow(releasing(_confirm(percent)), "a long, b long, linked boolean")

    tested = written(confirmed(first), "tested")
    stars = components(tested.filter("linked").select("a", "b")).withColumnRenamed("component", "label")
    named = buckets.join(stars, buckets["rep"] == stars["node"], "left") \
        .withColumn("comp", F.coalesce("label", "rep")).drop("node", "label")
    # buckets whose members are all connected need no second look
    apart = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket")
    pairs = proposed(named.join(apart, "bucket", "left_semi"), ALL).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    tested = tested.unionByName(written(confirmed(pairs), "tested"))
    parts = components(tested.filter("linked").select("a", "b"))
    part = classes.select("digest", "rep", "doc_id").join(parts, F.col("rep") == F.col("node"), "left") \
        .select("digest", F.coalesce("component", "rep").alias("part"), "doc_id")
    names = part.groupBy("part").agg(F.min("doc_id").alias("component"))
    of_class = part.join(names, "part").select("digest", "component")
    out = every.join(of_class, "digest", "left") \
        .select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
