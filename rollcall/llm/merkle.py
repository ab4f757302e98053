"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line. Its leaves are pieces of up to ``PIECE_WORDS`` words, so
that an edit within a long paragraph can be located too. A paragraph's digest
covers its leaves, a section's its paragraphs, the root the sections. Sections
are cut by content: a paragraph whose digest ends in 0 or 8 closes one, so an
edit moves no border elsewhere. Every character belongs to a piece and digests
are SHA-256, so equal roots mean equal texts.

A fingerprint is the whole tree in short form, ``root|section:...``: the root
digest in full, then per section its paragraphs parted by ``;`` and their
leaves parted by ``,``, each digest cut to ``SHORT`` hex digits, with the
section's own before a colon. Likeness is the share of equal leaves (Jaccard);
``changed_sections`` walks down the branches that differ.

Everything is built-in SQL functions. Defined cases: a null text is empty, and
an empty text has one empty tree; rows with a null id come last in the order of
ids; of repeated ids the order is by text; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.store import parts_for, pick

PIECE_WORDS = 8
SHORT = 10
CLOSES = "08"             # last hex digits of a paragraph digest that end a section
BUCKET_CHARS = 4_000_000  # text of a run of neighbouring ids


def digest(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)


def paragraphs(text: Column) -> Column:
    """Lines, each with the line break that ends it, except for an empty rest."""
    return F.filter(F.split(text, "(?<=\n)", -1), lambda p: p != "")


def pieces(paragraph: Column) -> Column:
    """Runs of up to PIECE_WORDS words with the white space that follows; a leading blank run is one too."""
    return F.regexp_extract_all(paragraph, F.lit(rf"(?:\S++\s*+){{1,{PIECE_WORDS}}}+|\s++"), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The tree of a text as a string.

    Leaf digests are full until their paragraph's is taken; in the string they are short.
    """
    text = F.coalesce(text, F.lit(""))
    # a paragraph: its digest, a colon, its leaves
    shown = F.transform(paragraphs(text), lambda p: F.struct(
        F.transform(pieces(p), digest).alias("leaves")))
    shown = F.transform(shown, lambda s: F.concat(
        digest(F.array_join(s["leaves"], "")), F.lit(":"),
        F.array_join(F.transform(s["leaves"], lambda d: F.substring(d, 1, SHORT)), ",")))
    # sections end behind a paragraph whose digest closes one
    marked = F.transform(shown, lambda s: F.when(F.substring(s, 64, 1).isin(*CLOSES), F.concat(s, F.lit("/"))).otherwise(
        F.concat(s, F.lit(";"))))
    sections = F.filter(F.split(F.array_join(marked, ""), "/", -1), lambda s: s != "")
    # of a section the digests of its paragraphs count; their leaves are shown
    listed = F.transform(sections, lambda s: F.concat(
        digest(F.array_join(F.regexp_extract_all(s, F.lit("([0-9a-f]{64}):"), F.lit(1)), "")), F.lit(":"),
        F.rtrim(F.regexp_replace(s, "[0-9a-f]{64}:", ""), F.lit(";"))))
    root = digest(F.array_join(F.transform(listed, lambda s: F.substring(s, 1, 64)), ""))
    return F.concat_ws("|", root, F.array_join(
        F.transform(listed, lambda s: F.concat(F.substring(s, 1, SHORT), F.substring(s, 65, 1 << 30))), "|"))


def root(print_: Column) -> Column:
    return F.substring(print_, 1, 64)


def leaves(print_: Column) -> Column:
    """The leaf digests of a fingerprint."""
    return F.filter(F.split(F.regexp_replace(F.substring(print_, 66, 1 << 30), rf"(^|\|)[0-9a-f]{{{SHORT}}}:", ","), "[,;]", -1),
                    lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal leaves of two fingerprints, 1 for equal roots."""
    x, y = leaves(a), leaves(b)
    both, either = F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))
    return F.when(root(a) == root(b), F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both / either)


def changed_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections of ``a`` whose branch isn't in ``b``; empty for equal roots."""
    sections = lambda p: F.transform(F.slice(F.split(p, r"\|", -1), 2, 1 << 30), lambda s: F.substring(s, 1, SHORT))
    known = sections(b)
    every = F.transform(sections(a), lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(
        F.transform(F.filter(every, lambda x: ~F.array_contains(known, x["s"])), lambda x: x["i"]))


def with_next(docs: DataFrame, cols: list[str]) -> DataFrame:
    """Rows (doc_id, *cols) with the next row's columns as ``next_<col>``, descending doc_id, the last followed by the first.

    Ids are cut into runs of even width, about BUCKET_CHARS of text each, and
    every run is ordered by itself. A run's last row is followed by the first
    of the run below: those few rows (one a run) are found by their ids and
    put behind the run as guests.
    """
    lo, hi, chars, nulls = docs.agg(F.min("doc_id"), F.max("doc_id"), F.sum(F.length("text")),
                                    F.count_if(F.col("doc_id").isNull())).first()
    runs = parts_for(chars, BUCKET_CHARS)
    width = ((hi - lo) // runs + 1) if lo is not None else 1
    run = F.coalesce(F.floor((F.col("doc_id") - F.lit(lo or 0)) / F.lit(width)).cast("long"), F.lit(-1))
    base = docs.select("doc_id", *cols, run.alias("run"), F.lit(0).alias("guest"))
    # (run, id of the first row of the run below): one row a run, ids only
    heads = base.groupBy("run").agg(F.max("doc_id").alias("head"))
    below = Window.orderBy(F.desc("run"))
    top = heads.agg(F.max(F.struct("run", "head")).alias("t")).select("t.head")
    after = heads.select("run", F.lead("run").over(below).alias("next_run"), F.lead("head").over(below).alias("head"))
    first = hi
    after = after.withColumn("next_run", F.coalesce("next_run", F.lit((first - lo) // width if first is not None else -1))) \
        .withColumn("head", F.when(F.col("head").isNull() & (F.col("next_run") != -1), F.lit(first)).otherwise(F.col("head")))
    guests = base.alias("b").join(
        F.broadcast(after.select(F.col("run").alias("of_run"), "next_run", "head")),       # 24 bytes for each run of text
        (F.col("b.run") == F.col("next_run")) & F.col("b.doc_id").eqNullSafe(F.col("head"))) \
        .select("doc_id", *cols, F.col("of_run").alias("run"), F.lit(1).alias("guest"))
    order = Window.partitionBy("run").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    following = F.lead(F.struct(*cols)).over(order)
    out = base.unionByName(guests).withColumn("next", following).filter("guest = 0")
    return out.select("doc_id", *cols, *[F.col(f"next.{c}").alias(f"next_{c}") for c in cols])


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last third replaced by as many first code points of ``other``, or all of them."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(other, F.lit(1), cut))


def merkle_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_changed.

    ``n_changed`` counts the sections that the edit touched. A tree is built
    before the rows are ordered and travels with its text, so the next row's
    isn't built again.
    """
    base = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"),
                                               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(base.withColumn("print", fingerprint(F.col("text"))), ["text", "print"])
    changed = edited(F.col("text"), F.coalesce("next_text", F.lit("")))
    out = pairs.withColumn("edited", changed).withColumn("edited_print", fingerprint(F.col("edited")))
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), digest(F.col("edited")).alias("edited_sha256"),
                      F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
                      likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                      likeness(F.col("print"), F.coalesce("next_print", "print")).alias("near_next"),
                      F.size(changed_sections(F.col("print"), F.col("edited_print"))).cast("long").alias("n_changed"))
