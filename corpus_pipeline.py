"""A training corpus from raw documents: five stages, each one operator on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of documents.

Defined cases: doc_id and text are the key, and a null doc_id is an id like any
other; so each row goes or stays by its own text. The near-duplicate stage
leaves one row of each key; mixing may repeat a row. Redaction goes by text.
Null and empty texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.bpe import bpe_encode
from rollcall.llm.mixing import label_domains, mix
from rollcall.llm.near_dup import near_duplicates
from rollcall.llm.quality import quality_scores
from rollcall.llm.queries import TARGETS, tokenizer_path
from rollcall.llm.secret_scan import redacted, secret_scan
from rollcall.llm.store import table, written


REPEATS = 8     # times at most that mixing takes one document: what earlier stages left little of is not repeated further


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the threshold of their language."""
    gone = quality_scores(docs, table(spark, sf_dir, "labels")).filter(~F.col("kept")).select(
        F.col("doc_id").alias("id"), F.col("lang").alias("of"), "text_hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.coalesce("lang", F.lit("")) == F.col("of")) \
        & (F.xxhash64("text") == F.col("text_hash"))
    return docs.join(gone, same, "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, of its smallest id: five-word shingles, similarity 0.8."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", F.xxhash64("text")))
    ids = keyed.groupBy("_key").agg(F.min("doc_id").alias("id"), F.count("*").alias("_rows"))
    found = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), width=5, percent=80) \
        .select(F.col("doc_id").alias("_key"), "component_id").distinct()
    best = found.join(ids, "_key").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "_key", "_rows")).alias("best"))
    best = written(best.select("best._key", "best._rows"), "kept")
    once = keyed.join(best.filter("_rows = 1"), "_key", "left_semi")
    more = keyed.join(best.filter("_rows > 1"), "_key", "left_semi").dropDuplicates(["_key"])
    return once.unionByName(more).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced, and n_chars of what is left."""
    found = secret_scan(docs).filter("spans != ''").select("text_hash", "spans").dropDuplicates(["text_hash"])
    joined = docs.join(found, F.xxhash64("text") == F.col("text_hash"), "left")
    clean = {"text": redacted(F.col("text"), F.col("spans"))}
    clean["n_chars"] = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length(clean["text"]).cast("long"))
    return joined.select(*[(clean[c].alias(c) if c in clean else F.col(c)) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or dropped so that domain tokens meet the target shares, as far as REPEATS
    allows; those judged clean stay once."""
    drawn = mix(docs, label_domains(table(spark, sf_dir, "labels")), TARGETS, anchor="clean", most=REPEATS)
    times = drawn.filter("copies != 1").select(F.col("doc_id").alias("id"), "text_hash", "copies").dropDuplicates(["id", "text_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("text_hash"))
    rows = docs.join(times, same, "left").withColumn("copies", F.coalesce("copies", F.lit(1))).filter("copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, by their digests."""
    return bpe_encode(docs, tokenizer_path())


STAGES = [("quality classifier", quality), ("near duplicates", near_dedup), ("secret scan", secrets),
          ("mixing", mixture), ("bpe", encode)]

# the stages learn models and find components, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
