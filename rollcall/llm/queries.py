"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.bpe import bpe_encode
from rollcall.llm.kronecker import hard_negatives
from rollcall.llm.language_crf import identify_language
from rollcall.llm.lemp import lexical_search
from rollcall.llm.licenses import license_scan
from rollcall.llm.merkle import merkle_fingerprints
from rollcall.llm.mixing import label_domains, mix
from rollcall.llm.near_dup import near_duplicates
from rollcall.llm.pii import personal_data
from rollcall.llm.quality import quality_scores
from rollcall.llm.secret_scan import secret_scan
from rollcall.llm.store import table
from rollcall.llm.topk import maxscore_topk
from rollcall.llm.warc import warc_round_trip

TOKENIZER = "word_bpe_49k.json"
TARGETS = {"clean": 0.92, "toxic": 0.05, "junk": 0.03}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op5_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    held = F.coalesce(held, F.lit(False))          # a document without an id teaches
    return identify_language(docs, docs.filter(~held).select("lang", "text")).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")), TARGETS).drop("text_hash")


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_fingerprints(table(spark, sf_dir, "documents"))


def op10_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op11_lemp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("matches")


def op13_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_warc_dictionary, op3_quality_classifier, op4_personal_data, op5_maxscore_topk, op6_bpe,
    op7_language_crf, op8_mixing, op9_merkle, op10_odd_sketch, op11_lemp_search, op12_license_index,
    op13_kronecker_negatives)}

ORACLE_SQL = {
    "op2_warc_dictionary": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        best AS (
            SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < top THEN top END AS refers_to
        FROM p LEFT JOIN best USING (payload_digest)""",
    "op5_maxscore_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_lemp_search": """
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents),
        size AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
        whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS len FROM size),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
        q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
        w AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, whole),
        s AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // len))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN tf USING (term) JOIN size USING (doc_id), whole
            GROUP BY 1, 2),
        r AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op13_kronecker_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.w, c.w)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        r AS (
            SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5""",
}
