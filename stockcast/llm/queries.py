"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.llm import bpe, chat, conversation_repair, exact_dedup, fingerprints, license_scan, lm_scoring, mixing, near_vectors, ngram_join, periodic_runs, pii, quality
from stockcast.llm.common import LOWER, UPPER, WORD, table


def vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the public tokenizer the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    same = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), same)
    return chat.conversation_digests(chat.format_turns(turns.unionByName(extra)))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_score(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), *vocabulary())


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), damage=periodic_runs.repeated_tail)
    return periodic_runs.run_digests(found)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1,
    "op2_source_mixing": op2,
    "op3_pii": op3,
    "op4_chat_formatting": op4,
    "op5_lm_scoring": op5,
    "op6_license_scan": op6,
    "op7_quality_classifier": op7,
    "op8_embedding_near_dedup": op8,
    "op9_byte_bpe": op9,
    "op10_exact_dedup": op10,
    "op11_conversation_repair": op11,
    "op12_periodic_runs": op12,
    "op13_document_fingerprints": op13,
}

ORACLE_SQL = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(x, y) AS (SELECT DISTINCT doc_id, doc_id FROM documents UNION SELECT r.x, both_ways.b FROM r JOIN both_ways ON both_ways.a = r.y),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, m.y AS component_id
FROM documents d LEFT JOIN z USING (doc_id) LEFT JOIN m ON m.x = d.doc_id""",
    "op4_chat_formatting": chat.ORACLE_SQL,
    "op10_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS whole FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS keep_id, count(*) OVER (PARTITION BY whole) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY whole) AS kept, sha256(whole) AS text_sha256 FROM n""",
}
