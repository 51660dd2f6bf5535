"""The registered queries of this package, one per operator, and their DuckDB texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bagminhash, exact_dedup, hard_negatives, html_extraction, packing, phrase_automata, quality_rules,
               sentencepiece_prefix, suffix_dedup, token_counts, toxicity, url_templates, whitening)
from .common import scratch, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"),
                                       scratch(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = exact_dedup.dedup(exact_dedup.arrivals(table(spark, sf_dir, "documents")))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


#: (host, path, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_prefix.encode_decode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(F.col("c0").alias("doc_id"), "n_bytes", "n_removed",
                          F.floor(F.size("spans") / 2).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.bpe_with_end(tokenizer("word_bpe_49k.json"), 2))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "loss_tokens")


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = bagminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = phrase_automata.deduplicated(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"),
                                relabel="CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it exceeds a long."""
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_exact_dedup, op3_url_templates, op4_sentencepiece,
                                  op5_suffix_dedup, op6_packing, op7_bagminhash, op8_toxicity,
                                  op9_quality_rules, op10_phrase_automata, op11_hard_negatives,
                                  op12_whitening, op13_html_extraction)}

ORACLE = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op10_phrase_automata": """
        WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'),
                                              lambda x: x <> '') AS words FROM documents),
        s AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS h
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
        r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS later FROM s),
        g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE later),
        p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
        k AS (SELECT p.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (g.i IS NULL) AS kept
              FROM p LEFT JOIN g USING (doc_id, i) GROUP BY 1)
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)""",
    "op5_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
                   FROM documents),
        s AS (SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 400)) AS k
              FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM d)),
        r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p
              FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM s) WHERE c > 1),
        g AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM r),
        runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, g),
        kept AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
                 UNION ALL SELECT doc_id, coalesce(max(b), 0), n FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id, n),
        t AS (SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS t
              FROM kept JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(t)) AS kept_sha256
        FROM d JOIN t USING (doc_id)
        LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id) USING (doc_id)""",
    "op9_quality_rules": quality_rules.duckdb_sql(),
    "op3_url_templates": url_templates.duckdb_sql(URL_RULES),
    "op11_hard_negatives": hard_negatives.duckdb_sql(),
    "op13_html_extraction": html_extraction.duckdb_sql(),
}
