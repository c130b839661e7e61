"""The queries of the training-text operators, over the tables of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    line_dedup,
    ngram_join,
    quality,
    quality_rules,
    token_alignment,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from orderloom.llm.rows import table
from orderloom.sources.folders import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

RULES = (
    url_filter.Rule("block", "net"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


def remainder(id: str, parts: int) -> Column:
    """Which of so many parts an id belongs to, by the crc32 of its digits; null without an id."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % parts


def held_out(id: str, parts: int, part: int) -> Column:
    """Whether a document's label is kept from the model; a document without an id has none to keep."""
    return F.coalesce(remainder(id, parts) == part, F.lit(False)).alias("held_out")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 3) != 1)
    scored = quality.with_quality(docs, quality.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1), "score", "predicted")


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    groups = exact_dedup.exact_groups(docs, carried=digest)
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("carried").alias("text_sha256"))


def tokens_and_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.round_trip(docs.select("doc_id", "text"), BYTE_BPE)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tokens_and_digests(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, PIECES).select("doc_id", "n_words", "n_tokens")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    manifest = token_files.write_token_files(docs, new_folder(spark, "token-files"), WORD_BPE, end_id=1)
    return token_files.read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 5) != 0)
    scored = toxicity.with_toxicity(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0), "score", "predicted")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.with_verdict(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.with_overlap(docs, table(spark, folder, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return line_dedup.without_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.aligned(docs, BYTE_BPE, PIECES, groups=digest).withColumnsRenamed(
        {"id": "doc_id", "groups": "groups_sha256"}
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_join": op2_ngram_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe": op4_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_token_files": op6_token_files,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_quality_rules": op12_quality_rules,
    "op13_token_alignment": op13_token_alignment,
}

# Not here, as SQL cannot express a fitted model, a tokenizer or a file format:
# op1, op4, op5, op6 and op7. Their tests hold them against brute force.
ORACLES = {
    "op2_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, least(len(w), 5) AS size, array_to_string(list_slice(w, i, i + 4), ' ') AS shown
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
            FROM shingles x JOIN shingles y ON x.shown = y.shown AND x.size = y.size AND x.doc_id < y.doc_id
            GROUP BY x.doc_id, y.doc_id
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= 75 * (x.n + y.n - shared)
        ), edges AS (
            SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reached AS (
            SELECT a AS doc_id, b AS other FROM edges
            UNION
            SELECT reached.doc_id, edges.b FROM reached JOIN edges ON reached.other = edges.a
        )
        SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles,
               least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reached USING (doc_id)
        GROUP BY d.doc_id
    """,
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_url_filter": """
        WITH parsed AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), judged AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
            END AS rule
            FROM parsed
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged
    """,
    "op9_decontamination": r"""
        WITH item_words AS (
            SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
        ), windows AS (
            SELECT DISTINCT item, least(10, len(words)) AS size,
                   array_to_string(list_slice(words, i, i + least(10, len(words)) - 1), ' ') AS shown
            FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
                  FROM item_words WHERE len(words) > 0)
        ), sizes AS (SELECT DISTINCT size FROM windows),
        doc_words AS (
            SELECT doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), places AS (
            SELECT doc_id, size, i, array_to_string(list_slice(words, i, i + size - 1), ' ') AS shown
            FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
                  FROM doc_words, sizes WHERE len(words) >= size)
        ), found AS (
            SELECT doc_id, item, i, size FROM places JOIN windows USING (size, shown)
        ), hit AS (
            SELECT doc_id, count(DISTINCT w) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS w FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(DISTINCT item) AS n_items,
                   string_agg(DISTINCT item, ',' ORDER BY item) AS list
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op10_line_dedup": """
        WITH lines AS (
            SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                   unnest(string_split(text, chr(10))) AS line
            FROM documents WHERE text IS NOT NULL
        ), known AS (
            SELECT *, trim(line, ' ') AS bare FROM lines
        ), spread AS (
            SELECT bare FROM known WHERE bare <> ''
            GROUP BY bare HAVING count(DISTINCT coalesce(source, '')) >= 8
        ), judged AS (
            SELECT k.*, s.bare IS NOT NULL AND row_number() OVER (PARTITION BY k.bare ORDER BY doc_id, pos) > 1 AS gone
            FROM known k LEFT JOIN spread s ON k.bare = s.bare
        ), cleaned AS (
            SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
                   count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
            FROM judged GROUP BY doc_id
        )
        SELECT d.doc_id, c.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
        FROM documents d LEFT JOIN cleaned c USING (doc_id)
    """,
}
