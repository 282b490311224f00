"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from platterflow.llm import (
    bpe, embedding_dedup, exact_dedup, html_text, importance, lm_score, packing, prefix_trie, quality, simhash, spotsigs,
    substring_dedup, suffix_dedup,
)
from platterflow.llm.common import table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trips(table(spark, folder, "documents"), WORD_VOCABULARY)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), BYTE_VOCABULARY)


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_texts(table(spark, folder, "pages"))


def op8_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, folder, "documents"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classified(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.scored(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, folder, "conversations"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash, op2_bpe, op3_packing, op4_exact_dedup, op5_html_text, op6_suffix_dedup, op7_substring_dedup, op8_spotsigs,
        op9_quality, op10_lm_score, op11_embedding_dedup, op12_prefix_trie, op13_importance)
}


def _crc_of_half(value: int) -> int:
    """CRC-32 of four bits; 0xEDB88320 is the fixed polynomial."""
    for _ in range(4):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


CRC_TABLE = [_crc_of_half(value) for value in range(16)]


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes in SQL: the low half of each byte, then the high one."""
    digits = f"hex(encode({text}))"
    halves = (f"list_transform(range(1, length({digits}) + 1), "
              f"lambda i: CAST(strpos('0123456789ABCDEF', {digits}[CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END]) - 1 AS BIGINT))")
    step = f"lambda c, x: xor(c >> 4, {CRC_TABLE}[CAST(xor(c, x) & 15 AS INTEGER) + 1])"
    return f"xor(list_reduce({halves}, {step}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)""",
    "op11_embedding_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
        units AS (
            SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM vectors
            WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
            ON a.vec_id <> b.vec_id AND list_dot_product(a.u, b.u) >= 0.9),
        reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
               least(vec_id, (SELECT min(b) FROM reached WHERE a = vec_id)) AS component_id,
               vec_id = least(vec_id, (SELECT min(b) FROM reached WHERE a = vec_id)) AS kept
        FROM embeddings""",
    "op12_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                || coalesce(text, ''))) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS heads
                  FROM (SELECT DISTINCT conv_id FROM turns)),
        whole AS (
            SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM convs c
            JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.place <= c.heads
            UNION ALL
            SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.heads),
        numbered AS (
            SELECT *, row_number() OVER own AS depth, list(struct_pack(r := role, t := text)) OVER own AS path
            FROM whole WINDOW own AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)),
        members AS (
            SELECT conv_id, depth, path, strlen(text) AS size FROM numbered
            UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
        ends AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
        nodes AS (
            SELECT depth, path, min(m.conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
                   sha256(coalesce(string_agg(CAST(e.conv_id AS VARCHAR), ',' ORDER BY e.conv_id), '')) AS ends_sha256
            FROM members m LEFT JOIN ends e USING (conv_id, depth) GROUP BY depth, path),
        families AS (
            SELECT n.depth, n.path, count(c.depth) AS n_children FROM nodes n
            LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path GROUP BY n.depth, n.path),
        subtrees AS (
            SELECT n.depth, n.path, sum((b.n_convs - 1) * b.size) AS saved_tokens,
                   count(*) FILTER (f.n_children = 0) AS n_leaves
            FROM nodes n JOIN nodes b ON b.depth >= n.depth AND b.path[1:n.depth] = n.path
            JOIN families f ON f.depth = b.depth AND f.path = b.path GROUP BY n.depth, n.path)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, f.n_children, s.n_leaves,
               CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN families f ON f.depth = n.depth AND f.path = n.path
        JOIN subtrees s ON s.depth = n.depth AND s.path = n.path
        LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]""",
    "op13_importance": f"""
        WITH texts AS (
            SELECT true AS ours, doc_id AS id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
        split AS (
            SELECT row_number() OVER () AS k, ours, id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
        runs AS (
            SELECT k, ours, unnest(list_concat(words,
                list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]),
                list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
                )) AS run FROM split),
        counted AS (SELECT k, ours, run, count(*) AS n FROM runs GROUP BY ALL),
        hashed AS (SELECT run, {crc32_sql("run")} % 10000 AS bucket FROM (SELECT DISTINCT run FROM counted)),
        buckets AS (
            SELECT bucket, coalesce(sum(n) FILTER (ours), 0) AS s, coalesce(sum(n) FILTER (NOT ours), 0) AS t
            FROM counted JOIN hashed USING (run) GROUP BY bucket),
        totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM buckets),
        gains AS (
            SELECT bucket, floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE)
                                           / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS gain
            FROM buckets, totals),
        weights AS (
            SELECT k, sum(n) AS n_features, sum(n * gain) AS weight
            FROM counted JOIN hashed USING (run) JOIN gains USING (bucket) GROUP BY k),
        scores AS (
            SELECT id AS doc_id, len(words) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                   CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                   CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || id)[1:8] AS BIGINT) + 0.5)
                        / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
            FROM split LEFT JOIN weights USING (k) WHERE ours),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) FILTER (n_words >= 20) OVER () * 5 // 100 AS drawn FROM scores)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank
        FROM ranked""",
}
