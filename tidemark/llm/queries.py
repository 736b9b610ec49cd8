"""The registered queries of the corpus operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, grammar, lm, media, near_dedup, packing, pieces, prefix_trie, quality, secrets, substring_dedup, toxicity
from .text import load


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"), shingle=4)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(load(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(load(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op5_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.token_files(load(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(load(spark, sf_dir, "documents"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_features(load(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model_scores(load(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encoded(load(spark, sf_dir, "documents"), decode=True)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(load(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.aligned(load(spark, sf_dir, "documents")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secrets": op3_secrets,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_grammar": op5_token_grammar,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_media": op8_media,
    "op9_toxicity": op9_toxicity,
    "op10_lm_scores": op10_lm_scores,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_alignment": op13_token_alignment,
}

#: crc32 of a conversation's decimal id, bit by bit, by the polynomial's fixed value.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(8 * strlen(conv_id::VARCHAR)), lambda i: ((ascii(substr(conv_id::VARCHAR, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT) & 1)::UBIGINT)),
  lambda c, b: CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END))"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS first FROM x GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM x JOIN f ON f.g = x.g WHERE first < doc_id),
r AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
k AS (SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.j) AS kept FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w) a LEFT JOIN c ON c.doc_id = a.doc_id AND c.j = a.j WHERE c.j IS NULL GROUP BY a.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN k ON k.doc_id = w.doc_id""",
    "op12_prefix_trie": f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, ({CRC32} % 4)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE c.conv_id = base OR p > h
  UNION ALL SELECT c.conv_id, p - 4, role, text FROM c JOIN t ON t.conv_id = base WHERE c.conv_id <> base AND p <= h),
b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS depth, role, text FROM r),
m AS (SELECT conv_id, depth, list([role, text]) OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM b UNION ALL SELECT conv_id, 0, [] FROM c),
n AS (SELECT k, depth, min(conv_id) AS id, count(*) AS n_convs FROM m GROUP BY ALL),
x AS (SELECT m.conv_id, m.depth, n.id FROM m JOIN n ON m.k = n.k AND m.depth = n.depth),
w AS (SELECT n.id, n.depth, n.n_convs, up.id AS parent, coalesce(len(regexp_extract_all(b.text, '[^\x20\x09-\x0D]+')), 0) AS words
  FROM n LEFT JOIN b ON b.conv_id = n.id AND b.depth = n.depth LEFT JOIN x up ON up.conv_id = n.id AND up.depth = n.depth - 1),
ch AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM w WHERE parent IS NOT NULL GROUP BY ALL),
f AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN ch ON ch.parent = w.id AND ch.depth = w.depth),
s AS (SELECT a.id, a.depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens FROM f JOIN x a ON a.conv_id = f.id AND a.depth <= f.depth GROUP BY ALL),
e AS (SELECT x.id, x.depth, string_agg(x.conv_id::VARCHAR, ',' ORDER BY x.conv_id) AS ids FROM x JOIN (SELECT conv_id, max(depth) AS depth FROM m GROUP BY ALL) l ON l.conv_id = x.conv_id AND l.depth = x.depth GROUP BY ALL)
SELECT f.id AS conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM f JOIN s ON s.id = f.id AND s.depth = f.depth LEFT JOIN e ON e.id = f.id AND e.depth = f.depth""",
}
