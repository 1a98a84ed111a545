"""The operators as registered queries over the given tables, with SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    chat_tree,
    cutting_stock,
    hyperlang,
    license_automaton,
    merkle,
    ngram_jaccard,
    periodic_runs,
    pivot_index,
    prefix_trie,
    rank_bpe,
    suffix_sort,
    suffix_tree_lm,
    toxicity,
    vocabulary,
)
from tarmac.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    """The byte-level vocabulary the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_jaccard.near_groups(spark, docs, size=3, numerator=90, denominator=100)


_OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words
),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2
),
linked AS (
  SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id
  WHERE 100 * common >= 90 * (len(x.s) + len(y.s) - common)
),
links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_reached AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM sets LEFT JOIN least_reached ON doc_id = a
"""


#: The conversation that every run of the chat query adds: control strings inside both texts.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op2_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    return chat_tree.digests(chat_tree.format_chats(spark, rows.unionByName(added))).drop("nodes")


_OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + 11 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(spark, table(spark, sf_dir, "embeddings"))


_OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, least(v.vec_id, coalesce(c.least, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(c.least, v.vec_id)) AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a
"""


def op4_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cutting_stock.cut(table(spark, sf_dir, "documents"), vocabulary.encoder(vocabulary_path()))
    return cutting_stock.pack(spark, pieces)


def op5_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_study(spark, table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    """Learned from the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold("doc_id", 5) != 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.learn(spark, docs, labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = suffix_tree_lm.score(spark, docs, fold("doc_id", 10) != 0, spread=8.0)
    held_out = (fold("doc_id", 10) == 0).alias("held_out")
    return scored.select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_automaton.license_scan(table(spark, sf_dir, "documents"))
    return found.drop("spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = hyperlang.learn(docs.filter(fold("doc_id", 5) != 0))
    return hyperlang.identify(docs, prototypes).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op11_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.digests(suffix_sort.remove_repeats(spark, table(spark, sf_dir, "documents"), window=400))


_OP11_SQL = r"""
WITH bytes AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents
),
starts AS (
  SELECT r, p, md5_number(substring(h, 2 * p + 1, 800)) AS key FROM (SELECT r, h, unnest(range(length(h) // 2 - 399)) AS p FROM bytes)
),
repeated AS (
  SELECT r, p FROM starts WHERE key IN (SELECT key FROM starts GROUP BY key HAVING count(*) > 1)
),
marked AS (
  SELECT r, p, CASE WHEN p - lag(p) OVER w <= 400 THEN 0 ELSE 1 END AS fresh FROM repeated WINDOW w AS (PARTITION BY r ORDER BY p)
),
spans AS (
  SELECT r, min(p) AS a, max(p) + 400 AS b
  FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS s FROM marked) GROUP BY r, s
),
edges AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY r
),
pieces AS (
  SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM spans
  UNION ALL SELECT r, 0 AS a, min(a) AS b FROM spans GROUP BY r
),
kept AS (
  SELECT r, string_agg(substring(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
  FROM pieces JOIN bytes USING (r) GROUP BY r
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM bytes LEFT JOIN edges USING (r) LEFT JOIN kept USING (r)
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark, table(spark, sf_dir, "conversations"))


_OP12_SQL = r"""
WITH RECURSIVE crc_bits(value, crc, bits) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT value, CASE WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, bits + 1 FROM crc_bits WHERE bits < 8
),
crc_table AS (SELECT value, crc FROM crc_bits WHERE bits = 8),
crc_steps(conv_id, digits, place, crc) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 1, 4294967295 FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT s.conv_id, s.digits, s.place + 1, xor(s.crc >> 8, t.crc)
  FROM crc_steps s JOIN crc_table t ON t.value = xor(s.crc & 255, CAST(ascii(substring(s.digits, s.place, 1)) AS BIGINT))
  WHERE s.place <= length(s.digits)
),
heads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(crc, 4294967295) % 4 AS h FROM crc_steps WHERE place = length(digits) + 1
),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, words,
    md5(md5(text) || '|' || role) AS content
  FROM (
    SELECT conv_id, part, place, role, text, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
    FROM (
      SELECT h.conv_id, 1 AS part, t.place, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.base AND t.place <= h.h
      UNION ALL SELECT t.conv_id, 2, t.place, t.role, t.text FROM turns t JOIN heads h ON t.conv_id = h.conv_id WHERE t.place > h.h
    )
  )
),
walked AS (
  SELECT conv_id, depth, words, string_agg(content, ',') OVER w AS node, max(depth) OVER (PARTITION BY conv_id) AS length
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
  UNION ALL SELECT h.conv_id, 0, 0, '', (SELECT count(*) FROM rebuilt r WHERE r.conv_id = h.conv_id) FROM heads h
),
parents AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM walked
),
nodes AS (
  SELECT node, min(parent) AS parent, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM parents GROUP BY node
),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
  SELECT w.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved
  FROM nodes v JOIN walked w ON w.conv_id = v.conv_id AND w.depth <= v.depth LEFT JOIN kids k ON k.node = v.node
  GROUP BY w.node
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, t.n_leaves,
  CAST(t.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = v.parent LEFT JOIN kids k ON k.node = v.node
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.find_runs(table(spark, sf_dir, "documents"), seeded=True))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_chat_tree": op2_chat_tree,
        "op3_pivot_index": op3_pivot_index,
        "op4_cutting_stock": op4_cutting_stock,
        "op5_rank_bpe": op5_rank_bpe,
        "op6_merkle": op6_merkle,
        "op7_toxicity": op7_toxicity,
        "op8_suffix_tree_lm": op8_suffix_tree_lm,
        "op9_license_scan": op9_license_scan,
        "op10_language_id": op10_language_id,
        "op11_suffix_sort": op11_suffix_sort,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": _OP1_SQL, "op2_chat_tree": _OP2_SQL, "op3_pivot_index": _OP3_SQL,
        "op11_suffix_sort": _OP11_SQL, "op12_prefix_trie": _OP12_SQL,
    }
