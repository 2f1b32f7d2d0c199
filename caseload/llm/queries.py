"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip_digests
from .chat import formatted_chats
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .html_extract import Model, main_texts
from .html_pages import labelled_pages
from .lexical_search import search
from .licenses import license_scan
from .merkle import manifest
from .packing import pack
from .pii import personal_data
from .quality import quality_scores, trained
from .rows import read_table
from .sharding import shuffled_shards
from .simhash import near_groups


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents")).drop("row_key")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents")).drop("row_key")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents")).drop("row_key")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents")).drop("row_key")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_shards(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_scores(docs, trained(docs, read_table(spark, sf_dir, "labels"))).drop("row_key")


def document_paths(docs: DataFrame) -> DataFrame:
    """The table has no paths: a document lies in its source, by tens of thousands, thousands and hundreds
    of its id. Those with the lowest twenty ids of a directory's range are its licence files."""
    n = F.col("doc_id")
    dirs = F.concat_ws("/", "source", F.expr("doc_id div 10000"))
    inner = F.concat_ws("/", dirs, F.expr("doc_id div 1000"))
    inmost = F.concat_ws("/", inner, F.expr("doc_id div 100"))
    path = (
        F.when(n % 10000 < 20, F.concat(dirs, F.lit("/LICENSE")))
        .when(n % 1000 < 20, F.concat(inner, F.lit("/LICENSE")))
        .when(n % 100 < 20, F.concat(inmost, F.lit("/LICENSE")))
        .otherwise(F.concat(inmost, F.lit("/"), n.cast("string"), F.lit(".txt")))
    )
    return docs.withColumn("path", path)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_paths(read_table(spark, sf_dir, "documents"))
    return license_scan(files, "path", "text", ("doc_id",)).drop("row_key")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted_chats(read_table(spark, sf_dir, "conversations"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"), Model(labelled_pages())).drop("row_key")


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read_table(spark, sf_dir, "documents")).drop("row_key")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"), proofs=False).drop("tree")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("item")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS content
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(content) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY content ORDER BY length(text) DESC, doc_id)
"""

OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark)
),
windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, p, p + n - 1) AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM item_words WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, n, p, list_slice(w, p, p + n - 1) AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT doc_id, item_id, p, n FROM places JOIN windows USING (n, win)),
hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9_SQL = """
WITH turns AS (
  SELECT *, CAST(floor(turn / 256) AS BIGINT) AS part,
    (row_number() OVER (PARTITION BY conv_id, floor(turn / 256) ORDER BY turn, role, text) - 1) // 256 AS piece
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
),
whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS said,
         list(turn ORDER BY turn, role, text) AS numbers
  FROM turns GROUP BY conv_id
),
one AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, said FROM whole GROUP BY said),
kept AS (
  SELECT * FROM one WHERE NOT EXISTS (
    SELECT 1 FROM one AS longer
    WHERE longer.said[1] = one.said[1] AND len(longer.said) > len(one.said)
      AND list_slice(longer.said, 1, len(one.said)) = one.said)
)
SELECT conv_id, part, piece, CAST(len(said) AS BIGINT) AS n_turns, copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
FROM kept JOIN turns USING (conv_id)
GROUP BY ALL
"""

OP12_SQL = r"""
WITH RECURSIVE
crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
),
changed AS (
  SELECT d.*, CASE WHEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 2 = 0
         THEN replace(text, chr(10), '') ELSE text END AS tampered
  FROM documents AS d, crc
),
parts AS (
  SELECT source, doc_id, text, tampered,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
  FROM changed
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (
    SELECT source, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS spoiled
    FROM parts
  )
),
nodes AS (
  SELECT source, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n
),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
),
top AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, pos // 3, n
),
heights AS (SELECT source, max(level) AS height FROM nodes GROUP BY source),
steps AS (
  SELECT l.source, l.doc_id, l.pos, n.level,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < l.pos // CAST(pow(3, n.level) AS BIGINT)), '') AS before,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > l.pos // CAST(pow(3, n.level) AS BIGINT)), '') AS after
  FROM leaves AS l JOIN heights AS t ON l.source IS NOT DISTINCT FROM t.source
  JOIN nodes AS n ON n.source IS NOT DISTINCT FROM l.source AND n.level < t.height
   AND n.pos // 3 = l.pos // CAST(pow(3, n.level + 1) AS BIGINT)
  GROUP BY ALL
),
top_steps AS (
  SELECT s.source, n.level,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < s.pos // CAST(pow(3, n.level) AS BIGINT)), '') AS before,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > s.pos // CAST(pow(3, n.level) AS BIGINT)), '') AS after
  FROM subroots AS s JOIN top AS n ON n.n > 1 AND n.pos // 3 = s.pos // CAST(pow(3, n.level + 1) AS BIGINT)
  GROUP BY s.source, s.pos, n.level
),
lower_paths AS (
  SELECT source, pos, list(before || '|' || after ORDER BY level) AS path, string_agg(before || after, '' ORDER BY level) AS proof
  FROM steps GROUP BY source, pos
),
upper_paths AS (
  SELECT source, list(before || '|' || after ORDER BY level) AS path, string_agg(before || after, '' ORDER BY level) AS proof
  FROM top_steps GROUP BY source
),
folded AS (
  SELECT l.doc_id, l.leaf, s.subroot, r.h AS root,
         sha256(coalesce(a.proof, '') || coalesce(b.proof, '')) AS proof_sha256,
         list_reduce([l.spoiled] || coalesce(a.path, []) || coalesce(b.path, []),
           lambda x, step: sha256(split_part(step, '|', 1) || x || split_part(step, '|', 2))) AS folded_root
  FROM leaves AS l
  JOIN subroots AS s ON l.source IS NOT DISTINCT FROM s.source
  JOIN top AS r ON r.n = 1
  LEFT JOIN lower_paths AS a ON a.source IS NOT DISTINCT FROM l.source AND a.pos = l.pos
  LEFT JOIN upper_paths AS b ON b.source IS NOT DISTINCT FROM l.source
)
SELECT *, folded_root = root AS verified FROM folded
"""

OP13_SQL = r"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS item FROM benchmark)
),
lengths AS (SELECT doc, doc_id, count(*) AS n FROM found GROUP BY doc, doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
places AS (SELECT doc, term, count(*) AS tf FROM found WHERE term IN (SELECT term FROM asked) GROUP BY doc, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM places, whole GROUP BY term, docs
),
scored AS (
  SELECT item, item_id, doc, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN places USING (term) JOIN weights USING (term) JOIN lengths USING (doc), whole
  GROUP BY item, item_id, doc, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {
    "op1_simhash_near_dedup": (op1_simhash_near_dedup, None),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_personal_data": (op3_personal_data, None),
    "op4_exact_dedup": (op4_exact_dedup, OP4_SQL),
    "op5_benchmark_decontamination": (op5_benchmark_decontamination, OP5_SQL),
    "op6_hypergeometric_sharding": (op6_hypergeometric_sharding, None),
    "op7_quality_classifier": (op7_quality_classifier, None),
    "op8_license_scan": (op8_license_scan, None),
    "op9_chat_formatting": (op9_chat_formatting, OP9_SQL),
    "op10_html_extraction": (op10_html_extraction, None),
    "op11_bpe_round_trip": (op11_bpe_round_trip, None),
    "op12_merkle_manifest": (op12_merkle_manifest, OP12_SQL),
    "op13_lexical_search": (op13_lexical_search, OP13_SQL),
}
