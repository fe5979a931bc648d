"""The registered queries of the operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldomart.llm.bpe import bpe_encode
from saldomart.llm.centroids import cluster_vectors
from saldomart.llm.common import table
from saldomart.llm.conversation_repair import repair_conversations
from saldomart.llm.decontamination import contaminated
from saldomart.llm.lm_scoring import score_texts
from saldomart.llm.ngram_join import ngram_join
from saldomart.llm.pii import find_pii
from saldomart.llm.quality_model import score_quality
from saldomart.llm.quality_rules import judged
from saldomart.llm.substring_dedup import remove_repeats
from saldomart.llm.token_counts import count_tokens
from saldomart.llm.token_files import tokens_through_files
from saldomart.llm.warc import fixity_audit, page_records, record_leaves, warc_leaves, write_warc
from saldomart.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
END_OF_DOCUMENT = 2


def op1_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = judged(docs, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *[f"stats.{c}" for c in counts], "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, TOKEN_LIMIT)


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against a written replica that was damaged on its way.

    The replica lacks the pages whose number leaves 7 when divided by 501; pages that leave
    5 when divided by 97 have another first byte.
    """
    records = page_records(table(spark, sf_dir, "pages"))
    page, split = F.col("record_id"), F.locate("\r\n\r\n", F.col("record")) + 3
    flipped = F.concat(
        F.substring("record", F.lit(1), split), F.lit("~"), F.substring("record", split + 2, F.length("record"))
    )
    damaged = records.filter(page % 501 != 7).withColumn(
        "record", F.when(page % 97 == 5, flipped).otherwise(F.col("record"))
    )
    path = new_folder(spark, "warc")
    write_warc(damaged, path)
    return fixity_audit(record_leaves(records), warc_leaves(spark, path))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_through_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_OF_DOCUMENT)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_bpe_encode": op1_bpe_encode,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_quality_model": op3_quality_model,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_ngram_join": op7_ngram_join,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_pii": op10_pii,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_files": op12_token_files,
    "op13_centroid_clusters": op13_centroid_clusters,
}

_WARC_SQL = """
WITH records AS (
  SELECT page_id, page_id // 1000 AS archive, strlen(html) AS body,
         strlen(concat('WARC/1.0', '\r\n', 'WARC-Type: resource', '\r\n', 'WARC-Record-ID: <urn:page:', page_id, '>',
                       '\r\n', 'WARC-Target-URI: ', url, '\r\n', 'WARC-Date: 1970-01-01T00:00:00Z', '\r\n',
                       'Content-Type: text/html', '\r\n', 'Content-Length: ', strlen(html))) + 4 + strlen(html) AS n_bytes
  FROM pages),
master AS (
  SELECT *, CAST(coalesce(sum(n_bytes + 4) OVER w, 0) AS BIGINT) AS record_offset FROM records
  WINDOW w AS (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
replica AS (
  SELECT *, CAST(coalesce(sum(n_bytes + 4) OVER w, 0) AS BIGINT) AS replica_offset FROM records
  WHERE page_id % 501 <> 7
  WINDOW w AS (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT m.archive, m.page_id AS record_id,
       CASE WHEN r.page_id IS NULL THEN 'missing' WHEN m.page_id % 97 = 5 THEN 'corrupt' ELSE 'moved' END AS status,
       m.record_offset, r.replica_offset, m.n_bytes AS record_bytes, r.n_bytes AS replica_bytes
FROM master m LEFT JOIN replica r USING (page_id)
WHERE r.page_id IS NULL OR m.page_id % 97 = 5 OR r.replica_offset <> m.record_offset"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NORMAL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_RULES_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 4], ' ')) AS word_window
  FROM split, unnest(generate_series(1, len(w) - 4)) AS t(i)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, word_window) > 1), generate_series(0, 4) AS s(k)
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, stratum, len(w) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_exclamations,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (doc_id)),
levelled AS (
  SELECT *, floor(100 * n_symbols / greatest(word_chars, 1)) AS symbols,
         floor(100 * n_exclamations / greatest(word_chars, 1)) AS exclamations,
         floor(100 * n_dup_lines / greatest(n_lines, 1)) AS duplicate_lines,
         floor(100 * n_repeat_words / greatest(n_words, 1)) AS repeated_words,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted),
ruled AS (
  UNPIVOT (SELECT doc_id, stratum, symbols, exclamations, duplicate_lines, repeated_words FROM levelled)
  ON symbols, exclamations, duplicate_lines, repeated_words INTO NAME rule VALUE level),
rows_by_level AS (
  SELECT stratum, rule, least(level, 100) AS level,
         count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality <> 1) AS n_bad
  FROM ruled JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id)
  USING (doc_id) GROUP BY ALL),
rejecting AS (
  SELECT *, sum(n_good) OVER from_top AS k, sum(n_bad) OVER from_top AS bad,
         sum(n_good) OVER (PARTITION BY stratum, rule) AS n,
         (SELECT count(DISTINCT stratum) FROM rows_by_level) AS strata
  FROM rows_by_level WINDOW from_top AS (PARTITION BY stratum, rule ORDER BY level DESC)),
safe AS (
  SELECT *, bad - 4 * k AS use
  FROM rejecting
  WHERE level > 0 AND k < n * 0.005 AND bad > 4 * k AND 0.05 / (4 * strata) >= (
    SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995)))
    FROM generate_series(0, CAST(k AS BIGINT)) AS s(i))),
cutoffs AS (
  SELECT stratum, rule, level AS cutoff FROM safe
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY use DESC, level DESC) = 1),
rejected AS (
  SELECT DISTINCT doc_id FROM ruled JOIN cutoffs USING (stratum, rule) WHERE level >= cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM levelled"""

_CONTAMINATION_SQL = f"""
WITH docs AS (SELECT doc_id, {_NORMAL_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_NORMAL_WORDS} AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS pattern
  FROM items, unnest(generate_series(1, greatest(1, len(w) - 9))) AS t(i) WHERE len(w) > 0),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM docs, (SELECT DISTINCT n FROM patterns), unnest(generate_series(1, len(w) - n + 1)) AS t(i)),
hits AS (SELECT doc_id, item_id, n, i FROM places JOIN patterns USING (n, pattern)),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

_DEDUP_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS word_window
  FROM docs, unnest(generate_series(1, len(w) - 49)) AS t(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY word_window) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS place FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

_JOIN_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
ngrams AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS ngram
  FROM docs, unnest(generate_series(1, greatest(1, len(w) - 4))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM ngrams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM ngrams a JOIN ngrams b ON a.ngram = b.ngram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b, c.n = x.n AND c.n = y.n AS same
  FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 5 * c.n >= 4 * (x.n + y.n - c.n)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
found AS (SELECT a, count(*) AS n_links, count(*) FILTER (same) AS n, min(b) FILTER (same) AS copy FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, least(doc_id, coalesce(copy, doc_id)) AS rep_id,
       1 + coalesce(n, 0) AS n_same, coalesce(n_links, 0) AS n_links
FROM docs LEFT JOIN found ON found.a = doc_id LEFT JOIN lowest ON lowest.a = doc_id"""


def _edit_sql(path: str, letter: str, cost: str) -> str:
    """A path (nine digits of cost, then letters) with one more edit; the least path is the cheapest."""
    return f"lpad(CAST(CAST(left({path}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({path}, 10) || '{letter}'"


def _kept_sql(path: str, letter: str) -> str:
    return f"CASE WHEN NOT forced AND letter = '{letter}' THEN {_edit_sql(path, 'K', 'more')} END"


def _chosen_sql(path: str) -> str:
    return f"CASE WHEN NOT forced THEN {_edit_sql(path, 'R', '1 + more')} END"


_REPAIR_SQL = rf"""
WITH RECURSIVE crc_steps AS (
  SELECT n, 0 AS step, n AS crc FROM range(256) AS t(n)
  UNION ALL
  SELECT n, step + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(crc ORDER BY n) AS crcs FROM crc_steps WHERE step = 8),
given AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name
  FROM conversations),
faults AS (
  SELECT *, xor(list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(name, '')],
                            lambda crc, b: xor(crc >> 8, crcs[(xor(crc, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM given, crc_table),
damaged AS (
  SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM faults, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, left(text, 32), text) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS letter, CASE
    WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
    ELSE 'sound' END AS fault
  FROM ordered),
messages AS (
  SELECT *, fault IN ('blank', 'duplicate') AS forced, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more,
         lag(letter) OVER (PARTITION BY c ORDER BY i) AS before
  FROM judged),
counted AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM messages GROUP BY c),
paths AS (
  SELECT c, CAST(0 AS BIGINT) AS i, '000000000' AS nothing, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a
  FROM counted
  UNION ALL
  SELECT c, i + 1, {_edit_sql("nothing", "D", "2")},
         least({_edit_sql("s", "D", "2")}, {_kept_sql("nothing", "s")}),
         least({_edit_sql("u", "D", "2")}, {", ".join(f"{_kept_sql(x, 'u')}, {_chosen_sql(x)}" for x in ("nothing", "s", "a"))}),
         least({_edit_sql("a", "D", "2")}, {_kept_sql("u", "a")}, {_chosen_sql("u")})
  FROM (
    SELECT p.c, p.i, nothing, s, letter, forced, more,
           least(u, {", ".join(_edit_sql(x, "I", "5") for x in ("nothing", "s", "a"))}) AS u, least(a, {_edit_sql("u", "I", "5")}) AS a
    FROM paths AS p JOIN messages AS m ON m.c = p.c AND m.i = p.i + 1)),
best AS (
  SELECT c, least(nothing, a, {_edit_sql("u", "I", "5")}) AS path FROM paths JOIN counted USING (c) WHERE i = n),
edits AS (
  SELECT c, k, path[9 + k] AS edit,
         count(*) FILTER (path[9 + k] <> 'I') OVER (PARTITION BY c ORDER BY k) AS i,
         count(*) FILTER (path[9 + k] <> 'D') OVER (PARTITION BY c ORDER BY k) AS place
  FROM best, range(1, length(path) - 8) AS t(k)),
left_over AS (
  SELECT e.*, m.role, m.text, max(edit = 'K' AND place = 1 AND letter = 's') OVER (PARTITION BY e.c) AS system
  FROM edits AS e LEFT JOIN messages AS m ON m.c = e.c AND m.i = e.i WHERE edit <> 'D'),
repaired AS (
  SELECT c, string_agg(concat(
    CASE WHEN edit = 'K' THEN role WHEN (place + CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':',
    CASE WHEN edit <> 'I' THEN text END), chr(10) ORDER BY k) AS lines
  FROM left_over GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(left(path, 9) AS BIGINT), 0) AS cost, coalesce(substr(path, 10), '') AS audit,
       sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM given) LEFT JOIN counted USING (c) LEFT JOIN best USING (c) LEFT JOIN repaired USING (c)"""

_VECTORS_SQL = """
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), v) - 1 AS cluster, v AS c
  FROM kept WHERE vec_id IS NOT NULL QUALIFY cluster < 16)"""


def _assigned_sql(number: int) -> str:
    return f"""
a{number} AS MATERIALIZED (
  SELECT row_no, vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
  FROM kept CROSS JOIN c{number}
  QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY distance, cluster) = 1)"""


def _moved_sql(number: int) -> str:
    return f"""
s{number} AS (
  SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM a{number}, range(1, 65) AS t(i) GROUP BY ALL),
c{number + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(moved, c) AS c FROM c{number} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM s{number} GROUP BY cluster)
  USING (cluster))"""


_CENTROIDS_SQL = (
    "WITH "
    + ",".join([_VECTORS_SQL, *[part for i in range(3) for part in (_assigned_sql(i), _moved_sql(i))], _assigned_sql(3)])
    + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)"""
)

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": _RULES_SQL,
    "op6_warc_fixity": _WARC_SQL,
    "op7_ngram_join": _JOIN_SQL,
    "op8_decontamination": _CONTAMINATION_SQL,
    "op9_substring_dedup": _DEDUP_SQL,
    "op11_conversation_repair": _REPAIR_SQL,
    "op13_centroid_clusters": _CENTROIDS_SQL,
}
