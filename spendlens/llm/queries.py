"""The operators as queries over the test tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import table
from spendlens.llm.conversation_repair import damaged, repair_report, turns_of
from spendlens.llm.decontamination import contamination
from spendlens.llm.exact_dedup import exact_dedup
from spendlens.llm.simhash import simhash_components
from spendlens.llm.html_extraction import main_text
from spendlens.llm.language_id import language_id
from spendlens.llm.line_dedup import line_dedup
from spendlens.llm.quality_rules import quality_rules
from spendlens.llm.secret_scan import secret_scan
from spendlens.llm.substring_dedup import substring_dedup
from spendlens.llm.toxicity import toxicity
from spendlens.llm.sentencepiece_tokens import sentencepiece_tokens
from spendlens.llm.vector_codes import book_digest, vector_codes, with_label_errors


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_tokens(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(turns_of(table(spark, sf_dir, "conversations"))))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error",
                                           F.lit(book_digest(book)).alias("codebooks_sha256"))


_OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS t, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0
), doc_windows AS (
  SELECT doc_id, i, t, array_to_string(w[i:i + t - 1], ' ') AS g
  FROM d, (SELECT DISTINCT t FROM item_windows) AS lengths, unnest(range(1, len(w) - t + 2)) AS u(i)
), hits AS (
  SELECT doc_id, item_id, i, t FROM doc_windows JOIN item_windows USING (t, g)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, t FROM hits), unnest(range(i, i + t)) AS u(p)
  GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP5 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM n WINDOW same AS (PARTITION BY body)
"""


_OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM d, unnest(range(1, len(w) - 48)) AS u(i)
), covered AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM windows), unnest(range(i, i + 50)) AS u(p)
  WHERE least < doc_id
), kept AS (
  SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS body, count(*) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


_OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('s' || source, '') AS owner, {'s': source, 'l': lang}::VARCHAR AS repo FROM documents
), patterns(kind, pattern, grp) AS (
  VALUES ('assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
         ('access', 'AKIA[A-Z0-9]+', 0), ('hex', '[0-9a-f]{24,}', 0), ('opaque', '[A-Za-z0-9]{16,}', 0)
), parts AS (
  SELECT doc_id, owner, repo, 'assign' AS kind, string_split_regex(text, pattern) AS gaps,
         regexp_extract_all(text, pattern, 0) AS matches, regexp_extract_all(text, pattern, 2) AS vals
  FROM d, patterns WHERE kind = 'assign'
  UNION ALL
  SELECT doc_id, owner, repo, kind, string_split_regex(text, pattern), regexp_extract_all(text, pattern, 0),
         regexp_extract_all(text, pattern, 0)
  FROM d, patterns WHERE kind <> 'assign'
), rows_ AS (
  SELECT doc_id, owner, repo, kind, i, length(gaps[i]) AS gap, length(matches[i]) AS size, vals[i] AS val
  FROM parts, unnest(range(1, len(matches) + 1)) AS u(i)
), placed AS (
  SELECT doc_id, owner, repo, kind, size, val, sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop,
         length(regexp_replace(val, '[^0-9]', '', 'g')) >= 4 AND length(regexp_replace(val, '[^A-Za-z]', '', 'g')) >= 4 AS looks
  FROM rows_
), candidates AS (
  SELECT *, stop - size AS start FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(val) >= 6 WHEN 'access' THEN size >= 20 WHEN 'hex' THEN true ELSE looks END
), held AS (
  SELECT val, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos, owners >= 3 OR repos >= 6 AS copied
  FROM candidates GROUP BY val
), spans AS (
  SELECT DISTINCT doc_id, kind, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END AS rank, start, stop, copied
  FROM candidates JOIN held USING (val) WHERE kind <> 'opaque'
  UNION ALL
  SELECT DISTINCT doc_id, 'live', 3, stop - length(val), stop, false
  FROM candidates JOIN held USING (val) WHERE looks AND NOT copied
), found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (copied) AS n_copied,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank, stop) AS spans
  FROM spans GROUP BY doc_id
), most AS (
  SELECT doc_id, max(owners) AS most_owners, max(repos) AS most_repos FROM candidates JOIN held USING (val) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_copied, 0) AS n_copied, coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN most USING (doc_id)
"""


_OP9 = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line, regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS u(i)
), same AS (
  SELECT doc_id, line, w, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS nth FROM lines WHERE len(w) > 0
), firsts AS (
  SELECT row_number() OVER (ORDER BY doc_id, line) AS id, doc_id, line, w FROM same WHERE nth = 1
), shingles AS (
  SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
  FROM firsts, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i)
), sizes AS (
  SELECT id, count(*) AS n FROM shingles GROUP BY id
), pairs AS (
  SELECT a.id AS a, b.id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2
), removed AS (
  SELECT doc_id, line FROM same WHERE nth > 1
  UNION
  SELECT doc_id, line FROM firsts JOIN (
    SELECT DISTINCT o.b FROM pairs o JOIN sizes x ON x.id = o.a JOIN sizes y ON y.id = o.b
    WHERE 10 * shared >= 8 * (x.n + y.n - shared)
  ) ON id = b
), per_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed_lines FROM removed GROUP BY doc_id
)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_removed,
       coalesce(removed_lines, '') AS removed_lines
FROM documents LEFT JOIN per_doc USING (doc_id)
"""


_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS n FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), repeated AS (
  SELECT k, count(DISTINCT p) AS n FROM windows, unnest([i, i + 1, i + 2]) AS u(p) WHERE n > 1 GROUP BY k
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^!?]', '', 'g')) AS BIGINT) AS n_shouts
  FROM d LEFT JOIN repeated USING (k)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
         + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
         + 32 * (word_chars > 16 * n_words)::INT + 64 * (10 * n_shouts > 3 * n_words)::INT AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 > 0 AS base_failed, failed = 0 AS kept,
       n_lines, n_shouts, failed, CAST(2 AS INTEGER) AS policy_version
FROM f
"""


_OP12 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), kinds AS (
  SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b)),
    CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM keyed
), rows_ AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM rows_
), judged AS (
  SELECT *, CASE WHEN ending = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
                 WHEN ending IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM placed
), numbered AS (
  SELECT *, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 3 ELSE 1000000 END AS w FROM judged
), walk AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'a': '', 'b': ''} AS s0, {'c': CAST(1000000 AS BIGINT), 'a': '', 'b': ''} AS s1,
         {'c': CAST(1000000 AS BIGINT), 'a': '', 'b': ''} AS s2, {'c': CAST(1000000 AS BIGINT), 'a': '', 'b': ''} AS s3
  FROM keyed GROUP BY conv
  UNION ALL
  SELECT conv, i, {'c': s0.c + 4, 'a': s0.a || 'D', 'b': s0.b}, list_sort([{'c': s1.c + 4, 'a': s1.a || 'D', 'b': s1.b}, {'c': s0.c + w + CASE initial WHEN 's' THEN 0 ELSE 1000000 END, 'a': s0.a || 'K', 'b': s0.b || chr(10) || role || ':' || text}])[1],
         list_sort([{'c': t2.c + 4, 'a': t2.a || 'D', 'b': t2.b}, {'c': x.c + w + CASE initial WHEN 'u' THEN 0 ELSE 1000000 END, 'a': x.a || 'K', 'b': x.b || chr(10) || role || ':' || text}, {'c': x.c + w + 3, 'a': x.a || 'R', 'b': x.b || chr(10) || 'user:' || text}])[1],
         list_sort([{'c': t3.c + 4, 'a': t3.a || 'D', 'b': t3.b}, {'c': t2.c + w + CASE initial WHEN 'a' THEN 0 ELSE 1000000 END, 'a': t2.a || 'K', 'b': t2.b || chr(10) || role || ':' || text}, {'c': t2.c + w + 3, 'a': t2.a || 'R', 'b': t2.b || chr(10) || 'assistant:' || text}])[1]
  FROM (SELECT *, list_sort([s0, s1, t3])[1] AS x
        FROM (SELECT *, list_sort([s3, {'c': t2.c + 3, 'a': t2.a || 'I', 'b': t2.b || chr(10) || 'assistant:'}])[1] AS t3
              FROM (SELECT conv, n.i, s0, s1, s3, role, text, initial, w, list_sort([s2, {'c': s0.c + 3, 'a': s0.a || 'I', 'b': s0.b || chr(10) || 'user:'}, {'c': s1.c + 3, 'a': s1.a || 'I', 'b': s1.b || chr(10) || 'user:'}, {'c': s3.c + 3, 'a': s3.a || 'I', 'b': s3.b || chr(10) || 'user:'}])[1] AS t2
                    FROM walk JOIN numbered n USING (conv) WHERE n.i = walk.i + 1)))
), ended AS (
  SELECT conv, list_sort([s0, f3])[1] AS f
  FROM (SELECT *, list_sort([s3, {'c': f2.c + 3, 'a': f2.a || 'I', 'b': f2.b || chr(10) || 'assistant:'}])[1] AS f3
        FROM (SELECT *, list_sort([s2, {'c': s0.c + 3, 'a': s0.a || 'I', 'b': s0.b || chr(10) || 'user:'}, {'c': s1.c + 3, 'a': s1.a || 'I', 'b': s1.b || chr(10) || 'user:'}, {'c': s3.c + 3, 'a': s3.a || 'I', 'b': s3.b || chr(10) || 'user:'}])[1] AS f2
              FROM walk WHERE i = coalesce((SELECT max(i) FROM numbered n WHERE n.conv = walk.conv), 0)))
), counts AS (
  SELECT conv, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM numbered GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, f.c AS cost, f.a AS audit, sha256(substr(f.b, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM keyed) JOIN ended USING (conv) LEFT JOIN counts USING (conv)
"""


_OP13 = r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS k, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT k, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, unnest(range(16)) AS u(p)
), book0 AS (
  SELECT p, k AS e, x AS c FROM parts WHERE k < 64
), near0 AS MATERIALIZED (
  SELECT k, p, arg_min(e, dist * 256 + e) AS e, min(dist) AS dist FROM (
    SELECT k, p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist
    FROM parts JOIN book0 USING (p)) GROUP BY k, p
), book1 AS MATERIALIZED (
  SELECT p, e, list(coalesce(m, c) ORDER BY j) AS c FROM (
    SELECT p, e, j, c[j] AS c FROM book0, unnest(range(1, len(c) + 1)) AS u(j)
  ) LEFT JOIN (
    SELECT p, e, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS m FROM near0 JOIN parts USING (k, p), unnest(range(1, len(x) + 1)) AS u(j)
    GROUP BY p, e, j
  ) USING (p, e, j) GROUP BY p, e
), near1 AS MATERIALIZED (
  SELECT k, p, arg_min(e, dist * 256 + e) AS e, min(dist) AS dist FROM (
    SELECT k, p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist
    FROM parts JOIN book1 USING (p)) GROUP BY k, p
), book2 AS MATERIALIZED (
  SELECT p, e, list(coalesce(m, c) ORDER BY j) AS c FROM (
    SELECT p, e, j, c[j] AS c FROM book1, unnest(range(1, len(c) + 1)) AS u(j)
  ) LEFT JOIN (
    SELECT p, e, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS m FROM near1 JOIN parts USING (k, p), unnest(range(1, len(x) + 1)) AS u(j)
    GROUP BY p, e, j
  ) USING (p, e, j) GROUP BY p, e
), near2 AS MATERIALIZED (
  SELECT k, p, arg_min(e, dist * 256 + e) AS e, min(dist) AS dist FROM (
    SELECT k, p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist
    FROM parts JOIN book2 USING (p)) GROUP BY k, p
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM near2 GROUP BY k
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (k), digest
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_toxicity, op3_language_id, op4_decontamination, op5_exact_dedup, op6_sentencepiece,
                                   op7_substring_dedup, op8_secret_scan, op9_line_dedup, op10_html_extraction, op11_quality_rules, op12_conversation_repair, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": _OP4, "op5_exact_dedup": _OP5,
            "op7_substring_dedup": _OP7, "op8_secret_scan": _OP8,
            "op9_line_dedup": _OP9, "op11_quality_rules": _OP11,
            "op12_conversation_repair": _OP12, "op13_vector_codes": _OP13}
