"""The text operators as named queries over whole tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, conversations, decontamination, exact_dedup, language, line_dedup, lm, near_dedup, quality, spelling, token_counts,
    token_files, toxicity,
)
from tidemark.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


QUERIES: dict[str, Query] = {
    "op1_decontamination": lambda s, d: decontamination.find_items(documents(s, d), table(s, d, "benchmark")),
    "op2_quality_rules": lambda s, d: quality.judge(documents(s, d)),
    "op3_token_counts": lambda s, d: token_counts.count_tokens(documents(s, d)),
    "op4_near_dedup": lambda s, d: near_dedup.classes(documents(s, d)),
    "op5_byte_bpe": lambda s, d: bpe.round_trip_digests(documents(s, d)),
    "op6_lm_scoring": lambda s, d: lm.score_documents(documents(s, d)),
    "op7_toxicity": lambda s, d: toxicity.score_texts(documents(s, d), table(s, d, "labels")),
    "op8_language_id": lambda s, d: language.identify(documents(s, d)),
    "op9_token_files": lambda s, d: token_files.token_file_digests(documents(s, d)),
    "op10_line_dedup": lambda s, d: line_dedup.line_digests(documents(s, d)),
    "op11_exact_dedup": lambda s, d: exact_dedup.find_copies(documents(s, d)),
    "op12_conversation_repair": lambda s, d: conversations.repaired_digests(table(s, d, "conversations")),
    "op13_spelling_variants": lambda s, d: spelling.variants(documents(s, d)),
}

# crc32 of a UTF-8 text as a SQL expression: the table of 256 remainders, made by shifting, and one step a byte.
CRC_TABLE = """crc AS (
  SELECT list(r ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(3988292384, r >> 1) ELSE r >> 1 END) AS r
    FROM (SELECT unnest(range(256)) AS i))
)"""


def crc32_sql(text: str) -> str:
    digits = f"hex(encode({text}))"
    bytes_of = f"list_transform(range(1, length({digits}) + 1, 2), lambda p: CAST('0x' || {digits}[p:p + 1] AS BIGINT))"
    step = "lambda c, b: xor(crcs[xor(c, b) % 256 + 1], c >> 8)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_of}), {step}))"

ORACLES: dict[str, str] = {
    "op10_line_dedup": """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
split AS (SELECT doc_id, string_split(body, chr(10)) AS lines FROM docs),
lines AS (
  SELECT doc_id, i AS pos, lines[i] AS line,
         translate(trim(lines[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split, unnest(range(1, len(lines) + 1)) AS r(i)
),
keys AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT l.doc_id, l.pos, l.line, k.key IS NOT NULL AND l.doc_id <> k.keeper AS lost
  FROM lines l LEFT JOIN keys k ON l.key = k.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_exact_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM t
""",
    "op12_conversation_repair": f"""
WITH RECURSIVE {CRC_TABLE},
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS named FROM conversations
),
kinds AS (SELECT conv_id, turn, role, text, {crc32_sql("named")} % 20 AS kind FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER w AS rn, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS previous,
         rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS ink
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
faults AS (
  SELECT *, CASE WHEN ink = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'd'
                 WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM placed
),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
         count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE rn > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n
  FROM faults GROUP BY conv_id
),
inserts(a, b, initials, lines) AS (
  VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
         (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']),
         (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:']),
         (2, 2, 'II', ['assistant:', 'user:']), (3, 3, 'II', ['user:', 'assistant:'])
),
edits(b, c, edit, wanted, role) AS (
  VALUES (0, 0, 'D', NULL, NULL), (1, 1, 'D', NULL, NULL), (2, 2, 'D', NULL, NULL), (3, 3, 'D', NULL, NULL),
         (0, 1, 'K', 's', NULL), (0, 2, 'K', 'u', NULL), (1, 2, 'K', 'u', NULL), (2, 3, 'K', 'a', NULL), (3, 2, 'K', 'u', NULL),
         (0, 2, 'R', NULL, 'user'), (1, 2, 'R', NULL, 'user'), (2, 3, 'R', NULL, 'assistant'), (3, 2, 'R', NULL, 'user')
),
walk AS (
  SELECT conv_id, n, 0 AS rn, 0 AS state, struct_pack(cost := 0, audit := '', body := CAST([] AS VARCHAR[])) AS best FROM figures
  UNION ALL
  SELECT w.conv_id, w.n, w.rn + 1, e.c, min(struct_pack(
           cost := w.best.cost + 3 * length(i.initials) + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                   + CASE WHEN f.fault = 't' AND e.edit <> 'D' THEN 3 ELSE 0 END,
           audit := w.best.audit || i.initials || e.edit,
           body := list_concat(w.best.body, i.lines, CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.role, f.role) || ':' || f.text] END)))
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rn = w.rn + 1
  JOIN inserts i ON i.a = w.state JOIN edits e ON e.b = i.b
  WHERE (e.wanted IS NULL OR e.wanted = f.initial) AND (e.edit = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.n, w.rn, e.c
),
ends AS (
  SELECT conv_id, min(struct_pack(
           cost := best.cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
           audit := best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
           body := list_concat(best.body, CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END))) AS best
  FROM walk WHERE rn = n GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {CRC_TABLE},
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents
),
runs AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named
         FROM found WHERE length(run) >= 5 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc32_sql("named")} AS h FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n) AS n
  FROM hashed GROUP BY 1
),
vocabulary AS (SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 5 AND n >= 3),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM vocabulary, unnest(range(1, length(word) + 1)) AS r(i)
),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM near GROUP BY word
),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
         CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON v.word = b.word
),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.next IS NULL
""",
}
