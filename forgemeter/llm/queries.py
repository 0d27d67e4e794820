"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat_snapshots,
    collocations,
    conversation_trie,
    decontamination,
    html_wrappers,
    language_id,
    line_dedup,
    merkle_fixity,
    mixing,
    quality_gam,
    quality_rules,
    simhash,
    token_counts,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedupe_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_deleted", "text")


LEDGER_SQL = """
words AS (
  SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words,
    list_filter(coalesce(string_split(text, chr(10)), []), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS again
  FROM (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM words))
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM grams, (VALUES (0), (1), (2)) AS offsets(k) WHERE again GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(len(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')), 0) AS BIGINT) AS word_chars,
    CAST(coalesce(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM words w LEFT JOIN covered c USING (doc_id)
), ledger AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (5 * n_dup_lines > 2 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
    + 64 * (100 * n_repeat_words > 20 * n_words)::INT AS BIGINT) AS fail_bits
  FROM measured
)
"""


@query("op2_quality_rules", f"""
WITH {LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  (fail_bits & 63) = 0 AS kept, n_lines, fail_bits, 2 AS policy
FROM ledger
""")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(quality_rules.stored_ledger(table(spark, sf_dir, "documents")))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*first, "n_lines", "fail_bits", "policy")


@query("quality_rule_ablations", f"""
WITH {LEDGER_SQL}, cases AS (
  SELECT * FROM (VALUES (1, 'few_words', 1, 3), (1, 'repeated_words', 2, 3),
    (2, 'few_words', 1, 63), (2, 'repeated_words', 2, 63), (2, 'many_symbols', 4, 63), (2, 'duplicate_lines', 8, 63),
    (2, 'short_words', 16, 63), (2, 'long_words', 32, 63),
    (3, 'few_words', 1, 127), (3, 'repeated_words', 2, 127), (3, 'many_symbols', 4, 127), (3, 'duplicate_lines', 8, 127),
    (3, 'short_words', 16, 127), (3, 'long_words', 32, 127), (3, 'some_repetition', 64, 127)) AS t(policy, rule, bit, mask)
)
SELECT policy, rule, count(*) FILTER (fail_bits & bit <> 0) AS failing, count(*) FILTER (fail_bits & mask = bit) AS failing_alone,
  count(*) FILTER (fail_bits & mask = 0) AS kept_with, count(*) FILTER (fail_bits & mask & ~bit = 0) AS kept_without
FROM cases, ledger GROUP BY ALL
""")
def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablations(quality_rules.stored_ledger(table(spark, sf_dir, "documents")))


@query("op3_chat_snapshots", """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position FROM turns
), prefixes AS (
  SELECT conv_id, position, string_agg(role || chr(1) || text || chr(2), '') OVER (PARTITION BY conv_id ORDER BY position) AS prefix FROM numbered
), whole AS (
  SELECT conv_id, max(position) AS n, arg_max(prefix, position) AS prefix FROM prefixes GROUP BY conv_id
), distinct_ones AS (
  SELECT min(conv_id) AS conv_id, n, prefix, count(*) AS n_logged FROM whole GROUP BY n, prefix
), kept AS (
  SELECT d.* FROM distinct_ones d
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p JOIN whole w USING (conv_id) WHERE p.prefix = d.prefix AND p.position < w.n)
)
SELECT k.conv_id, CAST((t.position - 1) // 1024 AS INTEGER) AS part, CAST((k.n + 1023) // 1024 AS INTEGER) AS n_parts, CAST(k.n AS BIGINT) AS n_turns, k.n_logged,
  string_agg('<|' || t.role || '|>' || chr(10) || t.text || chr(10) || '<|end|>' || chr(10), '' ORDER BY t.position) AS rendered
FROM kept k JOIN numbered t USING (conv_id) GROUP BY ALL
""")
def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_snapshots.formatted(table(spark, sf_dir, "conversations"))


@query("op4_html_wrappers")
def op4_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_texts(table(spark, sf_dir, "pages"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A second replica made from the first: some pages changed by one character, some lost, some stored twice."""
    key, half = F.col("page_id"), F.floor(F.length("html") / 2).cast("int")
    changed = F.concat(F.substring("html", F.lit(1), half), F.lit("\x7f"), F.expr("substring(html, cast(floor(length(html) / 2) as int) + 2)"))
    rows = pages.filter(F.coalesce(key % 389 != 7, F.lit(True)))
    rows = rows.withColumn("html", F.when(key % 97 == 13, changed).otherwise(F.col("html")))
    return rows.withColumn("copy", F.explode(F.when(key % 1009 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy")


@query("op6_merkle_fixity", """
WITH records AS (
  SELECT page_id, strlen('WARC/1.0') + 2 + strlen('WARC-Type: response') + 2 + strlen('WARC-Record-ID: <urn:page:' || page_id || '>') + 2
    + strlen('WARC-Target-URI: ' || coalesce(url, '')) + 2 + strlen('Content-Length: ' || strlen(coalesce(html, ''))) + 4 + strlen(coalesce(html, '')) + 4 AS bytes
  FROM pages
), placed AS (
  SELECT *, CAST(coalesce(sum(bytes) OVER (PARTITION BY page_id // 1000 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM records
)
SELECT page_id // 1000 AS file, page_id AS place, "offset", CAST(bytes AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS primary_records,
  CAST(CASE WHEN page_id % 389 = 7 THEN 0 WHEN page_id % 1009 = 5 THEN 2 ELSE 1 END AS BIGINT) AS replica_records,
  CASE WHEN page_id % 389 = 7 THEN 'missing' ELSE 'changed' END AS kind
FROM placed WHERE page_id % 389 = 7 OR page_id % 97 = 13 OR page_id % 1009 = 5
""")
def op6_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return merkle_fixity.audit(pages, damaged_replica(pages))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


MIXING_SQL = """
WITH line AS (
  SELECT doc_id, source, source IS NULL AS no_source, coalesce(source, '') AS src,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ':' || md5(coalesce(text, '')) || ':'
      || row_number() OVER (PARTITION BY doc_id, text ORDER BY source IS NULL, source))) AS place
  FROM documents
), sums AS (
  SELECT no_source, src, CAST(sum(size) AS BIGINT) AS source_size FROM line GROUP BY ALL
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY no_source, src) AS source_no,
    list_extract([3, 1, 2], 1 + CAST((row_number() OVER (ORDER BY no_source, src) - 1) % 3 AS INTEGER)) AS weight FROM sums
), levels AS (
  SELECT *,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, no_source, src
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, no_source, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT *, least(CAST(2 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target,
    CAST(greatest(1, least(1024, ceil(source_size / 256))) AS BIGINT) AS length
  FROM levels
), quotas AS (
  SELECT *, CAST(ceil(source_size / length) AS BIGINT) AS blocks,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * CAST(ceil(source_size / length) AS BIGINT) + 0.5) AS BIGINT) ELSE 0 END AS quota
  FROM targets
), drawn AS (
  SELECT no_source, src, ((n % blocks) * (CASE WHEN blocks % step = 0 THEN 999983 ELSE step END) + start) % blocks AS block, count(*) AS times
  FROM (SELECT no_source, src, blocks, unnest(range(quota)) AS n, CAST('0x' || substr(md5('blocks:0:' || source_no), 1, 8) AS BIGINT) AS start,
          list_extract([1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121], 1 + CAST(CAST('0x' || substr(md5('blocks:0:' || source_no), 9, 8) AS BIGINT) % 8 AS INTEGER)) AS step
        FROM quotas) GROUP BY ALL
), placed AS (
  SELECT line.*, CAST(sum(size) OVER (PARTITION BY no_source, src ORDER BY place, size, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM line
), cut AS (
  SELECT p.doc_id, p.no_source, p.src, p.stop, p.size, q.length, unnest(range((p.stop - p.size) // q.length, (p.stop - 1) // q.length + 1)) AS block
  FROM placed p JOIN quotas q USING (no_source, src) WHERE p.size > 0
), taken AS (
  SELECT cut.doc_id, CAST(sum(times * (least(stop, (cut.block + 1) * length) - greatest(stop - size, cut.block * length))) AS BIGINT) AS taken
  FROM cut JOIN drawn ON cut.no_source = drawn.no_source AND cut.src = drawn.src AND cut.block = drawn.block GROUP BY 1
)
SELECT l.doc_id, l.source, l.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM line l JOIN quotas q USING (no_source, src) LEFT JOIN taken t ON t.doc_id = l.doc_id
"""


@query("op8_mixing", MIXING_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(table(spark, sf_dir, "documents"))


TRIE_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, count(*) AS n FROM turns GROUP BY c
), crc(c, rest, value) AS (
  SELECT c, CAST(c AS VARCHAR), CAST(4294967295 AS BIGINT) FROM sizes
  UNION ALL
  SELECT c, rest[2:], list_reduce(list_prepend(xor(value, ascii(rest)), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))
  FROM crc WHERE rest <> ''
), plan AS (
  SELECT k.c, xor(value, 4294967295) % 4 AS h, k.c - k.c % 20 AS donor, least(xor(value, 4294967295) % 4, coalesce(d.n, 0)) AS taken
  FROM crc k LEFT JOIN sizes d ON d.c = k.c - k.c % 20 WHERE rest = ''
), rebuilt AS (
  SELECT p.c, t.place AS depth, t.role, t.text FROM plan p JOIN turns t ON t.c = p.donor WHERE t.place <= p.taken
  UNION ALL
  SELECT p.c, t.place - p.h + p.taken, t.role, t.text FROM plan p JOIN turns t ON t.c = p.c WHERE t.place > p.h
), steps AS (
  SELECT c, depth, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt
  UNION ALL SELECT c, 0, 'root', 0 FROM sizes
), placed AS (
  SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS up, max(depth) OVER (PARTITION BY c) = depth AS ends FROM steps
), nodes AS (
  SELECT node, depth, min(c) AS conv_id, min(up) AS up, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM placed GROUP BY node, depth
), childless AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.up = n.node) AS n_children FROM nodes n
), below AS (
  SELECT DISTINCT a.node AS top, b.node FROM placed a JOIN placed b ON a.c = b.c AND a.depth <= b.depth
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM childless n LEFT JOIN nodes p ON p.node = n.up
JOIN (SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM below JOIN childless USING (node) GROUP BY top) s ON s.top = n.node
"""


@query("op11_conversation_trie", TRIE_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT id, lang, unnest(w) AS w, generate_subscripts(w, 1) AS place FROM listed
), runs AS (
  SELECT lang, w AS w1, lead(w) OVER piece AS w2, lead(w, 2) OVER piece AS w3 FROM words WINDOW piece AS (PARTITION BY id ORDER BY place)
), found AS (
  SELECT lang, [w1] AS w FROM runs UNION ALL SELECT lang, [w1, w2] FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, [w1, w2, w3] FROM runs WHERE w3 IS NOT NULL
), counts AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, len(w) AS k, any_value(w) AS w, count(*) AS f FROM found GROUP BY 1, 2, 3
), several AS (
  SELECT * FROM counts WHERE k > 1 AND f >= 10
), sides AS (
  SELECT lang, phrase, f, 1 AS k, w[1] AS first_part, array_to_string(w[2:], ' ') AS rest FROM several
  UNION ALL SELECT lang, phrase, f, 2, array_to_string(w[:2], ' '), w[3] FROM several WHERE k = 3
), cuts AS (
  SELECT s.lang, s.phrase, s.k, l.f AS l, r.f AS r, (1000000::HUGEINT * s.f * s.f) // (l.f::HUGEINT * r.f) AS score
  FROM sides s LEFT JOIN counts l ON l.lang = s.lang AND l.phrase = s.first_part LEFT JOIN counts r ON r.lang = s.lang AND r.phrase = s.rest
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts
), inner_ones AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM several WHERE k = 3
), kept AS (
  SELECT s.lang, s.phrase, s.f AS a, c.l, c.r, CAST(c.score AS BIGINT) AS score
  FROM several s JOIN lowest c ON c.lang = s.lang AND c.phrase = s.phrase AND c.place = 1
  WHERE NOT EXISTS (SELECT 1 FROM inner_ones i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.f >= 50 * s.f)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked r JOIN (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang) t ON t.lang = r.lang WHERE rank <= 2000
"""


@query("op12_collocations", COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_quality_gam")
def op13_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
