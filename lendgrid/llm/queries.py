"""The registered queries of the subpackage, each with SQL for the same rows where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendgrid.llm.decontaminate import find_leaks
from lendgrid.llm.filter_audit import audit_filters, document_failures
from lendgrid.llm.frames import scratch_path
from lendgrid.llm.language_crf import detect_languages
from lendgrid.llm.license_scan import scan_licenses
from lendgrid.llm.line_dedup import drop_boilerplate
from lendgrid.llm.mixing import mix_sources
from lendgrid.llm.ordinal_quality import score_quality, train_quality
from lendgrid.llm.quality_rules import STOP_WORDS, apply_quality_rules
from lendgrid.llm.simhash import near_duplicate_classes
from lendgrid.llm.spelling_variants import group_spellings, slipped_words
from lendgrid.llm.suffix_dedup import remove_repeats
from lendgrid.llm.token_counts import Vocabulary, count_tokens
from lendgrid.llm.warc_archive import read_archive, write_archive


#: The folder of the public vocabulary files, and the one whose pieces and scores are used.
TOKENIZERS, PIECES = "/opt/tokenizers", "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source."""
    return drop_boilerplate(table(spark, folder, "documents"), counts=True).select("doc_id", "text", "n_lines", "n_dropped", "all_boilerplate")


OP1_SQL = r"""
WITH pages AS (SELECT row_number() OVER () AS page, doc_id, coalesce('h' || source, '') AS host, text FROM documents),
lines AS (SELECT page, doc_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM pages),
keyed AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS key FROM lines),
totals AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
found AS (SELECT host, key FROM (SELECT host, key, count(DISTINCT page) AS n FROM keyed WHERE key <> '' GROUP BY host, key) AS c
          JOIN totals USING (host) WHERE n >= 5 AND n / pages > 0.05),
marked AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed AS k LEFT JOIN found AS f ON k.host = f.host AND k.key = f.key),
summed AS (SELECT page, count(*) AS n_lines, sum(gone::INT) AS n_gone, bool_and(gone OR key = '') AND bool_or(gone) AS bare,
           string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS rest FROM marked GROUP BY page)
SELECT doc_id, CASE WHEN n_gone > 0 AND NOT bare THEN rest ELSE text END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines,
       CASE WHEN bare THEN 0 ELSE coalesce(n_gone, 0) END::BIGINT AS n_dropped, coalesce(bare, FALSE) AS all_boilerplate
FROM pages LEFT JOIN summed USING (page)
"""


def op2_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page archived as a WARC record and read back."""
    path = scratch_path(spark, "warc")
    write_archive(table(spark, folder, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS d FROM p),
b AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first,
      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(d, 5 * (i // 4) + 1, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), 'string_agg', '') AS b32 FROM h)
SELECT page_id, n::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM b
"""


def op3_token_counts(spark: SparkSession, folder: str, vocabulary: str = f"{TOKENIZERS}/{PIECES}") -> DataFrame:
    """Unigram piece count of every text."""
    return count_tokens(table(spark, folder, "documents"), Vocabulary.read(vocabulary))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licenses that each text names."""
    return scan_licenses(table(spark, folder, "documents"))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that fill half the corpus's tokens by target weights."""
    return mix_sources(table(spark, folder, "documents"), counts=True).select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def _dealt(name: str, nodes: str, parent: str, key: str) -> str:
    """CTEs that deal ``parent_budget`` out over ``nodes`` (capacity, weight) by trying every sibling as the first open one."""
    over = f"PARTITION BY {parent} ORDER BY capacity / weight, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
{name}_o AS (SELECT *, coalesce(sum(capacity) OVER ({over}), 0)::HUGEINT AS before,
  (sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER ({over}), 0))::HUGEINT AS left_w FROM {nodes} WHERE weight > 0),
{name}_f AS (SELECT *, (parent_budget - before) * weight >= capacity::HUGEINT * left_w AS is_full FROM {name}_o),
{name}_l AS (SELECT *, min(CASE WHEN NOT is_full THEN {{'f': capacity / weight, 'k': {key}, 'b': before, 'w': left_w}} END) OVER (PARTITION BY {parent}) AS o FROM {name}_f),
{name} AS (SELECT *, (CASE WHEN is_full THEN capacity ELSE greatest(0, ((parent_budget - o.b) * weight) // o.w) END)::BIGINT AS budget FROM {name}_l)"""


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
  ['web', 'books', 'code', 'forum'][1 + coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % 4] AS domain,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens, lang AS raw_lang, source AS raw_source FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END AS w_domain,
  CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w_lang, 1 AS weight, 2 * sum(tokens)::BIGINT AS capacity
  FROM d WHERE tokens > 0 GROUP BY domain, lang, source),
total AS (SELECT floor(sum(tokens) * 0.5::DOUBLE)::BIGINT AS parent_budget FROM leaf),
dom AS (SELECT domain, sum(capacity)::BIGINT AS capacity, max(w_domain) AS weight, 1 AS top, any_value(parent_budget) AS parent_budget FROM leaf, total GROUP BY domain),
{_dealt('dom_b', 'dom', 'top', 'domain')},
lan AS (SELECT leaf.domain, leaf.lang, sum(leaf.capacity)::BIGINT AS capacity, max(w_lang) AS weight, any_value(dom_b.budget) AS parent_budget
  FROM leaf JOIN dom_b ON leaf.domain = dom_b.domain GROUP BY leaf.domain, leaf.lang),
{_dealt('lan_b', 'lan', 'domain', 'lang')},
src AS (SELECT leaf.*, lan_b.budget AS parent_budget FROM leaf JOIN lan_b USING (domain, lang)),
{_dealt('src_b', 'src', 'domain, lang', 'source')},
cut AS (SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest FROM src_b WHERE budget > 0),
keyed AS (SELECT d.*, epochs, rest, md5('7|' || epochs || '|' || coalesce(doc_id::VARCHAR, 'none')) AS key FROM d JOIN cut USING (domain, lang, source) WHERE d.tokens > 0),
placed AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
  - sum(tokens) OVER (PARTITION BY domain, lang, source, key) AS start FROM keyed)
SELECT doc_id, domain, raw_lang AS lang, raw_source AS source, tokens AS n_tokens, (epochs + (start < rest)::INT)::INT AS copies
FROM placed WHERE epochs + (start < rest)::INT > 0
"""


def op6_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and tail probabilities of every text."""
    docs = table(spark, folder, "documents")
    model = train_quality(docs, table(spark, folder, "labels"))
    return score_quality(docs.select("doc_id", "text"), model).drop("text")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a benchmark item, and the item."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The measures of every text and the verdict of the rules."""
    return apply_quality_rules(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS ws FROM d) AS x),
win AS (SELECT r, i, [word, lead(word) OVER o, lead(word, 2) OVER o] AS t, lead(word, 2) OVER o IS NOT NULL AS whole FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM win WHERE whole) AS x WHERE n > 1),
cov AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) AS x GROUP BY r),
wc AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum((lower(word) IN ({', '.join(f"'{x}'" for x in STOP_WORDS)}))::INT) AS n_stop FROM w GROUP BY r),
l AS (SELECT r, unnest(string_split(body, chr(10))) AS line FROM d),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stop, 0) AS n_stop
  FROM d LEFT JOIN wc USING (r) LEFT JOIN cov USING (r) LEFT JOIN lc USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words
  AND n_symbols / n_words <= 0.3 AND n_stop / n_words >= 0.01 AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept
FROM m
"""


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicate_classes(table(spark, folder, "documents"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text without the strings that earlier documents have."""
    left = remove_repeats(table(spark, folder, "documents"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes at each step of each order, by source."""
    return audit_filters(document_failures(table(spark, folder, "documents"), table(spark, folder, "labels")))


OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (SELECT doc_id, part, coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), FALSE) AS e, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
  100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) AS c, regexp_matches(body, '[#$%&*|]') AS d FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
o AS (SELECT '' AS filter_order, 0 AS used UNION ALL
  SELECT filter_order || substr('ABCDE', i::INT + 1, 1), used | (1 << i::INT) FROM o, range(5) AS r(i) WHERE used & (1 << i::INT) = 0),
s AS (SELECT filter_order, i::INT AS step, 1 << (instr('ABCDE', substr(filter_order, i::INT, 1)) - 1)::INT AS own,
  list_sum(list_transform(range(1, i), lambda j: 1 << (instr('ABCDE', substr(filter_order, j::INT, 1)) - 1)::INT)) AS before
  FROM o, range(1, 6) AS r(i) WHERE length(filter_order) = 5),
x AS (SELECT part, filter_order, step, own, n, good, toxic, mask = own AS only_own, mask & own > 0 AS fails, mask & coalesce(before, 0)::INT > 0 AS gone FROM m, s),
y AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (only_own), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM y
"""


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word, the frequent word that it may be a spelling of, and the last one of such a chain."""
    return group_spellings(slipped_words(table(spark, folder, "documents")))


OP12_SQL = r"""
WITH RECURSIVE runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
u AS (SELECT row_number() OVER () AS k, run, n, bytes, length(bytes) // 2 AS size FROM (SELECT run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes FROM runs GROUP BY id, run) AS x),
t AS (SELECT i AS b, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)),
places AS (SELECT 0::BIGINT AS d, b, v FROM t UNION ALL
  SELECT p.d + 1, p.b, xor(p.v >> 8, t.v) FROM places AS p JOIN t ON t.b = p.v & 255 WHERE p.d < (SELECT max(size) FROM u)),
bytes AS (SELECT k, size - 1 - j AS d, xor(('0x' || substr(bytes, (2 * j + 1)::INT, 2))::BIGINT, CASE WHEN j < 4 THEN 255 ELSE 0 END) AS b FROM (SELECT *, unnest(range(size)) AS j FROM u) AS x),
crc AS (SELECT k, xor(bit_xor(v), 4294967295) AS h FROM bytes JOIN places USING (d, b) GROUP BY k),
slipped AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM u JOIN crc USING (k)),
w AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w) AS x),
near AS (SELECT a.word, b.word AS near FROM less AS a JOIN less AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less AS l JOIN w ON l.rest = w.word UNION SELECT w.word, l.word FROM less AS l JOIN w ON l.rest = w.word),
ranked AS (SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near
  FROM near JOIN (SELECT word AS near, n FROM w) AS x USING (near)),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN x.n >= 10 * w.n THEN near END AS form, CASE WHEN x.n >= 10 * w.n THEN x.n END AS form_n
  FROM w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) AS x USING (word)),
chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT c.word, f.form FROM chain AS c JOIN formed AS f ON c.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain AS c JOIN formed AS f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""


def op13_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text."""
    return detect_languages(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_warc_archive, op3_token_counts, op4_license_scan, op5_source_mixing, op6_ordinal_quality, op7_decontamination, op8_quality_rules,
                                   op9_simhash, op10_suffix_dedup, op11_filter_audit, op12_spelling_variants, op13_language_crf)}
SQL = {"op1_line_dedup": OP1_SQL, "op2_warc_archive": OP2_SQL, "op5_source_mixing": OP5_SQL, "op8_quality_rules": OP8_SQL, "op11_filter_audit": OP11_SQL, "op12_spelling_variants": OP12_SQL}
