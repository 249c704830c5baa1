"""The queries of the operators, as the entry point registers them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import decontam, divergence, htmltext, mixing, packing, quality, rules, sharding, simhash, substring, toxicity, trie, urlfilter
from tracelake.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumn("rejected_by", F.array_join("rejected_by", ","))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.chosen(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.without_repeats(table(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urlfilter.default_rules(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.numbered(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


_DEALT = (op1_decontamination, op2_quality, op3_packing, op4_quality_rules, op5_mixing, op6_substring_dedup, op7_simhash, op8_url_filter, op9_html_text, op10_toxicity)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (*_DEALT, op11_divergence, op12_sharding, op13_prefix_trie)}

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def rules_sql(limit: float = rules.LIMIT, delta: float = rules.DELTA) -> str:
    """SQL of op4_quality_rules, with the binomial bounds from log-gamma terms."""
    grid = ", ".join(f"('{m}', {i}, {c}::DOUBLE)" for m, i, c in rules.STEPS)
    p = limit
    term = f"exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}::DOUBLE) + (n - i) * ln(1 - {p}::DOUBLE))"
    value = " ".join(f"WHEN '{m}' THEN {m}" for m in rules.GRID)
    named = ", ".join(f"CASE WHEN {m} > (SELECT min(c) FROM taken WHERE taken.stratum = f.stratum AND taken.m = '{m}') THEN '{m}' END" for m in rules.GRID)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '(null)') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, {_WORDS.format("t")} AS w FROM d),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 3)) AS k) GROUP BY 1),
n AS (SELECT d.r, d.doc_id, d.stratum, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d) d JOIN w USING (r) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
  coalesce(n_symbols / word_chars, 0) AS symbol_share, 100 * coalesce(n_dup_lines / n_words, 0) AS dup_lines_per_100_words,
  coalesce(n_repeat_words / n_words, 0) AS repeat_share, coalesce(word_chars / n_words, 0) AS mean_word, coalesce(n_upper / word_chars, 0) AS upper_share FROM n),
lab AS (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
known AS (SELECT f.*, q, substr(md5(doc_id::VARCHAR), 1, 1) IN ({", ".join(f"'{x}'" for x in rules.DESIGN)}) AS design FROM f JOIN lab USING (doc_id) WHERE NOT base_failed
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY stratum, {", ".join(rules.GRID)}) = 1),
over AS (SELECT r, stratum, q, design, m, i, c, CASE m {value} END > c AS above FROM known, (VALUES {grid}) AS g(m, i, c)),
steps AS (SELECT stratum, m, c, row_number() OVER (PARTITION BY stratum ORDER BY count(*) FILTER (design AND above AND q = 1), count(*) FILTER (design AND above AND q = 0) DESC, i DESC, m) AS place
  FROM over GROUP BY stratum, m, i, c),
good AS (SELECT r, over.stratum, min(place) FILTER (above) AS place FROM over JOIN steps USING (stratum, m, c) WHERE NOT design AND q = 1 GROUP BY 1, 2),
joint AS (SELECT s.stratum, s.place, count(*) AS n, count(*) FILTER (g.place <= s.place) AS k FROM steps s JOIN good g ON g.stratum = s.stratum GROUP BY 1, 2),
tails AS (SELECT *, n / (SELECT count(*) FROM good) AS share, CASE WHEN k < {p} * n THEN list_sum(list_transform(range(0, k + 1), lambda i: {term})) ELSE 1 END AS tail FROM joint),
last AS (SELECT stratum, max(place) AS last FROM tails WHERE tail < {delta} * share GROUP BY 1),
taken AS (SELECT steps.* FROM steps JOIN last USING (stratum) WHERE place <= last)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by = '' AS kept, rejected_by
FROM (SELECT *, array_to_string(list_filter([{named}], lambda x: x IS NOT NULL), ',') AS rejected_by FROM f)"""


#: A list of the 256 remainders of the CRC-32, and the CRC-32 of the bytes of {0} by it (as t).
_CRC_TABLE = "tab AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT) AS c FROM (SELECT unnest(range(0, 256)) AS b)))"
_CRC = "xor(list_reduce(list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda x: ('0x' || x)::BIGINT), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::BIGINT), 4294967295)"


def divergence_sql(least: int = divergence.LEAST_DOCUMENTS, top: int = divergence.TOP) -> str:
    """SQL of op11_divergence."""
    share = "(CASE WHEN v > 0 THEN 1 + ({0}::HUGEINT + 5) * 1000000000 // ({1}::HUGEINT + 5 * v) ELSE 0 END)".format
    return rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER.replace("text", "coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT lang, source, r, unnest(w) AS term FROM (SELECT *, row_number() OVER () AS r FROM d)),
k AS (SELECT lang, term FROM e GROUP BY 1, 2 HAVING count(DISTINCT r) >= {least}),
c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY 1) USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2) USING (lang, source)),
p AS (SELECT lang, source, k.term, coalesce(n, 0) AS n, {share("coalesce(n, 0)", "total")} AS p FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, {share("m", "m_all")} AS q FROM (SELECT lang, term, v, sum(n) AS m, sum(sum(n)) OVER (PARTITION BY lang) AS m_all FROM p JOIN g USING (lang, source) GROUP BY 1, 2, 3)),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term) GROUP BY 1, 2, 3) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM f) WHERE part = 'pair' OR r <= {top}"""


ORACLE = {
    "op11_divergence": divergence_sql(),
    "op12_sharding": f"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (SELECT x, {_CRC.format("x")} AS crc FROM (SELECT DISTINCT coalesce(text, '') AS x FROM documents), tab),
ids AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS k, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT AS h FROM documents),
jumps(k, b, j, s) AS (SELECT k, -1::BIGINT, 0::BIGINT, h::HUGEINT FROM ids
  UNION ALL SELECT k, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((s2 // 8589934592) + 1)::DOUBLE))::BIGINT, s2
  FROM (SELECT k, j, (s * {sharding.MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT AS s2 FROM jumps WHERE j < {sharding.SHARDS + 1})),
ends AS (SELECT k, max(j) FILTER (j < {sharding.SHARDS})::INTEGER AS shard, max(j) FILTER (j < {sharding.SHARDS + 1})::INTEGER AS grown_shard FROM jumps GROUP BY 1),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + {sharding.OVERHEAD} AS size, crc AS text_crc32, shard, grown_shard, CASE WHEN h >= 9223372036854775808 THEN h::HUGEINT - 18446744073709551616::HUGEINT ELSE h::HUGEINT END AS h
  FROM documents JOIN texts ON x = coalesce(text, '') JOIN ids ON ids.k = coalesce(doc_id::VARCHAR, '') JOIN ends ON ends.k = ids.k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM d""",
    "op13_prefix_trie": rf"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, digest, len({_WORDS.format("text")}) AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) - 1 AS i FROM t),
c AS (SELECT conv_id, giver, CASE WHEN giver = conv_id THEN 0 ELSE {_CRC.format("conv_id::VARCHAR")} % {trie.HEADS} END AS h FROM (SELECT DISTINCT conv_id, conv_id - conv_id % {trie.GROUP} AS giver FROM t), tab),
r AS (SELECT c.conv_id, 0 AS own, i, digest, words FROM c JOIN o ON o.conv_id = giver AND i < h UNION ALL SELECT conv_id, 1, i, digest, words FROM c JOIN o USING (conv_id) WHERE i >= h),
l AS (SELECT conv_id, coalesce(list(digest ORDER BY own, i) FILTER (digest IS NOT NULL), []) AS l, coalesce(list(words ORDER BY own, i) FILTER (digest IS NOT NULL), []) AS w FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d, array_to_string(l[1:d], ' ') AS k, CASE WHEN d = 0 THEN NULL ELSE array_to_string(l[1:d-1], ' ') END AS up, coalesce(w[d], 0) AS words, len(l) = d AS last FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM l)),
n AS (SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
ch AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
s AS (SELECT p.d, p.k, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (ch.k IS NULL) AS n_leaves FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d LEFT JOIN ch ON ch.d = n.d AND ch.k = n.k GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (d, k) LEFT JOIN ch USING (d, k) LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.up""",
    "op4_quality_rules": rules_sql(),
    "op1_decontamination": f"""
WITH d AS (SELECT DISTINCT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM hit JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item""",
    "op6_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i+34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM rep, (SELECT unnest(range(0, 35)) AS k)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS kept, count(*) AS n FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op8_url_filter": r"""
WITH r(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
rs AS (SELECT rule, verdict, substr(rule, 1, strpos(rule, '/') - 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM r),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM p JOIN rs ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT p.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
}
