"""The registered queries of this package, with their SQL where there is one."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayflow.llm import bands, bitplanes, importance, jaccard, langid, lexical, licenses, milquality, packing, perspective, simhash, urlfilter, wumanber
from stayflow.llm.text import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op2_compression_bands")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.compression_bands(documents(spark, sf_dir))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


# The word characters and the window of the contamination rule.
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
       FROM d, sizes, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS t(i)),
hits AS (SELECT DISTINCT dw.r, dw.i, dw.size, bw.item FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op4_benchmark_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wumanber.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark")).drop("items")


@query("op5_bit_plane_ids")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.round_trip(documents(spark, sf_dir))


@query("op6_output_code_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_all(documents(spark, sf_dir))


OP7_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
m AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS form
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || form || CASE WHEN form = 'user' THEN ' name=' || coalesce(speaker, 'unknown') ELSE '' END || chr(10) AS head FROM m),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS message FROM h),
w AS (SELECT *, CAST(coalesce(sum(length(message)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, body, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s)
SELECT conv_id, perspective, turn, speaker, form, message, start, CASE WHEN form = 'assistant' THEN start + length(head) END AS learn_start,
       CASE WHEN form = 'assistant' THEN length(body) + 11 END AS learn_length
FROM w
"""


@query("op7_perspective_rotation", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspective.rotate(documents(spark, sf_dir, "conversations"))


@query("op8_attention_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return milquality.score_all(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@query("op9_cost_balanced_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


OP10_SQL = r"""
WITH r AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
      regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query FROM r),
k AS (SELECT page_id, host, path, CASE WHEN instr(url, '://') > 0 THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '')
      || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key FROM u),
l AS (SELECT DISTINCT key FROM k WHERE page_id % 50 = 0 AND key IS NOT NULL),
j AS (SELECT k.*, l.key IS NOT NULL AS listed,
      CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
           WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
           WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
      FROM k LEFT JOIN l ON k.key = l.key)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM j
"""


@query("op10_blocked_bloom_url_filter", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of the query set: every page whose id is divisible by 50."""
    listed = documents(spark, sf_dir, "pages").filter("page_id % 50 = 0")
    return urlfilter.judge_urls(documents(spark, sf_dir, "pages"), listed)


# The buckets, the salt, the share drawn and the CRC-32 polynomial.
OP11_SQL = r"""
WITH crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
             FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dc AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY ALL),
tc AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY ALL),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM dc UNION SELECT word FROM tc)),
b AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
             lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM v, crc),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM dc JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM tc JOIN b USING (word) GROUP BY bucket),
total AS (SELECT coalesce((SELECT CAST(sum(s) AS BIGINT) FROM s), 0) AS s_all, coalesce((SELECT CAST(sum(t) AS BIGINT) FROM t), 0) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), total),
k AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM dc JOIN b USING (word) JOIN g USING (bucket) GROUP BY r),
p AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
      CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise FROM d LEFT JOIN k USING (r)),
q AS (SELECT *, weight + noise AS score, count(CASE WHEN n_features >= 20 THEN 1 END) OVER () AS n,
      row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features) AS place FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM q
"""


@query("op11_importance_resampling", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


# The word characters, the shingle length and the least similarity.
OP12_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT r, n, min(r) OVER (PARTITION BY f, n) AS rep FROM (SELECT r, n, string_agg(hash(g), ',' ORDER BY hash(g)) AS f FROM s JOIN n USING (r) GROUP BY r, n)),
u AS (SELECT s.r, g, n FROM s JOIN c USING (r) WHERE c.r = rep),
o AS (SELECT a.r AS x, b.r AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common FROM u AS a JOIN u AS b ON a.g = b.g AND a.r <> b.r AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY a.r, b.r),
l AS (SELECT x, y FROM o WHERE 100 * common >= 90 * (nx + ny - common)),
reach(x, y) AS (SELECT DISTINCT rep, rep FROM c UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y),
best AS (SELECT reach.x AS rep, min(doc_id) AS component_id FROM reach JOIN c ON c.rep = reach.y JOIN d ON d.r = c.r GROUP BY reach.x)
SELECT doc_id, coalesce(c.n, 0) AS n_shingles, CASE WHEN c.n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN c USING (r) LEFT JOIN best USING (rep)
"""


@query("op12_signature_tree_join", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(documents(spark, sf_dir))


# The term characters, the scale of the scores and the number of documents per item.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS b, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM tf, total GROUP BY term),
m AS (SELECT r, doc_id, CAST(10 + ((90 * len(w) * n_docs) // l) AS BIGINT) AS m FROM d, total WHERE len(w) > 0),
s AS (SELECT b, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM (SELECT b, unnest(w) AS term FROM b) JOIN df USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY b, r),
k AS (SELECT b, doc_id, score, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k JOIN b USING (b) WHERE rank <= 10
"""


@query("op13_ranked_lexical_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
