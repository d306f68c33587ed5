"""The queries opN_<name> and pipeline: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.llm import bpe, conversations, fillin, fingerprints, licenses, linededup, packing, quality, sharding, simhash, suffix, toxicity, vectors
from rootline.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.query_paths(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillin.digests(fillin.fill_in_middle(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_packing": op1_packing,
    "op2_licenses": op2_licenses,
    "op3_toxicity": op3_toxicity,
    "op4_fingerprints": op4_fingerprints,
    "op5_simhash": op5_simhash,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_vectors": op8_vectors,
    "op9_sharding": op9_sharding,
    "op10_line_dedup": op10_line_dedup,
    "op11_repair": op11_repair,
    "op12_suffix": op12_suffix,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_TEMPLATES = ", ".join(f"('{n}', '{t}')" for n, t in licenses.TEMPLATES.items())
_MUST = ", ".join(f"('{n}', '{t}', {len(own)})" for n, own in licenses.MUST.items() for t in own)
_SHORT, _LONG = licenses.RUNS
_WORDS = "regexp_extract_all(lower({}), '[a-z0-9][a-z0-9+-]*(?:\\.[0-9]+)?')"

ORACLES: dict[str, str] = {
    "op2_licenses": f"""
WITH f AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN coalesce(regexp_matches(text, '(?i)^[^\\n]*\\blicen[sc]ed?\\b'), FALSE) AND doc_id % 4 = 0 THEN
    CASE WHEN doc_id % 12 = 0 THEN source WHEN doc_id % 12 = 4 THEN source || '/' || lang ELSE source || '/' || lang || '/b' || (doc_id // 100) END || '/LICENSE'
    ELSE source || '/' || lang || '/b' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATES}) v(template, body)),
tt AS (SELECT template, term, count(*) AS tf FROM (SELECT template, unnest({_WORDS.format("body")}) AS term FROM t) GROUP BY 1, 2),
d AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_WORDS.format("text")}) AS term FROM f) WHERE term IN (SELECT term FROM tt) GROUP BY 1),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM f)) / CAST(1 + coalesce(df, 0) AS DOUBLE)) + 1 AS idf FROM (SELECT DISTINCT term FROM tt) LEFT JOIN d USING (term)),
tw AS (SELECT template, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS w FROM tt JOIN idf USING (term)),
m AS (SELECT * FROM (VALUES {_MUST}) v(template, term, needed)),
p AS (SELECT doc_id, unnest(range(len(ls))) AS piece, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM f) UNION ALL SELECT doc_id, -1, text FROM f WHERE contains(text, chr(10))),
pw AS (SELECT doc_id, piece, {_WORDS.format("line")} AS words FROM p),
u AS (SELECT doc_id, piece, {_LONG}00 + s AS start, words[s + 1 : s + {_LONG}] AS words FROM (SELECT *, unnest(range(0, greatest(len(words) - {_LONG // 2}, 1), {_LONG // 2})) AS s FROM pw WHERE len(words) > {_SHORT})
  UNION ALL SELECT doc_id, piece, -s, words[s + 1 : s + {_SHORT}] FROM (SELECT *, unnest(range(0, greatest(len(words) - {_SHORT // 2}, 1), {_SHORT // 2})) AS s FROM pw)
  UNION ALL SELECT f.doc_id, -2, 0, {_WORDS.format("text")} FROM f WHERE path LIKE '%/LICENSE'),
ut AS (SELECT doc_id, piece, start, term, count(*) AS tf FROM (SELECT doc_id, piece, start, unnest(words) AS term FROM u) WHERE term IN (SELECT term FROM tt) GROUP BY 1, 2, 3, 4),
uw AS (SELECT doc_id, piece, start, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, piece, start)) AS w FROM ut JOIN idf USING (term)),
s AS (SELECT doc_id, uw.piece, uw.start, tw.template, round(sum(uw.w * tw.w), 6) AS score, count(m.term) AS own, max(m.needed) AS needed FROM uw JOIN tw USING (term) LEFT JOIN m ON m.template = tw.template AND m.term = uw.term
  GROUP BY doc_id, uw.piece, uw.start, tw.template HAVING count(m.term) = (SELECT max(needed) FROM m x WHERE x.template = tw.template)),
own AS (SELECT doc_id, split_part(template, '/', 1) AS own_license, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) AS rn FROM s WHERE score >= 0.6) WHERE rn = 1),
r AS (SELECT f.doc_id, path, own_license, score, regexp_replace(path, '/?[^/]*$', '') AS folder FROM f LEFT JOIN own USING (doc_id)),
g AS (SELECT folder, own_license FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY score DESC, own_license, path) AS rn FROM r WHERE own_license IS NOT NULL AND path LIKE '%/LICENSE') WHERE rn = 1),
n AS (SELECT r.doc_id, g.own_license AS near, g.folder AS inherited_from, row_number() OVER (PARTITION BY r.doc_id ORDER BY length(g.folder) DESC) AS rn FROM r JOIN g ON r.folder = g.folder OR starts_with(r.folder, g.folder || '/'))
SELECT r.doc_id, path, own_license, score, coalesce(own_license, near) AS license, CASE WHEN own_license IS NULL THEN inherited_from END AS inherited_from FROM r LEFT JOIN n ON r.doc_id = n.doc_id AND n.rn = 1
""",
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_repair": r"""
WITH RECURSIVE bits AS (SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key, row_number() OVER () AS rid FROM conversations),
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, rid,
  xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS h FROM keyed, bits),
damaged AS (SELECT conv_id, turn, rid, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, rid, copy) AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, rid, copy) AS seen FROM damaged),
f AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair FROM placed),
convs AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (
  SELECT conv_id, 0 AS k, {c: CAST(0 AS HUGEINT), a: '', x: CAST([] AS VARCHAR[])} AS v0, {c: CAST(1000000000 AS HUGEINT), a: '', x: CAST([] AS VARCHAR[])} AS v1, {c: CAST(2 AS HUGEINT), a: 'I', x: ['user:']} AS v2, {c: CAST(4 AS HUGEINT), a: 'II', x: ['user:', 'assistant:']} AS v3 FROM convs
  UNION ALL
  SELECT conv_id, k, n0, n1, m2, list_min([n3, {c: m2.c + 2, a: m2.a || 'I', x: m2.x || ['assistant:']}]) FROM (
    SELECT *, list_min([n2, {c: n0.c + 2, a: n0.a || 'I', x: n0.x || ['user:']}, {c: n1.c + 2, a: n1.a || 'I', x: n1.x || ['user:']}, {c: n3.c + 2, a: n3.a || 'I', x: n3.x || ['user:']}]) AS m2 FROM (
      SELECT dp.conv_id, f.k, {c: v0.c + 3, a: v0.a || 'D', x: v0.x} AS n0,
        list_min([{c: v1.c + 3, a: v1.a || 'D', x: v1.x}, {c: v0.c + w + CASE WHEN i = 's' THEN 0 ELSE 1000000000 END, a: v0.a || 'K', x: v0.x || [line]}]) AS n1,
        list_min([{c: v2.c + 3, a: v2.a || 'D', x: v2.x}]
          || list_transform([v0, v1, v3], lambda v: {c: v.c + w + CASE WHEN i = 'u' THEN 0 ELSE 1000000000 END, a: v.a || 'K', x: v.x || [line]})
          || list_transform([v0, v1, v3], lambda v: {c: v.c + w + 2, a: v.a || 'R', x: v.x || ['user:' || text]})) AS n2,
        list_min([{c: v3.c + 3, a: v3.a || 'D', x: v3.x}, {c: v2.c + w + CASE WHEN i = 'a' THEN 0 ELSE 1000000000 END, a: v2.a || 'K', x: v2.x || [line]}, {c: v2.c + w + 2, a: v2.a || 'R', x: v2.x || ['assistant:' || text]}]) AS n3
      FROM dp JOIN (SELECT *, role || ':' || text AS line, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 1 ELSE 1000000000 END AS w FROM f) f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.k = dp.k + 1))),
best AS (SELECT conv_id, list_min([v0, v3]) AS v FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS last FROM dp) WHERE last = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(v.c AS BIGINT) AS cost, v.a AS audit, sha256(array_to_string(v.x, chr(10))) AS repaired_sha256 FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id
""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(hx, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hx, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(hx, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hx, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (SELECT *, substring(t, 1, p) AS a, substring(t, p + 1, q - p) AS b, substring(t, q + 1, n) AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(q - p AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(t) AS restored_sha256 FROM x
""",
}
