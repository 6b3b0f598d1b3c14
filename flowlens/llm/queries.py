"""Registered queries of the subpackage: each operator over its whole table, production parameters."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from flowlens.llm import convrepair, filteraudit, hpylm, langid, mixing, partenum, pii, pstable, quality, subword, suffixdedup, urlrules, warc
from flowlens.llm.common import read_table
from flowlens.plans.registry import register

#: model file of the public tokenizer (a parameter; never copied here)
TOKENIZER = os.environ.get("FLOWLENS_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@register("op1_warc_segments", """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
o AS (SELECT d, min(page_id) AS origin FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN p.n >= 100 AND o.origin <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.n >= 100 AND o.origin <> p.page_id THEN o.origin END AS refers_to, true AS ok
FROM p LEFT JOIN o USING (d)""")
def op1(spark, sf):
    return warc.archive_round_trip(read_table(spark, sf, "pages"))


@register("op2_language_filters")
def op2(spark, sf):
    return langid.identify(read_table(spark, sf, "documents"))


@register("op3_soft_mixing")
def op3(spark, sf):
    return mixing.mixing_rates(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
    ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.r) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id"""


@register("op4_partenum_join", JACCARD_SQL)
def op4(spark, sf):
    return partenum.jaccard_classes(read_table(spark, sf, "documents"), n=3, num=90, den=100)


@register("op5_contextual_pii")
def op5(spark, sf):
    base = F.col("base")
    return pii.find_spans(read_table(spark, sf, "documents")).select(
        "doc_id", *[pii.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(F.col("spans")).alias("spans"))


URL_SQL = r"""
WITH rules(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT h.page_id, h.host, h.path, r.host || r.path AS rule, r.action,
  row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM h LEFT JOIN rules r ON ends_with('.' || h.host, '.' || r.host) AND starts_with(h.path, r.path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1"""


@register("op6_url_ranges", URL_SQL)
def op6(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlrules.match_rules(read_table(spark, sf, "pages"), rules)


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_links, min(reach.r) AS component_id, v.vec_id = min(reach.r) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN reach ON reach.vec_id = v.vec_id GROUP BY v.vec_id"""


@register("op7_pstable_vectors", VECTOR_SQL)
def op7(spark, sf):
    return pstable.near_vectors(read_table(spark, sf, "embeddings"))


@register("op8_quality_rules")
def op8(spark, sf):
    return quality.quality_verdicts(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@register("op9_pitman_yor")
def op9(spark, sf):
    return hpylm.score_documents(read_table(spark, sf, "documents"))


@register("op10_subword_samples")
def op10(spark, sf):
    return subword.sample_segmentations(read_table(spark, sf, "documents"), TOKENIZER)


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
o AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
y AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT d.*, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM d),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(l) < 200 THEN 'A' ELSE '' END
  || CASE WHEN 100 * len(list_distinct(l)) < 50 * len(l) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM w JOIN o USING (t) LEFT JOIN y USING (doc_id)),
c AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS x,
  contains(fails, substr(filter_order, step, 1)) AS bad,
  regexp_matches(substr(filter_order, 1, step - 1), '[' || fails || '_]') AS gone
  FROM c, p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (SELECT part, filter_order, step, x, sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN bad AND gone THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN bad AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
  sum(CASE WHEN bad AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM t"""


REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT r, i, md5(substr(x, 2 * i + 1, 800)) AS h FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 399)) AS i FROM d)),
g AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
q AS (SELECT r, i FROM p JOIN g USING (h)),
b AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM q),
s AS (SELECT r, min(i) AS lo, max(i) + 400 AS hi FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM b) GROUP BY r, run),
k AS (SELECT d.r, d.x, s.lo, s.hi, coalesce(lag(s.hi) OVER (PARTITION BY d.r ORDER BY s.lo), 0) AS before FROM d JOIN s USING (r)),
t AS (SELECT r, any_value(x) AS x, max(hi) AS last, count(*) AS n, sum(hi - lo) AS gone,
  string_agg(substr(x, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head FROM k GROUP BY r)
SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(t.gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(t.n, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN t.r IS NULL THEN d.x ELSE t.head || substr(t.x, 2 * t.last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (r)"""


@register("op11_suffix_dedup", REPEATS_SQL)
def op11(spark, sf):
    return suffixdedup.strip_repeats(read_table(spark, sf, "documents"), keep=False)


@register("op12_filter_audit", AUDIT_SQL)
def op12(spark, sf):
    return filteraudit.audit_filters(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@register("op13_conversation_repair")
def op13(spark, sf):
    return convrepair.repair(convrepair.damage(read_table(spark, sf, "conversations")))


@register("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
