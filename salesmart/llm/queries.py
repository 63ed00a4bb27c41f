"""The text operators as named queries with the parameters of production, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import centroids, chat, exact_dedup, fingerprints, line_rules, mixing, packing, phrases, sharding, simhash, substrings, toxicity, urls
from salesmart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql
        return build

    return add


@query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)""")
def op1(spark, sf):
    return exact_dedup.mark(table(spark, sf, "documents"), hash_all=True)


@query("op2_best_fit_packing")
def op2(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@query("op3_toxicity")
def op3(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))


@query("op4_sharding")
def op4(spark, sf):
    return sharding.shard(table(spark, sf, "documents")).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


@query("op5_simhash_near_dedup")
def op5(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


#: The rules of the query: verdict, host, path.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for _, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
)
_BLOCKED = ", ".join(f"'{h}{p}'" for v, h, p in URL_RULES if v == "block")
_WORDS = "|".join(r.name.strip("^") for r in urls.PATTERNS)


@query("op6_url_filters", rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {_FITS} END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ({_BLOCKED}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(lower(host || path), '(^|[^0-9a-z])({_WORDS})([^0-9a-z]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM r""")
def op6(spark, sf):
    rules = [urls.host_rule(*r) for r in URL_RULES] + list(urls.PATTERNS)
    return urls.judge(table(spark, sf, "pages"), rules)


@query("op7_substring_dedup")
def op7(spark, sf):
    return substrings.spans(table(spark, sf, "documents"), within=True)


@query("op7_substring_dedup_within")
def op7_within(spark, sf):
    return substrings.spans(table(spark, sf, "documents"), within=True)


@query("op8_document_fingerprints")
def op8(spark, sf):
    return fingerprints.fingerprint(table(spark, sf, "documents"))


@query("op9_mixing")
def op9(spark, sf):
    return mixing.taken(table(spark, sf, "documents"))


@query("op10_chat_formatting")
def op10(spark, sf):
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    chats = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_chats(chats))


_LINE = r"array_to_string(regexp_extract_all(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[1-9]', '0', 'g'), '[^\x20\x09-\x0D]+'), ' ')"


@query("op11_quality_rules", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM s),
g AS (SELECT r, i, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
o AS (SELECT r, i, z IS NOT NULL AND count(*) OVER (PARTITION BY r, x, y, z) > 1 AS often FROM g),
v AS (
  SELECT r, often OR coalesce(lag(often) OVER o, false) OR coalesce(lag(often, 2) OVER o, false) AS covered
  FROM o WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, count(*) FILTER (covered) AS n_repeat_words FROM v GROUP BY r),
u AS (SELECT DISTINCT source, t FROM d),
hosts AS (SELECT source, count(*) AS n_docs FROM u GROUP BY source),
lines AS (SELECT source, t, {_LINE} AS l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT source, t, unnest(string_split(t, chr(10))) AS l FROM u)),
seen AS (SELECT source, l, count(DISTINCT t) AS k FROM lines WHERE l <> '' GROUP BY source, l),
gone AS (
  SELECT seen.source, l FROM seen JOIN hosts ON seen.source IS NOT DISTINCT FROM hosts.source WHERE k > 10 AND 100 * k > n_docs),
cut AS (
  SELECT lines.source, t, sum(n) AS n_removed FROM lines JOIN gone ON lines.source IS NOT DISTINCT FROM gone.source AND lines.l = gone.l
  GROUP BY lines.source, t)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(s.t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(s.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
  NOT (len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w)) AND 100 * coalesce(n_removed, 0) <= 50 * len(w) AS kept
FROM s LEFT JOIN c USING (r) LEFT JOIN cut ON s.source IS NOT DISTINCT FROM cut.source AND s.t = cut.t""")
def op11(spark, sf):
    return line_rules.judge(table(spark, sf, "documents"))


def _round(n: int) -> str:
    """Assignment to the centroids of round ``n``, then the centroids of the next."""
    return f"""
d{n} AS (SELECT r, c, sum((v - m) * (v - m)) AS d FROM x JOIN c{n} USING (i) GROUP BY r, c),
a{n} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{n} GROUP BY r),
c{n + 1} AS MATERIALIZED (
  SELECT c, i, coalesce(g, m) AS m FROM c{n}
  LEFT JOIN (SELECT c, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS g FROM x JOIN a{n} USING (r) GROUP BY c, i) USING (c, i))"""


@query("op12_centroid_clustering", f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(CAST(64 AS DOUBLE) * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
x AS MATERIALIZED (SELECT r, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM k),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c FROM k QUALIFY c < 16),
c0 AS MATERIALIZED (SELECT c, i, v AS m FROM x JOIN s USING (r)),{_round(0)},{_round(1)},{_round(2)},{_round(3)},
h AS (SELECT c, sha256(string_agg(CAST(m AS BIGINT), ',' ORDER BY i)) AS h FROM c3 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM k JOIN a3 USING (r) JOIN h USING (c)""")
def op12(spark, sf):
    return centroids.cluster(table(spark, sf, "embeddings"))


@query("op13_phrase_collocations", r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
p AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM s),
w AS (SELECT id, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM p),
g AS MATERIALIZED (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
f1 AS MATERIALIZED (SELECT lang, x, count(*) AS a FROM g GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, x, y, count(*) AS a FROM g WHERE y IS NOT NULL GROUP BY ALL HAVING a >= 10),
f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS a FROM g WHERE z IS NOT NULL GROUP BY ALL HAVING a >= 10),
cut AS (
  SELECT f2.lang, x || ' ' || y AS phrase, f2.a, 1 AS k, p.a AS l, q.a AS r FROM f2 JOIN f1 p USING (lang, x) JOIN f1 q ON q.lang = f2.lang AND q.x = y
  WHERE NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.a >= 50 * f2.a)
    AND NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.a >= 50 * f2.a)
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, f3.a, 1, p.a, q.a FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x
    JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, f3.a, 2, p.a, q.a FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y
    JOIN f1 q ON q.lang = f3.lang AND q.x = f3.z),
scores AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cut),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best JOIN n USING (lang) QUALIFY rank <= 2000""")
def op13(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


@query("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline  # it lies beside the package and imports this subpackage's operators

    return corpus_pipeline.run(spark, sf)
