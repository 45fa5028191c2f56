"""Registered queries of this package, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wardflow.llm import (
    bpe,
    conversations,
    decontaminate,
    divergence,
    jaccard,
    language,
    licenses,
    quality,
    secrets,
    simhash,
    token_files,
    topk_search,
    toxicity,
)
from wardflow.llm.batches import ready, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(ready(spark), sf_dir)
    return fn


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op2_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op4_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op5_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ["language", F.round("probability", 6).alias("probability"), "kept"]
    docs = language.identify(table(spark, sf_dir, "documents"))
    pages = language.identify_pages(table(spark, sf_dir, "pages"))
    return docs.select("doc.doc_id", F.lit(None).cast("long").alias("page_id"), *found).unionByName(
        pages.select(F.lit(None).cast("long").alias("doc_id"), "doc.page_id", *found)
    )


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", topk_search.quantised(F.col("embedding")).alias("vector")
    )
    return topk_search.search(vectors, F.col("vec_id") % 20 == 0, 20, vector="vector")


@query
def op10_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(table(spark, sf_dir, "conversations"))


@query
def op12_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


# Words of a text: A-Z lowered, runs of digits, a-z and everything outside ASCII.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "list_filter(string_split_regex(coalesce(" + _LOWER + ", ''), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

ORACLE_SQL["op5_benchmark_hits"] = f"""
WITH d AS (
  SELECT doc_id, {_WORDS.format("text")} AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), spans AS (
  SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k
  FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS line FROM spans
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
  FROM d, sizes WHERE len(w) >= n
), found AS (
  SELECT p.doc_id, p.k, p.n, windows.item
  FROM (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS line FROM places) p
  JOIN windows ON p.line = windows.line AND p.n = windows.n
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         array_to_string(list_sort(list(DISTINCT item)), ',') AS named
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

ORACLE_SQL["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
) WHERE rank <= 20
"""

# The checksum is spelled out byte by byte; the repair keeps, row by row, the best edits that lead to
# each state of the grammar, with up to two inserted turns ahead of a row.
ORACLE_SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''),
           lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])),
           4294967295) % 20 AS kind
  FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         left(role, 1) AS r
  FROM damaged
), marked AS (
  SELECT *, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?')
      THEN 'truncated' ELSE '' END AS fault,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS step
  FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), inserts(s, pre, lines, mid) AS (
  VALUES (0, '', CAST([] AS VARCHAR[]), 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
         (1, '', [], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
         (2, '', [], 2), (2, 'I', ['assistant:'], 3), (3, '', [], 3), (3, 'I', ['user:'], 2)
), keeps(mid, r, t) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), renames(mid, role, t) AS (
  VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)
), edits AS (
  SELECT conv_id, i, s, t, pre || letter AS edits, 3 * length(pre) + cost AS cost,
         list_concat(lines, said) AS said
  FROM (
    SELECT conv_id, i, mid AS from_mid, mid AS t, 'D' AS letter, 4 AS cost, CAST([] AS VARCHAR[]) AS said
    FROM marked, renames
    UNION ALL
    SELECT conv_id, i, k.mid, k.t, 'K', CASE WHEN fault = '' THEN 0 ELSE 3 END, [role || ':' || text]
    FROM marked JOIN keeps k USING (r) WHERE fault IN ('', 'truncated')
    UNION ALL
    SELECT conv_id, i, n.mid, n.t, 'R', CASE WHEN fault = '' THEN 3 ELSE 6 END, [n.role || ':' || text]
    FROM marked, renames n WHERE fault IN ('', 'truncated')
  ) JOIN inserts ON mid = from_mid
), path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS edits, CAST([] AS VARCHAR[]) AS said FROM counts
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.t, min(p.cost + e.cost),
         arg_min(p.edits || e.edits, {'c': p.cost + e.cost, 'e': p.edits || e.edits}),
         arg_min(list_concat(p.said, e.said), {'c': p.cost + e.cost, 'e': p.edits || e.edits})
  FROM path p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.s = p.s
  GROUP BY p.conv_id, p.i, e.t
), ended AS (
  SELECT p.conv_id, p.cost + 3 * length(pre) AS cost, p.edits || pre AS audit, list_concat(p.said, lines) AS said
  FROM path p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
  JOIN inserts ON inserts.s = p.s AND mid IN (0, 3)
), best AS (
  SELECT conv_id, min(cost) AS cost, arg_min(audit, {'c': cost, 'e': audit}) AS audit,
         arg_min(said, {'c': cost, 'e': audit}) AS said
  FROM ended GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE_SQL["op12_jaccard_classes"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce({_LOWER.format("text")}, ''), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * overlap >= 80 * (x.n + y.n - overlap)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLE_SQL["op13_source_divergence"] = f"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         list_filter(string_split_regex(coalesce({_LOWER.format("text")}, ''),
                     '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), words AS (
  SELECT lang, source, doc, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS in_lang FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), sources AS (
  SELECT DISTINCT lang, source FROM d
), cells AS (
  SELECT s.lang, s.source, k.term, k.in_lang, count(w.term) AS n
  FROM sources s JOIN kept k ON k.lang = s.lang
  LEFT JOIN words w ON w.lang = s.lang AND w.source = s.source AND w.term = k.term
  GROUP BY ALL
), sized AS (
  SELECT *, CAST(sum(n) OVER g + 5 * count(*) OVER g AS HUGEINT) AS whole,
         CAST(sum(in_lang) OVER g + 5 * count(*) OVER g AS HUGEINT) AS lang_whole
  FROM cells WINDOW g AS (PARTITION BY lang, source)
), shares AS (
  SELECT lang, source, term, n,
         CAST(1 + 1000000000 * CAST(n + 5 AS HUGEINT) // whole AS BIGINT) AS p,
         CAST(1 + 1000000000 * CAST(in_lang + 5 AS HUGEINT) // lang_whole AS BIGINT) AS q
  FROM sized
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""
