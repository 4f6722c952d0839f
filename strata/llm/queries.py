"""One registered query per operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (
    alignment, anomalies, decontaminate, hmm, language, merkle, mixing, neardup, secrets, sharding, surrogates, toxicity,
    warc,
)
from strata.session import scratch_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One word, as a DuckDB pattern, and the number of words of a text.
SQL_WORD = r"[^\x20\x09-\x0D]+"
SQL_WORDS = f"COALESCE(len(regexp_extract_all(text, '{SQL_WORD}')), 0)"


def register(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: function(tune(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op7_source_mix", f"""
WITH sizes AS (
  SELECT doc_id, source, CAST({SQL_WORDS} AS BIGINT) AS size FROM documents),
named AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * SUM(source_size) OVER () - 2 * COALESCE(SUM(source_size) OVER rising, 0))
            / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER rising, 0)) AS level
  FROM named
  WINDOW rising AS (ORDER BY source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         LEAST(CAST(2 * source_size AS DOUBLE), weight * MAX(level) OVER ()) AS target,
         CAST('0x' || substr(md5('mix:' || COALESCE('=' || source, '')), 1, 5) AS BIGINT)
           / 1048576.0::DOUBLE AS start
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.start,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size,
           COALESCE(((s.doc_id % 4093) + 4093) % 4093, -1), s.doc_id NULLS FIRST) AS k
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(k * rate + start) - floor((k - 1) * rate + start)) * size AS BIGINT) AS taken
FROM placed""")
def op7(spark, sf_dir):
    rows = mixing.copies_per_row(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sql_shingles(table: str, key: str, size: int) -> str:
    """Distinct shingles of a table: ``key, shingle``; shorter texts are one shingle."""
    return f"""
  SELECT DISTINCT {key}, array_to_string(w[i : i + {size} - 1], ' ') AS shingle
  FROM (SELECT {key}, w, unnest(generate_series(1, greatest(len(w) - {size} + 1, 1))) AS i
        FROM (SELECT {key}, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w
              FROM {table}) WHERE len(w) > 0)"""


@register("op3_benchmark_matches", f"""
WITH items AS ({sql_shingles('benchmark', 'item_id', 5)}),
docs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + run - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, run, unnest(generate_series(1, len(w) - run + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w FROM documents),
          (SELECT DISTINCT least(5, len(regexp_extract_all(text, '{SQL_WORD}'))) AS run FROM benchmark)
        WHERE run > 0 AND len(w) >= run)),
sizes AS (SELECT item_id, COUNT(*) AS n_shingles FROM items GROUP BY item_id),
found AS (SELECT doc_id, item_id, COUNT(*) AS n_found FROM docs JOIN items USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM found JOIN sizes USING (item_id) WHERE 100 * n_found >= 80 * n_shingles""")
def op3(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op10_hash_shards", """
WITH hashed AS (
  SELECT doc_id, CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
         COALESCE(strlen(text), 0) AS bytes FROM documents),
buckets AS (
  SELECT bits, h >> (60 - bits) AS prefix, SUM(bytes) AS bytes, COUNT(*) AS n,
         SUM(bytes) <= 1048576 OR MIN(h) = MAX(h) AS fits
  FROM hashed, (SELECT unnest(generate_series(0, 60)) AS bits) GROUP BY ALL),
shards AS (
  SELECT b.* FROM buckets b LEFT JOIN buckets p ON p.bits = b.bits - 1 AND p.prefix = b.prefix >> 1
  WHERE b.fits AND (b.bits = 0 OR NOT p.fits))
SELECT doc_id, CASE WHEN bits = 0 THEN '' ELSE right(lpad(CAST(prefix::BIT AS VARCHAR), 64, '0'), bits::INT) END AS shard,
       CAST(bits AS INT) AS shard_bits, CAST(s.bytes AS BIGINT) AS shard_bytes, n AS shard_rows,
       s.bytes > 1048576 AS oversized
FROM hashed d JOIN shards s ON d.h >> (60 - s.bits) = s.prefix""")
def op10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.with_shards(docs).drop("text")


def _sql_secrets() -> str:
    """The scan in DuckDB: positions from the pieces between matches, then a join in scope."""
    parts, ok = [], {
        "assign": "length(regexp_extract(m, '{p}', 2)) >= 6",
        "key": "length(m) = 40 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')"
               " AND regexp_matches(m, '[0-9]')",
    }
    for kind, (pattern, _) in secrets.KINDS.items():
        p = pattern.replace("'", "''")
        parts.append(f"""
  SELECT rid, {secrets.ORDER[kind]} AS k, '{kind}' AS kind, i, gaps[i] AS gap, found[i] AS m,
         {ok.get(kind, 'true').replace('{p}', p)} AS ok
  FROM (SELECT rid, unnest(generate_series(1, len(found))) AS i, found, gaps, found[i] AS m
        FROM (SELECT rid, regexp_extract_all(text, '{p}') AS found, string_split_regex(text, '{p}') AS gaps
              FROM docs WHERE regexp_matches(text, '{p}')))""")
    beside = " OR ".join(
        f"(w.kind = '{weak}' AND o.kind IN ({', '.join(repr(x) for x in others)}))"
        for weak, others in secrets.COMPLEMENTS.items())
    base = ", ".join(repr(k) for k in secrets.BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS text FROM documents),
pieces AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT *, SUM(length(gap) + length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS stop FROM pieces),
spans AS (
  SELECT rid, k, kind, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
  FROM placed WHERE ok),
reported AS (
  SELECT * FROM spans WHERE kind IN ({base})
  UNION ALL
  SELECT * FROM spans w WHERE EXISTS (
    SELECT 1 FROM spans o WHERE o.rid = w.rid AND ({beside})
      AND o.start <= w.start + {secrets.SCOPE} AND o.stop >= w.start - {secrets.SCOPE})),
lists AS (
  SELECT rid, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access,
         COUNT(*) FILTER (kind = 'hex') AS n_hex, COUNT(*) FILTER (kind NOT IN ({base})) AS n_linked,
         COALESCE(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k)
                  FILTER (kind IN ({base})), '') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
  FROM reported GROUP BY rid)
SELECT doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access,
       COALESCE(n_hex, 0) AS n_hex, sha256(COALESCE(base, '')) AS base_sha256,
       COALESCE(spans, '') AS spans, COALESCE(n_linked, 0) AS n_linked
FROM docs LEFT JOIN lists USING (rid)"""


@register("op4_linked_secrets", _sql_secrets())
def op4(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")


@register("op9_warc_captures", """
WITH payloads AS (
  SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS hex FROM pages),
digests AS (
  SELECT page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (CAST('0x' || substr(hex, CAST(i // 4 AS INT) * 5 + 1, 5) AS INT) >> (15 - 5 * (i % 4))::INT) % 32 + 1, 1)
    FOR i IN range(32)], '') AS payload_digest
  FROM payloads),
firsts AS (SELECT payload_digest, payload_bytes, MIN(page_id) AS first FROM digests GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (payload_digest, payload_bytes)""")
def op9(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.page_index(spark, path)


@register("op5_near_duplicates", f"""
WITH RECURSIVE sets AS MATERIALIZED ({sql_shingles('documents', 'doc_id', 4)}),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * COUNT(*) >= 80 * (ANY_VALUE(x.n) + ANY_VALUE(y.n) - COUNT(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT a AS doc_id, COALESCE(ANY_VALUE(n), 0) AS n_shingles, MIN(b) AS component_id, a = MIN(b) AS kept
FROM reach LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a""")
def op5(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


@register("op6_anomalous_documents")
def op6(spark, sf_dir):
    return anomalies.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "score", "anomalous")


@register("op8_hmm_scores")
def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("held_out", hmm.remainder(F.col("doc_id"), 7) == 2)
    return hmm.scored(docs)


@register("op2_word_languages")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = hmm.remainder(F.col("doc_id"), 3) == 1
    labelled = docs.filter(~held_out & F.col("lang").isNotNull()).select(F.col("lang").alias("label"), "text")
    texts = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.identified(texts, language.fitted(labelled))


@register("op1_surrogates")
def op1(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, key="key of the registered query")


@register("op11_token_alignment")
def op11(spark, sf_dir):
    return alignment.aligned(read(spark, sf_dir, "documents"))


@register("op12_toxicity_scores")
def op12(spark, sf_dir):
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                           lambda doc_id: doc_id.isNotNull() & (hmm.remainder(doc_id, 5) == 0))


def _sql_crc32(value: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bits = f"flatten([[(ascii(c) >> b) & 1 FOR b IN range(8)] FOR c IN string_split({value}, '')])"
    return (f"xor(list_reduce([4294967295::BIGINT] || {bits}, lambda crc, bit: xor(crc >> 1, "
            "CASE WHEN (xor(crc, bit) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)")


def _sql_merkle() -> str:
    """Both trees level by level, then the proofs from the leaves up."""
    fields = {name: name for name in merkle.FIELDS}

    def leaf(fields):
        return "sha256(" + " || ".join(
            f"COALESCE(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')" for x in fields.values()) + ")"

    def levels(name, leaves):
        return f"""
{name} AS (
  SELECT 0 AS level, g, pos, n, digest FROM {leaves}
  UNION ALL
  SELECT level + 1, g, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY level, g, pos // 16, n),
{name}_sides AS MATERIALIZED (
  SELECT level, g, pos, COALESCE(string_agg(digest, '') OVER before, '') AS l,
         COALESCE(string_agg(digest, '') OVER after, '') AS r
  FROM {name} WHERE n > 1
  WINDOW before AS (PARTITION BY level, g, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY level, g, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""

    def climb(name, tree, start):
        return f"""
{name} AS (
  SELECT doc_id, 0 AS level, g, pos, n, proof, folded FROM {start}
  UNION ALL
  SELECT doc_id, {name}.level + 1, g, pos // 16, (n + 15) // 16, proof || l || r, sha256(l || folded || r)
  FROM {name} JOIN {tree}_sides USING (level, g, pos) WHERE n > 1)"""

    return f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, {leaf(fields)} AS digest,
         CASE WHEN {_sql_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {leaf(fields | {"text": f"translate(text, '{UPPER}', '{LOWER}')"})} END AS altered,
         COUNT(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos
  FROM documents),{levels("tree", "docs")},
subroots AS MATERIALIZED (SELECT 0 AS g, g AS pos, COUNT(*) OVER () AS n, digest FROM tree WHERE n = 1),{levels("crown", "subroots")},
low AS (SELECT doc_id, g, pos, n, '' AS proof, COALESCE(altered, digest) AS folded FROM docs),{climb("climbed", "tree", "low")},
high AS (SELECT doc_id, 0 AS g, g AS pos, (SELECT COUNT(*) FROM subroots) AS n, proof, folded FROM climbed WHERE n = 1),{climb("proven", "crown", "high")}
SELECT doc_id, d.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(p.proof) AS proof_sha256,
       p.folded AS folded_root, p.folded = r.digest AS verified
FROM proven p JOIN docs d USING (doc_id) JOIN subroots s ON s.pos = d.g
JOIN crown r ON r.n = 1 WHERE p.n = 1"""


@register("op13_merkle_manifest", _sql_merkle())
def op13(spark, sf_dir):
    changed = F.col("doc_id").isNotNull() & (hmm.remainder(F.col("doc_id"), 5) == 0)
    return merkle.verified(read(spark, sf_dir, "documents"), changed)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
