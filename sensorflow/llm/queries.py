"""The registered query of each operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorflow.llm import (
    chunk_reuse, id_planes, near_dedup, permutation_index, piece_codec, quality_mil, secrets, source_divergence, tasks,
    tiling, token_counts, url_filter, value_dictionaries, warc_bundles,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tasks.prepare(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_warc_bundles", """
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, 5 * i::INT + 1, 5))::INT, 1)), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = warc_bundles.archive(spark, tasks.table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = token_counts.count_tokens(tasks.table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op4_id_planes")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return id_planes.stored(spark, tasks.table(spark, folder, "documents"))


@query("op3_near_dedup", """
WITH RECURSIVE words AS (
  SELECT doc_id, string_split_regex(trim(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
    'abcdefghijklmnopqrstuvwxyz     '), ' '), ' +') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words WHERE w <> ['']),
exploded AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM shingled),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM exploded a JOIN exploded b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT a AS doc_id, a AS r FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT d.doc_id, coalesce(len(s), 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
  d.doc_id = coalesce(c, d.doc_id) AS kept
FROM documents d LEFT JOIN shingled USING (doc_id) LEFT JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY 1) USING (doc_id)""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(tasks.table(spark, folder, "documents"))


@query("op8_chunk_reuse")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_reuse.encode_documents(tasks.table(spark, folder, "documents"), digests=True)


@query("op5_quality_mil")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = tasks.table(spark, folder, "documents")
    return quality_mil.scored(docs, quality_mil.train(docs, tasks.table(spark, folder, "labels")))


@query("op6_string_tiling")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(tasks.table(spark, folder, "documents"), tasks.table(spark, folder, "benchmark"))


@query("op7_secret_scan")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(tasks.table(spark, folder, "documents"))


@query("op9_url_filter")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = url_filter.judged(tasks.table(spark, folder, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op10_permutation_index")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.search(tasks.table(spark, folder, "embeddings"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Assign and average, written out for each round."""
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (SELECT p, r AS e, v AS w FROM cut WHERE r < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := d, e := e)) AS n FROM (SELECT r, cut.p, e,
    list_sum(list_transform(list_zip(v, w), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
  FROM cut JOIN book{i} b ON cut.p = b.p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m, w) AS w FROM book{i} b LEFT JOIN (
  SELECT p, e, list(m ORDER BY k) AS m FROM (SELECT p, e, k, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
    FROM (SELECT cut.p, n.e AS e, unnest(v) AS x, unnest(range(len(v))) AS k FROM cut JOIN near{i} USING (r, p)) GROUP BY ALL) GROUP BY p, e) m
  ON b.p = m.p AND b.e = m.e)""")
    return "WITH " + ",".join(steps) + f""",
coded AS (SELECT r, string_agg(printf('%02x', n.e), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


@query("op11_value_dictionaries", _codes_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return value_dictionaries.encode(tasks.table(spark, folder, "embeddings"))


@query("op13_piece_codec")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.encode_documents(tasks.table(spark, folder, "documents"), digests=True)


@query("op12_source_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, term, count(*)::HUGEINT AS c FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(c)::HUGEINT AS c FROM t GROUP BY ALL HAVING count(*) >= 10),
l AS (SELECT lang, count(*) AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT t.lang, t.source, t.term, sum(t.c)::HUGEINT AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c)::HUGEINT AS n FROM g GROUP BY ALL) USING (lang, source) LEFT JOIN (SELECT lang, v FROM l) USING (lang)),
p AS (SELECT lang, source, term, coalesce(g.c, 0) AS c, 1 + 1000000000 * (coalesce(g.c, 0) + 2) // (n + 2 * v) AS p
  FROM gn JOIN kept USING (lang) LEFT JOIN g USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM gn a JOIN gn b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
q AS (SELECT lang, term, 1 + 1000000000 * (c + 2) // (n + 2 * v) AS q FROM kept JOIN l USING (lang)),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM all_pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(tasks.table(spark, folder, "documents"))
