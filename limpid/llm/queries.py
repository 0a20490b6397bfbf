"""The operators of this package as queries over the test tables: name -> callable, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    """Registers a function (spark, sf_dir) under its own name."""
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rank_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), *rank_file())


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def learned_from(docs: DataFrame) -> DataFrame:
    """The rows that models learn from: crc32 of doc_id as text leaves another remainder than 2 when divided by 4."""
    from pyspark.sql import functions as F

    return docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from limpid.llm.language import identify, train

    docs = table(spark, sf_dir, "documents")
    model = train(learned_from(docs).select("doc_id", "text", "lang"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_char", "rejected"
    )


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


@query
def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.merkle import edited_neighbours

    return edited_neighbours(table(spark, sf_dir, "documents"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.licenses import licenses

    return licenses(table(spark, sf_dir, "documents"))


@query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learned_from)


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from limpid.llm.token_files import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


SHARDS = 16


@query
def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from limpid.llm.sharding import manifest

    found = manifest(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0])
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: The checksum is made byte by byte from a table of 256 remainders, which the first two steps derive from its polynomial.
SQL["op12_shards"] = f"""
WITH remainders AS (
  SELECT list(c ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM range(256) r(i))
), plain AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[1 + xor(c & 255, b)]))) AS text_crc32
  FROM documents, remainders
), records AS (
  SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // 262144 AS piece FROM plain
), draws AS (
  SELECT doc_id, s, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS cost
  FROM (SELECT DISTINCT doc_id FROM documents), range({SHARDS + 1}) n(s)
), best AS (
  SELECT doc_id, (arg_min(s, (cost, s)) FILTER (s < {SHARDS}))::INT AS shard, arg_min(s, (cost, s))::INT AS grown_shard FROM draws GROUP BY doc_id
)
SELECT r.doc_id, r.size, r.text_crc32, 'key' AS law, b.shard,
  row_number() OVER (PARTITION BY b.shard
    ORDER BY md5(concat_ws(':', coalesce(r.doc_id::VARCHAR, ''), r.size, r.text_crc32, r.piece)), r.doc_id NULLS FIRST, r.size, r.text_crc32, r.piece) - 1 AS slot,
  b.grown_shard
FROM records r JOIN best b ON r.doc_id IS NOT DISTINCT FROM b.doc_id
"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


SQL["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), found AS (
  SELECT id, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY lang
), sizes AS (
  SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.size, 0) + l.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // (l.size + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), rows_of AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM cells WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM rows_of
QUALIFY part = 'pair' OR rank <= 200
"""


CLUSTERS, CLUSTER_ROUNDS = 8, 10


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from limpid.llm.centroids import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"), k=CLUSTERS, rounds=CLUSTER_ROUNDS, dims=64, scale=1024, seed=3)


def _centroid_sql() -> str:
    """Each round as two steps over (vector, dimension) cells."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, c, dist FROM (
    SELECT x.r, m.c, sum((x.x - m.x) * (x.x - m.x)) AS dist FROM cells x JOIN c{i} m USING (d) GROUP BY x.r, m.c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT m.c, m.d, CASE WHEN t.n IS NULL THEN m.x ELSE ((t.s - ((t.s % t.n) + t.n) % t.n) // t.n)::BIGINT END AS x
  FROM c{i} m LEFT JOIN (SELECT a.c, x.d, sum(x.x) AS s, count(*) AS n FROM a{i} a JOIN cells x USING (r) GROUP BY a.c, x.d) t
    ON m.c = t.c AND m.d = t.d)"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(CLUSTER_ROUNDS))
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x::DOUBLE), false))) = 64
), cells AS MATERIALIZED (
  SELECT r, d, v[d] AS x FROM whole, range(1, 65) n(d)
), c0 AS MATERIALIZED (
  SELECT c, d, v[d] AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM whole QUALIFY c < {CLUSTERS}), range(1, 65) n(d)
),
{steps},
{assigned(CLUSTER_ROUNDS)},
named AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{CLUSTER_ROUNDS} GROUP BY c
)
SELECT w.vec_id, a.c::INT AS cluster, a.dist::BIGINT AS distance,
  (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia, n.centroid_sha256
FROM a{CLUSTER_ROUNDS} a JOIN whole w USING (r) JOIN named n USING (c)
"""


SQL["op11_centroids"] = _centroid_sql()
