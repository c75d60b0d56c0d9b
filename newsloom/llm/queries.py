"""Registered queries of the training-data operators and the SQL that some have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontaminate, fingerprints, jaccard, lexical, line_dedup, lm, negatives, packing, quality, sharding, substring_dedup, vectors, warc
from newsloom.scratch import materialize, scratch_path

#: Vocabulary file of the registered queries that need tokens.
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS1 = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


@query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS1} AS ws FROM documents),
w AS (
  SELECT doc_id, a, array_to_string(ws[a + 1:a + 20], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(len(ws) - 19)) AS a FROM d WHERE len(ws) >= 20)),
f AS (SELECT k, min((doc_id, a)) AS p FROM w GROUP BY k),
g AS (
  SELECT DISTINCT doc_id, unnest(range(a, a + 20)) AS i
  FROM w JOIN f USING (k) WHERE (doc_id, a) > p),
gone AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(ws) AS n, coalesce(len(gone), 0) AS m,
         list_filter(ws, lambda x, i: gone IS NULL OR NOT list_contains(gone, i - 1)) AS kept
  FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, m::BIGINT AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept"""
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = substring_dedup.repeated_passages(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    """
WITH every AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM documents),
l AS (SELECT doc_id, line_no, line, regexp_extract_all(line, '[^\\x20\\x09\\x0B-\\x0D]+') AS ws FROM every),
f AS (
  SELECT array_to_string(ws, ' ') AS t, any_value(ws) AS ws, len(any_value(ws)) AS n,
         min((doc_id, line_no)) AS place
  FROM l WHERE len(ws) > 0 GROUP BY 1),
v AS (
  SELECT array_to_string(list_concat(ws[1:i], ws[i + 2:n]), ' ') AS k, i, n, t, place
  FROM (SELECT *, unnest(range(n)) AS i FROM f WHERE n >= 5)),
replaced AS (SELECT k, i, n, min(place) AS p FROM v GROUP BY k, i, n),
gone AS (
  SELECT t FROM v JOIN replaced USING (k, i, n) WHERE p < place
  UNION SELECT v.t FROM v JOIN f ON v.k = f.t AND v.n = f.n + 1 WHERE f.n >= 5 AND f.place < v.place
  UNION SELECT f.t FROM v JOIN f ON v.k = f.t AND v.n = f.n + 1 WHERE f.n >= 5 AND v.place < f.place),
kept AS (SELECT t, place FROM f WHERE t NOT IN (SELECT t FROM gone)),
marked AS (
  SELECT doc_id, line_no, line, len(ws) > 0 AND place IS NULL AS removed
  FROM l LEFT JOIN kept ON array_to_string(ws, ' ') = t AND place = (doc_id, line_no))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (removed)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    lines = F.size(F.split(F.coalesce("before", F.lit("")), "\n")).cast("long")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        lines.alias("n_lines"),
        F.col("lines_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).drop("key")


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = materialize(quality.statistics_table(table(spark, sf_dir, "documents")), "quality")
    model = quality.learn(statistics, table(spark, sf_dir, "labels"))
    return quality.score_documents(statistics, model)


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


_WORDS6 = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_LOWER6 = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS6.format(_LOWER6)} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS6.format(_LOWER6)} AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[a + 1:a + 10], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 10, 0) + 1)) AS a FROM i WHERE len(ws) > 0)),
g AS (
  SELECT doc_id, a, n, array_to_string(ws[a + 1:a + n], ' ') AS phrase
  FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS a
        FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)),
m AS (SELECT doc_id, a, n, item_id FROM g JOIN w USING (phrase, n)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM m) GROUP BY doc_id),
found AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_base32(payload: str) -> str:
    part = f"('0x' || substr(sha1({payload}), k * 5 + 1, 5))::BIGINT"
    letter = f"substr('{warc.BASE32}', ((({part}) >> s) & 31)::INTEGER + 1, 1)"
    return (
        f"array_to_string(list_transform(range(8), lambda k: "
        f"array_to_string(list_transform([15, 10, 5, 0], lambda s: {letter}), '')), '')"
    )


@query(
    f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
firsts AS (SELECT x, min(page_id) AS f FROM p GROUP BY x)
SELECT p.page_id, strlen(p.x)::BIGINT AS payload_bytes, {_sql_base32('p.x')} AS payload_digest,
       CASE WHEN p.page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f THEN f END AS refers_to
FROM p JOIN firsts USING (x)"""
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), path)
    return warc.archived_pages(spark, path)


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.learn(docs))


@query()
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.similar_vectors(table(spark, sf_dir, "embeddings"))


_WORDS11 = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS11.format(_LOWER6)} AS ws FROM documents),
c AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (SELECT DISTINCT item_id, unnest({_WORDS11.format(_LOWER6)}) AS term FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(
    floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN t USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@query(
    """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.shifted_labels(table(spark, sf_dir, "embeddings")))
