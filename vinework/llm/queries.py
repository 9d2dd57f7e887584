"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinework.llm import centroids, ctw, decontaminate, langid, licences, minhash, mixing, pages, simhash, spann, substrings, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(divisor: int):
    """Residue of a document's checksum, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    digits = F.lower(F.lpad(F.hex("_sh_fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("_sh_id").alias("component_id"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_dc_words").alias("n_words"),
        F.col("_dc_hit").alias("n_hit"),
        F.size("_dc_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "_dc_items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(F.coalesce(_remainder(4), F.lit(0)) != 2).select("text", "lang"))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    found = langid.identify(docs.select("doc_id", held_out, "text"), model)
    return found.select("doc_id", "held_out", F.col("_li_lang").alias("lang_pred"), F.col("_li_score").alias("score"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.shares(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP4_SQL = """
WITH sized AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    coalesce('s' || source, 'n') AS key, source,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || text, '')), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT key, source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY key, source
), weighed AS (
  SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS weight FROM sources
), filled AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, place) AS nth,
    coalesce(sum(3 * source_size) OVER before, 0) AS full_size, coalesce(sum(weight) OVER before, 0) AS full_weight,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight
  FROM weighed
  WINDOW before AS (ORDER BY 3 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((total - full_size)::DOUBLE / (all_weight - full_weight)::DOUBLE, nth)
    FILTER ((total - full_size)::DOUBLE / (all_weight - full_weight)::DOUBLE * weight <= 3 * source_size) AS level FROM filled
), targets AS (
  SELECT key, source_size, least(level * weight, (3 * source_size)::DOUBLE) AS target FROM weighed, level
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM targets
), places AS (
  SELECT key, place, sum(size)::BIGINT AS words FROM sized GROUP BY key, place
), upto AS (
  SELECT *, sum(words) OVER (PARTITION BY key ORDER BY place) AS upto FROM places
), once AS (
  SELECT key, place, words, upto <= target - whole * source_size AS more,
    max(CASE WHEN upto <= target - whole * source_size THEN upto ELSE 0 END) OVER (PARTITION BY key) AS got,
    target - whole * source_size AS budget
  FROM upto JOIN rests USING (key)
), extra AS (
  SELECT key, arg_min(place, (abs(words - (budget - got)), place)) AS extra
  FROM once WHERE NOT more AND abs(words - (budget - got)) < budget - got GROUP BY key
)
SELECT doc_id, size, source_size, target, (size * (whole + (more OR coalesce(place = extra, FALSE))::INT))::BIGINT AS taken
FROM sized JOIN rests USING (key) JOIN once USING (key, place) LEFT JOIN extra USING (key)
"""


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.find_repeats(docs)
    return found.select(
        "doc_id",
        F.col("_sd_words").alias("n_words"),
        F.col("_sd_removed").alias("n_removed"),
        F.col("_sd_sha256").alias("kept_sha256"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``; those without a source or language lie in no known directory."""
    docs = _table(spark, sf_dir, "documents")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    path = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), name).alias("path")
    found = licences.scan(docs.select("doc_id", path, "text"))
    return found.select(
        "doc_id",
        F.col("_lc_licence").alias("licence"),
        F.col("_lc_score").alias("score"),
        F.col("_lc_origin").alias("origin"),
        F.col("_lc_from").alias("inherited_from"),
        F.size("_lc_hits").alias("n_hits"),
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    n_chars = F.char_length("_mt_text").cast("bigint").alias("n_chars")
    return found.select("page_id", "url", F.col("_mt_text").alias("text"), n_chars, F.col("_mt_gone").alias("n_differenced"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    # Labels grow with the documents, so they are never sent to all tasks.
    lexicon = toxicity.learn(docs.filter(~held_out).join(labels.hint("merge"), "doc_id"))
    found = toxicity.toxicity(docs.select("doc_id", held_out.alias("held_out"), "text"), lexicon)
    score = F.col("_tx_score").alias("score")
    return found.select("doc_id", "held_out", score, (F.col("_tx_score") >= 0.5).cast("int").alias("predicted"))


def op9_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = spann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_remainder(10) == 0, F.lit(False))
    docs = _table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    found = ctw.score(docs, ~F.col("held_out"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("_lm_tokens").alias("n_tokens"),
        F.col("_lm_known").alias("n_known"),
        F.col("_lm_train_tokens").alias("train_tokens"),
        F.col("_lm_base").alias("base_score"),
        F.col("_lm_score").alias("score"),
        F.col("_lm_bits").alias("bits_per_byte"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        "vec_id",
        F.col("_ce_cluster").alias("cluster"),
        F.col("_ce_distance").alias("distance"),
        F.col("_ce_cluster_inertia").alias("cluster_inertia"),
        F.col("_ce_inertia").alias("inertia"),
        centroids.digest().alias("centroid_sha256"),
    )


def _op11_sql(k: int, rounds: int, width: int, scale: int) -> str:
    """The rounds one after the other, over one row per vector and component."""
    floor = "(sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*)"
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {width}
), x AS (
  SELECT r, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM kept
), first AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, x) - 1 AS j, x FROM kept QUALIFY j < {k}
), c0 AS (
  SELECT j, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM first
)"""]  # fmt: skip
    for t in range(rounds + 1):
        steps.append(f""", d{t} AS MATERIALIZED (
  SELECT r, j, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN c{t} c USING (i) GROUP BY r, j
), a{t} AS MATERIALIZED (
  SELECT r, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{t} GROUP BY r
)""")
        if t < rounds:
            steps.append(f""", m{t} AS (
  SELECT a.j, x.i, ({floor})::BIGINT AS v FROM a{t} a JOIN x USING (r) GROUP BY a.j, x.i
), c{t + 1} AS MATERIALIZED (
  SELECT j, i, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m USING (j, i)
)""")
    steps.append(f""", sums AS (
  SELECT j, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY j
), digests AS (
  SELECT j, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j
)
SELECT vec_id, a.j::INT AS cluster, a.d AS distance, cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} a USING (r) JOIN sums USING (j) JOIN digests USING (j)
""")
    return "".join(steps)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.col("doc_id").eqNullSafe(F.col("_mh_id")).alias("kept")
    return found.select("doc_id", F.col("_mh_size").alias("n_shingles"), F.col("_mh_id").alias("component_id"), kept)


OP12_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * c >= 85 * (an + bn - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.learn(vectors))
    return found.select(
        "vec_id",
        F.col("_wh_component").alias("component"),
        F.col("_wh_n").alias("n"),
        # Null where the exact value passes 64 bits; the operator's own column has 38 digits.
        F.col("_wh_deviation").try_cast("bigint").alias("deviation"),
        F.col("_wh_value").alias("whitened"),
        F.col("_wh_explained").alias("explained"),
        F.col("_wh_identity_error").alias("identity_error"),
    )


QUERIES.update({f.__name__: f for f in (
    op1_simhash,
    op2_decontamination,
    op3_language_id,
    op4_source_mixing,
    op5_substring_dedup,
    op6_license_scan,
    op7_html_extraction,
    op8_toxicity,
    op9_ann_search,
    op10_lm_scoring,
    op11_centroid_clustering,
    op12_minhash,
    op13_whitening,
)})
ORACLES["op4_source_mixing"] = OP4_SQL
ORACLES["op11_centroid_clustering"] = _op11_sql(centroids.CLUSTERS, centroids.ROUNDS, centroids.WIDTH, centroids.SCALE)
ORACLES["op12_minhash"] = OP12_SQL
