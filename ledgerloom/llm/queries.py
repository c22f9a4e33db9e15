"""The registered queries of the training-data operators and, where SQL can say it, what checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format, ns_clusters, pii_votes, quality_forest, ring_shards, secret_scan, simhash_trie, source_mix, suffix_dedup, token_align, token_prefix, url_model, winnowing
from ledgerloom.llm.common import table
from ledgerloom.plans.registry import Registry

R = Registry()

#: Words, as DuckDB's regular expressions write them.
_WORD = r"[^\x20\x09-\x0D]+"


@R.query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@R.query("op2_url_filters")
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.filter_urls(table(spark, sf_dir, "pages"))


def _duck_escape(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for s in chat_format.CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}' || chr(92) || '{s[1:]}')"
    return out


@R.query("op3_chat_formatting", f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_duck_escape("role")}) + length({_duck_escape("text")}) + {len(chat_format.BEGIN + chat_format.MIDDLE + chat_format.END)}) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id""")
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{tricky}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{tricky}'")
    back = chat_format.read_back(chat_format.format_conversations(given.unionByName(added)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


@R.query("op4_secret_scans")
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


@R.query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_forest.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_forest.COUNTS, "base_failed", "kept")


@R.query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, ["doc_id"])


@R.query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


@R.query("op8_source_mixing", rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sized GROUP BY source),
places AS (
  SELECT *, 2 * source_size AS cap,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(2 * source_size) OVER o, 0) AS caps_before, coalesce(sum(weight) OVER o, 0) AS weights_before
  FROM sums WINDOW o AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (total::DOUBLE * 1.5::DOUBLE - caps_before::DOUBLE) / (weights - weights_before)::DOUBLE AS level FROM places),
shared AS (SELECT (min(struct_pack(b := weights_before, l := level)) FILTER (level * weight < cap)).l AS level FROM levels),
targets AS (SELECT l.source, l.source_size, CASE WHEN s.level IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, s.level * l.weight) END AS target FROM levels l, shared s),
rated AS (
  SELECT d.doc_id, d.size::BIGINT AS size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken FROM rated""")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@R.query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_votes.find_personal_data(table(spark, sf_dir, "documents"))


@R.query("op10_benchmark_decontamination", r"""
WITH item_words AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, 13 AS n, array_to_string(w[i : i + 12], ' ') AS win FROM item_words, unnest(generate_series(1, len(w) - 12)) AS g(i) WHERE len(w) >= 13
  UNION SELECT item, len(w), array_to_string(w, ' ') FROM item_words WHERE len(w) BETWEEN 1 AND 12),
doc_words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
hits AS (
  SELECT DISTINCT d.r, i, x.n, x.item FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n) d
  JOIN windows x ON x.n = d.n AND x.win = array_to_string(d.w[d.i : d.i + d.n - 1], ' ')),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@R.query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.token_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@R.query("op12_ring_shards")
def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards.law_of_bytes(table(spark, sf_dir, "documents"))


def _duck_clusters(rounds: int = ns_clusters.ROUNDS, clusters: int = ns_clusters.CLUSTERS) -> str:
    """Plain k-means, one pair of common tables a round: every vector against every centroid."""
    distance = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INT AS cluster, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, v) <= {clusters})"""]
    for t in range(rounds + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, arg_min(cluster, d * {clusters} + cluster) AS cluster, min(d) AS distance
  FROM (SELECT x.r, c.cluster, {distance}::HUGEINT AS d FROM kept x, c{t} c) GROUP BY r)""")
        if t < rounds:
            parts.append(f"""
m{t} AS MATERIALIZED (
  SELECT cluster, list(fl ORDER BY i) AS v FROM (
    SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS fl
    FROM (SELECT a.cluster, u.i, sum(x.v[u.i]) AS s, count(*) AS n FROM a{t} a JOIN kept x USING (r), (SELECT unnest(generate_series(1, 64)) AS i) u GROUP BY 1, 2)) GROUP BY cluster),
c{t + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m USING (cluster))""")
    return ",".join(parts) + f"""
SELECT x.vec_id, a.cluster, a.distance::BIGINT AS distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept x USING (r) JOIN c{rounds} c USING (cluster)"""


@R.query("op13_centroid_clustering", _duck_clusters())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_clusters.clustered(table(spark, sf_dir, "embeddings"))
