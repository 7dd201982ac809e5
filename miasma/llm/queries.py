"""One query per text operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.llm import (bpe, decontaminate, fim, html, licenses, lm, periodic, quality, reshard, rules, simhash, topk,
                        warc)
from miasma.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with SQL that gives the same rows if there is any."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    return (quality.classify(docs, weights)
            .select("doc_id", held_out(F.col("doc_id"), quality.FOLD).alias("held_out"), "score", "predicted"))


@query()
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = rules.train(docs, table(spark, sf_dir, "labels"))
    return rules.judge(docs, found).select("doc_id", *rules.BASE, "base_failed", "kept")


@query()
def op7_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def _sql_words(name: str, key: str) -> str:
    """Words of a table, and for each the list that starts with it and has up to 13 words."""
    return rf"""{name}_lists AS (
  SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontaminate.WORD}') AS w
  FROM {name}), {name}_words AS (
  SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS p, len(w) AS n FROM {name}_lists), {name}_runs AS (
  SELECT {key}, p, n, list(word) OVER (PARTITION BY {key} ORDER BY p
    ROWS BETWEEN CURRENT ROW AND {decontaminate.WIDTH - 1} FOLLOWING) AS run FROM {name}_words)"""


@query(f"""WITH {_sql_words("documents", "doc_id")}, {_sql_words("benchmark", "item_id")}, windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, len(run) AS k, array_to_string(run, ' ') AS win
  FROM benchmark_runs WHERE len(run) = least(n, {decontaminate.WIDTH})),
hits AS (
  SELECT doc_id, p, d.k AS k, item
  FROM (SELECT doc_id, p, k, array_to_string(list_slice(run, 1, k), ' ') AS win
    FROM documents_runs, (SELECT DISTINCT k FROM windows) WHERE len(run) >= k) d
  JOIN windows b ON d.k = b.k AND d.win = b.win),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM documents_lists d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op5_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.report(decontaminate.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query()
def op10_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, TOKENIZER, outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


@query(f"""WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.MIN_SHARED_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.MIN_SHARED_BYTES} AND page_id <> first THEN first END AS refers_to FROM q""")
def op1_warc(spark, sf_dir):
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_lm_scoring(spark, sf_dir):
    found = lm.score(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return found.withColumnRenamed("id", "doc_id")


@query()
def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op4_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op6_resharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = reshard.read_layout(docs, reshard.reshard(docs, shards=8, old_shards=6))
    return placed.select("doc_id", reshard.row_size(F.col("text")).alias("size"),
                         F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                         F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5""")
def op11_topk_search(spark, sf_dir):
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    index = topk.build_index(vectors)
    return topk.search(index, vectors.filter(F.col("id") % 50 == 0), k=5)


@query()
def op12_periodic_runs(spark, sf_dir):
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic.find(table(spark, sf_dir, "documents"), repeat_by=key)
    best = periodic.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
                        best["length"].alias("length"), best["period"].alias("period"),
                        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_TEXT13 = "coalesce(text, '')"


@query(f"""WITH u AS (SELECT doc_id, {_TEXT13} AS text, regexp_extract_all({_TEXT13}, '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || doc_id) AS h FROM documents),
d AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p""")
def op13_fill_in_middle(spark, sf_dir):
    rows = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
