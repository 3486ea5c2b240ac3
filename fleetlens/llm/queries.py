"""The numbered queries with their production parameters, and SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    balanced_shards,
    decontamination,
    fill_in_middle,
    language_cnn,
    license_scan,
    masked_lm,
    pii_surrogates,
    quality_ratio,
    simhash_dedup,
    source_mix,
    url_automaton,
    warc_zstd,
    whitening,
)
from fleetlens.llm.shared import table, text_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        @functools.wraps(run)
        def with_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
            text_batches(spark)
            return run(spark, sf_dir)

        QUERIES[name] = with_batches
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


@query("op1_masked_lm_scores")
def masked_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed conditional log-probability of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return masked_lm.score_documents(docs).select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


@query("op2_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain which benchmark items."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.rarity(docs))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op4_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_source_mix")
def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = source_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: A deployment passes a key of its own; with this one anybody can draw the same surrogates.
DEMO_KEY = b"replace me with a key from a vault"


@query("op6_pii_surrogates")
def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii_surrogates.replace_entities(docs, DEMO_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",")
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), kinds.alias("kinds"))


URL_SQL = """
WITH parts AS (
  SELECT page_id,
         coalesce(nullif(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), NULL), '') AS raw_host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
hosts AS (
  SELECT page_id, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts),
fitted AS (
  SELECT page_id, host, path,
         CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM hosts)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
                 WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block'
       ELSE CASE WHEN regexp_matches(host, 'casino|poker|porn|phish|malware')
                   OR regexp_matches('.' || host || '.', '[.-](bets|betting|pills|adult|spam|ads|tracker)[.-]')
                   OR contains(path, '/ads/')
                   OR ends_with(path, '.exe') OR ends_with(path, '.apk')
                 THEN 'block' ELSE 'allow' END END AS verdict
FROM fitted
"""


@query("op7_url_automaton", URL_SQL)
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    judged = url_automaton.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads),
typed AS (
  SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM firsts)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM typed
"""


@query("op8_warc_zstd", WARC_SQL)
def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back; a record that fails its checks ends the query."""
    read = warc_zstd.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("record_type"))
    return read.select("page_id", "payload_bytes", "payload_digest", checked.alias("record_type"), "refers_to")


@query("op9_language_cnn")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = language_cnn.held_out(F.col("doc_id"))
    net = language_cnn.train(docs.where(~out).select("text", "lang"))
    judged = language_cnn.identify(docs.select("doc_id", "text", out.alias("held_out")), net)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


@query("op10_quality_ratio")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the log-likelihood ratio of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_ratio.trusted_texts(docs, table(spark, sf_dir, "labels"))
    target = quality_ratio.ngram_counts(trusted, 4, quality_ratio.BUCKETS)
    raw = quality_ratio.ngram_counts(docs, 4, quality_ratio.BUCKETS)
    return quality_ratio.judge(docs, quality_ratio.log_ratio(target, raw))


@query("op11_balanced_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document; equal texts stay together."""
    return balanced_shards.shard_documents(table(spark, sf_dir, "documents"))


@query("op12_fill_in_middle")
def fill_in_middle_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output and of the text restored from it."""
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading whitened components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
