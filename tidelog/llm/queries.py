"""Registered queries of this subpackage, over the whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import (
    bpe,
    byte_bpe,
    decontaminate,
    exact_dedup,
    filter_audit,
    periodic_runs,
    pii,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
)
from tidelog.llm.common import documents

#: Folder of the vocabulary files on every machine.
VOCABULARIES = "/opt/tokenizers"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, labels(spark, sf_dir)))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir)))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), f"{VOCABULARIES}/word_bpe_49k.json", keep_text=False)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), keep_text=False)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(documents(spark, sf_dir), f"{VOCABULARIES}/byte_bpe_50k.json")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find(documents(spark, sf_dir), prepare=periodic_runs.planted_words, keep_text=False)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(documents(spark, sf_dir), f"{VOCABULARIES}/byte_bpe_multi_50k.tiktoken", keep_text=False)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", labels(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_simhash,
        op3_exact_dedup,
        op4_secrets,
        op5_decontamination,
        op6_toxicity,
        op7_bpe,
        op8_suffix_dedup,
        op9_token_files,
        op10_pii,
        op11_periodic_runs,
        op12_byte_bpe,
        op13_filter_audit,
    )
}

ORACLE = {
    "op3_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.norm) AS text_sha256
        FROM n JOIN g ON n.norm = g.norm
    """,
    "op5_decontamination": r"""
        WITH docs AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
        ), wins AS (
            SELECT DISTINCT item_id, w[i : i + 9] AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT len(win) AS n FROM wins
        ), places AS (
            SELECT r, n, i, w[i : i + n - 1] AS win
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
        ), found AS (SELECT r, n, i, item_id FROM places JOIN wins ON places.win = wins.win
        ), hit AS (
            SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit ON docs.r = hit.r LEFT JOIN named ON docs.r = named.r
    """,
    "op8_suffix_dedup": r"""
        WITH docs AS (
            SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), starts AS (
            SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s
            FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs WHERE length(h) >= 100)
        ), repeated AS (
            SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS first FROM starts) WHERE first < doc_id
        ), runs AS (
            SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM (
                SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM repeated)
        ), spans AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, run
        ), pieces AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM spans
        ), cut AS (
            SELECT d.r, sum(b - a) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(max(h), 2 * max(b) + 1) AS kept
            FROM pieces JOIN docs d ON pieces.r = d.r GROUP BY d.r
        )
        SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM docs LEFT JOIN cut ON docs.r = cut.r
    """,
    "op13_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, coalesce(doc_id, 9223372036854775807) AS place FROM d
        ), marks AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), masks AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
                + 8 * regexp_matches(t, '[#$%&*|]')::INT
                + 16 * (min(place) OVER (PARTITION BY t) < place)::INT AS mask
            FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps AS (
            SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before
            FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
        ), counted AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
            FROM masks GROUP BY part, mask
        ), each AS (
            SELECT part, filter_order, step, own,
                coalesce(sum(n) FILTER (mask & (before + own) = 0), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                coalesce(sum(n_good) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS good_lost,
                coalesce(sum(n_toxic) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS toxic_lost
            FROM counted, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM each
    """,
}
