"""The registered queries of the operators, each over a whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelstats.llm import bpe, collocations, digest, html_text, mtree, packing, quality, runs, shards, simhash, token_files, toxicity, warc
from labelstats.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op1(table(spark, sf_dir, "pages"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.op2(table(spark, sf_dir, "documents"))


def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.op3(table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op4(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op6(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op8(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op9(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.op10(table(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.op11(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.op12(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op13(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_text,
        op2_shards,
        op3_mtree,
        op4_warc,
        op5_toxicity,
        op6_bpe,
        op7_quality,
        op8_simhash,
        op9_packing,
        op10_digest,
        op11_runs,
        op12_collocations,
        op13_token_files,
    )
}

ORACLES = {
    "op3_mtree": """
        WITH v AS (
            SELECT DISTINCT vec_id,
                   [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM s
        )
        WHERE rank <= 5
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT *, strlen(body) AS payload_bytes,
                   min(page_id) OVER (PARTITION BY payload_digest) AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM g
    """,
    "op12_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
        ), g AS (
            SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w
        ), s AS (
            SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
            FROM g, (SELECT unnest(range(1, 6)) AS k)
            WHERE i + k - 1 <= len(words)
        ), f AS (
            SELECT lang, k, phrase, count(*) AS f FROM s GROUP BY ALL HAVING count(*) >= 100
        ), t AS (
            SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang
        ), c AS (
            SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1
        ), kept AS (
            SELECT * FROM c
            WHERE NOT EXISTS (
                SELECT 1 FROM c AS o
                WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.f >= 100 * c.f
                  AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
            )
        ), cut AS (
            SELECT lang, phrase, f AS a, words, k, unnest(range(1, k)) AS left_size FROM kept
        ), scored AS (
            SELECT cut.lang, cut.phrase, a, left_size, l.f AS l, r.f AS r, CAST(n AS BIGINT) AS n,
                   CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
            FROM cut
            JOIN f AS l ON l.lang = cut.lang AND l.phrase = array_to_string(words[1:left_size], ' ')
            JOIN f AS r ON r.lang = cut.lang AND r.phrase = array_to_string(words[left_size + 1:], ' ')
            JOIN t ON t.lang = cut.lang
        ), best AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, left_size) AS place FROM scored
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM best WHERE place = 1
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
