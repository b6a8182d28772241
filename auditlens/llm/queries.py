"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm import alignment, bpe, collocations, decontaminate, language, licenses, mixing, pii, quality, sharding, simhash, suffixes, tokens
from auditlens.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_languages(read_table(spark, sf_dir, "documents"))


def op2_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read_table(spark, sf_dir, "documents"), ["doc_id"])


def op4_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return sharding.hilbert_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scanned(docs).drop("text", "detections")


def op7_suffix_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_passages(read_table(spark, sf_dir, "documents")).drop("removed")


def op8_winnowing_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contamination_report(documents, benchmark)


def op9_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokens.tokenized(docs, public_tokenizers.path(TOKENIZER))


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_report(read_table(spark, sf_dir, "documents"))


def op11_summary_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return alignment.link_report(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))


def op13_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(RANKS))
    rows = bpe.encoded(read_table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])
    return bpe.decoded(rows, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_mixture_language,
            op2_simhash_duplicates,
            op3_robust_quality,
            op4_fair_queue_mix,
            op5_hilbert_shards,
            op6_license_signatures,
            op7_suffix_passages,
            op8_winnowing_hits,
            op9_plane_tokens,
            op10_boosted_pii,
            op11_summary_collocations,
            op12_galloping_alignment,
            op13_two_tier_bpe,
        )
    }


# What SQL says of the same tables, for the operators whose whole result SQL can express.
_OP8 = """
WITH doc_words AS (
    SELECT doc_id, list_transform(
        regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'),
        lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
    FROM documents
),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_transform(
        regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'),
        lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
    FROM benchmark
),
item_windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS n,
        array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS w
    FROM (SELECT item, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
          FROM item_words WHERE len(words) > 0)
),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS w
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
          FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)
),
hits AS (SELECT doc_id, d.n, i, item FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.w = b.w),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP11 = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, size, w[i : i + size - 1] AS words
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM words, (VALUES (1), (2), (3), (4), (5)) AS sizes(size) WHERE len(w) >= size)
),
frequent AS (SELECT lang, size, words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
inside AS (
    SELECT DISTINCT lang, words[i : i + part - 1] AS words, f
    FROM (SELECT lang, words, f, part, unnest(range(1, size - part + 2)) AS i
          FROM frequent, (VALUES (2), (3), (4)) AS parts(part) WHERE size > part)
),
kept AS (
    SELECT * FROM frequent AS c WHERE size > 1
    AND NOT EXISTS (SELECT 1 FROM inside AS o WHERE o.lang = c.lang AND o.words = c.words AND 100 * o.f >= 100 * c.f)
),
cuts AS (
    SELECT c.lang, c.words, c.f AS a, k, l.f AS l, r.f AS r, n,
        CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) AS c
    JOIN frequent AS l ON l.lang = c.lang AND l.words = c.words[1 : k]
    JOIN frequent AS r ON r.lang = c.lang AND r.words = c.words[k + 1 : c.size]
    JOIN totals AS t ON t.lang = c.lang
),
chosen AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score
    FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM chosen QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_winnowing_hits": _OP8, "op11_summary_collocations": _OP11}
