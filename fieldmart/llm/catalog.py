"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.llm import langid
from fieldmart.llm.chat import rotate
from fieldmart.llm.common import Scratch
from fieldmart.llm.decontamination import decontaminate
from fieldmart.llm.exact_dedup import exact_dedup
from fieldmart.llm.minhash import near_duplicates
from fieldmart.llm.negatives import hard_negatives
from fieldmart.llm.packing import pack
from fieldmart.llm.phrases import collocations
from fieldmart.llm.prefixes import similar_documents
from fieldmart.llm.suffixes import remove_repeats
from fieldmart.llm.toxicity import score, train
from fieldmart.llm.warc import pages_to_warc
from fieldmart.llm.wavelet import read_tokens, write_tokens

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op1"), keep="largest")


ORACLE_SQL["op1_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Scratch(spark, "op3"))


@query
def op5_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), Scratch(spark, "op5")))


@query
def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_to_warc(table(spark, sf_dir, "pages"), Scratch(spark, "op6"))


# The base32 digits of the digest: eight times 20 bits, five hexadecimal digits for four of them.
ORACLE_SQL["op6_arc_to_warc"] = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), hashed AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS digest FROM payloads
), digested AS (
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + ((('0x' || substr(digest, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)),
               'string_agg', '') AS payload_digest
    FROM hashed
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


@query
def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"), Scratch(spark, "op2"))


ORACLE_SQL["op2_chat_rotation"] = r"""
WITH named AS (
    SELECT conv_id, turn, replace(coalesce(text, ''), '<|', '< |') AS text,
           regexp_replace(trim(role), '[\s<|>]+', '_', 'g') AS name
    FROM conversations
), messages AS (
    SELECT *, CASE WHEN length(name) > 0 THEN name ELSE 'unknown' END AS speaker,
           row_number() OVER (ORDER BY conv_id, turn NULLS LAST, name, text) AS nth
    FROM named
), people AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM messages WHERE speaker <> 'system'
), rendered AS (
    SELECT m.conv_id, p.perspective, m.nth, m.text, m.speaker = p.perspective AS trained,
           '<|im_start|>' || CASE WHEN m.speaker = 'system' THEN 'system'
                                  WHEN m.speaker = p.perspective THEN 'assistant'
                                  ELSE 'user name=' || m.speaker END || chr(10) AS head
    FROM messages m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
    SELECT *, coalesce(sum(length(head) + length(text) + 11) OVER (
        PARTITION BY conv_id, perspective ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM rendered
), pieces AS (
    SELECT *, start // 262144 AS piece, min(start) OVER (PARTITION BY conv_id, perspective, start // 262144) AS first
    FROM placed
)
SELECT conv_id, perspective, piece,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY nth) AS text,
       coalesce(string_agg((start - first + length(head)) || '-' || (start - first + length(head) + length(text) + 10), ','
                           ORDER BY nth) FILTER (WHERE trained), '') AS mask,
       count(*) AS n_messages,
       count(*) FILTER (WHERE trained) AS n_trained
FROM pieces
GROUP BY conv_id, perspective, piece
"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op9"))


ORACLE_SQL["op9_decontamination"] = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), item_words AS (
    SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark WHERE item_id IS NOT NULL
), starts AS (
    SELECT item_id, words, least(len(words), 10) AS length,
           unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS start
    FROM item_words WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, length, array_to_string(words[start:start + length - 1], ' ') AS gram FROM starts
), lengths AS (
    SELECT DISTINCT length FROM windows
), grams AS (
    SELECT doc_id, length, start, array_to_string(words[start:start + length - 1], ' ') AS gram
    FROM (SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS start
          FROM doc_words, lengths WHERE len(words) >= length)
), hits AS (
    SELECT doc_id, start, g.length, item_id FROM grams g JOIN windows w ON g.gram = w.gram AND g.length = w.length
), hit_words AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + length)) AS word FROM (SELECT DISTINCT doc_id, start, length FROM hits))
    GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))


@query
def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    moved = F.try_add(embeddings["label"].cast("long"), F.lit(1)) % 10
    label = F.when(embeddings["vec_id"] % 7 == 0, moved).otherwise(embeddings["label"])
    return hard_negatives(embeddings, Scratch(spark, "op13"), label=label)


ORACLE_SQL["op13_hard_negatives"] = """
WITH own AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM own a JOIN own r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


ORACLE_SQL["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), places AS (
    SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
    FROM split, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k
), counted AS (
    SELECT lang, words[i:i + k - 1] AS words, count(*) AS f FROM places GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counted WHERE len(words) = 1 GROUP BY lang
), frequent AS (
    SELECT * FROM counted WHERE f >= 100
), cuts AS (
    SELECT c.lang, c.words, k, c.f AS a, l.f AS l, r.f AS r, n,
           (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, len(words))) AS k FROM frequent) c
    JOIN frequent l ON l.lang = c.lang AND l.words = c.words[1:k]
    JOIN frequent r ON r.lang = c.lang AND r.words = c.words[k + 1:]
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inside AS (
    SELECT lang, words[i:i + k - 1] AS words, max(f) AS f
    FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM frequent, (SELECT unnest(range(2, 5)) AS k)
          WHERE len(words) > k)
    GROUP BY ALL
), kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.words = b.words
    WHERE i.f IS NULL OR 100 * i.f < 100 * a
)
SELECT lang, row_number() OVER best_first AS rank, array_to_string(words, ' ') AS phrase, a, l, r, n::BIGINT AS n,
       score::BIGINT AS score
FROM kept
WINDOW best_first AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' '))
QUALIFY row_number() OVER best_first <= 2000
"""


@query
def op12_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), Scratch(spark, "op12"))
