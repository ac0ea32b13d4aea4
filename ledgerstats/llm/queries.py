"""The numbered operators with production parameters over their whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerstats import files
from ledgerstats.llm.common import size_session
from ledgerstats.llm.fingerprints import compare_with_edits
from ledgerstats.llm.language import identify_languages
from ledgerstats.llm.licences import scan_licences
from ledgerstats.llm.neardup import near_duplicates
from ledgerstats.llm.neighbours import nearest
from ledgerstats.llm.order import in_training_order
from ledgerstats.llm.packing import pack
from ledgerstats.llm.passages import remove_repeats
from ledgerstats.llm.pieces import piece_digests
from ledgerstats.llm.prefixes import prefix_trie
from ledgerstats.llm.repair import damaged, repair_digests
from ledgerstats.llm.toxicity import toxicity
from ledgerstats.llm.warc import archive_pages


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    path = f"{directory}/{name}.parquet"
    size_session(spark, files.size_in_bytes(spark, path))
    return spark.read.parquet(path)


def byte_bpe() -> tuple[str, str, str]:
    """The byte-level vocabulary as JSON, its ranks, and the pattern of words."""
    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    vectors = _table(spark, directory, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op2_training_order(spark: SparkSession, directory: str) -> DataFrame:
    rows = in_training_order(_table(spark, directory, "documents"), byte_bpe(), key=20240229)
    return rows.drop("path")


def op3_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_digests(_table(spark, directory, "documents"), model)


def op4_packing(spark: SparkSession, directory: str) -> DataFrame:
    return pack(_table(spark, directory, "documents"), byte_bpe())


def op5_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates(_table(spark, directory, "documents"))


def op6_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return identify_languages(_table(spark, directory, "documents"))


def op7_repeated_passages(spark: SparkSession, directory: str) -> DataFrame:
    rows = remove_repeats(_table(spark, directory, "documents"))
    return rows.select("doc_id", "text", "removed_spans")


def op8_warc(spark: SparkSession, directory: str) -> DataFrame:
    rows = archive_pages(_table(spark, directory, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_licences(spark: SparkSession, directory: str) -> DataFrame:
    return scan_licences(_table(spark, directory, "documents")).drop("spans")


def op10_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return compare_with_edits(_table(spark, directory, "documents"))


def op11_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    conversations = _table(spark, directory, "conversations")
    return repair_digests(conversations, damaged(conversations))


def op12_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity(_table(spark, directory, "documents"), _table(spark, directory, "labels"))


def op13_prefix_trie(spark: SparkSession, directory: str) -> DataFrame:
    return prefix_trie(_table(spark, directory, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbours,
        op2_training_order,
        op3_sentencepiece,
        op4_packing,
        op5_near_duplicates,
        op6_language_id,
        op7_repeated_passages,
        op8_warc,
        op9_licences,
        op10_fingerprints,
        op11_conversation_repair,
        op12_toxicity,
        op13_prefix_trie,
    )
}

ORACLES = {
    "op5_near_duplicates": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3),
                                        lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x
            FROM d
        ), n AS (
            SELECT doc_id, count(x) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
            FROM s AS a JOIN s AS b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT u, v FROM p JOIN n AS a ON a.doc_id = u JOIN n AS b ON b.doc_id = v
            WHERE 100 * c >= 85 * (a.n + b.n - c)
        ), r AS (
            SELECT doc_id, doc_id AS c FROM d
            UNION SELECT l.v, r.c FROM r JOIN l ON r.doc_id = l.u
        ), m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
        SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept
        FROM n JOIN m USING (doc_id)
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), r AS (
            SELECT page_id, octet_length(payload) AS payload_bytes,
                sha256(payload) AS payload_digest,
                min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
                ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM r
    """,
    # The checksum is folded bit by bit, as DuckDB has no function for it.
    "op13_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), s AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS own
            FROM t GROUP BY conv_id
        ), c AS (
            SELECT conv_id, own, xor(list_reduce(
                list_concat([4294967295::BIGINT], list_transform(
                    string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda a, b: list_reduce(
                    list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
            FROM s
        ), r AS (
            SELECT c.conv_id,
                list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
            FROM c LEFT JOIN s AS b ON b.conv_id = c.conv_id - c.conv_id % 20
        ), m AS (
            SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM r
        ), n AS (
            SELECT seq[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                    FILTER (len(seq) = depth), '')) AS ends_sha256
            FROM m GROUP BY ALL
        ), k AS (
            SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n
            WHERE depth > 0 GROUP BY ALL
        ), w AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children,
                CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(
                    n.node[n.depth].text, '[^ 	-
]+')) END AS saved
            FROM n LEFT JOIN k ON n.node = k.node
        ), u AS (
            SELECT node, depth, n_children, saved, unnest(range(0, depth + 1)) AS above FROM w
        ), b AS (
            SELECT node[1:above] AS node, count(*) FILTER (n_children = 0) AS n_leaves,
                sum(saved)::BIGINT AS saved_tokens
            FROM u GROUP BY ALL
        )
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
            b.n_leaves, b.saved_tokens, w.ends_sha256
        FROM w JOIN b ON w.node = b.node
        LEFT JOIN n AS p ON p.node = w.node[1:w.depth - 1] AND w.depth > 0
    """,
}
