"""The queries of this subpackage and the SQL for those that have one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.llm.decontaminate import contaminated
from slicedigest.llm.knn import top_k
from slicedigest.llm.multi_index import near_duplicate_vectors
from slicedigest.llm.packing import pack_documents
from slicedigest.llm.prefix_trie import prefix_trie
from slicedigest.llm.quality import fit_quality, score_quality
from slicedigest.llm.secret_ledger import RULES, scan_paths, span_count, span_text
from slicedigest.llm.sharding import shuffle_into_shards
from slicedigest.llm.simhash import near_duplicates
from slicedigest.llm.site_style import main_text
from slicedigest.llm.token_counts import section_tokens
from slicedigest.llm.token_links import token_links
from slicedigest.llm.warc import read_archives, resolve_revisits, write_archives
from slicedigest.runtime import use_checkpoint_dir

SHARDS = 24


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_site_style_text(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(_table(spark, sf, "pages"))


def op2_sum_of_squares_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(_table(spark, sf, "documents"), keep_ids=False).drop("ids", "sequence_tokens")


def op3_voronoi_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(_table(spark, sf, "embeddings"))


def op4_template_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op5_zstd_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{use_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(_table(spark, sf, "pages"), folder)
    read = resolve_revisits(read_archives(spark, folder))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"))


def op6_hypergeometric_shards(spark: SparkSession, sf: str) -> DataFrame:
    dealt = shuffle_into_shards(_table(spark, sf, "documents"), SHARDS, ["doc_id", "text"])
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_section_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return section_tokens(_table(spark, sf, "documents"))


def op8_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return score_quality(docs, fit_quality(docs, _table(spark, sf, "labels")))


def op9_blob_ledger_secrets(spark: SparkSession, sf: str) -> DataFrame:
    versions = _table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    found, _ = scan_paths(versions)
    spans = span_text()
    return found.select(
        "doc_id",
        *[span_count(r.name).alias(f"n_{r.name}") for r in RULES],
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )


def op10_segment_popcount_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"))


def op11_inverted_multi_index(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf, "embeddings"))


def op12_token_byte_links(spark: SparkSession, sf: str) -> DataFrame:
    return token_links(_table(spark, sf, "documents"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(_table(spark, sf, "conversations"))


OP3_SQL = """
WITH usable AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

OP5_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM k
"""

_ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
OP9_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matched AS (
    SELECT doc_id, text, k.kind, k.rank, k.least, regexp_extract_all(text, k.pattern, 0) AS hits,
           regexp_extract_all(text, k.pattern, k.part) AS held, string_split_regex(text, k.pattern) AS gaps
    FROM t, (VALUES ('assign', 0, '{_ASSIGN}', 1, 6), ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]{{24,}}', 0, 24))
        AS k(kind, rank, pattern, part, least)
    WHERE regexp_matches(text, k.pattern)),
spans AS (
    SELECT doc_id, kind, rank, length(hits[i]) AS size,
           list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM matched) WHERE length(held[i]) >= least),
joined AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rank) AS spans
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM t LEFT JOIN joined USING (doc_id)
"""

_CRC = """list_reduce([4294967295::UBIGINT] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::UBIGINT),
    lambda a, b: list_reduce([xor(a, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0 END)))"""
OP13_SQL = f"""
WITH numbered AS (
    SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT c, list(turn ORDER BY pos) AS own, (xor({_CRC}, 4294967295::UBIGINT) % 6)::BIGINT AS h FROM numbered GROUP BY c),
rebuilt AS (
    SELECT l.c, list_concat(coalesce(b.own, [])[1:l.h], l.own[l.h + 1:]) AS turns
    FROM lists l LEFT JOIN lists b ON b.c = l.c - l.c % 100),
places AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT turns[1:depth] AS path, depth, min(c) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(turns) = depth), '') AS ends
    FROM places GROUP BY ALL),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[depth].t) END AS saved
    FROM nodes n LEFT JOIN kids k ON k.path = n.path),
spread AS (SELECT unnest(range(0, depth + 1)) AS above, path, saved, n_children FROM valued),
sums AS (
    SELECT path[1:above] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM spread GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN sums s ON s.path = v.path LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.path[1:v.depth - 1]
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_site_style_text,
        op2_sum_of_squares_packing,
        op3_voronoi_top_k,
        op4_template_decontamination,
        op5_zstd_warc,
        op6_hypergeometric_shards,
        op7_section_tokens,
        op8_compression_quality,
        op9_blob_ledger_secrets,
        op10_segment_popcount_simhash,
        op11_inverted_multi_index,
        op12_token_byte_links,
        op13_prefix_trie,
    )
}
ORACLES = {"op3_voronoi_top_k": OP3_SQL, "op5_zstd_warc": OP5_SQL, "op9_blob_ledger_secrets": OP9_SQL, "op13_prefix_trie": OP13_SQL}
