"""Registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.llm import ann, line_dedup, mixing, packing, periodic_runs, quality, sharding, simhash, suffix_dedup, tokens, toxicity, warc, whitening
from stockcast.session import shared_dir
from stockcast.sources.panel import table


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_boosted_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from ``labels`` outside the held-out fold."""
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of ``documents`` by proportional stratified interleaving (law: row counts)."""
    dealt = sharding.shard_documents(table(spark, folder, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op1_warc_capture_index(spark: SparkSession, folder: str) -> DataFrame:
    """Archive all ``pages``, index the captures and read every record back through the index."""
    pages = table(spark, folder, "pages")
    place = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = warc.build_index(warc.write_archives(pages, place), place)
    return warc.read_back(index, pages).drop("url_key")


def op2_two_tier_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all ``documents`` under the piece model."""
    return tokens.count_tokens(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_multiprobe_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all ``embeddings``."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op6_mcd_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of all ``documents`` and the verdict of the robust distance per language and source."""
    return quality.score(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op7_induced_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of all ``documents`` once strings of 50 bytes seen in earlier documents are cut out."""
    return suffix_dedup.removal_report(table(spark, folder, "documents"))


def op8_binary_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All ``documents`` cut into pieces of binary lengths, each a sequence of its own."""
    packed = packing.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of all ``documents`` and the near-duplicate group each belongs to."""
    groups = simhash.near_duplicates(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pivotal_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mixture of ``documents`` takes from each document, by pivotal rounding."""
    copies = mixing.copies_per_document(mixing.sized_rows(table(spark, folder, "documents")))
    return copies.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op11_bit_sliced_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All ``embeddings`` on the first eight components of their exact integer covariance."""
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("__at", "__of")
    ).select(
        "vec_id", (F.col("__at") + 1).alias("component"), "n", "deviation", "__of.whitened", "__of.explained", "identity_error")


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``; those with crc32(doc_id) divisible by 10 repeat their words from one place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    n = F.size("__words")
    chosen = docs.select("doc_id", "text", g.alias("__g"), F.when(h % 10 == 0, words).alias("__words"))
    chosen = chosen.withColumn("__a", F.expr("CAST(__g % nullif(size(__words), 0) AS INT)"))
    chosen = chosen.withColumn("__p", F.expr("CAST(1 + floor((size(__words) - __a) / (3 + __g % 8)) AS INT)"))
    repeated = F.expr(
        "concat(slice(__words, 1, __a), transform(sequence(0, size(__words) - __a - 1), i -> get(__words, __a + i % __p)))")
    return chosen.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_kruskal_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all ``documents``, a tenth of which is made periodic first."""
    found = periodic_runs.find_runs(made_periodic(table(spark, folder, "documents")))
    # the greatest exact exponent: fractions compared by their cross products
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (b, r) ->
        CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)""")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "__best.start", "__best.length", "__best.period",
        F.expr("__best.length * 1000 DIV __best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_bloom_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of all ``documents`` once lines that an earlier document has are cut out."""
    return line_dedup.line_report(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = (
    op1_warc_capture_index, op2_two_tier_token_counts, op3_boosted_toxicity, op4_interleaved_shards,
    op5_multiprobe_neighbours, op6_mcd_outliers, op7_induced_suffix_dedup, op8_binary_pieces, op9_simhash_groups,
    op10_pivotal_mixture, op11_bit_sliced_whitening, op12_kruskal_runs, op13_bloom_line_dedup,
)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline over all ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


OP1_SQL = """
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS body, sha1(COALESCE(html, '')) AS h,
           MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) AS response
    FROM pages)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)
           FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM p
"""

OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s
      FROM (SELECT r, doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT s, MIN(doc_id) AS first FROM w GROUP BY s),
late AS (SELECT w.r, w.i, COALESCE(w.i > lag(w.i) OVER (PARTITION BY w.r ORDER BY w.i) + 50, TRUE) AS fresh
         FROM w JOIN f USING (s) WHERE f.first < w.doc_id),
n AS (SELECT r, i, SUM(CAST(fresh AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS k FROM late),
spans AS (SELECT r, k, MIN(i) AS a, MAX(i) + 50 AS b FROM n GROUP BY r, k),
gaps AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans),
cut AS (SELECT g.r, SUM(b - a) AS n_removed, COUNT(*) AS n_spans, MAX(b) AS last,
               string_agg(substr(d.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM gaps g JOIN d USING (r) GROUP BY g.r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(COALESCE(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, MIN(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.r, k.doc_id, k.line, k.i, COALESCE(f.first < k.doc_id, FALSE) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*QUERIES, pipeline)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the result; the others are tested against brute force in tests/llm."""
    return {"op1_warc_capture_index": OP1_SQL, "op7_induced_suffix_dedup": OP7_SQL, "op13_bloom_line_dedup": OP13_SQL}
