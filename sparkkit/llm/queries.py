"""The registered queries of this subpackage with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(f):
        REGISTRY[f.__name__] = Query(f, sql)
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

SQL_URLS = f"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(rhost, rpath, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
fits AS (
  SELECT page_id, rhost || rpath AS rule, rules.verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, rules.verdict DESC) AS k
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN fits ON u.page_id = fits.page_id AND k = 1"""


@query(SQL_URLS)
def op2_url_trie(spark, folder):
    from .url_filter import filter_urls

    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op6_simhash_pivots(spark, folder):
    from .simhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


SQL_MIX = r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
known AS (SELECT source, sum(size)::DOUBLE AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0 * source_size AS cap, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS w FROM known),
stepped AS (
  SELECT *, sum(cap) OVER o - cap AS held, sum(w) OVER (ORDER BY cap / w DESC, source DESC) AS open_weight, sum(source_size) OVER () AS total
  FROM weighed WINDOW o AS (ORDER BY cap / w, source)),
level AS (SELECT max((total * 1.5 - held) / open_weight) FILTER (WHERE (total * 1.5 - held) / open_weight <= cap / w) AS lam FROM stepped),
dealt AS (SELECT source, source_size, least(cap, w * lam) AS target FROM weighed, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0) ELSE 0.0 END AS rate,
    ('0x' || substr(md5('10:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM sized JOIN dealt ON sized.source IS NOT DISTINCT FROM dealt.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM rated"""


@query(SQL_MIX)
def op10_mix_sources(spark, folder):
    from .mix import plan_mix, words

    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    planned = plan_mix(docs.select("doc_id", "source", words("text").alias("n")), F.col("n"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

SQL_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to FROM f"""


@query(SQL_WARC)
def op1_warc_round_trip(spark, folder):
    from .warc import round_trip

    return round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))


@query()
def op4_pack_sequences(spark, folder):
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op7_suffix_repeats(spark, folder):
    from .suffix import digest

    return digest(table(spark, folder, "documents"))


@query()
def op8_lattice_hashing(spark, folder):
    from .lattice import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


@query()
def op9_ordinal_quality(spark, folder):
    from .quality import graded, score, train

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score(docs, train(docs, graded(table(spark, folder, "labels")))).select("doc_id", "expected_grade", "p_best", "kept")


@query()
def op5_closed_syncmers(spark, folder):
    from .syncmers import fingerprints

    return fingerprints(table(spark, folder, "documents"))


@query()
def op3_licence_scan(spark, folder):
    from .licences import document_files, scan

    found = scan(document_files(table(spark, folder, "documents")))
    return found.select(F.col("id").alias("doc_id"), "path", "licence", F.round("cosine", 6).alias("cosine"), "origin", "directory")


@query()
def op11_align_tokenizers(spark, folder):
    import public_tokenizers

    from .align import align

    a, b, ranks = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
    return align(table(spark, folder, "documents"), a, b, ranks)


@query()
def op12_byte_bpe(spark, folder):
    import public_tokenizers

    from .byte_bpe import round_trip

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op13_conversation_repair(spark, folder):
    from .repair import damage, repair

    return repair(damage(table(spark, folder, "conversations"))).withColumnRenamed("conv", "conv_id")


@query()
def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
