"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (bpe, decontam, divergence, filteraudit, html, langid, licenses, quality, secrets, simhash, tokencounts,
               urlfilter, warc)
from .common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(read_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), path, pattern)
    return bpe.digests(bpe.decode(ids, path, pattern))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html.extract(pages, html.learn(pages)).withColumn("n_chars", F.length("text").cast("long"))


def document_edits() -> list[Column]:
    """Four edits of each document, from its own text: its first line goes, its
    source is put in the middle, the last tenth is replaced by the first 40
    characters, and a line with its language is appended."""
    n, none, end = F.length("text"), F.lit(""), F.lit(2 ** 40)
    changes = ((F.lit(0), F.instr("text", "\n"), none),
               (F.floor(n / 2), F.floor(n / 2), F.coalesce("source", none)),
               (F.floor(n * 0.6), F.floor(n * 0.7), F.substring("text", 1, 40)),
               (end, end, F.concat(F.lit("\nlang: "), F.coalesce("lang", none))))
    return [tokencounts.edit(F.lit(i), *change) for i, change in enumerate(changes, 1)]


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.counts_with_own_edits(read_table(spark, sf_dir, "documents"), document_edits(),
                                             public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = (urlfilter.Rule("net", "/", "block"), urlfilter.Rule("example.net", "/en/", "allow"),
             urlfilter.Rule("example.com", "/de/", "block"), urlfilter.Rule("org", "/fr/", "allow"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, URL_RULES, urlfilter.hosts_with_words(pages))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(read_table(spark, sf_dir, "documents")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_language_id, op3_bpe, op4_html, op5_token_counts, op6_warc, op7_url_filter,
                                    op8_secrets, op9_quality, op10_decontamination, op11_filter_audit, op12_licenses,
                                    op13_divergence)}

_WORDS_SQL = ", ".join(f"'{w}'" for w in urlfilter.HOST_WORDS)
_RULES_SQL = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)

ORACLE_SQL: dict[str, str] = {
    "op6_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM m""",
    "op7_url_filter": rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT row_number() OVER () AS row, page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
      FROM u),
rules(rhost, rpath, verdict) AS (VALUES {_RULES_SQL}),
fits AS (SELECT row, rhost || rpath AS rule, verdict,
                row_number() OVER (PARTITION BY row ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS rn
         FROM h, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN len(list_intersect(string_split_regex(host, '[.-]'), [{_WORDS_SQL}])) > 0
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN (SELECT * FROM fits WHERE rn = 1) USING (row)""",
    "op11_filter_audit": filteraudit.AUDIT_SQL,
    "op12_licenses": licenses.LICENSE_SQL,
    "op13_divergence": divergence.DIVERGENCE_SQL,
}
