"""The queries of the corpus operators, each with its SQL where SQL can express it.

Every query takes its rows from its operator and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (bpe, class_lm, graph_search, license_scan, line_runs, mixing, pair_search,
               quality_lines, setsketch, token_lengths, toxicity, warc, whitening)
from .common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Shingle width and share of the link that the contract of op4 names.
OP4_SHINGLE, OP4_PERCENT = 4, 80


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


def is_remainder(column: str, divisor: int, value: int) -> Column:
    """Whether crc32 of the id leaves this remainder; false for a null id."""
    return F.coalesce(remainder(column, divisor) == value, F.lit(False))


def doc_id() -> Column:
    return F.col("id").alias("doc_id")


@query()
def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_lines.train_lines(docs, table(spark, sf_dir, "labels"))
    return quality_lines.label_lines(docs, model).select(
        doc_id(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "content_words")


@query()
def op2_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    shards = graph_search.shard_count(vectors.count())
    index = graph_search.build_index(vectors, shards=shards)
    return graph_search.search_index(index, vectors.where("vec_id % 20 = 0"), shards)


@query()
def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = class_lm.learn(docs, learns=~is_remainder("doc_id", 10, 0))
    return class_lm.score_texts(docs, model).select(
        doc_id(), is_remainder("id", 10, 0).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


@query()
def op4_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=OP4_SHINGLE,
                                      percent=OP4_PERCENT)
    return found.select(doc_id(), "n_shingles", "component_id", "kept")


_MIX_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighed AS (
    SELECT source, s,
           [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w
    FROM sources),
-- Round by round: share what is left, stop those that would pass their limit.
rounds AS (
    SELECT 0 AS round, source, s, w, false AS stopped FROM weighed
    UNION ALL
    SELECT round + 1, source, s, w,
           stopped OR w * ((sum(s) OVER () - coalesce(sum(3 * s) FILTER (stopped) OVER (), 0))
                           / (sum(w) FILTER (NOT stopped) OVER ())::DOUBLE) > 3 * s
    FROM rounds WHERE round < 64),
last AS (SELECT * FROM rounds WHERE round = 64),
targets AS (
    SELECT source, s, CASE WHEN stopped THEN (3 * s)::DOUBLE ELSE
           w * ((sum(s) OVER () - coalesce(sum(3 * s) FILTER (stopped) OVER (), 0))
                / (sum(w) FILTER (NOT stopped) OVER ())::DOUBLE) END AS target
    FROM last),
rated AS (SELECT *, CASE WHEN s > 0 THEN target / s ELSE 0.0 END AS rate FROM targets)
SELECT d.doc_id, d.size, r.s AS source_size, r.target,
       (d.size * (floor(r.rate)::BIGINT + CASE WHEN
           ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.digest),
                           1, 13))::BIGINT
               / 4503599627370496.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
"""


@query(_MIX_SQL)
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select(doc_id(), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"),
                           usable=~is_remainder("doc_id", 4, 2))
    return toxicity.score_toxicity(docs, model).select(
        doc_id(), is_remainder("id", 4, 2).alias("held_out"), "score", "predicted")


_WARC_SQL = r"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex
                FROM pages),
ranked AS (SELECT *, first_value(page_id) OVER same AS first, row_number() OVER same AS place
           FROM hashed WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (('0x' || substr(hex, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT
                   // (32768 // (32 ** (i % 4))::BIGINT) % 32 + 1)::BIGINT, 1)), '')
           AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place = 1 THEN NULL ELSE first END AS refers_to
FROM ranked
"""


@query(_WARC_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.round_trip(table(spark, sf_dir, "documents"))
    return tokens.select(doc_id(), "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.suffix_sums(
        token_lengths.length_counts(table(spark, sf_dir, "documents")))


@query()
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.col("base_places")
    named = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(places)))
    both = F.concat(base["label"], F.col("template_places")["label"])
    return found.select(
        doc_id(), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(base["start"]).alias("first_word"), F.array_max(base["start"]).alias("last_word"),
        named(base["label"]).alias("base_labels"), named(both).alias("labels"), "score")


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_rows(table(spark, sf_dir, "embeddings"))


_LINES_SQL = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls
    FROM documents),
lines AS (
    SELECT doc_id, rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (
    SELECT l.*, coalesce(f.first <> l.doc_id, false) AS gone FROM keyed l LEFT JOIN firsts f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""


@query(_LINES_SQL)
def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(doc_id(), "n_lines", "n_dropped",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


_RANK_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
sized AS (SELECT *, len(ts)::BIGINT AS n FROM docs WHERE len(ts) > 0),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
held AS (
    SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM sized) t
    WHERE term IN (SELECT term FROM asked) GROUP BY rid, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT
           AS w FROM held, whole GROUP BY term),
gains AS (
    SELECT rid, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))
           AS gain FROM held JOIN sized USING (rid) JOIN weights USING (term), whole),
scored AS (
    SELECT item_id, rid, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term)
    GROUP BY item_id, rid),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
           AS rank, doc_id, score FROM scored JOIN docs USING (rid) WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


@query(_RANK_SQL)
def op13_pair_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_search.rank_documents(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))
