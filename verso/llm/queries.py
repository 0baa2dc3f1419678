"""Queries of the corpus operators over the tables in a folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, license_scan, quality_cnn, sentence_spans, shard_pack, source_mix, token_separators, transport_stream, url_aliases
from .shared import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents")).drop("places")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_aliases.verdicts(pages, url_aliases.links(pages))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", source_mix.words_in(F.col("text")).alias("n"))
    rows = source_mix.copies(sizes, F.col("n"))
    return rows.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.without_repeats(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op7_shard_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_pack.packed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_stream.streams(table(spark, sf_dir, "documents"), media=False)


def op10_token_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_separators.token_counts(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_quality_cnn, op3_url_aliases, op4_source_mix, op5_sentence_spans, op6_jaccard_join, op7_shard_pack, op8_decontaminate, op9_transport_stream, op10_token_separators)}


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: A template's regular expression over words with a blank before each.
_NOTICES = {
    "apache-notice": " licensed under the apache license",
    "bsd-text": " redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-notice": " licensed under( a creative commons)? cc by nc( sa)?( nd)?( [^ ]+){2}",
    "cc-by-notice": " licensed under( a creative commons)? cc by( nc)?( sa)?( nd)?( [^ ]+){2}",
    "gpl-notice": " licensed under the( terms of the)? gnu general public license",
    "isc-text": " permission to use copy modify and( or)? distribute this( [^ ]+){1,3} for any purpose with or without fee is hereby granted",
    "mit-notice": " released under the( terms of the)? mit license",
    "mit-text": " permission is hereby granted free of charge to any person obtaining a copy of this( [^ ]+){1,6} to deal in the( [^ ]+){1,3} without restriction",
}
_PHRASES = {"apache": "apache license", "cc-by": "cc by", "gpl": "gnu general public license", "mit": "mit license"}


def _op1_sql() -> str:
    labels = sorted([*((k, f" {v}") for k, v in _PHRASES.items()), *_NOTICES.items()])
    place = " OR ".join(f"w[i:i + {v.count(' ')}] = {v.split()!r}" for v in _PHRASES.values())
    listed = lambda some: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(j, '{v}( |$)') THEN '{k}' END" for k, v in some) + "], lambda x: x IS NOT NULL), ',')"
    return f"""
        WITH t AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        j AS (SELECT doc_id, w, array_to_string(list_transform(w, lambda x: ' ' || x), '') AS j,
                     list_filter(range(1, len(w) + 1), lambda i: {place}) AS b FROM t),
        l AS (SELECT *, {listed([x for x in labels if x[0] in _PHRASES])} AS base_labels, {listed(labels)} AS labels FROM j)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(b)::BIGINT AS n_base, b[1] - 1 AS first_word, b[-1] - 1 AS last_word,
               base_labels, labels, CASE WHEN labels = '' THEN 0.0::DOUBLE WHEN labels = base_labels THEN 0.5 ELSE 1.0 END AS score
        FROM l"""


#: Links relative to a folder, <base> and comments, which the tables don't have, are for the test against plain Python.
_OP3_SQL = r"""
    WITH RECURSIVE p AS (
        SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
               list_transform(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), lambda x: regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)) AS canonical,
               list_transform(regexp_extract_all(html, '(?i)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh\b[^>]*>'), lambda x: regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''>]+)', 1)) AS refresh,
               list_transform(regexp_extract_all(html, '(?i)<meta\b[^>]*\bproperty\s*=\s*["'']?og:url\b[^>]*>'), lambda x: regexp_extract(x, '(?i)\bcontent\s*=\s*["'']?([^"''\s>]+)', 1)) AS og
        FROM pages),
    l AS (
        SELECT url, host, trim(replace(link, '&amp;', '&')) AS link, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme
        FROM (SELECT url, host, unnest(canonical || refresh || og) AS link FROM p WHERE url LIKE '%://%') WHERE link <> ''),
    w AS (SELECT url AS a, CASE WHEN contains(link, '://') THEN link WHEN link LIKE '//%' THEN scheme || ':' || link WHEN link LIKE '/%' THEN scheme || '://' || host || link END AS b FROM l),
    f AS (SELECT url, regexp_replace(url, '(?s)#.*$', '') AS g FROM (SELECT a AS url FROM w UNION SELECT b FROM w UNION SELECT url FROM p) WHERE url IS NOT NULL),
    z AS (SELECT url, CASE WHEN contains(g, '://') THEN regexp_replace(regexp_extract(g, '(?s)^(.*?://)', 1), '^[Hh][Tt][Tt][Pp][Ss]?://', 'https://')
                 || translate(regexp_extract(g, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(g, '(?s)^.*?://[^/?#]*(.*)$', 1) ELSE g END AS form FROM f),
    e AS (SELECT x.form AS a, y.form AS b FROM w JOIN z AS x ON x.url = w.a JOIN z AS y ON y.url = w.b WHERE x.form <> y.form),
    u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    n AS (SELECT a AS url, regexp_extract(a, '(?s)^.*?://([^/?#]*)', 1) AS host, regexp_extract(a, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT a FROM u)),
    r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS r(h, q, verdict)),
    reach AS (SELECT a AS url, a AS other FROM u UNION SELECT reach.url, u.b FROM reach JOIN u ON u.a = reach.other),
    judged AS (SELECT url, arg_max(verdict, length(h || q)) AS v FROM n JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY url),
    passed AS (SELECT reach.url, CASE WHEN bool_or(v = 'allow') THEN 'allow' ELSE 'block' END AS v FROM reach JOIN judged ON judged.url = reach.other GROUP BY reach.url),
    own AS (SELECT page_id, url, host, path, (SELECT arg_max(h || q, length(h || q)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)) AS rule,
                   (SELECT arg_max(verdict, length(h || q)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)) AS v FROM p)
    SELECT page_id, host, path, rule, coalesce(own.v, passed.v, 'allow') AS verdict FROM own LEFT JOIN z ON z.url = own.url LEFT JOIN passed ON passed.url = z.form"""

_OP4_SQL = r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1]::BIGINT AS w FROM s),
    o AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()::BIGINT - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
                 sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS w_rest FROM w),
    f AS (SELECT max_by(rest / w_rest, w_rest) AS level FROM o WHERE 2 * source_size * w_rest >= w * rest),
    t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, coalesce(w * level, 2 * source_size)) AS target,
                 ('0x' || md5('mix' || coalesce('s' || source, 'n'))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u FROM w, f),
    k AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                 row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) - 1 AS i FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, ((floor(u + rate * (i + 1)) - floor(u + rate * i)) * size)::BIGINT AS taken FROM k"""

_OP8_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
    g AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
          FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
    x AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g))),
    h AS (SELECT x.r, x.i, x.n, g.item FROM x JOIN g USING (n, gram)),
    c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
    m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)"""


def oracle_sql() -> dict[str, str]:
    """Learning (2), connected components of similar texts (6), passages (5), packing (7), streams (9) and tokenizers (10) have no SQL."""
    return {"op1_license_scan": _op1_sql(), "op3_url_aliases": _OP3_SQL, "op4_source_mix": _OP4_SQL, "op8_decontaminate": _OP8_SQL}
