"""The registered queries of this package and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import (
    exact_dedup,
    hard_negatives,
    html_text,
    licenses,
    minhash,
    mixing,
    packing,
    quality,
    ranked_search,
    secret_scan,
    toxicity,
    url_filters,
    warc,
)
from tracklane.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query()
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


_LICENSE_SQL = r"""
    WITH found AS (
      SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    places AS (
      SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t,
             [i FOR i IN range(1, len(w) + 1) IF w[i] = 'cc' AND w[i + 1] = 'by'] AS cc,
             [i FOR i IN range(1, len(w) + 1) IF w[i] = 'general' AND w[i + 1] = 'public'
                                             AND w[i + 2] = 'license'] AS gpl,
             [i FOR i IN range(1, len(w) + 1) IF w[i] = 'all' AND w[i + 1] = 'rights'
                                             AND w[i + 2] = 'reserved'] AS ar
      FROM found),
    labelled AS (
      SELECT doc_id, len(w) AS n_words, list_concat(cc, gpl, ar) AS starts,
             list_filter([CASE WHEN len(cc) > 0 THEN 'cc-by' END,
                          CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                          CASE WHEN len(ar) > 0 THEN 'reserved' END],
                         lambda x: x IS NOT NULL) AS base,
             list_filter([
               CASE WHEN regexp_matches(t,
                 ' licensed under the apache license (version )?2 0 ') THEN 'apache-2.0' END,
               CASE WHEN contains(t,
                 ' redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met ')
                 THEN 'bsd' END,
               CASE WHEN regexp_matches(t,
                 ' licensed under (a )?(creative commons )?cc by nc 4 0 ') THEN 'cc-by-nc-4.0' END,
               CASE WHEN regexp_matches(t,
                 ' licensed under (a )?(creative commons )?cc by sa 4 0 ') THEN 'cc-by-sa-4.0' END,
               CASE WHEN regexp_matches(t,
                 ' copyright (c )?([^ ]+ ){1,8}all rights reserved ') THEN 'copyright' END,
               CASE WHEN regexp_matches(t,
                 ' gnu general public license (as published by the free software foundation (either )?)?version 3 ')
                 THEN 'gpl-3.0' END,
               CASE WHEN contains(t, ' under the mit license ') THEN 'mit' END,
               CASE WHEN regexp_matches(t,
                 ' permission is hereby granted free of charge to any person obtaining a copy of ([^ ]+ ){1,12}to deal in the software without restriction ')
                 THEN 'mit-text' END], lambda x: x IS NOT NULL) AS more
      FROM places)
    SELECT doc_id, n_words, len(starts) AS n_base,
           list_min(starts) - 1 AS first_word, list_max(starts) - 1 AS last_word,
           array_to_string(base, ',') AS base_labels,
           array_to_string(list_sort(list_concat(base, more)), ',') AS labels,
           CASE WHEN len(more) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE
             AS score
    FROM labelled
    """


@_query(_LICENSE_SQL)
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the SQL has notices and openings only
    return licenses.scan(_table(spark, sf_dir, "documents")).drop(
        "text_labels", "text_score", "spans"
    )


@_query()
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(_table(spark, sf_dir, "documents"))


@_query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@_query()
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_classes(_table(spark, sf_dir, "documents"), size=4)
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@_query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query(
    """
    WITH payload AS (
      SELECT page_id, coalesce(html, '') AS html FROM pages),
    firsts AS (
      SELECT page_id, strlen(html) AS n, sha256(html) AS digest,
             min(page_id) OVER (PARTITION BY html) AS first_id
      FROM payload)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
             AS record_type,
           CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM firsts
    """
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    archives = spark.read.parquet(path)
    index = warc.build_index(warc.read_archives(archives))
    captures = warc.look_up(index, pages)
    return warc.fetch(archives, captures).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query(
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.text_classes(_table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LISTED_HOSTS = (
    "ads-track.example.com",
    "adult-x.example.com",
    "casino-win.example.net",
    "cheap-pills.example.net",
    "free-bets.example.net",
    "spam-farm.example.org",
)


@_query(
    """
    WITH cut AS (
      SELECT page_id,
             CASE WHEN position('://' IN url) > 0
                  THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages),
    part AS (
      SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
    urls AS (
      SELECT page_id,
             translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
      FROM part),
    rules(verdict, rule_host, rule_path) AS (VALUES
      ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
      ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
      ('block', 'net', '/fr/')),
    listed(listed_host) AS (VALUES
      ('ads-track.example.com'), ('adult-x.example.com'), ('casino-win.example.net'),
      ('cheap-pills.example.net'), ('free-bets.example.net'), ('spam-farm.example.org'))
    SELECT page_id, host, path,
           (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
              AND starts_with(path, rule_path)) AS rule,
           coalesce(
             (SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules
              WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                AND starts_with(path, rule_path)),
             CASE WHEN EXISTS (SELECT 1 FROM listed WHERE host = listed_host
                               OR ends_with(host, '.' || listed_host))
                  THEN 'block' ELSE 'allow' END) AS verdict
    FROM urls
    """
)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(_table(spark, sf_dir, "pages"), URL_RULES, LISTED_HOSTS)


@_query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_SECRETS_SQL = r"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    rules(o, kind, pattern, grp, least) AS (VALUES
      (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1, 12),
      (1, 'access', '(AKIA[A-Z0-9]+)', 1, 18),
      (2, 'hex', '([0-9a-f]+)', 1, 16),
      (3, 'private_key', '(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)', 1, 1),
      (4, 'github', '(gh[oprsu]_[A-Za-z0-9]{36,})', 1, 1),
      (5, 'slack', '(xox[abprs]-[A-Za-z0-9-]{10,})', 1, 1),
      (6, 'google', '(AIza[A-Za-z0-9_-]{35})', 1, 1),
      (7, 'stripe', '([rs]k_live_[A-Za-z0-9]{16,})', 1, 1),
      (8, 'jwt', '(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)', 1, 1),
      (9, 'bearer', '([Bb][Ee][Aa][Rr][Ee][Rr]\x20+[A-Za-z0-9._~+/-]{20,})', 1, 1),
      (10, 'login', '([a-z]{2,10}://[^\x00-\x20/:@]{1,256}:[^\x00-\x20/@]{1,256}@)', 1, 1)),
    matched AS (
      SELECT r, o, kind, least, regexp_extract_all(text, pattern, 0) AS m,
             regexp_extract_all(text, pattern, 1) AS told,
             string_split_regex(text, pattern) AS gaps
      FROM texts, rules WHERE regexp_matches(text, pattern)),
    each AS (
      SELECT r, o, kind, least, unnest(m) AS one, unnest(told) AS part,
             unnest(gaps[:len(m)]) AS gap, generate_subscripts(m, 1) AS k
      FROM matched),
    placed AS (
      SELECT r, o, kind, length(one) AS n, length(part) >= least AS long_enough,
             sum(length(gap) + length(one)) OVER (PARTITION BY r, o ORDER BY k) AS stop
      FROM each),
    spans AS (
      SELECT r, o, kind, (stop - n)::BIGINT AS start,
             kind || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS said
      FROM placed WHERE long_enough),
    joined AS (
      SELECT r, count(*) FILTER (WHERE o = 0) AS n_assign,
             count(*) FILTER (WHERE o = 1) AS n_access,
             count(*) FILTER (WHERE o = 2) AS n_hex,
             string_agg(said, ',' ORDER BY start, o) FILTER (WHERE o < 3) AS base,
             string_agg(said, ',' ORDER BY start, o) AS spans
      FROM spans GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM texts LEFT JOIN joined USING (r)
    """


@_query(_SECRETS_SQL)
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secret_scan.BASE]

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


@_query(
    """
    WITH usable AS (
      SELECT row_number() OVER () AS r, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND coalesce(list_bool_and(list_transform(embedding,
              lambda x: x IS NOT NULL AND isfinite(x))), true)),
    scores AS (
      SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id,
             a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM usable a JOIN usable b ON a.r <> b.r
      WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT ar, anchor_id, br AS pr, id AS positive_id, score AS positive_score
      FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, br) <= 5)
    SELECT p.anchor_id, positive_id,
           row_number() OVER (PARTITION BY p.ar, pr ORDER BY score DESC, id NULLS LAST, br)::INT
             AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scores n ON p.ar = n.ar AND NOT n.same
     AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.vectors(
        _table(spark, sf_dir, "embeddings"),
        relabel=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label),
    )
    return hard_negatives.mine(rows)


@_query(
    r"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
      FROM documents),
    size AS (
      SELECT count(*) FILTER (WHERE len(t) > 0) AS docs, sum(len(t))::BIGINT AS terms FROM texts),
    held AS (
      SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM texts) GROUP BY ALL),
    known AS (
      SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM held, size GROUP BY term, docs),
    items AS (
      SELECT row_number() OVER () AS i, item_id, text
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    asked AS (
      SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM items),
    lengths AS (
      SELECT r, doc_id, 10 + (90 * len(t) * docs) // terms AS m FROM texts, size WHERE len(t) > 0),
    scored AS (
      SELECT i, item_id, doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM asked JOIN known USING (term) JOIN held USING (term) JOIN lengths USING (r)
      GROUP BY i, item_id, r, doc_id)
    SELECT item_id,
           row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
           doc_id, score
    FROM scored WHERE score > 0
    QUALIFY rank <= 10
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
