"""The corpus operators as queries over the synthetic tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontamination, language, licenses, mixing, sharding, simhash, tokens, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed values of the URL query: action, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "slot", "shard")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "matches", "window", "n_hits")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "mix_group", "mix_block", "mix_slot", "mix_position")


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", "over_limit", "cut_chars")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all pages, under the models of the documents' languages."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    model = language.fit(docs)
    facts = ("declared", "text_language", "language", F.round("posterior", 6).alias("posterior"), "accepted")
    of_docs = language.identify(language.document_evidence(docs), model).select(F.col("key").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), *facts)
    return of_docs.union(language.identify(language.page_evidence(pages), model).select(F.lit(None).cast("long"), F.col("key"), *facts))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_url_filter": op2_url_filter,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_tokens": op7_tokens,
    "op8_licenses": op8_licenses,
    "op9_language": op9_language,
    "op10_ann": op10_ann,
}


def _sharding_sql() -> str:
    """The filled table stands in the statement as two hex digits a slot; hashing and placement are SQL."""
    owner = "".join(f"{i:02x}" for i in sharding.fill_table([f"shard-{i}" for i in range(sharding.SHARDS)]))
    return f"""
        WITH s AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {sharding.TABLE_SIZE} AS slot FROM documents)
        SELECT doc_id, slot, ('0x' || substr('{owner}', CAST(slot * 2 + 1 AS INTEGER), 2))::INTEGER AS shard FROM s
    """


_URL_SQL = r"""
    WITH rules(action, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    rest AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
    parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM raw),
    hits AS (
        SELECT p.page_id, r.host || r.path AS rule, r.action, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
        FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    )
    SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.action, 'allow') AS verdict
    FROM parts p LEFT JOIN hits h ON h.page_id = p.page_id AND h.n = 1
"""

_WARC_SQL = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS f FROM d)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
        CASE WHEN n >= 1000 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 1000 AND f <> page_id THEN f END AS refers_to
    FROM m
"""

#: Words and masks as ``decontamination`` has them (windows of 12 words with 10 equal ones), with words joined where the operator hashes them.
_LEAKS_SQL = r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
    b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
    spots AS (SELECT item_id, w, len(w) < 12 AS short, unnest(range(0, CASE WHEN len(w) < 12 THEN 1 ELSE len(w) - 4 END)) AS a FROM b WHERE len(w) > 0),
    owners AS (SELECT DISTINCT item_id, short, least(a, 7) AS lead, w[a - least(a, 7) + 1 : a + 12] AS around FROM spots),
    places AS (SELECT row_number() OVER () AS place, short, lead, around FROM (SELECT DISTINCT short, lead, around FROM owners)),
    seeds AS (
        SELECT place, 0 AS n, array_to_string(around[lead + 1 : lead + 5], ' ') AS k FROM places WHERE NOT short
        UNION ALL SELECT place, 1, array_to_string(around[lead + 1 : lead + 3] || around[lead + 5 : lead + 6], ' ') FROM places WHERE NOT short AND len(around) >= lead + 6
        UNION ALL SELECT place, -len(around), array_to_string(around, ' ') FROM places WHERE short
    ),
    starts AS (SELECT r, w, unnest(range(0, len(w))) AS p FROM d WHERE len(w) > 0),
    probes AS (
        SELECT r, p, 0 AS n, array_to_string(w[p + 1 : p + 5], ' ') AS k FROM starts WHERE len(w) >= p + 5
        UNION ALL SELECT r, p, 1, array_to_string(w[p + 1 : p + 3] || w[p + 5 : p + 6], ' ') FROM starts WHERE len(w) >= p + 6
        UNION ALL SELECT r, p, -s.n, array_to_string(w[p + 1 : p + s.n], ' ') FROM starts, (SELECT DISTINCT len(around) AS n FROM places WHERE short) s WHERE len(w) >= p + s.n
    ),
    hits AS (
        SELECT d.doc_id, place, around, list_transform(range(1, len(around) + 1), lambda i: CASE WHEN p - lead + i >= 1 AND w[greatest(p - lead + i, 1)] = around[i] THEN 1 ELSE 0 END) AS equal
        FROM probes JOIN seeds USING (n, k) JOIN places USING (place) JOIN d USING (r)
    ),
    found AS (SELECT doc_id, place, least(len(around), 12) AS width, list_max(list_transform(range(1, len(equal) + 1), lambda e: list_sum(equal[greatest(e - 11, 1) : e]))) AS matches FROM hits)
    SELECT doc_id, item_id, CAST(max(matches) AS INTEGER) AS matches, CAST(max(width) AS INTEGER) AS "window", count(*) AS n_hits
    FROM found JOIN places USING (place) JOIN owners USING (short, lead, around)
    WHERE matches >= CASE WHEN width < 12 THEN width ELSE 10 END
    GROUP BY doc_id, item_id
"""


def _licenses_sql() -> str:
    """Every block of a text that has enough of a template's words, without the filters; templates stand in the statement."""
    known = ", ".join(f"({n}, '{t.label}', '{b' '.join(t.words).decode()}', {str(t.phrase).lower()}, {t.need}, {t.window})" for n, t in enumerate(licenses.templates()))
    return rf"""
        WITH t(n, label, line, phrase, need, width) AS (VALUES {known}),
        k AS (SELECT label, string_split(line, ' ') AS line, list_distinct(string_split(line, ' ')) AS own, phrase, need, width FROM t),
        d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        u AS (SELECT r, w, list_distinct(w) AS own FROM d),
        near AS (SELECT r, w, k.*, unnest(range(0, greatest(1, len(w) - width + 1))) AS place FROM u JOIN k ON len(list_intersect(u.own, k.own)) >= need),
        blocks AS (SELECT r, label, phrase, place, w[place + 1 : place + width] AS block, line, own, need FROM near),
        found AS (SELECT r, label, phrase, place, len(list_intersect(list_distinct(block), own)) AS shared, len(own) AS size, need FROM blocks WHERE NOT phrase OR block = line),
        f AS (
            SELECT r, count(*) FILTER (phrase) AS n_base, min(place) FILTER (phrase) AS first_word, max(place) FILTER (phrase) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(shared / size) AS score
            FROM found WHERE shared >= need GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
        FROM d LEFT JOIN f USING (r)
    """


ORACLE_SQL: dict[str, str] = {
    "op1_sharding": _sharding_sql(),
    "op2_url_filter": _URL_SQL,
    "op4_warc": _WARC_SQL,
    "op5_decontamination": _LEAKS_SQL,
    "op8_licenses": _licenses_sql(),
}
