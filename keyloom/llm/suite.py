"""Registered queries of the corpus operators, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keyloom.llm import (
    byte_bpe, edit_prints, exact_dedup, filter_audit, language_id, manifest, quality, secret_scan, simhash, source_mix, token_counts, token_files, toxicity,
)
from keyloom.llm.common import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_tables(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), keep_table=False)


@_query
def op2_language_id(spark, sf_dir):
    return language_id.identify_languages(documents(spark, sf_dir))


@_query
def op3_source_mix(spark, sf_dir):
    return source_mix.mix_sources(documents(spark, sf_dir))


@_query
def op4_toxicity(spark, sf_dir):
    return toxicity.assess_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


@_query
def op5_token_files(spark, sf_dir):
    return token_files.token_file_rows(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, stable=True)


@_query
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@_query
def op8_edit_prints(spark, sf_dir):
    return edit_prints.edit_fingerprints(documents(spark, sf_dir))


@_query
def op9_secret_scan(spark, sf_dir):
    return secret_scan.scan_secrets(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query
def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(documents(spark, sf_dir), keep=exact_dedup.LARGEST)


@_query
def op11_manifest(spark, sf_dir):
    return manifest.build_manifest(documents(spark, sf_dir))


@_query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(documents(spark, sf_dir), labels(spark, sf_dir))


@_query
def op13_quality(spark, sf_dir):
    return quality.assess_quality(documents(spark, sf_dir), labels(spark, sf_dir))


SQL["op10_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


def _manifest_sql(levels: int = 6) -> str:
    """The trees level by level: ``levels`` of them hold 16 ** levels rows a source and as many sources."""
    part = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # the checksum of the digits, a bit at a time
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k::INT) & 1)))"
    step = "xor(a >> 1, 3988292384 * (xor(a, b) & 1))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform({bits}, lambda x: x::BIGINT)), lambda a, b: {step}), 4294967295)"
    out = [
        f"leaves AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN text IS NOT NULL AND ({crc}) % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS changed FROM documents)",
        "sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM leaves))",
        "d0 AS MATERIALIZED (SELECT doc_id, tree, leaf, changed AS fold, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot "
        "FROM leaves JOIN sources ON leaves.source IS NOT DISTINCT FROM sources.source)",
        "n0 AS MATERIALIZED (SELECT tree, spot, leaf AS d FROM d0)",
    ]

    def climb(nodes: str, docs: str, k: int) -> None:
        """One level up: a tree of one node stays as it is."""
        out.append(
            f"g_{nodes}{k} AS MATERIALIZED (SELECT tree, spot // 16 AS up, string_agg(d, '' ORDER BY spot) AS run, any_value(n) AS n "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {nodes}{k}) GROUP BY ALL)"
        )
        out.append(f"{nodes}{k + 1} AS MATERIALIZED (SELECT tree, up AS spot, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS d FROM g_{nodes}{k})")
        left, right = "substr(run, 1, 64 * (spot % 16))", "substr(run, 64 * (spot % 16 + 1) + 1)"
        out.append(
            f"{docs}{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (n, up, run, spot, proof, fold), up AS spot, CASE WHEN n > 1 THEN proof || {left} || {right} ELSE proof END AS proof, "
            f"CASE WHEN n > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold "
            f"FROM (SELECT x.*, g.n, g.up, g.run FROM {docs}{k} x JOIN g_{nodes}{k} g ON x.tree = g.tree AND x.spot // 16 = g.up))"
        )

    for k in range(levels):
        climb("n", "d", k)
    out.append(f"m0 AS MATERIALIZED (SELECT 0 AS tree, tree AS spot, d FROM n{levels})")
    out.append(f"e0 AS MATERIALIZED (SELECT d{levels}.* EXCLUDE (spot, tree), 0 AS tree, s.tree AS spot, s.d AS subroot FROM d{levels} JOIN n{levels} s ON d{levels}.tree = s.tree)")
    for k in range(levels):
        climb("m", "e", k)
    return f"""WITH {', '.join(out)}
SELECT doc_id, leaf, subroot, m.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = m.d AS verified FROM e{levels} CROSS JOIN m{levels} m"""


SQL["op11_manifest"] = _manifest_sql()


SQL["op12_filter_audit"] = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), f AS (
  SELECT doc_id, part,
    (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END) AS fails
  FROM w
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), cells AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), steps AS (
  SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[:k - 1]), 0) AS before FROM orders, range(1, 6) r(k)
), counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (before + bit)::INT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & before::INT = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & before::INT <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & before::INT = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & before::INT = 0 AND fails & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""
