"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm import (alignment, exact_dedup, html_text, langid, manifest, mixing, packing, pii, quality_gam,
                            quality_rules, simhash, toxicity, warc)
from demandlake.llm.common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule that reads all documents with temperature weights, no source more than twice."""
    return mixing.schedule(documents(spark, sf_dir)).select(
        "doc_id", "source", "tokens", "epoch", "position", "block", "weight", "exponent")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two packing of all documents into sequences of at most 2048 tokens."""
    return packing.packed(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by the pattern grammar."""
    return toxicity.query(spark, documents(spark, sf_dir), sf_dir)


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose SimHash fingerprints differ in at most 3 bits."""
    return simhash.groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers of all documents by language and source."""
    return quality_rules.judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents, dropped rows included."""
    return exact_dedup.groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base counts and spans, and the spans that the method adds."""
    base = pii.as_text(F.col("base"))
    return pii.spans(documents(spark, sf_dir)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(pii.as_text(F.col("added")), F.lit(""))).alias("spans"))


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by an additive model with pairs."""
    return quality_gam.query(spark, documents(spark, sf_dir), sf_dir)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by Kneser-Ney character models."""
    return langid.query(spark, documents(spark, sf_dir))


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle audit of all pages as WARC records in two replicas."""
    return warc.fixity(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between two tokenizers in all documents, scored by their pairs' counts in the corpus."""
    return alignment.aligned(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, and the roots folded from tampered copies."""
    return manifest.audit(documents(spark, sf_dir))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_neardup": op4_simhash_neardup,
    "op5_quality_rules": op5_quality_rules,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pii": op7_pii,
    "op8_quality_gam": op8_quality_gam,
    "op9_langid": op9_langid,
    "op10_warc_fixity": op10_warc_fixity,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_html_text": op13_html_text,
}

_RECORD = """'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR
    || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""



def _manifest_sql(levels: int = 6, source_levels: int = 3) -> str:
    """The manifest with its levels spelt out: up to 16 ** levels rows a source and 16 ** source_levels sources."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))) + ")"

    # crc32 of the decimal doc_id: each character, then eight shifts.
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda ch: list_concat([ascii(ch)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def climb(name: str, start: str, key: str, top: int) -> tuple[list[str], str]:
        """Levels name0 to name<top> over start(key, node, n, hash), and the last one."""
        found = [f"{name}0 AS (SELECT {key}, node, n, hash FROM {start})"]
        for k in range(1, top + 1):
            found.append(f"{name}g{k} AS (SELECT {key}, node // 16 AS node, any_value(n) AS n, list(hash ORDER BY node) AS run "
                         f"FROM {name}{k - 1} GROUP BY {key}, node // 16)")
            found.append(f"{name}{k} AS (SELECT {key}, node, (n + 15) // 16 AS n, "
                         f"CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS hash FROM {name}g{k})")
        return found, f"{name}{top}"

    def fold(name: str, start: str, key: str, top: int, position: str) -> tuple[list[str], str]:
        """Follow position through the runs of name: proof grows, folded is hashed on."""
        found, last = [], start
        for k in range(1, top + 1):
            slot = f"l.{position} // {16 ** (k - 1)} % 16"
            left, right = f"array_to_string(g.run[1:{slot}], '')", f"array_to_string(g.run[{slot} + 2:], '')"
            found.append(f"{start}{name}{k} AS (SELECT l.* REPLACE (CASE WHEN g.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof, "
                         f"CASE WHEN g.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded) FROM {last} l "
                         f"JOIN {name}g{k} g ON g.{key} IS NOT DISTINCT FROM l.{key} AND g.node = l.{position} // {16 ** k})")
            last = f"{start}{name}{k}"
        return found, last

    up, top = climb("s", "placed", "source", levels)
    over, root = climb("r", "sources", "tree", source_levels)
    within, last = fold("s", "begun", "source", levels, "node")
    above, end = fold("r", "halfway", "tree", source_levels, "source_node")
    return ", ".join([
        f"WITH leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(f'translate(text, {letters})')} END AS changed FROM documents)",
        "placed AS (SELECT *, leaf AS hash, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS node, "
        "count(*) OVER (PARTITION BY source) AS n FROM leaves)", *up,
        "sources AS (SELECT 0 AS tree, source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS node, "
        f"count(*) OVER () AS n FROM {top})", *over,
        "begun AS (SELECT doc_id, source, leaf, node, '' AS proof, coalesce(changed, leaf) AS folded FROM placed)", *within,
        f"halfway AS (SELECT l.*, s.tree, s.node AS source_node, s.hash AS subroot FROM {last} l JOIN sources s ON s.source IS NOT DISTINCT FROM l.source)",
        *above]) + f""" SELECT doc_id, leaf, subroot, t.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.hash AS verified
        FROM {end} l JOIN {root} t ON t.tree = l.tree"""


ORACLE_SQL = {
    "op12_merkle_manifest": _manifest_sql(),
    "op10_warc_fixity": f"""
        WITH own AS (SELECT page_id, url, html, {_RECORD} AS r FROM pages),
        bad AS (SELECT page_id, url, sha256(r) AS own_sha,
                       CASE WHEN sha256(r)[1:2] = 'a7' AND length(html) > 0 THEN '~' || html[2:] ELSE html END AS html FROM own),
        rec AS (SELECT 1 AS replica, page_id, url, strlen(r) AS length, sha256(r) AS record_sha256 FROM own
                UNION ALL SELECT 2, page_id, url, strlen({_RECORD}), sha256({_RECORD}) FROM bad),
        leaf AS (SELECT *, coalesce(floor(page_id / 1024.0)::BIGINT, -1) AS file_id FROM rec),
        placed AS (SELECT *, row_number() OVER w - 1 AS position,
                          coalesce(sum(length) OVER (PARTITION BY replica, file_id ORDER BY page_id, url, record_sha256
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
                   FROM leaf WINDOW w AS (PARTITION BY replica, file_id ORDER BY page_id, url, record_sha256)),
        l0 AS (SELECT replica, file_id, position AS node,
                      sha256("offset"::VARCHAR || ':' || length::VARCHAR || ':' || record_sha256) AS hash FROM placed),
        l1 AS (SELECT replica, file_id, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l0 GROUP BY ALL),
        l2 AS (SELECT replica, file_id, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l1 GROUP BY ALL),
        l3 AS (SELECT replica, file_id, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l2 GROUP BY ALL)
        SELECT a.page_id, a.file_id, a.position, a."offset", a.length, a.record_sha256, x.hash AS root, y.hash AS replica_root,
               p.hash IS DISTINCT FROM q.hash AS differs
        FROM placed a JOIN l0 p ON p.replica = 1 AND p.file_id = a.file_id AND p.node = a.position
        LEFT JOIN l0 q ON q.replica = 2 AND q.file_id = a.file_id AND q.node = a.position
        JOIN l3 x ON x.replica = 1 AND x.file_id = a.file_id JOIN l3 y ON y.replica = 2 AND y.file_id = a.file_id
        WHERE a.replica = 1""",
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
                   FROM documents),
             g AS (SELECT doc_id, text_sha256,
                          first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
                          count(*) OVER (PARTITION BY text_sha256) AS group_size
                   FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
}
