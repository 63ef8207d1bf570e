"""Registered queries of the corpus operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm._io import fold_of, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.secrets import listed, scan

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of("assign", "access", "hex")
    found = scan(table(spark, sf_dir, "documents"))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.toxicity import ToxicityModel

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ToxicityModel.fit(docs, table(spark, sf_dir, "labels")).apply(docs)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.fingerprint import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.exact_dedup import decide

    out = decide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.lm_score import score

    return score(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.minhash import near_groups

    out = near_groups(table(spark, sf_dir, "documents"), width=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.mixing import assign

    out = assign(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = F.col("_copies") * F.col("_size") + F.col("_part")
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docframe.llm.quality import QualityModel

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = QualityModel.fit(docs, table(spark, sf_dir, "labels")).apply(docs)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_minhash": op6_minhash,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
}

# The rules of op1 as patterns of the other engine, in the order in which equal starts are listed, and what a match
# (v) must fulfil.
_SECRETS = (
    ("assign", """(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "length(regexp_extract(v, '{re}', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(v) >= 20"), ("hex", "[0-9a-f]+", "length(v) >= 24"), ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "TRUE"),
    ("git_token", "gh[opsu]_[A-Za-z0-9]+", "length(v) >= 40"), ("web_token", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "length(v) >= 40"),
)
_MATCHES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT doc_id, {i} AS rule, '{kind}' AS kind, unnest(m) AS v, unnest(list_transform(range(1, len(m) + 1), lambda i: length(array_to_string(p[1:i], '')) + length(array_to_string(m[1:i-1], '')))) AS s "
    f"FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM d)) WHERE {test.replace('{re}', pattern)}"
    for i, (kind, pattern, test) in enumerate(_SECRETS)
)

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), x AS ({_MATCHES}),
        g AS (SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
                     string_agg(kind || ':' || s || ':' || (s + length(v)), ',' ORDER BY s, rule) FILTER (rule < 3) AS base, string_agg(kind || ':' || s || ':' || (s + length(v)), ',' ORDER BY s, rule) AS spans FROM x GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
    """,
    "op6_minhash": """
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END)) AS items FROM w),
        c AS (SELECT doc_id, items, min(doc_id) OVER (PARTITION BY items) AS first_id FROM s),
        u AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM c WHERE doc_id = first_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS common FROM u a JOIN u b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (total - common) UNION SELECT b, a FROM p WHERE 100 * common >= 80 * (total - common)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM c WHERE doc_id = first_id UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
        SELECT doc_id, len(items)::BIGINT AS n_shingles, CASE WHEN len(items) = 0 THEN doc_id ELSE component_id END AS component_id, CASE WHEN len(items) = 0 THEN TRUE ELSE doc_id = component_id END AS kept FROM c JOIN m ON a = first_id
    """,
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
        q AS (SELECT *, octet_length(encode(html)) >= 100 AND page_id <> first_id AS again FROM p)
        SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to FROM q
    """,
    "op8_mixing": """
        WITH d AS (SELECT doc_id, source, substr(md5('8:' || coalesce(doc_id::VARCHAR, '')), 1, 3) AS bucket,
                          coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w,
                     source_size * 3.0::DOUBLE AS cap FROM s),
        l AS (SELECT *, ((SELECT sum(source_size) FROM r)::DOUBLE
                     - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
        t AS (SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM l WHERE level <= cap / w), 'inf'::DOUBLE) * w) AS target FROM l),
        b AS (SELECT source, bucket, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
        p AS (SELECT b.source, bucket, source_size, target, words,
                     CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
                     coalesce(sum(words) OVER (PARTITION BY b.source ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
              FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source),
        q AS (SELECT *, CASE WHEN words > 0 THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, (target - (whole * source_size)::DOUBLE - before::DOUBLE) / words)) ELSE 0 END AS share FROM p)
        SELECT doc_id, size, q.source_size, q.target,
               (whole * size + CASE WHEN share >= 1 THEN size ELSE floor(size * share + 0.5)::BIGINT END)::BIGINT AS taken
        FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source AND d.bucket = q.bucket
    """,
}
