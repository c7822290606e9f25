"""The queries of this subpackage and, where SQL can tell their rows, that SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import centroids, conversations, decontaminate, exact_dedup, html_text, jaccard_join, language_id, licenses, neighbours, packing, pii, token_files, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(_read(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_token_files(token_files.write_token_files(_read(spark, sf_dir, "documents")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(_read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(_read(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.described(*centroids.cluster(_read(spark, sf_dir, "embeddings"))).withColumnRenamed("id", "vec_id")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.duplicates(spark, f"{sf_dir}/documents.parquet")
    return rows.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


QUERIES = {f.__name__: f for f in (op1_pii, op2_neighbours, op3_language_id, op4_decontaminate, op5_jaccard_join, op6_packing, op7_token_files, op8_warc, op9_licences, op10_html_text, op11_conversations, op12_centroids, op13_exact_dedup)}

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

#: CRC-32 of a text by its bits: a byte is mixed in, then eight shifts (-1) follow.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length({0}) + 1), lambda i: [CAST(ascii(substr({0}, i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
#: States before and after insertions, their number, and the lines inserted. States: 0 nothing, 1 system, 2 user, 3 assistant.
_INSERTS = "(VALUES (0, 0, 0, ''), (0, 1, 2, 'user:'), (0, 2, 3, 'user:\nassistant:'), (1, 0, 1, ''), (1, 1, 2, 'user:'), (1, 2, 3, 'user:\nassistant:'), (2, 0, 2, ''), (2, 1, 3, 'assistant:'), (3, 0, 3, ''), (3, 1, 2, 'user:')) ins(q, n, to_q, lines)"
_REPAIR = f"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS how FROM conversations),
hurt AS (
    SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy
    FROM base WHERE how <> 0
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i FROM hurt),
seen AS (
    SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 't' ELSE 'o' END AS fault
    FROM placed
),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM seen),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM pairs GROUP BY conv_id
),
found(conv_id, i, q, w) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'fix': ''}} FROM conversations
    UNION ALL
    SELECT conv_id, i, q, min(w) FROM (
        SELECT f.conv_id, s.i, e.q, {{'cost': f.w.cost + 3 * ins.n + e.cost, 'audit': f.w.audit || repeat('I', ins.n) || e.edit, 'fix': concat_ws(chr(10), nullif(f.w.fix, ''), nullif(ins.lines, ''), e.line)}} AS w
        FROM found f JOIN seen s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i + 1 JOIN {_INSERTS} ON ins.q = f.q,
        LATERAL (
            SELECT ins.to_q AS q, 4 AS cost, 'D' AS edit, NULL AS line
            UNION ALL SELECT CASE s.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE s.fault WHEN 't' THEN 3 ELSE 0 END, 'K', s.role || ':' || s.text
            WHERE s.fault IN ('t', 'o') AND (s.initial = 's' AND ins.to_q = 0 OR s.initial = 'u' AND ins.to_q <> 2 OR s.initial = 'a' AND ins.to_q = 2)
            UNION ALL SELECT CASE ins.to_q WHEN 2 THEN 3 ELSE 2 END, CASE s.fault WHEN 't' THEN 6 ELSE 3 END, 'R', CASE ins.to_q WHEN 2 THEN 'assistant:' ELSE 'user:' END || s.text WHERE s.fault IN ('t', 'o')
        ) e
    ) GROUP BY ALL
),
ends AS (
    SELECT f.conv_id, min({{'cost': f.w.cost + 3 * ins.n, 'audit': f.w.audit || repeat('I', ins.n), 'fix': concat_ws(chr(10), nullif(f.w.fix, ''), nullif(ins.lines, ''))}}) AS w
    FROM found f LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM f.conv_id JOIN {_INSERTS} ON ins.q = f.q WHERE f.i = coalesce(c.n, 0) AND ins.to_q IN (0, 3) GROUP BY f.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, w.cost AS cost, w.audit AS audit, sha256(w.fix) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    floored = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    parts = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept ORDER BY c LIMIT {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS m FROM (SELECT r, c, CAST(list_sum(list_transform(range(1, 65), lambda j: (kept.v[j] - c{i}.v[j]) * (kept.v[j] - c{i}.v[j]))) AS BIGINT) AS d FROM kept, c{i}) GROUP BY r)")
        if i < rounds:
            parts.append(f"m{i} AS (SELECT c, list({floored} ORDER BY j) AS v FROM (SELECT m.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{i} JOIN kept USING (r), range(1, 65) t(j) GROUP BY m.c, j) GROUP BY c)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cc.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} cc ON cc.c = a.m.c
"""


SQL: dict[str, str] = {
    "op11_conversations": _REPAIR,
    "op12_centroids": _centroid_sql(),
    "op13_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
""",
    "op4_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
places AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))
),
found AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, gram)),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
""",
    "op8_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
    SELECT *, max(page_id) OVER (PARTITION BY hex) AS response,
           array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(hex, 1 + 5 * (j // 4), 5) AS BIGINT) >> (5 * (3 - j % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
    FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM named
""",
}
