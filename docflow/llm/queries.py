"""The registered queries of the operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import centroid_clusters
from .edited import edited_fingerprints
from .hilbert import vector_codes
from .kdtree import top_k
from .licenses import scan_licenses
from .linededup import dedup_lines
from .packing import pack_documents
from .pieces import decode, encode
from .simhash import near_duplicates
from .styletree import extract_main_text
from .tokencount import token_counts
from .toxicity import toxicity
from .warc import audit, record_text


def _t(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; labels of the held-out third are never learnt from."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, _t(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scanned with all rules."""
    scanned = scan_licenses(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, by the byte-level BPE vocabulary of 50,257 entries."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after later copies of repeated runs of 50 words or more are deleted."""
    cut = dedup_lines(_t(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50)
    text = F.coalesce("text", F.lit(""))
    return cut.select(
        "doc_id", "n_lines", "n_deleted", F.length(text).cast("long").alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256")
    )


def op5_piece_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 best segmentations of every whole text, decoded again."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = decode(encode(docs, model, n=3), model)
    same = F.sha2(F.col("text").cast("binary"), 256) == F.col("text_sha256")
    return back.select("doc_id", "rank", "score", "n_pieces", "ids_sha256", same.alias("round_trip"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    return near_duplicates(_t(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, max_bits=4)


def op7_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, audited against a replica in which the records of
    some pages are altered (first character) and others are lost."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url", "html")
    altered = F.when(F.col("page_id") % 101 == 7, F.concat(F.lit("#"), F.substr("html", F.lit(2)))).otherwise(F.col("html"))
    replica = pages.where(~(F.col("page_id") % 211).eqNullSafe(F.lit(3))).withColumn("html", altered)
    number, record = F.col("page_id").alias("number"), record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("record")
    return audit(pages.select(number, record), replica.select(number, record))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every whole text and of its edited copy, and their likeness."""
    return edited_fingerprints(_t(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes packed into sequences of 2,048, 4,096 or 8,192."""
    return pack_documents(_t(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows by integer inner product for every 50th vector."""
    vectors = _t(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's product code of 16 parts, codebooks of 64 entries, 2 rounds."""
    return vector_codes(_t(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's article, by its site's style tree."""
    return extract_main_text(_t(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after 10 rounds of 8 centroids."""
    return centroid_clusters(_t(spark, sf_dir, "embeddings"), k=8, rounds=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_line_dedup": op4_line_dedup,
    "op5_piece_segmentation": op5_piece_segmentation,
    "op6_simhash": op6_simhash,
    "op7_fixity_audit": op7_fixity_audit,
    "op8_fingerprints": op8_fingerprints,
    "op9_packing": op9_packing,
    "op10_top_k": op10_top_k,
    "op11_vector_codes": op11_vector_codes,
    "op12_html_extraction": op12_html_extraction,
    "op13_centroids": op13_centroids,
}

#: Numbers of SQL that mean the same in every round.
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_AWAY = "CAST(list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
_FLOOR = "(s - ((s % n) + n) % n) // n"


def _scaled(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    steps = [
        f"v AS (SELECT vec_id, label, {_scaled(256)} AS q FROM embeddings WHERE {_FINITE})",
        f"""x AS MATERIALIZED (
            SELECT vec_id, label, p, q[p * (len(q) // {parts}) + 1 : (p + 1) * (len(q) // {parts})] AS q FROM v, range({parts}) t(p))""",
        f"c0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, q AS m FROM x QUALIFY e < {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, label, p, any_value(q) AS q, min(d * 1024 + e) AS k
            FROM (SELECT x.*, e, {_AWAY} AS d FROM x JOIN c{r} USING (p)) GROUP BY vec_id, label, p)""")
        if r < rounds:
            steps.append(f"""n{r} AS (
                SELECT p, e, list({_FLOOR} ORDER BY i) AS m
                FROM (SELECT p, k % 1024 AS e, i, CAST(sum(q[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, LATERAL (SELECT unnest(range(1, len(q) + 1)) AS i) GROUP BY ALL)
                GROUP BY p, e)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(n{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN n{r} USING (p, e))")
    return "WITH " + ", ".join(steps) + f""",
        h AS (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}),
        o AS (
            SELECT vec_id, label, string_agg(printf('%02x', CAST(k % 1024 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(k // 1024) AS BIGINT) AS error
            FROM a{rounds} GROUP BY vec_id, label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o, h"""


def _clusters_sql(k: int, rounds: int) -> str:
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, {_scaled(1024)} AS q FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q AS m FROM v QUALIFY c < {k})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, any_value(q) AS q, min(d * {k} + c) AS k FROM (SELECT v.*, c, {_AWAY} AS d FROM v, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""n{r} AS (
                SELECT c, list({_FLOOR} ORDER BY i) AS m
                FROM (SELECT k % {k} AS c, i, CAST(sum(q[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY ALL) GROUP BY c)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN n{r} USING (c))")
    return "WITH " + ", ".join(steps) + f"""
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, k // {k} AS distance, CAST(sum(k // {k}) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(k // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c = k % {k}"""


ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM d),
        w AS (SELECT doc_id, no, regexp_extract_all(line, '[^\x09-\x0D\x20]+') AS words FROM l),
        s AS (
            SELECT doc_id, no, array_to_string(words, ' ') AS line, len(words) AS n,
                   row_number() OVER o AS p, sum(len(words)) OVER o AS total
            FROM w WHERE len(words) > 0 WINDOW o AS (PARTITION BY doc_id ORDER BY no)),
        a AS (SELECT doc_id, list(line ORDER BY p) AS seq FROM s GROUP BY doc_id),
        r AS (
            SELECT x.doc_id, x.p, y.p AS q, array_to_string(seq[x.p : y.p], chr(10)) AS run
            FROM s x JOIN s y ON x.doc_id = y.doc_id AND y.p >= x.p AND y.p < x.p + 50 JOIN a ON a.doc_id = x.doc_id
            WHERE y.total - x.total + x.n >= 50 AND (y.total - y.n - x.total + x.n < 50 OR y.total - x.total < 50)),
        f AS (SELECT *, min((doc_id, p)) OVER (PARTITION BY run) AS first FROM r),
        g AS (SELECT DISTINCT doc_id, unnest(range(p, q + 1)) AS p FROM f WHERE (doc_id, p) <> first),
        k AS (
            SELECT l.doc_id, count(g.p) AS n_deleted, count(*) AS n_lines,
                   coalesce(string_agg(CASE WHEN g.p IS NULL THEN l.line END, chr(10) ORDER BY l.no), '') AS kept
            FROM l LEFT JOIN s USING (doc_id, no) LEFT JOIN g ON g.doc_id = l.doc_id AND g.p = s.p GROUP BY l.doc_id)
        SELECT doc_id, n_lines, n_deleted, CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM k""",
    "op7_fixity_audit": r"""
        WITH p AS (
            SELECT page_id, url, html, CASE WHEN page_id % 101 = 7 THEN '#' || substr(html, 2) ELSE html END AS changed FROM pages),
        t AS (
            SELECT page_id, 'WARC/1.0' || n || 'WARC-Type: resource' || n || 'WARC-Record-ID: <urn:page:' || page_id || '>' || n
                   || 'WARC-Date: 2024-01-01T00:00:00Z' || n || 'WARC-Target-URI: ' || url || n || 'Content-Type: text/html' || n
                   || 'Content-Length: ' AS head, html, changed, n || n AS gap
            FROM p, (SELECT chr(13) || chr(10) AS n)),
        r AS (
            SELECT 'a' AS side, page_id, head || strlen(html) || gap || html || gap AS rec FROM t
            UNION ALL SELECT 'b', page_id, head || strlen(changed) || gap || changed || gap FROM t WHERE page_id % 211 <> 3),
        o AS (
            SELECT side, page_id, page_id // 1024 AS archive, strlen(rec) AS length, sha256(rec) AS sha256,
                   coalesce(sum(strlen(rec)) OVER (PARTITION BY side, page_id // 1024 ORDER BY page_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
            FROM r)
        SELECT a.page_id AS number, CASE WHEN b.sha256 IS NULL THEN 'missing' ELSE 'altered' END AS kind, a.archive,
               CAST(a."offset" AS BIGINT) AS offset_a, CAST(a.length AS BIGINT) AS length_a, a.sha256 AS sha256_a,
               CAST(b."offset" AS BIGINT) AS offset_b, CAST(b.length AS BIGINT) AS length_b, b.sha256 AS sha256_b
        FROM (SELECT * FROM o WHERE side = 'a') a LEFT JOIN (SELECT * FROM o WHERE side = 'b') b USING (page_id)
        WHERE a.sha256 IS DISTINCT FROM b.sha256""",
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_vector_codes": _codes_sql(parts=16, entries=64, rounds=2),
    # the given tables' pages hold their text in one article element of headings and paragraphs
    "op12_html_extraction": r"""
        WITH a AS (
            SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>') AS parts FROM pages),
        u AS (
            SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                   regexp_replace(x, '<[^>]+>', ' ', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) AS parts FROM a),
        b AS (
            SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''),
                   chr(10) || chr(10)) AS text FROM u)
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM b""",
    "op13_centroids": _clusters_sql(k=8, rounds=10),
}
