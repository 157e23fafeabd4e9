"""The operators over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantlake.llm import (
    char_language, content_chunks, deleted_interpolation, fold_bpe, framed_ids, heap_bpe, lsh_forest, merkle_manifest, substring_levels, voronoi_join, warc,
    whitening, winnowing)
from plantlake.llm.common import documents


def op1_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return deleted_interpolation.scored(documents(spark, folder))


def op2_content_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return content_chunks.fingerprints(documents(spark, folder))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(spark, spark.read.parquet(f"{folder}/pages.parquet")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_heap_bpe_counts(spark: SparkSession, folder: str) -> DataFrame:
    return heap_bpe.token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op5_fold_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return fold_bpe.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_substring_levels(spark: SparkSession, folder: str) -> DataFrame:
    return substring_levels.deduplicated(documents(spark, folder), with_text=False)


def op7_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op8_framed_ids(spark: SparkSession, folder: str) -> DataFrame:
    return framed_ids.framed_ids(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op9_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.near_duplicates(documents(spark, folder), size=2)


def op10_char_language(spark: SparkSession, folder: str) -> DataFrame:
    return char_language.identified(documents(spark, folder))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    out = whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_voronoi_join(spark: SparkSession, folder: str) -> DataFrame:
    return voronoi_join.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    lowered = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    return merkle_manifest.manifest(docs, tampered={"text": lowered}, tampered_where=touched)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_deleted_interpolation, op2_content_chunks, op3_warc, op4_heap_bpe_counts, op5_fold_bpe, op6_substring_levels,
                            op7_winnowing, op8_framed_ids, op9_lsh_forest, op10_char_language, op11_whitening, op12_voronoi_join, op13_merkle_manifest, pipeline)}

_SPACED = "regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MARKED = f"regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"



def _merkle_sql(levels: int) -> str:
    """A tree of eights written out level by level: first per ``lang``, then over the languages. ``levels`` levels hold 8^levels nodes."""
    def part(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def tree(tag: str, source: str) -> list[str]:
        out = [f"{tag}n0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS c FROM {source})"]
        for k in range(levels):
            out.append(f"{tag}s{k} AS (SELECT g, i, coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                       f"coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tag}n{k} WHERE c > 1)")
            out.append(f"{tag}n{k + 1} AS (SELECT g, j AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, count(*) OVER (PARTITION BY g) AS c "
                       f"FROM (SELECT *, i // 8 AS j FROM {tag}n{k} WHERE c > 1) GROUP BY g, j)")
        out.append(f"{tag}root AS (" + " UNION ALL ".join(f"SELECT g, h FROM {tag}n{k} WHERE c = 1" for k in range(levels + 1)) + ")")
        return out

    def path(tag: str, start: str, at: str, group: str) -> list[str]:
        out, last = [], start
        for k in range(levels):
            out.append(f"{tag}p{k} AS (SELECT d.* REPLACE (CASE WHEN s.g IS NULL THEN f ELSE sha256(l || f || r) END AS f, proof || coalesce(l || r, '') AS proof) "
                       f"FROM {last} d LEFT JOIN {tag}s{k} s ON s.g = d.{group} AND s.i = d.{at} // {8 ** k})")
            last = f"{tag}p{k}"
        return out

    lower = _LOWER.format(text="text")
    same = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda a, d: xor(a >> 8, crc[(xor(a, d) & 255) + 1])), 4294967295)"
    # Zlib's crc32 by its table of bytes.
    ctes = ["bytes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, b: xor(c >> 1, (c & 1) * 3988292384))) AS crc)",
            f"leaf AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i, "
            f"sha256({same} || {part('text')}) AS h, CASE WHEN {crc} % 3 = 0 THEN sha256({same} || {part(lower)}) END AS t FROM documents, bytes)",
            *tree("a", "leaf"), "top AS (SELECT 0 AS g, g AS i, h FROM aroot)", *tree("b", "top"),
            "d AS (SELECT doc_id, g, i, 0 AS z, h AS leaf, coalesce(t, h) AS f, '' AS proof FROM leaf)",
            *path("a", "d", "i", "g"), *path("b", f"ap{levels - 1}", "g", "z")]
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT p.doc_id, p.leaf, aroot.h AS subroot, broot.h AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root, p.f = broot.h AS verified "
            f"FROM bp{levels - 1} p JOIN aroot ON aroot.g = p.g JOIN broot ON broot.g = 0")


SQL: dict[str, str] = {
    "op12_voronoi_join": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score FROM v q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id IS DISTINCT FROM q.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_merkle_manifest": _merkle_sql(7),
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        top AS (SELECT h, max(page_id) AS m FROM p GROUP BY h)
        SELECT page_id, strlen(html) AS payload_bytes,
            array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + (5 * i) // 4, 2))::INTEGER >> (3 - (5 * i) % 4)) & 31), 1)
                             FOR i IN range(32)], '') AS payload_digest,
            CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> m THEN m END AS refers_to
        FROM p JOIN top USING (h)""",
    "op6_substring_levels": f"""
        WITH w AS (SELECT doc_id, {_SPACED.format(text="text")} AS ws FROM documents),
        place AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w),
        win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM place),
        first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (k) WHERE m < doc_id),
        per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
            sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' '), '')) AS kept_sha256
        FROM w LEFT JOIN per USING (doc_id)""",
    "op7_winnowing": f"""
        WITH w AS (SELECT doc_id, {_MARKED.format(text="text")} AS ws FROM documents),
        item AS (SELECT item_id, {_MARKED.format(text="text")} AS ws FROM benchmark),
        need AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM item WHERE len(ws) > 0),
        wanted AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM need)),
        win AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
                FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS i FROM w, (SELECT DISTINCT n FROM need))),
        found AS (SELECT doc_id, item_id, i, n FROM win JOIN wanted USING (n, k)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op9_lsh_forest": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(text=_LOWER.format(text="text"))} AS ws FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws
                ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS g FROM w),
        n AS (SELECT doc_id, len(g) AS n_shingles, hash(list_sort(g)) AS h FROM s),
        rep AS (SELECT h, n_shingles AS n, min(doc_id) AS r FROM n WHERE n_shingles > 0 GROUP BY ALL),
        x AS (SELECT r, n, unnest(g) AS g FROM rep JOIN s ON r = s.doc_id),
        link AS (SELECT a.r AS u, b.r AS v FROM x a JOIN x b ON a.g = b.g AND a.r < b.r AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
                 GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        sides AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
        reach AS (SELECT r, r AS c FROM rep UNION SELECT reach.r, sides.v FROM reach JOIN sides ON reach.c = sides.u),
        root AS (SELECT r, min(c) AS c FROM reach GROUP BY r)
        SELECT n.doc_id, n.n_shingles, coalesce(root.c, n.doc_id) AS component_id, n.doc_id = coalesce(root.c, n.doc_id) AS kept
        FROM n LEFT JOIN rep ON n.h = rep.h AND n.n_shingles = rep.n LEFT JOIN root USING (r)""",
}
