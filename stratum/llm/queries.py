"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import documents, ship
from stratum.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", end_id=2, capacity=4096)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.lines import dedup_lines
    found = dedup_lines(_table(spark, sf_dir, "documents"), min_chars=40)
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op3_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.simple8b import read_token_files, write_token_files
    docs = _table(spark, sf_dir, "documents")
    path = shared_dir(spark, "token-files")
    write_token_files(docs, path, tokenizer="byte_bpe_50k.json", end_id=0)
    return read_token_files(spark.read.parquet(path))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.topk import top_k
    return top_k(_table(spark, sf_dir, "embeddings"), k=10, scale=1024.0, every=100)


def op5_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.classify import resample
    scored, keep = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", "log_weight", "key", keep.alias("kept"))


def op6_column_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.substrings import remove_repeats
    found = remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.neardup import near_vectors
    found = near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.mixing import mix
    found = mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op9_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.simhash import simhash_components
    ship(spark)
    found = simhash_components(documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.chunks import dedup_chunks
    return dedup_chunks(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.token_counts import count_tokens
    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", limit=2048)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.trie import prefix_trie, shared_openings
    return prefix_trie(shared_openings(_table(spark, sf_dir, "conversations"), every=5, most=9))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.merkle import manifest
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], group="lang", order="doc_id",
                    changed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, tampered=tampered)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_cost_packing, op2_line_dedup, op3_simple8b_tokens, op4_exact_topk, op5_quality_resampling, op6_column_bwt_dedup,
    op7_embedding_neardup, op8_pivotal_mix, op9_simhash_neardup, op10_chunk_dedup,
    op11_token_counts, op12_prefix_trie, op13_merkle_manifest)}

# --- the same results in DuckDB's SQL, where SQL can express them ------------------------------

_VALID = """embedding IS NOT NULL AND NOT list_contains(list_transform(embedding,
              lambda x: x IS NULL OR isnan(x) OR isinf(x)), true)"""

_ISLANDS = """
    m AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a, b) AS island FROM m),
    runs AS (SELECT doc_id, island, min(a) AS a, max(b) AS b FROM g GROUP BY 1, 2),
    per AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS runs FROM runs GROUP BY 1)"""

# Unsigned CRC-32 of a column of ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({0}) + 1),
      lambda i: [CAST(ascii(substr({0}, CAST(i AS INTEGER), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""


def _leaf_sql(n_chars: str) -> str:
    cols = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in cols) + ")"


SQL: dict[str, str] = {
    "op2_line_dedup": f"""
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    s AS (SELECT *, upto - length(line) AS before FROM (
            SELECT doc_id, i, line, CAST(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto
            FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d))),
    -- the least run of 40 characters from every line on, and up to every line: what any longer run consists of
    w AS (SELECT doc_id, a, b, lines[a + 1:b] AS run FROM d JOIN (
            SELECT s.doc_id, s.i - 1 AS a, e.i AS b FROM s
            ASOF JOIN (SELECT doc_id, upto, min(i) AS i FROM s GROUP BY ALL) e ON e.doc_id = s.doc_id AND s.before + 40 <= e.upto
            UNION SELECT s.doc_id, e.i - 1, s.i FROM s
            ASOF JOIN (SELECT doc_id, before, max(i) AS i FROM s GROUP BY ALL) e ON e.doc_id = s.doc_id AND s.upto - 40 >= e.before) USING (doc_id)),
    f AS (SELECT run, min((doc_id, a)) AS first FROM w GROUP BY run HAVING count(*) > 1),
    spans AS (SELECT doc_id, a, b FROM w JOIN f USING (run) WHERE (doc_id, a) <> first),
    {_ISLANDS}
    SELECT doc_id, coalesce(len(lines), 0) AS n_lines,
      CAST(coalesce(list_sum(list_transform(runs, lambda r: r.b - r.a)), 0) AS BIGINT) AS n_removed,
      CASE WHEN runs IS NULL THEN text ELSE array_to_string(list_filter(lines, lambda x, i:
           NOT list_contains(list_transform(runs, lambda r: i - 1 >= r.a AND i - 1 < r.b), true)), chr(10)) END AS text
    FROM d LEFT JOIN per USING (doc_id)""",
    "op6_column_bwt_dedup": f"""
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (
            SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
    f AS (SELECT s, min((doc_id, i)) AS first FROM w GROUP BY s HAVING count(*) > 1),
    spans AS (SELECT doc_id, i AS a, i + 100 AS b FROM w JOIN f USING (s) WHERE (doc_id, i) <> first),
    {_ISLANDS}
    SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(list_sum(list_transform(runs, lambda r: r.b - r.a)), 0) AS BIGINT) AS n_removed,
      coalesce(len(runs), 0) AS n_spans,
      sha256(unhex(CASE WHEN runs IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(runs) + 1), lambda j:
        substr(h, 2 * coalesce(runs[j].b, 0) + 1, 2 * (coalesce(runs[j + 1].a, length(h) // 2) - coalesce(runs[j].b, 0)))), '') END)) AS kept_sha256
    FROM d LEFT JOIN per USING (doc_id)""",
    "op4_exact_topk": f"""
    WITH v AS (SELECT vec_id, row_number() OVER () AS rid,
                      list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings WHERE {_VALID}),
    s AS (SELECT q.vec_id AS query_id, q.rid, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s) WHERE n <= 10""",
    "op7_embedding_neardup": f"""
    WITH RECURSIVE n AS (SELECT vec_id, row_number() OVER () AS rid, embedding, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    u AS (SELECT rid, vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e
          FROM n WHERE {_VALID} AND list_contains(list_transform(e, lambda x: x <> 0), true)),
    l AS (SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e)
          AND list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) >= 0.9),
    r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT r.a, min(v.vec_id) AS m FROM r JOIN n v ON v.rid = r.b GROUP BY r.a),
    k AS (SELECT a, count(*) AS k FROM l GROUP BY a)
    SELECT vec_id, coalesce(k, 0) AS n_links, least(coalesce(m, vec_id), vec_id) AS component_id,
           least(coalesce(m, vec_id), vec_id) = vec_id AS kept
    FROM n LEFT JOIN c ON c.a = rid LEFT JOIN k ON k.a = rid""",
    "op12_prefix_trie": f"""
    WITH RECURSIVE t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL),
    v AS (SELECT c, n, c - c % 5 AS base, {_CRC.format("s")} % 9 AS h FROM (SELECT c, count(*) AS n, CAST(c AS VARCHAR) AS s FROM t GROUP BY c)),
    l AS (SELECT v.c, v.base, v.h, least(v.h, coalesce(b.n, 0)) AS k, least(v.h, coalesce(b.n, 0)) + greatest(v.n - v.h, 0) AS len
          FROM v LEFT JOIN v b ON b.c = v.base),
    r AS (SELECT c, i - h + k AS d, role, text FROM t JOIN l USING (c) WHERE i > h
          UNION ALL SELECT l.c, i, role, text FROM l JOIN t ON t.c = l.base AND i <= k),
    p(c, d, s, b) AS (SELECT c, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT) FROM l
          UNION ALL SELECT p.c, r.d, sha256(s || strlen(role) || ':' || role || text), strlen(text) FROM p JOIN r ON r.c = p.c AND r.d = p.d + 1),
    o AS (SELECT c, d, b, min(c) OVER w AS o, count(*) OVER w AS m FROM p WINDOW w AS (PARTITION BY d, s)),
    a AS (SELECT *, lag(o) OVER (PARTITION BY c ORDER BY d) AS up FROM o),
    n AS (SELECT c, d, b, m, up FROM a WHERE o = c),
    k AS (SELECT up AS c, d - 1 AS d, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL),
    x AS (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN k USING (c, d)),
    u AS (SELECT o.o AS c, o.d, sum(CASE WHEN x.k = 0 THEN 1 ELSE 0 END) AS leaves, sum((x.m - 1) * x.b) AS saved
          FROM x JOIN o ON o.c = x.c AND o.d <= x.d GROUP BY ALL),
    e AS (SELECT o.o AS c, o.d, string_agg(CAST(o.c AS VARCHAR), ',' ORDER BY o.c) AS ends FROM o JOIN l ON l.c = o.c AND l.len = o.d GROUP BY ALL)
    SELECT c AS conv_id, d AS depth, up AS parent_conv_id, m AS n_convs, k AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
      CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
    FROM x JOIN u USING (c, d) LEFT JOIN e USING (c, d)""",
    "op13_merkle_manifest": f"""
    WITH RECURSIVE d AS (SELECT *, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} AS other,
             {_CRC.format("s")} % 7 = 0 AS hit, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
             FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)),
    r AS (SELECT doc_id, g, leaf, CASE WHEN hit THEN other ELSE leaf END AS given,
             row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
    lo(g, level, i, h, n) AS (SELECT g, 0, i, leaf, count(*) OVER (PARTITION BY g) FROM r
          UNION ALL SELECT g, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM lo WHERE n > 1 GROUP BY g, level, i // 2, n),
    sub AS (SELECT g, level AS height, h AS subroot FROM lo WHERE n = 1),
    hi(level, i, h, n) AS (SELECT 0, g, subroot, count(*) OVER () FROM sub
          UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM hi WHERE n > 1 GROUP BY level, i // 2, n),
    top AS (SELECT level AS height, h AS root FROM hi WHERE n = 1),
    steps AS (SELECT doc_id, r.g, r.i, r.leaf, s.level AS step, r.i >> s.level AS pos, lo2.h AS other
              FROM r JOIN sub USING (g) CROSS JOIN LATERAL (SELECT unnest(range(0, height)) AS level) s
              LEFT JOIN lo lo2 ON lo2.g = r.g AND lo2.level = s.level AND lo2.i = xor(r.i >> s.level, 1)
              UNION ALL
              SELECT doc_id, r.g, r.i, r.leaf, sub.height + s.level, r.g >> s.level, hi2.h
              FROM r JOIN sub USING (g) CROSS JOIN (SELECT unnest(range(0, (SELECT height FROM top))) AS level) s
              LEFT JOIN hi hi2 ON hi2.level = s.level AND hi2.i = xor(r.g >> s.level, 1)),
    proofs AS (SELECT g, i, sha256(string_agg(coalesce(other, ''), '' ORDER BY step)) AS proof,
                      list({{'pos': pos, 'other': other}} ORDER BY step) AS path FROM steps GROUP BY g, i),
    folded AS (SELECT r.*, coalesce(proof, sha256('')) AS proof_sha256,
                 list_reduce(list_concat([{{'pos': CAST(0 AS BIGINT), 'other': given}}], coalesce(path, [])),
                   lambda a, b: {{'pos': CAST(0 AS BIGINT), 'other': sha256(CASE WHEN b.other IS NULL THEN a.other
                     WHEN b.pos & 1 = 1 THEN b.other || a.other ELSE a.other || b.other END)}}).other AS folded_root
               FROM r LEFT JOIN proofs USING (g, i))
    SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
    FROM folded JOIN sub USING (g) CROSS JOIN top""",
}
