"""Registered queries of the corpus operators: each applies one with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.bpe import round_trip
from tidewatch.llm.common import read_documents
from tidewatch.llm.embedding_dedup import embedding_classes
from tidewatch.llm.exact_dedup import duplicate_groups
from tidewatch.llm.filter_audit import audit_filters
from tidewatch.llm.langid import identify_languages
from tidewatch.llm.merkle import manifest, proof_digest
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.pii import find_personal_data, personal_data_digest
from tidewatch.llm.quality import METRICS, judge_documents
from tidewatch.llm.secrets import scan_secrets, secret_digest
from tidewatch.llm.sharding import shard_documents
from tidewatch.llm.simhash import near_duplicates
from tidewatch.llm.token_files import token_file_digests, write_token_files
from tidewatch.session import scratch_path

SHARDS = 16


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(read_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), 2048, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(read_documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"))
    return token_file_digests(spark, path)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(read_documents(spark, sf_dir)))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(find_personal_data(read_documents(spark, sf_dir)))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = {s: 1.0 for s in range(SHARDS + 1)}
    placed = shard_documents(read_documents(spark, sf_dir), {s: even[s] for s in range(SHARDS)}, even)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(read_documents(spark, sf_dir))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(read_documents(spark, sf_dir)).select(
        "doc_id", "n_words", *[m for m in METRICS if m != "n_words"], "base_failed", "kept"
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return proof_digest(manifest(read_documents(spark, sf_dir), tampered=tampered))


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_secrets": op3_secrets,
    "op4_pii": op4_pii,
    "op5_sharding": op5_sharding,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_langid": op8_langid,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle": op12_merkle,
    "op13_embeddings": op13_embeddings,
}

ORACLES = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_quality": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        runs AS (
            SELECT r, i, array_to_string(w[i:i + 4], chr(1)) AS run
            FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
        twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
        inside AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
        lines AS (
            SELECT r, sum(n - 1) AS n
            FROM (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM split)
                  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line)
            GROUP BY r),
        counted AS (
            SELECT r, doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(inside.n, 0)::BIGINT AS n_repeat_words
            FROM split LEFT JOIN lines USING (r) LEFT JOIN inside USING (r)),
        based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
        hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM based WHERE source IS NOT NULL GROUP BY source),
        moments AS (
            SELECT (sum(f) + 0.5) / (sum(n) + 1) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS v, count(*) / sum(n) AS h FROM hosts),
        prior AS (
            SELECT m, CASE WHEN v - m * (1 - m) * h > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / (v - m * (1 - m) * h) - 1)) ELSE 1e6 END AS weight
            FROM moments),
        rates AS (SELECT source, (f + m * weight) / (n + weight) AS rate, n + weight AS total FROM hosts, prior),
        condemned AS (SELECT source FROM rates WHERE rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM condemned)) AS kept
        FROM based""",
    "op11_filter_audit": r"""
        WITH split AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        firsts AS (SELECT t, min(doc_id) AS first FROM split GROUP BY t),
        failed AS (
            SELECT doc_id, part,
                   (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS bits
            FROM split JOIN firsts USING (t)),
        marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        cells AS (
            SELECT part, bits, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
            FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, bits),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps AS (
            SELECT filter_order, s::INT AS step, bits[s] AS own, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
            FROM orders, range(1, 6) AS r(s)),
        met AS (
            SELECT part, filter_order, step, own, n, good, toxic, cells.bits & own > 0 AS fails, cells.bits & before > 0 AS gone, cells.bits = own AS by_itself
            FROM cells, steps),
        counted AS (
            SELECT part, filter_order, step, own, sum(n * (NOT fails AND NOT gone)::INT) AS kept, sum(n * (fails AND NOT gone)::INT) AS removed,
                   sum(n * (fails AND gone)::INT) AS redundant, sum(n * by_itself::INT) AS unique_fails,
                   sum(good * (fails AND NOT gone)::INT) AS good_lost, sum(toxic * (fails AND NOT gone)::INT) AS toxic_lost
            FROM met GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
               unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM counted""",
    "op12_merkle": r"""
        WITH RECURSIVE bytes AS (
            SELECT i, i AS c, 0 AS bit FROM range(256) AS b(i)
            UNION ALL
            SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, bit + 1 FROM bytes WHERE bit < 8),
        crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM bytes WHERE bit = 8),
        crcs AS (
            SELECT doc_id, 0 AS pos, 4294967295 AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT doc_id, pos + 1, xor(crc >> 8, crcs[(xor(crc, ascii(substr(doc_id::VARCHAR, pos + 1, 1))) & 255) + 1])
            FROM crcs, crc_table WHERE pos < strlen(doc_id::VARCHAR)),
        marked AS (SELECT doc_id FROM crcs WHERE pos = strlen(doc_id::VARCHAR) AND xor(crc, 4294967295) % 5 = 0),
        spelled AS (
            SELECT doc_id, source,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS body,
                   coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lower_body
            FROM documents),
        hashed AS (SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || lower_body) AS changed FROM spelled),
        leaves AS (
            SELECT row_number() OVER () AS k, doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n
            FROM hashed),
        tree AS (
            SELECT 0 AS level, s, r, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT level + 1, s, r // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY r)) FROM tree WHERE n > 1 GROUP BY level, s, r // 16, n),
        subroots AS (SELECT s, digest FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS level, s - 1 AS r, count(*) OVER () AS n, digest FROM subroots
            UNION ALL
            SELECT level + 1, r // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY r)) FROM top WHERE n > 1 GROUP BY level, r // 16, n),
        steps AS (
            SELECT t.s, t.level, t.r, coalesce(string_agg(o.digest, '' ORDER BY o.r) FILTER (o.r < t.r), '') AS before,
                   coalesce(string_agg(o.digest, '' ORDER BY o.r) FILTER (o.r > t.r), '') AS after
            FROM tree t JOIN tree o ON o.s = t.s AND o.level = t.level AND o.r // 16 = t.r // 16 WHERE t.n > 1 GROUP BY t.s, t.level, t.r),
        top_steps AS (
            SELECT t.level, t.r, coalesce(string_agg(o.digest, '' ORDER BY o.r) FILTER (o.r < t.r), '') AS before,
                   coalesce(string_agg(o.digest, '' ORDER BY o.r) FILTER (o.r > t.r), '') AS after
            FROM top t JOIN top o ON o.level = t.level AND o.r // 16 = t.r // 16 WHERE t.n > 1 GROUP BY t.level, t.r),
        way AS (
            SELECT k, s, 0 AS level, r, '' AS proof, CASE WHEN doc_id IN (SELECT doc_id FROM marked) THEN changed ELSE leaf END AS digest FROM leaves
            UNION ALL
            SELECT k, s, level + 1, r // 16, proof || before || after, sha256(before || digest || after) FROM way JOIN steps USING (s, level, r)),
        reached AS (SELECT k, s, arg_max(proof, level) AS proof, arg_max(digest, level) AS digest FROM way GROUP BY k, s),
        top_way AS (
            SELECT k, 0 AS level, s - 1 AS r, proof, digest FROM reached
            UNION ALL
            SELECT k, level + 1, r // 16, proof || before || after, sha256(before || digest || after) FROM top_way JOIN top_steps USING (level, r)),
        ended AS (SELECT k, arg_max(proof, level) AS proof, arg_max(digest, level) AS digest FROM top_way GROUP BY k),
        root AS (SELECT digest AS root FROM top WHERE n = 1)
        SELECT doc_id, leaf, subroots.digest AS subroot, root, sha256(proof) AS proof_sha256, ended.digest AS folded_root, ended.digest = root AS verified
        FROM leaves JOIN subroots USING (s) JOIN ended USING (k), root""",
    "op13_embeddings": """
        WITH RECURSIVE numbered AS (
            SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
        sound AS (
            SELECT *, sqrt(list_inner_product(e, e)) AS size FROM numbered
            WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
        linked AS (
            SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
            WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.93),
        reached AS (
            SELECT r, r AS s FROM numbered
            UNION
            SELECT reached.r, linked.b FROM reached JOIN linked ON linked.a = reached.s),
        least AS (SELECT reached.r, min(n.vec_id) AS component_id FROM reached JOIN numbered n ON n.r = reached.s GROUP BY reached.r),
        degrees AS (SELECT a AS r, count(*) AS n_links FROM linked GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM numbered JOIN least USING (r) LEFT JOIN degrees USING (r)""",
}
