"""The corpus operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import clustering, common, exact_dedup, fingerprint, language_id, mixing, ngram_join, packing, sharding, snapshot, substring_dedup, token_counts, token_output, warc

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir), WORD_BPE)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(common.documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.documents(spark, sf_dir).select("doc_id", "text"), PIECES).select("doc_id", "n_words", "n_tokens")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(common.documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(common.documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(common.documents(spark, sf_dir), keep=False).select("doc_id", "bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(common.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(common.documents(spark, sf_dir))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.saved_path(spark, "ids")
    token_output.write_ids(common.documents(spark, sf_dir), path, BYTE_BPE)
    return token_output.read_ids(spark, path)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    known = language_id.learn(docs.where("not held_out"))
    return language_id.language_id(docs.select("doc_id", "held_out", "text"), known).select("doc_id", "held_out", "lang_pred", "score")


def later_snapshot(docs: DataFrame) -> DataFrame:
    """The snapshot that documents are compared with: crc32 of the decimal doc_id modulo 10 says what happened to a row."""
    kind = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    moved = -1 - F.col("doc_id")
    keys = F.when(kind.isin(3, 4), F.array(moved)).when(kind == 5, F.array(F.col("doc_id"), moved)).otherwise(F.array("doc_id"))
    return docs.where(F.coalesce(kind != 0, F.lit(True))).select(
        F.explode(keys).alias("doc_id"),
        F.when(kind == 1, F.concat(F.coalesce("text", F.lit("")), F.lit("+"))).otherwise(F.col("text")).alias("text"),
        F.when(kind == 2, F.col("source")).otherwise(F.col("lang")).alias("lang"),
        F.when(kind == 2, F.col("lang")).when(kind == 4, None).otherwise(F.col("source")).alias("source"),
    )


def op11_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return snapshot.snapshot_diff(docs, later_snapshot(docs), "doc_id", ["text", "lang", "source"])


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    path = common.saved_path(spark, "warc")
    files = warc.write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read_warc(spark, path, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sharding_64k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 with a limit that small tables exceed too."""
    return sharding.shard(common.documents(spark, sf_dir), 1 << 16, keep=False).select("doc_id", "bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")


def _sharding_sql(limit: int) -> str:
    return f"""
        WITH RECURSIVE h AS (
            SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents),
        levels AS (
            SELECT d, hash >> CAST(60 - d AS BIGINT) AS p, sum(bytes) AS b, count(*) AS n
            FROM h, (SELECT unnest(range(25)) AS d) GROUP BY 1, 2),
        tree AS (
            SELECT d, p, b, n FROM levels WHERE d = 0
            UNION ALL
            SELECT l.d, l.p, l.b, l.n FROM tree t JOIN levels l ON l.d = t.d + 1 AND l.p >> 1 = t.p
            WHERE t.b > {limit} AND t.n > 1)
        SELECT doc_id, bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), CAST(d AS INTEGER), '0') END AS shard,
               CAST(d AS INTEGER) AS shard_depth, CAST(b AS BIGINT) AS shard_bytes, n AS shard_rows
        FROM h JOIN tree ON hash >> CAST(60 - d AS BIGINT) = p WHERE b <= {limit} OR n = 1"""


#: CRC-32 of the decimal digits of `n`, bit by bit.
_CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({n} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)))"""

_DIFF_SQL = f"""
    WITH a AS (SELECT doc_id AS key, text, lang, source, {_CRC32_SQL.format(n="doc_id")} % 10 AS kind FROM documents),
    b AS (
        SELECT unnest(CASE WHEN kind IN (3, 4) THEN [-1 - key] WHEN kind = 5 THEN [key, -1 - key] ELSE [key] END) AS key,
               CASE WHEN kind = 1 THEN coalesce(text, '') || '+' ELSE text END AS text, CASE WHEN kind = 2 THEN source ELSE lang END AS lang,
               CASE WHEN kind = 2 THEN lang WHEN kind = 4 THEN NULL ELSE source END AS source
        FROM a WHERE kind IS DISTINCT FROM 0),
    k AS (SELECT a.key AS a_key, b.key AS b_key, a.text AS a_text, b.text AS b_text, a.lang AS a_lang, b.lang AS b_lang, a.source AS a_source, b.source AS b_source
          FROM a FULL JOIN b ON a.key = b.key),
    x AS (SELECT a_key AS key, a_text AS text, a_lang AS lang, a_source AS source, row_number() OVER (PARTITION BY a_text, a_lang, a_source ORDER BY a_key) AS i FROM k WHERE b_key IS NULL),
    y AS (SELECT b_key AS key, b_text AS text, b_lang AS lang, b_source AS source, row_number() OVER (PARTITION BY b_text, b_lang, b_source ORDER BY b_key) AS i FROM k WHERE a_key IS NULL),
    r AS (
        SELECT b_key AS key, a_key AS old_key, CASE WHEN a_text IS DISTINCT FROM b_text OR a_lang IS DISTINCT FROM b_lang OR a_source IS DISTINCT FROM b_source THEN 'update' ELSE 'same' END AS op,
               concat_ws(',', CASE WHEN a_text IS DISTINCT FROM b_text THEN 'text' END, CASE WHEN a_lang IS DISTINCT FROM b_lang THEN 'lang' END, CASE WHEN a_source IS DISTINCT FROM b_source THEN 'source' END) AS changed,
               b_text AS text, b_lang AS lang, b_source AS source
        FROM k WHERE a_key IS NOT NULL AND b_key IS NOT NULL
        UNION ALL
        SELECT coalesce(y.key, x.key), x.key, CASE WHEN y.key IS NULL THEN 'delete' WHEN x.key IS NULL THEN 'insert' ELSE 'rekey' END, '', y.text, y.lang, y.source
        FROM x FULL JOIN y ON x.i = y.i AND x.text IS NOT DISTINCT FROM y.text AND x.lang IS NOT DISTINCT FROM y.lang AND x.source IS NOT DISTINCT FROM y.source)
    SELECT key, old_key, op, changed, CASE WHEN op <> 'delete' THEN sha256(concat_ws(chr(10), coalesce(text, '~'), coalesce(lang, '~'), coalesce(source, '~'))) END AS row_sha256 FROM r"""

_WARC_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f FROM pages),
    d AS (SELECT page_id, f, strlen(html) AS n, list_aggregate(list_transform(string_split(sha1(html), ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), 'string_agg', '') AS bits FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j: CAST(substr(bits, 5 * i + j + 1, 1) AS INTEGER) << (4 - j)))::INTEGER, 1)), 'string_agg', '') AS payload_digest
    FROM d"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_best_fit_packing, op2_order_minhash, op3_token_counts, op4_exact_dedup, op5_ngram_jaccard_join, op6_sharding, op7_substring_dedup, op8_source_mixing, op9_token_output, op10_language_id, op11_snapshot_diff, op12_ball_kmeans, op13_warc, sharding_64k)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op6_sharding": _sharding_sql(sharding.BYTE_LIMIT),
        "op11_snapshot_diff": _DIFF_SQL,
        "op12_ball_kmeans": clustering.cluster_sql(),
        "op13_warc": _WARC_SQL,
        "sharding_64k": _sharding_sql(1 << 16),
    }
