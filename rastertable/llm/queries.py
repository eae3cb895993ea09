"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embedding_dedup, exact_dedup, hard_negatives, license_scan, manifest, minhash, mixing, pii,
               quality, repeats, secret_scan, token_store)
from .common import shared_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir), with_columns=["doc_id"])


@query("op4_mixing", r"""
WITH d AS (SELECT doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
        3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS whole FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used,
        (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest FROM w),
l AS (SELECT *, (whole - used)::DOUBLE / rest AS share FROM r),
m AS (SELECT arg_min(share, used) AS level FROM l WHERE share * weight <= cap),
t AS (SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM l, m),
k AS (SELECT *, md5(concat_ws(':', '0', doc_id, size)) AS key FROM d),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY substr(key, 1, 15), doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
b AS (SELECT p.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE (budget // source_size) * size
        + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken FROM b""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), with_columns=["doc_id"])


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), with_ids=False)


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_table(quality.features(documents(spark, sf_dir)), "features")
    model = quality.fit(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_features(table, model).select(
        F.col("id").alias("doc_id"), (quality.fold("id") == 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op5_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text")))


@query("op6_embedding_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), with_columns=["vec_id"])


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.digest(pii.personal_data(docs, pii.fit(docs)))


@query("op8_minhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), with_columns=["doc_id"])


@query("op9_token_store")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_tokens(token_store.write_tokens(documents(spark, sf_dir)), with_ids=False)


@query("op10_repeats")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir), with_columns=["doc_id"], with_text=False).drop("removed")


@query("op11_licenses")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(documents(spark, sf_dir).select("doc_id", "text")))


@query("op12_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM v),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             list_inner_product(a.e, b.e)::BIGINT AS score
      FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
        AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), anchor=F.col("vec_id") % 100 == 0)


@query("op13_manifest", r"""
WITH RECURSIVE
d AS (SELECT doc_id, lang, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
               lambda crc, byte: list_reduce(list_transform(range(8), lambda i: i::UBIGINT),
                 lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END, xor(crc, byte)),
               4294967295::UBIGINT) AS crc, source, n_chars, text,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
f AS (SELECT doc_id, lang, crc, text, low, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM d),
leaf AS (SELECT doc_id, coalesce('=' || lang, '') AS part, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
           sha256(head || CASE WHEN xor(crc, 4294967295::UBIGINT) % 3 = 0 THEN coalesce(strlen(low) || ':' || low, '-')
                               ELSE coalesce(strlen(text) || ':' || text, '-') END) AS claimed FROM f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
             count(*) OVER (PARTITION BY part) AS n FROM leaf),
low AS (SELECT part, 0 AS level, idx, n, h FROM ranked UNION ALL
        SELECT part, level + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx))
        FROM low WHERE n > 1 GROUP BY part, level, idx // 8),
sub AS (SELECT part, h AS subroot, row_number() OVER (ORDER BY part) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, idx, n, subroot AS h FROM sub UNION ALL
         SELECT level + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx))
         FROM high WHERE n > 1 GROUP BY level, idx // 8),
nodes AS (SELECT part, level, idx, h FROM low WHERE n > 1 UNION ALL SELECT 'top', level, idx, h FROM high WHERE n > 1),
seg AS (SELECT part, level, idx,
          coalesce(string_agg(h, '') OVER (g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
          coalesce(string_agg(h, '') OVER (g ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
        FROM nodes WINDOW g AS (PARTITION BY part, level, idx // 8 ORDER BY idx)),
up AS (SELECT r.part, r.idx, list({'b': b, 'a': a} ORDER BY level) AS path FROM ranked r
       JOIN seg ON seg.part = r.part AND seg.idx = r.idx // (8 ** level)::BIGINT GROUP BY 1, 2),
top AS (SELECT s.part, list({'b': b, 'a': a} ORDER BY level) AS path FROM sub s
        JOIN seg ON seg.part = 'top' AND seg.idx = s.idx // (8 ** level)::BIGINT GROUP BY 1),
whole AS (SELECT r.doc_id, r.h AS leaf, r.claimed, subroot, (SELECT h FROM high WHERE n = 1) AS root,
            list_concat(coalesce(up.path, []), coalesce(top.path, [])) AS path
          FROM ranked r JOIN sub USING (part) LEFT JOIN up ON up.part = r.part AND up.idx = r.idx
          LEFT JOIN top ON top.part = r.part),
done AS (SELECT *, sha256(array_to_string(list_transform(path, lambda s: s.b || s.a), '')) AS proof_sha256,
           list_reduce(path, lambda x, s: {'b': sha256(s.b || x.b || s.a), 'a': ''}, {'b': claimed, 'a': ''}).b AS folded_root
         FROM whole)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    low = manifest.leaf_digest(*[F.translate("text", capitals, capitals.lower()) if c == "text" else F.col(c) for c in fields])
    return manifest.audit(manifest.build(docs, fields, more={"tampered": F.when(tampered, low)}), claimed="tampered")
