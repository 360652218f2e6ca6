"""The queries of this package, with the parameters for production, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import (
    bpe,
    caps,
    chat,
    exact,
    grid_codes,
    hard_negatives,
    licences,
    packing,
    ring,
    secret_scan,
    simhash,
    token_counts,
    toxicity,
)
from folioscope.llm.common import table

HELD_OUT = "pmod(crc32(cast(doc_id AS string)), 5) = 0"
MULTI = "byte_bpe_multi_50k.tiktoken"
RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json, as ranks
SPECIALS = {"<|endoftext|>": 50256}


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return ring.shard_documents(table(spark, folder, "documents"), shards=40)


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.array_join("licences", ";").alias("licences"),
        F.array_join("sentences.sentence", ";").alias("sentence_ids"),
        F.size("sentences").alias("n_sentences"),
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(MULTI)
    docs = table(spark, folder, "documents")
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode_documents(encoded, ranks).select(
        "doc_id",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return token_counts.count_tokens(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_vectors(table(spark, folder, "embeddings"), cosine=0.95)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return packing.pack_documents(table(spark, folder, "documents"), ranks, 2048, 0, SPECIALS)


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.expr("CASE id WHEN 0 THEN 'user' ELSE 'assistant' END").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.windows(rows, budget=1024, history=256))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = grid_codes.encode_vectors(
        table(spark, folder, "embeddings"), scale=4096, parts=8, entries=16, rounds=6
    )
    return grid_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(grid_codes.digest(books)).alias("codebooks_sha256")
    )


def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("spans")

    def of_kind(name):
        return F.filter(spans, lambda s: s["kind"] == secret_scan.KINDS.index(name))

    known = F.filter(spans, lambda s: s["kind"] != secret_scan.RANDOM)
    return secret_scan.scan_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        *[F.size(of_kind(name)).cast("long").alias(f"n_{name}") for name in secret_scan.KINDS],
        F.sha2(secret_scan.spans_text(known), 256).alias("base_sha256"),
        secret_scan.spans_text(spans).alias("spans"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(
        table(spark, folder, "embeddings"),
        is_anchor=F.expr("vec_id % 50 = 0"),
        label=F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"),
        positives=5,
        negatives=3,
        low=50,
        high=95,
        scale=256,
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_sharding": op4_sharding,
    "op5_licences": op5_licences,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_embeddings": op8_embeddings,
    "op9_packing": op9_packing,
    "op10_chat": op10_chat,
    "op11_vector_codes": op11_vector_codes,
    "op12_secrets": op12_secrets,
    "op13_hard_negatives": op13_hard_negatives,
}

NORMAL = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

FINITE = "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
SQUARES = "list_sum(list_transform(list_zip(r.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of assignment and averaging written out one after the other."""
    steps = [
        f"""WITH whole AS MATERIALIZED (
            SELECT vec_id, label,
                list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings WHERE embedding IS NOT NULL AND {FINITE}),
        r AS MATERIALIZED (
            SELECT vec_id, part, w[part * len(w) // {parts} + 1 : (part + 1) * len(w) // {parts}] AS v
            FROM whole, range({parts}) AS t(part)),
        b0 AS MATERIALIZED (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM r
            QUALIFY entry < {entries})"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
            SELECT r.vec_id, r.part, r.v, min(({SQUARES}, b.entry)) AS best
            FROM r JOIN b{k} AS b USING (part) GROUP BY ALL)"""
        )
        steps.append(
            f"""b{k + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} AS b LEFT JOIN (
                SELECT part, entry, list(CAST(total // n - (total % n < 0)::INT AS BIGINT) ORDER BY place) AS v FROM (
                    SELECT part, best[2] AS entry, place, sum(v[place]) AS total, count(*) AS n
                    FROM a{k}, range(1, 9) AS t(place) GROUP BY ALL)
                GROUP BY ALL) AS m USING (part, entry))"""
        )
    return (
        ", ".join(steps[:-1])
        + f""", coded AS MATERIALIZED (
            SELECT vec_id, CAST(sum(best[1]) AS BIGINT) AS error,
                string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code
            FROM a{rounds} GROUP BY vec_id),
        named AS (SELECT vec_id, label, code, error FROM coded JOIN whole USING (vec_id))
        SELECT vec_id, code, error,
            CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds})
                AS codebooks_sha256
        FROM named"""
    )


SQL = {
    "op11_vector_codes": _codes_sql(),
    "op13_hard_negatives": """
        WITH r AS MATERIALIZED (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {FINITE}),
        s AS MATERIALIZED (
            SELECT a.id AS anchor_id, b.id, a.label = b.label AS own,
                CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM r AS a JOIN r AS b ON a.id % 50 = 0 AND a.id <> b.id),
        positive AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
            id AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN s USING (anchor_id)
        WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3
    """.replace("{FINITE}", FINITE),
    "op3_exact_dedup": f"""
        WITH normal AS (SELECT doc_id, sha256({NORMAL}) AS text_sha256, {NORMAL} AS t FROM documents),
        groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM normal JOIN groups USING (t)
    """,
}
