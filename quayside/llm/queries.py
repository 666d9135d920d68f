"""A query per operator over the whole supplied tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bpe, exact_dedup, langid, merkle, mixing, order_minhash, qda, secret_scan, simhash, site_style, token_counts, warc, whitening
from quayside.llm.spread import learnt_from, on_workers
from quayside.sources.relations import shared_folder, written


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BPE = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = documents(spark, sf_dir).select("doc_id", bpe.round_trip("text", *BPE).alias("both")).select("doc_id", "both.*")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.edited_by_next(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op3_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = written(documents(spark, sf_dir).select("doc_id", qda.measure("text").alias("features")), "statistics")
    scored = rows.withColumn("score", qda.score("features", qda.learn(rows, labels)))
    return scored.select(
        "doc_id",
        (~learnt_from()).alias("held_out"),
        "score",
        (F.col("score") >= qda.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.fresh_index(spark)
    found = exact_dedup.memberships(documents(spark, sf_dir), index)
    index.close()
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = written(mixing.sized(documents(spark, sf_dir)).select("doc_id", "key", "size"), "sizes")
    return mixing.mixed(sizes, mixing.plan(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id"
    )


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives, index = shared_folder(spark, "warc"), shared_folder(spark, "capture-index")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), archives)
    warc.index(spark, archives, index)
    urls = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")
    found = warc.records(warc.lookup(spark, index, urls))
    response = F.col("record_type") == "response"
    return found.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", langid.predict("text", langid.fit(docs.where(learnt_from()))).alias("p"))
    return found.select(
        "doc_id",
        (~learnt_from()).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        "p.score",
        "p.rejected",
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = site_style.extract(pages).withColumnRenamed("main_text", "text")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_section(documents(spark, sf_dir), *BPE)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.by_component(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # A deviation beyond a long is null there and exact beside it.
    return found.withColumnRenamed("deviation", "deviation_exact").select(
        "vec_id",
        "component",
        "n",
        F.col("deviation_exact").try_cast("bigint").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        "deviation_exact",
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars"]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    rows = documents(spark, sf_dir).select(
        "doc_id",
        "source",
        merkle.record_digest([*fields, "text"]).alias("digest"),
        F.when(chosen, merkle.record_digest([*fields, lowered])).alias("altered"),
    )
    found = merkle.manifest(rows, "source", "doc_id", "digest", ["doc_id", "altered"])
    return found.select(
        "doc_id",
        merkle.hexadecimal("leaf").alias("leaf"),
        merkle.hexadecimal("subroot").alias("subroot"),
        merkle.hexadecimal("root").alias("root"),
        merkle.proof_digest().alias("proof_sha256"),
        merkle.folded(F.coalesce("altered", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    base = [rule.kind for rule in secret_scan.BASE]
    return found.select(
        "doc_id",
        *[secret_scan.count("spans", kind).alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"),
    )


QUERIES = (op1_byte_bpe, op2_order_minhash, op3_quality_discriminant, op4_exact_dedup, op5_source_mix, op6_simhash_components, op7_warc_index, op8_language, op9_main_text, op10_token_counts, op11_embedding_whitening, op12_merkle_manifest, op13_secret_scan)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: ready(query) for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    def field(name: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"

    def spans(rank: int, rule: secret_scan.Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""list_transform(
            list_filter(list_transform(range(1, len(regexp_extract_all(t, {pattern})) + 1), lambda i: {{
                'start': list_sum(list_transform(string_split_regex(t, {pattern})[:i], lambda s: length(s)))
                    + coalesce(list_sum(list_transform(regexp_extract_all(t, {pattern})[:i - 1], lambda s: length(s))), 0),
                'size': length(regexp_extract_all(t, {pattern})[i]),
                'counted': length(regexp_extract_all(t, {pattern}, {rule.group})[i]) >= {rule.least}}}), lambda m: m.counted),
            lambda m: {{'start': m.start, 'rank': {rank}, 'kind': '{rule.kind}', 'stop': m.start + m.size}})"""

    def joined(spans: str) -> str:
        return f"array_to_string(list_transform({spans}, lambda m: m.kind || ':' || m.start || ':' || m.stop), ',')"

    secrets = " || ".join(spans(rank, rule) for rank, rule in enumerate(secret_scan.RULES))
    base = ", ".join(f"'{rule.kind}'" for rule in secret_scan.BASE)
    counts = ", ".join(f"len(list_filter(found, lambda m: m.kind = '{rule.kind}')) AS n_{rule.kind}" for rule in secret_scan.BASE)
    record = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    return {
        "op13_secret_scan": f"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
            f AS (SELECT doc_id, list_sort({secrets}) AS found FROM d)
            SELECT doc_id, {counts}, sha256({joined(f"list_filter(found, lambda m: m.kind IN ({base}))")}) AS base_sha256,
                {joined("found")} AS spans
            FROM f""",
        "op12_merkle_manifest": f"""
            WITH RECURSIVE d AS (
                SELECT *, translate(text, '{ascii_uppercase}', '{ascii_lowercase}') AS lowered,
                    list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
                FROM documents),
            l AS (
                SELECT doc_id, source, sha256({record} || {field("text")}) AS leaf,
                    CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256({record} || {field("lowered")}) END AS altered
                FROM d),
            n AS (
                SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY source) AS size,
                    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
                FROM l),
            up AS (
                SELECT source, 0 AS lvl, place, size, leaf AS digest FROM n
                UNION ALL
                SELECT source, lvl + 1, place >> 4, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
                FROM up WHERE size > 1 GROUP BY source, lvl, place >> 4, size),
            s AS (
                SELECT source, digest AS subroot, count(*) OVER () AS size,
                    row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
                FROM up WHERE size = 1),
            top AS (
                SELECT 0 AS lvl, place, size, subroot AS digest FROM s
                UNION ALL
                SELECT lvl + 1, place >> 4, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
                FROM top WHERE size > 1 GROUP BY lvl, place >> 4, size),
            runs AS (
                SELECT n.id, u.lvl, u.place, u.digest, n.place >> (4 * u.lvl) AS own
                FROM n JOIN up u ON u.source IS NOT DISTINCT FROM n.source AND u.size > 1
                    AND u.place >> 4 = n.place >> (4 * u.lvl + 4)
                UNION ALL
                SELECT n.id, 1000 + t.lvl, t.place, t.digest, s.place >> (4 * t.lvl)
                FROM n JOIN s ON s.source IS NOT DISTINCT FROM n.source
                    JOIN top t ON t.size > 1 AND t.place >> 4 = s.place >> (4 * t.lvl + 4)),
            steps AS (
                SELECT id, row_number() OVER (PARTITION BY id ORDER BY lvl) AS step,
                    coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < own), '') AS before,
                    coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > own), '') AS after
                FROM runs GROUP BY id, lvl),
            fold AS (
                SELECT id, 0 AS step, coalesce(altered, leaf) AS digest FROM n
                UNION ALL
                SELECT id, steps.step, sha256(before || digest || after)
                FROM fold JOIN steps USING (id) WHERE steps.step = fold.step + 1),
            folded AS (SELECT id, arg_max(digest, step) AS folded_root FROM fold GROUP BY id),
            proofs AS (SELECT id, string_agg(before || after, '' ORDER BY step) AS others FROM steps GROUP BY id),
            r AS (SELECT digest AS root FROM top WHERE size = 1)
            SELECT doc_id, leaf, subroot, root, sha256(coalesce(others, '')) AS proof_sha256, folded_root,
                folded_root = root AS verified
            FROM n JOIN s ON s.source IS NOT DISTINCT FROM n.source JOIN folded USING (id)
                LEFT JOIN proofs USING (id), r""",
        "op7_warc_index": """
            WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
            d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
            f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
            SELECT page_id, n AS payload_bytes, digest AS payload_digest,
                   CASE WHEN n >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN n >= 100 AND first < page_id THEN first END AS refers_to
            FROM f""",
        "op4_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    }
