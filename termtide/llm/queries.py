"""The queries over the test tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import bpe, centroids, decontaminate, jaccard, language, licenses, pii
from termtide.llm import preference, quality, repeats, simhash, warc, whitening
from termtide.llm.common import read_table
from termtide.llm.oracles import ORACLE_SQL as ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

# A fixed key, so that results can be repeated; real runs pass one from their secret store.
PII_KEY = "termtide test key"
TOKENIZER = "byte_bpe_50k.json"
WARC_ARCHIVE_BYTES = 32 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with its later answers' words turned around."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turned = F.array_join(F.reverse(F.split("text", " ")), " ")
    later = (F.col("role") == "assistant") & (F.col("turn") >= 2 * F.pmod("conv_id", F.lit(3)))
    other = turns.withColumn("text", F.when(later, turned).otherwise(F.col("text")))
    return preference.preference_pairs(turns, other)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_hits(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op3_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"]
    )
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256",
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(licenses.license_spans(read_table(spark, sf_dir, "documents")))


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymize(docs, PII_KEY, spans_col="spans")
    kinds = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["kind"])))
    return found.select(
        "doc_id",
        "text",
        F.size("spans").cast("bigint").alias("n_replaced"),
        F.array_join(kinds, ",").alias("kinds"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(spark, docs, tokenizer_path())
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    ).drop("n_lines")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return warc.archive_round_trip(pages, archive_bytes=WARC_ARCHIVE_BYTES).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out()))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whitened_embeddings(read_table(spark, sf_dir, "embeddings"))
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    return made.select(F.col("id").alias("vec_id"), *names)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_sets(read_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read_table(spark, sf_dir, "embeddings"))
    return centroids.cluster_report(found).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_preference_format,
        op2_decontaminate,
        op3_repeated_substrings,
        op4_license_scan,
        op5_pii_pseudonyms,
        op6_simhash,
        op7_bpe,
        op8_quality_rules,
        op9_warc,
        op10_language,
        op11_whitening,
        op12_jaccard_join,
        op13_centroids,
    )
}
