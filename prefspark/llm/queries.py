"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm import collision_ann, collocations, decontamination, near_duplicates, packing, pii, quality_classifier, quality_rules
from prefspark.llm import secrets, simple8b, spelling_variants, token_counts, tokenization, warc
from prefspark.storage import new_path

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses_of(table(spark, sf_dir, "pages")))


def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark)
    simple8b.write_token_table(table(spark, sf_dir, "documents"), path, tokenization.tokenizer_path(WORD_TOKENIZER))
    return simple8b.read_token_digests(spark, path)


def packed_digests(docs: DataFrame) -> DataFrame:
    """The places of all pieces, with digests of their ids instead of the ids."""
    pieces = packing.cut_documents(docs, tokenization.tokenizer_path(WORD_TOKENIZER))
    digests = pieces.select("piece_id", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return digests.join(packing.place_pieces(pieces), "piece_id").drop("piece_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=4, similarity_pct=80)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *map(of_kind, pii.BASE_KINDS),
        F.sha2(pii.joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenization.tokenizer_path(BYTE_TOKENIZER))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *map(of_kind, secrets.BASE_KINDS),
        F.sha2(pii.joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
    )


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collision_ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), k=20, every=20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query_row", "row")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"), min_length=5, min_count=3, ratio=2)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_warc_derivatives,
        op3_simple8b,
        op4_packing,
        op5_quality_rules,
        op6_near_duplicates,
        op7_personal_data,
        op8_quality_scores,
        op9_token_counts,
        op10_secrets,
        op11_nearest_neighbours,
        op12_collocations,
        op13_spelling_variants,
    )
}
