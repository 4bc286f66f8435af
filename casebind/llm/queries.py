"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebind.llm import chat, pii, toxicity
from casebind.llm.ball_codes import compress
from casebind.llm.decontaminate import find_items
from casebind.llm.fingerprints import compared
from casebind.llm.importance import resample
from casebind.llm.license_scan import scan_licences
from casebind.llm.line_dedup import dedup_lines
from casebind.llm.mixing import mix, quality_weights
from casebind.llm.ngram_join import near_duplicates
from casebind.llm.oracles import ORACLES  # noqa: F401
from casebind.llm.sharding import manifest
from casebind.llm.substring_dedup import dedup_substrings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_substrings(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed",
                    F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (compared(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_chars",
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")


def conversation_events(rows: DataFrame) -> DataFrame:
    """An event log of the stored turns: each begins a message and streams its text as a delta."""
    same_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
                        F.row_number().over(same_turn).alias("copy"))
    message = F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "copy")
    seq = F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "copy", F.lit(0).alias("step"))
    return turns.select("conv_id", message.alias("message"), "role", F.inline(F.array(
        F.struct(seq.alias("seq"), F.lit("message").alias("event"), F.lit("").alias("text")),
        F.struct(seq.withField("step", F.lit(1)).alias("seq"), F.lit("delta").alias("event"),
                 F.col("text").alias("text")))))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        rows.schema)
    messages = chat.reconstruct(conversation_events(rows.union(probe)))
    return chat.read_back(chat.render(messages))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "text", F.col("n_lines").cast("long"), F.col("n_kept").cast("long")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model)
            .select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                    "score", "predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.BASE),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents weigh by the quality marks of ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix(docs, quality_weights(table(spark, sf_dir, "labels")))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return (resample(docs, target, keep=["doc_id"])
            .select("doc_id", "n_features", "weight", "score", "rank"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_license_scan": op3_license_scan,
    "op4_chat": op4_chat,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_mixing": op8_mixing,
    "op8_mixing_by_quality": op8_mixing,  # its name while op8_mixing had no weights
    "op9_pii": op9_pii,
    "op10_ngram_join": op10_ngram_join,
    "op11_sharding": op11_sharding,
    "op12_vector_codes": op12_vector_codes,
    "op13_resampling": op13_resampling,
}
