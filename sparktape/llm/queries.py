"""The operators and the pipeline as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    language,
    line_dedup,
    near_dedup,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    token_counts,
    toxicity,
    whitening,
)
from .oracles import ORACLES
from .tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def fold(folds: int):
    """Remainder of the CRC-32 of the doc_id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(_docs(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_docs(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _docs(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(3) != 1))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC_AT).cast("int").alias("predicted"),
    )


#: The conversation that says the control strings of other templates.
PROBE = "\\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = rows.unionByName(probe)
    done = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text"))))
    turns = chat.read_turns(F.col("formatted"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = chat.read_learnt(F.col("formatted"), F.col("loss_spans"))
    return done.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_docs(spark, sf_dir))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_docs(spark, sf_dir), shingle_words=4)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = language.fit(docs.where(fold(5) != 0))
    found = language.with_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
        "language.rejected",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_docs(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "perplexity",
        "base_failed",
        "kept",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    learnt = whitening.fit(rows)
    shares = [F.lit(share).cast("double") for share in learnt.explained]
    found = whitening.with_whitened(rows, learnt).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "value")
    )
    return found.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(learnt.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(F.array(*shares).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(learnt.identity_error).cast("double").alias("identity_error"),
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """`doc_id, text`; a tenth of the texts, by the CRC-32 of the doc_id, repeat some words from
    some place on to their end. A null doc_id plants nothing."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(code / 10).alias("g"), (code % 10 == 0).alias("chosen"))
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def planted(word, i):
        place = F.col("a") + F.pmod(i - F.col("a"), F.col("p"))
        return F.when(i >= F.col("a"), F.get("words", place.cast("int"))).otherwise(word)

    text = F.array_join(F.transform("words", planted), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.with_runs(with_planted_period(_docs(spark, sf_dir))).select(
        "doc_id", "runs", "collapsed", periodic.longest_run(F.col("runs")).alias("best")
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c] for c in periodic.RUN)), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}") for name in periodic.RUN),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.with_token_counts(_docs(spark, sf_dir).select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def all_queries() -> dict[str, Query]:
    import corpus_pipeline

    named = [
        op1_decontaminate,
        op2_line_dedup,
        op3_packing,
        op4_sharding,
        op5_toxicity,
        op6_chat,
        op7_secrets,
        op8_near_dedup,
        op9_language,
        op10_quality,
        op11_whitening,
        op12_periodic,
        op13_token_counts,
    ]
    return {run.__name__: run for run in named} | {"pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    import corpus_pipeline

    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | pipeline
