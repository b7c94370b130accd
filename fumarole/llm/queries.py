"""The corpus operators as queries: (spark, folder of the tables) -> DataFrame."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.llm import bottomk, bpe, chat, jaccard, language, lines, merkle, middle, mixing, neighbours, orderhash, rules, substrings
from fumarole.llm.common import held_out, stored
from fumarole.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

__all__ = ["ORACLE", "QUERIES"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_ngram_jaccard_join(spark, sf):
    found = jaccard.near_duplicates(documents(spark, sf), 3, (90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op2_language_id(spark, sf):
    docs = documents(spark, sf)
    samples = language.learn(docs.where(~held_out(F.col("doc_id"))))
    return language.predict(docs, samples).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_substring_dedup(spark, sf):
    return substrings.without_repeats(documents(spark, sf)).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_document_fingerprints(spark, sf):
    return orderhash.edited_likeness(documents(spark, sf))


def token_rows(docs: DataFrame) -> DataFrame:
    ids = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    return bpe.decode_ids(ids, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_byte_level_bpe(spark, sf):
    return token_rows(documents(spark, sf))


@query
def op6_mixing_sources(spark, sf):
    taken = mixing.taken_rows(documents(spark, sf))
    return taken.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op7_quality_classifier(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = neighbours.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = neighbours.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op8_line_dedup(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    bitmaps = lines.line_bitmaps(docs)
    kept = lines.with_bitmaps(docs, bitmaps)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_quality_rules(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    sample = rules.text_measures(rules.some_rows(docs))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = rules.cascade(rules.text_measures(docs).withColumn("base_failed", failed), rules.standard_rules(), sample, costs=rules.standard_costs())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_chat_formatting(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    chats = chat.format_chats(turns.unionByName(more))
    read = chats.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "")})
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query
def op11_fill_in_middle(spark, sf):
    framed = stored(middle.framed_texts(documents(spark, sf)), "framed")
    return middle.digests(middle.fill_in_middle(framed))


@query
def op12_merkle_manifest(spark, sf):
    """The suspect copy of every fifth document has its text lower-cased."""
    docs = documents(spark, sf)
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    suspect = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    leaves = docs.select(
        "doc_id", merkle.group_key(F.col("source")).alias(merkle.GROUP), merkle.leaf_hash(*head, F.col("text")).alias("digest"),
        F.when(suspect, merkle.leaf_hash(*head, merkle.lower_ascii(F.col("text")))).alias("suspect"))
    found = merkle.manifest(leaves).withColumn("folded_root", merkle.folded(F.coalesce("suspect", "digest"), F.col("path")))
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op13_minhash_near_dedup(spark, sf):
    return bottomk.near_duplicates(documents(spark, sf), 4, (80, 100))


@query
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
